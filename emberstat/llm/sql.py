"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op1_decontamination"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS g
       FROM b, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
       FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS u(i) WHERE len(w) >= n),
hit AS (SELECT DISTINCT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

ORACLES["op9_url_rules"] = r"""
WITH u AS (SELECT row_number() OVER () AS r, page_id,
  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(h, q, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (SELECT r, arg_max(h || q, length(h || q)) AS rule, arg_max(verdict, length(h || q)) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (r)
"""


def _draw(key: str, child: str) -> str:
    return f"((('0x' || substr(md5({key} || '@' || {child}), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"


def _descend(name: str, shards: int) -> str:
    """CTEs that walk the tree of ``shards`` equal shards down to ``<name>_shard(r, shard)``."""
    whole = shards // 4 * 4
    rows = ", ".join(f"('r{k // 4}', 'r{k // 4}/k{k // 2}', {k})" if k < whole else f"('x{k}', 'x{k}/k', {k})" for k in range(shards))
    out = f"{name}_leaf(region, rack, shard) AS (VALUES {rows}),\n"
    levels = [("region", "region", "true"), ("rack", "rack", "t.region = up.child"), ("shard", "rack || '#' || shard", "t.rack = up.child")]
    up = "(SELECT r, key, '' AS child FROM d)"
    for level, child, on in levels:
        out += f"""{name}_{level} AS (SELECT r, key, arg_min(c, -ln({_draw('key', 'c')}) / w) AS child FROM (
  SELECT up.r, up.key, {child} AS c, count(*) AS w FROM {up} up JOIN {name}_leaf t ON {on} GROUP BY ALL) GROUP BY r, key),\n"""
        up = f"{name}_{level}"
    return out


# CRC-32 is linear in the bits of the text: step() moves a register over a zero byte, each bit of a byte adds its
# own register, moved by the byte's distance from the end
ORACLES["op8_sharding"] = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key, text,
  coalesce(octet_length(encode(text)), 0) + 1 AS size FROM documents),
{_descend('a', 8)}{_descend('b', 9)}
tab AS (SELECT i, list_reduce([i] || [0, 1, 2, 3, 4, 5, 6, 7], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
  FROM (SELECT unnest(generate_series(0::BIGINT, 255)) AS i)),
walk(n, lane, x) AS (SELECT 0::BIGINT, lane, CASE WHEN lane = 8 THEN 4294967295 ELSE v END
    FROM (SELECT unnest(generate_series(0::BIGINT, 8)) AS lane) l LEFT JOIN tab ON i = CASE WHEN lane = 8 THEN 0 ELSE 1 << lane END
  UNION ALL SELECT n + 1, lane, xor(x >> 8, v) FROM walk JOIN tab ON i = x & 255 WHERE n < (SELECT max(size) FROM d)),
hexes AS (SELECT i, lower(printf('%02x', i)) AS h FROM tab),
bytes AS (SELECT r, size - 1 - unnest(generate_series(1, size - 1)) AS n, unnest(regexp_extract_all(lower(hex(encode(text))), '..')) AS h FROM d WHERE size > 1),
bits AS (SELECT r, bit_xor(x) AS c FROM bytes JOIN hexes USING (h) JOIN walk USING (n) WHERE lane < 8 AND (i >> lane) & 1 = 1 GROUP BY r),
crc AS (SELECT r, CASE WHEN text IS NOT NULL THEN xor(xor(coalesce(c, 0), x), 4294967295) END AS crc
  FROM d LEFT JOIN bits USING (r) JOIN walk ON n = size - 1 AND lane = 8)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law,
  CAST(split_part(a_shard.child, '#', 2) AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY a_shard.child ORDER BY md5(concat_ws(':', 'slot', CAST(doc_id AS VARCHAR), CAST(size AS VARCHAR), CAST(crc AS VARCHAR)))) - 1 AS slot,
  CAST(split_part(b_shard.child, '#', 2) AS INTEGER) AS grown_shard
FROM d JOIN crc USING (r) JOIN a_shard USING (r) JOIN b_shard USING (r)
"""


def _seats(name: str, cells: str, part: str, cell: str, share: str) -> str:
    """Highest quotients, every seat listed: ``<name>(part, cell, quota)``."""
    return f"""{name}_quotients AS (SELECT {part}, {cell}, seats, {share} AS s, unnest(generate_series(0, seats)) AS k FROM {cells} WHERE {share} > 0),
{name}_ranked AS (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY s / (2 * k + 1) DESC, {cell}, k) AS rank FROM {name}_quotients),
{name} AS (SELECT {part}, {cell}, count(*) AS quota FROM {name}_ranked WHERE rank <= seats GROUP BY ALL)"""


def _before(x: str) -> str:
    def chosen(b: str) -> str:
        return f"((start + {b}) * extra // blocks - start * extra // blocks)"

    return f"(base * ({x}) + {chosen(f'(({x}) // 16)')} * 16 + ({chosen(f'(({x}) // 16 + 1)')} - {chosen(f'(({x}) // 16)')}) * (({x}) % 16))"


ORACLES["op3_mixing"] = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
  md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))) AS draw FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM d GROUP BY source),
weighed AS (SELECT *, (number - 1) % 3 + 1 AS weight, (SELECT sum(source_size) FROM src) AS total FROM src),
rounds AS (SELECT 0 AS step, number, weight, source_size, total, false AS capped,
    total / (SELECT sum(weight) FROM weighed) * weight AS target FROM weighed
  UNION ALL SELECT step + 1, number, weight, source_size, total, now, CASE WHEN now THEN CAST(3 * source_size AS DOUBLE) ELSE
    CAST(total - coalesce(sum(3 * source_size) FILTER (now) OVER (), 0) AS DOUBLE) / (sum(weight) FILTER (NOT now) OVER ()) * weight END
  FROM (SELECT *, capped OR target > 3 * source_size AS now FROM rounds) WHERE step < 60),
goal AS (SELECT number, source, src.source_size, target, CAST(ceil(total / 16.0) AS BIGINT) AS seats, 0 AS everything
  FROM rounds JOIN src USING (number) WHERE step = 60),
{_seats('first', 'goal', 'everything', 'number', 'target')},
placed AS (SELECT d.*, number, source_size, target, coalesce(quota, 0) AS quota,
  CAST(floor((('0x' || substr(draw, 1, 8))::BIGINT)::DOUBLE / 4294967296.0 * ceil(greatest(source_size, 1) / 1048576.0)) AS BIGINT) AS shard
  FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source LEFT JOIN first USING (number)),
cells AS (SELECT number, shard, any_value(quota) AS seats, CAST(sum(size) AS BIGINT) AS words FROM placed GROUP BY number, shard),
{_seats('second', 'cells', 'number', 'shard', 'words')},
own AS (SELECT number, shard, blocks, least(coalesce(quota, 0), 3 * blocks) // blocks AS base, least(coalesce(quota, 0), 3 * blocks) % blocks AS extra,
  ('0x' || substr(md5(concat_ws(':', 'mix', CAST(number AS VARCHAR), CAST(shard AS VARCHAR))), 1, 8))::BIGINT % blocks AS start
  FROM (SELECT *, (words + 15) // 16 AS blocks FROM cells WHERE words > 0) LEFT JOIN second USING (number, shard)),
line AS (SELECT placed.*, base, extra, start, blocks, CAST(coalesce(sum(size) OVER (PARTITION BY number, shard ORDER BY draw, r
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a FROM placed LEFT JOIN own USING (number, shard))
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(CASE WHEN size > 0 THEN {_before('a + size')} - {_before('a')} ELSE 0 END AS BIGINT) AS taken FROM line
"""


def _licenses() -> str:
    from .licenses import DRIFT, K, LEAST_COVER, MOST_STRETCH, PHRASES

    phrases = ", ".join(f"({k}, '{p.label}', {p.base}, '{p.words}')" for k, p in enumerate(PHRASES))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT phrase, label, base, string_split(txt, ' ') AS w FROM (VALUES {phrases}) AS v(phrase, label, base, txt)),
tg AS (SELECT phrase, label, base, len(w) AS m, i AS place, list_slice(w, i + 1, i + {K}) AS g FROM t, unnest(generate_series(0, len(w) - {K})) AS u(i)),
dg AS (SELECT r, i AS pos, list_slice(w, i + 1, i + {K}) AS g FROM d, unnest(generate_series(0, len(w) - {K})) AS u(i)),
votes AS (SELECT r, phrase, label, base, m, pos - place AS diagonal, count(*) AS votes, list(place) AS places, min(pos) AS s, max(pos) + {K} AS e
  FROM dg JOIN tg USING (g) GROUP BY ALL),
steps AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, phrase ORDER BY diagonal) <= {DRIFT} THEN 0 ELSE 1 END AS far FROM votes),
named AS (SELECT *, sum(far) OVER (PARTITION BY r, phrase ORDER BY diagonal) AS span FROM steps),
full_ AS (SELECT r, label, diagonal FROM votes WHERE base AND votes = m - {K - 1}),
words AS (SELECT r, phrase, label, m, span, min(s) AS s, max(e) AS e, list_distinct(flatten(list(places))) AS places FROM named GROUP BY r, phrase, label, m, span),
spans AS (SELECT r, phrase, label, s, e, m, (SELECT count(DISTINCT p + k) FROM unnest(places) AS u(p), unnest(generate_series(0, {K - 1})) AS v(k)) / m AS cover FROM words),
good AS (SELECT r, label, cover FROM spans WHERE cover >= {LEAST_COVER} AND e - s <= {MOST_STRETCH} * m UNION ALL SELECT r, label, 1.0 FROM full_),
a AS (SELECT r, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM full_ GROUP BY r),
b AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score FROM good GROUP BY r)
SELECT doc_id, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(coalesce(score, 0) AS DOUBLE) AS score FROM d LEFT JOIN a USING (r) LEFT JOIN b USING (r)
"""


ORACLES["op2_licenses"] = _licenses()


def _quality() -> str:
    from .quality import CLASSES, COMMON_WORDS, LEAST_FOR_WORDS, LEAST_WORDS, MOST_CHAR_DISTANCE, MOST_WORD_SHARE, WORDS

    sets = {"lower": "[a-z]", "upper": "[A-Z]", "digits": "[0-9]", "white": r"[\x20\x09-\x0D]", "symbols": "[#*$%&|<>]", "other_scripts": r"[^\x00-\x7F]",
            "marks": r"[^a-zA-Z0-9\x20\x09-\x0D#*$%&|<>\x80-\x{10FFFF}]"}
    classes = ", ".join(f"('{c}')" for c in CLASSES)
    count = " ".join(f"WHEN '{c}' THEN length(text) - length(regexp_replace(text, '{sets[c]}+', '', 'g'))" for c in CLASSES)
    langs = ", ".join(f"'{x}'" for x in COMMON_WORDS)
    words = ", ".join(f"('{w}')" for w in WORDS)

    def half(a: str, b: str) -> str:
        return f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"

    def jsd(p: str) -> str:
        return f"sqrt(greatest(sum({half(p, 'q')} + {half('q', p)}) / 2, 0))"

    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, CASE WHEN lang IN ({langs}) THEN lang ELSE '' END AS ref,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
cc AS (SELECT r, ref, class, CASE class {count} END AS n FROM d, (VALUES {classes}) AS v(class)),
wl AS (SELECT r, ref, unnest(w) AS word FROM d),
wc AS (SELECT r, word AS class, count(*) AS n FROM wl WHERE word IN (SELECT * FROM (VALUES {words})) GROUP BY ALL),
wn AS (SELECT r, ref, len(w) AS n_words FROM d WHERE len(w) > 0),
wf AS (SELECT wn.r, ref, v.word AS class, coalesce(n, 0) AS n, n_words FROM wn CROSS JOIN (VALUES {words}) AS v(word) LEFT JOIN wc ON wc.r = wn.r AND wc.class = v.word),
wr AS (SELECT ref, class, sum(n) / sum(n_words) AS q FROM wf GROUP BY ALL),
ws AS (SELECT r, class, n / n_words AS p, q FROM wf JOIN wr USING (ref, class)),
wa AS (SELECT r, class, p, q FROM ws UNION ALL SELECT r, NULL, greatest(1 - sum(p), 0), greatest(1 - sum(q), 0) FROM ws GROUP BY r),
wd AS (SELECT r, {jsd('p')} AS word_distance, {jsd('o')} AS blank
  FROM (SELECT *, CASE WHEN class IS NULL THEN 1.0 ELSE 0.0 END AS o FROM wa) GROUP BY r),
ct AS (SELECT r, sum(n) AS t FROM cc GROUP BY r),
cr AS (SELECT ref, class, sum(n) / sum(sum(n)) OVER (PARTITION BY ref) AS q FROM cc GROUP BY ref, class),
cd AS (SELECT r, {jsd('p')} AS char_distance FROM (SELECT r, n / t AS p, q FROM cc JOIN ct USING (r) JOIN cr USING (ref, class) WHERE t > 0) GROUP BY r),
g AS (SELECT r, i, array_to_string(list_slice(w, i, i + 2), ' ') AS g FROM d, unnest(generate_series(1, len(w) - 2)) AS u(i)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + 2)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1) GROUP BY r),
ln AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
a AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(ln.n, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM d LEFT JOIN rep USING (r) LEFT JOIN ln USING (r)),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(char_distance, 0) <= {MOST_CHAR_DISTANCE}
  AND (n_words < {LEAST_FOR_WORDS} OR coalesce(word_distance, 0) <= {MOST_WORD_SHARE} * coalesce(blank, 1)) AS kept FROM b LEFT JOIN cd USING (r) LEFT JOIN wd USING (r)
"""


ORACLES["op5_quality"] = _quality()

ORACLES["op11_lexical_search"] = rf"""
WITH d AS (SELECT r, doc_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents)),
tf AS (SELECT r, doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT r, count(*) AS n FROM d GROUP BY r),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY t, docs),
q AS (SELECT DISTINCT i, item_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS i, item_id, {_WORDS} AS w FROM benchmark)),
scored AS (SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // words))))) AS score
           FROM q JOIN w USING (t) JOIN tf USING (t) JOIN n USING (r), s GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 50
"""

ORACLES["op13_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, octet_length(encode(html)) AS n, array_to_string(list_transform(generate_series(0, 31), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + (i // 8) * 10, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)), '') AS digest FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM w
"""
