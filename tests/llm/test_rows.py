"""Operators that judge rows one by one: odd values, clashing names, empty tables."""

import base64
import random
import string
import zlib
from collections import Counter

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from emberstat.llm.language import fit, held_out, identify, training_sample
from emberstat.llm.licenses import PHRASES, scan_licenses
from emberstat.llm.mixing import mix, mixed
from emberstat.llm.page_text import article_of, extract_text, unique_runs
from emberstat.llm.quality import judge_quality
from emberstat.llm.queries import QUERIES
from emberstat.llm.sharding import assign, grown, leaves, placed, shard_of
from emberstat.llm.token_count import count_merged, count_tokens, load_vocabulary
from emberstat.llm.url_rules import judge_urls
from tests.conftest import SMALL
from tests.llm import brute

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, None, "en", "a", 1), (2, "", None, None, 2), (None, " \n\t ", "fr", "a", 3), (3, "?! ... #$%", "xx", "b", 4), (4, "One word", "en", "b", 5),
       (4, "One word", "en", "b", 5), (5, "x" * 300_000, "de", None, 6), (6, "the cat and the dog " * 40_000, "en", "a", 7), (7, "Ünï çødé 漢字     z", "de", "c", 8)]
SCHEMA = "doc_id long, text string, lang string, source string, n_words long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).cache()


# token counts
def test_token_counts_equal_the_library(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op6_token_count"](spark, SMALL).collect()}
    table = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    library = Tokenizer.from_file(PATH)
    for d, t in zip(table["doc_id"], table["text"]):
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (rows[d]["n_tokens"], rows[d]["n_bytes"], rows[d]["over_limit"]) == (n, len(t.encode()), n > 512)


def test_token_counts_of_odd_texts(spark, odd):
    library = Tokenizer.from_file(PATH)
    r = random.Random(9)
    signs = [*"abcXYZ  '\n\t.,!019éß", " ", "\x85", "\x1c", " ", "中", "😀", "́", "²", "'s", "'ll", " the", "<|endoftext|>", "\r", "  "]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 30))) for _ in range(3000)] + [t or "" for _, t, *_ in ODD]
    df = spark.createDataFrame(list(enumerate(texts)), "n_tokens long, text string")
    got = {x["id"]: x["n_tokens"] for x in count_tokens(df.withColumnRenamed("n_tokens", "id"), PATH).collect()}
    assert [got[i] for i in range(len(texts))] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert count_tokens(odd.limit(0), PATH).count() == 0


def test_merging_one_long_word():
    vocabulary = load_vocabulary(PATH)
    library = Tokenizer.from_file(PATH)
    for word in ("a" * 5000, "abracadabra" * 300):
        assert count_merged(word.encode(), vocabulary) == len(library.encode(word, add_special_tokens=False).ids)


# languages
def test_languages_are_told_apart(spark):
    rows = QUERIES["op10_language"](spark, SMALL).collect()
    table = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    lang = dict(zip(table["doc_id"], table["lang"]))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and sum(lang[r["doc_id"]] == r["lang_pred"] for r in out) >= 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(spark, odd):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = fit(docs)
    got = sorted((str(r["doc_id"]), r["lang_pred"], r["rejected"]) for r in identify(odd.withColumnRenamed("lang", "lang_pred"), model).collect())
    und = [g for g in got if g[1] == "und"]
    assert sorted(u[0] for u in und) == ["1", "2", "3", "None"] and all(u[2] for u in und)
    assert {g[1] for g in got} <= {"und", "en", "fr", "de", "es"}
    assert sum(r["rejected"] for r in identify(docs, model).collect()) <= 2
    none = fit(docs.limit(0))
    assert {(r["lang_pred"], r["rejected"]) for r in identify(odd, none).collect()} == {("und", True)}
    assert identify(odd.limit(0), model).count() == 0


UNLEARNED = {
    "fi": "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä",
    "sw": "watu wote wamezaliwa huru hadhi na haki zao ni sawa wote wamejaliwa akili na dhamiri hivyo yapasa watendeane kindugu kila mtu anastahili kuwa na haki zote na uhuru wote",
    "pl": "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa"}


def test_junk_and_unlearned_languages_are_rejected(spark):
    r = random.Random(3)
    rows = []
    for n in (50, 100, 300, 1000):
        rows.append((f"letters {n}", " ".join("".join(r.choice(string.ascii_lowercase) for _ in range(r.randint(2, 9))) for _ in range(n))))
        rows += [(f"hex {n}", r.randbytes(3 * n).hex()), (f"base64 {n}", base64.b64encode(r.randbytes(5 * n)).decode())]
        rows += [(f"{lang} {n}", " ".join(r.choice(words.split()) for _ in range(n))) for lang, words in UNLEARNED.items()]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit(docs.filter(~held_out(docs["doc_id"])))
    junk = identify(spark.createDataFrame(rows, "id string, text string"), model)
    assert not [x["id"] for x in junk.collect() if not x["rejected"]]
    quality = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1")
    clean = identify(docs.join(quality, "doc_id"), model, keep=["doc_id"]).collect()
    assert len(clean) > 200 and sum(x["rejected"] for x in clean) <= 0.005 * len(clean)


def test_copies_do_not_starve_the_sample(spark):
    few = spark.range(40_000).selectExpr("concat('text of few ', char(97 + id % 5)) AS text", "'few' AS lang")
    hot = spark.range(63_000).selectExpr("concat('text of many ', greatest(id - 60000, 0)) AS text", "'hot' AS lang")
    no_letters = spark.range(5000).selectExpr("cast(id AS string) AS text", "'few' AS lang")
    docs = few.unionByName(hot).unionByName(no_letters)
    assert Counter(r["lang"] for r in training_sample(docs, 1000).collect()) == {"few": 5, "hot": 1000}
    assert Counter(r["lang"] for r in training_sample(docs, 1).collect()) == {"few": 1, "hot": 1}


# licences
def test_licences_of_odd_and_edited_texts(spark, odd):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    texts = [gpl, gpl.replace("Public", "big Public"), "Under the MIT-License! under the mit license", "cc by, nc CC-BY-NC", "apache license version 3",
             "under the mit licence", "apache license version 2 " * 50]
    rows = [(i, t, "L") for i, t in enumerate(texts)]
    got = {r["id"]: r for r in scan_licenses(spark.createDataFrame(rows, "id long, text string, labels string")).collect()}
    assert [(got[i]["n_base"], got[i]["first_word"], got[i]["last_word"], got[i]["base_labels"], got[i]["labels"]) for i in range(7)] == [
        (0, None, None, "", "gpl-3"), (0, None, None, "", "gpl-3"), (2, 0, 4, "mit", "mit"), (2, 0, 3, "cc-by-nc", "cc-by-nc"), (0, None, None, "", ""),
        (0, None, None, "", ""), (50, 0, 196, "apache-2", "apache-2")]
    assert 0.8 <= got[1]["score"] <= 1 and got[0]["score"] == 1 and got[4]["score"] == 0
    plain = scan_licenses(odd).collect()
    assert len(plain) == len(ODD) and all(r["n_base"] == 0 and r["labels"] == "" for r in plain)
    assert scan_licenses(odd.limit(0)).count() == 0


def test_every_phrase_is_found(spark):
    rows = [(i, f"some words {p.words} and more") for i, p in enumerate(PHRASES)]
    got = scan_licenses(spark.createDataFrame(rows, "id long, text string")).collect()
    assert all(PHRASES[r["id"]].label in r["labels"].split(",") for r in got)


# mixing
def test_mix_comes_near_its_targets(spark):
    r = random.Random(2)
    rows = [(i, " ".join(["w"] * r.choice([0, 3, 40, 500])), None if i % 100 == 9 else f"s{4 if i % 20 else i % 80 // 20}") for i in range(3000)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    size, taken, target = Counter(), Counter(), {}
    for x in got:
        size[x["source"]] += x["size"]
        taken[x["source"]] += x["taken"]
        target[x["source"]] = x["target"]
        assert 0 <= x["taken"] <= 3 * x["size"]
    names = sorted(n for n in size if n is not None) + [None]
    weight = {n: (1, 2, 3)[i % 3] for i, n in enumerate(names)}
    goal, capped = {}, set()
    while True:
        left = sum(size.values()) - sum(3 * size[n] for n in capped)
        goal = {n: 3 * size[n] if n in capped else left * weight[n] / sum(weight[m] for m in names if m not in capped) for n in names}
        over = {n for n in names if goal[n] > 3 * size[n] + 1e-6}
        if not over:
            break
        capped |= over
    assert capped
    for n in names:
        assert target[n] == pytest.approx(goal[n]) and abs(taken[n] - goal[n]) <= max(32, 0.002 * goal[n])
    again = mix(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string").repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_rows_without_words_stay_off_the_line(spark):
    rows = [(i, "w " * (i % 7), "a") for i in range(500)] + [(None, " ", "a")] * 300 + [(None, None, "b")] * 300
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert got.count() == 1100 and got.filter("size = 0 AND taken != 0").count() == 0
    worded = mix(spark.createDataFrame(rows[:500], "doc_id long, text string, source string")).filter("size > 0")
    key = lambda df: sorted((r["id"], r["taken"]) for r in df.collect())
    assert key(got.filter("size > 0")) == key(worded)


def test_mix_of_odd_tables(spark, odd):
    got = mix(odd).collect()
    assert len(got) == len(ODD) and sum(x["taken"] for x in got) > 0
    assert mix(odd.limit(0)).count() == 0
    assert {(x["target"], x["taken"]) for x in mix(odd.filter("text IS NULL")).collect()} <= {(0.0, 0), (None, 0)}
    out = mixed(odd.withColumnRenamed("n_words", "rid"))
    assert out.columns == ["doc_id", "text", "lang", "source", "rid"] and out.count() > 0


# quality
def test_quality_of_odd_texts(spark, odd):
    got = {(r["doc_id"], r["n_words"]): r for r in judge_quality(odd).collect()}
    assert not any(r["kept"] for r in got.values()) and got[(6, 200_000)]["n_repeat_words"] == 200_000
    assert got[(3, 3)]["n_symbols"] == 3 and got[(1, 0)]["word_chars"] == 0
    assert judge_quality(odd.limit(0)).count() == 0


# sharding
def test_shards(spark, odd):
    rows = placed(spark.range(4000).selectExpr("id AS doc_id", "concat('t', id % 50) AS text"), leaves(8), leaves(9)).collect()
    count = Counter(r["shard"] for r in rows)
    assert set(count) == set(range(8)) and min(count.values()) > 400
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(count[s]))
    moved = [r for r in rows if r["grown_shard"] != r["shard"]]
    assert {r["grown_shard"] for r in moved} == {8} and 300 < len(moved) < 600
    assert all(r["text_crc32"] == zlib.crc32(f"t{r['key'] % 50}".encode()) and r["size"] == len(f"t{r['key'] % 50}") + 1 for r in rows)
    own = placed(odd, leaves(8), leaves(9)).collect()
    assert len(own) == len(ODD) and sum(r["text_crc32"] is None for r in own) == 1
    assert placed(odd.limit(0), leaves(8), leaves(9)).count() == 0
    heavy = [("a", "a/k", 0, 1.0), ("a", "a/k", 1, 0.0), ("b", "b/k", 2, 3.0)]
    count = Counter(r["shard"] for r in assign(spark.range(4000), heavy, "id").collect())
    assert set(count) == {0, 2} and 2.5 < count[2] / count[0] < 3.6


def test_one_more_shard_takes_rows_only_into_itself(spark):
    trees = [leaves(n) for n in range(1, 21)] + [grown(leaves(3)), grown(leaves(8), 4), grown(grown(leaves(4)))]
    keys = spark.range(2000)
    columns = [c for k, t in enumerate(trees) for c in (shard_of(keys["id"], t).alias(f"a{k}"), shard_of(keys["id"], grown(t)).alias(f"b{k}"))]
    rows = keys.select(*columns).toPandas()
    for k, t in enumerate(trees):
        moved = rows[rows[f"a{k}"] != rows[f"b{k}"]]
        new = len(t)
        assert set(moved[f"b{k}"]) == {new} and [s for _, _, s, _ in grown(t)] == list(range(new + 1))
        assert 0.4 * len(rows) / (new + 1) < len(moved) < 1.8 * len(rows) / (new + 1)


def test_a_changed_weight_moves_only_its_subtree(spark):
    before, after = leaves(8), [(r, k, s, 2.0 if s == 5 else w) for r, k, s, w in leaves(8)]
    rows = assign(assign(spark.range(4000), before, "id"), after, "id", "then").filter("shard != then").collect()
    assert rows and all(r["then"] // 4 == 1 for r in rows)  # only into the region of shard 5


# URLs
def test_urls(spark):
    urls = ["https://WWW.Example.com/en/a", "http://example.com/en/", "http://x.example.com/en/?q", "http://a.net/es/1", "http://anet/es/1", "http://net/es/", "http://a.org/",
            "http://a.com", "http://a.com?x/", "http://a.com/#f", None, "no scheme.com/", "ftp://b.COM/x#y?z", "://c.com/", "http://a.com/\nb"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), (None, "/", "block"),
             ("net", "/es/", "allow"), ("com", None, "block")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert got == {0: ("www.example.com", "/en/a", "www.example.com/en/", "allow"), 1: ("example.com", "/en/", "example.com/en/", "block"),
                   2: ("x.example.com", "/en/", "example.com/en/", "block"), 3: ("a.net", "/es/1", "net/es/", "block"), 4: ("anet", "/es/1", None, "allow"),
                   5: ("net", "/es/", "net/es/", "block"), 6: ("a.org", "/", None, "allow"), 7: ("a.com", "", None, "allow"), 8: ("a.com", "", None, "allow"),
                   9: ("a.com", "/", "com/", "allow"), 10: ("", "", None, "allow"), 11: ("", "", None, "allow"), 12: ("b.com", "/x", "com/", "allow"),
                   13: ("c.com", "/", "com/", "allow"), 14: ("a.com", "/\nb", "com/", "allow")}
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in judge_urls(df, none).collect()} == {"allow"} and judge_urls(df.limit(0), none).count() == 0


def test_many_rules_against_brute_force(spark):
    r = random.Random(4)
    label = lambda: r.choice("abcd")
    rules = {(".".join(label() for _ in range(r.randint(1, 3))), "/" + "/".join(label() for _ in range(r.randint(0, 2)))): r.choice(["allow", "block"]) for _ in range(60)}
    urls = [f"http://{'.'.join(label() for _ in range(r.randint(1, 4)))}/{'/'.join(label() for _ in range(r.randint(0, 3)))}" for _ in range(400)]
    listed = spark.createDataFrame([(h, p, v) for (h, p), v in rules.items()], "host string, path string, verdict string")
    got = judge_urls(spark.createDataFrame(list(enumerate(urls)), "i long, url string"), listed).collect()
    for x in got:
        host, path = x["host"], x["path"]
        fits = [(len(h + p), len(h), h + p, v) for (h, p), v in rules.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (x["rule"], x["verdict"]) == (max(fits)[2:] if fits else (None, "allow"))


# pages
def test_articles():
    page = ('<html><head><title>T</title></head><body><div id="cookie-notice">We use cookies<div>inner</div> more</div><header><h1>Site</h1></header><main><article>'
            '<header><h1>Head</h1><p>by me</p></header><p>One &amp; two&nbsp;three <b>un</b>bold<p>four<div class="ad">buy</div><ul><li>five</li></ul>'
            '<section class="comments"><p>nice</p></section><script>var a="</p><p>no"</script></article></main><aside>side</aside><footer>f</footer>')
    assert article_of(page) == (True, "Head One & two three unbold four five")
    assert article_of("<body><nav>m</nav><div class='ad'><p>never closed<article><p>A</p></article>") == (True, "A")
    assert article_of("<p>plain</p> text <form>f<input>x</form> tail") == (False, "plain text tail")
    assert article_of(None) == article_of("") == (False, "")


def test_names_do_not_remove_articles():
    assert article_of('<div class="content has-sidebar"><p>main text here</p></div>')[1] == "main text here"
    assert article_of('<main><div class="post no-comments"><p>para</p></div></main>') == (True, "para")
    assert article_of('<article><div id="reply-effect"><p>one</p><p>two</p></div></article>') == (True, "one two")
    for name in ("related-work", "notice-text", "menu-item-analysis", "adsorption", "navigationTheory", "comments-in-law", "share-of-market"):
        assert article_of(f'<article><p>a</p><p class="{name}">b c</p></article>') == (True, "a b c"), name
    assert article_of("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p></article>") == (True, "Let x=1 be")
    # most of the words under a noisy name stay, unless they are comments, a menu or links
    most = "<p>" + "word " * 40 + "</p>"
    for name, kept in (("widget", True), ("promo-box", True), ("comments", False), ("comment-list", False), ("nav-menu", False)):
        assert ("word" in article_of(f'<article><p>a b</p><div class="{name}">{most}</div></article>')[1]) is kept, name
    links = "<p>" + '<a href="/x">word word</a> ' * 20 + "</p>"
    assert article_of(f'<article><p>a b</p><div class="related-posts">{links}</div></article>') == (True, "a b")
    assert article_of(f'<article><p>{"a " * 30}</p><div class="related-posts">{links}</div><section class="comments"><article><p>nice</p></article></section></article>')[1].split() == ["a"] * 30


def test_articles_under_many_names_equal_what_was_written():
    """Generated pages: the article's blocks under plain names, noise under names of noise, in any order and depth."""
    r = random.Random(6)
    plain = ["", "content", "post-body", "has-sidebar", "no-comments", "entry with-menu", "related-work", "text", "reply-study", "headline-news-x", "advance", "menuette"]
    noise = ["ad", "ad-slot-3", "cookie-notice", "cookieBanner", "sidebar", "site-footer", "share-buttons", "related-posts", "comments", "comment_list", "newsletter-signup", "nav", "breadcrumb"]

    def words(n, tag):
        return " ".join(f"{tag}{r.randrange(1000)}" for _ in range(n))

    for _ in range(400):
        said, inner = [], []
        for _ in range(r.randint(2, 8)):
            text = words(r.randint(8, 30), "w")
            said.append(text)
            tag = r.choice(["p", "h2", "li", "blockquote", "section"])
            block = f"<{tag}>{text}</{tag}>"
            for _ in range(r.randint(0, 2)):
                block = f'<div class="{r.choice(plain)}">{block}</div>'
            inner.append(block)
            if r.random() < 0.5:
                inner.append(f'<div {r.choice(["class", "id"])}="{r.choice(noise)}"><p>{words(r.randint(1, 3), "n")}</p></div>')
        shell = r.choice(["<article>%s</article>", "<main>%s</main>", "<div class='x'><article class='post'>%s</article></div>", "<main><article>%s</article></main>"])
        around = [f'<div class="{r.choice(noise)}">{words(3, "n")}</div>', "<nav><ul><li>n1</li></ul></nav>", "<footer>n2</footer>", "<aside>n3</aside>", "<form><label>n4</label></form>"]
        r.shuffle(around)
        page = f"<html><body>{''.join(around[:2])}{shell % ''.join(inner)}{''.join(around[2:])}</body></html>"
        assert article_of(page) == (True, " ".join(said))


def test_long_and_repeated_pages(spark):
    page = "<article>" + "<p>some words of a long page</p>" * 60_000 + "</article>"
    df = spark.createDataFrame([(1, None, page), (2, "http://h/", "<p>x y</p>"), (2, "http://h/", "<p>x y</p>")], "page_id long, url string, html string")
    got = extract_text(df).collect()
    assert sorted(len(x["text"].split()) for x in got) == [2, 2, 360_000]


def test_boilerplate_of_unmarked_pages(spark):
    top, end = " ".join(f"menu{i}" for i in range(12)), " ".join(f"legal{i}" for i in range(9))
    own = [" ".join(f"own{p}x{i}" for i in range(20 + p)) for p in range(6)]
    pages = [(p, f"http://h.com/{p}", f"<div>{top}</div><p>{own[p]}</p><div>{end}</div>", "t") for p in range(6)]
    pages += [(10, "http://h.com/c", f"<article><p>{top} stays</p></article>", "t"), (11, None, None, None), (12, "http://o.com/", "<p>alone here</p>", "t")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in extract_text(df).collect()}
    assert [got[p]["text"] for p in range(6)] == own
    assert got[10]["text"] == f"{top} stays" and got[11]["text"] == "" and got[12]["text"] == "alone here"
    assert all(r["n_chars"] == len(r["text"]) for r in got.values()) and extract_text(df.limit(0)).count() == 0
    assert unique_runs(["same text that is on every page of it"] * 4) == ["same text that is on every page of it"] * 4


def test_boilerplate_inside_marked_articles(spark):
    """A passage that a host's pages say outside their articles goes from the articles that repeat it too; passages that only
    articles share and teasers of one article stay."""
    letter, quote = " ".join(f"letter{i}" for i in range(10)), " ".join(f"quote{i}" for i in range(10))
    own = [" ".join(f"own{p}x{i}" for i in range(20 + p)) for p in range(6)]
    page = "<body><aside>{} {}</aside><article><p>{}</p><p>{}</p><p>{}</p></article><footer>f{}</footer></body>"
    pages = [(p, f"http://m.com/{p}", page.format(letter, own[0] if p else "", own[p], quote, letter if p < 4 else "end", p)) for p in range(6)]
    pages += [(10 + p, f"http://n.com/{p}", f"<article><p>{own[p]} {letter}</p></article>") for p in range(4)]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert [got[p] for p in range(6)] == [f"{own[p]} {quote}" + " end" * (p > 3) for p in range(6)]
    assert [got[10 + p] for p in range(4)] == [f"{own[p]} {letter}" for p in range(4)]


def test_runs_are_counted_over_the_whole_host(spark):
    r = random.Random(8)
    prose = lambda: " ".join(f"w{r.randrange(10**6)}" for _ in range(12))
    notice, quote = "please read this notice about our new opening hours today", "to be or not to be that is the question"
    own = [prose() for _ in range(5000)]
    noted, quoted = set(r.sample(range(5000), 60)), set(r.sample(range(5000), 12))
    html = [f"<p>{own[k]}</p>" + f"<div>{notice}</div>" * (k in noted) + f"<p>{quote}</p>" * (k in quoted) for k in range(5000)]
    # copies of a page are one page
    pages = [(k, "http://big.com/", h) for k, h in enumerate(html)] + [(5000 + k, "http://copies.com/", f"<p>{own[k % 2]}</p>") for k in range(6)]
    got = {x["page_id"]: x["text"] for x in extract_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(8)).collect()}
    assert len(got) == 5006 and not [k for k in noted if "notice" in got[k]]
    assert not [k for k in quoted if quote not in got[k]] and not [k for k in range(5000) if own[k] not in got[k]]
    assert [got[5000 + k] for k in range(6)] == [own[k % 2] for k in range(6)]


def test_pages_have_no_menu_or_footer(spark):
    rows = QUERIES["op7_page_text"](spark, SMALL).collect()
    html = dict(zip(*pq.read_table(f"{SMALL}/pages.parquet", columns=["page_id", "html"]).to_pydict().values()))
    assert len(rows) == len(html) and all("©" not in r["text"] and "<p>" not in r["text"] for r in rows)
    assert all(r["n_chars"] == len(r["text"]) > 0 for r in rows) and brute.words(rows[0]["text"])
