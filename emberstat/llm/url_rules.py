"""URL rules: a blocked Bloom filter passes possible hits to an exact join.

A rule is a host (with all its subdomains) and a path prefix. A URL is
expanded to its canonical keys (each host suffix with each prefix whose
length some rule has). Keys that the filter of the listed rules doesn't know
are dropped row by row; the others meet the rules in a hash join, which
removes false positives. The longest rule wins. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, with_results

RESULTS = ["host", "path", "rule", "verdict"]
BITS = 4  # set for each key, all in one 64-bit block
#: Blocks of the filter, as a power of two: at most 1 MB, whatever the list's size.
MOST_BLOCKS = 17


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def _block(host: Column, path: Column, power: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(host, path), 64 - power).cast("int")


def _mask(host: Column, path: Column) -> Column:
    """The bits of a key, taken from the low half of its hash (the block comes from the top)."""
    h, mask = F.xxhash64(host, path), F.lit(0).cast("long")
    for k in range(BITS):
        bit = F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def bloom_filter(rules: DataFrame, power: int) -> DataFrame:
    """One row: the ``2 ** power`` 64-bit blocks of the rules' keys."""
    words = rules.groupBy(_block(F.col("rule_host"), F.col("rule_path"), power).alias("id")).agg(
        F.bit_or(_mask(F.col("rule_host"), F.col("rule_path"))).alias("word"))
    every = rules.sparkSession.range(1 << power).select(F.col("id").cast("int").alias("id"))
    filled = every.join(words, "id", "left").select(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word")).alias("w"))
    return filled.agg(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["word"]).alias("blocks"))


def judge_urls(pages: DataFrame, rules: DataFrame, keep: list[str] | None = None, url_col: str = "url",
               otherwise: str = "allow") -> DataFrame:
    """The columns ``keep`` (all by default) with ``host``, ``path``, ``rule`` and ``verdict`` of each URL; an input
    column of such a name is replaced.

    ``rules``: host, path, verdict (``allow`` or ``block``). A rule fits its host and all subdomains if the URL's
    path starts with the rule's; the one with most characters wins, then the one with the longer host; a rule listed
    with both verdicts blocks. A URL that no rule fits gets ``otherwise``. A rule with a null is ignored. A null URL
    and one without ``://`` have an empty host and path, which no rule fits. Repeated rows each give a row; an empty
    table none; without rules every URL gets ``otherwise``.
    """
    spark = pages.sparkSession
    listed = rules.filter("host != '' AND path IS NOT NULL AND verdict IS NOT NULL").groupBy(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path")).agg((F.min((F.col("verdict") != "block").cast("int")) > 0).alias("allowed"))
    power = min(max(4, (listed.count() // 4).bit_length()), MOST_BLOCKS)  # 16 bits a key or more, until the bound
    blocks = bloom_filter(listed, power).scalar()
    lengths = listed.agg(F.sort_array(F.collect_set(F.length("rule_path")))).scalar()

    row = F.struct(*[F.col(f"`{c}`") for c in (keep or pages.columns)]).alias("row")
    url = F.col(f"`{url_col}`")
    df = pages.select(F.monotonically_increasing_id().alias("rid"), row, host_of(url).alias("host"), path_of(url).alias("path"))
    df = df.withColumns({"labels": F.split("host", r"\."), "lengths": lengths, "blocks": blocks})
    df = df.withColumn("lengths", F.filter("lengths", lambda n: n <= F.length("path")))
    hosts = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda k: F.array_join(F.slice("labels", k, F.size("labels")), "."))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform("lengths", lambda n: F.struct(h.alias("h"), F.substring("path", F.lit(1), n).alias("p")))))
    possible = F.filter(keys, lambda k: F.get("blocks", _block(k["h"], k["p"], power)).bitwiseAND(_mask(k["h"], k["p"])) == _mask(k["h"], k["p"]))
    df = df.select("rid", "row", "host", "path", F.explode_outer(possible).alias("key"))
    hit = df.join(listed, (F.col("key.h") == F.col("rule_host")) & (F.col("key.p") == F.col("rule_path")), "left")
    found = F.when(F.col("rule_host").isNotNull(), F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("m"),
                                                            F.concat("rule_host", "rule_path").alias("rule"), "allowed"))
    best = hit.groupBy("rid").agg(F.first(F.struct("row", "host", "path")).alias("own"), F.max(found).alias("best"))
    verdict = F.when(F.col("best").isNull(), F.lit(otherwise)).when(F.col("best.allowed"), F.lit("allow")).otherwise(F.lit("block"))
    return with_results(best.select("own.*", F.col("best.rule").alias("rule"), verdict.alias("verdict")), "row", RESULTS)
