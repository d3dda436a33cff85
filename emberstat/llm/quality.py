"""Quality rules by distribution divergence.

Each document has two histograms: character classes, and common words of
several languages with a place for all other words. A language's reference is
the histogram of all its documents together; a label without a word list, and
null, has a reference of character classes for each of its scripts. A document of enough words is
kept if the Jensen-Shannon distances of its histograms to its reference
are small; basic rules on length and repetition come first.
DataFrame functions only: a document's counts are made in its own row, and
only the histograms are summed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, stage, with_results

RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]
#: Frequent words of each language (fixed lists).
COMMON_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he".split(),
    "fr": "de la le et les des en un une du est que dans pour par sur pas au".split(),
    "de": "der die und den von zu das mit sich des auf ist im dem nicht ein eine als".split(),
    "es": "de la que el en y a los se del las un por con una su para es".split(),
}
WORDS = sorted({w for own in COMMON_WORDS.values() for w in own})
CLASSES = ["lower", "upper", "digits", "white", "symbols", "other_scripts", "marks"]
#: Scripts that a label without a word list is told apart by; a text of none of them has the script "rest".
SCRIPTS = {s.lower(): rf"\p{{Is{s}}}+" for s in ["Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Bengali", "Tamil", "Telugu", "Thai",
                                                "Georgian", "Armenian", "Ethiopic", "Hangul"]} | {"han": r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]+"}
WHOLE = "whole"
#: Least share of a label's rows for a script to have a reference of its own.
LEAST_SCRIPT = 0.05
WHITE = r"[\x20\x09-\x0D]+"
#: Fewest words for the rules, and for the comparison of common words.
LEAST_WORDS, LEAST_FOR_WORDS = 50, 100
#: Largest Jensen-Shannon distance (square root of the divergence in bits, 0 to 1) of the character classes, and of the
#: words as a share of the distance that a text without any common word has.
MOST_CHAR_DISTANCE, MOST_WORD_SHARE = 0.3, 0.95


def _counted(df: DataFrame) -> DataFrame:
    """Adds the counts of ``text``. Expressions that are used more than once get a column of their own."""
    n = df.withColumns({"words": F.array_remove(F.split("text", WHITE), ""), "l0": F.regexp_replace("text", "[a-z]+", "")})
    steps = [("l1", WHITE), ("l2", "[A-Z]+"), ("l3", "[0-9]+"), ("l4", "[#*$%&|<>]+"), ("l5", r"[^\x00-\x7F]+")]
    for k, (name, pattern) in enumerate(steps):
        n = n.withColumn(name, F.regexp_replace(f"l{k}", pattern, ""))
    size = [F.length("text"), *[F.length(f"l{k}") for k in range(6)]]
    left = dict(zip(["lower", "white", "upper", "digits", "symbols", "other_scripts"], (a - b for a, b in zip(size, size[1:]))))
    left["marks"] = size[6]
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = n.withColumns({"n_words": F.size("words").cast("long"), **{f"c_{c}": left[c].cast("long") for c in CLASSES},
                       "word_chars": (F.length("text") - left["white"]).cast("long"), "n_symbols": left["symbols"].cast("long"),
                       "lines": lines, "common": F.filter("words", lambda w: w.isin(WORDS))})
    n = n.withColumns({"n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
                       **{f"w_{w}": (F.size("common") - F.size(F.array_remove("common", w))).cast("long") for w in WORDS}})
    # hashes of all 3-word windows; only a text in which one comes twice is sorted
    three = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    n = n.withColumn("windows", F.when(F.col("n_words") >= 3, F.slice(three, F.lit(1), (F.col("n_words") - 2).cast("int"))).otherwise(F.array().cast("array<long>")))
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    by_hash = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    n = n.withColumn("sorted", F.when(again, by_hash))

    def repeated(x, j):
        near = [F.get("sorted", j + d)["h"] for d in (-1, 1)]
        return F.coalesce(x["h"] == near[0], F.lit(False)) | F.coalesce(x["h"] == near[1], F.lit(False))

    n = n.withColumn("places", F.sort_array(F.transform(F.filter("sorted", repeated), lambda x: x["i"])))
    # each window adds its words beyond the one before
    zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("places", zero, lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")), lambda s: s["n"])
    return n.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))


def _script(text: Column) -> Column:
    """The script of most letters (ties: the last by name), ``WHOLE`` for a text without letters."""
    count = [F.struct((F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).alias("n"), F.lit(name).alias("script")) for name, pattern in SCRIPTS.items()]
    most = F.greatest(*count)
    return F.when(~text.rlike(r"\p{L}"), F.lit(WHOLE)).when(most["n"] == 0, F.lit("rest")).otherwise(most["script"])


def distance(p: list[Column], q: list[Column]) -> Column:
    """Jensen-Shannon distance of two histograms that sum to 1; terms of an empty place are 0."""

    def half(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    return F.sqrt(F.greatest(reduce(lambda s, x: s + x, [half(a, b) + half(b, a) for a, b in zip(p, q)]) / 2, F.lit(0.0)))


def judge_quality(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The columns ``keep`` (all by default) with the counts, ``base_failed``, ``char_distance``, ``word_distance`` and
    ``kept`` of each whole text; an input column of such a name is replaced.

    Words are runs of anything but white space. ``n_dup_lines``: lines with a word that equal an earlier line.
    ``n_repeat_words``: words in 3-word windows that stand twice or more in the text (windows are compared by 64-bit
    hashes). ``base_failed``: under 50 words, or more than half of the words repeated. Others are compared with the
    reference of their ``lang``. A value without a word list, and null, has one of the character classes for each
    dominant script and no test of words. Texts without letters, and those of a script that a value has in less than
    ``LEAST_SCRIPT`` of its rows, are compared with all texts of the value (under null every script stands for itself).
    ``word_distance`` counts from 100 words on and is null below and without a word list. A null text has no words and fails. Repeated rows each give a row and all count
    in the references; an empty table stays empty.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lang = F.col(f"`{lang_col}`").cast("string")
    listed = F.coalesce(lang.isin(list(COMMON_WORDS)), F.lit(False))
    ref = F.coalesce(F.concat(F.lit("="), lang), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    columns = [f"c_{c}" for c in CLASSES] + [f"w_{w}" for w in WORDS]
    counted = _counted(docs.select(row, text.alias("text"), ref.alias("ref"), listed.alias("listed")))
    script = F.when(F.col("listed"), F.lit(WHOLE)).otherwise(_script(F.col("text")))
    counted = stage(counted.select("row", "ref", "listed", script.alias("script"), *RESULTS[:5], *columns), "counts")
    # a row for each label and script: of its own texts, or of the whole label
    sums = counted.groupBy("ref", "script").agg(F.count("*").alias("all_rows"), F.sum("n_words").alias("all_words"), *[F.sum(c).alias(f"all_{c}") for c in columns])
    sums = stage(sums, "references")
    totals = sums.columns[2:]
    whole = sums.groupBy("ref").agg(*[F.sum(c).alias(f"whole_{c}") for c in totals])
    apart = (F.col("script") != WHOLE) & ((F.col("ref") == "") | (F.col("all_rows") >= LEAST_SCRIPT * F.col("whole_all_rows")))
    sums = sums.join(whole, "ref").select("ref", "script", *[F.when(apart, F.col(c)).otherwise(F.col(f"whole_{c}")).alias(c) for c in totals])
    sums = stage(sums, "references")
    df = counted.join(checked_broadcast(sums, F.octet_length("ref") + 8 * len(sums.columns) + 32), ["ref", "script"])

    def shares(prefix: str, names: list[str], total: Column, rest: bool) -> list[Column]:
        out = [F.try_divide(F.col(prefix + n), total) for n in names]
        return out + ([F.lit(1.0) - reduce(lambda s, x: s + x, out)] if rest else [])

    chars = [f"c_{c}" for c in CLASSES]
    total = {p: reduce(lambda s, x: s + x, [F.col(p + c) for c in chars]) for p in ("", "all_")}
    near_chars = distance(shares("", chars, total[""], False), shares("all_", chars, total["all_"], False))
    common = [f"w_{w}" for w in WORDS]
    ref = shares("all_", common, F.col("all_words"), True)
    near_words = distance(shares("", common, F.col("n_words"), True), ref)
    no_words = distance([F.lit(0.0)] * len(common) + [F.lit(1.0)], ref)
    df = df.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    df = df.withColumns({"char_distance": F.when(F.col("n_words") >= LEAST_WORDS, near_chars), "word_distance": F.when(F.col("listed") & (F.col("n_words") >= LEAST_FOR_WORDS), near_words)})
    fits = (F.coalesce("char_distance", F.lit(0.0)) <= MOST_CHAR_DISTANCE) & (F.coalesce("word_distance", F.lit(0.0)) <= MOST_WORD_SHARE * no_words)
    return with_results(df.withColumn("kept", ~F.col("base_failed") & fits), "row", RESULTS)
