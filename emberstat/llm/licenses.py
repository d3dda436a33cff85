"""Licence scan by diagonal voting.

Every run of ``K`` words of a text is joined by its hash to the places where it
stands in the licence phrases. A hit votes for the diagonal "place in the
text less place in the phrase": a phrase that stands there verbatim gathers
all its votes on one diagonal, one with words put in or left out spreads them
over neighbouring ones. Neighbouring diagonals are merged to spans, and a
span counts if it covers enough of the phrase's words in about its length.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fold_ascii, with_results

K = 3
#: Diagonals no further apart are one span; share of a phrase's words that a span must cover, in at most so many times its length.
DRIFT, LEAST_COVER, MOST_STRETCH = 2, 0.8, 1.5
RESULTS = ["n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


class Phrase(NamedTuple):
    label: str
    words: str
    base: bool


# fixed phrases: the base ones, then the usual notices of common licences
PHRASES = [
    Phrase("mit", "under the mit license", True),
    Phrase("apache-2", "apache license version 2", True),
    Phrase("cc-by-nc", "cc by nc", True),
    Phrase("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", False),
    Phrase("apache-2", "you may not use this file except in compliance with the license", False),
    Phrase("bsd", "redistribution and use in source and binary forms with or without modification are permitted", False),
    Phrase("gpl-3", "licensed under the gnu general public license version 3", False),
    Phrase("gpl", "under the terms of the gnu general public license as published by the free software foundation", False),
    Phrase("lgpl", "under the terms of the gnu lesser general public license", False),
    Phrase("mpl-2", "subject to the terms of the mozilla public license", False),
    Phrase("cc-by", "licensed under a creative commons attribution 4 0 international license", False),
    Phrase("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", False),
]


def phrase_grams(spark: SparkSession, phrases: list[Phrase]) -> DataFrame:
    """A row for each place of a K-gram in a phrase: fixed by the phrase list, a few hundred rows."""
    rows = []
    for number, p in enumerate(phrases):
        own = p.words.split()
        if len(own) < K:
            raise ValueError(f"a phrase has {K} words at least: {p.words!r}")
        rows += [(number, p.label, p.base, len(own), at, *own[at : at + K]) for at in range(len(own) - K + 1)]
    grams = spark.createDataFrame(rows, "phrase int, label string, base boolean, m int, place int, a string, b string, c string")
    return grams.withColumn("hash", F.xxhash64("a", "b", "c"))


def scan_licenses(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text", phrases: list[Phrase] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with the licences of each whole text; an input column of such a name is
    replaced.

    ``n_base``: places where a base phrase's words stand one after the other; ``first_word``, ``last_word``: smallest
    and largest start of them (words from 0; null without one); ``base_labels`` and ``labels`` (those of merged spans
    too): distinct, sorted, comma-joined; ``spans``: label, start, end and score (share of the phrase's words) of
    each; ``score``: the best, 0 without one. A null or empty text has none of them. Repeated rows each give a row;
    an empty table stays empty. Hits are compared word by word, not only by hash.
    """
    grams = phrase_grams(docs.sparkSession, phrases or PHRASES)
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    words = F.array_remove(F.split(fold_ascii(F.col(f"`{text_col}`")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")
    df = docs.select(F.monotonically_increasing_id().alias("rid"), row, words.alias("words"))
    run = F.arrays_zip(*[F.slice("words", k + 1, F.greatest(F.size("words"), F.lit(1))).alias(x) for k, x in enumerate("xyz")])
    df = df.select("rid", "row", F.posexplode_outer(run).alias("pos", "g")).withColumn("h", F.xxhash64("g.x", "g.y", "g.z"))
    same = (F.col("h") == F.col("hash")) & (F.col("g.x") == F.col("a")) & (F.col("g.y") == F.col("b")) & (F.col("g.z") == F.col("c"))
    hits = df.join(F.broadcast(grams), same, "left")
    lead = F.coalesce(F.col("pos") == 0, F.lit(True))  # one row of each text stays, hit or not, and carries its columns
    hits = hits.filter(F.col("phrase").isNotNull() | lead).select(
        "rid", F.when(lead, F.col("row")).alias("row"), "phrase", "label", "base", "m", "place", (F.col("pos") - F.col("place")).alias("diagonal"))
    votes = hits.groupBy("rid", "phrase", "label", "base", "m", "diagonal").agg(
        F.first("row", ignorenulls=True).alias("row"), F.count("place").alias("votes"), F.collect_set("place").alias("places"),
        (F.col("diagonal") + F.min("place")).alias("start"), (F.col("diagonal") + F.max("place") + K).alias("end"))
    order = Window.partitionBy("rid", "phrase").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT, F.lit(True)).cast("int")
    votes = votes.withColumn("far", far).withColumn("span", F.sum("far").over(order))
    whole = F.when(F.col("base") & (F.col("votes") == F.col("m") - (K - 1)), F.col("diagonal"))
    spans = votes.groupBy("rid", "phrase", "label", "base", "m", "span").agg(
        F.first("row", ignorenulls=True).alias("row"), F.count(whole).alias("n_base"), F.min(whole).alias("first"), F.max(whole).alias("last"),
        F.min("start").alias("start"), F.max("end").alias("end"), F.flatten(F.collect_list("places")).alias("places"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (K - 1))))))
    spans = spans.withColumn("cover", covered / F.col("m"))
    fits = (F.col("cover") >= LEAST_COVER) & (F.col("end") - F.col("start") <= MOST_STRETCH * F.col("m"))
    good = fits | (F.col("n_base") > 0)

    def joined(label):
        return F.array_join(F.sort_array(F.collect_set(label)), ",")

    out = spans.groupBy("rid").agg(
        F.first("row", ignorenulls=True).alias("row"), F.sum("n_base").alias("n_base"), F.min("first").cast("long").alias("first_word"),
        F.max("last").cast("long").alias("last_word"), joined(F.when(F.col("n_base") > 0, F.col("label"))).alias("base_labels"),
        joined(F.when(good, F.col("label"))).alias("labels"), F.coalesce(F.max(F.when(good, F.col("cover"))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(good, F.struct("start", "end", "label", F.col("cover").alias("score"))))).alias("spans"))
    return with_results(out, "row", RESULTS)
