"""The registered queries of the text operators: whole tables, production parameters."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .sql import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
__all__ = ["ORACLES", "QUERIES"]


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages of every document (13-word windows, 5 % of the words)."""
    from .decontaminate import contaminated, find_matches, n_hit_words

    found = find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", n_hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


@_query
def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text in a byte-level vocabulary of 50,257 entries."""
    import public_tokenizers

    from .token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])


@_query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from the documents that are not held out."""
    from .language import fit, held_out, identify

    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return identify(docs, model, keep=["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@_query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document: 5-word shingles, similarity 0.8 or more."""
    from .near_duplicates import classes

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(docs)[1].select(F.col("id").alias("doc_id"), "class_id", "kept", "class_rows")


#: The listed rules: fixed values of the query.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block")]


@_query
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and verdict of every page's URL."""
    from .url_rules import judge_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules, keep=["page_id"])


@_query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 8 shards, and in one of 9."""
    from .sharding import grown, leaves, placed

    docs = table(spark, sf_dir, "documents")
    return placed(docs, leaves(8), grown(leaves(8))).withColumnRenamed("key", "doc_id")


@_query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@_query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    from .quality import judge_quality

    return judge_quality(table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("char_distance", "word_distance")


@_query
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases of every whole text."""
    from .licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("spans")


@_query
def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from .page_text import extract_text

    return extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


@_query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that rank highest for every benchmark item."""
    from .lexical_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def planted(docs: DataFrame) -> DataFrame:
    """``documents`` as the run contract reads them: one in ten, by the checksum of its id, goes on periodically from some
    word on (as words joined by one space). Other texts, and those without id, stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    g, n = F.floor(h / 10).cast("long"), F.size("words").cast("long")
    hit = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words")).select(
        "*", F.when(n > 0, g % n).alias("a"), n.alias("n"), (3 + g % 8).alias("more"))
    hit = hit.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / F.col("more")).cast("long"))
    periodic = F.expr("array_join(transform(sequence(0L, n - 1), i -> words[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    return hit.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text"))


@_query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every whole text."""
    from .periodic_runs import best_run, periodic_runs, runs_digest

    found = periodic_runs(planted(table(spark, sf_dir, "documents")), keep=["doc_id"], keep_text=False)
    found = found.select("*", best_run().alias("best"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"), runs_digest().alias("runs_sha256"), "collapsed_sha256")


@_query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives with revisit records, as read back."""
    from ..session import scratch_path
    from .warc import read_archives, resolve_revisits, write_archives

    pages, path = table(spark, sf_dir, "pages"), scratch_path(spark, "archives")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    found = resolve_revisits(read_archives(spark, path))
    return found.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast(kind).alias("refers_to"))
