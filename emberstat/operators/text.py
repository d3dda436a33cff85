"""Document-term matrices as long frames (doc_id, term, tf).

The dense doc × term matrix is never built: 90 % of it is zeros. Every
statistic (row sums, column sums, sparsity, frequency tables) is an
aggregation of the long form. Documents are processed whole.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.porter2 import with_stem
from ..functions.text import ENGLISH_STOPWORDS, EXTRA_STOPWORDS, normalize_text
from .checkpoint import materialize
from .joins import join_small

STOPWORDS = ENGLISH_STOPWORDS + EXTRA_STOPWORDS
#: Documents that one task may hold without being dealt out.
TASK_DOCS = 5_000


def tokenize(corpus: DataFrame, text: str = "text", doc_id: str = "doc_id", out: str = "token",
             normalize: bool = False) -> DataFrame:
    """One row per whitespace-separated token (empty tokens dropped)."""
    c = F.col(text)
    if normalize:
        c = normalize_text(c)
    return corpus.select(doc_id, F.explode(F.split(c, r"\s+")).alias(out)).filter(F.col(out) != "")


def remove_stopwords(tokens: DataFrame, col: str = "token", words: Iterable[str] = STOPWORDS) -> DataFrame:
    """Left-anti join on a fixed stop list (broadcast: its size is fixed)."""
    spark = tokens.sparkSession
    stop = spark.createDataFrame([(w,) for w in sorted(set(words))], f"{col} string")
    return join_small(tokens, stop, on=col, how="left_anti", bounded=True)


def flag_stopwords(tokens: DataFrame, col: str = "token", words: Iterable[str] = STOPWORDS,
                   flag: str = "is_stop") -> DataFrame:
    """Tokens with a boolean ``is_stop`` column (broadcast left join on the
    fixed list), for counting kept and removed tokens in one pass."""
    spark = tokens.sparkSession
    stop = spark.createDataFrame([(w, True) for w in sorted(set(words))], f"{col} string, {flag} boolean")
    j = join_small(tokens, stop, on=col, how="left", bounded=True)
    return j.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def stem_terms(terms: DataFrame, col: str = "term") -> DataFrame:
    """(term, stem) for the distinct terms of ``terms``: the stemmer's rules as built-in string functions, once per
    distinct word."""
    return with_stem(terms.select(col).distinct(), col)


def document_terms(corpus: DataFrame, min_length: int = 3, stopwords: Iterable[str] | None = STOPWORDS,
                   text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Token stream after the control list without stemming: split, lower, punctuation, digits, stop words, minimum
    length. Columns doc_id, term."""
    t = tokenize(corpus, text, doc_id, "token", normalize=True)
    if stopwords is not None:
        t = remove_stopwords(t, "token", stopwords)
    return t.filter(F.length("token") >= min_length).withColumnRenamed("token", "term")


def term_counts(terms: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Raw term frequencies: (doc_id, term, tf)."""
    return terms.groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_term_matrix(corpus: DataFrame, stemming: bool = True, min_length: int = 3,
                         stopwords: Iterable[str] | None = STOPWORDS, text: str = "text",
                         doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, term, tf) after the control list.

    With stemming the tokens are first counted per (document, token) and
    that much smaller table is written once; the stemmer then runs on its
    distinct tokens only, and counts of tokens sharing a stem are added up.
    The corpus is tokenised a single time and the stem join never sees the
    raw token stream. The length bound applies to the stem.
    """
    if not stemming:
        return term_counts(document_terms(corpus, min_length, stopwords, text, doc_id), doc_id)
    t = tokenize(corpus, text, doc_id, "token", normalize=True)
    if stopwords is not None:
        t = remove_stopwords(t, "token", stopwords)
    raw = materialize(t.groupBy(doc_id, "token").agg(F.count(F.lit(1)).alias("tf")))
    stems = stem_terms(raw, "token")
    j = join_small(raw, stems, on="token")
    return (j.filter(F.length("stem") >= min_length).groupBy(doc_id, F.col("stem").alias("term"))
            .agg(F.sum("tf").alias("tf")))


def doc_frequency(dtm: DataFrame) -> DataFrame:
    """(term, df): documents containing each term."""
    return dtm.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def remove_sparse(dtm: DataFrame, n_docs: int | Column, sparse: float) -> DataFrame:
    """Keep terms present in more than ``n_docs·(1-sparse)`` documents
    (``removeSparseTerms``); ``n_docs`` counts every document of the corpus."""
    keep = doc_frequency(dtm).filter(F.col("df") > F.lit(n_docs) * (1 - sparse)).select("term")
    # a common term may hold a large share of the rows: the kept terms, measured, go to the matrix, not the other way
    return join_small(dtm, keep, on="term", how="left_semi")


def dealt(corpus: DataFrame) -> tuple[DataFrame, int]:
    """The corpus dealt evenly to tasks, and its number of rows. Files of one large row group put all their documents in one
    task; where a task holds more than ``TASK_DOCS`` of them and twice its share, rows are dealt anew, whatever
    their keys. Otherwise the corpus is as it was."""
    held = corpus.groupBy(F.spark_partition_id()).count()
    n, most = held.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    if most > TASK_DOCS and most * cores > 2 * n:
        corpus = corpus.repartition(max(cores, -(-n // TASK_DOCS)))
    return corpus, n


def sparse_document_term_matrix(corpus: DataFrame, sparse: float, doc_id: str = "doc_id", **kw) -> DataFrame:
    """DTM with sparse terms removed. The DTM is written once to the shared
    checkpoint folder: the document frequencies and the filtered matrix
    both read it, so the corpus is tokenised a single time."""
    corpus, n_docs = dealt(corpus)
    dtm = materialize(document_term_matrix(corpus, doc_id=doc_id, **kw))
    return remove_sparse(dtm, n_docs, sparse)


def vocabulary_ids(dtm: DataFrame) -> DataFrame:
    """(term_id, term): 1-based ids in term order (distributed dense rank)."""
    from .ranks import rank_keys

    return rank_keys(dtm.select("term").distinct(), ["term"], method="dense", name="term_id").select(
        "term_id", "term")


def drop_empty_docs(dtm: DataFrame) -> DataFrame:
    """(doc_id, n_terms) of documents that still hold a term; in long form
    an empty document simply has no rows left."""
    return dtm.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"))


def word_freq(dtm: DataFrame, k: int | None = None) -> DataFrame:
    """(word, freq, rank) by decreasing corpus frequency (ties by word);
    ``k`` keeps the first k (a top-k: each partition sends only k rows)."""
    from .ranks import rank_keys

    f = term_frequency(dtm)
    if k is not None:  # k rows are numbered in one task
        r = f.orderBy(F.desc("freq"), "term").limit(k).withColumn(
            "rank", F.row_number().over(Window.orderBy(F.desc("freq"), "term")).cast("long"))
        return r.select(F.col("term").alias("word"), "freq", "rank")
    r = rank_keys(f.select((-F.col("freq")).alias("_nf"), "term"), ["_nf", "term"], method="row_number",
                  name="rank")
    return r.select(F.col("term").alias("word"), (-F.col("_nf")).alias("freq"), "rank")


def doc_lengths(dtm: DataFrame) -> DataFrame:
    """Row sums: tokens per document (documents without terms are absent)."""
    return dtm.groupBy("doc_id").agg(F.sum("tf").cast("long").alias("length"))


def term_frequency(dtm: DataFrame) -> DataFrame:
    """Column sums: corpus frequency of each term."""
    return dtm.groupBy("term").agg(F.sum("tf").cast("long").alias("freq"))


def freq_table(dtm: DataFrame) -> DataFrame:
    """``table(i)`` / ``table(j)`` of the (doc, term) pairs: kind, id, pairs and token-weighted total."""
    aggs = [F.count(F.lit(1)).alias("n_pairs"), F.sum("tf").cast("long").alias("n_tokens")]
    docs = dtm.groupBy(F.lit("doc").alias("kind"), F.col("doc_id").cast("string").alias("id")).agg(*aggs)
    return docs.unionByName(dtm.groupBy(F.lit("term").alias("kind"), F.col("term").alias("id")).agg(*aggs))


def dtm_summary(dtm: DataFrame) -> DataFrame:
    """docs, terms, non-zero and zero cells, sparsity (%), longest term; from per-document and per-term row counts."""
    docs = dtm.groupBy("doc_id").count().agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("count"), F.lit(0)).alias("non_zero"))
    terms = dtm.groupBy("term").count().agg(F.count(F.lit(1)).alias("terms"), F.max(F.length("term")).alias("max_term_length"))
    s = docs.crossJoin(terms)  # two single rows
    cells = F.col("docs") * F.col("terms")
    return s.select("docs", "terms", "non_zero", (cells - F.col("non_zero")).alias("zero"),
                    F.round(100 * F.try_divide(cells - F.col("non_zero"), cells)).cast("long").alias("sparsity_pct"),
                    "max_term_length")
