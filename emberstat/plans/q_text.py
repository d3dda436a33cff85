"""Group C queries: text → document-term matrix → sparse cut → frequencies.

Oracle twins run the same control list in DuckDB. Each key has a stemmed
counterpart (``stemmed_*``, the study's own form), whose oracle stems the
distinct words by the stemmer's steps as SQL; tests hold these steps against
the plain Python stemmer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.porter2 import stem_sql
from ..functions.text import collapse_whitespace, normalize_text
from ..operators import text as tx
from ..operators.checkpoint import materialize
from ..sources.tables import table
from . import standins as si
from .registry import query

SPARSE = 0.97


def _sql_list(words):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(words))) + "]"


CORPUS_SQL = rf"""WITH corpus AS (SELECT doc_id, text FROM documents WHERE lang = 'en'),
norm AS (SELECT doc_id, regexp_replace(regexp_replace(lower(text), '[[:punct:]]', '', 'g'), '[0-9]', '', 'g') AS t FROM corpus),
toks AS (SELECT doc_id, token FROM (SELECT doc_id, unnest(regexp_split_to_array(t, '\s+')) AS token FROM norm) WHERE token != ''),
stop AS (SELECT unnest({_sql_list(tx.STOPWORDS)}) AS token),
kept AS (SELECT * FROM toks WHERE token NOT IN (SELECT token FROM stop)),
dtm AS (SELECT doc_id, token AS term, count(*) AS tf FROM kept WHERE length(token) >= 3 GROUP BY 1, 2),
ndocs AS (SELECT count(*) AS n FROM corpus),
dfs AS (SELECT term, count(*) AS df FROM dtm GROUP BY 1),
keep AS (SELECT term, df FROM dfs, ndocs WHERE df > n * (1 - {SPARSE})),
sdtm AS (SELECT * FROM dtm WHERE term IN (SELECT term FROM keep))
"""

# the same matrix of stems: tokens are stemmed before the length bound
STEMMED_SQL = CORPUS_SQL.replace("dtm AS (SELECT doc_id, token AS term, count(*) AS tf FROM kept WHERE length(token) >= 3 GROUP BY 1, 2)", f"""raw AS (SELECT doc_id, token, count(*) AS tf FROM kept GROUP BY 1, 2),
stems AS MATERIALIZED ({stem_sql("(SELECT DISTINCT token FROM raw)", "token")}),
dtm AS (SELECT doc_id, stem AS term, CAST(sum(tf) AS BIGINT) AS tf FROM raw JOIN stems USING (token) WHERE length(stem) >= 3 GROUP BY 1, 2)""")

#: What the keys read of the matrix, plain or stemmed.
BODY = {
    "document_term_matrix": "SELECT * FROM dtm",
    "sparse_terms": "SELECT term, df FROM keep",
    "vocabulary": "SELECT dense_rank() OVER (ORDER BY term) AS term_id, term FROM keep",
    "nonempty_docs": "SELECT doc_id, count(*) AS n_terms FROM sdtm GROUP BY 1",
    "doc_lengths": "SELECT doc_id, CAST(sum(tf) AS BIGINT) AS length FROM sdtm GROUP BY 1",
    "term_frequency": "SELECT term, CAST(sum(tf) AS BIGINT) AS freq FROM sdtm GROUP BY 1",
    "dtm_summary": """SELECT docs, terms, non_zero, docs * terms - non_zero AS zero,
  CAST(round(100 * (docs * terms - non_zero) / (docs * terms)) AS BIGINT) AS sparsity_pct, max_term_length
FROM (SELECT count(DISTINCT doc_id) AS docs, count(DISTINCT term) AS terms, count(*) AS non_zero,
             CAST(max(length(term)) AS INTEGER) AS max_term_length FROM sdtm)""",
    "top_words": """SELECT term AS word, freq, CAST(row_number() OVER (ORDER BY freq DESC, term) AS BIGINT) AS rank
FROM (SELECT term, CAST(sum(tf) AS BIGINT) AS freq FROM sdtm GROUP BY 1) ORDER BY freq DESC, term LIMIT 30""",
}


def _dtm(spark, sf, stemming=False):
    return tx.document_term_matrix(si.reviews(spark, sf), stemming=stemming)


def _sparse_dtm(spark, sf, stemming=False):
    return tx.sparse_document_term_matrix(si.reviews(spark, sf), SPARSE, stemming=stemming)


@query("text_normalize", r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(text),
  '[[:punct:]]', '', 'g'), '[0-9]', '', 'g'), '\s+', ' ', 'g')) AS norm FROM documents""")
def text_normalize(spark, sf):
    c = table(spark, sf, "documents")
    return c.select("doc_id", collapse_whitespace(normalize_text(F.col("text"))).alias("norm"))


@query("tokenize", r"""SELECT doc_id, token, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS token FROM documents)
WHERE token != '' GROUP BY 1, 2""")
def tokenize(spark, sf):
    t = tx.tokenize(table(spark, sf, "documents"))
    return t.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


@query("term_counts", CORPUS_SQL.replace(" WHERE lang = 'en'", "") + "SELECT doc_id, token AS term, count(*) AS tf FROM toks GROUP BY 1, 2")
def term_counts(spark, sf):
    """Raw term frequency of the normalised tokens."""
    t = tx.tokenize(table(spark, sf, "documents"), normalize=True).withColumnRenamed("token", "term")
    return tx.term_counts(t)


@query("stopword_filter", CORPUS_SQL + """SELECT t.doc_id, t.n_tokens, coalesce(k.n_kept, 0) AS n_kept
FROM (SELECT doc_id, count(*) AS n_tokens FROM toks GROUP BY 1) t
LEFT JOIN (SELECT doc_id, count(*) AS n_kept FROM kept GROUP BY 1) k USING (doc_id)""")
def stopword_filter(spark, sf):
    t = tx.flag_stopwords(tx.tokenize(si.reviews(spark, sf), normalize=True))
    return t.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"),
                                   F.count(F.when(~F.col("is_stop"), 1)).alias("n_kept"))


@query("document_term_matrix", CORPUS_SQL + BODY["document_term_matrix"])
def document_term_matrix(spark, sf):
    return _dtm(spark, sf)


@query("sparse_terms", CORPUS_SQL + BODY["sparse_terms"])
def sparse_terms(spark, sf):
    return tx.doc_frequency(_sparse_dtm(spark, sf))


@query("vocabulary", CORPUS_SQL + BODY["vocabulary"])
def vocabulary(spark, sf):
    return tx.vocabulary_ids(_sparse_dtm(spark, sf))


@query("nonempty_docs", CORPUS_SQL + BODY["nonempty_docs"])
def nonempty_docs(spark, sf):
    return tx.drop_empty_docs(_sparse_dtm(spark, sf))


@query("doc_lengths", CORPUS_SQL + BODY["doc_lengths"])
def doc_lengths(spark, sf):
    return tx.doc_lengths(_sparse_dtm(spark, sf))


@query("term_frequency", CORPUS_SQL + BODY["term_frequency"])
def term_frequency(spark, sf):
    return tx.term_frequency(_sparse_dtm(spark, sf))


@query("token_total", CORPUS_SQL + "SELECT CAST(sum(tf) AS BIGINT) AS total FROM sdtm")
def token_total(spark, sf):
    return _sparse_dtm(spark, sf).agg(F.sum("tf").cast("long").alias("total"))


@query("dtm_summary", CORPUS_SQL + BODY["dtm_summary"])
def dtm_summary(spark, sf):
    return tx.dtm_summary(_sparse_dtm(spark, sf))


@query("freq_table", CORPUS_SQL + """
SELECT 'doc' AS kind, CAST(doc_id AS VARCHAR) AS id, count(*) AS n_pairs, CAST(sum(tf) AS BIGINT) AS n_tokens FROM sdtm GROUP BY 1, 2
UNION ALL
SELECT 'term' AS kind, term AS id, count(*) AS n_pairs, CAST(sum(tf) AS BIGINT) AS n_tokens FROM sdtm GROUP BY 1, 2""")
def freq_table(spark, sf):
    """Frequency tables of the document and term ids (the matrix is written once and read twice)."""
    return tx.freq_table(materialize(_sparse_dtm(spark, sf)))


@query("top_words", CORPUS_SQL + BODY["top_words"])
def top_words(spark, sf):
    """The 30 most frequent terms (a top-k over the term totals)."""
    return tx.word_freq(_sparse_dtm(spark, sf), 30)


@query("stem_tokens", STEMMED_SQL + "SELECT token AS term, stem FROM stems")
def stem_tokens(spark, sf):
    """Distinct kept tokens of the corpus with their Snowball English stems."""
    t = tx.remove_stopwords(tx.tokenize(si.reviews(spark, sf), normalize=True)).withColumnRenamed("token", "term")
    return tx.stem_terms(t)


@query("stemmed_document_term_matrix", STEMMED_SQL + BODY["document_term_matrix"])
def stemmed_document_term_matrix(spark, sf):
    return _dtm(spark, sf, True)


@query("stemmed_sparse_terms", STEMMED_SQL + BODY["sparse_terms"])
def stemmed_sparse_terms(spark, sf):
    return tx.doc_frequency(_sparse_dtm(spark, sf, True))


@query("stemmed_vocabulary", STEMMED_SQL + BODY["vocabulary"])
def stemmed_vocabulary(spark, sf):
    return tx.vocabulary_ids(_sparse_dtm(spark, sf, True))


@query("stemmed_nonempty_docs", STEMMED_SQL + BODY["nonempty_docs"])
def stemmed_nonempty_docs(spark, sf):
    return tx.drop_empty_docs(_sparse_dtm(spark, sf, True))


@query("stemmed_doc_lengths", STEMMED_SQL + BODY["doc_lengths"])
def stemmed_doc_lengths(spark, sf):
    return tx.doc_lengths(_sparse_dtm(spark, sf, True))


@query("stemmed_term_frequency", STEMMED_SQL + BODY["term_frequency"])
def stemmed_term_frequency(spark, sf):
    return tx.term_frequency(_sparse_dtm(spark, sf, True))


@query("stemmed_summary", STEMMED_SQL + BODY["dtm_summary"])
def stemmed_summary(spark, sf):
    return tx.dtm_summary(_sparse_dtm(spark, sf, True))


@query("stemmed_top_words", STEMMED_SQL + BODY["top_words"])
def stemmed_top_words(spark, sf):
    """The 30 most frequent stems."""
    return tx.word_freq(_sparse_dtm(spark, sf, True), 30)
