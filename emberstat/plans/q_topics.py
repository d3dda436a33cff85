"""Group C queries, topic part: LDA fit and the explorer tables.

Explorer tables are oracle-checked on a fixed φ stand-in (term shares per
document source; θ = the document's source) because a fitted LDA has no
DuckDB twin; the LDA keys are checked by properties.
"""

from __future__ import annotations

from pyspark.ml.clustering import LocalLDAModel
from pyspark.sql import functions as F

from ..operators import lda as ld
from ..operators import text as tx
from ..operators import topics as tp
from ..operators.checkpoint import materialize
from ..session import scratch_path
from ..sources.models import load_model, save_model
from . import standins as si
from .q_text import CORPUS_SQL, SPARSE
from .registry import query

# fixed values of the study: topics, prior on θ, seed
K, ALPHA, SEED = 20, 0.02, 3456
#: Prior on φ and full passes over the documents (an online fit needs far fewer passes than a sampler).
BETA, ITERS = 0.1, 10
#: Passes of the trace at most, and the relative gain of the bound under which it stops; sweeps of the sampler and every
#: how many its likelihood is noted (the study ran thousands of sweeps on one machine; ``fit_gibbs`` takes any number).
TRACE, GAIN, SWEEPS, KEEP = 12, 1e-4, 20, 2

# ---------------------------------------------------------------- stand-in φ
STANDIN_SQL = CORPUS_SQL + """,
src AS (SELECT doc_id, source AS topic FROM documents WHERE lang = 'en'),
phi_c AS (SELECT topic, term, sum(tf) AS c FROM sdtm JOIN src USING (doc_id) GROUP BY 1, 2),
phi AS (SELECT topic, term, c / sum(c) OVER (PARTITION BY topic) AS phi FROM phi_c),
tfreq AS (SELECT term, CAST(sum(tf) AS BIGINT) AS freq FROM sdtm GROUP BY 1),
pw AS (SELECT term, freq, freq / sum(freq) OVER () AS pw FROM tfreq),
dlen AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS length FROM sdtm GROUP BY 1),
share AS (SELECT topic, sum(CAST(1 AS DOUBLE) * length) AS freq FROM src JOIN dlen USING (doc_id) GROUP BY 1),
prop AS (SELECT topic, freq, freq / sum(freq) OVER () AS proportion FROM share)
"""


def _standin(spark, sf):
    """(phi, theta, doc_len, term_freq) of the fixed stand-in."""
    corpus = spark.read.parquet(f"{sf}/documents.parquet").filter(F.col("lang") == "en")
    dtm = materialize(tx.sparse_document_term_matrix(corpus.select("doc_id", "text"), SPARSE, stemming=False))
    src = corpus.select("doc_id", F.col("source").alias("topic"))
    c = dtm.join(src, "doc_id").groupBy("topic", "term").agg(F.sum("tf").alias("c"))
    tot = c.groupBy("topic").agg(F.sum("c").alias("_t"))
    phi = materialize(c.join(tot, "topic").select("topic", "term", (F.col("c") / F.col("_t")).alias("phi")))
    theta = src.select("doc_id", "topic", F.lit(1.0).alias("theta"))
    return phi, theta, tx.doc_lengths(dtm), tx.term_frequency(dtm)


@query("topic_relevance", STANDIN_SQL + """
SELECT topic, "lambda", CAST(row_number() OVER (PARTITION BY topic, "lambda" ORDER BY relevance DESC, term) AS INTEGER) AS "rank",
       term, relevance
FROM (SELECT topic, "lambda", term, round("lambda" * ln(phi) + (1 - "lambda") * ln(phi / pw), 10) AS relevance
      FROM phi JOIN pw USING (term), (SELECT range / 100 AS "lambda" FROM range(101)) l WHERE phi > 0)
QUALIFY "rank" <= 30""")
def topic_relevance(spark, sf):
    phi, _, _, tf = _standin(spark, sf)
    return tp.relevance(phi, tf, top=30)


@query("topic_share", STANDIN_SQL + "SELECT topic, freq, round(proportion, 12) AS proportion FROM prop")
def topic_share(spark, sf):
    _, theta, dl, _ = _standin(spark, sf)
    return tp.topic_share(theta, dl).select("topic", "freq", F.round("proportion", 12).alias("proportion"))


@query("term_saliency", STANDIN_SQL + """,
j AS (SELECT term, topic, phi * proportion AS a, proportion FROM phi JOIN prop USING (topic)),
k AS (SELECT term, topic, a / sum(a) OVER (PARTITION BY term) AS pkw, proportion FROM j),
d AS (SELECT term, sum(pkw * ln(pkw / proportion)) AS distinctiveness FROM k WHERE pkw > 0 GROUP BY 1)
SELECT term, round(distinctiveness, 12) AS distinctiveness, round(pw * distinctiveness, 12) AS saliency
FROM d JOIN pw USING (term)""")
def term_saliency(spark, sf):
    phi, theta, dl, tf = _standin(spark, sf)
    s = tp.saliency(phi, tp.topic_share(theta, dl), tf)
    return s.select("term", F.round("distinctiveness", 12).alias("distinctiveness"),
                    F.round("saliency", 12).alias("saliency"))


@query("term_topics", STANDIN_SQL + """,
j AS (SELECT term, topic, phi * freq AS t FROM phi JOIN share USING (topic))
SELECT term, topic, round(t / sum(t) OVER (PARTITION BY term), 10) AS freq FROM j""")
def term_topics(spark, sf):
    """How each term's tokens spread over the topics."""
    phi, theta, dl, _ = _standin(spark, sf)
    return tp.term_topics(phi, tp.topic_share(theta, dl)).select("term", "topic", F.round("freq", 10).alias("freq"))


@query("topic_distance", STANDIN_SQL + """,
t AS (SELECT topic, sum(phi) AS tot FROM phi GROUP BY 1),
b AS (SELECT x.topic AS topic_a, y.topic AS topic_b,
             sum(x.phi * ln(x.phi / ((x.phi + y.phi) / 2)) + y.phi * ln(y.phi / ((x.phi + y.phi) / 2))) AS shared,
             sum(x.phi) AS ma, sum(y.phi) AS mb
      FROM phi x JOIN phi y ON x.term = y.term AND x.topic < y.topic GROUP BY 1, 2)
SELECT ta.topic AS topic_a, tb.topic AS topic_b,
       round(0.5 * coalesce(shared, 0) + 0.5 * ln(2) * ((ta.tot - coalesce(ma, 0)) + (tb.tot - coalesce(mb, 0))), 10) AS jsd
FROM t ta JOIN t tb ON ta.topic < tb.topic LEFT JOIN b ON b.topic_a = ta.topic AND b.topic_b = tb.topic""")
def topic_distance(spark, sf):
    phi, _, _, _ = _standin(spark, sf)
    return tp.topic_distance(phi).select("topic_a", "topic_b", F.round("jsd", 10).alias("jsd"))


DISTANCE_SQL = STANDIN_SQL + """,
t AS (SELECT topic, sum(phi) AS tot FROM phi GROUP BY 1),
b AS (SELECT x.topic AS topic_a, y.topic AS topic_b,
             sum(x.phi * ln(x.phi / ((x.phi + y.phi) / 2)) + y.phi * ln(y.phi / ((x.phi + y.phi) / 2))) AS shared,
             sum(x.phi) AS ma, sum(y.phi) AS mb
      FROM phi x JOIN phi y ON x.term = y.term AND x.topic < y.topic GROUP BY 1, 2),
jsd AS (SELECT ta.topic AS a, tb.topic AS b,
       0.5 * coalesce(shared, 0) + 0.5 * ln(2) * ((ta.tot - coalesce(ma, 0)) + (tb.tot - coalesce(mb, 0))) AS d
FROM t ta JOIN t tb ON ta.topic < tb.topic LEFT JOIN b ON b.topic_a = ta.topic AND b.topic_b = tb.topic)"""


def _axis_sql(name: str, matrix: str, squarings: int = 14) -> str:
    """CTE text: the leading axis ``<name>(a, x, root)`` of a matrix by repeated squaring alone."""
    out = f"""{name}_0 AS (SELECT a, b, v + CASE WHEN a = b THEN (SELECT max(s) FROM (SELECT sum(abs(v)) AS s FROM {matrix} GROUP BY a)) ELSE 0 END AS v FROM {matrix})"""
    for k in range(squarings):
        out += f""",
{name}_{k + 1} AS MATERIALIZED (SELECT l.a, r.b, sum(l.v * r.v) / (SELECT max(abs(v)) * max(abs(v)) FROM {name}_{k}) AS v FROM {name}_{k} l JOIN {name}_{k} r ON l.b = r.a GROUP BY l.a, r.b)"""
    last = f"{name}_{squarings}"
    return out + f""",
{name}_u AS (SELECT a, v / sqrt(sum(v * v) OVER ()) AS x FROM {last} WHERE b = (SELECT a FROM {last} WHERE a = b ORDER BY v DESC LIMIT 1)),
{name} AS (SELECT a, x * (SELECT CASE WHEN x < 0 THEN -1 ELSE 1 END FROM {name}_u ORDER BY round(abs(x), 9) DESC, a LIMIT 1) AS x,
  (SELECT sum(l.x * m.v * r.x) FROM {matrix} m JOIN {name}_u l ON l.a = m.a JOIN {name}_u r ON r.a = m.b) AS root FROM {name}_u)"""


@query("topic_map_fixed", DISTANCE_SQL + f""",
cells AS (SELECT a, b, d * d AS d FROM jsd UNION ALL SELECT b, a, d * d FROM jsd UNION ALL SELECT topic, topic, 0 FROM t),
m AS MATERIALIZED (SELECT a, b, -0.5 * (d - avg(d) OVER (PARTITION BY a) - avg(d) OVER (PARTITION BY b) + avg(d) OVER ()) AS v FROM cells),
{_axis_sql("one", "m")},
rest AS MATERIALIZED (SELECT m.a, m.b, m.v - l.root * l.x * r.x AS v FROM m JOIN one l ON l.a = m.a JOIN one r ON r.a = m.b),
{_axis_sql("two", "rest")}
SELECT one.a AS topic, round(one.x * sqrt(greatest(one.root, 0)), 7) + 0.0 AS x, round(two.x * sqrt(greatest(two.root, 0)), 7) + 0.0 AS y,
  round(proportion, 12) AS proportion FROM one JOIN two USING (a) JOIN prop ON topic = one.a""")
def topic_map_fixed(spark, sf):
    """The topic map of the fixed stand-in."""
    phi, theta, dl, _ = _standin(spark, sf)
    m = tp.topic_map(tp.topic_distance(phi), tp.topic_share(theta, dl))
    return m.select("topic", (F.round("x", 7) + 0.0).alias("x"), (F.round("y", 7) + 0.0).alias("y"), F.round("proportion", 12).alias("proportion"))


# ---------------------------------------------------------------- fitted LDA
def lda_inputs(spark, sf):
    """Stemmed, sparse-cut DTM of the reviews and its bags (both written once)."""
    dtm = materialize(tx.sparse_document_term_matrix(si.reviews(spark, sf), SPARSE, stemming=True))
    return dtm, ld.bags(dtm)


def lda_context(spark, sf, k=K, max_iter=ITERS):
    """The inputs, count vectors and a fitted model."""
    dtm, data = lda_inputs(spark, sf)
    vectors = materialize(tp.count_vectors(data))
    return dtm, data, vectors, tp.fit_lda(vectors, k=k, alpha=ALPHA, beta=BETA, seed=SEED, max_iter=max_iter)


@query("lda_fit")
def lda_fit(spark, sf):
    """One row describing the fit: K, V, documents, log-likelihood bound, perplexity."""
    _, data, vectors, model = lda_context(spark, sf)
    ll, lp = tp.fit_quality(model, vectors, float(data.n_tokens))
    return vectors.agg(F.count(F.lit(1)).alias("docs")).select(
        F.lit(model.getK()).alias("k"), F.lit(data.n_terms).alias("vocab_size"), "docs",
        F.lit(ll).alias("log_lik"), F.lit(lp).alias("log_perplexity"))


@query("lda_top_terms")
def lda_top_terms(spark, sf):
    _, data, _, model = lda_context(spark, sf)
    return tp.top_terms(model, data.terms, 5)


@query("lda_phi")
def lda_phi(spark, sf):
    _, data, _, model = lda_context(spark, sf)
    return tp.phi_table(model, data.terms)


@query("lda_theta")
def lda_theta(spark, sf):
    _, _, vectors, model = lda_context(spark, sf)
    return materialize(tp.theta_table(model, vectors))  # an inference of all documents, whatever reads it how often


@query("lda_trace")
def lda_trace(spark, sf):
    """The bound of every ``KEEP``-th of up to ``TRACE`` passes of one fit (fewer when it gains less than ``GAIN``)."""
    _, data = lda_inputs(spark, sf)
    fit = ld.fit_em(data, K, ALPHA, BETA, SEED, passes=TRACE, tolerance=GAIN)
    return ld.trace_table(spark, fit, keep=KEEP)


@query("lda_sweep_k")
def lda_sweep_k(spark, sf):
    """In-sample bound and held-out perplexity (document completion) for several numbers of topics."""
    _, data = lda_inputs(spark, sf)
    return ld.sweep_k(data, [5, 10, 20], ALPHA, BETA, SEED, passes=ITERS)


def gibbs(spark, sf):
    _, data = lda_inputs(spark, sf)
    return data, ld.fit_gibbs(data, K, ALPHA, BETA, SEED, sweeps=SWEEPS, keep=KEEP)


@query("gibbs_trace")
def gibbs_trace(spark, sf):
    """Log-likelihood of the sampler after every ``KEEP``-th sweep."""
    return ld.trace_table(spark, gibbs(spark, sf)[1], "sweep")


@query("word_assignments")
def word_assignments(spark, sf):
    """Tokens of each document and term by the sampler's topic."""
    data, fit = gibbs(spark, sf)
    return ld.assignments(fit, data.terms)


@query("docs_for_topic")
def docs_for_topic(spark, sf):
    _, _, vectors, model = lda_context(spark, sf)
    return materialize(tp.docs_for_topic(tp.theta_table(model, vectors), 5))


def _explorer_inputs(spark, sf):
    dtm, data, vectors, model = lda_context(spark, sf)
    return tp.phi_table(model, data.terms), tp.theta_table(model, vectors), tx.doc_lengths(dtm), tx.term_frequency(dtm)


@query("topic_map")
def topic_map(spark, sf):
    phi, theta, dl, _ = _explorer_inputs(spark, sf)
    return tp.topic_map(tp.topic_distance(phi), materialize(tp.topic_share(theta, dl)))


@query("ldavis_json")
def ldavis_json(spark, sf):
    """The explorer document, written as a JSON text file and read back."""
    from ..sources.csv import write_json_doc

    phi, theta, dl, tf = _explorer_inputs(spark, sf)
    path = write_json_doc(tp.explorer_json(phi, theta, dl, tf), scratch_path(spark, "explorer-json"))
    return spark.read.text(path).withColumnRenamed("value", "json")


@query("model_round_trip")
def model_round_trip(spark, sf):
    """Save the fitted model, load it back, and describe its topics."""
    _, data, _, model = lda_context(spark, sf)
    path = save_model(model, scratch_path(spark, "lda-model"))
    return tp.top_terms(load_model(LocalLDAModel, path), data.terms, 5)
