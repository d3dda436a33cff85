"""Row-wise operators run unchanged on a streaming frame."""

from pyspark.sql import functions as F

from emberstat.functions.clean import binary_label, clean_trace
from emberstat.operators import text as tx
from emberstat.session import scratch_path
from tests.conftest import SMALL


def test_row_operators_on_a_stream(spark):
    docs_schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    stream = spark.readStream.schema(docs_schema).option("pathGlobFilter", "documents.parquet").parquet(SMALL)
    toks = tx.remove_stopwords(tx.tokenize(stream.filter(F.col("lang") == "en").select("doc_id", "text"),
                                           normalize=True))
    q = (toks.writeStream.format("memory").queryName("stream_tokens").outputMode("append")
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql("SELECT count(*) AS n FROM stream_tokens").first().n
    batch = tx.remove_stopwords(tx.tokenize(
        spark.read.parquet(f"{SMALL}/documents.parquet").filter(F.col("lang") == "en"), normalize=True)).count()
    assert got == batch > 0


def test_cleanup_on_a_stream(spark):
    li_schema = spark.read.parquet(f"{SMALL}/lineitem.parquet").schema
    s = spark.readStream.schema(li_schema).option("pathGlobFilter", "lineitem.parquet").parquet(SMALL)
    dirty = F.when(F.col("l_discount") == 0, F.lit("T")).otherwise(F.col("l_discount").cast("string"))
    out = s.select(clean_trace(dirty).alias("d"), binary_label(F.col("l_tax")).alias("taxed"))
    q = (out.writeStream.format("memory").queryName("stream_clean").outputMode("append")
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt2")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    r = spark.sql("SELECT count(*) AS n, count(d) AS nd FROM stream_clean").first()
    assert r.n == r.nd == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
