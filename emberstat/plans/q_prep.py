"""Group A queries: sources, sinks, projections, filters, joins, reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import clean_trace, make_date_from_parts, parse_date_us, round_r, to_num
from ..operators import joins, prep, reshape, series
from ..session import scratch_path
from ..sources import csv as csvio
from ..sources import frames
from ..sources.tables import register_tables, table
from . import flights as fl
from . import standins as si
from .registry import query
from .sqlparts import AIR, DIAMONDS, FLIGHTS, MONTHLY, SELECTED, PREPARED, WEATHER, with_

PREPARED_COLS = ", ".join(["FlightNum"] + fl.MODEL_COLUMNS)

FLIGHT_SCHEMA = T.StructType([
    T.StructField("FlightNum", T.LongType()), T.StructField("Year", T.IntegerType()),
    T.StructField("Month", T.IntegerType()), T.StructField("DayofMonth", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    # dirty columns stay text until cleaned
    T.StructField("DepTime", T.StringType()), T.StructField("ArrTime", T.StringType()),
    T.StructField("DepDelay", T.StringType()),
    T.StructField("Origin", T.StringType()), T.StructField("Dest", T.StringType()),
    T.StructField("UniqueCarrier", T.StringType()), T.StructField("Distance", T.DoubleType()),
])


def _list_dirs(spark, path: str) -> list[str]:
    """Sub-folders of ``path`` on whatever file system it lives on."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory())


@query("csv_round_trip", PREPARED + f"""SELECT {PREPARED_COLS}, CASE FlightNum % 7 WHEN 0 THEN ' lead' WHEN 1 THEN 'trail ' WHEN 2 THEN ''
  WHEN 3 THEN 'two' || chr(10) || 'lines' WHEN 4 THEN 'a "quoted" word' WHEN 5 THEN 'comma, and \\' END AS note FROM prepared""")
def csv_round_trip(spark, sf):
    """Prepared table with a free-text column → CSV folder (vector-free columns) → read back with its schema."""
    df = fl.prepared(spark, sf, keep_key=True)
    note = F.lit(None).cast("string")
    for k, text in enumerate([" lead", "trail ", "", "two\nlines", 'a "quoted" word', "comma, and \\"]):
        note = F.when(F.col("FlightNum") % 7 == k, F.lit(text)).otherwise(note)
    df = df.withColumn("note", note)
    path = csvio.write_csv(df, scratch_path(spark, "scored-csv"))
    return csvio.read_csv(spark, path, schema=df.schema, multi_line=True)


@query("multi_file_union", with_(FLIGHTS) + "SELECT * FROM flights")
def multi_file_union(spark, sf):
    """One CSV per year, each read with one all-text schema for the dirty
    columns, then bound by name (the per-year ingest loop)."""
    f = si.flights(spark, sf)
    root = scratch_path(spark, "year-files")
    csvio.write_csv(f.withColumn("file_year", F.col("Year")), root, partition_by=["file_year"])
    return csvio.read_csv_many(spark, _list_dirs(spark, root), schema=FLIGHT_SCHEMA)


SQL_SOURCE = """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_price
FROM lineitem WHERE year(l_shipdate) >= 1997 GROUP BY l_returnflag, l_linestatus"""


@query("sql_source", SQL_SOURCE)
def sql_source(spark, sf):
    register_tables(spark, sf, ["lineitem"])
    return frames.from_sql(spark, SQL_SOURCE)


@query("literal_frame", """
WITH names(l_returnflag, flag_name, weight) AS (
  VALUES ('A', 'accepted', CAST(1 AS DOUBLE)), ('N', 'none', CAST(1 AS DOUBLE)), ('R', 'returned', CAST(1 AS DOUBLE)))
SELECT l_returnflag, flag_name, weight, count(*) AS n FROM lineitem JOIN names USING (l_returnflag)
GROUP BY ALL""")
def literal_frame(spark, sf):
    """A literal lookup frame (``weight`` recycled) joined to the data."""
    names = frames.literal(spark, {"l_returnflag": ["A", "N", "R"], "flag_name": ["accepted", "none", "returned"],
                                   "weight": [1.0]}, "l_returnflag string, flag_name string, weight double")
    counts = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return joins.join_small(counts, names, "l_returnflag", bounded=True).select(
        "l_returnflag", "flag_name", "weight", "n")


@query("sequence_rows", """
SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 7 DAY)) AS DATE) AS day
FROM orders""")
def sequence_rows(spark, sf):
    """Every 7th day from the first to the last order date."""
    return frames.date_spine(table(spark, sf, "orders"), "o_orderdate", 7)


@query("ts_index", with_(MONTHLY) + """, s AS (SELECT min(month) AS m0 FROM monthly)
SELECT month, value,
       CAST(date_diff('month', m0, month) AS BIGINT) AS idx,
       round(year(m0) + (month(m0) - 1) / 12.0 + date_diff('month', m0, month) / 12.0, 6) AS time
FROM monthly, s""")
def ts_index(spark, sf):
    """Regular monthly series index: ``time = start + i / 12``, computed from
    the date itself (no window over the whole series)."""
    s = series.ts_index(si.monthly_totals(spark, sf), "month", 12)
    return s.select("month", "value", "idx", F.round("time", 6).alias("time"))


@query("ordered_head", PREPARED + f"SELECT {PREPARED_COLS} FROM prepared ORDER BY "
       + ", ".join(c + " NULLS FIRST" for c in PREPARED_COLS.split(", ")) + " LIMIT 10")
def ordered_head(spark, sf):
    """First 10 rows by flight number; the other columns break ties."""
    df = fl.prepared(spark, sf, keep_key=True)
    return prep.ordered_head(df, 10, *df.columns)


@query("frame_dim", PREPARED + "SELECT count(*) AS rows, 15 AS cols FROM prepared")
def frame_dim(spark, sf):
    return prep.frame_dim(fl.prepared(spark, sf))


@query("na_omit_count", PREPARED + f"""SELECT count(*) AS rows, 15 AS cols FROM prepared
WHERE {' AND '.join(c + ' IS NOT NULL' for c in fl.MODEL_COLUMNS)}""")
def na_omit_count(spark, sf):
    return prep.frame_dim(prep.na_omit(fl.prepared(spark, sf)))


@query("select_cols", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def select_cols(spark, sf):
    return prep.select_cols(table(spark, sf, "lineitem"), "l_orderkey", "l_quantity", "l_returnflag")


@query("drop_cols", with_(WEATHER) + "SELECT * FROM wparsed")
def drop_cols(spark, sf):
    """``mutate(Date = as.Date(..)) → Year/Month/DayofMonth → select(-Date)``."""
    return fl.weather_by_day(si.weather(spark, sf))


@query("select_positional", with_(DIAMONDS) + "SELECT carat, cut, color, clarity, depth FROM diamonds")
def select_positional(spark, sf):
    return prep.select_pos(si.diamonds(spark, sf), 1, 5)


@query("filter_conj", with_(FLIGHTS) + "SELECT * FROM flights WHERE Origin = 'R' AND Year >= 1996 "
                                       "AND DepTime != 'NA' AND ArrTime != 'NA'")
def filter_conj(spark, sf):
    return fl.origin_flights(si.flights(spark, sf))


@query("filter_not_null", with_(AIR) + "SELECT * FROM air WHERE Ozone IS NOT NULL")
def filter_not_null(spark, sf):
    return prep.filter_rows(si.air_quality(spark, sf), F.col("Ozone").isNotNull())


@query("semi_join_in", """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40)""")
def semi_join_in(spark, sf):
    keep = table(spark, sf, "part").filter(F.col("p_size") > 40).select(F.col("p_partkey").alias("l_partkey"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return joins.semi_in(li, keep, "l_partkey")


@query("sequential_mutate", "WITH " + ",".join([FLIGHTS, WEATHER, SELECTED]) +
       "\nSELECT FlightNum, DepDelay, IsDepDelayed FROM labelled")
def sequential_mutate(spark, sf):
    f = fl.clean_flights(fl.with_weather(fl.origin_flights(si.flights(spark, sf)),
                                         fl.weather_by_day(si.weather(spark, sf))))
    return f.select("FlightNum", "DepDelay", "IsDepDelayed")


@query("if_else_null", "WITH " + ",".join([FLIGHTS, WEATHER, SELECTED]) + """
SELECT CASE WHEN TmaxF > 300 THEN 'hot' ELSE 'mild' END AS heat, count(*) AS n FROM joined GROUP BY 1""")
def if_else_null(spark, sf):
    """NULL condition (flight without weather) takes the ELSE branch."""
    from ..functions.clean import if_else

    j = fl.with_weather(fl.origin_flights(si.flights(spark, sf)), fl.weather_by_day(si.weather(spark, sf)))
    return j.groupBy(if_else(F.col("TmaxF") > 300, F.lit("hot"), F.lit("mild")).alias("heat")).agg(
        F.count(F.lit(1)).alias("n"))


@query("cast_clean", with_(WEATHER) + """
SELECT Date, PrcpIn AS PrcpText, TRY_CAST(PrcpIn AS DOUBLE) AS PrcpNum, TRY_CAST(CAST(CDD AS VARCHAR) AS DOUBLE) AS CDD
FROM weather""")
def cast_clean(spark, sf):
    w = si.weather(spark, sf)
    return w.select("Date", F.col("PrcpIn").alias("PrcpText"), to_num("PrcpIn").alias("PrcpNum"),
                    to_num(F.col("CDD").cast("string")).alias("CDD"))


DIRTY_DISCOUNT = ("CASE WHEN l_discount = 0 THEN 'T' WHEN l_linenumber = 7 THEN NULL "
                  "WHEN l_linenumber = 3 AND l_discount = 0.05 THEN 'M' ELSE CAST(l_discount AS VARCHAR) END")


@query("clean_trace", f"""
SELECT l_returnflag, count(*) AS n, count(clean) AS n_known,
       CAST(sum(CASE WHEN clean = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_zero, round(sum(clean), 4) AS total
FROM (SELECT l_returnflag, CASE WHEN d IS NULL OR d = 'T' THEN CAST(0 AS DOUBLE) ELSE TRY_CAST(d AS DOUBLE) END AS clean
      FROM (SELECT l_returnflag, {DIRTY_DISCOUNT} AS d FROM lineitem))
GROUP BY 1""")
def clean_trace_q(spark, sf):
    """NULL / "T" → 0, numbers parsed, other tokens ("M") → NULL."""
    li = table(spark, sf, "lineitem")
    d = F.expr(DIRTY_DISCOUNT.replace("VARCHAR", "STRING"))
    c = li.select("l_returnflag", clean_trace(d).alias("clean"))
    return c.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("clean").alias("n_known"),
        F.sum(F.when(F.col("clean") == 0, 1).otherwise(0)).cast("long").alias("n_zero"),
        F.round(F.sum("clean"), 4).alias("total"))


@query("delay_label", "WITH " + ",".join([FLIGHTS, WEATHER, SELECTED]) +
       "\nSELECT IsDepDelayed, count(*) AS n FROM labelled GROUP BY 1")
def delay_label(spark, sf):
    f = fl.clean_flights(fl.origin_flights(si.flights(spark, sf)).withColumns(
        {"PrcpIn": F.lit(None).cast("string"), "SnowIn": F.lit(None).cast("string")}))
    return f.groupBy("IsDepDelayed").agg(F.count(F.lit(1)).alias("n"))


@query("separate_vector", "SELECT vec_id, embedding[2] AS e2, embedding[5] AS e5 FROM embeddings")
def separate_vector(spark, sf):
    e = table(spark, sf, "embeddings")
    return prep.separate(e, "embedding", {"e2": 2, "e5": 5}).select("vec_id", "e2", "e5")


@query("bucketize", """
SELECT CAST(CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 20 THEN 1 WHEN l_quantity < 30 THEN 2
                 WHEN l_quantity < 40 THEN 3 ELSE 4 END AS DOUBLE) AS bucket, count(*) AS n
FROM lineitem GROUP BY 1""")
def bucketize(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity")
    b = prep.bucketize(li, "l_quantity", [-float("inf"), 10, 20, 30, 40, float("inf")])
    return b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query("left_join_calendar", "WITH " + ",".join([FLIGHTS, WEATHER, SELECTED]) + "\nSELECT * FROM joined")
def left_join_calendar(spark, sf):
    return fl.with_weather(fl.origin_flights(si.flights(spark, sf)), fl.weather_by_day(si.weather(spark, sf)))


@query("bind_cols", """
WITH a AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS _pos FROM lineitem),
     b AS (SELECT l_extendedprice AS r_price, l_orderkey AS r_orderkey,
                  row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS _pos FROM lineitem)
SELECT _pos, l_orderkey, l_linenumber, r_price, r_orderkey FROM a FULL JOIN b USING (_pos)""")
def bind_cols(spark, sf):
    """n-th line by key beside the n-th line by descending price."""
    li = table(spark, sf, "lineitem")
    a = li.select("l_orderkey", "l_linenumber")
    b = li.select(F.col("l_extendedprice").alias("r_price"), F.col("l_orderkey").alias("r_orderkey"),
                  F.col("l_linenumber").alias("r_line"), (-F.col("l_extendedprice")).alias("_neg"))
    out = joins.bind_cols(a, b, ["l_orderkey", "l_linenumber"], ["_neg", "r_orderkey", "r_line"])
    return out.select("_pos", "l_orderkey", "l_linenumber", "r_price", "r_orderkey")


@query("union_labelled", """
SELECT l_orderkey, l_quantity, CASE WHEN l_linestatus = 'O' THEN 'open' ELSE 'filled' END AS Model
FROM lineitem WHERE l_linestatus IN ('O', 'F')""")
def union_labelled(spark, sf):
    li = table(spark, sf, "lineitem")
    parts = {"open": li.filter(F.col("l_linestatus") == "O"), "filled": li.filter(F.col("l_linestatus") == "F")}
    return joins.bind_rows_labelled({k: v.select("l_orderkey", "l_quantity") for k, v in parts.items()})


@query("unpivot_metrics", """
WITH wide AS (SELECT l_returnflag AS model, min(l_discount) * 100 AS AUC, max(l_tax) * 100 AS Accuracy
              FROM lineitem GROUP BY 1)
SELECT model, metric, value, round_even(value, 1) AS val2
FROM (UNPIVOT wide ON AUC, Accuracy INTO NAME metric VALUE value)""")
def unpivot_metrics(spark, sf):
    wide = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("model")).agg(
        (F.min("l_discount") * 100).alias("AUC"), (F.max("l_tax") * 100).alias("Accuracy"))
    long = reshape.gather(wide, ["model"], ["AUC", "Accuracy"], "metric", "value")
    return long.withColumn("val2", round_r("value", 1))


@query("topn_per_group", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn
  FROM lineitem) WHERE rn <= 10""")
def topn_per_group(spark, sf):
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return reshape.top_n_by(li, ["l_suppkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 10)


@query("sort_multi", """
SELECT p_type, p_retailprice, p_partkey,
       row_number() OVER (ORDER BY p_type, p_retailprice DESC, p_partkey) AS pos FROM part""")
def sort_multi(spark, sf):
    """``arrange(p_type, desc(p_retailprice))`` with a key tie-break; the
    position is part of the result so the order is checked."""
    p = table(spark, sf, "part").select("p_type", "p_retailprice", "p_partkey",
                                        (-F.col("p_retailprice")).alias("_neg"))
    pos = joins.row_index(p, ["p_type", "_neg", "p_partkey"], "pos").drop("_neg")
    return prep.arrange(pos, "p_type", F.desc("p_retailprice"), "p_partkey")


@query("distinct_values", "SELECT DISTINCT p_brand FROM part")
def distinct_values(spark, sf):
    return table(spark, sf, "part").select("p_brand").distinct()


@query("round_metric", """
SELECT l_returnflag, round_even(avg(l_discount) * 100, 1) AS r_even, round(avg(l_discount) * 100, 1) AS r_up
FROM lineitem GROUP BY 1""")
def round_metric(spark, sf):
    a = table(spark, sf, "lineitem").groupBy("l_returnflag").agg((F.avg("l_discount") * 100).alias("v"))
    return a.select("l_returnflag", round_r("v", 1).alias("r_even"), F.round("v", 1).alias("r_up"))


@query("date_parts", with_(WEATHER) + """
SELECT Date, CAST(year(dt) AS INTEGER) AS Year, CAST(month(dt) AS INTEGER) AS Month, CAST(day(dt) AS INTEGER) AS DayofMonth
FROM (SELECT Date, CAST(try_strptime(Date, '%m/%d/%Y') AS DATE) AS dt FROM weather)""")
def date_parts(spark, sf):
    from ..functions.clean import date_parts as parts

    w = si.weather(spark, sf).select("Date")
    return w.select("Date", *parts(parse_date_us("Date")))


@query("parse_date_us", with_(WEATHER) + "SELECT Date, CAST(try_strptime(Date, '%m/%d/%Y') AS DATE) AS parsed FROM weather")
def parse_date_us_q(spark, sf):
    return si.weather(spark, sf).select("Date", parse_date_us("Date").alias("parsed"))


@query("make_date", with_(AIR) + """
SELECT Month, Day, CAST(try_strptime(concat_ws('/', Month, Day, '2024'), '%m/%d/%Y') AS DATE) AS NewDate FROM air""")
def make_date(spark, sf):
    a = si.air_quality(spark, sf)
    return a.select("Month", "Day", make_date_from_parts("Month", "Day", F.lit(2024)).alias("NewDate"))


@query("array_slice", "SELECT vec_id, embedding[1:8] AS head8 FROM embeddings")
def array_slice(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.slice("embedding", 1, 8).alias("head8"))


@query("flight_delay_counts", PREPARED + f"""SELECT IsDepDelayed, count(*) AS n FROM prepared
WHERE {' AND '.join(c + ' IS NOT NULL' for c in fl.MODEL_COLUMNS)} GROUP BY 1""")
def flagship(spark, sf):
    """The flagship: prepared model table, incomplete rows dropped, rows per label."""
    return prep.na_omit(fl.prepared(spark, sf)).groupBy("IsDepDelayed").agg(F.count(F.lit(1)).alias("n"))


@query("sequence_numbers", """
SELECT value, count(o_orderkey) AS n FROM (SELECT unnest(range((SELECT max(o_custkey) FROM orders), (SELECT min(o_custkey) FROM orders) - 1, -7)) AS value) s
LEFT JOIN orders ON o_custkey = value GROUP BY value""")
def sequence_numbers(spark, sf):
    """Every seventh customer number from the largest down, with its orders."""
    od = table(spark, sf, "orders")
    lo, hi = od.agg(F.min("o_custkey"), F.max("o_custkey")).first()
    n = frames.seq_frame(spark, hi, lo, -7)
    return n.join(od, n.value == od.o_custkey, "left").groupBy("value").agg(F.count("o_orderkey").alias("n"))


@query("registered_view", """
SELECT o_orderpriority, p.name, count(*) AS n FROM orders JOIN (VALUES ('1-URGENT', 'now'), ('2-HIGH', 'soon'), ('5-LOW', 'later')) AS p(priority, name)
ON o_orderpriority = priority GROUP BY ALL""")
def registered_view(spark, sf):
    """A local frame copied to the cluster under a name (a second copy overwrites the first), joined by SQL."""
    register_tables(spark, sf, ["orders"])
    frames.register(frames.literal(spark, {"priority": ["1-URGENT"], "name": ["old"]}), "priorities")
    frames.register(frames.literal(spark, {"priority": ["1-URGENT", "2-HIGH", "5-LOW"], "name": ["now", "soon", "later"]}), "priorities")
    return frames.from_sql(spark, "SELECT o_orderpriority, name, count(*) AS n FROM orders JOIN priorities ON o_orderpriority = priority GROUP BY ALL")
