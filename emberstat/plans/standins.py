"""Stand-in inputs built from the driver's test tables.

The analyses were written for airline CSVs, a weather file, diamonds and
movie reviews, none of which ship with the data. These functions only shape
rows of the test tables into the schemas those analyses expect; they do none
of the analyses' work. Each has a DuckDB twin in ``sqlparts.py``.

Mapping: a flight is a lineitem of an order (``Origin`` ← return flag,
``Dest`` ← order priority, ``UniqueCarrier`` ← market segment, ``Distance``
← extended price, departure delay ← days from order to shipment); the
weather of a day summarises that day's orders and carries the dirty
``"T"`` / ``"M"`` / NULL tokens of a real weather file; a diamond is a
lineitem (cut ← return flag, clarity ← line status, color ← line number,
price ← extended price, carat ← quantity, depth ← tax × 100).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table


def flights(spark: SparkSession, sf: str) -> DataFrame:
    """Raw flight rows; dirty columns are strings holding ``"NA"``."""
    li = table(spark, sf, "lineitem")
    od = table(spark, sf, "orders")
    cu = table(spark, sf, "customer")
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(cu, od.o_custkey == cu.c_custkey)
    ship = F.to_date("l_shipdate")
    na_or = lambda n, v: F.when(F.col("l_linenumber") == n, F.lit("NA")).otherwise(v.cast("string"))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("FlightNum"),
        F.year(ship).alias("Year"), F.month(ship).alias("Month"), F.dayofmonth(ship).alias("DayofMonth"),
        F.dayofweek(ship).alias("DayOfWeek"),
        na_or(5, F.col("l_linenumber") * 100 + 5).alias("DepTime"),
        na_or(6, F.col("l_linenumber") * 100 + 45).alias("ArrTime"),
        na_or(4, F.datediff(ship, F.to_date("o_orderdate"))).alias("DepDelay"),
        F.col("l_returnflag").alias("Origin"), F.col("o_orderpriority").alias("Dest"),
        F.col("c_mktsegment").alias("UniqueCarrier"), F.col("l_extendedprice").alias("Distance"))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order date; ``Date`` as ``m/d/yyyy`` text, precipitation
    and snow as text with numbers, ``"T"``, ``"M"`` or NULL."""
    od = table(spark, sf, "orders")
    day = od.groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("mx"), F.min("o_totalprice").alias("mn"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("nf"),
        F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).alias("no"))
    prcp = (F.when(F.col("n") % 5 == 0, F.lit("T")).when(F.col("n") % 7 == 0, F.lit(None))
            .when(F.col("n") % 11 == 0, F.lit("M")).otherwise((F.col("nf") / 100.0).cast("string")))
    snow = (F.when(F.col("no") % 3 == 0, F.lit("T")).when(F.col("no") % 4 == 0, F.lit(None))
            .otherwise((F.col("no") / 10.0).cast("string")))
    return day.select(
        F.date_format("d", "M/d/yyyy").alias("Date"),
        (F.col("mx") / 1000).alias("TmaxF"), (F.col("mn") / 1000).alias("TminF"),
        ((F.col("mx") / 1000 + F.col("mn") / 1000) / 2).alias("TmeanF"),
        prcp.alias("PrcpIn"), snow.alias("SnowIn"),
        F.col("n").cast("double").alias("CDD"), F.col("nf").cast("double").alias("HDD"),
        F.col("no").cast("double").alias("GDD"))


def diamonds(spark: SparkSession, sf: str) -> DataFrame:
    """carat, cut, color, clarity, depth, price (+ a row key)."""
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_quantity").alias("carat"), F.col("l_returnflag").alias("cut"),
        F.col("l_linenumber").cast("string").alias("color"), F.col("l_linestatus").alias("clarity"),
        (F.col("l_tax") * 100).alias("depth"), F.col("l_extendedprice").alias("price"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_key"))


def air_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Daily readings: Month, Day (int), Ozone (double, NULL on some days)."""
    ev = table(spark, sf, "events")
    d = ev.groupBy(F.to_date("ts").alias("d")).agg(F.avg("value").alias("v"), F.count(F.lit(1)).alias("n"))
    return d.select(F.month("d").alias("Month"), F.dayofmonth("d").alias("Day"),
                    F.when(F.col("n") % 4 == 0, F.lit(None)).otherwise(F.round("v", 6)).alias("Ozone"))


def monthly_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly series (economics / AirPassengers): month start, total."""
    od = table(spark, sf, "orders")
    return od.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("value"))


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """The review corpus: English documents (doc_id, text)."""
    return table(spark, sf, "documents").filter(F.col("lang") == "en").select("doc_id", "text")


def scored_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A deterministic score with ties and a 0/1 label for metric checks."""
    li = table(spark, sf, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_key"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        (F.pmod(F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729
                + F.round(F.col("l_extendedprice")).cast("long"), F.lit(1000)) / 1000.0).alias("score"))
