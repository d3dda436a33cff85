"""The flight-delay preparation: ingest → filter → calendar join → cleanup →
label → model columns. All lazy; one Catalyst plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import binary_label, clean_trace, date_parts, na_to_zero, parse_date_us, to_num, to_str
from ..operators.joins import left_join
from ..operators.prep import drop_cols, filter_rows, mutate, select_cols
from . import standins

# fixed values of the study: the label and its predictors, in their order
MODEL_COLUMNS = ["IsDepDelayed", "Dest", "Year", "DayOfWeek", "Month", "UniqueCarrier", "Distance",
                 "TmaxF", "TminF", "TmeanF", "PrcpIn", "SnowIn", "CDD", "HDD", "GDD"]
FEATURES = MODEL_COLUMNS[1:]
CATEGORICAL = ["Dest", "UniqueCarrier", "DayOfWeek", "Month"]
ORIGIN = "R"
FIRST_YEAR = 1996


def weather_by_day(weather: DataFrame) -> DataFrame:
    """Parse the text date, split it into Year/Month/DayofMonth, drop it."""
    w = weather.withColumn("Date", parse_date_us("Date"))
    return drop_cols(w.select("*", *date_parts("Date")), "Date")


def origin_flights(flights: DataFrame, origin: str = ORIGIN, first_year: int = FIRST_YEAR) -> DataFrame:
    """``Origin == origin & Year >= first_year & DepTime != "NA" & ArrTime != "NA"``."""
    return filter_rows(flights, F.col("Origin") == origin, F.col("Year") >= first_year,
                       F.col("DepTime") != "NA", F.col("ArrTime") != "NA")


def with_weather(flights: DataFrame, weather_days: DataFrame) -> DataFrame:
    """Left join on the calendar key; every flight is kept once."""
    return left_join(flights, weather_days, ["Year", "Month", "DayofMonth"])


def clean_flights(df: DataFrame) -> DataFrame:
    """The sequential mutate: the label reads the *cleaned* DepDelay."""
    return mutate(
        df,
        ("DepTime", to_num("DepTime")),
        ("ArrTime", to_num("ArrTime")),
        ("DepDelay", na_to_zero("DepDelay")),
        ("IsDepDelayed", binary_label("DepDelay")),
        ("DayOfWeek", to_str("DayOfWeek")),
        ("Month", to_str("Month")),
        ("PrcpIn", clean_trace("PrcpIn")),
        ("SnowIn", clean_trace("SnowIn")),
    )


def prepared(spark: SparkSession, sf: str, keep_key: bool = False) -> DataFrame:
    """The model table: 15 columns (plus ``FlightNum`` if ``keep_key``)."""
    f = origin_flights(standins.flights(spark, sf))
    w = weather_by_day(standins.weather(spark, sf))
    cols = (["FlightNum"] if keep_key else []) + MODEL_COLUMNS
    return select_cols(clean_flights(with_weather(f, w)), *cols)
