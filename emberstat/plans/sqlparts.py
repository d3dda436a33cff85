"""DuckDB twins of the stand-in inputs (see ``standins.py``), as CTE text. Column names are fixed values of the study."""

FLIGHTS = """
flights AS (
  SELECT l_orderkey * 10 + l_linenumber AS FlightNum,
         CAST(year(l_shipdate) AS INTEGER) AS Year,
         CAST(month(l_shipdate) AS INTEGER) AS Month,
         CAST(day(l_shipdate) AS INTEGER) AS DayofMonth,
         CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS DayOfWeek,
         CASE WHEN l_linenumber = 5 THEN 'NA' ELSE CAST(l_linenumber * 100 + 5 AS VARCHAR) END AS DepTime,
         CASE WHEN l_linenumber = 6 THEN 'NA' ELSE CAST(l_linenumber * 100 + 45 AS VARCHAR) END AS ArrTime,
         CASE WHEN l_linenumber = 4 THEN 'NA'
              ELSE CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS VARCHAR) END AS DepDelay,
         l_returnflag AS Origin, o_orderpriority AS Dest, c_mktsegment AS UniqueCarrier,
         l_extendedprice AS Distance
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

WEATHER = """
wday AS (
  SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n, max(o_totalprice) AS mx, min(o_totalprice) AS mn,
         CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS nf,
         CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_o
  FROM orders GROUP BY 1),
weather AS (
  SELECT strftime(d, '%-m/%-d/%Y') AS Date, mx / 1000 AS TmaxF, mn / 1000 AS TminF,
         (mx / 1000 + mn / 1000) / 2 AS TmeanF,
         CASE WHEN n % 5 = 0 THEN 'T' WHEN n % 7 = 0 THEN NULL WHEN n % 11 = 0 THEN 'M'
              ELSE CAST(CAST(nf AS DOUBLE) / 100 AS VARCHAR) END AS PrcpIn,
         CASE WHEN n_o % 3 = 0 THEN 'T' WHEN n_o % 4 = 0 THEN NULL
              ELSE CAST(CAST(n_o AS DOUBLE) / 10 AS VARCHAR) END AS SnowIn,
         CAST(n AS DOUBLE) AS CDD, CAST(nf AS DOUBLE) AS HDD, CAST(n_o AS DOUBLE) AS GDD
  FROM wday),
wparsed AS (
  SELECT CAST(year(dt) AS INTEGER) AS Year, CAST(month(dt) AS INTEGER) AS Month,
         CAST(day(dt) AS INTEGER) AS DayofMonth, TmaxF, TminF, TmeanF, PrcpIn, SnowIn, CDD, HDD, GDD
  FROM (SELECT CAST(try_strptime(Date, '%m/%d/%Y') AS DATE) AS dt, * FROM weather))"""

SELECTED = """
selected AS (SELECT * FROM flights WHERE Origin = 'R' AND Year >= 1996 AND DepTime != 'NA' AND ArrTime != 'NA'),
joined AS (SELECT * FROM selected LEFT JOIN wparsed USING (Year, Month, DayofMonth)),
cleaned AS (
  SELECT * REPLACE (
           TRY_CAST(DepTime AS DOUBLE) AS DepTime,
           TRY_CAST(ArrTime AS DOUBLE) AS ArrTime,
           CASE WHEN DepDelay != 'NA' THEN TRY_CAST(DepDelay AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS DepDelay,
           CAST(DayOfWeek AS VARCHAR) AS DayOfWeek,
           CAST(Month AS VARCHAR) AS Month,
           CASE WHEN PrcpIn IS NULL OR PrcpIn = 'T' THEN CAST(0 AS DOUBLE) ELSE TRY_CAST(PrcpIn AS DOUBLE) END AS PrcpIn,
           CASE WHEN SnowIn IS NULL OR SnowIn = 'T' THEN CAST(0 AS DOUBLE) ELSE TRY_CAST(SnowIn AS DOUBLE) END AS SnowIn)
  FROM joined),
labelled AS (
  SELECT *, CASE WHEN DepDelay > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS IsDepDelayed FROM cleaned),
prepared AS (
  SELECT FlightNum, IsDepDelayed, Dest, Year, DayOfWeek, Month, UniqueCarrier, Distance,
         TmaxF, TminF, TmeanF, PrcpIn, SnowIn, CDD, HDD, GDD FROM labelled)"""

PREPARED = "WITH " + ",".join([FLIGHTS, WEATHER, SELECTED]) + "\n"

DIAMONDS = """
diamonds AS (
  SELECT l_quantity AS carat, l_returnflag AS cut, CAST(l_linenumber AS VARCHAR) AS color,
         l_linestatus AS clarity, l_tax * 100 AS depth, l_extendedprice AS price,
         l_orderkey * 10 + l_linenumber AS row_key
  FROM lineitem)"""

AIR = """
aday AS (SELECT CAST(ts AS DATE) AS d, avg(value) AS v, count(*) AS n FROM events GROUP BY 1),
air AS (SELECT CAST(month(d) AS INTEGER) AS Month, CAST(day(d) AS INTEGER) AS Day,
               CASE WHEN n % 4 = 0 THEN NULL ELSE round(v, 6) END AS Ozone FROM aday)"""

MONTHLY = """
monthly AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(sum(o_totalprice), 2) AS value
            FROM orders GROUP BY 1)"""

SCORED = """
scored AS (
  SELECT l_orderkey * 10 + l_linenumber AS row_key,
         CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label,
         CAST((l_orderkey * 7919 + l_linenumber * 104729 + CAST(round(l_extendedprice) AS BIGINT)) % 1000 AS DOUBLE) / 1000 AS score
  FROM lineitem)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"
