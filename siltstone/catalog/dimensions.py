"""Dimension loads driven through several batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import Warehouse
from siltstone.catalog import query
from siltstone.catalog.fixtures import (
    CUSTOMER_YEARS_SQL,
    YEARS,
    customer_years,
    split_into_batches,
    table,
    warehouse,
)
from siltstone.operators.rows import current
from siltstone.plans.dimensions import load_date_dim, load_member_dim, load_scd1, load_scd2

SCD2_SQL = f"""
WITH {CUSTOMER_YEARS_SQL},
ch AS (SELECT *, lag(attr) OVER (PARTITION BY o_custkey ORDER BY y) AS p FROM src),
v AS (SELECT * FROM ch WHERE p IS NULL OR p <> attr),
dim AS (
  SELECT row_number() OVER (ORDER BY y, o_custkey) AS sk, o_custkey, attr, y AS start_y,
         lead(y) OVER (PARTITION BY o_custkey ORDER BY y) AS end_y FROM v)"""


def _scd2(spark: SparkSession, sf: str) -> Warehouse:
    wh = warehouse(spark)
    batch = split_into_batches(customer_years(spark, sf), "y", YEARS)
    for y in YEARS:
        load_scd2(wh, "gold.member", batch(y), ["o_custkey"], ["attr"], "sk", dt.datetime(y, 1, 1), str(y))
    return wh


def _versions(dim: DataFrame) -> DataFrame:
    return dim.select(
        "sk",
        "o_custkey",
        "attr",
        F.year("Start_Time").alias("start_y"),
        F.year("End_Time").alias("end_y"),
    )


@query(f"{SCD2_SQL} SELECT * FROM dim")
def scd2_final(spark: SparkSession, sf: str) -> DataFrame:
    return _versions(_scd2(spark, sf).read("gold.member"))


@query(f"{SCD2_SQL} SELECT * FROM dim WHERE end_y IS NULL")
def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return _versions(current(_scd2(spark, sf).read("gold.member")))


@query(f"""
WITH {CUSTOMER_YEARS_SQL},
ch AS (SELECT *, lag(attr) OVER (PARTITION BY o_custkey ORDER BY y) AS p FROM src WHERE y <> 1998),
base AS (
  SELECT row_number() OVER (ORDER BY y, o_custkey) AS sk, o_custkey, attr, y AS s,
         lead(y) OVER (PARTITION BY o_custkey ORDER BY y) AS e FROM ch WHERE p IS NULL OR p <> attr),
late AS (
  SELECT src.o_custkey, src.attr, base.s AS open_s, base.attr AS open_attr
  FROM src LEFT JOIN base ON base.o_custkey = src.o_custkey AND base.e IS NULL WHERE src.y = 1998),
later AS (SELECT o_custkey, min(s) AS s FROM base WHERE s > 1998 GROUP BY 1),
spliced AS (
  SELECT late.o_custkey, late.attr, h.sk AS held, n.sk AS next, n.attr AS next_attr, n.s AS next_s
  FROM late JOIN later USING (o_custkey) JOIN base n ON n.o_custkey = late.o_custkey AND n.s = later.s
  LEFT JOIN base h ON h.o_custkey = late.o_custkey AND h.s < 1998 AND h.e > 1998
  WHERE late.open_s > 1998 AND h.attr IS DISTINCT FROM late.attr),
fresh AS (SELECT *, row_number() OVER (ORDER BY o_custkey) AS r FROM spliced WHERE next_attr <> attr),
timely AS (
  SELECT *, row_number() OVER (ORDER BY o_custkey) AS r FROM late
  WHERE open_s IS NULL OR (open_s < 1998 AND open_attr <> attr)),
sizes AS (SELECT (SELECT count(*) FROM base) AS n_base, (SELECT count(*) FROM fresh) AS n_fresh)
SELECT sk, o_custkey, attr,
       CASE WHEN sk IN (SELECT next FROM spliced WHERE next_attr = attr) THEN 1998 ELSE s END AS start_y,
       CASE WHEN sk IN (SELECT held FROM spliced WHERE held IS NOT NULL) THEN 1998
            WHEN e IS NULL AND o_custkey IN (SELECT o_custkey FROM timely WHERE open_s IS NOT NULL) THEN 1998
            ELSE e END AS end_y
FROM base
UNION ALL SELECT n_base + r, o_custkey, attr, 1998, next_s FROM fresh, sizes
UNION ALL SELECT n_base + n_fresh + r, o_custkey, attr, 1998, NULL FROM timely, sizes""")
def scd2_late(spark: SparkSession, sf: str) -> DataFrame:
    """The batch of 1998 comes after all others, and again."""
    wh = warehouse(spark)
    batch = split_into_batches(customer_years(spark, sf), "y", YEARS)
    for y in [*(y for y in YEARS if y != 1998), 1998, 1998]:
        load_scd2(
            wh, "gold.member", batch(y), ["o_custkey"], ["attr"], "sk", dt.datetime(y, 1, 1), str(y), late="splice"
        )
    return _versions(wh.read("gold.member"))


@query(f"""
WITH {CUSTOMER_YEARS_SQL},
f AS (SELECT o_custkey, min(y) AS fy, arg_max(attr, y) AS attr FROM src GROUP BY 1)
SELECT row_number() OVER (ORDER BY fy, o_custkey) AS sk, o_custkey, attr FROM f""")
def scd1_final(spark: SparkSession, sf: str) -> DataFrame:
    wh = warehouse(spark)
    batch = split_into_batches(customer_years(spark, sf), "y", YEARS)
    for y in YEARS:
        load_scd1(wh, "gold.member", batch(y), ["o_custkey"], ["attr"], "sk", str(y))
    return wh.read("gold.member")


DATE_DIM_SQL = """
SELECT DISTINCT CAST(d AS DATE) AS DateKey, CAST(day(d) AS INTEGER) AS "Day",
       CAST(month(d) AS INTEGER) AS "Month", CAST(year(d) AS INTEGER) AS "Year",
       strftime(d, '%b-%Y') AS mmmyyyy, strftime(d, '%Y-%m') AS yyyymm
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
      UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)"""


@query(DATE_DIM_SQL)
def date_dim(spark: SparkSession, sf: str) -> DataFrame:
    wh = warehouse(spark)
    load_date_dim(wh, "gold.dates", table(spark, sf, "orders"), "o_orderdate", "orders")
    load_date_dim(wh, "gold.dates", table(spark, sf, "lineitem"), "l_shipdate", "lines")
    return wh.read("gold.dates")


@query("""
WITH m AS (
  SELECT c_name, c_mktsegment, min(CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END) AS b
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT c_name AS CustomerName, c_mktsegment AS Segment, split_part(c_name, '#', 1) AS FirstName,
       split_part(c_name, '#', 2) AS LastName,
       row_number() OVER (ORDER BY b, c_name, c_mktsegment) AS CustomerID FROM m""")
def member_dim(spark: SparkSession, sf: str) -> DataFrame:
    wh = warehouse(spark)
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    bought = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("CustomerName"), F.col("c_mktsegment").alias("Segment"), "o_orderdate"
    )
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    for n, drop in enumerate([early, ~early]):
        load_member_dim(
            wh, "gold.customers", bought.filter(drop), ["CustomerName", "Segment"],
            "CustomerName", "CustomerID", "#", str(n),
        )
    return wh.read("gold.customers")


@query("""
SELECT p_name, split_part(p_name, ' ', 1) AS FirstName, split_part(p_name, ' ', 2) AS LastName,
       row_number() OVER (ORDER BY p_name) AS PartID FROM (SELECT DISTINCT p_name FROM part)""")
def part_name_dim(spark: SparkSession, sf: str) -> DataFrame:
    wh = warehouse(spark)
    parts = table(spark, sf, "part")
    for n in range(2):  # the second pass finds nothing new
        load_member_dim(wh, "gold.part_names", parts, ["p_name"], "p_name", "PartID", batch_id=str(n))
    return wh.read("gold.part_names")
