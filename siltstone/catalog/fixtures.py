"""The given tables in the shapes the loads expect; every shape covers all rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import Warehouse
from siltstone.operators.rows import dedupe, rename
from siltstone.session import new_folder

BATCH_TS = dt.datetime(2024, 1, 1)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, new_folder(spark, "warehouse"))


def orders_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return rename(table(spark, sf, "orders"), {"o_custkey": "customer_id_o"})


def customer_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return rename(table(spark, sf, "customer"), {"c_custkey": "customer_id_c"})


def split_into_batches(
    df: DataFrame, column: str, values: Sequence[object]
) -> Callable[[object], DataFrame]:
    """Write a feed once, a folder per batch, and read back one batch at a time.

    The feed is computed in one pass; each batch then reads its own files only.
    """
    spark = df.sparkSession
    path = new_folder(spark, "batches")
    # A file per task and batch; the batches are few, so a shuffle to have fewer files would cost more than it saves.
    df.write.partitionBy(column).parquet(path)
    return lambda value: spark.read.schema(df.schema).parquet(path).filter(
        F.col(column) == F.lit(value)
    )


YEARS = range(1995, 2002)

# One row per customer and order year: the customer's latest order of that year.
CUSTOMER_YEARS_SQL = """
src AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS attr
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                             ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""


def customer_years(spark: SparkSession, sf: str) -> DataFrame:
    dated = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    latest = dedupe(dated, ["o_custkey", "y"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return latest.select("o_custkey", "y", F.col("o_orderpriority").alias("attr"))


# A sale per line item. Money is counted in cents so that sums are exact.
SALES_SQL = """
sales AS (
  SELECT 'BR' || l_suppkey AS Branch_ID, s_name AS BranchName, n_name AS DealerName,
         p_brand AS Model_ID,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS Revenue,
         CAST(l_quantity AS BIGINT) AS Units_Sold,
         'DT' || strftime(l_shipdate, '%Y%m') AS Date_ID,
         CAST(day(l_shipdate) AS INTEGER) AS "Day", CAST(month(l_shipdate) AS INTEGER) AS "Month",
         CAST(year(l_shipdate) AS INTEGER) AS "Year", l_orderkey, l_linenumber, l_partkey, p_type
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey)"""


def sales_feed(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return (
        lines.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("BR"), "l_suppkey").alias("Branch_ID"),
            F.col("s_name").alias("BranchName"),
            F.col("n_name").alias("DealerName"),
            F.col("p_brand").alias("Model_ID"),
            F.round(F.col("l_extendedprice") * 100).cast("long").alias("Revenue"),
            F.col("l_quantity").cast("long").alias("Units_Sold"),
            F.concat(F.lit("DT"), F.date_format("l_shipdate", "yyyyMM")).alias("Date_ID"),
            F.dayofmonth("l_shipdate").alias("Day"),
            F.month("l_shipdate").alias("Month"),
            F.year("l_shipdate").alias("Year"),
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "p_type",
        )
    )


# An order line per line item; customers of one segment come without a name.
ORDER_LINES_SQL = """
lines AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS OrderNumber, l_linenumber AS LineNumber,
         CAST(o_orderdate AS DATE) AS OrderDate,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS CustomerName,
         'c' || c_custkey || '@example.com' AS Email, p_name AS Item,
         CAST(l_quantity AS INTEGER) AS Qty, CAST(l_extendedprice AS FLOAT) AS UnitPrice,
         CAST(l_tax AS FLOAT) AS Tax, l_shipdate, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""


def order_lines(spark: SparkSession, sf: str, carried: Mapping[str, Column] | None = None) -> DataFrame:
    """Customers are joined to the orders and parts to the line items, so lines are shuffled once for each of two joins.

    The order's key stays in the result, which lies by order, and what groups by that needs no shuffle. Line
    items are typed, and columns to carry along taken from them, before they are shuffled.
    """
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = (
        table(spark, sf, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey",
            F.col("o_orderdate").cast("date").alias("OrderDate"),
            F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_name")).alias("CustomerName"),
            "c_custkey",
        )
    )
    carried = carried or {}
    items = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_linenumber").alias("LineNumber"),
        F.col("l_quantity").cast("int").alias("Qty"),
        F.col("l_extendedprice").cast("float").alias("UnitPrice"),
        F.col("l_tax").cast("float").alias("Tax"),
        *(c.alias(name) for name, c in carried.items()),
    )
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("Item"))
    lines = items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("OrderNumber"),
        "LineNumber",
        "OrderDate",
        "CustomerName",
        F.concat(F.lit("c"), "c_custkey", F.lit("@example.com")).alias("Email"),
        "Item",
        "Qty",
        "UnitPrice",
        "Tax",
        *carried,
    )


# Lines of an order feed of which four fifths are flawed: short, a key too wide for an int, no number, a field too many.
FLAWED_SQL = """
feed AS (
  SELECT *, CAST(o_orderkey % 5 AS INTEGER) AS flaw,
         CASE WHEN o_orderkey % 5 = 2 THEN o_orderkey * 10000000000 ELSE o_orderkey END AS sent_key
  FROM orders)"""


def flawed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as lines of text: key, customer, status and price, with the flaws of ``FLAWED_SQL``."""
    flaw = F.col("o_orderkey") % 5
    key = F.when(flaw == 2, F.col("o_orderkey") * 10_000_000_000).otherwise(F.col("o_orderkey")).cast("string")
    price = F.when(flaw == 1, None).when(flaw == 3, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    surplus = F.when(flaw == 4, "surplus")
    fields = [key, F.col("o_custkey").cast("string"), F.col("o_orderstatus"), price, surplus]
    return table(spark, sf, "orders").select(F.concat_ws(",", *fields).alias("value"))


FLAWED_SCHEMA = "o_orderkey int, o_custkey int, o_orderstatus string, o_totalprice double"
