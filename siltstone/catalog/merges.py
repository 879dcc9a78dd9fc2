"""The merge family, each variant over yearly batches of whole orders."""

from __future__ import annotations

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
from siltstone.operators.merge import insert_absent, merge, offending_keys

ALL = "silver.member"


def _through_years(spark: SparkSession, sf: str, **clauses) -> DataFrame:
    """Publish the first year and merge the others one by one."""
    wh = warehouse(spark)
    batch = split_into_batches(customer_years(spark, sf), "y", YEARS)
    wh.publish(batch(YEARS[0]), ALL, batch_id=str(YEARS[0]))
    for y in YEARS[1:]:
        merge(wh, ALL, batch(y), ["o_custkey"], batch_id=str(y), **clauses)
    return wh.read(ALL)


@query(f"""
WITH {CUSTOMER_YEARS_SQL}
SELECT o_custkey, max(y) AS y, arg_max(attr, y) AS attr FROM src GROUP BY 1""")
def merge_upsert_all(spark: SparkSession, sf: str) -> DataFrame:
    return _through_years(spark, sf)


@query(f"""
WITH {CUSTOMER_YEARS_SQL}
SELECT o_custkey, max(y) AS y, arg_max(attr, y) AS attr FROM src
GROUP BY 1 HAVING min(y) = 1995""")
def merge_update_only(spark: SparkSession, sf: str) -> DataFrame:
    return _through_years(spark, sf, insert=None)


@query(f"""
WITH {CUSTOMER_YEARS_SQL}
SELECT o_custkey, min(y) AS y, arg_min(attr, y) AS attr FROM src GROUP BY 1""")
def merge_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    return _through_years(spark, sf, update=None)


@query(f"""
WITH {CUSTOMER_YEARS_SQL}
SELECT o_custkey, max(y) AS y,
       CASE WHEN min(y) = 1995 THEN arg_min(attr, y) END AS attr FROM src GROUP BY 1""")
def merge_partial_insert(spark: SparkSession, sf: str) -> DataFrame:
    return _through_years(
        spark, sf,
        update={"y": F.col("y")},
        insert={"o_custkey": F.col("o_custkey"), "y": F.col("y")},
    )


@query(f"""
WITH {CUSTOMER_YEARS_SQL}
SELECT o_custkey, CAST(arg_max(o, y) AS VARCHAR) AS attr, max(y) AS y
FROM (SELECT o_custkey, y, CASE WHEN y = min(y) OVER (PARTITION BY o_custkey) THEN attr
                                ELSE 'seen again' END AS o FROM src) GROUP BY 1""")
def merge_constant_update(spark: SparkSession, sf: str) -> DataFrame:
    return _through_years(spark, sf, update={"y": F.col("y"), "attr": F.lit("seen again")})


@query(f"""
WITH {CUSTOMER_YEARS_SQL}
SELECT o_custkey, y, attr FROM src
QUALIFY attr <> '1-URGENT' OR y = max(y) OVER (PARTITION BY o_custkey)""")
def merge_target_where(spark: SparkSession, sf: str) -> DataFrame:
    """Only an urgent row is overtaken by the customer's next year; other rows stay beside it."""
    wh = warehouse(spark)
    batch = split_into_batches(customer_years(spark, sf), "y", YEARS)
    wh.publish(batch(YEARS[0]), ALL)
    for y in YEARS[1:]:
        merge(wh, ALL, batch(y), ["o_custkey"], target_where=F.col("attr") == "1-URGENT")
    return wh.read(ALL)


@query(f"""
WITH {CUSTOMER_YEARS_SQL}
SELECT o_custkey, max(y) AS y, arg_max(attr, y) AS attr,
       CASE WHEN count(*) > 1 THEN 'Update' ELSE 'Insert' END AS Process_Type
FROM src GROUP BY 1""")
def merge_tagged(spark: SparkSession, sf: str) -> DataFrame:
    wh = warehouse(spark)
    batch = split_into_batches(customer_years(spark, sf), "y", YEARS)
    wh.publish(batch(YEARS[0]).withColumn("Process_Type", F.lit("Insert")), ALL)
    for y in YEARS[1:]:
        merge(wh, ALL, batch(y), ["o_custkey"], tag_column="Process_Type")
    return wh.read(ALL)


@query(f"""
WITH {CUSTOMER_YEARS_SQL}
SELECT o_custkey, attr, min(y) AS y FROM src GROUP BY 1, 2""")
def insert_absent_composite(spark: SparkSession, sf: str) -> DataFrame:
    wh = warehouse(spark)
    years = customer_years(spark, sf)
    batch = split_into_batches(years, "y", YEARS)
    wh.create_if_absent(ALL, years.schema)
    for y in [*YEARS, YEARS[0]]:  # the repeated batch adds nothing
        insert_absent(wh, ALL, batch(y), ["o_custkey", "attr"])
    return wh.read(ALL)


def _orders_by_year(spark: SparkSession, sf: str) -> Warehouse:
    """All orders, partitioned by year."""
    wh = warehouse(spark)
    orders = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "y"]
    wh.publish(orders.select(columns), "silver.orders", partition_by=["y"])
    return wh


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN l.l_orderkey IS NULL THEN o_orderstatus ELSE 'X' END AS o_orderstatus,
       o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS y
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem
                       WHERE l_shipdate >= TIMESTAMP '2001-06-01') l ON o_orderkey = l_orderkey""")
def merge_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Only the partitions with a late shipped order are rewritten."""
    wh = _orders_by_year(spark, sf)
    late = table(spark, sf, "lineitem").filter(
        F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz")
    )
    late = late.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    merge(wh, "silver.orders", late, ["o_orderkey"], update={"o_orderstatus": F.lit("X")}, insert=None)
    return wh.read("silver.orders")


KEPT_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS y
FROM orders"""


@query(f"{KEPT_SQL} WHERE NOT (o_totalprice < 50000 AND year(o_orderdate) = 1997)")
def delete_where(spark: SparkSession, sf: str) -> DataFrame:
    wh = _orders_by_year(spark, sf)
    wh.delete_where("silver.orders", (F.col("o_totalprice") < 50000) & (F.col("y") == 1997))
    return wh.read("silver.orders")


@query(f"{KEPT_SQL} WHERE o_orderstatus NOT IN ('F', 'P')")
def delete_in_list(spark: SparkSession, sf: str) -> DataFrame:
    wh = _orders_by_year(spark, sf)
    wh.delete_where("silver.orders", F.col("o_orderstatus").isin("F", "P"))
    return wh.read("silver.orders")


@query("""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_totalprice > 300000 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_totalprice > 300000 THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS y FROM orders""")
def update_where(spark: SparkSession, sf: str) -> DataFrame:
    wh = _orders_by_year(spark, sf)
    wh.update_where(
        "silver.orders",
        F.col("o_totalprice") > 300000,
        {"o_orderstatus": F.lit("Z"), "o_totalprice": F.lit(0.0)},
    )
    return wh.read("silver.orders")


@query("""
SELECT l_suppkey, l_partkey, l_shipdate, count(*) AS n_rows FROM lineitem
JOIN (SELECT DISTINCT o_orderdate FROM orders) ON l_shipdate = o_orderdate
GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def merge_offending_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Sales that a merge on (supplier, part, day) would refuse, of the days that have orders."""
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate")
    days = table(spark, sf, "orders").select(F.col("o_orderdate").alias("l_shipdate")).distinct()
    target = lines.join(days, "l_shipdate", "left_semi")
    return offending_keys(lines, target, ["l_suppkey", "l_partkey", "l_shipdate"])
