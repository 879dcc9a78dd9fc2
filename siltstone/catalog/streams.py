"""Streaming queries, run to the end of the input at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.catalog import query
from siltstone.catalog.fixtures import (
    BATCH_TS,
    FLAWED_SCHEMA,
    FLAWED_SQL,
    customer_bronze,
    flawed_lines,
    table,
    warehouse,
)
from siltstone.functions.columns import conform
from siltstone.plans.orders import gold_segment_counts
from siltstone.session import new_folder
from siltstone.streaming.streams import (
    order_feed_schema,
    rejects,
    stream_bronze,
    stream_merge,
    stream_table,
    stream_upsert,
)


def _split_feed(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Orders before 1998 as CSV files, the others as a table; returns the table part."""
    orders = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    feed = conform(orders.filter(early), order_feed_schema())
    feed.write.mode("append").option("header", True).csv(f"{folder}/files")
    late = orders.filter(~early)
    late.write.mode("append").parquet(f"{folder}/table")
    return late


def _union_table(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "stream")
    late = _split_feed(spark, sf, folder)
    for _ in range(2):  # the second run finds no new file
        union = stream_bronze(spark, f"{folder}/files", f"{folder}/table", late.schema, f"{folder}/lake")
    return union


@query("""
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS customer_id_o, o_orderstatus,
       o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM orders""")
def stream_union(spark: SparkSession, sf: str) -> DataFrame:
    return _union_table(spark, sf).drop("o_clerk", "o_shippriority", "o_comment")


@query("""
SELECT c_mktsegment, CAST(count(o_orderkey) AS BIGINT) AS total_orders
FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def stream_segment_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The gold counts, recomputed from the streamed union table."""
    gold = gold_segment_counts(_union_table(spark, sf), customer_bronze(spark, sf), BATCH_TS)
    return gold.drop("insert_timestamp")


@query(f"""
WITH {FLAWED_SQL},
late AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS sent_key, CAST(o_custkey AS INTEGER) AS customer_id_o, o_totalprice, NULL AS reject_reason
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT CAST(sent_key AS VARCHAR) AS sent_key, CASE WHEN flaw < 2 THEN CAST(o_custkey AS INTEGER) END AS customer_id_o,
       CASE WHEN flaw = 0 THEN o_totalprice END AS o_totalprice,
       CASE flaw WHEN 2 THEN 'o_orderkey is no int' WHEN 3 THEN 'o_totalprice is no double'
                 WHEN 4 THEN 'more fields than columns' END AS reject_reason
FROM feed UNION ALL SELECT * FROM late""")
def stream_routed(spark: SparkSession, sf: str) -> DataFrame:
    """Files with flaws and a table, streamed into one table, and the rejects of the files beside it."""
    folder = new_folder(spark, "stream")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    orders.filter(late).drop("o_orderdate").write.parquet(f"{folder}/table")
    flawed_lines(spark, sf).write.text(f"{folder}/files")
    schema = T.StructType.fromDDL(FLAWED_SCHEMA)
    for _ in range(2):  # the second run finds no new file
        union = stream_bronze(
            spark, f"{folder}/files", f"{folder}/table", orders.drop("o_orderdate").schema, f"{folder}/lake",
            schema=schema, header=False,
        )
    bad = rejects(spark, f"{folder}/lake/orders_files_bronze", union.schema)
    return union.select(
        F.col("o_orderkey").cast("string").alias("sent_key"), "customer_id_o", "o_totalprice",
        F.lit(None).cast("string").alias("reject_reason"),
    ).unionByName(
        bad.select(
            F.split("reject_record", ",")[0].alias("sent_key"), F.lit(None).cast("int").alias("customer_id_o"),
            F.lit(None).cast("double").alias("o_totalprice"), "reject_reason",
        )
    )


UPSERTED_SQL = """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate >= TIMESTAMP '1998-01-01' DESC, o_totalprice DESC, o_orderkey DESC) = 1"""


@query(UPSERTED_SQL)
def stream_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The same by one merge a batch, without a log of the rows."""
    wh = warehouse(spark)
    folder = new_folder(spark, "stream")
    orders = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    columns = ["o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"]
    for part in [early, ~early, None]:
        if part is not None:
            orders.filter(part).select(columns).write.mode("append").parquet(f"{folder}/in")
        stream = stream_table(spark, f"{folder}/in", orders.select(columns).schema)
        stream_merge(
            wh, "silver.latest", stream, ["o_custkey"], [F.desc("o_totalprice"), F.desc("o_orderkey")],
            f"{folder}/checkpoint",
        )
    return wh.read("silver.latest")


@query(UPSERTED_SQL)
def stream_upserted(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's dearest order of the last run that had one; a third run has no input."""
    wh = warehouse(spark)
    folder = new_folder(spark, "stream")
    orders = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    columns = ["o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"]
    for part in [early, ~early, None]:
        if part is not None:
            orders.filter(part).select(columns).write.mode("append").parquet(f"{folder}/in")
        stream = stream_table(spark, f"{folder}/in", orders.select(columns).schema)
        stream_upsert(
            wh, "silver.latest", stream, ["o_custkey"], [F.desc("o_totalprice"), F.desc("o_orderkey")],
            f"{folder}/log", f"{folder}/checkpoint",
        )
    return wh.read("silver.latest")
