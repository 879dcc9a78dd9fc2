"""Queries over single operators: joins, classification, aggregates, scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.catalog import query
from siltstone.catalog.fixtures import (
    BATCH_TS,
    CUSTOMER_YEARS_SQL,
    SALES_SQL,
    YEARS,
    customer_bronze,
    customer_years,
    orders_bronze,
    sales_feed,
    split_into_batches,
    table,
    warehouse,
)
from siltstone.functions.columns import (
    bucketize,
    date_parts,
    default_if_blank,
    line_total,
    name_parts,
    piece,
)
from siltstone.operators.keys import RANK, ranked
from siltstone.operators.rows import (
    classify_changes,
    dedupe,
    grain_violations,
    group_counts,
    max_key,
    members,
    new_rows,
    preview,
    split_changes,
    union_all,
)
from siltstone.plans.facts import Dimension, lookup_keys
from siltstone.plans.ingest import next_watermark
from siltstone.plans.orders import (
    counts_by_status,
    gold_segment_counts,
    load_gold_by_status,
    orders_staging,
    revenue_by_year_category,
)
from siltstone.session import new_folder
from siltstone.sources.files import write_parquet

GOLD_SQL = """
SELECT c_mktsegment, CAST(count(o_orderkey) AS BIGINT) AS total_orders
FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"""


@query(GOLD_SQL)
def segment_counts(spark: SparkSession, sf: str) -> DataFrame:
    gold = gold_segment_counts(orders_bronze(spark, sf), customer_bronze(spark, sf), BATCH_TS)
    return gold.drop("insert_timestamp")


@query("""
SELECT o_orderstatus, c_mktsegment, CAST(count(o_orderkey) AS BIGINT) AS total_orders
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus IN ('O', 'F', 'P') GROUP BY ALL""")
def segment_counts_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return counts_by_status(orders_bronze(spark, sf), customer_bronze(spark, sf), "O,F,P")


@query("""
SELECT 'orders_gold_aggregations_' || o_orderstatus AS gold_table, c_mktsegment,
       CAST(count(o_orderkey) AS BIGINT) AS total_orders
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus IN ('O', 'F', 'P') GROUP BY ALL""")
def gold_tables_by_status(spark: SparkSession, sf: str) -> DataFrame:
    orders, customers = orders_bronze(spark, sf), customer_bronze(spark, sf)
    tables = load_gold_by_status(warehouse(spark), "gold.by_status", orders, customers, "O,F,P", BATCH_TS)
    return union_all(
        [t.select(F.lit(name).alias("gold_table"), "c_mktsegment", "total_orders") for name, t in tables.items()]
    )


@query("""
SELECT o_orderkey, o_custkey AS customer_id_o, c_custkey AS customer_id_c, o_orderstatus,
       o_orderpriority, c_name, c_mktsegment, DATE '2024-01-01' AS inserted
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def orders_enriched(spark: SparkSession, sf: str) -> DataFrame:
    staging = orders_staging(orders_bronze(spark, sf), customer_bronze(spark, sf), BATCH_TS)
    return staging.select(
        "o_orderkey",
        "customer_id_o",
        "customer_id_c",
        "o_orderstatus",
        "o_orderpriority",
        "c_name",
        "c_mktsegment",
        F.to_date("insert_timestamp").alias("inserted"),
    )


@query(f"""
WITH {SALES_SQL}
SELECT "Year", split_part(Model_ID, '#', 1) AS Model_Category,
       CAST(sum(Revenue * Units_Sold) AS BIGINT) AS Total_Revenue
FROM sales GROUP BY ALL""")
def revenue_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return revenue_by_year_category(sales_feed(spark, sf), separator="#")


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS y, split_part(o_orderpriority, '-', 1) AS Model_Category,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT) * 2) AS BIGINT) AS Total_Revenue
FROM orders GROUP BY ALL""")
def revenue_by_year_priority(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("y"),
        "o_orderpriority",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        F.lit(2).alias("units"),
    )
    return revenue_by_year_category(orders, "o_orderpriority", "-", "y", "cents", "units")


@query("""
SELECT CASE WHEN l_extendedprice > 75000 THEN 'Big' WHEN l_extendedprice > 40000 THEN 'Medium'
            ELSE 'Small' END AS BucketSize, l_returnflag, count(*) AS row_count
FROM lineitem GROUP BY ALL""")
def order_buckets(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn(
        "BucketSize", bucketize(F.col("l_extendedprice"), [(75000, "Big"), (40000, "Medium")], "Small")
    )
    return group_counts(lines, ["BucketSize", "l_returnflag"])


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Unknown' ELSE c_name END
       AS CustomerName FROM customer""")
def blank_names_defaulted(spark: SparkSession, sf: str) -> DataFrame:
    name = (
        F.when(F.col("c_mktsegment") == "BUILDING", "")
        .when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name"))
    )
    return table(spark, sf, "customer").select(
        "c_custkey", default_if_blank(name, "Unknown").alias("CustomerName")
    )


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def grain_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return grain_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT l_suppkey, l_partkey, count(*) AS row_count FROM lineitem GROUP BY ALL")
def two_key_counts(spark: SparkSession, sf: str) -> DataFrame:
    return group_counts(table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"])


@query("SELECT DISTINCT s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey"
       " JOIN lineitem ON l_suppkey = s_suppkey")
def distinct_members(spark: SparkSession, sf: str) -> DataFrame:
    sales = sales_feed(spark, sf)
    return members(sales, ["BranchName", "DealerName"]).toDF("s_name", "n_name")


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    latest = dedupe(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return latest.select("o_custkey", "o_orderkey", "o_totalprice")


@query("""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def top_orders_preview(spark: SparkSession, sf: str) -> DataFrame:
    return preview(
        table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
        100,
        [F.desc("o_totalprice"), F.asc("o_orderkey")],
    )


# Every customer's attribute of a year against that of the year before.
CHANGES_SQL = f"""
WITH {CUSTOMER_YEARS_SQL},
tagged AS (
  SELECT new.o_custkey, new.y, new.attr, old.attr AS attr_Sink,
         CASE WHEN old.o_custkey IS NULL THEN 'New Record'
              WHEN new.attr IS DISTINCT FROM old.attr THEN 'Updated Record'
              ELSE 'Rejected Records' END AS Dataset_Filtering
  FROM src new LEFT JOIN src old ON new.o_custkey = old.o_custkey AND new.y = old.y + 1)"""


def _year_before(years: DataFrame) -> DataFrame:
    return years.withColumn("y", F.col("y") + 1)


def _all_years(spark: SparkSession, sf: str) -> DataFrame:
    years = customer_years(spark, sf)
    return classify_changes(years, _year_before(years), ["o_custkey", "y"], ["attr"])


@query(f"{CHANGES_SQL} SELECT * FROM tagged")
def changes_classified(spark: SparkSession, sf: str) -> DataFrame:
    return _all_years(spark, sf)


@query(f"""{CHANGES_SQL}
SELECT o_custkey, y, attr, 'new' AS route FROM tagged WHERE Dataset_Filtering = 'New Record'
UNION ALL
SELECT o_custkey, y, attr, 'updated' FROM tagged WHERE Dataset_Filtering = 'Updated Record'""")
def changes_routed(spark: SparkSession, sf: str) -> DataFrame:
    new, updated = split_changes(_all_years(spark, sf))
    return union_all(
        [
            new.select("o_custkey", "y", "attr", F.lit("new").alias("route")),
            updated.select("o_custkey", "y", "attr", F.lit("updated").alias("route")),
        ]
    )


@query(f"""
WITH {CUSTOMER_YEARS_SQL}
SELECT o_custkey, y, attr FROM src a
WHERE NOT EXISTS (SELECT 1 FROM src b WHERE a.y = b.y + 1 AND a.o_custkey = b.o_custkey AND a.attr = b.attr)""")
def rows_not_in_target(spark: SparkSession, sf: str) -> DataFrame:
    years = customer_years(spark, sf)
    return new_rows(years, _year_before(years), ["o_custkey", "attr", "y"]).select("o_custkey", "y", "attr")


@query("""
SELECT o_orderkey, c_name, c_mktsegment, n_name FROM orders
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def star_lookup(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    found = lookup_keys(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        [
            Dimension(customer, {"o_custkey": "c_custkey"}, ["c_name", "c_mktsegment", "c_nationkey"]),
            Dimension(nation, {"c_nationkey": "n_nationkey"}, ["n_name"]),
        ],
    )
    return found.drop("o_custkey", "c_nationkey")


@query("""
WITH grain AS (SELECT l_suppkey, l_partkey, CAST(min(l_orderkey) AS BIGINT) AS first_order
               FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_quantity, first_order
FROM lineitem LEFT JOIN grain USING (l_suppkey, l_partkey)""")
def composite_key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    grain = lines.groupBy("l_suppkey", "l_partkey").agg(F.min("l_orderkey").alias("first_order"))
    dim = Dimension(grain, {"l_suppkey": "l_suppkey", "l_partkey": "l_partkey"}, ["first_order"])
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_partkey"]
    return lookup_keys(lines.select(columns), [dim]).drop("l_suppkey", "l_partkey")


@query("""
SELECT p_partkey, split_part(p_name, ' ', 1) AS FirstName, split_part(p_name, ' ', 2) AS LastName,
       nullif(split_part(p_brand, ' ', 2), '') AS SecondWord FROM part""")
def names_split(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").withColumns(name_parts(F.col("p_name")))
    return parts.select("p_partkey", "FirstName", "LastName", piece(F.col("p_brand"), " ", 1).alias("SecondWord"))


@query("""
SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS "Day", CAST(month(o_orderdate) AS INTEGER) AS "Month",
       CAST(year(o_orderdate) AS INTEGER) AS "Year", strftime(o_orderdate, '%b-%Y') AS mmmyyyy,
       strftime(o_orderdate, '%Y-%m') AS yyyymm FROM orders""")
def order_date_parts(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", *(v.alias(c) for c, v in date_parts(F.col("o_orderdate")).items()))


@query(f"""
WITH {SALES_SQL} SELECT l_orderkey, l_linenumber, Revenue * Units_Sold AS Total_Revenue FROM sales""")
def line_totals(spark: SparkSession, sf: str) -> DataFrame:
    return sales_feed(spark, sf).select(
        "l_orderkey", "l_linenumber", line_total("Revenue", "Units_Sold").alias("Total_Revenue")
    )


@query("""
SELECT 'orders' AS table_name, CAST(max(o_orderkey) AS BIGINT) AS high FROM orders
UNION ALL SELECT 'part', CAST(max(p_partkey) AS BIGINT) FROM part
UNION ALL SELECT 'nothing', CAST(0 AS BIGINT)""")
def key_high_marks(spark: SparkSession, sf: str) -> DataFrame:
    orders, part = table(spark, sf, "orders"), table(spark, sf, "part")
    marks = [
        ("orders", max_key(orders, "o_orderkey")),
        ("part", max_key(part, "p_partkey")),
        ("nothing", max_key(part.filter("p_partkey IS NULL"), "p_partkey")),
    ]
    return spark.createDataFrame(marks, "table_name string, high long")


@query("""
SELECT 'orders' AS table_name, strftime(max(o_orderdate), '%Y-%m-%d') AS mark FROM orders
UNION ALL SELECT 'lineitem', strftime(max(l_shipdate), '%Y-%m-%d') FROM lineitem""")
def next_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    marks = [
        ("orders", next_watermark(orders, "o_orderdate")[:10]),
        ("lineitem", next_watermark(lines, "l_shipdate")[:10]),
    ]
    return spark.createDataFrame(marks, "table_name string, mark string")


@query("""
SELECT o_custkey, c_mktsegment, row_number() OVER (ORDER BY o_custkey) AS member_rank
FROM (SELECT DISTINCT o_custkey FROM orders) JOIN customer ON o_custkey = c_custkey""")
def dense_keys(spark: SparkSession, sf: str) -> DataFrame:
    buyers = members(table(spark, sf, "orders"), ["o_custkey"])
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    joined = buyers.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    path = new_folder(spark, "ranks")
    with ranked(joined, ["o_custkey"]) as (rows, _):
        write_parquet(rows.withColumnRenamed(RANK, "member_rank"), path)
    return spark.read.parquet(path)


@query(f"""
WITH {CUSTOMER_YEARS_SQL} SELECT o_custkey, attr, y FROM src""")
def yearly_members(spark: SparkSession, sf: str) -> DataFrame:
    batch = split_into_batches(customer_years(spark, sf), "y", YEARS)
    return union_all([batch(y) for y in YEARS])
