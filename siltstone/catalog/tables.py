"""Table life cycle and file sources over whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.catalog import query
from siltstone.catalog.fixtures import (
    BATCH_TS,
    FLAWED_SCHEMA,
    FLAWED_SQL,
    ORDER_LINES_SQL,
    flawed_lines,
    order_lines,
    table,
    warehouse,
)
from siltstone.operators.rows import union_all
from siltstone.plans.dimensions import date_dimension_schema, date_rows
from siltstone.plans.orders import cleanse_orders, order_line_schema
from siltstone.session import new_folder
from siltstone.sources.files import (
    read_csv,
    read_delimited,
    read_path_as_table,
    read_since,
    route_csv,
    write_bronze,
)
from siltstone.sources.warehouse import read_snapshot

EARLY_SQL = "o_orderdate < TIMESTAMP '1998-01-01'"


def _early() -> F.Column:
    return F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")


@query(f"""
SELECT 'before' AS state, o_orderstatus, count(*) AS row_count FROM orders WHERE {EARLY_SQL} GROUP BY ALL
UNION ALL SELECT 'now', o_orderstatus, count(*) FROM orders GROUP BY ALL""")
def version_read(spark: SparkSession, sf: str) -> DataFrame:
    wh = warehouse(spark)
    orders = table(spark, sf, "orders")
    first = wh.publish(orders.filter(_early()), "silver.orders")
    wh.append(orders.filter(~_early()), "silver.orders")
    states = [("before", wh.read("silver.orders", first)), ("now", wh.read("silver.orders"))]
    return union_all(
        [
            df.groupBy(F.lit(state).alias("state"), "o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))
            for state, df in states
        ]
    )


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def append_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Each batch is sent twice and counts once."""
    wh = warehouse(spark)
    orders = table(spark, sf, "orders")
    for name, part in [("early", orders.filter(_early())), ("late", orders.filter(~_early()))]:
        for _ in range(2):
            wh.append(part.drop("o_orderdate"), "bronze.orders", batch_id=name)
    return wh.read("bronze.orders")


@query(f"SELECT o_orderkey, o_custkey FROM orders WHERE NOT ({EARLY_SQL})")
def landing_replaced(spark: SparkSession, sf: str) -> DataFrame:
    wh = warehouse(spark)
    orders = table(spark, sf, "orders")
    wh.replace_landing(orders.filter(_early()).select("o_orderkey", "o_custkey"), "landing.orders")
    wh.replace_landing(orders.filter(~_early()).select("o_orderkey", "o_custkey"), "landing.orders")
    return wh.read("landing.orders")


@query(f"""
SELECT o_orderkey, o_custkey, CASE WHEN NOT ({EARLY_SQL}) THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def schema_widened(spark: SparkSession, sf: str) -> DataFrame:
    """A column that a later batch brings is NULL in the rows before it."""
    wh = warehouse(spark)
    orders = table(spark, sf, "orders")
    wh.publish(orders.filter(_early()).select("o_orderkey", "o_custkey"), "silver.orders")
    late = orders.filter(~_early()).select("o_orderkey", "o_custkey", "o_orderpriority")
    wh.append(late, "silver.orders", merge_schema=True)
    return wh.read("silver.orders")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def table_cloned(spark: SparkSession, sf: str) -> DataFrame:
    """The copy keeps its rows when the original is changed and cloned again."""
    wh = warehouse(spark)
    wh.create_namespace("etl")
    wh.publish(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "etl.customer")
    wh.clone("etl.customer", "bronze.customer_raw")
    wh.delete_where("etl.customer", F.col("c_mktsegment") == "BUILDING")
    wh.clone("etl.customer", "bronze.customer_raw")
    return wh.read("bronze.customer_raw")


@query("""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS DateKey, CAST(year(o_orderdate) AS INTEGER) AS "Year",
       'gold' AS quality FROM orders""")
def declared_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table declared with NOT NULL columns and a quality tier, then filled."""
    wh = warehouse(spark)
    wh.create_if_absent("gold.dates", date_dimension_schema(), properties={"quality": "gold"})
    wh.append(date_rows(table(spark, sf, "orders"), "o_orderdate"), "gold.dates")
    wh.create_if_absent("gold.dates", date_dimension_schema(), properties={"quality": "ignored"})
    quality = wh.properties("gold.dates")["quality"]
    return wh.read("gold.dates").select("DateKey", "Year", F.lit(quality).alias("quality"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-30'")
def rows_since_mark(spark: SparkSession, sf: str) -> DataFrame:
    fresh = read_since(table(spark, sf, "orders"), "o_orderdate", "1999-06-30")
    return fresh.select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def path_as_table(spark: SparkSession, sf: str) -> DataFrame:
    path = write_bronze(table(spark, sf, "part"), new_folder(spark, "lake"), "part")
    parts = read_path_as_table(spark, path)
    return parts.select("p_partkey", "p_name", "p_retailprice")


@query(f"""
WITH {ORDER_LINES_SQL}
SELECT OrderNumber, LineNumber, OrderDate, Email, Item, Qty, UnitPrice,
       CASE WHEN CustomerName = '' THEN 'Unknown' ELSE CustomerName END AS CustomerName,
       CASE WHEN UnitPrice > 1500 THEN 'Big' WHEN UnitPrice > 800 THEN 'Medium' ELSE 'Small' END AS BucketSize,
       '' AS update_status, 'csv' AS file_kind, DATE '2024-01-01' AS created
FROM lines""")
def csv_cleansed(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines through CSV files, read by glob with the declared schema, and cleansed."""
    folder = new_folder(spark, "drop")
    columns = order_line_schema().names
    order_lines(spark, sf).select(columns).write.option("header", True).csv(folder)
    silver = cleanse_orders(read_csv(spark, f"{folder}/*.csv", order_line_schema()), BATCH_TS)
    return silver.select(
        *(c for c in columns if c != "Tax"),
        "BucketSize",
        "update_status",
        F.substring_index("SoureFile", ".", -1).alias("file_kind"),
        F.to_date("CreationTimeStamp").alias("created"),
    )


@query(f"""
WITH {FLAWED_SQL}
SELECT CAST(sent_key AS VARCHAR) AS sent_key, CAST(o_custkey AS VARCHAR) AS sent_customer,
       CASE WHEN flaw IN (0, 1) THEN CAST(o_orderkey AS INTEGER) END AS o_orderkey,
       CASE WHEN flaw = 0 THEN o_totalprice END AS o_totalprice,
       CASE flaw WHEN 2 THEN 'o_orderkey is no int' WHEN 3 THEN 'o_totalprice is no double'
                 WHEN 4 THEN 'more fields than columns' END AS reject_reason
FROM feed""")
def csv_routed(spark: SparkSession, sf: str) -> DataFrame:
    """A feed with flaws, its good rows and its rejects side by side; short rows are good ones."""
    folder = new_folder(spark, "flawed")
    flawed_lines(spark, sf).write.text(folder)
    good, rejects = route_csv(spark, folder, FLAWED_SCHEMA, header=False)
    sent = F.split("reject_record", ",")
    return union_all(
        [
            good.select(
                F.col("o_orderkey").cast("string").alias("sent_key"),
                F.col("o_custkey").cast("string").alias("sent_customer"),
                "o_orderkey",
                "o_totalprice",
                F.lit(None).cast("string").alias("reject_reason"),
            ),
            rejects.select(
                sent[0].alias("sent_key"),
                sent[1].alias("sent_customer"),
                F.lit(None).cast("int").alias("o_orderkey"),
                F.lit(None).cast("double").alias("o_totalprice"),
                "reject_reason",
            ),
        ]
    )


@query("""
SELECT CAST(event_id AS INTEGER) AS id, event_type AS kind, props AS properties,
       TRY_CAST(event_type AS INTEGER) AS not_a_number FROM events""")
def delimited_mapped(spark: SparkSession, sf: str) -> DataFrame:
    """Text with quotes and commas inside, renamed and typed; what does not convert is NULL."""
    folder = new_folder(spark, "export")
    events = table(spark, sf, "events").select("event_id", "event_type", "props")
    events.write.option("header", True).option("escape", "\\").csv(folder)
    return read_delimited(
        spark,
        folder,
        [
            ("event_id", "id", "int"),
            ("event_type", "kind", "string"),
            ("props", "properties", "string"),
            ("event_type", "not_a_number", "int"),
        ],
    )


@query("""
SELECT CAST(event_id AS INTEGER) AS id, event_type AS kind, value FROM events""")
def marked_files_mapped(spark: SparkSession, sf: str) -> DataFrame:
    """Text files that each begin with a byte-order mark, read by their plain column names."""
    folder = new_folder(spark, "marked")
    events = table(spark, sf, "events").select("event_id", "event_type", "value").repartition(3)
    # The header line starts with the first column's name, so the mark in it starts the file.
    events.withColumnRenamed("event_id", "\ufeffevent_id").write.option("header", True).csv(folder)
    mapping = [("event_id", "id", "int"), ("event_type", "kind", "string"), ("value", "value", "double")]
    return read_delimited(spark, folder, mapping, strict=True)


@query(f"""
SELECT 'before' AS state, o_orderkey, o_totalprice FROM orders WHERE {EARLY_SQL}
UNION ALL SELECT 'now', o_orderkey, o_totalprice FROM orders""")
def snapshot_by_path(spark: SparkSession, sf: str) -> DataFrame:
    """A table addressed by its path alone, as it is and as it was before the last batch."""
    wh = warehouse(spark)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    first = wh.publish(orders.filter(_early()).drop("o_orderdate"), "gold.orders")
    wh.append(orders.filter(~_early()).drop("o_orderdate"), "gold.orders")
    path = wh.path("gold.orders")
    states = {"before": read_snapshot(spark, path, first), "now": read_snapshot(spark, path)}
    return union_all([df.select(F.lit(state).alias("state"), "o_orderkey", "o_totalprice") for state, df in states.items()])


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS _c0, o_orderstatus AS _c1, o_orderpriority AS _c2 FROM orders""")
def csv_path_as_table(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of CSV files scanned by its path; columns are positions, values are text."""
    path = new_folder(spark, "export")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.csv(path)
    return read_path_as_table(spark, path, "csv")


@query("SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS last_key FROM orders GROUP BY 1")
def table_as_view(spark: SparkSession, sf: str) -> DataFrame:
    wh = warehouse(spark)
    wh.publish(table(spark, sf, "orders"), "bronze.orders", ["o_orderstatus"])
    view = wh.register_view("bronze.orders", f"orders_{id(wh)}")
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS last_key FROM {view} GROUP BY 1")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def dropped_and_published_again(spark: SparkSession, sf: str) -> DataFrame:
    """After a drop the name is free for a table of another shape."""
    wh = warehouse(spark)
    wh.publish(table(spark, sf, "customer"), "gold.things", ["c_mktsegment"])
    wh.drop("gold.things")
    if wh.exists("gold.things"):
        raise AssertionError("the table is still there")
    wh.publish(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "gold.things")
    return wh.read("gold.things")
