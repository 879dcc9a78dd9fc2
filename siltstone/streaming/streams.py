"""Streaming tables: file streams into Parquet tables, their union, and a streamed upsert.

Every stream runs until the input known at its start is done (``availableNow``)
and keeps its progress in a checkpoint, so a rerun takes up new files only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.columns import conform
from siltstone.operators.merge import merge
from siltstone.operators.rows import dedupe, rename, union_all
from siltstone.sources.files import REASON, RECORD, checked_csv, text_schema, without_rejects
from siltstone.sources.warehouse import Warehouse


def order_feed_schema() -> T.StructType:
    """Declared columns of the order feed files."""
    return T.StructType(
        [
            T.StructField("o_orderkey", T.IntegerType()),
            T.StructField("o_custkey", T.IntegerType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.StringType()),
            T.StructField("o_orderpriority", T.StringType()),
            T.StructField("o_clerk", T.StringType()),
            T.StructField("o_shippriority", T.StringType()),
            T.StructField("o_comment", T.StringType()),
        ]
    )


def _stream(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str, files_per_batch: int | None, **options: object
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def stream_checked_csv(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None, header: bool = True
) -> DataFrame:
    """CSV files, each taken up once, in the declared types; ``reject_reason`` and ``reject_record`` tell bad rows.

    Short rows are filled up with NULLs.
    """
    raw = _stream(spark, folder, text_schema(schema), "csv", files_per_batch, header=header)
    return checked_csv(raw, schema)


def stream_csv(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None, header: bool = True
) -> DataFrame:
    """CSV files, each taken up once; short rows are filled up, a row to be rejected fails the stream."""
    return without_rejects(stream_checked_csv(spark, folder, schema, files_per_batch, header))


def stream_table(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Rows appended to a Parquet table, such as the output of another stream."""
    return _stream(spark, folder, schema, "parquet", files_per_batch)


def stream_to_table(
    stream: DataFrame, folder: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> None:
    """Append all available input to a Parquet table, exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", folder)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_flows(streams: Sequence[DataFrame], folder: str, checkpoint: str) -> None:
    """Several streams into one table, as one query over their union.

    Two queries on one file sink would overwrite each other's log of written files.
    """
    stream_to_table(union_all(streams), folder, checkpoint)


REJECTED = "rejected"  # partition of a routed table: false for good rows, true for rejects


def route_stream(checked: DataFrame, folder: str, checkpoint: str) -> None:
    """Append good rows and rejects of a checked stream to one table, in a partition each.

    One query writes both, so a row is in exactly one of them, exactly once.
    """
    routed = checked.withColumn(REJECTED, F.col(REASON).isNotNull())
    stream_to_table(routed, folder, checkpoint, [REJECTED])


def _routed_schema(schema: T.StructType) -> T.StructType:
    told = [T.StructField(c, T.StringType()) for c in (REASON, RECORD)]
    return T.StructType([*schema.fields, *told, T.StructField(REJECTED, T.BooleanType())])


def stream_routed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Good rows appended to a routed table."""
    rows = stream_table(spark, folder, _routed_schema(schema))
    return rows.filter(~F.col(REJECTED)).select(*schema.names)


def rejects(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """(reject_reason, reject_record) of a routed table; only its rejects are scanned."""
    rows = spark.read.schema(_routed_schema(schema)).parquet(folder)
    return rows.filter(REJECTED).select(REASON, RECORD)


def stream_bronze(
    spark: SparkSession,
    file_folder: str,
    table_folder: str,
    table_schema: T.StructType,
    lake: str,
    names: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    header: bool = True,
) -> DataFrame:
    """Order files and an order table, each into its bronze table, and both into one union table.

    Both sides are brought to the declared schema before the union. Rows of the files that do not fit it
    stay in the rejects of the files' bronze table, ``orders_files_bronze``, and do not stop the others.
    """
    schema = schema or order_feed_schema()
    names = names or {"o_custkey": "customer_id_o"}
    checkpoints = f"{lake}/checkpoints"

    files = rename(stream_checked_csv(spark, file_folder, schema, header=header), names)
    files_schema = T.StructType([f for f in files.schema if f.name not in (REASON, RECORD)])
    route_stream(files, f"{lake}/orders_files_bronze", f"{checkpoints}/orders_files_bronze")

    table = rename(conform(stream_table(spark, table_folder, table_schema), schema), names)
    stream_to_table(table, f"{lake}/orders_bronze", f"{checkpoints}/orders_bronze")

    append_flows(
        [
            stream_table(spark, f"{lake}/orders_bronze", table.schema),
            stream_routed(spark, f"{lake}/orders_files_bronze", files_schema),
        ],
        f"{lake}/orders_union_bronze",
        f"{checkpoints}/orders_union_bronze",
    )
    return spark.read.schema(files_schema).parquet(f"{lake}/orders_union_bronze")


def stream_upsert(
    wh: Warehouse,
    name: str,
    stream: DataFrame,
    on: Sequence[str],
    latest: Sequence[Column],
    log: str,
    checkpoint: str,
) -> int:
    """Upsert a streamed source: log the new rows under a run number, then merge that run.

    Of several changes to a key in one run the first in the order ``latest``
    counts. The run number moves with the merge commit, so a run that died
    between the two steps is logged on and merged by the next call.
    """
    wh.create_if_absent(name, stream.schema)
    run = int(wh.properties(name).get("stream_run", 0)) + 1
    stream_to_table(stream.withColumn("__run", F.lit(run)), log, checkpoint, ["__run"])
    logged = T.StructType([*stream.schema.fields, T.StructField("__run", T.IntegerType())])
    fresh = wh.spark.read.schema(logged).parquet(log).filter(F.col("__run") == run).drop("__run")
    if fresh.isEmpty():
        return wh.version(name)
    return merge(wh, name, dedupe(fresh, on, latest), on, properties={"stream_run": str(run)})


def stream_merge(
    wh: Warehouse,
    name: str,
    stream: DataFrame,
    on: Sequence[str],
    latest: Sequence[Column],
    checkpoint: str,
    feed: str = "stream",
) -> int:
    """Upsert a streamed source batch by batch, each as one merge that notes the batch's number with its commit.

    Of several changes to a key in one batch the first in the order ``latest`` counts. A batch that died after its
    merge and before its checkpoint is given again under the same number, and is then found noted: every batch is
    merged once. ``feed`` keeps the numbers of several streams into one table apart. Nothing but the
    table is written; ``stream_upsert`` does without a callback from the JVM, but logs the rows.
    """
    wh.create_if_absent(name, stream.schema)

    def upsert(batch: DataFrame, number: int) -> None:
        merge(wh, name, dedupe(batch, on, latest), on, batch_id=f"{feed} {number}")

    query = (
        stream.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return wh.version(name)
