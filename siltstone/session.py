"""Session for tests and benchmarks, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(app: str, cores: int | str = "*", **conf: str) -> SparkSession:
    """A small local session; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "512")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local folder is lost with the machine and unseen by the others.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="siltstone-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """Hadoop file system and path object for ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """Write ``df`` once to the shared folder; hand back the written rows.

    Used where a frame feeds several branches that must see the same rows. The
    files outlive a lost executor and are deleted when the block ends, so nothing
    that leaves the block may still read them.
    """
    with staged_with_size(df, measure=False) as (rows, _):
        yield rows


@contextmanager
def staged_with_size(
    df: DataFrame, measure: bool = True, partition_by: Sequence[str] = ()
) -> Iterator[tuple[DataFrame, int]]:
    """``staged``, and the decoded size of the rows in bytes, counted while they are written.

    Files may compress a hundredfold, so their size says little about the memory the rows take. With
    ``partition_by`` a reader of some values of these columns opens their folders only.
    """
    spark = df.sparkSession
    path = new_folder(spark, "stage")
    seen = Observation()
    size = F.coalesce(F.sum(sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(0))), F.lit(0))
    writer = (df.observe(seen, size.alias("bytes")) if measure else df).write
    writer.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    fs, folder = hadoop_path(spark, path)
    try:
        yield spark.read.schema(df.schema).parquet(path), int(seen.get["bytes"]) if measure else 0
    finally:
        fs.delete(folder, True)


@contextmanager
def staged_by(df: DataFrame, columns: Sequence[str]) -> Iterator[tuple[DataFrame, int]]:
    """``staged_with_size``, a big frame in folders by ``columns``, a small one in few files.

    What Spark takes for small may turn out big; it is laid anew then.
    """
    limit = broadcast_threshold(df.sparkSession)
    big = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > limit
    with ExitStack() as stack:
        rows, size = stack.enter_context(staged_with_size(df, partition_by=columns if big else ()))
        if columns and not big and size > limit:
            rows, _ = stack.enter_context(staged_with_size(rows, measure=False, partition_by=columns))
        yield rows, size


def _width(column: Column, kind: T.DataType) -> Column:
    """Bytes of a value in memory, roughly: eight, and what a text or a nested value adds."""
    if isinstance(kind, T.StructType):
        return sum((_width(column[f.name], f.dataType) for f in kind), F.lit(8))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column.alias("v")))), F.lit(0)) + 8
    return F.lit(8)


def broadcast_threshold(spark: SparkSession) -> int:
    """Spark's own limit for a side that it may broadcast, in bytes."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
