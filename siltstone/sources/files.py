"""File and database sources, and the plain Parquet lake sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_path_as_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SQL scan of a path; backticks in the path are doubled so it stays one name."""
    quoted = path.replace("`", "``")
    return spark.sql(f"SELECT * FROM {fmt}.`{quoted}`")


#: Columns that a checked CSV scan adds: what is wrong with a row (NULL: nothing), and the fields of a row that is wrong.
REASON, RECORD = "reject_reason", "reject_record"
_SURPLUS = "__surplus"


def text_schema(schema: T.StructType) -> T.StructType:
    """All declared columns as text, and one more that only a row with too many fields fills."""
    return T.StructType([T.StructField(name, T.StringType()) for name in [*schema.names, _SURPLUS]])


def checked_csv(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows read with ``text_schema`` in their declared types, with ``REASON`` and ``RECORD``.

    A row that ends early has NULLs in the columns it lacks, and an empty field is a NULL. A value that does not fit
    its type and a field too many are reasons to reject the row; ``RECORD`` keeps all its
    fields as text, so nothing is lost.
    """
    typed, reasons = [], [F.when(F.col(_SURPLUS).isNotNull(), F.lit("more fields than columns"))]
    for field in schema.fields:
        text = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            typed.append(text)
            continue
        value = text.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        fits = value.isNotNull() | text.isNull() | (text == "")
        reasons.append(F.when(~fits, F.lit(f"{field.name} is no {field.dataType.simpleString()}")))
    reason = F.nullif(F.concat_ws("; ", *reasons), F.lit(""))
    record = F.when(reason.isNotNull(), F.to_csv(F.struct(*(F.col(f"`{c}`") for c in raw.columns))))
    return raw.select(*typed, reason.alias(REASON), record.alias(RECORD))


def without_rejects(checked: DataFrame) -> DataFrame:
    """The rows of a checked scan, failing where one was to be rejected."""
    told = F.concat_ws(": ", F.lit("MALFORMED row"), F.col(REASON), F.col(RECORD))
    whole = F.when(F.col(REASON).isNotNull(), F.raise_error(told).cast("boolean")).otherwise(True)
    return checked.filter(whole).drop(REASON, RECORD)


def _declared(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _scan_csv(spark: SparkSession, glob: str, schema: T.StructType, header: bool) -> DataFrame:
    return checked_csv(spark.read.schema(text_schema(schema)).option("header", header).csv(glob), schema)


def read_csv(spark: SparkSession, glob: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV drop zone with a declared schema; short rows are filled up, a row to be rejected fails the read."""
    return without_rejects(_scan_csv(spark, glob, _declared(schema), header))


def route_csv(
    spark: SparkSession, glob: str, schema: T.StructType | str, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The good rows of a CSV drop zone in their declared types, and its rejects.

    Rejects have the file, the reason and the record. Both read the files by themselves, each all of them.
    """
    checked = _scan_csv(spark, glob, _declared(schema), header)
    good = checked.filter(F.col(REASON).isNull()).drop(REASON, RECORD)
    rejects = with_source_file(checked, "source_file").filter(F.col(REASON).isNotNull())
    return good, rejects.select("source_file", REASON, RECORD)


def read_delimited(
    spark: SparkSession,
    path: str,
    mapping: Sequence[tuple[str, str, str]],
    strict: bool = False,
) -> DataFrame:
    """Comma separated text with a header, ``"`` quotes and ``\\`` escapes.

    ``mapping`` lists (source column, target column, type). A value that does
    not convert becomes NULL, or fails the read when ``strict``. A leading
    byte-order mark is skipped by the reader.
    """
    raw = (
        spark.read.option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", "\\")
        .csv(path)
    )
    convert = Column.cast if strict else Column.try_cast
    return raw.select(*(convert(F.col(f"`{src}`"), dtype).alias(dst) for src, dst, dtype in mapping))


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    split: tuple[str, str, str, int],
    **options: str,
) -> DataFrame:
    """Database table, read in parallel by ``split`` = (column, lower, upper, readers).

    Filters put on the result, such as a watermark, are pushed into the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    column, lower, upper, readers = split
    return (
        reader.option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", readers)
        .load()
    )


def read_since(df: DataFrame, column: str, watermark: object | None) -> DataFrame:
    """Rows strictly above the watermark, which is typed by the column; all rows when it is NULL.

    A mark of a zoned timestamp is a number of microseconds since 1970, which no session zone changes.
    """
    if watermark is None:
        return df
    if isinstance(df.schema[column].dataType, T.TimestampType) and str(watermark).lstrip("-").isdigit():
        return df.filter(F.col(column) > F.timestamp_micros(F.lit(int(str(watermark)))))
    return df.filter(F.col(column) > F.lit(watermark).cast(df.schema[column].dataType))


def with_source_file(df: DataFrame, column: str = "SoureFile") -> DataFrame:
    return df.withColumn(column, F.col("_metadata.file_path"))


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite a snappy Parquet directory that the plan does not read."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_bronze(df: DataFrame, lake: str, name: str) -> str:
    """Lake copy of a table in a folder of its own name."""
    path = f"{lake.rstrip('/')}/{name}"
    write_parquet(df, path)
    return path
