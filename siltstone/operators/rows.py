"""Joins, aggregates and row selection that the loads are made of."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.columns import differs, keyed_by, with_null_safe_keys
from siltstone.session import new_folder

NEW, UPDATED, REJECTED = "New Record", "Updated Record", "Rejected Records"
CHANGE = "Dataset_Filtering"


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows; halves are put together, as a chain of many frames takes long to plan."""
    if len(frames) <= 2:
        return reduce(DataFrame.unionByName, frames)
    half = len(frames) // 2
    return union_all(frames[:half]).unionByName(union_all(frames[half:]))


def preview(df: DataFrame, n: int, order_by: Sequence[Column]) -> DataFrame:
    """First ``n`` rows of a stated order; each task keeps only its own first ``n``."""
    return df.orderBy(*order_by).limit(n)


# -- aggregates -------------------------------------------------------------


def members(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def unique_members(df: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Distinct members, failing where one key comes with two attribute sets.

    The first distinct is a hash aggregate that shrinks each task's rows to the
    members before any shuffle; only members reach the grouping by key.
    """
    grouped = (
        members(df, [*keys, *attrs])
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*attrs)).alias("__attrs"))
    )
    one = F.when(
        F.col("__n") > 1, F.raise_error(F.lit(f"one {'/'.join(keys)} has several {'/'.join(attrs)}"))
    ).otherwise(F.col("__attrs"))
    return grouped.withColumn("__attrs", one).select(*keys, *(f"__attrs.{a}" for a in attrs))


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first of ``order_by``, or any row where no order is given.

    ``row_number() <= 1`` is cut inside each map task before the shuffle, so a
    hot key sends one row per task.
    """
    if not order_by:
        return df.dropDuplicates(list(keys))
    ordered = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(ordered)).filter("__rn <= 1").drop("__rn")


def group_counts(df: DataFrame, keys: Sequence[str], alias: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def grain_violations(df: DataFrame, grain: Sequence[str], alias: str = "row_count") -> DataFrame:
    """Keys of a supposed grain that occur more than once."""
    return group_counts(df, grain, alias).filter(F.col(alias) > 1)


def max_value(df: DataFrame, column: str) -> object | None:
    """One scalar on the driver: the largest value of a column, None when there is none."""
    return df.agg(F.max(column)).first()[0]


def max_key(df: DataFrame, column: str) -> int:
    return max_value(df, column) or 0


# -- joins ------------------------------------------------------------------


def current(dim: DataFrame, end: str = "End_Time") -> DataFrame:
    """Open versions of a type 2 dimension."""
    return dim.filter(F.col(end).isNull())


def lookup(fact: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Sequence[str]) -> DataFrame:
    """Left join of some dimension columns; ``on`` maps fact columns to dimension columns.

    No broadcast is forced: Spark broadcasts a dimension below its size
    threshold and otherwise sorts and splits hot fact keys at run time.
    """
    side = dim.select(
        *(F.col(d).alias(f"__dim{i}") for i, d in enumerate(on.values())), *take
    )
    match = [F.col(f).eqNullSafe(F.col(f"__dim{i}")) for i, f in enumerate(on)]
    return fact.join(side, reduce(Column.__and__, match), "left").drop(
        *(f"__dim{i}" for i in range(len(on)))
    )


def seen_keys(source: DataFrame, target: DataFrame, keys: Sequence[str], take: Sequence[str] = ()) -> DataFrame:
    """Key columns (and ``take``) of the target rows whose key the source holds.

    The target is scanned for its keys only. A small source is broadcast, so a
    big target is not shuffled; a hot target key sits on the left of a semi
    join, where run-time skew handling can split it.
    """
    left, names, given = keyed_by(target.select(*keys, *(c for c in take if c not in keys)), keys)
    right, _ = with_null_safe_keys(source.select(*keys), keys)
    return left.join(right.select(*names), names, "left_semi").select(*(given[c] for c in [*keys, *take]))


def without_keys(source: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not among the ``seen`` ones."""
    left, names, given = keyed_by(source, keys)
    right, _ = with_null_safe_keys(seen.select(*keys), keys)
    return left.join(right.select(*names), names, "left_anti").select(*given.values())


_HASH = "__hash"


def _found(held: DataFrame, source: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of ``held`` whose key the source holds, dealt anew by the key when they are joined next.

    The source's keys are made distinct in the map tasks, so a hot one costs a row per task, and a small
    set of them is broadcast: a big target is not shuffled then. The hash beside the key keeps the result from
    counting as dealt by the key. What joins it next gets a plain shuffle on both sides, and only
    there run-time skew handling splits a hot key.
    """
    hashed = F.xxhash64(*names)
    wanted = members(source.select(*names, hashed.alias(_HASH)), [_HASH, *names])
    return held.withColumn(_HASH, hashed).join(wanted, [_HASH, *names], "left_semi").drop(_HASH)


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is absent from the target; a NULL key equals a NULL key.

    The keys that both sides hold are found first, then the source is joined with them only. A
    source key that a third of the rows share is split among tasks. The target is expected to hold
    each key about once, as a dimension does; ``merge`` also takes on hot ones.
    """
    left, names = with_null_safe_keys(source, keys)
    held, _ = with_null_safe_keys(target.select(*keys), keys)
    return left.join(_found(held.select(*names), left, names), names, "left_anti").drop(*names)


def classify_changes(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Tag each source row New, Updated or Rejected against the target.

    The target's attributes come along as ``<name>_Sink`` and its ``carry``
    columns under their own names, NULL for new rows. The target is reduced to
    the keys at hand first, so a small source never shuffles a big target. A source key that many
    rows share is split among tasks; the target holds each key once.
    """
    tagged, names = with_null_safe_keys(source.select(*keys, *attrs), keys)
    held, _ = with_null_safe_keys(target.select(*keys, *attrs, *carry), keys)
    found = _found(held, tagged, names).select(
        *names,
        *(F.col(a).alias(f"{a}_Sink") for a in attrs),
        *carry,
        F.lit(True).alias("__held"),
    )
    kind = (
        F.when(F.col("__held").isNull(), NEW)
        .when(differs((F.col(a), F.col(f"{a}_Sink")) for a in attrs), UPDATED)
        .otherwise(REJECTED)
    )
    return (
        tagged.join(found, names, "left").withColumn(CHANGE, kind).drop(*names, "__held")
    )


def split_changes(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New and updated rows of a classified frame.

    The frame is computed once and written by kind; each route reads its own folder.
    """
    spark = classified.sparkSession
    path = new_folder(spark, "routes")
    routed = classified.filter(F.col(CHANGE).isin(NEW, UPDATED))
    routed.write.partitionBy(CHANGE).parquet(path)
    rows = spark.read.schema(classified.schema).parquet(path)
    return (
        rows.filter(F.col(CHANGE) == NEW).drop(CHANGE),
        rows.filter(F.col(CHANGE) == UPDATED).drop(CHANGE),
    )
