"""A reproducible shuffle of rows into shards by a Feistel permutation of their numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import kept

ROUNDS = 6
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its lower 33 bits
#: Walks after which a number that is still outside the range is an error. Fewer than
#: one in sqrt(n) numbers lie outside, so no cycle is known to come near it.
MAX_WALKS = 64


def _sides(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid with at least ``n`` cells."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def permuted(number: Column, n: int, seed: int = 0) -> Column:
    """Where a row number below ``n`` goes: a keyed permutation of 0 .. n - 1.

    The number is split into a row and a column of a grid with barely more than
    ``n`` cells; each round moves one of them by a keyed hash of the other.
    Numbers that leave the range walk on along their cycle until they are back in it.
    """
    a, b = _sides(n)
    big = 1 << 31

    def turn(state: Column, i: Column) -> Column:
        row, column = state["row"], state["column"]
        by_column = F.pmod(F.xxhash64(F.lit(seed), i, column), F.lit(big))
        by_row = F.pmod(F.xxhash64(F.lit(seed), i, row), F.lit(big))
        even = i % 2 == 0
        return F.struct(
            F.when(even, (row + by_column) % a).otherwise(row).alias("row"),
            F.when(even, column).otherwise((column + by_row) % b).alias("column"),
        )

    def once(x: Column) -> Column:
        column = x % b
        start = F.struct(((x - column) / b).cast("long").alias("row"), column.alias("column"))
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
            start,
            turn,
            lambda s: s["row"] * b + s["column"],
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(MAX_WALKS)),
        F.lit(-1).cast("long"),
        lambda x, i: F.when(i == 1, once(number)).when(x >= n, once(x)).otherwise(x),
        lambda x: F.when(x < n, x).otherwise(
            F.raise_error(F.lit("a row number did not come back into the range")).cast("long")
        ),
    )


def shards(docs: DataFrame, n_shards: int = 16, seed: int = 0) -> DataFrame:
    """Shard and slot of every row: doc_id, size, text_crc32, number, shard, slot.

    Rows are numbered in (doc_id, crc32, size) order, NULL ids first; rows equal in
    all three are alike, so it does not matter which of them gets which
    number. The permuted number gives the shard (remainder) and the slot
    (quotient), hence shards differ by one row at most and slots have no gaps,
    and both can be computed from a row number alone. A NULL text has size 1 and
    the crc32 of an empty text. No rows give no rows.

    Only ids, sizes and checksums are shuffled, by ranges of ids; the numbered rows
    are written once, as a recomputed range partitioning could number differently.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    placed = (
        docs.select(
            docs["doc_id"],
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
        .repartitionByRange("doc_id", "text_crc32", "size")
        .sortWithinPartitions("doc_id", "text_crc32", "size")
        .withColumn("at", F.monotonically_increasing_id())
    )
    rows = kept(placed, "shards").withColumn("part", F.shiftright("at", _ROW_BITS))
    # One row per partition.
    sizes = sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    table = docs.sparkSession.createDataFrame(offsets, "part long, offset long")
    numbered = rows.join(F.broadcast(table), "part").withColumn(
        "number", F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    place = permuted(F.col("number"), total, seed)
    return (
        numbered.withColumn("place", place)
        .withColumn("shard", (F.col("place") % n_shards).cast("int"))
        .withColumn("slot", F.floor(F.col("place") / n_shards).cast("long"))
        .select("doc_id", "size", "text_crc32", "number", "shard", "slot")
    )
