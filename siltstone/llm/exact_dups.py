"""Exact duplicates: counting quotient filters find repeated fingerprints, bytes decide."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm import quotient_filter as qf
from siltstone.llm.common import kept, whole_text

#: Fingerprints per slice that the number of slices aims at, and distinct ones a task holds before it sends its filters.
SLICE_FINGERPRINTS = 1 << 20
TASK_FINGERPRINTS = 1 << 22
FILTERS = "slice int, filter binary"


def slice_bits_for(rows: int) -> int:
    """Bits that give every slice about ``SLICE_FINGERPRINTS`` of ``rows`` fingerprints; 8 slices at least."""
    return min(30, max(3, (-(-rows // SLICE_FINGERPRINTS) - 1).bit_length()))


def build_filters(fingerprints: DataFrame, slice_bits: int) -> DataFrame:
    """Counting quotient filters of each partition's fingerprints (a frame of one long column), cut by slices.

    A fingerprint that fills a partition is one entry of its filter, so a hot one costs an entry per task.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def filters() -> pa.RecordBatch:
            where = (seen >> np.uint64(64 - slice_bits)).astype(np.int64)
            used, begins = np.unique(where, return_index=True)
            ends = np.append(begins[1:], len(where))
            made = [qf.encode(seen[a:b], counts[a:b], slice_bits) for a, b in zip(begins, ends)]
            return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(made, pa.binary())], ["slice", "filter"])

        for batch in batches:
            new = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            seen, counts = qf.tally(np.concatenate([seen, new]), np.concatenate([counts, np.ones(len(new), np.int64)]))
            if len(seen) >= TASK_FINGERPRINTS:
                yield filters()
                seen, counts = seen[:0], counts[:0]
        if len(seen):
            yield filters()

    return fingerprints.mapInArrow(build, FILTERS)


def merge_filters(filters: DataFrame) -> DataFrame:
    """One filter per slice, with all counts; also for filters of several corpora, where their slices are alike."""

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": group["slice"].iloc[:1].to_numpy(), "filter": [qf.merge(list(group["filter"]))]})

    return filters.groupBy("slice").applyInPandas(merged, FILTERS)


def repeated(filters: DataFrame) -> DataFrame:
    """(fingerprint, n): the fingerprints that merged filters count more than once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                found, counts = qf.decode(data)
                several = counts > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[several].view(np.int64)), pa.array(counts[several])], ["fingerprint", "n"]
                )

    return filters.select("filter").mapInArrow(read, "fingerprint long, n long")


def exact_duplicates(docs: DataFrame, fingerprint: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are copies if their whole texts are equal byte for byte; a NULL text equals an empty one. Of equal
    rows the one with the largest id stays. A NULL id stays only where all ids of its group are
    NULL (``keep_id`` is NULL then), and rows that share id and text all count as the row that stays.
    No rows give no rows; other columns are not read.

    Only texts whose fingerprint is counted more than once are compared: map tasks collapse
    equal texts before the shuffle, so a group with a third of all rows sends one text per task. Fingerprints
    may collide, since texts are compared; ids come back in a join on digests, and two
    texts of one SHA-256 would be an error.
    """
    text = whole_text(docs)
    keyed = docs.select(
        docs["doc_id"], fingerprint(text).alias("fingerprint"), F.sha2(text, 256).alias("text_sha256"), text.alias("text")
    )
    rows = kept(keyed.drop("text"), "fingerprints")
    filters = build_filters(rows.select("fingerprint"), slice_bits_for(rows.count()))
    several = kept(repeated(kept(merge_filters(filters), "quotient-filters")), "repeated-fingerprints")

    key = ["fingerprint", "text_sha256"]
    suspects = keyed.join(several.select("fingerprint"), "fingerprint", "left_semi")
    texts = suspects.groupBy(*key, "text").agg(F.max("doc_id").alias("largest"), F.count("*").alias("n"))
    one = F.when(
        F.count("*") > 1, F.raise_error(F.lit("different texts have the same SHA-256")).cast("long")
    ).otherwise(F.max("n"))
    groups = kept(
        texts.drop("text").groupBy(*key).agg(F.max("largest").alias("largest"), one.alias("n")).filter("n > 1"),
        "copies",
    )
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("largest"))
    return rows.join(groups, key, "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each that share id and text; all columns are kept."""
    marks = exact_duplicates(docs).filter("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest")
    )
    ids = kept(marks.distinct(), "kept-rows")
    digest = F.sha2(whole_text(docs), 256)
    same = docs["doc_id"].eqNullSafe(ids["__id"]) & (digest == ids["__digest"])
    return docs.join(ids, same, "left_semi").dropDuplicates(["doc_id", "text"])
