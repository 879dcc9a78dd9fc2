"""Binary token files: documents in id order, their ids in patched frame-of-reference segments."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import patched_for
from siltstone.llm.byte_bpe import ByteBpe
from siltstone.llm.common import whole_text

#: A segment takes documents until it holds so many ids.
SEGMENT_IDS = 1 << 19
_BATCH_CHARS = 6_000_000

FILE_SCHEMA = (
    "part int, segment int, start_in_part long, n_ids long, doc_ids array<bigint>, "
    "doc_lengths array<bigint>, payload binary"
)


def _text_batches(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, cut so that the ids of a piece fit in memory."""
    ids, texts, chars = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        ids.append(doc_id)
        texts.append(text)
        chars += len(text)
        if chars >= _BATCH_CHARS:
            yield ids, texts
            ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, percentile: float = 0.9
) -> None:
    """Encode every whole text, append ``end_id`` and write the segments under ``path``.

    Documents lie in ascending ``doc_id`` order over the parts and inside them (a
    NULL id first; rows that share an id side by side). NULL texts count as
    empty: they hold the end id only. No documents give a file set without rows.
    Other columns are not read. The text is shuffled once, by id range; a file
    holds a part's segments, one row each, with the documents they cover.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = ByteBpe.at(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        part, segment, start = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        lengths: list[int] = []
        raw: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, lengths, raw, size, segment, start
            payload = patched_for.encode(np.frombuffer(b"".join(raw), "<u4"), percentile)
            row = [part, segment, start, size, ids, lengths, payload]
            out = pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)
            segment, start = segment + 1, start + size
            ids, lengths, raw, size = [], [], [], 0
            return out

        longs = pa.list_(pa.int64())
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), longs, longs, pa.binary()]
        names = [f.split()[0] for f in FILE_SCHEMA.split(", ")]
        for batch in batches:
            for doc_ids, texts in _text_batches(batch):
                for doc_id, found in zip(doc_ids, bpe.encode(texts)):
                    ids.append(doc_id)
                    raw += [found, end]
                    lengths.append(len(found) // 4 + 1)
                    size += lengths[-1]
                    if size >= SEGMENT_IDS:
                        yield flush()
        if ids:
            yield flush()

    placed = (
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    placed.mapInArrow(encode, FILE_SCHEMA).write.option("compression", "uncompressed").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()  # one row per part
    offsets, total = [], 0
    for part, n in sorted((r["part"], r["n"]) for r in sizes):
        offsets.append((part, total))
        total += n
    parts = spark.createDataFrame(offsets, "part int, offset long")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, ids, lengths, payload in zip(*(c.to_pylist() for c in batch.columns)):
                values = patched_for.Segment(payload).decode().astype("<u4", copy=False)
                raw = memoryview(np.ascontiguousarray(values)).cast("B")
                ends = np.cumsum(np.array(lengths, dtype=np.int64))
                begins = ends - np.array(lengths, dtype=np.int64)
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(begins + start),
                        pa.array(lengths, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # Never more rows than parts.
    return (
        files.join(F.broadcast(parts), "part")
        .select((F.col("offset") + F.col("start_in_part")).alias("start"), "doc_ids", "doc_lengths", "payload")
        .mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )
