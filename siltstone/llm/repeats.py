"""Removal of long byte strings that stand earlier in the corpus, by names of sampled suffixes.

The suffixes that are sorted are a sample with the property of a difference
cover: whenever two positions begin the same ``length`` bytes, some shift of less than ``length``
takes both to sampled positions. Residues modulo a number, the usual cover, need
one sampled position in five to eight for strings of 100 bytes. Here the content picks them:
of every window of ``length`` bytes the place of its least-hashed 32 bytes. Equal
windows pick the same place, and one position in 35 is sampled.

Names are sorted in three rounds, each over what the round before left open:

1. the 32 bytes at each sampled position; one that stands nowhere else settles all windows that
   picked it: none of them repeats;
2. the triple of left context, name and right context that covers just these windows: a triple that
   stands earlier settles them too, all of them repeat; so does a first triple that is the
   only one around its name, as none repeats;
3. the windows that are left, one by one: of equal neighbours in the order all but the first repeat.

Texts are dealt into parts by ranges of ids and written once, in chunks, with the runs of windows that
picked one place; a chunk holds a piece of a long document or several short ones. All rounds read these
chunks where they lie. A part sends each distinct name once, so a passage that a third of all
documents share costs one entry per part. Names are split over slots by value, triples by the triple and
not by the name around which they lie; a slot is sorted in one task, and its size is bounded by the number of
slots, which follows the input.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.common import kept, whole_text
from siltstone.session import new_folder

#: Bytes of text in a chunk (fewer for the end of a document), in a part and per slot of names.
CHUNK_BYTES = 1 << 18
PART_BYTES = 8 << 20
SLOT_BYTES = 16 << 20
#: Parts lie in buckets of a table, of which Spark allows no more; beyond 800 GB parts grow.
MOST_PARTS = 100_000
GRAM = 32

_U = np.uint64
_POSITION_BITS = 26


class _Hash:
    """A polynomial hash modulo 2**64 of byte strings, from prefix sums."""

    def __init__(self, seed: int, base: int):
        self.codes = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
        self.base = base
        self.up = self.down = np.zeros(0, np.uint64)

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * CHUNK_BYTES)
            self.up, self.down = (
                np.multiply.accumulate(np.append(_U(1), np.full(size - 1, base, dtype=np.uint64)))
                for base in (self.base, pow(self.base, -1, 1 << 64))
            )

    def sums(self, codes: np.ndarray) -> np.ndarray:
        n = len(codes)
        self.powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.codes[codes] * self.up[:n], out=sums[1:])
        return sums

    def digest(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        size = (stop - start).astype(np.uint64)
        return _mix((sums[stop] - sums[start]) * self.down[start] + size * _U(0xA0761D6478BD642F))


#: Two independent hashes; what decides on a byte's removal is compared by both.
_HASHES = (_Hash(20, 0x9E3779B97F4A7C15), _Hash(21, 0xD1342543DE82EF95))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> _U(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size, span = len(x) - width + 1, 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:size], x[width - span : width - span + size])


@dataclass
class Runs:
    """The windows of a chunk in runs that picked the same place: first and last window, place, and its name."""

    first: np.ndarray
    last: np.ndarray
    place: np.ndarray
    name: np.ndarray

    @classmethod
    def of(cls, data: bytes, ends: np.ndarray, length: int) -> Runs:
        """``ends`` are those of the texts in ``data``, the last one with what the next chunk holds of it as well."""
        codes = np.frombuffer(data, np.uint8)
        n = len(codes)
        none = np.zeros(0, np.int64)
        if n < length:
            return cls(none, none, none, np.zeros(0, np.uint64))
        own = _HASHES[0]
        starts = np.arange(n - GRAM + 1)
        grams = own.digest(own.sums(codes), starts, starts + GRAM)
        bits = _U(max(_POSITION_BITS, n.bit_length()))
        least = _sliding_min((grams >> bits << bits) | starts.astype(np.uint64), length - GRAM + 1)
        limits = np.repeat(ends, np.diff(ends, prepend=0))[: len(least)]
        window = np.flatnonzero(np.arange(len(least)) + length <= limits)
        if not len(window):
            return cls(none, none, none, np.zeros(0, np.uint64))
        place = (least[window] & ((_U(1) << bits) - _U(1))).astype(np.int64)
        opens = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(window, prepend=-2) != 1))
        first = window[opens]
        last = window[np.append(opens[1:], len(window)) - 1]
        return cls(first, last, place[opens], grams[place[opens]])

    def packed(self) -> list[bytes]:
        """Columns of the written form."""
        parts = (self.first, "<u4"), (self.last - self.first, "<u2"), (self.place - self.first, "<u2"), (self.name, "<u8")
        return [values.astype(kind).tobytes() for values, kind in parts]

    @classmethod
    def read(cls, first: bytes, last: bytes, place: bytes, name: bytes) -> Runs:
        start = np.frombuffer(first, "<u4").astype(np.int64)
        return cls(
            start, start + np.frombuffer(last, "<u2"), start + np.frombuffer(place, "<u2"), np.frombuffer(name, "<u8")
        )

    def triples(self, sums: Sequence[np.ndarray], runs: np.ndarray, length: int) -> list[np.ndarray]:
        """Names of what the windows of these runs cover, and of where the sampled place lies in it."""
        first, stop = self.first[runs], self.last[runs] + length
        shift = (self.place[runs] - first).astype(np.uint64) * _U(0xE7037ED1A0B428DB)
        return [_mix(h.digest(s, first, stop) ^ shift) for h, s in zip(_HASHES, sums)]

    def windows(self, sums: Sequence[np.ndarray], runs: np.ndarray, length: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Starts and names of all windows of these runs, in text order."""
        sizes = self.last[runs] - self.first[runs] + 1
        at = np.repeat(self.first[runs] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        start = at + np.arange(len(at))
        return start, [h.digest(s, start, start + length) for h, s in zip(_HASHES, sums)]


def _distinct(keys: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that hold each distinct key first, in key order; each row's key; and which rows are not the first."""
    order = np.lexsort(keys[::-1])  # stable: rows of one key stay in text order
    new = np.ones(len(order), dtype=bool)
    differs = np.zeros(max(len(order) - 1, 0), dtype=bool)
    for key in keys:
        differs |= key[order][1:] != key[order][:-1]
    new[1:] = differs
    entry = np.empty(len(order), dtype=np.int64)
    entry[order] = np.cumsum(new) - 1
    later = np.ones(len(order), dtype=bool)
    later[order[new]] = False
    return order[new], entry, later


def _columns(*keys: np.ndarray) -> np.ndarray:
    return np.stack([k.astype("<u8") for k in keys], axis=1) if len(keys[0]) else np.zeros((0, len(keys)), "<u8")


class _Part:
    """What the rounds so far have settled about one part, from its chunks' runs and bytes and the rounds' flags."""

    def __init__(self, chunks: pa.Table, length: int, flags: Sequence[np.ndarray]):
        self.length = length
        chunks = chunks.sort_by("chunk")
        self.columns = {c: chunks.column(c) for c in chunks.column_names}
        self.runs = [Runs.read(*(self.columns[c][i].as_py() for c in _RUN_COLUMNS)) for i in range(chunks.num_rows)]
        names = np.concatenate([np.zeros(0, np.uint64), *(r.name for r in self.runs)])
        own, where, times = np.unique(names, return_inverse=True, return_counts=True)
        self.entries = [(0, _columns(own))]
        if not flags:
            return
        # 1: names that stand elsewhere too, in another part or in this one.
        shared = ((flags[0] & 1).astype(bool) | (times > 1))[where]
        cuts = np.cumsum([len(r.name) for r in self.runs])[:-1] if self.runs else []
        self.shared = [np.flatnonzero(x) for x in np.split(shared, cuts)] if self.runs else []
        name = names[shared]
        triple = self._gather(self.runs[i].triples(self._sums(i), x, length) for i, x in enumerate(self.shared) if len(x))
        distinct, entry, later = _distinct(triple)
        own, where = np.unique(name, return_inverse=True)
        low, high = np.full(len(own), ~_U(0)), np.zeros(len(own), np.uint64)
        np.minimum.at(low, where, triple[0])
        np.maximum.at(high, where, triple[0])
        self.entries = [(0, _columns(triple[0][distinct], triple[1][distinct])), (1, _columns(own, low, high))]
        if len(flags) < 2:
            return
        # 2: triples that stand earlier, and names with more than one triple.
        earlier = (flags[1][: len(distinct)] & 1).astype(bool)[entry] | later
        several = (flags[1][len(distinct) :] & 1).astype(bool)[where]
        self.repeated = self._per_chunk(earlier)
        self.open = self._per_chunk(~earlier & several)
        none = (np.zeros(0, np.int64), [np.zeros(0, np.uint64)] * len(_HASHES))
        found = [
            self.runs[i].windows(self._sums(i), x, length) if len(x) else none for i, x in enumerate(self.open)
        ]
        self.starts = [f[0] for f in found]
        window = self._gather(f[1] for f in found)
        distinct, entry, later = _distinct(window)
        self.entries = [(0, _columns(window[0][distinct], window[1][distinct]))]
        if len(flags) < 3:
            return
        # 3: windows that stand earlier.
        again = (flags[2] & 1).astype(bool)[entry] | later
        parts = np.split(again, np.cumsum([len(s) for s in self.starts])[:-1]) if self.starts else []
        self.again = [s[a] for s, a in zip(self.starts, parts)]

    def _sums(self, i: int) -> list[np.ndarray]:
        """Prefix sums of a chunk; sixteen times its size, so they are made when needed and not kept."""
        codes = np.frombuffer(self.columns["data"][i].as_py(), np.uint8)
        return [h.sums(codes) for h in _HASHES]

    @staticmethod
    def _gather(pairs: Iterable[Sequence[np.ndarray]]) -> list[np.ndarray]:
        pairs = list(pairs)
        return [np.concatenate([np.zeros(0, np.uint64), *(p[k] for p in pairs)]) for k in range(len(_HASHES))]

    def _per_chunk(self, chosen: np.ndarray) -> list[np.ndarray]:
        """The runs of each chunk that a choice among all shared ones leaves."""
        out, at = [], 0
        for shared in self.shared:
            out.append(shared[chosen[at : at + len(shared)]])
            at += len(shared)
        return out

    def covered(self) -> Iterator[tuple[int, bytes, np.ndarray]]:
        """Per chunk its number, its own bytes, and which of them some repeated window covers."""
        carried = np.zeros(0, dtype=bool)
        for i, runs in enumerate(self.runs):
            data = self.columns["data"][i].as_py()
            own = len(data) - self.columns["tail"][i].as_py()
            change = np.zeros(len(data) + 1, dtype=np.int32)
            np.add.at(change, runs.first[self.repeated[i]], 1)
            np.add.at(change, runs.last[self.repeated[i]] + self.length, -1)
            np.add.at(change, self.again[i], 1)
            np.add.at(change, self.again[i] + self.length, -1)
            gone = np.cumsum(change[:-1]) > 0
            gone[: len(carried)] |= carried
            carried = gone[own:]
            yield i, data[:own], gone[:own]


_RUN_COLUMNS = ["first", "last", "place", "name"]


def _settle(entries: pd.DataFrame) -> pd.DataFrame:
    """A flag for every key of one slot. Round 1: another part has the name; kind 1: the name's least and largest
    triple differ; else: an earlier part has the key."""
    entries = entries.sort_values("part", kind="stable")
    round_no, kind = int(entries["round"].iloc[0]), int(entries["kind"].iloc[0])
    width = 1 if round_no == 1 else 3 if kind else 2
    keys = np.frombuffer(b"".join(entries["keys"]), "<u8").reshape(-1, width)
    sizes = [len(k) // (8 * width) for k in entries["keys"]]
    if round_no == 1:
        _, where, times = np.unique(keys[:, 0], return_inverse=True, return_counts=True)
        flags = times[where] > 1
    elif kind:
        names, where = np.unique(keys[:, 0], return_inverse=True)
        low, high = np.full(len(names), ~_U(0)), np.zeros(len(names), np.uint64)
        np.minimum.at(low, where, keys[:, 1])
        np.maximum.at(high, where, keys[:, 2])
        flags = (low != high)[where]
    else:
        flags = _distinct([keys[:, 0], keys[:, 1]])[2]
    flags = flags.astype(np.uint8)
    cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    return pd.DataFrame(
        {
            "bucket": entries["bucket"].to_numpy(),
            "place": (entries["kind"] * (1 << 40) + entries["slot"]).to_numpy(),
            "flags": [flags[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])],
        }
    )


def _pieces(text: bytes, length: int) -> Iterator[tuple[bytes, int]]:
    """A long text in pieces of a chunk's size, each with the start of the next one as far as its windows reach."""
    for start in range(0, len(text), CHUNK_BYTES):
        piece = text[start : start + CHUNK_BYTES + length - 1]
        yield piece, len(piece) - min(CHUNK_BYTES, len(text) - start)


def _bucket_keys(spark: SparkSession, buckets: int) -> list[int]:
    """For every bucket a number that Spark's hash puts into it, so that each part has a bucket, and a task, to itself."""
    tries = buckets * (buckets.bit_length() + 20)  # some bucket stays without a number with odds of e**-20
    place = F.pmod(F.hash(F.col("id").cast("int")), F.lit(buckets))
    found = spark.range(tries).groupBy(place.alias("place")).agg(F.min("id").alias("id")).orderBy("place").collect()
    return [r["id"] for r in found]


def _chunks(docs: DataFrame, length: int) -> tuple[DataFrame, int]:
    """The documents in id order as chunks with their runs, bucketed so that flags come to them without moving texts."""
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*(docs[c] for c in rest)).alias("row"), whole_text(docs).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(MOST_PARTS, max(1, -(-total // PART_BYTES)))
    # As many buckets as a shuffle has partitions, or Spark would rather shuffle the texts to get as many.
    buckets = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = _bucket_keys(spark, buckets)

    schema = T.StructType(
        [
            T.StructField("bucket", T.IntegerType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("chunk", T.LongType()),
            T.StructField("rows", T.ArrayType(rows.schema["row"].dataType)),
            T.StructField("ends", T.ArrayType(T.LongType())),
            T.StructField("tail", T.IntegerType()),
            T.StructField("data", T.BinaryType()),
            *(T.StructField(c, T.BinaryType()) for c in _RUN_COLUMNS),
        ]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0

        def chunk(own_rows: pa.Array, ends: list[int], data: bytes, tail: int) -> pa.RecordBatch:
            nonlocal number
            limits = np.array(ends, dtype=np.int64)
            limits[-1:] += tail
            values = [
                pa.array([keys[part]], pa.int32()),
                pa.array([part], pa.int32()),
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(own_rows)], pa.int32()), pa.concat_arrays([own_rows])),
                pa.array([ends], pa.list_(pa.int64())),
                pa.array([tail], pa.int32()),
                pa.array([data], pa.binary()),
                *(pa.array([c], pa.binary()) for c in Runs.of(data, limits, length).packed()),
            ]
            number += 1
            return pa.RecordBatch.from_arrays(values, schema.names)

        for batch in batches:
            own_rows = batch.column(0)
            texts = batch.column(1).cast(pa.binary())
            first, held, size = 0, [], 0
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                if held and size + len(text) > CHUNK_BYTES:
                    yield chunk(own_rows.slice(first, len(held)), np.cumsum([len(t) for t in held]).tolist(), b"".join(held), 0)
                    held, size = [], 0
                if not held:
                    first = i
                if len(text) > CHUNK_BYTES:
                    pieces = list(_pieces(text, length))
                    for n, (piece, tail) in enumerate(pieces, 1):
                        # The row itself comes with the last piece of its text.
                        yield chunk(own_rows.slice(i, int(n == len(pieces))), [len(piece) - tail], piece, tail)
                    continue
                held.append(text)
                size += len(text)
            if held:
                yield chunk(own_rows.slice(first, len(held)), np.cumsum([len(t) for t in held]).tolist(), b"".join(held), 0)

    placed = rows.repartitionByRange(parts, "row.doc_id").sortWithinPartitions("row.doc_id", "text")
    name = f"repeat_chunks_{uuid.uuid4().hex[:12]}"
    (
        placed.mapInArrow(build, schema)
        .write.format("parquet")
        .option("path", new_folder(spark, "repeat-chunks"))
        .option("compression", "zstd")
        .bucketBy(buckets, "bucket")
        .saveAsTable(name)
    )
    chunks = spark.table(name)
    # Only the catalog knows buckets; once it has told, its entry goes, and the files stay.
    chunks.schema  # noqa: B018
    spark.sql(f"DROP TABLE {name}")
    return chunks, total


def remove_repeats(docs: DataFrame, length: int = 100, texts: bool = False) -> DataFrame:
    """Per row of ``docs``: its columns but the text, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes that covers it also starts earlier: in
    a row before (by doc_id, NULL first; rows that share an id by text), or in the same text before. Strings overlap freely, never
    cross texts, and are judged on the input. With ``texts`` the column ``text`` holds what is kept; characters
    that lose some of their bytes only are kept whole there. NULL texts count as empty; no rows give no rows.
    Other columns are carried along; their values are not looked at.

    Strings are compared by 128-bit digests. Texts are shuffled once, into id order; then only names and
    flags move. A task holds one part and works on it a chunk at a time; a document longer than a chunk
    is taken in pieces, so it needs little more than its own size.
    """
    chunks, total = _chunks(docs, length)
    slots = max(32, -(-total // SLOT_BYTES))
    settled: list[DataFrame] = []

    def state(own: pa.Table, told: pa.Table, rounds: int) -> _Part:
        flags = []
        for r in range(rounds):
            parts = told.column(f"flags{r + 1}")[0].as_py() if told.num_rows else None
            flags.append(np.frombuffer(b"".join(parts or []), np.uint8))
        return _Part(own, length, flags)

    def over_parts(columns: Sequence[str], use, schema, rounds: int) -> DataFrame:
        """``use`` over the state of every part, from some columns of its chunks and the flags so far."""
        own = chunks.select("bucket", "part", "chunk", *columns)
        if not rounds:
            return own.groupBy("bucket").applyInArrow(lambda table: use(state(table, table, 0), table), schema)
        told = settled[0]
        for flags in settled[1:]:
            told = told.join(flags.hint("merge"), "bucket", "left")  # small files, but they unfold
        return own.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(
            lambda table, flags: use(state(table, flags, rounds), table), schema
        )

    entry_schema = "round int, kind long, slot long, bucket int, part int, keys binary"
    for rounds in range(3):

        def send(part: _Part, table: pa.Table, rounds: int = rounds) -> pa.Table:
            found: list[tuple[int, int, bytes]] = []
            for kind, keys in part.entries:
                slot = ((keys[:, 0] >> _U(32)) * _U(slots) >> _U(32)).astype(np.int64)
                used, begins = np.unique(slot, return_index=True)
                for s, a, b in zip(used.tolist(), begins.tolist(), [*begins[1:].tolist(), len(slot)]):
                    found.append((kind, s, keys[a:b].tobytes()))
            bucket, number = (table.column(c)[0].as_py() for c in ("bucket", "part"))
            return pa.table(
                {
                    "round": pa.array([rounds + 1] * len(found), pa.int32()),
                    "kind": pa.array([f[0] for f in found], pa.int64()),
                    "slot": pa.array([f[1] for f in found], pa.int64()),
                    "bucket": pa.array([bucket] * len(found), pa.int32()),
                    "part": pa.array([number] * len(found), pa.int32()),
                    "keys": pa.array([f[2] for f in found], pa.binary()),
                }
            )

        columns = [*_RUN_COLUMNS, "data"] if rounds else _RUN_COLUMNS
        entries = over_parts(columns, send, entry_schema, rounds)
        flags = entries.groupBy("kind", "slot").applyInPandas(_settle, "bucket int, place long, flags binary")
        # A part's flags by kind and slot are in the order of its keys.
        joined = flags.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("place", "flags"))).alias("parts"))
        column = F.col("parts")["flags"].alias(f"flags{rounds + 1}")
        settled.append(kept(joined.select("bucket", column), f"repeat-flags{rounds + 1}"))

    row_type = chunks.schema["rows"].dataType.elementType
    new = {"n_bytes", "n_removed", "n_spans", "kept_sha256", "text"}
    fields = [f for f in row_type.fields if f.name not in new]
    keep = [i for i, f in enumerate(row_type.fields) if f.name not in new]
    out_schema = T.StructType(
        [
            *fields,
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("n_spans", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
            *([T.StructField("text", T.StringType())] if texts else []),
        ]
    )

    def finish(part: _Part, table: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        before: list[tuple[bytes, np.ndarray]] = []  # the pieces of a document so far
        for i, data, gone in part.covered():
            rows = part.columns["rows"][i].values
            ends = part.columns["ends"][i].as_py()
            if len(rows) < len(ends):
                before.append((data, gone))
                continue
            sizes, removed, spans, digests, left = [], [], [], [], []
            for a, b in zip([0, *ends[:-1]], ends):
                own, own_gone = data[a:b], gone[a:b]
                if before:
                    own = b"".join([*(d for d, _ in before), own])
                    own_gone = np.concatenate([*(g for _, g in before), own_gone])
                    before = []
                lost = int(np.count_nonzero(own_gone))
                rest = np.frombuffer(own, np.uint8)[~own_gone].tobytes() if lost else own
                sizes.append(len(own))
                removed.append(lost)
                spans.append(int(own_gone[0]) + int(np.count_nonzero(own_gone[1:] > own_gone[:-1])) if lost else 0)
                digests.append(hashlib.sha256(rest).hexdigest())
                if texts:
                    left.append(_whole_characters(np.frombuffer(own, np.uint8), own_gone) if lost else own.decode())
            columns = [rows.field(k) for k in keep] + [pa.array(x, pa.int64()) for x in (sizes, removed, spans)]
            columns.append(pa.array(digests, pa.string()))
            if texts:
                columns.append(pa.array(left, pa.string()))
            out.append(pa.RecordBatch.from_arrays(columns, out_schema.names))
        return pa.Table.from_batches(out)  # a part ends with the last piece of a text

    return over_parts([*_RUN_COLUMNS, "data", "rows", "ends", "tail"], finish, out_schema, 3)


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> str:
    """What is left of a text when a character goes only with all its bytes."""
    opens = (data & 0xC0) != 0x80
    character = np.cumsum(opens) - 1
    if len(data):
        all_gone = np.minimum.reduceat(gone, np.flatnonzero(opens))
        return data[~all_gone[character]].tobytes().decode("utf-8", "replace")
    return ""
