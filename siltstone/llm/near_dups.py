"""Near-duplicate components: MinHash bands find candidates, odd sketches sift them, full sets confirm.

The sketch of a text folds its MinHash samples into a bitmap of parities. Samples that two
texts share cancel out in the XOR of the bitmaps, so the number of its set bits tells how many
samples differ, and most precisely where few do: at high similarities. Where many texts resemble each
other a little too little, a wider bitmap that folds whole sets decides: the set bits of the XOR of two
never exceed the shingles that the sets do not share, so no link is lost by it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import kept, whole_text
from siltstone.llm.components import components
from siltstone.llm.shingles import shingle_set

SKETCH_BITS = 256
SET_BITS = 2048
_LONGS = SKETCH_BITS // 64
_SET_LONGS = SET_BITS // 64


@dataclass(frozen=True)
class Plan:
    """How texts are compared: shingle size, least similarity in percent, MinHash bands and rows.

    Two texts at the least similarity (0.8) share no band with odds of (1 - 0.8**5)**28 = 1.5e-5.
    """

    words: int = 5
    percent: int = 80
    bands: int = 28
    rows: int = 5
    seed: int = 11

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def most_bits(self) -> int:
        """Set bits of an XOR beyond which two texts are not compared.

        Four deviations above what the least similarity gives; the deviation joins
        that of the differing samples with that of their collisions in the bitmap.
        """
        j, k = self.percent / 100, self.samples
        differing = 2 * k * (1 - j)
        stay = (1 - 2 / SKETCH_BITS) ** differing
        variance = (2 * stay) ** 2 * k * j * (1 - j) + 2 * differing**2 / SKETCH_BITS
        return math.ceil(SKETCH_BITS * (1 - stay) / 2 + 4 * math.sqrt(variance))


class _Sampler:
    def __init__(self, plan: Plan):
        rng = np.random.default_rng(plan.seed)
        self.plan = plan
        self.factor = (rng.integers(0, 1 << 31, plan.samples, dtype=np.uint32) * np.uint32(2)) | np.uint32(1)
        self.shift = rng.integers(0, 1 << 32, plan.samples, dtype=np.uint32)
        self.salt = rng.integers(0, 1 << 63, plan.samples, dtype=np.uint64)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(self.plan.samples, 0xFFFFFFFF, dtype=np.uint32)
        narrow = (shingles >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(narrow), 4096):
            spread = narrow[at : at + 4096, None] * self.factor
            spread += self.shift
            np.minimum(low, spread.min(axis=0), out=low)
        return low

    def signature(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys and sketch, as signed 64-bit integers."""
        mixed = (self.minima(shingles).astype(np.uint64) + self.salt) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        bits = np.bincount((mixed >> np.uint64(56)).astype(np.int64), minlength=SKETCH_BITS) & 1
        sketch = np.packbits(bits.astype(np.uint8)).view(np.int64)
        keys = mixed.reshape(self.plan.bands, self.plan.rows)
        band = np.arange(self.plan.bands, dtype=np.uint64)
        for j in range(self.plan.rows):
            band = (band ^ keys[:, j]) * np.uint64(0xC2B2AE3D27D4EB4F)
            band ^= band >> np.uint64(32)
        return band.view(np.int64), sketch


def _vertex(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, plan: Plan) -> DataFrame:
    """Per row: doc_id, n_shingles, vertex (a digest of the set), bands, sketch; no set, no vertex."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _Sampler(plan)
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                sizes, vertices, bands, sketches = [], [], [], []
                for text in batch.column(1).to_pylist():
                    found = shingle_set(text, plan.words)
                    sizes.append(len(found))
                    if not len(found):
                        vertices.append(None)
                        bands.append(None)
                        sketches.append(None)
                        continue
                    vertices.append(_vertex(found))
                    own_bands, own_sketch = sampler.signature(found)
                    bands.append(own_bands)
                    sketches.append(own_sketch)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(vertices, pa.int64()),
                        pa.array(bands, longs),
                        pa.array(sketches, longs),
                    ],
                    ["doc_id", "n_shingles", "vertex", "bands", "sketch"],
                )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    schema = "doc_id long, n_shingles long, vertex long, bands array<bigint>, sketch array<bigint>"
    return rows.mapInArrow(run, schema)


def with_vertex(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``docs`` with ``vertex``, the digest of a row's set that ``near_rows`` gives; no set, no vertex."""

    @F.pandas_udf("long")
    def vertex(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = (shingle_set(t, plan.words) for t in texts)
            yield pd.Series([_vertex(f) if len(f) else None for f in found], dtype="Int64")

    return docs.withColumn("vertex", vertex(whole_text(docs)))


def _sets(docs: DataFrame, ids: DataFrame, plan: Plan) -> DataFrame:
    """(vertex, size, parity, shingles) of the documents with these ids; ``parity`` folds the whole set."""

    def parity(shingles: np.ndarray) -> np.ndarray:
        bits = np.bincount((shingles % np.uint64(SET_BITS)).astype(np.int64), minlength=SET_BITS) & 1
        return np.packbits(bits.astype(np.uint8)).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                texts = whole.column(0).slice(first, 500).to_pylist()
                found = [shingle_set(t, plan.words) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_vertex(f) for f in found], pa.int64()),
                        pa.array([len(f) for f in found], pa.int32()),
                        pa.array([parity(f) for f in found], longs),
                        pa.array([f.view(np.int64) for f in found], longs),
                    ],
                    ["vertex", "size", "parity", "shingles"],
                )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    found = rows.join(ids, "doc_id", "left_semi").select("text")
    return found.mapInArrow(run, "vertex long, size int, parity array<bigint>, shingles array<bigint>")


def _differing_bits(left: str, right: str, longs: int = _LONGS) -> Column:
    bits = [F.bit_count(F.col(f"{left}{i}").bitwiseXOR(F.col(f"{right}{i}"))) for i in range(longs)]
    return sum(bits[1:], bits[0])


def _linked(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("vertex").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("vertex").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - both
    return pairs.join(left, "a").join(right, "b").filter(100 * both >= plan.percent * either).select("a", "b")


def _closest(pairs: DataFrame, sketches: DataFrame, plan: Plan) -> DataFrame:
    """Of the pairs (vertex, leader) that pass the sketch, each vertex's closest, as (a, b)."""
    of = lambda name, prefix: sketches.select(
        F.col("vertex").alias(name), *(F.col(f"s{i}").alias(f"{prefix}{i}") for i in range(_LONGS))
    )
    sifted = (
        pairs.filter("vertex <> leader")
        .distinct()
        .join(of("vertex", "v"), "vertex")
        .join(of("leader", "l"), "leader")
        .select("vertex", "leader", _differing_bits("v", "l").alias("bits"))
        .filter(F.col("bits") <= plan.most_bits)
    )
    return (
        sifted.groupBy("vertex")
        .agg(F.min(F.struct("bits", "leader")).alias("best"))
        .select(F.least("vertex", "best.leader").alias("a"), F.greatest("vertex", "best.leader").alias("b"))
        .distinct()
    )


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members (band, vertex, ...) of bands that hold several components, with theirs."""
    placed = kept(
        members.join(found.withColumnRenamed("vertex", "of"), F.col("vertex") == F.col("of"), "left")
        .withColumn("component", F.coalesce("component", "vertex"))
        .drop("of"),
        "near-placed",
    )
    mixed = placed.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    mixed = kept(mixed.filter("least < most").select("band", "least"), "near-mixed")
    return kept(placed.join(mixed, "band"), "near-open")


def _across(members: DataFrame, plan: Plan, how: str, whole_sets: bool) -> DataFrame:
    """Join of open members over bands: different components, and bitmaps (s0, s1, ...) close enough."""
    longs = _SET_LONGS if whole_sets else _LONGS
    side = lambda prefix: members.select(
        *(F.col(c).alias(f"{prefix}{c}") for c in members.columns)
    )
    bits = _differing_bits("ls", "rs", longs)
    if whole_sets:
        # At the least similarity the sets do not share this part of their added sizes.
        near = (100 + plan.percent) * bits <= (100 - plan.percent) * (F.col("lsize") + F.col("rsize"))
    else:
        near = bits <= plan.most_bits
    met = (F.col("lband") == F.col("rband")) & (F.col("lcomponent") != F.col("rcomponent")) & near
    # Of pairs, one side leaves out the component of the band's least vertex, mostly the large one.
    left = side("l").filter("lcomponent <> lleast") if how == "inner" else side("l")
    return left.join(side("r"), met, how)


def _own_shingles(sets: DataFrame) -> DataFrame:
    """(vertex, own): how many shingles of a set no other set holds."""
    single = (
        sets.select("vertex", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("vertex").alias("vertex"), F.max("vertex").alias("other"))
        .filter("vertex = other")
    )
    return single.groupBy("vertex").agg(F.count("*").alias("own"))


def near_duplicates(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    The rows of ``near_rows`` without their vertex.
    """
    return near_rows(docs, plan).drop("vertex")


def near_rows(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Per row of ``docs``: doc_id, vertex (a digest of its set), n_shingles, component_id, kept.

    Texts are linked if the similarity (Jaccard) of their shingle sets is at least ``plan.percent``; a
    component is what links reach, named by its smallest doc_id, and that document is kept. NULL
    texts and texts without words have no set and are components of their own, as are rows without
    an id (they are kept). Rows that repeat an id are linked by their own texts; no rows give no rows;
    other columns are not read.

    Equal sets are one vertex from the start. Links are looked for in four steps, each only over what the
    ones before left in different components, so members of a large group are not paired with each other:

    1. of the texts that share a band, pairs with one of two leaders, per text the closest by sketch;
    2. texts without a partner across components leave: first by sketch, then by the bitmap of whole sets. Both
       are semi-joins, with one row per text at most;
    3. pairs with the band's most central text, the one with the fewest shingles of its own: the likely origin of copies;
    4. every pair that shares a band, lies in different components and passes the bitmap of whole sets.

    Every pair that steps 1, 3 and 4 find is confirmed on the full sets. Texts are shuffled once, to fetch the sets of
    those that share a band.
    """
    rows = kept(signatures(docs, plan), "near-signatures")
    classes = kept(
        rows.filter("vertex IS NOT NULL")
        .groupBy("vertex")
        .agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
        "near-classes",
    )
    sketches = classes.select("vertex", *(F.col("sketch")[i].alias(f"s{i}") for i in range(_LONGS)))
    members = classes.select("vertex", F.explode("bands").alias("band"))
    leaders = members.groupBy("band").agg(F.min("vertex").alias("low"), F.max("vertex").alias("high"))
    leaders = kept(leaders.filter("low < high"), "near-leaders")
    shared = kept(members.join(leaders, "band"), "near-members")

    first_pairs = shared.select("vertex", F.explode(F.array("low", "high")).alias("leader"))
    closest = kept(_closest(first_pairs, sketches, plan), "near-closest")
    ids = classes.join(shared.select("vertex").distinct(), "vertex", "left_semi").select("doc_id")
    sets = kept(_sets(docs, ids, plan), "near-sets")
    links = kept(_linked(closest, sets, plan), "near-links")
    found = kept(components(links, "near-first"), "near-first")

    open_members = _open(shared.select("band", "vertex").join(sketches, "vertex"), found)
    partnered = _across(open_members, plan, "left_semi", whole_sets=False)
    partnered = kept(partnered.select(F.col("lvertex").alias("vertex")).distinct(), "near-partnered")
    own_sets = sets.join(partnered, "vertex", "left_semi").dropDuplicates(["vertex"])
    bitmaps = own_sets.select("vertex", "size", *(F.col("parity")[i].alias(f"s{i}") for i in range(_SET_LONGS)))
    open_members = open_members.select("band", "vertex").join(kept(bitmaps, "near-bitmaps"), "vertex")
    open_members = _open(open_members, found)
    partnered = _across(open_members, plan, "left_semi", whole_sets=True)
    partnered = kept(partnered.select(F.col("lvertex").alias("vertex")).distinct(), "near-partnered")
    open_members = kept(
        open_members.drop("component", "least").join(partnered, "vertex", "left_semi"), "near-open"
    )
    own = _own_shingles(sets.join(partnered, "vertex", "left_semi"))
    centres = (
        open_members.select("band", "vertex")
        .join(own, "vertex", "left")
        .groupBy("band")
        .agg(F.min(F.struct(F.coalesce("own", F.lit(0)).alias("own"), "vertex"))["vertex"].alias("leader"))
    )
    central = open_members.select("band", "vertex").join(kept(centres, "near-centres"), "band")
    closest = kept(_closest(central.select("vertex", "leader"), sketches, plan), "near-closest")
    links = kept(links.union(_linked(closest, sets, plan)), "near-links")
    found = kept(components(links, "near-second"), "near-second")

    open_members = _open(open_members, found)
    across = (
        _across(open_members, plan, "inner", whole_sets=True)
        .select(F.least("lvertex", "rvertex").alias("a"), F.greatest("lvertex", "rvertex").alias("b"))
        .distinct()
    )
    links = kept(links.union(_linked(across, sets, plan)), "near-links")
    found = kept(components(links, "near-found"), "near-found")

    named = found.join(classes.select("vertex", "doc_id"), "vertex")
    least_ids = kept(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "near-names")
    by_vertex = (
        classes.select("vertex", "doc_id")
        .join(found, "vertex", "left")
        .join(least_ids, "component", "left")
        .select("vertex", F.coalesce("component_id", "doc_id").alias("component_id"))
    )
    by_vertex = kept(by_vertex, "near-components")
    return rows.join(by_vertex, "vertex", "left").select(
        "doc_id",
        "vertex",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )
