"""Resampling towards a target: weights from an array of bucket gains, ranks by regular sampling.

The first pass turns every text into the buckets of its words, two bytes each, and counts buckets.
The gains of all buckets are one array; a document's weight is the mean of what its buckets pick
from it. Ranks come from a parallel sort by regular sampling: runs are sorted where they
lie, every so many rows of a run are its sample, splitters are taken from the sorted samples at
regular places, each segment between two splitters is merged in a task of its own, and the counts of the
segments before give every row its exact rank.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import kept, whole_text

BUCKETS = 10_000
#: Rows that a segment of the sort aims at; it never holds more than three times as many.
SEGMENT_ROWS = 500_000
#: Words that a worker remembers the bucket of.
CACHE_WORDS = 1_000_000
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its lower 33 bits

# Words are runs of digits, ASCII letters and all that is not ASCII; A-Z are lowered.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class _Buckets(dict):
    """Buckets of words, remembered up to a fixed number."""

    def __missing__(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % BUCKETS
        if len(self) < CACHE_WORDS:
            self[word] = bucket
        return bucket


_buckets = _Buckets()


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text."""
    return text.translate(_WORD_BYTES).split()


def buckets_of(words: list[bytes], size: int = 1) -> np.ndarray:
    """The bucket of every run of 1 to ``size`` consecutive words."""
    found = list(map(_buckets.__getitem__, words))
    for n in range(2, size + 1):
        runs = zip(*(words[i:] for i in range(n)))
        found += [zlib.crc32(b" ".join(run)) % BUCKETS for run in runs]
    return np.array(found, dtype="<u2")


def _bucketed(texts: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_words, buckets) of (doc_id, text)."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Arrow batches count rows; long texts are taken a few megabytes at a time.
            raw = batch.column(1).cast(pa.binary())
            for start in range(0, batch.num_rows, 500):
                counts, found = [], []
                for text in raw.slice(start, 500):
                    words = words_of(text.as_py())
                    counts.append(len(words))
                    found.append(buckets_of(words, size).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, 500), pa.array(counts, pa.int64()), pa.array(found, pa.binary())],
                    ["doc_id", "n_words", "buckets"],
                )

    return texts.mapInArrow(convert, "doc_id long, n_words long, buckets binary")


def _bucket_counts(rows: DataFrame) -> np.ndarray:
    """How often each bucket occurs; a task sends its counts, the driver gets one number per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for buckets in batch.column(0):
                total += np.bincount(np.frombuffer(buckets.as_buffer(), "<u2"), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counts = np.zeros(BUCKETS, dtype=np.int64)
    tallies = rows.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    for bucket, n in tallies.collect():  # at most BUCKETS rows
        counts[bucket] = n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floor of a thousand times the log of its smoothed share in the target over that in the corpus."""
    own, wanted = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array(
        [
            math.floor(1000 * math.log(((t + 1) * own) / ((s + 1) * wanted)))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def noise(seed: str, doc_id: object) -> int:
    """What chance adds to a document's weight: a Gumbel value in thousandths, from a digest of its id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(docs: DataFrame, target: DataFrame, seed: str, size: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of all documents; ``target`` holds texts like the ones wanted."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    wanted = target.select(F.lit(0).cast("long").alias("doc_id"), whole_text(target).alias("text"))
    rows = kept(_bucketed(texts, size), "word-buckets")
    table = gains(_bucket_counts(rows), _bucket_counts(_bucketed(wanted, size)))
    shared = docs.sparkSession.sparkContext.broadcast(table)  # one number per bucket

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            found = [np.frombuffer(b.as_buffer(), "<u2") for b in batch.column(2)]
            sizes = np.array([len(f) for f in found], dtype=np.int64)
            sums = np.array([int(gain[f].sum()) for f in found], dtype=np.int64)
            weights = sums // np.maximum(sizes, 1)
            scores = weights + np.array([noise(seed, i) for i in batch.column(0).to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, (sizes, weights, scores))],
                ["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long, score long")


# -- sorting ------------------------------------------------------------------

_LAST_ID = (1 << 63) - 1  # a NULL id comes last


def _splitters(runs: DataFrame, n_rows: int, segment_rows: int) -> list[tuple[int, int]]:
    """(score, doc_id) that open the segments after the first one.

    Every run gives each ``step``-th of its rows. Runs are grouped, and a group's sorted samples
    are sampled again, so the driver holds about the square root of the runs times the segments.
    """
    segments = -(-n_rows // segment_rows)
    if segments < 2:
        return []
    n_runs = runs.agg(F.max("run")).first()[0] + 1
    step = max(1, segment_rows // n_runs)
    groups = math.isqrt(n_runs - 1) + 1

    def thin(batch: pd.DataFrame) -> pd.DataFrame:
        order = np.lexsort((batch["doc_id"], -batch["score"]))[groups // 2 :: groups]
        return batch.iloc[order][["score", "doc_id"]]

    samples = runs.filter(F.col("at") % step == step // 2).select(
        (F.col("run") % groups).alias("batch"), "score", F.coalesce("doc_id", F.lit(_LAST_ID)).alias("doc_id")
    )
    thinned = samples.groupBy("batch").applyInPandas(thin, "score long, doc_id long").collect()
    ordered = sorted((-r["score"], r["doc_id"]) for r in thinned)
    places = {len(ordered) * i // segments for i in range(1, segments)}
    return [(-score, doc_id) for score, doc_id in (ordered[p] for p in sorted(places))]


def ranked_by_regular_sampling(rows: DataFrame, first: int, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3 ... by falling score, then rising doc_id, for the ``first`` ones, else NULL.

    Rows alike in both columns are put in the order of their weights and sizes; NULL ids come last. Only
    segments with a rank to give are exchanged and merged.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "weight", "n_features"]
    marked = rows.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    runs = kept(marked, "sorted-runs")
    plain = runs.columns[:-1]
    runs = runs.withColumn("run", F.shiftright("at", _ROW_BITS)).withColumn(
        "at", F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    splitters = _splitters(runs, runs.count(), segment_rows)
    opens = np.array([(-s, i) for s, i in splitters], dtype=np.int64).reshape(-1, 2)
    shared = rows.sparkSession.sparkContext.broadcast(opens)  # one pair per segment

    @F.pandas_udf("int")
    def segment_of(score: pd.Series, doc_id: pd.Series) -> pd.Series:
        bounds = shared.value
        score, ids = -score.to_numpy(np.int64), doc_id.to_numpy(np.int64)
        # Bounds ascend, so counting the ones at or before a row is a search in two steps.
        low = np.searchsorted(bounds[:, 0], score, "left")
        high = np.searchsorted(bounds[:, 0], score, "right")
        tied = np.flatnonzero(low < high)
        for i in tied.tolist():
            low[i] += np.searchsorted(bounds[low[i] : high[i], 1], ids[i], "right")
        return pd.Series(low.astype(np.int32))

    dealt = kept(
        runs.select(*plain, segment_of("score", F.coalesce("doc_id", F.lit(_LAST_ID))).alias("segment")), "segments"
    )
    sizes = dict(dealt.groupBy("segment").agg(F.count("*")).collect())  # one row per segment
    before, total = {}, 0
    for segment in sorted(sizes):
        before[segment], total = total, total + sizes[segment]
    wanted = [s for s in before if before[s] < first]
    unranked = F.lit(None).cast("long")
    rest = dealt.filter(F.col("segment") > max(wanted, default=-1)).select(*plain, unranked.alias("rank"))
    if not wanted:
        return rest

    # Segment s is partition s: merged by Spark's sort, which spills, and numbered as it streams by.
    merged = (
        dealt.filter(F.col("segment") <= wanted[-1])
        .repartitionById(len(splitters) + 1, "segment")
        .sortWithinPartitions("segment", *order)
    )
    own = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    offsets = rows.sparkSession.createDataFrame(sorted(before.items()), "segment int, before long")
    place = F.col("before") + F.col("own") + 1
    # Broadcast: one row per segment.
    ranks = merged.withColumn("own", own).join(F.broadcast(offsets), "segment")
    return ranks.select(*plain, F.when(place <= first, place).alias("rank")).unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    seed: str = "2024",
    size: int = 1,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank (NULL where it is not drawn).

    Of the documents with at least ``least_words`` words ``percent`` per cent are drawn, without replacement and
    with odds that follow the weights: the highest sums of weight and Gumbel noise. Features are runs of 1 to
    ``size`` words. NULL and empty texts have no features and weight 0; a NULL id takes the noise of an empty id and
    comes last among equal scores, and rows that share an id share its noise. An empty target gives weights
    against a flat one; no rows give no rows. Other columns are not read.

    Texts are read once and not shuffled; two bytes per word are written. The driver gets a number per
    bucket and per segment, and samples.
    """
    rows = kept(scored(docs, target, seed, size), "scores")
    drawn = rows.filter(F.col("n_words") >= least_words)
    total = drawn.count()
    ranks = ranked_by_regular_sampling(drawn, percent * total // 100, segment_rows)
    rest = rows.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranks.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
