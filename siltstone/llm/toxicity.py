"""A convolutional toxicity classifier: hashed word embeddings, several filter widths, max pooling."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import kept, whole_text

#: Labelled documents that a model is fitted on, at most, chosen by a hash of their ids; a fifth of them is left out.
TRAINING_ROWS = 12_000
WIDTHS = (1, 2, 3)
FILTERS = 8
#: A word has a row in each table: two from halves of its 32-bit hash, so that words rarely share
#: both, and one from the hash of its first bytes, which inflected forms share. The rows stand side by side.
TABLES = 3
TABLE_ROWS = 1 << 16
TABLE_DIMS = 8
STEM_BYTES = 5
BATCH = 64
#: Batches that a fit takes, spread over as many whole passes as that gives, within bounds.
STEPS = 1_050
PASSES = (7, 30)
#: Labelled positives that a language needs for a threshold of its own.
LANGUAGE_POSITIVES = 20
#: The share of clean documents that a language's threshold may reject.
FALSE_ALARMS = 0.002
#: The share of toxic documents that it may miss, and the share of clean ones that it may reject to miss no more.
MISSES = 0.05
MOST_FALSE_ALARMS = 0.01
#: Scores are counted in so many steps for the thresholds.
SCORE_STEPS = 1024
_PAD = TABLE_ROWS  # a row of zeros
_WORDS = bytes(
    c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)
)


def word_rows(text: str) -> np.ndarray:
    """Table rows [TABLES, n] of a text's words: runs of ASCII letters and digits and of other characters beyond ASCII."""
    words = text.encode("utf-8", "replace").lower().translate(_WORDS).split()
    whole = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    stems = np.fromiter((zlib.crc32(w[:STEM_BYTES]) for w in words), np.uint32, len(words))
    return np.stack([whole & 0xFFFF, whole >> 16, stems & 0xFFFF]).astype(np.uint16)


@dataclass
class Model:
    """Weights, and a score from which a document counts as toxic per language ("" for others)."""

    tables: np.ndarray  # [TABLES, TABLE_ROWS + 1, TABLE_DIMS]
    filters: list[np.ndarray]  # per width [width, TABLES * TABLE_DIMS, FILTERS]
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    thresholds: dict[str, float] = field(default_factory=lambda: {"": 0.5})

    def words(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([table[own] for table, own in zip(self.tables, rows)], axis=-1)

    def _pooled(self, found: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list]:
        """Rows of the word tables, starts of the documents, and per width all windows.

        A document's words are followed by as many pads as the widest filter has
        places; its windows start at its words and at the first pad, so that a
        document without words has one too.
        """
        pads = max(WIDTHS)
        lengths = np.array([f.shape[1] + pads for f in found])
        starts = np.concatenate([[0], np.cumsum(lengths)])
        rows = np.full((TABLES, starts[-1] + pads), _PAD, dtype=np.int64)
        for at, own in zip(starts.tolist(), found):
            rows[:, at : at + own.shape[1]] = own
        words = self.words(rows)
        n = int(starts[-1])
        windows = []
        for width, filters in zip(WIDTHS, self.filters):
            total = words[:n] @ filters[0]
            for j in range(1, width):
                total += words[j : n + j] @ filters[j]
            windows.append(total)
        return rows, starts, windows

    def score(self, found: Sequence[np.ndarray]) -> np.ndarray:
        """Scores of texts, given as their word rows."""
        _, starts, windows = self._pooled(found)
        cuts = np.empty(2 * len(found), dtype=np.int64)
        cuts[::2] = starts[:-1]
        cuts[1::2] = starts[1:] - max(WIDTHS) + 1
        pooled = np.concatenate([np.maximum.reduceat(w, cuts, axis=0)[::2] for w in windows], axis=1)
        hidden = np.maximum(pooled + self.bias, 0)
        return 1 / (1 + np.exp(-(hidden @ self.weights + self.offset)))

    def threshold(self, lang: str | None) -> float:
        return self.thresholds.get(lang or "", self.thresholds[""])


def _new_model(prior: float, rng: np.random.Generator) -> Model:
    tables = rng.normal(0, 0.05, (TABLES, TABLE_ROWS + 1, TABLE_DIMS)).astype(np.float32)
    tables[:, _PAD] = 0
    filters = [
        rng.normal(0, 0.5 / np.sqrt(w), (w, TABLES * TABLE_DIMS, FILTERS)).astype(np.float32) for w in WIDTHS
    ]
    size = FILTERS * len(WIDTHS)
    odds = float(np.log(prior / (1 - prior))) if 0 < prior < 1 else (20.0 if prior else -20.0)
    return Model(
        tables,
        filters,
        np.zeros(size, np.float32),
        rng.normal(0, 0.3, size).astype(np.float32),
        odds,
    )


def fit(found: Sequence[np.ndarray], toxic: Sequence[int], seed: int = 7) -> Model:
    """Fit on the word rows of whole texts; the thresholds are chosen later, on rows that were not fitted on.

    Only the window that wins the pooling passes its error back, to the filter and
    to the embeddings of its words, each with a step that shrinks as it is used (Adagrad).
    """
    rng = np.random.default_rng(seed)
    y = np.asarray(toxic, dtype=np.float32)
    prior = float(y.mean()) if len(y) else 0.0
    model = _new_model(prior, rng)
    if not 0 < prior < 1:
        model.weights[:] = 0
        return model
    own = rng.permutation(len(y))
    seen = {"tables": np.full(model.tables.shape[:2], 1e-3, np.float32)}
    slow = {k: 1e-3 for k in ("bias", "weights", "offset", *range(len(WIDTHS)))}
    rate = 0.15
    for _ in range(int(np.clip(STEPS * BATCH // max(1, len(own)), *PASSES))):
        rng.shuffle(own)
        for first in range(0, len(own), BATCH):
            batch = own[first : first + BATCH]
            _step(model, [found[i] for i in batch], y[batch], rate, seen, slow)
    return model


def _step(model: Model, found: list, y: np.ndarray, rate: float, seen: dict, slow: dict) -> None:
    rows, starts, windows = model._pooled(found)
    pads, n = max(WIDTHS), len(found)
    best = [
        np.stack([a + w[a : b - pads + 1].argmax(axis=0) for a, b in zip(starts[:-1], starts[1:])])
        for w in windows
    ]  # per width [documents, filters]
    columns = np.arange(FILTERS)
    pooled = np.concatenate([w[b, columns] for w, b in zip(windows, best)], axis=1)
    before = pooled + model.bias
    hidden = np.maximum(before, 0)
    p = 1 / (1 + np.exp(-(hidden @ model.weights + model.offset)))
    error = (p - y) / n
    to_hidden = np.outer(error, model.weights) * np.where(before > 0, 1, 0.05)  # a leak revives idle filters

    def move(name, value, gradient):
        slow[name] = slow[name] + gradient * gradient
        return value - rate * 0.5 * gradient / np.sqrt(slow[name])

    gradients = [np.zeros_like(f) for f in model.filters]
    where: list[np.ndarray] = []
    what: list[np.ndarray] = []
    for k, width in enumerate(WIDTHS):
        own = to_hidden[:, k * FILTERS : (k + 1) * FILTERS]
        for j in range(width):
            at = best[k] + j
            gradients[k][j] = np.einsum("df,dfe->ef", own, model.words(rows[:, at]))
            where.append(at.ravel())
            what.append((own[:, :, None] * model.filters[k][j].T[None]).reshape(-1, TABLES * TABLE_DIMS))
    model.weights = move("weights", model.weights, error @ hidden).astype(np.float32)
    model.offset = float(move("offset", model.offset, error.sum()))
    model.bias = move("bias", model.bias, to_hidden.sum(axis=0)).astype(np.float32)
    for k, gradient in enumerate(gradients):
        model.filters[k] = move(k, model.filters[k], gradient).astype(np.float32)
    at, change = np.concatenate(where), np.concatenate(what)
    for table in range(TABLES):
        touched, slot = np.unique(rows[table][at], return_inverse=True)
        total = np.zeros((len(touched), TABLE_DIMS), np.float32)
        np.add.at(total, slot, change[:, table * TABLE_DIMS : (table + 1) * TABLE_DIMS])
        total[touched == _PAD] = 0
        seen["tables"][table, touched] += (total * total).mean(axis=1)
        model.tables[table, touched] -= rate * total / np.sqrt(seen["tables"][table, touched])[:, None]


def _threshold(clean: np.ndarray, toxic: np.ndarray) -> float:
    """From the counts of clean and toxic documents per score step.

    The lowest threshold of 0.3 or more that rejects at most ``FALSE_ALARMS`` of the clean ones. Where
    that misses more than ``MISSES`` of the toxic ones, the highest that does not, or, if that rejects
    more than ``MOST_FALSE_ALARMS`` of the clean ones, the lowest that rejects no more.
    """
    if not clean.sum():
        return 0.5

    def least(share: float) -> int:
        rejected = np.append(clean[::-1].cumsum()[::-1], 0)  # by the step that the threshold starts
        return int(np.argmax(rejected <= share * clean.sum()))

    step = min(max(least(FALSE_ALARMS), math.ceil(0.3 * SCORE_STEPS)), int(0.95 * SCORE_STEPS))
    if toxic.sum():
        missed = np.append(0, toxic.cumsum())
        highest = int(np.flatnonzero(missed <= MISSES * toxic.sum())[-1])
        if highest < step:
            step = min(step, max(highest, least(MOST_FALSE_ALARMS)))
    return step / SCORE_STEPS


def _thresholds(counts: Iterable[tuple[str | None, int, int, int]]) -> dict[str, float]:
    """Thresholds per language from (language, toxic, score step, documents); languages with few toxic ones use that of all."""
    by_lang: dict[str, np.ndarray] = {"": np.zeros((2, SCORE_STEPS), np.int64)}
    for lang, toxic, step, n in counts:
        by_lang[""][toxic, step] += n
        if lang:
            by_lang.setdefault(lang, np.zeros((2, SCORE_STEPS), np.int64))[toxic, step] += n
    return {
        lang: _threshold(*own) for lang, own in by_lang.items() if not lang or own[1].sum() >= LANGUAGE_POSITIVES
    }


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _known(labels: DataFrame) -> DataFrame:
    """One row per labelled id that is not held out: toxic if one of its labels says so."""
    known = labels.select(labels["doc_id"].alias("label_id"), labels["toxic"].alias("is_toxic")).dropna()
    return (
        known.filter(~held_out(F.col("label_id")))
        .groupBy("label_id")
        .agg((F.max("is_toxic") > 0).cast("int").alias("is_toxic"))
    )


def training_ids(labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """The ids to fit on: four fifths, by another hash, of the first ``rows`` by a hash."""
    first = _known(labels).orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
    return first.filter(F.pmod(F.xxhash64("label_id", F.lit("fit")), F.lit(5)) != 0)


def score_counts(docs: DataFrame, labels: DataFrame, fitted: DataFrame, model: Model) -> DataFrame:
    """(lang, is_toxic, step, n): all documents with a label, neither held out nor fitted on, by their scores.

    Documents are scored where they are read; only ids, languages and score steps are joined to the labels. (A
    join before the scores saves a quarter of the time and shuffles every text.)
    """
    scores = docs.filter(docs["doc_id"].isNotNull() & ~held_out(docs["doc_id"])).select(
        docs["doc_id"].alias("label_id"),
        docs["lang"].cast("string").alias("lang"),
        _scorer(docs.sparkSession, model)(whole_text(docs)).alias("score"),
    )
    step = F.least(F.floor(F.col("score") * SCORE_STEPS), F.lit(SCORE_STEPS - 1)).cast("int")
    # Broadcast: never more than the ids that were fitted on.
    others = _known(labels).join(F.broadcast(fitted.select("label_id")), "label_id", "left_anti")
    return (
        scores.select("label_id", "lang", step.alias("step"))
        .join(others, "label_id")
        .groupBy("lang", "is_toxic", "step")
        .agg(F.count("*").alias("n"))
    )


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """A model fitted on at most ``rows`` labelled documents, with thresholds from all others; none of them is held out.

    Which ones it is fitted on is settled by hashes of the ids, so it does not depend on how the
    tables are stored. An id that is labelled twice is toxic if one label says
    so, of rows that share an id the first text is fitted on and all count for the thresholds; NULL ids and
    labels teach nothing. Without labels of both kinds the score is the share of toxic ones (0 without any).
    """
    fitted = kept(training_ids(labels, rows), "training-ids")
    texts = docs.select(docs["doc_id"].alias("label_id"), whole_text(docs).alias("text"))
    # Broadcast: never more than ``rows`` ids.
    sample = (
        texts.join(F.broadcast(fitted), "label_id")
        .groupBy("label_id")
        .agg(F.min("text").alias("text"), F.max("is_toxic").alias("is_toxic"))
        .orderBy("label_id")
    )
    found, toxic = [], []
    for row in sample.toLocalIterator():  # a partition at a time; only word rows are kept
        found.append(word_rows(row["text"]))
        toxic.append(row["is_toxic"])
    model = fit(found, toxic)
    if len(set(toxic)) == 2:
        model.thresholds = _thresholds(tuple(r) for r in score_counts(docs, labels, fitted, model).toLocalIterator())
    return model


def _scorer(spark: SparkSession, model: Model):
    """A function of whole texts; they are scored in Arrow batches, a few megabytes at a time."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scorer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            found = []
            piece: list[np.ndarray] = []
            chars = 0
            for text in texts:
                piece.append(word_rows(text))
                chars += len(text)
                if chars > 300_000 or len(piece) >= 500:
                    found.append(own.score(piece))
                    piece, chars = [], 0
            if piece:
                found.append(own.score(piece))
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    return scorer


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``toxic`` (score at or above the language's threshold).

    NULL and empty texts get the score of no words. ``lang`` chooses the threshold and is no input of the
    score. All columns of ``docs`` are kept except ones of these two names, which are replaced.
    """
    plain = docs.drop("score", "toxic", "__score")

    threshold = F.lit(model.thresholds[""])
    for lang, least in model.thresholds.items():
        if lang:
            threshold = F.when(plain["lang"] == lang, F.lit(least)).otherwise(threshold)
    scored = plain.withColumn("score", _scorer(docs.sparkSession, model)(whole_text(plain)))
    return scored.withColumn("toxic", F.col("score") >= threshold)

