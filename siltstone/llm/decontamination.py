"""Benchmark items inside documents: SimHash of item-sized windows, multi-index lookup, exact check."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import whole_text
from siltstone.llm.shingles import hashed, shingle_hashes

BITS = 64
#: Items whose index is sent to the workers at once; more items take more passes over the documents.
BLOCK_ITEMS = 20_000
_BYTES = BITS // 8
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
# What ASCII texts are cut by: letters and digits are left.
_WORDS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


class _Letters(dict):
    """For str.translate: a blank for every character that is no Unicode letter, mark or digit, found once each."""

    def __missing__(self, code: int) -> int:
        self[code] = found = code if unicodedata.category(chr(code))[0] in "LMN" else 0x20
        return found


_LETTERS = _Letters()
LEAKS = "array<struct<item_id:bigint,start:bigint,n_words:bigint,similarity:double>>"


def word_hashes(text: str) -> np.ndarray:
    """A hash per word: runs of Unicode letters, marks and digits, without case and in composed form."""
    if text.isascii():
        return hashed(text.encode().lower().translate(_WORDS).split())
    # Folded, not lowered: the capitals of a sharp s are SS.
    plain = unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).casefold())
    return hashed([w.encode("utf-8", "replace") for w in plain.translate(_LETTERS).split()])


def radius(similarity: float) -> int:
    """Differing bits that hardly any pair of the least similarity exceeds.

    Sets of one size with that similarity (Jaccard) share 2j / (1 + j) of their weight, the cosine of
    the angle that decides a bit; four deviations are added to the bits that differ on average.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return min(BITS, math.ceil(BITS * share + 4 * math.sqrt(BITS * share * (1 - share))))


def _signs(shingles: np.ndarray) -> np.ndarray:
    """[n, 64] of +1 and -1, the bits of each shingle."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, _BYTES), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1)


def _similarity(window: np.ndarray, item: Counter) -> float:
    """Weight that both hold over the weight that either holds; a shingle weighs as often as it stands."""
    own = Counter(window.tolist())
    both = sum(min(n, item[s]) for s, n in own.items() if s in item)
    return both / (sum(own.values()) + sum(item.values()) - both)


@dataclass
class _Size:
    """The items of one length, by fingerprint.

    A fingerprint within the radius agrees with an item's up to ``radius // 8`` bits in at least one of its eight
    bytes, as more in each would exceed the radius. So per byte and value a row of bits
    names the items whose byte is that close, and the rows of a window's bytes, put together, hold every item in reach.
    """

    words: int
    ids: list
    weights: list[Counter]
    prints: np.ndarray  # [items, 8]
    near: np.ndarray  # [8, 256, items / 8]

    @classmethod
    def of(cls, words: int, items: list[tuple[object, np.ndarray]], reach: int) -> _Size:
        prints = np.concatenate([_fingerprints(_signs(s).sum(axis=0)[None]) for _, s in items])
        values = np.arange(256, dtype=np.uint8)
        close = _ONES[values[None, :, None] ^ prints.T[:, None, :]] <= reach // _BYTES
        return cls(
            words, [i for i, _ in items], [Counter(s.tolist()) for _, s in items], prints, np.packbits(close, axis=2)
        )

    def candidates(self, prints: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
        """(window, item) of all fingerprints within the radius."""
        for first in range(0, len(prints), 4096):
            own = prints[first : first + 4096]
            rows = self.near[0][own[:, 0]]
            for j in range(1, _BYTES):
                rows = rows | self.near[j][own[:, j]]
            window, item = np.nonzero(np.unpackbits(rows, axis=1, count=len(self.ids)))
            bits = _ONES[own[window] ^ self.prints[item]].sum(axis=1)
            hit = bits <= reach
            yield from zip((window[hit] + first).tolist(), item[hit].tolist())


class Index:
    """A block of items; texts are searched for windows like one of them."""

    def __init__(self, items: Sequence[tuple[object, str]], words: int, similarity: float):
        self.shingle, self.similarity, self.reach = words, similarity, radius(similarity)
        by_size: dict[int, list] = {}
        for item_id, text in items:
            found = word_hashes(text)
            if len(found):
                by_size.setdefault(len(found), []).append((item_id, shingle_hashes(found, words)))
        self.sizes = [_Size.of(n, own, self.reach) for n, own in sorted(by_size.items())]
        # Which sizes a shingle occurs in: a window like an item holds a shingle of it.
        pairs = sorted({(int(s), k) for k, size in enumerate(self.sizes) for w in size.weights for s in w})
        self.shingles = np.array([s for s, _ in pairs], dtype=np.uint64)
        self.size_of = np.array([k for _, k in pairs], dtype=np.int64)
        self.gate = np.zeros(1 << 20, dtype=bool)
        self.gate[(self.shingles >> np.uint64(44)).astype(np.int64)] = True

    def _hits(self, shingles: np.ndarray) -> dict[int, np.ndarray]:
        """Places of shingles that some item holds, by size."""
        place = np.flatnonzero(self.gate[(shingles >> np.uint64(44)).astype(np.int64)])
        low = np.searchsorted(self.shingles, shingles[place], "left")
        times = np.searchsorted(self.shingles, shingles[place], "right") - low
        if not times.sum():
            return {}
        at = np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
        sizes, places = self.size_of[at], np.repeat(place, times)
        return {int(k): places[sizes == k] for k in np.unique(sizes)}

    def search(self, text: str) -> list[dict]:
        """The best window per item that is similar enough: the most similar, then the first."""
        words = word_hashes(text)
        best: dict[object, tuple[float, int, int]] = {}
        by_width: dict[int, tuple[np.ndarray, dict]] = {}
        for size_no, size in enumerate(self.sizes):
            width = min(self.shingle, size.words)
            if width not in by_width:
                shingles = shingle_hashes(words, width) if len(words) >= width else words[:0]
                by_width[width] = shingles, self._hits(shingles) if len(shingles) else {}
            shingles, hits = by_width[width]
            places, n = hits.get(size_no), size.words - width + 1
            if places is None or len(shingles) < n:
                continue
            # Starts of the windows that hold a hit, and the runs they form.
            covered = np.zeros(len(shingles) - n + 2, dtype=np.int32)
            np.add.at(covered, np.clip(places - n + 1, 0, len(covered) - 1), 1)
            np.add.at(covered, np.clip(places + 1, 0, len(covered) - 1), -1)
            starts = np.flatnonzero(np.cumsum(covered)[:-1] > 0)
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1) if len(starts) else []:
                self._search_run(shingles, int(run[0]), int(run[-1]), n, size, best)
        return [
            {"item_id": i, "start": start, "n_words": n, "similarity": s}
            for i, (s, start, n) in sorted(best.items(), key=lambda x: (x[0] is None, x[0]))
        ]

    def _search_run(self, shingles, first: int, last: int, n: int, size: _Size, best: dict) -> None:
        for a in range(first, last + 1, 8192):
            b = min(last, a + 8191)
            signs = _signs(shingles[a : b + n])
            sums = np.zeros((len(signs) + 1, BITS), dtype=np.int32)
            np.cumsum(signs, axis=0, out=sums[1:])
            prints = _fingerprints(sums[n:] - sums[:-n])
            for window, item in size.candidates(prints, self.reach):
                at = a + window
                found = _similarity(shingles[at : at + n], size.weights[item])
                key = size.ids[item]
                if found >= self.similarity and (key not in best or (-found, at) < (-best[key][0], best[key][1])):
                    best[key] = (found, at, size.words)


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The items in id order, a bounded block at a time."""
    rows = items.select(items["item_id"].cast("long").alias("item_id"), whole_text(items).alias("text"))
    block: list[tuple[object, str]] = []
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        if len(block) == BLOCK_ITEMS:
            yield block
            block = []
    if block:
        yield block


def _searcher(shared: Broadcast):
    @F.pandas_udf(LEAKS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = shared.value
        for texts in batches:
            yield pd.Series([index.search(t) for t in texts])

    return search


def with_leaks(docs: DataFrame, items: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with ``leaks``: per item found in the text its best window (item_id, start, n_words, similarity).

    An item is found if a window of as many words has a weighted similarity (Jaccard over counted
    shingles of ``words`` words, or of the whole item where it is shorter) of at least ``similarity``. Words are runs of
    Unicode letters, marks and digits, compared case-folded and in composed form. Windows that share no shingle with an item of their size have similarity 0 and get no
    fingerprint; of the others all do, and all within the radius are compared exactly.

    Items are the query set: they are indexed a block at a time, and each block is sent to the
    workers. Documents are scanned where they are read; no rows are shuffled. NULL and empty texts have
    no leaks, and items without words are never found; items that repeat an id count as one, the best
    window of any. No items give empty lists. A column of the name ``leaks`` is replaced, all others are kept.
    """
    spark = docs.sparkSession
    plain = docs.drop("leaks")
    found = F.array().cast(LEAKS)
    for block in _blocks(items):
        shared = spark.sparkContext.broadcast(Index(block, words, similarity))
        found = F.concat(found, _searcher(shared)(whole_text(plain)))
    return plain.withColumn("leaks", found)
