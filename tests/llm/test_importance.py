"""Target resampling against plain loops, and the ranks against one sort."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from siltstone.llm import importance
from siltstone.llm.importance import ranked_by_regular_sampling, resample

from samples import nothing, odd, odd_rows, prose  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    runs = [" ".join(words[i : i + n]) for n in range(1, size + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def plain(rows, target, size=1, percent=10, least=20):
    found = [(i, *features(t, size)) for i, t in rows]
    s = Counter(b for _, _, f in found for b in f)
    t = Counter(b for text in target for b in features(text, size)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in s}
    scored = []
    for doc_id, n_words, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((n_words, doc_id, len(f), weight, score))
    able = sorted(
        (r for r in scored if r[0] >= least),
        key=lambda r: (-r[4], r[1] is None, r[1] if r[1] is not None else 0, r[3], r[2]),
    )
    drawn = len(able) * percent // 100
    out = Counter((*r[1:], i + 1 if i < drawn else None) for i, r in enumerate(able))
    return out + Counter((*r[1:], None) for r in scored if r[0] < least)


def test_odd_rows(spark, odd, odd_rows):
    target = [None, "", odd_rows[0][1][:200], "All rights reserved reserved"]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    rows = [(i, t) for i, t, *_ in odd_rows]
    assert Counter(map(tuple, resample(odd, wanted).collect())) == plain(rows, target)
    many = resample(odd, wanted, percent=90, least_words=1, size=2, segment_rows=3)
    assert Counter(map(tuple, many.collect())) == plain(rows, target, size=2, percent=90, least=1)


def test_a_hot_source_over_many_segments(spark):
    rng = random.Random(8)
    hot = prose(rng, 30)
    rows = [(i, hot if i % 3 == 0 else prose(rng, rng.randint(0, 60))) for i in range(900)]
    target = [prose(rng, 40) for _ in range(5)] + [hot]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = resample(docs, wanted, segment_rows=10)
    assert Counter(map(tuple, found.collect())) == plain(rows, target)


@pytest.mark.parametrize("n, segment_rows, first", [(0, 5, 3), (1, 5, 1), (40, 1, 40), (1000, 7, 333), (1000, 50, 0)])
def test_ranks_are_those_of_one_sort(spark, n, segment_rows, first):
    rng = random.Random(n + first)
    rows = [(rng.choice([None, *range(n)]), rng.randint(-4, 4), 1, rng.randint(0, 3)) for _ in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, score long, n_features long, weight long").repartition(5)
    found = ranked_by_regular_sampling(df, first, segment_rows)
    key = lambda r: (-r[1], r[0] is None, r[0] or 0, r[3])
    expected = Counter((*r, i + 1 if i < first else None) for i, r in enumerate(sorted(rows, key=key)))
    assert Counter(map(tuple, found.collect())) == expected


def test_segments_stay_near_their_size(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "id * 7919 % 20011 AS score", "1L AS weight", "1L AS n_features")
    runs = rows.repartition(16).sortWithinPartitions("score", ascending=False).selectExpr("*", "monotonically_increasing_id() AS n")
    runs = runs.selectExpr("doc_id", "score", "n >> 33 AS run", "n & 8589934591 AS at").cache()
    splitters = importance._splitters(runs, 20_000, 500)
    bounds = [-(1 << 40), *(-s for s, _ in splitters), 1 << 40]
    scores = sorted(-r["score"] for r in runs.collect())
    runs.unpersist()
    sizes = [sum(a <= s < b for s in scores) for a, b in zip(bounds, bounds[1:])]
    assert len(sizes) == 40 and max(sizes) <= 3 * 500


def test_no_rows(spark, nothing):
    assert resample(nothing, nothing).collect() == []
