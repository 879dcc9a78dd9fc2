"""Exact duplicates against plain grouping, and the filters against a plain counter."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.llm import exact_dups, quotient_filter
from siltstone.llm.exact_dups import build_filters, exact_duplicates, merge_filters, repeated, without_copies

from samples import nothing, odd, odd_rows  # noqa: F401

COUNTS = st.dictionaries(
    st.one_of(st.integers(0, (1 << 61) - 1), st.integers(0, 300)), st.integers(1, 1 << 40), max_size=60
)


def plain(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    out = []
    for i, text in rows:
        ids = groups[text or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return Counter(out)


def filter_of(counts):
    keys = sorted(counts)
    return quotient_filter.encode(
        np.array(keys, dtype=np.uint64), np.array([counts[k] for k in keys], dtype=np.int64), 3
    )


def content(data):
    fingerprints, counts = quotient_filter.decode(data)
    return list(zip(fingerprints.tolist(), counts.tolist()))


@settings(max_examples=150, deadline=None)
@given(COUNTS, COUNTS)
def test_filters_keep_and_merge_all_counts(a, b):
    assert content(filter_of(a)) == sorted(a.items())
    both = Counter(a) + Counter(b)
    assert content(quotient_filter.merge([filter_of(a), filter_of(b)])) == sorted(both.items())


def test_hot_fingerprints_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(exact_dups, "TASK_FINGERPRINTS", 50)
    hashes = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.xxhash64(F.col("id") % 1500)).alias("h")
    )
    expected = Counter(r["h"] for r in hashes.collect())
    one, two = (merge_filters(build_filters(part, 4)) for part in hashes.randomSplit([0.5, 0.5], seed=3))
    found = repeated(merge_filters(one.union(two)))
    assert {tuple(r) for r in found.collect()} == {(h, n) for h, n in expected.items() if n > 1}


def test_odd_rows(spark, odd, odd_rows):
    found = Counter(map(tuple, exact_duplicates(odd).collect()))
    assert found == plain([(i, t) for i, t, *_ in odd_rows])


def test_colliding_fingerprints_do_not_join_texts(spark, odd, odd_rows):
    weak = exact_duplicates(odd, fingerprint=lambda text: (F.length(text) % 3).cast("long"))
    assert Counter(map(tuple, weak.collect())) == plain([(i, t) for i, t, *_ in odd_rows])


def test_rows_that_stay(spark, odd, odd_rows):
    found = without_copies(odd)
    assert found.columns == odd.columns
    stay = {(r[0], r[4]) for r in plain([(i, t) for i, t, *_ in odd_rows]) if r[3]}
    texts = [(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in found.collect()]
    assert sorted(texts, key=str) == sorted(stay, key=str)


def test_no_rows(spark, nothing):
    assert exact_duplicates(nothing).collect() == []
    assert without_copies(nothing).collect() == []
