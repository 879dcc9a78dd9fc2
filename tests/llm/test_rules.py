"""Licences, quality and shards against plain Python."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter

from siltstone.llm import queries
from siltstone.llm.license_rules import BASE_PHRASES, Rule, rules
from siltstone.llm.license_scan import scan_licenses
from siltstone.llm.license_texts import BODIES
from siltstone.llm.quality import FEATURES, judge
from siltstone.llm.sharding import shards

from samples import SF, documents, nothing, odd, odd_rows, prose  # noqa: F401


def license_words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def base_places(words):
    found = []
    for phrase, label in BASE_PHRASES.items():
        own = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return found


def kept_labels(words, signatures):
    """Every rule tried everywhere; containment as stated."""
    text, hits = " " + " ".join(words) + " ", []
    for number, rule in enumerate(signatures):
        for m in re.finditer(f" (?:{rule.pattern})(?= )", text):
            start = text[: m.start()].count(" ")
            hits.append((start, -(start + m[0].count(" ")), -rule.priority, number, rule))
    kept = []
    for hit in sorted(hits, key=lambda h: h[:4]):
        if not any(k[1] <= hit[1] and k[2] <= hit[2] for k in kept):
            kept.append(hit)
    return {h[4].label for h in kept}, len(kept), max((h[4].confidence for h in kept), default=0.0)


def check_licenses(rows, texts, signatures):
    assert len(rows) == len(texts)
    expected = []
    for doc_id, text in texts:
        words = license_words(text)
        base = base_places(words)
        labels, n, score = kept_labels(words, signatures)
        own = {label for _, label in base}
        expected.append(
            (doc_id, len(words), len(base), min((p for p, _ in base), default=None), max((p for p, _ in base), default=None),
             ",".join(sorted(own)), ",".join(sorted(own | labels)), n, score)
        )
    key = lambda r: [(v is None, str(v)) for v in r]
    assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)


def test_licenses_of_all_documents(spark, documents):
    assert len(rules()) > 300
    check_licenses(queries.op3_signature_rules(spark, SF).collect(), list(documents.items()), rules())


def test_licenses_of_odd_rows(spark, odd, odd_rows, nothing):
    check_licenses(scan_licenses(odd).collect(), [(i, t) for i, t, _, _ in odd_rows], rules())
    assert scan_licenses(nothing).count() == 0


def test_license_texts(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0 (the License)",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "This is under Creative Commons Attribution-ShareAlike 4.0 International. cc by cc by-sa 3.0",
        "GNU Lesser General Public License v2.1 or any later version; all rights reserved ALL RIGHTS RESERVED",
        "The BSD 3-Clause License. Copyright (c) 2019 2020 X. Permission is hereby granted, free of charge, to any person obtaining a copy",
        "écc byé cc K by general public license general public license",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = scan_licenses(frame).collect()
    check_licenses(rows, list(enumerate(texts)), rules())
    labels = {r["doc_id"]: r["labels"] for r in rows}
    assert labels[0] == "apache-2.0"
    assert "gpl-2.0-or-later" in labels[1] and "cc-by-sa-4.0" in labels[2]


def sentence(pattern):
    """A text that a signature matches: the first of each choice, and nothing that may be missing."""
    before = None
    while pattern != before:
        before = pattern
        pattern = re.sub(
            r"\(\?:([^()|]*)(?:\|[^()]*)?\)(\?|\{\d+,\d+\})?",
            lambda m: "" if m[2] and (m[2] == "?" or m[2].startswith("{0")) else m[1],
            pattern,
        )
    pattern = re.sub(r"\[([^\]])[^\]]*\]\{(\d)\}", lambda m: m[1] * int(m[2]), pattern)
    pattern = re.sub(r"\[([^\]])[^\]]*\]", r"\1", pattern).replace("\\S+", "some")
    return " ".join(re.sub(r"(.)\?", r"\1", pattern).split())


def test_every_signature_finds_a_text_of_its_own(spark):
    assert len(BODIES) > 180 and len({label for label, _ in BODIES}) > 60
    texts = [sentence(pattern) for _, pattern in BODIES]
    texts = [t[0].upper() + t[1:].replace(" as is ", ' "AS IS", ') + "." for t in texts]
    frame = spark.createDataFrame([(i, f"Some words before. {t} And after.") for i, t in enumerate(texts)], "doc_id long, text string")
    labels = {r["doc_id"]: r["labels"].split(",") for r in scan_licenses(frame).collect()}
    missed = [(label, pattern) for i, (label, pattern) in enumerate(BODIES) if label not in labels[i]]
    # A sentence may lie inside a longer one, or inside a name with its version, which then stands for it.
    assert [m for m in missed if not labels[BODIES.index(m)] or labels[BODIES.index(m)] == [""]] == []
    assert len(missed) < 12, missed
    for rule in rules():
        assert rule.keyword in sentence(rule.pattern) or rule.keyword.startswith(" ") or rule.keyword.endswith(" "), rule


def test_a_whole_licence_text(spark):
    mit = """Copyright (c) 2021 Some One

    Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
    rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software. The above
    copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""
    french = "Tous droits réservés. Toute reproduction interdite. Este programa es software libre; alle Rechte vorbehalten"
    rows = [(1, mit), (2, french)]
    found = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["labels"] == "copyright,mit" and found[1]["n_hits"] >= 5
    assert found[2]["labels"] == "gpl,proprietary,reserved"
    check_licenses(list(found.values()), rows, rules())


def test_a_more_important_hit_hides_what_lies_inside_it(spark):
    signatures = [Rule("a", "x", "x y z", 2, 0.9), Rule("b", "y", "y z", 1, 0.5), Rule("c", "y", "y", 3, 0.7)]
    frame = spark.createDataFrame([(1, "x y z y z")], "doc_id long, text string")
    row = scan_licenses(frame, signatures).first()
    assert (row["labels"], row["n_hits"], row["score"]) == ("a,b,c", 4, 0.9)


def quality_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_quality_of_all_documents(spark, documents):
    for row in queries.op4_adaptive_thresholds(spark, SF).collect():
        counts = quality_counts(documents[row["doc_id"]])
        assert tuple(row[c] for c in COUNTS) == counts
        assert row["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (row["base_failed"] and row["kept"])


def test_quality_of_odd_rows(odd, odd_rows, nothing):
    rows = judge(odd).collect()
    key = lambda r: [(v is None, v or 0) for v in r]
    assert sorted(((r["doc_id"], *(r[c] for c in COUNTS)) for r in rows), key=key) == sorted(
        ((i, *quality_counts(t)) for i, t, _, _ in odd_rows), key=key
    )
    assert judge(nothing).count() == 0


def bucket(value):
    shift = max(value.bit_length() - 5, 0)
    return value >> shift << shift


def test_fences_follow_language_and_source(spark):
    """Symbols are usual in one source and odd in another; a small group uses its language's fence."""
    plain = " ".join(f"wort{i}" for i in range(60))
    noisy = " ".join(f"##wort{i}##" for i in range(60))
    rows = [(i, f"{plain} {i}", "en", "prose") for i in range(300)]
    rows += [(1000 + i, f"{noisy} {i}", "en", "tables") for i in range(300)]
    rows += [(2000, noisy, "en", "prose"), (3000, noisy, "fr", "new")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in judge(frame).collect()}
    assert all(kept[i] for i in range(300)) and all(kept[1000 + i] for i in range(300))
    assert not kept[2000]


def test_fences_from_a_plain_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = judge(docs, min_group=10**9).collect()  # all groups use all rows
    own = [r for r in rows if not r["base_failed"]]
    gone = set()
    for feature, fence in FEATURES.items():
        values = sorted(bucket(r[feature]) for r in own)
        low, high = (values[-(-len(values) * q // 1000) - 1] for q in (fence.lower, fence.upper))
        most, least = high + fence.reach * (high - low), low - fence.reach * (high - low)
        most = min(most, fence.cap or most)
        gone |= {i for i, r in enumerate(own) if bucket(r[feature]) > most}
        gone |= {i for i, r in enumerate(own) if fence.two_sided and bucket(r[feature]) < least}
    assert [r["kept"] for r in own] == [i not in gone for i in range(len(own))]
    assert not any(r["kept"] for r in rows if r["base_failed"]) and 0 < len(gone) < len(own) / 2


def test_what_is_odd_depends_on_the_source(spark):
    """Symbols that a source always has are no junk there, and a few documents with them are elsewhere."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        text = prose(rng, 80)
        if i < 300 or i >= 590:
            text = " ".join(w + "|" * (n % 2) for n, w in enumerate(text.split()))
        rows.append((i, text, "en", "tables" if i < 300 else "prose"))
    found = judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    kept = {r["doc_id"] for r in found.collect() if r["kept"]}
    assert len(kept & set(range(300))) > 280 and len(kept & set(range(300, 590))) > 270
    assert not kept & set(range(590, 600))


def test_a_megabyte_of_blanks(spark):
    texts = ["a" + " " * 1_000_000 + "b", " " * 1_000_000, "\t" * 500_000 + "c " * 60]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    found = judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    start = time.perf_counter()
    assert [r["n_words"] for r in found.orderBy("doc_id").collect()] == [2, 0, 60]
    assert time.perf_counter() - start < 20


def check_shards(rows, n):
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(n)) <= 1
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))


def test_shards_of_all_documents(spark, documents):
    rows = queries.op8_feistel_shards(spark, SF).collect()
    check_shards(rows, 16)
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in documents.items()
    }
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    again = queries.op8_feistel_shards(spark, SF).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_shards_of_odd_rows(odd, odd_rows, nothing):
    rows = shards(odd, 4).collect()
    check_shards(rows, 4)
    assert sorted(r["size"] for r in rows) == sorted(len((t or "").encode()) + 1 for _, t, _, _ in odd_rows)
    assert shards(nothing).count() == 0


def test_any_number_of_rows_is_permuted(spark):
    for n in (1, 2, 3, 5, 17, 100, 1001):
        frame = spark.range(n).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text")
        for seed in (0, 1):
            rows = shards(frame, 1, seed).collect()
            assert sorted(r["slot"] for r in rows) == list(range(n))
            assert sorted(r["number"] for r in rows) == list(range(n))
    assert [r["slot"] for r in sorted(rows, key=lambda r: r["number"])] != list(range(n))
