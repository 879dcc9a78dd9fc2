"""The manifest against trees built by plain loops."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.llm import merkle
from siltstone.llm.merkle import fold, manifest

from samples import nothing, odd, odd_rows  # noqa: F401


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    fields = [v if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in fields))


def tree(nodes):
    """The top node, and for every node its siblings and what folds any node to the top."""
    paths, levels = [[] for _ in nodes], [list(nodes)]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    for i, path in enumerate(paths):
        for level in levels[:-1]:
            path.append((level[i ^ 1] if i ^ 1 < len(level) else None, i % 2))
            i //= 2
    return levels[-1][0], paths


def plain(rows):
    """Expected rows from (doc_id, source, lang, n_chars, text)."""
    first = lambda v: (v is not None, v if v is not None else 0)
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append((leaf_of(*row), row))
    order = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    made = []
    for lang in order:
        langs[lang].sort(key=lambda e: (first(e[1][0]), e[0]))
        made.append(tree([e[0] for e in langs[lang]]))
    root, tops = tree([m[0] for m in made])
    out = []
    for lang, (subroot, paths), top in zip(order, made, tops):
        for (leaf, row), path in zip(langs[lang], paths):
            siblings, seen = path + top, leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                seen = leaf_of(row[0], row[1], row[2], row[3] + 1, row[4])
            for other, is_right in siblings:
                seen = sha(seen if other is None else other + seen if is_right else seen + other)
            proof = sha("".join(other for other, _ in siblings if other is not None))
            out.append((row[0], leaf, subroot, root, proof, seen, seen == root))
    return Counter(out)


def changed(df):
    hit = F.crc32(df["doc_id"].cast("string").cast("binary")) % 7 == 0
    return {"n_chars": F.when(hit, df["n_chars"] + 1).otherwise(df["n_chars"])}


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree long, node string, part int"


def corpus(seed, n, langs):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice([None, *values])
    return [
        (pick(*range(-3, 2 * n)), pick("a", "ß"), rng.choice(langs), pick(1, 2**40), pick("", "x" * rng.randint(0, 9), "中"))
        for _ in range(n)
    ]


@pytest.mark.parametrize(
    "n, langs, block",
    [(1, [None], 2), (2, ["en"], 2), (3, ["en", None, "é"], 4), (70, ["en"], 4), (300, [None, "", "b", "Z", "é", "zz"], 8),
     (200, [str(i) for i in range(40)], 4), (90, ["en", "de"], 4096)],
)
def test_manifest(spark, n, langs, block):
    rows = corpus(n, n, langs)
    df = spark.createDataFrame([(*r, "l", 1, "n", 2) for r in rows], SCHEMA).repartition(3)
    found = manifest(df, changed(df), block=block)
    assert Counter(map(tuple, found.collect())) == plain(rows)


def test_odd_rows(spark, odd, odd_rows):
    rows = [(i, s, la, None, t) for i, t, la, s in odd_rows]
    assert Counter(map(tuple, manifest(odd, changed(odd)).collect())) == plain(rows)


def test_proofs_hold_alone(spark):
    rows = corpus(5, 60, ["en", "de", None])
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for r in manifest(df, proofs=True, block=8).collect():
        assert r["verified"] and fold(r["leaf"], r["siblings"], bytes(r["sides"])) == r["root"]
        assert sha(r["siblings"]) == r["proof_sha256"]
        assert fold(sha("other"), r["siblings"], bytes(r["sides"])) != r["root"]


def test_a_lone_row_is_the_root(spark):
    df = spark.createDataFrame([(1, None, None, None, None)], "doc_id long, source string, lang string, n_chars long, text string")
    row = manifest(df).first()
    assert row["leaf"] == row["subroot"] == row["root"] == sha("1:1----")
    assert row["proof_sha256"] == sha("")


def test_no_rows(spark, nothing):
    assert manifest(nothing).collect() == []


def test_superblocks_are_powers_of_two(nothing):
    with pytest.raises(ValueError):
        merkle.manifest(nothing, block=12)
