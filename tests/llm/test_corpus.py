"""Toxicity, near-duplicates, repeats and benchmark items against brute force; the pipeline stage by stage."""

from __future__ import annotations

import copy
import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from siltstone.llm import decontamination, queries, repeats, toxicity
from siltstone.llm.components import components
from siltstone.llm.decontamination import with_leaks
from siltstone.llm.near_dups import Plan, near_duplicates
from siltstone.llm.repeats import remove_repeats

from samples import ODD_SCHEMA, SF, documents, nothing, odd, odd_rows, prose  # noqa: F401


def text_sets(texts, size):
    found = []
    for text in texts:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        found.append(frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset())
    return found


def linked_components(texts, size, percent=80):
    """For every text the index of the first text that links reach."""
    sets, parent = text_sets(texts, size), list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return sets, [top(i) for i in range(len(texts))]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_of_all_documents(spark, documents, size):
    ids = sorted(documents)
    sets, tops = linked_components([documents[i] for i in ids], size)
    if size == 2:
        found = queries.op10_odd_sketches(spark, SF)
    else:
        found = near_duplicates(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {tuple(r) for r in found.collect()} == {
        (i, len(s), ids[t], i == ids[t]) for i, s, t in zip(ids, sets, tops)
    }
    assert len(set(tops)) < len(ids)


def test_near_duplicates_of_odd_rows(odd, odd_rows, nothing):
    rows = near_duplicates(odd, Plan(words=2)).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert {i: by_id[i]["component_id"] for i in (1, 2, 3)} == {1: 1, 2: 1, 3: 1}
    assert [by_id[i]["kept"] for i in (1, 2, 3)] == [True, False, False]
    for i in (4, 5, 6):
        assert (by_id[i]["n_shingles"], by_id[i]["component_id"], by_id[i]["kept"]) == (0, i, True)
    assert all(r["kept"] for r in rows if r["doc_id"] is None)
    assert near_duplicates(nothing).count() == 0


def test_a_large_group_of_near_copies(spark):
    """Copies of one text that differ from each other more than from it, a chain, and unrelated texts."""
    rng = random.Random(2)
    base = prose(rng, 200).split()
    texts = [" ".join(base)]
    for _ in range(250):
        words = list(base)
        for _ in range(rng.randint(3, 9)):
            words[rng.randrange(len(words))] = prose(rng, 1)
        texts.append(" ".join(words))
    chain = prose(rng, 100).split()
    for i in range(30):
        chain[i * 3 : i * 3 + 3] = prose(rng, 3).split()
        texts.append(" ".join(chain))
    texts += [prose(rng, 50) for _ in range(40)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts = [texts[i] for i in order]
    _, tops = linked_components(texts, 2)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame, Plan(words=2)).collect()}
    assert found == dict(enumerate(tops))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2040)] + [(None, 1), (7, 7)]
    parent = {}

    def top(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((top(a), top(b)))
            parent[b] = a
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["vertex"]: r["component"] for r in found} == {i: top(i) for i in parent}


def cut(texts, length=100):
    """Per text what is left, and the removed runs; ``texts`` in order."""
    seen, found = set(), []
    for text in texts:
        data = (text or "").encode()
        marks = np.zeros(len(data) + 1, int)
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                marks[p] += 1
                marks[p + length] -= 1
            seen.add(window)
        gone = np.cumsum(marks[:-1]) > 0
        rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1))
        found.append((len(data), len(data) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return found


def test_repeats_of_all_documents(spark, documents):
    rows = {r["doc_id"]: tuple(r)[1:] for r in queries.op6_sampled_suffixes(spark, SF).collect()}
    ids = sorted(documents)
    expected = cut([documents[i] for i in ids])
    assert rows == dict(zip(ids, expected)) and sum(e[1] for e in expected) > 0


def test_repeats_of_odd_rows(odd, odd_rows, nothing):
    placed = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    found = remove_repeats(odd, texts=True)
    assert found.columns == [*(c for c in odd.columns if c != "text"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
    key = lambda r: [(v is None, str(v)) for v in r]
    rows = found.collect()
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows]
    assert sorted(got, key=key) == sorted(((p[0], *c) for p, c in zip(placed, cut([p[1] for p in placed]))), key=key)
    assert {r["kept"] for r in rows} == {"k"} and next(r["text"] for r in rows if r["doc_id"] == 4) == ""
    assert remove_repeats(nothing).count() == 0


def test_repeats_that_overlap_and_short_lengths(spark):
    rng = random.Random(4)
    period = "abcdefghij" * 40
    shared = prose(rng, 60)
    texts = [period, "xy" + period[:150], "a" * 400, shared, "q" + shared[50:220] + "z" + shared[:90],
             "é" * 120 + shared[30:150], "ü" + "é" * 90, "a" * 99, "b" + "a" * 101]
    texts += [shared[i : i + 120 + i] + prose(rng, 5) for i in range(0, 60, 7)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for length in (100, 40):
        rows = sorted(remove_repeats(frame, length, texts=True).collect(), key=lambda r: r["doc_id"])
        assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows] == cut(texts, length)
        assert all("�" not in r["text"] for r in rows)


def test_repeats_in_documents_longer_than_a_chunk(spark, monkeypatch):
    """Passages across the borders of pieces, and spans that run over them."""
    rng = random.Random(14)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(repeats, "PART_BYTES", 7000)
    long = prose(rng, 1500)
    texts = [long[950:1090], long, "x" * 3000, prose(rng, 20) + long[500:4100], long[:2000] + "!" + long[2000:],
             "", long[-150:], prose(rng, 400) + long[1900:2050], "é" * 2100]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = spark.catalog.listTables()
    rows = sorted(remove_repeats(frame, texts=True).collect(), key=lambda r: r["doc_id"])
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows] == cut(texts)
    assert spark.catalog.listTables() == before


def test_repeats_in_a_document_of_megabytes(spark):
    rng = random.Random(15)
    words = [prose(rng, 1) for _ in range(4000)]
    text = " ".join(rng.choice(words) for _ in range(700_000))
    assert len(text) > 3_000_000
    rows = [(1, text, "a"), (2, "start " + text[1_000_000:1_000_300] + " end", None), (3, None, "c"), (4, text, "d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in remove_repeats(frame).collect()}
    assert found[1]["n_removed"] < 1000 and found[1]["source"] == "a"
    assert found[2]["n_removed"] >= 300 and found[3]["n_bytes"] == 0 and found[2]["source"] is None
    assert (found[4]["n_removed"], found[4]["n_spans"]) == (len(text), 1)
    assert found[4]["kept_sha256"] == hashlib.sha256(b"").hexdigest()


def leaks_of(texts, items, size=5, least=0.8):
    words_of = lambda t: (t or "").encode().lower().translate(decontamination._WORDS).split()
    best = {}
    for item_id, item in items:
        item_words = words_of(item)
        if not item_words:
            continue
        width = min(size, len(item_words))
        n = len(item_words) - width + 1
        weight = Counter(tuple(item_words[i : i + width]) for i in range(n))
        for doc_id, text in texts:
            words = words_of(text)
            shingles = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
            if not weight.keys() & set(shingles):
                continue
            for a in range(len(shingles) - n + 1):
                own = Counter(shingles[a : a + n])
                both = sum(min(c, weight[s]) for s, c in own.items())
                found = both / (2 * n - both)
                if found >= least and found > best.get((doc_id, item_id), (0,))[0]:
                    best[doc_id, item_id] = (found, a, len(item_words))
    return best


def test_benchmark_items_in_all_documents(spark, documents):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = queries.op9_simhash_windows(spark, SF).collect()
    found = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"], r["n_words"]) for r in rows}
    assert found == leaks_of(documents.items(), items) and found


def test_altered_items_and_odd_rows(spark, odd, nothing):
    rng = random.Random(9)
    items = [(i, prose(rng, n)) for i, n in enumerate([3, 5, 14, 30, 45, 60, 60])]
    items += [(20, None), (21, ""), (22, "same same same same same same same same"), (None, prose(rng, 20))]
    texts = []
    for i, (_, item) in enumerate(items):
        words = (item or "").split()
        for change in range(4):
            own = list(words)
            if own and change:
                own[rng.randrange(len(own))] = ["other", "", "Two words", own[0].upper() + "!"][change]
            texts.append((i * 10 + change, f"{prose(rng, 30)}. {' '.join(own)}, {prose(rng, 12)}"))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = with_leaks(frame, bench).selectExpr("doc_id", "inline(leaks)").collect()
    found = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"], r["n_words"]) for r in rows}
    assert found == leaks_of(texts, items)
    decontamination_rows = with_leaks(odd, bench)
    assert decontamination_rows.count() == odd.count() and decontamination_rows.columns[-1] == "leaks"
    assert with_leaks(nothing, bench).count() == 0
    assert with_leaks(odd, bench.limit(0)).filter("size(leaks) > 0").count() == 0


def test_many_items_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 3)
    rng = random.Random(3)
    items = [(i, prose(rng, 20)) for i in range(8)]
    texts = [(i, f"{prose(rng, 9)} {t} end") for i, t in items]
    rows = with_leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in rows.selectExpr("doc_id", "inline(leaks)").collect()} == {(i, i) for i in range(8)}


def plain_words(text):
    """Words one character at a time, by what Unicode says of each."""
    words, own = [], ""
    for c in unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).casefold()) + " ":
        if unicodedata.category(c)[0] in "LMN":
            own += c
        elif own:
            words.append(own)
            own = ""
    return words


def test_items_in_other_case_and_punctuation_beyond_ascii(spark):
    item = "été à Genève où l’élève naïf répète « déjà vu » près du château – übermäßig große Straßen führen über Köln nach Zürich"
    other = "the quick brown fox jumps over a lazy dog while eleven pipers pipe"
    texts = [
        item,
        item.upper(),
        unicodedata.normalize("NFD", item.title()),
        item.replace(" – ", "—").replace("« ", "“").replace(" »", "”"),
        "…" + "‘".join(item.split()) + "…",
        other.replace(" ", " – "),
        "„" + other.upper() + "“",
    ]
    frame = spark.createDataFrame([(i, f"Zuvor — {t} ¿danach?") for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    rows = with_leaks(frame, items).selectExpr("doc_id", "inline(leaks)").collect()
    found = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"], r["n_words"]) for r in rows}
    assert found == {
        (i, 1 if i < 5 else 2): (1.0, 1, len(plain_words(item if i < 5 else other))) for i in range(len(texts))
    }


INSULTS = ["blorgface", "snarkwad", "grumblenit"]


def toxic_sample(rng, n):
    rows = []
    for i in range(n):
        words = prose(rng, rng.randint(20, 90)).split()
        bad = rng.random() < 0.3
        for _ in range(rng.randint(1, 3) if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(INSULTS) + rng.choice(["", "s", "ed"])
        rows.append((i, " ".join(words), rng.choice(["en", "de"]), int(bad)))
    return rows


def small_model(rng):
    """A model with all its parts drawn at random, and every filter awake."""
    model = toxicity._new_model(0.4, rng)
    model.tables = rng.normal(0, 0.3, model.tables.shape).astype(np.float32)
    model.tables[:, toxicity._PAD] = 0
    model.bias = (4 + rng.normal(0, 0.1, model.bias.shape)).astype(np.float32)
    return model


def plain_score(model, text):
    """Embeddings, windows, pooling and logit by loops over words, places and filters."""
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    vectors = []
    for word in words:
        own, stem = zlib.crc32(word), zlib.crc32(word[:5])
        rows = [own & 0xFFFF, own >> 16, stem & 0xFFFF]
        vectors.append([float(x) for table, row in zip(model.tables, rows) for x in table[row]])
    vectors += [[0.0] * len(vectors[0])] * 3 if vectors else [[0.0] * toxicity.TABLES * toxicity.TABLE_DIMS] * 3
    logit, unit = model.offset, 0
    for width, filters in zip(toxicity.WIDTHS, model.filters):
        for f in range(toxicity.FILTERS):
            best = max(
                sum(vectors[at + j][e] * float(filters[j, e, f]) for j in range(width) for e in range(len(vectors[0])))
                for at in range(len(words) + 1)
            )
            logit += max(best + float(model.bias[unit]), 0.0) * float(model.weights[unit])
            unit += 1
    return 1 / (1 + math.exp(-logit))


TOXIC_TEXTS = ["", "one", "Two words", "ärger über die Straße, drei four", "a b c d e f g a b c " * 4, "x-y_z 12 ab12"]


def test_scores_are_those_of_plain_loops():
    model = small_model(np.random.default_rng(3))
    found = model.score([toxicity.word_rows(t) for t in TOXIC_TEXTS])
    assert np.allclose(found, [plain_score(model, t) for t in TOXIC_TEXTS], atol=1e-5)
    # A filter that is asleep passes nothing on.
    model.bias[::2] = -9
    found = model.score([toxicity.word_rows(t) for t in TOXIC_TEXTS])
    assert np.allclose(found, [plain_score(model, t) for t in TOXIC_TEXTS], atol=1e-5)


def test_a_training_step_follows_the_slope_of_the_error():
    """Every part moves against the slope of the mean log loss, which is measured by small changes of it."""
    y = np.array([1, 0, 1, 1, 0, 0], dtype=np.float32)
    found = [toxicity.word_rows(t) for t in TOXIC_TEXTS]

    def loss(model):
        p = model.score(found)
        return -float(np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))

    def slope(values, at):
        model_values, step = values[at], 1e-2
        values[at] = model_values + step
        up = loss(model)
        values[at] = model_values - step
        down = loss(model)
        values[at] = model_values
        return (up - down) / (2 * step)

    model = small_model(np.random.default_rng(4))
    moved = copy.deepcopy(model)
    rate, start = 0.15, 1e-3
    seen = {"tables": np.full(model.tables.shape[:2], start, np.float32)}
    slow = {k: start for k in ("bias", "weights", "offset", *range(len(toxicity.WIDTHS)))}
    toxicity._step(moved, found, y, rate, seen, slow)

    def gradient(before, after):
        """What gradient a first step of Adagrad came from."""
        u = (np.asarray(before, float) - np.asarray(after, float)) / (0.5 * rate)
        return u * np.sqrt(start) / np.sqrt(1 - u * u)

    for name in ("weights", "bias"):
        got = gradient(getattr(model, name), getattr(moved, name))
        want = [slope(getattr(model, name), i) for i in range(len(got))]
        assert np.allclose(got, want, rtol=0.05, atol=2e-3), name
    for k, width in enumerate(toxicity.WIDTHS):
        got = gradient(model.filters[k], moved.filters[k])
        for at in [(0, 0, 0), (width - 1, 5, 3), (width - 1, 20, 7)]:
            assert abs(got[at] - slope(model.filters[k], at)) < 0.05 * abs(got[at]) + 2e-3
    for table in range(toxicity.TABLES):
        row = int(found[4][table][2])
        change = model.tables[table, row] - moved.tables[table, row]
        want = np.array([slope(model.tables, (table, row, e)) for e in range(toxicity.TABLE_DIMS)])
        assert float(change @ want) > 0.95 * np.linalg.norm(change) * np.linalg.norm(want)
    assert (moved.tables[:, toxicity._PAD] == 0).all()


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_sample(random.Random(6), 1500)
    docs = spark.createDataFrame([(i, t, la, "s", "kept") for i, t, la, _ in rows], "doc_id long, text string, lang string, source string, score string")
    labels = spark.createDataFrame([(i, b) for i, _, _, b in rows], "doc_id long, toxic int")
    scored = toxicity.score_documents(docs, toxicity.train(docs, labels)).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    truth = {i: b for i, _, _, b in rows}
    held = [r for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(truth[r["doc_id"]] == (r["score"] >= 0.3) for r in held) > 0.95 * len(held)
    assert sum(r["toxic"] for r in held if not truth[r["doc_id"]]) <= 0.02 * len(held)


def test_labels_of_held_out_rows_teach_nothing(spark):
    rows = toxic_sample(random.Random(8), 400)
    docs = spark.createDataFrame([(i, t, la) for i, t, la, _ in rows], "doc_id long, text string, lang string")
    truth = [(i, b) for i, _, _, b in rows]
    turned = [(i, 1 - b if zlib.crc32(str(i).encode()) % 4 == 2 else b) for i, b in truth]
    models = [toxicity.train(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (truth, turned)]
    assert all(np.array_equal(a, b) for a, b in zip(models[0].filters, models[1].filters))
    assert models[0].thresholds == models[1].thresholds


def test_thresholds_count_all_rows_that_are_not_fitted_on(spark):
    rows = toxic_sample(random.Random(12), 1500)
    docs = spark.createDataFrame([(i, t, la) for i, t, la, _ in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, b) for i, _, _, b in rows[:1300]], "doc_id long, toxic int")
    fitted = toxicity.training_ids(labels, 300)
    own = {r["label_id"] for r in fitted.collect()}
    model = toxicity.train(docs, labels, 300)
    expected = Counter()
    for i, text, lang, toxic in rows[:1300]:
        if zlib.crc32(str(i).encode()) % 4 != 2 and i not in own:
            expected[lang, toxic] += 1
    found = Counter()
    for r in toxicity.score_counts(docs, labels, fitted, model).collect():
        found[r["lang"], r["is_toxic"]] += r["n"]
    assert 200 < len(own) <= 300 and found == expected and sum(found.values()) > 600


def test_one_clean_score_does_not_set_a_threshold():
    """300 clean texts, one of them far up, and toxic ones all below it: recall stays."""
    toxic = [("de", 1, 400 + 10 * i, 2) for i in range(40)]
    one_far_up = [("de", 0, 5, 299), ("de", 0, 960, 1)]
    least = toxicity._thresholds([*toxic, *one_far_up])["de"] * toxicity.SCORE_STEPS
    assert sum(n for _, _, step, n in toxic if step >= least) >= 0.95 * 80
    many = [("de", 0, 5, 270), ("de", 0, 960, 30)]  # a tenth of the clean ones is too much for that
    assert toxicity._thresholds([*toxic, *many])["de"] * toxicity.SCORE_STEPS > 960


def test_recall_of_the_toxicity_stage(spark):
    """Clean texts of one language now and then hold a toxic word; its toxic texts are found all the same."""
    rng = random.Random(15)
    rows = toxic_sample(rng, 3000)
    rows = [
        (i, f"{t} {rng.choice(INSULTS)}" if la == "de" and not b and rng.random() < 0.004 else t, la, b)
        for i, t, la, b in rows
    ]
    docs = spark.createDataFrame(
        [(i, t, la, "s", len(t)) for i, t, la, _ in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    labels = spark.createDataFrame([(i, b) for i, _, _, b in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    gone = {r["doc_id"] for r in toxicity.score_documents(docs, model).filter("toxic").collect()}
    for lang in ("en", "de"):
        held = [(i, b) for i, _, la, b in rows if la == lang and zlib.crc32(str(i).encode()) % 4 == 2]
        assert sum(i in gone for i, b in held if b) >= 0.95 * sum(b for _, b in held)
        assert sum(i in gone for i, b in held if not b) <= 0.02 * sum(not b for _, b in held)


def test_toxicity_of_odd_rows(spark, odd, odd_rows, nothing):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (7, 0), (100, 1), (101, 0)], "doc_id long, toxic int")
    scored = toxicity.score_documents(odd, toxicity.train(odd, labels))
    assert scored.count() == len(odd_rows) and scored.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    blank = {r["score"] for r in scored.filter("doc_id IN (4, 5, 6)").collect()}
    assert len(blank) == 1
    model = toxicity.train(odd, labels.limit(0))
    assert max(r["score"] for r in toxicity.score_documents(odd, model).collect()) < 1e-8
    assert toxicity.score_documents(nothing, toxicity.train(nothing, labels)).count() == 0


def test_toxicity_query(spark, documents):
    rows = queries.op1_text_convolution(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.3)


def test_pipeline_stage_by_stage(spark):
    """Each stage against plain Python over its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    clean = stages["toxicity"](spark, docs, SF).cache()
    scored = toxicity.score_documents(docs, toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert clean.columns == columns
    assert set(texts(clean)) == {r["doc_id"] for r in scored.collect() if not r["toxic"]}

    single = stages["near_duplicates"](spark, clean, SF).cache()
    ids = sorted(texts(clean))
    _, tops = linked_components([texts(clean)[i] for i in ids], 5)
    assert single.columns == columns and set(texts(single)) == {ids[t] for t in tops}

    shorter = stages["repeats"](spark, single, SF).cache()
    ids = sorted(texts(single))
    left = cut([texts(single)[i] for i in ids])
    assert shorter.columns == columns and sorted(texts(shorter)) == ids
    for row, (n_bytes, n_removed, _, digest) in zip(sorted(shorter.collect(), key=lambda r: r["doc_id"]), left):
        own = row["text"].encode()
        assert row["n_chars"] == len(row["text"]) and len(own) >= n_bytes - n_removed
        if len(own) == n_bytes - n_removed:
            assert hashlib.sha256(own).hexdigest() == digest

    safe = stages["benchmark"](spark, shorter, SF).cache()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {doc_id for doc_id, _ in leaks_of(texts(shorter).items(), items)}
    assert safe.columns == columns and set(texts(safe)) == set(texts(shorter)) - leaked and leaked

    last = stages["encoding"](spark, safe, SF)
    assert last.filter("NOT round_trip").count() == 0 and last.count() == safe.count()
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, last.collect()))


def test_only_the_copy_goes_of_rows_that_share_an_id(spark):
    rng = random.Random(21)
    first, clean = prose(rng, 80), prose(rng, 80)
    rows = [(1, first), (5, first + " more"), (5, clean), (5, clean), (5, ""), (6, prose(rng, 80))]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    left = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == sorted([rows[0], rows[2], rows[4], rows[5]])


def test_pipeline_on_odd_rows(spark, odd, nothing):
    frame = odd.select(corpus_pipeline.COLUMNS)
    for docs in (frame, nothing.select(corpus_pipeline.COLUMNS)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()
    assert "text" in ODD_SCHEMA
