from __future__ import annotations

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.operators.merge import _folders_of, insert_absent, merge

KV = "k int, v string"


def test_update_all_and_insert_all(wh, frame):
    wh.publish(frame([(1, "a"), (2, "b")], KV), "t")
    merge(wh, "t", frame([(2, "B"), (3, "C")], KV), ["k"])
    assert rows(wh.read("t")) == [(1, "a"), (2, "B"), (3, "C")]


def test_null_keys_match_null_keys(wh, frame):
    wh.publish(frame([(None, "a"), (1, "b")], KV), "t")
    for _ in range(2):
        merge(wh, "t", frame([(None, "A")], KV), ["k"])
    assert rows(wh.read("t")) == [(1, "b"), (None, "A")]
    insert_absent(wh, "t", frame([(None, "x"), (5, "y")], KV), ["k"])
    assert rows(wh.read("t")) == [(1, "b"), (5, "y"), (None, "A")]


def test_a_null_part_of_a_composite_key(wh, frame):
    wh.publish(frame([(1, None, "a")], "k int, j string, v string"), "t")
    source = frame([(1, None, "b"), (1, "", "c"), (None, None, "d")], "k int, j string, v string")
    merge(wh, "t", source, ["k", "j"])
    assert rows(wh.read("t")) == [(1, "", "c"), (1, None, "b"), (None, None, "d")]


def test_two_source_rows_on_one_target_row_fail(wh, frame):
    wh.publish(frame([(1, "a")], KV), "t")
    with pytest.raises(PySparkException, match="several source rows match one row of t"):
        merge(wh, "t", frame([(1, "x"), (1, "y")], KV), ["k"])
    with pytest.raises(PySparkException, match="several source rows"):
        merge(wh, "t", frame([(1, "x"), (1, "x")], KV), ["k"], update={"v": F.lit("z")}, insert=None)
    assert rows(wh.read("t")) == [(1, "a")]


def test_repeated_source_keys_without_a_match_are_all_inserted(wh, frame):
    wh.publish(frame([(1, "a")], KV), "t")
    merge(wh, "t", frame([(2, "x"), (2, "y")], KV), ["k"])
    assert rows(wh.read("t")) == [(1, "a"), (2, "x"), (2, "y")]


def test_one_source_row_updates_every_target_row_of_its_key(wh, frame):
    wh.publish(frame([(1, "a"), (1, "b"), (2, "c")], KV), "t")
    merge(wh, "t", frame([(1, "z")], KV), ["k"])
    assert rows(wh.read("t")) == [(1, "z"), (1, "z"), (2, "c")]


def test_a_null_value_overwrites(wh, frame):
    wh.publish(frame([(1, "a")], KV), "t")
    merge(wh, "t", frame([(1, None)], KV), ["k"])
    assert rows(wh.read("t")) == [(1, None)]


def test_columns_left_out_of_an_insert_are_null(wh, frame):
    wh.publish(frame([(1, "a")], KV), "t")
    merge(wh, "t", frame([(1, "x"), (2, "y")], KV), ["k"], update={"v": F.lit("u")}, insert={"k": F.col("k")})
    assert rows(wh.read("t")) == [(1, "u"), (2, None)]


def test_target_predicate_limits_the_match(wh, frame):
    schema = "k int, v string, closed int"
    wh.publish(frame([(1, "old", 1), (1, "now", None), (2, "gone", 1)], schema), "t")
    source = frame([(1, "new", None), (2, "back", None)], schema)
    merge(wh, "t", source, ["k"], target_where=F.col("closed").isNull())
    assert rows(wh.read("t")) == [(1, "new", None), (1, "old", 1), (2, "back", None), (2, "gone", 1)]


def test_a_predicate_that_is_null_for_a_row_keeps_the_row(wh, frame):
    wh.publish(frame([(1, "a"), (2, None)], KV), "t")
    merge(wh, "t", frame([(1, "b"), (2, "b")], KV), ["k"], insert=None, target_where=F.col("v") == "a")
    assert rows(wh.read("t")) == [(1, "b"), (2, None)]


def test_tags(wh, frame):
    wh.publish(frame([(1, "a", "Insert"), (2, "b", "Insert")], "k int, v string, tag string"), "t")
    merge(wh, "t", frame([(2, "c"), (3, "d")], KV), ["k"], tag_column="tag")
    assert rows(wh.read("t")) == [(1, "a", "Insert"), (2, "c", "Update"), (3, "d", "Insert")]


def test_empty_source_and_empty_target(wh, frame):
    wh.publish(frame([], KV), "t")
    version = wh.version("t")
    merge(wh, "t", frame([], KV), ["k"])
    assert wh.version("t") == version
    merge(wh, "t", frame([(1, "a")], KV), ["k"])
    assert rows(wh.read("t")) == [(1, "a")]
    merge(wh, "t", frame([], KV), ["k"], batch_id="empty")
    assert wh.batch("t", "empty") == {}


def test_a_committed_batch_is_not_merged_again(wh, frame):
    wh.publish(frame([(1, "a")], KV), "t")
    merge(wh, "t", frame([(1, "b")], KV), ["k"], batch_id="x")
    merge(wh, "t", frame([(1, "later")], KV), ["k"])
    merge(wh, "t", frame([(1, "b")], KV), ["k"], batch_id="x")
    assert rows(wh.read("t")) == [(1, "later")]


def test_insert_absent_rerun_makes_no_version_and_rewrites_nothing(wh, frame):
    wh.publish(frame([(1, "a")], KV), "t")
    folders = wh.record("t")["folders"]
    version = insert_absent(wh, "t", frame([(1, "x"), (2, "y")], KV), ["k"])
    assert wh.record("t")["folders"][: len(folders)] == folders
    assert insert_absent(wh, "t", frame([(1, "x"), (2, "y")], KV), ["k"]) == version


def test_only_folders_with_a_matched_row_are_rewritten(wh, frame):
    wh.publish(frame([(i, i % 4, "a") for i in range(40)], "k int, p int, v string"), "t", ["p"])
    before = set(wh.record("t")["folders"])
    merge(wh, "t", frame([(5, 1, "z"), (99, 3, "n")], "k int, p int, v string"), ["k", "p"])
    kept = before & set(wh.record("t")["folders"])
    assert len(kept) == 3  # partition 1 is rewritten, the insert into 3 adds a folder
    assert wh.read("t").count() == 41
    assert rows(wh.read("t").filter("v <> 'a'")) == [(5, 1, "z"), (99, 3, "n")]


def test_a_source_derived_from_the_target(wh, frame):
    wh.publish(frame([(1, "a"), (2, "b")], KV), "t")
    merge(wh, "t", wh.read("t").select("k", F.upper("v").alias("v")), ["k"])
    assert rows(wh.read("t")) == [(1, "A"), (2, "B")]


def test_source_types_are_brought_to_the_target(wh, frame):
    wh.publish(frame([(1, "a")], "k bigint, v string"), "t")
    merge(wh, "t", frame([(1, 7), (2, 8)], "k int, v int"), ["k"])
    assert rows(wh.read("t")) == [(1, "7"), (2, "8")]
    assert wh.read("t").dtypes == [("k", "bigint"), ("v", "string")]


def test_the_match_reads_only_the_partitions_of_the_source(wh, frame):
    schema = "k int, p bigint, q string"
    wh.publish(frame([(1, 1, "a"), (2, 2, "a"), (3, None, "b"), (4, 2, None)], schema), "t", ["p", "q"])
    source = frame([(2, 2, "a"), (3, None, "b"), (9, 7, "z")], "k int, p int, q string")
    hit = _folders_of(wh, "t", source, ["p", "q"])
    assert len(hit) == 2 < len(wh.record("t")["folders"])
    assert rows(wh.read("t", folders=hit).select("k")) == [(2,), (3,)]
    merge(wh, "t", source, ["k", "p", "q"], update=None)
    assert rows(wh.read("t").select("k")) == [(1,), (2,), (3,), (4,), (9,)]


def test_many_partition_values_still_prune(wh, spark):
    """Far more values than the table has partitions: only folders that both hold are read."""
    wh.publish(spark.range(6).selectExpr("id AS k", "CAST(id AS STRING) AS p"), "t", ["p"])
    source = spark.range(4, 5004).selectExpr("id AS k", "CAST(id AS STRING) AS p")
    hit = _folders_of(wh, "t", source, ["p"])
    assert rows(wh.read("t", folders=hit).select("k")) == [(4,), (5,)]
    wh.publish(spark.range(3).selectExpr("id AS k", "concat('a/b=', id, ' %') AS p"), "odd", ["p"])
    assert len(_folders_of(wh, "odd", spark.sql("SELECT 'a/b=1 %' AS p"), ["p"])) == 1
    merge(wh, "t", source.limit(1).selectExpr("4L AS k", "'4' AS p"), ["k", "p"], update=None)
    assert wh.read("t").count() == 6


def test_blank_partition_values_do_not_repeat(wh, frame):
    schema = "k int, p string"
    wh.publish(frame([(0, "x")], schema), "t", ["p"])
    for _ in range(4):
        insert_absent(wh, "t", frame([(1, ""), (2, "")], schema), ["k", "p"])
    assert rows(wh.read("t")) == [(0, "x"), (1, None), (2, None)]


def test_a_source_that_only_compresses_well_is_not_broadcast(spark):
    from siltstone.session import broadcast_threshold, staged_with_size

    wide = spark.range(20_000).select((F.col("id") % 3).alias("k"), F.repeat(F.lit("x"), 2_000).alias("v"))
    with staged_with_size(wide) as (rows_, size):
        assert size > 40_000_000 > broadcast_threshold(spark) and rows_.count() == 20_000


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_a_hot_key_on_both_sides(wh, spark, broadcast):
    """A third of the target has one key, a third of the source another one that is new."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        _merge_hot_keys(wh, spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _merge_hot_keys(wh, spark):
    n = 30_000
    hot = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("int")
    wh.publish(spark.range(n).select(hot.alias("k"), F.lit("a").alias("v")), "t")
    fresh = F.when(F.col("id") % 3 == 0, -2).otherwise(F.col("id") + n).cast("int")
    source = spark.range(n).select(fresh.alias("k"), F.lit("b").alias("v"))
    one = spark.createDataFrame([(-1, "c")], KV)
    merge(wh, "t", source.unionByName(one), ["k"])
    counts = dict(wh.read("t").groupBy("v").count().collect())
    assert counts == {"a": n - n // 3, "b": n, "c": n // 3}


@pytest.fixture
def big_sources(spark):
    """Every source counts as too big to be broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


PKV = "k int, p string, v string"


def test_a_big_source_updates_and_inserts_in_one_pass(wh, frame, big_sources):
    """NULL keys, a key that repeats in the target, one that is new twice, and other types of key and value."""
    old = [(None, "x", "a"), (1, None, "b"), (2, "x", "c"), (2, "x", "d"), (3, "y", "e")]
    wh.publish(frame(old, PKV), "t", ["p"])
    new = [(None, "x", 1), (1, None, 2), (2, "x", 3), (7, "x", 4), (7, "x", 5)]
    merge(wh, "t", frame(new, "k bigint, p string, v int"), ["k", "p"], tag_column=None)
    got = [(1, None, "2"), (2, "x", "3"), (2, "x", "3"), (3, "y", "e"), (7, "x", "4"), (7, "x", "5"), (None, "x", "1")]
    assert rows(wh.read("t")) == sorted(got, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("clauses", [{"update": None}, {"insert": None}])
def test_a_big_source_with_one_clause(wh, frame, big_sources, clauses):
    wh.publish(frame([(1, "a"), (None, "b")], KV), "t")
    merge(wh, "t", frame([(1, "x"), (None, "y"), (2, "z")], KV), ["k"], **clauses)
    wanted = [(1, "a"), (2, "z"), (None, "b")] if "update" in clauses else [(1, "x"), (None, "y")]
    assert rows(wh.read("t")) == wanted


def test_a_big_source_leaves_the_target_outside_the_condition(wh, frame, big_sources):
    wh.publish(frame([(1, "a"), (2, "b")], KV), "t")
    merge(wh, "t", frame([(1, "x"), (2, "y")], KV), ["k"], target_where=F.col("v") == "a")
    assert rows(wh.read("t")) == [(1, "x"), (2, "b"), (2, "y")]


def test_a_big_source_with_a_matched_key_on_several_rows_fails(wh, frame, big_sources):
    wh.publish(frame([(1, "a"), (2, "b")], KV), "t")
    with pytest.raises(Exception, match="several source rows"):
        merge(wh, "t", frame([(1, "x"), (1, "y")], KV), ["k"])


@pytest.mark.parametrize("threshold", ["-1", "100KB"])
def test_rows_of_a_big_source_that_are_new_are_not_joined_with_the_target(wh, spark, monkeypatch, threshold):
    """No key, then a few keys of a big source are in the target: its rows never meet a stored one."""
    from siltstone.operators import merge as module

    taken = []
    monkeypatch.setattr(module, "without_keys", lambda df, *a, f=module.without_keys: taken.append(df.count()) or f(df, *a))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        wh.publish(spark.range(20_000).selectExpr("CAST(id AS INT) AS k", "'a' AS v"), "t")
        first = 20_000 if threshold == "-1" else 19_990
        insert_absent(wh, "t", spark.range(first, 40_000).selectExpr("CAST(id AS INT) AS k", "'b' AS v"), ["k"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sum(taken) == 20_000 - first
    assert dict(wh.read("t").groupBy("v").count().collect()) == {"a": 20_000, "b": 20_000}


def _keyed(spark, first, n, value):
    """Keys of three partitions, one of them NULL; the key itself is NULL in one row of each."""
    part = F.when(F.col("id") % 3 < 2, F.concat(F.lit("p"), F.col("id") % 3))
    key = F.when(F.col("id") >= 3, F.col("id")).cast("int")
    return spark.range(first, first + n, 1, 4).select(key.alias("k"), part.alias("p"), F.lit(value).alias("v"))


@pytest.mark.parametrize("part_bytes", [512 << 20, 20_000])
@pytest.mark.parametrize("update", ["*", None])
def test_a_big_source_meets_its_partitions_without_a_shuffle(wh, spark, monkeypatch, big_sources, update, part_bytes):
    """Whole partitions, then shares of their keys: rows are updated and inserted where they lie."""
    from siltstone.operators import merge as module

    written = []
    replace = type(wh).replace
    monkeypatch.setattr(type(wh), "replace", lambda self, name, df, *a, **k: written.append(df) or replace(self, name, df, *a, **k))
    monkeypatch.setattr(module, "_PART_BYTES", part_bytes, raising=False)
    wh.publish(_keyed(spark, 0, 3000, "old"), "t", ["p"])
    again = spark.createDataFrame([(3000 + 3, "p0", "twice"), (3000 + 3, "p0", "twice")], "k int, p string, v string")
    source = _keyed(spark, 0, 3, "new").unionAll(_keyed(spark, 1500, 3000, "new"))
    merge(wh, "t", source, ["k", "p"], update=update)
    assert "Exchange" not in written[-1]._jdf.queryExecution().executedPlan().toString()
    counts = dict(wh.read("t").groupBy("v").count().collect())
    assert counts == ({"old": 1497, "new": 3003} if update else {"old": 3000, "new": 1500})
    assert wh.read("t").select("k", "p").distinct().count() == 4500
    before = set(wh.record("t")["folders"])
    if update:  # no key is known: nothing is rewritten, and a new key may come twice
        merge(wh, "t", _keyed(spark, 6000, 30, "later").unionAll(again.withColumn("k", F.col("k") + 9000)), ["k", "p"])
        assert before < set(wh.record("t")["folders"]) and wh.read("t").count() == 4532
        merge(wh, "t", _keyed(spark, 6000, 30, "last").filter("p = 'p1'"), ["k", "p"], insert=None)
        assert dict(wh.read("t").groupBy("v").count().collect())["last"] == 10
        assert {f for f in before if "p=p1" not in f} < set(wh.record("t")["folders"])


def test_parts_keep_repeated_keys_and_rows_outside_the_condition(wh, frame, big_sources):
    """A key on three target rows of two folders, a row that the condition leaves out, and a key of other type."""
    wh.publish(frame([(1, "x", "a"), (1, "x", "b"), (2, "x", "c")], PKV), "t", ["p"])
    wh.append(frame([(1, "x", "d"), (3, None, "e"), (4, "y", "keep")], PKV), "t")
    new = frame([(1, "x", "z"), (3, None, "z"), (4, "y", "z"), (5, "y", "z")], "k bigint, p string, v string")
    merge(wh, "t", new, ["k", "p"], target_where=F.col("v") != "keep")
    wanted = [(1, "x", "z")] * 3 + [(2, "x", "c"), (3, None, "z"), (4, "y", "keep"), (4, "y", "z"), (5, "y", "z")]
    assert rows(wh.read("t")) == sorted(wanted, key=lambda r: [(v is None, str(v)) for v in r])


def test_a_hot_key_of_a_partition_is_not_met_in_one_task(wh, spark, big_sources):
    hot = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("int")
    old = spark.range(9000).select(hot.alias("k"), F.lit("x").alias("p"), F.lit("a").alias("v"))
    wh.publish(old, "t", ["p"])
    one = spark.createDataFrame([(-1, "x", "c"), (9001, "x", "b")], PKV)
    merge(wh, "t", one, ["k", "p"])
    assert dict(wh.read("t").groupBy("v").count().collect()) == {"a": 6000, "b": 1, "c": 3000}


def test_only_a_big_source_is_staged_in_folders(spark, big_sources):
    from siltstone.session import staged_by

    df = spark.range(100).selectExpr("id", "id % 4 AS p")
    with staged_by(df, ["p"]) as (laid, size):
        assert size == 1600 and all("/p=" in f for f in laid.inputFiles()) and laid.filter("p = 1").count() == 25
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    with staged_by(df, ["p"]) as (plain, _):
        assert not any("/p=" in f for f in plain.inputFiles()) and plain.count() == 100
