"""Plan checks: what must hold when the data no longer fits one task or a broadcast."""

from __future__ import annotations

import contextlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.operators.merge import _one_row_per_key, _rewritten
from siltstone.operators.rows import (
    classify_changes,
    dedupe,
    lookup,
    new_rows,
    preview,
    seen_keys,
    unique_members,
    without_keys,
)
from siltstone.plans.orders import counts_by_status, orders_staging, segment_counts
from siltstone.session import staged


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are when no side is small, with every oversized partition split."""
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        },
    ):
        yield


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df):
    """The plan as it was after running to the end."""
    df.collect()
    return plan(df)


def hot(spark, n=60_000, name="k"):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(key.alias(name), (F.col("id") * 7 % 1009).alias("v"))


def stored(spark, df, wh, name):
    wh.publish(df, name)
    return wh.read(name)


def test_no_operator_uses_a_cross_or_nested_loop_join(spark, wh, no_broadcast):
    a = stored(spark, hot(spark, 1000), wh, "a")
    for df in (
        new_rows(a, a, ["k", "v"]),
        classify_changes(a, a, ["k"], ["v"]),
        seen_keys(a, a, ["k"]),
        lookup(a, a.toDF("j", "w"), {"k": "j"}, ["w"]),
    ):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text and "SortMergeJoin" in text


def test_each_input_of_a_change_check_is_shuffled_once(spark, wh, no_broadcast):
    source, target = stored(spark, hot(spark, 1000), wh, "s"), stored(spark, hot(spark, 1000), wh, "t")
    for df in (new_rows(source, target, ["k"]), classify_changes(source, target, ["k"], ["v"])):
        # the target, the source's keys, the rows found, and the source
        assert plan(df).count("Exchange hashpartitioning") == 4


def test_a_hot_source_key_is_split_in_a_change_check(spark, wh, no_broadcast):
    source = stored(spark, hot(spark), wh, "s")
    target = stored(spark, spark.range(-1, 30_000).select(F.col("id").alias("k"), F.lit(5).alias("v")), wh, "t")
    fresh, changes = new_rows(source, target, ["k"]), classify_changes(source, target, ["k"], ["v"])
    for df in (fresh, changes):
        text = ran(df)
        assert "skew=true" in text
        # A hot key leaves a map task once where keys are looked up.
        assert "HashAggregate(keys=[__hash" in text
    assert fresh.count() == sum(1 for i in range(30_000, 60_000) if i % 3)
    assert changes.filter("Dataset_Filtering = 'New Record'").count() == fresh.count()


def test_a_small_source_does_not_shuffle_the_target_of_a_change_check(spark, wh):
    target = stored(spark, hot(spark, 1000), wh, "t")
    source = spark.createDataFrame([(-1, 5)], "k bigint, v bigint")
    for df in (new_rows(source, target, ["k"]), classify_changes(source, target, ["k"], ["v"])):
        text = ran(df)
        scan = text[: text.index("FileScan")].splitlines()
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text.split("Initial Plan")[0], scan


def test_a_hot_fact_key_is_split_in_a_lookup(spark, wh, no_broadcast):
    fact = stored(spark, hot(spark), wh, "fact")
    dim = stored(spark, spark.range(-1, 60_000).select(F.col("id").alias("n"), F.lit("x").alias("w")), wh, "dim")
    assert "skew=true" in ran(lookup(fact, dim, {"k": "n"}, ["w"]))


def test_a_hot_key_is_split_in_the_enrichment(spark, wh, no_broadcast):
    orders = stored(spark, hot(spark, name="customer_id_o"), wh, "o")
    customers = stored(spark, spark.range(60_000).select(F.col("id").alias("customer_id_c"), "id"), wh, "c")
    assert "skew=true" in ran(orders_staging(orders, customers, F.lit("2024-01-01")))


def test_a_hot_target_key_is_split_in_both_joins_of_a_merge(spark, wh, no_broadcast):
    wh.publish(hot(spark), "t")
    source = spark.range(-1, 30_000).select(F.col("id").alias("k"), F.lit(5).cast("long").alias("v"))
    updates = {"v": F.col("v")}
    with staged(_one_row_per_key(source, ["k"], updates)) as by_key:
        assert "skew=true" in ran(seen_keys(by_key, wh.read("t", with_folder=True), ["k"], ["__folder"]))
        joined, = _rewritten(wh, "t", set(wh.record("t")["folders"]), by_key, ["k"], updates, None)
        assert "skew=true" in ran(joined)


def test_a_small_source_does_not_shuffle_the_target(spark, wh):
    wh.publish(hot(spark, 1000), "t")
    source = spark.createDataFrame([(-1, 5)], "k bigint, v bigint")
    with staged(_one_row_per_key(source, ["k"], {"v": F.col("v")})) as by_key:
        seen = seen_keys(by_key, wh.read("t", with_folder=True), ["k"], ["__folder"])
        joined, = _rewritten(wh, "t", set(wh.record("t")["folders"]), by_key, ["k"], {"v": F.col("v")}, None)
        for df in (seen, joined):
            assert "BroadcastHashJoin" in plan(df) and "hashpartitioning" not in plan(df)


def test_seen_keys_scan_only_the_keys(spark, wh):
    wh.publish(hot(spark, 100), "t")
    text = plan(seen_keys(hot(spark, 100), wh.read("t"), ["k"]))
    assert "ReadSchema: struct<k:bigint>" in text


def test_dedupe_cuts_a_hot_key_before_the_shuffle(spark):
    text = plan(dedupe(hot(spark), ["k"], [F.desc("v")]))
    assert "row_number(), 1, Partial" in text


def test_orders_are_counted_per_customer_before_the_join(spark, wh, no_broadcast):
    orders = stored(
        spark,
        hot(spark, name="customer_id_o").select(
            "customer_id_o", F.col("v").alias("o_orderkey"), F.lit("O").alias("o_orderstatus")
        ),
        wh, "o",
    )
    customers = stored(
        spark,
        spark.range(9).select(F.col("id").alias("customer_id_c"), F.lit("A").alias("c_mktsegment"), "id"),
        wh, "c",
    )
    text = plan(segment_counts(orders, customers))
    assert text.index("SortMergeJoin") < text.index("partial_count(o_orderkey")
    assert text.count("Exchange") == 3  # one per join side, one for the segments
    status = plan(counts_by_status(orders, customers, "O"))
    assert "EqualTo(o_orderstatus,O)" in status or "In(o_orderstatus, [O])" in status


def test_members_shrink_before_the_shuffle(spark):
    text = plan(unique_members(hot(spark), ["k"], ["v"]))
    below = text[text.rindex("Exchange hashpartitioning(k") :]
    assert "HashAggregate(keys=[k" in below and text.count("Exchange") == 2


def test_preview_keeps_n_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(preview(hot(spark), 5, [F.desc("v")]))


def test_results_do_not_depend_on_the_join_strategy(spark, wh, no_broadcast):
    wh.publish(hot(spark, 3000), "t")
    target = wh.read("t")
    source = hot(spark, 4500)
    expected = sorted(i for i in range(3000, 4500) if i % 3)
    assert [r[0] for r in rows(new_rows(source, target, ["k"]).select("k"))] == sorted(expected, key=str)


def test_a_hot_source_key_is_split_among_the_inserts(spark, wh, no_broadcast):
    source = stored(spark, hot(spark), wh, "source")
    held = spark.range(10_000, 40_000).select(F.col("id").alias("k"))
    with staged(held) as seen:
        out = without_keys(source, seen, ["k"])
        assert "skew=true" in ran(out)


def test_order_drops_join_the_lines_once_and_group_where_they_lie(spark, tmp_path, no_broadcast):
    from siltstone.catalog import loads

    tables = {
        "lineitem": "SELECT id DIV 2 AS l_orderkey, id % 3 AS l_partkey, CAST(id % 2 AS INT) AS l_linenumber, 1D AS l_quantity, "
        "2D AS l_extendedprice, 0.5D AS l_tax, if(id % 2 = 0, 'R', NULL) AS l_returnflag, TIMESTAMP_NTZ '1998-01-01' AS l_shipdate FROM range(8)",
        "orders": "SELECT id AS o_orderkey, id % 2 AS o_custkey, TIMESTAMP_NTZ '1997-01-01' AS o_orderdate FROM range(4)",
        "customer": "SELECT id AS c_custkey, 'c' AS c_name, if(id = 0, 'BUILDING', 'x') AS c_mktsegment FROM range(2)",
        "part": "SELECT id AS p_partkey, 'p' AS p_name FROM range(3)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    for key in [loads.ITEM_KEY, loads.LINE_KEY]:
        drops = loads._order_drops(spark, str(tmp_path), key)
        text = plan(drops)
        assert text.count("FileScan parquet") == 4
        assert text.count("Exchange hashpartitioning(") == 6  # two sides of three joins, none for the grouping
    # Every key has one row a drop; half of the lines were returned and come again without tax.
    assert rows(drops.groupBy("b").agg(F.count("*"), F.max("Tax"))) == [(2, 8, 0.5), (3, 4, 0.0)]


def test_a_feed_is_split_into_batches_without_a_shuffle(spark):
    from siltstone.catalog.fixtures import split_into_batches

    batch = split_into_batches(spark.range(0, 8, 1, 4).withColumn("b", F.col("id") % 2), "b", [0, 1])
    assert rows(batch(1).select("id")) == [(1,), (3,), (5,), (7,)]
    assert len(batch(1).inputFiles()) == 8  # two batches, a file of each from each task
