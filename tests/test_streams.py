from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.session import new_folder
from siltstone.streaming.streams import (
    append_flows,
    order_feed_schema,
    rejects,
    route_stream,
    stream_bronze,
    stream_checked_csv,
    stream_csv,
    stream_merge,
    stream_routed,
    stream_table,
    stream_to_table,
    stream_upsert,
)

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])


def test_each_file_is_taken_up_once(spark, frame):
    root = new_folder(spark, "stream")
    for n in range(3):
        frame([(n, "a")], "k int, v string").write.mode("append").option("header", True).csv(f"{root}/in")
        for _ in range(2):
            stream_to_table(stream_csv(spark, f"{root}/in", SCHEMA, 1), f"{root}/out", f"{root}/cp")
    assert rows(spark.read.parquet(f"{root}/out")) == [(0, "a"), (1, "a"), (2, "a")]


def test_two_flows_into_one_table_lose_nothing(spark):
    root = new_folder(spark, "flows")
    for part, lo in (("a", 0), ("b", 100)):
        spark.range(lo, lo + 100).select(F.col("id").cast("int").alias("k"), F.lit(part).alias("v")).repartition(
            4
        ).write.parquet(f"{root}/{part}")
    for _ in range(2):
        flows = [stream_table(spark, f"{root}/{part}", SCHEMA, 2) for part in "ab"]
        append_flows(flows, f"{root}/out", f"{root}/cp")
    out = spark.read.parquet(f"{root}/out")
    assert (out.count(), out.select("k").distinct().count()) == (200, 200)


def test_bronze_union_has_the_declared_types_and_names(spark, frame):
    root = new_folder(spark, "bronze")
    schema = T.StructType.fromDDL("o_orderkey bigint, o_custkey bigint, o_orderdate date")
    frame([(1, 7, None, None, "1999-01-01")], "o_orderkey int, o_custkey int, o_orderstatus string,"
          " o_totalprice double, o_orderdate string").write.option("header", True).csv(f"{root}/files")
    spark.sql("SELECT 2L o_orderkey, 8L o_custkey, DATE'2000-02-02' o_orderdate").write.parquet(f"{root}/table")
    out = stream_bronze(spark, f"{root}/files", f"{root}/table", schema, f"{root}/lake")
    assert out.columns[1] == "customer_id_o"
    assert [f.dataType for f in out.schema] == [f.dataType for f in order_feed_schema()]
    assert rows(out.select("o_orderkey", "customer_id_o", "o_orderdate")) == [
        (1, 7, "1999-01-01"), (2, 8, "2000-02-02"),
    ]


def test_rejects_stay_beside_the_good_rows(spark):
    root = new_folder(spark, "routed")
    good, late = ["k,v", "1,a", "2", "3,", ""], ["k,v", "3000000000,b", "4,c,d", "x,e", "5,f"]
    for n, lines in enumerate([good, late]):
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("append").text(f"{root}/in")
        for _ in range(2):
            route_stream(stream_checked_csv(spark, f"{root}/in", SCHEMA, 1), f"{root}/out", f"{root}/cp")
        stream_to_table(stream_routed(spark, f"{root}/out", SCHEMA), f"{root}/next", f"{root}/cp2")
    assert rows(spark.read.parquet(f"{root}/next")) == [(1, "a"), (2, None), (3, None), (5, "f")]
    assert rows(rejects(spark, f"{root}/out", SCHEMA)) == [
        ("k is no int", "3000000000,b,"), ("k is no int", "x,e,"), ("more fields than columns", "4,c,d"),
    ]
    scan = rejects(spark, f"{root}/out", SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in scan


def test_a_strict_stream_stops_at_a_value_that_does_not_fit(spark):
    root = new_folder(spark, "strict")
    spark.createDataFrame([("k,v\n3000000000,b",)], "value string").write.text(f"{root}/in")
    with pytest.raises(Exception, match="MALFORMED"):
        stream_to_table(stream_csv(spark, f"{root}/in", SCHEMA), f"{root}/out", f"{root}/cp")


def _upsert(wh, spark, root):
    return stream_upsert(
        wh, "t", stream_table(spark, f"{root}/in", SCHEMA), ["k"], [F.desc("v")], f"{root}/log", f"{root}/cp"
    )


def test_streamed_upsert_takes_the_latest_change_and_reruns_are_no_ops(wh, spark, frame):
    root = new_folder(spark, "upsert")
    frame([(1, "a"), (1, "b"), (2, "a")], "k int, v string").write.parquet(f"{root}/in")
    version = _upsert(wh, spark, root)
    assert _upsert(wh, spark, root) == version
    frame([(2, "c"), (3, "a")], "k int, v string").write.mode("append").parquet(f"{root}/in")
    _upsert(wh, spark, root)
    assert rows(wh.read("t")) == [(1, "b"), (2, "c"), (3, "a")]


def test_a_streamed_upsert_that_died_before_its_merge_is_finished(wh, spark, frame, monkeypatch):
    import siltstone.streaming.streams as streams

    root = new_folder(spark, "upsert")
    frame([(1, "a")], "k int, v string").write.parquet(f"{root}/in")
    merge = streams.merge

    def die(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(streams, "merge", die)
    try:
        _upsert(wh, spark, root)
    except RuntimeError:
        pass
    assert wh.read("t").count() == 0
    monkeypatch.setattr(streams, "merge", merge)
    frame([(2, "b")], "k int, v string").write.mode("append").parquet(f"{root}/in")
    _upsert(wh, spark, root)
    assert rows(wh.read("t")) == [(1, "a"), (2, "b")]


def _merged(wh, spark, root):
    return stream_merge(wh, "t", stream_table(spark, f"{root}/in", SCHEMA, 1), ["k"], [F.desc("v")], f"{root}/cp")


def test_every_streamed_batch_is_merged_once(wh, spark, frame):
    root = new_folder(spark, "merge")
    for batch in ([(1, "a"), (1, "b"), (2, "a")], [(2, "c"), (3, "a")]):
        frame(batch, "k int, v string").coalesce(1).write.mode("append").parquet(f"{root}/in")
        version = _merged(wh, spark, root)
        assert _merged(wh, spark, root) == version
    assert rows(wh.read("t")) == [(1, "b"), (2, "c"), (3, "a")]


@pytest.mark.parametrize("after_the_merge", [False, True])
def test_a_streamed_batch_that_died_is_taken_up_again(wh, spark, frame, monkeypatch, after_the_merge):
    import siltstone.streaming.streams as streams

    root = new_folder(spark, "merge")
    frame([(1, "a")], "k int, v string").write.parquet(f"{root}/in")
    _merged(wh, spark, root)
    merge = streams.merge

    def die(*args, **kwargs):
        if after_the_merge:
            merge(*args, **kwargs)
        raise RuntimeError("lost")

    frame([(1, "b"), (2, "b")], "k int, v string").coalesce(1).write.mode("append").parquet(f"{root}/in")
    monkeypatch.setattr(streams, "merge", die)
    with pytest.raises(Exception, match="lost"):
        _merged(wh, spark, root)
    version = wh.version("t")
    monkeypatch.setattr(streams, "merge", merge)
    _merged(wh, spark, root)
    assert rows(wh.read("t")) == [(1, "b"), (2, "b")]
    assert (wh.version("t") == version) == after_the_merge
