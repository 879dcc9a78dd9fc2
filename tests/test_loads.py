from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.functions.columns import line_total
from siltstone.operators.rows import (
    classify_changes,
    dedupe,
    grain_violations,
    members,
    new_rows,
    preview,
    split_changes,
)
from siltstone.plans.dimensions import load_date_dim, load_member_dim, load_scd2
from siltstone.plans.facts import Dimension, load_fact, load_order_fact, lookup_keys
from siltstone.plans.ingest import (
    ExtractionFailed,
    Feed,
    create_control,
    extract_incremental,
    run_control_table,
    set_watermark,
    watermark,
)
from siltstone.plans.orders import (
    counts_by_status,
    gold_by_status,
    gold_segment_counts,
    load_gold_by_status,
    load_silver_orders,
    order_line_schema,
    orders_staging,
    revenue_by_year_category,
    segment_counts,
)
from siltstone.session import new_folder
from siltstone.sources.files import (
    read_csv,
    read_database,
    read_delimited,
    read_parquet,
    read_since,
    route_csv,
    write_bronze,
    write_parquet,
)

TS = dt.datetime(2024, 1, 1)


# -- facts --------------------------------------------------------------------

SALES = "Branch_ID string, Model_ID string, Revenue bigint, Units_Sold bigint, Date_ID string"
GRAIN = ["Branch_ID", "Model_SK", "Date_ID"]
COLUMNS = ["Branch_ID", "Model_ID", "Model_SK", "Revenue", "Units_Sold", "Total_Revenue", "Date_ID"]


def _load(wh, frame, source, batch_id=None):
    dims = [Dimension(wh.read("product"), {"Model_ID": "Model_ID"}, ["Model_SK"])]
    load_fact(
        wh, "fact", frame(source, SALES), dims, COLUMNS, GRAIN,
        {"Total_Revenue": line_total("Revenue", "Units_Sold")}, batch_id=batch_id,
    )


def _product(wh, frame, name, ts):
    load_scd2(
        wh, "product", frame([("m", name)], "Model_ID string, Product_Name string"),
        ["Model_ID"], ["Product_Name"], "Model_SK", ts,
    )


def test_fact_uses_current_versions_and_never_fans_out(wh, frame):
    _product(wh, frame, "old", dt.datetime(2024, 1, 1))
    _product(wh, frame, "new", dt.datetime(2024, 1, 2))
    _load(wh, frame, [("b", "m", 10, 2, "d1"), ("b", "unknown", 5, 1, "d1")])
    assert rows(wh.read("fact")) == [
        ("b", "m", 2, 10, 2, 20, "d1", "Insert"),
        ("b", "unknown", None, 5, 1, 5, "d1", "Insert"),
    ]


def test_fact_merge_updates_whole_rows_and_tags_them(wh, frame):
    _product(wh, frame, "p", TS)
    _load(wh, frame, [("b", "m", 10, 2, "d1"), ("b", "?", 1, 1, "d1")], "one")
    for _ in range(2):
        _load(wh, frame, [("b", "m", 7, 3, "d1"), ("b", "m", 1, 1, "d2"), ("b", "?", 2, 2, "d1")], "two")
    assert rows(wh.read("fact")) == [
        ("b", "?", None, 2, 2, 4, "d1", "Update"),  # a NULL key in the grain matches itself
        ("b", "m", 1, 1, 1, 1, "d2", "Insert"),
        ("b", "m", 1, 7, 3, 21, "d1", "Update"),
    ]


def test_lookup_on_a_composite_key_with_null(frame):
    fact = frame([(1, None, "x"), (1, "e", "y"), (2, "e", "z")], "a int, b string, v string")
    dim = frame([(1, None, 10), (1, "e", 11)], "n int, m string, sk int")
    found = lookup_keys(fact, [Dimension(dim, {"a": "n", "b": "m"}, ["sk"])])
    assert rows(found) == [(1, "e", "y", 11), (1, None, "x", 10), (2, "e", "z", None)]


def test_order_fact_grain_keeps_a_second_line_of_the_day(wh, frame):
    schema = "CustomerName string, Email string, OrderDate date, OrderNumber string, LineNumber int, Qty int"
    day = dt.date(2024, 5, 1)
    drops = [
        [("Ada L", "a", day, "o1", 1, 5), ("Ada L", "a", day, "o1", 2, 6)],
        [("Ada L", "a", day, "o1", 2, 99), ("Bo M", None, day, "o2", 1, 7)],
        [("Bo M", None, day, "o2", 1, 8)],
    ]
    for drop in drops:
        lines = frame(drop, schema)
        load_member_dim(wh, "c", lines, ["CustomerName", "Email"], "CustomerName", "CustomerID")
        load_date_dim(wh, "d", lines, "OrderDate")
        dims = [
            Dimension(wh.read("c"), {"CustomerName": "CustomerName", "Email": "Email"}, ["CustomerID"]),
            Dimension(wh.read("d"), {"OrderDate": "DateKey"}, ["DateKey"]),
        ]
        columns = ["CustomerID", "DateKey", "OrderNumber", "LineNumber", F.col("Qty").alias("Quantity")]
        load_order_fact(
            wh, "f", lines, dims, columns, ["CustomerID", "DateKey", "OrderNumber", "LineNumber"]
        )
    assert rows(wh.read("f")) == [
        (1, day, "o1", 1, 5), (1, day, "o1", 2, 6), (2, day, "o2", 1, 7),
    ]


# -- silver and gold ------------------------------------------------------------


def _drop(frame, folder, lines):
    frame(lines, order_line_schema()).write.option("header", True).csv(folder)
    return folder


def test_silver_first_run_inserts_only_and_later_runs_upsert(wh, spark, frame):
    root = new_folder(spark, "silver")
    day = dt.date(2024, 5, 1)
    first = [("o1", 1, day, "Ada", "a", "pen", 1, 900.0, 0.5), ("o2", 1, day, None, "b", "ink", 2, 10.0, 0.5)]
    second = [("o1", 1, day, "Ada", "a", "pen", 3, 1600.0, 0.5), ("o3", 1, day, "Cy", "c", "pad", 1, 1.0, 0.5)]
    load_silver_orders(wh, "s", read_csv(spark, _drop(frame, f"{root}/1", first) + "/*.csv", order_line_schema()), TS)
    load_silver_orders(wh, "s", read_csv(spark, _drop(frame, f"{root}/2", second) + "/*.csv", order_line_schema()), TS)
    got = wh.read("s").select("OrderNumber", "CustomerName", "Qty", "BucketSize", "update_status")
    assert rows(got) == [
        ("o1", "Ada", 3, "Big", "updated_record"),
        ("o2", "Unknown", 2, "Small", ""),
        ("o3", "Cy", 1, "Small", ""),
    ]
    files = [r[0] for r in wh.read("s").select("SoureFile").distinct().collect()]
    assert len(files) >= 2 and all(f.endswith(".csv") for f in files)


ORDERS = "o_orderkey bigint, customer_id_o bigint, o_orderstatus string"
CUSTOMERS = "customer_id_c bigint, c_mktsegment string"


def test_gold_counts_keep_orders_without_a_customer(frame):
    orders = frame([(1, 1, "O"), (2, 1, "F"), (3, 9, "O"), (None, 2, "O"), (5, None, "O")], ORDERS)
    customers = frame([(1, "A"), (2, "B"), (3, "C")], CUSTOMERS)
    assert rows(segment_counts(orders, customers)) == [("A", 2), ("B", 0), (None, 2)]
    plain = orders_staging(orders, customers, TS).groupBy("c_mktsegment").agg(F.count("o_orderkey"))
    assert rows(plain) == [("A", 2), ("B", 0), (None, 2)]
    assert gold_segment_counts(orders, customers, TS).columns == ["c_mktsegment", "total_orders", "insert_timestamp"]


def test_a_customer_listed_twice_counts_as_in_the_plain_join(frame):
    orders = frame([(1, 1, "O"), (2, 1, "F")], ORDERS)
    customers = frame([(1, "A"), (1, "A"), (1, "B")], CUSTOMERS)
    assert rows(segment_counts(orders, customers)) == [("A", 4), ("B", 2)]


def test_each_status_gets_its_own_table(frame):
    orders = frame([(1, 1, "O"), (2, 1, "F"), (3, 1, "O")], ORDERS)
    customers = frame([(1, "A")], CUSTOMERS)
    tables = gold_by_status(orders, customers, "O,F", TS)
    assert {n: [r[1] for r in rows(t)] for n, t in tables.items()} == {
        "orders_gold_aggregations_O": [2],
        "orders_gold_aggregations_F": [1],
    }
    assert rows(counts_by_status(orders, customers, "O,F")) == [("F", "A", 1), ("O", "A", 2)]


def test_unset_statuses_give_an_empty_default_table(frame):
    tables = gold_by_status(frame([(1, 1, "O")], ORDERS), frame([(1, "A")], CUSTOMERS), None, TS)
    (name, table), = tables.items()
    assert name == "orders_gold_aggregations_NA"
    assert table.count() == 0 and table.columns == ["c_mktsegment", "total_orders", "insert_timestamp"]


def test_a_status_with_a_quote_is_a_plain_value(frame):
    orders = frame([(1, 1, "it's")], ORDERS)
    tables = gold_by_status(orders, frame([(1, "A")], CUSTOMERS), "it's", TS)
    assert [t.count() for t in tables.values()] == [1]


def test_all_statuses_are_counted_in_one_pass(wh, frame):
    orders = frame([(1, 1, "O"), (2, 1, "F"), (3, 1, "O"), (4, 1, "it's"), (5, 1, "P")], ORDERS)
    customers = frame([(1, "A")], CUSTOMERS)
    for _ in range(2):
        tables = load_gold_by_status(wh, "gold.status", orders, customers, "O,F,it's,X", TS, "b1")
    assert wh.version("gold.status") == 1
    assert {n.removeprefix("orders_gold_aggregations_"): [r[:2] for r in rows(t)] for n, t in tables.items()} == {
        "O": [("A", 2)], "F": [("A", 1)], "it's": [("A", 1)], "X": [],
    }
    for table in tables.values():
        assert table.columns == ["c_mktsegment", "total_orders", "insert_timestamp"]
    # A gold table reads the folder of its status only, and no orders.
    text = tables["orders_gold_aggregations_O"]._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "PartitionFilters: [isnotnull(o_orderstatus" in text
    (name, empty), = load_gold_by_status(wh, "gold.none", orders, customers, None, TS).items()
    assert name == "orders_gold_aggregations_NA" and empty.count() == 0


def test_revenue_report_order(frame):
    schema = "Model_ID string, Year int, Revenue bigint, Units_Sold bigint"
    sales = frame([("B-1", 2020, 5, 2), ("A-1", 2020, 1, 1), ("B-2", 2020, 1, 3), ("A-9", 2019, 4, 4)], schema)
    assert [tuple(r) for r in revenue_by_year_category(sales).collect()] == [
        (2019, "A", 16), (2020, "B", 13), (2020, "A", 1),
    ]


# -- row operators ----------------------------------------------------------------


def test_dedupe_and_grain(frame):
    df = frame([(1, 3), (1, 5), (2, 1), (None, 1), (None, 2)], "k int, n int")
    assert rows(dedupe(df, ["k"], [F.desc("n")])) == [(1, 5), (2, 1), (None, 2)]
    assert dedupe(df, ["k"]).count() == 3
    assert rows(grain_violations(df, ["k"])) == [(1, 2), (None, 2)]
    assert rows(members(df, ["k"])) == [(1,), (2,), (None,)]
    assert [r.n for r in preview(df, 2, [F.desc("n"), F.asc("k")]).collect()] == [5, 3]


def test_changes_are_computed_once_and_routed_by_folder(frame):
    source = frame([("a", "x"), ("b", "y"), ("c", None), ("d", "w")], "k string, v string")
    target = frame([("b", "z"), ("c", None), ("d", None)], "k string, v string")
    new, updated = split_changes(classify_changes(source, target, ["k"], ["v"]))
    assert rows(new) == [("a", "x", None)] and rows(updated) == [("b", "y", "z"), ("d", "w", None)]
    for route in (new, updated):
        plan = route._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Join" not in plan and "PartitionFilters: [isnotnull(Dataset" in plan
    none = split_changes(classify_changes(source, source, ["k"], ["v"]))
    assert [r.collect() for r in none] == [[], []]


def test_new_rows_keep_repeated_source_rows(frame):
    source = frame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "k int, v string")
    target = frame([(1, "z"), (1, "z"), (None, "z")], "k int, v string")
    assert rows(new_rows(source, target, ["k"])) == [(2, "b"), (2, "b")]
    assert new_rows(source, target.limit(0), ["k"]).count() == 4


# -- files and databases -------------------------------------------------------------


def test_delimited_text_with_mark_quotes_and_dirty_values(spark, tmp_path):
    text = '﻿id,name,amount\n1,"a, \\"b\\"",10\n2,plain,not a number\n'
    (tmp_path / "in.csv").write_text(text, encoding="utf-8")
    mapping = [("id", "ID", "int"), ("name", "Name", "string"), ("amount", "Amount", "bigint")]
    assert rows(read_delimited(spark, str(tmp_path), mapping)) == [(1, 'a, "b"', 10), (2, "plain", None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_delimited(spark, str(tmp_path), mapping, strict=True).collect()


def test_bronze_write_overwrites_its_folder(spark, frame):
    lake = new_folder(spark, "lake")
    write_bronze(frame([(1,)], "k int"), lake, "t")
    path = write_bronze(frame([(2,)], "k int"), lake, "t")
    assert path == f"{lake}/t" and rows(read_parquet(spark, path)) == [(2,)]
    write_parquet(frame([(3,)], "k int"), path)
    assert rows(read_parquet(spark, path)) == [(3,)]


def test_a_view_of_a_frame(spark, frame):
    frame([(1,), (1,)], "k int").createOrReplaceTempView("silver_view")
    assert rows(spark.sql("SELECT k, count(1) n FROM silver_view GROUP BY k")) == [(1, 2)]


def test_watermark_reaches_the_scan_typed_by_the_column(spark, frame):
    path = write_bronze(frame([(9,), (10,), (11,)], "k int"), new_folder(spark, "lake"), "t")
    df = read_since(read_parquet(spark, path), "k", "9")
    assert rows(df) == [(10,), (11,)]  # as numbers, not as text
    assert "GreaterThan(k,9)" in df._jdf.queryExecution().executedPlan().toString()


def test_database_reader_options():
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def option(self, key, value):
            self.seen[key] = value
            return self

        def options(self, **more):
            self.seen.update(more)
            return self

        def load(self):
            return self.seen

    class Session:
        read = Reader()

    seen = read_database(Session(), "jdbc:x", "dbo.t", ("id", "0", "100", 8), user="u")
    assert seen == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "dbo.t", "user": "u", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "100", "numPartitions": 8,
    }


# -- extraction -------------------------------------------------------------------


def _feed(frame, keys):
    return Feed(lambda: frame([(k,) for k in keys], "k int"), "k")


def test_extraction_is_full_then_strictly_above_the_mark(wh, frame):
    create_control(wh, "c", {"t": "key"})
    extract_incremental(wh, "c", "t", _feed(frame, [5, 9, 10]))
    assert watermark(wh, "c", "t") == "10"
    extract_incremental(wh, "c", "t", _feed(frame, [10, 3, 11, 100]))
    assert rows(wh.read("bronze.t")) == [(10,), (100,), (11,), (5,), (9,)]
    assert rows(wh.read("landing.t")) == [(100,), (11,)]
    assert watermark(wh, "c", "t") == "100"


def test_nothing_new_leaves_the_mark_and_bronze(wh, frame):
    create_control(wh, "c", {"t": "key", "empty": "key"})
    extract_incremental(wh, "c", "t", _feed(frame, [1]))
    version = wh.version("bronze.t")
    assert extract_incremental(wh, "c", "t", _feed(frame, [1])) == version
    extract_incremental(wh, "c", "empty", _feed(frame, []))
    assert (watermark(wh, "c", "t"), watermark(wh, "c", "empty")) == ("1", None)
    assert not wh.exists("bronze.empty")
    with pytest.raises(ValueError, match="no row for other"):
        watermark(wh, "c", "other")


def test_a_run_that_died_before_moving_the_mark_is_finished(wh, frame, monkeypatch):
    import siltstone.plans.ingest as ingest

    create_control(wh, "c", {"t": "key"})

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "set_watermark", die)
    with pytest.raises(RuntimeError):
        extract_incremental(wh, "c", "t", _feed(frame, [1, 2]))
    monkeypatch.setattr(ingest, "set_watermark", set_watermark)
    # Row 3 came between the two runs: the rerun only finishes the mark, the next run takes it.
    extract_incremental(wh, "c", "t", _feed(frame, [1, 2, 3]))
    assert watermark(wh, "c", "t") == "2"
    extract_incremental(wh, "c", "t", _feed(frame, [1, 2, 3]))
    assert rows(wh.read("bronze.t")) == [(1,), (2,), (3,)]


def test_a_run_that_died_before_bronze_starts_over(wh, frame, monkeypatch):
    create_control(wh, "c", {"t": "key"})
    publish = type(wh).publish

    def die(wh, df, name, *args, **options):
        if name.startswith("bronze."):
            raise RuntimeError("lost")
        return publish(wh, df, name, *args, **options)

    monkeypatch.setattr(type(wh), "publish", die)
    with pytest.raises(RuntimeError):
        extract_incremental(wh, "c", "t", _feed(frame, [1]))
    monkeypatch.setattr(type(wh), "publish", publish)
    extract_incremental(wh, "c", "t", _feed(frame, [1, 2]))
    assert rows(wh.read("bronze.t")) == [(1,), (2,)]


def _marked_feed(wh, frame, schema, rows):
    create_control(wh, "control", {"t": "ts"})
    state = {"rows": rows}
    return state, Feed(lambda: frame(state["rows"], schema), schema.split(",")[-1].split()[0])


def test_a_reset_mark_loads_everything_again(wh, frame):
    state, feed = _marked_feed(wh, frame, "id int", [(1,), (2,)])
    extract_incremental(wh, "control", "t", feed)
    for _ in range(2):
        state["rows"] = [(1,), (2,), (3,), (4,)]
        set_watermark(wh, "control", "t", None)
        extract_incremental(wh, "control", "t", feed)
        assert sorted(r[0] for r in wh.read("bronze.t").collect()) == [1, 2, 3, 4]
    assert watermark(wh, "control", "t") == "4"


def test_a_mark_set_back_repeats_from_there(wh, frame):
    state, feed = _marked_feed(wh, frame, "id int", [(1,), (2,)])
    extract_incremental(wh, "control", "t", feed)
    state["rows"] = [(1,), (2,), (3,)]
    extract_incremental(wh, "control", "t", feed)
    set_watermark(wh, "control", "t", "2")
    extract_incremental(wh, "control", "t", feed)
    assert sorted(r[0] for r in wh.read("bronze.t").collect()) == [1, 2, 3, 3]


def test_zoned_marks_do_not_depend_on_the_session(spark, wh, frame):
    """A run in another zone, and the hour that a zone repeats in autumn."""
    at = lambda text: dt.datetime.fromisoformat(text)
    rows = [(at("2024-11-03T05:30:00+00:00"),), (at("2024-11-03T06:30:00+00:00"),)]
    state, feed = _marked_feed(wh, frame, "ts timestamp", rows)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for _ in range(2):
            spark.conf.set("spark.sql.session.timeZone", "America/New_York")
            extract_incremental(wh, "control", "t", feed)
            assert wh.read("bronze.t").count() == 2
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        state["rows"] = [*rows, (at("2024-11-03T07:30:00+00:00"),)]
        extract_incremental(wh, "control", "t", feed)
        assert wh.read("bronze.t").count() == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_csv_with_a_value_that_does_not_fit_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n3000000000\n")
    with pytest.raises(Exception, match="3000000000|MALFORMED|FAILFAST"):
        read_csv(spark, str(tmp_path), "id int").collect()


def test_flawed_rows_are_routed_and_short_ones_are_good(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,day\n1,"x,y",2024-01-01\n2\n3,"",\n')
    (tmp_path / "b.csv").write_text("id,name,day\n3000000000,b,2024-01-01\n4,c,soon\nz,c,soon\n5,e,2024-01-01,more\n")
    good, bad = route_csv(spark, str(tmp_path), "id int, name string, day date")
    first = dt.date(2024, 1, 1)
    assert [tuple(r) for r in good.orderBy("id").collect()] == [(1, "x,y", first), (2, None, None), (3, None, None)]
    found = [(r[0].rsplit("/", 1)[1], *r[1:]) for r in bad.orderBy("reject_record").collect()]
    assert found == [
        ("b.csv", "id is no int", "3000000000,b,2024-01-01,"),
        ("b.csv", "day is no date", "4,c,soon,"),
        ("b.csv", "more fields than columns", "5,e,2024-01-01,more"),
        ("b.csv", "id is no int; day is no date", "z,c,soon,"),
    ]
    assert read_csv(spark, str(tmp_path / "a.csv"), "id int, name string, day date").count() == 3


def test_landing_keeps_one_folder(wh, frame):
    """Ten runs, one of them after a run that died; every run sees its own rows only."""
    def folders():
        return [s.getPath().getName() for s in wh._list(wh.path("landing.t")) if s.getPath().getName().startswith("__load")]

    for n in range(10):
        if n == 5:
            frame([(99,)], "id int").write.parquet(f"{wh.path('landing.t')}/__load=dead")
        wh.replace_landing(frame([(n,)], "id int"), "landing.t")
        assert [tuple(r) for r in wh.read("landing.t").collect()] == [(n,)]
        assert len(folders()) == 1


def feeds_of(frame, broken=()):
    def read(name):
        if name in broken:
            raise OSError(f"{name} cannot be reached")
        return frame([(n * 10, name) for n in range(1, 4)], "id int, t string")

    return {name: Feed(lambda name=name: read(name), "id") for name in ["a", "b", "c", "d", "e"]}


def test_tables_at_once_give_the_marks_of_a_run_one_by_one(wh, frame):
    names = list(feeds_of(frame))
    for control in ("one", "many"):
        create_control(wh, control, dict.fromkeys(names, "key"))
    run_control_table(wh, "one", feeds_of(frame))
    one = rows(wh.read("one"))
    for name in names:
        wh.drop(f"bronze.{name}")
    done = run_control_table(wh, "many", feeds_of(frame), parallel=4)
    assert list(done) == names and rows(wh.read("many")) == one
    assert all(wh.read(f"bronze.{n}").count() == 3 for n in names)
    # A mark a table: five commits after the creation.
    assert wh.version("many") == 6
    run_control_table(wh, "many", feeds_of(frame), parallel=2)
    assert rows(wh.read("many")) == one and all(wh.read(f"bronze.{n}").count() == 3 for n in names)


def test_a_table_that_fails_leaves_the_others_done(wh, frame):
    create_control(wh, "control", dict.fromkeys("abcde", "key"))
    with pytest.raises(ExtractionFailed, match="b cannot be reached") as told:
        run_control_table(wh, "control", feeds_of(frame, {"b", "d"}), parallel=5)
    assert set(told.value.done) == {"a", "c", "e"} and set(told.value.failed) == {"b", "d"}
    marks = {r["table_name"]: r["cdc_value"] for r in wh.read("control").collect()}
    assert marks == {"a": "30", "b": None, "c": "30", "d": None, "e": "30"}
    run_control_table(wh, "control", feeds_of(frame), parallel=5)
    assert {r["cdc_value"] for r in wh.read("control").collect()} == {"30"}
    assert all(wh.read(f"bronze.{n}").count() == 3 for n in "abcde")
