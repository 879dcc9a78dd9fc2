from __future__ import annotations

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.columns import (
    bucketize,
    conform,
    default_if_blank,
    differs,
    line_total,
    name_parts,
    with_null_safe_keys,
)
from siltstone.plans.orders import PRICE_CLASSES, SMALLEST_CLASS


def test_price_classes_at_their_bounds(frame):
    df = frame([(800.0,), (800.01,), (1500.0,), (1500.01,), (None,)], "p double")
    out = df.select("p", bucketize(F.col("p"), PRICE_CLASSES, SMALLEST_CLASS))
    assert dict(map(tuple, out.collect())) == {
        800.0: "Small", 800.01: "Medium", 1500.0: "Medium", 1500.01: "Big", None: "Small",
    }


def test_blank_and_null_names_get_the_default_and_spaces_do_not(frame):
    df = frame([("",), (None,), (" ",), ("x",)], "n string")
    got = [r[0] for r in df.select(default_if_blank(F.col("n"), "Unknown")).collect()]
    assert got == ["Unknown", "Unknown", " ", "x"]


def test_one_word_name_has_no_last_name(frame):
    df = frame([("Ada Lovelace",), ("Plato",), ("A B C",), (None,)], "n string")
    out = df.select(*(v.alias(k) for k, v in name_parts(F.col("n")).items())).collect()
    assert [tuple(r) for r in out] == [("Ada", "Lovelace"), ("Plato", None), ("A", "B"), (None, None)]


def test_a_null_against_a_value_is_a_difference(frame):
    df = frame([("a", "a"), ("a", None), (None, None), ("a", "b")], "x string, y string")
    got = [r[0] for r in df.select(differs([(F.col("x"), F.col("y"))])).collect()]
    assert got == [False, True, False, True]


def test_measure_overflow_raises(frame):
    df = frame([(2**62, 4)], "a bigint, b bigint").select(line_total("a", "b"))
    with pytest.raises(PySparkException, match="overflow"):
        df.collect()


def test_conform_orders_casts_fills_and_refuses_unknown_columns(frame):
    schema = T.StructType.fromDDL("a bigint, b string, c date")
    out = conform(frame([(1, 2)], "b int, a int"), schema)
    assert out.dtypes == [("a", "bigint"), ("b", "string"), ("c", "date")]
    assert rows(out) == [(2, "1", None)]
    with pytest.raises(ValueError, match="extra"):
        conform(frame([(1,)], "extra int"), schema)


@pytest.mark.parametrize(
    "dtype", ["string", "int", "bigint", "double", "decimal(10,2)", "date", "timestamp", "timestamp_ntz",
              "boolean", "binary"]
)
def test_null_safe_keys_of_every_key_type(spark, dtype):
    df = spark.sql(f"SELECT CAST(NULL AS {dtype}) k")
    keyed, names = with_null_safe_keys(df, ["k"])
    assert tuple(keyed.select(*(F.col(n).isNotNull() for n in names)).first()) == (True, True)
    other, _ = with_null_safe_keys(df, ["k"])
    assert keyed.join(other.select(*names), names).count() == 1


def test_a_null_key_is_not_the_filler_value(frame):
    left, names = with_null_safe_keys(frame([(0,), (None,)], "k int"), ["k"])
    right, _ = with_null_safe_keys(frame([(None,)], "k int"), ["k"])
    assert [r.k for r in left.join(right.select(*names), names, "left_semi").collect()] == [None]
