"""Column expressions shared by the loads; all are built-in functions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bucketize(value: Column, bounds: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first bound that ``value`` exceeds; ``default`` otherwise, NULL included."""
    label = F
    for bound, name in bounds:
        label = label.when(value > bound, name)
    return label.otherwise(default)


def default_if_blank(value: Column, default: str) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def piece(value: Column, separator: str, index: int) -> Column:
    """Part ``index`` of a separated text, NULL where there is no such part."""
    return F.get(F.split(value, rf"\Q{separator}\E"), F.lit(index))


def name_parts(value: Column, separator: str = " ") -> dict[str, Column]:
    return {"FirstName": piece(value, separator, 0), "LastName": piece(value, separator, 1)}


def date_parts(day: Column) -> dict[str, Column]:
    """Calendar attributes of a date dimension row."""
    return {
        "Day": F.dayofmonth(day),
        "Month": F.month(day),
        "Year": F.year(day),
        "mmmyyyy": F.date_format(day, "MMM-yyyy"),
        "yyyymm": F.date_format(day, "yyyy-MM"),
    }


def as_timestamp(value: dt.datetime | Column) -> Column:
    """A batch time; a datetime without a zone is read in the session's time zone."""
    return (value if isinstance(value, Column) else F.lit(str(value))).cast("timestamp")


def line_total(price: str, units: str) -> Column:
    """Product of two measures; integer overflow raises under ANSI mode."""
    return F.col(price) * F.col(units)


def differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True where any pair differs, a NULL against a value counting as a difference."""
    result = F.lit(False)
    for left, right in pairs:
        result = result | ~left.eqNullSafe(right)
    return result


def _filler(dtype: T.DataType) -> Column:
    """A fixed non-null value of the type, to stand beside the "was NULL" flag."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        text = "1970-01-01"
    elif isinstance(dtype, T.BooleanType):
        text = "false"
    elif isinstance(dtype, (T.StringType, T.BinaryType)):
        text = ""
    else:
        text = "0"
    return F.lit(text).cast(dtype)


def with_null_safe_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add plain never-null columns on which equality means ``<=>`` on ``keys``.

    A join on ``a <=> b`` hashes on derived expressions, so an aggregation by
    ``a`` before it is shuffled again. Grouping and joining by these columns
    share one shuffle.
    """
    added: dict[str, Column] = {}
    schema = df.schema
    for i, key in enumerate(keys):
        added[f"__key{i}"] = F.coalesce(F.col(key), _filler(schema[key].dataType))
        added[f"__nul{i}"] = F.col(key).isNull()
    return df.withColumns(added), list(added)


def keyed_by(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str], dict[str, Column]]:
    """``df`` with the columns of ``with_null_safe_keys`` in place of its keys, their names, and the keys read from them.

    A shuffle by these columns then carries every key once.
    """
    wide, names = with_null_safe_keys(df, keys)
    given = {k: F.when(~F.col(f"__nul{i}"), F.col(f"__key{i}")) for i, k in enumerate(keys)}
    return wide.drop(*keys), names, {c: given.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; a column ``df`` lacks becomes NULL."""
    given = {f.name: f.dataType for f in df.schema.fields}
    unknown = [c for c in given if c not in schema.names]
    if unknown:
        raise ValueError(f"columns not in the target schema: {unknown}")

    def column(f: T.StructField) -> Column:
        if given.get(f.name) == f.dataType:
            return F.col(f.name)
        return (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)

    return df.select(*(column(f) for f in schema.fields))


def require_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail the write on a NULL in a column ``schema`` declares NOT NULL."""
    checked = {
        f.name: F.coalesce(
            F.col(f.name), F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}")).cast(f.dataType)
        )
        for f in schema.fields
        if not f.nullable
    }
    return df.withColumns(checked) if checked else df
