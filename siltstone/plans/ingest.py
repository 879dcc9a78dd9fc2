"""Incremental extraction by a stored high-water mark."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.sources.files import read_since
from siltstone.sources.warehouse import Warehouse

CONTROL_SCHEMA = "id int, table_name string, cdc_type string, cdc_value string"


@dataclass(frozen=True)
class Feed:
    """A source table: how to read it and the column its high-water mark follows."""

    read: Callable[[], DataFrame]
    column: str


def create_control(wh: Warehouse, control: str, tables: Mapping[str, str]) -> int:
    """Control table with a row per source table and no high-water mark yet.

    ``tables`` maps table names to a word on how their changes are found.
    """
    rows = [(i, name, kind, None) for i, (name, kind) in enumerate(tables.items(), 1)]
    return wh.publish(wh.spark.createDataFrame(rows, CONTROL_SCHEMA), control)


def watermark(wh: Warehouse, control: str, name: str) -> str | None:
    row = wh.read(control).filter(F.col("table_name") == name).select("cdc_value").first()
    if row is None:
        raise ValueError(f"{control} has no row for {name}")
    return row[0]


def set_watermark(wh: Warehouse, control: str, name: str, value: str | None) -> int:
    """Move the mark. By hand, NULL asks for a full load, an older value for a repetition from there."""
    moved = {f"runs.{name}": str(_runs(wh, control, name) + 1)}
    mark = F.lit(value).cast("string")
    return wh.update_where(control, F.col("table_name") == name, {"cdc_value": mark}, moved)


def _runs(wh: Warehouse, control: str, name: str) -> int:
    """How often the table's mark has been moved."""
    return int(wh.properties(control).get(f"runs.{name}", 0))


def next_watermark(landed: DataFrame, column: str) -> str | None:
    """Text of the largest landed value, compared in the column's own type.

    Zoned timestamps are noted as microseconds since 1970: their text depends on the session's zone.
    """
    most = F.max(column)
    if isinstance(landed.schema[column].dataType, T.TimestampType):
        most = F.unix_micros(most)
    return landed.agg(most.cast("string")).first()[0]


def extract_incremental(
    wh: Warehouse, control: str, name: str, feed: Feed, turn: AbstractContextManager | None = None
) -> int:
    """Land the rows above the stored mark, add them to bronze, then move the mark.

    The mark moves last. A run that died after the bronze commit is finished from
    the mark noted with that commit, so rows that arrived since are neither
    skipped nor landed twice. Moving the mark, by a run or by hand, starts a new run; a
    run from a NULL mark loads everything and replaces bronze. The landing table holds the last batch only.
    Runs that share a control table and go on at once commit their marks in ``turn``.
    Returns the version of the bronze table.
    """
    bronze = f"bronze.{name}"
    mark = watermark(wh, control, name)
    batch_id = f"run {_runs(wh, control, name)} after:{mark}"
    done = wh.batch(bronze, batch_id)
    if done is None:
        landing = f"landing.{name}"
        wh.replace_landing(read_since(feed.read(), feed.column, mark), landing)
        landed = wh.read(landing)
        next_mark = next_watermark(landed, feed.column)
        if next_mark is None:
            return wh.version(bronze)
        note = {"watermark": next_mark}
        if mark is None:
            wh.publish(landed, bronze, batch_id=batch_id, note=note)
        else:
            wh.append(landed, bronze, batch_id, note=note)
    else:
        next_mark = done["watermark"]
    with turn or nullcontext():
        set_watermark(wh, control, name, next_mark)
    return wh.version(bronze)


class ExtractionFailed(RuntimeError):
    """Some tables of a control table could not be extracted; the others are done."""

    def __init__(self, done: Mapping[str, int], failed: Mapping[str, BaseException]):
        super().__init__("; ".join(f"{name}: {error}" for name, error in failed.items()))
        self.done, self.failed = dict(done), dict(failed)


def run_control_table(
    wh: Warehouse, control: str, feeds: Mapping[str, Feed], parallel: int = 1
) -> dict[str, int]:
    """One extraction per control row, in order of its id, ``parallel`` of them at once.

    Each runs in a thread and a scheduler pool of its own, named after the table (where the cluster schedules fairly, its jobs
    share the executors with the others'); marks are committed one by one. A
    table that fails keeps its mark and does not stop the others: what is done is done, and then
    ``ExtractionFailed`` names the rest. The next run takes these up again.
    """
    names = [r[0] for r in wh.read(control).orderBy("id").select("table_name").collect()]
    turn = threading.Lock()
    context = wh.spark.sparkContext

    def extract(name: str) -> int:
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            return extract_incremental(wh, control, name, feeds[name], turn)
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)

    done: dict[str, int] = {}
    failed: dict[str, BaseException] = {}
    if parallel == 1:
        for name in names:
            done[name] = extract_incremental(wh, control, name, feeds[name])
        return done
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        runs = {name: pool.submit(inheritable_thread_target(wh.spark)(extract), name) for name in names}
        for name, run in runs.items():
            error = run.exception()
            if error is None:
                done[name] = run.result()
            else:
                failed[name] = error
    if failed:
        raise ExtractionFailed(done, failed) from next(iter(failed.values()))
    return done
