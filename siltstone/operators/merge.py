"""Merge into a warehouse table: one plan and one commit per call."""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence
from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.columns import conform, keyed_by, with_null_safe_keys
from siltstone.operators.rows import members, seen_keys, union_all, without_keys
from siltstone.session import broadcast_threshold, staged, staged_by, staged_with_size
from siltstone.sources.warehouse import FOLDER, Warehouse

Values = Mapping[str, Column] | str | None

_HASH, _NEW, _OLD = "__hash", "__new", "__old"  # a key's hash, and the rows of source and target that have it
#: A key on more rows than this is hot: its rows must not meet in one task.
_HOT = 1000
#: Bytes that a row takes at least; keys of which so many fit into a broadcast are worth a look at their rows.
_LEAST_ROW = 64
#: Decoded bytes that a task of a merge by partitions sorts, and how many tasks a partition and a plan may have.
_PART_BYTES, _SHARES, _PLAN_TASKS = 512 << 20, 8, 400


def _values(spec: Values, source: DataFrame, target_columns: Sequence[str]) -> dict[str, Column] | None:
    """Target column -> expression over the source; ``"*"`` takes every source column."""
    if spec is None:
        return None
    if spec == "*":
        return {c: F.col(c) for c in target_columns if c in source.columns}
    return dict(spec)


def merge(
    wh: Warehouse,
    name: str,
    source: DataFrame,
    on: Sequence[str],
    update: Values = "*",
    insert: Values = "*",
    target_where: Column | None = None,
    tag_column: str | None = None,
    batch_id: str | None = None,
    properties: Mapping[str, str] | None = None,
    staged_size: int | None = None,
) -> int:
    """Update the target rows whose key the source holds and insert the other source rows.

    ``update`` and ``insert`` map target columns to expressions over the source,
    ``"*"`` means all of them and ``None`` drops the clause; columns an insert
    leaves out become NULL. Keys compare NULL-safe. ``target_where`` limits the
    match to some target rows. ``tag_column`` is set to ``Update`` or ``Insert``.
    Two source rows hitting one target row are an error.

    Only folders with a matched row are rewritten; the target's keys are scanned in the source's partitions
    only where the table is partitioned by key columns. The join is Spark's choice as long as the source's decoded
    size is below Spark's own broadcast threshold. Of a bigger source, the hashes of the keys are met
    with the target's first. Source rows with no shared hash are new; if the others are few, they are
    merged as a small source. Otherwise one outer join of the touched folders with the source updates and inserts, or
    an insert leaves out the keys found. Whole keys decide everywhere, a shared hash only marks rows to look at.
    A source with several rows on a key to update, and hot keys on either side, take the way by one row per source key,
    staged and joined by sort and merge: run-time skew handling can split a hot key only between two plain shuffles,
    not next to an aggregation. A blank text in a partition column is a NULL, as Spark stores it so.

    Where the key holds the table's partition columns, a big source is staged by them and meets the target partition
    by partition: a task reads some partitions of both sides, or a share of the keys of a big one, and no row is
    shuffled. Many or very big partitions and hot keys take the ways above.

    ``staged_size`` is the decoded size of a source that is staged already, a big one by the table's partition columns
    if the key holds them; it is not written again then.
    """
    if wh.batch(name, batch_id) is not None:
        return wh.version(name)
    layout = wh.schema(name)
    if any(c.startswith("__") for c in layout.names):
        raise ValueError(f"{name} has a file layout of its own load; merge would not keep it")
    updates = _values(update, source, layout.names)
    inserts = _values(insert, source, layout.names)
    if tag_column:
        if updates is not None:
            updates[tag_column] = F.lit("Update")
        if inserts is not None:
            inserts[tag_column] = F.lit("Insert")

    partition_by = wh.record(name)["partition_by"]
    source = _blank_as_null(source, partition_by)
    laid = partition_by if _alike(source, layout, partition_by, on) else []
    with ExitStack() as stack:
        src, size = source, staged_size
        if size is None:
            src, size = stack.enter_context(staged_by(source, laid))
        small = size <= broadcast_threshold(wh.spark)
        folders = _folders_of(wh, name, src, [c for c in partition_by if c in on])
        target = wh.read(name, folders=folders, with_folder=True)
        if target_where is not None:
            target = target.filter(target_where)

        def held(df: DataFrame) -> DataFrame:
            return df if small else stack.enter_context(staged(df)).hint("merge")

        def inserted(df: DataFrame) -> DataFrame:
            return df.select(*(v.alias(c) for c, v in inserts.items()))

        touched: set[str] = set()
        branches = []
        near = src
        parts = []
        if not small:
            parts = _parts(src, size, laid, wh.read(name, folders=folders)) if laid else []
            found = _tally(wh, src, target, on, laid, parts) if parts else None
            if found is None or found.hot or (found.several and updates is not None):
                parts = []
                shared, n, several, hot = _shared_hashes(stack, src, target, on)
            if parts:
                near = None
                if found.folders and updates is not None:
                    touched = found.folders
                    rows = wh.read(name, folders=touched)
                    branches += _upserted(rows, layout, src, on, updates, inserts, target_where, laid, parts)
                elif inserts is not None:
                    new = _absent(src, target, on, laid, parts) if found.folders else _by_part(src, laid, parts, on, src)
                    branches.append(inserted(new))
            elif not n or n * _LEAST_ROW <= broadcast_threshold(wh.spark):
                near, small = None, True
                if n:
                    near, size = stack.enter_context(staged_with_size(_with_hash(src, target, on, shared, "left_semi")))
                    small = size <= broadcast_threshold(wh.spark)
                if inserts is not None:
                    branches.append(inserted(_with_hash(src, target, on, shared, "left_anti")) if n else inserted(src))
            elif updates is not None and not (several or hot):
                near = None
                touched = wh.touched_folders(_with_hash(target, src, on, shared, "left_semi"))
                branches += _upserted(wh.read(name, folders=touched), layout, src, on, updates, inserts, target_where)
            elif updates is None and not hot:
                near = None
                known = _with_hash(target, src, on, shared, "left_semi").select(*on)
                branches.append(inserted(without_keys(src, known, on)))
        if near is not None:
            by_key = held(_one_row_per_key(near, on, updates))
            found = seen_keys(by_key, target, on, [FOLDER])
            seen = stack.enter_context(staged(found))
            touched = wh.touched_folders(seen) if updates is not None else set()
            if touched:
                branches += _rewritten(wh, name, touched, by_key, on, updates, target_where)
            if inserts is not None:
                branches.append(inserted(without_keys(near, held(members(seen, on)), on)))
        ready = [conform(branch, layout) for branch in branches]
        return wh.replace(
            name,
            union_all(ready) if ready else None,
            touched,
            batch_id,
            properties=properties,
            rebalance=not parts,  # a part's rows come from one task already
            skip_empty=True,
        )


@dataclass(frozen=True)
class _Part:
    """Some partitions of source and target alike, or one of several shares of a big partition's keys."""

    partitions: Sequence[Sequence[object]]
    share: int = 0
    shares: int = 1

    def of(self, rows: DataFrame, columns: Sequence[Column]) -> DataFrame:
        """The part's rows in one task, so that what joins or groups them next needs no shuffle.

        ``columns`` are the partition columns, as the frame gives them; the key's hash is beside them.
        """
        own = [reduce(Column.__and__, (c.eqNullSafe(F.lit(v)) for c, v in zip(columns, values))) for values in self.partitions]
        wanted = reduce(Column.__or__, own)
        if self.shares > 1:
            wanted = wanted & (F.pmod(F.col(_HASH), F.lit(self.shares)) == self.share)
        return rows.filter(wanted).coalesce(1)


@dataclass(frozen=True)
class _Found:
    """What source and target have in common: folders with a shared hash, and whether a key is hot or to update twice."""

    folders: set[str]
    several: bool
    hot: bool


def _alike(source: DataFrame, layout: T.StructType, columns: Sequence[str], on: Sequence[str]) -> bool:
    """Whether a source can be laid like the table: its key holds the partition columns, with types that folders keep."""
    if not columns or not set(columns) <= set(on) or len(columns) == len(source.columns):
        return False
    kinds = [layout[c].dataType for c in columns]
    kept = all(isinstance(kind, (T.StringType, T.IntegralType, T.DateType)) for kind in kinds)
    return kept and kinds == [source.schema[c].dataType for c in columns]


def _parts(src: DataFrame, size: int, columns: Sequence[str], target: DataFrame | None = None) -> list[_Part]:
    """The source's partitions in parts that a task can sort; none where they are too many or too big.

    A big partition is cut into shares of its keys, each of which reads it, and small ones are put together. The
    driver gets a row count per partition of the source, up to a limit.
    """
    rows = src.select(*columns, F.lit(1).alias(_NEW), F.lit(0).alias(_OLD))
    if target is not None:
        rows = rows.unionAll(target.select(*columns, F.lit(0).alias(_NEW), F.lit(1).alias(_OLD)))
    counts = rows.groupBy(*columns).agg(F.sum(_NEW).alias(_NEW), F.sum(_OLD).alias(_OLD)).limit(100 * _PLAN_TASKS).collect()
    width = size / max(1, sum(r[_NEW] for r in counts))
    sizes = sorted((((r[_NEW] + r[_OLD]) * width, [r[c] for c in columns]) for r in counts), key=lambda s: -s[0])
    parts, small = [], []
    for weight, values in sizes:
        shares = math.ceil(weight / _PART_BYTES)
        if shares > _SHARES:
            return []
        if shares > 1:
            parts += [_Part([values], i, shares) for i in range(shares)]
        else:
            small.append((weight, values))
    tasks = max(2 * src.sparkSession.sparkContext.defaultParallelism, 2 * math.ceil(sum(w for w, _ in small) / _PART_BYTES))
    tasks = min(tasks, len(small))
    if len(parts) + tasks > _PLAN_TASKS or len(counts) == 100 * _PLAN_TASKS:
        return []
    filled = [(0.0, i, []) for i in range(tasks)]
    for weight, values in small:  # the biggest first, each to the emptiest part
        held, i, own = heapq.heappop(filled)
        own.append(values)
        heapq.heappush(filled, (held + weight, i, own))
    return parts + [_Part(own) for _, _, own in filled]


def _together(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of parts, each still in a task of its own.

    Spark would put frames of one partition each into one partition; as "at most two" it leaves them apart.
    """
    return union_all([df.coalesce(2) for df in frames])


def _by_part(
    rows: DataFrame, columns: Sequence[str], parts: Sequence[_Part], on: Sequence[str], other: DataFrame
) -> DataFrame:
    """The same rows, a task for each part."""
    hashed = rows.withColumn(_HASH, _hash_of(rows, other, on))
    return _together([part.of(hashed, [F.col(f"`{c}`") for c in columns]).drop(_HASH) for part in parts])


def _tally(
    wh: Warehouse, src: DataFrame, target: DataFrame, on: Sequence[str], columns: Sequence[str], parts: Sequence[_Part]
) -> _Found:
    """Meet the hashes of keys part by part.

    A key on three target rows or more in several folders counts for all folders of its part.
    """
    where, last, wide = "__where", "__last", "__wide"
    new = src.select(*columns, _hash_of(src, target, on).alias(_HASH), F.lit(1).alias(_NEW), F.lit(0).alias(_OLD), F.lit(None).cast("long").alias(where))
    old = target.select(
        *columns, _hash_of(target, src, on).alias(_HASH), F.lit(0).alias(_NEW), F.lit(1).alias(_OLD), F.xxhash64(FOLDER).alias(where)
    )
    both = (F.col(_NEW) > 0) & (F.col(_OLD) > 0)
    rows = new.unionAll(old)
    keys = [F.col(f"`{c}`") for c in columns]

    def met(part: _Part) -> DataFrame:
        by_hash = part.of(rows, keys).groupBy(_HASH).agg(
            F.sum(_NEW).alias(_NEW), F.sum(_OLD).alias(_OLD), F.min(where).alias(where), F.max(where).alias(last)
        )
        return by_hash.agg(
            F.collect_set(F.when(both, F.col(where))).alias(where),
            F.collect_set(F.when(both, F.col(last))).alias(last),
            F.max(both & (F.col(_OLD) > 2) & (F.col(where) != F.col(last))).alias(wide),
            F.max(both & (F.col(_NEW) > 1)).alias(_NEW),
            F.max((F.col(_NEW) > _HOT) | (F.col(_OLD) > _HOT)).alias(_OLD),
        )

    # Hashes are counted, not sorted, and take little room: a partition needs no shares here.
    told = _together([met(part if part.shares == 1 else _Part(part.partitions)) for part in parts if not part.share]).collect()
    hit = {h for r in told for h in (*r[where], *r[last])}
    listed = target.select(*columns, FOLDER, F.xxhash64(FOLDER)).distinct().collect() if hit else []
    folders = {wh.folder(r[-2]) for r in listed if r[-1] in hit}
    if any(r[wide] for r in told):
        folders |= {wh.folder(r[-2]) for r in listed}
    return _Found(folders, any(r[_NEW] for r in told), any(r[_OLD] for r in told))


def _absent(
    src: DataFrame, target: DataFrame, on: Sequence[str], columns: Sequence[str], parts: Sequence[_Part]
) -> DataFrame:
    """Source rows whose key no target row holds, part by part.

    An anti join would be pushed below the parts, where it needs a shuffle; an outer join stays.
    """
    left, names, given = keyed_by(src.withColumn(_HASH, _hash_of(src, target, on)), on)
    right, _, held = keyed_by(target.select(*on, _hash_of(target, src, on).alias(_HASH)), on)
    right = right.withColumn("__held", F.lit(True)).hint("merge")
    place, its = [given[c] for c in columns], [held[c] for c in columns]
    rows = [given[c] for c in src.columns]

    def new(part: _Part) -> DataFrame:
        met = part.of(left, place).join(part.of(right, its), names, "left")
        return met.filter(F.col("__held").isNull()).select(*rows)

    return _together([new(part) for part in parts])


def publish_parts(
    wh: Warehouse,
    name: str,
    rows: DataFrame,
    on: Sequence[str],
    partition_by: Sequence[str],
    batch_id: str | None = None,
    staged_size: int | None = None,
) -> int:
    """Publish a table's first rows; big ones that are staged by the partition columns are written partition by partition."""
    parts = []
    if staged_size is not None and staged_size > broadcast_threshold(wh.spark) and _alike(rows, rows.schema, partition_by, on):
        parts = _parts(rows, staged_size, partition_by)
    ready = _by_part(rows, partition_by, parts, on, rows) if parts else rows
    return wh.publish(ready, name, partition_by, merge_schema=True, batch_id=batch_id, rebalance=not parts)


def _blank_as_null(source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Partition columns read a blank text back as NULL, so a source must say NULL too."""
    blanks = {
        c: F.nullif(F.col(c), F.lit(""))
        for c in partition_by
        if c in source.columns and isinstance(source.schema[c].dataType, T.StringType)
    }
    return source.withColumns(blanks) if blanks else source


def _folders_of(wh: Warehouse, name: str, src: DataFrame, columns: Sequence[str]) -> list[str] | None:
    """The table's folders whose partition values the source holds; None stands for all.

    The table's own list of folders is joined to the source's distinct values, so the answer
    is never longer than that list, however many values the source has.
    """
    if not columns:
        return None
    layout = wh.schema(name)
    listed = [(f, *(_partition_value(f, c) for c in columns)) for f in wh.record(name)["folders"]]
    if not listed:
        return []
    kinds = ", ".join(["__listed string", *(f"`{c}` string" for c in columns)])
    folders = wh.spark.createDataFrame(listed, kinds).select(
        "__listed", *(F.col(f"`{c}`").cast(layout[c].dataType).alias(c) for c in columns)
    )
    values = members(src.select(*(F.col(c).cast(layout[c].dataType).alias(c) for c in columns)), columns)
    return sorted(r[0] for r in seen_keys(values, folders, columns, ["__listed"]).select("__listed").distinct().collect())


def _partition_value(folder: str, column: str) -> str | None:
    """The text after ``column=`` in a folder's path."""
    found = next(part for part in folder.split("/") if unquote(part).startswith(f"{column}="))
    value = unquote(found)[len(column) + 1 :]
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value


def _hash_of(df: DataFrame, other: DataFrame, on: Sequence[str]) -> Column:
    """A hash of the key that is the same where keys of both frames compare equal."""
    parts = []
    for key in on:
        own, its = df.schema[key].dataType, other.schema[key].dataType
        if own == its:
            parts.append(F.col(f"`{key}`"))
        elif isinstance(own, T.IntegralType) and isinstance(its, T.IntegralType):
            parts.append(F.col(f"`{key}`").cast("long"))
    return F.xxhash64(F.lit(0), *parts)


def _with_hash(df: DataFrame, other: DataFrame, on: Sequence[str], hashes: DataFrame, how: str) -> DataFrame:
    """Rows of ``df`` whose key's hash is among some hashes (``left_semi``) or not (``left_anti``)."""
    return df.withColumn(_HASH, _hash_of(df, other, on)).join(hashes.select(_HASH), _HASH, how).drop(_HASH)


def _shared_hashes(
    stack: ExitStack, src: DataFrame, target: DataFrame, on: Sequence[str]
) -> tuple[DataFrame, int, bool, bool]:
    """Hashes of keys that both sides hold, their number, whether one is on several source rows, and whether a key is hot.

    Hot keys of either side are among the hashes too. Map tasks count a hot key's rows before the shuffle.
    """
    new = src.select(_hash_of(src, target, on).alias(_HASH), F.lit(1).alias(_NEW), F.lit(0).alias(_OLD))
    old = target.select(_hash_of(target, src, on).alias(_HASH), F.lit(0).alias(_NEW), F.lit(1).alias(_OLD))
    counts = new.unionAll(old).groupBy(_HASH).agg(F.sum(_NEW).alias(_NEW), F.sum(_OLD).alias(_OLD))
    both = (F.col(_NEW) > 0) & (F.col(_OLD) > 0)
    hot = (F.col(_NEW) > _HOT) | (F.col(_OLD) > _HOT)
    shared = stack.enter_context(staged(counts.filter(both | hot)))
    n, several, any_hot = shared.agg(F.count(F.lit(1)), F.max(F.col(_NEW) > 1), F.max(hot)).first()
    return shared, n, bool(several), bool(any_hot)


def _upserted(
    rows: DataFrame,
    layout: T.StructType,
    src: DataFrame,
    on: Sequence[str],
    updates: Mapping[str, Column],
    inserts: Mapping[str, Column] | None,
    target_where: Column | None,
    columns: Sequence[str] = (),
    parts: Sequence[_Part] = (),
) -> list[DataFrame]:
    """All ``rows`` of the touched folders, matched ones updated, and the source rows that match none.

    No matched key is on two source rows, so every target row meets at most one. Parts of the partition
    ``columns`` are joined each for itself.
    """
    carried = []
    if target_where is not None:
        kept = rows.filter(~F.coalesce(target_where, F.lit(False)))
        carried.append(_by_part(kept, columns, parts, on, src) if parts else kept)
        rows = rows.filter(target_where)
    names_of_rows = rows.columns
    left, names, given = keyed_by(rows.withColumn(_HASH, _hash_of(rows, src, on)), on)
    right, _, own = keyed_by(src.withColumn(_HASH, _hash_of(src, rows, on)), on)
    others = [c for c in names_of_rows if c not in on]
    left = left.select(*names, *(F.col(f"`{c}`").alias(f"__old_{c}") for c in others), F.lit(True).alias("__held"), _HASH)
    right = right.withColumn("__given", F.lit(True))

    def value(c: str) -> Column:
        kind, kept = layout[c].dataType, F.col(f"`__old_{c}`")
        if c in updates:
            kept = F.when(F.col("__given"), updates[c].cast(kind)).otherwise(kept)
        added = inserts[c].cast(kind) if inserts and c in inserts else F.lit(None)
        return F.when(F.col("__held"), kept).otherwise(added).alias(c)

    both = [
        "__held", "__given", *(own[c] for c in src.columns), *(given[k].alias(f"__old_{k}") for k in on),
        *(f"`__old_{c}`" for c in others),
    ]
    values = [value(c) for c in names_of_rows]

    def met(old: DataFrame, new: DataFrame) -> DataFrame:
        how = "left" if inserts is None else "full"
        return old.join(new, names, how).select(*both).select(*values)

    if not parts:
        return [met(left, right), *carried]
    place, its = [given[c] for c in columns], [own[c] for c in columns]
    return [_together([met(part.of(left, place), part.of(right, its)) for part in parts]), *carried]


def _one_row_per_key(
    src: DataFrame, on: Sequence[str], updates: Mapping[str, Column] | None
) -> DataFrame:
    """Each source key once, with the number of its rows and the values to set."""
    if updates is None:
        return members(src, on)
    values = F.struct(*(v.alias(c) for c, v in updates.items()))
    return src.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"), F.first(values).alias("__set"))


def _rewritten(
    wh: Warehouse,
    name: str,
    touched: set[str],
    by_key: DataFrame,
    on: Sequence[str],
    updates: Mapping[str, Column],
    target_where: Column | None,
) -> list[DataFrame]:
    """All rows of the touched folders, matched ones updated."""
    rows = wh.read(name, folders=touched)
    carried = []
    if target_where is not None:
        carried.append(rows.filter(~F.coalesce(target_where, F.lit(False))))
        rows = rows.filter(target_where)
    held, names = with_null_safe_keys(rows, on)
    new, _ = with_null_safe_keys(by_key, on)
    # Inside every updated column, so no column pruning can drop the check.
    matched = F.when(
        F.col("__n") > 1,
        F.raise_error(F.lit(f"several source rows match one row of {name}")).cast("boolean"),
    ).otherwise(F.col("__n").isNotNull())
    joined = held.join(new.select(*names, "__n", "__set"), names, "left").select(
        *(
            F.when(matched, F.col("__set").getField(c)).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)
            for c in rows.columns
        )
    )
    return [joined, *carried]


def offending_keys(source: DataFrame, target: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that a merge refuses, with the number of their rows: several source rows on a target row."""
    several = source.groupBy(*on).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    return seen_keys(target, several, on, ["n_rows"])


def insert_absent(
    wh: Warehouse,
    name: str,
    source: DataFrame,
    on: Sequence[str],
    batch_id: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> int:
    """Insert the source rows whose key is absent; stored rows are never rewritten."""
    return merge(wh, name, source, on, update=None, batch_id=batch_id, properties=properties)
