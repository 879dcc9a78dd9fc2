"""Quality rules with thresholds that follow each language and source; expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import kept, let, whole_text

_SPACE = r"[\x20\x09-\x0D]"


@dataclass(frozen=True)
class Fence:
    """How far a feature may go in a group: ``reach`` times the distance of two of its quantiles beyond the upper one.

    Quantiles are given in per mille of the rows. A fence is never above ``cap``; ``two_sided`` features have a
    fence as far below the lower quantile as well.
    """

    lower: int
    upper: int
    reach: int
    cap: int | None = None
    two_sided: bool = False


#: Features that are judged, in per mille except for the word length (a tenth of a character). What most rows
#: of a group lack, such as symbols, is odd where a fifth of the rows or fewer have it; repetitions are common in
#: small doses, so only the last hundredth of a group goes. At most half of a text may be of such kinds.
FEATURES = {
    "symbol_rate": Fence(500, 800, 3, cap=500),
    "dup_line_rate": Fence(500, 990, 0, cap=500),
    "repeat_rate": Fence(500, 990, 0, cap=500),
    "word_length": Fence(250, 750, 3, two_sided=True),
}
#: Values below this are kept exactly in a sketch; above it a bucket is 1/16 of a power of two wide.
_EXACT_BITS = 5


def _measures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, source and the counts that the rules look at."""
    rows = docs.select(
        docs["doc_id"],
        docs["lang"].cast("string").alias("lang"),
        docs["source"].cast("string").alias("source"),
        whole_text(docs).alias("text"),
    )
    text = F.col("text")
    # Blanks at the ends leave an empty piece there; cutting them off first takes time by the square of a long run.
    words = F.array_remove(F.split(text, f"{_SPACE}+"), "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def repeated(w: Column) -> Column:
        """Words inside three-word windows that the text holds more than once."""
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(windows, covered))

    def covered(h: Column) -> Column:
        # Windows in hash order stand next to their repetitions; the places of those that have any,
        # in text order, cover three words each, less what the next place covers too.
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(
            by_hash,
            lambda s: F.filter(
                s,
                lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]),
            ),
        )
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        spans = let(
            places,
            lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
                F.lit(0),
                lambda total, x: total + x,
            ),
        )
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(spans)

    counted = let(
        words,
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            repeated(w).alias("n_repeat_words"),
        ),
    )
    line_counts = let(
        lines,
        lambda x: F.struct(
            F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")
        ),
    )
    return rows.select(
        "doc_id",
        "lang",
        "source",
        counted.alias("counted"),
        (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).alias("n_symbols"),
        line_counts.alias("line_counts"),
    ).select(
        "doc_id",
        "lang",
        "source",
        *(
            F.col(c).cast("long").alias(c.rsplit(".", 1)[-1])
            for c in (
                "counted.n_words",
                "counted.word_chars",
                "n_symbols",
                "line_counts.n_lines",
                "line_counts.n_dup_lines",
                "counted.n_repeat_words",
            )
        ),
    )


def _rate(part: str, whole: str, scale: int) -> Column:
    return F.when(F.col(whole) > 0, F.floor(F.col(part) * scale / F.col(whole))).otherwise(0).cast("long")


def _bucket_floor(value: Column) -> Column:
    """The least value of the sketch bucket that holds ``value``: its first five bits."""
    bits = F.greatest(F.length(F.bin(value)) - _EXACT_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, bits), bits)


def sketches(features: DataFrame, by: list[str]) -> DataFrame:
    """Quantile sketches: how many rows of each group fall into each bucket of each feature.

    Buckets are fixed, so sketches merge by adding counts, exactly and in any order, and a
    quantile read from one is at most a sixteenth below the true value.
    """
    long = features.select(
        *by,
        F.explode(
            F.array(
                *(F.struct(F.lit(f).alias("feature"), _bucket_floor(F.col(f)).alias("bucket")) for f in FEATURES)
            )
        ).alias("f"),
    )
    return long.groupBy(*by, "f.feature", "f.bucket").agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, by: list[str], features: dict[str, Fence]) -> DataFrame:
    """One row per group and feature: its size and its two quantiles, ``low`` and ``high`` (bucket floors)."""
    group = Window.partitionBy(*by, "feature")
    running = group.orderBy("bucket")
    ranked = sketch.withColumn("below", F.sum("n").over(running)).withColumn("size", F.sum("n").over(group))

    def least(part: str) -> Column:
        share = F.coalesce(*(F.when(F.col("feature") == f, F.lit(getattr(x, part))) for f, x in features.items()))
        return F.min(F.when(1000 * F.col("below") >= share * F.col("size"), F.col("bucket")))

    return ranked.groupBy(*by, "feature").agg(
        F.max("size").alias("size"), least("lower").alias("low"), least("upper").alias("high")
    )


def judge(docs: DataFrame, min_group: int = 200, features: dict[str, Fence] = FEATURES) -> DataFrame:
    """Counts and verdict of every row of ``docs`` (doc_id, text, lang, source).

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated three-word windows.
    ``kept``: not so, and no feature lies beyond the fence of its language and source, which the group's own
    quantiles set as ``features`` tell; values are compared by their sketch buckets, so a value as
    far as the fence stays. Rows that fail the base rule
    do not enter the sketches. Groups with fewer than ``min_group`` rows use the sketch of their language,
    and languages with fewer that of all rows: the same sketches, merged.

    NULL texts have no words and fail; NULL languages and sources are groups of their own; rows that
    repeat are judged each; no rows give no rows; other columns are not read.

    Texts are read once and not shuffled; their counts are written, and the thresholds, one
    row per group, come back in a join that Spark can split at a source with many rows.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = (
        _measures(docs)
        .withColumn("base_failed", failed)
        .withColumn("symbol_rate", _rate("n_symbols", "word_chars", 1000))
        .withColumn("dup_line_rate", _rate("n_dup_lines", "n_lines", 1000))
        .withColumn("repeat_rate", _rate("n_repeat_words", "n_words", 1000))
        .withColumn("word_length", _rate("word_chars", "n_words", 10))
        # Joins do not match NULLs, and groups do.
        .withColumn("group_lang", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")))
        .withColumn("group_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    )
    rows = kept(measured, "quality")
    own = kept(sketches(rows.filter(~F.col("base_failed")), ["group_lang", "group_source"]), "quality-sketch")
    by_lang = own.groupBy("group_lang", "feature", "bucket").agg(F.sum("n").alias("n"))
    overall = own.groupBy("feature", "bucket").agg(F.sum("n").alias("n"))
    levels = [
        quantiles(own, ["group_lang", "group_source"], features),
        quantiles(by_lang, ["group_lang"], features),
        quantiles(overall, [], features),
    ]
    names = [F.struct("size", "low", "high").alias(f"level{i}") for i in range(3)]
    merged = (
        levels[0].select("group_lang", "group_source", "feature", names[0])
        .join(levels[1].select("group_lang", "feature", names[1]), ["group_lang", "feature"])
        .join(levels[2].select("feature", names[2]), "feature")
    )
    chosen = (
        F.when(F.col("level0.size") >= min_group, F.col("level0"))
        .when(F.col("level1.size") >= min_group, F.col("level1"))
        .otherwise(F.col("level2"))
    )

    def setting(part: str) -> Column:
        return F.coalesce(*(F.when(F.col("feature") == f, F.lit(getattr(x, part))) for f, x in features.items()))

    margin = setting("reach") * (F.col("q.high") - F.col("q.low"))
    fences = merged.select("group_lang", "group_source", "feature", chosen.alias("q")).select(
        "group_lang",
        "group_source",
        "feature",
        F.least(F.col("q.high") + margin, setting("cap")).alias("most"),  # no cap is a NULL, which least skips
        (F.col("q.low") - margin).alias("least"),
    )
    pick = lambda feature, fence: F.max(F.when(F.col("feature") == feature, F.col(fence))).alias(
        f"{fence}_{feature}"
    )
    per_group = kept(
        fences.groupBy("group_lang", "group_source").agg(
            *(pick(f, "most") for f in features), *(pick(f, "least") for f, x in features.items() if x.two_sided)
        ),
        "quality-fences",
    )
    beyond = F.lit(False)
    for feature, fence in features.items():
        value = _bucket_floor(F.col(feature))
        beyond = beyond | (value > F.col(f"most_{feature}"))
        if fence.two_sided:
            beyond = beyond | (value < F.col(f"least_{feature}"))
    return rows.join(per_group, ["group_lang", "group_source"], "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.coalesce(beyond, F.lit(False))).alias("kept"),
        *features,
    )
