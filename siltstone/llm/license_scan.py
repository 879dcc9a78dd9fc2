"""Licence mentions in whole texts, by ordered signature rules; expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import let, whole_text
from siltstone.llm.license_rules import BASE_PHRASES, Rule, rules

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_HIT = "struct<start:int,stop:int,label:string,priority:int,confidence:double,rule:int>"


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _places(text: Column, pattern: Column) -> Column:
    """Word positions [start, stop) of all matches in ``text``, whose every word follows a blank.

    What lies before a match, and hence the number of blanks there, follows from the
    pieces that the same pattern cuts the text into.
    """
    both = F.struct(
        F.transform(F.split(text, pattern, -1), _spaces).alias("between"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), _spaces).alias("match"),
    )

    def run(cut: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.get(cut["between"], i)
            stop = start + F.get(cut["match"], i)
            return F.struct(
                stop.alias("at"),
                F.concat(
                    state["found"], F.array(F.struct(start.alias("start"), stop.alias("stop")))
                ).alias("found"),
            )

        nothing = F.struct(
            F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("found")
        )
        return F.when(
            F.size(cut["match"]) > 0,
            F.aggregate(
                F.sequence(F.lit(0), F.size(cut["match"]) - 1), nothing, step, lambda s: s["found"]
            ),
        ).otherwise(F.array().cast("array<struct<start:int,stop:int>>"))

    return let(both, run)


def _bounded(pattern: str) -> str:
    return f" (?:{pattern})(?= )"


def _tried(text: Column, signatures: Sequence[Rule]) -> Column:
    """The rules whose keyword occurs in ``text``; a keyword is looked for once for all its rules."""
    by_keyword: dict[str, list[Column]] = {}
    for i, r in enumerate(signatures):
        by_keyword.setdefault(r.keyword, []).append(
            F.struct(
                F.lit(i).alias("rule"),
                F.lit(r.label).alias("label"),
                F.lit(_bounded(r.pattern)).alias("pattern"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.confidence).alias("confidence"),
            )
        )
    groups = F.array(
        *(
            F.struct(F.lit(keyword).alias("keyword"), F.array(*own).alias("rules"))
            for keyword, own in by_keyword.items()
        )
    )
    met = F.filter(groups, lambda g: F.contains(text, g["keyword"]))
    return F.flatten(F.transform(met, lambda g: g["rules"]))


def _suppressed(hits: Column) -> Column:
    """Labels, number and best confidence of the hits that stay.

    Hits are met by start, the longer and then the more important first. One that lies inside
    a hit that stayed, of at least its priority, goes. Only hits that reach past
    the current start are remembered, so a step's work does not grow with the text.
    """
    ordered = F.sort_array(
        F.transform(
            hits,
            lambda h: F.struct(
                h["start"], (-h["stop"]).alias("back"), (-h["priority"]).alias("minor"), h["rule"],
                h["label"], h["confidence"],
            ),
        )
    )
    nothing = F.struct(
        F.array().cast("array<struct<back:int,minor:int>>").alias("open"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0).cast("long").alias("n"),
        F.lit(0.0).alias("best"),
    )

    def step(state: Column, h: Column) -> Column:
        inside = F.exists(
            state["open"], lambda o: (o["back"] <= h["back"]) & (o["minor"] <= h["minor"])
        )
        reaching = F.filter(state["open"], lambda o: -o["back"] > h["start"])
        return F.when(inside, state).otherwise(
            F.struct(
                F.concat(reaching, F.array(F.struct(h["back"], h["minor"]))).alias("open"),
                F.array_union(state["labels"], F.array(h["label"])).alias("labels"),
                (state["n"] + 1).alias("n"),
                F.greatest(state["best"], h["confidence"]).alias("best"),
            )
        )

    return F.aggregate(ordered, nothing, step)


def scan_licenses(docs: DataFrame, signatures: Sequence[Rule] | None = None) -> DataFrame:
    """Licence findings of every row: doc_id, n_words, base places and labels, kept hits, score.

    Texts are lower-cased and cut into words at ASCII characters that are neither letters
    nor digits. (``lower`` also changes letters beyond ASCII; they stay word characters
    and turn into no letter of a rule other than k, which only the Kelvin sign gives.)
    Base phrases are counted wherever their words stand in a row. The rules come on top: one is tried
    where its keyword occurs; a hit inside a hit of the same or a higher priority is dropped. ``score`` is
    the highest confidence of the hits that stay, 0 without any. NULL and empty
    texts have no words, no places (NULL first and last word), empty labels and score 0. Rows that repeat
    are returned as often as they come; no rows give no rows; other columns are not read.

    One pass without a shuffle: each row is scanned where it is read.
    """
    signatures = rules() if signatures is None else signatures
    words = F.trim(F.regexp_replace(F.lower(whole_text(docs)), _NOT_WORD, " "))
    padded = F.concat(F.lit(" "), words, F.lit(" "))
    needed = sorted({r.gate for r in signatures} | set(BASE_PHRASES))
    # A string that holds another one need not be looked for in every text.
    gates = [k for k in needed if not any(o != k and o in k for o in needed)]
    gate = F.lit(False)
    for keyword in gates:
        gate = gate | F.contains("padded", F.lit(keyword))
    rows = docs.select(docs["doc_id"], padded.alias("padded")).select(
        "doc_id",
        "padded",
        gate.alias("gated"),
        F.when(F.col("padded") == "  ", 0).otherwise(_spaces(F.col("padded")) - 1).cast("long").alias("n_words"),
    )
    text = F.col("padded")
    base = [
        F.when(
            F.contains(text, F.lit(phrase)), _places(text, F.lit(_bounded(phrase)))
        ).otherwise(F.array().cast("array<struct<start:int,stop:int>>")).alias(label)
        for phrase, label in BASE_PHRASES.items()
    ]
    hits = F.flatten(
        F.transform(
            _tried(text, signatures),
            lambda r: F.transform(
                _places(text, r["pattern"]),
                lambda p: F.struct(
                    p["start"], p["stop"], r["label"], r["priority"], r["confidence"], r["rule"]
                ),
            ),
        )
    ).cast(f"array<{_HIT}>")
    found = F.struct(F.struct(*base).alias("base"), _suppressed(hits).alias("kept"))
    labels = list(BASE_PHRASES.values())
    starts = F.flatten(
        F.array(*(F.transform(F.col(f"found.base.{b}"), lambda p: p["start"]) for b in labels))
    )
    base_labels = F.filter(
        F.array(*(F.when(F.size(f"found.base.{b}") > 0, F.lit(b)) for b in sorted(labels))),
        lambda b: b.isNotNull(),
    )
    no_words = F.array().cast("array<string>")
    return (
        rows.withColumn("found", F.when(F.col("gated"), found))
        .withColumn("starts", F.coalesce(starts, F.array().cast("array<int>")))
        .withColumn("base_found", F.when(F.col("gated"), base_labels).otherwise(no_words))
        .select(
            "doc_id",
            "n_words",
            F.size("starts").cast("long").alias("n_base"),
            F.array_min("starts").cast("long").alias("first_word"),
            F.array_max("starts").cast("long").alias("last_word"),
            F.array_join("base_found", ",").alias("base_labels"),
            F.array_join(
                F.sort_array(
                    F.array_union("base_found", F.coalesce("found.kept.labels", no_words))
                ),
                ",",
            ).alias("labels"),
            F.coalesce("found.kept.n", F.lit(0)).alias("n_hits"),
            F.coalesce("found.kept.best", F.lit(0.0)).alias("score"),
        )
    )
