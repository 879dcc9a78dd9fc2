"""Where the small tables lie, made-up texts, and fixtures that the tests here import."""

from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
#: The columns of documents and some whose names the operators use inside.
ODD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, "
    "band int, vertex string, chunk string, digest int, row int, rule string, n long, leaks string"
)


def prose(rng: random.Random, n: int) -> str:
    return " ".join(
        "".join(rng.choice("aeiouklmnst") for _ in range(rng.randint(1, 7))) for _ in range(n)
    )


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty and blank texts, a long text, repeated rows, ties and near copies."""
    rng = random.Random(5)
    base = prose(rng, 150)
    near = base.replace(base.split()[70], "changed", 1)
    odd = [
        (1, base, "en", "a"),
        (1, base, "en", "a"),  # a repeated row
        (2, base, "de", "b"),  # an exact copy
        (3, near, "en", "a"),
        (4, None, None, None),
        (5, "", "en", None),
        (6, " \n\t \n", None, "a"),
        (7, prose(rng, 20_000), "fr", "b"),  # long
        (8, "One", "en", "a"),
        (8, "two rows of one id", "en", "a"),
        (None, "no id at all, " + prose(rng, 60), "en", "a"),
        (None, None, "en", "a"),
        (9, "x<|endoftext|>y  two  blanks ▁ mark 中文 \U0001f600 \x00\x1c end ", "zz", "c"),
        (10, "All rights reserved. CC-BY 4.0, GNU General Public License version 2 or later", "en", "a"),
        (11, "same line\nsame line\n\nsame line\n" + "word " * 80, "en", "a"),
        (12, base[:300] + " " + prose(rng, 90) + " " + base[300:], "en", "a"),
        (-5, "ab " * 200, "en", "a"),
    ]
    odd += [(100 + i, prose(rng, 80), "en", "a") for i in range(12)]
    return odd


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    rows = [(i, t, la, s, None, 0.5, "k", 1, "v", "c", 7, 3, "r", 1, None) for i, t, la, s in odd_rows]
    return spark.createDataFrame(rows, ODD_SCHEMA).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
