"""Awkward rows that every operator must take: nulls, empty and very long texts, repeated rows, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

CLASH = ("n_words", "score", "spans", "node", "block", "key", "bands", "label", "items")


def awkward_rows(seed: int = 7) -> list[tuple[int | None, str | None]]:
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéñß") for _ in range(r.randint(1, 7))) for _ in range(60)]

    def prose(n: int) -> str:
        return " ".join(r.choice(vocabulary) + r.choice(["", "", ".", ",", ".\n"]) for _ in range(n))

    copy = prose(120)
    near = copy.split(" ")
    near[40] = "other"
    return [
        (0, None), (1, ""), (2, " \n\t "), (3, "a"), (4, "x y z"), (5, copy), (6, copy), (6, copy), (7, " ".join(near)),
        (8, prose(20_000)), (None, prose(80)), (None, None), (9, "For " * 500), (10, "日本語 😀 ▁ \x00 ok"),
        (11, "password = hunter2hunter2 and " + prose(60)), (12, "== | # $ % " * 40), (13, prose(200)), (13, prose(90)),
        (14, copy[:300] + prose(30) + copy[:300])]


def awkward(spark: SparkSession, seed: int = 7) -> DataFrame:
    rows = [(i, t, "en", *([1] * len(CLASH))) for i, t in awkward_rows(seed)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"{c} int" for c in CLASH)).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def by_row(rows) -> list[tuple]:
    """Rows in an order that nulls do not break."""
    return sorted((tuple(r) for r in rows), key=repr)
