"""Exact medians by selection (A7) against sorted lists."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from binscope.operators import profile as A


def columns(seed):
    r = random.Random(seed)
    n = 3001 + seed % 2
    return {
        "even_odd": [float(r.randrange(10**9)) for _ in range(n)],
        "ties": [float(r.choice([1, 2, 2, 2, 3])) for _ in range(n)],
        "binary": [float(i % 2) for i in range(n)],
        "nulls": [r.gauss(0, 1) if r.random() < 0.3 else None for _ in range(n)],
        "none": [None] * n,
        "one": [5.0] + [None] * (n - 1),
        "two": [5.0, -1.0] + [None] * (n - 2),
        "hot": [7.0 if r.random() < 0.6 else r.random() * 10 for _ in range(n)],
        "edge": [0.0] * (n // 2) + [r.random() for _ in range(n - n // 2)],
    }


@pytest.mark.parametrize("seed, sketch, gather", [(1, 10_000, 20_000), (2, 50, 5), (3, 20, 40), (4, 100, 0)])
def test_medians_and_modes(spark, monkeypatch, seed, sketch, gather):
    monkeypatch.setattr(A, "SKETCH", sketch)
    monkeypatch.setattr(A, "GATHER", max(gather, 1))
    cols = columns(seed)
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"`{n}` double" for n in cols)).repartition(5)
    got = {r.variable: (r.median, r.mode) for r in A.exact_median_and_mode(df, list(cols)).collect()}
    for n, values in cols.items():
        known = [v for v in values if v is not None]
        want = statistics.median(known) if known else None
        mode = min(known, key=lambda v: (-known.count(v), v)) if known and len(set(known)) < 50 else None
        assert got[n][0] == want, n
        assert mode is None or got[n][1] == mode, n


def test_no_cell_is_unpivoted(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "`a.b` double, c double")
    found = A.table1_continuous(df)
    assert {r.variable: r.median for r in found.collect()} == {"a.b": 2.0, "c": 2.0}
    assert A.exact_median_and_mode(df.filter("c > 100"), ["c"]).collect()[0].median is None
    assert "Generate" not in A.modes(df.select(F.col("c")), ["c"])._jdf.queryExecution().toString()


def test_density_curve(spark):
    import math
    xs = [0.0, 1.0, 1.0, 2.5, 7.0, None]
    df = spark.createDataFrame([(v,) for v in xs], "v double").repartition(3)
    got = A.kde_curve(df, "v", 30).orderBy("point").collect()
    known = [v for v in xs if v is not None]
    h = statistics.stdev(known) * len(known) ** -0.2
    grid = [-3 * h + i * (7 + 6 * h) / 29 for i in range(30)]
    for r, g in zip(got, grid):
        want = sum(math.exp(-((g - v) / h) ** 2 / 2) for v in known) / (len(known) * h * math.sqrt(2 * math.pi))
        assert math.isclose(r.x, g, abs_tol=1e-9) and math.isclose(r.density, want, rel_tol=1e-9)
    assert A.kde_curve(df.filter("v > 100"), "v").count() == 0
    flat = A.kde_curve(df.filter("v = 1"), "v", 3).collect()
    assert [(r.x, r.density) for r in flat] == [(1.0, None)] * 3
    assert A.kde_curve(df.filter("v = 7"), "v", 3).collect()[0].x is None
