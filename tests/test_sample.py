"""Splits, resampling and bootstrap (G1-G6) invariants."""

from pyspark.sql import functions as F

from binscope.operators import sample as G
from binscope.operators.running import global_row_number


def test_global_row_number_contiguous(spark, monkeypatch):
    from binscope.operators import running
    monkeypatch.setattr(running, "ROWS_PER_BUCKET", 100)   # several percentile buckets
    h = F.md5(F.col("id").cast("string"))
    df = spark.range(0, 5000).select(
        "id", F.conv(F.substring(h, 1, 15), 16, 10).cast("long").alias("o"), h.alias("h"))
    got = global_row_number(df.repartition(7), ["o", "h"], "rn").collect()
    assert sorted(r.rn for r in got) == list(range(5000))
    by_rank = [r.h for r in sorted(got, key=lambda r: r.rn)]
    assert by_rank == sorted(by_rank)                      # rank follows the digest order


def test_stratified_split_exact_shares(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("s"))
    out = G.stratified_split(df, "k", ["s"])
    counts = {(r.s, r.split): r["count"] for r in out.groupBy("s", "split").count().collect()}
    for s in (0, 1, 2):
        m = sum(v for (ss, _), v in counts.items() if ss == s)
        assert counts[(s, "train")] == (6 * m) // 10
        assert counts[(s, "train")] + counts[(s, "valid")] == (8 * m) // 10
    assert out.select("k").distinct().count() == 1000


def test_kfold_balanced(spark):
    df = spark.range(0, 100).select(F.col("id").alias("k"), F.lit(1).alias("s"))
    folds = [r["count"] for r in G.kfold_assign(df, "k", ["s"], k=5).groupBy("fold").count().collect()]
    assert sorted(folds) == [20] * 5


def test_undersample_and_weights(spark):
    df = spark.range(0, 100).select(F.col("id").alias("k"),
                                    (F.col("id") < 20).cast("int").alias("y"))
    u = G.random_undersample(df, "k", "y")
    assert {r.y: r["count"] for r in u.groupBy("y").count().collect()} == {0: 20, 1: 20}
    w = {r.y: r.weight for r in G.balanced_class_weights(df, "y").select("y", "weight").distinct().collect()}
    assert abs(w[1] - 100 / (2 * 20)) < 1e-12 and abs(w[0] - 100 / (2 * 80)) < 1e-12


def test_bootstrap_sizes_and_membership(spark):
    df = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("g"))
    b = G.bootstrap_sample(df, "k", ["g"], num_bootstraps=4, size=90)
    per = {(r.bootstrap, r.g): r["count"] for r in b.groupBy("bootstrap", "g").count().collect()}
    assert all(v == 30 for v in per.values()) and len(per) == 12
    assert b.join(df, ["k", "g"], "left_anti").count() == 0


def _brute_bootstrap(rows, size, balanced, boots):
    """rows: (k, m, g); size per m. Draws by the definition, on sorted lists."""
    from hashlib import md5
    groups: dict = {}
    for k, m, g in rows:
        groups.setdefault((m, g), []).append(k)
    out = []
    for (m, g), ks in groups.items():
        ks.sort(key=lambda k: (md5(f"{k}:boot".encode()).hexdigest(), k))
        mine = [v for (mm, _), v in groups.items() if mm == m]
        n = size // len(mine) if balanced else size * len(ks) // sum(map(len, mine))
        for b, seed in enumerate(G.bootstrap_seeds(boots)):
            for j in range(1, n + 1):
                x = ":".join([str(seed), m or "", g or "", str(j)])
                u = int(md5(x.encode()).hexdigest()[:8], 16) / 4294967296.0
                out.append((ks[int(u * len(ks))], m, g, b, j))
    return sorted(out, key=repr)


def test_bootstrap_equals_the_definition_with_narrow_windows(spark, monkeypatch):
    rows = [(i, "ab"[i % 2], None if i % 7 == 0 else "x" if i % 5 else "y") for i in range(9000)]
    df = spark.createDataFrame(rows, "k long, m string, g string")
    monkeypatch.setattr(G, "SELECT_BITS", 1)   # thousands of rows a bucket, so windows are parts of it
    for balanced in (False, True):
        got = G.bootstrap_sample(df, "k", ["m", "g"], 3, 40, balanced=balanced, within=["m"])
        assert sorted(map(tuple, got.select("k", "m", "g", "bootstrap", "draw").collect()), key=repr) == _brute_bootstrap(rows, 40, balanced, 3)
    monkeypatch.setattr(G, "WINDOW", -0.9)   # windows that miss: the row count tells, whole buckets follow
    got = G.bootstrap_sample(df, "k", ["m", "g"], 3, 40, within=["m"])
    assert sorted(map(tuple, got.select("k", "m", "g", "bootstrap", "draw").collect()), key=repr) == _brute_bootstrap(rows, 40, False, 3)


def test_poisson_weights_mean_near_one(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("k"))
    w = G.bootstrap_weights(df, "k", 2).agg(F.avg("weight")).collect()[0][0]
    assert abs(w - 1.0) < 0.05


def test_skewed_stratum_ranks_are_exact(spark):
    # one stratum holds 90 % of the rows; ranks must still be 1..m in md5 order
    df = spark.range(0, 20000).select(F.col("id").alias("k"),
                                      F.when(F.col("id") % 10 == 0, "small").otherwise("big").alias("s"))
    ranked, sizes = G.rank_within(df, ["s"], "k", 222)
    got = ranked.select("k", "s", "_r", "_m").toPandas()
    import hashlib
    for s, grp in got.groupby("s"):
        order = sorted(grp.k, key=lambda k: (hashlib.md5(f"{k}:222".encode()).hexdigest(), k))
        expect = {k: i + 1 for i, k in enumerate(order)}
        assert all(expect[k] == r for k, r in zip(grp.k, grp._r)), s
        assert set(grp._m) == {len(grp)}
    assert {r.s: r._m for r in sizes.collect()} == {"small": 2000, "big": 18000}


def test_split_shares_exact_under_skew(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("k"),
                                      (F.col("id") % 10 == 0).cast("int").alias("y"))
    out = G.stratified_split(df, "k", ["y"])
    c = {(r.y, r.split): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert (c[(0, "train")], c[(0, "valid")], c[(0, "test")]) == (10800, 3600, 3600)
    assert (c[(1, "train")], c[(1, "valid")], c[(1, "test")]) == (1200, 400, 400)
