"""Splits, resampling and weights.

Randomness is md5 of text, so Spark and DuckDB draw the same rows and a rerun
after an executor loss draws them again. Ranks inside a stratum come from
``running.rank_by_hash``: rows are ordered by an md5 digest, whose top bits cut
every stratum into 4,096 equal buckets without a statistics job, so a stratum
that holds a third of all rows is still spread over many tasks. The bootstrap selects single ranks of that
order without ranking all rows. Draw tables are generated in Spark from the per-group counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from binscope.functions.exprs import c, md5_order_cols
from binscope.operators.running import HASH_BITS, null_safe_join, rank_by_hash
from binscope.session import cut_lineage


def rank_within(df: DataFrame, strata: list[str], key: str, seed: int | str,
                out: str = "_r", size: str = "_m") -> tuple[DataFrame, DataFrame]:
    """1-based rank inside each stratum in ``md5(key:seed)`` order (then key)
    and the stratum size, plus the stratum-size table (see ``rank_by_hash``)."""
    cols = md5_order_cols(c(key), seed)
    d = df.select("*", *[x.alias(f"_o{i}") for i, x in enumerate(cols)])
    ranked, sizes = rank_by_hash(d, strata, "_o0", ["_o1", "_o2"], out, size)
    return ranked.drop("_o0", "_o1", "_o2"), sizes


def stratified_split(df: DataFrame, key: str, strata: list[str], seed: int = 222,
                     tenths: tuple[int, int] = (6, 8), out: str = "split") -> DataFrame:
    """G1: train / valid / test, exact shares inside every stratum. Rows are
    ordered by ``md5(key:seed)``; rank ``r`` of ``m``: train if
    ``r <= floor(6m/10)``, valid if ``r <= floor(8m/10)``, else test."""
    r, _ = rank_within(df, strata, key, seed)
    a, b = tenths
    split = (F.when(F.col("_r") <= F.floor(F.col("_m") * a / 10), "train")
             .when(F.col("_r") <= F.floor(F.col("_m") * b / 10), "valid").otherwise("test"))
    return r.withColumn(out, split).drop("_r", "_m")


def kfold_assign(df: DataFrame, key: str, strata: list[str], k: int = 5, seed: int = 222,
                 out: str = "fold") -> DataFrame:
    """Stratified fold number ``(r - 1) mod k`` over the md5 order, usable as
    ``CrossValidator(foldCol=...)``."""
    r, _ = rank_within(df, strata, key, seed)
    return r.withColumn(out, F.pmod(F.col("_r") - 1, F.lit(k)).cast("int")).drop("_r", "_m")


def random_undersample(df: DataFrame, key: str, label: str, seed: int = 222) -> DataFrame:
    """Every class cut to the size of the smallest, without replacement
    (first rows of the md5 order inside each class)."""
    r, _ = rank_within(df, [label], key, seed)
    smallest = df.groupBy(c(label)).count().agg(F.min("count")).first()[0] or 0  # one number
    return r.where(F.col("_r") <= smallest).drop("_r", "_m")


def balanced_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """``n / (classes * n_class)``; class counts are one row per class."""
    counts = df.groupBy(c(label).alias(label)).agg(F.count(F.lit(1)).alias("_nc"))
    every = Window.partitionBy()  # over the counts
    w = counts.select(label, (F.sum("_nc").over(every) / (F.count(F.lit(1)).over(every) * F.col("_nc"))).alias(out))
    return null_safe_join(df, w, [label])


BOOT_ORDER_SEED = "boot"  # rows of a group are indexed in md5(key:boot) order


def bootstrap_seeds(num_bootstraps: int = 10, lo: float = 200, hi: float = 300) -> list[int]:
    """One integer seed per bootstrap, evenly spaced (numpy linspace, truncated)."""
    if num_bootstraps == 1:
        return [int(lo)]
    step = (hi - lo) / (num_bootstraps - 1)
    return [int(lo + i * step) if i < num_bootstraps - 1 else int(hi) for i in range(num_bootstraps)]


SELECT_BITS = 12  # buckets of a group by the first bits of its rows' digests
WINDOW = 8.0  # half width of a target's digest window, in standard deviations of its place


def bootstrap_draws(sizes: DataFrame, groups: list[str], seeds: list[int], size: int, balanced: bool, within: list[str]) -> DataFrame:
    """(groups, bootstrap, draw, _idx): the rows that are drawn, by their place in the group.

    ``sizes`` has ``_ng`` rows of each group. Among the groups that share ``within``, ``size`` draws a
    bootstrap are dealt out by share, or evenly if ``balanced``."""
    share = Window.partitionBy(*[c(n) for n in within])
    m = (F.floor(F.lit(size) / F.count(F.lit(1)).over(share)) if balanced
         else F.floor(F.lit(size) * F.col("_ng") / F.sum("_ng").over(share)))
    boots = F.explode(F.array(*[F.struct(F.lit(b).alias("bootstrap"), F.lit(s).alias("seed")) for b, s in enumerate(seeds)]))
    dealt = sizes.select(*groups, "_ng", m.cast("long").alias("_mg")).where("_mg >= 1").select("*", boots.alias("_b"))
    draws = dealt.select(*groups, "_ng", F.col("_b.bootstrap").alias("bootstrap"), F.col("_b.seed").alias("_seed"),
                         F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mg"))).alias("draw"))
    hx = F.concat_ws(":", F.col("_seed").cast("string"),
                     *[F.coalesce(c(g).cast("string"), F.lit("")) for g in groups], F.col("draw").cast("string"))
    u = F.conv(F.substring(F.md5(hx), 1, 8), 16, 10).cast("bigint").cast("double") / 4294967296.0
    return draws.select(*groups, "bootstrap", "draw", (F.lit(1) + F.floor(u * F.col("_ng"))).cast("long").alias("_idx"))


def _targets(counts: DataFrame, draws: DataFrame, groups: list[str]) -> DataFrame:
    """Draws with the bucket that holds their row, its size and the row's rank in it: each draw takes the last
    bucket that begins at or before it. A group has 2^SELECT_BITS buckets and its draws here, no rows."""
    grp = [c(g) for g in groups]
    before = Window.partitionBy(*grp).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begin = counts.select(*groups, (F.coalesce(F.sum("_c").over(before), F.lit(0)) + 1).alias("_idx"), F.lit(0).alias("_kind"),
                          F.lit(None).cast("int").alias("bootstrap"), F.lit(None).cast("long").alias("draw"), "_bucket", "_c")
    asked = draws.select(*groups, "_idx", F.lit(1).alias("_kind"), "bootstrap", "draw", F.lit(None).cast("long").alias("_bucket"), F.lit(None).cast("long").alias("_c"))
    upto = Window.partitionBy(*grp).orderBy("_idx", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    at = F.last(F.when(F.col("_kind") == 0, F.struct("_bucket", "_c", "_idx")), ignorenulls=True).over(upto)
    found = begin.union(asked).select(*groups, "_idx", "_kind", "bootstrap", "draw", at.alias("_at")).where("_kind = 1")
    return found.select(*groups, "bootstrap", "draw", F.col("_at._bucket").alias("_bucket"), F.col("_at._c").alias("_c"),
                        (F.col("_idx") - F.col("_at._idx") + 1).alias("_rank"))


def _windows(targets: DataFrame, groups: list[str], spread: float | None) -> DataFrame:
    """(groups, _bucket, _windows): the disjoint digest ranges in which a bucket's targets lie (all of it without
    ``spread``). Digests are uniform: the r-th of m is about r/m into the bucket, give or take sqrt(m)/m."""
    span = 2.0 ** (HASH_BITS - SELECT_BITS)
    base = F.shiftleft(F.col("_bucket"), HASH_BITS - SELECT_BITS)
    half = F.lit(span) if spread is None else (spread * F.sqrt("_c") + 16) / F.col("_c") * span
    middle = F.col("_rank") / F.col("_c") * span
    lo = base + F.greatest(middle - half, F.lit(0.0)).cast("long")
    hi = base + F.least(middle + half, F.lit(span)).cast("long")
    own = [*[c(g) for g in groups], F.col("_bucket")]
    ranges = targets.select(*groups, "_bucket", lo.alias("_lo"), hi.alias("_hi")).distinct()
    earlier = Window.partitionBy(*own).orderBy("_lo", "_hi").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*own).orderBy("_lo", "_hi").rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.when(F.col("_lo") <= F.max("_hi").over(earlier), 0).otherwise(1)
    islands = ranges.withColumn("_new", fresh).withColumn("_island", F.sum("_new").over(upto))
    merged = islands.groupBy(*own, "_island").agg(F.min("_lo").alias("lo"), F.max("_hi").alias("hi"))
    return merged.groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("_windows"))


def bootstrap_sample(df: DataFrame, key: str, groups: list[str], num_bootstraps: int = 10,
                     size: int = 2000, seeds: list[int] | None = None, balanced: bool = False,
                     within: list[str] | None = None) -> DataFrame:
    """Draws with replacement, ``bootstrap`` (0-based) and ``draw`` columns added.

    Per bootstrap ``b``, of the ``n`` rows of ``G`` groups that share the values of
    ``within`` (none: all of them), group ``g`` of ``n_g`` rows gets
    ``floor(size * n_g / n)`` draws (``balanced=False``) or ``size // G``
    (``balanced=True``); draw ``j`` takes row ``1 + floor(u * n_g)`` of the group in
    ``md5(key:boot)`` order, ``u`` = md5 of ``seed:g...:j``.

    Nothing is sorted in full. The digest's first bits cut every group into equal
    buckets, which are counted map-side; draws are mapped to (bucket, rank). As the
    digests of a bucket are uniform too, the row of a rank lies in a narrow digest
    window: one more pass counts the rows below and between the windows, and only the
    rows inside them are shuffled and ranked (at 10^11 rows and 20,000 draws about
    one in a hundred; in a small table all). A draw outside its window, as good as
    impossible, would be missed by the row count, and all is done again with
    whole buckets. The sample is written once, as every metric of a bootstrap reads it; it has
    at most ``num_bootstraps * size`` rows for each value of ``within``."""
    seeds = seeds or bootstrap_seeds(num_bootstraps)
    names = list(df.columns)
    order = md5_order_cols(c(key), BOOT_ORDER_SEED)
    rows = df.select(*[c(n) for n in names], *[x.alias(f"_o{i}") for i, x in enumerate(order)])
    rows = rows.withColumn("_bucket", F.shiftright("_o0", HASH_BITS - SELECT_BITS))
    grp = [c(g) for g in groups]
    counts = cut_lineage(rows.groupBy(*grp, "_bucket").agg(F.count(F.lit(1)).alias("_c")), "bucket-counts")
    sizes = counts.groupBy(*grp).agg(F.sum("_c").alias("_ng"))
    draws = bootstrap_draws(sizes, groups, seeds, size, balanced, within or [])
    targets = cut_lineage(_targets(counts, draws, groups), "targets")
    n_draws = targets.count()
    for spread in (WINDOW, None):
        asked = null_safe_join(rows, _windows(targets, groups, spread), [*groups, "_bucket"])
        # slot 2j: in front of window j, 2j+1: in it
        h = F.col("_o0")
        passed = F.size(F.filter("_windows", lambda w: w["hi"] < h))
        held = F.coalesce(F.get("_windows", passed)["lo"] <= h, F.lit(False))
        slotted = asked.withColumn("_slot", 2 * passed + held.cast("int")).drop("_windows")
        per_slot = slotted.groupBy(*grp, "_bucket", "_slot").agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy(*grp, "_bucket").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        offsets = per_slot.select(*groups, "_bucket", "_slot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
        place = F.row_number().over(Window.partitionBy(*grp, "_bucket", "_slot").orderBy("_o0", "_o1", "_o2"))
        ranked = null_safe_join(slotted.where("_slot % 2 = 1").withColumn("_row", place), offsets, [*groups, "_bucket", "_slot"])
        ranked = ranked.select(*[c(n) for n in names], "_bucket", (F.col("_row") + F.col("_off")).alias("_rank"))
        wanted = targets.select(*groups, "_bucket", "_rank", "bootstrap", "draw")
        out = cut_lineage(null_safe_join(ranked, wanted, [*groups, "_bucket", "_rank"]).drop("_bucket", "_rank"), "bootstrap")
        if spread is None or out.count() == n_draws:
            return out


def _poisson1_cdf(kmax: int = 20) -> list[float]:
    acc, term, out = 0.0, math.exp(-1.0), []
    for k in range(kmax):
        acc += term
        out.append(acc)
        term /= (k + 1)
    return out


def bootstrap_weights(df: DataFrame, key: str, num_bootstraps: int = 10,
                      seeds: list[int] | None = None) -> DataFrame:
    """Full-size resampling in one pass: Poisson(1) weight per (row, bootstrap)
    by inverse CDF of an md5 uniform; no draw table, no join."""
    seeds = seeds or bootstrap_seeds(num_bootstraps)
    boots = F.explode(F.array(*[F.struct(F.lit(b).alias("bootstrap"), F.lit(s).alias("seed"))
                                for b, s in enumerate(seeds)])).alias("_b")
    d = df.select("*", boots)
    hx = F.concat_ws(":", F.col("_b.seed").cast("string"), c(key).cast("string"))
    u = F.conv(F.substring(F.md5(hx), 1, 8), 16, 10).cast("bigint").cast("double") / 4294967296.0
    w = F.lit(0)
    for cut in _poisson1_cdf():
        w = w + (u > F.lit(cut)).cast("int")
    return d.select(*[c(n) for n in df.columns], F.col("_b.bootstrap").alias("bootstrap"),
                    w.alias("weight"))


def smote_oversample(df: DataFrame, key: str, label: str, features: list[str], k: int = 5,
                     seed: int = 222) -> DataFrame:
    """Every class smaller than the largest grows to its size with synthetic
    rows ``x + lam * (nn - x)``; ``nn`` is one of the ``k`` nearest rows of the
    same class (squared Euclid on standardised features, ties by key, exact:
    ``neighbours.knn_lists``).

    Synthetic row ``i`` (0-based, per class) takes base row ``i mod m`` of the
    class in ``md5(key:seed)`` order; with ``h = md5(class:i:seed)`` the
    neighbour is number ``1 + hex(h[0:8]) mod len`` of the base row's list and
    ``lam = hex(h[8:16]) / 2^32``. A class with one row copies it. Features
    are standardised by their sample variance over the whole input. Rows with
    a missing feature are kept but are neither bases nor neighbours. Output:
    the input rows (``synthetic = 0``, ``synth_no = -1``, base and neighbour =
    the row itself) and the new rows (``synthetic = 1``, ``synth_no = i``,
    ``base_key``, ``nn_key``). For a numeric key the new rows get the key
    ``-(offset + i + 1)`` (offset = new rows of earlier classes, in label
    order), otherwise NULL."""
    from binscope.operators.neighbours import knn_lists

    spark = df.sparkSession
    kt = df.schema[key].dataType
    cols = [c(key).alias(key), c(label).alias(label), *[c(f).cast("double").alias(f) for f in features]]
    originals = df.select(*cols, F.lit(0).alias("synthetic"), F.lit(-1).cast("long").alias("synth_no"),
                          c(key).alias("base_key"), c(key).alias("nn_key"))
    counts = {r[0]: r[1] for r in df.groupBy(c(label)).count().collect()}  # one row per class
    if not counts:
        return originals
    big = max(counts.values())
    grow = {cl: big - n for cl, n in counts.items() if n < big and cl is not None}
    if not grow:
        return originals
    complete = F.lit(True)
    for f in features:
        complete = complete & F.col(f).isNotNull()
    minority = df.select(*cols).where(c(label).isin(list(grow))).where(complete)
    st = df.select(*cols).where(complete).agg(*[F.var_samp(f) for f in features]).first()
    nn, _ = knn_lists(minority, key, label, features, k, variances=list(st))
    ranked, sizes = rank_within(minority.select(label, key), [label], key, seed)
    m = {r[0]: r[1] for r in sizes.collect()}  # one row per class
    bases = ranked.join(nn, [label, key]).join(minority, [label, key]).select(
        label, F.col(key).alias("base_key"), "_nn",
                                                 (F.col("_r") - 1).alias("_b"),
                                                 *[F.col(f).alias(f"_x{j}") for j, f in enumerate(features)])
    plan = [(cl, grow[cl], m[cl]) for cl in sorted(grow) if m.get(cl)]
    total = sum(n for _, n, _ in plan)
    if not total:
        return originals
    # draws: one row per synthetic row, generated in Spark from the class offsets
    rid = F.col("id")
    cls, first, mm = None, None, None
    off = 0
    for cl, n, mc in plan:
        cond = rid < F.lit(off + n)
        cls = F.when(cond, F.lit(cl)) if cls is None else cls.when(cond, F.lit(cl))
        first = F.when(cond, F.lit(off)) if first is None else first.when(cond, F.lit(off))
        mm = F.when(cond, F.lit(mc)) if mm is None else mm.when(cond, F.lit(mc))
        off += n
    parts = max(1, min(total // 1_000_000 + 1, spark.sparkContext.defaultParallelism * 4))
    draws = (spark.range(0, total, 1, parts)
             .select(cls.cast(df.schema[label].dataType).alias(label), (rid - first).alias("synth_no"), rid.alias("_id"),
                     mm.alias("_m"))
             .withColumn("_b", F.pmod(F.col("synth_no"), F.col("_m")))
             .withColumn("_h", F.md5(F.concat_ws(":", F.col(label).cast("string"),
                                                 F.col("synth_no").cast("string"), F.lit(str(seed))))))
    d = draws.join(bases, [label, "_b"])
    h1 = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint")
    h2 = F.conv(F.substring("_h", 9, 8), 16, 10).cast("bigint")
    d = d.select("*", F.when(F.size("_nn") > 0, F.element_at("_nn", (F.pmod(h1, F.size("_nn")) + 1).cast("int")))
                 .alias("nn_key"), (h2.cast("double") / F.lit(4294967296.0)).alias("_lam"))
    nb = minority.select(F.col(label), F.col(key).alias("nn_key"),
                         *[F.col(f).alias(f"_n{j}") for j, f in enumerate(features)])
    d = d.join(nb, [label, "nn_key"], "left")
    numeric = isinstance(kt, (LongType, IntegerType, ShortType, ByteType))
    new_key = (-(F.col("_id") + 1)).cast(kt) if numeric else F.lit(None).cast(kt)
    synth = d.select(new_key.alias(key), F.col(label),
                     *[(F.col(f"_x{j}") + F.col("_lam") *
                        (F.coalesce(F.col(f"_n{j}"), F.col(f"_x{j}")) - F.col(f"_x{j}"))).alias(f)
                       for j, f in enumerate(features)],
                     F.lit(1).alias("synthetic"), "synth_no", "base_key",
                     F.coalesce(F.col("nn_key"), F.col("base_key")).cast(kt).alias("nn_key"))
    return originals.unionByName(synth)
