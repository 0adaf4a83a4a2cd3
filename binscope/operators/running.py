"""Running sums and ranks over an ordered column, per group, without one task per group.

A window ``partitionBy(group).orderBy(score)`` puts every row of a group into a
single task; at scale one model's distinct scores can number in the billions,
and one stratum can hold a third of all rows. Here the rows are dealt once by a
range exchange on (group, order): Spark samples its bounds, and every task gets
one contiguous range of all groups' rows, whatever their sizes. Sorted there,
they are numbered in passing and written to the shared checkpoint folder; the
number divided by ``ROWS_PER_BUCKET`` is the bucket. So a row finds its bucket by
where the exchange put it: no table of bounds, no search and no array in a row, and
a group may have any number of buckets. Bucket totals and their exclusive prefix
(a window over groups x buckets) are the offsets; the window then runs inside
each (group, bucket). The result is exact: the buckets only decide which task
does the work, never which rows are counted.

The numbers are drawn once, before the table is written, so every branch of the
plan, and every recomputation after an executor loss, sees the same buckets. All sizes
take the same path, and joins are left to Spark, which broadcasts a side only if
its bytes allow it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binscope.session import cut_lineage

DEFAULT_BUCKETS = None  # as many as the largest group needs


def null_safe_join(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner",
                   broadcast: bool = False) -> DataFrame:
    """Equi-join on ``cols`` where NULL matches NULL (group values may be missing)."""
    r = right
    for i, n in enumerate(cols):
        r = r.withColumnRenamed(n, f"_j{i}")
    if broadcast:
        r = F.broadcast(r)
    cond = None
    for i, n in enumerate(cols):
        e = left[n].eqNullSafe(r[f"_j{i}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_j{i}" for i in range(len(cols))])


ROWS_PER_BUCKET = 1_000_000  # rows of one (group, bucket), at most


def in_buckets(df: DataFrame, group_cols: list[str], order: list[Column], n_ranges: int | None = None) -> DataFrame:
    """``df`` with ``_place`` (ascending by group and ``order``) and ``_bucket``, written once: each (group,
    bucket) is one stretch of at most ``ROWS_PER_BUCKET`` rows of the group's order.

    ``order`` must tell the rows of a group apart. ``n_ranges`` fixes the number of tasks; by
    default it is the session's number of shuffle partitions."""
    by = [*map(F.col, group_cols), *order]
    ranges = df.repartitionByRange(n_ranges, *by) if n_ranges else df.repartitionByRange(*by)
    placed = ranges.sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id())
    return cut_lineage(placed.withColumn("_bucket", F.expr(f"_place div {ROWS_PER_BUCKET}")), "buckets")


def running_sums(df: DataFrame, keys: list[str], order_col: str, value_cols: list[str],
                 descending: bool = True, n_buckets: int | None = DEFAULT_BUCKETS,
                 prefix: str = "cum_", totals_prefix: str | None = "tot_") -> DataFrame:
    """Add ``prefix + v`` = sum of ``v`` over rows of the same group whose order
    value comes at or before this row's (descending or ascending), and, unless
    ``totals_prefix`` is None, ``totals_prefix + v`` = the group total.

    ``df`` should hold at most one row per (keys, order value); ties would be
    ordered arbitrarily otherwise. ``n_buckets=1`` is the plain window (fine when
    each group is known to be small); by default the sizes decide.
    """
    keys = list(keys)
    o: Column = -F.col(order_col) if descending else F.col(order_col)
    grp = keys if keys else ["_g"]
    base = df if keys else df.withColumn("_g", F.lit(0))
    tot_cols = [] if totals_prefix is None else value_cols
    if n_buckets == 1:
        w = Window.partitionBy(*grp).orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
        wt = Window.partitionBy(*grp)
        out = base.select("*", *[F.sum(v).over(w).alias(prefix + v) for v in value_cols],
                          *[F.sum(v).over(wt).alias(totals_prefix + v) for v in tot_cols])
        return out.drop("_g") if not keys else out

    with_b = in_buckets(base, grp, [o], n_buckets)
    totals = with_b.groupBy(*grp, "_bucket").agg(*[F.sum(v).alias("_t_" + v) for v in value_cols])
    whole = Window.partitionBy(*grp)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*grp, "_bucket", *[F.coalesce(F.sum("_t_" + v).over(before), F.lit(0)).alias("_o_" + v) for v in value_cols],
                            *[F.sum("_t_" + v).over(whole).alias("_gt_" + v) for v in tot_cols])
    wr = Window.partitionBy(*grp, "_bucket").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    out = (null_safe_join(with_b, offsets, grp + ["_bucket"])
           .select(*base.columns,
                   *[(F.sum(v).over(wr) + F.col("_o_" + v)).alias(prefix + v) for v in value_cols],
                   *[F.col("_gt_" + v).alias(totals_prefix + v) for v in tot_cols]))
    return out.drop("_g") if not keys else out


def rank_in_groups(df: DataFrame, group_cols: list[str], order_cols: list[str],
                   out: str = "_r", size: str = "_m", n_buckets: int | None = DEFAULT_BUCKETS
                   ) -> tuple[DataFrame, DataFrame]:
    """1-based rank of each row inside its group by ``order_cols`` (the first
    one numeric; together unique within a group) plus the group size; also
    returns the group-size table.

    Same bucketing as ``running_sums``: a range exchange deals the rows, they are
    counted per (group, bucket), and the rank is the bucket's offset plus
    ``row_number`` inside the (group, bucket), so a group holding a third of the
    rows is spread over many tasks. NULL group values form a group of their own.
    """
    grp = list(group_cols) if group_cols else ["_g"]
    base = df if group_cols else df.withColumn("_g", F.lit(0))
    with_b = in_buckets(base, grp, [F.col(n) for n in order_cols], n_buckets)
    counts = with_b.groupBy(*grp, "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(*grp)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*grp, "_bucket", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                            F.sum("_c").over(whole).alias(size))
    wr = Window.partitionBy(*grp, "_bucket").orderBy("_place")
    ranked = (null_safe_join(with_b, offsets.drop(size), grp + ["_bucket"])
              .withColumn(out, (F.row_number().over(wr) + F.col("_off")).cast("long"))
              .drop("_bucket", "_place", "_off"))
    sizes = offsets.select(*grp, size).distinct()
    if not group_cols:
        return ranked.drop("_g"), sizes.drop("_g")
    return ranked, sizes


def global_row_number(df: DataFrame, order_cols: list[str], out: str = "row_no") -> DataFrame:
    """0-based rank of each row in the global order of ``order_cols`` (the
    first numeric; together unique per row), without a single-task window."""
    ranked, _ = rank_in_groups(df, [], order_cols, out="_rk", size="_n")
    return ranked.withColumn(out, F.col("_rk") - 1).drop("_rk", "_n")


HASH_BITS = 60  # numeric digest prefixes are 60-bit (15 hex digits), uniform on [0, 2^60)


def rank_by_hash(df: DataFrame, group_cols: list[str], hash_col: str, tie_cols: list[str],
                 out: str = "_r", size: str = "_m", bucket_bits: int = 12
                 ) -> tuple[DataFrame, DataFrame]:
    """Rank inside each group in the order (``hash_col``, ``tie_cols``) where
    ``hash_col`` is a uniform 60-bit digest prefix (``md5_order_cols``).

    Because the digest is uniform, its top ``bucket_bits`` bits cut every
    group into 2^bucket_bits equal-sized buckets without any statistics job:
    per (group, bucket) counts -> offsets on that small table -> ``row_number``
    inside each (group, bucket). Everything is a deterministic function of the
    data, so a recomputation after an executor loss gives the same ranks, and
    a group holding a third of the rows is still spread over 4,096 buckets.
    Returns (ranked rows, group sizes)."""
    grp = list(group_cols) if group_cols else ["_g"]
    base = df if group_cols else df.withColumn("_g", F.lit(0))
    d = base.withColumn("_bucket", F.shiftright(F.col(hash_col), HASH_BITS - bucket_bits))
    counts = d.groupBy(*grp, "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    wb = Window.partitionBy(*grp).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*grp, "_bucket",
                            F.coalesce(F.sum("_c").over(wb), F.lit(0)).alias("_off"),
                            F.sum("_c").over(Window.partitionBy(*grp)).alias(size))
    wr = Window.partitionBy(*grp, "_bucket").orderBy(hash_col, *tie_cols)
    ranked = (null_safe_join(d, offsets, grp + ["_bucket"])
              .withColumn(out, (F.row_number().over(wr) + F.col("_off")).cast("long"))
              .drop("_bucket", "_off"))
    sizes = offsets.select(*grp, size).distinct()
    if not group_cols:
        return ranked.drop("_g"), sizes.drop("_g")
    return ranked, sizes


def hash_row_number(df: DataFrame, hash_col: str, tie_cols: list[str], out: str = "row_no"
                    ) -> DataFrame:
    """0-based global rank in (digest prefix, ties) order (see ``rank_by_hash``)."""
    ranked, _ = rank_by_hash(df, [], hash_col, tie_cols, out="_rk", size="_n")
    return ranked.withColumn(out, F.col("_rk") - 1).drop("_rk", "_n")
