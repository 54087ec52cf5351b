"""Operators that choose rows by order: caps, strides, peaks, draws, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framemill.functions import ranks
from framemill.session import checkpointed, shuffle_width


def _placed(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Adds _place_ and _rows_, names that no table here bears."""
    return ranks.positions(df, by, order, place="_place_", rows="_rows_")


def even_cap(df: DataFrame, by: list[str], order: list[str], target: int | Column) -> DataFrame:
    """At most target rows of each group, evenly spaced in its order, first and last included.

    Kept are the places floor(i * ((n - 1) / (target - 1))) in doubles, the last
    one n - 1; all rows where the group has no more than target, the first row
    for a target of 1, none for 0.
    """
    t = F.lit(target) if isinstance(target, int) else target
    r = _placed(df.withColumn("_t_", t.cast("bigint")), by, order)
    n, p, t = F.col("_rows_"), F.col("_place_"), F.col("_t_")
    step = (n - 1).cast("double") / (t - 1).cast("double")
    i = F.floor(p / step)
    hit = lambda k: (i + k >= 0) & (i + k < t - 1) & (F.floor((i + k).cast("double") * step) == p)
    keep = F.when(t < 1, F.lit(False)).when(n <= t, F.lit(True)).when(t == 1, p == 0).otherwise((p == n - 1) | hit(-1) | hit(0) | hit(1))
    return r.where(keep).drop("_t_", "_place_", "_rows_")


def stride_cap(df: DataFrame, by: list[str], order: list[str], budget: int) -> DataFrame:
    """At most budget rows of each group: places floor(i * (n / budget)) for i below budget; all rows where there are no more."""
    r = _placed(df, by, order)
    n, p = F.col("_rows_"), F.col("_place_")
    step = n.cast("double") / F.lit(float(budget))
    i = F.floor(p / step)
    hit = lambda k: (i + k >= 0) & (i + k < budget) & (F.floor((i + k).cast("double") * step) == p)
    return r.where((n <= budget) | hit(-1) | hit(0) | hit(1)).drop("_place_", "_rows_")


def row_stride(df: DataFrame, order: list[str], stride: int) -> DataFrame:
    """Every stride-th row of the whole order, from the first."""
    return _placed(df, [], order).where(F.col("_place_") % stride == 0).drop("_place_", "_rows_")


def auto_stride(rows: Column, per_row: Column, rate: Column, target: Column) -> Column:
    """Stride that brings about target of rows * per_row * rate results; 1 where there are no more than target."""
    expected = rows * per_row * rate
    return F.when(expected <= target, 1).otherwise(F.greatest(F.lit(1), F.floor(expected / target))).cast("bigint")


def early_exit(df: DataFrame, file: str, target: int, kept: Column, factor: float = 1.5) -> DataFrame:
    """Rows of the files read before more than factor * target rows were kept in files before them.

    file orders the files; kept marks the rows that count. Totals per file are few against the rows.
    """
    per = df.groupBy(F.col(file).alias("_file_")).agg(F.sum(kept.cast("bigint")).alias("_n_"))
    before = F.coalesce(F.sum("_n_").over(Window.partitionBy(F.lit(0)).orderBy("_file_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = per.withColumn("_before_", before).where(F.col("_before_") <= factor * target).select("_file_")
    return df.join(wanted, F.col(file) == F.col("_file_"), "left_semi")


def peak(df: DataFrame, by: list[str], score: Column, order: str, least: float | None = None) -> DataFrame:
    """The row of each group with the highest score; of equal ones the last in order. None where it is below least. Null scores rank below all."""
    best = df.withColumn("_s_", score).groupBy(*by).agg(F.max_by(F.struct(*df.columns, "_s_"), F.struct(F.coalesce(F.col("_s_"), F.lit(float("-inf"))), F.col(order))).alias("_b_"))
    out = best.select("_b_.*")
    return (out if least is None else out.where(F.col("_s_") >= least)).drop("_s_")


def top_k(df: DataFrame, by: list[str], score: Column, order: list[str], k: int) -> DataFrame:
    """The k rows of each group with the highest scores, ties by order; adds ``rank`` from 1. Limited before the shuffle by Spark's window group limit."""
    w = Window.partitionBy(*by).orderBy(score.desc(), *order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def peaks_or_fallback(df: DataFrame, by: list[str], score: Column, order: list[str], k: int, least: float, rate: float, seed: int = 0) -> DataFrame:
    """Up to k peaks of at least least per group; a group without any gives, with probability rate by a stable hash, one random row instead. Adds ``fallback``."""
    s = df.withColumn("_s_", score)
    good = top_k(s.where(F.col("_s_") >= least), by, F.col("_s_"), order, k).drop("rank").withColumn("fallback", F.lit(False))
    empty = s.groupBy(*by).agg(F.max("_s_").alias("_m_")).where((F.coalesce(F.col("_m_"), F.lit(float("-inf"))) < least) & (_draw(seed, *by) < rate)).drop("_m_")
    draw = s.join(empty, by, "left_semi").withColumn("_d_", _draw(seed + 1, *by, *order))
    spare = top_k(draw, by, -F.col("_d_"), order, 1).drop("rank", "_d_").withColumn("fallback", F.lit(True))
    return good.unionByName(spare).drop("_s_")


def _draw(seed: int, *key: Column | str) -> Column:
    """A number in [0, 1) from seed and key alone, which other engines compute alike."""
    return ranks.md5_number(F.lit(seed), *(F.col(k) if isinstance(k, str) else k for k in key)) / F.lit(2.0**60)


def bernoulli(df: DataFrame, key: list[str], rate: float, seed: int = 0, always: Column | None = None) -> DataFrame:
    """Keeps each row with probability rate, decided by a hash of seed and key alone; rows that satisfy ``always`` stay."""
    draw = _draw(seed, *key) < rate
    return df.where(draw if always is None else F.coalesce(always, F.lit(False)) | draw)


def bernoulli_md5(key: Column, rate: float, seed: str = "") -> Column:
    """The same from an md5 digest, which other engines share: the first 13 hex digits as a fraction."""
    part = F.conv(F.substring(F.md5(F.concat(F.lit(seed), key.cast("string"))), 1, 13), 16, 10).cast("bigint")
    return part / F.lit(float(16**13)) < rate


def bernoulli_drawn(df: DataFrame, order: list[str], failing: Column, rate: float, seed: int) -> DataFrame:
    """Sequential draws: the k-th failing row in order takes the k-th number of Python's seeded generator; passing rows draw nothing and stay.

    The numbers are drawn on the executors by rank: each task advances its own generator to its ranks.
    """
    fails = F.coalesce(failing, F.lit(True))
    bad = _placed(df.where(fails), [], order)
    schema = bad.schema

    def keep(batches):
        import random

        rng, at, value = random.Random(seed), -1, 0.0
        for b in batches:
            wanted = sorted(set(b["_place_"]))
            drawn = {}
            for p in wanted:
                if p < at:
                    rng, at = random.Random(seed), -1
                while at < p:
                    value, at = rng.random(), at + 1
                drawn[p] = value
            yield b[b["_place_"].map(drawn) < rate]

    return df.where(~fails).unionByName(bad.sortWithinPartitions("_place_").mapInPandas(keep, schema).drop("_place_", "_rows_"))


def every_kth(df: DataFrame, by: list[str], order: list[str], most: int = 50) -> DataFrame:
    """Of each group every k-th row, k = rows div most (1 at least), at most ``most`` rows."""
    r = _placed(df, by, order)
    k = F.greatest(F.lit(1), F.floor(F.col("_rows_") / most))
    return r.where((F.col("_place_") % k == 0) & (F.col("_place_") / k < most)).drop("_place_", "_rows_")


def first_per_key(df: DataFrame, by: list[str], order: list[str], limit: int | None = None) -> DataFrame:
    """The first row of each key; with limit only the keys whose first rows come first."""
    out = df.groupBy(*by).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r_")).select("_r_.*")
    return out if limit is None else out.orderBy(*order).limit(limit)


def probe_cap(df: DataFrame, by: list[str], order: list[str], per_group: int = 30, total: int = 2000) -> DataFrame:
    """The first per_group rows of each group, of these the first total in the order of groups and rows."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn_", F.row_number().over(w)).where(F.col("_rn_") <= per_group).drop("_rn_").orderBy(*by, *order).limit(total)


def renumber(df: DataFrame, sequence: str, order: list[str]) -> DataFrame:
    """Adds frame_in_seq (0-based) and sequence_length to rows of each sequence."""
    return _placed(df.drop("frame_in_seq", "sequence_length"), [sequence], order).withColumnRenamed("_place_", "frame_in_seq").withColumnRenamed("_rows_", "sequence_length")


def run_ids(df: DataFrame, key: str, order: list[str], by: list[str]) -> DataFrame:
    """Adds ``run``: number, from 1, of the stretch of equal keys within each group's order (null equals null).

    Groups are cut into ranges of their order, so none lies in one task; each range
    numbers its own stretches, and its neighbours' last keys tell how they join.
    """
    keys = [*by, *order]
    spark = df.sparkSession
    cut = checkpointed(df.repartitionByRange(2 * shuffle_width(spark), *keys).withColumn("_piece_", F.spark_partition_id()))
    inside = Window.partitionBy(*by, "_piece_").orderBy(*order)
    first = F.row_number().over(inside) == 1
    change = F.when(~first & ~F.col(key).eqNullSafe(F.lag(key).over(inside)), 1).otherwise(0)
    cut = cut.withColumn("_c_", change).withColumn("_c_", F.sum("_c_").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    names = [f"_by{i}_" for i in range(len(by))]
    low, high = F.min_by(F.struct(key), F.struct(*order)), F.max_by(F.struct(key), F.struct(*order))
    pieces = cut.groupBy(*(F.col(c).alias(g) for c, g in zip(by, names)), F.col("_piece_").alias("_p_")).agg(low.alias("_low_"), high.alias("_high_"), F.max("_c_").alias("_n_"))
    w = Window.partitionBy(*(names or [F.lit(0)])).orderBy("_p_")  # at most one row per range and group
    joins = F.when(F.lag("_high_").over(w).isNull() | ~F.lag("_high_").over(w).eqNullSafe(F.col("_low_")), 1).otherwise(0)
    pieces = pieces.withColumn("_j_", joins).withColumn("_start_", F.sum("_j_").over(w) + F.coalesce(F.sum("_n_").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    cond = F.col("_piece_") == F.col("_p_")
    for c, g in zip(by, names):
        cond = cond & F.col(c).eqNullSafe(F.col(g))
    return cut.join(pieces, cond).withColumn("run", F.col("_start_") + F.col("_c_")).select(*df.columns, "run")


def in_window(times: Column, start: Column, end: Column) -> Column:
    """Positions of times within [start, end]; all positions where start, end or times are missing or none falls inside."""
    every = F.sequence(F.lit(0), F.size(times) - 1)
    inside = F.filter(every, lambda i: (F.get(times, i) >= start) & (F.get(times, i) <= end))
    return F.when(times.isNull() | (F.size(times) == 0), F.array().cast("array<int>")).when(start.isNull() | end.isNull() | (F.size(inside) == 0), every).otherwise(inside)


def per_shape_buffered(frames: DataFrame, shape: list[str], order: list[str], column: str, n: int = 120) -> DataFrame:
    """All frames with the median of the first n frames of their shape as base; those n are not used up."""
    from framemill.operators.baselines import elementwise, first_n

    return frames.join(elementwise(first_n(frames, shape, order, n), shape, column), shape, "left")


def systematic(df: DataFrame, order: list[str], n: int, scanned: int = 8000) -> DataFrame:
    """Every max(1, scanned // n)-th row in order, n rows at most."""
    k = max(1, scanned // max(n, 1))
    return _placed(df, [], order).where((F.col("_place_") % k == 0) & (F.col("_place_") < k * n)).drop("_place_", "_rows_")


def hash_sample(df: DataFrame, key: list[str], n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement: the smallest hashes of seed and key. Each task sends at most n rows."""
    return df.withColumn("_h_", _draw(seed, *key)).orderBy("_h_", *key).limit(n).drop("_h_")


def nearest(df: DataFrame, value: Column, to: float, order: list[str], k: int) -> DataFrame:
    """The k rows whose value is nearest to ``to``."""
    return df.orderBy(F.abs(value - to), *order).limit(k)
