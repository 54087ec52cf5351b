"""Joins with side tables: poses, annotations, markers, split lists, intervals, operating points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def with_poses(frames: DataFrame, poses: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Left join; values are read as float, unreadable ones and frames without a pose give null. A key that repeats in poses counts once, with its smallest values."""
    side = poses.groupBy(*keys).agg(F.min(F.struct(*(F.col(v).try_cast("float").alias(v) for v in values))).alias("_p_")).select(*keys, "_p_.*")
    return frames.join(side, keys, "left")


def with_annotations(frames: DataFrame, annotations: DataFrame, key: str, values: list[str]) -> DataFrame:
    """As with_poses, but what is missing or unreadable is 0.0."""
    return with_poses(frames, annotations, [key], values).withColumns({v: F.coalesce(v, F.lit(0.0).cast("float")) for v in values})


def split_flag(paths: DataFrame, listed: DataFrame, keys: list[str], member: str = "path", inside: str = "test", outside: str = "train") -> DataFrame:
    """Adds ``split``: ``inside`` where any of the row's keys is in the list, else ``outside``. The list is made distinct; null keys match nothing."""
    side = listed.where(F.col(member).isNotNull()).select(F.col(member).alias("_m_")).distinct()
    out, hit = paths, F.lit(False)
    for i, k in enumerate(keys):
        out = out.join(side.withColumnRenamed("_m_", f"_m{i}_"), F.col(k) == F.col(f"_m{i}_"), "left")
        hit = hit | F.col(f"_m{i}_").isNotNull()
    return out.withColumn("split", F.when(hit, inside).otherwise(outside)).drop(*(f"_m{i}_" for i in range(len(keys))))


def with_flag(rows: DataFrame, flags: DataFrame, key: str, flag: str) -> DataFrame:
    """Left join of a boolean per key, false where missing; true if any of a repeated key's rows says so."""
    side = flags.groupBy(key).agg(F.max(F.coalesce(F.col(flag), F.lit(False))).alias(flag))
    return rows.drop(flag).join(side, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def in_intervals(points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, width: float, fallback: bool = False) -> DataFrame:
    """Points joined with the intervals of their key that hold them (start <= at <= end).

    The axis is cut into cells of ``width``; an interval is sent to the cells it
    covers and a point to its own, so a key with many points and intervals spreads
    over cells and no pair outside a common cell is formed. Rows with a null in
    key, at, start or end match nothing. fallback: points of keys of which
    no point matched are kept, with null intervals.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(float(width))).cast("bigint")
    cut = intervals.where(F.col(start) <= F.col(end)).withColumn("_cell_", F.explode(F.sequence(cell(start), cell(end))))
    extra = [c for c in intervals.columns if c not in points.columns]
    hit = points.withColumn("_cell_", cell(at)).join(cut.select(key, "_cell_", *extra), [key, "_cell_"]).where((F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end))).drop("_cell_")
    if not fallback:
        return hit
    rest = points.join(hit.select(key).distinct(), key, "left_anti")
    return hit.unionByName(rest, allowMissingColumns=True)


def operating_points(metrics: DataFrame, points: list[tuple[str, float, float]], by: list[str]) -> DataFrame:
    """op, by..., n, kept, share for each (name, a_min, i_min): one pass over the metrics, no join."""
    hit = F.array(*(F.struct(F.lit(name).alias("op"), ((F.col("area") >= a) & (F.col("intensity") >= i)).cast("bigint").alias("hit")) for name, a, i in points))
    one = metrics.select(*by, F.explode(hit).alias("_h_"))
    return one.groupBy("_h_.op", *by).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_h_.hit"), F.lit(0)).alias("kept")).withColumn("share", F.col("kept") / F.col("n"))


def threshold_sweep(df: DataFrame, value: Column, taus: list[float], band: float = 1.4) -> DataFrame:
    """tau, n, reached (value >= tau), in_band (tau <= value < band * tau)."""
    steps = F.array(*(F.lit(float(t)) for t in taus))
    one = df.select(value.alias("_v_"), F.explode(steps).alias("tau"))
    v, t = F.col("_v_"), F.col("tau")
    return one.groupBy("tau").agg(F.count("_v_").alias("n"), F.count(F.when(v >= t, 1)).alias("reached"), F.count(F.when((v >= t) & (v < t * band), 1)).alias("in_band"))
