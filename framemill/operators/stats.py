"""Distributions and threshold estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (0.01, 0.05, 0.25, 0.5, 0.95, 0.99)


def percentiles(df: DataFrame, by: list[str], value: str, levels: tuple[float, ...] = LEVELS) -> DataFrame:
    """by..., level, value: exact percentiles with linear interpolation; nulls are passed over."""
    each = df.groupBy(*by).agg(F.percentile(F.col(value).cast("double"), F.array(*map(F.lit, levels))).alias("_p_"))
    return each.select(*by, F.posexplode("_p_").alias("_i_", "value")).select(*by, F.element_at(F.array(*map(F.lit, levels)), F.col("_i_") + 1).alias("level"), "value")


def histogram(df: DataFrame, by: list[str], value: Column, low: float, width: float, bins: int) -> DataFrame:
    """by..., bin (0-based), n; values outside the range and nulls are left out, the upper edge counts to the last bin."""
    b = F.when(value == low + width * bins, bins - 1).otherwise(F.floor((value - low) / width)).cast("int")
    return df.select(*by, b.alias("bin")).where((F.col("bin") >= 0) & (F.col("bin") < bins)).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))


def grid(df: DataFrame, x: Column, y: Column, cell: float) -> DataFrame:
    """x_cell, y_cell, n on a grid of square cells; rows with a null are left out."""
    f = lambda c: F.floor(c / cell).cast("bigint")
    return df.select(f(x).alias("x_cell"), f(y).alias("y_cell")).where("x_cell is not null and y_cell is not null").groupBy("x_cell", "y_cell").agg(F.count(F.lit(1)).alias("n"))


def distinct_pairs(df: DataFrame, x: str, y: str, digits: int = 1) -> DataFrame:
    """n_pairs: distinct (x, y) rounded half to even."""
    r = lambda c: F.bround(F.col(c).cast("double"), digits)
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(F.count_distinct(r(x), r(y)).alias("n_pairs"))


def correlation(df: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias("n"), F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"))


def threshold_estimate(df: DataFrame, by: list[str], intensity: str) -> DataFrame:
    """by..., n, low, p01, p05, verdict per source of kept intensities.

    'likely' where the 1st and 5th percentile lie within max(1, p01 / 10) of each
    other, with a note where the minimum is within 0.5 of p01; else 'ambiguous'.
    A source without intensities has no row.
    """
    v = F.col(intensity).cast("double")
    p = lambda q: F.percentile(v, F.lit(q))
    s = df.where(v.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("low"), p(0.01).alias("p01"), p(0.05).alias("p05"))
    tight = (F.col("p05") - F.col("p01")) <= F.greatest(F.lit(1.0), F.col("p01") * 0.1)
    likely = F.format_string("likely i_min = %.1f", F.col("p01"))
    verdict = F.when(tight & (F.col("p01") > F.col("low") + 0.5), likely).when(tight, F.concat(likely, F.lit(" (no bg contamination detected)"))).otherwise("ambiguous")
    return s.withColumn("verdict", verdict)


def calibrated(df: DataFrame, by: list[str], deformation: str, intensity: str, floor: int = 12) -> DataFrame:
    """by..., n_background, p25, bg_p99, i_min.

    Background are the frames whose deformation lies below its first quartile.
    i_min is the rounded 99th percentile of their nonzero intensities plus 2 if
    there are ten such, else the rounded first quartile of all nonzero
    intensities; the floor at least.
    """
    d, i = F.col(deformation).cast("double"), F.col(intensity).cast("double")
    quart = df.groupBy(*by).agg(F.percentile(d, F.lit(0.25)).alias("p25"), F.percentile(F.when(i > 0, i), F.lit(0.25)).alias("_q_"))
    low = df.join(quart, by).where(d < F.col("p25")).groupBy(*by).agg(F.count(F.lit(1)).alias("n_background"), F.count(F.when(i > 0, 1)).alias("_nz_"), F.percentile(F.when(i > 0, i), F.lit(0.99)).alias("bg_p99"))
    j = quart.join(low, by, "left")
    guess = F.when(F.col("_nz_") >= 10, F.bround("bg_p99") + 2).otherwise(F.bround(F.coalesce("_q_", F.lit(0.0))))
    return j.select(*by, F.coalesce("n_background", F.lit(0)).alias("n_background"), "p25", "bg_p99", F.greatest(guess, F.lit(float(floor))).alias("i_min"))


def dynamism(df: DataFrame, by: list[str], order: list[str], step: Column, deformation: str, least: int = 3, empty_below: float = 4.0) -> DataFrame:
    """by..., n, dynamism (mean of ``step``, an expression that may use ``before``, the previous row as a struct), mean_deformation, median_deformation, empty_share; groups of ``least`` rows or more."""
    w = Window.partitionBy(*by).orderBy(*order)
    s = df.withColumn("before", F.lag(F.struct(*df.columns)).over(w)).withColumn("_step_", F.when(F.col("before").isNotNull(), step))
    d = F.col(deformation)
    out = s.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg("_step_").alias("dynamism"), F.avg(d).alias("mean_deformation"), F.median(d).alias("median_deformation"), F.avg((d < empty_below).cast("double")).alias("empty_share"))
    return out.where(F.col("n") >= least)


def channel_means(df: DataFrame, by: list[str], r: str, g: str, b: str) -> DataFrame:
    """by..., n, mean and population deviation of each channel, order: 'rgb' where the red mean leads, else 'bgr'."""
    m = [f for c in (r, g, b) for f in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))]
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *m)
    return out.withColumn("order", F.when(F.col(f"{r}_mean") > F.col(f"{b}_mean"), "rgb").otherwise("bgr"))
