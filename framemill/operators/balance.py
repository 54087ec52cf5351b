"""Balance of a corpus: buckets, counts, entropy, caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framemill.operators.selection import even_cap

# Sensor names by source.
SENSORS = {
    "gelslam": "mini_gelslam", "tactile_tracking": "mini_tracking", "real_tactile_mnist": "mini_rtm", "feelanyforce": "mini_feelanyforce",
    "threedcal": "mini_threedcal", "unit": "mini_unit", "tacquad": "mini_tacquad", "sim_tactile_mnist": "sim_taxim_mini", "sim_starstruck": "sim_taxim_mini",
}


def _filled(c: str, default: str) -> Column:
    """The column's text, or the default where it is null or empty."""
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(default))


def sensor_id() -> Column:
    source, split = F.col("source"), F.col("split")
    out = F.when(source.isin("fota_labeled", "fota_unlabeled"), F.concat(F.lit("mini_fota_"), _filled("side", "unk")))
    feats = F.when(split.startswith("test_diff_sensor_new_gel"), "mini_feats_new_gel").when(split.startswith("test_diff_sensor_old_gel"), "mini_feats_old_sensor").otherwise("mini_feats_main")
    out = out.when(source == "feats", feats)
    for name, sensor in SENSORS.items():
        out = out.when(source == name, sensor)
    sparsh = F.when(F.coalesce(F.col("indenter"), F.lit("")) == "", "mini_sparsh").otherwise(F.concat(F.lit("mini_sparsh_"), F.col("indenter")))
    return out.when(source == "sparsh", sparsh).otherwise(F.concat(F.lit("mini_"), source))


def object_id() -> Column:
    source, obj = F.col("source"), F.coalesce(F.col("obj_name"), F.lit("None"))
    place = F.when(F.col("x_mm").isNull() | F.col("y_mm").isNull(), "sphere/unknown").otherwise(
        F.concat(F.lit("sphere/x="), F.format_string("%.1f", F.col("x_mm").cast("double")), F.lit("_y="), F.format_string("%.1f", F.col("y_mm").cast("double")))
    )
    shape = F.coalesce(F.nullif(F.col("indenter"), F.lit("")), F.nullif(F.col("obj_name"), F.lit("")))
    episode = _filled("episode", "unk")
    return (
        F.when(source.isin("fota_labeled", "fota_unlabeled"), F.concat(obj, F.lit("/"), F.coalesce("capture", F.lit(""))))
        .when(source == "threedcal", place)
        .when(source == "feats", F.concat(F.coalesce(shape, F.lit("unknown")), F.lit("_"), F.coalesce("split", F.lit(""))))
        .when(source == "real_tactile_mnist", F.concat(F.lit("digit_"), obj, F.lit("/ep_"), episode))
        .when(source == "sim_tactile_mnist", F.concat(obj, F.lit("/ep_"), episode))
        .when(source == "sim_starstruck", F.concat(F.lit("starstruck/ep_"), episode))
        .when(source == "tacquad", F.concat(obj, F.lit("/"), F.coalesce("split", F.lit("None"))))
        .when(source == "sparsh", F.coalesce(shape, F.lit("unk")))
        .otherwise(_filled("obj_name", "unknown"))
    )


def buckets(rows: DataFrame) -> DataFrame:
    """Adds domain (filled by the source's prefix), sensor, object_id, gel. Columns that are missing count as null."""
    for c in ("source", "side", "indenter", "split", "obj_name", "capture", "episode", "domain"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    for c, t in (("x_mm", "float"), ("y_mm", "float"), ("markered", "boolean")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(t))
    domain = F.coalesce(F.nullif(F.col("domain"), F.lit("")), F.when(F.col("source").startswith("sim_"), "sim").otherwise("real"))
    return rows.withColumns({"domain": domain, "sensor": sensor_id(), "object_id": object_id(), "gel": F.when(F.coalesce("markered", F.lit(False)), "markered").otherwise("markerless")})


def axis_counts(rows: DataFrame, axes: list[list[str]]) -> DataFrame:
    """axis, bucket, n for every axis (a list of columns) in one pass, by grouping sets; null values are written '∅'."""
    cols = sorted({c for a in axes for c in a})
    rows = rows.select(*cols)
    grouped = rows.groupingSets([[F.col(c) for c in a] for a in axes], *cols).agg(F.count(F.lit(1)).alias("n"), F.grouping_id(*cols).alias("_g_"))
    ids = {sum(0 if c in a else 1 << (len(cols) - 1 - i) for i, c in enumerate(cols)): a for a in axes}
    text = lambda a: F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("∅")) for c in a))
    axis = bucket = None
    for g, a in ids.items():
        hit = F.col("_g_") == g
        axis = F.when(hit, "*".join(a)) if axis is None else axis.when(hit, "*".join(a))
        bucket = F.when(hit, text(a)) if bucket is None else bucket.when(hit, text(a))
    return grouped.select(axis.alias("axis"), bucket.alias("bucket"), "n")


def scores(counts: DataFrame, axis: str = "axis", n: str = "n") -> DataFrame:
    """axis, buckets, rows, entropy (normalised; 1 for a single bucket), ess (rows² / Σ n²)."""
    total = counts.groupBy(axis).agg(F.count(F.lit(1)).alias("buckets"), F.sum(n).alias("rows"), F.sum(F.col(n).cast("double") * F.log(F.col(n).cast("double"))).alias("_nl_"), F.sum(F.col(n).cast("double") * F.col(n)).alias("_sq_"))
    r = F.col("rows").cast("double")
    entropy = F.when(F.col("buckets") > 1, (F.log(r) - F.col("_nl_") / r) / F.log(F.col("buckets").cast("double"))).otherwise(1.0)
    return total.select(axis, "buckets", "rows", entropy.alias("entropy"), (r * r / F.col("_sq_")).alias("ess"))


def top_and_tail(counts: DataFrame, bucket: str, n: str, k: int) -> DataFrame:
    """The k largest buckets with their share, and one row '(N more)' for the rest, if any. Ties by bucket."""
    whole = Window.partitionBy(F.lit(0))
    # one row per bucket, and only k of them and two sums leave the tasks
    top = counts.orderBy(F.desc(n), bucket).limit(k).select(bucket, n)
    totals = counts.agg(F.count(F.lit(1)).alias("_b_"), F.sum(n).alias("_t_"))
    taken = top.agg(F.count(F.lit(1)).alias("_bk_"), F.coalesce(F.sum(n), F.lit(0)).alias("_tk_"))
    rest = totals.withColumn("_k_", F.lit(1)).join(taken.withColumn("_k_", F.lit(1)), "_k_")
    tail = rest.where(F.col("_b_") > F.col("_bk_")).select(F.concat(F.lit("("), (F.col("_b_") - F.col("_bk_")).cast("string"), F.lit(" more)")).alias(bucket), (F.col("_t_") - F.col("_tk_")).alias(n))
    both = top.unionByName(tail)
    return both.withColumn("share", F.col(n) / F.sum(n).over(whole))


def ranges(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """by..., column, n, low, high, mean, deviation (population); nulls are passed over."""
    long = rows.select(*by, F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns))).alias("_x_")).select(*by, "_x_.*")
    return long.groupBy(*by, "column").agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("deviation"))


def nested_counts(rows: DataFrame, outer: str, inner: str) -> DataFrame:
    """outer, counts (map of inner value -> rows). The inner values of one outer value must be few; null is written ''."""
    pairs = rows.groupBy(outer, F.coalesce(F.col(inner).cast("string"), F.lit("")).alias("_i_")).agg(F.count(F.lit(1)).alias("_n_"))
    return pairs.groupBy(outer).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_i_", "_n_")))).alias("counts"))


def mix(rows: DataFrame, by: str, of: str, values: list[str]) -> DataFrame:
    """by, one count column per value, other."""
    c = F.col(of).cast("string")
    return rows.groupBy(by).agg(*(F.count(F.when(c == v, 1)).alias(v) for v in values), F.count(F.when(c.isNull() | ~c.isin(*values), 1)).alias("other"))


def object_cap(rows: DataFrame, order: list[str], sim: int = 50, real: int = 250) -> DataFrame:
    """At most ``sim`` or ``real`` rows of each (domain, object_id), evenly spaced in order."""
    return even_cap(rows, ["domain", "object_id"], order, F.when(F.col("domain") == "sim", sim).otherwise(real))


def domain_cap(rows: DataFrame, order: list[str], real: int = 600_000, sim: int = 400_000) -> DataFrame:
    """Where a domain has more rows than its cap, each of its sources keeps its share (one row at least), evenly spaced.

    A source belongs to the domain of its first row in order. Shares round half to even.
    """
    first = rows.groupBy("source").agg(F.min_by("domain", F.struct(*order)).alias("_d_"), F.count(F.lit(1)).alias("_n_"))
    whole = F.sum("_n_").over(Window.partitionBy("_d_"))
    cap = F.when(F.col("_d_") == "sim", sim).otherwise(real)
    share = F.greatest(F.lit(1), F.bround(F.col("_n_") * (cap.cast("double") / whole)).cast("bigint"))
    target = first.select("source", F.when(whole > cap, share).otherwise(F.col("_n_")).alias("_target_"))
    return even_cap(rows.join(target, "source"), ["source"], order, F.col("_target_")).drop("_target_")


def split_targets(cap: int, shares: dict[str, float], rest: str | None = None) -> dict[str, int]:
    """Rows per split: int(cap * share); what is left goes to ``rest``."""
    out = {s: int(cap * a) for s, a in shares.items()}
    if rest is not None:
        out[rest] = cap - sum(v for k, v in out.items() if k != rest)
    return out


def capture_cap(rows: DataFrame, order: list[str], caps: dict[str, int]) -> DataFrame:
    """At most caps[split] rows of each (split, capture), evenly spaced; splits without a cap stay whole."""
    cap = F.lit(2**62)
    for s, n in caps.items():
        cap = F.when(F.col("split") == s, n).otherwise(cap)
    return even_cap(rows, ["split", "capture"], order, cap)
