"""Verification of key sets: differences, verdicts, seed envelopes, key quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["capture", "frame_idx"]

# Sources whose old producer drew from an unrecorded seed, and what that seed was the hash of.
UNRECORDED = {"sparsh": "hash(indenter)", "tacquad": "hash(domain)", "real_tactile_mnist": "hash(fname)"}


def reproducible(source: Column) -> Column:
    return ~source.isin(*UNRECORDED)


def why_not(source: Column) -> Column:
    """Why a source can't be reproduced key by key; '' where it can."""
    out = F.lit("")
    for name, what in UNRECORDED.items():
        out = F.when(source == name, f"seeded by {what}, which changes with every process and was not recorded").otherwise(out)
    return out


def keys_of(rows: DataFrame, key: list[str] = KEY) -> DataFrame:
    """The distinct keys without nulls."""
    return rows.where(" and ".join(f"`{k}` is not null" for k in key)).select(*key).distinct()


def key_diff(published: DataFrame, produced: DataFrame, key: list[str] = KEY) -> DataFrame:
    """key..., side ('missing' or 'extra'), n_published, n_produced: keys in one of the two only; the counts keep multiplicity."""
    count = lambda df, name: df.where(" and ".join(f"`{k}` is not null" for k in key)).groupBy(*key).agg(F.count(F.lit(1)).alias(name))
    both = count(published, "n_published").join(count(produced, "n_produced"), key, "full")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    side = F.when(F.col("n_produced") == 0, "missing").otherwise("extra").alias("side")
    return both.select(*key, zero("n_published"), zero("n_produced")).where("n_published = 0 or n_produced = 0").select(*key, side, "n_published", "n_produced")


def verdict(published: DataFrame, produced: DataFrame, bg_keep_rate: float, candidates: int, key: list[str] = KEY) -> DataFrame:
    """One row: n_published, n_produced, missing, extra, tolerance, exact, within, bag_exact (multiplicities agree too).

    The tolerance is three times the expected background draws, 10 at least.
    """
    tag = lambda df, a, b: df.where(" and ".join(f"`{k}` is not null" for k in key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).select(*key, (F.col("n") * a).alias("a"), (F.col("n") * b).alias("b"))
    both = tag(published, 1, 0).unionAll(tag(produced, 0, 1)).groupBy(*key).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    n = lambda c: F.count(F.when(c, 1))
    a, b = F.col("a"), F.col("b")
    s = both.agg(n(a > 0).alias("n_published"), n(b > 0).alias("n_produced"), n(b == 0).alias("missing"), n(a == 0).alias("extra"), n(a != b).alias("_bag_"))
    tolerance = F.lit(max(10, int(3 * bg_keep_rate * candidates)))
    diff = F.col("missing") + F.col("extra")
    return s.select("n_published", "n_produced", "missing", "extra", tolerance.alias("tolerance"), (diff == 0).alias("exact"), (diff <= tolerance).alias("within"), (F.col("_bag_") == 0).alias("bag_exact"))


def key_quality(rows: DataFrame, by: list[str], key: list[str] = KEY) -> DataFrame:
    """by..., n_rows, n_keys, present, unique, proof: what the key identifies in each source."""
    whole = F.concat_ws("", *(F.when(F.col(k).isNotNull(), "1").otherwise("0") for k in key)) == "1" * len(key)
    # keys first: a key that holds many rows leaves one row per task
    per = rows.groupBy(*by, *key).agg(F.count(F.lit(1)).alias("_n_"))
    q = per.groupBy(*by).agg(F.sum("_n_").alias("n_rows"), F.count(F.when(whole, 1)).alias("n_keys"))
    present, unique = F.col("n_keys") > 0, F.col("n_keys") == F.col("n_rows")
    proof = F.when(~present, "none").when(unique, "row-level").otherwise("key-set only")
    return q.withColumns({"present": present, "unique": present & unique, "proof": proof})


def tiers(quality: DataFrame) -> DataFrame:
    """Adds tier: 'tier-1' where a key is present, else 'tier-2'."""
    return quality.withColumn("tier", F.when(F.col("present"), "tier-1").otherwise("tier-2"))


def run_distances(runs: DataFrame, run: str = "run", key: list[str] = KEY) -> DataFrame:
    """run_a, run_b, symdiff for all pairs of runs: |A| + |B| - 2 |A ∩ B|.

    runs: run, key... A key is sent once, with the list of the runs that have it;
    runs are few, keys many.
    """
    per_key = runs.select(run, *key).distinct().groupBy(*key).agg(F.array_sort(F.collect_set(run)).alias("_r_"))
    pair = per_key.select(F.explode("_r_").alias("run_a"), "_r_").select("run_a", F.explode("_r_").alias("run_b"))
    n = pair.groupBy("run_a", "run_b").agg(F.count(F.lit(1)).alias("n"))  # the diagonal holds the sizes
    size = n.where("run_a = run_b").select(F.col("run_a").alias("run"), F.col("n").alias("size"))
    runs_a, runs_b = size.toDF("run_a", "size_a"), size.toDF("run_b", "size_b")
    every = runs_a.join(runs_b, F.col("run_a") < F.col("run_b"))  # pairs of runs, not of keys
    shared = n.where("run_a < run_b")
    return every.join(shared, ["run_a", "run_b"], "left").select("run_a", "run_b", (F.col("size_a") + F.col("size_b") - 2 * F.coalesce("n", F.lit(0))).alias("symdiff"))


def coverage(runs: DataFrame, published: DataFrame) -> DataFrame:
    """One row: covered, published_captures, coverage (1.0 where nothing is published)."""
    seen = runs.where("capture is not null").select("capture").distinct().withColumn("_s_", F.lit(1))
    j = published.where("capture is not null").select("capture").distinct().join(seen, "capture", "left")
    return j.agg(F.count("_s_").alias("covered"), F.count(F.lit(1)).alias("published_captures")).withColumn(
        "coverage", F.when(F.col("published_captures") == 0, 1.0).otherwise(F.col("covered") / F.col("published_captures"))
    )


def seed_envelope(runs: DataFrame, published: DataFrame, restrict: bool = False, key: list[str] = KEY) -> DataFrame:
    """One row: n_runs, floor, ceiling, gap, n_published, mean_produced, consistent, verdict, coverage.

    floor and ceiling are the least and largest distance between two runs, gap the
    least distance from a run to the published keys; restrict: published keys
    of captures that no run visited are left out (coverage tells how many those
    are). At least two runs are needed. Verdicts: 'strong' below the floor,
    'consistent' up to the ceiling, else 'exceeds'.
    """
    if len(runs.select("run").distinct().limit(2).collect()) < 2:
        raise ValueError("a seed envelope needs at least 2 runs")
    runs = runs.where(" and ".join(f"`{k}` is not null" for k in key))
    pub = keys_of(published, key)
    if restrict:
        pub = pub.join(runs.select("capture").distinct(), "capture", "left_semi")
    tagged = runs.select(F.concat(F.lit("r:"), F.col("run").cast("string")).alias("run"), *key).unionByName(pub.withColumn("run", F.lit("published")).select("run", *key))
    d = run_distances(tagged, "run", key)
    ours = d.where("run_a <> 'published' and run_b <> 'published'").agg(F.min("symdiff").alias("floor"), F.max("symdiff").alias("ceiling"))
    sizes = runs.select("run", *key).distinct().groupBy("run").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("n_runs"), F.avg("n").alias("mean_produced"), F.min("n").alias("_least_"))
    gap = d.where("run_a = 'published' or run_b = 'published'").agg(F.min("symdiff").alias("gap"))
    parts = [ours, sizes, gap, pub.agg(F.count(F.lit(1)).alias("n_published")), coverage(runs, published).select("coverage")]
    one = parts[0].withColumn("_k_", F.lit(1))
    for p in parts[1:]:  # single rows
        one = one.join(p.withColumn("_k_", F.lit(1)), "_k_")
    one = one.withColumn("gap", F.coalesce("gap", "_least_"))  # nothing published: the least run itself
    v = F.when(F.col("gap") < F.col("floor"), "strong").when(F.col("gap") <= F.col("ceiling"), "consistent").otherwise("exceeds")
    return one.select("n_runs", "floor", "ceiling", "gap", "n_published", "mean_produced", (F.col("gap") <= F.col("ceiling")).alias("consistent"), v.alias("verdict"), "coverage")


