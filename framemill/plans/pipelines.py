"""The producing pipelines as chains of operators, and queries that run them over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill import schema
from framemill.functions import arrays
from framemill.operators import balance, baselines, folds, names, pixels, selection
from framemill.plans.curation import WHOLE, drawn
from framemill.plans.curation import fold as fold_sql
from framemill.session import checkpointed, table

SHAPE = ["height", "width"]


def curated(pictures: DataFrame, spec: dict, source: list[str], unit: str, order: list[str], head: int = 10) -> DataFrame:
    """The generic run over pictures (source..., unit, order..., image): every picture after the head of its unit, with area, intensity and decision.

    Per unit and shape the first ``head`` pictures give the baseline and are used
    up. Pixels are read twice and never shuffled but for the heads; the fold sees
    numbers only. Metrics are of the picture as it came, the hash of the picture in
    channel order. A picture whose source, unit or shape is null belongs to no head:
    it has no baseline, so area and intensity are null and it passes; the fold takes
    null units as one unit, first in order.
    """
    keys = [*source, unit, *order]
    frames = pixels.grey_frames(pictures, [*keys, *SHAPE] if set(SHAPE) <= set(pictures.columns) else keys)
    group = [*source, unit, *(c for c in SHAPE if c in frames.columns)]
    kept = baselines.head_consumed(frames, group, order, "frame", head)
    m = kept.withColumn("m", arrays.contact(F.col("frame"), F.col("base"))).select(*keys, "m.area", "m.intensity")
    headless = pictures.where(" or ".join(f"`{c}` is null" for c in group)).select(*keys, F.lit(None).cast("int").alias("area"), F.lit(None).cast("double").alias("intensity"))
    m = m.unionByName(headless)
    m = m.withColumn("passing", arrays.passes(F.col("area"), F.col("intensity"), spec["a_min"], spec["i_min"]))
    hashes = pixels.measures(pictures, keys, spec["channel_mode"]).select(*keys, "phash")
    on = [F.col(f"m.{c}").eqNullSafe(F.col(f"h.{c}")) for c in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    both = m.alias("m").join(hashes.alias("h"), cond).select("m.*", "phash")
    return folds.curate(both, source, unit, [unit, *order], rate=spec["bg_keep_rate"], distance=spec["phash_dist"], lookback=spec["phash_lookback"], budget=spec["budget"])


def refiltered(frames: DataFrame, group: list[str], key: list[str], test: Column, column: str = "frame", n: int = 100, rate: float = 0.015, seed: int = 0, least: int = 1, zscore: bool = False, floor: float = 1.0) -> DataFrame:
    """Frames of a published table that pass ``test`` (an expression over area and intensity), and a stable draw of the others.

    The baseline is the median of n random frames per group; zscore: distances in
    population deviations of those frames. Frames of groups without a baseline stay.
    """
    chosen = baselines.random_n(frames, group, key, n, seed)
    chosen = baselines.at_least(chosen, group, least) if least > 1 else chosen
    chosen = checkpointed(chosen) if zscore else chosen
    bases = baselines.elementwise(chosen, group, column)
    m = baselines.with_base(frames, bases, group)
    if zscore:
        m = m.join(baselines.elementwise(chosen, group, column, "stddev_pop").withColumnRenamed("base", "std"), group, "left")
        value = arrays.zscore(F.col(column), F.col("base"), F.col("std"), floor)
    else:
        value = arrays.contact(F.col(column), F.col("base"))
    m = m.withColumn("m", value).select("*", "m.area", "m.intensity").drop("m")
    return selection.bernoulli(m, key, rate, seed, always=F.col("base").isNull() | test)


def reingested(rows: DataFrame, order: list[str], stride: int, file: str, target: int, kept: Column) -> DataFrame:
    """Every stride-th row, of the files before enough rows were kept; then an even cap at target of the kept."""
    r = selection.early_exit(selection.row_stride(rows, order, stride), file, target, kept)
    return selection.even_cap(r.where(kept), [], order, target)


def force_gated(rows: DataFrame, stem: str, key: list[str], least: float = 0.4, rate: float = 0.015, seed: int = 0) -> DataFrame:
    """Rows whose |f_z| reaches ``least`` and a stable draw of the others; indenter and its parameter from the stem, gel from the split."""
    kept = selection.bernoulli(rows, key, rate, seed, always=F.abs("f_z") >= least)
    s = names.stem_shape(F.col(stem))
    return kept.withColumns({"indenter": s["indenter"], "indenter_param": s["indenter_param"], "gel_variant": names.gel_by_split(F.col("split"))})


def deduped_and_capped(rows: DataFrame, unit: list[str], order: list[str], budget: int, distance: int = 4, lookback: int = 30) -> DataFrame:
    """Survivors of the windowed comparison per unit, strided down to the budget."""
    d = folds.dedupe(rows, unit, order, distance=distance, lookback=lookback)
    return selection.stride_cap(d.where("decision = 'kept'").drop("decision"), [], [*unit, *order], budget)


def composed(tables: list[DataFrame], order: list[str], per_sim: int, per_real: int, sim: int, real: int) -> DataFrame:
    """Sources as one corpus with buckets, capped per object, then per domain."""
    b = tables[0]
    for t in tables[1:]:
        b = b.unionByName(t, allowMissingColumns=True)
    return balance.domain_cap(balance.object_cap(balance.buckets(b), ["source", *order], per_sim, per_real), order, real, sim)


def peak_frames(frames: DataFrame, touch: list[str], key: list[str], a_min: float, i_min: float, k: int = 1, rate: float = 0.015, seed: int = 0, thresh: float = arrays.PIXEL_THRESH) -> DataFrame:
    """Per touch the k frames of highest intensity against the median of all its frames; an empty touch gives, at ``rate``, one random frame.

    The median holds a touch's frames per pixel; a touch is one clip.
    """
    m = baselines.with_base(frames, baselines.elementwise(frames, touch, "frame"), touch).withColumn("m", arrays.contact(F.col("frame"), F.col("base"), thresh))
    m = m.select(*touch, *key, "m.area", "m.intensity")
    score = F.when(F.col("area") >= a_min, F.col("intensity")).otherwise(0.0)
    return selection.peaks_or_fallback(m, touch, score, key, k, i_min, rate, seed)


def sequences(frames: DataFrame, sequence: str, order: list[str], a_min: float, i_min: float, rate: float, least: int = 10, head: int = 10, thresh: float = arrays.PIXEL_THRESH, shape: list[str] | None = None) -> DataFrame:
    """Frames of sequences of at least ``least``, against the median of their first ``head``, which are not used up; renumbered after filtering.

    shape: not-null columns that tell sizes of picture apart; each size of a
    sequence has its own first ``head``, and all its frames count and are numbered together.
    """
    group = [sequence, *(shape or [])]
    f = baselines.at_least(frames.where(F.col(sequence).isNotNull()), [sequence], least)
    m = baselines.with_base(f, baselines.elementwise(baselines.first_n(f, group, order, head), group, "frame"), group)
    m = m.withColumn("m", arrays.contact(F.col("frame"), F.col("base"), thresh)).select(*[c for c in frames.columns if c != "frame"], "m.area", "m.intensity")
    kept = selection.bernoulli(m, [sequence, *order], rate, always=arrays.passes(F.col("area"), F.col("intensity"), a_min, i_min))
    return selection.renumber(kept, sequence, order)


def contact_sample(frames: DataFrame, group: list[str], key: list[str], a_min: float, i_min: float, n: int = 40, scanned: int = 1200, seed: int = 0, thresh: float = arrays.PIXEL_THRESH) -> DataFrame:
    """n random frames in contact, out of ``scanned`` random frames, against the median of 30 per group."""
    bases = baselines.elementwise(baselines.random_n(frames, group, key, 30, seed), group, "frame")
    some = selection.hash_sample(frames, key, scanned, seed + 1)
    m = baselines.with_base(some, bases, group).withColumn("m", arrays.contact(F.col("frame"), F.col("base"), thresh)).select(*group, *key, "m.area", "m.intensity")
    return selection.hash_sample(m.where(arrays.passes(F.col("area"), F.col("intensity"), a_min, i_min)), key, n, seed + 2)


def _frames(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("label").alias("capture"), F.col("vec_id").alias("frame_idx"), F.transform("embedding", lambda v: v.cast("double") * 100).alias("frame"))


def _greys(spark: SparkSession, d: str, name: str, keep: list[str]) -> DataFrame:
    return pixels.grey_frames(table(spark, d, name), keep)


def pl_curate(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "make_parquet").select("source", "capture", "row_id", "image", "height", "width")
    spec = schema.settings({"domain": "real", "gel_variant": "mixed", "license_repo": "main", "i_min": 10, "a_min": 6})
    return curated(p, spec, ["source"], "capture", ["row_id"]).drop("phash").withColumn("intensity", F.round("intensity", 6))


def pl_refilter(spark: SparkSession, d: str) -> DataFrame:
    f = refiltered(_frames(spark, d), ["capture"], ["frame_idx"], (F.col("area") >= 20) & (F.col("intensity") >= 15.0), n=30)
    return f.select("capture", "frame_idx", "area", F.round("intensity", 6).alias("intensity"))


def pl_refilter_zscore(spark: SparkSession, d: str) -> DataFrame:
    f = refiltered(_frames(spark, d), ["capture"], ["frame_idx"], (F.col("area") >= 1) & (F.col("intensity") >= 3.2), n=30, zscore=True)
    return f.select("capture", "frame_idx", "area", F.round("intensity", 6).alias("intensity"))


def pl_reingest(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    order = ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    return reingested(rows, order, 2, "l_suppkey", 1000, F.col("l_quantity") > 25)


def pl_force(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "make_parquet").where("source = 'feats'").select("row_id", "capture", "split", "f_z")
    return force_gated(rows, "capture", ["row_id"], 5.0)


def pl_dedupe_cap(spark: SparkSession, d: str) -> DataFrame:
    h = _frames(spark, d).select("capture", "frame_idx", arrays.median_bits(F.col("frame")).alias("phash"))
    return deduped_and_capped(h, ["capture"], ["frame_idx"], 200, 20, 5).select("capture", "frame_idx", F.lpad(F.bin("phash"), 64, "0").alias("hash_bits"))


def pl_compose(spark: SparkSession, d: str) -> DataFrame:
    keep = ["row_id", "source", "side", "indenter", "split", "obj_name", "capture", "episode", "x_mm", "y_mm", "markered", "domain"]
    t = [table(spark, d, n) for n in ("make_parquet", "make_parquet_v2", "make_parquet_video")]
    c = composed([x.select(*[k for k in keep if k in x.columns]) for x in t], ["row_id"], 20, 40, 300, 600)
    return c.select("row_id", "source", "domain", "sensor", "object_id", "gel")


def pl_peaks(spark: SparkSession, d: str) -> DataFrame:
    return peak_frames(_frames(spark, d), ["capture"], ["frame_idx"], 20, 15.0, 3, 0.5, 1).withColumn("intensity", F.round("intensity", 6))


def pl_sequences(spark: SparkSession, d: str) -> DataFrame:
    f = _greys(spark, d, "make_parquet_video", ["sequence_id", "row_id", *SHAPE])
    f = f.select("sequence_id", "row_id", F.concat_ws("x", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SHAPE), F.size("frame").cast("string")).alias("shape"), "frame")
    return sequences(f, "sequence_id", ["row_id"], 6, 10, 0.015, shape=["shape"]).drop("shape").withColumn("intensity", F.round("intensity", 6))


def pl_contact_sample(spark: SparkSession, d: str) -> DataFrame:
    return contact_sample(_frames(spark, d), ["capture"], ["frame_idx"], 20, 15.0).withColumn("intensity", F.round("intensity", 6))


QUERIES = {f.__name__: f for f in (pl_curate, pl_refilter, pl_refilter_zscore, pl_reingest, pl_force, pl_dedupe_cap, pl_compose, pl_peaks, pl_sequences, pl_contact_sample)}
_CELLS = "cells as (select label as capture, vec_id as frame_idx, unnest(range(1, len(embedding) + 1)) as pos, cast(unnest(embedding) as double) * 100 as v from embeddings)"


def _bases(n: int | None, seed: int = 0) -> str:
    """SQL of the median and deviation of n random frames of each capture, or of all."""
    some = f" where (capture, frame_idx) in (select (capture, frame_idx) from (select label as capture, vec_id as frame_idx from embeddings) qualify row_number() over (partition by capture order by {drawn(seed, 'frame_idx')}, frame_idx) <= {n})" if n else ""
    return f"bases as (select capture, pos, median(v) as b, stddev_pop(v) as s from cells{some} group by all)"


def _met(far: str, least: float) -> str:
    return f"met as (select c.capture, c.frame_idx, cast(count(*) filter (where {far} > {least}) as int) as area, coalesce(avg({far}) filter (where {far} > {least}), 0.0) as intensity from cells c join bases using (capture, pos) group by all)"


_BITS = """mid as (select capture, frame_idx, quantile_disc(v, 0.5) filter (where pos > 1) as m from cells group by all),
  bits as (select capture, frame_idx, string_agg(case when v > m then '1' else '0' end, '' order by pos) as hash_bits from cells join mid using (capture, frame_idx) group by all),
  d as (select capture, frame_idx, cast(hash_bits as bit) as h from bits), rows as (select capture as g, row_number() over (partition by capture order by frame_idx) as rn, '' as unit, true as ok, h, capture, frame_idx, cast(null as bigint) as run from d)"""
_SHAPES = ", ".join(f"'{s}'" for s in names.SHAPES_LATER)
_GELS = " ".join(f"when '{k}' then '{v}'" for k, v in names.GEL_BY_SPLIT.items())

SQL: dict[str, str] = {
    "pl_refilter": f"""with {_CELLS}, {_bases(30)}, {_met('abs(v - b)', 10)}
  select capture, frame_idx, area, round(intensity, 6) as intensity from met where area >= 20 and intensity >= 15 or {drawn(0, 'frame_idx')} / {WHOLE} < 0.015""",
    "pl_refilter_zscore": f"""with {_CELLS}, {_bases(30)}, {_met('abs(v - b) / greatest(s, 1.0)', 3)}
  select capture, frame_idx, area, round(intensity, 6) as intensity from met where area >= 1 and intensity >= 3.2 or {drawn(0, 'frame_idx')} / {WHOLE} < 0.015""",
    "pl_reingest": """with p as (select *, row_number() over (order by l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 as p from lineitem), s as (select * from p where p % 2 = 0),
  f as (select l_suppkey, sum(case when l_quantity > 25 then 1 else 0 end) as n from s group by 1),
  b as (select l_suppkey, coalesce(sum(n) over (order by l_suppkey rows between unbounded preceding and 1 preceding), 0) as before from f),
  k as (select *, row_number() over (order by p) - 1 as q, count(*) over () as n from s where l_quantity > 25 and l_suppkey in (select l_suppkey from b where before <= 1.5 * 1000))
  select l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from k where n <= 1000 or q = n - 1 or exists (select 1 from range(0, 999) t(i) where floor(i * (cast(n - 1 as double) / 999.0)) = k.q)""",
    "pl_force": f"""with k as (select row_id, capture, split, f_z, string_split(capture, '_') as w from make_parquet where source = 'feats' and (abs(f_z) >= 5.0 or {drawn(0, 'row_id')} / {WHOLE} < 0.015)),
  p as (select *, list_position([lower(x) in ({_SHAPES}) for x in w], true) as place from k)
  select row_id, capture, split, f_z, case when place > 0 then lower(w[place]) else 'unknown' end as indenter, case when place > 0 then coalesce(w[place + 1], '') else '' end as indenter_param,
    coalesce(case split {_GELS} end, 'unknown') as gel_variant from p""",
    "pl_dedupe_cap": fold_sql(
        f"{_CELLS}, {_BITS}",
        """, k as (select f.capture, f.frame_idx, row_number() over (order by f.capture, f.frame_idx) - 1 as p, count(*) over () as n from f where rn > 0 and decision = 'kept')
  select capture, frame_idx, cast(hash_bits as varchar) as hash_bits from k join bits using (capture, frame_idx) where n <= 200 or exists (select 1 from range(0, 200) t(i) where floor(i * (cast(n as double) / 200.0)) = k.p)""",
        distance=20, lookback=5,
    ),
    "pl_peaks": f"""with {_CELLS}, {_bases(None)}, {_met('abs(v - b)', 10)}, sc as (select *, case when area >= 20 then intensity else 0.0 end as score from met),
  good as (select capture, frame_idx, area, intensity, false as fallback from sc where score >= 15 qualify row_number() over (partition by capture order by score desc, frame_idx) <= 3),
  empty as (select capture from sc group by capture having max(score) < 15 and {drawn(1, 'capture')} / {WHOLE} < 0.5)
  select capture, frame_idx, area, round(intensity, 6) as intensity, fallback from good union all
  select capture, frame_idx, area, round(intensity, 6), true from sc where capture in (select capture from empty) qualify row_number() over (partition by capture order by {drawn(2, 'capture', 'frame_idx')}, frame_idx) = 1""",
    "pl_contact_sample": f"""with {_CELLS}, {_bases(30)}, {_met('abs(v - b)', 10)},
  few as (select * from met order by {drawn(1, 'frame_idx')}, frame_idx limit 1200)
  select capture, frame_idx, area, round(intensity, 6) as intensity from few where area >= 20 and intensity >= 15 order by {drawn(2, 'frame_idx')}, frame_idx limit 40""",
}
