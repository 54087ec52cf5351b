"""Queries of the curation operators over the test tables, each with its SQL where SQL can say it.

Frames are the vectors of ``embeddings`` (capture = label, frame_idx = vec_id), so
contact metrics and hashes have an SQL counterpart; operators on real pictures run
over ``make_parquet`` and are tested against plain loops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framemill import schema
from framemill.functions import arrays
from framemill.operators import balance, baselines, folds, lookups, names, pixels, selection, stats, verify
from framemill.session import table
from framemill.sources import sinks

#: Thresholds on the scale of unit vectors.
PIXEL, A_MIN, I_MIN = 0.1, 20, 0.15

QUERIES: dict = {}
SQL: dict[str, str] = {}


def drawn(seed: int, *columns: str) -> str:
    """SQL of selection's and baselines' draws: a number in [0, 2 ** 60) from seed and columns."""
    return f"cast(concat('0x', substr(md5(concat_ws(':', '{seed}', {', '.join(columns)})), 1, 15)) as bigint)"


#: 2 ** 60 in SQL.
WHOLE = "1152921504606846976.0"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def r6(*columns: str):
    return [F.round(c, 6).alias(c) for c in columns]


def frames(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("label").alias("capture"), F.col("vec_id").alias("frame_idx"), F.col("embedding").alias("frame"))


def measured(spark: SparkSession, d: str) -> DataFrame:
    """capture, frame_idx, frame, area, intensity against the median of the capture's first 100 frames."""
    f = frames(spark, d)
    m = baselines.with_base(f, baselines.strategy("first_n", f, "frame", ["capture"], ["frame_idx"], 100), ["capture"])
    return m.withColumn("m", arrays.contact(F.col("frame"), F.col("base"), PIXEL)).select("capture", "frame_idx", "frame", "base", "m.area", "m.intensity")


# the frames of SQL: one row per value, and the metrics against the median of a group
_CELLS = "cells as (select label as capture, vec_id as frame_idx, unnest(range(1, len(embedding) + 1)) as pos, cast(unnest(embedding) as double) as v from embeddings)"
_METRICS = f"""{_CELLS},
  bases as (select capture, pos, median(v) as b from (select *, dense_rank() over (partition by capture order by frame_idx) as rn from cells) where rn <= 100 group by all),
  met as (select c.capture, c.frame_idx, cast(count(*) filter (where abs(v - b) > {PIXEL}) as int) as area,
      coalesce(avg(abs(v - b)) filter (where abs(v - b) > {PIXEL}), 0.0) as intensity, avg(abs(v - b)) as deformation
    from cells c join bases using (capture, pos) group by all)"""


@query(f"with {_METRICS} select capture, frame_idx, area, round(intensity, 6) as intensity from met where area >= {A_MIN} and intensity >= {I_MIN}")
def contact_filter(spark, d):
    m = measured(spark, d).where(arrays.passes(F.col("area"), F.col("intensity"), A_MIN, I_MIN))
    return m.select("capture", "frame_idx", "area", *r6("intensity"))


@query(
    f"""with {_CELLS}, n as (select *, dense_rank() over (partition by capture order by frame_idx) as rn from cells),
  bases as (select capture, pos, median(v) as b from n where rn <= 10 group by all having count(*) = 10),
  met as (select c.capture, c.frame_idx, cast(count(*) filter (where abs(v - b) > {PIXEL}) as int) as area, coalesce(avg(abs(v - b)) filter (where abs(v - b) > {PIXEL}), 0.0) as intensity
    from n c join bases using (capture, pos) where rn > 10 group by all)
  select capture, frame_idx, area, round(intensity, 6) as intensity from met where area >= {A_MIN} and intensity >= {I_MIN}"""
)
def contact_filter_head(spark, d):
    h = baselines.head_consumed(frames(spark, d), ["capture"], ["frame_idx"], "frame", 10)
    m = h.withColumn("m", arrays.contact(F.col("frame"), F.col("base"), PIXEL)).select("capture", "frame_idx", "m.area", "m.intensity")
    return m.where(arrays.passes(F.col("area"), F.col("intensity"), A_MIN, I_MIN)).select("capture", "frame_idx", "area", *r6("intensity"))


@query(
    f"""with {_CELLS}, bases as (select capture, pos, median(v) as b, greatest(stddev_pop(v), 0.05) as s from (select *, dense_rank() over (partition by capture order by frame_idx) as rn from cells) where rn <= 100 group by all),
  met as (select c.capture, c.frame_idx, cast(count(*) filter (where abs(v - b) / s > 1.5) as int) as area, coalesce(avg(abs(v - b) / s) filter (where abs(v - b) / s > 1.5), 0.0) as intensity
    from cells c join bases using (capture, pos) group by all)
  select capture, frame_idx, area, round(intensity, 6) as intensity from met where area >= 6 and intensity >= 1.8"""
)
def zscore_filter(spark, d):
    f = frames(spark, d)
    some = baselines.first_n(f, ["capture"], ["frame_idx"], 100)
    std = baselines.elementwise(some, ["capture"], "frame", "stddev_pop").withColumnRenamed("base", "std")
    m = f.join(baselines.elementwise(some, ["capture"], "frame"), "capture").join(std, "capture")
    m = m.withColumn("m", arrays.zscore(F.col("frame"), F.col("base"), F.col("std"), 0.05, 1.5)).select("capture", "frame_idx", "m.area", "m.intensity")
    return m.where("area >= 6 and intensity >= 1.8").select("capture", "frame_idx", "area", *r6("intensity"))


@query(
    f"""with {_METRICS}, st as (select a.capture, a.frame_idx, avg(abs(a.v - p.v)) as step from cells a
    join (select capture, frame_idx, lead(frame_idx) over (partition by capture order by frame_idx) as nxt from (select distinct capture, frame_idx from cells)) k on k.capture = a.capture and k.nxt = a.frame_idx
    join cells p on p.capture = a.capture and p.frame_idx = k.frame_idx and p.pos = a.pos group by all)
  select m.capture, count(*) as n, round(avg(step), 6) as dynamism, round(avg(deformation), 6) as mean_deformation, round(median(deformation), 6) as median_deformation,
    round(avg(case when deformation < 0.1 then 1.0 else 0.0 end), 6) as empty_share
  from met m left join st using (capture, frame_idx) group by m.capture having count(*) >= 3"""
)
def mean_deformation_probe(spark, d):
    m = measured(spark, d).withColumn("deformation", arrays.deformation(F.col("frame"), F.col("base"))).drop("base")
    p = stats.dynamism(m, ["capture"], ["frame_idx"], arrays.deformation(F.col("frame"), F.col("before.frame")), "deformation", 3, 0.1)
    return p.select("capture", "n", *r6("dynamism", "mean_deformation", "median_deformation", "empty_share"))


_BITS = f"""{_CELLS}, mid as (select capture, frame_idx, quantile_disc(v, 0.5) filter (where pos > 1) as m from cells group by all),
  bits as (select capture, frame_idx, string_agg(case when v > m then '1' else '0' end, '' order by pos) as hash_bits from cells join mid using (capture, frame_idx) group by all)"""


@query(f"with {_BITS} select capture, frame_idx, hash_bits from bits")
def sign_phash(spark, d):
    return frames(spark, d).select("capture", "frame_idx", F.lpad(F.bin(arrays.median_bits(F.col("frame"))), 64, "0").alias("hash_bits"))


@query(
    f"""with {_BITS}, h as (select *, row_number() over (partition by capture order by frame_idx) as rn from bits)
  select a.capture, a.frame_idx as frame_a, b.frame_idx as frame_b, cast(len(list_filter(range(1, 65), lambda x: a.hash_bits[x] <> b.hash_bits[x])) as int) as distance
  from h a join h b on a.capture = b.capture and b.rn between a.rn + 1 and a.rn + 3 where len(list_filter(range(1, 65), lambda x: a.hash_bits[x] <> b.hash_bits[x])) <= 24"""
)
def phash_pairs(spark, d):
    """Pairs of a capture's frames at most three places apart and at most 24 bits: bounded by the places, not by the capture."""
    h = frames(spark, d).select("capture", "frame_idx", arrays.median_bits(F.col("frame")).alias("h"))
    w = Window.partitionBy("capture").orderBy("frame_idx")
    ahead = F.array(*(F.lead(F.struct("frame_idx", "h"), k).over(w) for k in (1, 2, 3)))
    p = h.withColumn("ahead", ahead).select("capture", F.col("frame_idx").alias("frame_a"), "h", F.explode("ahead").alias("b")).where("b is not null")
    return p.select("capture", "frame_a", F.col("b.frame_idx").alias("frame_b"), arrays.hamming(F.col("h"), F.col("b.h")).alias("distance")).where("distance <= 24")


_DECIDED = f"""{_METRICS}, {_BITS.removeprefix(_CELLS + ', ')},
  d as (select capture, frame_idx, area >= {A_MIN} and round(intensity, 6) >= 0 and intensity >= {I_MIN} as ok, cast(hash_bits as bit) as h from met join bits using (capture, frame_idx))"""


def fold(rows: str, out: str, rate: float | None = None, distance: int | None = None, lookback: int = 30, budget: int | None = None, every: int | None = None) -> str:
    """SQL that walks rows (g, rn from 1, unit, ok, h, ...) one by one per g, as folds.curate does."""
    say = " ".join(
        [
            f"when kept >= {budget} then 'over_budget'" if budget is not None else "",
            "when n1 < taken + stride then 'strided'" if every is not None else "",
            f"when not ok and empty >= {rate} * greatest(kept, 1) then 'background'" if rate is not None else "",
            f"when len(list_filter(seen1, lambda x: bit_count(xor(x, h)) <= {distance})) > 0 then 'duplicate'" if distance is not None else "",
        ]
    )
    grow = f"case when said in ('kept', 'kept_empty') and (kept + 1) % {every} = 0 and kept + 1 > 0.95 * {budget} then stride * 1.2 else stride end" if every is not None else "stride"
    takes = "said in ('kept', 'kept_empty')"
    return f"""with recursive {rows},
  f(g, rn, n, taken, stride, kept, empty, unit, seen, decision, capture, frame_idx, run) as (
    select distinct g, cast(0 as bigint), 0, cast(0 as double), cast(1 as double), 0, 0, cast(null as varchar), cast([] as bit[]), '', cast(null as int), cast(null as bigint), cast(null as bigint) from rows
    union all
    select g, rn, n1, case when said in ('over_budget', 'strided') then taken else taken + stride end, {grow}, kept + cast({takes} as int), empty + cast(said = 'kept_empty' as int), unit,
      case when {takes} then list_append(seen1, h)[-{lookback}:] else seen1 end, said, capture, frame_idx, run
    from (select *, case {say} when ok then 'kept' else 'kept_empty' end as said
      from (select r.*, f.n + 1 as n1, f.taken, f.stride, f.kept, f.empty, case when r.unit is distinct from f.unit then cast([] as bit[]) else f.seen end as seen1 from f join rows r on r.g = f.g and r.rn = f.rn + 1)))
  {out}"""


_BY_CAPTURE = f"{_DECIDED}, rows as (select capture as g, row_number() over (partition by capture order by frame_idx) as rn, '' as unit, true as ok, h, capture, frame_idx, cast(null as bigint) as run from d)"
_BY_RUN = f"""{_DECIDED}, c as (select *, case when capture is not distinct from lag(capture) over (order by frame_idx) and row_number() over (order by frame_idx) > 1 then 0 else 1 end as c from d),
  r as (select *, cast(sum(c) over (order by frame_idx rows unbounded preceding) as bigint) as run from c),
  rows as (select run as g, row_number() over (partition by run order by frame_idx) as rn, '' as unit, true as ok, h, capture, frame_idx, run from r)"""
_BY_SOURCE = f"{_DECIDED}, rows as (select 'embeddings' as g, row_number() over (order by capture, frame_idx) as rn, cast(capture as varchar) as unit, ok, h, capture, frame_idx, cast(null as bigint) as run from d)"
_ROWS = "select capture, frame_idx, decision from f where rn > 0"


def _decided(spark, d):
    m = measured(spark, d).withColumns({"source": F.lit("embeddings"), "passing": arrays.passes(F.col("area"), F.col("intensity"), A_MIN, I_MIN), "phash": arrays.median_bits(F.col("frame"))})
    return m.select("source", "capture", "frame_idx", "area", *r6("intensity"), "passing", "phash")


@query(fold(_BY_CAPTURE, _ROWS, distance=20, lookback=5))
def window_dedupe(spark, d):
    return folds.dedupe(_decided(spark, d), ["capture"], ["frame_idx"], distance=20, lookback=5).select("capture", "frame_idx", "decision")


@query(fold(_BY_RUN, "select frame_idx, run, decision from f where rn > 0", distance=20, lookback=5))
def run_dedupe(spark, d):
    """A new unit at every change of capture along the order of frames."""
    m = _decided(spark, d)
    return folds.dedupe(selection.run_ids(m, "capture", ["frame_idx"], ["source"]), ["source", "run"], ["frame_idx"], distance=20, lookback=5).select("frame_idx", "run", "decision")


@query(fold(_BY_SOURCE, _ROWS, 0.1, 18, 5, 400))
def curate_full(spark, d):
    return folds.curate(_decided(spark, d), ["source"], "capture", ["capture", "frame_idx"], rate=0.1, distance=18, lookback=5, budget=400).select("capture", "frame_idx", "decision")


@query(
    fold(
        _BY_SOURCE,
        """select g as source, count(*) filter (where decision <> 'over_budget') as n_seen, count(*) filter (where decision like 'kept%') as n_kept, count(*) filter (where decision = 'kept_empty') as n_empty_kept,
    count(*) filter (where decision = 'duplicate') as n_dup_dropped from f where rn > 0 group by g""",
        0.1, 18, 5, 400,
    )
)
def run_counters(spark, d):
    return folds.counters(folds.curate(_decided(spark, d), ["source"], "capture", ["capture", "frame_idx"], rate=0.1, distance=18, lookback=5, budget=400), ["source"])


@query(fold(_BY_SOURCE, _ROWS, 0.1, 18, 5, 150, 20))
def curate_strided(spark, d):
    """The fold with the live stride among its rules."""
    return folds.curate(_decided(spark, d), ["source"], "capture", ["capture", "frame_idx"], rate=0.1, distance=18, lookback=5, budget=150, every=20).select("capture", "frame_idx", "decision")


@query(fold(_BY_SOURCE.replace("ok, h, capture", "true as ok, h, capture"), _ROWS, budget=300, every=50))
def live_stride(spark, d):
    return folds.live_stride(_decided(spark, d), ["source"], ["capture", "frame_idx"], 300, 50).select("capture", "frame_idx", "decision")


@query("select event_id, user_id, value from events where cast(concat('0x', substr(md5(concat('s1:', cast(event_id as varchar))), 1, 13)) as bigint) / 4503599627370496.0 < 0.3")
def bernoulli_keep(spark, d):
    return table(spark, d, "events").where(selection.bernoulli_md5(F.col("event_id"), 0.3, "s1:")).select("event_id", "user_id", "value")


@query(f"select event_id, event_type from events where event_type = 'purchase' or {drawn(7, 'event_id')} / {WHOLE} < 0.015")
def bernoulli_stable(spark, d):
    return selection.bernoulli(table(spark, d, "events"), ["event_id"], 0.015, 7, always=F.col("event_type") == "purchase").select("event_id", "event_type")


@query()
def bernoulli_drawn(spark, d):
    return selection.bernoulli_drawn(table(spark, d, "events").select("event_id", "value"), ["event_id"], F.col("value") < 50, 0.1, 0)


@query(
    """with p as (select *, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 as p, count(*) over (partition by l_suppkey) as n from lineitem)
  select l_suppkey, l_orderkey, l_linenumber from p where n <= 40 or p = n - 1 or exists (select 1 from range(0, 39) t(i) where floor(i * (cast(n - 1 as double) / 39.0)) = p.p)"""
)
def linspace_cap(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return selection.even_cap(rows, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"], 40).select("l_suppkey", "l_orderkey", "l_linenumber")


@query(
    """with p as (select *, row_number() over (partition by user_id order by event_id) - 1 as p, count(*) over (partition by user_id) as n from events)
  select user_id, event_id from p where n <= 7 or exists (select 1 from range(0, 7) t(i) where floor(i * (cast(n as double) / 7.0)) = p.p)"""
)
def stride_cap(spark, d):
    return selection.stride_cap(table(spark, d, "events").select("user_id", "event_id"), ["user_id"], ["event_id"], 7)


@query("select event_id from (select event_id, row_number() over (order by event_id) - 1 as p from events) where p % 3 = 0")
def row_stride(spark, d):
    return selection.row_stride(table(spark, d, "events").select("event_id"), ["event_id"], 3)


@query("select source, count(*) as n, cast(case when count(*) * 5.0 * 0.3 <= 40 then 1 else greatest(1, floor(count(*) * 5.0 * 0.3 / 40)) end as bigint) as stride from make_parquet_v2 group by source")
def auto_stride(spark, d):
    n = table(spark, d, "make_parquet_v2").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("stride", selection.auto_stride(F.col("n"), F.lit(5.0), F.lit(0.3), F.lit(40)))


@query(
    """with f as (select l_suppkey, sum(case when l_quantity > 25 then 1 else 0 end) as n from lineitem group by 1),
  b as (select l_suppkey, coalesce(sum(n) over (order by l_suppkey rows between unbounded preceding and 1 preceding), 0) as before from f)
  select l_suppkey, count(*) as n from lineitem where l_suppkey in (select l_suppkey from b where before <= 1.5 * 1000) and l_quantity > 25 group by 1"""
)
def early_exit_cap(spark, d):
    kept = F.col("l_quantity") > 25
    return selection.early_exit(table(spark, d, "lineitem").select("l_suppkey", "l_quantity"), "l_suppkey", 1000, kept).where(kept).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("select user_id, event_id, value from (select *, row_number() over (partition by user_id order by value desc, event_id desc) as k from events) where k = 1 and value >= 60")
def peak_pick(spark, d):
    return selection.peak(table(spark, d, "events").select("user_id", "event_id", "value"), ["user_id"], F.col("value"), "event_id", 60)


@query("select user_id, event_id, value, cast(k as int) as rank from (select *, row_number() over (partition by user_id order by value desc, event_id) as k from events) where k <= 3")
def top_k_per_group(spark, d):
    return selection.top_k(table(spark, d, "events").select("user_id", "event_id", "value"), ["user_id"], F.col("value"), ["event_id"], 3)


@query(
    f"""with good as (select user_id, event_id, value, false as fallback from events where value >= 120 qualify row_number() over (partition by user_id order by value desc, event_id) <= 2),
  empty as (select user_id from events group by user_id having coalesce(max(value), -1e300) < 120 and {drawn(5, 'user_id')} / {WHOLE} < 0.3)
  select * from good union all select user_id, event_id, value, true from events where user_id in (select user_id from empty) qualify row_number() over (partition by user_id order by {drawn(6, 'user_id', 'event_id')}, event_id) = 1"""
)
def peaks_or_fallback(spark, d):
    return selection.peaks_or_fallback(table(spark, d, "events").select("user_id", "event_id", "value"), ["user_id"], F.col("value"), ["event_id"], 2, 120, 0.3, 5)


@query("select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) - 1 as frame_in_seq, count(*) over (partition by user_id) as sequence_length from events")
def sequence_number(spark, d):
    return selection.renumber(table(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", ["ts", "event_id"]).drop("ts")


@query(
    """with c as (select *, case when event_type = lag(event_type) over w then 0 else 1 end as c from events window w as (partition by user_id order by ts, event_id))
  select user_id, event_id, event_type, cast(sum(c) over (partition by user_id order by ts, event_id rows unbounded preceding) as bigint) as run from c"""
)
def gaps_islands(spark, d):
    return selection.run_ids(table(spark, d, "events").select("user_id", "event_id", "ts", "event_type"), "event_type", ["ts", "event_id"], ["user_id"]).drop("ts")


@query(
    """with p as (select user_id, event_id, row_number() over (partition by user_id order by event_id) - 1 as p, count(*) over (partition by user_id) as n from events), k as (select *, greatest(1, n // 5) as k from p)
  select user_id, event_id from k where p % k = 0 and p / k < 5"""
)
def every_kth(spark, d):
    return selection.every_kth(table(spark, d, "events").select("user_id", "event_id"), ["user_id"], ["event_id"], 5)


@query("select l_suppkey, l_orderkey, l_linenumber from (select *, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_quantity) as k from lineitem) where k = 1 order by l_orderkey, l_linenumber, l_partkey, l_quantity limit 16")
def first_per_key(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return selection.first_per_key(rows, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"], 16).select("l_suppkey", "l_orderkey", "l_linenumber")


@query("select user_id, event_id from (select *, row_number() over (partition by user_id order by event_id) as k from events) where k <= 4 order by user_id, event_id limit 300")
def probe_cap(spark, d):
    return selection.probe_cap(table(spark, d, "events").select("user_id", "event_id"), ["user_id"], ["event_id"], 4, 300)


@query("select event_id from (select event_id, row_number() over (order by event_id) - 1 as p from events) where p % 16 = 0 and p < 16 * 500")
def systematic_sample(spark, d):
    return selection.systematic(table(spark, d, "events").select("event_id"), ["event_id"], 500, 8000)


@query(f"select row_id, source from make_parquet order by {drawn(3, 'row_id')}, row_id limit 100")
def hash_sample(spark, d):
    return selection.hash_sample(table(spark, d, "make_parquet").select("row_id", "source"), ["row_id"], 100, 3)


@query("select event_id, value from events where value is not null order by abs(value - 40.0), event_id limit 50")
def nearest_to(spark, d):
    return selection.nearest(table(spark, d, "events").select("event_id", "value").where("value is not null"), F.col("value"), 40.0, ["event_id"], 50)


@query(
    """with iv as (select user_id, min(epoch(ts)) as s, min(epoch(ts)) + 86400.0 * 5 as e from events group by 1)
  select v.event_id, v.user_id from events v join iv on iv.user_id = v.user_id and epoch(v.ts) between s and e"""
)
def touch_window(spark, d):
    p = table(spark, d, "events").select("event_id", "user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    iv = p.groupBy("user_id").agg(F.min("at").alias("start"), (F.min("at") + 86400.0 * 5).alias("end"))
    return lookups.in_intervals(p, iv, "user_id", "at", "start", "end", 86400.0).select("event_id", "user_id")


@query(
    """with e as (select vec_id, embedding, list_filter(range(0, len(embedding)), lambda i: embedding[i + 1] between 0.1 and 0.12) as inside from embeddings)
  select vec_id, cast(case when len(inside) = 0 then len(embedding) else len(inside) end as int) as n, cast(case when len(inside) = 0 then 0 else inside[1] end as int) as first from e"""
)
def touch_positions(spark, d):
    """Positions of a nested list within an interval, all of them where none falls inside."""
    at = selection.in_window(F.col("embedding"), F.lit(0.1).cast("float"), F.lit(0.12).cast("float"))
    return table(spark, d, "embeddings").withColumn("_w_", at).select("vec_id", F.size("_w_").alias("n"), F.get("_w_", 0).alias("first"))


_OPS = [("strict", 40.0, 0.2), ("balanced", 25.0, 0.16), ("lenient", 10.0, 0.12), ("area_only", 30.0, 0.0), ("intensity_only", 0.0, 0.18)]


@query(f"with {_METRICS}, ops(op, a, i) as (values {', '.join(map(str, _OPS))}) select op, count(*) as n, count(*) filter (where area >= a and intensity >= i) as kept, round(count(*) filter (where area >= a and intensity >= i) / count(*), 6) as share from met, ops group by op")
def op_sweep(spark, d):
    return lookups.operating_points(measured(spark, d), _OPS, []).select("op", "n", "kept", *r6("share"))


@query(f"with {_METRICS}, t(tau) as (values (0.08::double), (0.1::double), (0.12::double)) select tau, count(*) as n, count(*) filter (where deformation >= tau) as reached, count(*) filter (where deformation >= tau and deformation < tau * 1.4) as in_band from met, t group by tau")
def tau_sweep(spark, d):
    m = measured(spark, d)
    return lookups.threshold_sweep(m, arrays.deformation(F.col("frame"), F.col("base")), [0.08, 0.1, 0.12])


@query(
    """select r.row_id, v.x_mm, coalesce(v.y_mm, cast(0 as float)) as y_mm from make_parquet r left join (select capture, min(x_mm) as x_mm, min(y_mm) as y_mm from make_parquet_v2 where x_mm is not null and y_mm is not null group by capture) v on v.capture = r.capture"""
)
def pose_lookup(spark, d):
    v = table(spark, d, "make_parquet_v2").where("x_mm is not null and y_mm is not null").groupBy("capture").agg(F.min("x_mm").alias("px"), F.min("y_mm").alias("py"))
    rows = table(spark, d, "make_parquet").select("row_id", "capture")
    out = lookups.with_poses(rows, v.select("capture", F.col("px").alias("x_mm")), ["capture"], ["x_mm"])
    return lookups.with_annotations(out, v.select("capture", F.col("py").alias("y_mm")), "capture", ["y_mm"]).select("row_id", "x_mm", "y_mm")


@query("select r.row_id, coalesce(f.markered, false) as markered from make_parquet r left join (select capture, bool_or(coalesce(markered, false)) as markered from runner group by 1) f using (capture)")
def marker_lookup(spark, d):
    return lookups.with_flag(table(spark, d, "make_parquet").select("row_id", "capture"), table(spark, d, "runner").select("capture", "markered"), "capture", "markered").select("row_id", "markered")


@query(
    """with l as (select distinct capture from make_parquet where split = 'test' and capture is not null)
  select row_id, case when capture in (select capture from l) or obj_name in (select capture from l) then 'test' else 'train' end as split from make_parquet"""
)
def split_flag(spark, d):
    m = table(spark, d, "make_parquet")
    return lookups.split_flag(m.select("row_id", "capture", "obj_name"), m.where("split = 'test'").select(F.col("capture").alias("path")), ["capture", "obj_name"]).select("row_id", "split")


_BUCKETS = """b as (select row_id, source, coalesce(nullif(domain, ''), case when starts_with(source, 'sim_') then 'sim' else 'real' end) as domain,
  case when source in ('fota_labeled', 'fota_unlabeled') then concat('mini_fota_', coalesce(nullif(side, ''), 'unk'))
    when source = 'feats' then case when starts_with(split, 'test_diff_sensor_new_gel') then 'mini_feats_new_gel' when starts_with(split, 'test_diff_sensor_old_gel') then 'mini_feats_old_sensor' else 'mini_feats_main' end
    when source = 'gelslam' then 'mini_gelslam' when source = 'tactile_tracking' then 'mini_tracking' when source = 'real_tactile_mnist' then 'mini_rtm' when source = 'feelanyforce' then 'mini_feelanyforce'
    when source = 'threedcal' then 'mini_threedcal' when source = 'unit' then 'mini_unit' when source = 'tacquad' then 'mini_tacquad' when source in ('sim_tactile_mnist', 'sim_starstruck') then 'sim_taxim_mini'
    when source = 'sparsh' then case when coalesce(indenter, '') = '' then 'mini_sparsh' else concat('mini_sparsh_', indenter) end else 'mini_' || source end as sensor,
  case when source in ('fota_labeled', 'fota_unlabeled') then concat(coalesce(obj_name, 'None'), '/', coalesce(capture, ''))
    when source = 'threedcal' then case when x_mm is null or y_mm is null then 'sphere/unknown' else format('sphere/x={:.1f}_y={:.1f}', cast(x_mm as double), cast(y_mm as double)) end
    when source = 'feats' then concat(coalesce(nullif(indenter, ''), nullif(obj_name, ''), 'unknown'), '_', coalesce(split, ''))
    when source = 'real_tactile_mnist' then concat('digit_', coalesce(obj_name, 'None'), '/ep_', coalesce(nullif(episode, ''), 'unk'))
    when source = 'sim_tactile_mnist' then concat(coalesce(obj_name, 'None'), '/ep_', coalesce(nullif(episode, ''), 'unk')) when source = 'sim_starstruck' then concat('starstruck/ep_', coalesce(nullif(episode, ''), 'unk'))
    when source = 'tacquad' then concat(coalesce(obj_name, 'None'), '/', coalesce(split, 'None')) when source = 'sparsh' then coalesce(nullif(indenter, ''), nullif(obj_name, ''), 'unk')
    else coalesce(nullif(obj_name, ''), 'unknown') end as object_id,
  case when markered then 'markered' else 'markerless' end as gel, split, capture from make_parquet_v2)"""


def _bucketed(spark, d):
    return balance.buckets(table(spark, d, "make_parquet_v2").drop("image"))


@query(f"with {_BUCKETS} select row_id, domain, sensor, object_id, gel from b")
def corpus_buckets(spark, d):
    return _bucketed(spark, d).select("row_id", "domain", "sensor", "object_id", "gel")


_EVEN = "{n} <= {t} or ({t} = 1 and p = 0) or ({t} > 1 and (p = {n} - 1 or exists (select 1 from range(0, {t} - 1) g(i) where floor(i * (cast({n} - 1 as double) / cast({t} - 1 as double))) = p)))"


@query(
    f"""with {_BUCKETS}, q as (select *, row_number() over (partition by domain, object_id order by source, row_id) - 1 as p, count(*) over (partition by domain, object_id) as n, case when domain = 'sim' then 3 else 6 end as t from b)
  select row_id, domain, object_id from q where {_EVEN.format(n='n', t='t')}"""
)
def object_cap(spark, d):
    return balance.object_cap(_bucketed(spark, d).select("row_id", "source", "domain", "object_id"), ["source", "row_id"], 3, 6).select("row_id", "domain", "object_id")


@query(
    f"""with {_BUCKETS}, f as (select source, arg_min(domain, row_id) as dom, count(*) as n from b group by source),
  t as (select source, n, case when sum(n) over (partition by dom) > (case when dom = 'sim' then 150 else 300 end)
     then greatest(1, cast(round_even(n * ((case when dom = 'sim' then 150 else 300 end)::double / sum(n) over (partition by dom)), 0) as bigint)) else n end as t from f),
  q as (select b.row_id, b.source, t.n, t.t, row_number() over (partition by b.source order by row_id) - 1 as p from b join t on t.source = b.source)
  select row_id, source from q where {_EVEN.format(n='n', t='t')}"""
)
def domain_cap(spark, d):
    return balance.domain_cap(_bucketed(spark, d).select("row_id", "source", "domain"), ["row_id"], 300, 150).select("row_id", "source")


@query(
    f"""with q as (select row_id, split, capture, row_number() over (partition by split, capture order by row_id) - 1 as p, count(*) over (partition by split, capture) as n, case split when 'train' then 8 when 'val' then 2 else 1000000 end as t from make_parquet)
  select row_id, split, capture from q where {_EVEN.format(n='n', t='t')}"""
)
def capture_cap(spark, d):
    return balance.capture_cap(table(spark, d, "make_parquet").select("row_id", "split", "capture"), ["row_id"], {"train": 8, "val": 2})


_AXES = [["domain"], ["sensor"], ["gel"], ["source"], ["object_id"], ["domain", "gel"], ["domain", "sensor", "object_id", "gel"]]
_AXES_SQL = " union all ".join(
    f"select '{'*'.join(a)}' as axis, concat_ws('/', {', '.join(f'coalesce({c}, chr(8709))' for c in a)}) as bucket, count(*) as n from b group by all" for a in _AXES
)


@query(f"with {_BUCKETS} {_AXES_SQL}")
def balance_axes(spark, d):
    return balance.axis_counts(_bucketed(spark, d), _AXES)


@query(
    f"""with {_BUCKETS}, c as ({_AXES_SQL}), p as (select *, n / sum(n) over (partition by axis) as p from c)
  select axis, count(*) as buckets, cast(sum(n) as bigint) as rows, round(case when count(*) > 1 then -sum(p * ln(p)) / ln(count(*)) else 1.0 end, 6) as entropy, round(pow(sum(n), 2) / sum(n * n), 6) as ess from p group by axis"""
)
def balance_score(spark, d):
    return balance.scores(balance.axis_counts(_bucketed(spark, d), _AXES)).select("axis", "buckets", "rows", *r6("entropy", "ess"))


@query(
    """with c as (select capture, count(*) as n from runner where capture is not null group by 1), k as (select *, row_number() over (order by n desc, capture) as k from c),
  u as (select capture, n from k where k <= 8 union all select concat('(', cast(count(*) as varchar), ' more)'), cast(sum(n) as bigint) from k where k > 8 having count(*) > 0)
  select capture, n, round(n / sum(n) over (), 6) as share from u"""
)
def topk_tail(spark, d):
    c = table(spark, d, "runner").where("capture is not null").groupBy("capture").agg(F.count(F.lit(1)).alias("n"))
    return balance.top_and_tail(c, "capture", "n", 8).select("capture", "n", *r6("share"))


_RANGED = ["x_mm", "y_mm", "z_mm", "f_z"]


@query(" union all ".join(f"select source, '{c}' as \"column\", count({c}) as n, cast(min({c}) as double) as low, cast(max({c}) as double) as high, round(avg(cast({c} as double)), 5) as mean, round(stddev_pop(cast({c} as double)), 5) as deviation from make_parquet group by source" for c in _RANGED))
def ranges(spark, d):
    return balance.ranges(table(spark, d, "make_parquet"), ["source"], _RANGED).select("source", "column", "n", "low", "high", F.round("mean", 5).alias("mean"), F.round("deviation", 5).alias("deviation"))


@query("with c as (select indenter, coalesce(indenter_param, '') as i, count(*) as n from make_parquet group by all) select indenter, string_agg(concat(i, '=', cast(n as varchar)), ',' order by i) as counts from c group by indenter")
def nested_counts(spark, d):
    n = balance.nested_counts(table(spark, d, "make_parquet"), "indenter", "indenter_param")
    return n.select("indenter", F.concat_ws(",", F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))).alias("counts"))


@query("select source, count(*) filter (where markered) as \"true\", count(*) filter (where not markered) as \"false\", count(*) filter (where markered is null) as other from make_parquet_v2 group by source")
def markered_mix(spark, d):
    return balance.mix(table(spark, d, "make_parquet_v2"), "source", "markered", ["true", "false"])


@query("select l_returnflag, cast(least(floor(l_extendedprice / 2000.0), 59) as int) as bin, count(*) as n from lineitem where l_extendedprice between 0 and 120000 group by all")
def hist_1d(spark, d):
    return stats.histogram(table(spark, d, "lineitem"), ["l_returnflag"], F.col("l_extendedprice"), 0.0, 2000.0, 60)


@query("select cast(floor(cast(x_mm as double) / 0.5) as bigint) as x_cell, cast(floor(cast(y_mm as double) / 0.5) as bigint) as y_cell, count(*) as n from make_parquet where x_mm is not null and y_mm is not null group by all")
def hist_2d(spark, d):
    return stats.grid(table(spark, d, "make_parquet"), F.col("x_mm").cast("double"), F.col("y_mm").cast("double"), 0.5)


@query("select count(distinct (round_even(cast(x_mm as double), 1), round_even(cast(y_mm as double), 1))) as n_pairs from make_parquet where x_mm is not null and y_mm is not null")
def distinct_pairs(spark, d):
    return stats.distinct_pairs(table(spark, d, "make_parquet"), "x_mm", "y_mm")


@query(" union all ".join(f"select event_type, cast({q} as double) as level, round(quantile_cont(value, {q}), 6) as value from events group by event_type" for q in stats.LEVELS))
def percentiles(spark, d):
    return stats.percentiles(table(spark, d, "events"), ["event_type"], "value").select("event_type", "level", *r6("value"))


@query("select source, count(*) filter (where area is not null and intensity is not null) as n, round(corr(cast(area as double), cast(intensity as double)), 6) as r from runner group by source")
def correlation(spark, d):
    return stats.correlation(table(spark, d, "runner"), ["source"], "area", "intensity").select("source", "n", *r6("r"))


@query(
    """with s as (select source, count(*) as n, min(intensity::double) as low, quantile_cont(intensity::double, 0.01) as p01, quantile_cont(intensity::double, 0.05) as p05 from runner where intensity is not null group by source)
  select source, n, round(low, 5) as low, round(p01, 5) as p01, round(p05, 5) as p05, case when p05 - p01 <= greatest(1.0, 0.1 * p01) and p01 > low + 0.5 then format('likely i_min = {:.1f}', p01)
    when p05 - p01 <= greatest(1.0, 0.1 * p01) then format('likely i_min = {:.1f} (no bg contamination detected)', p01) else 'ambiguous' end as verdict from s"""
)
def imin_estimate(spark, d):
    e = stats.threshold_estimate(table(spark, d, "runner"), ["source"], "intensity")
    return e.select("source", "n", *(F.round(c, 5).alias(c) for c in ("low", "p01", "p05")), "verdict")


@query(
    f"""with {_METRICS}, q as (select capture, quantile_cont(deformation, 0.25) as p25, quantile_cont(intensity * 100, 0.25) filter (where intensity > 0) as iq from met group by capture),
  l as (select m.capture, count(*) as n_background, count(*) filter (where intensity > 0) as nz, quantile_cont(intensity * 100, 0.99) filter (where intensity > 0) as bg_p99 from met m join q using (capture) where deformation < p25 group by m.capture)
  select q.capture, n_background, round(p25, 6) as p25, round(bg_p99, 6) as bg_p99, cast(greatest(case when nz >= 10 then round_even(bg_p99, 0) + 2 else round_even(coalesce(iq, 0), 0) end, 12) as double) as i_min from q join l using (capture)"""
)
def calibrate_threshold(spark, d):
    m = measured(spark, d).withColumns({"deformation": arrays.deformation(F.col("frame"), F.col("base")), "intensity": F.col("intensity") * 100})
    return stats.calibrated(m, ["capture"], "deformation", "intensity").select("capture", "n_background", *r6("p25", "bg_p99"), "i_min")


@query("select source, count(*) as n_rows, count(distinct case when capture is not null and frame_idx is not null then (capture, frame_idx) end) as n_keys, count(distinct case when capture is not null and frame_idx is not null then (capture, frame_idx) end) > 0 as present, count(distinct case when capture is not null and frame_idx is not null then (capture, frame_idx) end) = count(*) as \"unique\", case when count(distinct case when capture is not null and frame_idx is not null then (capture, frame_idx) end) = 0 then 'none' when count(distinct case when capture is not null and frame_idx is not null then (capture, frame_idx) end) = count(*) then 'row-level' else 'key-set only' end as proof, case when count(distinct case when capture is not null and frame_idx is not null then (capture, frame_idx) end) > 0 then 'tier-1' else 'tier-2' end as tier from make_parquet_v2 group by source")
def key_quality(spark, d):
    return verify.tiers(verify.key_quality(table(spark, d, "make_parquet_v2"), ["source"]))


_A = "a as (select capture, cast(frame_idx as bigint) as frame_idx, count(*) as n from runner_published where capture is not null and frame_idx is not null group by all)"
_B = "b as (select capture, cast(frame_idx as bigint) as frame_idx, count(*) as n from runner where capture is not null and frame_idx is not null group by all)"


def _copies(spark, d):
    return table(spark, d, "runner_published"), table(spark, d, "runner").withColumn("frame_idx", F.col("frame_idx").cast("bigint"))


@query(f"with {_A}, {_B} select capture, frame_idx, case when b.n is null then 'missing' else 'extra' end as side, coalesce(a.n, 0) as n_published, coalesce(b.n, 0) as n_produced from a full join b using (capture, frame_idx) where a.n is null or b.n is null")
def key_diff(spark, d):
    return verify.key_diff(*_copies(spark, d))


@query(
    f"""with {_A}, {_B}, s as (select count(a.n) as n_published, count(b.n) as n_produced, count(*) filter (where b.n is null) as missing, count(*) filter (where a.n is null) as extra, count(*) filter (where a.n is distinct from b.n) as bag from a full join b using (capture, frame_idx))
  select n_published, n_produced, missing, extra, 225 as tolerance, missing + extra = 0 as exact, missing + extra <= 225 as within, bag = 0 as bag_exact from s"""
)
def key_verdict(spark, d):
    return verify.verdict(*_copies(spark, d), 0.015, 5000)


def _runs(spark, d):
    r = table(spark, d, "runner")
    return r.where("frame_idx is not null").select(F.explode(F.array(*(F.when(F.col("frame_idx") % 7 != k, k) for k in range(3)))).alias("run"), "capture", "frame_idx").where("run is not null")


_RUNS = "runs as (select distinct k as run, capture, frame_idx from runner, (values (0), (1), (2)) t(k) where frame_idx is not null and frame_idx % 7 <> k and capture is not null), pub as (select distinct capture, cast(frame_idx as int) as frame_idx from runner_published where capture is not null and frame_idx is not null)"
_DIST = f"""with {_RUNS}, all_runs as (select cast(run as varchar) as run, capture, frame_idx from runs union all select 'published', capture, frame_idx from pub),
  size as (select run, count(*) as n from all_runs group by 1), common as (select a.run as x, b.run as y, count(*) as n from all_runs a join all_runs b using (capture, frame_idx) where a.run < b.run group by all),
  d as (select s.run as run_a, t.run as run_b, s.n + t.n - 2 * coalesce(c.n, 0) as symdiff from size s join size t on s.run < t.run left join common c on c.x = s.run and c.y = t.run)"""


@query(f"{_DIST} select cast(run_a as int) as run_a, cast(run_b as int) as run_b, symdiff from d where run_a <> 'published' and run_b <> 'published'")
def run_distances(spark, d):
    return verify.run_distances(_runs(spark, d).where("capture is not null"))


@query(
    f"""{_DIST}, o as (select min(symdiff) as floor, max(symdiff) as ceiling from d where run_b <> 'published'), g as (select min(symdiff) as gap from d where run_b = 'published'),
  c as (select (select count(distinct capture) from pub where capture in (select capture from runs)) / (select count(distinct capture) from pub)::double as coverage)
  select cast(3 as bigint) as n_runs, floor, ceiling, gap, (select count(*) from pub) as n_published, round((select count(*) from runs) / 3.0, 6) as mean_produced, gap <= ceiling as consistent,
    case when gap < floor then 'strong' when gap <= ceiling then 'consistent' else 'exceeds' end as verdict, round(coverage, 6) as coverage from o, g, c"""
)
def seed_envelope(spark, d):
    e = verify.seed_envelope(_runs(spark, d), table(spark, d, "runner_published").select("capture", F.col("frame_idx").cast("int").alias("frame_idx")))
    return e.select("n_runs", "floor", "ceiling", "gap", "n_published", *r6("mean_produced"), "consistent", "verdict", *r6("coverage"))


@query("select count(distinct capture) filter (where capture in (select capture from runner)) as covered, count(distinct capture) as published_captures, count(distinct capture) filter (where capture in (select capture from runner)) / count(distinct capture)::double as coverage from runner_published")
def capture_coverage(spark, d):
    return verify.coverage(table(spark, d, "runner"), table(spark, d, "runner_published"))


@query("select source, source not in ('sparsh', 'tacquad', 'real_tactile_mnist') as reproducible, count(*) as n from runner group by all")
def reproducibility(spark, d):
    return table(spark, d, "runner").groupBy("source").agg(F.count(F.lit(1)).alias("n")).select("source", verify.reproducible(F.col("source")).alias("reproducible"), "n")


_NAMES = [c for c in schema.CORPUS.names if c != "image"]


@query(f"select {', '.join(c for c in _NAMES if c in schema.FIRST.names)}, cast(null as varchar) as episode, cast(null as int) as frame_idx, cast(null as int) as digit_class, case when markered then 'markered' else 'markerless' end as gel_variant, cast(null as varchar) as domain from make_parquet")
def schema_backfill(spark, d):
    return schema.backfill(table(spark, d, "make_parquet")).select(*_NAMES)


@query("select count(*) as old_rows, count(*) as new_rows, true as schema_ok, cast(0 as bigint) as changed, cast(0 as bigint) as not_null, true as ok from make_parquet")
def backfill_verify(spark, d):
    old = table(spark, d, "make_parquet").drop("row_id", "written_at")
    return schema.verify_backfill(old, schema.backfill(old))


@query(
    """with u as (select source, split, frame_idx, gel_variant from make_parquet_v2 union all select source, split, frame_idx, gel_variant from make_parquet_video union all select source, split, null, null from make_parquet)
  select source, split, count(*) as n, count(frame_idx) as with_frame, count(gel_variant) as with_gel from u group by all"""
)
def union_by_name(spark, d):
    u = schema.union([table(spark, d, t) for t in ("make_parquet_v2", "make_parquet_video", "make_parquet")])
    return u.groupBy("source", "split").agg(F.count(F.lit(1)).alias("n"), F.count("frame_idx").alias("with_frame"), F.count("gel_variant").alias("with_gel"))


_SHAPES = ", ".join(f"'{s}'" for s in names.SHAPES_LATER)


@query(
    f"""with t as (select row_id, capture, string_split(capture, '_') as w from make_parquet where capture is not null), p as (select *, list_position([lower(x) in ({_SHAPES}) for x in w], true) as k from t)
  select row_id, case when regexp_matches(capture, '{names.CAPTURE}') then regexp_extract(capture, '{names.CAPTURE}', 1) end as obj_name, try_cast(case when regexp_matches(capture, '{names.CAPTURE}') then regexp_extract(capture, '{names.CAPTURE}', 2) end as int) as init_pose,
    case when ends_with(capture, '_left') then 'left' when ends_with(capture, '_right') then 'right' end as side, case when k > 0 then lower(w[k]) else 'unknown' end as indenter, case when k > 0 then coalesce(w[k + 1], '') else '' end as indenter_param, w[1] as prefix,
    coalesce(try_cast(case when regexp_matches(w[-1], '^[0-9]+$') then w[-1] end as int), -1) as number from p"""
)
def name_parse(spark, d):
    c = F.col("capture")
    m = table(spark, d, "make_parquet").where(c.isNotNull())
    n = m.select("row_id", "capture", names.capture_parts(c).alias("a"), names.loose_capture(c).alias("b"), names.stem_shape(c).alias("s"), names.prefix(c).alias("prefix"), names.stem_number(F.element_at(F.split(c, "_"), -1), F.lit(-1)).alias("number"))
    return n.select("row_id", "a.obj_name", "a.init_pose", "b.side", "s.indenter", "s.indenter_param", "prefix", "number")


@query(
    """with s as (select doc_id, coalesce(octet_length(encode(text)), 0) as size from documents), c as (select *, sum(size) over (order by doc_id rows unbounded preceding) - size as before from s)
  select cast(before // 100000 as bigint) as shard, count(*) as n, cast(sum(size) as bigint) as bytes from c group by 1"""
)
def shard_plan(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("size"))
    return sinks.shard_plan(docs, ["doc_id"], "size", 100_000).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


@query()
def image_measures(spark, d):
    return pixels.measures(table(spark, d, "make_parquet"), ["row_id", "source"])


@query()
def image_contact(spark, d):
    """Contact metrics of real pictures against the median of the first ten of their capture and shape."""
    f = pixels.grey_frames(table(spark, d, "make_parquet"), ["row_id", "capture", "height", "width"])
    group = ["capture", "height", "width"]
    b = baselines.elementwise(baselines.first_n(f, group, ["row_id"], 10), group, "frame")
    m = f.where("capture is not null").join(b, group).withColumn("m", arrays.contact(F.col("frame"), F.col("base"), 10.0))
    return m.select("row_id", "capture", "m.area", *[F.round("m.intensity", 6).alias("intensity")])


@query()
def pixel_histogram(spark, d):
    return pixels.histograms(table(spark, d, "make_parquet"), ["source"])


@query()
def marker_report(spark, d):
    f = pixels.grey_frames(table(spark, d, "make_parquet"), ["row_id", "capture", "height", "width"], "luma")
    group = ["capture", "height", "width"]
    some = selection.every_kth(f.where("capture is not null"), group, ["row_id"], 50)
    means = baselines.elementwise(some, group, "frame", "mean").withColumns({"height": F.floor(3 * F.col("height") / 4).cast("int") - F.floor(F.col("height") / 4).cast("int"), "width": F.floor(3 * F.col("width") / 4).cast("int") - F.floor(F.col("width") / 4).cast("int")})
    return pixels.marker_reports(means.where(F.size("base") == F.col("height") * F.col("width")), ["capture"])


@query()
def channel_repair(spark, d):
    """Pictures whose first channel leads, put in the other order."""
    m = table(spark, d, "make_parquet").select("row_id", "image")
    return pixels.measures(pixels.reordered(m, "auto"), ["row_id"], "rgb").select("row_id", F.round("channel_lead", 6).alias("channel_lead"))
