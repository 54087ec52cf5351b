"""Selection, folds, balance and verification against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framemill import schema
from framemill.operators import balance, baselines, folds, lookups, names, selection, stats, verify


def ids(df, c="id"):
    return sorted(r[c] for r in df.collect())


@pytest.fixture(scope="module")
def numbered(spark):
    r = random.Random(0)
    rows = [(i, r.choice(["a", "a", "a", "b", None]), r.randrange(5), "x", 1) for i in range(500)]
    return rows, spark.createDataFrame(rows, "id bigint, g string, v int, position string, _x_ int").cache()


@pytest.mark.parametrize("t", [0, 1, 2, 7, 40, 1000])
def test_even_and_stride_caps(numbered, t):
    rows, df = numbered
    even, stride = [], []
    for g in ("a", "b", None):
        mine = [x[0] for x in rows if x[1] == g]
        n = len(mine)
        even += mine if n <= t else [mine[int(i)] for i in np.linspace(0, n - 1, t, dtype=np.int64)]
        stride += mine if n <= t else [mine[int(i * n / t)] for i in range(t)]
    assert ids(selection.even_cap(df, ["g"], ["id"], t)) == sorted(even)
    if t:
        assert ids(selection.stride_cap(df, ["g"], ["id"], t)) == sorted(stride)
    assert selection.even_cap(df, ["g"], ["id"], 3).columns == df.columns


def test_draws(spark, numbered):
    rows, df = numbered
    rng, want = random.Random(7), []
    for i, _, v, *_ in rows:
        if v > 1 or rng.random() < 0.4:
            want.append(i)
    assert ids(selection.bernoulli_drawn(df, ["id"], F.col("v") <= 1, 0.4, 7)) == want
    a = ids(selection.bernoulli(df, ["id"], 0.3, 1))
    assert a == ids(selection.bernoulli(df.repartition(7), ["id"], 0.3, 1)) and 100 < len(a) < 200
    assert set(a) <= set(ids(selection.bernoulli(df, ["id"], 0.5, 1)))
    assert len(ids(selection.hash_sample(df, ["id"], 20))) == 20
    assert selection.bernoulli(df, ["id"], 0.0, 1, F.col("v") == 0).count() == sum(x[2] == 0 for x in rows)


def test_peaks(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 9.0), ("a", 3, 9.0), ("b", 4, None), ("c", 5, 1.0)], "g string, id int, s double")
    assert ids(selection.peak(df, ["g"], F.col("s"), "id")) == [3, 4, 5]
    assert ids(selection.peak(df, ["g"], F.col("s"), "id", 2.0)) == [3]
    assert ids(selection.peaks_or_fallback(df, ["g"], F.col("s"), ["id"], 2, 2.0, 1.0)) == [2, 3, 4, 5]
    assert ids(selection.peaks_or_fallback(df, ["g"], F.col("s"), ["id"], 2, 2.0, 0.0)) == [2, 3]


def test_runs_windows_and_shapes(spark):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(["a", "a", None, None, "b", "a"])], "id int, k string").withColumn("u", F.lit(1))
    assert [r.run for r in selection.run_ids(df, "k", ["id"], ["u"]).orderBy("id").collect()] == [1, 1, 2, 2, 3, 4]
    t = F.array(*map(F.lit, (0.0, 1.0, 2.0, 3.0)))
    one = spark.range(1).select(
        selection.in_window(t, F.lit(1.0), F.lit(2.0)), selection.in_window(t, F.lit(9.0), F.lit(10.0)), selection.in_window(t, F.lit(None).cast("double"), F.lit(1.0)),
        selection.in_window(F.lit(None).cast("array<double>"), F.lit(0.0), F.lit(1.0)),
    ).first()
    assert list(one) == [[1, 2], [0, 1, 2, 3], [0, 1, 2, 3], []]


def test_baselines(spark):
    rows = [("a", i, [float(v)] * 3) for i, v in enumerate([3] * 5 + [20] * 5 + [99])] + [("b", i, [1.0] * 3) for i in range(4)] + [("c", 0, None)]
    df = spark.createDataFrame(rows, "capture string, frame_idx int, frame array<float>")
    h = baselines.head_consumed(df, ["capture"], ["frame_idx"], "frame", 10).collect()
    assert [(r.capture, r.frame_idx, r.base) for r in h] == [("a", 10, [11.5] * 3)]
    base = {r.capture: r.base for r in baselines.elementwise(df, ["capture"], "frame").collect()}
    assert base == {"a": [20.0] * 3, "b": [1.0] * 3}
    assert baselines.random_n(df, ["capture"], ["frame_idx"], 3, 1).count() == 7 and baselines.random_n(df, [], ["capture", "frame_idx"], 5).count() == 5
    assert baselines.with_base(df, baselines.elementwise(df, ["capture"], "frame"), ["capture"]).where("base is null").count() == 1


def curate_loop(rows, rate, distance, lookback, budget):
    kept = empty = 0
    seen, unit, out = [], object(), []
    for u, ok, h in rows:
        if kept >= budget:
            out.append("over_budget")
            continue
        if u != unit:
            unit, seen = u, []
        if not ok and empty >= rate * max(kept, 1):
            out.append("background")
            continue
        if any(bin((h ^ s) & (2**64 - 1)).count("1") <= distance for s in seen[-lookback:]):
            out.append("duplicate")
            continue
        seen.append(h)
        kept, empty = kept + 1, empty + (not ok)
        out.append("kept" if ok else "kept_empty")
    return out


def test_curate_and_dedupe(spark):
    r = random.Random(4)
    base = [r.getrandbits(64) - 2**63 for _ in range(12)]
    rows = [("s" if i < 260 else "t", f"u{i // 40:02d}", i, r.random() < 0.7, r.choice(base) ^ (1 << r.randrange(60))) for i in range(400)]
    df = spark.createDataFrame(rows, "source string, capture string, id int, passing boolean, phash bigint")
    got = {x.id: x.decision for x in folds.curate(df.repartition(5), ["source"], "capture", ["capture", "id"], rate=0.2, distance=3, lookback=4, budget=60).collect()}
    for s in "st":
        mine = [x for x in rows if x[0] == s]
        assert [got[x[2]] for x in mine] == curate_loop([(x[1], x[3], x[4]) for x in mine], 0.2, 3, 4, 60)
    d = {x.id: x.decision for x in folds.dedupe(df, ["capture"], ["id"], distance=3, lookback=4).collect()}
    for u in {x[1] for x in rows}:
        mine = [x for x in rows if x[1] == u]
        assert [d[x[2]] for x in mine] == curate_loop([(u, True, x[4]) for x in mine], 0, 3, 4, 10**9)
    c = folds.counters(folds.curate(df, ["source"], "capture", ["capture", "id"], distance=None, budget=10**6), ["source"]).collect()
    assert sum(x.n_seen for x in c) == 400 and all(x.n_dup_dropped == 0 for x in c)
    one = spark.createDataFrame([(1, "a", None), (2, "a", None)], "id int, capture string, phash bigint")
    assert {x.decision for x in folds.dedupe(one, ["capture"], ["id"]).collect()} == {"kept"}
    assert not folds.dedupe(one.limit(0), ["capture"], ["id"]).collect()


def test_live_stride(spark):
    df = spark.createDataFrame([(i, "s") for i in range(2000)], "id int, source string")
    got = [x.decision for x in folds.live_stride(df, ["source"], ["id"], 300, 50).orderBy("id").collect()]
    assert got.count("kept") == 300 and got[:285] == ["kept"] * 285 and "over_budget" in got


def test_balance_scores(spark):
    c = spark.createDataFrame([("x", "a", 3), ("x", "b", 1), ("y", "z", 7)], "axis string, bucket string, n bigint")
    s = {r.axis: r for r in balance.scores(c).collect()}
    assert math.isclose(s["x"].entropy, -(0.75 * math.log(0.75) + 0.25 * math.log(0.25)) / math.log(2)) and math.isclose(s["x"].ess, 16 / 10)
    assert s["y"].entropy == 1.0 and s["y"].ess == 1.0
    assert balance.split_targets(100, {"train": 0.83}, "test") == {"train": 83, "test": 17}
    assert not balance.scores(c.limit(0)).collect()


def test_stats(spark):
    floor = spark.createDataFrame([("s", 12.0)] * 990 + [("s", 1.0)] * 10, "source string, i double")
    r = stats.threshold_estimate(floor, ["source"], "i").first()
    assert r.low == 1.0 and abs(r.p01 - 12) < 0.5 and r.verdict.startswith("likely")
    wide = spark.createDataFrame([("s", float(v)) for v in np.linspace(0, 60, 1000)], "source string, i double")
    assert stats.threshold_estimate(wide, ["source"], "i").first().verdict == "ambiguous"
    assert not stats.threshold_estimate(wide.limit(0), ["source"], "i").collect()
    p = {x.level: x.value for x in stats.percentiles(wide, [], "i").collect()}
    assert all(abs(p[q] - np.percentile(np.linspace(0, 60, 1000), 100 * q)) < 1e-9 for q in stats.LEVELS)


def test_verify(spark):
    keys = lambda a, b: spark.createDataFrame([("a", i) for i in range(a, b)], "capture string, frame_idx int")
    v = verify.verdict(keys(0, 100), keys(0, 100), 0.015, 1000).first()
    assert v.exact and v.within and v.bag_exact
    v = verify.verdict(keys(0, 1000), keys(1, 1001), 0.015, 100_000).first()
    assert not v.exact and v.within and v.missing == v.extra == 1 and v.tolerance == 4500
    v = verify.verdict(keys(0, 1000), keys(0, 500), 0.015, 1000).first()
    assert v.missing == 500 and not v.within
    runs = lambda *offs: spark.createDataFrame([(k, "a", i) for k, o in enumerate(offs) for i in range(o, o + 1000)], "run int, capture string, frame_idx int")
    e = lambda r, lo, **kw: verify.seed_envelope(r, keys(lo, lo + 1000), **kw).first()
    assert e(runs(0, 5, 9), 4).consistent
    assert e(runs(0, 1, 2), 800).verdict == "exceeds"
    assert e(runs(0, 400, 800), 1).verdict == "strong"
    with pytest.raises(ValueError):
        e(runs(0), 0)
    more = keys(0, 1000).union(spark.createDataFrame([("b", i) for i in range(5000)], "capture string, frame_idx int"))
    assert not verify.seed_envelope(runs(0, 5, 9), more).first().consistent
    s = verify.seed_envelope(runs(0, 5, 9), more, restrict=True).first()
    assert s.consistent and s.coverage == 0.5
    q = verify.key_quality(spark.createDataFrame([("s", "a", 1), ("s", "a", 1), ("t", "a", 1), ("u", None, 1)], "source string, capture string, frame_idx int"), ["source"])
    assert {r.source: (r.n_rows, r.n_keys, r.proof) for r in q.collect()} == {"s": (2, 1, "key-set only"), "t": (1, 1, "row-level"), "u": (1, 0, "none")}


def test_schema(spark):
    assert len(schema.CORPUS) == 30 and len(schema.VIDEO) == 34 and len(schema.FIRST) == 25
    old = spark.createDataFrame([(bytearray(b"x"), "s", t, "12") for t in (True, False, True, None)], "image binary, source string, markered boolean, height string")
    new = schema.backfill(old)
    assert new.schema.names == schema.CORPUS.names and [r.gel_variant for r in new.collect()] == ["markered", "markerless", "markered", "markerless"]
    assert schema.backfill(new).collect() == new.collect()
    assert schema.verify_backfill(old, new).first().ok
    assert not schema.verify_backfill(old, new.withColumn("height", F.lit(13))).first().ok
    assert not schema.verify_backfill(old, new.limit(2)).first().ok
    both = schema.union([old.withColumn("strange", F.lit(1)), new])
    assert both.count() == 8 and both.schema.names == schema.CORPUS.names


def test_settings_of_sources(spark):
    good = {"domain": "real", "gel_variant": "mixed", "license_repo": "main", "i_min": 10}
    s = schema.settings(good)
    assert (s["a_min"], s["channel_mode"], s["phash_dist"], s["phash_lookback"], s["budget"], s["bg_keep_rate"]) == (40, "auto", 4, 30, 200_000, 0.015)
    for bad in ({"domain": "toy"}, {"channel_mode": "grb"}, {"a_min": 0}, {"bg_keep_rate": 1.5}, {"bg_keep_rate": -0.1}, {"color": "red"}):
        with pytest.raises(ValueError, match=next(iter(bad))):
            schema.settings(good | bad)
    with pytest.raises(ValueError, match="i_min must be given"):
        schema.settings({k: v for k, v in good.items() if k != "i_min"})
    assert len(schema.SOURCES) == 13 and schema.source("fota_unlabeled")["phash_lookback"] == 5
    with pytest.raises(KeyError, match="nobody"):
        schema.source("nobody")
    with pytest.raises(ValueError, match="unit"):
        schema.with_source("unit", good)
    more = schema.with_source("mine", good)
    assert schema.source("mine", more)["i_min"] == 10 and "mine" not in schema.SOURCES
    rows = {r.source: r for r in schema.source_table(spark, more).collect()}
    assert len(rows) == 14 and rows["unit"].phash_dist is None and rows["gelslam"].budget == 200_000


def test_names_and_lookups(spark):
    c = F.col("c")
    row = lambda text, e: spark.createDataFrame([(text,)], "c string").select(e.alias("x")).first().x
    assert tuple(row("113_cuboid_12", names.stem_shape(c))) == ("cuboid", "12") and tuple(row("a_flat", names.stem_shape(c))) == ("flat", "") and tuple(row("a_b", names.stem_shape(c))) == ("unknown", "")
    assert tuple(row("my_obj_Mini_Mini_init_pose_3_labeled_left", names.capture_parts(c))) == ("my_obj", 3, True, "left") and row("other", names.capture_parts(c)) is None
    assert tuple(row("corner3", names.trial_parts(c))) == ("corner", "3") and tuple(row("corner", names.trial_parts(c))) == ("corner", "0")
    assert row("12_X1.5Y-2.0Z0.25.png", names.calibration_parts(c)).y_mm == -2.0
    assert row("7-abc", names.before_dash(c)) == 7 and row("abc", names.before_dash(c)) == 0
    assert row("my_TEST_val.parquet", names.split_of(c)) == "test"
    p = spark.createDataFrame([("a", 0.5), ("a", 9.0), ("b", 0.5), (None, 0.5)], "k string, at double")
    iv = spark.createDataFrame([("a", 0.0, 1.0, "i"), ("a", 0.4, 30.0, "j"), ("b", 5.0, 6.0, "k"), ("a", None, 1.0, "n")], "k string, lo double, hi double, name string")
    got = sorted((r.k, r["at"], r.name) for r in lookups.in_intervals(p, iv, "k", "at", "lo", "hi", 2.0).select("k", "at", F.col("name")).collect())
    assert got == [("a", 0.5, "i"), ("a", 0.5, "j"), ("a", 9.0, "j")]
    assert lookups.in_intervals(p.where("k is not null"), iv, "k", "at", "lo", "hi", 2.0, fallback=True).count() == 4
    poses = spark.createDataFrame([("a", "1.5"), ("b", "bad"), ("a", "1.5")], "k string, x string")
    assert sorted((r.k or "", r.x) for r in lookups.with_annotations(p, poses, "k", ["x"]).collect()) == [("", 0.0), ("a", 1.5), ("a", 1.5), ("b", 0.0)]
