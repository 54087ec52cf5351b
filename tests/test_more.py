"""Smaller operators: row defaults, projections, strategies, summaries, pipelines on hand-made frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framemill import schema
from framemill.functions import images, png
from framemill.operators import balance, baselines, names, selection, stats
from framemill.plans import pipelines


def test_projected(spark):
    df = spark.createDataFrame([("c", 3, "train", None, 1), ("c", 4, "val", "sim", 2)], "capture string, frame_idx int, split string, domain string, odd int")
    r = schema.projected(df, schema.source("unit"), ("domain",)).orderBy("frame_idx").collect()
    assert [(x.source, x.domain, x.markered, x.gel_variant, x.frame_idx, x.height) for x in r] == [("unit", "real", True, "markered", 3, None), ("unit", "sim", True, "markered", 4, None)]
    assert not schema.projected(df, schema.source("sparsh")).first().markered


def test_row_defaults_and_summaries(spark):
    df = spark.createDataFrame([("", None, 4), (None, "mug", 5), ("cap", "", 6)], "capture string, obj_name string, frame_idx int")
    assert [(r.capture, r.obj_name) for r in names.row_defaults(df).orderBy("frame_idx").collect()] == [("unknown_4", "unknown"), ("mug_5", "mug"), ("cap", "unknown")]
    g = spark.range(1).select(names.grid_summary(F.array(F.lit(1.0), F.lit(3.0)), F.lit(None)).alias("a"), names.grid_summary(F.lit(None).cast("array<double>"), F.lit(2.0)).alias("b"), names.gel_by_split(F.lit("val")), names.gel_by_split(F.lit("zz"))).first()
    assert tuple(g[0]) == (3.0, 2.0, 0.0) and tuple(g[1]) == (None, None, 2.0) and (g[2], g[3]) == ("black_dot", "unknown")


def test_strategies(spark):
    rows = [(c, i, [float(i)] * 2) for c in "ab" for i in range(6)] + [("z", 0, [9.0] * 2)]
    df = spark.createDataFrame(rows, "c string, i int, frame array<float>")
    s = lambda kind, **kw: baselines.strategy(kind, df, "frame", ["c"], ["i"], **kw)
    bases = lambda d: {r.c: r.base[0] for r in d.collect()}
    assert s("none") is None
    assert bases(s("first_n", n=3)) == {"a": 1.0, "b": 1.0, "z": 9.0} and bases(s("first_n", n=3, least=2)) == {"a": 1.0, "b": 1.0}
    assert bases(s("per_touch")) == {"a": 2.5, "b": 2.5, "z": 9.0}
    assert s("random_all", n=5).count() == 1 and bases(s("random_group", n=2, seed=1)) == bases(baselines.strategy("random_group", df.repartition(5), "frame", ["c"], ["i"], n=2, seed=1))
    assert bases(s("explicit", explicit=s("per_touch"))) == bases(s("per_touch"))
    for bad in ("explicit", "other"):
        with pytest.raises(ValueError):
            s(bad)
    with pytest.raises(ValueError):
        baselines.elementwise(df, ["c"], "frame", "mode")
    assert not baselines.elementwise(df.limit(0), ["c"], "frame").collect()
    shaped = selection.per_shape_buffered(df.withColumn("h", F.lit(1)), ["h"], ["c", "i"], "frame", 2).collect()
    assert len(shaped) == 13 and {tuple(r.base) for r in shaped} == {(0.5, 0.5)}
    assert baselines.with_base(df, s("random_all", n=13), []).where("base is not null").count() == 13


def test_channel_means_and_mix(spark):
    df = spark.createDataFrame([("s", 9.0, 1.0, 2.0, "x"), ("s", 7.0, 1.0, 2.0, None), ("t", 1.0, 1.0, 2.0, "y")], "k string, r double, g double, b double, m string")
    got = {r.k: (r.n, r.r_mean, r.r_std, r.order) for r in stats.channel_means(df, ["k"], "r", "g", "b").collect()}
    assert got == {"s": (2, 8.0, 1.0, "rgb"), "t": (1, 1.0, 0.0, "bgr")}
    assert {r.k: (r.x, r.other) for r in balance.mix(df, "k", "m", ["x"]).collect()} == {"s": (1, 1), "t": (0, 1)}


def test_top_and_tail(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1), ("d", 1)], "k string, n bigint")
    assert [(r.k, r.n) for r in balance.top_and_tail(df, "k", "n", 1).collect()] == [("a", 5), ("(3 more)", 7)]
    assert balance.top_and_tail(df, "k", "n", 9).count() == 4 and balance.top_and_tail(df.limit(0), "k", "n", 3).count() == 0


def test_turns_and_jpeg():
    a = np.arange(6).reshape(1, 2, 3)
    assert (images.turn_right(a)[0] == [[3, 0], [4, 1], [5, 2]]).all()
    try:
        import PIL  # noqa: F401
    except ImportError:
        with pytest.raises(RuntimeError):
            images.encode_jpeg(np.zeros((4, 4, 3), np.uint8))


def test_pipelines_on_frames(spark):
    rng = np.random.default_rng(0)
    rows = []
    for c in "abc":
        for i in range(40):
            f = 100 + rng.normal(0, 1, 50)
            if i % 4 == 0:
                f[:20] += 60
            rows.append((c, i, [float(v) for v in f]))
    df = spark.createDataFrame(rows, "capture string, frame_idx int, frame array<float>")
    test = (F.col("area") >= 10) & (F.col("intensity") >= 30)
    kept = pipelines.refiltered(df, ["capture"], ["capture", "frame_idx"], test, n=30, rate=0.0)
    assert sorted((r.capture, r.frame_idx) for r in kept.collect()) == [(c, i) for c in "abc" for i in range(0, 40, 4)]
    z = pipelines.refiltered(df, ["capture"], ["capture", "frame_idx"], F.col("area") >= 0, n=30, rate=0.0, zscore=True)
    assert z.count() == 120
    none = pipelines.refiltered(df, ["capture"], ["capture", "frame_idx"], test, n=30, rate=0.0, least=1000)
    assert none.count() == 120  # no baseline: kept
    p = pipelines.peak_frames(df, ["capture"], ["frame_idx"], 10, 30, 2)
    assert p.count() == 6 and p.where("frame_idx % 4 <> 0").count() == 0
    s = pipelines.sequences(df, "capture", ["frame_idx"], 10, 30, 0.0)
    assert s.count() == 30 and {(r.frame_in_seq, r.sequence_length) for r in s.collect()} == {(i, 10) for i in range(10)}
    assert pipelines.contact_sample(df, ["capture"], ["capture", "frame_idx"], 10, 30, 7).count() == 7
    h = spark.createDataFrame([("a", i, i % 3) for i in range(60)], "capture string, frame_idx int, phash bigint")
    d = pipelines.deduped_and_capped(h, ["capture"], ["frame_idx"], 10, 0, 1)
    assert d.count() == 10
    f = spark.createDataFrame([(1, "9_cuboid_4", "test", 0.1), (2, "x_flat", "val", -0.5), (3, "none", "zz", None)], "row_id int, stem string, split string, f_z float")
    g = [(r.row_id, r.indenter, r.indenter_param, r.gel_variant) for r in pipelines.force_gated(f, "stem", ["row_id"], rate=0.0).collect()]
    assert g == [(2, "flat", "", "black_dot")]


def test_curated_keeps_pictures_without_unit(spark):
    """A null unit, source or shape has no baseline: its pictures pass; those that do not decode have no row."""
    rng = np.random.default_rng(3)
    picture = lambda: bytearray(png.encode(rng.integers(0, 256, (24, 24)).astype(np.uint8)))
    rows = [("s", "a", i, picture(), 24, 24) for i in range(15)] + [("s", None, 100 + i, picture(), 24, 24) for i in range(4)]
    rows += [("s", None, 200, bytearray(b"none"), 24, 24), (None, "a", 300, picture(), 24, 24), ("s", "a", 400, picture(), None, 24)]
    df = spark.createDataFrame(rows, "source string, capture string, row_id bigint, image binary, height int, width int")
    spec = schema.settings({"domain": "real", "gel_variant": "mixed", "license_repo": "main", "i_min": 10, "a_min": 6})
    got = {r.row_id: r for r in pipelines.curated(df, spec, ["source"], "capture", ["row_id"]).collect()}
    bare = {100, 101, 102, 103, 300, 400}
    assert set(got) == {*range(10, 15), *bare}
    assert all((got[i].area is None, got[i].intensity is None) == (i in bare, i in bare) for i in got)
    assert all(got[i].decision == "kept" for i in bare)


def test_sequences_of_several_sizes(spark, tmp_path):
    """Every size of a sequence is kept against its own baseline; null sequences are left out."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(60):
        p = np.full((24, 24) if i % 2 else (36, 48), 100) + rng.integers(0, 2, (24, 24) if i % 2 else (36, 48))
        if i >= 40:
            p[8:-8, 8:-8] += 100
        rows.append((i, bytearray(png.encode(p.astype(np.uint8))), *p.shape, "q" if i < 58 else None))
    spark.createDataFrame(rows, "row_id bigint, image binary, height int, width int, sequence_id string").write.parquet(f"{tmp_path}/make_parquet_video.parquet")
    got = pipelines.pl_sequences(spark, str(tmp_path)).where("intensity > 50").collect()
    assert sorted(r.row_id for r in got) == list(range(40, 58)) and len({r.frame_in_seq for r in got}) == 18
