"""Sources, sinks and streams on small files made here."""

import json
import os
import pickle
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framemill import schema
from framemill.functions import png
from framemill.operators import pixels
from framemill.sources import containers, files, sinks
from framemill.streaming import frames


def picture(v, h=8, w=6):
    return png.encode(np.full((h, w, 3), v, np.uint8))


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_picture_trees(spark, tmp_path):
    root = str(tmp_path / "t")
    for name in ("10", "9", "x"):
        put(f"{root}/cap/left/{name}.png", picture(1))
    put(f"{root}/cap/right/1.png", picture(1))
    got = {r.stem: r.frame_idx for r in files.sensor_tree(spark, root, "left").collect()}
    assert got == {"10": 10, "9": 9, "x": 0}
    cal = str(tmp_path / "c")
    put(f"{cal}/3_X1.5Y2Z-0.5.png", picture(1))
    put(f"{cal}/blank.png", picture(1))
    r = files.calibration_tree(spark, cal).collect()
    assert [(x.frame_idx, x.x_mm, x.z_mm) for x in r] == [(3, 1.5, -0.5)]
    obj = str(tmp_path / "o")
    for n in ("b", "a", "c"):
        put(f"{obj}/mug_1/{n}.png", picture(1))
    assert {r.stem: (r.frame_idx, r.family) for r in files.object_tree(spark, obj).collect()} == {"a": (0, "mug"), "b": (1, "mug"), "c": (2, "mug")}
    assert files.jpeg_pixels(spark, obj).count() == 3
    assert files.file_stats(spark, str(_table(spark, tmp_path))).first().rows == 5


def _table(spark, tmp_path):
    p = tmp_path / "stats"
    spark.range(5).coalesce(1).write.parquet(str(p))
    return p


def test_posed_and_listed_trees(spark, tmp_path):
    root = str(tmp_path / "p")
    cap = "mug_Mini_Mini_init_pose_2_labeled_left"
    put(f"{root}/{cap}/a.jpg", b"1")
    put(f"{root}/{cap}/b.jpg", b"2")
    put(f"{root}/odd/a.jpg", b"3")
    put(f"{root}/{cap}/poses.csv", b"filename,x_mm\na.jpg,1.5\nb.jpg,bad\n")
    got = {r.filename: (r.obj_name, r.init_pose, r.x_mm) for r in files.posed_tree(spark, root, True, ["x_mm"]).collect()}
    assert got == {"a.jpg": ("mug", 2, 1.5), "b.jpg": ("mug", 2, None)}
    lists = str(tmp_path / "test.csv")
    put(lists, b"odd/a.jpg\n")
    assert {(r.parent, r.stem): r.split for r in files.listed_tree(spark, root, lists).collect() if r.format == "jpg"} == {(cap, "a"): "train", (cap, "b"): "train", ("odd", "a"): "test"}


def test_nested_pictures(spark):
    rows = [(i, None if i == 2 else f"id{i}", [(bytearray(b"x"), "p"), (bytearray(b"y"), "q")] if i != 4 else None) for i in range(6)]
    df = spark.createDataFrame(rows, "n int, id string, pics array<struct<bytes:binary,path:string>>")
    got = sorted((r.n, r.capture, bytes(r.image)) for r in files.nested_pictures(df, "pics", ["n"], 2).collect())
    assert got == [(0, "id0_t0", b"x"), (0, "id0_t1", b"y"), (2, "row2_t0", b"x"), (2, "row2_t1", b"y")]


def test_containers(spark, tmp_path):
    a = np.arange(2 * 3 * 3, dtype=np.uint8).reshape(2, 3, 3)
    os.makedirs(tmp_path / "n")
    np.save(tmp_path / "n" / "good.npy", {"gs_img": a, "f_x": 1.5, "grid_z": np.array([[1.0, 3.0]])}, allow_pickle=True)
    np.save(tmp_path / "n" / "bad.npy", {"gs_img": a.astype(float)}, allow_pickle=True)
    np.save(tmp_path / "n" / "plain.npy", a)
    r = containers.npy_frames(spark, str(tmp_path / "n")).collect()
    assert [(x.height, x.width, x.f_x, x.f_y, x.grid_z_max, x.grid_z_mean, bytes(x.pixels)) for x in r] == [(2, 3, 1.5, 0.0, 3.0, 2.0, a.tobytes())]
    put(str(tmp_path / "k" / "d.pkl"), pickle.dumps([b"a", b"b"]))
    put(str(tmp_path / "k" / "org_d.pkl"), pickle.dumps([b"c"]))
    assert [(x.frame_idx, bytes(x.image)) for x in containers.pickled_pictures(spark, str(tmp_path / "k")).collect()] == [(0, b"a"), (1, b"b")]
    put(str(tmp_path / "e" / "evil.pkl"), pickle.dumps([os.system]))
    with pytest.raises(Exception, match="plain data"):
        containers.pickled_pictures(spark, str(tmp_path / "e")).collect()
    z = np.arange(5 * 2 * 2 * 3, dtype=np.uint8).reshape(5, 2, 2, 3)
    full = np.concatenate([z, np.zeros((1, 2, 2, 3), np.uint8)])
    put(str(tmp_path / "z" / ".zarray"), json.dumps({"shape": [5, 2, 2, 3], "chunks": [2, 2, 2, 3], "dtype": "|u1", "compressor": {"id": "zlib"}, "order": "C", "filters": None}).encode())
    for i in range(3):
        put(str(tmp_path / "z" / f"{i}.0.0.0"), zlib.compress(full[2 * i : 2 * i + 2].tobytes()))
    got = {x.frame_idx: bytes(x.pixels) for x in containers.zarr_frames(spark, str(tmp_path / "z")).collect()}
    assert got == {i: z[i].tobytes() for i in range(5)}


def test_pixel_maps(spark):
    red = np.zeros((8, 6, 3), np.uint8)
    red[..., 0] = 90
    df = spark.createDataFrame([(1, bytearray(png.encode(red))), (2, bytearray(png.encode(red[..., ::-1]))), (3, None), (4, bytearray(b"junk"))], "id int, image binary")
    m = {r.id: (r.swapped, r.channel_lead) for r in pixels.measures(df, ["id"]).collect()}
    assert m == {1: (True, 90.0), 2: (False, -90.0)}
    fixed = {r.id: r.image for r in pixels.reordered(df, "auto").collect()}
    assert fixed[3] is None and bytes(fixed[4]) == b"junk" and bytes(fixed[2]) == png.encode(red[..., ::-1])
    assert (png.decode([bytes(fixed[1])])[0][1][0] == red[..., ::-1]).all()
    h = {(r.channel, r.bin): r.share for r in pixels.histograms(df.withColumn("s", F.lit("x")), ["s"]).collect()}
    assert h[0, 22] == 0.5 and h[0, 0] == 0.5 and h[1, 0] == 1.0


def test_sinks(spark, tmp_path):
    rows = [(i, 60, "s", ["train", "val"][i % 2]) for i in range(9)]
    df = spark.createDataFrame(rows, "id int, size int, source string, split string")
    plan = sorted((r.id, r.shard) for r in sinks.shard_plan(df, ["id"], "size", 100).collect())
    assert [s for _, s in plan] == [i * 60 // 100 for i in range(9)]
    p = str(tmp_path / "corpus")
    sinks.write_corpus(df, p, ["source", "split"], 2)
    assert spark.read.parquet(p).count() == 9 and len([f for f in os.listdir(f"{p}/source=s/split=train") if f.endswith("parquet")]) >= 3
    with pytest.raises(Exception):
        sinks.write_corpus(df, p, ["source"])
    sinks.write_sharded(df, str(tmp_path / "sh"), ["id"], "size", 100)
    assert spark.read.parquet(str(tmp_path / "sh")).select("shard").distinct().count() == 5
    out = sinks.rebalanced(df, ["id"], 3).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert sorted(r["count"] for r in out) == [3, 3, 3]
    t = str(tmp_path / "inplace")
    df.write.parquet(t)
    sinks.replace(spark.read.parquet(t).where("id < 4"), t)
    assert spark.read.parquet(t).count() == 4 and not os.path.exists(t + ".old")
    sinks.write_report(df, str(tmp_path / "r.json"))
    assert spark.read.json(str(tmp_path / "r.json")).count() == 9
    w = schema.conform(df.withColumn("unknown", F.lit(1)))
    assert w.columns == schema.CORPUS.names


def stream(spark, tmp_path, df, name, parts):
    """The table as files that a stream reads one per batch."""
    src = str(tmp_path / name)
    for i, cond in enumerate(parts):
        df.where(cond).coalesce(1).write.parquet(f"{src}/{i}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)


def test_stream_dedupe_and_head(spark, tmp_path):
    rows = [("a" if i % 2 else "b", i, None if i == 7 else (5 if i < 10 else 1 << (i % 50)), [float(i)] * 3) for i in range(40)]
    df = spark.createDataFrame(rows, "capture string, frame_idx bigint, phash bigint, frame array<float>")
    s = stream(spark, tmp_path, df, "in", ["frame_idx < 15", "frame_idx >= 15 and frame_idx < 28", "frame_idx >= 28"])
    frames.run_to_table(frames.dedupe(s, 1, 4), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {r.frame_idx: r.decision for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {}
    for c in "ab":
        seen = []
        for cap, i, h, _ in rows:
            if cap == c:
                dup = h is not None and any(bin(h ^ x).count("1") <= 1 for x in seen[-4:])
                want[i] = "duplicate" if dup else "kept"
                if not dup and h is not None:
                    seen.append(h)
    assert got == want
    frames.run_to_table(frames.head_contact(s, 10.0, 5), str(tmp_path / "out2"), str(tmp_path / "cp2"))
    got = {r.frame_idx: (r.area, r.intensity) for r in spark.read.parquet(str(tmp_path / "out2")).collect()}
    assert set(got) == set(range(10, 40)) and got[39] == (3, 34.0) and got[10] == (0, 0.0)


def test_stream_windows(spark, tmp_path):
    rows = [(i, "u" if i % 2 else "v", float(i)) for i in range(0, 120, 5)]
    df = spark.createDataFrame(rows, "s int, k string, v double").withColumn("at", F.timestamp_seconds(F.col("s") * 60))
    s = stream(spark, tmp_path, df, "ev", ["s < 60", "s >= 60"])
    late = spark.createDataFrame([(10**6, "z", 0.0)], "s int, k string, v double").withColumn("at", F.timestamp_seconds(F.col("s") * 60))
    late.coalesce(1).write.parquet(str(tmp_path / "ev" / "9"))
    frames.run_to_table(frames.windowed(s, "at", ["k"], F.col("v"), "30 minutes"), str(tmp_path / "w"), str(tmp_path / "wcp"))
    got = {(r.k, r.start.timestamp() // 60): (r.n, r.total) for r in spark.read.parquet(str(tmp_path / "w")).collect()}
    assert sum(n for n, _ in got.values()) == 24
    frames.run_to_table(frames.sessions(s, "at", ["k"], "15 minutes"), str(tmp_path / "x"), str(tmp_path / "xcp"))
    assert spark.read.parquet(str(tmp_path / "x")).agg(F.sum("n")).first()[0] == 24
    frames.run_to_table(frames.once(s, "at", ["k"]), str(tmp_path / "o"), str(tmp_path / "ocp"))
    assert spark.read.parquet(str(tmp_path / "o")).where("k = 'u'").count() >= 1
