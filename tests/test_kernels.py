"""Kernels: PNG, image measures, array expressions, ranks."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framemill.store import Store
from framemill.functions import arrays, images, png, ranks


def encoded(p, filters, rng=None, extra=b""):
    """A plain encoder with any filter per scanline, written from the format's definition."""
    h, w, c = p.shape
    flat, out = p.reshape(h, w * c).astype(int), b""
    for y in range(h):
        f = filters[y % len(filters)]
        row = []
        for x in range(w * c):
            a = flat[y, x - c] if x >= c else 0
            b = flat[y - 1, x] if y else 0
            d = flat[y - 1, x - c] if y and x >= c else 0
            e = a + b - d
            near = min((abs(e - a), 0, a), (abs(e - b), 1, b), (abs(e - d), 2, d))[2]
            row.append((flat[y, x] - (0, a, b, (a + b) // 2, near)[f]) % 256)
        out += bytes([f, *row])
    chunk = lambda k, v: len(v).to_bytes(4, "big") + k + v + zlib.crc32(k + v).to_bytes(4, "big")
    z = zlib.compress(out)
    head = w.to_bytes(4, "big") + h.to_bytes(4, "big") + bytes([8, 0 if c == 1 else 2, 0, 0, 0])
    return png.SIGNATURE + chunk(b"IHDR", head) + extra + chunk(b"IDAT", z[:9]) + chunk(b"IDAT", z[9:]) + chunk(b"IEND", b"")


@pytest.mark.parametrize("c", [1, 3])
def test_png_round_trip_all_filters(c):
    rng = np.random.default_rng(c)
    pictures = [rng.integers(0, 256, (7, 5, c)).astype(np.uint8) for _ in range(6)]
    text = b"\x00\x00\x00\x03tEXta\x00b\x00\x00\x00\x00"
    data = [encoded(p, [i % 5, 4, 3], extra=text) for i, p in enumerate(pictures)]
    got = {}
    for at, pixels in png.decode([*data, None, b"", b"junk", data[0][:60]]):
        got |= dict(zip(at, pixels))
    assert sorted(got) == list(range(6))
    assert all((got[i] == p).all() for i, p in enumerate(pictures))
    for f in (0, 1, 2):
        assert (png.decode([png.encode(pictures[0], f)])[0][1][0] == pictures[0]).all()


def test_png_damage_is_no_picture():
    good = png.encode(np.arange(60, dtype=np.uint8).reshape(6, 10))
    assert png.scanlines(good) is not None
    for at in (17, 30, 45):
        bad = bytearray(good)
        bad[at] ^= 255
        assert png.scanlines(bytes(bad)) is None
    assert png.scanlines(good[:-30]) is None


def test_centre_and_metrics():
    f = np.zeros((1, 80, 120, 3), np.uint8)
    f[0, 20:60, 30:90] = 255
    g = images.grey_centre(f)
    assert g.shape == (1, 40, 60) and g.min() == 255 and g.dtype == np.float32
    flat = np.zeros((1, 40, 60))
    flat[0, :10, :10] = 50
    flat[0, 20, :5] = 3
    area, intensity = images.contact(flat, np.zeros((40, 60)))
    assert (area[0], intensity[0]) == (100, 50.0)
    assert images.contact(np.full((1, 4, 4), 10.0), np.zeros((4, 4)))[0][0] == 0
    assert images.grey_centre(np.zeros((1, 10, 10)), crop="trim").shape == (1, 6, 6)


def test_channels():
    red = np.zeros((1, 4, 4, 3), np.uint8)
    red[..., 0] = 200
    for mode, swapped in (("rgb", False), ("bgr", True), ("auto", True), ("mixed", True)):
        assert (images.order_channels(red, mode)[0, 0, 0, 2] == 200) == swapped
    assert not (images.order_channels(red[..., ::-1], "auto") != red[..., ::-1]).any()
    with pytest.raises(ValueError):
        images.order_channels(red, "xyz")
    assert images.near_black(red // 20)[0] and not images.near_black(red)[0]


def test_phash():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 255, (2, 1, 64, 64, 3)).astype(np.uint8)
    ha, hb = (int(images.phash(x)[0]) & (2**64 - 1) for x in (a, b))
    assert ha == int(images.phash(a.copy())[0]) & (2**64 - 1) and (ha ^ hb).bit_count() > 4
    # the transform, spelled out: each row goes on with the row of the upside-down picture
    x = images.shrink(images.luma(a))[0].astype(float)
    along = lambda m: np.fft.fft(np.hstack([m, np.flipud(m)])).real[:, :32]
    low = along(along(x).T).T[:8, :8].ravel()
    assert ha == int("".join("01"[int(v > np.median(low[1:]))] for v in low), 2)


def test_blobs_and_markers():
    m = np.zeros((30, 40), bool)
    m[2:6, 2:6] = m[10:12, 5:30] = True
    m[6, 6] = True
    assert sorted(images.blobs(m)) == [1, 16, 50]
    snake = np.ones((9, 9), bool)
    snake[1::4, :-1] = snake[3::4, 1:] = False
    assert len(images.blobs(snake)) == 1
    img = np.full((480, 640), 120.0)
    for y in range(20, 460, 60):
        for x in range(20, 620, 60):
            img[y : y + 10, x : x + 10] = 10
    assert images.marker_dots(img) == (80, 80)
    assert images.histogram(np.zeros((2, 3, 3, 3), np.uint8))[0, 0] == 18


def test_array_expressions(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=64)], [float(np.float32(v)) for v in rng.normal(size=64)]) for i in range(50)]
    df = spark.createDataFrame(rows, "i int, a array<float>, b array<float>")
    m = arrays.contact(F.col("a"), F.col("b"), 0.5)
    for r in df.select("a", "b", m.alias("m"), arrays.deformation(F.col("a"), F.col("b")).alias("d"), arrays.median_bits(F.col("a")).alias("h")).collect():
        d = np.abs(np.array(r.a) - np.array(r.b))
        assert r.m.area == (d > 0.5).sum() and abs(r.m.intensity - d[d > 0.5].mean()) < 1e-12 and abs(r.d - d.mean()) < 1e-12
        bits = np.array(r.a) > np.median(r.a[1:])
        assert r.h & (2**64 - 1) == int("".join("01"[int(b)] for b in bits), 2)
    none = df.select(arrays.contact(F.col("a"), F.lit(None).cast("array<float>")).alias("m")).first()
    assert none.m is None
    assert spark.range(1).select(arrays.hamming(F.lit(0b1011), F.lit(0b1001)), arrays.hamming(F.lit(-1), F.lit(0))).first()[:] == (1, 64)


def test_running_total_and_positions(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [None, "a", "b"][int(rng.integers(0, 3)) if i % 3 else 1], int(rng.integers(1, 9))) for i in range(900)]
    df = spark.createDataFrame(rows, "id bigint, g string, v bigint").withColumn("h", F.xxhash64("id"))
    got = ranks.running_total(df, ["g"], "h", ["id"], F.col("v"), 900).collect()
    for g in (None, "a", "b"):
        mine = sorted((r for r in got if r.g == g), key=lambda r: (r.h, r.id))
        assert [r.before for r in mine] == [0, *np.cumsum([r.v for r in mine])[:-1]]
    assert ranks.running_total(df, [], "h", ["id"], F.lit(1), 900).select("before").distinct().count() == 900
    for n in (1, 9):
        p = ranks.positions(df, ["g"], ["v", "id"], n).collect()
        for g in (None, "a", "b"):
            mine = sorted((r for r in p if r.g == g), key=lambda r: (r.v, r.id))
            assert [r.position for r in mine] == list(range(len(mine))) and {r.group_rows for r in mine} <= {len(mine)}
    assert not ranks.positions(df.limit(0), ["g"], ["id"]).collect()


def test_running_total_in_levels(spark, monkeypatch):
    """Totals of ranges added up in levels give what one level gives."""
    df = spark.range(3000).select("id", (F.col("id") % 3).cast("string").alias("g"), F.xxhash64("id").alias("h"))
    one = {r.id: r.before for r in ranks.running_total(df, ["g"], "h", ["id"], F.col("id"), 3000).collect()}
    monkeypatch.setattr(ranks, "RANGE_ROWS", 10)
    monkeypatch.setattr(ranks, "LEVEL_BITS", 3)
    assert ranks.range_bits(3000) == 9
    assert one == {r.id: r.before for r in ranks.running_total(df, ["g"], "h", ["id"], F.col("id"), 3000).collect()}
    import hashlib

    got = spark.range(20).select("id", ranks.md5_number(F.lit("x"), F.col("id")).alias("n"), ranks.md5_order(F.lit("x"), F.col("id")).alias("o")).collect()
    assert all(r.n == int(hashlib.md5(f"x:{r.id}".encode()).hexdigest()[:15], 16) for r in got)
    assert [r.id for r in sorted(got, key=lambda r: r.n)] == [r.id for r in sorted(got, key=lambda r: r.o)]


def test_store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "s"), {"a": "x int", "b": "y string"})
    assert not s.batches and not s.read("a").collect()
    s.commit({"a": spark.range(3).select(F.col("id").cast("int").alias("x"))})
    s.commit({"b": spark.createDataFrame([("q",)], "y string")})
    spark.range(9).select(F.col("id").cast("int").alias("x")).write.parquet(str(tmp_path / "s/a/batch=3"))  # of a batch that died
    t = Store(spark, str(tmp_path / "s"), s.schemas)
    assert t.batches == [1, 2] and t.read("a").count() == 3 and t.read("b").collect() == [("q", 2)] and t.upto(1).read("b").count() == 0
    t.commit({}, afresh=True)
    u = Store(spark, str(tmp_path / "s"), s.schemas)
    assert u.batches == [3] and u.read("a").count() == 0
