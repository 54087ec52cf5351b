"""Cross-split overlaps against all pairs, on perturbed, copied and damaged pictures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framemill.functions import png
from framemill.llm import overlap

ROWS = "row_id bigint, image binary, split string, source string, h1 string, rep int"


def grey(data):
    got = png.decode([data])
    return None if not got else got[0][1][0].astype(float).mean(axis=2)


def brute(rows):
    out = set()
    g = {r[0]: grey(r[1]) for r in rows if r[1] is not None}
    side = {r[0]: (r[2] or "").strip().lower() for r in rows}
    ev = [i for i in g if side[i] in ("val", "test") and g[i] is not None]
    tr = [i for i in g if side[i] == "train" and g[i] is not None]
    for e in ev:
        for t in tr:
            if g[e].shape == g[t].shape and np.abs((g[e] - g[e].mean()) - (g[t] - g[t].mean())).mean() <= 4.0:
                out.add((min(e, t), max(e, t)))
    return out


def pictures(n, seed, h=18, w=24):
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[0:h, 0:w]
    for _ in range(n):
        p = 120 + rng.normal(0, 8, (h, w)) + rng.normal(0, 12) * (x / w - 0.5) + rng.normal(0, 12) * (y / h - 0.5)
        cy, cx, a = rng.integers(0, h), rng.integers(0, w), rng.choice([0, 60])
        yield p + a * np.exp(-((y - cy) ** 2 + (x - cx) ** 2) / 18)


def as_png(p, f=0, rgb=False):
    q = np.clip(np.round(p), 0, 255).astype(np.uint8)
    return png.encode(np.repeat(q[:, :, None], 3, axis=2) if rgb else q, f)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(9)
    base, out, i = list(pictures(300, 1)), [], 0

    def add(data, split, source="s"):
        nonlocal i
        i += 1
        out.append((i, None if data is None else bytearray(data), split, source, "x", 1))

    for k, p in enumerate(base):
        add(as_png(p, k % 3), ["train", " TRAIN", "Train "][k % 3], ["a", None][k % 2])
        if k < 60:
            add(as_png(p + 15, (k + 1) % 3, rgb=k % 2 == 0), ["val", "TEST "][k % 2], "a")  # brighter, encoded otherwise
        elif k < 120:
            add(as_png(p + rng.uniform(-3, 3, p.shape)), "val", None)
        elif k < 150:
            q = p.copy()
            q[k % 18, 3:6] += 110
            add(as_png(q), "test", "b")
        elif k < 170:
            add(as_png(p.T), "val")
        elif k < 200:
            add(as_png(p), [None, "", "recon", "train"][k % 4])
    good = as_png(base[0])
    for bad in (None, b"", b"not a picture", good[:-40], bytes(reversed(good))):
        add(bad, "val")
        add(bad, "train")
    return out


def test_equals_all_pairs(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    o = overlap.Overlap(df)
    got = [tuple(r) for r in o.pairs().collect()]
    assert len(got) == len(set(got)) and set(got) == brute([(r[0], None if r[1] is None else bytes(r[1]), *r[2:]) for r in rows]) and len(got) >= 150
    report = o.report().collect()
    assert sum(r.pairs for r in report) == len(got) and {r.source for r in report} >= {"a", "b", None}
    assert sum(r.overlapping for r in report) == len({i for p in got for i in p if rows[i - 1][2].strip().lower() != "train"})


def test_partitioning_does_not_matter(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    assert set(overlap.Overlap(df.repartition(9)).pairs().collect()) == set(overlap.Overlap(df.coalesce(1)).pairs().collect())


def test_hot_class_is_compared_once(spark):
    """A third of all rows are copies of one picture: one class, one link, counts without pairs."""
    p = list(pictures(200, 4))
    rows = [(i, bytearray(as_png(p[0])), "train" if i % 4 else "val", "s", "", 0) for i in range(100)] + [(100 + i, bytearray(as_png(x)), ["train", "val"][i % 2], "t", "", 0) for i, x in enumerate(p[1:])]
    o = overlap.Overlap(spark.createDataFrame(rows, ROWS))
    assert o.links.count() == 1 and o.pairs().count() == 25 * 75
    r = {x.source: x for x in o.report().collect()}
    assert (r["s"].eval_rows, r["s"].overlapping, r["s"].same, r["s"].pairs) == (25, 25, 25, 25 * 75) and r["t"].pairs == 0


def test_empty_and_tiny(spark):
    none = spark.createDataFrame([], ROWS)
    assert not overlap.Overlap(none).pairs().collect() and not overlap.Overlap(none).report().collect()
    one = png.encode(np.full((1, 1), 7, np.uint8))
    two = png.encode(np.full((1, 1), 200, np.uint8))
    big = np.random.default_rng(0).integers(0, 256, (70, 90)).astype(np.uint8)
    df = spark.createDataFrame([(1, bytearray(one), "train", "s", "", 0), (2, bytearray(two), "val", "s", "", 0), (3, bytearray(png.encode(big)), "train", "s", "", 0), (4, bytearray(png.encode(big ^ 1)), "test", "s", "", 0), (None, bytearray(one), "train", "s", "", 0)], ROWS)
    assert sorted(map(tuple, overlap.Overlap(df).pairs().collect())) == [(1, 2), (3, 4)]


@pytest.mark.parametrize("noise,least", [(1.0, 1.0), (2.0, 0.98), (3.0, 0.85)])
def test_candidate_recall_on_noise_alone(noise, least):
    """Blank pictures, where noise is all there is to tell them apart: the share of near copies that meet."""
    rng = np.random.default_rng(3)
    a = np.round(120 + rng.normal(0, 8, (500, 18, 24))).astype(np.uint8)
    b = np.clip(np.round(a + rng.uniform(-2 * noise, 2 * noise, a.shape)), 0, 255).astype(np.uint8)
    ca, cb = overlap.canonical(a[..., None]), overlap.canonical(b[..., None])
    own, _, sa, pa_ = overlap.band_hashes(ca, 18, 24)
    _, probes, sb, pb_ = overlap.band_hashes(cb, 18, 24)
    met = (probes == own[:, :, None]).any(axis=(1, 2)) & (np.bitwise_count((sa ^ sb).view(np.uint64)) <= overlap.SKETCH)
    met &= np.abs(pa_.astype(int) - pb_).mean(axis=1) <= overlap.SAMPLE_MOST
    assert met.mean() >= least


def test_on_the_test_table(spark, small):
    df = spark.read.parquet(f"{small}/make_parquet.parquet").select("row_id", "image", "split", "source")
    want = brute([(r.row_id, None if r.image is None else bytes(r.image), r.split, r.source) for r in df.collect()])
    assert set(map(tuple, overlap.Overlap(df).pairs().collect())) == want
    assert overlap.Overlap(df.withColumn("rep_a", F.lit(1))).pairs().count() == len(want)


@pytest.mark.parametrize("far", [2.5, 3.5, 3.9, 4.0])
def test_every_near_pair_is_found_on_noise_alone(spark, far):
    """Blank pictures with uniform noise that leaves them just within ``far`` grey levels: none is lost."""
    rng = np.random.default_rng(12)
    rows = []
    for i, p in enumerate(np.round(120 + rng.normal(0, 8, (150, 18, 24)))):
        noise = rng.uniform(-1, 1, p.shape)
        q = next(q for k in np.linspace(2.2 * far, 0, 400) if np.abs((q := np.round(p + k * noise)) - q.mean() - (p - p.mean())).mean() <= far)
        rows += [(2 * i, bytearray(as_png(p)), "train", "s", "", 0), (2 * i + 1, bytearray(as_png(q)), "val", "s", "", 0)]
    want = brute([(r[0], bytes(r[1]), *r[2:]) for r in rows])
    assert {(2 * i, 2 * i + 1) for i in range(150)} <= want
    assert set(map(tuple, overlap.Overlap(spark.createDataFrame(rows, ROWS)).pairs().collect())) == want


def test_crowded_cells_are_compared_in_chunks(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, ROWS)
    want = sorted(map(tuple, overlap.Overlap(df).pairs().collect()))
    monkeypatch.setattr(overlap, "CHUNK", 7)
    assert sorted(map(tuple, overlap.Overlap(df).pairs().collect())) == want and len(want) >= 150

def lossy_pairs(kind):
    """Pairs just within 4.0 grey levels: blank pictures with a spot of seven bright pixels, or pictures of so little contrast that noise turns most signs."""
    rng = np.random.default_rng(21)
    rows = []
    for i in range(150):
        if kind == "spot":
            p, far = np.round(30 + rng.normal(0, 3, (18, 24))), np.zeros(18 * 24)
            far[rng.permutation(18 * 24)[:7]] = 1
            far = far.reshape(18, 24)
        else:
            p, far = np.round(120 + rng.normal(0, 1, (18, 24))), rng.uniform(-1, 1, (18, 24))
        q = next(q for k in np.linspace(220, 0, 2000) if np.abs((q := np.round(p + k * far)) - q.mean() - (p - p.mean())).mean() <= 4.0)
        rows += [(2 * i, bytearray(as_png(p)), "train", "s", "", 0), (2 * i + 1, bytearray(as_png(q)), "val", "s", "", 0)]
    return rows


@pytest.mark.parametrize("kind", ["spot", "low"])
def test_nothing_is_dropped_before_the_distance(spark, kind):
    rows = lossy_pairs(kind)
    want = brute([(r[0], bytes(r[1]), *r[2:]) for r in rows])
    assert {(2 * i, 2 * i + 1) for i in range(150)} <= want
    assert set(map(tuple, overlap.Overlap(spark.createDataFrame(rows, ROWS)).pairs().collect())) == want
