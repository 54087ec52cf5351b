"""Same or near-same pictures across splits.

Pictures are canonicalised (decoded, channels averaged, own mean subtracted; all
in whole numbers, so equal pictures are exactly equal) and hashed. One hash of
the whole canonical picture puts exact copies into classes, also of pictures
that differ in brightness or encoding only. Near copies are found without loss: a
picture is cut into blocks, and the mean absolute difference of block means, weighted
by block size, is never above that of the pixels; neither is the difference of a
contrast of block means. Two contrasts give a training picture its cell and an
evaluation picture all cells in reach; inside a cell coarse blocks, then fine ones,
drop pairs that must be too far apart, and the exact distance decides the rest.
The comparisons inside cells grow with the square of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framemill.functions.png import decode
from framemill.session import checkpointed, written

#: Grey levels of mean absolute difference up to which two pictures are near-same.
MOST = 4.0
#: Blocks that a picture is cut into, and how many of these per side make a coarse block.
BLOCKS, COARSE = 108, 3
#: Steps a grey level in which block means are kept, and what rounding them (twice half a step) and float sums can add to a bound, with room to spare.
STEPS, SLACK = 64, 1 / 32
#: Pictures of either side that one task compares at a time, and the tile of evaluation and training pictures that stays in its cache.
CHUNK, TILE = 32_768, (32, 4096)

# The band hashes below (with sketch and sample) are a lossy search. Overlap does not use them; a test still measures them.
#: Contrasts per band, and the grid width in standard deviations that grey noise of NOISE levels gives a contrast.
CONTRASTS, WIDTH, NOISE = 20, 2.4, 7.5
#: Cells that evaluation pictures look into per band: their own, those across the nearest SINGLES grid lines, those across two of the nearest PAIRS.
SINGLES, PAIRS = 8, 4
#: Grey levels from its mean beyond which a pixel counts as that far, so that a spot does not outweigh the picture.
CLIP = 32
#: Cells per side to which larger pictures are averaged before they are hashed (the distance is always of all pixels).
SIDE = 32
#: Bits of 64 in which the sketches of near pictures may differ; unrelated ones differ in about half.
SKETCH = 26
#: Pixels that are compared before whole pictures are fetched, and the mean difference of these up to which a pair is fetched.
SAMPLE, SAMPLE_MOST = 64, 8.0

_PLANS: dict = {}
_ODD: dict = {}


def _plan(height: int, width: int):
    """The contrast matrix of a picture shape, with grid widths, shifts and multipliers per column; sketch columns last."""
    if (height, width) not in _PLANS:
        rng = np.random.default_rng(20_250_301)
        h, w = max(height // 2, 1), max(width // 2, 1)
        tops, lefts = sorted({0, (height - h) // 2, height - h}), sorted({0, (width - w) // 2, width - w})
        windows = [(t, left) for t in tops for left in lefts]
        columns, widths = [], []
        for top, left in windows:
            signs = rng.choice([-1.0, 1.0], (h * w, CONTRASTS))
            window = np.zeros((height, width, CONTRASTS))
            window[top : top + h, left : left + w] = ((signs - signs.mean(axis=0)) / (h * w)).reshape(h, w, CONTRASTS)
            columns.append(window.reshape(height * width, CONTRASTS))
            widths += [WIDTH * NOISE / np.sqrt(h * w)] * CONTRASTS
        signs = rng.choice([-1.0, 1.0], (height * width, 64))
        columns.append(signs - signs.mean(axis=0))
        multipliers = rng.integers(1, 2**62, len(widths)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        pixels = rng.permutation(height * width)[:SAMPLE]
        _PLANS[height, width] = np.concatenate(columns, axis=1).astype(np.float32), np.array(widths), rng.random(len(widths)), multipliers, len(windows), pixels
    return _PLANS[height, width]


def canonical(pixels: np.ndarray) -> np.ndarray:
    """int64 (n, pixels): three times the pixel count times (grey - own mean), exactly."""
    n, height, width, channels = pixels.shape
    grey = pixels.astype(np.int64).sum(axis=3).reshape(n, -1) * (3 // channels)
    return grey * (height * width) - grey.sum(axis=1, keepdims=True)


def _mix(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))


def _odd(size: int) -> np.ndarray:
    if size not in _ODD:
        _ODD[size] = np.random.default_rng(size).integers(0, 2**62, (2, size)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return _ODD[size]


def class_hash(c: np.ndarray, height: int, width: int) -> np.ndarray:
    """Two 64-bit hashes of each canonical picture, with its shape."""
    with np.errstate(over="ignore"):
        u = c.astype(np.uint64)
        u = (u ^ (u >> np.uint64(17))) * np.uint64(0xBF58476D1CE4E5B9)
        u ^= u >> np.uint64(31)
        return np.stack([_mix((u * m).sum(axis=1, dtype=np.uint64), np.uint64(height << 32 | width)) for m in _odd(c.shape[1])], axis=1).view(np.int64)


def _raw(c: np.ndarray, height: int, width: int) -> np.ndarray:
    """Canonical pictures in grey levels; large ones averaged over at most SIDE x SIDE cells, which brings no two pictures further apart."""
    g = (c / (3 * height * width)).astype(np.float32).reshape(-1, height, width)
    for axis, size in ((1, height), (2, width)):
        if size > SIDE:
            edges = np.linspace(0, size, SIDE + 1).astype(int)
            g = np.add.reduceat(g, edges[:-1], axis=axis) / np.diff(edges).reshape((-1, 1) if axis == 1 else (-1,)).astype(np.float32)
    return g.reshape(len(g), -1)


def band_hashes(c: np.ndarray, height: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int32 (n, bands), int32 (n, bands, probes) whose first is the band's own, int64 sketch (n), int8 (n, sampled pixels)."""
    h, w = min(height, SIDE), min(width, SIDE)
    g = np.clip(_raw(c, height, width), -CLIP, CLIP)
    matrix, widths, shifts, multipliers, bands, pixels = _plan(h, w)
    all_contrasts = (g @ matrix).astype(np.float64)
    sketch = np.packbits(all_contrasts[:, len(widths) :] > 0, axis=1).view(np.int64).ravel()
    at = all_contrasts[:, : len(widths)] / widths + shifts
    cell = np.floor(at)
    part = (at - cell).reshape(len(c), bands, CONTRASTS)
    order = np.argsort(np.minimum(part, 1 - part), axis=2)[:, :, : max(SINGLES, PAIRS)]
    with np.errstate(over="ignore"):
        terms = (cell.astype(np.int64).view(np.uint64) * multipliers).reshape(len(c), bands, CONTRASTS)
        own = terms.sum(axis=2, dtype=np.uint64)
        # crossing the nearest grid line adds or takes one multiplier
        turn = np.where(part < 0.5, np.uint64(2**64 - 1), np.uint64(1)) * multipliers.reshape(bands, CONTRASTS)
        turn = np.take_along_axis(turn, order, axis=2)
        probes = [own, *(own + turn[:, :, i] for i in range(SINGLES)), *(own + turn[:, :, i] + turn[:, :, j] for i in range(PAIRS) for j in range(i))]
        keys = np.stack(probes, axis=2)
        for x in (np.arange(bands, dtype=np.uint64)[:, None], np.uint64(height << 32 | width)):
            keys = _mix(keys, x)
    keys = (keys >> np.uint64(13)).astype(np.uint32).view(np.int32)
    sample = np.clip(np.round(_raw(c, height, width)[:, pixels]), -127, 127).astype(np.int8)
    return np.ascontiguousarray(keys[:, :, 0]), keys, sketch, sample


def _grid(height: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the rows and of the columns of blocks."""
    rows = min(max(round((BLOCKS * height / width) ** 0.5), 1), height, BLOCKS)
    return np.linspace(0, height, rows + 1).astype(int), np.linspace(0, width, min(BLOCKS // rows, width) + 1).astype(int)


def block_means(c: np.ndarray, height: int, width: int) -> np.ndarray:
    """int16 (n, blocks): block means of canonical pictures, in steps of 1 / STEPS grey levels."""
    ys, xs = _grid(height, width)
    sums = np.add.reduceat(np.add.reduceat(c.reshape(-1, height, width), ys[:-1], axis=1), xs[:-1], axis=2)
    return np.round(sums * (STEPS / (3 * height * width)) / np.outer(np.diff(ys), np.diff(xs))).astype(np.int16).reshape(len(c), -1)


def weighted(means: np.ndarray, height: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """float32 (n, blocks), (n, coarse blocks), (n, 2 contrasts) of block means.

    Weighted by size: for two pictures, the sum of absolute differences of either
    kind of block, and each difference of a contrast, is at most their mean
    absolute difference of pixels + SLACK.
    """
    ys, xs = _grid(height, width)
    fine = means.astype(np.float32) * (np.outer(np.diff(ys), np.diff(xs)).ravel() / (STEPS * height * width)).astype(np.float32)
    rows, columns = len(ys) - 1, len(xs) - 1
    field = fine.reshape(-1, rows, columns)
    coarse = np.add.reduceat(np.add.reduceat(field, np.arange(0, rows, COARSE), axis=1), np.arange(0, columns, COARSE), axis=2)
    half = lambda n: np.where(np.arange(n) < n // 2, np.float32(1), np.float32(-1))
    return fine, coarse.reshape(len(means), -1), np.stack([field.sum(axis=1) @ half(columns), field.sum(axis=2) @ half(rows)], axis=1)


def cells(contrasts: np.ndarray, most: float) -> tuple[np.ndarray, list[list[int]]]:
    """int64 (n): the cell of each picture; and all cells in which pictures at most ``most`` away can lie."""
    size = max(2 * most, 1.0)
    at = lambda x: np.floor(x / size).astype(np.int64)
    code = lambda x, y: (x + 2**15) * 2**16 + y + 2**15
    own, low, high = at(contrasts), at(contrasts - most - SLACK), at(contrasts + most + SLACK)
    reach = [[code(x, y) for x in range(a, b + 1) for y in range(c, d + 1)] for (a, c), (b, d) in zip(low.tolist(), high.tolist())]
    return code(own[:, 0], own[:, 1]), reach


def _hashed(most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _hashes(batches, most)

    return run


def _hashes(batches: Iterator[pa.RecordBatch], most: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, pixels in decode(batch.column("image").to_pylist()):
            _, height, width, _ = pixels.shape
            c = canonical(pixels)
            whole = class_hash(c, height, width)
            means = block_means(c, height, width)
            cell, reach = cells(weighted(means, height, width)[2], most)
            take = pa.array(at)
            full = lambda x: pa.array(np.full(len(c), x, np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_id").take(take), batch.column("split").take(take), batch.column("source").take(take), pa.array(whole[:, 0]), pa.array(whole[:, 1]),
                    full(height), full(width), pa.array(cell), pa.array(reach, pa.list_(pa.int64())), pa.array([x.tobytes() for x in means], pa.binary()),
                ],
                names=["row_id", "split", "source", "h1", "h2", "height", "width", "cell", "reach", "means"],
            )


def hashed(rows: DataFrame, most: float = MOST) -> DataFrame:
    """row_id, split, source, h1, h2, height, width, cell, reach (cells of near pictures) and block means for the rows of train, val and test whose pictures decode."""
    split = F.lower(F.regexp_replace("split", r"^\s+|\s+$", ""))
    wanted = rows.select(F.col("row_id").cast("bigint").alias("row_id"), "image", split.alias("split"), F.col("source").cast("string").alias("source"))
    wanted = wanted.where(F.col("split").isin("train", "val", "test") & F.col("image").isNotNull() & F.col("row_id").isNotNull())
    return wanted.mapInArrow(_hashed(most), "row_id bigint, split string, source string, h1 bigint, h2 bigint, height int, width int, cell bigint, reach array<bigint>, means binary")


def _pixels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, pixels in decode(batch.column("image").to_pylist()):
            c = canonical(pixels)
            small = np.ascontiguousarray(pixels.astype(np.uint16).sum(axis=3).reshape(len(c), -1) * (3 // pixels.shape[3])).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id").take(pa.array(at)), pa.array(np.full(len(c), pixels.shape[1], np.int32)), pa.array([x.tobytes() for x in small], pa.binary())], names=["row_id", "height", "grey"]
            )


def _verified(most: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("grey_a").to_pylist(), batch.column("grey_b").to_pylist()
            near = np.zeros(len(a), bool)
            sizes = np.array([len(x) if len(x) == len(y) else -1 for x, y in zip(a, b)])
            for size in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == size)
                n = int(size) // 2
                d = np.frombuffer(b"".join(a[i] for i in at), "<u2").reshape(-1, n).astype(np.int64) - np.frombuffer(b"".join(b[i] for i in at), "<u2").reshape(-1, n)
                d = d * n - d.sum(axis=1, keepdims=True)
                near[at] = np.abs(d).sum(axis=1) <= most * 3 * n * n
            at = pa.array(np.flatnonzero(near))
            yield pa.RecordBatch.from_arrays([batch.column("rep_a").take(at), batch.column("rep_b").take(at)], names=["rep_a", "rep_b"])

    return verify


def within(a: np.ndarray, b: np.ndarray, height: int, width: int, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b (block means) of all pairs that their blocks leave possible at ``most``: no pair within it is missing."""
    (fa, ca, ka), (fb, cb, kb) = weighted(a, height, width), weighted(b, height, width)
    bound = np.float32(most + SLACK)
    by_a, by_b = np.argsort(ka[:, 0], kind="stable"), np.argsort(kb[:, 0], kind="stable")
    fa, ca, ka, fb, cb, kb = fa[by_a], ca[by_a], ka[by_a, 0], fb[by_b], np.ascontiguousarray(cb[by_b].T), kb[by_b, 0]
    out_a, out_b = [], []
    for i in range(0, len(a), TILE[0]):
        part = ca[i : i + TILE[0]]
        first, last = np.searchsorted(kb, ka[i] - bound), np.searchsorted(kb, ka[i : i + TILE[0]][-1] + bound, "right")
        for j in range(first, last, TILE[1]):
            end = min(j + TILE[1], last)
            total, step = np.zeros((len(part), end - j), np.float32), np.empty((len(part), end - j), np.float32)
            for d in range(part.shape[1]):
                np.subtract(part[:, d, None], cb[d, j:end], out=step)
                np.abs(step, out=step)
                total += step
            x, y = np.nonzero(total <= bound)
            for k in range(0, len(x), TILE[1]):
                p, q = x[k : k + TILE[1]] + i, y[k : k + TILE[1]] + j
                near = np.abs(fa[p] - fb[q]).sum(axis=1) <= bound
                out_a.append(by_a[p[near]])
                out_b.append(by_b[q[near]])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _met(most: float):
    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = left.column("rep_a").to_numpy(), right.column("rep_b").to_numpy()
        x = y = np.zeros(0, np.int64)
        if len(a) and len(b):
            height, width = key[0].as_py(), key[1].as_py()
            means = lambda column: np.frombuffer(b"".join(column.to_pylist()), np.int16).reshape(len(column), -1)
            x, y = within(means(left.column("means")), means(right.column("means_b")), height, width, most)
        other = a[x] != b[y]
        return pa.table({"rep_a": pa.array(a[x][other], pa.int64()), "rep_b": pa.array(b[y][other], pa.int64())})

    return compare


def _candidates(classes: DataFrame, most: float) -> DataFrame:
    """rep_a (evaluation), rep_b (training): every pair of different classes that block means leave possible; each once.

    A cell is compared in chunks of about CHUNK x CHUNK pictures, so a crowded one is many groups.
    """
    key = ["height", "width", "cell"]
    ev = classes.where("has_eval").select("height", "width", F.explode("reach").alias("cell"), F.col("rep").alias("rep_a"), "means")
    tr = classes.where("has_train").select(*key, F.col("rep").alias("rep_b"), "means")
    chunks = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias(name))
    sizes = F.broadcast(checkpointed(chunks(ev, "of_a").join(chunks(tr, "of_b"), key)))  # one row per cell that both sides reach
    own = lambda rep, of: F.pmod(F.xxhash64(rep), F.col(of)).cast("int")
    each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    ev = ev.join(sizes, key).select(*key, own("rep_a", "of_a").alias("at_a"), each("of_b").alias("at_b"), "rep_a", "means")
    tr = tr.join(sizes, key).select(*key, each("of_a").alias("at_a"), own("rep_b", "of_b").alias("at_b"), "rep_b", "means")
    key = [*key, "at_a", "at_b"]
    tr = tr.select(*(F.col(c).alias(f"{c}_of_b") for c in key), "rep_b", F.col("means").alias("means_b"))  # both sides stem from one table: no column may bear the other's name
    return ev.groupBy(*key).cogroup(tr.groupBy(*(f"{c}_of_b" for c in key))).applyInArrow(_met(most), "rep_a bigint, rep_b bigint")


def _against(most: float):
    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = left.column("row_id").to_numpy(), right.column("row_id").to_numpy()
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(a) and len(b):
            grey = lambda t, c: np.frombuffer(b"".join(t.column(c).to_pylist()), "<u2").reshape(len(t), -1).astype(np.float32)
            x, y = grey(left, "grey"), grey(right, "grey_b")
            x, y = x - x.mean(axis=1, keepdims=True), y - y.mean(axis=1, keepdims=True)
            for i in range(len(a)):
                d = np.abs(y - x[i]).mean(axis=1) / 3
                at = np.flatnonzero(d <= most + SLACK)
                out_a.append(np.full(len(at), a[i]))
                out_b.append(b[at])
        return pa.table({"rep_a": pa.array(np.concatenate(out_a), pa.int64()), "rep_b": pa.array(np.concatenate(out_b), pa.int64())})

    return compare


def compared(rows: DataFrame, every: int, most: float = MOST) -> DataFrame:
    """row_id_a, row_id_b: the pairs of rows whose row_id is divisible by ``every``, by comparing each with all rows, in blocks.

    No search and no classes: what this finds is what there is. The queries meet
    all rows, so the cost grows with the square of the table.
    """
    split = F.lower(F.regexp_replace("split", r"^\s+|\s+$", ""))
    wanted = rows.select(F.col("row_id").cast("bigint").alias("row_id"), "image", split.alias("split")).where(F.col("split").isin("train", "val", "test") & F.col("image").isNotNull() & F.col("row_id").isNotNull())
    grey = wanted.select("row_id", "image").mapInArrow(_pixels, "row_id bigint, height int, grey binary").join(wanted.select("row_id", (F.col("split") == "train").alias("train")), "row_id")
    grey = written(grey.select("row_id", "height", F.length("grey").alias("size"), "train", "grey"))
    n, shape = grey.count(), ["height", "size"]
    of_q, of_r = max(-(-n // (every * 4096)), 1), max(-(-n // 16_384), 1)
    block = lambda of: F.pmod(F.xxhash64("row_id"), F.lit(of)).cast("int")
    every_block = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    queries = grey.where(F.col("row_id") % every == 0).select(*shape, F.col("train").alias("side"), block(of_q).alias("q"), every_block(of_r).alias("r"), "row_id", "grey")
    others = grey.select(*(F.col(c).alias(f"{c}_b") for c in shape), (~F.col("train")).alias("side_b"), every_block(of_q).alias("q_b"), block(of_r).alias("r_b"), "row_id", F.col("grey").alias("grey_b"))
    met = queries.groupBy(*shape, "side", "q", "r").cogroup(others.groupBy("height_b", "size_b", "side_b", "q_b", "r_b")).applyInArrow(_against(most), "rep_a bigint, rep_b bigint")
    pixels = grey.select("row_id", "grey")
    both = met.join(pixels.toDF("rep_a", "grey_a"), "rep_a").join(pixels.toDF("rep_b", "grey_b"), "rep_b").mapInArrow(_verified(most), "rep_a bigint, rep_b bigint")
    return both.select(F.least("rep_a", "rep_b").alias("row_id_a"), F.greatest("rep_a", "rep_b").alias("row_id_b")).distinct()


class Overlap:
    """Cross-split overlaps of a picture table, by classes of exact copies.

    members: row_id, split, source, rep (the smallest row_id of the class).
    links: rep_a, rep_b: classes with evaluation and training rows, at most
    ``most`` grey levels apart (a class with both is linked with itself).

    Pictures that do not decode in full, rows without row_id and splits other
    than train, val and test (read loosely) take no part. Null sources stay null.
    Shapes must agree. Repeated pictures are one class, so their number does not
    multiply the comparisons. Empty tables give empty results; extra columns are
    ignored.
    """

    def __init__(self, rows: DataFrame, most: float = MOST):
        h = checkpointed(hashed(rows, most))
        classes = h.groupBy("h1", "h2").agg(
            F.min("row_id").alias("rep"), F.max(F.col("split") != "train").alias("has_eval"), F.max(F.col("split") == "train").alias("has_train"), *(F.first(c).alias(c) for c in ("height", "width", "cell", "reach", "means"))
        )
        classes = checkpointed(classes)
        self.members = h.select("row_id", "split", "source", "h1", "h2").join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).drop("h1", "h2")
        met = checkpointed(_candidates(classes, most))
        wanted = met.select(F.col("rep_a").alias("row_id")).union(met.select("rep_b")).distinct()
        grey = rows.select(F.col("row_id").cast("bigint").alias("row_id"), "image").join(wanted, "row_id", "left_semi").mapInArrow(_pixels, "row_id bigint, height int, grey binary")
        side = lambda x: grey.select(F.col("row_id").alias(f"rep_{x}"), F.col("height").alias(f"height_{x}"), F.col("grey").alias(f"grey_{x}"))
        near = met.join(side("a"), "rep_a").join(side("b"), "rep_b").where("height_a = height_b").select("rep_a", "rep_b", "grey_a", "grey_b").mapInArrow(_verified(most), "rep_a bigint, rep_b bigint")
        same = classes.where("has_eval and has_train").select(F.col("rep").alias("rep_a"), F.col("rep").alias("rep_b"))
        self.links = same.unionByName(near)

    def pairs(self) -> DataFrame:
        """All pairs of rows, one of an evaluation split, one of train: row_id_a < row_id_b. As many rows as there are pairs."""
        m = self.members
        ev = m.where("split <> 'train'").select(F.col("rep").alias("rep_a"), F.col("row_id").alias("e"))
        tr = m.where("split = 'train'").select(F.col("rep").alias("rep_b"), F.col("row_id").alias("t"))
        both = self.links.join(ev, "rep_a").join(tr, "rep_b")
        return both.select(F.least("e", "t").alias("row_id_a"), F.greatest("e", "t").alias("row_id_b"))

    def report(self) -> DataFrame:
        """Per evaluation split and source: rows, rows with a same or near-same training row, of these with a same one, pairs.

        Counted from class sizes, without making the pairs.
        """
        trained = self.members.where("split = 'train'").groupBy(F.col("rep").alias("rep_b")).agg(F.count(F.lit(1)).alias("n"))
        hits = self.links.join(trained, "rep_b").groupBy(F.col("rep_a").alias("rep")).agg(F.sum("n").alias("n"), F.max(F.col("rep_a") == F.col("rep_b")).alias("same"))
        ev = self.members.where("split <> 'train'").groupBy("split", "source", "rep").agg(F.count(F.lit(1)).alias("rows"))
        return ev.join(hits, "rep", "left").groupBy("split", "source").agg(
            F.sum("rows").alias("eval_rows"), F.sum(F.when(F.col("n").isNotNull(), F.col("rows")).otherwise(0)).alias("overlapping"),
            F.sum(F.when(F.col("same"), F.col("rows")).otherwise(0)).alias("same"), F.sum(F.coalesce(F.col("rows") * F.col("n"), F.lit(0))).alias("pairs"),
        )
