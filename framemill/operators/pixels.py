"""Pixel operators over tables with an ``image`` column, as Arrow maps: pixels stay in their task, numbers come out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framemill.functions import images
from framemill.functions.png import decode, encode


def _kept(df: DataFrame, keep: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)


def _map(df: DataFrame, keep: list[str], columns: str, compute) -> DataFrame:
    """Runs compute(pixels) -> list of Arrow arrays over the pictures that decode; the others are left out."""
    schema = f"{_kept(df, keep)}, {columns}"
    names = [*keep, *(c.split()[0] for c in columns.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, pixels in decode(b.column("image").to_pylist()):
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(at)) for c in keep), *compute(pixels)], names=names)

    return df.select(*keep, "image").mapInArrow(run, schema)


def measures(df: DataFrame, keep: list[str], mode: str = "auto") -> DataFrame:
    """keep..., height, width, mean_grey, channel_lead, swapped, phash (of the reordered picture), near_black."""

    def compute(p):
        ordered = images.order_channels(p, mode)
        lead = images.channel_lead(p)
        n = len(p)
        return [
            pa.array(np.full(n, p.shape[1], np.int32)), pa.array(np.full(n, p.shape[2], np.int32)), pa.array(p.mean(axis=(1, 2, 3))), pa.array(lead),
            pa.array((ordered != p).any(axis=(1, 2, 3))), pa.array(images.phash(ordered)), pa.array(images.near_black(p)),
        ]

    return _map(df, keep, "height int, width int, mean_grey double, channel_lead double, swapped boolean, phash bigint, near_black boolean", compute)


def grey_frames(df: DataFrame, keep: list[str], grey: str = "mean", crop: str = "quarter") -> DataFrame:
    """keep..., frame: the centre in grey as an array of float, row by row."""

    def compute(p):
        g = images.grey_centre(p, grey, crop).reshape(len(p), -1)
        return [pa.ListArray.from_arrays(pa.array(np.arange(0, g.size + 1, g.shape[1], dtype=np.int32)), pa.array(g.ravel()))]

    return _map(df, keep, "frame array<float>", compute)


def histograms(df: DataFrame, by: list[str], bins: int = 64) -> DataFrame:
    """by..., channel, bin, n, share: summed in each batch before anything is shuffled; share of the channel's pixels."""
    schema = f"{_kept(df, by)}, channel int, bin int, n bigint"

    def run(batches):
        for b in batches:
            for at, pixels in decode(b.column("image").to_pylist()):
                groups: dict[tuple, list[int]] = {}
                for i, key in enumerate(zip(*(b.column(c).take(pa.array(at)).to_pylist() for c in by))):
                    groups.setdefault(key, []).append(i)
                for key, i in groups.items():
                    h = images.histogram(pixels[i], bins)
                    c, v = np.nonzero(h)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([k] * len(c), b.schema.field(f).type) for k, f in zip(key, by)), pa.array(c.astype(np.int32)), pa.array(v.astype(np.int32)), pa.array(h[c, v])], names=[*by, "channel", "bin", "n"]
                    )

    sums = df.select(*by, "image").mapInArrow(run, schema).groupBy(*by, "channel", "bin").agg(F.sum("n").alias("n"))
    whole = sums.groupBy(*by, "channel").agg(F.sum("n").alias("_w_"))
    keys = [F.col(f"s.{c}").eqNullSafe(F.col(f"w.{c}")) for c in (*by, "channel")]
    cond = keys[0]
    for k in keys[1:]:
        cond = cond & k
    return sums.alias("s").join(whole.alias("w"), cond).select(*(f"s.{c}" for c in (*by, "channel", "bin", "n")), (F.col("n") / F.col("_w_")).alias("share"))


def reordered(df: DataFrame, mode: str) -> DataFrame:
    """The table with its pictures in the wanted channel order; pictures that need no change, or do not decode, keep their bytes."""

    def run(batches):
        for b in batches:
            data = b.column("image").to_pylist()
            for at, pixels in decode(data):
                ordered = images.order_channels(pixels, mode)
                for i in np.flatnonzero((ordered != pixels).any(axis=(1, 2, 3))):
                    data[at[i]] = encode(ordered[i])
            k = b.schema.get_field_index("image")
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary()) if j == k else c for j, c in enumerate(b.columns)], names=b.schema.names)

    return df.mapInArrow(run, df.schema)


def marker_reports(means: DataFrame, by: list[str], height: str = "height", width: str = "width", base: str = "base", least: int = 10) -> DataFrame:
    """by..., valid_dots, all_blobs, markered (``least`` dots or more) of mean images given as arrays."""
    schema = f"{_kept(means, by)}, valid_dots int, all_blobs int, markered boolean"

    def run(batches):
        for b in batches:
            out = [images.marker_dots(np.array(v, float).reshape(h, w)) for v, h, w in zip(b.column(base).to_pylist(), b.column(height).to_pylist(), b.column(width).to_pylist())]
            dots, every = (np.array([o[i] for o in out], np.int32) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in by), pa.array(dots), pa.array(every), pa.array(dots >= least)], names=[*by, "valid_dots", "all_blobs", "markered"])

    return means.select(*by, height, width, base).mapInArrow(run, schema)
