"""Reference images per group: which frames count, and their element-wise median, mean or deviation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framemill.functions.ranks import md5_number
from framemill.session import written

KINDS = ("median", "mean", "stddev_pop")


def first_n(frames: DataFrame, group: list[str], order: list[str], n: int = 10) -> DataFrame:
    """The first n frames of each group (all, if it has fewer)."""
    return frames.withColumn("_rn_", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_rn_") <= n).drop("_rn_")


def random_n(frames: DataFrame, group: list[str], key: list[str], n: int, seed: int = 0) -> DataFrame:
    """n frames of each group (of all frames, for no group) without replacement, the same in every run: smallest hashes of seed and key."""
    draw = md5_number(F.lit(seed), *(F.col(c) for c in key))
    if not group:
        return frames.orderBy(draw, *key).limit(n)
    return first_n(frames.withColumn("_draw_", draw), group, ["_draw_", *key], n).drop("_draw_")


def at_least(frames: DataFrame, group: list[str], n: int) -> DataFrame:
    """Only the frames of groups of at least n."""
    big = frames.groupBy(*group).agg(F.count(F.lit(1)).alias("_n_")).where(F.col("_n_") >= n).drop("_n_")
    return frames.join(big, group, "left_semi")


def elementwise(frames: DataFrame, group: list[str], column: str, kind: str = "median") -> DataFrame:
    """One array per group: the median (mean, population deviation) of every position, in double.

    Frames of a group must have one length. Null frames are passed over; groups
    of null frames only are left out. Frames stay arrays throughout: sums are added up
    per batch before they move, and a median moves each frame once. It holds a
    group's frames, so take a selection of bounded size first.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    keys = "".join(f"`{c}` {frames.schema[c].dataType.simpleString()}, " for c in group)
    one = frames.where(F.col(column).isNotNull()).select(*group, F.col(column).cast("array<double>").alias("_v_"))
    rows = lambda t: np.stack([np.array(v, float) for v in t.column("_v_").to_pylist()]) if len(t) else np.zeros((0, 0))  # noqa: E731 - null values are NaN

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(b.column(c).to_pylist() for c in group))) if group else enumerate([()] * b.num_rows):
                places.setdefault(key, []).append(i)
            for at in places.values():
                part = b.take(pa.array(at))
                v = rows(part)
                middle = v.mean(axis=0)  # deviations are summed about the batch's own mean, so that nothing cancels
                head = [part.column(c).slice(0, 1) for c in group]
                yield pa.RecordBatch.from_arrays([*head, pa.array([len(v)], pa.int64()), pa.array([middle.tolist()]), pa.array([((v - middle) ** 2).sum(axis=0).tolist()])], names=[*group, "n", "middle", "spread"])

    def last(t: pa.Table) -> pa.Table:
        if kind == "median":
            base = np.median(rows(t), axis=0)
        else:
            n, middle, spread = np.array(t.column("n").to_pylist(), float)[:, None], np.array(t.column("middle").to_pylist(), float), np.array(t.column("spread").to_pylist(), float)
            mean = (n * middle).sum(axis=0) / n.sum()
            base = mean if kind == "mean" else np.sqrt((spread.sum(axis=0) + (n * (middle - mean) ** 2).sum(axis=0)) / n.sum())
        return pa.table({**{c: t.column(c).slice(0, 1) for c in group}, "base": pa.array([base.tolist()], pa.list_(pa.float64()))})

    moved = one if kind == "median" else one.mapInArrow(partial, f"{keys}n bigint, middle array<double>, spread array<double>")
    return moved.groupBy(*(group or [F.lit("all").alias("_all_")])).applyInArrow(last, f"{keys}base array<double>")


def with_base(frames: DataFrame, bases: DataFrame, group: list[str]) -> DataFrame:
    """Frames with their group's base; null where it has none. One base a group, joined as the sizes suggest."""
    return frames.join(bases, group, "left") if group else frames.join(F.broadcast(bases.limit(1)), how="left")


def head_consumed(frames: DataFrame, group: list[str], order: list[str], column: str, n: int = 10) -> DataFrame:
    """The frames after the first n of each group, with the median of those n as base; groups of fewer than n give nothing.

    Places are found by keys alone, and only the heads' frames are shuffled: the
    last key of each head and its base go to where the others lie. Rows that tie with
    the n-th in ``order`` are used up with it. Null groups give nothing; nulls sort first.
    """
    keys = frames.select(*group, *order)
    heads = first_n(keys, group, order, n)
    # the place in order that ends a head, one row per group
    ends = heads.groupBy(*group).agg(F.max(F.struct(*order)).alias("_end_"), F.count(F.lit(1)).alias("_n_")).where(F.col("_n_") >= n).drop("_n_")
    ends = written(ends)
    place = F.struct(*order)
    base = elementwise(frames.join(ends, group).where(place <= F.col("_end_")).select(*group, column), group, column)
    return frames.join(ends.join(base, group), group).where(place > F.col("_end_")).select(*frames.columns, "base")


def keep_or(decision: Column, base: Column) -> Column:
    """A frame without a base is kept whatever the decision."""
    return base.isNull() | decision


def strategy(kind: str, frames: DataFrame, column: str, group: list[str], order: list[str], n: int | None = None, seed: int = 0, least: int = 1, explicit: DataFrame | None = None) -> DataFrame | None:
    """The bases of a strategy: group..., base, or None for 'none'.

    'first_n': the first n (10) frames of a group. 'random_group', 'random_all':
    n (100; 120) frames of each group, of all frames. 'per_touch': all frames of
    a group, or its first n. 'explicit': given as group..., base. Groups with fewer
    than ``least`` chosen frames have no base; 'random_all' gives one row, without group.
    """
    if kind == "none":
        return None
    if kind == "explicit":
        if explicit is None:
            raise ValueError("an explicit baseline must be given")
        return explicit.select(*group, "base")
    if kind == "random_all":
        return elementwise(random_n(frames, [], [*group, *order], n or 120, seed), [], column)
    if kind == "first_n":
        chosen = first_n(frames, group, order, n or 10)
    elif kind == "random_group":
        chosen = random_n(frames, group, order, n or 100, seed)
    elif kind == "per_touch":
        chosen = frames if n is None else first_n(frames, group, order, n)
    else:
        raise ValueError(f"unknown baseline {kind!r}")
    return elementwise(at_least(chosen, group, least) if least > 1 else chosen, group, column)
