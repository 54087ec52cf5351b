"""Per-key results when a few keys hold most rows.

Rows are range-partitioned on (key, secondary order) with Spark's sampled
quantiles. As the secondary order is part of the range key, a heavy key is cut
over as many partitions as its weight asks for. Each partition then folds its
sorted rows into one partial state per key, and the states of a key that
crosses partition boundaries are stitched in partition order. A key has at most
one state per partition, so no task ever holds a key's rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framemill.session import loose, shuffle_width

SPLITS = ("train", "val", "test")
STATE = (
    "part int, key_field string, key_text string, records bigint, others bigint, first_other string, last_other string, "
    "train bigint, val bigint, test bigint, outside bigint, first_written timestamp_ntz, last_written timestamp_ntz"
)


def _changes(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """True where a value differs from the one before it; null equals null only."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return pa.array([], pa.bool_())
    now, before = column.slice(1), column.slice(0, len(column) - 1)
    differs = pc.if_else(
        pc.and_(pc.is_valid(now), pc.is_valid(before)),
        pc.fill_null(pc.not_equal(now, before), False),
        pc.not_equal(pc.is_valid(now), pc.is_valid(before)),
    )
    return pa.concat_arrays([pa.array([True]), differs])


def _fold(t: pa.Table) -> list[dict]:
    """One state per key of a sorted batch, in order."""
    key_new = pc.or_(_changes(t["key_field"]), _changes(t["key_text"]))
    other_new = pc.and_(pc.or_(key_new, _changes(t["other"])), pc.is_valid(t["other"].combine_chunks()))
    run = pc.cumulative_sum(pc.cast(key_new, pa.int64()))
    split = t["split"].combine_chunks()
    flags = {s: pc.cast(pc.fill_null(pc.equal(split, s), False), pa.int64()) for s in SPLITS}
    flat = pa.table(
        {"run": run, "key_field": t["key_field"], "key_text": t["key_text"], "other": t["other"], "new": pc.cast(other_new, pa.int64()), "written_at": t["written_at"]} | flags
    )
    g = flat.group_by("run", use_threads=False).aggregate(
        [("key_field", "first"), ("key_text", "first"), ("run", "count"), ("new", "sum"), ("written_at", "min"), ("written_at", "max")]
        + [(s, "sum") for s in SPLITS]
        + [("other", "first"), ("other", "last")]
    )
    return [
        {
            "key_field": r["key_field_first"], "key_text": r["key_text_first"], "records": r["run_count"], "others": r["new_sum"],
            "first_other": r["other_first"], "last_other": r["other_last"],
            "train": r["train_sum"], "val": r["val_sum"], "test": r["test_sum"], "outside": r["run_count"] - r["train_sum"] - r["val_sum"] - r["test_sum"],
            "first_written": r["written_at_min"], "last_written": r["written_at_max"],
        }
        for r in g.to_pylist()
    ]


def stitch(a: dict, b: dict) -> dict:
    """The state of two neighbouring runs of one key; a value on both sides of the boundary counts once."""
    keep = lambda f, x, y: y if x is None else x if y is None else f(x, y)
    same = a["last_other"] is not None and a["last_other"] == b["first_other"]
    return a | {k: a[k] + b[k] for k in ("records", "train", "val", "test", "outside")} | {
        "others": a["others"] + b["others"] - same,
        "first_other": a["first_other"] if a["first_other"] is not None else b["first_other"],
        "last_other": b["last_other"] if b["last_other"] is not None else a["last_other"],
        "first_written": keep(min, a["first_written"], b["first_written"]),
        "last_written": keep(max, a["last_written"], b["last_written"]),
    }


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    schema = pa.schema(
        [("part", pa.int32()), ("key_field", pa.string()), ("key_text", pa.string()), ("records", pa.int64()), ("others", pa.int64()), ("first_other", pa.string()), ("last_other", pa.string())]
        + [(c, pa.int64()) for c in ("train", "val", "test", "outside")]
        + [("first_written", pa.timestamp("us")), ("last_written", pa.timestamp("us"))]
    )
    open_state: dict | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        states = _fold(pa.Table.from_batches([batch]))
        if open_state is not None:
            if (open_state["key_field"], open_state["key_text"]) == (states[0]["key_field"], states[0]["key_text"]):
                states[0] = stitch(open_state, states[0])
            else:
                states.insert(0, open_state)
        open_state = states.pop()
        if states:
            yield pa.RecordBatch.from_pylist([s | {"part": part} for s in states], schema)
    if open_state is not None:
        yield pa.RecordBatch.from_pylist([open_state | {"part": part}], schema)


def per_key(rows: DataFrame, keys: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Results for every value of every key column, heavy or not.

    rows: needs row_id, split, written_at and the key columns; others are ignored.
    keys: {key column: the other column whose distinct values are counted}.
    Returns key_field, key_text, records, others (distinct values of the other
    column), train, val, test, outside (records by split, read loosely; outside:
    any other or no split), splits (how many of the three occur), first_written,
    last_written.

    Keys are read loosely; rows whose key names nothing (null, blank, 'unknown')
    are left out. Null written_at are ignored by first and last (null if all
    are). Repeated rows count as often as they come. No rows give no keys.
    """
    n = partitions or 2 * shuffle_width(rows.sparkSession)
    split = F.lower(F.trim(F.col("split")))
    long = None
    for key, other in keys.items():
        part = rows.select(
            F.lit(key).alias("key_field"), loose(F.col(key)).alias("key_text"), loose(F.col(other)).alias("other"),
            F.when(split.isin(*SPLITS), split).alias("split"), F.col("written_at").cast("timestamp_ntz").alias("written_at"), F.col("row_id").cast("bigint").alias("row_id"),
        ).where(F.col("key_text").isNotNull())
        long = part if long is None else long.unionByName(part)
    order = ["key_field", "key_text", "other", "written_at", "row_id"]
    states = long.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("row_id").mapInArrow(_partials, STATE)
    # at most one state per key and partition: the list is bounded by the number of partitions
    pieces = F.sort_array(F.collect_list(F.struct("part", "first_other", "last_other")))
    sums = {c: F.sum(c).alias(c) for c in ("records", "train", "val", "test", "outside")}
    stitched = states.groupBy("key_field", "key_text").agg(
        *sums.values(), F.sum("others").alias("runs"), pieces.alias("pieces"), F.min("first_written").alias("first_written"), F.max("last_written").alias("last_written")
    )
    shared = F.aggregate(
        "pieces",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("string").alias("last")),
        lambda a, p: F.struct(
            (a["n"] + F.when(a["last"] == p["first_other"], 1).otherwise(0)).cast("bigint").alias("n"), F.coalesce(p["last_other"], a["last"]).alias("last")
        ),
    )["n"]
    return stitched.select(
        "key_field", "key_text", "records", (F.col("runs") - shared).alias("others"), "train", "val", "test", "outside",
        sum(F.when(F.col(s) > 0, 1).otherwise(0) for s in SPLITS).alias("splits"), "first_written", "last_written",
    )


def heavy(results: DataFrame, rows: DataFrame, share: float = 0.02) -> DataFrame:
    """Keys that hold at least ``share`` of all rows (rows without a key count in the whole)."""
    return results.where(F.col("records") >= F.lit(share * rows.count()))  # the count comes from the footers
