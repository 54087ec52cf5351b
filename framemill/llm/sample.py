"""A sample that is the same in every rerun and keeps its members as data grows.

Every frame gets a persistent sequence number when it first arrives. Numbers
form blocks of fixed length, and a hash of the block number alone chooses the
positions taken in the block, also in blocks not yet filled. So a frame's fate is
sealed with its number, and new batches only add frames. The numbers live in a
stored table that is only ever appended to, so neither late rows of an early batch
nor frames without a batch move a frame that was numbered before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framemill.functions.ranks import md5_number, md5_order, running_total
from framemill.session import written
from framemill.store import Store, location

#: Positions in a block: a prime, so that every multiplier makes a permutation of them.
BLOCK = 997

TABLES = {"frames": "capture string, frame_idx bigint, batch_no int, seq bigint"}


def chosen(seq: Column, rate: float, seed: int) -> Column:
    """Whether the sequence number is in the sample.

    In block b the positions p with (m * p + c) mod BLOCK < k are chosen, m, c
    and k from hashes of b: a random one of the affine permutations, under which any
    two positions fall together as often as in a simple random sample. Every block
    gives rate * BLOCK members, rounded up or down by a hash so that the mean is exact.
    """
    block, p = F.floor(seq / BLOCK), seq % BLOCK
    h = lambda i: md5_number(F.lit(seed), F.lit(i), block)
    m = h(1) % F.lit(BLOCK - 1) + 1
    c = h(2) % F.lit(BLOCK)
    u = h(3) / F.lit(2.0**60)
    return (m * p + c) % BLOCK < F.floor(F.lit(rate * BLOCK) + u)


def number(rows: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """capture, frame_idx, batch_no, seq of the frames that the state does not hold, numbered behind it.

    rows: capture, frame_idx, batch_no (others ignored). A frame counts once,
    with the first batch it came in; rows with a null key are no frames; frames
    without a batch_no come last. state: the frames numbered so far, with seq. New frames
    follow in the order of their batch and, within it, of a hash of the key. No
    rows: no frames.
    """
    frames = rows.where("capture is not null and frame_idx is not null").groupBy("capture", F.col("frame_idx").cast("bigint").alias("frame_idx")).agg(F.min(F.col("batch_no").cast("int")).alias("batch_no"))
    first = 0
    if state is not None:
        frames = frames.join(state.select("capture", "frame_idx"), ["capture", "frame_idx"], "left_anti")
        first = state.agg((F.coalesce(F.max("seq"), F.lit(-1)) + 1).alias("n")).first().n
    frames = written(frames.withColumn("_key_", md5_order(F.col("capture"), F.col("frame_idx"))))
    ran = running_total(frames, ["batch_no"], "_key_", ["capture", "frame_idx"], F.lit(1), frames.count())
    # one row per batch
    sizes = frames.groupBy(F.col("batch_no").alias("_batch_")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("_batch_").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offset = sizes.select("_batch_", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return ran.join(offset, F.col("batch_no").eqNullSafe(F.col("_batch_"))).select("capture", "frame_idx", "batch_no", (F.lit(first) + F.col("offset") + F.col("before")).cast("bigint").alias("seq"))


def sequence(spark: SparkSession, source: str) -> Store:
    """The stored numbers of a source (a name or path); sessions that share a folder share them."""
    return Store(spark, location(spark, "sequence", source), TABLES)


def arrived(store: Store, rows: DataFrame) -> DataFrame:
    """Numbers the frames of rows that are new, appends them to the store, and returns those of all frames of rows.

    capture, frame_idx, batch_no (as first seen), seq. Frames of the store that
    rows do not hold keep their numbers there but are not returned. A rerun
    appends nothing; so does an empty table.
    """
    held = store.read("frames") if store.batches else None
    new = number(rows, held)
    if held is not None:
        new = written(new)
    if held is None or not new.isEmpty():
        store.commit({"frames": new})
    whole = store.read("frames").drop("batch")
    if held is None:
        return whole
    return whole.join(rows.select("capture", F.col("frame_idx").cast("bigint").alias("frame_idx")).distinct(), ["capture", "frame_idx"], "left_semi")


def sample(numbered: DataFrame, rate: float, seed: int = 0) -> DataFrame:
    """The chosen of numbered frames. rate in [0, 1]; 0 chooses none, 1 all."""
    if not 0 <= rate <= 1:
        raise ValueError("rate must lie between 0 and 1")
    return numbered.where(chosen(F.col("seq"), rate, seed))
