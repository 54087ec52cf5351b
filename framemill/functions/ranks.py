"""Distributed running totals and ranks in a hash order.

A 64-bit hash spreads rows evenly, so its leading bits are ranges with known
quantiles and need no sampling. Each range is totalled, the short list of range
totals is accumulated per group, and rows get their running total inside their
range only. The order depends on the rows alone, so a rerun, another
partitioning or a lost executor gives the same totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framemill.session import checkpointed, shuffle_width

#: Rows that one range holds on average, and the bits of a range number that one level of totals adds up.
RANGE_ROWS, LEVEL_BITS = 20_000, 16


def range_bits(rows: int) -> int:
    """Leading hash bits so that a range holds about RANGE_ROWS of that many rows, whatever their number."""
    return max((max(rows, 1) // RANGE_ROWS).bit_length(), 3)


def md5_number(*parts: Column) -> Column:
    """The leading 60 bits of the MD5 of the parts, joined by ':', as a bigint that is not negative; other engines compute the same."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(p.cast("string") for p in parts))), 1, 15), 16, 10).cast("bigint")


def md5_order(*parts: Column) -> Column:
    """md5_number spread over all 64 bits in the same order, as running_total wants it."""
    return F.shiftleft(md5_number(*parts), 4).bitwiseXOR(F.lit(-(2**63)))


def _starts(sums: DataFrame, groups: list[str], bits: int) -> DataFrame:
    """Adds _start_, the sum over the group's ranges before a range. Beyond LEVEL_BITS the totals are added up in levels, so no window holds more than 2 ** LEVEL_BITS of them."""
    before = lambda by: F.coalesce(F.sum("_sum_").over((Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("_at_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if bits <= LEVEL_BITS:
        return sums.withColumn("_start_", before(groups)).drop("_sum_")
    high = f"_high{bits}_"
    fine = sums.withColumn(high, F.shiftright("_at_", LEVEL_BITS)).withColumn("_inner_", before([*groups, high]))
    names = [f"{g}{bits}" for g in groups]
    coarse = _starts(fine.groupBy(*(F.col(g).alias(g) for g in groups), F.col(high).alias("_at_")).agg(F.sum("_sum_").alias("_sum_")), groups, bits - LEVEL_BITS)
    coarse = coarse.select(*(F.col(g).alias(n) for g, n in zip(groups, names)), F.col("_at_").alias("_up_"), "_start_")
    cond = F.col(high) == F.col("_up_")
    for g, n in zip(groups, names):
        cond = cond & F.col(g).eqNullSafe(F.col(n))
    return fine.join(coarse, cond).withColumn("_start_", F.col("_start_") + F.col("_inner_")).drop("_sum_", "_inner_", "_up_", high, *names)


def running_total(df: DataFrame, by: list[str], order: str, ties: list[str], value: Column, rows: int) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows of the same group that stand before this one.

    by: columns of the group (may be none; null is a group of its own). order: a
    bigint hash column; ties: columns that order equal hashes. rows: the size of
    df, from which the number of ranges follows. df must give the same rows each
    time it is computed. ``df`` must have no columns before, _range_, _value_, _start_.
    """
    bits = range_bits(rows)
    # the sign bit is flipped so that ranges follow the order of signed hashes
    ranged = df.withColumn("_range_", F.shiftrightunsigned(F.col(order).bitwiseXOR(F.lit(-(2**63))), 64 - bits)).withColumn("_value_", value)
    groups = [f"_by{i}_" for i in range(len(by))]
    sums = ranged.groupBy(*[F.col(c).alias(g) for c, g in zip(by, groups)], F.col("_range_").alias("_at_")).agg(F.sum("_value_").alias("_sum_"))
    starts = _starts(sums, groups, bits)
    on = [F.col(c).eqNullSafe(F.col(g)) for c, g in zip(by, groups)] + [F.col("_range_") == F.col("_at_")]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    inside = Window.partitionBy(*by, "_range_").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.join(starts, cond).withColumn("before", F.col("_start_") + F.coalesce(F.sum("_value_").over(inside), F.lit(0)))
    return joined.drop("_range_", "_value_", "_start_", "_at_", *groups)


def positions(df: DataFrame, by: list[str], order: list[str], partitions: int | None = None, place: str = "position", rows: str = "group_rows") -> DataFrame:
    """Adds ``place`` (0-based in its group) and ``rows`` (of the group) to every row, however large its group.

    Rows are cut into ranges of (by, order) by sampled quantiles, so a large group
    lies in several tasks; each task numbers its sorted rows, and the sizes of the
    pieces of a group, at most one per task, give the offsets. ``order`` must make
    the order total within a group. Nulls are a group of their own and sort first.
    """
    spark = df.sparkSession
    n = partitions or 2 * shuffle_width(spark)
    keys = [*by, *order]
    # the range bounds are sampled, so the cut is written down before it is used twice
    cut = checkpointed(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_piece_", F.spark_partition_id()).withColumn("_at_", F.monotonically_increasing_id()))
    names = [f"_by{i}_" for i in range(len(by))]
    pieces = cut.groupBy(*(F.col(c).alias(g) for c, g in zip(by, names)), F.col("_piece_").alias("_p_")).agg(F.min("_at_").alias("_first_"), F.count(F.lit(1)).alias("_n_"))
    w = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    pieces = pieces.withColumn("_shift_", F.coalesce(F.sum("_n_").over(w.orderBy("_p_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_first_")).withColumn(rows, F.sum("_n_").over(w))
    cond = F.col("_piece_") == F.col("_p_")
    for c, g in zip(by, names):
        cond = cond & F.col(c).eqNullSafe(F.col(g))
    return cut.join(pieces, cond).withColumn(place, F.col("_at_") + F.col("_shift_")).drop("_piece_", "_at_", "_p_", "_first_", "_n_", "_shift_", *names)
