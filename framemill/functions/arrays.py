"""Frames as array columns: contact metrics and hashes as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Difference above which a pixel counts as touched, on the 0-255 scale.
PIXEL_THRESH = 10.0


def _doubles(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double"))


def difference(frame: Column, base: Column) -> Column:
    """Per pixel |frame - base| in double."""
    return F.zip_with(frame, base, lambda a, b: F.abs(a.cast("double") - b.cast("double")))


def mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values)


def contact(frame: Column, base: Column, thresh: float = PIXEL_THRESH) -> Column:
    """struct(area, intensity): pixels that differ by more than thresh, and their mean difference (0.0 if none); null without a baseline."""
    hit = F.filter(difference(frame, base), lambda d: d > thresh)
    return F.when(base.isNotNull(), F.struct(F.size(hit).alias("area"), F.when(F.size(hit) > 0, mean(hit)).otherwise(0.0).alias("intensity")))


def zscore(frame: Column, base: Column, std: Column, floor: float = 1.0, z: float = 3.0) -> Column:
    """struct(area, intensity) over pixels whose distance exceeds z standard deviations; deviations count as at least ``floor``."""
    score = F.zip_with(difference(frame, base), std, lambda d, s: d / F.greatest(s.cast("double"), F.lit(floor)))
    hit = F.filter(score, lambda v: v > z)
    return F.struct(F.size(hit).alias("area"), F.when(F.size(hit) > 0, mean(hit)).otherwise(0.0).alias("intensity"))


def deformation(frame: Column, base: Column) -> Column:
    """Mean |frame - base| over all pixels."""
    return mean(difference(frame, base))


def passes(area: Column, intensity: Column, a_min: float, i_min: float) -> Column:
    return (area >= a_min) & (intensity >= i_min)


def median_bits(values: Column) -> Column:
    """A 64-bit hash of 64 values: bit i, first value highest, says whether the value exceeds the median of all but the first."""
    rest = F.array_sort(F.slice(_doubles(values), 2, 63))
    middle = F.element_at(rest, 32)
    return F.aggregate(_doubles(values), F.lit(0).cast("bigint"), lambda h, x: F.shiftleft(h, 1).bitwiseOR(F.when(x > middle, 1).otherwise(0).cast("bigint")))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
