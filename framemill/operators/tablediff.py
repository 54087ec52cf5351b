"""Differences between two copies of a table, cell by cell.

Both sides are reduced to their distinct rows (pre-aggregated before the
shuffle, so a row that comes again many times moves once per task), spread over
hash buckets of the whole key and cogrouped as Arrow tables. Within a bucket the
keys of both sides are aligned by sorted search and the columns compared through
vectorised, null-aware masks; only the masked cells come out. Keys that come in
several versions lose the versions both sides hold alike first; what is left is compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framemill.session import shuffle_width

#: Rows of both sides that one bucket holds on average; at a few hundred bytes a row, some tens of MB.
BUCKET_ROWS = 50_000

FINDING = "finding"


def _side(df: DataFrame, keys: list[str], fields: list[str], types: dict[str, T.DataType]) -> DataFrame:
    """Keys and fields in comparable types, each distinct row once, with its first position."""
    return df.where(" and ".join(f"`{k}` is not null" for k in keys)).select(*(F.col(f"`{c}`").cast(types[c]).alias(c) for c in keys + fields)).distinct()


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which both sides compare by value."""
    if a == b:
        return a
    whole = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    real = [T.FloatType(), T.DoubleType()]
    if a in whole and b in whole:
        return whole[max(whole.index(a), whole.index(b))]
    if a in real and b in real:
        return T.DoubleType()
    if a in whole[:3] + real and b in whole[:3] + real:
        return T.DoubleType()
    return T.StringType()


def _row_ids(t: pa.Table, keys: list[str], other: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of the keys, the same on both sides and rising with the key."""
    n = t.num_rows
    codes = np.zeros(n + other.num_rows, dtype=np.int64)
    for k in keys:
        both = pa.chunked_array(t[k].chunks + other[k].chunks, t[k].type).combine_chunks()
        d = pc.dictionary_encode(both)
        rank = np.empty(len(d.dictionary), dtype=np.int64)
        rank[pc.sort_indices(d.dictionary).to_numpy()] = np.arange(len(rank))
        codes = np.unique(codes * max(len(rank), 1) + rank[d.indices.to_numpy(zero_copy_only=False)], return_inverse=True)[1] if len(codes) else codes
    return codes[:n], codes[n:]


def _differ(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Null-aware: null equals only null; NaN equals NaN."""
    va, vb = pc.is_valid(a), pc.is_valid(b)
    unequal = pc.fill_null(pc.not_equal(a, b), False)
    if pa.types.is_floating(a.type):
        unequal = pc.and_(unequal, pc.invert(pc.and_(pc.fill_null(pc.is_nan(a), False), pc.fill_null(pc.is_nan(b), False))))
    return pc.or_(pc.not_equal(va, vb), pc.and_(pc.and_(va, vb), unequal)).to_numpy(zero_copy_only=False)


def _codes(a: pa.ChunkedArray, b: pa.ChunkedArray) -> np.ndarray:
    """Numbers of the values of a and then of b: equal numbers for equal values, null (and NaN) equal only to itself."""
    both = pa.chunked_array(a.chunks + b.chunks, a.type).combine_chunks()
    return pc.dictionary_encode(both, null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _versions(left: pa.Table, right: pa.Table, key: np.ndarray, fields: list[str]) -> dict[str, np.ndarray]:
    """For each field the keys (numbers; of the rows of left, then of right) in whose versions it differs.

    Versions that both sides hold alike are set aside; if one side has no others, all of
    its versions stand against those left of the other. Of what is left, a field differs
    unless it has one value only.
    """
    n = left.num_rows
    side = np.arange(len(key)) < n
    codes = {f: _codes(left[f], right[f]) for f in fields}
    whole = np.unique(np.stack([key, *codes.values()], axis=1), axis=0, return_inverse=True)[1].ravel()
    alike = np.isin(whole, whole[side]) & np.isin(whole, whole[~side])
    open_ = {s: np.unique(key[~alike & (side == s)]) for s in (True, False)}
    # a key with versions left on one side only keeps all those of the other
    stays = ~alike | np.where(side, np.isin(key, np.setdiff1d(open_[False], open_[True])), np.isin(key, np.setdiff1d(open_[True], open_[False])))
    key = key[stays]
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0]) if len(key) else np.zeros(0, int)
    differs = {}
    for f, c in codes.items():
        c = c[stays][order]
        differs[f] = key[order][first][np.minimum.reduceat(c, first) != np.maximum.reduceat(c, first)] if len(first) else key
    return differs


def _bucket(keys: list[str], fields: list[str], names: tuple[str, str]):
    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        la, ra = _row_ids(left, keys, right)
        lo, ro = np.argsort(la, kind="stable"), np.argsort(ra, kind="stable")
        la, ra = la[lo], ra[ro]
        out: list[pa.Table] = []

        def emit(source: pa.Table, at: np.ndarray, finding: str) -> None:
            if len(at):
                t = source.select(keys).take(pa.array(at))
                out.append(t.append_column(FINDING, pa.array([finding] * len(at), pa.string())))

        # sorted search: where each left key stands among the right keys
        start, end = np.searchsorted(ra, la, "left"), np.searchsorted(ra, la, "right")
        first_l = np.r_[True, la[1:] != la[:-1]] if len(la) else np.zeros(0, bool)
        first_r = np.r_[True, ra[1:] != ra[:-1]] if len(ra) else np.zeros(0, bool)
        emit(left, lo[first_l & (start == end)], f"{names[0]}_only")
        there = np.searchsorted(la, ra, "left") != np.searchsorted(la, ra, "right")
        emit(right, ro[first_r & ~there], f"{names[1]}_only")
        n_l = np.diff(np.r_[np.flatnonzero(first_l), len(la)])
        count_l = np.repeat(n_l, n_l) if len(n_l) else np.zeros(0, int)
        single = (count_l == 1) & (end - start == 1)
        i, j = lo[single], ro[start[single]]
        li, rj = left.take(pa.array(i)), right.take(pa.array(j))
        for f in fields:
            differs = _differ(li[f].combine_chunks(), rj[f].combine_chunks())
            emit(left, i[differs], f)
        many = (start != end) & ~single
        if many.any():
            several = np.unique(la[many])
            mine, yours = lo[many], ro[np.isin(ra, several)]
            found = _versions(left.take(pa.array(mine)), right.take(pa.array(yours)), np.r_[la[many], ra[np.isin(ra, several)]], fields)
            for f, at in found.items():
                emit(left, lo[np.searchsorted(la, at, "left")], f)
        if out:
            return pa.concat_tables(out)
        kinds = {k: (left if left.num_rows else right).schema.field(k).type for k in keys}
        return pa.table({k: pa.array([], kinds[k]) for k in keys} | {FINDING: pa.array([], pa.string())})

    return compare


def table_diff(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], names: tuple[str, str], buckets: int | None = None) -> DataFrame:
    """Keys on one side only, and for keys on both sides each field whose values differ.

    Returns the key columns (in the left side's types) and ``finding``:
    '<name>_only' or a field's name. Keys and text compare exactly, numbers by
    value in the wider type without tolerance, null equals only null. Rows with a
    null key are left out. Repeated rows count once. Of a key with several different
    rows on a side, rows that both sides hold are set aside (if that leaves rows on one side
    only, they are compared with all of the other), and a field differs if any two of the rest do.
    Columns beyond keys and fields are ignored. Empty sides give only '_only'
    findings, or none.
    """
    types = {c: _wider(left.schema[c].dataType, right.schema[c].dataType) for c in keys + fields}
    out = T.StructType([T.StructField(k, types[k]) for k in keys] + [T.StructField(FINDING, T.StringType())])
    if buckets is None:
        rows = left.count() + right.count()  # from the footers
        buckets = max(shuffle_width(left.sparkSession), -(-rows // BUCKET_ROWS))
    spread = lambda df: df.withColumn("_bucket_", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    a, b = spread(_side(left, keys, fields, types)), spread(_side(right, keys, fields, types))
    found = a.groupBy("_bucket_").cogroup(b.groupBy("_bucket_")).applyInArrow(_bucket(keys, fields, names), out)
    return found.select(*(F.col(k).cast(left.schema[k].dataType).alias(k) for k in keys), FINDING)
