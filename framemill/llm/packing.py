"""Filling containers of a fixed token capacity.

Sources are queues in a hash order, served by deficit round-robin: in every
window each source may send its target share of the window's tokens, the quota of a
queue that has run dry goes to the others by their shares, and what a source sends
beyond (or below) its quota is carried to the next window. Served that way, a text
is dealt after p_r / p_s of its source's earlier tokens of every other source r, as far
as r has them, so the queues need not be walked: distributed running totals carry
the deficits across windows and partitions exactly, and every window but the last
is full. Each window, of bounded size, is then packed best fit by decreasing length.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framemill.functions.ranks import running_total
from framemill.session import written

CAPACITY = 2048
#: Containers that one window fills.
WINDOW = 128

PACKED = "window bigint, container int, doc_id bigint, source string, piece int, start bigint, tokens bigint"


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The container of each item, by falling size, each into the fullest container it fits; sizes are at most capacity."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    room: list[tuple[int, int]] = []  # (free, container), sorted
    at, made = [0] * len(sizes), 0
    for i in order:
        k = bisect_left(room, (sizes[i], -1))
        if k == len(room):
            free, container, made = capacity, made, made + 1
        else:
            free, container = room.pop(k)
        at[i] = container
        if free > sizes[i]:
            insort(room, (free - sizes[i], container))
    return at


def _packing(capacity: int):
    def pack(window: pa.Table) -> pa.Table:
        t = window.sort_by([("doc_id", "ascending")])
        doc, source, size = (t[c].to_pylist() for c in ("doc_id", "source", "tokens"))
        rows, rest = [], []
        container = 0
        for d, s, n in zip(doc, source, size):
            for piece in range(n // capacity if n > capacity else 0):
                rows.append((container, d, s, piece, piece * capacity, capacity))
                container += 1
            left = n % capacity if n > capacity else n
            if left:
                rest.append((d, s, n // capacity if n > capacity else 0, n - left, left))
        for (d, s, piece, start, n), at in zip(rest, best_fit([r[4] for r in rest], capacity)):
            rows.append((container + at, d, s, piece, start, n))
        columns = list(zip(*rows)) if rows else [()] * 6
        number = t["window"][0].as_py() if len(t) else 0
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array([number] * len(rows), pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["window", "container", "doc_id", "source", "piece", "start", "tokens"])

    return pack


def schedule(items: DataFrame, proportions: dict[str, float] | None = None) -> DataFrame:
    """source, total, share, and all (total, share) as an array ``queues``: one row per source.

    proportions: target share of tokens per source; sources left out, or all by
    default, have their share of all tokens. Shares are scaled to sum to 1.
    """
    totals = items.groupBy("source").agg(F.sum("tokens").alias("total"))
    share = F.col("total") / F.sum("total").over(_everything())
    if proportions:
        wish = F.create_map(*(F.lit(x) for kv in sorted(proportions.items()) for x in (kv[0], float(kv[1]))))
        share = F.coalesce(F.nullif(F.element_at(wish, F.col("source")), F.lit(0.0)), share)
    shares = totals.select("source", "total", share.alias("share"))
    shares = shares.withColumn("share", F.col("share") / F.sum("share").over(_everything()))
    return shares.withColumn("queues", F.sort_array(F.collect_list(F.struct("source", "total", "share")).over(_everything())))


def _dealt(served: Column) -> Column:
    """Tokens of all queues that are dealt when each has been served ``served`` times its share, or is dry."""
    return F.aggregate("queues", F.lit(0.0), lambda t, q: t + F.least(q["total"].cast("double"), q["share"] * served))


def windows(items: DataFrame, capacity: int = CAPACITY, per_window: int = WINDOW, proportions: dict[str, float] | None = None) -> DataFrame:
    """Adds ``window`` to items (doc_id, source, tokens): the one in which deficit round-robin sends the text.

    A source gets its target share of every window until it runs dry; from then on
    the others divide its quota. As every text must be packed, the last
    windows hold what the targets left over. proportions: see ``schedule``.
    """
    items = items.select("doc_id", "source", "tokens").withColumn("_key_", F.xxhash64("doc_id"))
    plan = schedule(items, proportions).select(F.col("source").alias("_source_"), "share", "queues")  # one row per source
    ran = running_total(items, ["source"], "_key_", ["doc_id"], F.col("tokens"), items.count())
    window = F.floor(_dealt(F.col("before") / F.col("share")) / F.lit(float(capacity * per_window)))
    return ran.join(F.broadcast(plan), F.col("source") == F.col("_source_")).select("doc_id", "source", "tokens", window.alias("window"))


def mixture(packed: DataFrame, items: DataFrame, capacity: int = CAPACITY, per_window: int = WINDOW, proportions: dict[str, float] | None = None) -> DataFrame:
    """Per window and source: tokens, share (of the window's tokens), wished (tokens that its quota grants) and deficit (tokens granted so far less tokens sent so far).

    A deficit is below zero by less than the source's longest text, and above
    zero by rounding only: texts are sent whole, in the window in which their first token is due.
    """
    size = float(capacity * per_window)
    sent = packed.groupBy("window", "source").agg(F.sum("tokens").alias("tokens"))
    last = packed.agg(F.coalesce(F.max("window"), F.lit(-1)).alias("n")).first().n
    plan = schedule(items, proportions)
    # how far the queues have been served when so many tokens are dealt: between the points where one runs dry the deal is linear
    dry = F.array_sort(F.transform("queues", lambda q: q["total"] / q["share"]))
    at = F.aggregate(dry, F.lit(0.0), lambda v, d: F.when(_dealt(d) <= F.col("due"), d).otherwise(v))
    left = F.aggregate("queues", F.lit(0.0), lambda t, q: t + F.when(q["total"] / q["share"] > F.col("_at_"), q["share"]).otherwise(0.0))
    grid = plan.select("source", "total", "share", "queues", F.explode(F.sequence(F.lit(0), F.lit(max(last, 0)))).alias("window")).withColumn("due", (F.col("window") + 1) * F.lit(size))
    grid = grid.withColumn("_at_", at).withColumn("_served_", F.col("_at_") + F.when(left > 0, (F.col("due") - _dealt(F.col("_at_"))) / left).otherwise(0.0))
    granted = grid.select("source", F.col("window").cast("bigint").alias("window"), F.least(F.col("total").cast("double"), F.col("share") * F.col("_served_")).alias("granted"))
    both = granted.join(sent, ["window", "source"], "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    w = Window.partitionBy("source").orderBy("window")
    return both.select(
        "window", "source", "tokens", (F.col("tokens") / F.greatest(F.sum("tokens").over(Window.partitionBy("window")), F.lit(1))).alias("share"),
        (F.col("granted") - F.coalesce(F.lag("granted").over(w), F.lit(0.0))).alias("wished"), (F.col("granted") - F.sum("tokens").over(w)).alias("deficit"),
    )


def _everything():
    return Window.partitionBy(F.lit(0))


def placed(items: DataFrame) -> DataFrame:
    """The items that take place, written down: doc_id, source ('unknown' for null), tokens."""
    return written(items.select("doc_id", F.coalesce("source", F.lit("unknown")).alias("source"), "tokens").where("tokens > 0 and doc_id is not null"))


def pack(items: DataFrame, capacity: int = CAPACITY, per_window: int = WINDOW, proportions: dict[str, float] | None = None) -> DataFrame:
    """One row per packed piece: window, container (number in its window), doc_id, source, piece, start, tokens.

    items: doc_id (unique, not null), source, tokens; others ignored. Every token
    of every text is packed once. A text is split only if it exceeds the capacity:
    into full containers and one remainder, which is packed like a text. Texts
    without tokens (null, empty) take no place. Null sources are one source.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    return windows(placed(items), capacity, per_window, proportions).groupBy("window").applyInArrow(_packing(capacity), PACKED)


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per window: containers, tokens, unused share."""
    boxes = packed.groupBy("window", "container").agg(F.sum("tokens").alias("tokens"))
    return boxes.groupBy("window").agg(F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens"), (1 - F.sum("tokens") / (F.count(F.lit(1)) * capacity)).alias("unused"))
