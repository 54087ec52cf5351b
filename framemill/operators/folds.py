"""Decisions that feed back on themselves: stride, background quota, deduplication among survivors, budget.

They need the rows in order, but only their numbers. Rows are hashed to tasks by
group, sorted there by Spark (which spills), and streamed through a small state:
a task holds one batch and at most ``lookback`` hashes, however long the group.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL_BITS = 2**64 - 1
DECISIONS = ("kept", "kept_empty", "strided", "background", "duplicate", "over_budget")
#: The stride grows by a fifth at a check that finds more than this share of the budget kept.
GROWTH, NEARLY = 1.2, 0.95


@dataclass(frozen=True)
class Rules:
    """Which rules a fold applies; None leaves a rule out. every: kept rows between two checks of the stride."""

    rate: float | None = None
    distance: int | None = None
    lookback: int = 30
    budget: int | None = None
    every: int | None = None


class _Sieve:
    """The state of one group, and its decision on the next row."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.kept = self.empty = self.seen = 0
        self.taken, self.stride = 0.0, 1.0  # the place, in rows, that the stride last reached; rows per step
        self.unit: object = self
        self.hashes: deque[int] = deque(maxlen=rules.lookback)

    def decide(self, unit, passing, phash) -> str:
        r = self.rules
        if r.budget is not None and self.kept >= r.budget:
            return "over_budget"
        if unit != self.unit:
            self.unit = unit
            self.hashes.clear()
        self.seen += 1
        if r.every is not None:
            if self.seen < self.taken + self.stride:
                return "strided"
            self.taken += self.stride
        full = passing is None or passing
        if r.rate is not None and not full and self.empty >= r.rate * max(self.kept, 1):
            return "background"
        if r.distance is not None and phash is not None:
            if any(((phash ^ h) & ALL_BITS).bit_count() <= r.distance for h in self.hashes):
                return "duplicate"
            self.hashes.append(phash)
        self.kept += 1
        self.empty += not full
        if r.every is not None and self.kept % r.every == 0 and self.kept > NEARLY * r.budget:
            self.stride *= GROWTH
        return "kept" if full else "kept_empty"


def _streamed(df: DataFrame, group: list[str], order: list[str], rules: Rules, columns: list[str | None]) -> DataFrame:
    """Adds ``decision`` by running the rules over each group's rows in order. columns: of unit, passing and hash; None where the rules need none."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", decision string"

    def run(batches):
        last, sieve = None, None
        for b in batches:
            none = [None] * b.num_rows
            keys = list(zip(*(b.column(c).to_pylist() for c in group))) if group else [()] * b.num_rows
            rows = zip(*(none if c is None else b.column(c).to_pylist() for c in columns))
            out = []
            for key, row in zip(keys, rows):
                if sieve is None or key != last:
                    last, sieve = key, _Sieve(rules)
                out.append(sieve.decide(*row))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, "decision"])

    spread = df.repartition(*group) if group else df.repartition(1)
    return spread.sortWithinPartitions(*group, *order).mapInArrow(run, schema)


def dedupe(df: DataFrame, unit: list[str], order: list[str], phash: str = "phash", distance: int = 4, lookback: int = 30) -> DataFrame:
    """Adds ``decision``: 'duplicate' for rows within ``distance`` bits of any of the last ``lookback`` kept hashes of their unit, else 'kept'.

    Rows without a hash are kept and leave no trace. The comparison is with survivors, so no window function can express it.
    """
    return _streamed(df, unit, order, Rules(distance=distance, lookback=lookback), [None, None, phash])


def curate(
    df: DataFrame, source: list[str], unit: str, order: list[str], passing: str = "passing", phash: str = "phash",
    rate: float = 0.015, distance: int | None = 4, lookback: int = 30, budget: int = 200_000, every: int | None = None,
) -> DataFrame:
    """Adds ``decision`` to the rows of each source, in order.

    Once budget rows are kept the rest is 'over_budget'. With ``every``, rows that
    the stride passes over are 'strided'; the stride starts at one row and grows by a
    fifth at every ``every`` kept rows beyond 95 % of the budget. A row that does not pass
    is 'background' while the kept empty rows reach rate times the kept rows (1 at
    least). Then a row close to one of the last kept hashes of its unit is a
    'duplicate' (distance None: no comparison). The rest is 'kept' or 'kept_empty'.
    The quota counts over the whole source, hashes are forgotten when ``unit``
    changes. A null ``passing`` means no baseline: the row passes.
    """
    return _streamed(df, source, order, Rules(rate, distance, lookback, budget, every), [unit, passing, phash])


def live_stride(df: DataFrame, source: list[str], order: list[str], budget: int, every: int = 5000) -> DataFrame:
    """Adds ``decision``: 'kept', 'strided' or 'over_budget', by the stride and the budget of ``curate`` alone."""
    return _streamed(df, source, order, Rules(budget=budget, every=every), [None, None, None])


def counters(decided: DataFrame, by: list[str]) -> DataFrame:
    """n_seen, n_kept, n_empty_kept, n_dup_dropped per source; rows over the budget were not seen."""
    d = F.col("decision")
    count = lambda *k: F.count(F.when(d.isin(*k), 1))
    return decided.groupBy(*by).agg(
        count("kept", "kept_empty", "strided", "background", "duplicate").alias("n_seen"), count("kept", "kept_empty").alias("n_kept"),
        count("kept_empty").alias("n_empty_kept"), count("duplicate").alias("n_dup_dropped"),
    )
