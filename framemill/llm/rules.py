"""Ordered rule lists by incremental reduced-error pruning, and their export to SQL.

Classes are learned from the rarest to the most frequent, which becomes the
default. Rules of a class are found one at a time: on two thirds of the
examples conditions (feature >= or < threshold) are added while they gain
information, on the other third final conditions are dropped while that makes
the rule more accurate; learning stops when a rule errs on more than half of what
it covers there. Examples that a rule covers are then set aside.
"""

from __future__ import annotations

import numpy as np

#: (class, ((feature, operator, threshold), ...))
Rule = tuple[str, tuple[tuple[str, str, float], ...]]

#: Thresholds tried per feature, at quantiles of the examples.
CUTS = 64


def covers(conditions, names: list[str], x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for feature, op, cut in conditions:
        v = x[:, names.index(feature)]
        hit &= v >= cut if op == ">=" else v < cut
    return hit


def _grow(names: list[str], x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[tuple[str, str, float]]:
    conditions: list[tuple[str, str, float]] = []
    inside = np.ones(len(x), bool)
    while len(conditions) < 8:
        p, n = w[inside & y].sum(), w[inside & ~y].sum()
        if not n or not p:
            break
        best, base = (1e-9, None), np.log2(p / (p + n))
        for j, f in enumerate(names):
            values = x[inside, j]
            order = np.argsort(values, kind="stable")
            v, pos = values[order], np.where(y[inside][order], w[inside][order], 0).cumsum()
            neg = np.where(y[inside][order], 0, w[inside][order]).cumsum()
            edge = np.flatnonzero(v[1:] > v[:-1]) + 1
            if not len(edge):
                continue
            if len(edge) > CUTS:
                edge = edge[np.linspace(0, len(edge) - 1, CUTS).astype(int)]
            for op, a, b in (("<", pos[edge - 1], neg[edge - 1]), (">=", pos[-1] - pos[edge - 1], neg[-1] - neg[edge - 1])):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(a > 0, a * (np.log2(a / (a + b)) - base), -1)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, op, round(float((v[edge[k]] + v[edge[k] - 1]) / 2), 6)))
        if best[1] is None:
            break
        conditions.append(best[1])
        inside &= covers([best[1]], names, x)
    return conditions


def _worth(conditions, names, x, y, w) -> float:
    hit = covers(conditions, names, x)
    p, n = w[hit & y].sum(), w[hit & ~y].sum()
    return (p - n) / (p + n) if p + n else -1.0


def induce(names: list[str], x: np.ndarray, y: np.ndarray, default: str, weights: np.ndarray | None = None, seed: int = 0, max_rules: int = 12, order: tuple[str, ...] = ()) -> list[Rule]:
    """The ordered rule list for classes y of the examples x; what no rule covers is ``default``. order: classes in another order than by rarity."""
    rng, rules = np.random.default_rng(seed), []
    weights = np.ones(len(x)) if weights is None else weights
    left = np.ones(len(x), bool)
    for k in order or sorted((c for c in set(y) if c != default), key=lambda c: (weights[y == c].sum(), c)):
        for _ in range(max_rules):
            at = rng.permutation(np.flatnonzero(left))
            grow, prune = at[: 2 * len(at) // 3], at[2 * len(at) // 3 :]
            if not (y[grow] == k).any() or not (y[prune] == k).any():
                break
            rule = _grow(names, x[grow], y[grow] == k, weights[grow])
            worth = lambda r: _worth(r, names, x[prune], y[prune] == k, weights[prune])
            while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
                rule = rule[:-1]
            if not rule or worth(rule) <= 0:
                break
            rules.append((k, tuple(rule)))
            left &= ~covers(rule, names, x)
    return rules


def apply(rules: list[Rule], names: list[str], x: np.ndarray, default: str) -> np.ndarray:
    out, open_ = np.full(len(x), default, object), np.ones(len(x), bool)
    for k, conditions in rules:
        hit = open_ & covers(conditions, names, x)
        out[hit] = k
        open_ &= ~hit
    return out


def to_case(rules: list[Rule], default: str = "prose") -> str:
    """The rule list as one SQL CASE expression over columns named like the features."""
    whens = "".join(f" WHEN {' AND '.join(f'`{f}` {op} {cut!r}D' for f, op, cut in conditions)} THEN '{k}'" for k, conditions in rules)
    return f"CASE{whens} ELSE '{default}' END" if whens else f"'{default}'"
