"""Per-key results, table differences and schema drift against plain loops, with nulls, ties, repeats and empty tables."""

import collections
import json
import random
from datetime import datetime, timedelta

from framemill.operators import drift, heavykeys, tablediff

ROWS = "row_id bigint, obj_name string, capture string, split string, written_at timestamp_ntz, others string, key_text string, records int"
KEYS = {"obj_name": "capture", "capture": "obj_name"}


def loose(x):
    x = None if x is None else x.strip().lower()
    return None if x in (None, "", "unknown") else x


def make_rows(n, seed=1):
    r = random.Random(seed)
    t = datetime(2025, 1, 1)
    pick = lambda *xs: r.choice(xs)
    return [
        (
            i, pick("big", "Big ", "BIG", "big", f"o{r.randrange(9)}", None, "", " Unknown"), pick("c1", " C1", f"c{r.randrange(30)}", None), pick("train", " VAL", "test", "recon", None),
            pick(None, t + timedelta(seconds=r.randrange(50))), "x", "y", 3,
        )
        for i in range(n)
    ]


def brute(rows):
    out = {}
    for field, a, b in (("obj_name", 1, 2), ("capture", 2, 1)):
        groups = collections.defaultdict(list)
        for x in rows:
            if loose(x[a]):
                groups[loose(x[a])].append(x)
        for k, g in groups.items():
            s = collections.Counter((x[3] or "").strip().lower() for x in g)
            at = [x[4] for x in g if x[4]]
            three = [s["train"], s["val"], s["test"]]
            out[field, k] = (len(g), len({loose(x[b]) for x in g} - {None}), *three, len(g) - sum(three), sum(v > 0 for v in three), min(at, default=None), max(at, default=None))
    return out


def test_per_key_any_partitioning(spark):
    rows = make_rows(700)
    df = spark.createDataFrame(rows, ROWS)
    for n in (1, 7, 23):
        got = {(r[0], r[1]): tuple(r[2:]) for r in heavykeys.per_key(df, KEYS, n).collect()}
        assert got == brute(rows)


def test_heavy_counts_rows_without_key(spark):
    rows = [(i, "a" if i < 2 else None, None, None, None, None, None, None) for i in range(100)]
    df = spark.createDataFrame(rows, ROWS)
    assert [tuple(r)[:2] for r in heavykeys.heavy(heavykeys.per_key(df, KEYS), df, 0.02).collect()] == [("obj_name", "a")]
    assert not heavykeys.heavy(heavykeys.per_key(df, KEYS), df, 0.03).collect()


def test_per_key_empty(spark):
    assert not heavykeys.per_key(spark.createDataFrame([], ROWS), KEYS).collect()


def test_diff_against_loop(spark):
    r = random.Random(3)
    nan = float("nan")

    def side(seed):
        q = random.Random(seed)
        out = []
        for _ in range(400):
            k, i = q.choice(["a", "A", "b ", None, ""]), q.choice([None, *range(25)])
            out.append((k, i, q.choice(["x", "X", None]), q.choice([1.0, 0.1, None, nan]), q.randrange(3)))
        return out + out[:40]

    a, b = side(1), side(2)
    left = spark.createDataFrame([(*x[:3], None if x[3] is None else float(x[3]), x[4], r.random()) for x in a], "k string, i int, t string, v float, n int, finding double")
    right = spark.createDataFrame([(*x[:3], x[3], x[4], "z") for x in b], "k string, i bigint, t string, v double, n bigint, _bucket2_ string")
    import numpy as np

    def versions(rows, single):
        d = collections.defaultdict(set)
        for k, i, t, v, n in rows:
            if k is not None and i is not None:
                d[k, i].add((t, None if v is None else repr(float(np.float32(v)) if single else v), n))
        return d

    sa, sb = versions(a, True), versions(b, False)
    want = {(*k, "l_only") for k in sa.keys() - sb.keys()} | {(*k, "r_only") for k in sb.keys() - sa.keys()}
    for k in sa.keys() & sb.keys():
        x, y = sa[k] - sb[k], sb[k] - sa[k]
        if x or y:
            want |= {(*k, f) for at, f in enumerate(("t", "v", "n")) if any(p[at] != q[at] for p in x or sa[k] for q in y or sb[k])}
    for buckets in (1, 5):
        got = [tuple(x) for x in tablediff.table_diff(left, right, ["k", "i"], ["t", "v", "n"], ("l", "r"), buckets).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_diff_crossed_versions(spark):
    """Versions (1, 2), (3, 4) against (1, 4), (3, 2): each value is on both sides, no row is."""
    s = "k string, i int, t int, v int"
    left = spark.createDataFrame([("a", 1, 1, 2), ("a", 1, 3, 4), ("b", 1, 1, 1), ("b", 1, 2, 1), ("c", 1, 1, 1), ("c", 1, 1, None), ("d", 1, 1, 1), ("d", 1, 2, 2)], s)
    right = spark.createDataFrame([("a", 1, 1, 4), ("a", 1, 3, 2), ("b", 1, 1, 1), ("b", 1, 2, 1), ("c", 1, 1, 1), ("d", 1, 1, 1), ("d", 1, 2, 3)], s)
    got = sorted((r.k, r.finding) for r in tablediff.table_diff(left, right, ["k", "i"], ["t", "v"], ("l", "r")).collect())
    assert got == [("a", "t"), ("a", "v"), ("c", "v"), ("d", "v")]


def test_diff_empty_sides(spark):
    s = "k string, i int, t string"
    some, none = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x")], s), spark.createDataFrame([], s)
    f = lambda a, b: [tuple(x) for x in tablediff.table_diff(a, b, ["k", "i"], ["t"], ("l", "r")).collect()]
    assert f(some, none) == [("a", 1, "l_only")] and f(none, some) == [("a", 1, "r_only")] and f(none, none) == [] and f(some, some) == []


LINES = "build_id bigint, producer string, file_no int, line_no int, payload string, field string"


def lines(spark, files):
    rows = [(b, "make_parquet", f, n, p if isinstance(p, str) else json.dumps(p), "x") for (b, f), ps in files.items() for n, p in enumerate(ps)]
    return drift.opened(spark.createDataFrame(rows, LINES))


def test_changes(spark):
    files = {
        (1, 1): [{"row_id": 1, "a": 1, "h": 5, "s": "x", "gone": None}, {"row_id": 2, "a": 2, "h": 6, "s": "y"}, {"row_id": 2, "a": 2, "h": 6, "s": "y"}, '{"row_id": 3, "broken'],
        (1, 2): [{"row_id": 2, "b": 2.0, "h": "6", "S": "y", "nul": None}, {"row_id": 9, "b": 4, "h": "7", "S": "q"}],
        (1, 4): [{"row_id": 2, "new": 1}],
        (2, 1): ["no json at all"],
        (2, 2): [{"row_id": 1, "a": [1, 2]}],
        (3, 1): [{"row_id": 1, "p": 1, "q": 1}],
        (3, 2): [{"row_id": 1, "r": 1, "q": None}],
    }
    got = {tuple(r) for r in drift.changes(lines(spark, files)).collect()}
    assert got == {
        (1, 2, "renamed", "a", "b"), (1, 2, "renamed", "s", "S"), (1, 2, "retyped", "h", "h"), (1, 2, "removed", "gone", ""), (1, 2, "added", "", "nul"),
        (2, 2, "added", "", "row_id"), (2, 2, "added", "", "a"), (3, 2, "renamed", "p", "r"),
    }
    assert not drift.changes(drift.opened(spark.createDataFrame([], LINES))).collect()


def test_unequal_or_missing_values_are_no_rename(spark):
    files = {(1, 1): [{"row_id": 1, "a": 1}, {"row_id": 2, "a": 2}], (1, 2): [{"row_id": 1, "b": 1}, {"row_id": 2}], (2, 1): [{"row_id": 1, "a": 1}], (2, 2): [{"row_id": 2, "b": 1}]}
    got = {(r.build_id, r.drift) for r in drift.changes(lines(spark, files)).collect()}
    assert got == {(1, "removed"), (1, "added"), (2, "removed"), (2, "added")}


def test_lifespans_and_table(spark):
    files = {(1, f): [{"row_id": 1, name: v, "zz": 1}] for f, (name, v) in enumerate([("markered", True), ("dots", True), ("dots", "no"), ("markered", 1)], 1)}
    files[1, 3].append({"row_id": 2, "obj_name": ["a", "b"], "height": "0024", "capture": 12, "markered": None})
    df = lines(spark, files)
    spans = {tuple(r) for r in drift.lifespans(df).select("field", "kind", "first_file", "last_file").collect()}
    assert {("dots", "boolean", 2, 2), ("dots", "string", 3, 3), ("markered", "boolean", 1, 1), ("markered", "number", 4, 4), ("zz", "number", 1, 4), ("markered", "", 3, 3)} <= spans
    log = drift.changes(df)
    assert drift.alias_table(log)["dots"] == "markered"
    t = {(r.file_no, r.row_id): r for r in drift.consistent(df, log).collect()}
    assert [t[f, 1].markered for f in (1, 2, 3, 4)] == [True, True, False, True]
    assert (t[3, 2].obj_name, t[3, 2].height, t[3, 2].capture, t[3, 2].markered) == ("a_b", 24, "12", None)
    assert t[1, 1].extras == {"zz": "1"}
