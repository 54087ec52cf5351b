"""Linked splits and the stable sample."""

import collections
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from framemill.llm import sample, splits

ROWS = "row_id bigint, obj_name string, capture string, split string, component string, kind int"


def loose(x):
    x = None if x is None else x.strip().lower()
    return None if x in (None, "", "unknown") else x


def fresh(spark):
    return splits.assignment(spark, uuid.uuid4().hex)


def groups(rows):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for r in rows:
        for k in (("o", loose(r[1])), ("c", loose(r[2]))):
            if k[1]:
                up[find(k)] = find(r[0])
    out = collections.defaultdict(list)
    for r in rows:
        out[find(r[0])].append(r)
    return list(out.values())


def make(n, seed, first=0):
    r = random.Random(seed)
    names = lambda p, k: r.choice([None, "", " Unknown", *(f"{p}{i}" for i in range(k)), f" {p}0 ".upper()])
    return [(first + i, names("o", 40), names("c", 60), r.choice(["train", " Val", "TEST", None, "x"]), "z", 1) for i in range(n)]


def chain(n):
    """One long path: every record shares its object with the one before and its capture with the one after."""
    order = list(range(n))
    random.Random(1).shuffle(order)
    return [(order[i], f"o{(i + 1) // 2}", f"c{i // 2}", "train" if i else "test", "z", 1) for i in range(n)]


@pytest.mark.parametrize("rows", [make(60, 1), make(300, 2), chain(120), [(1, None, None, "train", "", 0), (2, "unknown", " ", "val", "", 0)]])
def test_leaks(spark, rows):
    want = {min(r[0] for r in g) for g in groups(rows) if len({(r[3] or "").strip().lower() for r in g} & {"train", "val", "test"}) > 1}
    df, store = spark.createDataFrame(rows, ROWS), fresh(spark)
    if len(rows) > 100:  # in two batches
        splits.extend(store, df.where("row_id % 3 = 0"))
    got = splits.leaks(df, splits.extend(store, df)).collect()
    assert {r.row_id for r in got} == want and len(got) == len(want)


def test_empty(spark):
    none = spark.createDataFrame([], ROWS)
    s = splits.extend(fresh(spark), none)
    assert not splits.keys(s).collect() and not splits.components(s).collect() and not splits.assigned(none, s).collect() and not splits.leaks(none, s).collect() and not splits.quarantine(s).collect()


def test_contract_star_and_path(spark):
    edges = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 160)] + [(500, 500), (7, 3)]
    got = {r.node: r.root for r in splits.contract(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert all(got[i] == 0 for i in range(60)) and all(got[i] == 100 for i in range(100, 161)) and 500 not in got


def test_extend_keeps_fills_and_quarantines(spark):
    df = lambda rows: spark.createDataFrame(rows, ROWS)
    one = [(i, f"o{i // 10}", f"c{i // 10}", None, "", 0) for i in range(1000)]
    s1 = splits.extend(fresh(spark), df(one))
    first = {r.row_id: r.split for r in splits.assigned(df(one), s1).collect()}
    n = collections.Counter(first.values())
    assert abs(n["train"] - 800) <= 20 and abs(n["val"] - 100) <= 20 and abs(n["test"] - 100) <= 20
    a = next(i for i, s in first.items() if s == "train")
    b = next(i for i, s in first.items() if s == "val")
    same = next(i for i, s in first.items() if s == "train" and i // 10 != a // 10)
    two = [(2000, f"o{a // 10}", f"c{b // 10}", None, "", 0), (2001, f"o{a // 10}", "fresh", None, "", 0), (2002, f"o{same // 10}", "new", None, "", 0), (2003, None, None, None, "", 0)]
    two += [(3000 + i, f"p{i}", None, None, "", 0) for i in range(100)]
    s2 = splits.extend(splits.Store(spark, s1.folder, splits.TABLES), df(two))  # as another session would find it
    both = {r.row_id: (r.component, r.split) for r in splits.assigned(df(one + two), s2).collect()}
    assert len(both) == len(one + two)
    hit = {a // 10, b // 10}
    assert all(both[i][1] == ("quarantined" if i // 10 in hit else first[i]) for i in range(1000))
    assert both[2000][1] == both[2001][1] == "quarantined" and both[2002][1] == "train" and both[2003][1] in splits.SPLITS
    for g in groups(one + two):
        assert len({both[r[0]] for r in g}) == 1
    n_batches = len(s2.batches)
    assert len(splits.extend(s2, df([])).batches) == n_batches == len(splits.extend(s2, df(one + two)).batches)
    assert {r.split: r.records for r in splits._totals(s2).collect()} == collections.Counter(x[1] for x in both.values())
    (q,) = splits.quarantine(s2).collect()
    assert q.met == "train+val" and q.records == 22
    splits.resolve(s2, spark.createDataFrame([(q.component, "val"), (-5, "test")], "component bigint, split string"))
    after = {r.row_id: r.split for r in splits.assigned(df(one + two), s2).collect()}
    assert all(after[i] == ("val" if x[1] == "quarantined" else x[1]) for i, x in both.items()) and not splits.quarantine(s2).collect()


def test_changed_records_make_the_state_void(spark):
    df = lambda rows: spark.createDataFrame(rows, ROWS)
    s = splits.extend(fresh(spark), df([(1, "a", "x", None, "", 0), (2, "b", "x", None, "", 0), (3, "c", None, None, "", 0)]))
    other = [(1, "a", "x", None, "", 0), (2, "b", "y", None, "", 0), (3, "c", None, None, "", 0)]
    got = {r.row_id: r.component for r in splits.assigned(df(other), splits.extend(s, df(other))).collect()}
    assert len(set(got.values())) == 3 and len(splits.Store(spark, s.folder, splits.TABLES).batches) == 1


def test_sizes_are_filled_when_components_differ(spark):
    r = random.Random(5)
    rows, i = [], 0
    for c in range(400):
        for _ in range(max(1, int(r.paretovariate(1.2)))):
            rows.append((i, f"o{c}", None, None, "", 0))
            i += 1
    s = splits.extend(fresh(spark), spark.createDataFrame(rows, ROWS))
    n = {x.split: x.n for x in splits.components(s).groupBy("split").agg(F.sum("records").alias("n")).collect()}
    largest = max(collections.Counter(x[1] for x in rows).values())
    assert all(abs(n[k] - p * len(rows)) <= max(0.02 * len(rows), largest) for k, p in splits.SPLITS.items())


FRAMES = "capture string, frame_idx int, batch_no int, seq string"


def frames(n, seed, batches):
    r = random.Random(seed)
    return [(r.choice(["a", "b", "B", None]), r.choice([None, *range(4000)]), r.choice(batches), "x") for _ in range(n)]


def taken(numbered):
    return {(r.capture, r.frame_idx) for r in sample.sample(numbered, 0.2, 7).collect()}


def test_sample_is_stable(spark):
    rows = frames(6000, 1, [1, 2]) + frames(3000, 2, [3, 4]) + frames(2000, 3, [5])
    df = spark.createDataFrame(rows, FRAMES)
    whole = {tuple(r) for r in sample.sample(sample.number(df), 0.2, 7).collect()}
    assert whole == {tuple(r) for r in sample.sample(sample.number(df.repartition(11)), 0.2, 7).collect()}
    source, before = uuid.uuid4().hex, set()
    for b in (1, 2, 4, 5):
        now = {tuple(r) for r in sample.sample(sample.arrived(sample.sequence(spark, source), df.where(F.col("batch_no") <= b)), 0.2, 7).collect()}
        assert before <= now
        before = now
    assert before == whole
    keys = {(c, i) for c, i, *_ in rows if c is not None and i is not None}
    got = sample.sequence(spark, source).read("frames").collect()
    assert {(r.capture, r.frame_idx) for r in got} == keys and sorted(r.seq for r in got) == list(range(len(keys)))
    assert abs(len(whole) / len(keys) - 0.2) < 0.02


def test_sample_edges(spark):
    df = spark.createDataFrame([("a", 1, None, ""), ("a", 1, 3, ""), ("a", 2, None, "")], FRAMES)
    n = sorted((r.frame_idx, r.batch_no, r.seq) for r in sample.number(df).collect())
    assert n == [(1, 3, 0), (2, None, 1)]
    assert sample.sample(sample.number(df), 1.0).count() == 2 and sample.sample(sample.number(df), 0.0).count() == 0
    assert not sample.number(df.limit(0)).collect()
    with pytest.raises(ValueError):
        sample.sample(sample.number(df), 1.1)


def test_query_keeps_members_over_late_rows(spark, small, tmp_path):
    """Through the registered query: a late row of the first batch, frames without batch, repeats; and a rerun."""
    from framemill.llm import queries

    rows = spark.read.parquet(f"{small}/runner.parquet")
    late = rows.limit(1).withColumns({"capture": F.lit("late"), "batch_no": F.lit(1)})
    nulls = rows.limit(40).withColumns({"capture": F.lit("none"), "batch_no": F.lit(None).cast("int")})
    kept = None
    for part in (rows.where("batch_no > 1"), rows.where("batch_no = 1").unionByName(late), nulls.unionByName(rows), late):
        part.write.mode("append").parquet(f"{tmp_path}/runner.parquet")
        now = {(r.capture, r.frame_idx): r.seq for r in queries.p6_sample(spark, str(tmp_path)).collect()}
        assert kept is None or kept.items() <= now.items()
        kept = now
    assert kept == {(r.capture, r.frame_idx): r.seq for r in queries.p6_sample(spark, str(tmp_path)).collect()}


def test_every_block_gives_its_share(spark):
    n = sample.BLOCK * 40
    got = spark.range(n).where(sample.chosen(F.col("id"), 0.1, 3)).select((F.col("id") / sample.BLOCK).cast("int").alias("b"), (F.col("id") % sample.BLOCK).alias("p")).collect()
    per = collections.Counter(r.b for r in got)
    assert set(per.values()) <= {99, 100} and len(per) == 40
    assert np.std([r.p for r in got]) == pytest.approx(sample.BLOCK / 12**0.5, rel=0.1)
