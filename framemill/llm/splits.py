"""Train, validation and test splits that keep linked records together.

Records are linked by equal object or equal capture, directly or through others.
The components of this graph live in stored tables that are only appended to:
key -> node, node -> root for nodes that merged, and root -> records and split.
A batch of records reads the state only where it meets it: its keys are looked up,
their nodes followed to the roots by pointer jumping, and links between roots
contracted by hooking to the smallest neighbour. What is new is appended.
Existing components keep their split, new ones fill the deficits of the splits,
and a merge of components with different splits is quarantined until a
decision resolves it.

The graph is made of distinct keys and distinct key pairs, never of records, so
a key that holds a third of all records is one node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.functions.ranks import running_total
from framemill.session import loose, written
from framemill.store import Store, location

SPLITS = {"train": 0.8, "val": 0.1, "test": 0.1}
QUARANTINED = "quarantined"
#: Components of at least this share of all records are placed one by one; there can be at most 1 / share of them.
LARGE = 0.001
#: Rows up to which a batch's own keys or nodes are sent to the state instead of shuffling the state; some tens of MB.
SENT = 200_000

#: keys: each key's node. links: nodes that became part of a root. components: the latest row of a component holds;
#: met: the splits that clash in a quarantined one. totals: records per split. records: those seen, with a hash of their keys.
TABLES = {
    "keys": "kind string, key_text string, node bigint",
    "links": "node bigint, root bigint",
    "components": "component bigint, records bigint, split string, met string",
    "totals": "split string, records bigint",
    "records": "row_id bigint, named bigint",
}


def assignment(spark: SparkSession, source: str, kind: str = "splits") -> Store:
    """The stored assignment of a source (a name or path); sessions that share a folder share it."""
    return Store(spark, location(spark, kind, source), TABLES)


def keyed(rows: DataFrame, with_split: bool = False) -> DataFrame:
    """row_id, obj, cap (read loosely), lone (the row_id of a record that names neither), and split if asked for."""
    obj, cap, row = loose(F.col("obj_name")), loose(F.col("capture")), F.col("row_id").cast("bigint")
    split = F.lower(F.regexp_replace("split", r"^\s+|\s+$", "")).alias("split") if with_split else F.lit(None).cast("string").alias("split")
    return rows.where("row_id is not null").select(row.alias("row_id"), obj.alias("obj"), cap.alias("cap"), F.when(obj.isNull() & cap.isNull(), row.cast("string")).alias("lone"), split)


def _jumped(up: DataFrame) -> DataFrame:
    """node, root with every pointer followed to its end; two jumps between checks."""
    while True:
        over = up.select(F.col("node").alias("_at_"), F.col("root").alias("_next_"))
        step = lambda df, over=over: df.join(over, df["root"] == over["_at_"], "left").select("node", F.coalesce("_next_", "root").alias("root"), "old")
        twice = written(step(step(up.withColumn("old", F.col("root")))).withColumn("moved", F.col("root") != F.col("old")))
        up = twice.select("node", "root")
        if twice.where("moved").isEmpty():
            return up


def contract(edges: DataFrame) -> DataFrame:
    """node, root for every node of an edge table (u, v): the root is the smallest node of its component.

    Each round hooks every node to its smallest neighbour, jumps pointers until
    all point to a root, and contracts the edges; it ends when none is left.
    """
    edges = written(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    total: DataFrame | None = None
    while not edges.isEmpty():
        ends = edges.select(F.col("u").alias("node"), F.col("v").alias("near")).unionAll(edges.select("v", "u"))
        up = _jumped(ends.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("root")))
        if total is None:
            total = up
        else:
            later = up.select(F.col("node").alias("root"), F.col("root").alias("last"))
            # nodes of this round are roots of earlier ones, so they are all in total already
            total = written(total.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root")))
        a, b = up.select(F.col("node").alias("u"), F.col("root").alias("ru")), up.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        met = edges.join(a, "u").join(b, "v").where("ru <> rv")
        edges = written(met.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct())
    return total if total is not None else edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _sent(few: DataFrame, n: int) -> DataFrame:
    """few, to be broadcast where its n rows are a bounded number."""
    return F.broadcast(few) if n <= SENT else few


def _rooted(store: Store) -> DataFrame:
    """node, root for the nodes of the state that merged. Roots of one batch may be nodes of a later one."""
    links = store.read("links").select("node", "root")
    return links if len(store.batches) < 2 else _jumped(links)


def _latest(rows: DataFrame) -> DataFrame:
    """Of the component rows, the last of each component."""
    last = rows.groupBy("component").agg(F.max_by(F.struct("records", "split", "met"), "batch").alias("l"))
    return last.select("component", "l.*")


def components(store: Store) -> DataFrame:
    """component, records, split, met of all components of the state."""
    links = store.read("links").select(F.col("node").alias("component"))
    return _latest(store.read("components")).join(links, "component", "left_anti")


def keys(store: Store) -> DataFrame:
    """kind, key_text, component of all keys of the state."""
    rooted = _rooted(store)
    return store.read("keys").drop("batch").join(rooted, "node", "left").select("kind", "key_text", F.coalesce("root", "node").alias("component"))


def _naming(rows: DataFrame) -> DataFrame:
    """row_id and the one key (kind, key_text) that names a keyed row's component; any of its keys would do."""
    kind = F.when(F.col("obj").isNotNull(), "obj_name").when(F.col("cap").isNotNull(), "capture").otherwise("row")
    return rows.select("row_id", kind.alias("kind"), F.coalesce("obj", "cap", "lone").alias("key_text"), "split")


def leaks(rows: DataFrame, store: Store) -> DataFrame:
    """row_id, train, val, test, records of every group in which at least two of the splits occur; row_id is its smallest.

    store: an assignment that has seen all rows; the groups are its components.
    Splits are read loosely, other values ignored. Rows without object and
    capture are groups of one record. Null and repeated rows need no care; no
    rows, no groups; extra columns are ignored.
    """
    # per key first: a hot key leaves one row per task before anything is joined
    per_key = _naming(keyed(rows, with_split=True)).groupBy("kind", "key_text").agg(
        F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("records"), *(F.count(F.when(F.col("split") == s, 1)).alias(s) for s in SPLITS)
    )
    groups = per_key.join(keys(store), ["kind", "key_text"]).groupBy("component").agg(F.min("row_id").alias("row_id"), F.sum("records").alias("records"), *(F.sum(s).alias(s) for s in SPLITS))
    occurring = sum(F.when(F.col(s) > 0, 1).otherwise(0) for s in SPLITS)
    return groups.where(occurring >= 2).select("row_id", *SPLITS, "records")


def _fill(new: DataFrame, have: dict[str, int], proportions: dict[str, float]) -> DataFrame:
    """component, records, split for new components, so that the splits come near their proportions.

    Every component gets a split. The large ones go, largest first, where most is
    lacking; the others, each below LARGE of all records, fill what then is
    lacking in the order of a hash, so that each split gets a fair share of them.
    """
    spark = new.sparkSession
    totals = new.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("records"), F.lit(0)).alias("records")).first()
    whole = sum(have.values()) + totals.records
    short = {s: proportions[s] * whole - have.get(s, 0) for s in proportions}
    # at most 1 / LARGE components are this large
    large = new.where(F.col("records") >= max(LARGE * whole, 1)).orderBy(F.desc("records"), "component").limit(int(1 / LARGE) + 1).collect() if whole else []
    placed = []
    for c in large:
        split = max(short, key=lambda s: (short[s], s))
        short[split] -= c.records
        placed.append((c.component, c.records, split))
    rest = new.where(F.col("records") < max(LARGE * whole, 1)).withColumn("_key_", F.xxhash64("component"))
    n_rest = totals.records - sum(c.records for c in large)
    room = {s: max(x, 0.0) for s, x in short.items()}
    scale = n_rest / (sum(room.values()) or 1)
    cut, choice, last = 0.0, None, max(room, key=lambda s: (room[s], s))
    ran = running_total(rest, [], "_key_", ["component"], F.col("records"), totals.n)
    for s in room:
        cut += room[s] * scale
        hit = F.col("before") + F.col("records") / 2 <= F.lit(cut)
        choice = F.when(hit, s) if choice is None else choice.when(hit, s)
    filled = ran.select("component", "records", choice.otherwise(last).alias("split"))
    return filled.unionAll(spark.createDataFrame(placed, "component bigint, records bigint, split string"))


def _unseen(store: Store, rows: DataFrame) -> tuple[DataFrame, bool]:
    """The keyed rows the state has not seen, and whether a record it has seen now bears other keys."""
    k = keyed(rows).withColumn("named", F.xxhash64("obj", "cap"))
    if not store.batches:
        return k, False
    seen = store.read("records").select("row_id", F.col("named").alias("_before_"))
    both = written(k.join(seen, "row_id", "left").where("_before_ is null or _before_ <> named"))  # nothing, in a rerun
    changed = not both.where("_before_ is not null").isEmpty()
    return (k if changed else both.drop("_before_")), changed


def extend(store: Store, rows: DataFrame, proportions: dict[str, float] | None = None) -> Store:
    """Takes the records (row_id, obj_name, capture; others ignored) that the state has not seen into it, as one batch.

    Keys are read loosely; a record that names neither object nor capture is a
    component of its own. Row ids must be unique; rows without one are left out.
    Components that existed keep their split; a component that joins several with
    different splits is quarantined, with all its records, until ``resolve``; one that
    joins a quarantined component is quarantined too. New components fill what
    the splits lack. A rerun, or an empty batch, changes nothing. Records that were
    seen under other keys make the state void: it is then built afresh from rows.
    Records that have left the table stay in the state, and what they linked stays linked.
    """
    proportions = proportions or SPLITS
    spark = rows.sparkSession
    k, afresh = _unseen(store, rows)
    old = store.upto(0) if afresh else store
    # one pass over the records; all that follows is of distinct pairs
    pairs = written(k.groupBy("obj", "cap", "lone").agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("records")))
    if pairs.isEmpty():
        return store
    named = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(c).alias("key_text")) for kind, c in (("obj_name", "obj"), ("capture", "cap"), ("row", "lone")))))
    own = written(pairs.select("row_id", named.alias("k")).where("k.key_text is not null").groupBy("k.kind", "k.key_text").agg(F.min("row_id").alias("first")))
    n_own = own.count()
    # a new key's first row is its node; object and capture of that row share it, and are linked by it
    if old.batches:
        hit = old.read("keys").drop("batch").join(_sent(own.select("kind", "key_text"), n_own), ["kind", "key_text"])
        hit = hit.join(_rooted(old), "node", "left").select("kind", "key_text", F.coalesce("root", "node").alias("held"))
        known = written(own.join(hit, ["kind", "key_text"], "left").select("kind", "key_text", F.coalesce("held", "first").alias("node"), F.col("held").isNotNull().alias("old")))
    else:
        known = own.select("kind", "key_text", F.col("first").alias("node"), F.lit(False).alias("old"))
    node = lambda kind, column, name: known.where(F.col("kind") == kind).select(F.col("key_text").alias(column), F.col("node").alias(name))
    edges = pairs.where("obj is not null and cap is not null").join(node("obj_name", "obj", "u"), "obj").join(node("capture", "cap", "v"), "cap").select("u", "v")
    roots = contract(edges)
    final = written(known.join(roots, "node", "left").select("kind", "key_text", "old", F.col("node").alias("was"), F.coalesce("root", "node").alias("node")))
    touched = final.where("old").select(F.col("was").alias("component"), F.col("node").alias("root")).distinct()
    fresh = _naming(pairs.withColumn("split", F.lit(None).cast("string")).withColumn("row_id", F.col("records"))).groupBy("kind", "key_text").agg(F.sum("row_id").alias("records"))
    fresh = fresh.join(final, ["kind", "key_text"]).groupBy(F.col("node").alias("component")).agg(F.sum("records").alias("records"))
    none = F.lit(None).cast("string")
    if old.batches:
        kept = written(_latest(old.read("components").join(_sent(touched.select("component"), n_own), "component")).join(touched, "component"))
        both = kept.select(F.col("root").alias("component"), "records", "split", "met").unionByName(fresh.select("component", "records", none.alias("split"), none.alias("met")))
        lost = {r.split: r.records for r in kept.groupBy("split").agg(F.sum("records").alias("records")).collect()}
        have = {r.split: r.records for r in _totals(old).collect()}
    else:
        both, lost, have = fresh.select("component", "records", none.alias("split"), none.alias("met")), {}, {}
    said = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split(F.coalesce("met", "split"), r"\+"))))), "+")  # of at most four names
    joined = both.groupBy("component").agg(F.sum("records").alias("records"), said.alias("met"))
    joined = written(joined.select("component", "records", F.when(F.col("met") == "", None).when(F.col("met").contains("+"), QUARANTINED).otherwise(F.col("met")).alias("split"), "met"))
    settled = joined.where("split is not null")
    for r in settled.groupBy("split").agg(F.sum("records").alias("records")).collect():
        have[r.split] = have.get(r.split, 0) + r.records
    have = {s: n - lost.get(s, 0) for s, n in have.items()}
    placed = written(_fill(joined.where("split is null"), {s: n for s, n in have.items() if s != QUARANTINED}, proportions))
    for r in placed.groupBy("split").agg(F.sum("records").alias("records")).collect():
        have[r.split] = have.get(r.split, 0) + r.records
    store.commit(
        {
            "keys": final.where("not old").select("kind", "key_text", "node"),
            "links": touched.where("component <> root").select(F.col("component").alias("node"), "root"),
            "components": settled.select("component", "records", "split", F.when(F.col("split") == QUARANTINED, F.col("met")).alias("met")).unionByName(placed.withColumn("met", none)),
            "totals": spark.createDataFrame(sorted(have.items()), TABLES["totals"]),
            "records": k.select("row_id", "named"),
        },
        afresh,
    )
    return store


def _totals(store: Store) -> DataFrame:
    """split, records after the last batch."""
    return store.read("totals").where(F.col("batch") == max(store.batches, default=0)).drop("batch")


def quarantine(store: Store) -> DataFrame:
    """component, records, met: what is quarantined, and the splits that met in it, joined by '+'."""
    return components(store).where(F.col("split") == QUARANTINED).select("component", "records", "met")


def resolve(store: Store, decisions: DataFrame) -> Store:
    """Gives quarantined components (component, split; others ignored) the split decided; decisions about anything else are passed over."""
    now = written(quarantine(store).join(decisions.where(F.col("split").isin(*SPLITS)).groupBy("component").agg(F.min("split").alias("split")), "component").select("component", "records", "split", F.lit(None).cast("string").alias("met")))
    have = {r.split: r.records for r in _totals(store).collect()}
    for r in now.groupBy("split").agg(F.sum("records").alias("records")).collect():
        have[r.split] = have.get(r.split, 0) + r.records
        have[QUARANTINED] -= r.records
    store.commit({"components": now, "totals": store.spark.createDataFrame(sorted(have.items()), TABLES["totals"])})
    return store


def assigned(rows: DataFrame, store: Store) -> DataFrame:
    """row_id, component, split ('quarantined' where a merge is in conflict) for records the state has seen.

    Key table and components are joined first, so records move once; a hot key's
    records are split over tasks by adaptive execution's skew join.
    """
    named = keys(store).join(components(store).select("component", "split"), "component")
    return _naming(keyed(rows)).drop("split").join(named, ["kind", "key_text"]).select("row_id", "component", "split")
