"""Queries of the operators for training data, and their SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.llm import mixing, overlap, packing, quality, sample, splits, tokens
from framemill.session import table, written
from framemill.store import Store

RATE, SEED = 0.1, 20_250_301


def _named(one: DataFrame) -> DataFrame:
    """name, n: the columns of one row as rows."""
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("bigint").alias("n")) for c in one.columns))).alias("c")).select("c.*")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.Overlap(table(spark, d, "make_parquet")).pairs()


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.Overlap(table(spark, d, "make_parquet")).report()


def _assignment(spark: SparkSession, d: str) -> Store:
    """The stored assignment of a folder, with the batches by time in which its table grew; a rerun adds nothing."""
    rows = table(spark, d, "make_parquet")
    store = splits.assignment(spark, d)
    early = F.coalesce(F.col("written_at") < F.lit("2025-03-20").cast("timestamp_ntz"), F.lit(False))
    if not store.batches:
        splits.extend(store, rows.where(early))
    return splits.extend(store, rows)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.leaks(table(spark, d, "make_parquet"), _assignment(spark, d)).select("row_id")


def p4_assigned(spark: SparkSession, d: str) -> DataFrame:
    return splits.assigned(table(spark, d, "make_parquet"), _assignment(spark, d))


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    """The groups of the stored assignment by their smallest row."""
    a = p4_assigned(spark, d)
    return a.groupBy("component").agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("records"), F.countDistinct("split").alias("splits")).drop("component")


def p4_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return splits.quarantine(_assignment(spark, d))


def p4_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the assignment, counted: rows and groups, and the breaches of each rule."""
    store = _assignment(spark, d)
    now = written(splits.assigned(table(spark, d, "make_parquet"), store))
    before = splits.assigned(table(spark, d, "make_parquet"), store.upto(store.batches[0])).select("row_id", F.col("split").alias("early"))
    met = now.join(before, "row_id", "left").groupBy("component").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("split").alias("splits"), F.min("split").alias("split"), F.countDistinct("early").alias("earlier"), F.min("early").alias("early")
    )
    clash = F.col("earlier") > 1
    breach = lambda c: F.sum(c.cast("bigint"))
    one = met.agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("groups"), breach(F.col("splits") > 1).alias("groups_in_two_splits"),
        breach((F.col("earlier") == 1) & (F.col("split") != F.col("early"))).alias("groups_that_left_their_split"),
        breach(clash & (F.col("split") != splits.QUARANTINED)).alias("conflicts_not_quarantined"), breach(~clash & (F.col("split") == splits.QUARANTINED)).alias("quarantined_without_conflict"),
    )
    return _named(one)


def p6_sample(spark: SparkSession, d: str) -> DataFrame:
    return sample.sample(sample.arrived(sample.sequence(spark, d), table(spark, d, "runner")), RATE, SEED)


def _items(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return packing.placed(tokens.counted(docs.select("doc_id", tokens.source_key().alias("source"), "text")))


def _targets(spark: SparkSession, d: str) -> dict[str, float]:
    """The target shares; mix_targets has one row per corpus source."""
    return {r.source: r.target_share for r in table(spark, d, "mix_targets").select(tokens.source_key().alias("source"), "target_share").collect()}


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_items(spark, d), proportions=_targets(spark, d))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(p7_packed(spark, d))


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    """Shares of each window by source, with what its quota granted and the deficit carried on."""
    items, wish = _items(spark, d), _targets(spark, d)
    return packing.mixture(written(packing.pack(items, proportions=wish)), items, proportions=wish)


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the packing, counted: the texts, and the breaches of each rule."""
    items, wish = _items(spark, d), _targets(spark, d)
    packed = written(packing.pack(items, proportions=wish))
    per_text = packed.groupBy("doc_id").agg(F.sum("tokens").alias("packed"), F.count(F.lit(1)).alias("pieces"), F.max(F.col("start") + F.col("tokens")).alias("end"))
    texts = items.join(per_text, "doc_id", "full").agg(
        F.count(F.lit(1)).alias("texts"), F.sum((~F.col("tokens").eqNullSafe(F.col("packed")) | (F.col("end") != F.col("tokens"))).cast("bigint")).alias("texts_not_packed_once"),
        F.sum(((F.col("pieces") > 1) & (F.col("tokens") <= packing.CAPACITY)).cast("bigint")).alias("texts_split_that_fit"),
    )
    boxes = packed.groupBy("window", "container").agg(F.sum("tokens").alias("tokens")).agg(F.sum((F.col("tokens") > packing.CAPACITY).cast("bigint")).alias("containers_over_capacity"))
    longest = items.groupBy("source").agg(F.max("tokens").alias("longest"))
    off = packing.mixture(packed, items, proportions=wish).join(longest, "source").where("deficit > 1.5 or deficit <= -longest - 1.5")
    one = texts.crossJoin(boxes).crossJoin(off.agg(F.count(F.lit(1)).alias("windows_off_target")))  # one row each
    return _named(one)


def _mixed(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", mixing.text_key().alias("text_key"), "text")
    return mixing.mix(tokens.counted(docs), table(spark, d, "mix_targets"))


def p8_mixed(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(_mixed(spark, d), table(spark, d, "mix_targets"))


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the mix, counted: distinct texts of the target sources, and the breaches of each rule."""
    targets = table(spark, d, "mix_targets").select(tokens.source_key().alias("source"), "max_repeats", "target_share")
    docs = table(spark, d, "documents").select("doc_id", "source", mixing.text_key().alias("text_key"), "text")
    counted = written(tokens.counted(docs))
    mixed = written(mixing.mix(counted, targets))
    uses = mixed.join(counted.select("doc_id", "text_key"), "doc_id").groupBy("source", "text_key").agg(F.count(F.lit(1)).alias("uses"), F.countDistinct("doc_id").alias("copies"))
    per = uses.join(targets, "source").agg(F.sum((F.col("uses") > F.col("max_repeats")).cast("bigint")).alias("texts_over_repeats"), F.sum((F.col("copies") > 1).cast("bigint")).alias("texts_used_as_copies"))
    cut = mixed.where("tokens < text_tokens").groupBy("source").count().where("count > 1").agg(F.count(F.lit(1)).alias("sources_cut_twice"))
    n = mixed.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first().n
    off = mixing.shares(mixed, targets).where(F.abs(F.col("tokens") - F.col("target_share") * F.lit(n)) > 10).agg(F.count(F.lit(1)).alias("sources_off_target_by_ten_tokens"))
    texts = mixing.unique_texts(counted).agg(F.count(F.lit(1)).alias("texts"))
    return _named(texts.crossJoin(per).crossJoin(cut).crossJoin(off))  # one row each


def _common(spark: SparkSession, d: str) -> list[str]:
    return quality.common_list(table(spark, d, "common_words"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.found(table(spark, d, "documents"), _common(spark, d))


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    s = quality.statistics(table(spark, d, "documents"), _common(spark, d))
    return s.select("doc_id", "lines", "chars", "words", *(F.round(c, 6).alias(c) for c in ("mean_word_length", "symbol_ratio", "punctuated_lines", "common_words", "list", "table", "junk", "prose")), "text_class")


def p9_counts(spark: SparkSession, d: str) -> DataFrame:
    """The counts of p9_statistics that need no rules."""
    s = quality.statistics(table(spark, d, "documents"), _common(spark, d))
    return s.select("doc_id", "lines", "chars", "words", *(F.round(c, 6).alias(c) for c in ("mean_word_length", "punctuated_lines", "common_words")))


def p1_checks(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of every row whose row_id is divisible by 50, found by comparing it with all rows: those that p1_found misses, and those it has besides."""
    rows = table(spark, d, "make_parquet")
    asked = F.expr("row_id_a % 50 = 0 or row_id_b % 50 = 0")
    true, got = written(overlap.compared(rows, 50)), written(p1_found(spark, d).where(asked))
    missed = true.exceptAll(got).agg(F.count(F.lit(1)).alias("pairs_missed"))
    return _named(missed.crossJoin(got.exceptAll(true).agg(F.count(F.lit(1)).alias("pairs_wrong"))))  # one row each


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p1_checks, p4_found, p4_assigned, p4_groups, p4_quarantine, p4_checks, p6_sample, p7_packed, p7_fill, p7_mixture, p7_checks, p8_mixed, p8_shares, p8_checks, p9_found, p9_statistics, p9_counts)}

_NODES = """k as (select row_id, lower(regexp_replace(obj_name, '^\\s+|\\s+$', '', 'g')) as o, lower(regexp_replace(capture, '^\\s+|\\s+$', '', 'g')) as c, lower(trim(split)) as s from make_parquet),
  n as (select row_id, s, case when o not in ('', 'unknown') then 'o:' || o end as o, case when c not in ('', 'unknown') then 'c:' || c end as c from k)"""

_GROUPS = f"""{_NODES},
  links as (select distinct o as u, c as v from n where o is not null and c is not null),
  arcs as (select u, v from links union select v, u from links),
  names as (select o as node from n where o is not null union select c from n where c is not null),
  reach(node, other) as (select node, node from names union select r.node, a.v from reach r join arcs a on a.u = r.other),
  label as (select node, min(other) as label from reach group by node),
  g as (select n.row_id, n.s, coalesce(l.label, m.label, 'r:' || n.row_id) as label from n left join label l on l.node = n.o left join label m on m.node = n.c)"""

_BLANKS = "' ' || chr(9) || chr(12) || chr(11) || chr(13)"
_HASH = "cast(concat('0x', substr(md5({}), 1, 15)) as bigint)"


def _draw(i: int) -> str:
    return _HASH.format(f"concat('{SEED}:{i}:', seq // {sample.BLOCK})")


SQL = {
    "p4_found": f"with recursive {_GROUPS} select min(row_id) as row_id from g group by label having count(distinct case when s in ('train', 'val', 'test') then s end) >= 2",
    "p4_groups": f"with recursive {_GROUPS} select min(row_id) as row_id, count(*) as records, cast(1 as bigint) as splits from g group by label",
    "p4_checks": f"""with recursive {_GROUPS} select 'rows' as name, count(*) as n from g union all select 'groups', count(distinct label) from g
  union all select name, 0 from (values ('groups_in_two_splits'), ('groups_that_left_their_split'), ('conflicts_not_quarantined'), ('quarantined_without_conflict')) t(name)""",
    "p1_checks": "select name, 0 as n from (values ('pairs_missed'), ('pairs_wrong')) t(name)",
    "p9_counts": f"""with t as (select doc_id, trim(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), {_BLANKS} || chr(10) || chr(65279)) as t from documents),
  l as (select doc_id, trim(unnest(string_split(t, chr(10))), {_BLANKS}) as line from t where t <> ''),
  w as (select doc_id, line, regexp_extract_all(lower(line), '\\p{{L}}+') as words from l where line <> ''),
  c as (select list(distinct lower(trim(word))) as common from common_words where trim(word) <> '')
  select doc_id, count(*) as lines, cast(sum(length(line)) as bigint) as chars, cast(sum(len(words)) as bigint) as words,
    round(sum(length(array_to_string(words, ''))) / greatest(sum(len(words)), 1), 6) as mean_word_length,
    round(avg(case when regexp_matches(line, '[.!?…][''"”’)]*$') then 1.0 else 0.0 end), 6) as punctuated_lines,
    round(sum(len(list_filter(words, lambda x: list_contains(common, x)))) / greatest(sum(len(words)), 1), 6) as common_words
  from w, c group by doc_id""",
    "p7_checks": """select 'texts' as name, count(*) as n from documents where text <> '' union all
  select name, 0 from (values ('texts_not_packed_once'), ('texts_split_that_fit'), ('containers_over_capacity'), ('windows_off_target')) t(name)""",
    "p8_checks": """select 'texts' as name, count(distinct t) as n from (select regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '^[\\s\\x{FEFF}]+|\\s+$', '', 'g') as t from documents) where t <> '' union all
  select name, 0 from (values ('texts_over_repeats'), ('texts_used_as_copies'), ('sources_cut_twice'), ('sources_off_target_by_ten_tokens')) t(name)""",
    "p6_sample": f"""with f as (select capture, cast(frame_idx as bigint) as frame_idx, min(batch_no) as batch_no from runner where capture is not null and frame_idx is not null group by 1, 2),
  n as (select *, row_number() over (order by batch_no nulls last, {_HASH.format("concat(capture, ':', frame_idx)")}, capture, frame_idx) - 1 as seq from f),
  h as (select *, {_draw(1)} % {sample.BLOCK - 1} + 1 as m, {_draw(2)} % {sample.BLOCK} as c, {_draw(3)} / 1152921504606846976.0 as u from n)
  select capture, frame_idx, batch_no, seq from h where (m * (seq % {sample.BLOCK}) + c) % {sample.BLOCK} < floor({RATE * sample.BLOCK!r} + u)""",
}
