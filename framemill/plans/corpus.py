"""Queries over the corpus tables: per-key results, schema drift, differences of two copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framemill.operators import drift, heavykeys, tablediff
from framemill.session import table

KEYS = {"obj_name": "capture", "capture": "obj_name"}
FRAME = ["capture", "frame_idx"]
FIELDS = ["source", "domain", "markered", "gel_variant", "split", "episode", "obj_name", "height", "width", "area", "intensity", "phash", "is_empty"]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "make_parquet")
    return heavykeys.heavy(heavykeys.per_key(rows, KEYS), rows, 0.02).select("key_field", "key_text")


def p2_per_key(spark: SparkSession, d: str) -> DataFrame:
    return heavykeys.per_key(table(spark, d, "make_parquet"), KEYS)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(drift.opened(table(spark, d, "shard_lines")))


def p3_lifespans(spark: SparkSession, d: str) -> DataFrame:
    return drift.lifespans(drift.opened(table(spark, d, "shard_lines")))


def p3_table(spark: SparkSession, d: str) -> DataFrame:
    lines = drift.opened(table(spark, d, "shard_lines"))
    return drift.consistent(lines, drift.changes(lines)).drop("extras")


def p3_extras(spark: SparkSession, d: str) -> DataFrame:
    """The fields that no name of the consistent table stands for, with how many records hold a value."""
    lines = drift.opened(table(spark, d, "shard_lines"))
    return drift.consistent(lines, drift.changes(lines)).select("producer", F.explode("extras").alias("field", "text")).groupBy("producer", "field").agg(F.count(F.lit(1)).alias("records"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return tablediff.table_diff(table(spark, d, "runner"), table(spark, d, "runner_published"), FRAME, FIELDS, ("runner", "published"))


QUERIES = {f.__name__: f for f in (p2_found, p2_per_key, p3_found, p3_lifespans, p3_table, p3_extras, p5_found)}

_LOOSE = "lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'))"
_LONG = f"""long as (
  select 'obj_name' as key_field, {_LOOSE.format('obj_name')} as key_text, {_LOOSE.format('capture')} as other, lower(trim(split)) as s, written_at from make_parquet
  union all
  select 'capture', {_LOOSE.format('capture')}, {_LOOSE.format('obj_name')}, lower(trim(split)), written_at from make_parquet)"""

_CELLS = ", ".join({"frame_idx": "cast(frame_idx as bigint) as frame_idx", "intensity": "cast(intensity as double) as intensity"}.get(c, c) for c in FRAME + FIELDS)
_COPIES = f"""a as (select distinct {_CELLS} from runner where capture is not null and frame_idx is not null),
  b as (select distinct {_CELLS} from runner_published where capture is not null and frame_idx is not null)"""

_CHANGES = """with v as (select build_id, file_no, payload from shard_lines where json_valid(payload) and json_type(payload) = 'OBJECT'),
  f as (select distinct v.build_id, v.file_no, try_cast(json_extract_string(v.payload, '$.row_id') as bigint) as row_id, e.key as field,
      case when e.type = 'NULL' then null when e.type = 'BOOLEAN' then 'boolean' when e.type = 'VARCHAR' then 'string' when e.type = 'ARRAY' then 'array' when e.type = 'OBJECT' then 'object' else 'number' end as kind,
      case when e.type in ('UBIGINT', 'BIGINT', 'DOUBLE') then cast(cast(e.atom as double) as varchar) else cast(e.value as varchar) end as val
    from v, json_each(v.payload) e),
  cat as (select build_id, file_no, field, list_sort(list(distinct kind) filter (where kind is not null)) as kinds from f group by all),
  files as (select distinct build_id, file_no from shard_lines),
  gone as (select c.build_id, c.file_no + 1 as file_no, c.field as old_name from cat c join files x on x.build_id = c.build_id and x.file_no = c.file_no + 1
    where not exists (select 1 from cat d where d.build_id = c.build_id and d.file_no = c.file_no + 1 and d.field = c.field)),
  fresh as (select c.build_id, c.file_no, c.field as new_name from cat c join files x on x.build_id = c.build_id and x.file_no = c.file_no - 1
    where not exists (select 1 from cat d where d.build_id = c.build_id and d.file_no = c.file_no - 1 and d.field = c.field)),
  ids as (select distinct build_id, file_no, row_id from f where row_id is not null),
  common as (select b.build_id, b.file_no, b.row_id from ids a join ids b on a.build_id = b.build_id and a.row_id = b.row_id and b.file_no = a.file_no + 1),
  pairs as (select g.build_id, g.file_no, g.old_name, n.new_name, c.row_id, o.kind as k1, o.val as v1, w.kind as k2, w.val as v2
    from gone g join fresh n on g.build_id = n.build_id and g.file_no = n.file_no join common c on c.build_id = g.build_id and c.file_no = g.file_no
    left join f o on o.build_id = g.build_id and o.file_no = g.file_no - 1 and o.row_id = c.row_id and o.field = g.old_name and o.kind is not null
    left join f w on w.build_id = g.build_id and w.file_no = g.file_no and w.row_id = c.row_id and w.field = n.new_name and w.kind is not null),
  renamed as (select build_id, file_no, old_name, new_name from pairs group by all
    having bool_and(k1 is not distinct from k2 and (k1 is null or v1 is not distinct from v2)) and count(k1) > 0)
"""


def _read(field: str, to: str) -> str:
    """A field of the consistent table from its kind and JSON value in ``best``."""
    text = "case when kind = 'array' then array_to_string(cast(value as varchar[]), '_') when kind = 'number' then cast(cast(value as bigint) as varchar) else value ->> '$' end"
    if to == "boolean":
        text = "case when lower(trim(value ->> '$')) in ('true', 'yes', '1') then true when lower(trim(value ->> '$')) in ('false', 'no', '0') then false end"
    elif to != "string":
        text = f"try_cast(case when kind in ('number', 'string') then try_cast(trim(value ->> '$') as double) end as {to})"
    return f"max({text}) filter (where canon = '{field}') as {field}"


_TABLE = f"""with recursive {_CHANGES.removeprefix('with ')},
  alias(name, canon) as (select c, c from (values {', '.join(f"('{f}')" for f in drift.FIELDS)}) t(c) union
    select case when r.old_name = a.name then r.new_name else r.old_name end, a.canon from alias a join renamed r on r.old_name = a.name or r.new_name = a.name
    where case when r.old_name = a.name then r.new_name else r.old_name end not in ({', '.join(f"'{f}'" for f in drift.FIELDS)})),
  lines as (select build_id, producer, file_no, line_no, payload, try_cast(json_extract_string(payload, '$.row_id') as bigint) as row_id from shard_lines where json_valid(payload) and json_type(payload) = 'OBJECT'),
  one as (select * from lines where row_id is not null qualify row_number() over (partition by build_id, producer, file_no, row_id order by line_no) = 1),
  said as (select o.build_id, o.producer, o.file_no, o.row_id, a.canon, a.name, e.value, case e.type when 'BOOLEAN' then 'boolean' when 'VARCHAR' then 'string' when 'ARRAY' then 'array' else 'number' end as kind
    from one o, json_each(o.payload) e join alias a on a.name = e.key where e.type <> 'NULL'),
  best as (select * from said qualify row_number() over (partition by build_id, producer, file_no, row_id, canon order by name <> canon, name) = 1)
  select o.build_id, o.producer, o.file_no, o.row_id, {', '.join(_read(f, t) for f, t in drift.FIELDS.items())}
  from one o left join best b using (build_id, producer, file_no, row_id) group by all"""

SQL = {
    "p3_table": _TABLE,
    "p2_found": f"""with {_LONG} select key_field, key_text from long where key_text not in ('', 'unknown')
  group by key_field, key_text having count(*) >= 0.02 * (select count(*) from make_parquet)""",
    "p2_per_key": f"""with {_LONG} select key_field, key_text, count(*) as records,
  count(distinct case when other not in ('', 'unknown') then other end) as others,
  count(*) filter (where s = 'train') as train, count(*) filter (where s = 'val') as val, count(*) filter (where s = 'test') as test,
  count(*) filter (where s is null or s not in ('train', 'val', 'test')) as outside,
  cast((count(*) filter (where s = 'train') > 0) as int) + cast((count(*) filter (where s = 'val') > 0) as int) + cast((count(*) filter (where s = 'test') > 0) as int) as splits,
  min(written_at) as first_written, max(written_at) as last_written
  from long where key_text not in ('', 'unknown') group by key_field, key_text""",
    "p5_found": f"""with {_COPIES},
  keys as (select capture, frame_idx from a intersect select capture, frame_idx from b),
  only_a as (select * from a except select * from b), only_b as (select * from b except select * from a),
  left_a as (select * from only_a union select a.* from a where (capture, frame_idx) in (select (capture, frame_idx) from only_b) and (capture, frame_idx) not in (select (capture, frame_idx) from only_a)),
  left_b as (select * from only_b union select b.* from b where (capture, frame_idx) in (select (capture, frame_idx) from only_a) and (capture, frame_idx) not in (select (capture, frame_idx) from only_b))
  select capture, cast(frame_idx as int) as frame_idx, 'runner_only' as finding from (select capture, frame_idx from a except select * from keys)
  union all
  select capture, cast(frame_idx as int), 'published_only' from (select capture, frame_idx from b except select * from keys)
  """
    + "".join(f" union all select distinct a.capture, cast(a.frame_idx as int), '{f}' from left_a a join left_b b on a.capture = b.capture and a.frame_idx = b.frame_idx where a.{f} is distinct from b.{f}\n" for f in FIELDS),
    "p3_found": _CHANGES + """
  select build_id, file_no, 'renamed' as drift, old_name, new_name from renamed
  union all select build_id, file_no, 'removed', old_name, '' from gone g where not exists (select 1 from renamed r where r.build_id = g.build_id and r.file_no = g.file_no and r.old_name = g.old_name)
  union all select build_id, file_no, 'added', '', new_name from fresh n where not exists (select 1 from renamed r where r.build_id = n.build_id and r.file_no = n.file_no and r.new_name = n.new_name)
  union all select b.build_id, b.file_no, 'retyped', b.field, b.field from cat a join cat b on a.build_id = b.build_id and a.field = b.field and b.file_no = a.file_no + 1
    where len(a.kinds) > 0 and len(b.kinds) > 0 and a.kinds is distinct from b.kinds""",
    "p3_lifespans": """with v as (select build_id, producer, file_no, payload from shard_lines where json_valid(payload) and json_type(payload) = 'OBJECT'),
  f as (select build_id, producer, file_no, e.key as field,
      case when e.type = 'NULL' then null when e.type = 'BOOLEAN' then 'boolean' when e.type = 'VARCHAR' then 'string' when e.type = 'ARRAY' then 'array' when e.type = 'OBJECT' then 'object' else 'number' end as kind
    from v, json_each(v.payload) e),
  n as (select build_id, producer, file_no, field, count(*) as lines from f group by all),
  k as (select distinct build_id, producer, file_no, field, kind from f where kind is not null),
  one as (select n.*, coalesce(k.kind, '') as kind from n left join k using (build_id, producer, file_no, field)),
  i as (select *, file_no - row_number() over (partition by build_id, producer, field, kind order by file_no) as island from one)
  select producer, build_id, field, kind, min(file_no) as first_file, max(file_no) as last_file, cast(sum(lines) as bigint) as lines from i group by producer, build_id, field, kind, island""",
}
