"""Schemas that drift from file to file: catalogue, change log, alias table, one consistent table.

Lines are opened once into maps of field and JSON text, and what opening gives is
written down. Names and JSON types are aggregated into a catalogue per file, the
footer of a text file. ``lag`` over the files of a build makes islands of
consecutive files per producer, field and type: the life spans. Their starts
and endings, swept in order, are the changes. A field that ends where another starts
is a rename when the values on the records common to both files are equal.
Renames make an alias table, and the alias table makes the casts of the
consistent table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framemill.schema import VIDEO
from framemill.session import written

#: Distinct field names that the alias table may hold on the driver; a schema, not data, so beyond it the input is no set of tables.
MAX_NAMES = 100_000

#: Names and types of the consistent table: the widest corpus layout without its picture.
FIELDS = {f.name: f.dataType.simpleString() for f in VIDEO if f.name not in ("image", "image_format")}


def _kind(text: Column) -> Column:
    """JSON type of a JSON text: boolean, number, string, array, object; null for null."""
    t = F.substring(text, 1, 1)
    return F.when(t == "n", None).when(t == '"', "string").when(t.isin("t", "f"), "boolean").when(t == "[", "array").when(t == "{", "object").when(text.isNotNull(), "number")


def _value(text: Column) -> Column:
    """A text that is equal for equal JSON values of one type: numbers by value, so 1, 1.0 and 1e0 agree; null for null."""
    number = text.try_cast("double")
    return F.when(_kind(text) == "number", F.concat(number.cast("string"), F.when(F.abs(number) >= 2.0**53, text).otherwise(""))).when(_kind(text).isNotNull(), text)


def opened(lines: DataFrame) -> DataFrame:
    """build_id, producer, file_no, line_no, row_id, fields: one row per line; extra columns of ``lines`` are ignored.

    fields maps each name to the JSON text of its value ('null' for null). It is null
    where the line is not a valid JSON object; an object that names a field twice counts as
    broken. The result is written to the shared folder, so that no line is parsed twice.
    """
    doc = lines.select("build_id", "producer", "file_no", "line_no", F.try_parse_json(F.col("payload")).alias("doc")).withColumn("map", F.try_variant_get("doc", "$", "map<string,variant>"))
    fields = F.transform_values("map", lambda _, v: F.to_json(v))
    return written(doc.select("build_id", "producer", "file_no", "line_no", F.when(F.col("map").isNotNull(), F.try_variant_get("doc", "$.row_id", "bigint")).alias("row_id"), fields.alias("fields")))


def catalogue(lines: DataFrame) -> DataFrame:
    """One row per file and field of opened lines: the JSON types seen, lines with it, lines with a value."""
    each = lines.select("build_id", "producer", "file_no", F.explode("fields").alias("field", "text")).withColumn("kind", _kind(F.col("text")))
    per_kind = each.groupBy("build_id", "producer", "file_no", "field", "kind").agg(F.count(F.lit(1)).alias("n"))
    return per_kind.groupBy("build_id", "producer", "file_no", "field").agg(
        F.array_sort(F.collect_set("kind")).alias("kinds"), F.sum("n").alias("lines"), F.coalesce(F.sum(F.when(F.col("kind").isNotNull(), F.col("n"))), F.lit(0)).alias("filled")
    )


def lifespans(lines: DataFrame) -> DataFrame:
    """Islands of consecutive files per producer, build, field and JSON type ('' where only nulls were seen), of opened lines."""
    one = catalogue(lines).select("producer", "build_id", "file_no", "field", F.explode(F.when(F.size("kinds") == 0, F.array(F.lit(""))).otherwise(F.col("kinds"))).alias("kind"), "lines")
    w = Window.partitionBy("build_id", "producer", "field", "kind").orderBy("file_no")
    start = F.when(F.lag("file_no").over(w) == F.col("file_no") - 1, 0).otherwise(1)
    island = one.withColumn("start", start).withColumn("island", F.sum("start").over(w))
    return island.groupBy("producer", "build_id", "field", "kind", "island").agg(
        F.min("file_no").alias("first_file"), F.max("file_no").alias("last_file"), F.sum("lines").alias("lines")
    ).drop("island")


def turns(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """build_id, file_no, field, before, after, blank: where life spans of a field start or end, if the file before is there too.

    before, after: life spans of the field in the file before and in this one;
    blank: whether one that starts or ends has only nulls. Files without a predecessor have no turns.
    """
    starts = spans.select("build_id", "field", "kind", F.col("first_file").alias("file_no"), F.lit(1).alias("start"), F.lit(0).alias("end"))
    ends = spans.select("build_id", "field", "kind", (F.col("last_file") + 1).alias("file_no"), F.lit(0).alias("start"), F.lit(1).alias("end"))
    at = starts.unionByName(ends).groupBy("build_id", "field", "file_no").agg(F.sum("start").alias("starts"), F.sum("end").alias("ends"), F.max(F.col("kind") == "").alias("blank"))
    w = Window.partitionBy("build_id", "field").orderBy("file_no")
    alive = F.sum(F.col("starts") - F.col("ends")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    at = at.withColumn("after", alive).withColumn("before", F.col("after") - F.col("starts") + F.col("ends"))
    files = lines.select("build_id", "file_no").distinct()
    follow = files.withColumn("prior", F.lag("file_no").over(Window.partitionBy("build_id").orderBy("file_no"))).where("prior = file_no - 1").drop("prior")
    return at.join(follow, ["build_id", "file_no"]).select("build_id", "file_no", "field", "before", "after", "blank")


def _equal_pairs(lines: DataFrame, gone: DataFrame, new: DataFrame) -> DataFrame:
    """build_id, file_no, old_name, new_name of the pairs of a gone and a new field that hold equal values on all common records.

    Only files that lose a field and gain one are looked at, and only those fields' values are shuffled.
    """
    names = lambda df, c: df.groupBy("build_id", "file_no").agg(F.collect_set(c).alias(c))  # noqa: E731 - names of one file's fields
    asked = written(names(gone, "old_name").join(names(new, "new_name"), ["build_id", "file_no"]))
    keep = lambda c: F.map_filter("fields", lambda k, v: F.array_contains(c, k) & _kind(v).isNotNull())
    held = lines.where("row_id is not null")
    old = held.withColumn("file_no", F.col("file_no") + 1).join(asked, ["build_id", "file_no"]).select("build_id", "file_no", "row_id", "line_no", F.lit(0).alias("side"), F.transform_values(keep("old_name"), lambda _, v: _value(v)).alias("held"))
    now = held.join(asked, ["build_id", "file_no"]).select("build_id", "file_no", "row_id", "line_no", F.lit(1).alias("side"), F.transform_values(keep("new_name"), lambda _, v: _value(v)).alias("held"))
    # the first line of a record in each file; repeats add nothing
    w = Window.partitionBy("build_id", "file_no", "row_id").orderBy("side", "line_no")
    each = old.unionByName(now).withColumn("repeat", F.coalesce(F.lag("side").over(w) == F.col("side"), F.lit(False))).where("not repeat")
    each = each.withColumn("come", F.lead("held").over(w)).where("side = 0 and come is not null").select("build_id", "file_no", F.map_entries("held").alias("lost"), F.map_entries("come").alias("come"))
    # a renamed pair has as many equal values as either side has values; what a record tells of it is counted before anything is shuffled again
    pair = lambda o, n: F.struct(o.alias("old_name"), n.alias("new_name"))
    none = F.lit(None).cast("string")
    told = F.concat(
        F.transform("lost", lambda o: pair(o["key"], none)),
        F.transform("come", lambda n: pair(none, n["key"])),
        F.flatten(F.transform("lost", lambda o: F.transform(F.filter("come", lambda n: n["value"] == o["value"]), lambda n: pair(o["key"], n["key"])))),
    )
    counts = written(each.select("build_id", "file_no", F.explode(told).alias("t")).groupBy("build_id", "file_no", "t.old_name", "t.new_name").agg(F.count(F.lit(1)).alias("n")))
    n_old = counts.where("new_name is null").select("build_id", "file_no", "old_name", F.col("n").alias("n_old"))
    n_new = counts.where("old_name is null").select("build_id", "file_no", "new_name", F.col("n").alias("n_new"))
    both = counts.where("old_name is not null and new_name is not null").join(n_old, ["build_id", "file_no", "old_name"]).join(n_new, ["build_id", "file_no", "new_name"])
    return both.where("n = n_old and n = n_new").select("build_id", "file_no", "old_name", "new_name")


def changes(lines: DataFrame) -> DataFrame:
    """Every change of a file against the file before it in its build, of opened lines.

    build_id, file_no, drift ('added', 'removed', 'renamed', 'retyped'),
    old_name, new_name. The first file of a build, and one whose predecessor is
    missing, has no changes. Names compare exactly, letter case included. A rename
    holds when on all row_ids in both files the old and the new field have equal
    values (left out = null) of one type, not all null; if several pairs qualify, all are
    given. Repeated lines count once, broken lines not at all; files of broken
    lines only have no fields.
    """
    t = written(turns(lines, lifespans(lines)))  # a row per change of a field
    gone = t.where("before > 0 and after = 0").select("build_id", "file_no", F.col("field").alias("old_name"))
    new = t.where("before = 0 and after > 0").select("build_id", "file_no", F.col("field").alias("new_name"))
    retyped = t.where("before > 0 and after > 0 and not blank").select("build_id", "file_no", F.lit("retyped").alias("drift"), F.col("field").alias("old_name"), F.col("field").alias("new_name"))
    renamed = written(_equal_pairs(lines, gone, new).select("build_id", "file_no", F.lit("renamed").alias("drift"), "old_name", "new_name"))
    removed = gone.join(renamed, ["build_id", "file_no", "old_name"], "left_anti").select("build_id", "file_no", F.lit("removed").alias("drift"), "old_name", F.lit("").alias("new_name"))
    added = new.join(renamed, ["build_id", "file_no", "new_name"], "left_anti").select("build_id", "file_no", F.lit("added").alias("drift"), F.lit("").alias("old_name"), "new_name")
    return renamed.unionByName(removed).unionByName(added).unionByName(retyped)


def alias_table(log: DataFrame, fields: dict[str, str] = FIELDS) -> dict[str, str]:
    """Field name -> name in the consistent table, from the renames of a change log.

    A name of the consistent schema stands for itself. Any other follows the
    renames, most frequent first, until it meets such a name; names that never
    do are left out. The counted renames are bounded by pairs of field names.
    """
    counted = log.where("drift = 'renamed'").groupBy("old_name", "new_name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "old_name", "new_name").limit(MAX_NAMES + 1).collect()
    if len(counted) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} pairs of renamed fields: these are not fields of tables")
    known = {f: f for f in [*fields, "row_id"]}
    grown = True
    while grown:
        grown = False
        for r in counted:
            for a, b in ((r.old_name, r.new_name), (r.new_name, r.old_name)):
                if a in known and b not in known:
                    known[b] = known[a]
                    grown = True
    return known


def _text(value: Column) -> Column:
    """The plain text of a JSON text: strings without quotes and escapes."""
    string = F.when(~F.contains(value, F.lit("\\")), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(F.try_variant_get(F.try_parse_json(value), "$", "string"))
    return F.when(_kind(value) == "string", string).otherwise(value)


def _cast(value: Column, to: str) -> Column:
    """A JSON text in the wanted type, null where it can't be read."""
    kind, text = _kind(value), _text(value)
    if to == "string":
        listed = F.concat_ws("_", F.from_json(value, "array<string>"))
        number = text.try_cast("double")
        whole = F.when((F.abs(number) < 2.0**53) & (number == F.floor(number)), number.cast("bigint").cast("string")).otherwise(F.when(F.abs(number) < 2.0**53, number.cast("string")).otherwise(text))
        return F.when(kind == "array", listed).when(kind == "number", whole).otherwise(text)
    if to == "boolean":
        word = F.lower(F.trim(text))
        return F.when(word.isin("true", "yes", "1", "1.0"), True).when(word.isin("false", "no", "0", "0.0"), False)
    number = F.when(kind.isin("number", "string"), F.trim(text).try_cast("double"))
    return number.try_cast(to)


def consistent(lines: DataFrame, log: DataFrame, fields: dict[str, str] = FIELDS) -> DataFrame:
    """All opened lines as one table: build_id, producer, file_no, row_id, the fields in their types, extras.

    One row per record of a file, from its first line; repeated lines add nothing.
    Aliases are read as the field they stand for, the field's own name first; lists become texts joined by '_',
    'yes'/'no'/1/0 booleans, padded digits numbers; what can't be read in the
    field's type is null. Fields without a place in the schema go to ``extras``
    (name -> text). Lines that are not valid JSON, or have no row_id, give no row.
    """
    alias = alias_table(log, fields)
    filled = lambda name: F.nullif(F.element_at("fields", F.lit(name)), F.lit("null"))

    def said(name: str) -> Column:
        return F.coalesce(*(filled(n) for n in sorted((n for n in alias if alias[n] == name), key=lambda n: (n != name, n))))

    known = F.array(*(F.lit(n) for n in alias))
    extras = F.transform_values(F.map_filter("fields", lambda k, v: (v != "null") & ~F.array_contains(known, k)), lambda _, v: _text(v))
    first = Window.partitionBy("build_id", "producer", "file_no", "row_id").orderBy("line_no")
    held = lines.where("row_id is not null").withColumn("_at_", F.row_number().over(first)).where("_at_ = 1")
    texts = held.select("build_id", "producer", "file_no", "row_id", *(said(f).alias(f) for f in fields), extras.alias("extras"))
    return texts.select("build_id", "producer", "file_no", "row_id", *(_cast(F.col(f), t).alias(f) for f, t in fields.items()), "extras")
