"""Sources of loose files: picture trees, their side tables, published corpora.

Files are listed by Spark and read in tasks; names become columns. Order is
always a column, never the order of a listing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framemill.functions.ranks import positions
from framemill.operators import lookups, names


def pictures(spark: SparkSession, root: str, glob: str = "*.png", include: str | None = None, exclude: str | None = None) -> DataFrame:
    """path, image, parent, file, stem, format of every file below root that matches; include/exclude: substrings of the path."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    parts = F.split("path", "/")
    file = F.element_at(parts, -1)
    out = f.select("path", F.col("content").alias("image"), F.element_at(parts, -2).alias("parent"), file.alias("file"), F.regexp_replace(file, r"\.[^.]*$", "").alias("stem"), F.lower(F.regexp_extract(file, r"\.([^.]*)$", 1)).alias("format"))
    if include:
        out = out.where(F.col("path").contains(include))
    return out.where(~F.col("path").contains(exclude)) if exclude else out


def jpeg_pixels(spark: SparkSession, root: str) -> DataFrame:
    """path, height, width, channels, data of PNG and JPEG files through Spark's own decoder; the channels come out blue first."""
    i = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(root)
    return i.select("image.origin", "image.height", "image.width", F.col("image.nChannels").alias("channels"), "image.data").withColumnRenamed("origin", "path")


def sensor_tree(spark: SparkSession, root: str, sensor: str) -> DataFrame:
    """Pictures of one sub-sensor: capture (the folder above it), frame_idx (the stem's number, else the place in the folder)."""
    p = pictures(spark, root).where(F.col("parent") == sensor)
    p = p.withColumns({"capture": F.element_at(F.split("path", "/"), -3), "number": F.when(F.col("stem").rlike("^[0-9]+$"), F.col("stem").try_cast("bigint")).otherwise(0)})
    r = positions(p.drop("image"), ["capture"], ["number", "path"]).select("path", "position")
    return p.join(r, "path").withColumn("frame_idx", names.stem_number(F.col("stem"), F.col("position").cast("int"))).drop("number", "position")


def calibration_tree(spark: SparkSession, root: str) -> DataFrame:
    """Calibration pictures '{idx}_X..Y..Z...png': frame_idx, x_mm, y_mm, z_mm; other files are left out."""
    p = pictures(spark, root).withColumn("_n_", names.calibration_parts(F.col("file"))).where("_n_ is not null")
    return p.select("path", "file", "image", "_n_.*")


def object_tree(spark: SparkSession, root: str) -> DataFrame:
    """One folder per object: obj_name, family (before the first '_'), frame_idx = place in the folder's sorted listing, before any picture is decoded."""
    p = pictures(spark, root).withColumn("obj_name", F.col("parent"))
    r = positions(p.select("path", "obj_name", "file"), ["obj_name"], ["file", "path"]).select("path", F.col("position").cast("int").alias("frame_idx"))
    return p.join(r, "path").withColumn("family", names.prefix(F.col("obj_name")))


def posed_tree(spark: SparkSession, root: str, labeled: bool, values: list[str]) -> DataFrame:
    """Captures of the name '..._Mini_Mini_init_pose_..' with the poses of their poses.csv; folders of other names are left out."""
    p = pictures(spark, root, "*.jpg").withColumn("_n_", names.capture_parts(F.col("parent"))).where(F.col("_n_.labeled") == labeled)
    p = p.select("path", "image", F.col("parent").alias("capture"), F.col("file").alias("filename"), "_n_.obj_name", "_n_.init_pose", "_n_.side")
    if not labeled:
        return p
    csv = spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "poses.csv").csv(root)
    csv = csv.withColumn("capture", F.element_at(F.split(F.input_file_name(), "/"), -2))
    return lookups.with_poses(p, csv, ["capture", "filename"], values)


def annotated_tree(spark: SparkSession, root: str, values: list[str]) -> DataFrame:
    """Pictures with the rows of annotations.csv (by img_name); what is missing is 0.0."""
    notes = spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "annotations.csv").csv(root)
    return lookups.with_annotations(pictures(spark, root).withColumn("img_name", F.col("file")), notes, "img_name", values)


def listed_tree(spark: SparkSession, root: str, lists: str) -> DataFrame:
    """Pictures with split 'test' where a header-less list file names their path below root or their file, else 'train'."""
    listed = spark.read.csv(lists).select(F.col("_c0").alias("path"))
    p = pictures(spark, root, "*.*")
    below = F.regexp_replace("path", "^.*" + root.rstrip("/").rsplit("/", 1)[-1] + "/", "")
    return lookups.split_flag(p.withColumn("below", below), listed, ["below", "file"])


def nested_pictures(rows: DataFrame, column: str, order: list[str], stride: int = 1, ident: str = "id") -> DataFrame:
    """One row per picture of a list<struct<bytes, path>> column, of every stride-th row in order.

    capture: '<id>_t<i>', or 'row<place>_t<i>' where the id is null or empty. Null lists give nothing.
    """
    r = positions(rows, [], order).where(F.col("position") % stride == 0)
    e = r.select("*", F.posexplode(column).alias("touch", "_p_")).drop(column)
    name = F.coalesce(F.nullif(F.col(ident).cast("string"), F.lit("")), F.concat(F.lit("row"), F.col("position")))
    return e.select(*[c for c in e.columns if c not in ("_p_", "group_rows", "position")], F.concat(name, F.lit("_t"), F.col("touch")).alias("capture"), F.col("_p_.bytes").alias("image"))


def shuffled(df: DataFrame, key: list[str], seed: int) -> DataFrame:
    """A random order that is the same in every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), *key), *key)


def published(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Columns of a published corpus; what its files lack is null."""
    t = spark.read.option("mergeSchema", True).parquet(path)
    return t.select(*(F.col(c) if c in t.columns else F.lit(None).cast("string").alias(c) for c in columns))


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """folder, files, rows, bytes: rows counted per file without reading a column."""
    t = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("n"))
    folder = F.regexp_replace("file_path", "/[^/]*$", "")
    return t.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"), F.sum("file_size").alias("bytes"))


def uniform_rows(df: DataFrame, order: list[str], n: int, seed: int = 0) -> DataFrame:
    """n rows drawn uniformly without replacement, in order."""
    from framemill.operators.selection import hash_sample

    return hash_sample(df, order, n, seed).orderBy(*order)


def sorted_by_number(df: DataFrame, stem: Column) -> DataFrame:
    """Rows by the number in the stem (0 where it has none), then by path."""
    return df.orderBy(F.when(stem.rlike("^[0-9]+$"), stem.try_cast("bigint")).otherwise(0), "path")


def trials(spark: SparkSession, root: str, glob: str = "*.avi") -> DataFrame:
    """One row per clip: path, capture ('<folder>/<stem>'), split (the folder), obj_name and trial (trailing digits of the stem), unit_ord (place among the sorted paths)."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root).select("path", "length")
    parts = F.split("path", "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    out = f.select("path", "length", F.concat_ws("/", F.element_at(parts, -2), stem).alias("capture"), F.element_at(parts, -2).alias("split"), names.trial_parts(stem).alias("_n_"))
    out = out.select("path", "length", "capture", "split", "_n_.*")
    return out.withColumn("unit_ord", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("path")) - 1)  # one row per file
