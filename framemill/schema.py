"""The corpus schema, its widening, and the settings of sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The corpus layout.
CORPUS = T.StructType(
    [
        T.StructField("image", T.BinaryType()),
        T.StructField("image_format", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("markered", T.BooleanType()),
        T.StructField("capture", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("obj_name", T.StringType()),
        T.StructField("init_pose", T.IntegerType()),
        T.StructField("side", T.StringType()),
        T.StructField("x_mm", T.FloatType()),
        T.StructField("y_mm", T.FloatType()),
        T.StructField("z_mm", T.FloatType()),
        T.StructField("quat_x", T.FloatType()),
        T.StructField("quat_y", T.FloatType()),
        T.StructField("quat_z", T.FloatType()),
        T.StructField("quat_w", T.FloatType()),
        T.StructField("indenter", T.StringType()),
        T.StructField("indenter_param", T.StringType()),
        T.StructField("f_x", T.FloatType()),
        T.StructField("f_y", T.FloatType()),
        T.StructField("f_z", T.FloatType()),
        T.StructField("grid_z_max", T.FloatType()),
        T.StructField("grid_z_mean", T.FloatType()),
        T.StructField("episode", T.StringType()),
        T.StructField("frame_idx", T.IntegerType()),
        T.StructField("digit_class", T.IntegerType()),
        T.StructField("gel_variant", T.StringType()),
        T.StructField("domain", T.StringType()),
    ]
)
#: The first layout ends before ``episode``; the sequence layout goes on after ``domain``.
FIRST = T.StructType(CORPUS.fields[: CORPUS.names.index("episode")])
VIDEO = T.StructType(
    [
        *CORPUS.fields,
        T.StructField("sequence_id", T.StringType()),
        T.StructField("frame_in_seq", T.IntegerType()),
        T.StructField("sequence_length", T.IntegerType()),
        T.StructField("fps", T.FloatType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType = CORPUS) -> DataFrame:
    """Exactly the schema's columns in its order and types: missing ones null, unknown ones dropped, unreadable values null."""
    have = {c.lower(): c for c in reversed(df.columns)}
    columns = []
    for f in schema:
        if f.name in df.columns or f.name.lower() in have:
            name = f.name if f.name in df.columns else have[f.name.lower()]
            c = F.col(f"`{name}`")
            same = df.schema[name].dataType == f.dataType
            binary = isinstance(f.dataType, T.BinaryType) or isinstance(df.schema[name].dataType, T.BinaryType)
            columns.append((c if same else c.cast(f.dataType) if binary else c.try_cast(f.dataType)).alias(f.name))
        else:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*columns)


def union(tables: list[DataFrame], schema: T.StructType = CORPUS) -> DataFrame:
    """All tables as one, each conformed first."""
    out = conform(tables[0], schema)
    for t in tables[1:]:
        out = out.unionByName(conform(t, schema))
    return out


def gel_variant(markered: Column) -> Column:
    return F.when(F.coalesce(markered, F.lit(False)), "markered").otherwise("markerless")


def backfill(df: DataFrame) -> DataFrame:
    """Widens an older table: absent columns are added, gel_variant from markered, all else null. A second run changes nothing."""
    if "gel_variant" not in df.columns:
        df = df.withColumn("gel_variant", gel_variant(F.col("markered")) if "markered" in df.columns else F.lit("markerless"))
    return conform(df)


def verify_backfill(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: old_rows, new_rows, schema_ok, changed (rows of either that the other's original columns lack), not_null (values in added columns), ok.

    gel_variant is derived, so it may be filled. Rows compare as bags, in the widened types.
    """
    shared = [c for c in old.columns if c in CORPUS.names]
    added = [c for c in CORPUS.names if c not in shared and c != "gel_variant"]
    a, b = conform(old).select(shared), new.select(shared)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    filled = sum((F.count(c) for c in added), F.lit(0)).alias("not_null")
    parts = [count(a, "old_rows"), new.agg(F.count(F.lit(1)).alias("new_rows"), filled), count(a.exceptAll(b).unionAll(b.exceptAll(a)), "changed")]
    one = parts[0].withColumn("_k_", F.lit(1))
    for p in parts[1:]:  # single rows
        one = one.join(p.withColumn("_k_", F.lit(1)), "_k_")
    fits = [(f.name, f.dataType) for f in new.schema] == [(f.name, f.dataType) for f in CORPUS]
    ok = F.lit(fits) & (F.col("old_rows") == F.col("new_rows")) & (F.col("changed") == 0) & (F.col("not_null") == 0)
    return one.select("old_rows", "new_rows", F.lit(fits).alias("schema_ok"), "changed", "not_null", ok.alias("ok"))


def _one_of(*words: str) -> Callable:
    return lambda v: v in words


# The settings of a source, with their defaults. None has no default: the intensity, as no value holds for all sources.
SETTINGS: dict[str, tuple[str, str, Callable]] = {
    # name: (SQL type, default as SQL, or '' for none; what a value must satisfy)
    "domain": ("string", "", _one_of("real", "sim")),
    "gel_variant": ("string", "", _one_of("markered", "markerless", "mixed")),
    "license_repo": ("string", "", _one_of("main", "nc")),
    "i_min": ("double", "", lambda v: v >= 0),
    "channel_mode": ("string", "auto", _one_of("auto", "rgb", "bgr", "mixed")),
    "baseline": ("string", "first_n", _one_of("none", "explicit", "first_n", "random_group", "random_all", "per_touch")),
    "a_min": ("int", "40", lambda v: v > 0),
    "phash_dist": ("int", "4", lambda v: v is None or 0 <= v <= 64),
    "phash_lookback": ("int", "30", lambda v: v > 0),
    "budget": ("int", "200000", lambda v: v > 0),
    "bg_keep_rate": ("double", "0.015", lambda v: 0 <= v <= 1),
    "rng_seed": ("int", "0", lambda v: v >= 0),
    "touch_window_keep": ("double", "1.0", lambda v: 0 < v <= 1),
}
_READ = {"string": str, "int": int, "double": float}

# The thirteen sources; what is not said has the default.
SOURCES: dict[str, dict] = {
    "gelslam": {"domain": "real", "gel_variant": "markerless", "license_repo": "main", "i_min": 10},
    "tactile_tracking": {"domain": "real", "gel_variant": "markerless", "license_repo": "main", "i_min": 10},
    "unit": {"domain": "real", "gel_variant": "markered", "license_repo": "main", "i_min": 12, "channel_mode": "rgb", "baseline": "random_all", "phash_dist": None, "rng_seed": 20260520},
    "tacquad": {"domain": "real", "gel_variant": "markerless", "license_repo": "main", "i_min": 12, "channel_mode": "rgb", "baseline": "random_group", "phash_dist": None},
    "sparsh": {"domain": "real", "gel_variant": "markerless", "license_repo": "nc", "i_min": 12, "channel_mode": "rgb", "baseline": "random_group", "phash_dist": None},
    "threedcal": {"domain": "real", "gel_variant": "markerless", "license_repo": "main", "i_min": 10, "channel_mode": "rgb", "baseline": "explicit"},
    "feelanyforce": {"domain": "real", "gel_variant": "markerless", "license_repo": "main", "i_min": 10, "channel_mode": "rgb", "baseline": "random_all"},
    "real_tactile_mnist": {"domain": "real", "gel_variant": "markerless", "license_repo": "main", "i_min": 12, "channel_mode": "rgb", "baseline": "per_touch", "phash_dist": None, "touch_window_keep": 0.3},
    "sim_tactile_mnist": {"domain": "sim", "gel_variant": "markerless", "license_repo": "main", "i_min": 10, "channel_mode": "rgb", "baseline": "random_group", "phash_dist": None, "rng_seed": 20260519},
    "sim_starstruck": {"domain": "sim", "gel_variant": "markerless", "license_repo": "main", "i_min": 10, "channel_mode": "rgb", "baseline": "random_group", "phash_dist": None, "rng_seed": 20260520},
    "feats": {"domain": "real", "gel_variant": "markered", "license_repo": "main", "i_min": 0, "baseline": "none"},
    "fota_labeled": {"domain": "real", "gel_variant": "mixed", "license_repo": "main", "i_min": 10, "baseline": "random_group"},
    "fota_unlabeled": {"domain": "real", "gel_variant": "mixed", "license_repo": "main", "i_min": 10, "baseline": "random_group", "phash_dist": 1, "phash_lookback": 5},
}


def settings(given: dict) -> dict:
    """All settings, given or default; unknown, missing and unfit ones are refused together, each named."""
    full = {k: given[k] if k in given else _READ[kind](default) if default else None for k, (kind, default, _) in SETTINGS.items()}
    wrong = [f"{k} is no setting" for k in given if k not in SETTINGS]
    for k, (_, default, fits) in SETTINGS.items():
        if k not in given and not default:
            wrong.append(f"{k} must be given")
        elif not fits(full[k]):
            wrong.append(f"{k} can't be {full[k]!r}")
    if wrong:
        raise ValueError("; ".join(wrong))
    return full


def source(name: str, sources: dict[str, dict] = SOURCES) -> dict:
    """The settings of a source, with its name; another set of sources may be given in place of the thirteen."""
    if name not in sources:
        raise KeyError(f"no settings for {name!r} among {len(sources)} sources")
    return {"source": name, **settings(sources[name])}


def with_source(name: str, given: dict, sources: dict[str, dict] = SOURCES) -> dict[str, dict]:
    """The sources and one more; a name that is taken is refused."""
    if name in sources:
        raise ValueError(f"{name!r} has settings already")
    settings(given)
    return {**sources, name: given}


def source_table(spark: SparkSession, sources: dict[str, dict] = SOURCES) -> DataFrame:
    """The settings of all sources as a table to join with."""
    ddl = ", ".join(f"{k} {kind}" for k, (kind, _, _) in SETTINGS.items())
    rows = [tuple(None if v is None else _READ[SETTINGS[k][0]](v) if k != "source" else v for k, v in source(n, sources).items()) for n in sorted(sources)]
    return spark.createDataFrame(rows, f"source string, {ddl}")


def projected(frames: DataFrame, s: dict, extra: tuple[str, ...] = ()) -> DataFrame:
    """Corpus rows of a source's frames: constants from its settings, fields from the frame; ``extra`` columns of frames win over both where not null."""
    constant = {"source": s["source"], "domain": s["domain"], "markered": s["gel_variant"] == "markered", "gel_variant": s["gel_variant"]}
    out = frames
    for name, value in constant.items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in extra and name in frames.columns else F.lit(value))
    return conform(out)
