"""Fields read from file and capture names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The shapes of the first and the later converter, the capture name, gel by split.
SHAPES_FIRST = ["sphere", "cuboid", "cylinder", "cone", "hemisphere", "torus", "prism", "pyramid", "cross", "ellipsoid", "flat"]
SHAPES_LATER = ["sphere", "cuboid", "cylinder", "cone", "hemisphere", "torus", "prism", "pyramid", "cross", "ellipse", "ellipsoid", "polygon", "flat"]
CAPTURE = r"^(.+)_Mini_Mini_init_pose_(\d+)_(labeled|unlabeled)_(left|right)$"
CALIBRATION = r"^(\d+)_X(-?[0-9.]+)Y(-?[0-9.]+)Z(-?[0-9.]+)\.png$"


def stem_shape(stem: Column, shapes: list[str] = SHAPES_LATER) -> Column:
    """struct(indenter, indenter_param): the first token that is a shape and the token after it; ('unknown', '') where there is none, '' where nothing follows."""
    tokens = F.split(stem, "_")
    at = F.array_position(F.transform(tokens, lambda t: F.lower(t).isin(*shapes)), True)
    found = at > 0
    return F.struct(
        F.when(found, F.lower(F.element_at(tokens, at.cast("int")))).otherwise("unknown").alias("indenter"),
        F.when(found, F.coalesce(F.get(tokens, at.cast("int")), F.lit(""))).otherwise("").alias("indenter_param"),
    )


def capture_parts(name: Column) -> Column:
    """struct(obj_name, init_pose, labeled, side) of a full capture name; null where it does not match."""
    part = lambda i: F.regexp_extract(name, CAPTURE, i)
    return F.when(name.rlike(CAPTURE), F.struct(part(1).alias("obj_name"), part(2).try_cast("int").alias("init_pose"), (part(3) == "labeled").alias("labeled"), part(4).alias("side")))


def loose_capture(name: Column) -> Column:
    """struct(obj_name, init_pose, side) read token by token: what is missing is null."""
    tokens = F.split(name, "_")
    pose = F.array_position(tokens, "pose").cast("int")
    return F.struct(
        F.get(tokens, 0).alias("obj_name"), F.when(pose > 0, F.get(tokens, pose).try_cast("int")).alias("init_pose"),
        F.when(name.endswith("_left"), "left").when(name.endswith("_right"), "right").alias("side"),
    )


def trial_parts(trial: Column) -> Column:
    """struct(obj_name, trial): trailing digits off the name, '0' where there are none."""
    return F.struct(F.regexp_replace(trial, r"\d+$", "").alias("obj_name"), F.coalesce(F.nullif(F.regexp_extract(trial, r"(\d+)$", 1), F.lit("")), F.lit("0")).alias("trial"))


def calibration_parts(file: Column) -> Column:
    """struct(frame_idx, x_mm, y_mm, z_mm) of a calibration file name; null where it does not match."""
    part = lambda i: F.regexp_extract(file, CALIBRATION, i)
    return F.when(file.rlike(CALIBRATION), F.struct(part(1).try_cast("int").alias("frame_idx"), *(part(i + 2).try_cast("float").alias(n) for i, n in enumerate(("x_mm", "y_mm", "z_mm")))))


def prefix(name: Column) -> Column:
    return F.substring_index(name, "_", 1)


def stem_number(stem: Column, otherwise: Column) -> Column:
    """A stem of digits as int, else the other value."""
    return F.coalesce(F.when(stem.rlike(r"^[0-9]+$"), stem.try_cast("int")), otherwise)


def before_dash(stem: Column) -> Column:
    """The int before the first '-', 0 where it is none."""
    return F.coalesce(F.substring_index(stem, "-", 1).try_cast("int"), F.lit(0))


def split_of(file: Column) -> Column:
    """'test', 'val' or 'train' by the first of these that the name contains; null for none."""
    low = F.lower(file)
    return F.when(low.contains("test"), "test").when(low.contains("val"), "val").when(low.contains("train"), "train")


def row_defaults(rows: DataFrame) -> DataFrame:
    """capture falls back to '<obj>_<frame>', obj_name to 'unknown'; empty counts as missing."""
    obj = F.coalesce(F.nullif("obj_name", F.lit("")), F.lit("unknown"))
    own = F.coalesce(F.nullif("capture", F.lit("")), F.concat_ws("_", obj, F.col("frame_idx").cast("string")))
    return rows.withColumns({"capture": own, "obj_name": obj})


def grid_summary(grid: Column, force: Column) -> Column:
    """struct(grid_z_max, grid_z_mean, force): null for a missing grid, 0.0 for a missing force."""
    n = F.size(grid)
    return F.struct(
        F.array_max(grid).cast("float").alias("grid_z_max"),
        (F.aggregate(grid, F.lit(0.0), lambda s, x: s + x.cast("double")) / F.when(n > 0, n)).cast("float").alias("grid_z_mean"),
        F.coalesce(force, F.lit(0.0)).cast("float").alias("force"),
    )


# Gel by split of the force-labelled source; other splits are 'unknown'.
GEL_BY_SPLIT = {
    "train": "black_dot",
    "val": "black_dot",
    "test": "black_dot",
    "test_unknown_indenters": "black_dot",
    "test_diff_sensor_old_gel": "black_dot",
    "test_diff_sensor_new_gel": "different",
}


def gel_by_split(split: Column) -> Column:
    pairs = F.create_map(*(F.lit(x) for kv in GEL_BY_SPLIT.items() for x in kv))
    return F.coalesce(F.element_at(pairs, split), F.lit("unknown"))
