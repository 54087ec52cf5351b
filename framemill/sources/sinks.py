"""Writing a corpus: shards by bytes or rows, one folder per split, swap in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framemill.functions.ranks import positions
from framemill.session import checkpointed, shuffle_width

SHARD_BYTES, SHARD_ROWS = 2 * 1024**3, 60_000


def shard_plan(df: DataFrame, order: list[str], size: str, cap: int = SHARD_BYTES) -> DataFrame:
    """Adds ``shard``: bytes before the row, in order, over cap. A shard exceeds cap by less than one row.

    Rows are cut into ranges of the order; ranges are totalled, and only the list
    of range totals is accumulated in one place. Null sizes count as 0.
    """
    n = 2 * shuffle_width(df.sparkSession)
    v = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    cut = checkpointed(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_p_", F.spark_partition_id()).withColumn("_i_", F.monotonically_increasing_id()))
    sums = cut.groupBy(F.col("_p_").alias("_q_")).agg(F.sum(v).alias("_s_"))
    start = F.coalesce(F.sum("_s_").over(Window.partitionBy(F.lit(0)).orderBy("_q_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum(v).over(Window.partitionBy("_p_").orderBy("_i_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = cut.join(F.broadcast(sums.select("_q_", start.alias("_start_"))), F.col("_p_") == F.col("_q_"))  # one row per range
    return joined.withColumn("shard", F.floor((F.col("_start_") + inside) / cap).cast("bigint")).drop("_p_", "_i_", "_q_", "_start_")


def write_corpus(df: DataFrame, path: str, by: list[str], rows: int = SHARD_ROWS) -> None:
    """Snappy parquet, one folder per value of ``by`` (source, split), files of at most ``rows`` rows. Spark's committer makes it all or nothing; an empty table writes no data file."""
    df.write.mode("errorifexists").option("compression", "snappy").option("maxRecordsPerFile", rows).partitionBy(*by).parquet(path)


def write_sharded(df: DataFrame, path: str, order: list[str], size: str, cap: int = SHARD_BYTES) -> None:
    """One folder per planned shard, so that each holds about ``cap`` bytes."""
    shard_plan(df, order, size, cap).repartition("shard").write.mode("errorifexists").option("compression", "snappy").partitionBy("shard").parquet(path)


def rebalanced(df: DataFrame, order: list[str], files: int) -> DataFrame:
    """The table in ``files`` partitions of equal row counts (the last may be short), in order."""
    p = positions(df, [], order)
    n = F.greatest(F.ceil(F.col("group_rows") / files), F.lit(1))
    return p.withColumn("_f_", F.floor(F.col("position") / n)).repartitionByRange(files, "_f_").drop("position", "group_rows", "_f_")


def replace(df: DataFrame, path: str) -> None:
    """Rewrites the table at ``path``, which df may read: to a folder beside it first, then by renaming."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    target, fresh, old = (jvm.org.apache.hadoop.fs.Path(path + suffix) for suffix in ("", ".tmp", ".old"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df.write.mode("overwrite").parquet(path + ".tmp")
    fs.delete(old, True)
    if fs.exists(target) and not fs.rename(target, old) or not fs.rename(fresh, target):
        raise OSError(f"{path} could not be replaced; the new table is at {path}.tmp")
    fs.delete(old, True)


def write_report(df: DataFrame, path: str, kind: str = "json") -> None:
    """A report as JSON lines or CSV with a header, in one file: for aggregated results."""
    w = df.coalesce(1).write.mode("overwrite")
    w.json(path) if kind == "json" else w.option("header", True).csv(path)
