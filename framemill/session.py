"""Session helpers: table access, text keys, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table; a file or a folder of files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's ``spark.checkpoint.dir``.

    Only where none is set (tests on one machine) a temporary one is taken, once
    per process; on a cluster such a folder would not be shared, so that is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _TEMPORARY:
            _TEMPORARY.append(tempfile.mkdtemp(prefix="framemill-"))
        folder = _TEMPORARY[0]
    return folder


_TEMPORARY: list[str] = []


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    done = df.checkpoint(eager=True)
    # A checkpoint inherits the size estimate of its plan, and estimates multiply at every join: over a few
    # rounds of an iteration they become numbers of millions of digits. The rows alone carry no estimate.
    session = df.sparkSession
    plain = session._jsparkSession.internalCreateDataFrame(done._jdf.queryExecution().toRdd(), done._jdf.schema(), False)
    return DataFrame(plain, session)


def written(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a table written in the shared folder.

    Unlike a checkpoint it is computed once, is read by column, and has a size that the
    planner knows. For tables whose columns the caller names itself.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/framemill/cuts/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def loose(text: Column) -> Column:
    """A key read loosely: outer blanks and letter case ignored; '' and 'unknown' name nothing (null)."""
    key = F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))
    return F.when(~key.isin("", "unknown"), key)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions for shuffles that AQE can't size itself."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or a variant that no column of ``df`` bears (letter case ignored)."""
    taken = {c.lower() for c in df.columns}
    name = wish
    while name.lower() in taken:
        name += "_"
    return name


def spread(df: DataFrame, *key: str) -> DataFrame:
    """The rows over all cores by key, where they come in so few splits that three cores of four would idle; else as they are.

    For work that costs far more than moving its rows. So few splits are a small table, whatever the cluster.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    run = df._jdf.queryExecution()
    if "Adaptive" in run.executedPlan().getClass().getSimpleName():  # it shuffles already, and asking for its splits would run it
        return df
    splits = run.toRdd().getNumPartitions()
    return df.repartition(cores, *key) if 4 * splits <= cores else df
