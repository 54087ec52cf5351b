"""State that outlives a session: tables that grow by batches, in the shared folder.

A batch writes its part of every table into a folder of its own and becomes valid
when its number is appended to ``commits``, the last write. Parts of a batch that
died on the way are never read and are overwritten by the next one, so a
lost driver leaves the state as it was. A batch may start the state afresh: the
batches before it are then no longer read. One writer at a time.
"""

from __future__ import annotations

import copy
import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from framemill.session import shared_folder


def location(spark: SparkSession, kind: str, source: str) -> str:
    """The folder of a kind of state about one source (a path or a name), the same in every session that shares the folder."""
    return f"{shared_folder(spark)}/framemill/{kind}/{hashlib.md5(source.encode()).hexdigest()}"


class Store:
    """Named tables (name -> DDL schema) that grow by committed batches."""

    def __init__(self, spark: SparkSession, folder: str, schemas: dict[str, str]):
        self.spark, self.folder, self.schemas, self._last = spark, folder.rstrip("/"), schemas, 0
        self.batches = self._committed()

    def _committed(self) -> list[int]:
        try:
            rows = self.spark.read.schema("batch int, base int").parquet(f"{self.folder}/commits").collect()  # one row per batch
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        base = max(r.base for r in rows)
        self._last = max(r.batch for r in rows)
        return sorted({r.batch for r in rows if r.batch >= base})

    def upto(self, batch: int) -> Store:
        """The state as it was after a batch."""
        past = copy.copy(self)
        past.batches = [b for b in self.batches if b <= batch]
        return past

    def read(self, name: str) -> DataFrame:
        """All committed parts of a table; with ``batch``, the number of the part a row came with."""
        paths = [f"{self.folder}/{name}/batch={b}" for b in self.batches]
        if not paths:
            return self.spark.createDataFrame([], f"{self.schemas[name]}, batch int")
        return self.spark.read.schema(f"{self.schemas[name]}, batch int").option("basePath", f"{self.folder}/{name}").parquet(*paths)

    def commit(self, parts: dict[str, DataFrame], afresh: bool = False) -> int:
        """Writes one batch; tables without a part get none of this batch's rows. afresh: forget the batches before. Returns its number."""
        number = self._last + 1

        def write(name: str) -> None:
            part = parts.get(name)
            part = self.spark.createDataFrame([], self.schemas[name]) if part is None else part
            part.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={number}")

        with ThreadPoolExecutor(len(self.schemas)) as pool:  # small jobs side by side
            list(pool.map(write, self.schemas))
        base = number if afresh or not self.batches else self.batches[0]
        self.spark.createDataFrame([(number, base)], "batch int, base int").coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
        self._last, self.batches = number, ([] if afresh else self.batches) + [number]
        return number
