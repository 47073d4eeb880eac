"""Tables of one run: written beside the published ones, then moved into place together."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Staged:
    """The tables that a run writes under ``root``.

    All are written into a hidden folder first. ``publish`` renames that folder, which
    is the point of no return, and moves its tables: whole ones take the place of
    the table, others of the dates that they hold. A run that dies before leaves the
    published tables as they were (its folder is deleted by the next run that
    publishes); one that dies while it moves is finished by the next run.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root, prefix
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.end = f"{uuid.uuid4().hex}-for-{prefix}"
        self.dates: dict[str, str] = {}
        self._finish()

    def _names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at) if s.isDirectory()) if self.fs.exists(at) else []

    def live(self, name: str) -> str:
        return f"{self.root}/{self.prefix}{name}"

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(self.live(name)))

    def write(self, name: str, df: DataFrame, day: str | None = None, dates: bool = False) -> DataFrame:
        """Write a table and read it as it will be. ``day``: its partition column; ``dates``: only the dates of ``df`` change."""
        at = f"{self.root}/.staged-{self.end}/{'dates' if dates else 'whole'}/{name}"
        # rows of a day go to one task, but a large day is split by the adaptive planner
        (df.hint("rebalance", day).write.partitionBy(day) if day else df.write).parquet(at)
        new = self.spark.read.schema(df.schema).parquet(at).select(*df.columns)
        if not dates:
            return new
        replaced = [d.split("=", 1)[1] for d in self._names(at)]
        old = self.spark.read.parquet(self.live(name)).select(*df.columns)
        return old.filter(~F.col(day).isin(*[F.lit(d).cast("date") for d in replaced])).unionByName(new) if replaced else old

    def publish(self) -> None:
        self.fs.rename(self.path(f"{self.root}/.staged-{self.end}"), self.path(f"{self.root}/.ready-{self.end}"))
        self._finish()

    def discard(self) -> None:
        self.fs.delete(self.path(f"{self.root}/.staged-{self.end}"), True)

    def _move(self, source: str, target: str) -> None:
        self.fs.delete(self.path(target), True)
        self.fs.mkdirs(self.path(target).getParent())
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"{source} did not move to {target}")

    def _finish(self) -> None:
        """Move what a published run has not moved yet; delete what runs that died have left."""
        own = [n for n in self._names(self.root) if n.endswith(f"-for-{self.prefix}")]
        for ready in (f"{self.root}/{n}" for n in own if n.startswith(".ready-")):
            for name in self._names(f"{ready}/whole"):
                self._move(f"{ready}/whole/{name}", self.live(name))
            for name in self._names(f"{ready}/dates"):
                for date in self._names(f"{ready}/dates/{name}"):
                    self._move(f"{ready}/dates/{name}/{date}", f"{self.live(name)}/{date}")
            self.fs.delete(self.path(ready), True)
        for n in own:
            if n.startswith(".staged-") and not n.endswith(self.end):
                self.fs.delete(self.path(f"{self.root}/{n}"), True)
