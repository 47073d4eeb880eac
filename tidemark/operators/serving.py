"""Write-back of the scores into the served schedule: an upsert that a second run leaves alone."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.functions.columns import version_number
from tidemark.sources.schemas import SEND_SCHEDULE

VERSION = r"^v\d+$"
#: Buckets of a served table, at most: the driver lists and counts them.
MOST_BUCKETS = 4096


def candidates(scores: DataFrame, current: DataFrame) -> DataFrame:
    """The scores with the open zone of their user; written_at is computed_as_of, never the clock."""
    out = scores.join(current.select("user_id", "tz"), "user_id").withColumn("written_at", F.col("computed_as_of"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SEND_SCHEDULE])


def refuse_malformed(rows: DataFrame) -> None:
    """Every version is v<int> and every column has its type, or nothing is written."""
    for f in SEND_SCHEDULE:
        if rows.schema[f.name].dataType != f.dataType:
            raise TypeError(f"{f.name}: {rows.schema[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    bad = [r[0] for r in rows.filter(~F.coalesce(F.col("model_version").rlike(VERSION), F.lit(False))).select("model_version").limit(5).collect()]
    if bad:
        raise ValueError(f"model_version must be v<int>: {bad}")


def merged(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The schedule after the write-back, with ``won`` (whether a row is a candidate's): one full outer join.

    A candidate wins if its (version number, computed_as_of) is strictly above
    the stored pair, or if its user is new; all others keep their stored row.
    """
    rank = lambda row: F.struct(version_number(row["model_version"]), row["computed_as_of"])
    side = lambda df, name: df.select(F.col("user_id").alias("user"), F.struct(*SEND_SCHEDULE.names).alias(name))
    both = side(stored, "old").join(side(new, "new"), "user", "full_outer")
    old, new = F.col("old"), F.col("new")
    won = F.when(new.isNull(), False).when(old.isNull(), True).otherwise(rank(new) > rank(old))
    return both.withColumn("won", won).select(F.when(F.col("won"), new).otherwise(old).alias("row"), "won").select("row.*", "won")


def upsert(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The schedule after the write-back: users without a winner keep their row."""
    return merged(stored, new).drop("won")


class Schedule:
    """The served table: snapshots in a folder, and a pointer to the current one.

    A snapshot is written whole before the pointer moves (a rename), so readers
    see the old rows or the new ones. The snapshot before the current one stays,
    for readers that have planned on it; older ones go. One writer at a time holds
    the lock file; a lock older than ``lock_hours`` was left by a crash and is taken.
    """

    def __init__(self, spark: SparkSession, path: str, lock_hours: float = 6):
        self.spark, self.path, self.lock_ms = spark, path, lock_hours * 3_600_000
        jvm = spark._jvm
        self.at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        self.fs = self.at("x").getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at("."))) if self.fs.exists(self.at(".")) else []

    def current(self) -> str | None:
        done = [n for n in self._names() if n.startswith("current-")]
        return done[-1].removeprefix("current-") if done else None

    def _lock(self) -> None:
        self.fs.mkdirs(self.at("."))
        if self.fs.createNewFile(self.at("lock")):
            return
        age = self.spark._jvm.System.currentTimeMillis() - self.fs.getFileStatus(self.at("lock")).getModificationTime()
        # of several that see a stale lock, the one whose rename succeeds takes it
        stale = age >= self.lock_ms and self.fs.rename(self.at("lock"), self.at(f".stale-{uuid.uuid4().hex}"))
        if not (stale and self.fs.createNewFile(self.at("lock"))):
            raise RuntimeError(f"{self.path}: another write-back holds the lock")

    def read(self) -> DataFrame:
        now = self.current()
        return self.spark.read.schema(SEND_SCHEDULE).parquet(f"{self.path}/{now}") if now else self.spark.createDataFrame([], SEND_SCHEDULE)

    def write_back(self, new: DataFrame) -> tuple[int, int]:
        """(candidates, written)."""
        self._lock()
        new = new.persist()  # checked, counted and written from one computation
        try:
            stored, before = self.read(), self.current()
            refuse_malformed(new)
            refuse_malformed(stored)
            n, won = new.count(), merged(stored, new).filter("won").count()
            if won or before is None:
                number = int(before.split("-")[0]) + 1 if before else 0
                name = f"{number:012d}-{uuid.uuid4().hex}"
                upsert(stored, new).write.parquet(f"{self.path}/{name}")
                self.fs.create(self.at(f".tmp-{os.getpid()}"), True).close()
                self.fs.rename(self.at(f".tmp-{os.getpid()}"), self.at(f"current-{name}"))
                for old in self._names():
                    if old.removeprefix("current-").split("-")[0].isdigit() and not old.endswith((name, before or name)):
                        self.fs.delete(self.at(old), True)
            return n, won
        finally:
            new.unpersist()
            self.fs.delete(self.at("lock"), False)


class BucketedSchedule:
    """The served table in buckets of users: a write-back rewrites only buckets with a winner.

    A row lies in the folder of its bucket, a hash of its user; the number of
    buckets is fixed when the table is made. Winners are found by one join, on
    which candidates, winners and touched buckets are counted; then the touched
    buckets are read, merged and replaced by a dynamic overwrite: Spark writes
    them beside the table and moves each into place when all are written. A
    write-back that dies between two moves is completed by the next one with the
    same candidates, as an upsert leaves its own rows alone. One write-back at a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        if not 0 < buckets <= MOST_BUCKETS:
            raise ValueError(f"buckets must be 1 to {MOST_BUCKETS}")
        self.spark, self.path, self.buckets = spark, path, buckets
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        made = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        other = [n for n in made if n.startswith("by-") and n != f"by-{buckets}"]
        if other:
            raise ValueError(f"{path} is in {other[0].removeprefix('by-')} buckets")
        self.table = f"{path}/by-{buckets}"
        self.made = f"by-{buckets}" in made

    def bucket(self, user: str = "user_id") -> Column:
        return F.pmod(F.xxhash64(user), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame:
        fields = [*SEND_SCHEDULE, StructField("bucket", IntegerType())]
        return self.spark.read.schema(StructType(fields)).parquet(self.table) if self.made else self.spark.createDataFrame([], StructType(fields))

    def read(self, *users: str) -> DataFrame:
        """All rows, or those of some users, for which only their buckets are scanned."""
        rows = self._stored()
        if users:
            named = self.spark.createDataFrame([(u,) for u in users], "user_id string").select(self.bucket().alias("b"))
            rows = rows.filter(F.col("bucket").isin(*sorted({r["b"] for r in named.collect()})) & F.col("user_id").isin(*users))
        return rows.select(*SEND_SCHEDULE.names)

    def write_back(self, new: DataFrame) -> tuple[int, int]:
        """(candidates, written)."""
        refuse_malformed(self.read())
        new = new.select(*SEND_SCHEDULE.names).withColumn("bucket", self.bucket()).persist()
        winners = None
        try:
            refuse_malformed(new)
            winners = self._winners(new).persist()
            touched = {r["bucket"]: r["n"] for r in winners.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a bucket
            n = new.count()
            if touched or not self.made:
                kept = self._stored().filter(F.col("bucket").isin(*touched)) if touched else self._stored()
                rows = kept.join(winners.select("user_id"), "user_id", "left_anti").unionByName(winners)
                write = rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                write.partitionBy("bucket").parquet(self.table)
                self.made = True
            return n, sum(touched.values())
        finally:
            new.unpersist()
            if winners is not None:
                winners.unpersist()

    def _winners(self, new: DataFrame) -> DataFrame:
        """Candidates of new users, or strictly above the stored (version number, computed_as_of)."""
        rank = lambda *c: F.struct(version_number(F.col(c[0])), F.col(c[1]))
        old = self._stored().select(F.col("user_id").alias("of"), F.col("bucket").alias("in"), F.col("model_version").alias("old_version"), F.col("computed_as_of").alias("old_as_of"))
        both = new.join(old, (F.col("user_id") == F.col("of")) & (F.col("bucket") == F.col("in")), "left")
        won = F.when(F.col("of").isNull(), True).otherwise(rank("model_version", "computed_as_of") > rank("old_version", "old_as_of"))
        return both.filter(won).select(*new.columns)
