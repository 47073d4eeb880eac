"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch; texts are a few kB, so a batch stays at a few MB.
BATCH_ROWS = 1000
#: Bytes of text which one group of documents holds in a Python worker, about.
GROUP_BYTES = 6_000_000
#: Copies of one row that a task gives at once.
COPIES = 10_000
#: Groups of rows that look a key up.
LOOKUP_GROUPS = 1024


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``; where that is unset
    (tests on one machine) a folder of this process is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, base, True)
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base}/tidemark-{name}-{uuid.uuid4().hex}"
    for made in _noted:
        made.append(path)
    return path


_noted: list[list[str]] = []


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths that are made in the shared folder meanwhile."""
    made: list[str] = []
    _noted.append(made)
    try:
        yield made
    finally:
        _noted.remove(made)


def deleted(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables that nothing reads any more."""
    for p in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch for tables of whole texts, if nobody has chosen a bound."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def column(batch: pa.RecordBatch | pa.Table, name: str) -> list:
    return batch.column(name).to_pylist()


def byte_texts(batch: pa.RecordBatch | pa.Table, name: str = "text") -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def passed(docs: DataFrame, read: Callable[[str], Callable]) -> DataFrame:
    """``docs`` through a function of Arrow batches that keeps their columns; ``read`` is given the name of the text column there.

    The columns go by number meanwhile, as Spark takes no name with a dot into such a function.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(read(f"c{docs.columns.index('text')}"), plain.schema).toDF(*docs.columns)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only: extra columns of any name never meet the operators' own."""
    return df.select(*[df[n] for n in names])


def text_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and bytes of text, from one narrow aggregate."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    return row["n"], row["b"] or 0


def group_of(groups: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(groups)).cast("int")


def partitions(spark: SparkSession, groups: int) -> int:
    """Shuffle partitions for so many groups: the session's number or more, with a few groups in each."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-groups // 4))


def repeats(rows: DataFrame, key: str) -> bool:
    """Whether any value of ``key`` is there twice."""
    return not rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def repeated(rows: DataFrame, copies: str, *keys: str) -> DataFrame:
    """Each row as often as its column ``copies`` says, with ``nth`` (from 0) in that column's place.

    A row with millions of copies is dealt out in parts of ``COPIES``, by the row's ``keys``, so no task gives them all.
    """
    most = F.lit(COPIES)
    parts = rows.withColumn("repeated_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / most))))
    parts = parts.repartition(*keys, "repeated_part")
    first = F.col("repeated_part") * most
    return parts.withColumn("nth", F.explode(F.sequence(first, F.least(first + most, F.col(copies)) - 1))).drop(copies, "repeated_part")


def looked_up(rows: DataFrame, name: str, key: str, table: DataFrame) -> DataFrame:
    """``rows`` left-joined with ``table`` on ``key`` (unique there), where many rows may hold one key.

    The rows of a group of names ask once for each key, so a key that a third of all
    rows hold is asked for by ``LOOKUP_GROUPS`` rows at most and answered to each group.
    """
    rows = rows.withColumn("lookup_g", group_of(LOOKUP_GROUPS, name))
    asked = rows.select("lookup_g", key).distinct().join(table, key)
    return rows.join(asked, ["lookup_g", key], "left").drop("lookup_g")


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(column(b, n) for n in names), strict=True)
