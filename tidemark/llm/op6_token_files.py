"""Token ids in Parquet list columns, for selective reads.

Each document is one row: its id, its ids (a list column with dictionary
encoding), their number and its place in the file (delta encodings). Row
groups and pages have set sizes, and Parquet's page index is written, so a
reader of a few documents or of the metadata alone skips the other pages.

Scale: texts move once, into ranges of the order asked for; each task writes
one file. Starts come from the files' own sums: one number a file.

Edge cases: null and empty texts hold the end id alone; rows with equal ids
lie side by side; a null id comes first; an empty table writes an empty file
set; other columns are ignored. A special token's name inside a text is
encoded as the library does by default.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_path, small_batches
from .tokens import encoder, pieces, vocabulary_path

#: Bytes of text for each file, about.
FILE_BYTES = 16_000_000
OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.enable.dictionary#offset": "false",
}
SCHEMA = "doc_id long, tokens array<int>, n_tokens long, part int, offset long"


def write_tokens(docs: DataFrame, path: str, end_id: int = 0, vocabulary: str | None = None, order: list | None = None, text: str = "text") -> None:
    """Encode every text and write the files at ``path``, in ascending ``order`` (``doc_id`` unless given)."""
    vocabulary = vocabulary or vocabulary_path()
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length(docs[text]))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    keys = [F.col(f"_k{i}") for i in range(len(order or []))] or [F.col("doc_id")]
    rows = docs.select(docs["doc_id"], docs[text].alias("text"), *[c.alias(f"_k{i}") for i, c in enumerate(order or [])])
    rows = rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys, F.xxhash64("text")).select("doc_id", "text")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        many, part, offset = encoder(vocabulary).encode_many, TaskContext.get().partitionId(), 0
        for b in pieces(batches):
            ids, n = many(b.column("text"))
            n = n + 1
            ends = np.cumsum(n)
            flat = np.full(int(ends[-1]), end_id, np.int32)
            inside = np.ones(len(flat), bool)
            inside[ends - 1] = False
            flat[inside] = ids
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), lists, pa.array(n), pa.array(np.full(len(n), part, np.int32)), pa.array(offset + ends - n)],
                ["doc_id", "tokens", "n_tokens", "part", "offset"],
            )
            offset += int(ends[-1])

    rows.mapInArrow(encoded, SCHEMA).write.options(**OPTIONS).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Ids, places and sizes of the documents; no token page is read."""
    return spark.read.schema(SCHEMA).parquet(path).select("doc_id", "n_tokens", "part", "offset")


def read_tokens(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """The ids of documents from ``low`` to ``high``: other row groups and pages are skipped by their statistics."""
    return spark.read.schema(SCHEMA).parquet(path).filter(F.col("doc_id").between(low, high)).select("doc_id", "tokens")


def describe(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold: doc_id, start, n_tokens, ids_crc32 of each document."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("tokens")
            at = lists.offsets.to_numpy()
            ids = lists.values.to_numpy().astype("<u4", copy=False)
            crc = [zlib.crc32(ids[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(at).astype(np.int64)), b.column("part"), b.column("offset"), pa.array(crc, pa.int64())], ["doc_id", "n_tokens", "part", "offset", "ids_crc32"])

    read = rows.select("doc_id", "tokens", "part", "offset").mapInArrow(sums, "doc_id long, n_tokens long, part int, offset long, ids_crc32 long")
    return read.join(parts, "part").select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def file_order(docs: DataFrame) -> list:
    """The order of rows in the files that ``docs`` is read from: the file's number, and the row's in it."""
    number = F.regexp_extract(docs["_metadata.file_name"], r"part-(\d+)", 1)
    return [F.when(number != "", number.cast("long")), docs["_metadata.file_name"], docs["_metadata.row_index"]]


def token_files(docs: DataFrame, order: list | None = None) -> DataFrame:
    """Write the token files in the shared folder and describe them from a read of their own."""
    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    write_tokens(docs, path, order=order)
    return describe(spark, path)
