"""Landing: typed scans of the exports, and an append-only raw table by upload date."""

from __future__ import annotations

import hashlib
import re
from datetime import date
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import json_value, marked

from .schemas import DIM_USER, EVENTS, PROPERTIES, PROPERTY_KEYS, TIME_FORMAT
from .scratch import scratch_path

#: ``TIME_FORMAT`` as a pattern.
TIME = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{6}$"
#: Copies of an event that agree in these must agree in their payload.
CLOCKS = ("insert_id", "client_event_time", "server_received_time", "server_upload_time")
NAME = re.compile(r"events_(\d{4}-\d{2}-\d{2})(?:_\d+)*\.jsonl(?:\.gz)?")


class ConflictingDuplicates(ValueError):
    """One event came with several payloads."""


class ManifestDrift(ValueError):
    """Files differ from their manifest."""


def file_date(name: str) -> date:
    """The upload date in a file's name; any other name is refused."""
    m = NAME.fullmatch(Path(name).name)
    if not m:
        raise ValueError(f"not an event file: {name}")
    return date.fromisoformat(m[1])


def select_files(names: list[str], through: str | date | None = None) -> list[str]:
    """The event files up to and with a date, in order of name."""
    cut = date.fromisoformat(through) if isinstance(through, str) and through else through or None
    return sorted(n for n in names if (d := file_date(n)) and (cut is None or d <= cut))


def read_events(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Newline JSON (gzip by name) with the contract's schema; a bad record fails the read."""
    if not paths:
        return spark.createDataFrame([], EVENTS)
    return spark.read.schema(EVENTS).option("timestampNTZFormat", TIME_FORMAT).option("mode", "FAILFAST").json(paths)


def _events_of(value: Column) -> Column:
    loose = T.StructType([T.StructField(f.name, T.StringType(), True) for f in EVENTS])
    return F.from_json(value, loose)


def screened_events(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every record of the files: the contract's columns, its text, its file, and why it is refused (empty: accepted).

    Reasons: ``not_json``; ``missing:<field>`` (absent, null or, but for the
    properties, empty); ``unknown_field:<field>``; ``bad_time:<field>``;
    ``unknown_type``; ``bad_properties`` (no JSON object); ``unknown_property:<key>``
    (outside the keys of the event's type). Blank lines are no records.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file")) if paths else spark.createDataFrame([], "value string, file string")
    rows = lines.filter(F.trim("value") != "").select("value", "file", _events_of(F.col("value")).alias("e"), F.json_object_keys("value").alias("fields"))
    e = lambda c: F.col(f"e.{c}")
    times = [f.name for f in EVENTS if isinstance(f.dataType, T.TimestampNTZType)]
    # no zone is asked: a naive time that a session's zone skips is a time; each is read once, into a column of its own
    rows = rows.withColumns({"keys": F.json_object_keys("e.event_properties")} | {c: F.when(e(c).rlike(TIME), e(c).try_cast("timestamp_ntz")) for c in times})
    allowed = F.create_map(*[x for kind, keys in PROPERTY_KEYS.items() for x in (F.lit(kind), F.array(*map(F.lit, keys)).cast("array<string>"))])
    known = allowed[e("event_type")]
    named = lambda keys, kind: F.transform(keys, lambda k: F.concat(F.lit(kind), k))
    tests = {f"missing:{c}": F.coalesce(e(c), F.lit("")) == "" for c in EVENTS.names}
    tests |= {f"bad_time:{c}": (e(c) != "") & F.col(c).isNull() for c in times}
    tests |= {"unknown_type": (e("event_type") != "") & known.isNull(), "bad_properties": (e("event_properties") != "") & F.col("keys").isNull()}
    one_each = [F.when(test, F.lit(reason)) for reason, test in tests.items()]
    unknown = F.array_except("keys", known)
    several = [named(F.array_except("fields", F.array(*map(F.lit, EVENTS.names))), "unknown_field:"), named(unknown, "unknown_property:")]
    none = F.array().cast("array<string>")
    found = F.concat(F.array_compact(F.array(*one_each)), *[F.coalesce(x, none) for x in several])
    # most records are good, and are told by plain tests: nothing is missing, and there are no more fields than the contract's
    good = ~reduce(Column.__or__, [F.coalesce(test, F.lit(False)) for test in tests.values()]) & (F.size("fields") == len(EVENTS)) & (F.size(unknown) == 0)
    reasons = F.when(good, none).when(F.col("fields").isNull(), F.array(F.lit("not_json"))).otherwise(found)
    columns = [F.col(c) if c in times else e(c).alias(c) for c in EVENTS.names]
    return rows.select(*columns, "value", "file", reasons.alias("reasons"))


def land_screened(spark: SparkSession, paths: list[str], path: str, rejects: str) -> tuple[DataFrame, DataFrame]:
    """Land the accepted records of the files; the refused ones go beside them, with their reasons. Returns both tables.

    The files are parsed once, into a scratch table of accepted and refused rows.
    A run with the same files replaces its own rejects: they lie in a folder for
    each set of files (a hash of their names). Nothing is landed where accepted
    copies conflict.
    """
    scratch = scratch_path(spark, "screened")
    rows = screened_events(spark, paths)
    # of accepted records the text is not needed again
    text = [F.when(F.col("refused"), F.col(c)).alias(c) for c in ("value", "file")]
    rows = rows.withColumn("refused", F.size("reasons") > 0).select(*EVENTS.names, *text, "reasons", "refused")
    rows.write.parquet(scratch)
    rows = spark.read.schema(rows.schema).parquet(scratch)
    refused = rows.filter("refused").select("value", "file", "reasons").withColumn("batch", F.lit(hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]))
    landed = land(spark, rows.filter("NOT refused").select(*EVENTS.names), path)
    refused.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(rejects)
    drop(spark, scratch, confirm=True)
    return landed, spark.read.schema(refused.schema).parquet(rejects)


def read_dim_user(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV whose header is the contract's; an empty cell is NULL, and NULL only where the contract allows it."""
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in DIM_USER])
    # the header is held against the contract: columns in another order, or of other names, are refused
    df = spark.read.schema(loose).option("header", True).option("enforceSchema", False).option("nullValue", "").option("emptyValue", "").option("mode", "FAILFAST").option("timestampNTZFormat", TIME_FORMAT).csv(path)
    checked = [c if f.nullable else F.when(F.col(f.name).isNotNull(), F.col(f.name)).otherwise(F.raise_error(F.lit(f"dim_user: {f.name} is empty"))).alias(f.name) for f, c in zip(DIM_USER, DIM_USER.names, strict=True)]
    return df.select(*checked)


def read_dim(spark: SparkSession, source: str, jdbc: dict[str, str] | None = None) -> DataFrame:
    """The dimension from a table or view of that name, or from another store by JDBC."""
    return spark.read.format("jdbc").options(dbtable=source, **jdbc).load() if jdbc else spark.table(source)


def payload(text: Column | str) -> Column:
    """What an event's properties say, as one text."""
    return marked(*[json_value(text, k) for k in PROPERTIES])


def read_dim_jdbc(spark: SparkSession, url: str, table: str, cuts: tuple[str, ...] = (), **options: str) -> DataFrame:
    """The dimension from a database by JDBC: one partition for each range of user_id between the cuts.

    Filters and columns are pushed into the ranges' queries. A cell that the
    contract requires and the database does not have is refused when it is read.
    """
    quoted = [c.replace("'", "''") for c in sorted(cuts)]
    low, high = [None, *quoted], [*quoted, None]
    ranges = [" AND ".join([f"\"user_id\" >= '{a}'"] * (a is not None) + [f"\"user_id\" < '{b}'"] * (b is not None)) or "1 = 1" for a, b in zip(low, high, strict=True)]
    if quoted:
        ranges[0] += ' OR "user_id" IS NULL'
    texts = ", ".join(f"{f.name} STRING" for f in DIM_USER if isinstance(f.dataType, T.StringType))
    df = spark.read.jdbc(url, table, predicates=ranges, properties={"preferTimestampNTZ": "true", "customSchema": texts, **options})
    missing = [c for c in DIM_USER.names if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks {missing}")
    # a condition beside the columns, so that filters on these still reach the database
    empty = reduce(lambda a, f: a.when(F.col(f.name).isNull(), F.raise_error(F.lit(f"dim_user: {f.name} is empty")).cast("boolean")), [f for f in DIM_USER if not f.nullable], F)
    return df.filter(empty.otherwise(True)).select(*[F.col(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name).cast(f.dataType).alias(f.name) for f in DIM_USER])


def write_dim_jdbc(dim: DataFrame, url: str, table: str, partitions: int = 8, **options: str) -> int:
    """Replace the database's table by the dimension, and check what it then holds; returns its rows.

    The table is emptied and filled by ``partitions`` connections, each in one
    transaction. A task that ran twice, or a write that died, shows as rows more or
    fewer than were sent: that raises, and writing again puts it right.
    """
    spark = dim.sparkSession
    dim = dim.select(*DIM_USER.names)
    texts = ", ".join(f"{f.name} VARCHAR(255)" for f in DIM_USER if isinstance(f.dataType, T.StringType))
    sent = Observation()
    rows = dim.coalesce(partitions).observe(sent, F.count(F.lit(1)).alias("n"))
    rows.write.option("truncate", True).option("createTableColumnTypes", texts).jdbc(url, table, mode="overwrite", properties=options)
    held = spark.read.jdbc(url, table, properties=options).select("user_id", "valid_from")
    n, keys = held.count(), held.distinct().count()
    if not n == keys == sent.get["n"]:
        raise RuntimeError(f"{table} holds {n} rows of {keys} keys, {sent.get['n']} were sent: write again")
    return n


def conflicting_duplicates(events: DataFrame) -> DataFrame:
    """insert_ids that carry one set of clocks and several payloads."""
    return events.groupBy(*CLOCKS).agg(F.countDistinct(payload("event_properties")).alias("n_payloads")).filter("n_payloads > 1").select("insert_id", "n_payloads")


def conflicts(events: DataFrame, most: int = 20) -> list[str]:
    """Some insert_ids of ``conflicting_duplicates``; payloads are parsed of those events alone whose clocks several rows share."""
    shared = events.groupBy(*CLOCKS).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if shared.isEmpty():
        return []
    copies = events.alias("a").join(shared.alias("b"), F.expr(" AND ".join(f"a.{c} <=> b.{c}" for c in CLOCKS)), "left_semi")
    return sorted(r[0] for r in conflicting_duplicates(copies).select("insert_id").limit(most).collect())


def with_upload_date(events: DataFrame) -> DataFrame:
    return events.withColumn("upload_date", F.to_date("server_upload_time"))


def land(spark: SparkSession, events: DataFrame, path: str) -> DataFrame:
    """Write the days of ``events`` into the raw table, each replacing what that day held.

    Days that are not in the batch stay. The batch is checked before anything is
    written: a conflict leaves the table as it was. Copies conflict only if all
    their clocks are equal, the upload's too; they are of one upload day, which
    the batch replaces as a whole, so the days that stay need not be read.
    """
    batch = with_upload_date(events).select(*EVENTS.names, "upload_date")
    bad = conflicts(batch)
    if bad:
        raise ConflictingDuplicates(", ".join(bad))
    # rows of a day go together, but a large day is split by the adaptive planner
    batch.hint("rebalance", "upload_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("upload_date").parquet(path)
    return spark.read.parquet(path)


def file_hashes(spark: SparkSession, *folders: str) -> DataFrame:
    """(name, bytes, sha256) of every file below the folders, by any file system that Spark reads; names are relative to their folder.

    Files are hashed where they are read, one at a time; only names and hashes
    travel. Spark's scans do not show empty files, so these are as good as missing.
    """
    parts = []
    for folder in folders:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        root = spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath().rstrip("/") + "/"
        path = F.regexp_replace("path", "^[a-z0-9]+:/*(?=/)", "")
        parts.append(files.select(F.substring_index(path, root, -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")))
    return reduce(DataFrame.unionByName, parts)


def manifest_drift(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(name, drift) of files that are missing, extra or changed against a manifest table of (name, sha256)."""
    want, have = manifest.select("name", F.col("sha256").alias("want")), files.select("name", F.col("sha256").alias("have"))
    drift = F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "extra").when(F.col("want") != F.col("have"), "changed")
    return want.join(have, "name", "full_outer").select("name", drift.alias("drift")).filter("drift IS NOT NULL")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def manifest(root: str, parts: tuple[str, ...] = ("raw", "dims")) -> dict[str, str]:
    """sha256 of every file of the named folders, by relative name. For fixtures on a local disk."""
    base = Path(root)
    files = (p for part in parts for p in (base / part).rglob("*") if p.is_file())
    return {p.relative_to(base).as_posix(): hashlib.sha256(p.read_bytes()).hexdigest() for p in sorted(files)}


def check_manifest(root: str, text: str) -> None:
    """Refuse a fixture whose files differ from its manifest (lines of ``sha256  name``)."""
    want = {name: digest for digest, name in (line.split(maxsplit=1) for line in text.splitlines() if line.strip()) if name.split("/")[0] in ("raw", "dims")}
    have = manifest(root)
    drift = sorted(n for n in want.keys() | have.keys() if want.get(n) != have.get(n))
    if drift:
        raise ManifestDrift(", ".join(drift))


def drop(spark: SparkSession, path: str, confirm: bool = False) -> None:
    """Delete a table's folder; only with an explicit yes."""
    if not confirm:
        raise PermissionError(f"{path}: say confirm=True to delete it")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
