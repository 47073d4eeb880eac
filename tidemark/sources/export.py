"""Writers: event files by upload day, dimension and truth files, and canonical CSV of small tables."""

from __future__ import annotations

import csv
import io
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import EVENTS, TIME_FORMAT

#: Rows of a canonical CSV, at most: it is compared as text, on the driver.
MOST_CANONICAL = 100_000


def write_events(events: DataFrame, folder: str) -> list[str]:
    """Gzipped newline JSON, named ``events_<upload date>_<nnn>.jsonl.gz``; returns the paths in order.

    Rows of a day lie in files of their own, written by tasks; only the files' names pass the driver.
    """
    spark = events.sparkSession
    props = F.when(F.col("event_properties") == "{}", F.lit("{}")).otherwise(F.col("event_properties"))
    time = lambda c: F.date_format(c, TIME_FORMAT)
    clocks = ("client_event_time", "server_received_time", "server_upload_time")
    plain = [c for c in EVENTS.names if c not in (*clocks, "event_properties")]
    # the properties are JSON already: they go in as they are, and the text before them ends in a quote and one brace
    record = F.concat(F.rtrim(F.to_json(F.struct(*plain, *[time(c).alias(c) for c in clocks])), F.lit("}")), F.lit(',"event_properties":'), props, F.lit("}"))
    days = events.select(F.to_date("server_upload_time").alias("upload_date"), record.alias("value"))
    days.hint("rebalance", "upload_date").write.mode("error").partitionBy("upload_date").option("compression", "gzip").text(f"{folder}/.parts")
    fs, at = store(spark, folder)
    out = []
    for day in sorted(s.getPath().getName() for s in fs.listStatus(at(".parts")) if s.isDirectory()):
        files = sorted(s.getPath().getName() for s in fs.listStatus(at(f".parts/{day}")) if s.getPath().getName().startswith("part-"))
        for k, name in enumerate(files):
            out.append(f"{folder}/events_{day.split('=')[1]}_{k:03d}.jsonl.gz")
            fs.rename(at(f".parts/{day}/{name}"), at(out[-1].rsplit("/", 1)[1]))
    fs.delete(at(".parts"), True)
    return out


def write_dim(dim: DataFrame, path: str) -> None:
    """Headed CSV, an empty cell for NULL."""
    times = {c: F.date_format(c, TIME_FORMAT) for c in ("valid_from", "valid_to")}
    dim.withColumns(times).write.mode("error").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def write_truth(rows: DataFrame, path: str) -> None:
    """Newline JSON; read by evaluation only."""
    rows.write.mode("error").option("compression", "gzip").json(path)


def canonical(df: DataFrame, *columns: str) -> str:
    """A small table as CSV text in one form: rows in order of their first two columns, NULL empty, lines end in LF."""
    rows = df.select(*columns).limit(MOST_CANONICAL + 1).collect()
    if len(rows) > MOST_CANONICAL:
        raise ValueError(f"more than {MOST_CANONICAL} rows: compare large tables with table_diff")
    cells = sorted((tuple(_cell(v) for v in r) for r in rows), key=lambda r: r[:2])
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([columns, *cells])
    return out.getvalue()


def read_canonical(text: str, *columns: str) -> list[tuple[str, ...]]:
    header, *rows = csv.reader(io.StringIO(text))
    if tuple(header) != columns:
        raise ValueError(f"columns {header}, not {list(columns)}")
    return [tuple(r) for r in rows]


def _cell(value: object) -> str:
    if isinstance(value, datetime) and value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return "" if value is None else str(value)


def replaced_block(text: str, name: str, body: str) -> str:
    """A document with what stands between ``<!-- name -->`` and ``<!-- /name -->`` replaced; both marks must be there once."""
    begin, end = f"<!-- {name} -->", f"<!-- /{name} -->"
    if text.count(begin) != 1 or text.count(end) != 1 or text.index(begin) > text.index(end):
        raise ValueError(f"the marks of {name} must occur once, in order")
    return f"{text[: text.index(begin)]}{begin}\n{body.strip()}\n{text[text.index(end) :]}"


def store(spark: SparkSession, folder: str):
    """The file system of a folder, and the paths of names in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), lambda name: path(f"{folder}/{name}")
