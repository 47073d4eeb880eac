"""Staging: earliest copies with their time zone, and prompts with their first receipt."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import json_values, seconds_between, to_local
from tidemark.sources.landing import payload
from tidemark.sources.schemas import PROPERTIES
from tidemark.params import Params


def upload_horizon(events: DataFrame) -> DataFrame:
    """One row: the last upload date."""
    return events.agg(F.to_date(F.max("server_upload_time")).alias("horizon"))


def last_upload(events: DataFrame) -> date | None:
    """The last upload date, read once (one row): by the partition column alone where there is one."""
    row = events.agg(F.max("upload_date").alias("horizon")) if "upload_date" in events.columns else upload_horizon(events)
    return row.first()["horizon"]


def since(df: DataFrame, day: str, horizon: date | None, days: int) -> DataFrame:
    """Rows whose date is at most so many days before the horizon: a literal bound, which prunes partitions of that date."""
    return df if horizon is None else df.filter(F.col(day) >= F.lit(horizon - timedelta(days=days)))


def dedupe_earliest(raw: DataFrame, watch: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """Of the copies of an event the one that was uploaded, received, made first.

    Watched, each copy is compared with the one before it in the same window: a
    conflict has its clocks and another payload.
    """
    clocks = ("server_upload_time", "server_received_time", "client_event_time")
    w = Window.partitionBy("insert_id").orderBy(*clocks)
    rows = raw.withColumn("_copy", F.row_number().over(w))
    if watch is None:
        return rows.filter("_copy = 1").drop("_copy")
    rows = rows.withColumn("_before", F.lag(F.struct(*clocks, "event_properties")).over(w))
    same = reduce(lambda a, b: a & b, [F.col(f"_before.{c}").eqNullSafe(F.col(c)) for c in clocks])
    text, before = F.col("event_properties"), F.col("_before.event_properties")
    # a payload is parsed only where the texts of two such copies differ
    differs = F.when(F.col("_before").isNotNull() & same & ~text.eqNullSafe(before), payload(text) != payload(before))
    rows = watch("raw", rows.withColumn("_conflict", F.coalesce(differs, F.lit(False))))
    return watch("deduped", rows.filter("_copy = 1").drop("_copy", "_before", "_conflict"))


def as_of(events: DataFrame, dim: DataFrame, at: str = "client_event_time") -> DataFrame:
    """Zone and cohort of the user that were valid at the event; kept without if there are none.

    An equality on user_id with the interval as a residual condition: the
    planner may broadcast a small dimension or sort-merge a large one.
    """
    d = dim.select(F.col("user_id").alias("_u"), "tz", "cohort_id", "valid_from", "valid_to")
    valid = (F.col("valid_from") <= F.col(at)) & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to")))
    return events.join(d, (events["user_id"] == d["_u"]) & valid, "left").drop("_u", "valid_from", "valid_to")


def stg_events(raw: DataFrame, dim: DataFrame, params: Params | None = None, incremental: bool = False, watch: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row an event. Incremental: only local dates inside the lookback.

    The earliest copy is chosen before the lookback cuts; only whole upload days
    that cannot matter (lookback and margin) are pruned from the scan.
    """
    params = params or Params()
    horizon = last_upload(raw) if incremental else None
    if incremental and "upload_date" in raw.columns:
        raw = since(raw, "upload_date", horizon, params.lookback_days + params.source_prune_margin_days)
    rows = as_of(dedupe_earliest(raw, watch), dim)
    local = to_local("client_event_time", "tz")
    # parsed once for all keys: a step of its own, which the optimizer keeps as one expression
    rows = rows.withColumn("_properties", json_values("event_properties", *PROPERTIES))
    prop = lambda k: F.col(f"_properties.{k}")
    out = rows.select(
        "insert_id", "event_type", "user_id", "device_id", "client_event_time", "server_received_time", "server_upload_time", "tz", "cohort_id",
        local.alias("client_event_time_local"),
        F.to_date(local).alias("event_date"),
        seconds_between("client_event_time", "server_received_time").alias("upload_delay_seconds"),
        prop("prompt_id").alias("prompt_id"),
        prop("cohort_id").alias("prompt_cohort_id"),
        prop("window_minutes").cast("int").alias("window_minutes"),
        prop("attempt").cast("int").alias("attempt"),
        prop("error_code").alias("error_code"),
        prop("response_id").alias("response_id"),
    )
    out = watch("stg_events", out) if watch else out
    return since(out, "event_date", horizon, params.lookback_days) if incremental else out


def first_receipts(stg: DataFrame) -> DataFrame:
    """The first receipt of each prompt by client time, then insert_id: a hash aggregate, no sort."""
    first = F.min(F.struct("client_event_time", "insert_id", "client_event_time_local")).alias("r")
    got = stg.filter("event_type = 'prompt_delivered'").groupBy("prompt_id").agg(first)
    return got.select("prompt_id", F.col("r.insert_id").alias("delivered_insert_id"), F.col("r.client_event_time").alias("delivered_at"), F.col("r.client_event_time_local").alias("delivered_at_local"))


def stg_prompts(stg: DataFrame, params: Params | None = None, incremental: bool = False) -> DataFrame:
    """One row a prompt; no receipt, no delivery time.

    Incremental: prompts dated inside the lookback, and receipts dated at most
    ``source_prune_margin_days`` before that (a receipt follows its prompt; the
    margin covers zones and clocks).
    """
    params = params or Params()
    if incremental:
        horizon = last_upload(stg)
        out = stg_prompts(since(stg, "event_date", horizon, params.lookback_days + params.source_prune_margin_days), params)
        return since(out, "prompt_date", horizon, params.lookback_days)
    sent = stg.filter("event_type = 'prompt_sent'").select(
        "prompt_id", "user_id", "cohort_id", "prompt_cohort_id", "tz", "window_minutes",
        F.col("client_event_time").alias("sent_at"),
        F.col("client_event_time_local").alias("sent_at_local"),
        F.col("event_date").alias("prompt_date"),
    )
    return sent.join(first_receipts(stg), "prompt_id", "left")
