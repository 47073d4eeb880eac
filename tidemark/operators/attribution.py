"""Exactly one cause for every prompt, from the evidence of its events."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import seconds_between
from tidemark.params import Params

from .staging import last_upload, since, upload_horizon

FLAGS = ("response_on_time", "captured_in_window_received_late", "has_response", "has_response_in_window", "has_capture_in_window", "has_upload_failed", "has_upload_event")


def evidence(stg: DataFrame, prompts: DataFrame) -> DataFrame:
    """Flags of each prompt over all its events, aggregated before they meet the prompts again."""
    p = prompts.select("prompt_id", "sent_at", (F.col("window_minutes") * 60).alias("window_seconds"))
    e = stg.filter("prompt_id IS NOT NULL").select("prompt_id", "event_type", "upload_delay_seconds", "client_event_time", "server_received_time").join(p, "prompt_id")
    inside = lambda c: (seconds_between("sent_at", c) >= 0) & (seconds_between("sent_at", c) < F.col("window_seconds"))
    e = e.select("prompt_id", "upload_delay_seconds", F.col("event_type").alias("t"), inside("client_event_time").alias("client_in"), inside("server_received_time").alias("received_in"))
    t, client_in, received_in = F.col("t"), F.col("client_in"), F.col("received_in")
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    response = t == "response_recorded"
    return e.groupBy("prompt_id").agg(
        F.min("upload_delay_seconds").alias("min_upload_delay_seconds"),
        some(response & client_in & received_in).alias("response_on_time"),
        some(t.isin("capture_started", "upload_started", "upload_completed") & client_in & ~received_in).alias("captured_in_window_received_late"),
        some(response).alias("has_response"),
        some(response & client_in).alias("has_response_in_window"),
        some((t == "capture_started") & client_in).alias("has_capture_in_window"),
        some(t == "upload_failed").alias("has_upload_failed"),
        some(t.isin("upload_started", "upload_failed", "upload_completed")).alias("has_upload_event"),
    )


def label_of(params: Params):
    """The causes in their order of precedence: the first that holds is the label."""
    c = F.col
    return (
        F.when(~c("delivered_in_grace"), "delivery_fault")
        .when(c("min_upload_delay_seconds") < -60 * params.skew_max_min, "unattributed")
        .when(c("response_on_time"), "on_time")
        .when((c("has_response") & c("captured_in_window_received_late")) | (c("has_upload_failed") & ~c("has_response")), "upload_fault")
        .when(~(c("has_capture_in_window") | c("has_response_in_window") | c("has_upload_event")), "timing_gap")
        .otherwise("unattributed")
    )


def attribution(prompts: DataFrame, stg: DataFrame, params: Params | None = None, incremental: bool = False, watch: Callable[[str, DataFrame], DataFrame] | None = None, horizon: date | None = None) -> DataFrame:
    """One label a prompt, under the prompt's own cohort; final once its date is ``lookback_days`` behind the uploads.

    Incremental: dates inside the lookback, from events dated at most
    ``source_prune_margin_days`` before it. The day just at its end is final and
    written once more, so every partition is stamped final. ``horizon``: the last
    upload date, where ``stg`` does not hold all events.
    """
    params = params or Params()
    known = horizon
    if incremental:
        known = last_upload(stg)
        prompts = since(prompts, "prompt_date", known, params.lookback_days)
        stg = since(stg, "event_date", known, params.lookback_days + params.source_prune_margin_days)
    grace = F.col("delivered_at").isNotNull() & (seconds_between("sent_at", "delivered_at") <= 60 * params.delivery_grace_min)
    p = prompts.select(
        "prompt_id", "user_id", F.col("prompt_cohort_id").alias("cohort_id"), "tz", "window_minutes", "sent_at", "sent_at_local",
        "prompt_date", "delivered_at", F.coalesce(grace, F.lit(False)).alias("delivered_in_grace"),
    )
    found = evidence(stg, prompts)
    out = p.join(watch("evidence", found) if watch else found, "prompt_id", "left")
    out = out.withColumns({"min_upload_delay_seconds": F.coalesce("min_upload_delay_seconds", F.lit(0).cast("long"))} | {k: F.coalesce(k, F.lit(False)) for k in FLAGS})
    out = out.withColumn("label", label_of(params))
    out = out.withColumn("horizon", F.lit(known)) if known else out.crossJoin(F.broadcast(upload_horizon(stg)))
    status = F.when(F.datediff("horizon", "prompt_date") >= params.lookback_days, "final").otherwise("provisional")
    out = out.withColumn("status", status).drop("horizon")
    return watch("attribution", out) if watch else out
