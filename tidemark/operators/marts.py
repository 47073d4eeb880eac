"""Daily on-time rate, retention, and the current user dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import days_between, ratio
from tidemark.params import LABELS, Params


def _count(condition) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def dim_user_current(dim: DataFrame) -> DataFrame:
    """The open row of each user."""
    return dim.filter("valid_to IS NULL").select("user_id", "cohort_id", "tz")


def ontime_rate_daily(labelled: DataFrame) -> DataFrame:
    """Counts by cohort and local date; the rate is NULL only when nothing was delivered."""
    out = labelled.groupBy("cohort_id", F.to_date("sent_at_local").alias("prompt_date")).agg(
        F.count(F.lit(1)).alias("prompts_sent"),
        _count(F.col("delivered_in_grace")).alias("prompts_delivered"),
        *[_count(F.col("label") == k).alias(k) for k in ("on_time", "upload_fault", "timing_gap", "unattributed", "delivery_fault")],
    )
    return out.withColumn("ontime_rate", F.round(ratio(F.col("on_time"), F.col("prompts_delivered")), 6))


def overall_rate(daily: DataFrame) -> DataFrame:
    """One row: the sum of on-time prompts by the sum of delivered ones (never a mean of rates)."""
    s = daily.agg(F.sum("prompts_sent").alias("prompts_sent"), F.sum("prompts_delivered").alias("prompts_delivered"), F.sum("on_time").alias("on_time"))
    return s.withColumn("ontime_rate", F.round(ratio(F.col("on_time"), F.col("prompts_delivered")), 6))


def label_counts(labelled: DataFrame) -> DataFrame:
    """All five labels, zeros too."""
    labels = labelled.sparkSession.createDataFrame([(k,) for k in LABELS], "label string")
    counts = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return labels.join(counts, "label", "left").select("label", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def ontime_retention(labelled: DataFrame, stg: DataFrame, params: Params | None = None) -> DataFrame:
    """Rate in each user's first days, and whether they opened the app after them (NULL while that is open)."""
    params = params or Params()
    prompts = labelled.select("user_id", F.to_date("sent_at_local").alias("prompt_date"), "label", "delivered_in_grace")
    anchors = prompts.groupBy("user_id").agg(F.min("prompt_date").alias("anchor_date"))
    early = prompts.join(anchors, "user_id").filter(days_between("anchor_date", "prompt_date") < params.retention_days)
    early = early.groupBy("user_id").agg(_count(F.col("delivered_in_grace")).alias("prompts_delivered"), _count(F.col("label") == "on_time").alias("on_time"))
    days = stg.select("user_id", "event_type", F.to_date("client_event_time_local").alias("day"))
    horizon = days.agg(F.max("day").alias("observed_through"))
    # one row a user and day: the join moves no more than that
    opens = days.filter("event_type = 'app_opened'").groupBy("user_id").agg(F.max("day").alias("last_open"))
    out = anchors.crossJoin(F.broadcast(horizon)).join(early, "user_id", "left").join(opens, "user_id", "left")
    delivered, on_time = (F.coalesce(c, F.lit(0)).cast("long") for c in ("prompts_delivered", "on_time"))
    closed = days_between("anchor_date", "observed_through") >= params.retention_days
    after = F.coalesce(days_between("anchor_date", "last_open") >= params.retention_days, F.lit(False))
    return out.select(
        "user_id", "anchor_date", "observed_through", delivered.alias("prompts_delivered"), on_time.alias("on_time"),
        F.round(ratio(on_time, delivered), 6).alias("ontime_rate"),
        F.when(~F.coalesce(closed, F.lit(False)), F.lit(None).cast("boolean")).otherwise(after).alias("retained"),
    )
