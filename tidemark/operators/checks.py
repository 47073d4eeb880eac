"""Data checks: each returns the rows that violate it, so an empty result passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio, short_arc
from tidemark.params import LABELS, Params
from tidemark.sources.landing import conflicting_duplicates  # noqa: F401  (one of the checks)
from tidemark.sources.schemas import PROPERTY_KEYS


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_values(df: DataFrame, *columns: str) -> DataFrame:
    """A row for each column that holds NULLs, with their number."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in columns])).alias("x")).select("x.*").filter("n > 0")


def unaccepted(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def cohort_day_unique(daily: DataFrame) -> DataFrame:
    return duplicate_keys(daily, "cohort_id", "prompt_date").drop("n")


def parts_missed() -> Column:
    parts = F.col("on_time") + F.col("upload_fault") + F.col("timing_gap") + F.col("unattributed")
    return (parts != F.col("prompts_delivered")) | (F.col("prompts_delivered") + F.col("delivery_fault") != F.col("prompts_sent"))


def cohort_day_partition(daily: DataFrame) -> DataFrame:
    return daily.filter(parts_missed()).select("cohort_id", "prompt_date")


def one_dim_row_per_event(stg: DataFrame) -> DataFrame:
    s = stg.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("insert_id").alias("n_ids"), F.count("tz").alias("n_with_tz"))
    return s.filter("n_rows <> n_ids OR n_with_tz <> n_rows")


def dim_key_unique(dim: DataFrame) -> DataFrame:
    return duplicate_keys(dim, "user_id", "valid_from")


def error_code_misplaced() -> Column:
    missing = (F.col("event_type") == "upload_failed") & F.col("error_code").isNull()
    return missing | F.col("event_type").isin("upload_started", "upload_completed") & F.col("error_code").isNotNull()


def error_code_only_on_failure(stg: DataFrame) -> DataFrame:
    return stg.filter(error_code_misplaced()).select("insert_id", "event_type", "error_code")


def one_label_per_prompt(prompts: DataFrame, labelled: DataFrame) -> DataFrame:
    a = prompts.agg(F.count(F.lit(1)).alias("prompts"))
    b = labelled.agg(F.count(F.lit(1)).alias("labelled"), F.count_if(F.col("label").isNull()).alias("unlabelled"))
    return a.crossJoin(b).filter("prompts <> labelled OR unlabelled <> 0")  # one row each


def prompt_cohort_matches_dim(prompts: DataFrame) -> DataFrame:
    return prompts.filter("prompt_cohort_id IS NULL OR prompt_cohort_id <> cohort_id").select("prompt_id", "cohort_id", "prompt_cohort_id")


def out_of_band(params: Params | None = None) -> Column:
    away = F.abs(short_arc(F.col("send_hour_local") + F.col("send_minute_local") / F.lit(60.0) - F.col("cohort_hour_local")))
    return (away > (params or Params()).max_user_shift_min / 60.0 + 1e-9) | ~F.col("send_hour_local").between(0, 23) | ~F.col("send_minute_local").between(0, 59)


def send_time_in_band(scores: DataFrame, params: Params | None = None) -> DataFrame:
    return scores.filter(out_of_band(params)).select("user_id")


def unattributed_share(labelled: DataFrame, params: Params | None = None) -> DataFrame:
    share = labelled.agg(ratio(F.count_if(F.col("label") == "unattributed"), F.count(F.lit(1))).alias("unattributed_share"))
    return share.filter(F.col("unattributed_share") > (params or Params()).unattributed_max)


def stale(raw: DataFrame, now, hours: int) -> DataFrame:
    """The last upload, if it is more than so many hours before ``now`` (the caller's clock; feeds nothing)."""
    last = raw.agg(F.max("server_upload_time").alias("last_upload"))
    return last.filter(F.col("last_upload").isNull() | (F.col("last_upload") < F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(hours)} HOURS")))


def all_checks(raw, dim, stg, prompts, labelled, daily, scores, params: Params | None = None) -> dict[str, DataFrame]:
    """Every check by name."""
    return {
        "cohort_day_unique": cohort_day_unique(daily),
        "cohort_day_partition": cohort_day_partition(daily),
        "one_dim_row_per_event": one_dim_row_per_event(stg),
        "dim_key_unique": dim_key_unique(dim),
        "error_code_only_on_failure": error_code_only_on_failure(stg),
        "one_label_per_prompt": one_label_per_prompt(prompts, labelled),
        "prompt_cohort_matches_dim": prompt_cohort_matches_dim(prompts),
        "no_conflicting_duplicates": conflicting_duplicates(raw),
        "send_time_in_band": send_time_in_band(scores, params),
        "unattributed_share": unattributed_share(labelled, params),
        "raw_not_null": null_values(raw, "insert_id", "event_type", "user_id", "client_event_time", "server_received_time", "server_upload_time"),
        "raw_event_type": unaccepted(raw, "event_type", tuple(PROPERTY_KEYS)),
        "stg_not_null": null_values(stg, "insert_id", "tz", "event_date"),
        "label_accepted": unaccepted(labelled, "label", LABELS),
        "status_accepted": unaccepted(labelled, "status", ("final", "provisional")),
        "prompt_unique": duplicate_keys(labelled, "prompt_id"),
        "score_unique": duplicate_keys(scores, "user_id"),
    }


class ChecksFailed(AssertionError):
    pass


def enforce(checks: dict[str, DataFrame]) -> None:
    """Raise with the names of the checks that have rows."""
    failed = [name for name, rows in checks.items() if not rows.isEmpty()]
    if failed:
        raise ChecksFailed(", ".join(failed))
