"""Data checks without scans of their own: metrics observed while the models are written.

``Watch`` puts a metric node into the plan of a model, so its numbers come with
the write. A run may be stopped by them before anything is published.

Uniqueness is read from counts of steps that the models take anyway: events
before and after the join with the dimension, prompts and the groups of their
evidence. Copies that conflict are counted in the window that picks the earliest.

A stage that runs again after a lost executor may count its rows twice. Numbers
that should be zero stay zero or not; two counts that should be equal may then
differ without cause, so ``pipeline.refresh`` confirms a broken metric by the
check's own query before it refuses.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.params import LABELS, Params
from tidemark.sources.schemas import PROPERTY_KEYS

from .checks import error_code_misplaced, out_of_band, parts_missed

RAW_REQUIRED = ("insert_id", "event_type", "user_id", "client_event_time", "server_received_time", "server_upload_time")


def _nulls(*columns: str) -> Column:
    """Cells that are NULL."""
    return F.coalesce(F.sum(sum((F.col(c).isNull().cast("long") for c in columns), F.lit(0).cast("long"))), F.lit(0))


def _odd(column: str, values: tuple[str, ...]) -> Column:
    return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def metrics(model: str, params: Params) -> dict[str, Column]:
    """What is observed of each model, as aggregates without DISTINCT."""
    return {
        "raw": lambda: {"nulls": _nulls(*RAW_REQUIRED), "odd_types": _odd("event_type", tuple(PROPERTY_KEYS)), "conflicts": F.count_if("_conflict")},
        "deduped": lambda: {"n": F.count(F.lit(1))},
        "stg_events": lambda: {"n": F.count(F.lit(1)), "no_zone": _nulls("tz"), "nulls": _nulls("insert_id", "tz", "event_date"), "misplaced": F.count_if(error_code_misplaced())},
        "stg_prompts": lambda: {"n": F.count(F.lit(1)), "other_cohort": F.count_if(F.col("prompt_cohort_id").isNull() | (F.col("prompt_cohort_id") != F.col("cohort_id")))},
        "evidence": lambda: {"n": F.count(F.lit(1))},
        "attribution": lambda: {"n": F.count(F.lit(1)), "unlabelled": _nulls("label"), "odd_labels": _odd("label", LABELS), "odd_status": _odd("status", ("final", "provisional"))},
        "ontime_rate_daily": lambda: {"parts_missed": F.count_if(parts_missed()), "unattributed": F.coalesce(F.sum("unattributed"), F.lit(0)), "prompts": F.coalesce(F.sum("prompts_sent"), F.lit(0))},
        "scores_send_time": lambda: {"out_of_band": F.count_if(out_of_band(params))},
    }[model]()


class Watch:
    """The observations of one run. As a function of (model, df) it gives the frame that is observed."""

    def __init__(self, params: Params | None = None):
        self.params = params or Params()
        self.seen: dict[str, Observation] = {}

    def __call__(self, model: str, df: DataFrame) -> DataFrame:
        self.seen[model] = Observation(f"{model}-{uuid.uuid4().hex}")
        return df.observe(self.seen[model], *[c.alias(k) for k, c in metrics(model, self.params).items()])

    def numbers(self) -> dict[str, dict[str, int]]:
        """The metrics of each model; its query must have run."""
        return {model: o.get for model, o in self.seen.items()}

    def broken(self) -> dict[str, int]:
        """By check, how far the run is from passing it: 0 where it holds."""
        x = self.numbers()
        share = x["ontime_rate_daily"]["unattributed"] > self.params.unattributed_max * x["ontime_rate_daily"]["prompts"]
        return {
            "raw_not_null": x["raw"]["nulls"],
            "raw_event_type": x["raw"]["odd_types"],
            "no_conflicting_duplicates": x["raw"]["conflicts"],
            "one_dim_row_per_event": abs(x["stg_events"]["n"] - x["deduped"]["n"]) + x["stg_events"]["no_zone"],
            "stg_not_null": x["stg_events"]["nulls"],
            "error_code_only_on_failure": x["stg_events"]["misplaced"],
            "prompt_cohort_matches_dim": x["stg_prompts"]["other_cohort"],
            "prompt_unique": abs(x["stg_prompts"]["n"] - x["evidence"]["n"]),
            "one_label_per_prompt": abs(x["stg_prompts"]["n"] - x["attribution"]["n"]) + x["attribution"]["unlabelled"],
            "label_accepted": x["attribution"]["odd_labels"],
            "status_accepted": x["attribution"]["odd_status"],
            "cohort_day_partition": x["ontime_rate_daily"]["parts_missed"],
            "unattributed_share": x["ontime_rate_daily"]["unattributed"] if share else 0,
            "send_time_in_band": x["scores_send_time"]["out_of_band"],
        }

