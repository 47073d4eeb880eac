"""Evaluation: accuracy against hidden truth, simulation, holdout, power, and comparison of tables."""

from __future__ import annotations

import math
from random import Random
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import circular_distance, open_probability, ratio
from tidemark.params import LABELS

ARMS = ("baseline", "cohort", "recommended")
#: Differences of the on-time rate that an experiment may be planned for.
EFFECTS = (0.01, 0.02, 0.05)
#: Prompts that one seeded stream may be drawn for: its numbers pass through the driver.
MOST_SEEDED = 1_000_000


def served_hour(scores: DataFrame) -> Column:
    return F.col("send_hour_local") + F.col("send_minute_local") / F.lit(60.0)


def label_accuracy(truth: DataFrame, labelled: DataFrame) -> DataFrame:
    """Share of truth prompts with the right label; a prompt without label is wrong."""
    built = labelled.select("prompt_id", "label")
    right = F.coalesce(F.col("label") == F.col("cause"), F.lit(False))
    return truth.join(built, "prompt_id", "left").agg(F.avg(right.cast("double")).alias("label_accuracy"))


def center_quality(truth_users: DataFrame, scores: DataFrame) -> DataFrame:
    """Mean distance of the centres, and share of served times inside the reachable window; a user without score is 12 hours off and outside."""
    s = scores.select("user_id", "center_hour_local", served_hour(scores).alias("served"))
    t = truth_users.select("user_id", F.col("reachable_center_local_hour").alias("c"), F.col("reachable_width_hours").alias("w")).join(s, "user_id", "left")
    return t.agg(
        F.avg(F.coalesce(circular_distance(F.col("center_hour_local"), F.col("c")), F.lit(12.0))).alias("center_mae"),
        F.avg(F.coalesce(circular_distance(F.col("served"), F.col("c")) <= F.col("w") / 2, F.lit(False)).cast("double")).alias("coverage"),
    )


def seeded_uniforms(prompts: DataFrame, seed: int) -> DataFrame:
    """Four uniforms a prompt from one seeded stream in prompt_id order: for exact reruns of small profiles (the
    stream is drawn on the driver, for ``MOST_SEEDED`` prompts at most; larger ones take ``hashed_uniforms``)."""
    spark, n = prompts.sparkSession, prompts.count()
    if n > MOST_SEEDED:
        raise ValueError(f"{n} prompts are too many for one stream: use hashed_uniforms")
    rng = Random(seed)
    drawn = spark.createDataFrame([(i + 1, *(rng.random() for _ in range(4))) for i in range(n)], "r long, u0 double, u1 double, u2 double, u3 double")
    return prompts.withColumn("r", F.row_number().over(Window.orderBy("prompt_id")).cast("long")).join(drawn, "r").drop("r")


def hashed_uniforms(prompts: DataFrame, seed: int) -> DataFrame:
    """Four uniforms a prompt from its id: the same at every partitioning, at any size."""
    return prompts.withColumns({f"u{i}": F.pmod(F.xxhash64(F.lit(seed), F.lit(i), "prompt_id"), F.lit(1 << 52)) / F.lit(float(1 << 52)) for i in range(4)})


def cause(hour: Column, rates: dict[str, float], window_minutes: Column) -> Column:
    """The cause that fixed uniforms give a prompt sent at ``hour``: delivery, skew, response, upload, in this order."""
    p = open_probability(hour, F.col("reachable_center_local_hour"), F.col("reachable_width_hours"), window_minutes)
    return (
        F.when(F.col("u0") < rates["delivery_fault_rate"], "delivery_fault")
        .when(F.col("u1") < rates["clock_skew_rate"], "unattributed")
        .when(F.col("u2") >= p, "timing_gap")
        .when(F.col("u3") < rates["upload_fault_rate"], "upload_fault")
        .otherwise("on_time")
    )


def simulate(prompts: DataFrame, truth_users: DataFrame, scores: DataFrame, rates: dict[str, float], window_minutes: int) -> DataFrame:
    """Counts and on-time rate of each arm under common uniforms (u0-u3 of ``prompts``).

    Arms: the hour of the data, the cohort's hour, the served hour.
    """
    served = scores.select("user_id", F.col("cohort_hour_local").cast("double").alias("cohort"), served_hour(scores).alias("recommended"))
    rows = prompts.join(truth_users.select("user_id", "reachable_center_local_hour", "reachable_width_hours"), "user_id").join(served, "user_id")
    rows = rows.withColumn("baseline", F.col("local_send_hour"))
    arms = F.explode(F.array(*[F.struct(F.lit(a).alias("arm"), cause(F.col(a), rates, F.lit(float(window_minutes))).alias("cause")) for a in ARMS]))
    out = rows.select(arms.alias("x")).groupBy("x.arm").agg(F.count(F.lit(1)).alias("prompts_sent"), *[F.count_if(F.col("x.cause") == k).alias(k) for k in LABELS])
    out = out.withColumn("prompts_delivered", F.col("prompts_sent") - F.col("delivery_fault"))
    return out.withColumn("ontime_rate", ratio(F.col("on_time"), F.col("prompts_delivered")))


def holdout(scores_cut: DataFrame, stg_full: DataFrame, cut: str, window_hours: float = 2.0) -> DataFrame:
    """How near the schedule of uploads up to ``cut`` comes to the organic opens uploaded after it.

    Over users with both: share of opens inside the window, and the mean of
    each user's nearest open. No such user raises.
    """
    opens = stg_full.filter((F.col("event_type") == "app_opened") & (F.to_date("server_upload_time") > F.lit(cut).cast("date")))
    opens = opens.select("user_id", (F.hour("client_event_time_local") + F.minute("client_event_time_local") / F.lit(60.0)).alias("hour"))
    at = {"recommended": served_hour(scores_cut), "cohort": F.col("cohort_hour_local").cast("double")}
    served = scores_cut.select("user_id", *[hour.alias(arm) for arm, hour in at.items()])
    d = opens.join(served, "user_id").select("user_id", *[circular_distance(F.col(arm), F.col("hour")).alias(arm) for arm in at])
    per_user = [c for arm in at for c in (F.count_if(F.col(arm) <= window_hours).alias(f"hit_{arm}"), F.min(arm).alias(f"near_{arm}"))]
    users = d.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), *per_user)
    sums = [c for arm in at for c in (F.sum(f"hit_{arm}").alias(f"hit_{arm}"), F.avg(f"near_{arm}").alias(f"near_{arm}"))]
    total = users.agg(F.count(F.lit(1)).alias("users"), F.sum("n").alias("opens"), *sums)  # one row, even of nothing
    n_users = F.when(F.col("users") > 0, F.col("users")).otherwise(F.raise_error(F.lit("holdout: no user has both a score and a held-out open")).cast("long"))
    arms = [
        F.struct(F.lit(arm).alias("arm"), n_users.alias("n_users"), F.col("opens").alias("n_opens"), ratio(F.col(f"hit_{arm}"), F.col("opens")).alias("in_window_share"), F.col(f"near_{arm}").alias("mean_nearest_hours"))
        for arm in at
    ]
    return total.select(F.inline(F.array(*arms)))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(f"{what}: nothing to score")
    return df


def sample_size(p: float, effect: float, alpha: float = 0.05, power: float = 0.8) -> int:
    """Users an arm for a two-sided two-sample test of proportions p and p + effect."""
    if effect <= 0:
        raise ValueError("the effect must be positive")
    z = NormalDist().inv_cdf(1 - alpha / 2) + NormalDist().inv_cdf(power)
    q = p + effect
    return math.ceil(z * z * (p * (1 - p) + q * (1 - q)) / effect**2)


def days_to_power(n: int, users_per_arm: int, delivered_share: float) -> int:
    return math.ceil(n / (users_per_arm * delivered_share))


def power_table(labelled: DataFrame, *by: str, effects: tuple[float, ...] = EFFECTS, alpha: float = 0.05, power: float = 0.8) -> DataFrame:
    """For each group and effect: delivered prompts that an arm needs, and days until half of the group's users, one prompt a day, have them.

    One aggregate, whatever the number of groups. Where nothing was delivered, or an arm has no user, the days are NULL.
    """
    z = NormalDist().inv_cdf(1 - alpha / 2) + NormalDist().inv_cdf(power)
    delivered = F.col("delivered_in_grace")
    groups = labelled.groupBy(*by).agg(
        F.countDistinct("user_id").alias("users"),
        ratio(F.count_if(F.col("label") == "on_time"), F.count_if(delivered)).alias("p"),
        ratio(F.count_if(delivered), F.count(F.lit(1))).alias("share"),
    )
    rows = groups.withColumn("effect", F.explode(F.array(*[F.lit(float(e)) for e in effects])))
    q = F.col("p") + F.col("effect")
    n = F.ceil(F.lit(z * z) * (F.col("p") * (1 - F.col("p")) + q * (1 - q)) / (F.col("effect") * F.col("effect")))
    return rows.withColumn("n_per_arm", n).select(*by, "users", F.round("p", 6).alias("ontime_rate"), "effect", "n_per_arm", F.ceil(ratio(F.col("n_per_arm"), F.floor(F.col("users") / 2) * F.col("share"))).alias("days"))


def table_diff(expected: DataFrame, actual: DataFrame, *keys: str) -> DataFrame:
    """Keys that are missing, extra or changed (NULLs compare equal)."""
    rest = [c for c in expected.columns if c not in keys]
    a = expected.select(*keys, F.struct(*rest).alias("a"), F.lit(1).alias("in_a"))
    b = actual.select(*keys, F.struct(*rest).alias("b"), F.lit(1).alias("in_b"))
    both = a.join(b, list(keys), "full_outer")
    kind = F.when(F.col("in_b").isNull(), "missing").when(F.col("in_a").isNull(), "extra").when(~F.col("a").eqNullSafe(F.col("b")), "changed")
    return both.select(*keys, kind.alias("difference")).filter("difference IS NOT NULL")


def content_hash(df: DataFrame) -> DataFrame:
    """One row: the number of rows and a sum of their hashes, whatever their order."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("hash_sum"))
