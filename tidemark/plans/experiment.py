"""An experiment over users: its arms, its sends, and the read-out by arm."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio

#: Parts in a thousand of the users that an experiment's arms take.
SPLIT = {"treatment": 475, "control": 475, "holdout": 50}


def assigned(users: DataFrame, salt: str, split: dict[str, int] | None = None) -> DataFrame:
    """The users with their ``arm``: by a salted hash of the id, so never drawn anew and even within every cohort."""
    part, upto, arm = F.pmod(F.xxhash64(F.lit(salt), F.col("user_id")), F.lit(1000)), 0, None
    for name, share in (split or SPLIT).items():
        upto += share
        arm = F.when(part < upto, name) if arm is None else arm.when(part < upto, name)
    if upto != 1000:
        raise ValueError("the arms' parts must add up to 1000")
    return users.withColumn("arm", arm)


def jittered(sends: DataFrame, salt: str, share: float = 0.1, minutes: int = 15) -> DataFrame:
    """``jitter_min`` of each treated (user_id, prompt_date): a tenth of the sends move by up to a quarter of an hour."""
    u = lambda tag: F.pmod(F.xxhash64(F.lit(f"{salt} {tag}"), F.col("user_id"), F.col("prompt_date")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    by = F.floor(u("by") * (2 * minutes + 1)).cast("int") - minutes
    return sends.withColumn("jitter_min", F.when((F.col("arm") == "treatment") & (u("whether") < share), by).otherwise(F.lit(0)))


def ratio_metrics() -> dict[str, tuple[Column, Column]]:
    """The primary metric and the guardrails: which prompts count, of which."""
    label, delivered = F.col("label"), F.col("delivered_in_grace")
    return {
        "ontime_rate": (label == "on_time", delivered),
        "response_rate": (label.isin("on_time", "upload_fault"), delivered),
        "delivery_fault_share": (label == "delivery_fault", F.lit(True)),
        "unattributed_share": (label == "unattributed", delivered),
    }


def readout(labelled: DataFrame, arms: DataFrame, z: float = 1.959964) -> DataFrame:
    """One row a metric: its rate in treatment and control, their difference, its standard error and interval.

    Rates are sums over sums, so cohort-days weigh by their prompts. Prompts of
    one user depend on each other: the variance is that of the ratio of sums over
    users (delta method), from each user's two counts and their products in one
    aggregate an arm. Users without an arm, and other arms, are left out; an arm
    without users, or of one, has no error.
    """
    metrics = ratio_metrics()
    counts = [c for name, (of, among) in metrics.items() for c in (F.count_if(of & among).alias(f"x_{name}"), F.count_if(among).alias(f"n_{name}"))]
    users = labelled.groupBy("user_id").agg(*counts).join(arms.select("user_id", "arm").filter("arm IN ('treatment', 'control')"), "user_id")
    moments = [F.count(F.lit(1)).alias("users")]
    for name in metrics:
        x, n = (F.col(f"{c}_{name}").cast("double") for c in "xn")
        moments += [F.sum(v).alias(f"{k}_{name}") for k, v in {"x": x, "n": n, "xx": x * x, "nn": n * n, "xn": x * n}.items()]
    by_arm = users.groupBy("arm").agg(*moments)

    def of(name: str) -> Column:
        c = lambda k: F.col(f"{k}_{name}")
        rate = ratio(c("x"), c("n"))
        spread = ratio(c("xx") - 2 * rate * c("xn") + rate * rate * c("nn"), c("n") * c("n"))
        return F.struct(F.lit(name).alias("metric"), rate.alias("rate"), (spread * ratio(F.col("users"), F.col("users") - 1)).alias("variance"))

    rows = by_arm.select("arm", "users", F.explode(F.array(*map(of, metrics))).alias("m")).select("arm", "users", "m.*")
    arm = lambda name, c: F.max(F.when(F.col("arm") == name, F.col(c)))
    both = rows.groupBy("metric").agg(*[arm(a, c).alias(f"{a}_{c}") for a in ("treatment", "control") for c in ("users", "rate", "variance")])
    difference = F.col("treatment_rate") - F.col("control_rate")
    error = F.sqrt(F.col("treatment_variance") + F.col("control_variance"))
    out = both.select("metric", "treatment_users", "control_users", "treatment_rate", "control_rate", difference.alias("difference"), error.alias("std_error"))
    return out.withColumn("low", F.col("difference") - z * F.col("std_error")).withColumn("high", F.col("difference") + z * F.col("std_error"))
