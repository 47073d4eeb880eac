"""Send-time features and scores: circular statistics with shrinkage towards the cohort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import TWO_PI, seconds_between, short_arc, wrap_hours
from tidemark.params import Params


def features_user_hour(stg: DataFrame, params: Params | None = None) -> DataFrame:
    """Organic opens of each user by local hour, in the last days before the last client time of all."""
    params = params or Params()
    horizon = stg.agg(F.max("client_event_time").alias("horizon"))
    opens = stg.filter("event_type = 'app_opened'").select("user_id", "client_event_time", F.hour("client_event_time_local").alias("hour_local"))
    recent = opens.crossJoin(F.broadcast(horizon)).filter(seconds_between("client_event_time", "horizon") < params.feature_window_days * 86400)
    return recent.groupBy("user_id", "hour_local").agg(F.count(F.lit(1)).alias("n_opens"), F.max("client_event_time").alias("last_open_at"))


def _angle(hour: Column) -> Column:
    return F.lit(TWO_PI) * (hour + F.lit(0.5)) / F.lit(24.0)


def circular_sums(bins: DataFrame, by: str) -> DataFrame:
    """n, sum of cosines and of sines for each key. The at most 24 bins are added in order of the hour, so the
    floating sums never depend on how rows were dealt out."""
    hours = bins.groupBy(by, "hour_local").agg(F.sum("n_opens").alias("n_opens"))
    listed = hours.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("hour_local", "n_opens"))).alias("h"), F.sum("n_opens").alias("n_opens"))
    add = lambda f: F.aggregate("h", F.lit(0.0), lambda acc, x: acc + x["n_opens"] * f(_angle(x["hour_local"])))
    return listed.select(by, "n_opens", add(F.cos).alias("ux"), add(F.sin).alias("uy"))


def cohort_prior(bins: DataFrame) -> DataFrame:
    """Mean direction and mean resultant length of each cohort."""
    s = circular_sums(bins, "cohort_id")
    x, y = F.try_divide("ux", F.col("n_opens").cast("double")), F.try_divide("uy", F.col("n_opens").cast("double"))
    return s.select("cohort_id", F.atan2("uy", "ux").alias("mu"), F.sqrt(x * x + y * y).alias("rbar"))


def cohort_window(prompts: DataFrame) -> DataFrame:
    """Whole hours that each cohort's longest window spans."""
    return prompts.groupBy("cohort_id").agg(F.ceil(F.max("window_minutes") / F.lit(60.0)).cast("int").alias("window_bins"))


def window_mass(bins: DataFrame, windows: DataFrame) -> DataFrame:
    """Opens inside the circular window from each hour that has opens. Each bin is sent to the starts it feeds
    (at most 24 a cohort), which replaces a self-join of the bins."""
    b = bins.groupBy("cohort_id", "hour_local").agg(F.sum("n_opens").alias("n_opens")).join(windows, "cohort_id")
    back = F.when(F.col("window_bins") > 0, F.sequence(F.lit(0), F.least(F.col("window_bins"), F.lit(24)) - 1)).otherwise(F.array().cast("array<int>"))
    fed = b.select("cohort_id", "n_opens", F.explode(back).alias("d"), F.col("hour_local").alias("h")).select("cohort_id", F.pmod(F.col("h") - F.col("d"), F.lit(24)).alias("hour_local"), "n_opens")
    mass = fed.groupBy("cohort_id", "hour_local").agg(F.sum("n_opens").alias("mass"))
    return mass.join(b.select("cohort_id", "hour_local"), ["cohort_id", "hour_local"], "left_semi")


def cohort_moment(mass: DataFrame) -> DataFrame:
    """The start of the fullest window; of equal ones the smaller hour."""
    return mass.groupBy("cohort_id").agg(F.max_by("hour_local", F.struct("mass", -F.col("hour_local"))).alias("cohort_hour_local"))


def scores_send_time(current: DataFrame, features: DataFrame, prompts: DataFrame, params: Params | None = None) -> DataFrame:
    """A send time for each user: the posterior centre, held within a band round the cohort's moment.

    Users of a cohort without opens or without prompts have no score.
    """
    params = params or Params()
    k, most = float(params.shrinkage_pseudo_count), params.max_user_shift_min / 60.0
    users = current.select("user_id", "cohort_id")
    feats = features.join(users, "user_id")
    # at most 24 rows a cohort: all that the cohorts' figures need
    bins = feats.groupBy("cohort_id", "hour_local").agg(F.sum("n_opens").alias("n_opens"), F.max("last_open_at").alias("last_open_at"))
    as_of = bins.agg(F.max("last_open_at").alias("computed_as_of"))
    prior = cohort_prior(bins)
    moment = cohort_moment(window_mass(bins, cohort_window(prompts)))
    own = circular_sums(feats, "user_id").select("user_id", "n_opens", "ux", "uy")
    cohorts = prior.join(moment, "cohort_id")  # a row a cohort
    zero = F.lit(0.0)
    rows = users.join(cohorts, "cohort_id").join(own, "user_id", "left")
    rows = rows.select(
        "user_id", "cohort_id", "cohort_hour_local", F.coalesce("n_opens", F.lit(0)).alias("n"),
        (F.coalesce("ux", zero) + k * F.col("rbar") * F.cos("mu")).alias("px"),
        (F.coalesce("uy", zero) + k * F.col("rbar") * F.sin("mu")).alias("py"),
    )
    center = wrap_hours(F.atan2("py", "px") * F.lit(24.0) / F.lit(TWO_PI))
    rows = rows.withColumns({"center": center, "sure": F.sqrt(F.col("px") * F.col("px") + F.col("py") * F.col("py")) / (F.col("n") + F.lit(k))})
    shift = F.greatest(F.lit(-most), F.least(F.lit(most), short_arc(F.col("center") - F.col("cohort_hour_local"))))
    minute = F.pmod(F.round((F.col("cohort_hour_local") + shift) * F.lit(60.0)).cast("int"), F.lit(1440))
    return rows.withColumn("minute", minute).crossJoin(F.broadcast(as_of)).select(
        "user_id", "cohort_id",
        F.expr("minute div 60").cast("int").alias("send_hour_local"),
        (F.col("minute") % 60).alias("send_minute_local"),
        "cohort_hour_local",
        F.round("center", 6).alias("center_hour_local"),
        F.round("sure", 6).alias("confidence"),
        F.lit(params.model_version).alias("model_version"),
        "computed_as_of",
    )
