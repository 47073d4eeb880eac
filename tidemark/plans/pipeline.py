"""The whole chain: stage, attribute, mart, score, serve; in memory or incrementally on tables."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import attribution as att
from tidemark.operators import checks, marts, scores, serving, staging
from tidemark.operators.metrics import Watch
from tidemark.params import Params
from tidemark.plans.staged import Staged
from tidemark.session import configure


class Tables:
    """The models of one input, each built when it is first asked for: a function of raw, dim and params alone.

    ``staged``: models that are tables already.
    Otherwise those that several others read (staging, attribution, features,
    scores) are stored at ``level`` when they are first computed, until
    ``unpersist``; with level None nothing is stored.
    """

    NAMES = ("stg_events", "stg_prompts", "attribution", "ontime_rate_daily", "ontime_retention", "dim_user_current", "features_user_hour", "scores_send_time")

    def __init__(self, raw: DataFrame, dim: DataFrame, params: Params | None = None, level: StorageLevel | None = StorageLevel.MEMORY_AND_DISK, staged: dict[str, DataFrame] | None = None):
        self.raw, self.dim, self.params, self.level = raw, dim, params or Params(), level
        self.kept: list[DataFrame] = []
        vars(self).update(staged or {})

    def _keep(self, df: DataFrame) -> DataFrame:
        if self.level is None:
            return df
        self.kept.append(df.persist(self.level))
        return self.kept[-1]

    @cached_property
    def stg_events(self) -> DataFrame:
        return self._keep(staging.stg_events(self.raw, self.dim, self.params))

    @cached_property
    def stg_prompts(self) -> DataFrame:
        return staging.stg_prompts(self.stg_events, self.params)

    @cached_property
    def attribution(self) -> DataFrame:
        return self._keep(att.attribution(self.stg_prompts, self.stg_events, self.params))

    @cached_property
    def ontime_rate_daily(self) -> DataFrame:
        return marts.ontime_rate_daily(self.attribution)

    @cached_property
    def ontime_retention(self) -> DataFrame:
        return marts.ontime_retention(self.attribution, self.stg_events, self.params)

    @cached_property
    def dim_user_current(self) -> DataFrame:
        return marts.dim_user_current(self.dim)

    @cached_property
    def features_user_hour(self) -> DataFrame:
        return self._keep(scores.features_user_hour(self.stg_events, self.params))

    @cached_property
    def scores_send_time(self) -> DataFrame:
        return self._keep(scores.scores_send_time(self.dim_user_current, self.features_user_hour, self.stg_prompts, self.params))

    def register(self, prefix: str = "") -> None:
        """Each table as a temporary view."""
        for name in self.NAMES:
            getattr(self, name).createOrReplaceTempView(prefix + name)

    def unpersist(self) -> None:
        """Let go of what was stored."""
        while self.kept:
            self.kept.pop().unpersist()


def build(raw: DataFrame, dim: DataFrame, params: Params | None = None, level: StorageLevel | None = StorageLevel.MEMORY_AND_DISK) -> Tables:
    """All models of an input, in memory."""
    return Tables(raw, dim, params, level)


PARTITIONS = {"stg_events": "event_date", "stg_prompts": "prompt_date", "attribution": "prompt_date"}
#: Tables that are computed in full by every run, from those before them.
WHOLE = ("ontime_rate_daily", "ontime_retention", "dim_user_current", "features_user_hour", "scores_send_time")


def refresh(spark: SparkSession, raw: DataFrame, dim: DataFrame, root: str, params: Params | None = None, full: bool = False, check: bool = False, watch: Watch | None = None) -> Tables:
    """Write all models under ``root``; none is published before all are written.

    The first run, or ``full``, writes everything; later runs rewrite only the
    local dates inside the lookback of the three partitioned models, each
    partition as a whole. Marts, features and scores are always computed in full,
    once. ``check``: metrics of the rows that are written (those of the dates
    that this run rewrites) are observed meanwhile, and a violation stops the
    run with the published tables as they were. ``watch``: the metrics alone,
    for the caller to read.
    """
    params = params or Params()
    configure(spark)
    staged, watch = Staged(spark, root, params.schema_prefix), Watch(params) if check else watch
    again = not full and all(staged.exists(name) for name in PARTITIONS)
    put = lambda name, df: staged.write(name, df, PARTITIONS[name], again)
    seen = watch or (lambda name, df: df)
    try:
        stg = put("stg_events", staging.stg_events(raw, dim, params, again, watch))
        prompts = put("stg_prompts", seen("stg_prompts", staging.stg_prompts(stg, params, again)))
        labelled = put("attribution", att.attribution(prompts, stg, params, again, watch))
        t = Tables(raw, dim, params, None, {"stg_events": stg, "stg_prompts": prompts, "attribution": labelled})
        for name in WHOLE:
            model = getattr(t, name)
            setattr(t, name, staged.write(name, seen(name, model) if name in ("ontime_rate_daily", "scores_send_time") else model))
        if check:
            _refuse_broken(t, watch)
    except BaseException:
        staged.discard()
        raise
    columns = {name: getattr(t, name).columns for name in (*PARTITIONS, *WHOLE)}
    staged.publish()
    return Tables(raw, dim, params, None, {name: spark.read.parquet(staged.live(name)).select(*own) for name, own in columns.items()})


def repeated_keys(t: Tables) -> DataFrame:
    """(check, n): keys that occur more than once in the small tables, in one job."""
    of = {"cohort_day_unique": (t.ontime_rate_daily, ("cohort_id", "prompt_date")), "dim_key_unique": (t.dim, ("user_id", "valid_from")), "score_unique": (t.scores_send_time, ("user_id",))}
    parts = [checks.duplicate_keys(df, *keys).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n") for name, (df, keys) in of.items()]
    return reduce(DataFrame.unionByName, parts)


def _refuse_broken(t: Tables, watch: Watch) -> None:
    """Raise if a check is broken. Counts may be too high where a stage ran twice, so the check's own query decides."""
    broken = [name for name, n in watch.broken().items() if n] + [r["check"] for r in repeated_keys(t).collect() if r["n"]]
    if broken:
        exact = checks.all_checks(t.raw, t.dim, t.stg_events, t.stg_prompts, t.attribution, t.ontime_rate_daily, t.scores_send_time, t.params)
        checks.enforce({name: exact[name] for name in broken})


def run(spark: SparkSession, raw: DataFrame, dim: DataFrame, root: str, params: Params | None = None, full: bool = False, check: bool = True) -> tuple[Tables, tuple[int, int]]:
    """Build, check (a violation stops before anything is published) and write back."""
    params = params or Params()
    t = refresh(spark, raw, dim, root, params, full, check)
    served = serving.BucketedSchedule(spark, f"{root}/{params.schema_prefix}send_schedule").write_back(serving.candidates(t.scores_send_time, t.dim_user_current))
    return t, served
