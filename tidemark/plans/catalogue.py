"""One query for each operator over the driver's tables, and the same query in DuckDB's SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import circular_distance, json_value, open_probability, seconds_between, to_local
from tidemark.operators import attribution as att
from tidemark.operators import checks, marts, scores, serving, staging
from tidemark.operators.metrics import Watch
from tidemark.params import LABELS, Params
from tidemark.plans import evaluate, experiment, targets
from tidemark.plans.pipeline import Tables, build, refresh
from tidemark.session import configure
from tidemark.sources import export, landing, star_adapter
from tidemark.sources.landing import conflicting_duplicates, with_upload_date
from tidemark.sources.scratch import scratch_path

CUT = "2024-01-20"
NOW = datetime(2024, 2, 2, 12)
RATES = {"delivery_fault_rate": 0.08, "clock_skew_rate": 0.03, "upload_fault_rate": 0.1}


def _raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    configure(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return star_adapter.raw_events(events), star_adapter.dim_user(events)


_held: dict[str, list[Tables]] = {}


def _built(spark: SparkSession, *inputs: tuple[DataFrame, DataFrame]) -> list[Tables]:
    """The models of one query. What the session's query before stored is let go, so each pays for its own models."""
    for t in _held.pop(spark.sparkContext.applicationId, []):
        t.unpersist()
    _held.clear()
    return _held.setdefault(spark.sparkContext.applicationId, [build(raw, dim) for raw, dim in inputs])


def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    return _built(spark, _raw(spark, sf_dir))[0]


def _stg(spark, sf_dir):
    return _tables(spark, sf_dir).stg_events


def _number(user: str = "user_id"):
    return F.substring(user, 3, 20).cast("long")


def dedupe_earliest(spark, d):
    return staging.dedupe_earliest(_raw(spark, d)[0]).select("insert_id", "event_type", "server_upload_time")


def conflicts(spark, d):
    raw = _raw(spark, d)[0]
    broken = raw.filter(raw["insert_id"].endswith("7")).withColumn("event_properties", F.lit("{}"))
    return conflicting_duplicates(raw.unionByName(broken)).select("insert_id", F.col("n_payloads").cast("long").alias("n_payloads"))


def scd2_as_of(spark, d):
    raw, dim = _raw(spark, d)
    return staging.as_of(staging.dedupe_earliest(raw), dim).select("insert_id", "user_id", "tz", "cohort_id")


def local_date_hour(spark, d):
    return _stg(spark, d).select("insert_id", "client_event_time_local", "event_date", F.hour("client_event_time_local").alias("hour_local"))


def json_fields(spark, d):
    raw = _raw(spark, d)[0]
    return raw.groupBy(json_value("event_properties", "prompt_id").alias("prompt_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max(json_value("event_properties", "window_minutes").cast("int")).alias("window_minutes"), F.count(json_value("event_properties", "error_code")).alias("n_errors")
    ).filter("prompt_id IS NOT NULL")


def upload_delay(spark, d):
    raw = _raw(spark, d)[0]
    return raw.select("event_type", seconds_between("client_event_time", "server_received_time").alias("s")).groupBy("event_type").agg(F.min("s").alias("least"), F.max("s").alias("most"), F.sum("s").alias("total"))


def first_receipt(spark, d):
    return staging.stg_prompts(_stg(spark, d)).select("prompt_id", "prompt_date", "delivered_insert_id", "delivered_at")


def evidence_flags(spark, d):
    t = _tables(spark, d)
    return t.attribution.select("prompt_id", "delivered_in_grace", "min_upload_delay_seconds", *att.FLAGS)


def attribution(spark, d):
    return _tables(spark, d).attribution.select("prompt_id", "user_id", "cohort_id", "prompt_date", "label")


def attribution_by_prompt(spark, d):
    """The labels from tables in buckets of prompt_id, which need no exchange on it."""
    t, name = _tables(spark, d), f"by_prompt_{uuid.uuid4().hex[:12]}"
    held = targets.ByPrompt(spark, name, scratch_path(spark, "by-prompt"), 8).write(t.stg_prompts, t.stg_events)
    return held.attribution().select("prompt_id", "user_id", "cohort_id", "prompt_date", "label", "status")


def status_final(spark, d):
    return _tables(spark, d).attribution.groupBy("prompt_date", "status").agg(F.count(F.lit(1)).alias("n"))


def ontime_rate_daily(spark, d):
    return _tables(spark, d).ontime_rate_daily


def overall_rate(spark, d):
    return marts.overall_rate(_tables(spark, d).ontime_rate_daily)


def label_counts(spark, d):
    return marts.label_counts(_tables(spark, d).attribution)


def retention(spark, d):
    return _tables(spark, d).ontime_retention


def dim_current(spark, d):
    return marts.dim_user_current(_raw(spark, d)[1])


def features_user_hour(spark, d):
    return _tables(spark, d).features_user_hour


def circular_vector(spark, d):
    t = _tables(spark, d)
    feats = t.features_user_hour.join(t.dim_user_current.select("user_id", "cohort_id"), "user_id")
    sums = scores.circular_sums(feats, "cohort_id").join(scores.cohort_prior(feats), "cohort_id")
    return sums.select("cohort_id", F.col("n_opens").cast("long").alias("n_opens"), *[F.round(c, 6).alias(c) for c in ("ux", "uy", "mu", "rbar")])


def _mass(t: Tables) -> DataFrame:
    feats = t.features_user_hour.join(t.dim_user_current.select("user_id", "cohort_id"), "user_id")
    return scores.window_mass(feats, scores.cohort_window(t.stg_prompts))


def cohort_window_mass(spark, d):
    return _mass(_tables(spark, d))


def cohort_moment(spark, d):
    return scores.cohort_moment(_mass(_tables(spark, d)))


def scores_send_time(spark, d):
    return _tables(spark, d).scores_send_time


def _offers(spark, d):
    """A stored schedule and candidates, of which some are above their stored row, some below and some new."""
    t = _tables(spark, d)
    new = serving.candidates(t.scores_send_time.withColumn("model_version", F.lit("v2")), t.dim_user_current)
    stored = new.filter(_number() % 5 != 0).withColumns(
        {
            "model_version": F.when(_number() % 3 == 0, "v10").otherwise("v1"),
            "computed_as_of": F.col("computed_as_of") - F.expr("INTERVAL 1 DAY"),
            "written_at": F.col("computed_as_of") - F.expr("INTERVAL 1 DAY"),
            "send_hour_local": F.lit(0),
        }
    )
    return stored, new


def send_schedule_upsert(spark, d):
    return serving.upsert(*_offers(spark, d))


def send_schedule_buckets(spark, d):
    """The same through the table in buckets: made from the stored rows, then written back."""
    stored, new = _offers(spark, d)
    served = serving.BucketedSchedule(spark, scratch_path(spark, "served"), 16)
    served.write_back(stored)
    served.write_back(new)
    return served.read()


def lookback_partitions(spark, d):
    raw, dim = _raw(spark, d)
    return staging.stg_events(with_upload_date(raw), dim, Params(), incremental=True).groupBy("event_date").agg(F.count(F.lit(1)).alias("n_events"), F.countDistinct("insert_id").alias("n_ids"))


def through_cut(spark, d):
    raw = with_upload_date(_raw(spark, d)[0]).filter(F.col("upload_date") <= F.lit(CUT).cast("date"))
    return raw.groupBy("upload_date").agg(F.count(F.lit(1)).alias("n_events"))


def holdout(spark, d):
    raw, dim = _raw(spark, d)
    early = with_upload_date(raw).filter(F.col("upload_date") <= F.lit(CUT).cast("date")).drop("upload_date")
    cut, full = _built(spark, (early, dim), (raw, dim))
    out = evaluate.holdout(cut.scores_send_time, full.stg_events, CUT)
    return out.select("arm", "n_users", "n_opens", F.round("in_window_share", 6).alias("in_window_share"), F.round("mean_nearest_hours", 6).alias("mean_nearest_hours"))


def _truth_users(current: DataFrame) -> DataFrame:
    n = _number()
    return current.select("user_id", (n * 7 % 24 + F.lit(0.5)).alias("reachable_center_local_hour"), (n % 5 + F.lit(4.0)).alias("reachable_width_hours"))


def simulate_counts(spark, d):
    t = _tables(spark, d)
    p = t.stg_prompts.select("prompt_id", "user_id", (F.hour("sent_at_local") + F.minute("sent_at_local") / F.lit(60.0)).alias("local_send_hour"), (_number() * 31 + F.dayofmonth("prompt_date")).alias("z"))
    p = p.withColumns({f"u{i}": (F.col("z") * 7919 + (i + 1) * 104729) % 10007 / F.lit(10007.0) for i in range(4)})
    out = evaluate.simulate(p, _truth_users(t.dim_user_current), t.scores_send_time, RATES, 60)
    return out.select("arm", "prompts_sent", *LABELS, "prompts_delivered", F.round("ontime_rate", 6).alias("ontime_rate"))


def center_quality(spark, d):
    t = _tables(spark, d)
    q = evaluate.center_quality(_truth_users(t.dim_user_current), t.scores_send_time)
    return q.select(F.round("center_mae", 5).alias("center_mae"), F.round("coverage", 6).alias("coverage"))


def label_accuracy(spark, d):
    t = _tables(spark, d)
    truth = t.stg_prompts.select("prompt_id", F.when(F.col("delivered_at").isNull(), "delivery_fault").otherwise("timing_gap").alias("cause"))
    return evaluate.label_accuracy(truth, t.attribution).select(F.round("label_accuracy", 6).alias("label_accuracy"))


def power_table(spark, d):
    return evaluate.power_table(_tables(spark, d).attribution, "cohort_id")


def experiment_readout(spark, d):
    """Two arms by the user's number, with a holdout that is left out."""
    t = _tables(spark, d)
    arms = t.dim_user_current.select("user_id", F.when(_number() % 19 == 0, "holdout").when(_number() % 2 == 0, "treatment").otherwise("control").alias("arm"))
    out = experiment.readout(t.attribution, arms)
    return out.select("metric", *[F.col(c).cast("long").alias(c) for c in ("treatment_users", "control_users")], *[F.round(c, 6).alias(c) for c in ("treatment_rate", "control_rate", "difference", "std_error")])


def checks_partition(spark, d):
    daily = _tables(spark, d).ontime_rate_daily
    return checks.cohort_day_partition(daily.withColumn("on_time", F.when(F.dayofmonth("prompt_date") % 7 == 0, F.col("on_time") + 1).otherwise(F.col("on_time"))))


def checks_unique(spark, d):
    dim = _raw(spark, d)[1]
    return checks.dim_key_unique(dim.unionByName(dim.filter(_number() % 4 == 0))).select("user_id", "valid_from", "n")


def checks_one_dim_row(spark, d):
    raw, dim = _raw(spark, d)
    twice = dim.unionByName(dim.filter(_number() % 10 == 3))
    return checks.one_dim_row_per_event(staging.stg_events(raw, twice)).select("n_rows", "n_ids", "n_with_tz")


def checks_share(spark, d):
    return checks.unattributed_share(_tables(spark, d).attribution).select(F.round("unattributed_share", 6).alias("unattributed_share"))


def checks_band(spark, d):
    s = _tables(spark, d).scores_send_time
    return checks.send_time_in_band(s.withColumn("send_hour_local", F.when(_number() % 6 == 0, F.pmod(F.col("send_hour_local") + 9, F.lit(24))).otherwise(F.col("send_hour_local"))))


def golden_diff(spark, d):
    daily = _tables(spark, d).ontime_rate_daily.select("cohort_id", "prompt_date", "prompts_sent", "on_time")
    day = F.dayofmonth("prompt_date")
    other = daily.filter(~((F.col("cohort_id") == "c-0") & (day % 2 == 0))).withColumn("on_time", F.when((F.col("cohort_id") == "c-1") & (day % 5 == 0), F.col("on_time") + 1).otherwise(F.col("on_time")))
    more = daily.filter(F.col("cohort_id") == "c-2").withColumn("cohort_id", F.lit("c-9"))
    return evaluate.table_diff(daily, other.unionByName(more), "cohort_id", "prompt_date")


def response_curve(spark, d):
    c = _raw(spark, d)[1].filter("valid_to IS NULL").select("user_id", _number().alias("n"))
    h, center, width, window = (F.col("n") % 24).cast("double"), (F.col("n") * 7 % 24).cast("double"), (F.col("n") % 5).cast("double"), (F.col("n") % 90).cast("double")
    return c.select("user_id", F.round(circular_distance(h, center), 6).alias("distance"), F.round(open_probability(h, center, width, window), 6).alias("probability"))


def local_round_trip(spark, d):
    e = _raw(spark, d)[0].select("insert_id", "client_event_time").distinct()
    return e.select(F.to_date(to_local("client_event_time", F.lit("Asia/Tokyo"))).alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


def checks_cohort_day(spark, d):
    daily = _tables(spark, d).ontime_rate_daily
    return checks.cohort_day_unique(daily.unionByName(daily.filter(F.dayofmonth("prompt_date") % 6 == 0)))


def checks_error_code(spark, d):
    stg = _stg(spark, d)
    planted = F.when((F.substring("insert_id", 3, 20).cast("long") % 3 == 0) & F.col("event_type").isin("upload_failed", "upload_completed"), "E1")
    return checks.error_code_only_on_failure(stg.withColumn("error_code", planted))


def checks_one_label(spark, d):
    t = _tables(spark, d)
    return checks.one_label_per_prompt(t.stg_prompts, t.attribution.filter(~F.col("prompt_id").endswith("1")))


def checks_prompt_cohort(spark, d):
    p = _tables(spark, d).stg_prompts
    planted = F.when(_number() % 4 == 0, "c-9").when(_number() % 7 != 0, F.col("prompt_cohort_id"))
    return checks.prompt_cohort_matches_dim(p.withColumn("prompt_cohort_id", planted))


def checks_columns(spark, d):
    stg = _stg(spark, d)
    nulls = checks.null_values(stg, "insert_id", "prompt_id", "window_minutes").select(F.lit("not_null").alias("test"), F.col("column_name").alias("of"), "n")
    odd = checks.unaccepted(stg, "event_type", ("app_opened", "prompt_sent", "prompt_delivered")).select(F.lit("accepted").alias("test"), F.col("event_type").alias("of"), "n")
    again = checks.duplicate_keys(stg.filter("event_type = 'prompt_sent'"), "user_id").select(F.lit("unique").alias("test"), F.col("user_id").alias("of"), "n")
    return nulls.unionByName(odd).unionByName(again).withColumn("n", F.col("n").cast("long"))


def checks_freshness(spark, d):
    return checks.stale(_raw(spark, d)[0], NOW, 36)


def content_hashes(spark, d):
    daily = _tables(spark, d).ontime_rate_daily
    a, b = (evaluate.content_hash(x) for x in (daily, daily.repartition(5)))
    same = a.join(b.withColumnsRenamed({"n_rows": "m_rows", "hash_sum": "other"}), F.col("hash_sum") == F.col("other"), "left")
    return same.select("n_rows", F.coalesce(F.col("n_rows") == F.col("m_rows"), F.lit(False)).alias("same"))


def landed_files(spark, d):
    """Export files of the events, of which those up to a date are selected, scanned and landed by upload day."""
    folder = scratch_path(spark, "landing")
    files = export.write_events(_raw(spark, d)[0], f"{folder}/raw")
    landed = landing.land(spark, landing.read_events(spark, landing.select_files(files, CUT)), f"{folder}/events")
    return landed.groupBy("upload_date").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("insert_id").alias("n_ids"), F.count(json_value("event_properties", "prompt_id")).alias("n_with_prompt"),
        F.sum(seconds_between("client_event_time", "server_upload_time")).alias("delay_seconds"),
    )


def landing_rejects(spark, d):
    """Records of the event files, some of them damaged in one of six ways, landed strictly: how many are accepted, and refused for what."""
    folder = scratch_path(spark, "rejects")
    export.write_events(_raw(spark, d)[0], f"{folder}/good")
    n = F.regexp_extract("value", '"insert_id":"[ed]-([0-9]+)"', 1).cast("long")
    hurt = lambda pattern, put: F.regexp_replace("value", pattern, put)
    planted = (
        F.when(n % 11 == 0, hurt('"insert_id":"[^"]*",', ""))
        .when(n % 13 == 0, hurt(r"^\{", '{"source":"x",'))
        .when((n % 17 == 0) & F.col("value").endswith("{}}"), hurt(r"\{\}\}$", '{"attempt_no":1}}'))
        .when(n % 17 == 0, hurt(r"\}\}$", ',"attempt_no":1}}'))
        .when(n % 19 == 0, F.substring("value", 1, 30))
        .when(n % 23 == 0, hurt('"server_received_time":"[^"]*"', '"server_received_time":"soon"'))
        .when(n % 29 == 0, hurt('"event_type":"[^"]*"', '"event_type":"unheard_of"'))
        .otherwise(F.col("value"))
    )
    spark.read.text(f"{folder}/good").select(planted.alias("value")).write.text(f"{folder}/raw")
    landed, refused = landing.land_screened(spark, [f"{folder}/raw"], f"{folder}/events", f"{folder}/refused")
    reasons = refused.select(F.explode("reasons").alias("reason")).unionByName(landed.select(F.lit("accepted").alias("reason")))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def manifest_drift(spark, d):
    """Event files against the manifest of what was exported: each seventh day's are gone, each fifth's rewritten, one is new."""
    folder = scratch_path(spark, "manifest")
    files = export.write_events(_raw(spark, d)[0], f"{folder}/raw")
    manifest = landing.file_hashes(spark, f"{folder}/raw")
    manifest.write.parquet(f"{folder}/manifest")
    fs, at = export.store(spark, f"{folder}/raw")

    def put(name):
        out = fs.create(at(name), True)
        out.writeBytes("other")
        out.close()

    for name in (f.rsplit("/", 1)[1] for f in files):
        day = landing.file_date(name).day
        if day % 7 == 0:
            fs.delete(at(name), False)
        elif day % 5 == 0:
            put(name)
    put("events_2030-01-01_000.jsonl.gz")
    drift = landing.manifest_drift(spark.read.parquet(f"{folder}/manifest"), landing.file_hashes(spark, f"{folder}/raw"))
    return drift.select(F.regexp_extract("name", "[0-9]{4}-[0-9]{2}-[0-9]{2}", 0).alias("day"), "drift").distinct()


def checks_observed(spark, d):
    """How far events with planted faults are from each check, by the metrics that are observed while the tables are written."""
    raw, dim = _raw(spark, d)
    raw = raw.withColumn("event_type", F.when(F.substring("insert_id", 3, 20).cast("long") % 31 == 0, "unheard_of").otherwise(F.col("event_type")))
    late = raw.filter(F.col("insert_id").endswith("7")).withColumn("server_upload_time", F.col("server_upload_time") + F.expr("INTERVAL 1 DAY"))
    raw = raw.unionByName(late).unionByName(late.withColumn("event_properties", F.lit("{}")))
    dim = dim.withColumn("cohort_id", F.when(_number() % 7 == 0, "c-9").otherwise(F.col("cohort_id"))).unionByName(dim.filter(_number() % 10 == 3))
    watch = Watch()
    refresh(spark, raw, dim, scratch_path(spark, "observed"), watch=watch)
    return spark.createDataFrame(list(watch.broken().items()), "check_name string, n long")


def dim_file(spark, d):
    """The dimension through its CSV file."""
    folder = scratch_path(spark, "dim")
    export.write_dim(_raw(spark, d)[1], folder)
    return landing.read_dim_user(spark, folder).select("user_id", "tz", "cohort_id", "valid_from", "valid_to")


def incremental_tables(spark, d):
    """Tables built up to the last upload day but one, then refreshed with the last."""
    raw, dim = _raw(spark, d)
    folder = scratch_path(spark, "tables")
    landing.land(spark, raw, f"{folder}/raw")
    raw = spark.read.parquet(f"{folder}/raw")
    last = F.lit(staging.last_upload(raw))
    refresh(spark, raw.filter(F.col("upload_date") < last), dim, folder)
    t = refresh(spark, raw, dim, folder)
    return t.attribution.groupBy("prompt_date", "label", "status").agg(F.count(F.lit(1)).alias("n"))


# DuckDB ----------------------------------------------------------------------

ADAPTER = """
base AS (
  SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         row_number() OVER w AS n, date_trunc('second', first_value(ts) OVER w) AS sent
  FROM events WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id)),
moved AS (
  SELECT 'e-' || event_id AS insert_id,
         CASE WHEN n = 1 THEN 'prompt_sent' WHEN event_type = 'signup' THEN 'app_opened' WHEN event_type = 'view' THEN 'capture_started'
              WHEN event_type = 'click' THEN 'upload_completed' WHEN event_type = 'purchase' THEN 'response_recorded' WHEN event_type = 'error' THEN 'upload_failed' END AS event_type,
         event_id, user_id, k, sent,
         CASE WHEN n = 1 THEN sent WHEN event_type = 'signup' THEN date_trunc('second', ts)
              ELSE sent + to_seconds(CAST(floor((epoch(date_trunc('second', ts)) - epoch(sent)) / 12) AS BIGINT)) END AS client_event_time
  FROM base
  UNION ALL
  SELECT 'd-' || event_id, 'prompt_delivered', event_id, user_id, k, sent, sent + to_seconds(30 + 7 * k) FROM base WHERE n = 1 AND k % 10 <> 9),
clocked AS (
  SELECT *, client_event_time + to_seconds(CASE WHEN event_type IN ('prompt_sent', 'response_recorded', 'prompt_delivered') THEN 0
              WHEN k % 10 = 0 THEN -400 WHEN k % 10 IN (1, 2) THEN 7200 ELSE k END) AS server_received_time,
         '{' || CASE WHEN event_type = 'app_opened' THEN '' ELSE '"prompt_id":"p-' || user_id || '-' || CAST(CAST(sent AS DATE) AS VARCHAR) || '"' ||
              CASE WHEN event_type = 'prompt_sent' THEN ',"cohort_id":"c-' || (user_id % 3) || '","window_minutes":60' ELSE '' END END || '}' AS event_properties
  FROM moved),
uploaded AS (SELECT *, server_received_time + to_seconds(60 + (event_id % 97) * 600) AS server_upload_time FROM clocked),
raw AS (
  SELECT insert_id, event_type, 'u-' || user_id AS user_id, client_event_time, server_received_time, server_upload_time, event_properties FROM uploaded
  UNION ALL
  SELECT insert_id, event_type, 'u-' || user_id, client_event_time, server_received_time, server_upload_time + to_seconds(1800), event_properties FROM uploaded WHERE event_id % 20 = 0),
people AS (SELECT DISTINCT user_id AS u FROM events),
dim AS (
  SELECT 'u-' || u AS user_id, CASE u % 4 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Europe/London' WHEN 2 THEN 'Asia/Tokyo' ELSE 'America/Los_Angeles' END AS tz,
         'c-' || (u % 3) AS cohort_id, TIMESTAMP '2023-12-01' AS valid_from, CASE WHEN u % 10 = 0 THEN TIMESTAMP '2024-01-15' END AS valid_to FROM people
  UNION ALL
  SELECT 'u-' || u, CASE WHEN u % 4 = 0 THEN 'Asia/Tokyo' ELSE 'Europe/London' END, 'c-' || (u % 3), TIMESTAMP '2024-01-15', NULL FROM people WHERE u % 10 = 0)"""


def chain(raw: str = "raw", dim: str = "dim", p: str = "") -> str:
    """The models from a raw table, as named CTEs with a prefix."""
    return f"""
{p}deduped AS (SELECT * FROM {raw} QUALIFY row_number() OVER (PARTITION BY insert_id ORDER BY server_upload_time, server_received_time, client_event_time) = 1),
{p}zoned AS (SELECT e.*, d.tz, d.cohort_id, (e.client_event_time AT TIME ZONE 'UTC') AT TIME ZONE d.tz AS client_event_time_local
  FROM {p}deduped e LEFT JOIN {dim} d ON e.user_id = d.user_id AND d.valid_from <= e.client_event_time AND (d.valid_to IS NULL OR e.client_event_time < d.valid_to)),
{p}stg AS (SELECT *, CAST(client_event_time_local AS DATE) AS event_date, CAST(epoch(server_received_time) - epoch(client_event_time) AS BIGINT) AS upload_delay_seconds,
  json_extract_string(event_properties, '$.prompt_id') AS prompt_id, json_extract_string(event_properties, '$.cohort_id') AS prompt_cohort_id,
  CAST(json_extract_string(event_properties, '$.window_minutes') AS INTEGER) AS window_minutes FROM {p}zoned),
{p}receipts AS (SELECT prompt_id, insert_id AS delivered_insert_id, client_event_time AS delivered_at FROM {p}stg WHERE event_type = 'prompt_delivered'
  QUALIFY row_number() OVER (PARTITION BY prompt_id ORDER BY client_event_time, insert_id) = 1),
{p}prompts AS (SELECT s.prompt_id, s.user_id, s.cohort_id, s.prompt_cohort_id, s.tz, s.window_minutes, s.client_event_time AS sent_at, s.client_event_time_local AS sent_at_local,
  CAST(s.client_event_time_local AS DATE) AS prompt_date, r.delivered_insert_id, r.delivered_at FROM {p}stg s LEFT JOIN {p}receipts r USING (prompt_id) WHERE s.event_type = 'prompt_sent'),
{p}seen AS (SELECT e.prompt_id, e.event_type AS t, e.upload_delay_seconds, epoch(e.client_event_time) - epoch(p.sent_at) AS c, epoch(e.server_received_time) - epoch(p.sent_at) AS r, p.window_minutes * 60 AS w
  FROM {p}stg e JOIN {p}prompts p USING (prompt_id)),
{p}flags AS (SELECT prompt_id, min(upload_delay_seconds) AS min_upload_delay_seconds,
  bool_or(t = 'response_recorded' AND c >= 0 AND c < w AND r >= 0 AND r < w) AS response_on_time,
  bool_or(t IN ('capture_started', 'upload_started', 'upload_completed') AND c >= 0 AND c < w AND NOT (r >= 0 AND r < w)) AS captured_in_window_received_late,
  bool_or(t = 'response_recorded') AS has_response, bool_or(t = 'response_recorded' AND c >= 0 AND c < w) AS has_response_in_window,
  bool_or(t = 'capture_started' AND c >= 0 AND c < w) AS has_capture_in_window, bool_or(t = 'upload_failed') AS has_upload_failed,
  bool_or(t IN ('upload_started', 'upload_failed', 'upload_completed')) AS has_upload_event FROM {p}seen GROUP BY prompt_id),
{p}graced AS (SELECT p.*, p.delivered_at IS NOT NULL AND epoch(p.delivered_at) - epoch(p.sent_at) <= 600 AS delivered_in_grace, f.* EXCLUDE (prompt_id)
  FROM {p}prompts p JOIN {p}flags f USING (prompt_id)),
{p}labelled AS (SELECT *, CASE WHEN NOT delivered_in_grace THEN 'delivery_fault' WHEN min_upload_delay_seconds < -300 THEN 'unattributed' WHEN response_on_time THEN 'on_time'
  WHEN (has_response AND captured_in_window_received_late) OR (has_upload_failed AND NOT has_response) THEN 'upload_fault'
  WHEN NOT has_capture_in_window AND NOT has_response_in_window AND NOT has_upload_event THEN 'timing_gap' ELSE 'unattributed' END AS label,
  CASE WHEN date_diff('day', prompt_date, (SELECT CAST(max(server_upload_time) AS DATE) FROM {p}stg)) >= 5 THEN 'final' ELSE 'provisional' END AS status FROM {p}graced),
{p}daily AS (SELECT prompt_cohort_id AS cohort_id, prompt_date, count(*) AS prompts_sent, CAST(sum(CAST(delivered_in_grace AS INTEGER)) AS BIGINT) AS prompts_delivered,
  {", ".join(f"CAST(sum(CAST(label = '{k}' AS INTEGER)) AS BIGINT) AS {k}" for k in ("on_time", "upload_fault", "timing_gap", "unattributed", "delivery_fault"))},
  round(CAST(sum(CAST(label = 'on_time' AS INTEGER)) AS DOUBLE) / nullif(sum(CAST(delivered_in_grace AS INTEGER)), 0), 6) AS ontime_rate FROM {p}labelled GROUP BY 1, 2),
{p}current AS (SELECT user_id, cohort_id, tz FROM {dim} WHERE valid_to IS NULL),
{p}features AS (SELECT user_id, CAST(hour(client_event_time_local) AS INTEGER) AS hour_local, count(*) AS n_opens, max(client_event_time) AS last_open_at FROM {p}stg
  WHERE event_type = 'app_opened' AND epoch((SELECT max(client_event_time) FROM {p}stg)) - epoch(client_event_time) < 30 * 86400 GROUP BY 1, 2),
{p}feats AS (SELECT f.*, c.cohort_id, 2 * pi() * (f.hour_local + 0.5) / 24 AS theta FROM {p}features f JOIN {p}current c USING (user_id)),
{p}bins AS (SELECT cohort_id, hour_local, CAST(sum(n_opens) AS BIGINT) AS n_opens FROM {p}feats GROUP BY 1, 2),
{p}prior AS (SELECT cohort_id, CAST(sum(n_opens) AS BIGINT) AS n_opens, sum(n_opens * cos(theta)) AS ux, sum(n_opens * sin(theta)) AS uy FROM {p}feats GROUP BY 1),
{p}bars AS (SELECT *, atan2(uy, ux) AS mu, sqrt((ux / n_opens) * (ux / n_opens) + (uy / n_opens) * (uy / n_opens)) AS rbar FROM {p}prior),
{p}mass AS (SELECT s.cohort_id, s.hour_local, CAST(sum(b.n_opens) AS BIGINT) AS mass FROM {p}bins s JOIN {p}bins b USING (cohort_id)
  JOIN (SELECT cohort_id, CAST(ceil(max(window_minutes) / 60.0) AS INTEGER) AS w FROM {p}prompts GROUP BY 1) USING (cohort_id)
  WHERE (b.hour_local - s.hour_local + 24) % 24 < w GROUP BY 1, 2),
{p}moment AS (SELECT cohort_id, hour_local AS cohort_hour_local FROM {p}mass QUALIFY row_number() OVER (PARTITION BY cohort_id ORDER BY mass DESC, hour_local) = 1),
{p}own AS (SELECT user_id, sum(n_opens) AS n, sum(n_opens * cos(theta)) AS vx, sum(n_opens * sin(theta)) AS vy FROM {p}feats GROUP BY 1),
{p}posterior AS (SELECT c.user_id, c.cohort_id, m.cohort_hour_local, coalesce(o.n, 0) AS n, coalesce(o.vx, 0) + 5 * b.rbar * cos(b.mu) AS px, coalesce(o.vy, 0) + 5 * b.rbar * sin(b.mu) AS py
  FROM {p}current c JOIN {p}bars b USING (cohort_id) JOIN {p}moment m USING (cohort_id) LEFT JOIN {p}own o USING (user_id)),
{p}centred AS (SELECT *, atan2(py, px) * 24 / (2 * pi()) - 24 * floor(atan2(py, px) / (2 * pi())) AS center, sqrt(px * px + py * py) / (n + 5) AS sure FROM {p}posterior),
{p}shifted AS (SELECT *, greatest(-2.0, least(2.0, (center - cohort_hour_local) - 24 * floor((center - cohort_hour_local + 12) / 24))) AS shift FROM {p}centred),
{p}scores AS (SELECT user_id, cohort_id, CAST(m // 60 AS INTEGER) AS send_hour_local, CAST(m % 60 AS INTEGER) AS send_minute_local, cohort_hour_local, round(center, 6) AS center_hour_local, round(sure, 6) AS confidence,
  'v1' AS model_version, (SELECT max(last_open_at) FROM {p}feats) AS computed_as_of FROM (SELECT *, (CAST(round((cohort_hour_local + shift) * 60) AS INTEGER) + 1440) % 1440 AS m FROM {p}shifted))"""


def _sql(select: str, more: str = "", base: str | None = None) -> str:
    parts = [ADAPTER.strip(), *([chain().strip()] if base is None else [base] if base else []), *([more] if more else [])]
    return "WITH " + ",\n".join(parts) + "\n" + select


NUM = "CAST(substr(user_id, 3) AS BIGINT)"
DIST = "abs(({a}) - ({b}) - 24 * floor((({a}) - ({b}) + 12) / 24))"
_names = "prompt_id, delivered_in_grace, min_upload_delay_seconds, " + ", ".join(att.FLAGS)
_truth = f"truth AS (SELECT user_id, {NUM} * 7 % 24 + CAST(0.5 AS DOUBLE) AS c, {NUM} % 5 + CAST(4 AS DOUBLE) AS w FROM current)"


def _arms_sql() -> str:
    d = DIST.format(a="h", b="c")
    return f"""{_truth},
arms AS (
  SELECT 'baseline' AS arm, user_id, prompt_date, hour(sent_at_local) + minute(sent_at_local) / CAST(60 AS DOUBLE) AS h FROM prompts
  UNION ALL SELECT 'cohort', p.user_id, prompt_date, CAST(cohort_hour_local AS DOUBLE) FROM prompts p JOIN scores USING (user_id)
  UNION ALL SELECT 'recommended', p.user_id, prompt_date, send_hour_local + send_minute_local / CAST(60 AS DOUBLE) FROM prompts p JOIN scores USING (user_id)),
drawn AS (SELECT arm, {d} AS d, w, {NUM} * 31 + day(prompt_date) AS z FROM arms JOIN truth USING (user_id) WHERE user_id IN (SELECT user_id FROM scores)),
told AS (SELECT arm, CASE WHEN (z * 7919 + 104729) % 10007 / CAST(10007 AS DOUBLE) < 0.08 THEN 'delivery_fault'
  WHEN (z * 7919 + 209458) % 10007 / CAST(10007 AS DOUBLE) < 0.03 THEN 'unattributed'
  WHEN (z * 7919 + 314187) % 10007 / CAST(10007 AS DOUBLE) >= CAST(0.9 AS DOUBLE) * exp(-greatest(CAST(0 AS DOUBLE), d - w / 2)) THEN 'timing_gap'
  WHEN (z * 7919 + 418916) % 10007 / CAST(10007 AS DOUBLE) < 0.1 THEN 'upload_fault' ELSE 'on_time' END AS k FROM drawn)"""


def _holdout_sql() -> str:
    d = DIST.format(a="s.h", b="o.h")
    return _sql(
        """SELECT arm, count(*) AS n_users, CAST(sum(n) AS BIGINT) AS n_opens, round(CAST(sum(hit) AS DOUBLE) / sum(n), 6) AS in_window_share, round(avg(nearest), 6) AS mean_nearest_hours
FROM (SELECT arm, user_id, count(*) AS n, sum(CAST(d <= 2 AS INTEGER)) AS hit, min(d) AS nearest FROM near GROUP BY 1, 2) GROUP BY arm""",
        f"""cut AS (SELECT * FROM raw WHERE CAST(server_upload_time AS DATE) <= DATE '{CUT}'), {chain("cut", "dim", "c_").strip()},
opens AS (SELECT user_id, hour(client_event_time_local) + minute(client_event_time_local) / CAST(60 AS DOUBLE) AS h FROM stg WHERE event_type = 'app_opened' AND CAST(server_upload_time AS DATE) > DATE '{CUT}'),
served AS (SELECT user_id, 'recommended' AS arm, send_hour_local + send_minute_local / CAST(60 AS DOUBLE) AS h FROM c_scores UNION ALL SELECT user_id, 'cohort', CAST(cohort_hour_local AS DOUBLE) FROM c_scores),
near AS (SELECT arm, user_id, {d} AS d FROM opens o JOIN served s USING (user_id))""",
    )


RATIOS = (
    ("ontime_rate", "label = 'on_time'", "delivered_in_grace"), ("response_rate", "label IN ('on_time', 'upload_fault')", "delivered_in_grace"),
    ("delivery_fault_share", "label = 'delivery_fault'", "true"), ("unattributed_share", "label = 'unattributed'", "delivered_in_grace"),
)
UPSERT_SQL = _sql(
        "SELECT * EXCLUDE (take) FROM (SELECT n.*, s.user_id IS NULL OR s.model_version = 'v1' AS take FROM new_rows n LEFT JOIN stored s USING (user_id)) WHERE take UNION ALL SELECT * FROM stored WHERE model_version = 'v10'",
        f"""new_rows AS (SELECT s.user_id, send_hour_local, send_minute_local, cohort_hour_local, c.tz, confidence, 'v2' AS model_version, computed_as_of, computed_as_of AS written_at FROM scores s JOIN current c USING (user_id)),
stored AS (SELECT * REPLACE (CASE WHEN {NUM} % 3 = 0 THEN 'v10' ELSE 'v1' END AS model_version, computed_as_of - INTERVAL 1 DAY AS computed_as_of, computed_as_of - INTERVAL 1 DAY AS written_at, CAST(0 AS INTEGER) AS send_hour_local) FROM new_rows WHERE {NUM} % 5 <> 0)""")  # fmt: skip

CATALOGUE: dict[str, tuple[Callable, str]] = {
    "q_dedupe_earliest": (dedupe_earliest, _sql("SELECT insert_id, event_type, server_upload_time FROM deduped")),
    "q_conflicting_duplicates": (conflicts, _sql(
        """SELECT insert_id, count(DISTINCT coalesce(json_extract_string(event_properties, '$.prompt_id'), '<null>') || coalesce(json_extract_string(event_properties, '$.cohort_id'), '<null>') || coalesce(json_extract_string(event_properties, '$.window_minutes'), '<null>')) AS n_payloads
FROM (SELECT * FROM raw UNION ALL SELECT * REPLACE ('{}' AS event_properties) FROM raw WHERE insert_id LIKE '%7') GROUP BY insert_id, client_event_time, server_received_time, server_upload_time
HAVING n_payloads > 1""", base="")),
    "q_scd2_asof_tz": (scd2_as_of, _sql("SELECT insert_id, user_id, tz, cohort_id FROM zoned")),
    "q_local_date_hour": (local_date_hour, _sql("SELECT insert_id, client_event_time_local, event_date, CAST(hour(client_event_time_local) AS INTEGER) AS hour_local FROM stg")),
    "q_json_extract": (json_fields, _sql("""SELECT json_extract_string(event_properties, '$.prompt_id') AS prompt_id, count(*) AS n, max(CAST(json_extract_string(event_properties, '$.window_minutes') AS INTEGER)) AS window_minutes,
count(json_extract_string(event_properties, '$.error_code')) AS n_errors FROM raw GROUP BY 1 HAVING prompt_id IS NOT NULL""", base="")),
    "q_upload_delay": (upload_delay, _sql("SELECT event_type, min(s) AS least, max(s) AS most, CAST(sum(s) AS BIGINT) AS total FROM (SELECT event_type, CAST(epoch(server_received_time) - epoch(client_event_time) AS BIGINT) AS s FROM raw) GROUP BY 1", base="")),
    "q_first_receipt": (first_receipt, _sql("SELECT prompt_id, prompt_date, delivered_insert_id, delivered_at FROM prompts")),
    "q_evidence_flags": (evidence_flags, _sql(f"SELECT {_names} FROM labelled")),
    "q_attribution": (attribution, _sql("SELECT prompt_id, user_id, prompt_cohort_id AS cohort_id, prompt_date, label FROM labelled")),
    "q_attribution_by_prompt": (attribution_by_prompt, _sql("SELECT prompt_id, user_id, prompt_cohort_id AS cohort_id, prompt_date, label, status FROM labelled")),
    "q_status_final": (status_final, _sql("SELECT prompt_date, status, count(*) AS n FROM labelled GROUP BY 1, 2")),
    "q_ontime_rate_daily": (ontime_rate_daily, _sql("SELECT * FROM daily")),
    "q_overall_rate": (overall_rate, _sql("SELECT CAST(sum(prompts_sent) AS BIGINT) AS prompts_sent, CAST(sum(prompts_delivered) AS BIGINT) AS prompts_delivered, CAST(sum(on_time) AS BIGINT) AS on_time, round(CAST(sum(on_time) AS DOUBLE) / nullif(sum(prompts_delivered), 0), 6) AS ontime_rate FROM daily")),
    "q_label_counts": (label_counts, _sql(f"SELECT k AS label, count(label) AS n FROM (VALUES {', '.join(f'({k!r})' for k in LABELS)}) v(k) LEFT JOIN labelled ON label = k GROUP BY k")),
    "q_retention": (retention, _sql(
        """SELECT a.user_id, a.anchor_date, h.observed_through, coalesce(w.d, 0) AS prompts_delivered, coalesce(w.o, 0) AS on_time, round(CAST(coalesce(w.o, 0) AS DOUBLE) / nullif(coalesce(w.d, 0), 0), 6) AS ontime_rate,
CASE WHEN date_diff('day', a.anchor_date, h.observed_through) < 28 THEN NULL ELSE coalesce(date_diff('day', a.anchor_date, l.last_open) >= 28, false) END AS retained
FROM anchors a CROSS JOIN (SELECT max(CAST(client_event_time_local AS DATE)) AS observed_through FROM stg) h
LEFT JOIN (SELECT p.user_id, CAST(sum(CAST(delivered_in_grace AS INTEGER)) AS BIGINT) AS d, CAST(sum(CAST(label = 'on_time' AS INTEGER)) AS BIGINT) AS o FROM labelled p JOIN anchors a USING (user_id) WHERE date_diff('day', a.anchor_date, p.prompt_date) < 28 GROUP BY 1) w USING (user_id)
LEFT JOIN (SELECT user_id, max(CAST(client_event_time_local AS DATE)) AS last_open FROM stg WHERE event_type = 'app_opened' GROUP BY 1) l USING (user_id)""",
        "anchors AS (SELECT user_id, min(prompt_date) AS anchor_date FROM labelled GROUP BY 1)")),
    "q_dim_current": (dim_current, _sql("SELECT user_id, cohort_id, tz FROM dim WHERE valid_to IS NULL", base="")),
    "q_features_user_hour": (features_user_hour, _sql("SELECT * FROM features")),
    "q_circular_vector": (circular_vector, _sql("SELECT cohort_id, n_opens, round(ux, 6) AS ux, round(uy, 6) AS uy, round(mu, 6) AS mu, round(rbar, 6) AS rbar FROM bars")),
    "q_cohort_window_mass": (cohort_window_mass, _sql("SELECT * FROM mass")),
    "q_cohort_moment": (cohort_moment, _sql("SELECT * FROM moment")),
    "q_scores_send_time": (scores_send_time, _sql("SELECT * FROM scores")),
    "q_send_schedule_upsert": (send_schedule_upsert, UPSERT_SQL),
    "q_send_schedule_buckets": (send_schedule_buckets, UPSERT_SQL),
    "q_lookback_partitions": (lookback_partitions, _sql("SELECT event_date, count(*) AS n_events, count(DISTINCT insert_id) AS n_ids FROM stg WHERE date_diff('day', event_date, (SELECT CAST(max(server_upload_time) AS DATE) FROM raw)) <= 5 GROUP BY 1")),
    "q_through_cut": (through_cut, _sql(f"SELECT CAST(server_upload_time AS DATE) AS upload_date, count(*) AS n_events FROM raw WHERE CAST(server_upload_time AS DATE) <= DATE '{CUT}' GROUP BY 1", base="")),
    "q_holdout": (holdout, _holdout_sql()),
    "q_simulate_counts": (simulate_counts, _sql(
        "SELECT arm, count(*) AS prompts_sent, " + ", ".join(f"count(*) FILTER (k = '{k}') AS {k}" for k in LABELS) + ", count(*) FILTER (k <> 'delivery_fault') AS prompts_delivered, round(CAST(count(*) FILTER (k = 'on_time') AS DOUBLE) / nullif(count(*) FILTER (k <> 'delivery_fault'), 0), 6) AS ontime_rate FROM told GROUP BY arm",
        _arms_sql())),
    "q_center_quality": (center_quality, _sql(
        f"SELECT round(avg(coalesce({DIST.format(a='s.center_hour_local', b='t.c')}, 12)), 5) AS center_mae, round(avg(CAST(coalesce({DIST.format(a='s.send_hour_local + s.send_minute_local / CAST(60 AS DOUBLE)', b='t.c')} <= t.w / 2, false) AS DOUBLE)), 6) AS coverage FROM truth t LEFT JOIN scores s USING (user_id)", _truth)),
    "q_label_accuracy": (label_accuracy, _sql("SELECT round(avg(CAST(label = CASE WHEN delivered_at IS NULL THEN 'delivery_fault' ELSE 'timing_gap' END AS DOUBLE)), 6) AS label_accuracy FROM labelled")),
    "q_checks_partition": (checks_partition, _sql("SELECT cohort_id, prompt_date FROM (SELECT * REPLACE (on_time + CASE WHEN day(prompt_date) % 7 = 0 THEN 1 ELSE 0 END AS on_time) FROM daily) WHERE on_time + upload_fault + timing_gap + unattributed <> prompts_delivered OR prompts_delivered + delivery_fault <> prompts_sent")),
    "q_checks_unique": (checks_unique, _sql(f"SELECT user_id, valid_from, count(*) AS n FROM (SELECT * FROM dim UNION ALL SELECT * FROM dim WHERE {NUM} % 4 = 0) GROUP BY 1, 2 HAVING n > 1", base="")),
    "q_checks_one_dim_row": (checks_one_dim_row, _sql("SELECT count(*) AS n_rows, count(DISTINCT insert_id) AS n_ids, count(tz) AS n_with_tz FROM t_stg HAVING n_rows <> n_ids OR n_with_tz <> n_rows", f"twice AS (SELECT * FROM dim UNION ALL SELECT * FROM dim WHERE {NUM} % 10 = 3), {chain('raw', 'twice', 't_').strip()}", base="")),
    "q_checks_share": (checks_share, _sql("SELECT round(x, 6) AS unattributed_share FROM (SELECT avg(CAST(label = 'unattributed' AS DOUBLE)) AS x FROM labelled) WHERE x > 0.10")),
    "q_checks_band": (checks_band, _sql(f"SELECT user_id FROM (SELECT user_id, {DIST.format(a=f'(send_hour_local + CASE WHEN {NUM} % 6 = 0 THEN 9 ELSE 0 END) % 24 + send_minute_local / CAST(60 AS DOUBLE)', b='cohort_hour_local')} AS d FROM scores) WHERE d > 2 + 1e-9")),
    "q_golden_diff": (golden_diff, _sql(
        "SELECT coalesce(a.cohort_id, b.cohort_id) AS cohort_id, coalesce(a.prompt_date, b.prompt_date) AS prompt_date, CASE WHEN b.cohort_id IS NULL THEN 'missing' WHEN a.cohort_id IS NULL THEN 'extra' ELSE 'changed' END AS difference FROM daily a FULL JOIN other b ON a.cohort_id = b.cohort_id AND a.prompt_date = b.prompt_date WHERE a.cohort_id IS NULL OR b.cohort_id IS NULL OR a.on_time <> b.on_time",
        "other AS (SELECT cohort_id, prompt_date, on_time + CASE WHEN cohort_id = 'c-1' AND day(prompt_date) % 5 = 0 THEN 1 ELSE 0 END AS on_time FROM daily WHERE NOT (cohort_id = 'c-0' AND day(prompt_date) % 2 = 0) UNION ALL SELECT 'c-9', prompt_date, on_time FROM daily WHERE cohort_id = 'c-2')")),
    "q_response_curve": (response_curve, _sql(
        f"SELECT user_id, round(d, 6) AS distance, round(CAST(0.9 AS DOUBLE) * exp(-greatest(CAST(0 AS DOUBLE), d - w / 2)) * least(CAST(1 AS DOUBLE), m / CAST(60 AS DOUBLE)), 6) AS probability FROM (SELECT user_id, {DIST.format(a='CAST(n % 24 AS DOUBLE)', b='CAST(n * 7 % 24 AS DOUBLE)')} AS d, CAST(n % 5 AS DOUBLE) AS w, CAST(n % 90 AS DOUBLE) AS m FROM (SELECT user_id, {NUM} AS n FROM dim WHERE valid_to IS NULL))", base="")),
    "q_checks_cohort_day": (checks_cohort_day, _sql("SELECT cohort_id, prompt_date FROM (SELECT * FROM daily UNION ALL SELECT * FROM daily WHERE day(prompt_date) % 6 = 0) GROUP BY 1, 2 HAVING count(*) > 1")),
    "q_checks_error_code": (checks_error_code, _sql(
        """SELECT insert_id, event_type, error_code FROM (SELECT *, CASE WHEN CAST(substr(insert_id, 3) AS BIGINT) % 3 = 0 AND event_type IN ('upload_failed', 'upload_completed') THEN 'E1' END AS error_code FROM stg)
WHERE (event_type = 'upload_failed' AND error_code IS NULL) OR (event_type IN ('upload_started', 'upload_completed') AND error_code IS NOT NULL)""")),
    "q_checks_one_label": (checks_one_label, _sql("SELECT * FROM (SELECT (SELECT count(*) FROM prompts) AS prompts, (SELECT count(*) FROM labelled WHERE prompt_id NOT LIKE '%1') AS labelled, (SELECT count(*) FROM labelled WHERE prompt_id NOT LIKE '%1' AND label IS NULL) AS unlabelled) WHERE prompts <> labelled OR unlabelled <> 0")),
    "q_checks_prompt_cohort": (checks_prompt_cohort, _sql(f"SELECT prompt_id, cohort_id, c AS prompt_cohort_id FROM (SELECT *, CASE WHEN {NUM} % 4 = 0 THEN 'c-9' WHEN {NUM} % 7 <> 0 THEN prompt_cohort_id END AS c FROM prompts) WHERE c IS NULL OR c <> cohort_id")),
    "q_checks_columns": (checks_columns, _sql(
        """SELECT 'not_null' AS test, 'prompt_id' AS of, count(*) AS n FROM stg WHERE prompt_id IS NULL HAVING n > 0 UNION ALL SELECT 'not_null', 'window_minutes', count(*) AS n FROM stg WHERE window_minutes IS NULL HAVING n > 0
UNION ALL SELECT 'not_null', 'insert_id', count(*) AS n FROM stg WHERE insert_id IS NULL HAVING n > 0
UNION ALL SELECT 'accepted', event_type, count(*) FROM stg WHERE event_type NOT IN ('app_opened', 'prompt_sent', 'prompt_delivered') GROUP BY event_type
UNION ALL SELECT 'unique', user_id, count(*) AS n FROM stg WHERE event_type = 'prompt_sent' GROUP BY user_id HAVING n > 1""")),
    "q_checks_freshness": (checks_freshness, _sql(f"SELECT last_upload FROM (SELECT max(server_upload_time) AS last_upload FROM raw) WHERE last_upload IS NULL OR last_upload < TIMESTAMP '{NOW}' - INTERVAL 36 HOURS", base="")),
    # 1.959964 and 0.841621 are the normal quantiles of 0.975 and 0.8
    "q_power_table": (power_table, _sql(
        """SELECT cohort_id, users, round(p, 6) AS ontime_rate, effect, n_per_arm, CAST(ceil(n_per_arm / nullif((users // 2) * share, 0)) AS BIGINT) AS days FROM (
SELECT *, CAST(ceil(power(1.959963984540054::DOUBLE + 0.8416212335729143::DOUBLE, 2) * (p * (1 - p) + (p + effect) * (1 - p - effect)) / power(effect, 2)) AS BIGINT) AS n_per_arm
FROM (SELECT prompt_cohort_id AS cohort_id, count(DISTINCT user_id) AS users, CAST(sum(CAST(label = 'on_time' AS INTEGER)) AS DOUBLE) / nullif(sum(CAST(delivered_in_grace AS INTEGER)), 0) AS p,
  CAST(sum(CAST(delivered_in_grace AS INTEGER)) AS DOUBLE) / count(*) AS share FROM labelled GROUP BY 1),
(SELECT unnest([0.01::DOUBLE, 0.02::DOUBLE, 0.05::DOUBLE]) AS effect))""")),
    "q_experiment_readout": (experiment_readout, _sql(
        """SELECT metric, CAST(max(users) FILTER (arm = 'treatment') AS BIGINT) AS treatment_users, CAST(max(users) FILTER (arm = 'control') AS BIGINT) AS control_users,
round(max(r) FILTER (arm = 'treatment'), 6) AS treatment_rate, round(max(r) FILTER (arm = 'control'), 6) AS control_rate,
round(max(r) FILTER (arm = 'treatment') - max(r) FILTER (arm = 'control'), 6) AS difference, round(sqrt(sum(v)), 6) AS std_error
FROM (SELECT metric, arm, users, r, CAST(users AS DOUBLE) / (users - 1) * (xx - 2 * r * xn + r * r * nn) / (sn * sn) AS v FROM
  (SELECT metric, arm, count(*) AS users, sum(x) / sum(n) AS r, sum(n) AS sn, sum(x * x) AS xx, sum(x * n) AS xn, sum(n * n) AS nn FROM per_user GROUP BY metric, arm)) GROUP BY metric""",
        f"""per_user AS (SELECT metric, user_id, CASE WHEN {NUM} % 2 = 0 THEN 'treatment' ELSE 'control' END AS arm, CAST(count(*) FILTER (a AND b) AS DOUBLE) AS x, CAST(count(*) FILTER (b) AS DOUBLE) AS n FROM ("""
        + " UNION ALL ".join(f"SELECT '{m}' AS metric, user_id, {a} AS a, {b} AS b FROM labelled" for m, a, b in RATIOS)
        + f""") WHERE {NUM} % 19 <> 0 GROUP BY metric, user_id)""")),
    "q_content_hash": (content_hashes, _sql("SELECT count(*) AS n_rows, true AS same FROM daily")),
    "q_landed_files": (landed_files, _sql(
        f"SELECT CAST(server_upload_time AS DATE) AS upload_date, count(*) AS n_events, count(DISTINCT insert_id) AS n_ids, count(json_extract_string(event_properties, '$.prompt_id')) AS n_with_prompt, CAST(sum(epoch(server_upload_time) - epoch(client_event_time)) AS BIGINT) AS delay_seconds FROM raw WHERE CAST(server_upload_time AS DATE) <= DATE '{CUT}' GROUP BY 1", base="")),
    "q_landing_rejects": (landing_rejects, _sql(
        """SELECT CASE WHEN n % 11 = 0 THEN 'missing:insert_id' WHEN n % 13 = 0 THEN 'unknown_field:source' WHEN n % 17 = 0 THEN 'unknown_property:attempt_no' WHEN n % 19 = 0 THEN 'not_json'
WHEN n % 23 = 0 THEN 'bad_time:server_received_time' WHEN n % 29 = 0 THEN 'unknown_type' ELSE 'accepted' END AS reason, count(*) AS n FROM (SELECT CAST(substr(insert_id, 3) AS BIGINT) AS n FROM raw) GROUP BY 1""", base="")),
    "q_checks_observed": (checks_observed, _sql(
        """SELECT 'raw_not_null' AS check_name, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'raw_event_type', count(*) FROM odd_raw WHERE event_type = 'unheard_of'
UNION ALL SELECT 'no_conflicting_duplicates', count(*) FROM (SELECT 1 FROM odd_raw GROUP BY insert_id, client_event_time, server_received_time, server_upload_time HAVING count(DISTINCT event_properties) > 1)
UNION ALL SELECT 'one_dim_row_per_event', (SELECT count(*) + count(*) FILTER (tz IS NULL) FROM t_stg) - (SELECT count(*) FROM t_deduped)
UNION ALL SELECT 'stg_not_null', 0 UNION ALL SELECT 'error_code_only_on_failure', count(*) FROM t_stg WHERE event_type = 'upload_failed'
UNION ALL SELECT 'prompt_cohort_matches_dim', count(*) FROM t_prompts WHERE prompt_cohort_id IS NULL OR prompt_cohort_id <> cohort_id
UNION ALL SELECT 'prompt_unique', count(*) - count(DISTINCT prompt_id) FROM t_prompts UNION ALL SELECT 'one_label_per_prompt', 0 UNION ALL SELECT 'label_accepted', 0 UNION ALL SELECT 'status_accepted', 0
UNION ALL SELECT 'cohort_day_partition', 0 UNION ALL SELECT 'unattributed_share', CASE WHEN count(*) FILTER (label = 'unattributed') > 0.1 * count(*) THEN count(*) FILTER (label = 'unattributed') ELSE 0 END FROM t_labelled
UNION ALL SELECT 'send_time_in_band', 0""",
        f"""odd AS (SELECT * REPLACE (CASE WHEN CAST(substr(insert_id, 3) AS BIGINT) % 31 = 0 THEN 'unheard_of' ELSE event_type END AS event_type) FROM raw),
late AS (SELECT * REPLACE (server_upload_time + INTERVAL 1 DAY AS server_upload_time) FROM odd WHERE insert_id LIKE '%7'),
odd_raw AS (SELECT * FROM odd UNION ALL SELECT * FROM late UNION ALL SELECT * REPLACE ('{{}}' AS event_properties) FROM late),
odd_dim AS (SELECT * REPLACE (CASE WHEN {NUM} % 7 = 0 THEN 'c-9' ELSE cohort_id END AS cohort_id) FROM dim UNION ALL SELECT * FROM dim WHERE {NUM} % 10 = 3),
{chain('odd_raw', 'odd_dim', 't_').strip()}""", base="")),
    "q_manifest_drift": (manifest_drift, _sql(
        """SELECT CAST(d AS VARCHAR) AS day, CASE WHEN day(d) % 7 = 0 THEN 'missing' ELSE 'changed' END AS drift FROM (SELECT DISTINCT CAST(server_upload_time AS DATE) AS d FROM raw) WHERE day(d) % 7 = 0 OR day(d) % 5 = 0
UNION ALL SELECT '2030-01-01', 'extra'""", base="")),
    "q_dim_file": (dim_file, _sql("SELECT user_id, tz, cohort_id, valid_from, valid_to FROM dim", base="")),
    "q_incremental_tables": (incremental_tables, _sql("SELECT prompt_date, label, status, count(*) AS n FROM labelled GROUP BY 1, 2, 3")),
    "q_local_days": (local_round_trip, _sql("SELECT CAST((client_event_time AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Tokyo' AS DATE) AS day, count(*) AS n FROM (SELECT DISTINCT insert_id, client_event_time FROM raw) GROUP BY 1", base="")),
}


#: Queries that return dates: these leave as text on both sides, so that no client's date type matters.
DATES = {
    "q_local_date_hour": ["event_date"],
    "q_first_receipt": ["prompt_date"],
    "q_attribution": ["prompt_date"],
    "q_attribution_by_prompt": ["prompt_date"],
    "q_status_final": ["prompt_date"],
    "q_ontime_rate_daily": ["prompt_date"],
    "q_retention": ["anchor_date", "observed_through"],
    "q_lookback_partitions": ["event_date"],
    "q_through_cut": ["upload_date"],
    "q_checks_partition": ["prompt_date"],
    "q_golden_diff": ["prompt_date"],
    "q_local_days": ["day"],
    "q_checks_cohort_day": ["prompt_date"],
    "q_landed_files": ["upload_date"],
    "q_incremental_tables": ["prompt_date"],
}


def _dated(name: str, query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: query(spark, d).withColumns({c: F.col(c).cast("string") for c in DATES[name]})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _dated(name, q) if name in DATES else q for name, (q, _) in CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    text = lambda cs: ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cs)
    return {name: f"SELECT * REPLACE ({text(DATES[name])}) FROM ({sql})" if name in DATES else sql for name, (_, sql) in CATALOGUE.items()}
