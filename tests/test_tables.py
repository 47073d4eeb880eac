"""Landing, incremental refresh, write-back, checks, evaluation, streaming and the query catalogue."""

import gzip
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tidemark.operators import checks, serving
from tidemark.params import Params
from tidemark.plans import catalogue, evaluate, experiment, pipeline
from tidemark.sources import export, generator, landing, star_adapter
from tidemark.sources.schemas import EVENTS, SEND_SCHEDULE
from tidemark.streaming import micro_batch

SMALL = "/root/testdata/sf0.001"
T0 = datetime(2024, 5, 1, 12)


def raw_row(i, day=0, props="{}", upload=0):
    t = T0 + timedelta(days=day)
    return (i, "app_opened", "u1", "d1", t, t, t + timedelta(seconds=upload), props)


@pytest.fixture(scope="module")
def adapted(spark):
    e = spark.read.parquet(f"{SMALL}/events.parquet")
    return star_adapter.raw_events(e).cache(), star_adapter.dim_user(e).cache()


def rows(df):
    return sorted(map(str, df.collect()))


def test_read_files(spark, tmp_path):
    rec = {"insert_id": "a", "event_type": "app_opened", "user_id": "u", "device_id": "d", "client_event_time": "2024-05-01 12:00:00.123456", "server_received_time": "2024-05-01 12:00:01.000000", "server_upload_time": "2024-05-01 12:00:02.000000", "event_properties": {"k": None}}
    with gzip.open(tmp_path / "events_2024-05-01_03.jsonl.gz", "wt") as f:
        f.write(json.dumps(rec) + "\n")
    r = landing.read_events(spark, [str(tmp_path / "events_2024-05-01_03.jsonl.gz")]).first()
    assert r["client_event_time"].microsecond == 123456 and json.loads(r["event_properties"]) == {"k": None}
    assert landing.read_events(spark, []).count() == 0
    head = "user_id,tz,cohort_id,signup_date,valid_from,valid_to\n"
    (tmp_path / "dim.csv").write_text(head + "u,UTC,c,2024-01-01,2024-01-01 00:00:00.000000,\n")
    assert landing.read_dim_user(spark, str(tmp_path / "dim.csv")).first()["valid_to"] is None
    (tmp_path / "bad.csv").write_text(head + "u,,c,2024-01-01,2024-01-01 00:00:00.000000,\n")
    with pytest.raises(Exception, match="tz is empty"):
        landing.read_dim_user(spark, str(tmp_path / "bad.csv")).collect()


def test_file_selection():
    names = ["x/events_2024-05-02_00.jsonl.gz", "events_2024-05-01.jsonl", "events_2024-05-03_1.jsonl.gz"]
    assert landing.select_files(names, "2024-05-02") == ["events_2024-05-01.jsonl", "x/events_2024-05-02_00.jsonl.gz"]
    with pytest.raises(ValueError):
        landing.select_files(["events_May.jsonl"])


def test_land_replaces_days_and_refuses_conflicts(spark, tmp_path):
    path = f"{tmp_path}/raw"
    first = spark.createDataFrame([raw_row("a"), raw_row("b", 1)], EVENTS)
    assert landing.land(spark, first, path).count() == 2
    assert landing.land(spark, first, path).count() == 2
    landing.land(spark, spark.createDataFrame([raw_row("c", 1), raw_row("d", 1)], EVENTS), path)
    assert sorted(r["insert_id"] for r in spark.read.parquet(path).collect()) == ["a", "c", "d"]
    clash = spark.createDataFrame([raw_row("e", 2), raw_row("e", 2, '{"prompt_id":"p"}')], EVENTS)
    with pytest.raises(landing.ConflictingDuplicates):
        landing.land(spark, clash, path)
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(PermissionError):
        landing.drop(spark, path)
    landing.drop(spark, path, confirm=True)


def test_manifest(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a").write_text("x")
    text = "\n".join(f"{v}  {k}" for k, v in landing.manifest(str(tmp_path)).items())
    landing.check_manifest(str(tmp_path), text + "\nffff  truth/other")
    (tmp_path / "raw/b").write_text("y")
    with pytest.raises(landing.ManifestDrift, match="raw/b"):
        landing.check_manifest(str(tmp_path), text)


def test_two_landings_equal_one(spark, tmp_path, adapted):
    raw, dim = adapted
    raw = landing.with_upload_date(raw)
    one = pipeline.refresh(spark, raw, dim, f"{tmp_path}/one")
    for cut in ("2024-01-28", "2024-01-29", "2024-01-30", "2024-01-31"):  # a day at a time, so every date is met when it turns final
        two = pipeline.refresh(spark, raw.filter(F.col("upload_date") <= F.lit(cut).cast("date")), dim, f"{tmp_path}/two")
    two = pipeline.refresh(spark, raw, dim, f"{tmp_path}/two")
    assert rows(one.attribution) == rows(two.attribution)
    assert rows(one.scores_send_time) == rows(two.scores_send_time)
    before = rows(two.attribution)
    assert rows(pipeline.refresh(spark, raw, dim, f"{tmp_path}/two").attribution) == before


def test_closed_partitions_are_left_alone(spark, tmp_path, adapted):
    raw, dim = landing.with_upload_date(adapted[0]), adapted[1]
    t = pipeline.refresh(spark, raw, dim, f"{tmp_path}/t")
    planted = t.attribution.filter("prompt_date = DATE'2024-01-03'").limit(1).withColumn("prompt_id", F.lit("planted"))
    planted.write.mode("append").partitionBy("prompt_date").parquet(f"{tmp_path}/t/attribution")
    again = pipeline.refresh(spark, raw, dim, f"{tmp_path}/t").attribution
    assert again.filter("prompt_id = 'planted'").count() == 1
    full = pipeline.refresh(spark, raw, dim, f"{tmp_path}/t", full=True).attribution
    assert full.filter("prompt_id = 'planted'").count() == 0


def schedule_row(user, hour, version, day):
    t = T0 + timedelta(days=day)
    return (user, hour, 0, 9, "UTC", 0.5, version, t, t)


def test_upsert_is_strict_and_numeric(spark, tmp_path):
    make = lambda rs: spark.createDataFrame(rs, SEND_SCHEDULE)
    served = serving.Schedule(spark, f"{tmp_path}/served")
    assert served.write_back(make([schedule_row("a", 1, "v2", 0), schedule_row("b", 1, "v10", 0), schedule_row("c", 1, "v1", 0)])) == (3, 3)
    assert served.write_back(make([schedule_row("a", 2, "v10", 0), schedule_row("b", 2, "v2", 5), schedule_row("c", 2, "v1", 0), schedule_row("d", 2, "v1", 0)])) == (4, 2)
    assert {r["user_id"]: r["send_hour_local"] for r in served.read().collect()} == {"a": 2, "b": 1, "c": 1, "d": 2}
    assert served.write_back(make([schedule_row("c", 3, "v1", 1)])) == (1, 1)
    before = rows(served.read())
    for bad in ("1", "vx", None):
        with pytest.raises(ValueError, match="v<int>"):
            served.write_back(make([]).unionByName(spark.createDataFrame([schedule_row("z", 3, "v1", 1)], SEND_SCHEDULE).withColumn("model_version", F.lit(bad).cast("string"))))
    with pytest.raises(TypeError):
        served.write_back(make([schedule_row("c", 3, "v3", 1)]).withColumn("confidence", F.lit("x")))
    served.fs.createNewFile(served.at("lock"))
    with pytest.raises(RuntimeError):
        served.write_back(make([]))
    assert rows(served.read()) == before
    planned = served.read()  # a reader of the snapshot before the next one is not cut off
    crashed = serving.Schedule(spark, served.path, lock_hours=0)  # its lock is old enough to be taken
    assert crashed.write_back(make([schedule_row("c", 4, "v1", 2)])) == (1, 1)
    assert rows(planned) == before != rows(served.read())
    served.write_back(make([schedule_row("c", 5, "v1", 3)]))
    assert sum(n.startswith("current-") for n in served._names()) == 2


def test_run_serves_once(spark, tmp_path, adapted):
    raw, dim = adapted
    failed = F.regexp_replace("event_properties", "}$", ',"error_code":"E1"}')
    raw = raw.withColumn("event_properties", F.when(F.col("event_type") == "upload_failed", failed).otherwise(F.col("event_properties")))
    with pytest.raises(checks.ChecksFailed, match="unattributed_share"):
        pipeline.run(spark, raw, dim, f"{tmp_path}/r")
    loose = Params(unattributed_max=0.5)
    _, (n, won) = pipeline.run(spark, raw, dim, f"{tmp_path}/r", loose)
    assert n == won == 15
    assert pipeline.run(spark, raw, dim, f"{tmp_path}/r", loose)[1] == (15, 0)


def test_checks_find_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int")
    assert checks.duplicate_keys(df, "k").count() == 1 and checks.null_values(df, "k", "v").collect()[0]["n"] == 1
    assert checks.unaccepted(df, "k", ("b",)).count() == 1
    stg = spark.createDataFrame([("1", "upload_failed", None), ("2", "upload_started", "E"), ("3", "upload_failed", "E")], "insert_id string, event_type string, error_code string")
    assert sorted(r["insert_id"] for r in checks.error_code_only_on_failure(stg).collect()) == ["1", "2"]
    p = spark.createDataFrame([("p1", "a", "b"), ("p2", "a", "a"), ("p3", "a", None)], "prompt_id string, cohort_id string, prompt_cohort_id string")
    assert checks.prompt_cohort_matches_dim(p).count() == 2
    one = spark.createDataFrame([("p1", "on_time")], "prompt_id string, label string")
    assert checks.one_label_per_prompt(p, one).count() == 1
    raw = spark.createDataFrame([raw_row("a")], EVENTS)
    assert checks.stale(raw, T0 + timedelta(hours=5), 4).count() == 1 and checks.stale(raw, T0, 4).count() == 0


def test_evaluation(spark):
    truth = spark.createDataFrame([("p1", "on_time"), ("p2", "on_time"), ("p3", "timing_gap")], "prompt_id string, cause string")
    got = spark.createDataFrame([("p1", "on_time"), ("p2", "timing_gap")], "prompt_id string, label string")
    assert evaluate.label_accuracy(truth, got).first()[0] == pytest.approx(1 / 3)
    users = spark.createDataFrame([("a", 23.0, 2.0), ("b", 5.0, 2.0)], "user_id string, reachable_center_local_hour double, reachable_width_hours double")
    scored = spark.createDataFrame([("a", 1.0, 0, 0, 1)], "user_id string, center_hour_local double, send_hour_local int, send_minute_local int, cohort_hour_local int")
    q = evaluate.center_quality(users, scored).first()
    assert (q["center_mae"], q["coverage"]) == (7.0, 0.5)
    assert [evaluate.sample_size(0.609756, d / 100) for d in (1, 2, 5)] == [37174, 9245, 1452]
    assert [evaluate.sample_size(0.461143, d / 100) for d in (1, 2, 5)] == [39061, 9775, 1565]
    assert evaluate.days_to_power(1000, 100, 0.8) == 13
    made = spark.range(100).select(F.concat(F.lit("u"), F.col("id") % 20).alias("user_id"), F.when(F.col("id") < 30, "on_time").otherwise("timing_gap").alias("label"), (F.col("id") < 80).alias("delivered_in_grace"), F.lit("c").alias("c"))
    made = made.unionByName(spark.range(1).select(F.lit("u").alias("user_id"), F.lit("delivery_fault").alias("label"), F.lit(False).alias("delivered_in_grace"), F.lit("none").alias("c")))
    got = {(r["c"], r["effect"]): (r["users"], r["n_per_arm"], r["days"]) for r in evaluate.power_table(made, "c").collect()}
    for e in evaluate.EFFECTS:
        n = evaluate.sample_size(30 / 80, e)
        assert got["c", e] == (20, n, evaluate.days_to_power(n, 10, 0.8)) and got["none", e] == (1, None, None)
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, None), (4, "z")], "k int, v string")
    assert {r["k"]: r["difference"] for r in evaluate.table_diff(a, b, "k").collect()} == {1: "changed", 3: "missing", 4: "extra"}
    assert evaluate.content_hash(a).collect() == evaluate.content_hash(a.repartition(3)).collect() != evaluate.content_hash(b).collect()
    with pytest.raises(RuntimeError):
        evaluate.require_rows(a.limit(0), "holdout")
    opens = spark.createDataFrame([("zz", "app_opened", T0, T0)], "user_id string, event_type string, server_upload_time timestamp_ntz, client_event_time_local timestamp_ntz")
    with pytest.raises(Exception, match="no user has both"):
        evaluate.holdout(scored, opens, "2024-04-01").collect()
    with pytest.raises(ValueError, match="too many"):
        evaluate.seeded_uniforms(spark.range(evaluate.MOST_SEEDED + 1).select(F.col("id").alias("prompt_id")), 1)


def test_simulation_prefers_the_reachable_hour(spark):
    users = spark.createDataFrame([("a", 8.0, 2.0)], "user_id string, reachable_center_local_hour double, reachable_width_hours double")
    scored = spark.createDataFrame([("a", 8, 0, 20)], "user_id string, send_hour_local int, send_minute_local int, cohort_hour_local int")
    prompts = spark.range(400).select(F.concat(F.lit("p"), "id").alias("prompt_id"), F.lit("a").alias("user_id"), F.lit(14.0).alias("local_send_hour"))
    rates = {"delivery_fault_rate": 0.1, "clock_skew_rate": 0.05, "upload_fault_rate": 0.1}
    for drawn in (evaluate.seeded_uniforms(prompts, 7), evaluate.hashed_uniforms(prompts, 7)):
        got = {r["arm"]: r for r in evaluate.simulate(drawn, users, scored, rates, 60).collect()}
        assert got["recommended"]["ontime_rate"] > 0.6 > 0.05 > got["cohort"]["ontime_rate"]
        assert len({r["delivery_fault"] for r in got.values()}) == 1 and got["baseline"]["prompts_sent"] == 400


def test_stream_equals_batch(spark, tmp_path, adapted):
    raw, dim = adapted
    for i, day in enumerate(("2024-01-27", "2024-01-31", "2024-02-28")):
        low = ("2023-01-01", "2024-01-27", "2024-01-31")[i]
        part = raw.filter((F.to_date("server_upload_time") > F.lit(low).cast("date")) & (F.to_date("server_upload_time") <= F.lit(day).cast("date")))
        part.coalesce(1).write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(f"{tmp_path}/in")
        micro_batch.start(micro_batch.read_stream(spark, f"{tmp_path}/in"), dim, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    batch = pipeline.build(raw, dim)
    names = [c for c in batch.attribution.columns if c != "status"]  # the batches are days apart, inside the lookback: dates between them are not stamped again
    assert rows(spark.read.parquet(f"{tmp_path}/out/attribution").select(*names)) == rows(batch.attribution.select(*names))


def test_catalogue_against_duckdb(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SMALL}/events.parquet'")
    new = ("q_checks_cohort_day", "q_checks_error_code", "q_checks_one_label", "q_checks_prompt_cohort", "q_checks_columns", "q_checks_freshness", "q_content_hash", "q_landed_files", "q_dim_file", "q_incremental_tables", "q_send_schedule_buckets", "q_landing_rejects", "q_checks_observed", "q_experiment_readout", "q_attribution_by_prompt", "q_manifest_drift")
    for name in ("q_ontime_rate_daily", "q_scores_send_time", "q_retention", "q_send_schedule_upsert", "q_holdout", "q_dedupe_earliest", *new):
        df = catalogue.queries()[name](spark, SMALL)
        names = sorted(df.columns)
        found = con.execute(f"SELECT {', '.join(names)} FROM ({catalogue.oracle_sql()[name]})").fetchall()
        assert sorted(map(str, map(tuple, df.select(*names).collect()))) == sorted(map(str, found)), name
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


def test_incremental_plans_prune_partitions(spark, tmp_path, adapted):
    """Every scan of an incremental model has a bound on its date, and the horizon of raw reads the partition column alone."""
    raw, dim = adapted
    landing.land(spark, raw, f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    t = pipeline.refresh(spark, raw, dim, f"{tmp_path}/t")
    from tidemark.operators import attribution as att
    from tidemark.operators import staging

    dim.unpersist()
    for df, bounded in ((staging.stg_events(raw, dim, incremental=True), "upload_date"), (staging.stg_prompts(t.stg_events, incremental=True), "event_date"), (att.attribution(t.stg_prompts, t.stg_events, incremental=True), "_date")):
        scans = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line and str(tmp_path) in line]
        assert scans and all(f"{bounded}" in s.split("PartitionFilters: [")[1].split("]")[0] and ">= " in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans), scans
        assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()
    days = spark.read.parquet(f"{tmp_path}/raw").agg(F.max("upload_date"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in days and staging.last_upload(raw) is not None


def test_backfill_is_the_union_and_a_second_run_changes_nothing(spark, tmp_path, adapted):
    raw, dim = adapted
    for low, high in (("2023-01-01", "2024-01-12"), ("2024-01-12", "2024-01-22"), ("2024-01-22", "2025-01-01")):
        part = raw.filter((F.to_date("server_upload_time") > F.lit(low).cast("date")) & (F.to_date("server_upload_time") <= F.lit(high).cast("date")))
        landed = landing.land(spark, part, f"{tmp_path}/raw")
        pipeline.refresh(spark, landed, dim, f"{tmp_path}/parts", full=True)
    one = pipeline.build(raw, dim)
    read = lambda name: spark.read.parquet(f"{tmp_path}/parts/{name}")
    assert rows(landed.drop("upload_date")) == rows(raw.select(*EVENTS.names))
    assert rows(read("attribution").select(*one.attribution.columns)) == rows(one.attribution)
    before = rows(read("attribution"))
    landing.land(spark, part, f"{tmp_path}/raw")
    pipeline.refresh(spark, spark.read.parquet(f"{tmp_path}/raw"), dim, f"{tmp_path}/parts")
    assert rows(read("attribution")) == before
    one.unpersist()


def test_a_session_in_another_zone_builds_the_same(spark, adapted):
    raw, dim = adapted
    t = pipeline.build(raw, dim, level=None)
    utc = rows(t.attribution), rows(t.scores_send_time)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # its clocks change inside the data's months
        t = pipeline.build(raw, dim, level=None)
        assert (rows(t.attribution), rows(t.scores_send_time)) == utc
        march = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 01:30:00' AS a, TIMESTAMP_NTZ'2024-03-10 03:30:00' AS b")
        from tidemark.functions.columns import seconds_between

        assert march.select(seconds_between("a", "b")).first()[0] == 7200
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def profile(**more):
    knobs = dict(seed=5, users=60, days=8, shards=3, tz_mix={"America/New_York": 0.5, "Asia/Tokyo": 0.5}, tz_change_rate=0.2, cohorts={"c-a": 8, "c-b": 20}, window_minutes=60, upload_fault_rate=0.15, delivery_fault_rate=0.1)
    knobs |= dict(reachable_width_hours=6, duplicate_rate=0.1, late_arrival_rate=0.1, late_arrival_max_hours=48, clock_skew_rate=0.05, clock_skew_min=30, organic_opens_per_day=1.5)
    return generator.Profile(**(knobs | more))


def test_generator_knobs(spark):
    g = generator.Generator(spark, profile())
    assert g.events.schema == EVENTS or [f.name for f in g.events.schema] == EVENTS.names
    t = pipeline.build(g.events, g.dim_user)
    assert evaluate.label_accuracy(g.truth_prompts, t.attribution).first()[0] == 1.0  # the cause is what attribution finds
    assert t.attribution.count() == 480 and g.dim_user.count() > 60
    for name, failed in checks.all_checks(g.events, g.dim_user, t.stg_events, t.stg_prompts, t.attribution, t.ontime_rate_daily, t.scores_send_time, Params(unattributed_max=0.2)).items():
        assert failed.isEmpty(), name
    t.unpersist()
    assert rows(generator.Generator(spark, profile(shards=1)).events) == rows(g.events)  # shards are partitions, no more
    assert rows(generator.Generator(spark, profile(seed=6)).events) != rows(g.events)
    plain = generator.Generator(spark, profile(duplicate_rate=0, late_arrival_rate=0, clock_skew_rate=0, delivery_fault_rate=1, organic_opens_per_day=0, tz_change_rate=0)).events
    assert plain.count() == 480 == plain.filter("event_type = 'prompt_sent'").count()
    assert g.events.count() > g.events.select("insert_id").distinct().count()
    with pytest.raises(ValueError):
        profile(clock_skew_min=5)
    with pytest.raises(TypeError):
        generator.Profile.read('{"seed": 1}')


def test_generated_files_round_trip(spark, tmp_path):
    g = generator.Generator(spark, profile(users=10))
    files = export.write_events(g.events, f"{tmp_path}/raw")
    back = landing.read_events(spark, landing.select_files(files))
    assert rows(back) == rows(g.events)
    export.write_dim(g.dim_user, f"{tmp_path}/dim")
    assert rows(landing.read_dim_user(spark, f"{tmp_path}/dim")) == rows(g.dim_user)
    export.write_truth(g.truth_users, f"{tmp_path}/truth")
    assert spark.read.json(f"{tmp_path}/truth").count() == 10
    t = pipeline.build(back, g.dim_user, level=None)
    text = export.canonical(t.attribution, "prompt_id", "user_id", "cohort_id", "label")
    assert text.splitlines()[0] == "prompt_id,user_id,cohort_id,label" and len(export.read_canonical(text, "prompt_id", "user_id", "cohort_id", "label")) == 80
    assert export.canonical(t.attribution.repartition(7), "prompt_id", "user_id", "cohort_id", "label") == text
    with pytest.raises(ValueError):
        export.read_canonical(text, "x")
    assert export.replaced_block("a <!-- t --> old <!-- /t --> b", "t", "new") == "a <!-- t -->\nnew\n<!-- /t --> b"
    with pytest.raises(ValueError):
        export.replaced_block("a", "t", "new")


def test_experiment_arms(spark):
    users = spark.range(20_000).select(F.format_string("u-%06d", "id").alias("user_id"), F.lit(T0.date()).alias("prompt_date"))
    arms = experiment.jittered(experiment.assigned(users, "s"), "s")
    n = {r["arm"]: r["count"] for r in arms.groupBy("arm").count().collect()}
    assert abs(n["treatment"] - 9500) < 300 and abs(n["control"] - 9500) < 300 and abs(n["holdout"] - 1000) < 150
    moved = arms.filter("jitter_min <> 0")
    assert moved.filter("arm <> 'treatment' OR abs(jitter_min) > 15").isEmpty() and 700 < moved.count() < 1100
    with pytest.raises(ValueError):
        experiment.assigned(users, "s", {"treatment": 1})
