"""Staged publication with observed checks, the served table in buckets, and strict landing."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tidemark.operators import checks, serving
from tidemark.operators.metrics import Watch
from tidemark.params import Params
from tidemark.plans import pipeline
from tidemark.plans.staged import Staged
from tidemark.sources import generator, landing
from tidemark.sources.schemas import EVENTS, SEND_SCHEDULE

T0 = datetime(2024, 5, 1, 12)
LOOSE = Params(unattributed_max=0.2)


@pytest.fixture(scope="module")
def made(spark):
    knobs = dict(seed=5, users=15, days=8, shards=2, tz_mix={"America/New_York": 0.5, "Asia/Tokyo": 0.5}, tz_change_rate=0.2, cohorts={"c-a": 8, "c-b": 20}, window_minutes=60, upload_fault_rate=0.15, delivery_fault_rate=0.1)
    knobs |= dict(reachable_width_hours=6, duplicate_rate=0.1, late_arrival_rate=0.1, late_arrival_max_hours=48, clock_skew_rate=0.05, clock_skew_min=30, organic_opens_per_day=1.5)
    g = generator.Generator(spark, generator.Profile(**knobs))
    return landing.with_upload_date(g.events).cache(), g.dim_user.cache()


def rows(df):
    return sorted(map(str, df.collect()))


def files(folder):
    """Every data file below a folder, with its time."""
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def jobs(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        action()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_checks_cost_no_scan(spark, tmp_path, made):
    """Checked and unchecked runs differ by the one job over the keys of small tables, and its stages."""
    raw, dim = made
    plain = jobs(spark, "plain", lambda: pipeline.refresh(spark, raw, dim, f"{tmp_path}/a", LOOSE))
    checked = jobs(spark, "checked", lambda: pipeline.refresh(spark, raw, dim, f"{tmp_path}/b", LOOSE, check=True))
    keys = jobs(spark, "keys", lambda: pipeline.repeated_keys(pipeline.refresh(spark, raw, dim, f"{tmp_path}/c", LOOSE)).collect())
    assert 0 < checked - plain <= keys - plain + 1 <= 8
    for name in (*pipeline.PARTITIONS, *pipeline.WHOLE):
        assert rows(spark.read.parquet(f"{tmp_path}/a/{name}")) == rows(spark.read.parquet(f"{tmp_path}/b/{name}")), name


def test_a_broken_metric_leaves_the_tables(spark, tmp_path, made):
    raw, dim = made
    pipeline.run(spark, raw, dim, f"{tmp_path}/t", LOOSE)
    before = files(tmp_path)
    late = raw.filter("event_type = 'prompt_sent'").orderBy(F.desc("upload_date"), "insert_id").limit(3)  # inside the dates that the run rewrites
    plants = {
        "no_conflicting_duplicates": (raw.unionByName(late.withColumn("event_properties", F.lit('{"prompt_id":"other"}'))), dim),
        "raw_not_null": (raw.unionByName(late.withColumn("insert_id", F.lit("new")).withColumn("server_received_time", F.lit(None).cast("timestamp_ntz"))), dim),
        "one_dim_row_per_event.*dim_key_unique": (raw, dim.unionByName(dim.limit(4))),
        "prompt_unique": (raw.unionByName(late.withColumn("insert_id", F.concat("insert_id", F.lit("again")))), dim),
    }
    for name, (r, d) in plants.items():
        with pytest.raises(checks.ChecksFailed, match=name):
            pipeline.run(spark, r, d, f"{tmp_path}/t", LOOSE)
        assert files(tmp_path) == before, name
    with pytest.raises(checks.ChecksFailed, match="unattributed_share"):
        pipeline.run(spark, raw, dim, f"{tmp_path}/t", Params(unattributed_max=0.0))


def test_metrics_equal_the_checks(spark, tmp_path, made):
    raw, dim = made
    raw = raw.unionByName(raw.filter("event_type = 'prompt_sent'").limit(5).withColumn("event_properties", F.lit("{}")))
    watch = Watch(LOOSE)
    t = pipeline.refresh(spark, raw, dim, f"{tmp_path}/t", LOOSE, watch=watch)
    exact = checks.all_checks(raw, dim, t.stg_events, t.stg_prompts, t.attribution, t.ontime_rate_daily, t.scores_send_time, LOOSE)
    broken = watch.broken()
    assert {n for n, k in broken.items() if k} == {n for n in broken if not exact[n].isEmpty()} == {"no_conflicting_duplicates"} | {n for n in broken if n == "prompt_cohort_matches_dim" and broken[n]}
    assert broken["no_conflicting_duplicates"] == exact["no_conflicting_duplicates"].count() == 5
    assert watch.numbers()["stg_events"]["n"] == t.stg_events.count() and watch.numbers()["attribution"]["n"] == t.attribution.count()


def test_publication_is_finished_after_a_crash(spark, tmp_path, made):
    raw, dim = made
    root = f"{tmp_path}/t"
    first = raw.filter(F.col("upload_date") < raw.agg(F.max("upload_date")).first()[0])
    pipeline.refresh(spark, first, dim, root, LOOSE)
    before = files(tmp_path)
    moved = []

    class Dies(Staged):
        def _move(self, source, target):
            if len(moved) == 3:
                raise OSError("lost")
            moved.append(target)
            super()._move(source, target)

    known = pipeline.Staged
    try:
        pipeline.Staged = Dies
        with pytest.raises(OSError, match="lost"):
            pipeline.refresh(spark, raw, dim, root, LOOSE)
    finally:
        pipeline.Staged = known
    assert files(tmp_path) != before
    Staged(spark, root)  # what the next run begins with
    one = pipeline.refresh(spark, raw, dim, f"{tmp_path}/one", LOOSE)
    assert rows(spark.read.parquet(f"{root}/attribution").select(*one.attribution.columns)) == rows(one.attribution)
    assert rows(spark.read.parquet(f"{root}/scores_send_time")) == rows(one.scores_send_time)
    assert not [n for n in os.listdir(root) if n.startswith(".")]

    class DiesEarly(Staged):
        def publish(self):
            raise OSError("early")

    before = rows(spark.read.parquet(f"{root}/attribution"))
    try:
        pipeline.Staged = DiesEarly
        with pytest.raises(OSError, match="early"):
            pipeline.refresh(spark, first, dim, root, LOOSE)
    finally:
        pipeline.Staged = known
    assert rows(spark.read.parquet(f"{root}/attribution")) == before
    Staged(spark, root)
    assert not [n for n in os.listdir(root) if n.startswith(".")]


def schedule_row(user, hour, version, day):
    t = T0 + timedelta(days=day)
    return (user, hour, 0, 9, "UTC", 0.5, version, t, t)


def test_only_buckets_with_a_winner_are_written(spark, tmp_path):
    make = lambda rs: spark.createDataFrame(rs, SEND_SCHEDULE)
    path = f"{tmp_path}/served"
    served = serving.BucketedSchedule(spark, path, 8)
    first = make([schedule_row(f"u{i}", 1, "v2", 0) for i in range(200)])
    assert served.write_back(first) == (200, 200)
    before = files(path)
    assert served.write_back(first) == (200, 0) and files(path) == before  # a second run writes nothing
    new = make([schedule_row("u3", 5, "v10", 0), schedule_row("u4", 5, "v1", 9), schedule_row("u5", 5, "v2", 0), schedule_row("u6", 5, "v2", 1)])
    want = rows(serving.upsert(served.read(), new))
    touched = {r["b"] for r in new.filter("user_id IN ('u3', 'u6')").select(served.bucket().alias("b")).collect()}
    assert served.write_back(new) == (4, 2)
    after = files(path)
    of = lambda f: int(f.split("bucket=")[1].split("/")[0])
    assert {f: t for f, t in before.items() if of(f) not in touched} == {f: t for f, t in after.items() if of(f) not in touched}
    assert all(of(f) in touched for f in set(before) ^ set(after)) and set(before) != set(after)
    assert rows(served.read()) == want
    found = served.read("u3", "nobody")
    assert [r["send_hour_local"] for r in found.collect()] == [5]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    again = serving.BucketedSchedule(spark, path, 8)
    assert again.write_back(make([schedule_row("x", 1, "v1", 0)])) == (1, 1) and again.read().count() == 201
    with pytest.raises(ValueError, match="8 buckets"):
        serving.BucketedSchedule(spark, path, 16)
    with pytest.raises(ValueError, match="v<int>"):
        again.write_back(make([schedule_row("z", 3, "1", 1)]))
    with pytest.raises(TypeError):
        again.write_back(make([schedule_row("z", 3, "v1", 1)]).withColumn("confidence", F.lit("x")))
    empty = serving.BucketedSchedule(spark, f"{tmp_path}/none", 4)
    assert empty.read().count() == 0 and empty.write_back(make([])) == (0, 0) and empty.read().count() == 0


RECORD = {"insert_id": "a", "event_type": "prompt_sent", "user_id": "u", "device_id": "d", "client_event_time": "2024-03-10 02:30:00.123456", "server_received_time": "2024-05-01 12:00:01.000000", "server_upload_time": "2024-05-01 12:00:02.000000", "event_properties": {"prompt_id": "p"}}


def record(i, **more):
    return json.dumps({k: v for k, v in (RECORD | {"insert_id": f"e{i}"} | more).items() if v != "absent"})


def test_refused_records_and_their_reasons(spark, tmp_path):
    want = [
        (record(0), []), (record(1, insert_id="absent"), ["missing:insert_id"]), (record(2, device_id=None), ["missing:device_id"]), (record(3, device_id=""), ["missing:device_id"]),
        (record(4, extra=1, more=None), ["unknown_field:extra", "unknown_field:more"]), (record(5, event_properties={"attempt": 1}), ["unknown_property:attempt"]),
        (record(6, event_type="odd"), ["unknown_type"]), (record(7, client_event_time="2024-13-01 00:00:00.000000"), ["bad_time:client_event_time"]), (record(8, client_event_time="2024-03-01"), ["bad_time:client_event_time"]),
        ('{"insert_id": ', ["not_json"]), ("[1]", ["not_json"]), (record(9, event_properties="x"), ["bad_properties"]), (record(10, event_properties="absent"), ["missing:event_properties"]),
        (record(11, event_type="app_opened", event_properties={}), []), (record(12, event_properties={"prompt_id": None}), []), (record(13, user_id="absent", event_type="odd"), ["missing:user_id", "unknown_type"]),
    ]
    path = tmp_path / "events_2024-05-01.jsonl"
    path.write_text("\n".join([*(text for text, _ in want), "", "  "]))
    for zone in ("UTC", "America/New_York"):  # a time that the zone skips is a time
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = {r["value"]: sorted(r["reasons"]) for r in landing.screened_events(spark, [str(path)]).collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == {text: sorted(reasons) for text, reasons in want}
    for _ in range(2):  # the same files again replace what they gave
        landed, refused = landing.land_screened(spark, [str(path)], f"{tmp_path}/raw", f"{tmp_path}/refused")
        assert sorted(r["insert_id"] for r in landed.collect()) == ["e0", "e11", "e12"] and refused.count() == 13
    assert landed.filter("insert_id = 'e0'").first()["client_event_time"] == datetime(2024, 3, 10, 2, 30, 0, 123456)
    assert landing.screened_events(spark, []).count() == 0
    other = tmp_path / "events_2024-05-02.jsonl"
    other.write_text(record(20, extra=2))
    landed, refused = landing.land_screened(spark, [str(other)], f"{tmp_path}/raw", f"{tmp_path}/refused")
    assert refused.count() == 14 and landed.count() == 3


def test_screening_reads_each_time_once(spark, tmp_path):
    """Good records are told by plain tests with the same outcome, repeated fields too; a time is cast once a record, and accepted texts are not stored."""
    path = tmp_path / "events_2024-05-01.jsonl"
    again = record(1)[:-1] + ', "user_id": "v"}'
    lacking = record(2, device_id="absent")[:-1] + ', "user_id": "v"}'
    odd = record(3, source="x", device_id="absent")
    key = record(4)[:-2] + ', "prompt_id": "q"}}'
    unlisted = record(5)[:-2] + ', "attempt": 1}}'
    path.write_text("\n".join((again, lacking, odd, key, unlisted)))
    screened = landing.screened_events(spark, [str(path)])
    got = {r["value"]: sorted(r["reasons"]) for r in screened.collect()}
    assert got == {again: [], lacking: ["missing:device_id"], odd: ["missing:device_id", "unknown_field:source"], key: [], unlisted: ["unknown_property:attempt"]}
    assert screened._jdf.queryExecution().optimizedPlan().toString().count("try_cast(") == 3


def test_payloads_are_parsed_of_copies_alone(spark, tmp_path, monkeypatch):
    t = lambda s: T0 + timedelta(seconds=s)
    make = lambda *rows: spark.createDataFrame([(i, "prompt_sent", "u", "d", T0, T0, t(s), props) for i, s, props in rows], EVENTS)
    parsed = []
    payload = landing.payload
    monkeypatch.setattr(landing, "payload", lambda text: parsed.append(text) or payload(text))
    other = '{"prompt_id":"p"}'
    assert landing.land(spark, make(("a", 0, "{}"), ("a", 1, other), ("b", 0, "{}")), f"{tmp_path}/raw").count() == 3 and not parsed
    assert landing.land(spark, make(("a", 0, other), ("a", 0, '{ "prompt_id": "p" }'), ("b", 0, "{}")), f"{tmp_path}/raw").count() == 3 and parsed
    with pytest.raises(landing.ConflictingDuplicates, match="^a, c$"):
        landing.land(spark, make(("c", 0, "{}"), ("c", 0, other), ("b", 0, "{}"), ("a", 1, other), ("a", 1, "{}"), ("a", 1, "{}")), f"{tmp_path}/raw")
    assert landing.conflicts(make(("b", 0, "{}"), ("b", 0, "{}"))) == []


def test_dimension_of_another_header_is_refused(spark, tmp_path):
    cells = "u,UTC,c,2024-01-01,2024-01-01 00:00:00.000000,\n"
    for i, head in enumerate(("user_id,cohort_id,tz,signup_date,valid_from,valid_to", "user_id,tz,cohort_id,signup_date,valid_from", "user_id,tz,cohort_id,signup_date,valid_from,valid_to,more", "user_id,zone,cohort_id,signup_date,valid_from,valid_to")):
        (tmp_path / f"{i}.csv").write_text(f"{head}\n{cells}")
        with pytest.raises(Exception, match="(?i)header|malformed|FAILED_READ"):
            landing.read_dim_user(spark, f"{tmp_path}/{i}.csv").collect()
    (tmp_path / "ok.csv").write_text(f"user_id,tz,cohort_id,signup_date,valid_from,valid_to\n{cells}")
    assert landing.read_dim_user(spark, f"{tmp_path}/ok.csv").count() == 1


def test_dimension_over_jdbc(spark, made):
    """Round trip through a database, read in ranges of users; filters reach its queries."""
    dim, url = made[1], "jdbc:derby:memory:dim;create=true"
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    for _ in range(2):  # writing again changes nothing
        assert landing.write_dim_jdbc(dim, url, "dim_user", 3, **options) == dim.count()
    cuts = tuple(r["user_id"] for r in dim.select("user_id").distinct().orderBy("user_id").limit(9).collect())[2::3]
    back = landing.read_dim_jdbc(spark, url, "dim_user", cuts, **options)
    assert rows(back) == rows(dim) and back.rdd.getNumPartitions() == len(cuts) + 1 and back.schema.simpleString() == dim.schema.simpleString()
    plan = back.filter("valid_to IS NULL AND cohort_id = 'c-a'").select("user_id")._jdf.queryExecution().executedPlan().toString()
    assert "IsNull(valid_to)" in plan and "EqualTo(cohort_id,c-a)" in plan
    again = dim.unionByName(dim.limit(1))
    with pytest.raises(RuntimeError, match="write again"):
        landing.write_dim_jdbc(again, url, "dim_user", 3, **options)
    gap = dim.withColumn("signup_date", F.when(F.col("user_id") != dim.first()["user_id"], F.col("signup_date")))
    landing.write_dim_jdbc(gap, url, "dim_user", 3, **options)
    with pytest.raises(Exception, match="signup_date is empty"):
        landing.read_dim_jdbc(spark, url, "dim_user", **options).collect()


def test_manifest_drift_on_any_file_system(spark, tmp_path):
    for name, text in (("a/x.csv", "1"), ("a/y.csv", "2"), ("b/z.csv", "3")):
        (tmp_path / "raw" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / name).write_text(text)
    before = landing.file_hashes(spark, f"{tmp_path}/raw").cache()
    assert {r["name"]: r["bytes"] for r in before.collect()} == {"a/x.csv": 1, "a/y.csv": 1, "b/z.csv": 1}
    assert {f"raw/{r['name']}": r["sha256"] for r in before.collect()} == landing.manifest(str(tmp_path), ("raw",))
    (tmp_path / "raw/a/x.csv").write_text("other")
    (tmp_path / "raw/a/y.csv").unlink()
    (tmp_path / "raw/new.csv").write_text("4")
    drift = landing.manifest_drift(before, landing.file_hashes(spark, f"file://{tmp_path}/raw"))
    assert {r["name"]: r["drift"] for r in drift.collect()} == {"a/x.csv": "changed", "a/y.csv": "missing", "new.csv": "extra"}
