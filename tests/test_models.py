"""Every model on small rows: each arm, boundary and neighbouring precedence."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tidemark.operators import attribution as att
from tidemark.operators import marts, scores, staging
from tidemark.params import Params
from tidemark.sources.schemas import DIM_USER, EVENTS

T0 = datetime(2024, 5, 1, 12)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def event(i, kind, client=0, delay=0, upload=60, user="u1", props='{"prompt_id":"p1"}'):
    return (i, kind, user, "d1", at(client), at(client + delay), at(client + delay + upload), props)


def dim_row(user="u1", tz="UTC", cohort="c1", start=datetime(2024, 1, 1), end=None):
    return (user, tz, cohort, start.date(), start, end)


SENT = '{"prompt_id":"p1","cohort_id":"c1","window_minutes":60}'


def stage(spark, events, dim=None):
    return staging.stg_events(spark.createDataFrame(events, EVENTS), spark.createDataFrame(dim or [dim_row()], DIM_USER))


def labelled(spark, *events, receipt=10):
    rows = [event("e0", "prompt_sent", props=SENT)] + ([event("e1", "prompt_delivered", receipt)] if receipt is not None else []) + list(events)
    stg = stage(spark, rows)
    return att.attribution(staging.stg_prompts(stg), stg)


def test_earliest_copy_wins(spark):
    rows = [event("a", "app_opened", upload=500), event("a", "app_opened", upload=50), event("b", "app_opened")]
    got = {r["insert_id"]: r["server_upload_time"] for r in staging.dedupe_earliest(spark.createDataFrame(rows, EVENTS)).collect()}
    assert got == {"a": at(50), "b": at(60)}


def test_as_of_zone_half_open(spark):
    dim = [dim_row(tz="UTC", end=at(100)), dim_row(tz="Asia/Tokyo", cohort="c2", start=at(100))]
    rows = [event("a", "app_opened", 99), event("b", "app_opened", 100), event("c", "app_opened", user="nobody")]
    got = {r["insert_id"]: (r["tz"], r["cohort_id"]) for r in stage(spark, rows, dim).collect()}
    assert got == {"a": ("UTC", "c1"), "b": ("Asia/Tokyo", "c2"), "c": (None, None)}


def test_local_date_delay_and_properties(spark):
    rows = [event("a", "upload_failed", 12 * 3600, -7, props='{"prompt_id":"p1","attempt":2,"error_code":"E1"}'), event("b", "upload_completed", props='{"prompt_id":"p1","attempt":1,"error_code":null}')]
    a, b = stage(spark, rows, [dim_row(tz="Asia/Tokyo")]).orderBy("insert_id").collect()
    assert str(a["event_date"]) == "2024-05-02" and a["upload_delay_seconds"] == -7 and (a["attempt"], a["error_code"]) == (2, "E1")
    assert b["error_code"] is None and b["window_minutes"] is None


def test_first_receipt_and_none(spark):
    rows = [event("s", "prompt_sent", props=SENT), event("z", "prompt_delivered", 5), event("y", "prompt_delivered", 5), event("x", "prompt_delivered", 9), event("t", "prompt_sent", props=SENT.replace("p1", "p2"))]
    got = {r["prompt_id"]: (r["delivered_insert_id"], r["delivered_at"]) for r in staging.stg_prompts(stage(spark, rows)).collect()}
    assert got == {"p1": ("y", at(5)), "p2": (None, None)}


RESPONSE, FAILED, DONE, CAPTURE = "response_recorded", "upload_failed", "upload_completed", "capture_started"


@pytest.mark.parametrize(
    ("events", "receipt", "label"),
    [
        ([event("a", RESPONSE, 60)], None, "delivery_fault"),
        ([event("a", RESPONSE, 60)], 600, "on_time"),
        ([event("a", RESPONSE, 60)], 601, "delivery_fault"),
        ([event("b", CAPTURE, 30, -301), event("a", RESPONSE, 60)], 10, "unattributed"),
        ([event("b", CAPTURE, 30, -300), event("a", RESPONSE, 60)], 10, "on_time"),
        ([event("b", CAPTURE, 30, 90_000), event("a", RESPONSE, 60)], 10, "on_time"),
        ([event("a", RESPONSE, 3599)], 10, "on_time"),
        ([event("a", RESPONSE, 3600)], 10, "timing_gap"),
        ([event("a", RESPONSE, 60, 3600)], 10, "unattributed"),
        ([event("b", DONE, 60, 4000), event("a", RESPONSE, 4060)], 10, "upload_fault"),
        ([event("b", FAILED, 60, 4000), event("a", RESPONSE, 4060)], 10, "unattributed"),
        ([event("b", FAILED, 60)], 10, "upload_fault"),
        ([event("b", FAILED, 60), event("a", RESPONSE, 70)], 10, "on_time"),
        ([event("b", CAPTURE, 60)], 10, "unattributed"),
        ([event("b", CAPTURE, 3700)], 10, "timing_gap"),
        ([event("b", DONE, 3700)], 10, "unattributed"),
        ([], 10, "timing_gap"),
        ([event("b", FAILED, 60)], None, "delivery_fault"),
        ([event("b", FAILED, 60, -400)], 10, "unattributed"),
    ],
)
def test_attribution_arms(spark, events, receipt, label):
    rows = labelled(spark, *events, receipt=receipt).collect()
    assert [r["label"] for r in rows] == [label]


def test_status_boundary(spark):
    for days, status in ((4, "provisional"), (5, "final"), (6, "final")):
        stg = stage(spark, [event("e0", "prompt_sent", props=SENT), event("z", "app_opened", days * 86400, props="{}")])
        assert att.attribution(staging.stg_prompts(stg), stg).first()["status"] == status


def labels_of(spark, rows):
    """Rows of (user, cohort, day, label, delivered)."""
    days = [(u, c, T0 + timedelta(days=d), k, g) for u, c, d, k, g in rows]
    return spark.createDataFrame(days, "user_id string, cohort_id string, sent_at_local timestamp_ntz, label string, delivered_in_grace boolean")


def test_daily_rate_zero_and_null(spark):
    rows = [("u1", "a", 0, "on_time", True), ("u2", "a", 0, "timing_gap", True), ("u3", "a", 0, "delivery_fault", False), ("u1", "b", 0, "timing_gap", True), ("u1", "c", 0, "delivery_fault", False)]
    got = {r["cohort_id"]: (r["prompts_sent"], r["prompts_delivered"], r["on_time"], r["ontime_rate"]) for r in marts.ontime_rate_daily(labels_of(spark, rows)).collect()}
    assert got == {"a": (3, 2, 1, 0.5), "b": (1, 1, 0, 0.0), "c": (1, 0, 0, None)}
    assert marts.overall_rate(marts.ontime_rate_daily(labels_of(spark, rows))).first()["ontime_rate"] == round(1 / 3, 6)
    assert {r["label"]: r["n"] for r in marts.label_counts(labels_of(spark, rows)).collect()} == {"on_time": 1, "upload_fault": 0, "delivery_fault": 2, "timing_gap": 2, "unattributed": 0}


def test_retention_three_states(spark):
    rows = [("in", "a", 0, "on_time", True), ("in", "a", 28, "on_time", True), ("out", "a", 0, "timing_gap", True), ("new", "a", 10, "on_time", True)]
    opens = [event("a", "app_opened", 28 * 86400, user="in"), event("b", "app_opened", 27 * 86400, user="out"), event("c", "app_opened", 30 * 86400, user="x")]
    stg = stage(spark, opens, [dim_row(user=u) for u in ("in", "out", "x")])
    got = {r["user_id"]: (r["retained"], r["prompts_delivered"], r["ontime_rate"]) for r in marts.ontime_retention(labels_of(spark, rows), stg).collect()}
    assert got == {"in": (True, 1, 1.0), "out": (False, 1, 0.0), "new": (None, 1, 1.0)}


def test_features_window_and_kind(spark):
    month = 30 * 86400
    rows = [event("a", "app_opened", 0), event("b", "app_opened", 1), event("c", "capture_started", 2), event("d", "app_opened", 3600), event("z", "prompt_sent", month, props=SENT)]
    got = {(r["hour_local"]): r["n_opens"] for r in scores.features_user_hour(stage(spark, rows)).collect()}
    assert got == {12: 1, 13: 1}  # the first is just outside the window


def score(spark, features, users=None, window=60, params=None):
    users = users or sorted({u for u, *_ in features})
    current = spark.createDataFrame([(u, "c1", "UTC") for u in users], "user_id string, cohort_id string, tz string")
    feats = spark.createDataFrame([(u, h, n, T0) for u, h, n in features], "user_id string, hour_local int, n_opens long, last_open_at timestamp_ntz")
    prompts = spark.createDataFrame([("c1", window)], "cohort_id string, window_minutes int")
    return {r["user_id"]: r for r in scores.scores_send_time(current, feats, prompts, params).collect()}


def expected(own, everyone, k=5.0):
    """Posterior centre and confidence, from plain arithmetic."""
    vec = lambda bins: (sum(n * math.cos(2 * math.pi * (h + 0.5) / 24) for h, n in bins), sum(n * math.sin(2 * math.pi * (h + 0.5) / 24) for h, n in bins))
    (cx, cy), (x, y) = vec(everyone), vec(own)
    total, n = sum(n for _, n in everyone), sum(n for _, n in own)
    px, py = x + k * cx / total, y + k * cy / total
    return (math.atan2(py, px) * 24 / (2 * math.pi)) % 24, math.hypot(px, py) / (n + k)


def test_scores_shrink_towards_cohort(spark):
    f = [("a", 9, 4), ("a", 10, 1), ("b", 11, 6)]
    got = score(spark, f, ["a", "b", "new"])
    for user in ("a", "b", "new"):
        center, sure = expected([(h, n) for u, h, n in f if u == user], [(h, n) for _, h, n in f])
        assert got[user]["center_hour_local"] == pytest.approx(center, abs=1e-6) and got[user]["confidence"] == pytest.approx(sure, abs=1e-6)
        assert got[user]["cohort_hour_local"] == 11


def test_scores_clamp_and_wrap(spark):
    got = score(spark, [("night", 23, 50), ("early", 1, 40), ("far", 12, 30)], window=60)
    assert got["night"]["cohort_hour_local"] == 23
    assert (got["far"]["send_hour_local"], got["far"]["send_minute_local"]) in ((21, 0), (1, 0))
    assert got["early"]["send_hour_local"] in (0, 1) and got["far"]["model_version"] == "v1"


def test_moment_ties_to_the_smaller_hour_and_window_spans(spark):
    assert score(spark, [("a", 20, 3), ("b", 4, 3)])["a"]["cohort_hour_local"] == 4
    assert score(spark, [("a", 23, 3), ("a", 0, 3), ("b", 10, 5)], window=61)["a"]["cohort_hour_local"] == 23
    assert score(spark, [("a", 23, 3), ("a", 0, 3), ("b", 10, 5)], window=60)["a"]["cohort_hour_local"] == 10


def test_cohort_without_opens_or_prompts_has_no_score(spark):
    current = spark.createDataFrame([("a", "c1", "UTC"), ("b", "c2", "UTC")], "user_id string, cohort_id string, tz string")
    feats = spark.createDataFrame([("a", 3, 2, T0)], "user_id string, hour_local int, n_opens long, last_open_at timestamp_ntz")
    prompts = spark.createDataFrame([("c1", 60), ("c2", 60)], "cohort_id string, window_minutes int")
    assert [r["user_id"] for r in scores.scores_send_time(current, feats, prompts).collect()] == ["a"]
    assert scores.scores_send_time(current, feats, prompts.filter(F.col("cohort_id") == "c2")).isEmpty()
    assert Params().lookback_days == 5
