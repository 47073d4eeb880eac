"""Targets in the catalog, tables co-located by prompt, and the experiment's read-out."""

import random

import pytest
from pyspark.sql import functions as F
from tidemark.params import Params
from tidemark.plans import experiment, pipeline, targets
from tidemark.sources import star_adapter

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def adapted(spark):
    e = spark.read.parquet(f"{SMALL}/events.parquet")
    return star_adapter.raw_events(e).cache(), star_adapter.dim_user(e).cache()


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_two_targets_side_by_side(spark, tmp_path, adapted):
    raw, dim = adapted
    early = raw.filter(F.to_date("server_upload_time") < F.lit("2024-01-20").cast("date"))
    one = pipeline.refresh(spark, early, dim, f"{tmp_path}/one")
    two = pipeline.refresh(spark, raw, dim, f"{tmp_path}/two", Params(schema_prefix="dev_"))
    targets.register(spark, f"{tmp_path}/one", "target_one")
    names = targets.register(spark, f"{tmp_path}/two", "target_two", Params(schema_prefix="dev_"))
    for database, t in (("target_one", one), ("target_two", two)):
        assert rows(spark.table(f"{database}.attribution").select(*t.attribution.columns)) == rows(t.attribution)
        days = {f"prompt_date={r[0]}" for r in t.attribution.select("prompt_date").distinct().collect()}
        assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {database}.attribution").collect()} == days
    assert len(names) == 8 and "PartitionFilters: [isnotnull(prompt_date" in plan(spark.sql("SELECT * FROM target_two.attribution WHERE prompt_date = DATE'2024-01-10'"))
    one = pipeline.refresh(spark, raw, dim, f"{tmp_path}/one", full=True)
    targets.register(spark, f"{tmp_path}/one", "target_one")  # new days are taken up
    assert rows(spark.table("target_one.attribution").select(*one.attribution.columns)) == rows(two.attribution)
    with pytest.raises(PermissionError):
        targets.drop_target(spark, f"{tmp_path}/one", "target_one")
    targets.drop_target(spark, f"{tmp_path}/one", "target_one", confirm=True)
    assert not spark.catalog.databaseExists("target_one") and not (tmp_path / "one").exists()
    assert spark.table("target_two.scores_send_time").count() == two.scores_send_time.count() > 0


def test_no_exchange_on_the_prompt(spark, tmp_path, adapted):
    t = pipeline.build(*adapted, level=None)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to broadcast
    try:
        held = targets.ByPrompt(spark, "by_prompt_test", f"{tmp_path}/b", 6).write(t.stg_prompts, t.stg_events)
        got = held.attribution()
        assert "Exchange" not in plan(got) and plan(got).count("Bucketed: true") >= 2
        assert "hashpartitioning(prompt_id" in plan(t.attribution)
        assert rows(got) == rows(t.attribution.select(*got.columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP DATABASE IF EXISTS by_prompt_test CASCADE")


def test_readout_is_the_jackknife(spark):
    """Differences are exact; the delta method's error is near that of leaving out one user at a time."""
    rng, sends, arms = random.Random(4), [], []
    for u in range(300):
        arm, base = rng.choice(["treatment", "control", "holdout"]), rng.random()
        arms.append((f"u{u}", arm))
        for _ in range(rng.randrange(1, 30)):
            p = min(1.0, base + (0.1 if arm == "treatment" else 0))
            label = "delivery_fault" if rng.random() < 0.1 else "on_time" if rng.random() < p else rng.choice(["upload_fault", "timing_gap", "unattributed"])
            sends.append((f"u{u}", label, label != "delivery_fault"))
    arms.append(("nobody", "treatment"))
    sends.append(("unassigned", "on_time", True))
    got = {r["metric"]: r for r in experiment.readout(spark.createDataFrame(sends, "user_id string, label string, delivered_in_grace boolean"), spark.createDataFrame(arms, "user_id string, arm string")).collect()}
    of = dict(arms)
    for metric, hit, among in (("ontime_rate", {"on_time"}, True), ("response_rate", {"on_time", "upload_fault"}, True), ("delivery_fault_share", {"delivery_fault"}, False), ("unattributed_share", {"unattributed"}, True)):
        rate, variance = {}, {}
        for arm in ("treatment", "control"):
            users = {}
            for u, label, delivered in sends:
                if of.get(u) == arm:
                    x = users.setdefault(u, [0, 0])
                    x[0] += label in hit
                    x[1] += delivered or not among
            a, b, n = sum(x for x, _ in users.values()), sum(x for _, x in users.values()), len(users)
            rate[arm] = a / b
            left = [(a - x) / (b - y) for x, y in users.values()]
            variance[arm] = (n - 1) / n * sum((v - sum(left) / n) ** 2 for v in left)
            assert got[metric][f"{arm}_users"] == n and got[metric][f"{arm}_rate"] == pytest.approx(rate[arm])
        r, error = got[metric], sum(variance.values()) ** 0.5
        assert r["difference"] == pytest.approx(rate["treatment"] - rate["control"]) and r["std_error"] == pytest.approx(error, rel=0.05)
        assert r["low"] < r["difference"] < r["high"]
    one = experiment.readout(spark.createDataFrame([("a", "on_time", True)], "user_id string, label string, delivered_in_grace boolean"), spark.createDataFrame([("a", "treatment")], "user_id string, arm string"))
    assert [(r["treatment_rate"], r["std_error"]) for r in one.filter("metric = 'ontime_rate'").collect()] == [(1.0, None)]
