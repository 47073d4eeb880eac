"""The stateful stream of earliest copies against the batch, in any order of batches."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from tidemark.operators import staging
from tidemark.params import Params
from tidemark.sources.schemas import EVENTS
from tidemark.streaming import earliest, micro_batch

T0 = datetime(2024, 3, 8, 12)


def copies(seed):
    rng, out = random.Random(seed), []
    for i in range(60):
        made = T0 + timedelta(minutes=rng.randrange(3000))
        for k in range(rng.choice([1, 1, 2, 4])):
            up = made + timedelta(seconds=rng.randrange(100_000))
            out.append((f"e{i}", "app_opened", "u", "d", made, made + timedelta(seconds=k), up, '{"k":%d}' % k))
    return out


def run(spark, folder, batches, params):
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, EVENTS)
        df.coalesce(1).write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(f"{folder}/in")
        earliest.start(micro_batch.read_stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/check", params).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


def test_any_order_of_batches_gives_the_earliest_copies(spark, tmp_path):
    rows = copies(1)
    want = sorted(map(str, staging.dedupe_earliest(spark.createDataFrame(rows, EVENTS)).collect()))
    for seed in (1, 2):
        mixed = random.Random(seed).sample(rows, len(rows))
        updates = run(spark, f"{tmp_path}/{seed}", [mixed[:50], mixed[50:90], mixed[90:]], Params(lookback_days=9))
        assert sorted(map(str, earliest.current(updates).collect())) == want
        assert updates.groupBy("insert_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").count() > 0  # some were replaced


def test_state_expires(spark, tmp_path):
    """Once uploads are the lookback ahead, an event's state is gone, and copies of such an age are not passed on."""
    old = ("old", "app_opened", "u", "d", T0, T0, T0 + timedelta(seconds=60), "{}")
    far = lambda i, days: (f"far{i}", "app_opened", "u", "d", T0, T0, T0 + timedelta(days=days), "{}")
    again = ("old", "app_opened", "u", "d", T0, T0, T0 + timedelta(seconds=30), "{}")
    folder, params = f"{tmp_path}/x", Params(lookback_days=2)
    updates = run(spark, folder, [[old, far(0, 0)], [far(1, 10)], [far(2, 11)], [again, far(3, 12)]], params)
    assert updates.filter("insert_id = 'old'").count() == 1 and updates.count() == 5
    query = earliest.start(micro_batch.read_stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/check", params)
    query.awaitTermination()
    store = spark.read.format("statestore").load(f"{folder}/check")
    assert "old" not in {r["key"]["insert_id"] for r in store.collect()}
