import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tidemark.functions import columns as c


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "want"), [('{"k": null}', None), ("{}", None), ('{"k": 5}', "5"), ('{"k": ""}', ""), ('{"k": "a"}', "a")])
def test_json_value(spark, text, want):
    assert one(spark, c.json_value("t", "k"), t=text) == want


def test_seconds_floor_both_sides(spark):
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    assert one(spark, c.seconds_between(ts("2024-01-01 00:00:00.9"), ts("2024-01-01 00:00:01.1"))) == 1
    assert one(spark, c.seconds_between(ts("2024-01-01 00:00:05"), ts("2024-01-01 00:00:01"))) == -4
    assert one(spark, c.days_between(F.lit("2024-01-01").cast("date"), F.lit("2024-01-02").cast("date"))) == 1


@pytest.mark.parametrize(("utc", "zone", "local"), [("2024-03-10 06:59:59", "America/New_York", "2024-03-10 01:59:59"), ("2024-03-10 07:00:00", "America/New_York", "2024-03-10 03:00:00"), ("2024-01-01 20:00:00", "Asia/Tokyo", "2024-01-02 05:00:00")])
def test_local_time(spark, utc, zone, local):
    assert str(one(spark, c.to_local(F.lit(utc).cast("timestamp_ntz"), F.lit(zone)))) == local


def test_ratio(spark):
    assert one(spark, c.ratio(F.lit(1), F.lit(0))) is None and one(spark, c.ratio(F.lit(1), F.lit(None).cast("int"))) is None and one(spark, c.ratio(F.lit(1), F.lit(4))) == 0.25


@pytest.mark.parametrize(("x", "wrapped", "arc"), [(0.0, 0, 0), (24.0, 0, 0), (-1.0, 23, -1), (12.0, 12, -12), (-12.0, 12, -12), (13.0, 13, -11), (-13.0, 11, 11)])
def test_circle(spark, x, wrapped, arc):
    assert one(spark, c.wrap_hours(F.lit(x))) == wrapped and one(spark, c.short_arc(F.lit(x))) == arc
    assert one(spark, c.circular_distance(F.lit(x), F.lit(0.0))) == abs(arc)


def test_open_probability(spark):
    p = lambda h, w, m: one(spark, c.open_probability(F.lit(h), F.lit(10.0), F.lit(w), F.lit(m)))
    assert p(11.0, 2.0, 60.0) == 0.9 and p(12.0, 2.0, 60.0) == pytest.approx(0.9 * math.exp(-1)) and p(10.0, 2.0, 30.0) == 0.45 and p(10.0, 2.0, 120.0) == 0.9


def test_version_number(spark):
    assert one(spark, c.version_number(F.lit("v10"))) == 10
    for bad in ("10", "vx", "v1.0", None):
        with pytest.raises(PySparkException):
            one(spark, c.version_number(F.lit(bad).cast("string")))


def test_marked_tells_null_from_text(spark):
    assert one(spark, c.marked(F.lit("a"), F.lit(None).cast("string"))) == "a|<null>"
