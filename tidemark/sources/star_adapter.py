"""The event contract derived from a plain events table (event_id, ts, user_id, event_type, value, props).

A user's first event of a day becomes a prompt; the day's other events become
what followed it, each with three clocks. All rules are arithmetic on the
input columns, so any engine can derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KINDS = {"signup": "app_opened", "view": "capture_started", "click": "upload_completed", "purchase": "response_recorded", "error": "upload_failed"}
ZONES = ("America/New_York", "Europe/London", "Asia/Tokyo", "America/Los_Angeles")


def _plus(ts: Column, seconds: Column) -> Column:
    return (F.timestamp_seconds(F.unix_seconds(ts.cast("timestamp")) + seconds)).cast("timestamp_ntz")


def raw_events(events: DataFrame) -> DataFrame:
    day = Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts", "event_id")
    base = events.select("event_id", "ts", "user_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).withColumns(
        {"n": F.row_number().over(day), "sent": F.first("ts").over(day)}
    )
    base = base.withColumn("sent", _plus(F.col("sent"), F.lit(0)))
    kind = F.coalesce(*[F.when(F.col("event_type") == a, F.lit(b)) for a, b in KINDS.items()])
    moved = _plus(F.col("sent"), F.floor((F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.col("sent").cast("timestamp"))) / 12))
    # one scan: an event becomes its row and, if it is a delivered prompt, a receipt; some rows are uploaded twice
    receipt = (F.col("n") == 1) & (F.col("k") % 10 != 9)
    rows = base.withColumn("row", F.explode(F.when(receipt, F.array(F.lit("e"), F.lit("d"))).otherwise(F.array(F.lit("e")))))
    own = F.col("row") == "e"
    rows = rows.select(
        F.concat("row", F.lit("-"), "event_id").alias("insert_id"),
        F.when(~own, "prompt_delivered").when(F.col("n") == 1, "prompt_sent").otherwise(kind).alias("event_type"),
        "event_id", "user_id", "k", "sent",
        F.when(~own, _plus(F.col("sent"), F.lit(30) + 7 * F.col("k"))).when(F.col("n") == 1, F.col("sent")).when(F.col("event_type") == "signup", _plus(F.col("ts"), F.lit(0))).otherwise(moved).alias("client_event_time"),
    )
    digit = F.col("k") % 10
    delay = F.when(F.col("event_type").isin("prompt_sent", "response_recorded", "prompt_delivered"), 0).when(digit == 0, -400).when(digit.isin(1, 2), 7200).otherwise(F.col("k"))
    prompt = F.concat(F.lit('"prompt_id":"p-'), "user_id", F.lit("-"), F.to_date("sent").cast("string"), F.lit('"'))
    cohort = F.concat(F.lit(',"cohort_id":"c-'), F.col("user_id") % 3, F.lit('","window_minutes":60'))
    inside = F.when(F.col("event_type") == "app_opened", F.lit("")).when(F.col("event_type") == "prompt_sent", F.concat(prompt, cohort)).otherwise(prompt)
    rows = rows.withColumn("received", _plus(F.col("client_event_time"), delay))
    rows = rows.withColumn("again", F.explode(F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1800))).otherwise(F.array(F.lit(0)))))
    return rows.select(
        "insert_id", "event_type",
        F.concat(F.lit("u-"), "user_id").alias("user_id"),
        F.concat(F.lit("dev-"), "user_id").alias("device_id"),
        "client_event_time",
        F.col("received").alias("server_received_time"),
        _plus(F.col("received"), F.lit(60) + (F.col("event_id") % 97) * 600 + F.col("again")).alias("server_upload_time"),
        F.concat(F.lit("{"), inside, F.lit("}")).alias("event_properties"),
    )


def dim_user(events: DataFrame) -> DataFrame:
    users = events.select("user_id").distinct()
    zone = F.element_at(F.array(*map(F.lit, ZONES)), (F.col("user_id") % 4 + 1).cast("int"))
    start, turn, none = (F.lit(x).cast("timestamp_ntz") for x in ("2023-12-01 00:00:00", "2024-01-15 00:00:00", None))
    ten = F.col("user_id") % 10 == 0
    moved = F.when(F.col("user_id") % 4 == 0, F.lit(ZONES[2])).otherwise(F.lit(ZONES[1]))
    first = F.struct(zone.alias("tz"), start.alias("valid_from"), F.when(ten, turn).otherwise(none).alias("valid_to"))
    second = F.struct(moved.alias("tz"), turn.alias("valid_from"), none.alias("valid_to"))
    rows = users.withColumn("row", F.explode(F.when(ten, F.array(first, second)).otherwise(F.array(first))))
    return rows.select(
        F.concat(F.lit("u-"), "user_id").alias("user_id"), "row.tz", F.concat(F.lit("c-"), F.col("user_id") % 3).alias("cohort_id"),
        F.lit("2023-12-01").cast("date").alias("signup_date"), "row.valid_from", "row.valid_to",
    )
