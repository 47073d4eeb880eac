"""Synthetic event exports with a known cause behind every prompt.

Everything is a column of ``spark.range``: each number that looks random is a
hash of (seed, purpose, user, day), so rows do not depend on partitions and a
profile of any size is generated where its partitions lie. The cause is drawn
first; the events are what such a prompt leaves behind. Late uploads, wrong
client clocks and repeated exports are put in afterwards and leave the cause
alone.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import TWO_PI, open_probability, wrap_hours
from tidemark.params import Params

from .schemas import DIM_USER, EVENTS, TRUTH_PROMPTS, TRUTH_USERS

#: The first simulated day, in UTC.
FIRST_DAY = "2026-01-05"
#: Standard deviation, in hours, of users' centres round their cohort's hour.
SPREAD = 4.0


@dataclass(frozen=True)
class Profile:
    """The knobs of a generated data set; all are required."""

    seed: int
    users: int
    days: int
    shards: int
    tz_mix: dict[str, float]
    tz_change_rate: float
    cohorts: dict[str, int]
    window_minutes: int
    upload_fault_rate: float
    delivery_fault_rate: float
    reachable_width_hours: float
    duplicate_rate: float
    late_arrival_rate: float
    late_arrival_max_hours: float
    clock_skew_rate: float
    clock_skew_min: float
    organic_opens_per_day: float

    def __post_init__(self):
        rates = [f.name for f in fields(self) if f.name.endswith("_rate") and not 0 <= getattr(self, f.name) <= 1]
        positive = [n for n in ("users", "days", "shards", "window_minutes", "late_arrival_max_hours") if getattr(self, n) <= 0]
        if rates or positive or not self.tz_mix or not self.cohorts or not 0 < self.reachable_width_hours <= 24 or self.organic_opens_per_day < 0:
            raise ValueError(f"profile out of range: {rates + positive or 'tz_mix, cohorts, reachable_width_hours, organic_opens_per_day'}")
        if self.clock_skew_min <= Params().skew_max_min:
            raise ValueError("clock_skew_min must be above the skew that attribution tolerates")

    @classmethod
    def read(cls, text: str) -> Profile:
        """From JSON; a missing or unknown knob is refused."""
        return cls(**json.loads(text))


class Generator:
    """The tables of a profile: ``events``, ``dim_user``, ``truth_users``, ``truth_prompts``."""

    def __init__(self, spark: SparkSession, profile: Profile):
        self.spark, self.p = spark, profile

    def _u(self, purpose: str, *keys: str) -> Column:
        """A uniform number in [0, 1) for this purpose and key."""
        h = F.xxhash64(F.lit(self.p.seed), F.lit(purpose), *[F.col(k) for k in keys])
        return F.pmod(h, F.lit(1 << 52)) / F.lit(float(1 << 52))

    def _normal(self, purpose: str, *keys: str) -> Column:
        return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - self._u(purpose + " a", *keys))) * F.cos(F.lit(TWO_PI) * self._u(purpose + " b", *keys))

    def _seconds(self, purpose: str, low: float, high: float, *keys: str) -> Column:
        return F.floor(F.lit(float(low)) + self._u(purpose, *keys) * F.lit(float(high - low)))

    def _weighted(self, weights: dict[str, float], u: Column) -> Column:
        names, total, upto, out = sorted(weights), sum(weights.values()), 0.0, None
        for name in names[:-1]:
            upto += weights[name] / total
            out = F.when(u < upto, name) if out is None else out.when(u < upto, name)
        return F.lit(names[-1]) if out is None else out.otherwise(names[-1])

    def _users(self) -> DataFrame:
        p = self.p
        zones = sorted(p.tz_mix)
        ids = self.spark.range(0, p.users, 1, p.shards).select((F.col("id") + 1).alias("n"))
        hour = reduce(lambda acc, c: acc.when(F.col("cohort_id") == c, p.cohorts[c]), sorted(p.cohorts), F.when(F.lit(False), 0))
        return ids.select(
            "n",
            F.format_string("u-%06d", "n").alias("user_id"),
            self._weighted(dict.fromkeys(p.cohorts, 1.0), self._u("cohort", "n")).alias("cohort_id"),
            self._weighted(p.tz_mix, self._u("zone", "n")).alias("tz"),
            F.expr(f"DATE'{FIRST_DAY}'").alias("first_day"),
            F.floor(self._u("signup", "n") * 90 + 1).cast("int").alias("before"),
            # one change of zone on a later day, to any other zone of the mix
            ((F.lit(p.days) > 1) & (F.lit(len(zones)) > 1) & (self._u("moves", "n") < p.tz_change_rate)).alias("moves"),
            F.floor(self._u("move day", "n") * max(1, p.days - 1) + 1).cast("int").alias("move_day"),
        ).withColumns(
            {
                "tz2": F.element_at(F.filter(F.array(*map(F.lit, zones)), lambda z: z != F.col("tz")), (F.floor(self._u("other zone", "n") * max(1, len(zones) - 1)) + 1).cast("int")) if len(zones) > 1 else F.col("tz"),
                "moved_at": F.when(F.col("moves"), F.date_add("first_day", F.col("move_day")).cast("timestamp_ntz")),
                "cohort_hour": hour,
                "center": F.round(wrap_hours(hour + self._normal("centre", "n") * SPREAD), 3),
            }
        )

    @property
    def dim_user(self) -> DataFrame:
        """One row a user, two if the zone changes; the last is open."""
        u = self._users().withColumn("signup_date", F.date_sub("first_day", F.col("before")))
        start = F.col("signup_date").cast("timestamp_ntz")
        old = F.struct(F.col("tz").alias("z"), start.alias("valid_from"), F.col("moved_at").alias("valid_to"))
        new = F.struct(F.col("tz2").alias("z"), F.col("moved_at").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
        rows = u.withColumn("row", F.explode(F.when(F.col("moves"), F.array(old, new)).otherwise(F.array(old))))
        return rows.select("user_id", F.col("row.z").alias("tz"), "cohort_id", "signup_date", "row.valid_from", "row.valid_to").select(*DIM_USER.names)

    @property
    def truth_users(self) -> DataFrame:
        return self._users().select("user_id", "cohort_id", F.col("center").alias("reachable_center_local_hour"), F.lit(float(self.p.reachable_width_hours)).alias("reachable_width_hours")).select(*TRUTH_USERS.names)

    def _prompts(self) -> DataFrame:
        """One row a user and day: when the prompt is sent, and its cause."""
        p, key = self.p, ("n", "d")
        rows = self._users().withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(p.days - 1))))
        utc = lambda z: F.convert_timezone(z, F.lit("UTC"), F.date_add("first_day", F.col("d")).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("cohort_hour")))
        # the zone that holds when the prompt is sent: a move can fall between the day's start and the hour
        rows = rows.withColumn("sent", F.when(F.col("moves") & (utc(F.col("tz")) >= F.col("moved_at")), utc(F.col("tz2"))).otherwise(utc(F.col("tz"))))
        rows = rows.withColumn("zone", F.when(F.col("moves") & (F.col("sent") >= F.col("moved_at")), F.col("tz2")).otherwise(F.col("tz")))
        local = F.convert_timezone(F.lit("UTC"), F.col("zone"), F.col("sent"))
        rows = rows.withColumn("local_hour", F.hour(local) + F.minute(local) / F.lit(60.0))
        opens = open_probability(F.col("local_hour"), F.col("center"), F.lit(float(p.reachable_width_hours)), F.lit(float(p.window_minutes)))
        cause = (
            F.when(self._u("delivery", *key) < p.delivery_fault_rate, "delivery_fault")
            .when(self._u("skew", *key) < p.clock_skew_rate, "unattributed")
            .when(self._u("responds", *key) >= opens, "timing_gap")
            .when(self._u("upload", *key) < p.upload_fault_rate, "upload_fault")
            .otherwise("on_time")
        )
        prompt = F.format_string("p-%06d", F.col("d").cast("long") * p.users + F.col("n"))
        return rows.select("*", cause.alias("cause"), prompt.alias("prompt_id"))

    @property
    def truth_prompts(self) -> DataFrame:
        return self._prompts().select("prompt_id", "user_id", "cause", F.round("local_hour", 3).alias("local_send_hour")).select(*TRUTH_PROMPTS.names)

    def _followed(self) -> Column:
        """The events of a prompt by its cause: (type, client second, received second, attempt, error), seconds after it was sent."""
        key, window = ("n", "d"), self.p.window_minutes * 60
        s = lambda purpose, low, high: self._seconds(purpose, low, high, *key)
        nothing = F.lit(None)

        def event(kind: str, client: Column, received: Column, attempt: Column | None = None, error: str | None = None) -> Column:
            return F.struct(
                F.lit(kind).alias("kind"), client.cast("long").alias("client"), received.cast("long").alias("received"),
                (nothing if attempt is None else attempt).cast("int").alias("attempt"), F.lit(error).cast("string").alias("error"),
            )

        soon = lambda kind, at, tag, **more: event(kind, at, at + s(tag, 5, 120), **more)
        one = F.lit(1)
        got = s("receipt", 5, 120)
        opened = got + s("opened", 60, max(61, window / 3))
        capture = opened + s("capture", 30, 180)
        begun = capture + s("begun", 20, 120)
        done = begun + s("done", 5, 60)
        done_received = done + s("done received", 5, 120)
        online = F.lit(window) + s("online", 600, 6 * 3600)
        done_late = online + s("done late", 10, 60)
        late_received = done_late + s("late received", 5, 60)
        sent = event("prompt_sent", F.lit(0), F.lit(0))
        receipt = event("prompt_delivered", got, got)
        seen = soon("prompt_opened", opened, "opened received")
        captured = soon("capture_started", capture, "capture received")
        answer = lambda at: event("response_recorded", at, at)
        good = F.array(sent, receipt, seen, captured, soon("upload_started", begun, "begun received", attempt=one), event("upload_completed", done, done_received, one), answer(done_received))
        offline = F.array(
            sent, receipt, seen,
            event("capture_started", capture, online + s("capture online", 1, 5)),
            event("upload_started", begun, online + s("begun online", 5, 10), one),
            event("upload_completed", done_late, late_received, one),
            answer(late_received),
        )
        tries = []
        for k in (1, 2, 3):
            at = begun + (k - 1) * 300 + s(f"try {k}", 0, 60)
            failed = at + s(f"fails {k}", 10, 90)
            tries.append(F.array(soon("upload_started", at, f"try received {k}", attempt=F.lit(k)), soon("upload_failed", failed, f"fail received {k}", attempt=F.lit(k), error="E_NET")))
        failing = F.concat(F.array(sent, receipt, seen, captured), tries[0], tries[1], F.when(self._u("third try", *key) < 0.5, tries[2]).otherwise(F.slice(tries[2], 1, 0)))
        cause = F.col("cause")
        return (
            F.when(cause == "delivery_fault", F.array(sent))
            .when(cause == "timing_gap", F.array(sent, receipt))
            .when((cause == "upload_fault") & (self._u("offline", *key) < 0.5), offline)
            .when(cause == "upload_fault", failing)
            .otherwise(good)
        )

    @property
    def events(self) -> DataFrame:
        """The export: at least once, with its three clocks, in no order."""
        p, client_side = self.p, ("prompt_opened", "capture_started", "upload_started", "upload_failed", "upload_completed")
        base = self._prompts()
        of = base.select("n", "d", "user_id", "cohort_id", "cause", "prompt_id", "sent", F.posexplode(self._followed()).alias("e", "x"))
        of = of.select("n", "d", "e", "user_id", "cohort_id", "cause", "prompt_id", "sent", "x.*")
        skew = F.when((F.col("cause") == "unattributed") & F.col("kind").isin(*client_side), self._seconds("wrong clock", p.clock_skew_min * 60, p.clock_skew_min * 60 + 3600, "n", "d", "e")).otherwise(F.lit(0))
        of = of.withColumn("client", F.col("client") + skew)
        quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
        props = F.concat(
            F.lit('{"prompt_id":'), quoted(F.col("prompt_id")),
            F.when(F.col("kind") == "prompt_sent", F.concat(F.lit(',"cohort_id":'), quoted(F.col("cohort_id")), F.lit(f',"window_minutes":{p.window_minutes}'))).otherwise(F.lit("")),
            F.when(F.col("attempt").isNotNull(), F.concat(F.lit(',"attempt":'), F.col("attempt").cast("string"), F.lit(',"error_code":'), F.coalesce(quoted(F.col("error")), F.lit("null")))).otherwise(F.lit("")),
            F.when(F.col("kind") == "response_recorded", F.concat(F.lit(',"response_id":'), quoted(F.concat(F.lit("r-"), F.substring("prompt_id", 3, 20))))).otherwise(F.lit("")),
            F.lit("}"),
        )
        late = F.when(self._u("late", "n", "d") < p.late_arrival_rate, self._seconds("late by", 3600, max(3601, p.late_arrival_max_hours * 3600), "n", "d", "e")).otherwise(F.lit(0))
        of = of.select("n", "d", "e", "user_id", "kind", "sent", "client", "received", late.alias("late"), props.alias("props"))

        whole, part = int(p.organic_opens_per_day), p.organic_opens_per_day % 1
        number = F.lit(whole) + F.when(self._u("one more", "n", "d") < part, 1).otherwise(0)
        own = base.withColumn("e", F.explode(F.when(number > 0, F.sequence(F.lit(100), F.lit(99) + number)).otherwise(F.array().cast("array<int>"))))
        hour = wrap_hours(F.col("center") + self._normal("organic", "n", "d", "e") * (p.reachable_width_hours / 2))
        zone = F.when(F.col("moves") & (F.date_add("first_day", F.col("d")).cast("timestamp_ntz") >= F.col("moved_at")), F.col("tz2")).otherwise(F.col("tz"))
        opened = F.convert_timezone(zone, F.lit("UTC"), F.date_add("first_day", F.col("d")).cast("timestamp_ntz") + F.make_dt_interval(secs=F.floor(hour * 60) * 60))
        zero = F.lit(0).cast("long")
        own = own.select("n", "d", "e", "user_id", F.lit("app_opened").alias("kind"), opened.alias("sent"), zero.alias("client"), self._seconds("organic received", 5, 120, "n", "d", "e").alias("received"), F.lit(0).alias("late"), F.lit("{}").alias("props"))

        rows = of.unionByName(own)
        again = F.when(self._u("again", "n", "d", "e") < p.duplicate_rate, F.array(F.lit(0).cast("long"), self._seconds("again by", 1, 3600, "n", "d", "e"))).otherwise(F.array(F.lit(0).cast("long")))
        rows = rows.withColumn("more", F.explode(again))
        at = lambda c: F.col("sent") + F.make_dt_interval(secs=c)
        upload = F.col("received") + self._seconds("uploaded", 60, 1800, "n", "d", "e") + F.col("late") + F.col("more")
        return rows.select(
            F.concat_ws("-", F.lit("e"), F.lpad(F.col("n").cast("string"), 6, "0"), "d", "e").alias("insert_id"), F.col("kind").alias("event_type"), "user_id",
            F.concat(F.lit("d-"), F.substring("user_id", 3, 20)).alias("device_id"),
            at(F.col("client")).alias("client_event_time"), at(F.col("received")).alias("server_received_time"), at(upload).alias("server_upload_time"),
            F.col("props").alias("event_properties"),
        ).select(*EVENTS.names)
