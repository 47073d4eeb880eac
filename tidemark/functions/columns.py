"""Column helpers: the scalar functions whose exact contract the models depend on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 6.283185307179586


def json_value(text: Column | str, key: str) -> Column:
    """A top-level scalar as string; a JSON null and a missing key are NULL."""
    return F.get_json_object(text, f"$.{key}")


def json_values(text: Column | str, *keys: str) -> Column:
    """Top-level scalars as a struct of strings, from one parse of the text; a JSON null, a missing key and what is no JSON object are NULL."""
    return F.from_json(text, ", ".join(f"`{k}` string" for k in keys))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole-second boundaries crossed from start to end (negative if end is earlier), whatever the session's zone."""
    return naive_seconds(end) - naive_seconds(start)


def naive_seconds(ts: Column | str) -> Column:
    """Whole seconds of a naive time since 1970, rounded down, from its own calendar fields: no zone is asked."""
    return F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(end, start)


def to_local(ts: Column | str, zone: Column | str) -> Column:
    """A naive UTC time as naive local time in a zone that may differ by row."""
    return F.convert_timezone(F.lit("UTC"), F.col(zone) if isinstance(zone, str) else zone, ts)


def ratio(n: Column, d: Column) -> Column:
    """Float division; NULL if the denominator is 0 or NULL."""
    return F.try_divide(n.cast("double"), d.cast("double"))


def wrap_hours(x: Column) -> Column:
    """Onto [0, 24)."""
    return x - F.lit(24.0) * F.floor(x / F.lit(24.0))


def short_arc(d: Column) -> Column:
    """A difference of hours as the short way round, in [-12, 12)."""
    return d - F.lit(24.0) * F.floor((d + F.lit(12.0)) / F.lit(24.0))


def circular_distance(a: Column, b: Column) -> Column:
    """Hours between two times of day, in [0, 12]."""
    return F.abs(short_arc(a - b))


def open_probability(hour: Column, center: Column, width: Column, window_minutes: Column) -> Column:
    """0.9 inside the reachable window, decaying with the hours outside it; a window under an hour lowers it in proportion."""
    outside = F.greatest(F.lit(0.0), circular_distance(hour, center) - width / F.lit(2.0))
    return F.lit(0.9) * F.exp(-outside) * F.least(F.lit(1.0), window_minutes / F.lit(60.0))


def version_number(version: Column) -> Column:
    """The number of a ``v<int>`` version; any other shape raises when it is read."""
    number = F.regexp_extract(version, r"^v(\d+)$", 1)
    return F.when(number != "", number.cast("long")).otherwise(F.raise_error(F.concat(F.lit("model_version must be v<int>: "), F.coalesce(version, F.lit("null")))))


def marked(*columns: Column) -> Column:
    """The columns as one text, with a mark for NULL, so that different rows differ."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("<null>")) for c in columns])
