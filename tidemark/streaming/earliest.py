"""The earliest copy of each event as a stream with state.

For each insert_id the state holds the copy that was uploaded, received, made
first among those seen. A copy that is earlier than the held one replaces it
and is passed on; others are dropped. So whatever the order of the batches, the
last row passed on for an event is its earliest copy. State is kept until the
watermark (on the upload time) has passed the held copy's upload by the
lookback; a copy that comes later than that is dropped, as the models no longer rewrite its dates.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.staging import dedupe_earliest
from tidemark.params import Params
from tidemark.session import configure
from tidemark.sources.schemas import EVENTS

CLOCKS = ["server_upload_time", "server_received_time", "client_event_time"]
#: Naive times travel as microseconds, in a session pinned to UTC.
MICROS = {"client_event_time": "client_us", "server_received_time": "received_us", "server_upload_time": "upload_us"}
KEPT = ("event_type", "user_id", "device_id", "event_properties", *MICROS.values())
STATE = "event_type string, user_id string, device_id string, event_properties string, client_us long, received_us long, upload_us long"
ORDER = ["upload_us", "received_us", "client_us", "event_properties"]


def _earliest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, lookback_ms: int) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    best = None
    for frame in frames:
        row = frame.sort_values(ORDER, kind="stable", na_position="first").iloc[0]
        row = tuple(None if pd.isna(row[c]) else int(row[c]) if c.endswith("_us") else row[c] for c in KEPT)
        best = row if best is None else min(best, row, key=_order)
    held = state.get if state.exists else None
    if best is None or (held is not None and _order(held) <= _order(best)):
        return
    state.update(best)
    # never before the watermark: a copy that the watermark has let pass is held for a moment at least
    state.setTimeoutTimestamp(max(best[KEPT.index("upload_us")] // 1000 + lookback_ms, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame([(*key, *best)], columns=["insert_id", *KEPT])


def _order(row: tuple) -> tuple:
    at = dict(zip(KEPT, row, strict=True))
    return tuple((at[c] is not None, at[c]) for c in ORDER)


def earliest_copies(stream: DataFrame, params: Params | None = None) -> DataFrame:
    """A stream of events as a stream of copies, each earlier than those passed on before for its event."""
    configure(stream.sparkSession)
    days = (params or Params()).lookback_days
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = stream.select("insert_id", "event_type", "user_id", "device_id", "event_properties", *[micros(c).alias(us) for c, us in MICROS.items()], F.col("server_upload_time").cast("timestamp").alias("uploaded"))
    rows = rows.withWatermark("uploaded", f"{days} days")
    out = rows.groupBy("insert_id").applyInPandasWithState(
        lambda key, frames, state: _earliest(key, frames, state, days * 86_400_000), f"insert_id string, {STATE}", STATE, "update", GroupStateTimeout.EventTimeTimeout
    )
    back = {us: F.timestamp_micros(us).cast("timestamp_ntz").alias(c) for c, us in MICROS.items()}
    return out.select("insert_id", "event_type", "user_id", "device_id", *[back[us] for us in MICROS.values()], "event_properties").select(*EVENTS.names)


def start(stream: DataFrame, path: str, checkpoint: str, params: Params | None = None) -> StreamingQuery:
    """Append what is passed on to a table: a batch that is run again replaces its own folder."""

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return earliest_copies(stream, params).writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(updates: DataFrame) -> DataFrame:
    """The earliest copy of each event from the rows passed on."""
    return dedupe_earliest(updates.select(*EVENTS.names))
