"""The models driven by a stream: each micro-batch lands its upload days and refreshes the tables.

Late data is a matter of the lookback, not of a watermark: a batch may bring
any upload day, and the models rewrite the local dates inside the lookback.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.params import Params
from tidemark.plans.pipeline import refresh
from tidemark.sources.landing import _exists, drop, land
from tidemark.sources.schemas import EVENTS, TIME_FORMAT


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("timestampNTZFormat", TIME_FORMAT).json(folder)


def start(stream: DataFrame, dim: DataFrame, root: str, checkpoint: str, params: Params | None = None) -> StreamingQuery:
    """Append each batch to the raw days it touches, then refresh. A batch that is run again adds nothing: whole rows are distinct."""
    params = params or Params()

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        path = f"{root}/raw_events"
        df = df.select(*EVENTS.names)
        if _exists(spark, path):
            raw = spark.read.parquet(path)
            days = [r[0] for r in df.select(F.to_date("server_upload_time")).distinct().collect()]
            df = raw.filter(F.col("upload_date").isin(days)).select(*EVENTS.names).unionByName(df).distinct() if days else df
        copy = f"{root}/batches/{number}"
        df.write.mode("overwrite").parquet(copy)  # the days are overwritten: read them to the end first
        land(spark, spark.read.schema(EVENTS).parquet(copy), path)
        refresh(spark, spark.read.parquet(path), dim, root, params)
        drop(spark, copy, confirm=True)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
