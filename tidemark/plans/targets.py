"""Targets in the session's catalog: a database for each, with the published tables; and tables co-located by prompt."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import attribution as att
from tidemark.operators.staging import upload_horizon
from tidemark.params import Params
from tidemark.plans.pipeline import PARTITIONS, WHOLE
from tidemark.sources.landing import drop


def register(spark: SparkSession, root: str, database: str, params: Params | None = None) -> list[str]:
    """The tables under ``root`` as external tables of a database, with their partitions; a second call takes up new ones.

    Schema and partition columns are read from the files. Queries by name then
    prune by the catalog's partitions, without listing folders.
    """
    prefix, names = (params or Params()).schema_prefix, []
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in (*PARTITIONS, *WHOLE):
        table = f"{database}.{name}"
        if not spark.catalog.tableExists(table):
            spark.catalog.createTable(table, path=f"{root}/{prefix}{name}", source="parquet")
        if name in PARTITIONS:
            # folders that came are added, those that went are dropped
            spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        spark.catalog.refreshTable(table)
        names.append(table)
    return names


def drop_target(spark: SparkSession, root: str, database: str, confirm: bool = False) -> None:
    """Drop a target's database and its folder; other targets stay. Only with an explicit yes."""
    if not confirm:
        raise PermissionError(f"{database}: say confirm=True to delete it")
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    drop(spark, root, confirm=True)


class ByPrompt:
    """Prompts and their events, stored in buckets of prompt_id and sorted by it.

    Both tables have the same buckets, so what joins or groups by prompt reads
    bucket by bucket: the attribution of all prompts has no exchange on
    prompt_id. The write shuffles each row once; every later read is free of it.
    Events without a prompt are not in the table (they would all be one bucket):
    the upload horizon is taken when it is written.
    """

    def __init__(self, spark: SparkSession, database: str, path: str, buckets: int = 200):
        self.spark, self.database, self.path, self.buckets = spark, database, path, buckets
        self.horizon: date | None = None

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        # one file a bucket: the shuffle and the buckets share their hash
        out = df.repartition(self.buckets, "prompt_id").write.mode("overwrite").format("parquet").option("path", f"{self.path}/{name}")
        out.bucketBy(self.buckets, "prompt_id").sortBy("prompt_id").saveAsTable(f"{self.database}.{name}")
        return self.spark.table(f"{self.database}.{name}")

    def write(self, prompts: DataFrame, stg: DataFrame) -> ByPrompt:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        self.horizon = upload_horizon(stg).first()["horizon"]
        self._write(prompts, "prompts_by_prompt")
        self._write(stg.filter("prompt_id IS NOT NULL"), "events_by_prompt")
        return self

    @property
    def prompts(self) -> DataFrame:
        return self.spark.table(f"{self.database}.prompts_by_prompt")

    @property
    def events(self) -> DataFrame:
        return self.spark.table(f"{self.database}.events_by_prompt")

    def attribution(self, params: Params | None = None) -> DataFrame:
        return att.attribution(self.prompts, self.events, params, horizon=self.horizon)
