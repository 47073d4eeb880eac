"""A corpus from documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``.

Edge cases, the same for all stages: an empty table stays empty; further columns
of any name and type pass through to the last stage; repeated rows are judged
alike, and of those with the same id and text near_duplicates leaves one. A null
or empty text goes at language_id (no language); a null id is kept by all stages
and comes first in the token files' metadata; a null source is a source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import op2_language, op3_decontaminate, op4_mixing, op6_token_files, op8_jaccard
from tidemark.llm.common import deleted, noted, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or like no language's profile, go."""
    profiles = op2_language.fit(docs.filter(~op2_language.held_out()))
    return op2_language.keep_identified(docs, profiles)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, similarity 0.75) stays: the least id."""
    return op8_jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    return op3_decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; their order in the files interleaves the sources by their target weights."""
    return op4_mixing.in_mixed_order(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the files that are read, and what a read of them shows of each document."""
    return op6_token_files.token_files(docs, order=op6_token_files.file_order(docs))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: Language profiles, encodings and schedules are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over ``documents``. What a stage leaves behind in the shared folder is deleted
    as soon as the next stage's input is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with noted() as made:
            docs = written(stage(spark, docs, sf_dir), name)
        deleted(spark, before + made[:-1])  # the last path is the stage's output
        before = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
