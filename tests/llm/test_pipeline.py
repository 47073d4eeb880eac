"""The pipeline, stage by stage on its own input, against brute force."""

import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tidemark.llm import op3_decontaminate, op8_jaccard
from tidemark.llm.tokens import Encoder, vocabulary_path

from .test_operators import CLASHES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{base}/{name}")
        out.append((docs, spark.read.parquet(f"{base}/{name}")))
        docs = out[-1][1]
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_columns_and_order_of_operators(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "source_mixing", "token_output"]
    for before, after in stages[:-1]:
        assert after.dtypes == before.dtypes and texts(after).items() <= texts(before).items()


def test_language_keeps_clean_documents(stages):
    before, after = map(texts, stages[0])
    assert all(len(before[i].split()) < 20 for i in before.keys() - after.keys())


def test_near_duplicates(stages):
    before, after = map(texts, stages[1])
    assert sorted(after) == sorted({c for _, _, c in op8_jaccard.reference(sorted(before.items()))})


def test_decontamination(spark, stages):
    before, after = map(texts, stages[2])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert sorted(after) == sorted(x[0] for x in op3_decontaminate.reference(list(before.items()), items) if not x[5])


def test_mixing_and_tokens_follow_one_order(spark, stages):
    before, after = map(texts, stages[3])
    assert before == after
    docs = stages[4][0]
    placed = docs.select("doc_id", "source", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()
    e, start = Encoder(vocabulary_path()), 0
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in stages[4][1].collect()}
    assert len(got) == len(placed)
    for r in placed:
        ids = e.whole(after[r["doc_id"]]) + bytes(4)
        assert got[r["doc_id"]] == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert len({r["source"] for r in placed[:64]}) > 1


def odd_documents(spark):
    rows = [(1, "The cat sat on the mat and looked at the moon for a long while", "en", "a"), (1, "The cat sat on the mat and looked at the moon for a long while", "en", "a"), (None, "The dog ran over the hill and into the old town", "en", None)]
    rows += [(2, None, None, "a"), (3, "", "en", "b"), (4, "12 34 !!", None, "b"), (5, "the moon " * 20_000, "en", "b"), (6, "The cat sat on the mat and looked at the moon for a long while", None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return docs.withColumns({c: F.lit(i) for i, c in enumerate(CLASHES) if c not in ("doc", "text")} | {"a.b": F.lit("x"), "m": F.create_map(F.lit("x"), F.lit(1))})


def test_every_stage_on_odd_rows_and_on_none(spark, tmp_path):
    docs = odd_documents(spark)
    for k, start in enumerate((docs, docs.limit(0))):
        at = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, at, SMALL)
            out.write.parquet(f"{tmp_path}/{k}-{name}")
            after = spark.read.parquet(f"{tmp_path}/{k}-{name}")
            if name != "token_output":
                assert after.dtypes == docs.dtypes, name
                at = after
            ids = sorted(str(r["doc_id"]) for r in after.collect())
            want = {"language_id": ["1", "1", "5", "6", "None"], "near_duplicates": ["1", "5", "None"]}.get(name, ["1", "5", "None"])
            assert ids == (want if k == 0 else []), name


def test_mixing_stage_keeps_to_its_shares(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"), F.when(F.col("id") % 10 < 9, "big").otherwise("small").alias("source"), F.lit(5).cast("long").alias("n_chars"))
    sources = [r["source"] for p in corpus_pipeline.source_mixing(spark, docs, SMALL).select("source", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i")).orderBy("p", "i").collect() for r in [p]]
    share = 400**0.5 / (400**0.5 + 3600**0.5)
    for n in range(0, 1600, 16):  # less than one block of 16 from the target while both sources last
        assert abs(sources[:n].count("small") - n * share) < 16


def test_run_leaves_only_what_its_result_reads(spark):
    import os

    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 0
    left = {x.split("-")[1] for x in set(os.listdir(base)) - before}
    assert left <= {"source_mixing", "tokens", "decontamination"} | {"matches"}, left
