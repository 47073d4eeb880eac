"""The registered queries on an empty table and on rows with nothing in them: one row for each row, of the defined values."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries

#: What a row with a null or empty text gives, of the columns that do not depend on formats.
NOTHING = {
    "op2_language_id": {"lang_pred": "und", "score": 0.0},
    "op3_decontamination": {"n_words": 0, "n_hit": 0, "n_items": 0, "contaminated": False},
    "op5_substring_dedup": {"n_words": 0, "n_removed": 0},
    "op6_token_output": {"n_tokens": 1},
    "op7_license_scan": {"n_matches": 0},
    "op8_jaccard_join": {"n_shingles": 0},
    "op9_secret_scan": {"n_assign": 0, "n_access": 0, "n_hex": 0, "spans": ""},
    "op10_media_columns": {"n_bytes": 0, "payload_bytes": 64},
    "op11_simhash_dedup": {"fingerprint": "0" * 16, "component_id": 1},
}


def _folder(spark, path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs.withColumns({"n": F.array(F.lit(1)), "a.b": F.lit(1)}).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([("1", "one two three")], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return _folder(spark, tmp_path_factory.mktemp("empty"), [])


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    rows = [(1, None, None, None), (1, None, None, None), (2, "", "s", "en"), (None, "", "s", None), (None, None, None, "en")]
    return _folder(spark, tmp_path_factory.mktemp("nothing"), rows)


@pytest.mark.parametrize("name", sorted(NOTHING))
def test_empty_table(spark, empty, name):
    assert queries.queries()[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(NOTHING))
def test_rows_with_nothing(spark, nothing, name):
    got = queries.queries()[name](spark, nothing).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "2", "None", "None"]
    assert [{k: r[k] for k in NOTHING[name]} for r in got] == [NOTHING[name]] * 5


def test_mixing_of_nothing(spark, empty, nothing):
    assert queries.op4_source_mixing(spark, empty).collect() == []
    queries.op4_source_mixing(spark, nothing).collect()
