"""The SQL against brute force, on the smallest table."""

import duckdb
import pytest
from tidemark.llm import op3_decontaminate, op5_substrings, op8_jaccard, op12_spelling, op13_divergence, oracles

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_sql_is_brute_force(name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    got = sorted(con.execute(oracles.SQL[name]).fetchall(), key=str if name.startswith("op12") else None)
    if name.startswith("op3"):
        some = sorted(docs, key=lambda r: len(r[1] or ""))[:160]  # brute force compares all places: long texts take too long
        assert [x for x in got if x[0] in dict(some)] == sorted(op3_decontaminate.reference(some, items))
    elif name.startswith("op12"):
        assert sorted(got, key=lambda r: r[0]) == op12_spelling.reference(docs)
    elif name.startswith("op13"):
        assert got == op13_divergence.reference(con.execute("SELECT text, lang, source FROM documents").fetchall())
    else:
        assert got == sorted((op5_substrings if name.startswith("op5") else op8_jaccard).reference(docs))
