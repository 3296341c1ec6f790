from __future__ import annotations

import duckdb
import brute
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from footfall.llm import queries

SMALL = "/root/testdata/sf0.001"


def test_pipeline_against_plain_python(spark):
    con = duckdb.connect()
    rows = con.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
    items = con.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    good = [r for r in rows if not brute.failed(brute.measures(r[1]))]
    lines = [(doc, text) for doc, text, _, _ in brute.dedup_lines(good)]
    groups = brute.near_groups([brute.fingerprint(t) for _, t in lines])
    first = {}
    for (doc, text), g in zip(lines, groups):
        first.setdefault(g, (doc, text))
    single = list(first.values())
    bad = {doc for doc, _ in brute.leaks(single, items)}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {doc: len(library.encode(text, add_special_tokens=False).ids) + 1 for doc, text in single if doc not in bad}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: r.doc_tokens for r in got} == want
    for doc, n in want.items():
        assert sum(r.length for r in got if r.doc_id == doc) == n


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).dtypes == docs.dtypes


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SMALL)
    want = con.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
