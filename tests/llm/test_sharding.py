from __future__ import annotations

import itertools
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from footfall.llm import sharding


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 2), (4, 2)])
def test_the_curve_visits_every_cell_in_steps_of_one(spark, dims, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    frame = spark.createDataFrame(cells, [f"c{k}" for k in range(dims)])
    index = sharding.curve_index([F.col(f"c{k}").cast("int") for k in range(dims)], bits)
    rows = sorted((r[dims], tuple(r[:dims])) for r in frame.select("*", index).collect())
    assert [r[0] for r in rows] == list(range(len(cells)))
    for (_, a), (_, b) in zip(rows, rows[1:]):
        assert sum(abs(x - y) for x, y in zip(a, b)) == 1


def documents(n, rng):
    rows = [(k, rng.choice(["hot", "hot", f"s{k % 9}"]), rng.choice(["en", "de", None]), "word " * rng.randrange(0, 300)) for k in range(n)]
    return rows + [(None, None, None, None), (3, "hot", "en", "again"), (3, "hot", "en", "again"), (n, "hot", "en", "")]


@pytest.mark.parametrize("n, shards", [(500, 40), (10, 40), (1000, 7)])
def test_rows_law(spark, n, shards):
    rows = documents(n, random.Random(n))
    frame = spark.createDataFrame([(d, s, g, t, 1) for d, s, g, t in rows], "doc_id bigint, source string, lang string, text string, shard int")
    out = sharding.curve_shards(frame.repartition(6), shards).collect()
    want = sorted(((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, _, _, t in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=str) == want
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(slots.get(k, [])) for k in range(shards)]
    assert max(counts) - min(counts) <= 1
    ordered = sorted(out, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in out)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, source string, lang string, text string")
    assert sharding.curve_shards(none).count() == 0


def test_written_shards_hold_all_rows_in_order(spark, tmp_path):
    rows = documents(300, random.Random(9))
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string")
    path = str(tmp_path / "shards")
    sharding.write_shards(frame, path, 5)
    back = spark.read.parquet(path)
    assert sorted(map(str, back.select(*frame.columns).collect())) == sorted(map(str, frame.collect()))
    placed = {(r.doc_id, r.text_hash): r.shard for r in sharding.curve_shards(frame, 5).collect()}
    for r in back.withColumn("h", F.xxhash64("text")).collect():
        assert r.doc_id == 3 or placed[r.doc_id, r.h] == r.shard


def opened(rows, key, shards=40):
    """Per value the shards that a reader opens who knows smallest and largest values only."""
    spans = defaultdict(list)
    for r in rows:
        spans[r.shard].append(key(r))
    spans = {k: (min(v), max(v)) for k, v in spans.items()}
    return [sum(low <= x <= high for low, high in spans.values()) for x in {key(r) for r in rows}]


def test_smallest_and_largest_values_prune_on_any_dimension(spark):
    rng = random.Random(4)
    rows = [(k, f"s{rng.randrange(12)}", rng.choice(["en", "de", "fr", "es"]), "word " * (4 ** rng.randrange(1, 6))) for k in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string")
    out = sharding.curve_shards(frame, 40).join(frame.drop("text"), "doc_id").collect()
    for key in (lambda r: r.source, lambda r: r.lang, lambda r: r.size, lambda r: r.doc_id // 1000):
        met = opened(out, key)
        assert sum(met) / len(met) < 26  # of 40; by chance nearly all


@pytest.mark.parametrize("bits", [3, 5])
def test_given_documents_prune(spark, bits):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source", "lang", "text")
    out = sharding.curve_shards(docs, 40, bits).join(docs.drop("text"), "doc_id").collect()
    for key, most in ((lambda r: r.source, 20), (lambda r: r.lang, 26)):
        met = opened(out, key)
        print(sum(met) / len(met))
        assert sum(met) / len(met) < most  # of 40


def test_cells_keep_the_order_of_the_values(spark):
    names = [None, "", "a", "https://a.example/x", "https://a.example/y", "https://b.example", "é", "z" * 40]
    for values in (names, names[3:6], [None], ["same"] * 3):
        frame = spark.createDataFrame([(k, v, v, "t") for k, v in enumerate(values)], "doc_id bigint, source string, lang string, text string")
        cells = [r.c for r in frame.orderBy(F.col("source").asc_nulls_first()).select(sharding.coordinates(frame, F.lit(16))[0].alias("c")).collect()]
        assert cells == sorted(cells) and len(set(cells)) >= min(2, len(set(values)))
