from __future__ import annotations

import random

import brute
import pytest
from pyspark.sql import functions as F

from footfall.llm import decontaminate


def fixture(rng):
    vocabulary = [a + b for a in ("ba", "do", "ki", "lu") for b in ("ran", "sel", "tik", "é")] + ["the", "of"]
    def text(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [(k, " ".join(text(rng.randrange(5, 70)))) for k in range(30)]
    items += [(100, None), (101, ""), (102, "two words"), (103, "same same same same same same same same"), (104, items[0][1]), (105, "x " * 300)]
    docs = []
    for k in range(250):
        w = text(rng.randrange(0, 150))
        if rng.random() < 0.6:
            leak = items[rng.randrange(30)][1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 6])):  # edits
                at = rng.randrange(len(leak))
                leak = rng.choice([leak[:at] + ["edit"] + leak[at + 1:], leak[:at] + leak[at + 1:], leak[:at] + ["more"] + leak[at:], leak[: len(leak) - 1], leak[1:]]) or ["gone"]
            at = rng.randrange(len(w) + 1)
            w = w[:at] + leak + w[at:]
        sep = rng.choice([" ", "  ", ", ", "\n"])
        docs.append((k, sep.join(x.upper() if rng.random() < 0.1 else x for x in w)))
    docs += [(900, None), (901, ""), (902, "Two, words!"), (903, "two words more"), (904, "same " * 40), (905, items[3][1]), (905, items[4][1])]
    docs += [(906, " ".join(i[1] for i in items[:30]) + " tail" * 10), (907, (items[5][1] + " ") * 40), (908, "x " * 301), (None, items[6][1])]
    return docs, items


@pytest.mark.parametrize("block_shingles", [decontaminate.BLOCK_SHINGLES, 100])
def test_against_all_windows(spark, block_shingles):
    docs, items = fixture(random.Random(3))
    frame = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, item_id int")
    bench = spark.createDataFrame([(*r, "a") for r in items], "item_id bigint, text string, n string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame, bench, block_shingles=block_shingles).collect()}
    assert got == brute.leaks(docs, items)


def test_similarity_is_that_of_the_best_window(spark):
    docs, items = fixture(random.Random(4))
    frame, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    texts, wanted = {d: t for d, t in docs if d != 905}, dict(items)
    for r in decontaminate.contaminated(frame, bench).collect():
        if r.doc_id in texts:
            assert r.similarity == pytest.approx(brute.best_window(brute.shingles(texts[r.doc_id]), brute.shingles(wanted[r.item_id])))


def test_items_without_an_id(spark):
    a, b = " ".join(f"a{k}" for k in range(20)), " ".join(f"b{k}" for k in range(20))
    docs = [(1, f"x {a} y"), (2, f"{b} y"), (3, f"{a} x {b}"), (4, "clean " * 30)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame([(None, a), (None, b), (None, b), (None, None), (7, a), (8, "other " * 9)], "item_id bigint, text string")
    for block_shingles in (decontaminate.BLOCK_SHINGLES, 20):
        got = [(r.doc_id, r.item_id, r.start) for r in decontaminate.contaminated(frame, bench, block_shingles=block_shingles).collect()]
        assert sorted(got, key=str) == sorted([(1, None, 1), (1, 7, 1), (2, None, 0), (3, None, 0), (3, 7, 0), (3, None, 21)], key=str)
    assert [r.doc_id for r in decontaminate.drop_contaminated(frame, bench.filter("item_id IS NULL")).collect()] == [4]


def test_short_items_inside_documents(spark):
    items = [(1, "Yes"), (2, "two words"), (3, "we saw it"), (4, "to be or not"), (None, "or not"), (5, "one two three four five"), (6, ""), (7, "to be nowhere")]
    docs = [(1, "yes"), (2, "x two, WORDS y two words"), (3, "two other words"), (4, "it is to be or not to be"), (5, "zero one two three four five six"), (6, "we saw"), (7, None), (8, "words two yesterday")]
    frame, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = [(1, 1, 0), (2, 2, 1), (4, 4, 2), (4, None, 4), (5, 5, 1)]
    for block_shingles in (decontaminate.BLOCK_SHINGLES, 10):
        got = decontaminate.contaminated(frame, bench, block_shingles=block_shingles, short_inside=True).collect()
        assert sorted(((r.doc_id, r.item_id, r.start) for r in got), key=str) == sorted(want, key=str)
        assert {(r.similarity, r.bits) for r in got} == {(1.0, 0)}
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(frame, bench, short_inside=True).collect()) == [3, 6, 7, 8]


def test_query_finds_short_items(spark, tmp_path):
    from footfall.llm import queries

    spark.createDataFrame([(1, "x two words y"), (2, "clean")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "two words")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [(r.doc_id, r.item_id) for r in queries.benchmark_decontamination(spark, str(tmp_path)).collect()] == [(1, 1)]


def indexed(spark, bench, threshold=0.8):
    items = bench.select("item_id", decontaminate.shingles(F.col("text")).alias("item"))
    items = items.withColumn("n", F.size("item")).withColumn("item_print", decontaminate.fingerprint("item"))
    return decontaminate._seeds(items.withColumn("_item", F.xxhash64("item_id", "item")), threshold)


def test_the_index_selects(spark):
    """With 1,000 unrelated items of one size a window meets rows of its own item only, and only documents
    that hold an item have windows."""
    rng = random.Random(8)
    items = [(k, " ".join(f"w{rng.randrange(5000)}" for _ in range(30))) for k in range(1000)]
    docs = [(k, " ".join(f"w{rng.randrange(5000)}" for _ in range(200)) + (f" {items[k][1]} " if k % 10 == 0 else " ") + "tail") for k in range(300)]
    frame, bench = spark.createDataFrame(docs, "_doc bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    rows = frame.select("_doc", F.lit(0).alias("_text"), decontaminate.shingles(F.col("text")).alias("hashes"))
    index = indexed(spark, bench).cache()
    windows = decontaminate._windows(rows, index, 0.8).cache()
    assert {r._doc for r in windows.select("_doc").distinct().collect()} == set(range(0, 300, 10))
    assert windows.count() < 30 * 15
    met = decontaminate._met(windows, index, 23)
    per_window = met.groupBy("_doc", "_item", "start").count().agg(F.max("count")).first()[0]
    assert per_window <= 24 and met.count() <= 24 * windows.count()
    assert met.filter("first AND bits <= 23").select("_doc").distinct().count() == 30


def test_a_shingle_of_all_items_is_no_seed(spark):
    shared = "answer the question below in one word or two"
    items = [(k, f"{shared} " + " ".join(f"q{k}x{j}" for j in range(40))) for k in range(200)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    seeds = indexed(spark, bench).select("item_id", F.explode("seeds").alias("h"))
    assert seeds.groupBy("h").count().agg(F.max("count")).first()[0] == 1
    docs = [(k, f"intro {text} outro") for k, text in items[:20]] + [(500, f"{shared} " * 30)]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), bench)
    assert sorted((r.doc_id, r.item_id, r.start) for r in found.collect()) == [(k, k, 1) for k in range(20)]


def test_blocks_cover_the_fingerprint():
    for radius in (0, 3, 10, 23, 40):
        masks = [m % (1 << 64) for m in decontaminate._masks(radius)]
        assert len(masks) == radius + 1 and sum(masks) == (1 << 64) - 1


def test_fingerprint(spark):
    rng = random.Random(1)
    rows = [([rng.getrandbits(63) - (1 << 62) for _ in range(n)],) for n in (1, 2, 3, 40, 500)]
    frame = spark.createDataFrame(rows, "h array<bigint>")
    for (h,), r in zip(rows, frame.select(decontaminate.fingerprint("h").alias("p")).collect()):
        assert r.p % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_drop(spark):
    docs, items = fixture(random.Random(5))
    frame = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, _text int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontaminate.drop_contaminated(frame, bench)
    assert out.columns == frame.columns
    bad = {(d, t) for d, t in docs if any(x == d for x, _ in brute.leaks([(d, t)], items))}
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(str(x) for x in docs if x not in bad)
    assert decontaminate.drop_contaminated(frame.limit(0), bench).count() == 0
    assert decontaminate.drop_contaminated(frame, bench.limit(0)).count() == len(docs)


def test_no_python_and_no_text_in_a_shuffle(spark):
    docs, items = fixture(random.Random(6))
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert F is not None
