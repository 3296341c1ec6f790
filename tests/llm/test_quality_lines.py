from __future__ import annotations

import hashlib
import random

import brute
from pyspark.sql import functions as F

from footfall.llm import common, lines, quality


def texts(rng):
    vocabulary = ["the", "Ab", "çé", "longerword", "x#", "|", "STOP", "a,b"]
    out = [None, "", " \n\t ", "one", "A B \x0b c", "#*$%&|<>", "x" * 400 + " y" * 30]
    for _ in range(80):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.4:
            w += w[:rng.randrange(1, 30)] * rng.randrange(1, 4)
        out.append("".join(x + rng.choice([" ", "  ", "\n", "\t", "\r\n"]) for x in w))
    out.append("go on " * 3000 + "and then stop " * 9)
    return out


def test_ledger(spark):
    rows = list(enumerate(texts(random.Random(1)))) + [(None, "null id"), (3, "repeated id"), (3, "repeated id")]
    frame = spark.createDataFrame([(*r, 5, 7) for r in rows], "doc_id bigint, text string, n_words int, failed int")
    ledger = quality.ledger(frame).collect()
    names = list(brute.measures(""))
    got = sorted(((r.doc_id, *(r[n] for n in names), r.failed) for r in ledger), key=str)
    want = []
    for doc, text in rows:
        m = brute.measures(text)
        want.append((doc, *m.values(), sum(quality.BIT[f] for f in brute.failed(m))))
    assert got == sorted(want, key=str)


def test_policies_and_ablation(spark):
    rows = list(enumerate(texts(random.Random(2))))
    ledger = quality.ledger(spark.createDataFrame(rows, "doc_id bigint, text string"))
    bad = {doc: set(brute.failed(brute.measures(t))) for doc, t in rows}
    kept = {r.doc_id for r in quality.apply_policy(ledger, quality.BASE).filter("kept").collect()}
    assert kept == {d for d, f in bad.items() if not f & set(quality.BASE.rules)}
    got = {r.rule: (r.failing, r.rejected_by_it_alone) for r in quality.ablation(ledger, quality.CURRENT).collect()}
    assert got == {
        rule: (sum(rule in f for f in bad.values()), sum(f == {rule} for f in bad.values())) for rule in quality.RULES
    }


def test_keep_good(spark):
    rows = list(enumerate(texts(random.Random(3))))
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, kept int")
    out = quality.keep_good(frame)
    assert out.columns == frame.columns
    assert sorted(r.doc_id for r in out.collect()) == [d for d, t in rows if not brute.failed(brute.measures(t))]
    assert quality.keep_good(frame.limit(0)).count() == 0
    assert "Exchange" not in out._jdf.queryExecution().toString()


def line_rows(rng):
    pool = ["Common line of many documents", "  common LINE of many documents \t", "short", "tiny", "Ünïcode line ÄÖ", "unique", ""]
    rows = [(k, "\n".join(rng.choice(pool) + (str(k) if rng.random() < 0.3 else "") for _ in range(rng.randrange(1, 9)))) for k in range(60)]
    return rows + [
        (100, None), (101, ""), (102, "\n\n"), (7, rows[7][1]), (8, "Common line of many documents\nother"),
        (None, "Common line of many documents\nnobody's line"), (None, "nobody's line"), (103, " Common line of many documents"),
        (104, "\n".join(["Common line of many documents"] * 5000 + ["end"])),
    ]


def test_line_dedup(spark):
    rows = line_rows(random.Random(1))
    frame = spark.createDataFrame([(*r, 3, "z") for r in rows], "doc_id bigint, text string, pos int, first string")
    out = lines.dedup_lines(frame)
    assert out.columns == [*frame.columns, "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in out.collect()), key=str)
    assert got == sorted(brute.dedup_lines(rows), key=str)
    for least, most in ((1, 1), (10, 5)):
        some = lines.dedup_lines(frame, least, most).collect()
        assert sorted(((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in some), key=str) == sorted(brute.dedup_lines(rows, least, most), key=str)


def test_line_dedup_keeps_null_texts_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    assert lines.dedup_lines(frame).first().text is None
    assert lines.dedup_lines(frame.limit(0)).count() == 0


def test_digest(spark):
    frame = spark.createDataFrame([(1, "a line that repeats\nx"), (2, "A LINE that repeats\ny")], "doc_id bigint, text string")
    out = lines.dedup_lines(frame).select("doc_id", F.sha2("text", 256).alias("s")).collect()
    assert {r.doc_id: r.s for r in out} == {
        1: hashlib.sha256(b"a line that repeats\nx").hexdigest(), 2: hashlib.sha256(b"y").hexdigest(),
    }


def test_window_hashes(spark):
    rows = [(["a", "b"] * 20 + ["c", "a", "b"],), ([],), (["x"],), (["a", "b", "a"],)]
    for width in (1, 2, 3, 5, 7, 8):
        out = spark.createDataFrame(rows, "w array<string>").select("w", common.window_hashes(F.col("w"), width).alias("h")).collect()
        runs = [(tuple(r.w[i:i + width]), h) for r in out for i, h in enumerate(r.h)]
        assert [len(r.h) for r in out] == [max(0, len(r.w) - width + 1) for r in out]
        assert len({x for x, _ in runs}) == len(set(runs)) == len({h for _, h in runs})
