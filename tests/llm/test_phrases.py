from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import phrases


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, least, top, cover=100):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if a >= least}
        best = []
        for p, a in found.items():
            if len(p) == 1:
                continue
            longer = [q for q in found if len(q) > len(p) and 100 * found[q] >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if longer:
                continue
            cuts = [(1000 * a * n[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            best.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(rng, n):
    vocabulary = [f"w{k}" for k in range(30)]
    fixed = ["New York City", "in terms of the", "a b a b a b", "é ñ", "over and over and over"]
    rows = []
    for _ in range(n):
        w = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))]
        text = "".join(x + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ", "]) for x in w)
        rows.append((text, rng.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", None), ("lone", "fr"), ("x y " * 500, "es"), ("\x1c\x0b\x0c \x85 a", "de")]


@pytest.mark.parametrize("least, top, shards, bits, chunk, at_once, cover", [
    (5, 2000, 4, 1 << 16, 1 << 20, 1 << 22, 100), (5, 2000, 3, 64, 40, 100, 100), (20, 7, 1, 1 << 12, 200, 50, 60), (3, 2000, 2, 1 << 10, 100, 1 << 22, 100),
])
def test_against_all_windows(spark, least, top, shards, bits, chunk, at_once, cover):
    """Also with a filter so small that it takes everything, and with chunks of a few words."""
    rows = corpus(random.Random(least + shards), 250)
    frame = spark.createDataFrame([(*r, 1, "p") for r in rows], "text string, lang string, n int, phrase string").repartition(6)
    out = phrases.collocations(frame, top, least, cover, shards, bits, chunk, at_once).collect()
    assert sorted(map(tuple, out)) == brute(rows, least, top, cover)


def test_every_phrase_is_counted_in_one_cycle_from_its_activation(spark, monkeypatch):
    """Scans interleave: longer phrases start in the middle of the first cycle, and rest after one."""
    rows = [("hot pot soup now. " * 40, "en")] * 8 + [("rare bird flies here. " * 15, "en")] + [("filler words of no use", "en")] * 40
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(8)
    seen = defaultdict(list)
    plain = phrases.scan

    def scan(shard, filters, first, at_once):
        out = plain(shard, filters, first, at_once).cache()
        for r in out.select(F.col("phrase").cast("string").alias("phrase")).distinct().collect():
            seen[r.phrase].append(len(steps))
        steps.append(first)
        return out

    steps: list[bool] = []
    monkeypatch.setattr(phrases, "scan", scan)
    stored = phrases.store_shards(frame, 4, 100)
    found = {r.phrase: r.n for r in phrases.frequent_phrases(stored, 10, 4, 1 << 12).collect()}
    assert found["hot pot soup now"] == 320 and found["rare bird"] == 15 and "filler words of no use" in found
    assert min(seen["hot pot"]) < 4, "longer phrases wait for no full cycle"
    assert all(max(at) - min(at) < 4 for at in seen.values())
    assert steps[:4] == [True] * 4 and not any(steps[4:])


def test_large_numbers_are_exact(spark, monkeypatch):
    big = 3 * 10**15 + 1
    counts = [("en", "a", big), ("en", "b", big - 2), ("en", "a b", big - 7)]
    frame = spark.createDataFrame(counts, "lang string, phrase string, n bigint")
    totals = spark.createDataFrame([("en", b"", 7 * 10**17 + 3, 0)], "lang string, codes binary, n_words bigint, shard int")
    monkeypatch.setattr(phrases, "store_shards", lambda *_: totals)
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *_: frame)
    row = phrases.collocations(frame.withColumn("text", F.lit("")), min_count=1).first()
    assert row.score == 1000 * (big - 7) * (7 * 10**17 + 3) // (big * (big - 2))


def test_filter_has_all_that_was_put_in(spark):
    words = [f"w{k}" for k in range(500)]
    frame = spark.createDataFrame([("en", w.encode()) for w in words] + [("en", b"a b c")], "lang string, phrase binary")
    bitmap = phrases.filter_of(frame, 1 << 14, np.zeros(1 << 11, np.uint8))
    assert phrases.in_filter(bitmap, phrases.word_hashes("en", [w.encode() for w in words])).all()
    h = phrases.word_hashes("en", [b"a", b"b", b"c"])
    assert phrases.in_filter(bitmap, phrases.longer(phrases.longer(h[:1], h[1:2]), h[2:]))[0]
    others = phrases.in_filter(bitmap, phrases.word_hashes("de", [w.encode() for w in words]))
    assert others.mean() < 0.05
    more = phrases.filter_of(frame.limit(0), 1 << 14, bitmap)
    assert np.array_equal(more, bitmap)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([("a b", "en")], none.schema)).count() == 0
