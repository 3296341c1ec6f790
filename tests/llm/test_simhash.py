from __future__ import annotations

import random

import brute
import pytest
from pyspark.sql import functions as F

from footfall.llm import components, simhash

SIGNED = 1 << 63


def signed(x: int) -> int:
    return x - 2 * SIGNED if x >= SIGNED else x


def family(rng, n):
    """Fingerprints of which many are a few bits from each other, and some share whole blocks."""
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        out.add(x)
        for _ in range(rng.randrange(6)):
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("text", [
    None, "", " \t\n", "one", "One two", "a b c", "the cat sat on the mat the cat sat", "Ärger É A b c d", "x " * 5000,
])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode(), 3) == brute.fingerprint(text)


@pytest.mark.parametrize("max_bits, task_rows", [(3, 20_000), (3, 4), (2, 6), (5, 20_000)])
def test_links_connect_what_is_near(spark, max_bits, task_rows):
    prints = family(random.Random(max_bits), 300)
    prints += [x for x in (prints[0] ^ k for k in range(1, 64)) if x not in prints]  # a crowded subtree
    frame = spark.createDataFrame([(signed(x),) for x in prints], "fp bigint")
    edges = simhash.links(frame, max_bits, task_rows, at_once=50).collect()
    at = {signed(x): k for k, x in enumerate(prints)}
    assert all((prints[at[e.u]] ^ prints[at[e.v]]) is not None for e in edges)
    got = brute.roots(len(prints), [(at[e.u], at[e.v]) for e in edges])
    assert got == brute.near_groups(prints, max_bits)


def test_components(spark):
    rng = random.Random(5)
    pairs = [(k, k + 1) for k in range(200)] + [(rng.randrange(300, 900), rng.randrange(300, 900)) for _ in range(500)]
    pairs += [(1000, k) for k in range(1001, 1300)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    want = brute.roots(1300, pairs)
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: want[x] for x in touched}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def documents(rng):
    base = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(rng.randrange(1, 120))) for _ in range(40)]
    rows = [(k, t) for k, t in enumerate(base)]
    for k in range(60):  # near copies
        w = rng.choice(base).split()
        w[rng.randrange(len(w))] = "zzz"
        rows.append((100 + k, " ".join(w)))
    rows += [(200 + k, base[3].upper()) for k in range(30)]  # exact copies
    rows += [(300, None), (301, ""), (302, " \n"), (303, "two words"), (303, "two words"), (None, base[5]), (None, "own text of nobody here")]
    return rows


def test_near_duplicates(spark):
    rows = documents(random.Random(2))
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, fp int, root string")
    got = simhash.near_duplicates(frame).select("doc_id", "fingerprint", "component_id").collect()
    prints = [brute.fingerprint(t) for _, t in rows]
    group = brute.near_groups(prints)
    least = {}
    for (doc, _), g in zip(rows, group):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    want = [(doc, f"{p:016x}", least.get(g)) for (doc, _), p, g in zip(rows, prints, group)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_one_document_of_each_group_stays(spark):
    rows = documents(random.Random(4)) + [(0, "another text under a known id")]
    frame = spark.createDataFrame([(*r, "s") for r in rows], "doc_id bigint, text string, source string")
    out = simhash.drop_near_duplicates(frame)
    assert out.columns == frame.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    group = brute.near_groups([brute.fingerprint(t) for _, t in rows])
    by = dict(zip(rows, group))
    assert sorted(by[k] for k in kept) == sorted(set(group))
    first = {}
    for (doc, _), g in zip(rows, group):
        first[g] = min(first.get(g, 1 << 62), 1 << 62 if doc is None else doc)
    assert all((1 << 62 if doc is None else doc) == first[by[doc, text]] for doc, text in kept)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0


def test_no_pair_table_in_the_plan(spark):
    frame = spark.range(50).select((F.col("id") * 7919).alias("fp"))
    plan = simhash.links(frame)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
