from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from hypothesis import given, settings, strategies as st

from footfall.llm import audit


def failed(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    return {
        *("A" if len(w) < 100 else ""), *("B" if 100 * len(set(w)) < 80 * len(w) else ""),
        *("C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""), *("D" if re.search(r"[#$%&*|]", text) else ""),
    }


def brute(docs, labels):
    """docs: (doc_id, text, lang). Filter by filter, order by order."""
    least = {}
    for doc, text, _ in docs:
        key = audit.LAST if doc is None else doc
        least[text or ""] = min(key, least.get(text or "", key))
    marks = {}
    for doc, quality, toxic in labels:
        if doc is not None:
            good, bad = marks.get(doc, (False, False))
            marks[doc] = (good or quality == 1, bad or toxic == 1)
    rows = []
    for doc, text, lang in docs:
        again = (audit.LAST if doc is None else doc) > least[text or ""]
        rows.append((lang or "", failed(text) | ({"E"} if again else set()), *marks.get(doc, (False, False))))
    out, total = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[part, f] += len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), sum(f in r[1] for r in gone), sum(r[1] == {f} for r in rows if r[0] == part),
                    sum(r[2] for r in here), sum(r[3] for r in here),
                ]
                gone += here
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def documents(rng):
    words = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(150):
        n = rng.choice([5, 99, 100, 101, 150])
        text = " ".join(rng.sample(words, min(n, 300)) if rng.random() < 0.5 else rng.choices(words[:120], k=n))
        text = text.upper() if rng.random() < 0.2 else text
        rows.append((k, text + rng.choice(["", "", " #", "|"]), rng.choice(["en", "de", None])))
    rows += [(200 + k, rng.choice(rows)[1], rng.choice(["en", "de"])) for k in range(60)]
    return rows + [(300, None, "en"), (301, "", "en"), (302, "", None), (None, rows[3][1], "en"), (None, "alone", "en"), (5, rows[5][1], "en"), (5, "another text", "en"), (400, "\x0b\x1c" * 200, "en")]


@pytest.mark.parametrize("groups, merged", [(audit.GROUPS, audit.MERGED), (3, 200)])
def test_against_filter_by_filter(spark, groups, merged):
    docs = documents(random.Random(1))
    rng = random.Random(2)
    labels = [(d, rng.randrange(2), rng.randrange(2)) for d, _, _ in docs if rng.random() < 0.5] + [(3, 0, 0), (3, 1, 1), (None, 1, 1), (77, None, None)]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, lang string, mask int").repartition(4)
    marks = spark.createDataFrame([(*x, "m") for x in labels], "doc_id bigint, quality int, toxic int, part string")
    out = audit.audit(frame, marks, groups, merged).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in out}
    assert len(got) == len(out) == 3 * 600
    assert got == brute(docs, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "x", "en")], docs.schema)
    assert audit.audit(one, labels).count() == 600


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab😀", max_size=8), max_size=30))
def test_a_trie_holds_the_smallest_key_of_every_text(texts):
    trie, least = audit.Trie(), {}
    for k, text in enumerate(texts):
        key = (k * 7 % 11, k)
        trie.insert(text, key)
        least[text] = min(key, least.get(text, key))
    assert sorted(trie.terminals()) == sorted(least.values())


def test_a_long_shared_start_is_split(spark, monkeypatch):
    """Near copies with a start of thousands of characters, and a third of all rows with one text."""
    monkeypatch.setattr(audit, "LEAST_GROUP", 1000)
    start = "x" * 3000
    rows = [(k, f"{start}{k % 50} tail", "en") for k in range(300)] + [(1000 + k, "the same " * 200, "en") for k in range(200)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(8)
    shared = audit.shared_prefixes(frame, 16)
    assert start[:2048] in shared and max(map(len, shared)) <= 4096
    assert len({audit.own_prefix(t, shared) for _, t, _ in rows}) == 51
    masks = audit.masks(frame, 16).collect()
    assert {r.doc for r in masks if not r.mask & audit.BIT["E"]} == set(range(50)) | {1000}
    spread = audit.measured(frame, spark.sparkContext.broadcast(shared)).filter("mask is null and text like 'the same%'")
    assert spread.count() <= 8  # one row per task, not per document
