"""Dish names in any script, of several words, in whole texts."""

from __future__ import annotations

import random
from collections import Counter

import regex
from pyspark.sql import functions as F

from footfall.operators.groups import tf_idf
from footfall.plans import dishes, keywords
from footfall.params import Params


def mentions(spark, texts, names):
    heads = spark.createDataFrame([(k, 1, 7) for k in range(len(texts))], "reviewid long, cityid int, shopid long")
    bodies = spark.createDataFrame(list(enumerate(texts)), "reviewid long, reviewbody string")
    bodies = bodies.withColumn("hp_statdate", F.lit("2024-02-01").cast("date"))
    tags = spark.createDataFrame([(1, 7, n) for n in names], "cityid int, shopid long, tag string")
    listed = dishes.heads_with_dishes(heads, tags)
    rows = dishes.reviews_with_text(listed, bodies, "2024-01-01", "dishes")
    return {r.dish: r.c for r in dishes.mention_counts(rows).collect()}


def test_scripts_and_several_words(spark):
    texts = [
        "Das 红烧肉 war gut, 我爱红烧肉!", "Crème brûlée. CRÈME BRÛLÉE, br l e", "hot pot hot pot; hotpot, hot  pot", "and and, sand andy and",
        None, "", "x" * 100_000 + " and",
    ]
    assert mentions(spark, texts, ["红烧肉", "brûlée", "hot pot", "and", "a.d", "\\E(", "and"]) == {
        "红烧肉": 2, "brûlée": 2, "hot pot": 2, "and": 4,
    }


def brute(texts, names):
    """A pattern per text and name."""
    letter, spaceless = r"[\p{L}\p{M}\p{N}]", r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
    found = Counter()
    for text in texts:
        for name in set(names) - {""}:
            pattern = regex.escape(name.lower())
            if not regex.search(spaceless, name):
                pattern = f"(?<!{letter}){pattern}(?!{letter})"
            found[name] += len(regex.findall(pattern, (text or "").lower()))
    return {k: n for k, n in found.items() if n}


def test_against_a_pattern_per_name(spark):
    rng = random.Random(5)
    parts = ["de", " ", "la", "-", "  ", "é", "肉", "红", "7", "#", ".", "\n", "_", "DE", "\x01", "\\E", "ภ"]
    names = [
        "de", "de la", "de la de", "la", "é", "红肉", "肉", "7", "de-la", "#7", "7.", "##", "la_de", "de  la", "肉 de",
        "de7", "\\E", "", " ", "DE la", "de.la", "ภ", "la de la",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(600)] + [None, "", "de la " * 5_000]
    assert mentions(spark, texts, names) == brute(texts, names)


def test_a_review_counts_once_however_often_its_rows_come(spark):
    assert mentions(spark, ["soup"], ["soup", "soup"]) == {"soup": 1}
    heads = spark.createDataFrame([(1, 1, 7)] * 3, "reviewid long, cityid int, shopid long")
    bodies = spark.createDataFrame([(1, "soup")] * 2, "reviewid long, reviewbody string").withColumn("hp_statdate", F.lit("2024-02-01").cast("date"))
    assert dishes.reviews_with_text(heads, bodies, "2024-01-01").count() == 1


def test_a_given_number_of_documents(spark):
    rows = spark.createDataFrame([("f", 1, "a", 1.0), ("f", 2, "a", 1.0), ("f", 2, "b", 2.0)], "tagtype string, shopid long, tag string, score double")
    counted = {(r.shopid, r.tag): r.score for r in tf_idf(rows, "tagtype", "shopid", "tag", "score").collect()}
    given = {(r.shopid, r.tag): r.score for r in tf_idf(rows, "tagtype", "shopid", "tag", "score", 10).collect()}
    assert counted[1, "a"] == 0 and round(given[1, "a"], 9) == 1.609437912 and round(given[2, "b"], 9) == 4.605170186


def test_the_keyword_limit_cuts_names(spark):
    rows = spark.createDataFrame([(1, 1, "n" * k, 1.0 / k) for k in range(5, 15)], "userid long, cityid int, keyword string, score double")
    kept = keywords.top_names(rows, Params(max_keyword_len=7, max_shop_name_len=12))
    assert sorted(len(r.keyword) for r in kept.collect()) == [5, 6, 7]
