"""Dish tags of shops and their mentions in reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions.text import once
from footfall.operators.joins import join_per_key
from footfall.operators.packed import explode_tags
from footfall.params import Params
from footfall.plans.shops import eligible


#: Scripts whose words are not set apart by spaces.
NO_SPACES = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
LETTER = r"[\p{L}\p{M}\p{N}]"
#: Marks around a run of letters and digits.
BEFORE, AFTER = "\x01", "\x02"


def reviews_with_text(heads: DataFrame, bodies: DataFrame, after: str, *keep: str) -> DataFrame:
    """Distinct reviews with their text, and the columns of the heads to keep. Joined and
    deduplicated on one shuffle by review: the text is shuffled once."""
    recent = bodies.filter(F.col("hp_statdate") > F.lit(after).cast("date"))
    joined = heads.distinct().join(recent.select("reviewid", "reviewbody", "hp_statdate"), "reviewid")
    return joined.select("reviewid", "cityid", "shopid", "reviewbody", *keep).distinct()


def heads_with_dishes(heads: DataFrame, dishes: DataFrame) -> DataFrame:
    """Review heads of shops that list dishes, with the shop's list, made ready to be searched for: a
    short list per shop."""
    names = dishes.select("shopid", _name(F.col("tag")).alias("name")).filter(F.col("name.text") != "")
    lists = names.groupBy("shopid").agg(F.array_sort(F.collect_set("name")).alias("dishes"))
    return join_per_key(heads.distinct(), lists, ["shopid"])


def shop_info(shops: DataFrame, p: Params) -> DataFrame:
    tagged = eligible(shops, p).filter(
        (F.col("cat0_id") == p.top_category)
        & ((F.col("shop_tags") != "") | (F.col("dish_tags") != ""))
    )
    return tagged.select(
        F.col("city_id").alias("cityid"), F.col("shop_id").alias("shopid"),
        "shop_tags", "dish_tags",
    )


def with_dishes(info: DataFrame) -> DataFrame:
    return info.filter(F.col("dish_tags") != "")


def shop_dishes(info: DataFrame) -> DataFrame:
    exploded = explode_tags(with_dishes(info), "dish_tags", ["cityid", "shopid"], "rank")
    return exploded.select("cityid", "shopid", F.lit("dish").alias("tagtype"), "tag", "rank")


def build_dictionary(dishes: DataFrame) -> DataFrame:
    """Dishes of more than one row, as dictionary lines of a word segmenter."""
    counts = dishes.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return counts.select(F.concat("tag", F.lit(" 1 n")).alias("entry"))


def _marked(text: Column) -> Column:
    """Every run of letters and digits between a mark before it and one after it."""
    plain = F.translate(text, f"{BEFORE}{AFTER}", "\x03\x03")
    return F.regexp_replace(plain, f"({LETTER}+)", f"{BEFORE}$1{AFTER}")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"[^{LETTER[1:-1]}]+"), lambda w: w != "")


def _name(dish: Column) -> Column:
    """What a name is searched by.

    kind 0: stands apart, starts and ends with a letter or digit: by its words, then by ``marked``, which
    a marked text holds only where the name is set apart. Kind 1: of a script without spaces: as it
    stands. Kind 2: has a symbol at an end: by a pattern."""
    low = F.lower(dish)
    kind = F.when(dish.rlike(NO_SPACES), 1).when(low.rlike(f"(?s)^{LETTER}(.*{LETTER})?$"), 0).otherwise(2)
    words = _words(low)
    return F.struct(
        dish.alias("dish"), low.alias("text"), kind.alias("kind"), _marked(low).alias("marked"),
        F.when(kind == 0, F.array_join(words, " ")).alias("gram"), F.when(kind == 0, F.size(words)).alias("size"),
    )


def _pattern(text: Column) -> Column:
    literal = F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    return F.concat(F.lit(f"(?<!{LETTER})"), literal, F.lit(f"(?!{LETTER})"))


def _grams(words: Column, sizes: Column) -> Column:
    """All runs of so many words, each joined by a blank."""

    def runs(size: Column) -> Column:
        last = F.size(words) - size
        joined = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, size), " "))
        return F.when(size == 1, words).when(last >= 0, joined).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(sizes, runs))


def _times(text: Column, name: Column) -> Column:
    """How often the text holds the name, from left to right."""
    left = F.length(F.replace(text, name, F.lit("")))
    return F.floor((F.length(text) - left) / F.length(name))


def _mentions(text: Column) -> Column:
    """(dish, n) of the dishes that a text in lower case names.

    The word runs of the text, of the lengths that the list has, are intersected with the list's by their
    hashes; only names found there are counted, in the marked text, which is made where there is one."""
    sizes = F.array_distinct(F.filter(F.transform("dishes", lambda d: d["size"]), lambda k: k.isNotNull()))
    grams = F.transform("dishes", lambda d: d["gram"])

    def counted(present: Column, marked: Column) -> Column:
        return F.transform("dishes", lambda d: F.struct(
            d["dish"].alias("dish"),
            F.when(d["kind"] == 0, F.when(F.array_contains(present, d["gram"]), _times(marked, d["marked"])).otherwise(0))
            .when(~F.contains(text, d["text"]), 0)
            .when(d["kind"] == 1, _times(text, d["text"]))
            .otherwise(F.regexp_count(text, _pattern(d["text"]))).alias("n"),
        ))

    present = once(_words(text), lambda w: F.array_intersect(_grams(w, sizes), grams))
    return once(present, lambda p: once(F.when(F.size(p) > 0, _marked(text)), lambda m: counted(p, m)))


def mention_counts(reviews: DataFrame, *by: str) -> DataFrame:
    """How often the reviews of a shop name each of its dishes, in whole texts and any script. A name counts
    as it stands, in lower case; set apart from other letters and digits where the script has spaces.

    The shop's dishes come with the review, so only (shop, dish) counts are shuffled."""
    found = once(F.lower("reviewbody"), _mentions)
    rows = reviews.select(*by, "shopid", F.explode(F.filter(found, lambda x: x.n > 0)).alias("f"))
    counts = rows.groupBy(*by, "shopid", F.col("f.dish").alias("dish"))
    return counts.agg(F.sum("f.n").cast("bigint").alias("c")).select(*by, "shopid", "dish", "c")


def merge_extracts(extracts: DataFrame) -> DataFrame:
    total = extracts.groupBy("shopid", "dish").agg(F.sum("c").alias("c"))
    return total.filter(F.col("c") > 0)
