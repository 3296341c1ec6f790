"""Best partners by shared groups: users that rate the same items, words that one user searches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.operators.joins import exclude, join_per_key, restrict
from footfall.operators.ranking import rank_key, top_k_per_group


def top_pairs(
    left: DataFrame, right: DataFrame, part: str, group: Sequence[str], a: str, b: str,
    score: Callable[[Column, Column], Column], k: int, day: str | None = None, within: int = 0,
) -> DataFrame:
    """For left rows (part, group, a, w) and right rows (part, group, b, w) the pair (a, b) has
    ``total`` = sum of w_a * w_b over shared groups and ``rows`` = number of shared row pairs; the
    score of both decides the k best b of each a.

    One join on part and group, at every size. Rows of a member in a group are summed first, so both
    inputs come straight from a shuffle on the join keys and Spark splits a group that holds a large
    part of them; sums per pair are combined before they are shuffled. The pairs of a group are the
    work: their number is what the score is defined on.

    With ``day`` a pair of rows counts if the right row is ``within`` so many days after the left one, on the
    same day included. The interval becomes an equality on bins of its width: a left row is in the bin of
    its day, a right row in that of its day and in the one before, so they meet once if they are near
    enough; what else shares a bin is filtered out. Two copies of a row at every width."""
    keys = [part, *group]
    if day is None:
        rows = _compact(left, keys, a, "a").join(_compact(right, keys, b, "b"), keys)
    else:
        width = max(within, 1)
        number = F.unix_date(day)
        own = F.floor(number / width)
        left = left.withColumn("bin", own).withColumn("day_a", number)
        bins = F.array(own, own - 1) if within else F.array(own)
        right = right.withColumn("bin", F.explode(bins)).withColumn("day_b", number)
        keys.append("bin")
        rows = _compact(left, [*keys, "day_a"], a, "a").join(_compact(right, [*keys, "day_b"], b, "b"), keys)
        rows = rows.filter((F.col("day_b") - F.col("day_a")).between(0, within))
    pairs = rows.filter(F.col("a") != F.col("b")).groupBy(part, "a", "b").agg(
        F.sum(F.col("wa") * F.col("wb")).alias("total"),
        F.sum(F.col("ca") * F.col("cb")).alias("rows"),
    )
    scored = pairs.select(
        part, F.col("a").alias(a), F.col("b").alias(b),
        score(F.col("total"), F.col("rows")).alias("score"),
    )
    return top_k_per_group(scored, [part, a], k, "score", [b])


def _compact(df: DataFrame, keys: list[str], member: str, out: str) -> DataFrame:
    """One row per group and member: sums of products factor into products of sums."""
    return df.groupBy(*keys, F.col(member).alias(out)).agg(
        F.sum("w").alias(f"w{out}"), F.count(F.lit(1)).alias(f"c{out}")
    )


def best_pairs(
    left: DataFrame | None, right: DataFrame, part: str, group: Sequence[str], a: str, b: str,
    growth: Callable[[Column], Column], k: int, cut: Callable[[DataFrame, str], DataFrame],
    crowd: int = 1000, depth: int = 4, only: DataFrame | None = None, many: int = 10_000,
) -> DataFrame:
    """``top_pairs`` for the score total * growth(rows), growth rising and not negative, without the pairs of
    crowded groups that cannot be among the k best.

    Groups of at most ``crowd`` members are joined as they are. Of a crowded group only the members with the
    largest weights meet a member of positive weight, those with the smallest one of negative weight, and
    those with the smallest names everybody: ``depth * k`` of each, and all with several rows. A pair that is
    found gets its exact score over all groups. A member whose weights bound what any other partner could
    score below its k-th best is done; the others go on with lists four times as long, in the end whole. On
    ties, as where partners share one row and all score growth(1) = 0, the smallest names win, so that list
    decides. ``cut`` stores what several steps read.

    Without ``left`` the right rows, one per group and member with ``w`` and a count ``c`` of rows, meet themselves:
    all members, those of the column ``a`` of ``only``, or those marked by a column ``mine``.

    Where no group is crowded, the pairs of a member of at most ``many`` groups are dealt out once, by that member:
    sums and ranks are made there, of ``many * crowd`` rows at most. Pairs of the others are summed before each of two
    shuffles, so that no task gets all of them."""
    keys, pair = [part, *group], [part, "a", "b"]
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in [*keys, "b"]])
    if left is None:
        marked = ["mine"] if "mine" in right.columns else []
        rows_b = right.select(*keys, F.col(b).alias("b"), F.col("w").alias("wb"), F.col("c").alias("cb"), *marked).filter(whole)
        rows_a = rows_b.withColumnsRenamed({"b": "a", "wb": "wa", "cb": "ca"})
        rows_a, rows_b = (rows_a.filter("mine").drop("mine"), rows_b.drop("mine")) if marked else (rows_a, rows_b)
        rows_a = rows_a if only is None else restrict(rows_a, only.withColumnRenamed(a, "a"), ["a"])
    else:
        rows_a, rows_b = _compact(left, keys, a, "a"), cut(_compact(right, keys, b, "b"), "members-b")
    crowded = rows_b.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd)
    crowded = cut(crowded, "crowded")
    if crowded.isEmpty():
        def best(members: DataFrame, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
            met = members.join(rows_b, keys).filter(F.col("a") != F.col("b"))
            found = met.select(*pair, (F.col("wa") * F.col("wb")).alias("total"), (F.col("ca") * F.col("cb")).alias("rows"))
            totals = deal(found).groupBy(*pair).agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
            return _best(totals.withColumn("score", F.col("total") * growth(F.col("rows"))), part, a, b, k)

        busy = rows_a.groupBy(part, "a").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > many)
        busy = cut(busy.select(part, "a"), "busy")
        by_member = lambda met: met.repartition(part, "a")
        if busy.isEmpty():
            return best(rows_a, by_member)
        split = best(restrict(rows_a, busy, [part, "a"]), lambda met: met)
        return best(exclude(rows_a, busy, [part, "a"]), by_member).unionByName(split)
    own_side = left is not None or only is not None or "mine" in right.columns
    rows_a = cut(rows_a, "members-a") if own_side else rows_a
    many_a, many_b = (cut(join_per_key(x, crowded, keys), name) for x, name in ((rows_a, "crowd-a"), (rows_b, "crowd-b")))
    few_a, few_b = (exclude(x, crowded, keys) for x in (rows_a, rows_b))
    few = cut(_totals(few_a.join(few_b, keys).filter(F.col("a") != F.col("b")), pair), "few-pairs")

    def scored(totals: DataFrame) -> DataFrame:
        return totals.withColumn("score", F.col("total") * growth(F.col("rows")))

    open_ = many_a.select(part, "a").distinct()
    done = [scored(exclude(few, open_, [part, "a"]))]
    length = depth * k
    for round_ in count():
        mine = restrict(many_a, open_, [part, "a"])
        heads = cut(_heads(many_b, keys, length), f"heads-{round_}")
        suits = (F.col("side") == 0) | (F.col("side") == F.signum("wa").cast("int"))
        met = mine.join(heads.select(*keys, "b", "side"), keys).filter(suits & (F.col("a") != F.col("b")))
        own = restrict(few, open_, [part, "a"])
        found = met.select(*pair).unionByName(own.select(*pair)).distinct()
        shared = found.join(mine.select(*keys, "a", "wa", "ca"), [part, "a"]).join(many_b.select(*keys, "b", "wb", "cb"), [*keys, "b"])
        totals = own.unionByName(_totals(shared, pair)).groupBy(*pair).agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
        round_scored = cut(scored(totals), f"scored-{round_}")
        left_over = cut(_undecided(round_scored, mine, heads, keys, length, growth, k), f"undecided-{round_}")
        done.append(exclude(round_scored, left_over, [part, "a"]))
        if left_over.isEmpty():
            break
        open_, length = left_over, 4 * length
    return _best(reduce(DataFrame.unionByName, done), part, a, b, k)


def _best(scored: DataFrame, part: str, a: str, b: str, k: int) -> DataFrame:
    named = scored.select(part, F.col("a").alias(a), F.col("b").alias(b), "score")
    return top_k_per_group(named, [part, a], k, "score", [b])


def _totals(rows: DataFrame, pair: list[str]) -> DataFrame:
    return rows.groupBy(*pair).agg(
        F.sum(F.col("wa") * F.col("wb")).alias("total"), F.sum(F.col("ca") * F.col("cb")).alias("rows")
    )


def _heads(members: DataFrame, keys: list[str], length: int) -> DataFrame:
    """The first members of each group by weight (side 1), by weight from below (-1) and by name (0), ``rn``
    their place; side 0 without a place: those of several rows."""
    orders = {1: [F.col("wb").desc(), F.col("b")], -1: [F.col("wb"), F.col("b")], 0: [F.col("b")]}
    lists = [members.filter(F.col("cb") > 1).withColumn("rn", F.lit(None).cast("int")).withColumn("side", F.lit(0))]
    for side, order in orders.items():
        rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        lists.append(members.withColumn("rn", rn).filter(F.col("rn") <= length).withColumn("side", F.lit(side)))
    return reduce(DataFrame.unionByName, lists)


def _undecided(
    scored: DataFrame, mine: DataFrame, heads: DataFrame, keys: list[str], length: int,
    growth: Callable[[Column], Column], k: int,
) -> DataFrame:
    """(part, a) of members that a partner outside the lists could still be among the k best of."""
    part = keys[0]
    order = [rank_key("score").desc(), F.col("b")]
    rn = F.row_number().over(Window.partitionBy(part, "a").orderBy(*order))
    kth = scored.withColumn("rn", rn).filter(F.col("rn") <= k).filter(F.col("rn") == k)
    kth = kth.select(part, "a", rank_key("score").alias("kth"), F.col("b").alias("kth_b"))
    ends = heads.filter(F.col("rn") == length).groupBy(*keys).agg(*[
        F.max(F.when(F.col("side") == side, F.col(c))).alias(name)
        for name, side, c in (("high", 1, "wb"), ("low", -1, "wb"), ("last", 0, "b"))
    ])
    # who is in no list has weights between low and high, one row, and a name after last
    most = F.greatest(F.lit(0.0), F.when(F.col("wa") >= 0, F.col("wa") * F.col("high")).otherwise(F.col("wa") * F.col("low")))
    beyond = join_per_key(mine.filter(F.col("n") > length), ends, keys).groupBy(part, "a").agg(
        F.sum(most).alias("total"), F.sum("ca").alias("rows"), F.min("last").alias("last")
    )
    bound = F.col("total") * growth(F.col("rows"))
    above = F.col("kth") > rank_key(bound) + 1
    tied = (bound <= 0) & ((F.col("kth") > 0) | ((F.col("kth") == 0) & (F.col("kth_b") <= F.col("last"))))
    decided = F.col("kth").isNotNull() & (above | tied)
    return beyond.join(kth, [part, "a"], "left").filter(~decided).select(part, "a")
