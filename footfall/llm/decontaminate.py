"""Benchmark decontamination: documents that hold a benchmark item, or nearly so.

A document is compared with an item through windows of the item's size. Texts are lower-case words of
letters and digits; a window or item is the multiset of its 5-word shingles, a shingle weighs as often
as it occurs (a text of fewer words is one shingle). A window holds an item if the weighted Jaccard
similarity of the two is at least ``threshold``.

1. A window that similar holds, of its w shingles, at least ``need`` = t/(1+t) * (w + n) of the item's n, so
   it lacks at most n - t*n of them. One more than that are the item's seeds, those that the fewest items
   have: every window that can pass holds a seed. Windows are made around seeds only, each at its first
   one; a shingle that many items share is a seed of the few that have no rarer ones.
2. Each window gets a 64-bit SimHash. The items' fingerprints are indexed by item and radius + 1 blocks of
   bits: two fingerprints within the radius agree in a block, so the lookup finds the window's item if it
   is in the radius. A window meets at most radius + 1 index rows, whatever the number of items, and is
   not compared with other items: those that can pass have seeds of their own in it. A pair that meets in
   several blocks is taken at the first. What the index saves is the exact comparison of windows beyond the
   radius; it cannot tell unrelated fingerprints apart, as blocks of 2 or 3 bits often agree by chance.
3. The exact similarity decides.

Everything runs inside the scan of the documents; what is shuffled is one row per found pair and task.
The items are a stated query set: they are taken in blocks of a bounded number of shingles, each block
broadcast against all documents.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.llm.common import let, window_hashes
from footfall.sources.storage import materialise

BITS = 64
#: Shingles and index rows of one broadcast block: a few dozen bytes each, some 40 MB as hash tables.
BLOCK_SHINGLES = 1_000_000


def _words(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def shingles(text: Column, size: int = 5) -> Column:
    """Hashes of the ``size``-word shingles in order; of the whole sequence if it is shorter."""
    def hashes(w: Column) -> Column:
        return F.when(F.size(w) >= size, window_hashes(w, size)).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    return let(_words(text), hashes)


def fingerprint(hashes: str) -> Column:
    """Majority bits of an array of hashes; two counters of 32 bits are summed at a time."""
    pairs = f"""transform(sequence(0, 31), j ->
        aggregate({hashes}, 0L, (a, x) -> a + (shiftrightunsigned(x, j) & 4294967297L)))"""
    bits = f"""aggregate(sequence(0, 31), 0L, (acc, j) -> acc
        | IF(2 * (counts[j] & 4294967295L) > size({hashes}), shiftleft(1L, j), 0L)
        | IF(2 * shiftrightunsigned(counts[j], 32) > size({hashes}), shiftleft(1L, j + 32), 0L))"""
    return F.expr(f"transform(array({pairs}), counts -> {bits})[0]")


def _masks(radius: int) -> list[int]:
    """radius + 1 bit masks that cover 64 bits, as signed 64-bit numbers."""
    blocks = radius + 1
    edges = [k * BITS // blocks for k in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [m - (1 << BITS) if m >> 63 else m for m in masks]


def _common_weight(left: Column, right: Column) -> Column:
    """Sum over shingles of the smaller number of occurrences."""
    plain = F.size(F.array_intersect(left, right))
    counted = F.aggregate(
        F.array_intersect(left, right), F.lit(0),
        lambda acc, x: acc + F.least(F.size(F.filter(left, lambda y: y == x)), F.size(F.filter(right, lambda y: y == x))),
    )
    return F.when(F.size(F.array_distinct(left)) == F.size(left), plain).otherwise(counted)


def _seeds(items: DataFrame, threshold: float) -> DataFrame:
    """items with ``seeds``: the shingles that the fewest items have, one occurrence more than a window can
    lack."""
    each = items.select("_item", "n", F.explode("item").alias("h")).groupBy("_item", "n", "h").agg(F.count(F.lit(1)).alias("times"))
    holders = each.groupBy("h").agg(F.count(F.lit(1)).alias("holders"))
    order = Window.partitionBy("_item").orderBy("holders", "h").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("times").over(order), F.lit(0))  # of an item's own shingles
    lacking = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9)
    chosen = each.join(holders, "h").withColumn("before", before).filter(F.col("before") <= lacking)
    return items.join(chosen.groupBy("_item").agg(F.collect_list("h").alias("seeds")), "_item")


def _windows(rows: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """Windows of rows (_doc, _text, hashes) around the seeds of items that they may hold."""
    seeds = items.select("_item", F.explode("seeds").alias("h"))
    # outer and never null: else Spark infers filters on the array's size, which compute it twice
    m = F.coalesce(F.size("hashes"), F.lit(0)).alias("m")
    at = rows.select("_doc", "_text", "hashes", m, F.posexplode_outer("hashes").alias("pos", "h"))
    hits = at.join(F.broadcast(seeds), "h").join(F.broadcast(items.select("_item", "n", "item", "seeds")), "_item")
    width = F.least("n", "m")
    need = F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("n") + width) - 1e-9).cast("int")
    hits = hits.withColumn("w", width).withColumn("need", need).filter("need <= w")
    # only the shingles around the seed go on
    hits = hits.withColumn("lead", F.least(F.col("w") - 1, F.col("pos")))
    around = F.expr("slice(hashes, pos + 1 - lead, lead + w)")
    hits = hits.select("_doc", "_text", "_item", "n", "m", "w", "need", "pos", "lead", "item", "seeds", around.alias("around"))
    hits = hits.filter(F.size(F.array_except("item", "around")) <= F.col("n") - F.col("need"))
    starts = hits.withColumn("back", F.explode(F.expr("sequence(0, lead)")))
    starts = starts.withColumn("start", F.expr("pos - back")).filter("start + w <= m")
    before = F.expr("slice(around, lead - back + 1, back)")
    starts = starts.filter(F.size(F.array_intersect(before, "seeds")) == 0)
    window = F.expr("slice(around, lead - back + 1, w)")
    windows = starts.select("_doc", "_text", "_item", "start", "n", "w", "need", window.alias("window"), "item")
    strange, lacking = F.size(F.array_except("window", "item")), F.size(F.array_except("item", "window"))
    windows = windows.filter((strange <= F.col("w") - F.col("need")) & (lacking <= F.col("n") - F.col("need")))
    return windows.select("_doc", "_text", "_item", "start", "window", fingerprint("window").alias("print"))


def _met(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """Windows with the index rows that they meet: those of their item with an equal block."""
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(radius)])

    def keys(of: str) -> Column:
        return F.posexplode(F.transform(masks, lambda m: F.col(of).bitwiseAND(m))).alias("block", "key")

    index = items.select("_item", "item_print", keys("item_print"))
    met = windows.select("*", keys("print")).join(F.broadcast(index), ["_item", "block", "key"])
    apart = F.col("print").bitwiseXOR(F.col("item_print"))
    first = F.array_position(F.transform(masks, lambda m: apart.bitwiseAND(m)), F.lit(0).cast("long")) - 1
    return met.withColumn("bits", F.bit_count(apart)).withColumn("first", first == F.col("block"))


def _find(rows: DataFrame, items: DataFrame, threshold: float, radius: int) -> DataFrame:
    """Pairs of rows (_doc, _text, hashes) and items (_item, item_id, item, seeds, n, item_print)."""
    near = _met(_windows(rows, items, threshold), items, radius).filter((F.col("bits") <= radius) & F.col("first"))
    near = near.join(F.broadcast(items.select("_item", "item_id", "item")), "_item")
    near = near.withColumn("both", _common_weight(F.col("window"), F.col("item")))
    near = near.withColumn("similarity", F.col("both") / (F.size("window") + F.size("item") - F.col("both")))
    return near.filter(F.col("similarity") >= threshold).select("_doc", "_text", "_item", "item_id", "similarity", "start", "bits")


def _find_runs(rows: DataFrame, items: DataFrame) -> DataFrame:
    """The same for items of one shingle, which a document has as it is or not at all."""
    seeds = items.select("_item", "item_id", F.col("item")[0].alias("h"))
    at = rows.select("_doc", "_text", F.posexplode("hashes").alias("start", "h"))
    hits = at.join(F.broadcast(seeds), "h")
    return hits.select("_doc", "_text", "_item", "item_id", F.lit(1.0).alias("similarity"), "start", F.lit(0).alias("bits"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8, radius: int = 23,
    block_shingles: int = BLOCK_SHINGLES, short_inside: bool = False,
) -> DataFrame:
    """Per document and item found in it: doc_id, _text (hash of the text), item_id, similarity of the
    best window, its first word ``start`` (the smallest of equals) and the differing ``bits``.

    Null or empty texts and items hold and match nothing. An item of fewer words than a shingle matches
    documents that consist of just these words, with ``short_inside`` documents that have these words in a
    row: one more pass over the documents for each such number of words that occurs. Rows with equal doc_id and text give one row, items
    with equal item_id, or with none, are one item each per text; an item_id may be null. radius 23: at similarity 0.8 a fingerprint bit differs
    with probability 0.15, more than 23 of 64 with 10^-5. Items of more than ``block_shingles`` together are
    taken in blocks; then the shingles of the documents are stored once for all blocks."""
    known = benchmark.select("item_id", "text", F.size(_words(F.col("text"))).alias("_words"))
    passes = [(shingle, known, partial(_find, threshold=threshold, radius=radius))]
    if short_inside:
        lengths = known.select("_words").filter(F.col("_words").between(1, shingle - 1)).distinct().collect()
        passes = [(shingle, known.filter(F.col("_words") >= shingle), passes[0][2])]
        passes += [(r[0], known.filter(F.col("_words") == r[0]), _find_runs) for r in sorted(lengths)]
    found = []
    for size, some, find in passes:
        items = some.select("item_id", shingles(F.col("text"), size).alias("item")).filter(F.size("item") > 0)
        items = items.withColumn("n", F.size("item")).withColumn("item_print", fingerprint("item")).distinct()
        items = items.withColumn("_item", F.xxhash64("item_id", "item"))  # never null, as item_id may be
        items = materialise(_seeds(items, threshold), "benchmark-items")
        rows = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text"), shingles(F.col("text"), size).alias("hashes"))
        # an item is its shingles and a row per bit block of the index
        total = items.agg(F.sum(F.col("n") + radius + 1)).first()[0] or 0
        blocks = max(1, -(-total // block_shingles))
        if blocks > 1:
            rows = materialise(rows, "shingles")
        block = F.pmod("_item", F.lit(blocks))
        found += [find(rows, items.filter(block == b)) for b in range(blocks)]
    best = F.max_by(F.struct("similarity", "start", "bits"), F.struct("similarity", -F.col("start"))).alias("best")
    pairs = reduce(DataFrame.unionByName, found).groupBy("_doc", "_text", "_item", "item_id").agg(best)
    return pairs.select(F.col("_doc").alias("doc_id"), "_text", "item_id", "best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, short_inside: bool = False) -> DataFrame:
    """docs without the documents that hold an item. All columns stay; repeated rows go together."""
    found = contaminated(docs, benchmark, short_inside=short_inside)
    gone = found.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_footfall_id"), F.col("_text").alias("_footfall_text")).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(*columns, F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_footfall_id"), F.xxhash64("text").alias("_footfall_text"))
    return rows.join(gone, ["_footfall_id", "_footfall_text"], "left_anti").select(*columns)
