"""Shards along a Hilbert curve over document metadata.

Source, language, length and doc_id are quantised to a grid, each in its own order; documents are sorted
by the curve index of their cell and cut into runs of equal numbers of rows. Neighbours on the curve are
neighbours in every dimension, so the values of a shard span a short range of each, and a reader that
knows smallest and largest values opens few shards for a filter on any of them.

The order is made by range partitions that are sorted inside. A row's rank is the number of rows in
the partitions before it plus its place: only one count per partition is summed up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.llm.common import let
from footfall.sources.storage import materialise

GRID_BITS = 5


def _curve_tables(dims: int) -> tuple[list[int], list[int], list[int]]:
    """For each position on one level of the curve: entry corner, direction; and inverse Gray code."""
    size = 1 << dims

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def trailing_ones(i: int) -> int:
        return ((i ^ (i + 1)).bit_length() - 1) % dims

    entry = [0 if w == 0 else gray(2 * ((w - 1) // 2)) for w in range(size)]
    direction = [0 if w == 0 else trailing_ones(w if w % 2 else w - 1) for w in range(size)]
    inverse = [0] * size
    for w in range(size):
        inverse[gray(w)] = w
    return entry, direction, inverse


def curve_index(coordinates: list[Column], bits: int = GRID_BITS) -> Column:
    """Hilbert index (bigint) of integer coordinates in [0, 2^bits); two coordinates or more."""
    dims = len(coordinates)
    full = (1 << dims) - 1
    entry, direction, inverse = (F.array(*map(F.lit, t)) for t in _curve_tables(dims))

    def shift(name: str, x: Column, k: Column) -> Column:
        return F.call_function(name, x, k)

    def rotate(x: Column, right: Column) -> Column:
        turned = shift("shiftright", x, right).bitwiseOR(shift("shiftleft", x, F.lit(dims) - right))
        return turned.bitwiseAND(F.lit(full))

    def step(state: Column, level: Column) -> Column:
        corner = sum((shift("shiftright", c, level) % 2 * (1 << j) for j, c in enumerate(coordinates)), F.lit(0))
        turn = (state.d + 1) % dims
        place = F.get(inverse, rotate(corner.bitwiseXOR(state.e), turn))

        def moved(w: Column) -> Column:
            return F.struct(
                shift("shiftleft", state.h, F.lit(dims)).bitwiseOR(w.cast("long")).alias("h"),
                state.e.bitwiseXOR(rotate(F.get(entry, w), (F.lit(dims) - turn) % dims)).alias("e"),
                ((state.d + F.get(direction, w) + 1) % dims).alias("d"),
            )

        return let(place, moved)

    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda s: s.h)


def _ordinal(value: Column, least: str, most: str) -> Column:
    """A number in the order of the texts between least and most: the seven bytes after what all share.
    Null comes first."""
    a, b = (least or "").encode(), (most or "").encode()
    same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    own = F.rpad(F.hex(F.substring(value.cast("binary"), same + 1, 7)), 14, "0")
    return F.coalesce(F.conv(own, 16, 10).cast("long"), F.lit(-1))


def coordinates(docs: DataFrame, size: Column, bits: int = GRID_BITS) -> list[Column]:
    """Grid cells of source, lang, size and doc_id, in the order of their values. Nulls have a cell like any
    value.

    Cells of source, lang and size hold about equal numbers of rows: their bounds are quantiles (to
    1/10,000), so the driver gets 2^bits numbers of each. A value of many rows has a cell of its own."""
    cells = 1 << bits
    names = ("source", "lang")
    bounds = [f(c).alias(f"{kind}_{c}") for c in names for kind, f in (("least", F.min), ("most", F.max))]
    span_of = [F.min("doc_id").cast("double").alias("low"), F.max("doc_id").cast("double").alias("high")]
    found = docs.agg(*span_of, *bounds).first()
    low, span = found.low or 0.0, max(1.0, (found.high or 0.0) - (found.low or 0.0) + 1)
    place = F.floor((F.col("doc_id").cast("double") - low) * cells / span)
    inside = F.greatest(F.lit(0), F.least(F.lit(cells - 1), F.coalesce(place, F.lit(0)))).cast("int")

    numbers = {c: _ordinal(F.col(c), found[f"least_{c}"], found[f"most_{c}"]) for c in names} | {"size": size}
    shares = [k / cells for k in range(1, cells)]
    cuts = docs.agg(*[F.percentile_approx(x, shares, 10_000).alias(c) for c, x in numbers.items()]).first()

    def cell(name: str) -> Column:
        above = F.array(*[F.lit(q).cast("long") for q in cuts[name] or ()]).cast("array<bigint>")
        return let(numbers[name], lambda x: F.size(F.filter(above, lambda q: q < x))).cast("int")

    return [cell("source"), cell("lang"), cell("size"), inside]


def curve_shards(docs: DataFrame, shards: int = 40, bits: int = GRID_BITS) -> DataFrame:
    """Per row: doc_id, text_hash, size, text_crc32, curve, shard, slot.

    Numbers of rows in shards differ by one at most; slots count from 0 in curve order. Inside a cell
    equal texts lie together, then doc_id decides; rows equal in both are in any fixed order. The grid has
    2^(4 bits) cells; bits up to 15. The size
    is the UTF-8 length (null text: none) plus 16. No rows give no rows. Needs doc_id, text, lang and
    source; other columns play no part."""
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long") + 16
    keys = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), size.alias("size"), F.crc32(text).alias("text_crc32"), curve_index(coordinates(docs, size, bits), bits).alias("curve"))
    order = ["curve", "text_hash", "doc_id"]
    laid = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    laid = materialise(laid.select("*", place.alias("place")), "curve")
    part = F.shiftrightunsigned("place", 33)
    inside = F.col("place").bitwiseAND((1 << 33) - 1)
    laid = laid.withColumn("part", part).withColumn("inside", inside)
    counts = laid.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(Window.partitionBy()).alias("total"))
    ranked = laid.join(offsets, "part").withColumn("rank", F.col("offset") + F.col("inside"))
    shard = F.expr(f"(rank * {shards}) div total")
    ranked = ranked.withColumn("shard", shard.cast("int"))
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return ranked.withColumn("slot", F.col("rank") - first).select("doc_id", "text_hash", "size", "text_crc32", "curve", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 40, bits: int = GRID_BITS) -> None:
    """Write the documents as one folder of files per shard, in curve order in and across files.

    Rows with equal doc_id and text go to the first slot of theirs."""
    placed = curve_shards(docs, shards, bits).groupBy("doc_id", "text_hash").agg(F.min(F.struct("shard", "slot")).alias("_footfall_at"))
    rows = docs.withColumn("text_hash", F.xxhash64("text")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.text_hash") == F.col("p.text_hash"))
    rows = rows.join(placed.alias("p"), same).select(*[F.col(f"d.`{c}`") for c in docs.columns], "_footfall_at")
    rows = rows.withColumn("shard", F.col("_footfall_at.shard"))
    laid = rows.repartitionByRange("shard", "_footfall_at.slot").sortWithinPartitions("shard", "_footfall_at.slot")
    laid.drop("_footfall_at").write.partitionBy("shard").parquet(path)
