"""Packing of documents into sequences of a fixed number of tokens.

A document is its ids and a closing id 0. It is cut into whole sequences and a rest. The lengths of
all pieces form a histogram of at most ``size`` counts, on which the packing is planned: lengths are
placed longest first, each into the shortest pack so far, whole runs of equal packs at a time. A pack
is a pattern with a count, so the plan's size depends on the sequence length and not on the documents.
Pieces then find their place by rank among the pieces of their length.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from footfall.llm.common import ship_by_value
from footfall.llm.tokens import encoder
from footfall.sources.storage import materialise

ship_by_value(__name__)

END = (0).to_bytes(4, "little")


def plan(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, longest first) and how many packs have them.

    Shortest-pack-first: a length goes into the shortest of the packs while it fits there, into new
    packs otherwise. Of a pattern that is needed in part, the rest stays as it is."""
    open_packs: list[tuple[int, tuple[int, ...], int]] = []  # heap by total length
    closed: Counter = Counter()

    def put(pattern: tuple[int, ...], count: int) -> None:
        if count and sum(pattern) == size:
            closed[pattern] += count
        elif count:
            heapq.heappush(open_packs, (sum(pattern), pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_packs and open_packs[0][0] + length <= size:
                total, pattern, count = heapq.heappop(open_packs)
                used = min(left, count)
                if used < count:
                    heapq.heappush(open_packs, (total, pattern, count - used))
                left -= used
                put((*pattern, length), used)
            else:  # a new pack is the shortest until it is full of this length
                full, left = divmod(left, size // length)
                put((length,) * (size // length), full)
                put((length,) * left, min(1, left))
                left = 0
    for _, pattern, count in open_packs:
        closed[pattern] += count
    return sorted(closed.items(), reverse=True)


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, next rank, first sequence, copies, offset): the pieces of a length with
    ranks in the range lie in consecutive sequences, ``copies`` in each, from the offset on."""
    rows, taken, sequence = [], Counter(), 0
    for pattern, count in patterns:
        offset = 0
        for length, copies in sorted(Counter(pattern).items(), reverse=True):
            first = taken[length]
            taken[length] += copies * count
            rows.append((length, first, taken[length], sequence, copies, offset))
            offset += length * copies
        sequence += count
    return rows


def pieces(docs: DataFrame, path: str, size: int = 1024) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens per piece, and its rank among the pieces of its
    length in the task that made it (part, nth). A null text is the closing id alone."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["start", "length", "ids_crc32", "doc_tokens", "nth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, seen, part = encoder(path), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            at, rows = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = made.encode(text or "") + END
                total = len(ids) // 4
                for start in range(0, total, size):
                    length = min(size, total - start)
                    at.append(k)
                    rows.append((start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), total, seen[length]))
                    seen[length] += 1
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(names)
            parts = pa.array([part] * len(at), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), *columns, parts], names=["doc_id", *names, "part"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{n} bigint" for n in names) + ", part int")


def pack(docs: DataFrame, path: str, size: int = 1024) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Sequences have at most ``size`` tokens, offsets no gaps. A document of more tokens is cut at
    multiples of ``size``. Repeated rows and equal doc_ids are packed each; no rows give no rows. The
    histogram (at most ``size`` rows) is all that reaches the driver."""
    spark = docs.sparkSession
    cut = materialise(pieces(docs, path, size), "pieces")
    each = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = each.select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(
        _places(plan(histogram, size)) if histogram else [],
        "length bigint, low bigint, high bigint, sequence bigint, copies bigint, base bigint",
    )
    ranked = cut.join(firsts.drop("n"), ["length", "part"]).withColumn("rank", F.col("first") + F.col("nth"))
    # at most size^2 / 2 rows, see plan(): its patterns are runs of lengths between 1 and size
    at = places.withColumnRenamed("length", "of")
    mine = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranked.join(F.broadcast(at), mine).withColumn("k", F.col("rank") - F.col("low"))
    sequence = F.col("sequence") + F.expr("k div copies")
    offset = F.col("base") + F.col("k") % F.col("copies") * F.col("length")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", sequence.alias("sequence_id"), offset.alias("offset"))
