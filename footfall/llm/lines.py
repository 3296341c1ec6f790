"""Line deduplication: a line that many documents hold stays in the first of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import SPACES, ascii_lower, key128, let
from footfall.operators.joins import join_per_key

_ID, _TEXT, _GONE = "_footfall_id", "_footfall_text", "_footfall_gone"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _lines() -> Column:
    return F.split(F.coalesce("text", F.lit("")), "\n", -1)


def _identity() -> list[Column]:
    """A row's document: a null doc_id is one unknown document that comes after all others."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    return [doc.alias(_ID), F.xxhash64("text").alias(_TEXT)]


def dropped_lines(docs: DataFrame, min_chars: int = 10, max_docs: int = 1) -> DataFrame:
    """(document, positions to drop): lines whose key has at least ``min_chars`` code points and is in
    more than ``max_docs`` documents, outside the smallest doc_id that holds it.

    Only 128-bit hashes of keys are shuffled. Documents are counted by doc_id, with map-side
    combine, so a line of a third of all documents is one row per task; the join back to the lines is
    one that Spark splits on a hot key."""
    keys = F.transform(_lines(), line_key)
    lines = docs.select(*_identity(), F.posexplode(keys).alias("pos", "key")).filter(F.length("key") >= min_chars)
    lines = lines.select(_ID, _TEXT, "pos", *key128(F.col("key")))
    counts = lines.groupBy("h1", "h2").agg(F.count_distinct(_ID).alias("n"), F.min(_ID).alias("first"))
    hits = join_per_key(lines, counts.filter(F.col("n") > max_docs), ["h1", "h2"]).filter(F.col(_ID) != F.col("first"))
    return hits.groupBy(_ID, _TEXT).agg(F.collect_set("pos").alias(_GONE))


def dedup_lines(docs: DataFrame, min_chars: int = 10, max_docs: int = 1) -> DataFrame:
    """docs with ``text`` without the dropped lines, and the columns n_lines and n_dropped.

    A null or empty text has one empty line. A text that loses nothing stays as it is, null too; one
    that loses all lines becomes empty. Rows with equal doc_id and text are treated alike; rows with
    equal doc_id and other text are one document for the count. n_lines and n_dropped replace input
    columns of these names."""
    gone = dropped_lines(docs, min_chars, max_docs)
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns], *_identity())
    rows = rows.join(gone.hint("shuffle_hash"), [_ID, _TEXT], "left")  # texts stream past the positions, unsorted
    n = F.size(_lines())
    rest = F.array_except(F.sequence(F.lit(0), n - 1), F.col(_GONE))
    text = let(_lines(), lambda all_: F.array_join(F.transform(rest, lambda i: F.get(all_, i)), "\n"))
    rows = rows.withColumn("n_lines", n.cast("long"))
    rows = rows.withColumn("n_dropped", F.when(F.col(_GONE).isNull(), 0).otherwise(F.size(_GONE)).cast("long"))
    rows = rows.withColumn("text", F.when(F.col(_GONE).isNull(), F.col("text")).otherwise(text))
    return rows.drop(_ID, _TEXT, _GONE)
