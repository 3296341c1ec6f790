"""What each filter of a chain removes, alone and together with the others, in every order.

Each document gets a mask of the filters it fails. Four filters look at the text alone; the fifth, "the
same text has a smaller doc_id", needs all texts. For it every task first merges the equal texts it reads,
so a text reaches the shuffle once per task; texts are then dealt out by ranges of an adaptive prefix, as
long as it must be for a group of texts to fit a task, and each task puts its whole texts into a radix
trie that holds the smallest doc_id at each terminal. A walk over the trie names the documents that keep
their texts; all others are duplicates.

Documents are then counted by part and mask: 32 rows a part at most, from which all orders, steps and
Shapley values follow without a look at any document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import UPPER, arrow_batches, ship_by_value, sliced
from footfall.sources.storage import materialise

ship_by_value(__name__)

FILTERS = "ABCDE"
BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
SYMBOLS = b"#$%&*|"
#: The doc_id that stands for null: it comes after all others.
LAST = 2**63 - 1
#: Code points of texts that a task holds to merge equal ones.
MERGED = 4 << 20
#: Rows that go to a Python worker and back at a time.
ROWS = 512
#: Code points of the first prefix, doubled where many texts share it.
FIRST_PREFIX = 2
#: Code points of a text that are counted at first, and the least that a group is split for.
HEAD = 64
LEAST_GROUP = 1 << 14
#: A prefix group holds 1/GROUPS of all code points at most, or texts that are the same. A group's trie has to
#: fit a task: for 10 TB some 100,000 groups.
GROUPS = 1024


def text_mask(raw: bytes, chars: int) -> int:
    """Bits of the filters A to D: few words, few different words, many capitals, symbols."""
    words = raw.split()  # of bytes: at [\x20\x09-\x0D] only
    capitals = len(raw) - len(raw.translate(None, UPPER.encode()))
    fails = {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * capitals > 10 * chars,
        "D": len(raw.translate(None, SYMBOLS)) < len(raw),
    }
    return sum(BIT[name] for name, failed in fails.items() if failed)


# -- smallest doc_id per text ----------------------------------------------------------------------

class Trie:
    """Compressed trie of texts: an edge is a run of characters, a terminal holds the smallest key."""

    __slots__ = ("edges", "least")

    def __init__(self, least=None):
        self.edges: dict[str, tuple[str, Trie]] = {}
        self.least = least

    def insert(self, text: str, key) -> None:
        node, at = self, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                node.edges[text[at]] = (text[at:], Trie(key))
                return
            run, below = edge
            same = _common(run, text, at)
            if same < len(run):  # the text leaves the edge half-way: a node there
                middle = Trie()
                middle.edges[run[same]] = (run[same:], below)
                node.edges[text[at]] = (run[:same], middle)
                below = middle
            node, at = below, at + same
        node.least = key if node.least is None else min(node.least, key)

    def terminals(self) -> Iterator:
        """The smallest key of every text."""
        open_ = [self]
        while open_:
            node = open_.pop()
            if node.least is not None:
                yield node.least
            open_.extend(below for _, below in node.edges.values())


def _common(run: str, text: str, at: int) -> int:
    """How many first characters ``run`` and text[at:] share."""
    low, high = 0, min(len(run), len(text) - at)
    if text.startswith(run[:high], at):
        return high
    while low < high:  # they share low, and high at most
        middle = (low + high + 1) // 2
        if text.startswith(run[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


def shared_prefixes(docs: DataFrame, groups: int = GROUPS) -> set[str]:
    """Prefixes of 2, 4, 8, ... code points under which different texts have more than 1/groups of all code
    points: fewer than ``groups`` of each length. Texts are counted once each, by their hashes, and by their
    first code points; only where these do not tell large groups apart, by longer ones."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("chars", F.length("text"))

    def heads(rows: DataFrame, length: int) -> DataFrame:
        once = rows.select(F.xxhash64("text").alias("h"), F.left("text", F.lit(length)).alias("head"), "chars")
        once = once.groupBy("h").agg(F.first("head").alias("head"), F.max("chars").alias("chars"))
        counted = once.groupBy("head").agg(F.sum("chars").alias("chars"), F.max("chars").alias("longest"))
        return materialise(counted, f"heads-{length}")

    found: set[str] = set()
    size, length, rows = FIRST_PREFIX, HEAD, heads(texts, HEAD)
    most = max((rows.agg(F.sum("chars")).first()[0] or 0) // groups, LEAST_GROUP)
    while True:
        shares = rows.groupBy(F.left("head", F.lit(size)).alias("prefix")).agg(F.sum("chars").alias("chars"), F.max("longest").alias("longest"))
        large = shares.filter((F.col("chars") > most) & (F.col("longest") > size)).select("prefix").collect()
        if not large:
            return found
        found |= {x.prefix for x in large}
        large = F.broadcast(spark.createDataFrame(large, "prefix string"))
        if 2 * size > length:
            length *= 4
            texts = texts.join(large, F.left("text", F.lit(size)) == F.col("prefix"), "left_semi")
            rows = heads(texts, length)
        else:
            rows = rows.join(large, F.left("head", F.lit(size)) == F.col("prefix"), "left_semi")
        size *= 2


def own_prefix(text: str, shared: set[str]) -> str:
    size = FIRST_PREFIX
    while text[:size] in shared and len(text) > size:
        size *= 2
    return text[:size]


def measured(docs: DataFrame, shared: Broadcast, merged: int = MERGED) -> DataFrame:
    """Two kinds of rows: per document part, mask (A to D), doc and the hash of its text; per text, as often
    as tasks (or a task, beyond ``merged`` code points) hold it, its prefix, smallest doc, hash and the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes: set[str] = shared.value
        held: dict[str, tuple[int, int]] = {}
        size = 0

        def rows(parts, masks, docs_, hashes, prefixes_, texts) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = map(pa.array, (parts, masks, docs_, hashes, prefixes_, texts), kinds)
            return pa.RecordBatch.from_arrays(list(columns), names=["part", "mask", "doc", "hash", "prefix", "text"])

        def owners() -> Iterator[pa.RecordBatch]:
            none, texts = [None] * len(held), list(held)
            own = [own_prefix(t, prefixes) for t in texts]
            return sliced(rows(none, none, [d for d, _ in held.values()], [h for _, h in held.values()], own, texts), ROWS)

        for batch in batches:
            ids, texts, parts = (c.to_pylist() for c in batch.columns)
            masks, hashes, none = [], [], [None] * len(ids)
            for doc, text in zip(ids, texts):
                raw = text.encode()
                masks.append(text_mask(raw, len(text)))
                hashes.append(xxhash.xxh64_intdigest(raw) - (1 << 63))
                known = held.get(text)
                if known is None:
                    size += len(text) + 64
                if known is None or doc < known[0]:
                    held[text] = doc, hashes[-1]
            yield rows(parts, masks, ids, hashes, none, none)
            if size >= merged:
                yield from owners()
                held, size = {}, 0
        yield from owners()

    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc")
    texts = docs.select(doc, F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("part"))
    return texts.mapInArrow(run, "part string, mask int, doc bigint, hash bigint, prefix string, text string")


def first_holders(texts: DataFrame) -> DataFrame:
    """(doc, hash) of the smallest doc of every text, by radix tries.

    A task gets a range of prefixes in order and has the trie of one prefix at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, prefix = Trie(), None

        def walk() -> pa.RecordBatch:
            keys = list(trie.terminals())
            columns = [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["doc", "hash"])

        for batch in batches:
            for at, doc, hash_, text in zip(*(c.to_pylist() for c in batch.columns)):
                if at != prefix:
                    yield walk()
                    trie, prefix = Trie(), at
                trie.insert(text, (doc, hash_))
        yield walk()

    rows = texts.select("prefix", "doc", "hash", "text").repartitionByRange("prefix").sortWithinPartitions("prefix")
    return rows.mapInArrow(run, "doc bigint, hash bigint")


def masks(docs: DataFrame, groups: int = GROUPS, merged: int = MERGED) -> DataFrame:
    """Per row of docs part, doc (a null doc_id: 2^63 - 1) and mask, the bits of the filters it fails.

    Rows with the doc_id that is the smallest of their text do not fail E, several of them neither; a null
    doc_id comes after all others. Texts are stored once per task and shuffled once."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(shared_prefixes(docs, groups))  # fewer than groups of each length
    with arrow_batches(spark, ROWS):
        stored = materialise(measured(docs, shared, merged), "audit")
        first = materialise(first_holders(stored.filter("mask is null")), "audit-first")
    first = first.distinct().withColumn("first", F.lit(True))
    rows = stored.filter("mask is not null").select("part", "mask", "doc", "hash").join(first, ["doc", "hash"], "left")
    repeated = F.when(F.col("first"), 0).otherwise(BIT["E"])
    return rows.select("part", "doc", F.col("mask").bitwiseOR(repeated).alias("mask"))


# -- all orders ------------------------------------------------------------------------------------

def audit(docs: DataFrame, labels: DataFrame, groups: int = GROUPS, merged: int = MERGED) -> DataFrame:
    """Per part (lang; null: empty string), order of the five filters and step, counts of documents.

    kept and removed after and at the step; redundant fail its filter but were removed before;
    unique_fails fail its filter only; good_lost and toxic_lost are removed here and have the label (a
    document's labels are the largest of its label rows); shapley is what the filter removes, summed over
    all orders. A null text is empty, repeated rows count each, no rows give no rows. Other columns of
    docs and labels are not read."""
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc"))
    marks = marks.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    cells = masks(docs, groups, merged).join(marks, "doc", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))

    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = cells.withColumn("filter_order", F.explode(orders))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = {name: F.instr("filter_order", name) for name in FILTERS}
    here = _bits({name: at == F.col("step") for name, at in place.items()})
    before = _bits({name: at < F.col("step") for name, at in place.items()})
    rows = rows.withColumn("here", F.col("mask").bitwiseAND(here)).withColumn("before", F.col("mask").bitwiseAND(before))
    fails, left = F.col("here") != 0, F.col("before") == 0

    def total(condition: Column, value: Column = F.col("n")) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("long")

    # in as many orders a document's filter comes first of those it fails
    first_in = F.floor(F.lit(120) / F.greatest(F.bit_count("mask"), F.lit(1)))
    return rows.groupBy("part", "filter_order", "step").agg(
        total(left & ~fails).alias("kept"),
        total(left & fails).alias("removed"),
        total(~left & fails).alias("redundant"),
        total(fails & (F.col("mask") == F.col("here"))).alias("unique_fails"),
        total(left & fails, F.col("good")).alias("good_lost"),
        total(left & fails, F.col("toxic")).alias("toxic_lost"),
        total(fails, F.col("n") * first_in).alias("shapley"),
    )


def _bits(chosen: dict[str, Column]) -> Column:
    return reduce(Column.bitwiseOR, [F.when(c, BIT[name]).otherwise(0) for name, c in chosen.items()])
