"""SimHash near-duplicates: fingerprints, links within a bit distance, connected components.

Only different fingerprints are compared, so exact copies cost one row. Two fingerprints that differ
in at most ``max_bits`` bits agree in one of ``max_bits + 1`` blocks. For each block the fingerprint
is rotated so that the block comes first; fingerprints that agree in it form one subtree of a binary
trie. A task walks such subtrees in pairs of nodes: it adds up the bits in which the two paths differ
and leaves a pair of nodes as soon as there are more than ``max_bits``. The sorted array of
fingerprints is the trie: a node is a range of it, its children are found with prefix sums of one bit.

A subtree with more than ``task_rows`` fingerprints is dealt out: its rows are split by hash into c
parts and every pair of parts is one task, so a task holds a bounded number of rows and every pair of
fingerprints still meets. c follows from the counted size by one formula for all sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import ship_by_value
from footfall.llm.components import components
from footfall.operators.joins import join_per_key
from footfall.sources.storage import materialise

ship_by_value(__name__)

BITS = 64
SEED = 42


def fingerprint(text: bytes, shingle: int) -> int:
    """64 majority bits of the shingle hashes of a UTF-8 text; 0 for a text without words."""
    parts = text.lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in parts])
    starts = [0, *ends[:-shingle].tolist()]
    hashes = np.array(
        [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())],
        dtype="<u8",
    )
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        octets = hashes[at:at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, keep: list[str | Column]) -> DataFrame:
    """The columns ``keep`` and the fingerprint as a signed bigint ``fp``. A null text has no words."""
    rows = docs.select(*keep, F.col("text").cast("binary").alias("_text"))
    kept = rows.drop("_text")
    schema = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes) + ", fp bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t or b"", shingle) for t in batch.column(batch.num_columns - 1).to_pylist()], dtype=np.uint64)
            columns = batch.columns[:-1] + [pa.array(made.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "fp"])

    return rows.mapInArrow(run, schema)


def _children(lo, hi, ones):
    """Border between the 0 child and the 1 child of the node [lo, hi); ones: prefix sums of the bit."""
    return hi - (ones[hi] - ones[lo])


def _leaf_pairs(values, subtrees, levels, budget, most=1 << 20):
    """Index pairs (i < j) inside each subtree whose values differ in at most ``budget`` bits.

    values: sorted inside each subtree; levels: the bits below a subtree's root, from the top.
    The frontier of node pairs is kept below ``most`` by going deep with one part at a time."""
    ones = {}
    lo, hi = subtrees
    todo = [(0, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while todo:
        depth, alo, ahi, blo, bhi, diff = todo.pop()
        if len(alo) > most:
            half = len(alo) // 2
            todo += [(depth, *(x[half:] for x in (alo, ahi, blo, bhi, diff)))]
            alo, ahi, blo, bhi, diff = (x[:half] for x in (alo, ahi, blo, bhi, diff))
            todo.append((depth, alo, ahi, blo, bhi, diff))
            continue
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            near = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
            if near.any():
                yield i[near], j[near]
            alo, ahi, blo, bhi, diff = (x[~single] for x in (alo, ahi, blo, bhi, diff))
        if not len(alo):
            continue
        if depth == len(levels):  # equal paths: the same value cannot occur twice in a subtree
            continue
        bit = levels[depth]
        if depth not in ones:
            ones[depth] = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        amid, bmid = _children(alo, ahi, ones[depth]), _children(blo, bhi, ones[depth])
        same = alo == blo
        cross = ~same
        parts = [
            (alo, amid, blo, bmid, diff, np.ones(len(alo), bool)),
            (amid, ahi, bmid, bhi, diff, np.ones(len(alo), bool)),
            (alo, amid, bmid, bhi, diff + 1, np.ones(len(alo), bool)),
            (amid, ahi, blo, bmid, diff + 1, cross),  # of a node with itself this pair is the one above
        ]
        made = []
        for a0, a1, b0, b1, d, use in parts:
            use = use & (a1 > a0) & (b1 > b0) & (d <= budget) & ~((a0 == b0) & (a1 - a0 == 1))
            made.append([x[use] for x in (a0, a1, b0, b1, d)])
        todo.append((depth + 1, *(np.concatenate(x) for x in zip(*made))))


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the classes of i and j in ``label``, which points at the smallest member."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            jump = label[label]
            if (jump == label).all():
                break
            label[:] = jump


def _tree_edges(task, block, x, width: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest over the links of every subtree of every task in the arrays."""
    order = np.lexsort((x, block, task))
    task, block, x = task[order], block[order], x[order]
    node = x >> np.uint64(BITS - width)
    new = (task[1:] != task[:-1]) | (block[1:] != block[:-1]) | (node[1:] != node[:-1])
    borders = np.flatnonzero(np.concatenate([[True], new, [True]]))
    label = np.arange(len(x))
    levels = list(range(BITS - width - 1, -1, -1))
    for i, j in _leaf_pairs(x, (borders[:-1], borders[1:]), levels, budget):
        _unite(label, i, j)
    moved = np.flatnonzero(label != np.arange(len(x)))
    turn = (block[moved] * width).astype(np.uint64)
    back = (np.uint64(BITS) - turn) % np.uint64(BITS)
    return tuple((v >> turn) | np.where(turn > 0, v << back, 0).astype(np.uint64) for v in (x[moved], x[label[moved]]))


def links(prints: DataFrame, max_bits: int = 3, task_rows: int = 20_000, at_once: int = 100_000) -> DataFrame:
    """Edges (u, v) between different fingerprints at ``max_bits`` or fewer differing bits.

    ``prints``: one column fp, each fingerprint once. Of the links inside a task a spanning forest is
    returned: every connected set stays connected, and rows grow with the fingerprints, not with the
    links. Small subtrees are walked together, ``at_once`` rows at a time."""
    blocks = max_bits + 1
    width = BITS // blocks
    # rotated so that the block's bits come first; the last block takes the rest of the bits
    turned = [F.shiftleft("fp", b * width).bitwiseOR(F.shiftrightunsigned("fp", BITS - b * width)) if b else F.col("fp") for b in range(blocks)]
    rows = prints.select(F.posexplode(F.array(*turned)).alias("block", "x"))
    rows = rows.withColumn("node", F.shiftrightunsigned("x", BITS - width))
    sizes = rows.groupBy("block", "node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    half = max(1, task_rows // 2)
    rows = join_per_key(rows, sizes, ["block", "node"]).withColumn("c", F.ceil(F.col("n") / half).cast("int"))
    own = F.pmod(F.xxhash64("x"), F.col("c")).cast("int")
    others = F.when(F.col("c") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("c") - 1), lambda o: o != F.col("own")))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(others))
    task = F.xxhash64("block", "node", F.least("own", "other"), F.greatest("own", "other"))
    rows = rows.select(task.alias("task"), "block", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows_held = 0

        def edges(columns):
            u, v = _tree_edges(*columns, width, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            task, block, x = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            held.append([task, block, x.view(np.uint64)])
            rows_held += len(task)
            if rows_held < at_once or held[0][0][0] == task[-1]:
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            cut = np.searchsorted(columns[0], task[-1])  # the last task may go on in the next batch
            yield edges([c[:cut] for c in columns])
            held, rows_held = [[c[cut:] for c in columns]], len(columns[0]) - cut
        if rows_held:
            yield edges([np.concatenate(c) for c in zip(*held)])

    dealt = rows.repartition("task").sortWithinPartitions("task")
    return dealt.mapInArrow(run, "u bigint, v bigint").distinct()


def group_prints(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fp, root) for fingerprints that have a link; root is one of the component's fingerprints."""
    found = components(links(prints, max_bits))
    return found.select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Per row of docs: doc_id, fp (signed), fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id of the component. Rows that repeat a doc_id are rows of their
    own; a null doc_id counts for no minimum, and a component of null ids only has a null id. A null
    or empty text has fingerprint 0 and is linked like any other. An empty table gives no rows."""
    prints = materialise(fingerprints(docs, shingle, ["doc_id"]), "prints")
    smallest = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    smallest = materialise(smallest, "distinct-prints")
    roots = group_prints(smallest.select("fp"), max_bits)
    owned = smallest.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    whole = owned.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = join_per_key(owned, whole, ["root"]).select("fp", "component_id")
    out = join_per_key(prints, classes, ["fp"])
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select("doc_id", "fp", text.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """docs with one row of each component: that with the smallest doc_id, of several such rows that
    with the smallest content hash, of equal rows one. A null doc_id comes last. All columns stay."""
    key = [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1)).alias("_footfall_id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("_footfall_row")]
    prints = materialise(fingerprints(docs, shingle, key), "prints")
    first = F.min(F.struct("_footfall_id", "_footfall_row")).alias("first")
    smallest = materialise(prints.groupBy("fp").agg(first), "distinct-prints")
    roots = group_prints(smallest.select("fp"), max_bits)
    owned = smallest.join(roots, "fp", "left")
    kept = owned.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    kept = kept.select("first.*")
    marked = docs.select("*", *key)
    return marked.join(kept, ["_footfall_id", "_footfall_row"], "left_semi").dropDuplicates(["_footfall_id", "_footfall_row"]).select(*[F.col(f"`{c}`") for c in docs.columns])
