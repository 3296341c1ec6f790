"""Collocations: phrases whose words stand together more often than their parts would by chance.

Frequent phrases are found by dynamic itemset counting. Texts are cut once into words and stored in
``shards``. Scan t reads shard t mod ``shards`` and counts phrases of all lengths side by side. Words count
in the first cycle. A longer phrase becomes active as soon as both its subphrases (without the last and
without the first word) have reached the threshold in what was counted so far, also in the middle of a
cycle; it is counted in the ``shards`` scans from then on, so in every shard once, and then rests. The
scans end when nothing is active.

Which phrases have reached the threshold goes to the tasks as a Bloom filter of ``filter_bits`` bits,
whatever their number. A phrase is active from the first scan in which the filter has both subphrases; the
filter only ever grows and is the same in every task, so a phrase it takes too early is also counted for
exactly one cycle. All counts are exact; what the filter costs is counting of phrases that stay rare.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.llm.common import UPPER, arrow_batches, ship_by_value
from footfall.operators.joins import join_per_key
from footfall.operators.ranking import first_k
from footfall.session import new_path, release
from footfall.sources.storage import materialise

ship_by_value(__name__)

#: Stands for a break between pieces; no word holds a dot.
BREAK = b"."
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
#: A-Z in lower case, breaks as dots.
PLAIN = bytes.maketrans(UPPER.encode() + BREAKS, UPPER.lower().encode() + BREAK * len(BREAKS))
MOST_WORDS = 5
SHARDS = 3
#: Words of a stored chunk, and those that a scan counts at a time.
CHUNK = 1 << 20
AT_ONCE = 1 << 22
STEP = np.uint64(0x9E3779B97F4A7C15)


class _Codes(dict):
    """Word -> number in order of first sight; the break is 0."""

    def __init__(self):
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def cut(text: bytes) -> list[bytes]:
    """Lower-cased words, with breaks between two pieces and at the end."""
    # white space that is left besides the breaks is blank and tab
    words = text.translate(PLAIN).replace(BREAK, b" . ").split()
    words.append(BREAK)
    return words


def encode_shards(docs: DataFrame, shards: int, chunk: int = CHUNK) -> DataFrame:
    """(lang, words, hashes, codes, n_words, shard): runs of texts of one language as numbers into their own
    word list, which is joined by blanks.

    A null text is empty, a null language ``und``. A text of any length is one run of at most its own words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, open_ = TaskContext.get().partitionId(), 0, {}

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal made
            words, parts, _ = open_.pop(lang)
            codes = np.concatenate(parts)
            made += 1
            own = list(words)[1:]
            return pa.RecordBatch.from_pydict({
                "lang": [lang], "words": [b" ".join(own)], "hashes": [word_hashes(lang, own).tobytes()],
                "codes": pa.array([codes.tobytes()], pa.binary()), "n_words": [np.count_nonzero(codes)],
                "shard": pa.array([(part + made) % shards], pa.int32()),
            })

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, text = lang.as_py(), text.as_py()
                if not text:
                    continue
                kept = open_.setdefault(lang, [_Codes(), [], 0])
                words = cut(text)
                kept[1].append(np.fromiter(map(kept[0].__getitem__, words), "<i4", len(words)))
                kept[2] += len(words)
                if kept[2] >= chunk:
                    yield flush(lang)
        for lang in list(open_):
            yield flush(lang)

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "lang string, words binary, hashes binary, codes binary, n_words bigint, shard int")


# -- the filter ------------------------------------------------------------------------------------

def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def longer(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases made longer by a word."""
    h = (hashes ^ (hashes >> np.uint64(29))) * STEP + word
    return h ^ (h >> np.uint64(32))


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mixed = hashes * STEP
    mask = np.uint64(bits - 1)
    return mixed >> np.uint64(8) & mask, (mixed >> np.uint64(36) ^ hashes) & mask


def in_filter(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    a, b = _probes(hashes, bitmap.size * 8)
    found = bitmap[a >> np.uint64(3)] >> (a & np.uint64(7)).astype(np.uint8) & 1
    found &= bitmap[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8) & 1
    return found.astype(bool)


def filter_of(phrases: DataFrame, bits: int, before: np.ndarray) -> np.ndarray:
    """``before`` with the phrases added. The driver gets at most bits / 64 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = word_hashes(lang, bytes(phrase).split(b" "))
                h = words[:1]
                for k in range(1, len(words)):
                    h = longer(h, words[k:k + 1])
                hashes.append(h)
            at = np.concatenate(_probes(np.concatenate(hashes), bits)) if hashes else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["at", "bit"])

    marks = phrases.select("lang", "phrase").mapInArrow(run, "at bigint, bit bigint")
    # both columns as one binary of the driver: 16 bytes a number
    found = marks.groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = before.copy().view(np.uint64)
    out[found.column("at").to_numpy()] |= found.column("bit").to_numpy().view(np.uint64)
    return out.view(np.uint8)


# -- one scan --------------------------------------------------------------------------------------

def _count(lang: str, words: list[bytes], hashes: np.ndarray, codes: np.ndarray, now, old, first_cycle: bool):
    """(phrases, counts) of everything active in these codes, one length after the other.

    now and old are the filters of this scan and of the one a cycle ago."""
    names = pa.array(words, pa.binary())
    real = codes > 0
    if first_cycle:
        n = np.bincount(codes, minlength=len(words))
        n[0] = 0
        seen = np.flatnonzero(n)
        yield names.take(pa.array(seen)), n[seen]
    h = hashes[codes]
    by_word = [in_filter(x, hashes) if x is not None else np.zeros(len(words), bool) for x in (now, old)]
    known, rested = (x[codes] & real for x in by_word)
    for size in range(2, MOST_WORDS + 1):
        at = np.flatnonzero(known[:-1] & known[1:])  # windows by their first position
        if not at.size:
            return
        over = rested[at] & rested[at + 1]
        live = at[~over]
        if live.size:
            yield _windows(names, codes, live, size)
        if size == MOST_WORDS:
            return
        h_at = longer(h[at], hashes[codes[at + size - 1]])
        h = np.zeros_like(h)
        h[at] = h_at
        # a cycle ago a phrase was known by the same steps: through its subphrases
        known, rested = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
        known[at] = in_filter(now, h_at)
        if old is not None:
            rested[at[over]] = in_filter(old, h_at[over])


def _windows(names: pa.Array, codes: np.ndarray, at: np.ndarray, size: int) -> tuple[pa.Array, np.ndarray]:
    """Different windows of ``size`` words at these positions, with their counts."""
    key = codes[at].astype(np.int64)
    for k in range(1, size):
        if k > 1:  # numbers of the windows so far, so that two numbers fit in one key
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key << 32 | codes[at + k]
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    start = at[first]
    parts = [names.take(pa.array(codes[start + k])) for k in range(size)]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())), n


def _unpacked(bitmap: bytes | None) -> np.ndarray | None:
    return None if bitmap is None else np.frombuffer(zlib.decompress(bitmap), np.uint8)


def scan(shard: DataFrame, filters: Broadcast, first_cycle: bool, at_once: int = AT_ONCE) -> DataFrame:
    """(lang, phrase, n): counts of the active phrases in the shard, combined within tasks. A task holds
    ``at_once`` words and one chunk at most. filters: that of this scan and of the one a cycle ago."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, old = map(_unpacked, filters.value)
        open_: dict[str, list] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            codes, hashes, parts, _ = open_.pop(lang)
            words = list(codes)
            for phrases, n in _count(lang, words, np.concatenate(hashes), np.concatenate(parts), now, old, first_cycle):
                for a in range(0, len(n), 20_000):
                    part = phrases.slice(a, 20_000)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), part, pa.array(n[a:a + 20_000], pa.int64())], names=["lang", "phrase", "n"])

        for batch in batches:
            for row in range(batch.num_rows):
                lang = batch.column(0)[row].as_py()
                words = batch.column(1)[row].as_py()
                words = words.split(b" ") if words else []
                hashes, codes = (np.frombuffer(batch.column(k)[row].as_buffer(), t) for k, t in ((2, "<u8"), (3, "<i4")))
                kept = open_.setdefault(lang, [_Codes(), [np.zeros(1, np.uint64)], [], 0])
                before = len(kept[0])
                own = np.fromiter(map(kept[0].__getitem__, words), "<i4", len(words))
                kept[1].append(hashes[own >= before])  # new words, numbered in their order
                kept[2].append(np.concatenate([np.zeros(1, "<i4"), own])[codes])
                kept[3] += len(codes)
                if kept[3] >= at_once:
                    yield from flush(lang)
        for lang in list(open_):
            yield from flush(lang)

    return shard.select("lang", "words", "hashes", "codes").mapInArrow(run, "lang string, phrase binary, n bigint")


def store_shards(docs: DataFrame, shards: int, chunk: int = CHUNK) -> DataFrame:
    path = new_path(docs.sparkSession, "phrase-shards")
    coded = encode_shards(docs, shards, chunk)
    with arrow_batches(docs.sparkSession, 512):
        coded.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(coded.schema).parquet(path)


def frequent_phrases(
    stored: DataFrame, min_count: int, shards: int, filter_bits: int = 1 << 26, at_once: int = AT_ONCE
) -> DataFrame:
    """(lang, phrase, n) of all phrases of 1 to 5 words with n >= min_count, from stored shards.

    Counts of phrases whose cycle is not over are carried from scan to scan, and the table of the scan before
    is deleted when the next one stands; of the others those with enough are kept."""
    spark = stored.sparkSession
    filters: list[np.ndarray | None] = []
    now = np.zeros(filter_bits // 8, np.uint8)
    live, folder, found = None, None, []
    for t in count():
        filters.append(now)
        old = filters[t - shards] if t >= shards else None
        if old is not None and np.array_equal(now, old):
            break  # nothing is active, now or later
        packed = [None if x is None else zlib.compress(x, 1) for x in (now, old)]
        shared = spark.sparkContext.broadcast(packed)  # filter_bits / 8 bytes each at most
        counts = scan(stored.filter(F.col("shard") == t % shards), shared, t < shards, at_once)
        counts = counts.withColumn("since", F.lit(t))
        if live is not None:
            counts = counts.unionByName(live)
        # tasks have combined what they counted: rows are added up after the shuffle only
        counts = counts.repartition("lang", "phrase").groupBy("lang", "phrase")
        counts = counts.agg(F.sum("n").alias("n"), F.min("since").alias("since"))
        before, folder = folder, new_path(spark, f"phrase-counts-{t}")
        with arrow_batches(spark, 2):  # chunks
            counts.write.option("compression", "zstd").parquet(folder)
        shared.destroy()
        if before is not None:
            release(spark, before)
        state = spark.read.schema(counts.schema).parquet(folder)
        reached = materialise(state.filter(F.col("n") >= min_count), f"phrases-{t}")
        text = F.col("phrase").cast("string")
        words = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
        now = filter_of(reached.filter(words < MOST_WORDS), filter_bits, now)  # of which longer ones are made
        # a phrase seen in scan s was active in s or before
        over = F.col("since") + shards <= t + 1
        found.append(reached.filter(over))
        live = state.filter(~over)
        if t >= shards:
            filters[t - shards] = None
    found.append(live.filter(F.col("n") >= min_count))
    return reduce(DataFrame.unionByName, found).select("lang", F.col("phrase").cast("string").alias("phrase"), "n")


# -- scores ----------------------------------------------------------------------------------------

def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(38,0)")


def collocations(
    docs: DataFrame, top: int = 2000, min_count: int = 100, cover: int = 100, shards: int = SHARDS,
    filter_bits: int = 1 << 26, chunk: int = CHUNK, at_once: int = AT_ONCE,
) -> DataFrame:
    """Per language the ``top`` phrases of 2 to 5 words by score: lang, rank, phrase, a, l, r, n, score.

    Text is cut at ``[.,;:!?\\x0A-\\x0D]`` and into words at blank and tab, A-Z in lower case. n: words of
    the language; a: occurrences of the phrase, at least min_count; l, r: those of its two parts at the cut
    with the lowest floor(1000 a n / (l r)), the shorter left part on ties. A phrase inside a longer one
    with ``cover`` percent of its occurrences or more is left out. Ties: larger a, then the phrase's bytes.

    A null text has no words, a null language is ``und``; repeated rows count each; no rows, or no
    frequent phrase, give no rows. Only lang and text of docs are read."""
    stored = store_shards(docs, shards, chunk)
    frequent = materialise(frequent_phrases(stored, min_count, shards, filter_bits, at_once), "phrases")
    totals = stored.groupBy("lang").agg(F.sum("n_words").alias("all"))
    words = F.split("phrase", " ")
    phrases = frequent.select("lang", "phrase", F.col("n").alias("a"), words.alias("words")).filter(F.size("words") > 1)
    part = frequent.withColumnRenamed("n", "f")

    def joined(first, size) -> Column:
        return F.array_join(F.slice("words", first, size), " ")

    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("words") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), lambda i: joined(i, size)),
    ))
    within = phrases.filter(F.size("words") > 2).select("lang", F.col("a").alias("longer"), F.explode(inner).alias("phrase"))
    within = within.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = join_per_key(phrases, within, ["lang", "phrase"], "left")
    kept = kept.filter(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))

    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.size("words")).alias("right"))
    cuts = join_per_key(cuts, part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = join_per_key(cuts, part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang").withColumn("num", 1000 * _exact("a") * _exact("all")).withColumn("den", _exact("l") * _exact("r"))
    cuts = cuts.withColumn("score", F.expr("num div den"))
    best = cuts.groupBy("lang", "phrase", "a", "all").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = best.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("all").alias("n"), "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    best = first_k(scored, ["lang"], top, order)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return best.select("lang", rank.alias("rank"), "phrase", "a", "l", "r", "n", "score")
