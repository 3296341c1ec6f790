"""Token counts and ids by a given tokenizer file, without shuffling pre-tokens.

A byte-level BPE cuts a text into pre-tokens and encodes each on its own, so the ids of a text are the
ids of its pre-tokens one after the other. Two tiers answer for a pre-token: a table of the most
frequent ones of the corpus, sent to every executor, then a bounded cache in each worker process that
asks the library once per new pre-token. Texts the fast cut may not treat as the library does (rare
characters, special strings) and other kinds of tokenizer go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import ship_by_value
from footfall.sources.storage import materialise

ship_by_value(__name__)

#: The letters up to U+024F.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
#: Fixed value: the cut of byte-level BPE into contractions, letters, numbers, the rest and white space,
#: for texts of the characters below only.
PRE_TOKEN = rf" ?[{LETTERS}]+|'(?:[sdmt]|ll|ve|re)| ?[0-9]+| ?[^\s0-9{LETTERS}]+|\s+(?!\S)|\s+"
#: All but Latin up to U+024F without superscripts, fractions and separators, and common punctuation.
UNSURE = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧‰-⁞€]")

#: Most pre-tokens that a task reports to the frequency count, and that the table holds.
TABLE_SIZE = 65_536
#: A worker keeps at most twice as many pre-tokens.
CACHE_SIZE = 500_000


class _Cache(dict):
    """Pre-token -> value in two generations: when the young one is full, it replaces the old one."""

    def __init__(self, encode, size: int):
        super().__init__()
        self.encode, self.size, self.old, self.table = encode, size, {}, {}

    def __missing__(self, piece: str):
        value = self.table.get(piece)
        if value is None:
            value = self.old.get(piece)
        if value is None:
            value = self.encode(piece)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[piece] = value
        return value


class Encoder:
    """Ids of whole texts as little-endian 32-bit numbers, without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.special: tuple[str, ...] = ()
        self.pattern = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._ids = lambda text: model.encode(text, num_threads=1)
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self._ids = lambda text: model.encode(text, add_special_tokens=False).ids
            bpe = model.model  # keeps the tokenizer's model at hand, without its cut and its offsets
            with open(path, encoding="utf-8") as f:
                kind = json.load(f)
            cut = kind.get("pre_tokenizer") or {}
            self.special = tuple(t["content"] for t in kind.get("added_tokens") or ())
            if cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and not kind.get("normalizer"):
                self.pattern = re.compile(PRE_TOKEN)
                self._tokens = lambda piece: bpe.tokenize(piece.encode().decode("latin-1").translate(BYTE_CHARACTERS))
        self.lengths = _Cache(lambda piece: len(self._tokens(piece)), CACHE_SIZE)
        self.ids = _Cache(lambda piece: _packed([t.id for t in self._tokens(piece)]), CACHE_SIZE)

    def pieces(self, text: str) -> list[str] | None:
        """The pre-tokens, or None if the text has to go to the library whole."""
        if self.pattern is None or UNSURE.search(text) or any(s in text for s in self.special):
            return None
        return self.pattern.findall(text)

    def count(self, text: str) -> int:
        pieces = self.pieces(text)
        return len(self._ids(text)) if pieces is None else sum(map(self.lengths.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        pieces = self.pieces(text)
        return _packed(self._ids(text)) if pieces is None else b"".join(map(self.ids.__getitem__, pieces))


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _byte_characters() -> dict[int, str]:
    """Byte-level BPE spells a byte as a character: printable Latin-1 as itself, the others in order
    from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return {b: chr(b if b in shown else next(hidden)) for b in range(256)}


BYTE_CHARACTERS = _byte_characters()


def encoder(path: str) -> Encoder:
    """The worker process's encoder of this file; it outlives the task."""
    home = sys.modules.setdefault("_footfall_worker", types.ModuleType("_footfall_worker"))
    kept = home.__dict__.setdefault("encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _texts(batch: pa.RecordBatch, column: int) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def frequent_pieces(docs: DataFrame, path: str, size: int = TABLE_SIZE) -> DataFrame:
    """(piece, n): pre-tokens with a share of 1/size or more of what the tasks report, so ``size`` at
    most. Each task counts all its pre-tokens and reports the ``size`` most frequent; only these reports
    are shuffled, never the pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, seen = encoder(path), Counter()
        for batch in batches:
            for text in _texts(batch, 0):
                seen.update(made.pieces(text) or ())
            if len(seen) > 8 * size:  # a piece this rare in the task is no frequent one
                seen = Counter(dict(seen.most_common(4 * size)))
        top = seen.most_common(size)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    counted = docs.select("text").mapInArrow(run, "piece string, n bigint")
    counted = materialise(counted.groupBy("piece").agg(F.sum("n").alias("n")), "pieces")
    total = counted.agg(F.sum("n")).first()[0] or 0
    return counted.filter(F.col("n") * size >= total)


def token_counts(docs: DataFrame, path: str, table_size: int = TABLE_SIZE) -> DataFrame:
    """Per row doc_id, n_bytes (UTF-8) and n_tokens of the whole text; a null text is empty: 0 and 0.

    Special strings inside a text count as the library's default has them. Repeated rows are counted
    each; no rows give no rows. ``path`` is read on every executor."""
    table = frequent_pieces(docs, path, table_size)
    spark = docs.sparkSession

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path)
        for batch in batches:
            pieces = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(made._tokens(p)) for p in pieces], pa.int32())], names=["piece", "size"])

    sizes = table.select("piece").mapInArrow(lengths, "piece string, size int")
    shared = spark.sparkContext.broadcast({r.piece: r.size for r in sizes.collect()})  # table_size rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path)
        made.lengths.table = shared.value
        for batch in batches:
            texts = _texts(batch, 1)
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(map(made.count, texts), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
