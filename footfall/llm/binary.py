"""Token ids as Arrow files: sequences of equal length with masks, read without copying.

    write(docs, tokenizer_path, folder)          # ids of all documents in ascending doc_id order
    with TokenFile(path) as f:
        ids, mask = f[k]                         # ids: a view into the mapped file

A file is an Arrow stream file (IPC file format, uncompressed) with record batches of ``rows`` sequences:
``ids`` (16 bits where the vocabulary allows it, else 32) and the bit lists ``mask`` and ``ends`` are
fixed-size lists of length ``size``, so sequence k lies at a known place of batch k // rows. A document is
its ids and a closing id 0; documents follow each other without gaps, and only a file's last sequence is
padded. The mask has a bit for every token (padding: 0), ``ends`` for the last token of a document;
``doc_ids`` lists the documents that end in the sequence, so a file tells its documents without any other
table.

A task writes one file, of a range of doc_ids. The table ``_files`` beside them names the files of tasks that
ended, with the number of tokens before each; files of lost attempts are not in it and are never read.
"""

from __future__ import annotations

import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from footfall.llm.common import arrow_batches, ship_by_value
from footfall.llm.tokens import encoder

ship_by_value(__name__)

END = (0).to_bytes(4, "little")
FILES = "_files"
FILE_ROWS = "file string, tokens bigint, sequences bigint, batches bigint, docs bigint, start bigint"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it. Hadoop writes local paths with one slash or three, and unescaped."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), path.removeprefix("file://").removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def vocabulary(tokenizer: str) -> int:
    """Number of ids, added ones included."""
    if tokenizer.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=tokenizer).get_piece_size()
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values()) + 1


# -- writing ---------------------------------------------------------------------------------------

class _Sequences:
    """Cuts documents that follow each other into batches of full sequences."""

    def __init__(self, size: int, rows: int, token: pa.DataType, doc_id: pa.DataType):
        self.size, self.rows = size, rows
        kinds = {"ids": token, "mask": pa.bool_(), "ends": pa.bool_()}
        lists = [(name, pa.list_(pa.field("item", kind, False), size)) for name, kind in kinds.items()]
        self.schema = pa.schema([*lists, ("doc_ids", pa.list_(doc_id))])
        self.parts: list[np.ndarray] = []
        self.ends: list[int] = []
        self.docs: list = []
        self.held = 0

    def add(self, doc, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(ids)
        self.held += len(ids)
        self.ends.append(self.held - 1)
        self.docs.append(doc)
        if self.held >= self.size * self.rows:
            yield from self.batches(self.held // (self.size * self.rows) * self.rows)

    def batches(self, n: int) -> Iterator[pa.RecordBatch]:
        """The first n sequences, padded where the tokens end, in batches of ``rows``."""
        ids, used = np.concatenate(self.parts), n * self.size
        ends = np.zeros(len(ids), bool)
        ends[self.ends] = True
        fits = np.searchsorted(self.ends, used)  # documents that end before
        at = np.searchsorted(self.ends[:fits], np.arange(n + 1) * self.size).astype(np.int32)
        docs = pa.ListArray.from_arrays(pa.array(at), pa.array(self.docs[:fits], self.schema.field("doc_ids").type.value_type))
        full = [np.pad(x[:used], (0, max(0, used - len(x)))) for x in (ids, np.ones(len(ids), bool), ends)]
        for a in range(0, n, self.rows):
            b = min(n, a + self.rows)
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(x[a * self.size:b * self.size]), type=self.schema.field(k).type)
                for k, x in enumerate(full)
            ]
            yield pa.RecordBatch.from_arrays([*columns, docs[a:b]], schema=self.schema)
        # open documents go on in the next sequences
        self.parts, self.held = [ids[used:]], max(0, len(ids) - used)
        self.ends, self.docs = [e - used for e in self.ends[fits:]], self.docs[fits:]

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield from self.batches(-(-self.held // self.size))


def write(docs: DataFrame, tokenizer: str, folder: str, size: int = 1024, rows: int = 256) -> DataFrame:
    """Writes docs below ``folder`` and returns the stored table of files: file, tokens, sequences, batches,
    docs, start (tokens in all files before).

    Rows with equal doc_ids follow each other by text, repeated rows are written each; a null doc_id comes
    first, a null text is the closing id alone. No rows give no files. Texts are shuffled once; a doc_id of
    any number of rows is spread over several files."""
    spark = docs.sparkSession
    token = np.dtype("<u2" if vocabulary(tokenizer) <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, context, out, cut = encoder(tokenizer), TaskContext.get(), None, None
        tokens = sequences = n_batches = n_docs = 0
        fs, root = _open(folder)
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.arrow"

        def put(batch: pa.RecordBatch) -> None:
            nonlocal sequences, n_batches
            out.write_batch(batch)
            sequences, n_batches = sequences + batch.num_rows, n_batches + 1

        try:
            for batch in batches:
                if out is None and batch.num_rows:
                    fs.create_dir(root, recursive=True)
                    cut = _Sequences(size, rows, pa.from_numpy_dtype(token), batch.column(0).type)
                    sink = fs.open_output_stream(posixpath.join(root, name), compression=None)
                    out = pa.ipc.new_file(sink, cut.schema)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ids = np.frombuffer(made.encode(text or "") + END, "<u4").astype(token)
                    tokens, n_docs = tokens + len(ids), n_docs + 1
                    for full in cut.add(doc, ids):
                        put(full)
            if out is not None:
                for last in cut.rest():
                    put(last)
        finally:
            if out is not None:
                out.close()
                sink.close()
        if out is not None:
            row = [context.partitionId(), name, tokens, sequences, n_batches, n_docs]
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=["part", "file", "tokens", "sequences", "batches", "docs"])

    order = ["doc_id", "_text_hash", "_row"]
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("_text_hash"), F.monotonically_increasing_id().alias("_row"))
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    files = ordered.mapInArrow(run, "part int, file string, tokens bigint, sequences bigint, batches bigint, docs bigint")
    with arrow_batches(spark, 512):
        found = sorted(files.collect())  # a row per task
    rows_, start = [], 0
    for f in found:
        rows_.append((f.file, f.tokens, f.sequences, f.batches, f.docs, start))
        start += f.tokens
    path = posixpath.join(folder, FILES)
    spark.createDataFrame(rows_, FILE_ROWS).write.mode("error").parquet(path)
    return spark.read.schema(FILE_ROWS).parquet(path)


# -- reading ---------------------------------------------------------------------------------------

class TokenFile:
    """Random access to one file. On a local or mounted folder ids are views into the mapped file."""

    def __init__(self, path: str):
        fs, at = _open(path)
        self.source = pa.memory_map(at) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(at)
        self.file = pa.ipc.open_file(self.source)
        self.size = self.file.schema.field("ids").type.list_size
        self.batches = self.file.num_record_batches
        self.rows = self.file.get_batch(0).num_rows if self.batches else 0

    def __len__(self) -> int:
        return (self.batches - 1) * self.rows + self.file.get_batch(self.batches - 1).num_rows if self.batches else 0

    def batch(self, k: int) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array]:
        """Ids, mask and ends of all sequences of a batch one after the other, and the documents that end
        there."""
        found = self.file.get_batch(k)
        ids, mask, ends, docs = (found.column(i).flatten() for i in range(4))
        return ids.to_numpy(zero_copy_only=True), mask, ends, docs

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if not 0 <= k < len(self):
            raise IndexError(k)
        ids, mask, *_ = self.batch(k // self.rows)
        at = k % self.rows * self.size
        return ids[at:at + self.size], mask.slice(at, self.size).to_numpy(zero_copy_only=False)

    def documents(self, first: int, end: int) -> Iterator[tuple]:
        """(doc_id, start, tokens, crc32 of the ids) of the documents that start in batches [first, end)."""
        per_batch = self.rows * self.size
        skipping = first > 0 and not self.batch(first - 1)[2][-1].as_py()  # the open one started earlier
        start, n, crc = first * per_batch, 0, 0
        for k in range(first, self.batches):
            if k >= end and (skipping or not n):
                return
            ids, mask, ends, docs = self.batch(k)
            ids = ids.astype("<u4")
            at = 0
            for stop, doc in zip((np.flatnonzero(ends) + 1).tolist(), docs.to_pylist()):
                if not skipping:
                    yield doc, start, n + stop - at, zlib.crc32(ids[at:stop], crc)
                skipping, at, n, crc = False, stop, 0, 0
                start = k * per_batch + at
                if k >= end:
                    return
            tail = ids[at:mask.true_count]  # only a file's last sequence is padded, at its end
            if not skipping:
                n, crc = n + len(tail), zlib.crc32(tail, crc)

    def __enter__(self) -> TokenFile:
        return self

    def __exit__(self, *error) -> None:
        self.source.close()


def read_documents(spark: SparkSession, folder: str, id_type: str = "bigint", batches: int = 16) -> DataFrame:
    """Per document of the files doc_id, start (tokens of all documents before it), n_tokens, ids_crc32.

    A task reads ``batches`` batches of a file and follows the last document beyond them."""
    files = spark.read.schema(FILE_ROWS).parquet(posixpath.join(folder, FILES))
    last = F.expr(f"(batches - 1) div {batches}")
    units = files.select("file", "start", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("unit"))
    units = units.repartition(max(1, units.count()))  # a task each, however small the table is
    kind = to_arrow_type(DataType.fromDDL(id_type))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in found:
            for unit in part.to_pylist():
                with TokenFile(posixpath.join(folder, unit["file"])) as f:
                    rows = list(f.documents(unit["unit"] * batches, (unit["unit"] + 1) * batches))
                docs, starts, *rest = zip(*rows) if rows else [[]] * 4
                columns = [pa.array(docs, kind), pa.array([unit["start"] + x for x in starts], pa.int64())]
                columns += [pa.array(c, pa.int64()) for c in rest]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return units.mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
