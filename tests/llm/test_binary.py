from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import binary

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def documents(rng, n):
    rows = [(k, " ".join(rng.choice(["the", "cat", "Größe", "日本", "x1", "\n"]) for _ in range(rng.randrange(0, 60)))) for k in range(n)]
    rng.shuffle(rows)
    return rows + [(n, "long text " * 3000), (n + 1, ""), (n + 2, None), (-5, "first <|endoftext|> of all")]


def expected(rows):
    out, start = [], 0
    for doc, text in sorted(rows):
        ids = ids_of(text)
        out.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    return out


@pytest.mark.parametrize("size, rows, batches", [(1024, 256, 16), (16, 3, 1), (7, 2, 2), (1, 5, 3)])
def test_round_trip(spark, tmp_path, size, rows, batches):
    docs = documents(random.Random(size), 120 if size > 1 else 20)
    docs = docs if size > 1 else [(d, (t or "")[:50]) for d, t in docs]
    frame = spark.createDataFrame([(*d, 7) for d in docs], "doc_id bigint, text string, start int").repartition(5)
    files = binary.write(frame, PATH, str(tmp_path / "t"), size, rows)
    got = binary.read_documents(spark, str(tmp_path / "t"), batches=batches).collect()
    assert sorted(map(tuple, got)) == expected(docs)
    assert files.agg(F.sum("docs"), F.sum("tokens")).first() == (len(docs), sum(len(ids_of(t)) for _, t in docs))


def test_sequences_and_masks(spark, tmp_path):
    docs = documents(random.Random(2), 40)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    files = binary.write(frame, PATH, str(tmp_path / "t"), 32, 4).orderBy("start").collect()
    stream = []
    for f in files:
        with binary.TokenFile(str(tmp_path / "t" / f.file)) as opened:
            assert len(opened) == f.sequences and opened.batches == f.batches
            parts = [opened[k] for k in range(len(opened))]
            for k, (ids, mask) in enumerate(parts):
                assert len(ids) == len(mask) == 32 and (mask.all() or k == len(parts) - 1)
                assert not ids[~mask].any() and (np.diff(mask.astype(int)) <= 0).all()
                stream += ids[mask].tolist()
            with pytest.raises(IndexError):
                opened[len(opened)]
    assert stream == [i for _, t in sorted(docs) for i in ids_of(t)]


def test_a_sequence_is_a_view_of_the_mapped_file(spark, tmp_path):
    binary.write(spark.createDataFrame([(1, "word " * 5000)], "doc_id bigint, text string"), PATH, str(tmp_path / "t"), 64, 8)
    name = next(n for n in os.listdir(tmp_path / "t") if n.endswith(".arrow"))
    with binary.TokenFile(str(tmp_path / "t" / name)) as opened:
        before = pa.total_allocated_bytes()
        ids = [opened[k][0] for k in (70, 3, 70)]
        assert ids[0].dtype == np.uint16 and ids[0].ctypes.data == ids[2].ctypes.data
        assert not ids[0].flags.owndata and not ids[0].flags.writeable
        assert pa.total_allocated_bytes() - before < 4096


def test_a_large_vocabulary_has_wide_ids():
    cut = binary._Sequences(4, 2, pa.uint32(), pa.string())
    made = [*cut.add("a", np.array([70_000, 1, 0], "<u4")), *cut.add("b", np.arange(10, dtype="<u4")), *cut.rest()]
    assert [b.num_rows for b in made] == [2, 2]
    assert [x.as_py() for b in made for x in b.column(0)] == [[70_000, 1, 0, 0], [1, 2, 3, 4], [5, 6, 7, 8], [9, 0, 0, 0]]
    assert [x.as_py() for b in made for x in b.column(3)] == [["a"], [], [], ["b"]]
    assert binary.vocabulary(PATH) <= 1 << 16


def test_equal_ids_and_nulls(spark, tmp_path):
    rows = [(1, "b"), (1, "a"), (1, "a"), (None, "n"), (None, None), (0, "z")]
    binary.write(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), PATH, str(tmp_path / "t"), 4, 2)
    got = sorted(binary.read_documents(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 0, 1, 1, 1]
    assert sorted((r.doc_id, r.ids_crc32) for r in got if r.doc_id) == sorted((d, crc(ids_of(t))) for d, t in rows if d)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(6)]
    names = spark.createDataFrame([("x", "b"), (None, "a")], "doc_id string, text string")
    binary.write(names, PATH, str(tmp_path / "s"))
    assert [r.doc_id for r in binary.read_documents(spark, str(tmp_path / "s"), "string").orderBy("start").collect()] == [None, "x"]


def test_no_rows_and_files_of_lost_attempts(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    binary.write(none, PATH, str(tmp_path / "none"))
    assert binary.read_documents(spark, str(tmp_path / "none")).count() == 0
    binary.write(spark.createDataFrame([(1, "a")], none.schema), PATH, str(tmp_path / "t"))
    (tmp_path / "t" / "part-000000-99-lost.arrow").write_bytes(b"half a file")
    assert binary.read_documents(spark, str(tmp_path / "t")).count() == 1
