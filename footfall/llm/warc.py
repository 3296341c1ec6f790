"""WARC archives as a Spark data source.

    register(spark)
    records.write.format("warc").mode("append").save(path)
    spark.read.format("warc").option("payload", "keep").load(path).filter("record_type = 'response'")

Files are ``.warc.gz`` with one gzip member per record, or plain ``.warc``. The writer states each
member's length in its gzip header (extra field ``sl``), so a reader that needs the headers only
inflates the head of a member and seeks to the next. Predicates on header columns are tested before
anything of a payload is inflated. Foreign files without the field are inflated to the member's end, and
may have many records in a member, as where a whole file is one stream. Bytes that are no record, and
archives that end inside one, raise an error: no record is lost in silence.

Files are reached through ``pyarrow.fs``: a local or shared folder, HDFS or an object store. Large
compressed files are read in ranges, as a member's start can be recognised.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition,
    IsNotNull, IsNull, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)

from footfall.llm.common import ship_by_value
from footfall.operators.joins import join_per_key
from footfall.session import new_path

ship_by_value(__name__)

MANIFEST = "_manifest"
VERSION = b"WARC/1.0\r\n"
#: Fixed value of the format: the profile of a revisit to an identical payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)
#: Columns that a record's headers alone decide, and the header each comes from.
HEADERS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
    "warc_date": "warc-date", "refers_to": "warc-refers-to",
}


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it. Hadoop writes local paths with one slash or three, and unescaped."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), path.removeprefix("file://").removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


# -- writing ---------------------------------------------------------------------------------------

def record_bytes(record: dict) -> bytes:
    """One record: WARC headers, an HTTP head that states the payload's length, the payload.

    A revisit has no payload; its head and digest are those of the full payload."""
    size = record["payload_bytes"]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    body = b"" if record["record_type"] == "revisit" else record["payload"] or b""
    lines = [
        ("WARC-Type", record["record_type"]), ("WARC-Record-ID", record["record_id"]),
        ("WARC-Target-URI", record["target_uri"]), ("WARC-Date", record["warc_date"]),
        ("WARC-Payload-Digest", f"sha1:{record['payload_digest']}"), ("WARC-Refers-To", record["refers_to"]),
        ("WARC-Profile", SAME_PAYLOAD if record["record_type"] == "revisit" else None),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(head) + len(body))),
    ]
    # a line break inside a value would end the header
    text = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in lines if v is not None)
    return b"".join((VERSION, text.encode(), b"\r\n", head, body, b"\r\n\r\n"))


def gzip_member(raw: bytes, level: int) -> bytes:
    """A gzip member whose extra field ``sl`` holds its compressed and plain length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


class WarcWriter(DataSourceArrowWriter):
    """Each task attempt writes files of its own; the manifest of the commit names those that count."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.level = int(options.get("level", "3"))
        self.roll = int(options.get("fileBytes", str(512 << 20)))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        context = TaskContext.get()
        stem = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        names, out = [], None
        try:
            for batch in iterator:
                for record in batch.to_pylist():
                    if out is None:
                        names.append(f"{stem}-{len(names):03d}.warc.gz")
                        out = fs.open_output_stream(posixpath.join(root, names[-1]), compression=None)
                    out.write(gzip_member(record_bytes(record), self.level))
                    if out.tell() >= self.roll:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return _Written(names)

    def commit(self, messages: list) -> None:
        """A manifest of its own per commit, moved to its name when it is whole: earlier and simultaneous
        commits to the folder stay as they are."""
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        key = uuid.uuid4().hex
        draft = posixpath.join(root, f"_draft-{key}")
        with fs.open_output_stream(draft, compression=None) as f:
            f.write(json.dumps(sorted(names)).encode())
        fs.move(draft, posixpath.join(root, f"{MANIFEST}-{key}.json"))

    def abort(self, messages: list) -> None:
        fs, root = _open(self.path)
        for m in messages:
            for name in m.names if m is not None else ():
                fs.delete_file(posixpath.join(root, name))


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


# -- reading ---------------------------------------------------------------------------------------

class FileRange(InputPartition):
    """Records of a file that start in [start, end)."""

    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.payload = options.get("payload", "keep")
        if self.payload not in ("keep", "check", "skip"):
            raise ValueError("payload is keep, check (measured and hashed, not returned) or skip")
        self.split = int(options.get("splitBytes", str(64 << 20)))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes over predicates on header columns; the others stay with Spark."""
        for f in filters:
            test = _header_test(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self) -> list[InputPartition]:
        """Ranges of the files in the manifests, or of all archives in the folder if it has none."""
        fs, root = _open(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            found = [info]
        else:
            inside = fs.get_file_info(pafs.FileSelector(root))
            found = [x for x in inside if x.base_name.endswith((".warc", ".warc.gz"))]
            manifests = [x.path for x in inside if x.base_name.startswith(MANIFEST)]
            named: set[str] = set()
            for at in manifests:
                with fs.open_input_stream(at) as f:
                    named |= set(json.loads(f.read()))
            if manifests:
                found = [x for x in found if x.base_name in named]
        out: list[InputPartition] = []
        for x in sorted(found, key=lambda x: x.path):
            step = self.split if x.base_name.endswith(".gz") else max(1, x.size)
            at = self.path if info.type == pafs.FileType.File else posixpath.join(self.path, x.base_name)
            out += [FileRange(at, a, min(a + step, x.size)) for a in range(0, x.size, step)]
        return out or [FileRange("", 0, 0)]

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, at = _open(partition.path)
        rows, held = [], 0
        with fs.open_input_file(at) as f:
            walk = _gzip_records if at.endswith(".gz") else _plain_records
            for row in walk(f, partition.start, partition.end, self._wanted, self.payload):
                rows.append(row)
                held += len(row["payload"] or b"") + 500
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=_arrow_schema())
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow_schema())

    def _wanted(self, row: dict) -> bool:
        return all(_holds(kind, row[column], value) for column, kind, value in self.tests)


def _arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in SCHEMA.split(", "))])


def _header_test(f: Filter) -> tuple[str, str, object] | None:
    negated = isinstance(f, Not)
    inner = f.child if negated else f
    kinds = {
        EqualTo: "equal", EqualNullSafe: "same", In: "in", IsNull: "null", IsNotNull: "not null",
        StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "contains",
    }
    kind = kinds.get(type(inner))
    if kind is None or len(inner.attribute) != 1 or inner.attribute[0] not in HEADERS or negated and kind in ("same", "in"):
        return None
    return inner.attribute[0], ("not " if negated else "") + kind, getattr(inner, "value", None)


def _holds(kind: str, have: str | None, value) -> bool:
    if kind in ("null", "not not null"):
        return have is None
    if kind in ("not null",):
        return have is not None
    if kind == "same":
        return have == value
    if have is None:  # SQL: a comparison with null is not true, negated or not
        return False
    negated, kind = kind.startswith("not "), kind.removeprefix("not ")
    result = {
        "equal": lambda: have == value, "in": lambda: have in value, "starts": lambda: have.startswith(value),
        "ends": lambda: have.endswith(value), "contains": lambda: value in have,
    }[kind]()
    return result != negated


def _head(raw: bytes) -> tuple[dict, int] | None:
    """Header fields by lower-case name and where the block starts; None if the head is not complete."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields: dict[str, str] = {}
    for line in raw[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, end + 4


def _row(fields: dict) -> dict:
    row = {column: fields.get(header) for column, header in HEADERS.items()}
    digest = fields.get("warc-payload-digest")
    return row | {"payload_digest": digest.rpartition(":")[2] if digest else None, "payload_bytes": None, "payload": None}


def _fill(row: dict, fields: dict, block: bytes, mode: str) -> dict:
    """The payload's length and digest: from the payload itself, or as a revisit's headers state them."""
    if not fields.get("content-type", "").startswith("application/http"):
        body, stated = block, None
    else:
        head = _head(block)
        body = block[head[1]:] if head else b""
        stated = head[0].get("content-length") if head else None
    if row["record_type"] == "revisit":
        return row | {"payload_bytes": int(stated) if stated else None}
    return row | {"payload_bytes": len(body), "payload_digest": sha1_base32(body), "payload": body if mode == "keep" else None}


class _Member:
    """The text of one gzip member, inflated as far as it is needed; what was used is let go."""

    def __init__(self, f, at: int, step: int = 1 << 16):
        f.seek(at)
        self.f, self.step, self.inflate, self.text = f, step, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Another piece of text; False at the member's end."""
        if self.inflate.eof:
            return False
        raw = self.inflate.unconsumed_tail or self.f.read(self.step)
        if not raw:
            raise ValueError("the archive ends inside a gzip member")
        self.text += self.inflate.decompress(raw, self.step)
        return True

    def head(self) -> tuple[dict, int] | None:
        """The next record's header; None if only line ends are left."""
        while True:
            self.text = self.text.lstrip(b"\r\n")
            head = _head(self.text)
            if head is not None or not self.more():
                break
        if head is None and self.text or head is not None and not self.text.startswith(b"WARC/"):
            raise ValueError("no WARC header in a gzip member")
        return head

    def take(self, n: int, keep: bool) -> bytes:
        """The next n bytes, or nothing of them if they are not to be kept."""
        parts = []
        while len(self.text) < n:
            parts += [self.text] * keep
            n, self.text = n - len(self.text), b""
            if not self.more():
                raise ValueError("a record is longer than its gzip member")
        parts += [self.text[:n]] * keep
        self.text = self.text[n:]
        return b"".join(parts)

    def end(self) -> int:
        """Where the file goes on after the member."""
        while self.more():
            self.text = b""
        return self.f.tell() - len(self.inflate.unused_data)


def _gzip_records(f, start: int, end: int, wanted, mode: str) -> Iterator[dict]:
    """Records of the members that start in [start, end): one of each member that states its length, all of
    the others. What is no record, or not complete, is an error."""
    at, size = start if start == 0 else _next_member(f, start, end), f.size()
    while at is not None and at < min(end, size):
        f.seek(at)
        length = _stated_length(f.read(4096))
        if length is not None and at + length > size:
            raise ValueError("the archive ends inside a gzip member")
        member = _Member(f, at)
        try:
            while (head := member.head()) is not None:
                fields, block = head
                row, n = _row(fields), int(fields.get("content-length", "0"))
                take = wanted(row)
                need = take and (mode != "skip" or row["record_type"] == "revisit")
                if need or length is None:
                    member.take(block, False)
                    text = member.take(n, need)
                if take:
                    yield _fill(row, fields, text, mode) if need else row
                if length is not None:
                    break  # what follows is skipped unread
            at = at + length if length is not None else member.end()
        except zlib.error as e:
            raise ValueError(f"damaged gzip member at byte {at}: {e}") from e


def _stated_length(raw: bytes) -> int | None:
    """Compressed length from the extra field ``sl``."""
    if len(raw) < 12 or not raw[3] & 4:
        return None
    extra = raw[12:12 + struct.unpack_from("<H", raw, 10)[0]]
    while len(extra) >= 4:
        size = struct.unpack_from("<H", extra, 2)[0]
        if extra[:2] == b"sl" and size == 8:
            return struct.unpack_from("<I", extra, 4)[0]
        extra = extra[4 + size:]
    return None


def _next_member(f, start: int, end: int) -> int | None:
    """The first member that starts in [start, end): the gzip signature and, inflated, a WARC version."""
    step, at = 1 << 20, start
    while at < end:
        f.seek(at)
        window = f.read(step + 4096)
        k = window.find(b"\x1f\x8b\x08")
        while 0 <= k < step and at + k < end:
            try:
                if zlib.decompressobj(31).decompress(window[k:k + 4096], 5) == b"WARC/":
                    return at + k
            except zlib.error:
                pass
            k = window.find(b"\x1f\x8b\x08", k + 1)
        at += step
    return None


def _plain_records(f, start: int, end: int, wanted, mode: str) -> Iterator[dict]:
    """All records of an archive that is not compressed; anything else in it is an error."""
    at, total = start, f.size()
    while at < end:
        f.seek(at)
        text, blank = b"", 0
        while (head := _head(text)) is None and (more := f.read(8192)):
            text += more
            if not text.strip(b"\r\n"):
                blank, text = blank + len(text), b""
            kept = text.lstrip(b"\r\n")
            blank, text = blank + len(text) - len(kept), kept
        if not text:
            return
        if head is None or not text.startswith(b"WARC/"):
            raise ValueError(f"no WARC header at byte {at + blank}")
        at += blank + head[1]
        size = int(head[0].get("content-length", "0"))
        if at + size > total:
            raise ValueError("the archive ends inside a record")
        row = _row(head[0])
        if wanted(row):
            if mode == "skip" and row["record_type"] != "revisit":
                yield row
            else:
                f.seek(at)
                yield _fill(row, head[0], f.read(size), mode)
        at += size


class WarcSource(DataSource):
    """Options: path; payload keep | check | skip; splitBytes; for writing level and fileBytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are appended to, never overwritten: use mode('append')")
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known; predicates reach Python sources only with this setting."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# -- pages as records ------------------------------------------------------------------------------

def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def page_of(record: Column) -> Column:
    return F.nullif(F.regexp_extract(record, "^<urn:page:(.*)>$", 1), F.lit("")).cast("bigint")


def records(pages: DataFrame, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A record per page. Of pages with equal payloads of at least ``least_bytes`` bytes that with the
    smallest page_id is the response, the others revisit it and carry no payload.

    Payloads are compared by SHA-1 and length; only digests are grouped. A null html is an empty
    payload. Of a payload's rows with the smallest page_id each is a response; a null page_id is never
    smallest unless all are null, then all are responses. No rows give no records."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", F.col("url").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    firsts = rows.groupBy("sha1", "payload_bytes").agg(F.min("page_id").alias("first"))
    rows = join_per_key(rows, firsts, ["sha1", "payload_bytes"])
    again = (F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select(
        record_id(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.lit(date).alias("warc_date"),
        F.when(again, record_id(F.col("first"))).alias("refers_to"),
        base32(F.col("sha1")).alias("payload_digest"), "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of 40 hex digits: 5 digits are 4 letters."""
    alphabet = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = [F.lpad(F.conv(F.substring(hexadecimal, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*parts), *alphabet)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back, payloads checked."""
    spark = pages.sparkSession
    register(spark)
    path = new_path(spark, "warc")
    records(pages, least_bytes).write.format("warc").mode("append").save(path)
    return spark.read.format("warc").option("payload", "check").load(path)
