from __future__ import annotations

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from footfall.llm import warc


def pages(rng):
    base = [f"<html>{'x' * rng.randrange(3000)} page é {k}</html>" for k in range(30)]
    rows = [(k, f"http://h{k % 3}.org/{k}", rng.choice(base)) for k in range(150)]
    return rows + [(500, None, None), (501, "", ""), (502, "http://a\r\nX: y", "new"), (503, "u", "WARC/1.0\r\n\r\n\r\nWARC/1.0\r\nWARC-Type: response"), (None, "n", "new"), (7, "again", rows[7][2])]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc"))
    frame = spark.createDataFrame([(*r, 1) for r in pages(random.Random(1))], "page_id bigint, url string, html string, first int")
    warc.register(spark)
    warc.records(frame.repartition(3)).write.format("warc").mode("append").save(path)
    return path


def expected(rows, least=0):
    first = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if page is not None:
            first[raw] = min(page, first.get(raw, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        again = len(raw) >= least and page != first.get(raw)
        out.append((page, len(raw), warc.sha1_base32(raw), "revisit" if again else "response", first[raw] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 1000])
def test_round_trip(spark, least):
    rows = pages(random.Random(1))
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = warc.round_trip(frame, least)
    got = [
        (r.page, r.payload_bytes, r.payload_digest, r.record_type, r.first)
        for r in out.select("*", warc.page_of(F.col("record_id")).alias("page"), warc.page_of(F.col("refers_to")).alias("first")).collect()
    ]
    assert sorted(got, key=str) == expected(rows, least)
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_payloads_come_back(spark, archive):
    raw = {(html or "").encode() for _, _, html in pages(random.Random(1))}
    out = spark.read.format("warc").load(archive).filter("record_type = 'response'").collect()
    assert {bytes(r.payload) for r in out} == raw
    assert all(r.payload_digest == warc.sha1_base32(bytes(r.payload)) for r in out)
    skipped = spark.read.format("warc").option("payload", "skip").load(archive)
    assert skipped.filter("payload IS NOT NULL").count() == 0 and skipped.count() == len(pages(random.Random(1)))


@pytest.mark.parametrize("condition", [
    "record_type = 'revisit'", "record_type <> 'revisit'", "target_uri LIKE 'http://h1%'", "target_uri LIKE '%.org/12'",
    "target_uri LIKE '%h2%'", "record_id IN ('<urn:page:3>', '<urn:page:4>')", "refers_to IS NULL", "refers_to IS NOT NULL",
    "target_uri <=> NULL", "NOT (target_uri LIKE 'http%')", "payload_bytes > 1500 AND record_type = 'response'",
])
def test_pushed_predicates(spark, archive, condition):
    all_rows = spark.read.format("warc").load(archive).collect()
    plain = spark.createDataFrame(all_rows, warc.SCHEMA)
    got = spark.read.format("warc").load(archive).filter(condition).collect()
    assert sorted(map(str, got)) == sorted(map(str, plain.filter(condition).collect()))


def test_unwanted_payloads_are_not_inflated(archive, monkeypatch):
    reader = warc.WarcReader({"path": archive, "splitBytes": "1000000"})
    monkeypatch.setattr(warc, "_fill", lambda *_: pytest.fail("a payload was decoded"))
    reader.tests = [("record_type", "equal", "conversion")]
    assert [b for p in reader.partitions() for b in reader.read(p)] == []


@pytest.mark.parametrize("split", [500, 5000])
def test_ranges_see_every_record_once(spark, archive, split):
    ids = [r.record_id for r in spark.read.format("warc").option("splitBytes", str(split)).load(archive).collect()]
    assert sorted(ids) == sorted(r.record_id for r in spark.read.format("warc").load(archive).collect())


@pytest.mark.parametrize("kind", ["plain", "members", "big members"])
def test_archives_of_others(spark, tmp_path, kind):
    body = b"z" * (300_000 if kind == "big members" else 50)
    records = [
        b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:a>\r\nContent-Type: application/warc-fields\r\nContent-Length: 6\r\n\r\nab: cd\r\n\r\n",
        b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Record-ID: <urn:b>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body),
    ] * 3
    name = "x.warc" if kind == "plain" else "x.warc.gz"
    (tmp_path / name).write_bytes(b"".join(records) if kind == "plain" else b"".join(map(gzip.compress, records)))
    warc.register(spark)
    out = spark.read.format("warc").load(str(tmp_path)).collect()
    assert sorted(r.record_type for r in out) == ["resource"] * 3 + ["warcinfo"] * 3
    assert {bytes(r.payload) for r in out} == {b"ab: cd", body}
    assert spark.read.format("warc").load(str(tmp_path)).filter("record_type = 'warcinfo'").count() == 3


def test_base32(spark):
    digests = [hashlib.sha1(str(k).encode()) for k in range(50)]
    frame = spark.createDataFrame([(d.hexdigest(),) for d in digests], "x string")
    assert [r[0] for r in frame.select(warc.base32(F.col("x"))).collect()] == [warc.sha1_base32(str(k).encode()) for k in range(50)]


def test_only_committed_files_are_read(spark, archive):
    n = spark.read.format("warc").load(archive).count()
    with open(f"{archive}/left-over.warc.gz", "wb") as f:
        f.write(warc.gzip_member(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n", 1))
    assert spark.read.format("warc").load(archive).count() == n


def raw_records(n):
    rows = [{"record_type": "response", "record_id": f"<r{k}>", "target_uri": f"u{k}", "warc_date": None, "payload_digest": "x", "refers_to": None, "payload_bytes": 5000 * (k % 3), "payload": bytes([65 + k]) * (5000 * (k % 3))} for k in range(n)]
    return [warc.record_bytes(r) for r in rows], rows


@pytest.mark.parametrize("how", ["one stream", "two members", "a member each", "plain", "plain with blank lines"])
@pytest.mark.parametrize("mode", ["keep", "check", "skip"])
def test_foreign_archives_are_read_in_full(spark, tmp_path, how, mode):
    raw, rows = raw_records(10)
    data = {
        "one stream": lambda: gzip.compress(b"".join(raw)),
        "two members": lambda: gzip.compress(b"".join(raw[:7])) + gzip.compress(b"".join(raw[7:])),
        "a member each": lambda: b"".join(map(gzip.compress, raw)),
        "plain": lambda: b"".join(raw), "plain with blank lines": lambda: b"\r\n" + b"\r\n\r\n\r\n".join(raw) + b"\r\n" * 20,
    }[how]()
    path = tmp_path / ("x.warc" if "plain" in how else "x.warc.gz")
    path.write_bytes(data)
    warc.register(spark)
    out = spark.read.format("warc").option("payload", mode).option("splitBytes", "300").load(str(path)).collect()
    assert sorted(r.record_id for r in out) == [f"<r{k}>" for k in range(10)]
    if mode == "keep":
        assert {r.record_id: bytes(r.payload) for r in out} == {r["record_id"]: r["payload"] for r in rows}


@pytest.mark.parametrize("damage", ["cut gzip", "cut own", "cut plain", "no head", "no head in gzip", "noise in gzip"])
def test_damaged_archives_raise(spark, tmp_path, damage):
    raw, _ = raw_records(4)
    whole = gzip.compress(b"".join(raw))
    data, name = {
        "cut gzip": (whole[:len(whole) // 2], "x.warc.gz"),
        "cut own": (b"".join(warc.gzip_member(x, 3) for x in raw)[:-30], "x.warc.gz"),
        "cut plain": (b"".join(raw[:2])[:-100], "x.warc"), "no head": (raw[0] + b"garbage" * 9 + raw[1], "x.warc"),
        "no head in gzip": (gzip.compress(raw[0] + b"garbage \r\n\r\n"), "x.warc.gz"),
        "noise in gzip": (whole[:60] + bytes(50) + whole[110:], "x.warc.gz"),
    }[damage]
    (tmp_path / name).write_bytes(data)
    warc.register(spark)
    with pytest.raises(Exception, match="WARC header|ends inside|longer than|damaged"):
        spark.read.format("warc").option("payload", "check").load(str(tmp_path / name)).collect()


def test_commits_do_not_touch_each_other(spark, tmp_path):
    warc.register(spark)
    frame = spark.createDataFrame([(1, "u", "a"), (2, "u", "b")], "page_id bigint, url string, html string")
    for k in (1, 2):
        warc.records(frame.filter(F.col("page_id") == k)).write.format("warc").mode("append").save(str(tmp_path))
    manifests = [p for p in tmp_path.iterdir() if p.name.startswith("_manifest")]
    assert len(manifests) == 2 and not [p for p in tmp_path.iterdir() if p.name.startswith("_draft")]
    (tmp_path / "_draft-left").write_bytes(b"[")  # of a driver that died
    assert spark.read.format("warc").load(str(tmp_path)).count() == 2
