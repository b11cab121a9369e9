"""Archives: round trip, format, damage."""

import hashlib
import io
import struct

import pytest
import zstandard

from landgrid.llm import warc
from landgrid.shared import shared_folder

SCHEMA = "page_id long, url string, html string, payload string, first long, digest string"


def pages(spark):
    big, bad = "<p>größer</p>" * 40, "line\r\nWARC/1.1\r\n\r\n" * 20
    rows = [(k, f"http://h/{k}", f"<html>{k} text</html>" * (k % 7), None, None, "d") for k in range(40)]
    rows += [(100 + k, "http://h/big", big, "", 1, "d") for k in range(30)] + [(100, "http://h/other", big, "", 1, "d")]
    rows += [(200, None, None, None, None, None), (201, "", "", None, None, None), (None, "u\r\nWARC-Type: evil", big, None, None, None),
             (202, "ü\n\t", bad, None, None, None), (203, "x", bad, None, None, None), (204, "x", "y" * 99, None, None, None),
             (205, "x", "y" * 99, None, None, None), (206, "x", "z" * 3_000_000, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def want(rows):
    first = {}
    for r in rows:
        body = (r.html or "").encode()
        if len(body) >= 100 and r.page_id is not None:
            first[body] = min(first.get(body, r.page_id), r.page_id)
    out = []
    for r in rows:
        body = (r.html or "").encode()
        revisit = body in first and first[body] != r.page_id
        out.append((str(r.page_id), len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response",
                    str(first[body] if revisit else None)))
    return sorted(out)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 1000)
    frame = pages(spark)
    got = warc.round_trip(spark, frame)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got.collect()) == want(frame.collect())
    assert warc.round_trip(spark, frame.limit(0)).count() == 0


def test_archives_roll_and_hold_payloads(spark):
    import os

    folder = f"{shared_folder(spark)}/roll".removeprefix("file:")
    os.makedirs(folder)
    frame = pages(spark)
    archives = warc.write(warc.resolved(frame), folder, warc.dictionary(frame), roll=2000)
    listed = spark.createDataFrame(archives.collect(), archives.schema)
    assert listed.count() > 3 and not [f for f in os.listdir(folder) if f.endswith(".open")]
    payloads = {(r.record_id, r.payload) for r in warc.read(listed, folder).collect() if r.record_type == "response"}
    assert ("<urn:page:202>", bytearray(("line\r\nWARC/1.1\r\n\r\n" * 20).encode())) in [(a, b) for a, b in payloads] or \
        any(a == "<urn:page:202>" and bytes(b) == ("line\r\nWARC/1.1\r\n\r\n" * 20).encode() for a, b in payloads)
    short = listed.withColumn("records", listed.records + 1)
    with pytest.raises(Exception, match="records, not"):
        warc.read(short, folder).collect()


def test_an_attempt_beside_another_replaces_nothing(spark):
    import os

    folder = f"{shared_folder(spark)}/attempts".removeprefix("file:")
    os.makedirs(folder)
    frame = pages(spark)
    rows, content = warc.resolved(frame).repartition(3, "page_id"), warc.dictionary(frame)
    first = warc.write(rows, folder, content, roll=2000).collect()
    held = {r.path: open(r.path, "rb").read() for r in first}
    second = warc.write(rows.orderBy("digest"), folder, content, roll=3000).collect()
    assert not {r.path for r in first} & {r.path for r in second}
    assert held == {r.path: open(r.path, "rb").read() for r in first}
    listed = spark.createDataFrame(first, "path string, records bigint, bytes bigint")
    assert warc.read(listed, folder).count() == frame.count()


def archive(bodies, content=b"", raw=False):
    maker = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content) if content else None, write_checksum=True)
    made = [b if raw else warc.record(str(k), None, b, hashlib.sha256(b).hexdigest(), None) for k, b in enumerate(bodies)]
    return warc.dictionary_frame(content) + b"".join(map(maker.compress, made))


def read_all(data):
    return [warc.parsed(r)[2] for r in warc.records(io.BytesIO(data))]


def test_frames_and_dictionaries():
    bodies = [b"", b"a", b"abc" * 100_000, bytes(range(256)) * 2000]
    samples = [f"<html><body>page number {k} with text {k * k}</body></html>".encode() * 3 for k in range(300)]
    content = warc.trained(samples)
    assert content
    assert read_all(archive(bodies)) == bodies == read_all(archive(bodies, content))
    packed = zstandard.ZstdCompressor().compress(content)
    inner = archive(bodies, content)[8 + len(content):]
    assert read_all(struct.pack("<II", warc.SKIPPABLE, len(packed)) + packed + inner) == bodies
    assert read_all(warc.dictionary_frame(b"")) == []
    assert warc.trained([]) == b""


def test_damage_is_found():
    good = archive([b"hello" * 50, b"world" * 50])
    broken = [b"", good[4:], good[:-3], good[:20] + bytes([good[20] ^ 255]) + good[21:], good + b"xxxxxxxxxxxx"]
    record = warc.record("1", None, b"hello", hashlib.sha256(b"hello").hexdigest(), None)
    revisit = warc.record("1", None, b"hello", hashlib.sha256(b"hello").hexdigest(), "0")
    broken += [archive([r], raw=True) for r in (
        record[:-1], record + b"\r\n", record.replace(b"hello", b"jello"), record.replace(b"WARC/1.1", b"WARC/9.9"),
        record.replace(b"WARC-Type: response", b"WARC-Type: metadata"), record.replace(b"Content-Length: 5", b"Content-Length: 6"),
        record.replace(b"WARC-Record-ID", b"X"), revisit.replace(b"WARC-Refers-To", b"X-Other"), b"", b"\r\n\r\n")]
    for data in broken:
        with pytest.raises(warc.BadArchive):
            read_all(data)
    assert warc.parsed(revisit)[1]["content-length"] == "5"
