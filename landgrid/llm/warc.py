"""WARC archives in Zstandard frames: writer, dictionary, reader.

An archive begins with a skippable frame that holds a trained dictionary; behind it every record is
one frame. The reader loads the dictionary from that frame, finds each further frame, decodes it
alone, and checks the record's headers and lengths. Archives lie in the folder all executors share,
are rolled at ``ROLL`` bytes, and appear under their final names only when they are complete.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgrid.llm import common
from landgrid.shared import saved, shared_folder

# fixed values of the formats
SKIPPABLE = 0x184D2A5D           # magic of the frame that holds the dictionary
FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"

SMALLEST = 100                   # payload bytes from which equal payloads are stored once
ROLL = 64 << 20                  # compressed bytes after which a writer begins a new archive
CHUNK = 1 << 20                  # bytes read at a time
SAMPLES = 400                    # pages the dictionary is trained on, by the hash of their ids
SAMPLE_BYTES = 16 << 10          # longer pages are left out of the sample
DICTIONARY = 32 << 10            # bytes of the dictionary
LARGEST = 1 << 31                # decoded bytes a record may claim


class BadArchive(ValueError):
    """Bytes that are not a valid archive of this kind."""


# -- records ---------------------------------------------------------------------------------------

def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value).strip()


def record(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record; a revisit keeps the HTTP headers and leaves the payload out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{page}>")]
    if url:
        head.append(("WARC-Target-URI", _clean(url)))
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha256:{digest}"),
             ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return lines + b"\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes, what: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in raw.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise BadArchive(f"{what}: bad header line {line[:80]!r}")
        out[name.decode().lower()] = value.strip().decode()
    return out


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, HTTP headers and payload of one record, after checking form, lengths and digest."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not blank or version != VERSION:
        raise BadArchive(f"not a record: {data[:40]!r}")
    headers = _headers(lines, "record")
    for name in ("warc-type", "warc-record-id", "content-length", "warc-payload-digest"):
        if name not in headers:
            raise BadArchive(f"record without {name}")
    if not headers["content-length"].isdigit() or int(headers["content-length"]) + 4 != len(rest) or rest[-4:] != b"\r\n\r\n":
        raise BadArchive(f"{headers['warc-record-id']}: {len(rest) - 4} bytes, not {headers['content-length']}")
    block = rest[:-4]
    http, blank, payload = block.partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not blank or not status.startswith(b"HTTP/"):
        raise BadArchive(f"{headers['warc-record-id']}: no HTTP header")
    inner = _headers(lines, "HTTP")
    if not inner.get("content-length", "").isdigit():
        raise BadArchive(f"{headers['warc-record-id']}: no HTTP length")
    if headers["warc-type"] == "response":
        if int(inner["content-length"]) != len(payload):
            raise BadArchive(f"{headers['warc-record-id']}: payload of {len(payload)} bytes, not {inner['content-length']}")
        if headers["warc-payload-digest"] != "sha256:" + hashlib.sha256(payload).hexdigest():
            raise BadArchive(f"{headers['warc-record-id']}: digest differs")
    elif headers["warc-type"] != "revisit" or payload or "warc-refers-to" not in headers:
        raise BadArchive(f"{headers['warc-record-id']}: bad {headers['warc-type']}")
    return headers, inner, payload


# -- frames ----------------------------------------------------------------------------------------

def dictionary_frame(content: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(content)) + content


class Frames:
    """Bytes of a stream, some ahead of the place that was read to."""

    def __init__(self, stream):
        self.stream, self.held = stream, b""

    def fill(self, n: int) -> bool:
        while len(self.held) < n:
            more = self.stream.read(max(CHUNK, n - len(self.held)))
            if not more:
                return False
            self.held += more
        return True

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise BadArchive("the archive ends within a frame")
        out, self.held = self.held[:n], self.held[n:]
        return out

    def frame(self) -> bytes | None:
        """The next whole frame, found by its header and block sizes; None at the end."""
        if not self.fill(1):
            return None
        if not self.fill(9) or struct.unpack_from("<I", self.held)[0] != FRAME:
            raise BadArchive("no frame where one should begin")
        flags = self.held[4]
        single, checksum = flags >> 5 & 1, flags >> 2 & 1
        at = 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
        while True:
            if not self.fill(at + 3):
                raise BadArchive("the archive ends within a frame")
            header = int.from_bytes(self.held[at:at + 3], "little")
            at += 3 + (1 if header >> 1 & 3 == 1 else header >> 3)
            if header & 1:
                break
        return self.take(at + 4 * checksum)


def records(stream) -> Iterator[bytes]:
    """Decoded records of an archive, one at a time."""
    frames = Frames(stream)
    magic, size = struct.unpack("<II", frames.take(8))
    if magic != SKIPPABLE:
        raise BadArchive("the archive does not begin with a dictionary")
    content = frames.take(size)
    if content[:4] == struct.pack("<I", FRAME):                       # a dictionary may itself be compressed
        content = zstandard.ZstdDecompressor().decompress(content, max_output_size=LARGEST)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content)) if content else zstandard.ZstdDecompressor()
    while (frame := frames.frame()) is not None:
        claimed = zstandard.frame_content_size(frame)
        if claimed < 0 or claimed > LARGEST:
            raise BadArchive(f"a record claims {claimed} bytes")
        try:
            data = reader.decompress(frame)
        except zstandard.ZstdError as error:
            raise BadArchive(f"a frame can't be decoded: {error}") from None
        if len(data) != claimed:
            raise BadArchive(f"a record has {len(data)} bytes, not {claimed}")
        yield data


def trained(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary from the samples; empty if they are too few or too short to train on."""
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 10)), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


# -- Spark -----------------------------------------------------------------------------------------

def resolved(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """``page_id, url, payload, digest, first``: ``first`` is the page that the record revisits, else null.

    Rows that share the smallest page id of a payload are all responses; so are null ids, if their
    payload has no other. Copies meet in an aggregation, one row per task and payload.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = (rows.filter(F.octet_length("payload") >= smallest).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("held")).filter("held > 1").drop("held"))
    found = rows.join(firsts, "digest", "left")
    differs = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return found.select("page_id", "url", "payload", "digest", F.when(differs, F.col("first")).alias("first"))


def dictionary(pages: DataFrame) -> bytes:
    """Trained on at most ``SAMPLES`` pages, taken by the hash of their ids."""
    ids = common.bounded_sample(pages.filter("page_id is not null").select("page_id", F.lit(0).alias("one")), "page_id", "one", SAMPLES)
    texts = common.sample_texts(pages.withColumn("text", F.col("html")), "page_id", ids, SAMPLE_BYTES)
    return trained([t.encode() for t, _, _ in texts if t])


def write(rows: DataFrame, folder: str, content: bytes, roll: int = ROLL) -> DataFrame:
    """Write ``resolved`` rows as archives into ``folder``; a row per archive with path, records, bytes.

    An archive is named after the attempt that wrote it, so one that is repeated, or runs beside another, never
    replaces archives whose rows were kept. The paths in the rows tell which archives count.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
        writer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content) if content else None,
                                          write_checksum=True, write_content_size=True)
        context, number, open_, done = TaskContext.get(), 0, None, []

        def close():
            open_[0].close()
            store.move(open_[1], open_[2])
            done.append((open_[2], open_[3], open_[4]))

        for batch in batches:
            for page, url, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ is None:
                    name = f"{root}/part-{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}.warc.zst"
                    temporary = f"{name}.open"
                    open_ = [store.open_output_stream(temporary, compression=None), temporary, name, 0, 0]
                    open_[0].write(dictionary_frame(content))
                    number += 1
                frame = writer.compress(record("null" if page is None else str(page), url, payload, digest,
                                               None if first is None else str(first)))
                open_[0].write(frame)
                open_[3] += 1
                open_[4] += len(frame)
                if open_[4] >= roll:
                    close()
                    open_ = None
        if open_ is not None:
            close()
        paths, counts, sizes = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                                         names=["path", "records", "bytes"])

    return rows.mapInArrow(run, "path string, records bigint, bytes bigint")


def read(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives in ``path``: id, type, digest, payload length, payload, what it refers to.

    An archive is read as a stream, record by record. A damaged one fails the job, and so does one
    whose number of records is not the one it was written with.
    """
    fields = [("record_id", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
              ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("refers_to", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = pafs.FileSystem.from_uri(folder)[0] if "://" in folder or folder.startswith("file:") else pafs.LocalFileSystem()

        def of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), fields)],
                                              names=[name for name, _ in fields])

        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size, count = [], 0, 0
                with store.open_input_stream(path, compression=None) as stream:
                    for data in records(stream):
                        head, http, payload = parsed(data)
                        refers = head.get("warc-refers-to")
                        rows.append((head["warc-record-id"], head["warc-type"], head["warc-payload-digest"].removeprefix("sha256:"),
                                     int(http["content-length"]), payload, refers))
                        size += len(payload)
                        count += 1
                        if size > 8 * CHUNK or len(rows) >= 2048:
                            yield of(rows)
                            rows, size = [], 0
                if count != expected:
                    raise BadArchive(f"{path}: {count} records, not {expected}")
                if rows:
                    yield of(rows)

    return archives.select("path", "records").mapInArrow(
        run, "record_id string, record_type string, payload_digest string, payload_bytes bigint, payload binary, refers_to string")


def archived(spark: SparkSession, pages: DataFrame) -> tuple[DataFrame, str]:
    """Write pages to a new folder beside the session's checkpoints; a table of the archives, and the folder."""
    folder = f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    store, root = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
    store.create_dir(root, recursive=True)
    return saved(write(resolved(pages), folder, dictionary(pages))), folder


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write a record per page, read the archives back and describe each record.

    Empty table: no rows. Repeated rows: a record each; rows that share the smallest id of a payload
    are all responses. Null html: an empty payload. Null url: no target header. Null id: ``null``.
    """
    archives, folder = archived(spark, pages.select("page_id", "url", "html"))
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(.*)>$', 1) as bigint)")
    many = archives.repartition(max(1, min(archives.count(), 4096)), "path")
    return read(many, folder).select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                     page("refers_to").alias("refers_to"))


SQL = f"""
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (
  select payload_digest, min(page_id) as first from p where payload_bytes >= {SMALLEST} group by 1
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, p.payload_digest,
       case when first is null or page_id is not distinct from first then 'response' else 'revisit' end as record_type,
       case when first is null or page_id is not distinct from first then null else first end as refers_to
from p left join f using (payload_digest)
"""
