"""WARC archives with Zstandard frames and a shared dictionary.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary; every record that follows is one Zstandard frame of its own.

Writing.  The pages are numbered and written once with their digests; equal
payloads are found by aggregating digests only, so a page that half the
table repeats costs one row a task.  A task packs its records into archives
of about ``ARCHIVE_BYTES`` uncompressed bytes, each one value of a text table
with one value a file: Spark's own writer and commit protocol put the
archives into any store, and a lost executor only repeats its tasks.  Its
line separator is an empty skippable frame, so a file is a valid
Zstandard stream from its first byte to its last.

Reading.  Files come in through Spark's binary reader.  A task loads the
dictionary from the leading skippable frame, finds the end of every frame
from its block headers, decodes one frame per record and validates it:
version line, mandatory headers, block length, payload length and digests.  A
record that fails keeps its row with the reason in ``error``; a frame whose end cannot be
found ends its archive, with one row that says so.

A payload of at least ``min_bytes`` that others equal is stored once (the
response with the largest page_id); the others are revisits, which have the
HTTP header of their response and its record id but no payload.

Defined results
  * null or empty html: a response with an empty payload;
  * null page_id: written without that header, read back as null; smaller
    than any other when a response is chosen, so revisits may refer to null;
  * repeated rows and ids: every row has its own record; of equal payloads
    under the largest page_id the row numbered last is the response;
  * null url: the URI is ``urn:page``; control characters, spaces and
    non-ASCII characters of a url are percent-encoded;
  * very long pages: an archive holds at least one record, whole;
  * empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm._common import Scratch, read

#: Fixed values of the Zstandard and WARC formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
#: An empty skippable frame (magic 0x184D2A50, length 0): the separator the writer puts after an archive.
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

#: Payloads shorter than this are always stored.
MIN_BYTES = 1000
#: Uncompressed bytes after which a task begins a new archive.
ARCHIVE_BYTES = 16 << 20
#: The dictionary is trained on so many pages at most, on so many characters of each (it affects sizes only).
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 200, 8192, 32 << 10
LEVEL = 3

RECORD = ("record_id string, record_type string, date string, target_uri string, page_id long, refers_to_record string, "
          "payload_digest string, payload_bytes long, payload binary, error string")


# -- one archive ---------------------------------------------------------------
def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary, or nothing where the samples are too few for one."""
    try:
        return zstandard.train_dictionary(size, [s for s in samples if s]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def record_id(run: str, rid: int) -> str:
    h = hashlib.md5(f"{run}/{rid}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def build_record(kind: str, rid: str, url: str | None, page_id: int | None, digest: str, n_bytes: int,
                 payload: bytes | None, refers_to: str | None) -> bytes:
    """A record of WARC/1.1; the block is an HTTP header and, of a response, the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes + (payload or b"")
    uri = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "urn:page"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
            f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """Frames of one archive after its dictionary."""

    def __init__(self, dictionary: bytes):
        self.dictionary = dictionary
        given = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **given)
        self.begin()

    def begin(self) -> None:
        self.frames = [struct.pack("<II", DICTIONARY_MAGIC, len(self.dictionary)), self.dictionary]
        self.size = self.records = 0

    def add(self, record: bytes) -> None:
        self.frames.append(self.compressor.compress(record))
        self.size += len(record)
        self.records += 1

    def close(self) -> bytes:
        out = b"".join(self.frames)
        self.begin()
        return out


class BadArchive(ValueError):
    pass


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends: its header, then blocks up to the last."""
    try:
        has_checksum = data[at + 4] & 4
        pos = at + zstandard.frame_header_size(data[at:at + 18])
        while True:
            b = data[pos] | data[pos + 1] << 8 | data[pos + 2] << 16
            kind = b >> 1 & 3
            if kind == 3:
                raise BadArchive(f"reserved block type at byte {pos}")
            pos += 3 + (1 if kind == 1 else b >> 3)
            if b & 1:
                break
        pos += 4 if has_checksum else 0
    except (IndexError, zstandard.ZstdError) as e:
        raise BadArchive(f"frame at byte {at} is cut short or damaged") from e
    if pos > len(data):
        raise BadArchive(f"frame at byte {at} is cut short")
    return pos


def read_frames(data: bytes) -> Iterator[tuple[bytes | None, str | None]]:
    """(record, None) or (None, error) for every frame of an archive."""
    view, at, decoder = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at < 8:
            raise BadArchive(f"{len(view) - at} bytes after the last frame")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            if at + 8 + size > len(view):
                raise BadArchive(f"skippable frame at byte {at} is cut short")
            if magic == DICTIONARY_MAGIC and at == 0 and size:
                body = bytes(view[8:8 + size])
                if body[:4] == struct.pack("<I", FRAME_MAGIC):  # a dictionary may be compressed itself
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
        elif magic == FRAME_MAGIC:
            end = frame_end(view, at)
            try:
                yield decoder.decompressobj().decompress(view[at:end]), None
            except zstandard.ZstdError as e:
                yield None, f"frame at byte {at}: {e}"
            at = end
        else:
            raise BadArchive(f"no frame at byte {at}")


def _digest(value: str) -> str:
    """A sha1 header value (base32 or hex) as lower-case hex."""
    name, _, text = value.partition(":")
    if name.lower() != "sha1":
        raise ValueError(f"digest {name} is not sha1")
    out = text.lower() if len(text) == 40 else base64.b32decode(text.upper()).hex()
    if not re.fullmatch("[0-9a-f]{40}", out):
        raise ValueError("malformed digest")
    return out


_FIELD_NAME = re.compile(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+")


def _headers(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not _FIELD_NAME.fullmatch(name):
            raise ValueError(f"malformed header {name[:40]!r}")
        if name.lower() in out and name.lower() != "warc-concurrent-to":
            raise ValueError(f"header {name.lower()} is repeated")
        out[name.lower()] = value.strip()
    return out


def parse_record(record: bytes, with_payload: bool = True) -> dict:
    """The fields of one record after validation; ValueError names what is wrong."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", version):
        raise ValueError("no WARC header")
    h = _headers(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if not h.get(name):
            raise ValueError(f"header {name} is missing")
    if not re.fullmatch(r"\d+", h["content-length"]):
        raise ValueError("malformed content-length")
    size = int(h["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"content-length is {size}, the block has {len(rest) - 4} bytes")
    block, kind = rest[:size], h["warc-type"]
    if "warc-block-digest" in h and hashlib.sha1(block).hexdigest() != _digest(h["warc-block-digest"]):
        raise ValueError("block digest differs")
    out = {"record_id": h["warc-record-id"], "record_type": kind, "date": h["warc-date"], "target_uri": h.get("warc-target-uri"),
           "page_id": int(h["x-page-id"]) if "x-page-id" in h else None, "refers_to_record": h.get("warc-refers-to"),
           "payload_digest": _digest(h["warc-payload-digest"]) if "warc-payload-digest" in h else None,
           "payload_bytes": None, "payload": None}
    if kind not in ("response", "revisit"):
        return out
    if not out["payload_digest"]:
        raise ValueError("header warc-payload-digest is missing")
    http, gap, payload = block.partition(b"\r\n\r\n")
    status, *lines = http.split(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("no HTTP header")
    told = _headers(lines).get("content-length", "")
    if not re.fullmatch(r"\d+", told):
        raise ValueError("HTTP content-length is missing")
    out["payload_bytes"] = int(told)
    if kind == "revisit":
        if payload or not out["refers_to_record"]:
            raise ValueError("a revisit with a payload or without warc-refers-to")
        return out
    if len(payload) != out["payload_bytes"]:
        raise ValueError(f"HTTP content-length is {told}, the payload has {len(payload)} bytes")
    if hashlib.sha1(payload).hexdigest() != out["payload_digest"]:
        raise ValueError("payload digest differs")
    return out | {"payload": payload if with_payload else None}


def read_archive(data: bytes, with_payload: bool = True) -> Iterator[dict]:
    """Records of one archive, those that fail with their ``error``."""
    frames = read_frames(data)
    while True:
        try:
            record, error = next(frames)
        except StopIteration:
            return
        except BadArchive as e:
            yield {"error": str(e)}
            return
        try:
            yield parse_record(record, with_payload) if error is None else {"error": error}
        except ValueError as e:
            yield {"error": str(e)}


# -- tables ----------------------------------------------------------------------
def write_archives(pages: DataFrame, path: str, scratch: Scratch, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """One record per row of ``pages`` in archives under ``path``."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    sample = pages.select(F.substring(html, 1, SAMPLE_CHARS).cast("binary").alias("s")).limit(SAMPLE_PAGES).collect()
    dictionary = train_dictionary([bytes(r.s) for r in sample])
    rows = pages.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).alias("url"), html.cast("binary").alias("payload"))
    rows = rows.withColumns({"n": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload"), "same": F.sha2("payload", 256)})
    rows = scratch.write(rows, "rows")
    # among equal payloads (by SHA-256 and length) the largest page_id answers for all
    last = F.max(F.struct("page_id", "rid"))
    stored = (rows.filter(F.col("n") >= min_bytes).groupBy("same", "n")
              .agg(last.alias("last"), F.count("*").alias("times")).filter("times > 1")
              .select("same", "n", F.col("last.rid").alias("stored_rid")))
    stored = scratch.write(stored, "stored")
    again = F.col("stored_rid").isNotNull() & (F.col("stored_rid") != F.col("rid"))
    todo = rows.join(stored, ["same", "n"], "left").select(
        "rid", "page_id", "url", "sha1", "n", F.when(~again, F.col("payload")).alias("payload"),
        F.when(again, F.col("stored_rid")).alias("stored_rid"))
    run = path.rstrip("/").rsplit("/", 1)[-1]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = ArchiveWriter(dictionary)
        for b in batches:
            rid, page_id, url, sha1, n, _, stored_rid = (c.to_pylist() if i != 5 else None for i, c in enumerate(b.columns))
            for i in range(b.num_rows):
                again = stored_rid[i] is not None
                out.add(build_record("revisit" if again else "response", record_id(run, rid[i]), url[i], page_id[i], sha1[i], n[i],
                                     b.column(5)[i].as_py(), record_id(run, stored_rid[i]) if again else None))
                if out.size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([out.close()], pa.binary())], ["archive"])
        if out.records:
            yield pa.RecordBatch.from_arrays([pa.array([out.close()], pa.binary())], ["archive"])

    # bytes pass through the text writer as they are; one value a file
    (todo.mapInArrow(pack, "archive binary").select(F.col("archive").cast("string"))
     .write.option("lineSep", SEPARATOR.decode()).option("maxRecordsPerFile", 1).text(path))


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives under ``path`` (columns of ``RECORD``)."""
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]] for f in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], t) for k, t in zip(names, kinds)], names)

        for b in batches:
            for data in b.column(0):
                rows, size = [], 0
                for r in read_archive(data.as_py(), with_payload):
                    rows.append(r)
                    size += len(r.get("payload") or b"") + 300
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def resolve(records: DataFrame, scratch: Scratch) -> DataFrame:
    """Responses and revisits with the page each revisit refers to; a revisit whose
    response is missing or has another digest or length gets an error."""
    index = scratch.write(records.drop("payload"), "index")
    stored = scratch.write(index.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"),
        F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("n"), F.lit(True).alias("there")), "responses")
    out = index.filter("record_type = 'revisit'").join(stored, "refers_to_record", "left")
    good = F.coalesce(F.col("there"), F.lit(False)) & (F.col("d") == F.col("payload_digest")) & (F.col("n") == F.col("payload_bytes"))
    out = out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                     F.coalesce("error", F.when(~good, "the response it refers to is missing or differs")).alias("error"))
    rest = index.filter("record_type is null or record_type <> 'revisit'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"), "error")
    return rest.unionByName(out)


def op12_warc(spark, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    path = f"{scratch.root}/archives"
    write_archives(read(spark, sf_dir, "pages"), path, scratch)
    scratch.drop("rows", "stored")
    return resolve(read_archives(spark, path, with_payload=False), scratch)


ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= {MIN_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_BYTES} AND page_id <> last THEN last END AS refers_to,
       CAST(NULL AS VARCHAR) AS error
FROM m
"""
