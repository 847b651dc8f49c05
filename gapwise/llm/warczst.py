"""WARC archives in Zstandard: one frame per record behind a dictionary frame.

Layout of an archive: a skippable frame (magic 0x184D2A5D) with the
zstd-compressed dictionary, then one Zstandard frame, with content size and
checksum, for each WARC/1.1 record. The reader loads the dictionary from the
leading skippable frame, finds the end of each frame from its block headers,
and decodes frame by frame, so a damaged record does not hide the others. It
checks the WARC version line, required headers, Content-Length against the
block, the record's end, the HTTP length against the payload and the payload's
SHA-1 (the last two not of truncated or segmented records). What fails is a row
with ``error`` set, never a dropped row. Only a block of Content-Type
application/http has an HTTP head before its payload; other blocks (warcinfo,
metadata, resource, conversion) are payload whole. A revisit may name what it
refers to by id, by target URI (``refers_to_url``), or not at all.

Archives are rows (archive, content): those that ``write_archives`` makes, or
``spark.read.format("binaryFile")`` over *.warc.zst files (their ``path`` is the
archive's name). An archive is closed
at ``ARCHIVE_BYTES`` of compressed records, so a task holds one small archive.

Equal payloads: of pages whose payloads of at least ``MIN_BYTES`` bytes are
equal, the one with the largest page_id is a ``response`` and the others are
``revisit`` records that refer to it. The largest id of every digest comes
from one narrow aggregation; digests that occur more than once are joined back
with a salt, so that a payload shared by a large part of all pages is spread
over tasks.

Edge cases: null html is an empty payload; a null url gives no target header;
a page with a null page_id revisits an equal page that has one, or is a
response; rows that repeat the largest page_id are all responses; an empty
table gives no archives; the dictionary is trained on a bounded sample
(``SAMPLE_PAGES`` pages) and left out where that is too small to train on.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.arrowtext import in_share, map_arrow

MIN_BYTES = 1000
ARCHIVE_BYTES = 4 << 20
SAMPLE_PAGES = 400
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 32_768
SALTS = 32
DATE = "2000-01-01T00:00:00Z"
_DICT_MAGIC = 0x184D2A5D
_FRAME_MAGIC = 0xFD2FB528
_ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
#: Servers also end HTTP head lines with a bare line feed.
_HTTP_END = re.compile(rb"\r?\n\r?\n")
_HTTP_LENGTH = re.compile(rb"^content-length[ \t]*:[ \t]*(\d+)[ \t]*\r?$", re.I | re.M)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for records like the samples; empty if they are too few or too small."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    if not dictionary:
        return b""
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", _DICT_MAGIC, len(packed)) + packed


def make_record(kind: str, record_id: str, url: str | None, payload: bytes, digest: bytes,
                refers_to: str | None = None, date: str = DATE) -> bytes:
    """One WARC record; a revisit keeps the HTTP head of its response and drops the payload."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
             + str(len(payload)).encode() + _END)
    if kind == "response":
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
            "WARC-Payload-Digest: sha1:" + base64.b32encode(digest).decode(),
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + _END + block + _END


def frame_end(data: memoryview, start: int) -> int:
    """Where the frame that begins at ``start`` ends, from its headers alone."""
    if start + 8 > len(data):
        raise ValueError("truncated frame header")
    magic, size = struct.unpack_from("<II", data, start)
    if magic & 0xFFFFFFF0 == 0x184D2A50:
        end = start + 8 + size
    elif magic == _FRAME_MAGIC:
        head = bytes(data[start:start + 18])
        try:
            checksum = zstandard.get_frame_parameters(head).has_checksum
            end = start + zstandard.frame_header_size(head)
        except zstandard.ZstdError as e:
            raise ValueError(f"bad frame header: {e}") from None
        last = 0
        while not last:
            if end + 3 > len(data):
                raise ValueError("truncated frame")
            block = int.from_bytes(data[end:end + 3], "little")
            last, kind = block & 1, block >> 1 & 3
            end += 3 + (1 if kind == 1 else block >> 3)
        end += 4 * checksum
    else:
        raise ValueError(f"no frame at byte {start}")
    if end > len(data):
        raise ValueError("truncated frame")
    return end


def _headers(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8").split("\r\n")
    out = {}
    for line in lines:
        if line[:1] in (" ", "\t") and out:
            out[name.strip().lower()] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {line[:60]!r}")
        out[name.strip().lower()] = value.strip()
    return first, out


def _bare(uri: str | None) -> str | None:
    return uri.strip("<>") if uri else None


def _split_http(block: bytes) -> tuple[int | None, bytes]:
    """The length that the HTTP head of a block names, and the payload after it."""
    end = _HTTP_END.search(block)
    if not end:
        raise ValueError("block without HTTP header end")
    length = _HTTP_LENGTH.search(block, 0, end.end())
    return int(length[1]) if length else None, block[end.end():]


def _sha1(named: str) -> str | None:
    """The hex digits of a digest header, which has them in base 32 or hex; None if it is no SHA-1."""
    algorithm, _, value = named.partition(":")
    if algorithm.lower().replace("-", "") != "sha1":
        return None
    return bytes.fromhex(value).hex() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def parse_record(raw: bytes) -> dict:
    """The checked fields of one record; ValueError says what is wrong with it."""
    head, found, rest = raw.partition(_END)
    if not found:
        raise ValueError("record without header end")
    version, h = _headers(head)
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"bad version line {version[:40]!r}")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in h:
            raise ValueError(f"missing header {name}")
    if not h["content-length"].isdigit():
        raise ValueError("bad Content-Length")
    size = int(h["content-length"])
    if len(rest) != size + len(_END) or rest[size:] != _END:
        raise ValueError(f"Content-Length {size} does not match the record")
    kind, length, payload = h["warc-type"], None, rest[:size]
    whole = kind != "revisit" and "warc-truncated" not in h and "warc-segment-number" not in h
    http = h.get("content-type", "").partition(";")[0].strip().lower() == "application/http"
    if http and (payload or kind != "revisit"):
        length, payload = _split_http(payload)
        if kind == "revisit" and payload:
            raise ValueError("revisit record with a payload")
        if whole and length is not None and length != len(payload):
            raise ValueError(f"HTTP Content-Length {length} does not match the payload")
    digest = _sha1(h.get("warc-payload-digest", ""))
    if whole and digest is not None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("payload does not match its digest")
    bare = kind == "revisit" and not payload
    url = h.get("warc-target-uri")
    if version == "WARC/1.0" and url and url[0] == "<" and url[-1] == ">":
        url = url[1:-1]  # as the grammar of 1.0 has it
    return {"record_id": _bare(h["warc-record-id"]), "record_type": kind, "date": h["warc-date"],
            "url": url, "refers_to": _bare(h.get("warc-refers-to")),
            "refers_to_url": h.get("warc-refers-to-target-uri"),
            "payload_bytes": length if bare else len(payload),
            "payload_digest": digest, "payload": None if bare else payload}


def read_archive(content: bytes) -> Iterator[dict]:
    """A dict for each frame: the record's fields, its offset, and ``error`` where it is bad."""
    data, at = memoryview(content), 0
    dictionary = None
    while at < len(data):
        try:
            end = frame_end(data, at)
            if data[at:at + 4] != _ZSTD_MAGIC:
                if at == 0 and struct.unpack_from("<I", data)[0] == _DICT_MAGIC:
                    body = bytes(data[8:end])
                    if body[:4] == _ZSTD_MAGIC:
                        body = zstandard.ZstdDecompressor().decompress(body)
                    dictionary = zstandard.ZstdCompressionDict(body)
                at = end
                continue
        except (ValueError, zstandard.ZstdError) as e:
            yield {"offset": at, "error": str(e)}
            return  # without its length nothing after this frame can be found
        try:
            reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
            raw = reader.decompressobj().decompress(bytes(data[at:end]))
            yield {"offset": at, "error": None, **parse_record(raw)}
        except (ValueError, zstandard.ZstdError) as e:
            yield {"offset": at, "error": str(e)}
        at = end


def plan_records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``pages(page_id, url, html)`` with payload, digest, record_type and refers_to."""
    plain = pages.select(
        "page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    ).select("*", F.sha1("payload").alias("digest"),
             F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("salt"))
    shared = (plain.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
              .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
              .select("digest", "salt", "keeper"))
    again = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return plain.join(shared, ["digest", "salt"], "left").select(
        "page_id", "url", "payload", "digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("keeper")).alias("refers_to"))


def _name(page_id) -> str:
    return "urn:page:" + ("" if page_id is None else str(page_id))


def write_archives(records: DataFrame, dictionary: bytes, date: str = DATE) -> DataFrame:
    """(archive, content) of the records of ``plan_records``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        head = dictionary_frame(dictionary)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=True,
                                          write_content_size=True)
        part, number, frames, size = TaskContext.get().partitionId(), 0, [head], 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([f"part-{part:05d}-{number:05d}.warc.zst"]),
                 pa.array([b"".join(frames)], pa.binary())], names=["archive", "content"])

        for b in batches:
            for page_id, url, payload, digest, kind, keeper in zip(*(c.to_pylist() for c in b.columns)):
                frame = packer.compress(make_record(
                    kind, _name(page_id), url, payload, bytes.fromhex(digest), _name(keeper), date))
                if size and size + len(frame) > ARCHIVE_BYTES:
                    yield archive()
                    number, frames, size = number + 1, [head], 0
                frames.append(frame)
                size += len(frame)
        if size:
            yield archive()

    return map_arrow(records.select("page_id", "url", "payload", "digest", "record_type", "refers_to"),
                     run, "archive string, content binary")


_FIELDS = [("offset", pa.int64(), T.LongType()), ("record_id", pa.string(), T.StringType()),
           ("record_type", pa.string(), T.StringType()), ("date", pa.string(), T.StringType()),
           ("url", pa.string(), T.StringType()), ("refers_to", pa.string(), T.StringType()),
           ("refers_to_url", pa.string(), T.StringType()),
           ("payload_bytes", pa.int64(), T.LongType()),
           ("payload_digest", pa.string(), T.StringType()),
           ("payload", pa.binary(), T.BinaryType()), ("error", pa.string(), T.StringType())]


def read_records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """A row for each record of ``archives(archive, content)``, or of binaryFile rows with their ``path``
    as the archive; ``payloads`` False leaves those out."""
    fields = [x for x in _FIELDS if payloads or x[0] != "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(name: str, got: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * len(got), pa.string()),
                 *(pa.array([r.get(f) for r in got], kind) for f, kind, _ in fields)],
                names=["archive", *(f for f, _, _ in fields)])

        for b in batches:
            for name, content in zip(b.column(0), b.column(1)):
                held = []
                for record in read_archive(content.as_py() or b""):
                    if not payloads:
                        record.pop("payload", None)
                    held.append(record)
                    if len(held) == 256:
                        yield rows(name.as_py(), held)
                        held = []
                if held:
                    yield rows(name.as_py(), held)

    schema = T.StructType([T.StructField("archive", T.StringType()),
                           *(T.StructField(f, kind) for f, _, kind in fields)])
    name = "archive" if "archive" in archives.columns else "path"
    return map_arrow(archives.select(F.col(name).alias("archive"), "content"), run, schema)


def sample_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from the ``SAMPLE_PAGES`` pages whose ids have the smallest hashes."""
    some = in_share(F.col("page_id"), SAMPLE_PAGES, pages.count())
    rows = (pages.where("html is not null and page_id is not null").where(some)
            .select(F.xxhash64("page_id").alias("h"), "page_id",
                    F.substring("html", 1, SAMPLE_BYTES // 4).alias("html"))
            .orderBy("h", "page_id", "html").limit(SAMPLE_PAGES).collect())
    return train_dictionary([make_record("response", _name(r["page_id"]), None, r["html"].encode(), b"\0" * 20)
                             for r in rows])


def page_id_of(record_id: str):
    """Column: the page id that ``write_archives`` put into a record id; null if none."""
    return F.nullif(F.substring(F.col(record_id), len("urn:page:") + 1, 1 << 30), F.lit(""))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha1(body) AS digest FROM p),
k AS (SELECT digest, max(page_id) AS keeper FROM d WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM d LEFT JOIN k ON d.digest = k.digest
"""
