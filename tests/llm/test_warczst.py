import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from gapwise.llm import queries, warczst

PAGES = "page_id bigint, url string, html string"


def _rows():
    big, other = "<p>ünï</p>" * 300, "<b>x</b>" * 200
    rows = [(i, f"http://h/{i}", big) for i in range(5)] + [(10, None, other), (11, "http://h/\r\nx", other)]
    rows += [(20, "http://h/s", "short"), (21, "http://h/s", "short"), (22, "http://h/n", None), (23, "u", ""),
             (4, "http://h/again", big), (None, "http://h/null", big), (None, None, None)]
    return rows + [(30 + i, f"http://h/{i}", f"<html>page {i} " + "text " * i) for i in range(300)]


def _want(rows):
    keeper = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if i is not None and len(b) >= 1000:
            keeper[b] = max(i, keeper.get(b, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        k = keeper.get(b)
        again = k is not None and k != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", k if again else None))
    return sorted(out, key=str)


def test_round_trip_with_payloads(spark, tmp_dir):
    rows = _rows()
    pages = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("x")).withColumn("n", F.lit(1))
    dictionary = warczst.sample_dictionary(pages)
    warczst.write_archives(warczst.plan_records(pages), dictionary).write.parquet(tmp_dir + "/a")
    read = warczst.read_records(spark.read.parquet(tmp_dir + "/a")).withColumn(
        "page_id", warczst.page_id_of("record_id").cast("bigint")).collect()
    assert all(r.error is None for r in read)

    def number(uri):
        return int(uri.removeprefix("urn:page:")) if uri else None

    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to))
                  for r in read), key=str)
    assert got == _want(rows)
    html = {(i, hashlib.sha1((h or "").encode()).hexdigest()): (h or "").encode() for i, _, h in rows}
    for r in read:
        assert r.payload is None if r.record_type == "revisit" else (
            bytes(r.payload) == html[r.page_id, r.payload_digest])


def test_small_archives_and_query(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(warczst, "ARCHIVE_BYTES", 2000)
    rows = _rows()
    spark.createDataFrame(rows, PAGES).write.parquet(tmp_dir + "/pages.parquet")
    out = [tuple(r) for r in queries.op6_warc(spark, tmp_dir).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(out, key=str) == _want(rows)


def test_empty_table(spark):
    pages = spark.createDataFrame([], PAGES)
    assert warczst.sample_dictionary(pages) == b""
    assert warczst.write_archives(warczst.plan_records(pages), b"").count() == 0


def _archive(dictionary=b""):
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    packer = zstandard.ZstdCompressor(dict_data=known, write_checksum=True)
    records = [warczst.make_record("response", f"urn:page:{i}", "http://h", b"payload %d " % i * 50,
                                   hashlib.sha1(b"payload %d " % i * 50).digest()) for i in range(4)]
    return [warczst.dictionary_frame(dictionary), *map(packer.compress, records)], records


def test_frames_dictionary_and_one_record_each():
    samples = [(f"<html><body>page {i} " + "common words here " * 20).encode() for i in range(300)]
    dictionary = warczst.train_dictionary(samples, 4096)
    assert dictionary
    frames, records = _archive(dictionary)
    assert struct.unpack_from("<I", frames[0])[0] == 0x184D2A5D
    read = list(warczst.read_archive(b"".join(frames)))
    assert [r["record_id"] for r in read] == [f"urn:page:{i}" for i in range(4)]
    assert read[1]["offset"] == len(frames[0]) + len(frames[1])
    plain = struct.pack("<II", 0x184D2A5D, len(dictionary)) + dictionary  # an unpacked dictionary is fine too
    assert all(r["error"] is None for r in warczst.read_archive(plain + b"".join(frames[1:])))
    assert all(r["error"] for r in warczst.read_archive(b"".join(frames[1:])))  # dictionary missing


def test_damage_is_reported_and_does_not_spread():
    frames, _ = _archive()
    bad = bytearray(frames[2])
    bad[-1] ^= 255
    read = list(warczst.read_archive(b"".join([*frames[:2], bytes(bad), *frames[3:]])))
    assert [r["error"] is None for r in read] == [True, False, True, True]
    read = list(warczst.read_archive(b"".join(frames)[:-3]))
    assert [r["error"] is None for r in read] == [True, True, True, False]
    assert list(warczst.read_archive(b"not an archive"))[0]["error"]
    assert list(warczst.read_archive(b"")) == []


@pytest.mark.parametrize("change", [
    (b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: 4", b"Content-Length: 5"), (b"WARC-Date", b"WARC-Dato"),
    (b"WARC-Type: response", b"no colon"), (b"payload 0 payload", b"payload 1 payload")])
def test_header_and_length_checks(change):
    raw = warczst.make_record("response", "urn:page:1", "u", b"payload 0 " * 40,
                              hashlib.sha1(b"payload 0 " * 40).digest())
    assert warczst.parse_record(raw)["payload"] == b"payload 0 " * 40
    assert change[0] in raw
    with pytest.raises(ValueError):
        warczst.parse_record(raw.replace(*change, 1))


def _record(kind, block, *headers):
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x:{kind}>", "WARC-Date: 2020-01-01T00:00:00Z",
            f"Content-Length: {len(block)}", *headers]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_files_with_all_kinds_of_records(spark, tmp_dir):
    digest = "0123456789012345678901234567890123456789"
    made = [
        (_record("warcinfo", b"software: x\r\nformat: WARC", "Content-Type: application/warc-fields"),
         b"software: x\r\nformat: WARC", 25),
        (_record("request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", "Content-Type: application/http; msgtype=request"), b"", 0),
        (_record("response", b"HTTP/1.1 200 OK\nX-Odd: caf\xe9\nno colon\n\n<p>x", "Content-Type: application/http;msgtype=response",
                 "WARC-Payload-Digest: sha1:" + hashlib.sha1(b"<p>x").hexdigest()), b"<p>x", 4),
        (_record("response", b"HTTP/1.1 200 OK\r\nContent-Length: 99\r\n\r\ncut", "Content-Type: application/http",
                 "WARC-Truncated: length"), b"cut", 3),
        (_record("resource", b"\x00\r\n\r\n\x01", "Content-Type: image/png", "WARC-Target-URI: <http://h/",
                 " a>"), b"\x00\r\n\r\n\x01", 6),
        (_record("metadata", b"", "Content-Type: application/warc-fields"), b"", 0),
        (_record("conversion", "Only täxt".encode(), "Content-Type: text/plain", "WARC-Refers-To: <urn:x:response>"),
         "Only täxt".encode(), 10),
        (_record("revisit", b"HTTP/1.1 200 OK\r\nContent-Length: 7\r\n\r\n", "Content-Type: application/http; msgtype=response",
                 "WARC-Refers-To-Target-URI: http://h/first", f"WARC-Payload-Digest: sha1:{digest}"), None, 7),
        (_record("revisit", b""), None, None),
    ]
    samples = [b"some words that come again %d " % i * 20 for i in range(300)]
    dictionary = warczst.train_dictionary(samples, 4096)
    for name, known in (("a", b""), ("b", dictionary)):
        packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(known) if known else None)
        with open(f"{tmp_dir}/{name}.warc.zst", "wb") as f:
            f.write(warczst.dictionary_frame(known) + b"".join(packer.compress(raw) for raw, _, _ in made))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(tmp_dir)
    read = warczst.read_records(files).orderBy("archive", "offset").collect()
    assert [r.error for r in read] == [None] * 2 * len(made)
    assert [r.archive.rsplit("/", 1)[1] for r in read] == ["a.warc.zst"] * len(made) + ["b.warc.zst"] * len(made)
    assert [(None if r.payload is None else bytes(r.payload), r.payload_bytes) for r in read] == [x[1:] for x in made] * 2
    assert read[7].refers_to is None and read[7].refers_to_url == "http://h/first" and read[7].payload_digest == digest
    assert read[6].refers_to == "urn:x:response" and read[4].url == "http://h/ a"


def test_archives_written_to_files_read_back(spark, tmp_dir):
    rows = _rows()
    pages = spark.createDataFrame(rows, PAGES)
    archives = warczst.write_archives(warczst.plan_records(pages), warczst.sample_dictionary(pages))
    for r in archives.collect():
        with open(f"{tmp_dir}/{r.archive}", "wb") as f:
            f.write(r.content)
    read = warczst.read_records(spark.read.format("binaryFile").load(tmp_dir), payloads=False)
    assert read.where("error is null").count() == read.count() == len(rows)
