from __future__ import annotations

import base64
import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.errors import PySparkException

from feedloom.llm.warc import (
    DICTIONARY_FRAME,
    decode_record,
    encode_record,
    frames,
    page_of,
    read_warc,
    write_archives,
)

PAGES = "page_id bigint, url string, html string"
DATE = "2024-01-01T00:00:00Z"


def round_trip(spark, tmp_path, rows, **options):
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    archives = write_archives(pages, f"file://{tmp_path}/warc", **options)
    found = read_warc(archives).withColumn("page_id", page_of("record_id")).withColumn("of", page_of("refers_to"))
    return archives, found.collect()


def test_payloads_come_back_byte_for_byte(spark, tmp_path):
    rows = [(n, f"http://h/{n}?é#x", f"<p>page {n} é \r\n\r\n WARC/1.1 {'x' * n}") for n in range(500)]
    archives, found = round_trip(spark, tmp_path, rows, archive_bytes=40_000)
    assert archives.count() > 3 and sum(row["n_records"] for row in archives.collect()) == 500
    for row in found:
        _, url, html = rows[row["page_id"]]
        assert bytes(row["payload"]) == html.encode() and row["target_uri"] == url
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert (row["payload_digest"], row["payload_bytes"]) == (digest, len(html.encode()))
        assert (row["record_type"], row["of"]) == ("response", None)


def test_equal_payloads_revisit_the_largest_id(spark, tmp_path):
    rows = [(n, "u", "same" if n % 3 == 0 else f"own {n}") for n in range(300)] + [(None, None, "same"), (297, "u", "same")]
    _, found = round_trip(spark, tmp_path, rows)
    assert len(found) == 302
    for row in found:
        revisit = row["page_id"] is None or (row["page_id"] % 3 == 0 and row["page_id"] != 297)
        assert row["record_type"] == ("revisit" if revisit else "response")
        assert row["of"] == (297 if revisit else None)
        if revisit:
            assert (row["payload"], row["payload_bytes"]) == (None, 4)


def test_short_payloads_do_not_revisit(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    _, found = round_trip(spark, tmp_path, rows, min_bytes=3)
    assert {row["page_id"]: row["record_type"] for row in found} == {
        1: "response", 2: "response", 3: "revisit", 4: "response",
    }


def test_dictionary_leads_and_each_record_is_a_frame(spark, tmp_path):
    rows = [(n, "u", f"<html><body class='main'><p>text {n * n} of page {n}</p></body></html>") for n in range(800)]
    archives, _ = round_trip(spark, tmp_path, rows)
    path = archives.orderBy("n_records", ascending=False).first()["path"].removeprefix("file://")
    data = open(path, "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == DICTIONARY_FRAME
    assert zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])[:4] == b"\x37\xa4\x30\xec"
    for chunk in (7, 64, 1 << 20):
        found = list(frames(io.BytesIO(data), chunk))
        assert all(decode_record(content)["record_type"] == "response" for _, content in found)


def archive(*records, dictionary=None):
    head = b"" if dictionary is None else struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary
    trained = None if dictionary is None else zstandard.ZstdCompressionDict(dictionary, zstandard.DICT_TYPE_RAWCONTENT)
    compressor = zstandard.ZstdCompressor(dict_data=trained)
    return head + b"".join(compressor.compress(record) for record in records)


GOOD = encode_record(1, "http://h/", b"payload", "response", None, DATE)


def test_raw_dictionaries_other_skippable_frames_and_plain_archives():
    skipped = struct.pack("<II", 0x184D2A53, 3) + b"abc"
    for data in (archive(GOOD, GOOD), archive(GOOD, GOOD, dictionary=b"payload" * 20), skipped + archive(GOOD) + skipped + archive(GOOD)):
        assert [decode_record(c)["payload"] for _, c in frames(io.BytesIO(data))] == [b"payload"] * 2


BROKEN = {
    "length too long": GOOD.replace(b"Content-Length: 7\r\n\r\npayload", b"Content-Length: 7\r\n\r\npaylo"),
    "no version": GOOD.replace(b"WARC/1.1", b"HTTP/1.1", 1),
    "no record id": GOOD.replace(b"WARC-Record-ID", b"X-Other"),
    "length is text": GOOD.replace(b"Content-Length: ", b"Content-Length: x", 1),
    "digest": GOOD.replace(b"payload\r\n", b"pAyload\r\n"),
    "header without colon": GOOD.replace(b"WARC-Type: ", b"WARC-Type ", 1),
    "HTTP length": GOOD.replace(b"Content-Length: 7", b"Content-Length: 6"),
    "text after the record": GOOD + b"x",
}


@pytest.mark.parametrize("name", sorted(BROKEN))
def test_wrong_records_are_refused(name):
    with pytest.raises(ValueError):
        decode_record(BROKEN[name])


@pytest.mark.parametrize("cut", [3, 30, -5])
def test_broken_archives_stop_or_are_reported(spark, tmp_path, cut):
    (tmp_path / "a.warc.zst").write_bytes(archive(GOOD, BROKEN["digest"], GOOD) + archive(GOOD)[:cut])
    paths = spark.createDataFrame([(f"file://{tmp_path}/a.warc.zst",)], "path string")
    with pytest.raises(PySparkException, match="a.warc.zst"):
        read_warc(paths).collect()
    found = read_warc(paths, on_error="report").collect()
    assert [row["error"] is None for row in found] == [True, False, True, False]


def test_a_folder_that_tasks_cannot_open_is_refused_at_the_start(spark):
    pages = spark.createDataFrame([(1, "u", "x")], "page_id bigint, url string, html string")
    with pytest.raises(ValueError, match="tasks cannot open wasbs: files"):
        write_archives(pages, "wasbs://c@host/warc")
