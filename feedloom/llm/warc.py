"""WARC archives compressed with Zstandard: one frame per record, dictionary in a leading skippable frame.

Tasks write and read archive files in the shared folder as streams, so that neither side
ever holds more than one record and one batch of rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.lookup import BROADCAST_BYTES, width
from feedloom.sources.streams import opened
from feedloom.workspace import new_path, settle

# Fixed values of the formats.
SKIPPABLE = 0x184D2A50
DICTIONARY_FRAME = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payload bytes after which a writing task begins its next archive.
ARCHIVE_BYTES = 64 << 20
#: A dictionary is trained on the first records of its archive, up to so many bytes.
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 48 << 10
MIN_SAMPLES = 64
#: Record bytes after which a reading task hands on its rows.
BATCH_BYTES = 8 << 20
READ_BYTES = 1 << 18

WRITTEN = "path string, n_records bigint, n_bytes bigint"
RECORDS = (
    "path string, position bigint, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary, error string"
)
RECORD_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("position", pa.int64()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
        ("error", pa.string()),
    ]
)


def record_id(page_id: int | None) -> str:
    return f"<urn:feedloom:page:{'none' if page_id is None else page_id}>"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_value(text: str) -> str:
    """Text for one header line: control characters are written as percent escapes."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def encode_record(
    page_id: int | None, url: str | None, payload: bytes, record_type: str, refers_to: int | None, date: str
) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if record_type == "response" else b"")
    fields = [
        ("WARC-Type", record_type),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", header_value(url)))
    if record_type == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def decode_record(data: bytes) -> dict:
    """The fields of one record; raises ValueError where headers or lengths are wrong."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/1."):
        raise ValueError("no WARC version line or end of headers")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"header line without a colon: {line[:80]!r}")
        fields[name.strip().lower().decode()] = value.strip().decode()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isdigit():
        raise ValueError("content-length is not a number")
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"content-length {length}, but {len(rest) - 4} bytes before the end of the record")
    kind = fields["warc-type"]
    row = {
        "record_type": kind,
        "record_id": fields["warc-record-id"],
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload": block,
        "payload_bytes": length,
    }
    if fields.get("content-type", "").startswith("application/http"):
        http, found, payload = block.partition(b"\r\n\r\n")
        if not found:
            raise ValueError("HTTP headers without an end")
        declared = None
        for line in http.split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length":
                declared = int(value)
        row |= {"payload": payload, "payload_bytes": len(payload)}
        if kind == "revisit":
            row |= {"payload": None, "payload_bytes": declared}
        elif declared is not None and declared != len(payload):
            raise ValueError(f"HTTP content-length {declared}, but {len(payload)} bytes")
    if kind == "response" and row["payload_digest"] not in (None, base32_sha1(row["payload"])):
        raise ValueError("payload digest does not match")
    return row


def trained(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    if len(samples) < MIN_SAMPLES:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:  # samples too alike or too small for one
        return None


class ArchiveWriter:
    """One archive: records wait until there is a dictionary, then each becomes a frame."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        self.waiting: list[bytes] = []
        self.held = self.payload = self.records = self.size = 0
        self.sink = None

    def start(self) -> None:
        fs, path = opened(self.path)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.sink = fs.open_output_stream(path, compression=None)
        dictionary = trained(self.waiting)
        if dictionary is not None:
            packed = zstandard.ZstdCompressor(level=9).compress(dictionary.as_bytes())
            self.put(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        for record in self.waiting:
            self.put(self.compressor.compress(record))
        self.waiting = []

    def put(self, data: bytes) -> None:
        self.sink.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self.records += 1
        self.payload += len(record)
        if self.sink is not None:
            self.put(self.compressor.compress(record))
            return
        self.waiting.append(record)
        self.held += len(record)
        if self.held >= SAMPLE_BYTES:
            self.start()

    def close(self) -> dict:
        if self.sink is None:
            self.start()
        self.sink.close()
        return {"path": self.path, "n_records": self.records, "n_bytes": self.size}


def archiver(folder: str, date: str, archive_bytes: int) -> Callable:
    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, writer = [], None
        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "payload", "record_type", "refers_to")]
            for at in range(batch.num_rows):
                writer = writer or ArchiveWriter(folder)
                writer.add(encode_record(*[column[at].as_py() for column in columns], date))
                if writer.payload >= archive_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_pylist(done)

    return archive


def frames(source, size: int = READ_BYTES) -> Iterator[tuple[int, bytes]]:
    """(position, content) of each frame of an archive, decoded one at a time."""
    position, held, decompressor = 0, b"", zstandard.ZstdDecompressor()

    def more(want: int) -> bool:
        nonlocal held
        while len(held) < want and (data := source.read(size)):
            held += data
        return len(held) >= want

    while more(1):
        if not more(8):
            raise ValueError("archive ends inside a frame's header")
        magic, length = struct.unpack("<II", held[:8])
        if magic & ~0xF == SKIPPABLE:
            if not more(8 + length):
                raise ValueError("archive ends inside a skippable frame")
            content, held = held[8 : 8 + length], held[8 + length :]
            if magic == DICTIONARY_FRAME and position == 0:
                if content.startswith(FRAME_MAGIC):
                    content = zstandard.ZstdDecompressor().decompress(content)
                trained = content.startswith(DICTIONARY_MAGIC)
                kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
                decompressor = zstandard.ZstdDecompressor(
                    dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind)
                )
            position += 8 + length
            continue
        if not held.startswith(FRAME_MAGIC):
            raise ValueError("not a Zstandard frame")
        frame, parts, taken = decompressor.decompressobj(), [], 0
        data = held
        while True:
            parts.append(frame.decompress(data))
            taken += len(data)
            if frame.eof:
                break
            data = source.read(size)
            if not data:
                raise ValueError("archive ends inside a frame")
        held = frame.unused_data
        yield position, b"".join(parts)
        position += taken - len(held)


def reader(on_error: str) -> Callable:
    def rows_of(path: str) -> Iterator[dict]:
        def reported(fault: Exception) -> dict:
            if on_error == "raise":
                raise ValueError(f"{path}, frame after byte {position}: {fault}") from fault
            return {"path": path, "position": position, "error": str(fault)}

        position = 0
        fs, inner = opened(path)
        with fs.open_input_stream(inner, compression=None) as source:
            found = frames(source)
            while True:
                try:
                    position, content = next(found, (position, None))
                except (ValueError, zstandard.ZstdError) as fault:
                    yield reported(fault)
                    return  # where the next frame begins is not known
                if content is None:
                    return
                try:
                    yield {"path": path, "position": position} | decode_record(content)
                except ValueError as fault:
                    yield reported(fault)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for row in rows_of(path):
                    rows.append(row)
                    size += len(row.get("payload") or b"")
                    if size >= BATCH_BYTES or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)

    return read


def with_record_types(pages: DataFrame, page_id: str, url: str, html: str, min_bytes: int) -> DataFrame:
    """(page_id, url, payload, record_type, refers_to), one row per page.

    Of equal payloads of at least `min_bytes` the largest page_id is the response. Which
    payloads recur is settled over digests; only those digests are joined back, broadcast
    where their measured size allows it.
    """
    records = pages.select(
        F.col(f"`{page_id}`").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    shared = (
        records.where(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "response")
    )
    shared = settle(shared, "shared-payloads")
    if width(shared) <= BROADCAST_BYTES:
        shared = F.broadcast(shared)
    joined = records.join(shared, "digest", "left")
    revisits = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("response")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one record per page into archives in `folder`; (path, n_records, n_bytes) of each.

    The payload is the html in UTF-8, empty for null. A null url has no target header.
    Equal payloads become revisits of the one with the largest page_id; pages without an
    id are smaller than any. Repeated rows each get a record; those of the response are
    all responses. An empty table gives no archive. Other columns are not written.

    An archive's name is new for each attempt of a task, and only attempts that ended are
    listed, so files of lost or repeated tasks are never read. A folder that tasks cannot
    open by themselves (`sources.streams`) is refused before anything is read.
    """
    opened(folder)
    records = with_record_types(pages, page_id, url, html, min_bytes)
    return settle(records.mapInArrow(archiver(folder, date, archive_bytes), WRITTEN), "archives")


def read_warc(archives: DataFrame, on_error: str = "raise") -> DataFrame:
    """The records of the archives whose paths are in the column `path`, streamed by tasks.

    A record with wrong headers, lengths or digest, and a broken archive, stop the job, or
    with on_error="report" give a row with an `error`. A revisit has no payload; its
    payload_bytes are those its HTTP headers name.
    """
    if on_error not in ("raise", "report"):
        raise ValueError(f"on_error must be 'raise' or 'report', not {on_error!r}")
    paths = archives.select("path")
    parts = max(1, paths.count())
    return paths.repartition(parts, "path").mapInArrow(reader(on_error), RECORDS)


def warc_round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    return read_warc(write_archives(pages, new_path(spark, "warc"), min_bytes=min_bytes))


def page_of(identifier: str):
    """The page_id in a record's identifier; null where there is none."""
    return F.regexp_extract(identifier, r":page:(-?[0-9]+)>", 1).try_cast("bigint")
