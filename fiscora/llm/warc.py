"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

The writer makes one archive (or more, by size) per task in the shared folder, under a name of its own, so a task that
runs again leaves at most an unread file; the reader opens the archives that finished tasks reported.  Each archive is
read frame by frame: one record is in memory at a time, and its version line, headers, lengths and digests are
checked.  Files are opened through pyarrow.fs by URI, so the folder can be in any store that pyarrow reaches.

Of records with equal payloads of `min_bytes` or more, the one of the largest id is a response and the others are
revisits of it (rows that repeat the largest id are all responses); smaller ones are all responses.

Defined cases: null html is an empty payload; a null url gives a urn of the id; control characters and spaces of a url
are percent-encoded in its header; an empty table gives no archive and no rows; other columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, sample_share, scratch

# Fixed values of the WARC and Zstandard formats.
SKIPPABLE = (0x184D2A5D).to_bytes(4, "little")
FRAME = (0xFD2FB528).to_bytes(4, "little")
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 20


class WarcError(ValueError):
    """An archive that breaks its format."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str | None, page: str) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else f"urn:page:{page}"


def build_record(page: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        VERSION.decode(), f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {_uri(url, page)}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{payload_digest(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """The record's headers (lower-case names), block and payload length and digest, checked."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or lines[0] not in (b"WARC/1.0", VERSION):
        raise WarcError(f"no WARC version line: {record[:40]!r}")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"bad header line {line[:80]!r}")
        headers[name.strip().lower().decode()] = value.strip().decode()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"record without {name}")
    length = headers["content-length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length {length} of {headers['warc-record-id']} does not fit its {len(rest) - 4} bytes")
    block = rest[:-4]
    if headers.get("warc-block-digest", "").removeprefix("sha1:") not in ("", payload_digest(block)):
        raise WarcError(f"block digest of {headers['warc-record-id']} differs")
    out = {"headers": headers, "block": block}
    if headers["warc-type"] in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        said = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if headers["warc-type"] == "response":
            if said not in (None, len(payload)) or digest not in ("", payload_digest(payload)):
                raise WarcError(f"payload of {headers['warc-record-id']} differs from its headers")
            said, digest = len(payload), payload_digest(payload)
        elif "warc-refers-to" not in headers or said is None or not digest:
            raise WarcError(f"revisit {headers['warc-record-id']} says not what it revisits")
        out |= {"payload_bytes": said, "payload_digest": digest, "payload": payload}
    return out


def read_frames(stream) -> Iterator[bytes]:
    """The content of each frame of an archive, one at a time; `stream` has read(n)."""
    data = stream.read(READ_BYTES)

    def need(n: int) -> bool:
        nonlocal data
        while len(data) < n and (more := stream.read(READ_BYTES)):
            data += more
        return len(data) >= n

    dictionary = None
    if need(8) and data[:4] == SKIPPABLE:
        size = int.from_bytes(data[4:8], "little")
        if not need(8 + size):
            raise WarcError("the dictionary's frame is cut off")
        raw, data = data[8 : 8 + size], data[8 + size :]
        dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw) if raw[:4] == FRAME else raw)
    engine = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while need(1):
        if not need(4) or data[:4] != FRAME:
            raise WarcError("no Zstandard frame where a record should be")
        frame, parts = engine.decompressobj(), []
        while not frame.eof:
            if not data and not need(1):
                raise WarcError("the last frame is cut off")
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI with its scheme, as Spark's file systems resolve it, so that pyarrow opens the same store."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return "file://" + found.removeprefix("file:") if found.startswith("file:/") and not found.startswith("file://") else found


def train_dictionary(payloads: list[bytes], size: int = 1 << 16) -> bytes:
    """A trained dictionary, or where there are too few samples their plain content."""
    samples = [build_record("0", f"https://example.com/{i}", p, None, "2024-01-01T00:00:00Z") for i, p in enumerate(payloads)]
    samples += [build_record(str(i), None, b"<!DOCTYPE html><html><head></head><body></body></html>", None, "2024-01-01T00:00:00Z") for i in range(8)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def revisits(pages: DataFrame, min_bytes: int, id_col: str, url_col: str, html_col: str, broadcast_rows: int) -> DataFrame:
    """(_id, _url, _html, _to): the id of the response that a row revisits, else null."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"), F.coalesce(F.col(html_col), F.lit("")).alias("_html")
    ).withColumn("_key", F.struct(F.octet_length("_html").alias("n"), F.unhex(F.sha1("_html")).alias("sha1")))
    groups = materialise(
        rows.filter(F.octet_length("_html") >= min_bytes).groupBy("_key").agg(F.max("_id").alias("_to"), F.count("*").alias("_n")).filter("_n > 1").drop("_n"), "warc-groups"
    ).withColumnRenamed("_key", "_of")
    if groups.count() <= broadcast_rows:
        groups = F.broadcast(groups)
    joined = rows.join(groups, F.col("_key") == F.col("_of"), "left")
    return joined.select("_id", "_url", "_html", F.when(F.col("_to") > F.col("_id"), F.col("_to")).alias("_to"))


def write_archives(rows: DataFrame, folder: str, dictionary: bytes, max_bytes: int = 128 << 20, level: int = 3, date: str = "2024-01-01T00:00:00Z") -> list[str]:
    """Writes (_id, _url, _html, _to) as archives below `folder`; the paths that finished tasks wrote."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        engine = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
        out, name, size = None, "", 0
        for batch in batches:
            for page, url, html, to in zip(*(batch.column(i) for i in range(4))):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name, size = f"{uuid.uuid4().hex}.warc.zst", 0
                    out = fs.open_output_stream(f"{base}/{name}")
                    out.write(SKIPPABLE + len(packed).to_bytes(4, "little") + packed)
                record = build_record(str(page.as_py()), url.as_py(), html.as_py().encode(), None if to.as_py() is None else str(to.as_py()), date)
                frame = engine.compress(record)
                out.write(frame)
                size += len(frame)
                if size >= max_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], names=["path"])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], names=["path"])

    return [r["path"] for r in rows.mapInArrow(run, "path string").collect()]


def read_archives(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of the archives' records, one task an archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ident(value: str | None) -> int | None:
            tail = (value or "").strip("<>").rpartition(":")[2]
            return int(tail) if tail.lstrip("-").isdigit() else None

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_stream(at) as stream:
                    for record in read_frames(stream):
                        r = parse_record(record)
                        h = r["headers"]
                        payload = r["payload"] if h["warc-type"] == "response" else None
                        rows.append((ident(h["warc-record-id"]), h.get("warc-target-uri"), r["payload_bytes"], r["payload_digest"], h["warc-type"], ident(h.get("warc-refers-to")), payload))
                        held += len(payload or b"")
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield flush(rows)
                            rows, held = [], 0
                if rows:
                    yield flush(rows)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return listed.repartition(max(1, len(paths))).mapInArrow(run, schema)


def round_trip(
    pages: DataFrame, min_bytes: int = 0, sample_rows: int = 500, sample_chars: int = 1 << 16, broadcast_rows: int = 100_000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Writes the pages as archives in the shared folder and returns what reading them back gives.

    The dictionary is trained on about sample_rows pages, of each sample_chars characters at most.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    sample = sample_share(pages.select(id_col, html_col), id_col, sample_rows).select(F.substring(F.coalesce(F.col(html_col), F.lit("")), 1, sample_chars)).toArrow()
    dictionary = train_dictionary([x.encode() for x in sample.column(0).to_pylist()])
    folder = qualified(spark, scratch(spark, "warc"))
    return read_archives(spark, write_archives(revisits(pages, min_bytes, id_col, url_col, html_col, broadcast_rows), folder, dictionary))
