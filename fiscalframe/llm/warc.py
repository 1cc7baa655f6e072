"""WARC archives compressed record by record with Zstandard and a shared dictionary.

An archive starts with a skippable frame that holds the dictionary; then comes
one frame per record. Spark's text writer puts the frames into files, so task
retries and lost executors leave no half archive on any file system. Its line
separator is an empty skippable frame, which every Zstandard reader passes
over. Archives are read back whole by Spark's binary reader; they hold a
bounded number of records. The reader takes archives of other writers too:
dictionary frames that are compressed themselves, several skippable frames,
frames without content size.

Defined results: a null payload is empty. A null url gives a record without
target; control characters, blanks and characters beyond ASCII are
percent-encoded in it. Rows that repeat id and payload are records of one type. A record
whose headers, lengths or digests are wrong comes back with ``error`` set, and
so does the rest of a damaged archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalframe.sources.outputs import scratch_path

# Numbers and names of the two formats.
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

#: An empty skippable frame; all its bytes are ASCII.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"

#: Characters of a url that stay as they are.
_URI = "".join(map(chr, range(33, 127)))

ID_PREFIX = "urn:page:"
DATE = "2000-01-01T00:00:00Z"
RECORDS_PER_ARCHIVE = 4096
DICTIONARY_BYTES = 64 << 10
#: The dictionary is trained on so many payloads of at most so many bytes.
SAMPLE_ROWS = 256
SAMPLE_BYTES = 64 << 10

_PLAN = "page_id long, url string, payload binary, digest binary, payload_bytes long, refers_to long, record_type string"
_RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, error string"


def plan_records(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Which page is a response and which revisits one, by equal payloads of at least ``least`` bytes.

    Only ids and digests are grouped, with one row per digest and task, so a
    payload that a third of all pages share costs nothing. The join spreads
    such a payload over tasks, as one side holds each digest once.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.unhex(F.sha1("payload")), "payload_bytes": F.octet_length("payload").cast("long")})
    keys = pages.select(F.col(id_col).cast("long").alias("page_id"), F.unhex(F.sha1(body)).alias("digest"))
    latest = keys.groupBy("digest").agg(F.max("page_id").alias("latest"))
    joined = rows.join(latest, "digest", "left")
    again = (F.col("payload_bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("latest"))
    return joined.select(
        "page_id",
        "url",
        F.when(~again, F.col("payload")).alias("payload"),
        "digest",
        "payload_bytes",
        F.when(again, F.col("latest")).alias("refers_to"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
    )


def record_bytes(page_id: int | None, url: str | None, payload: bytes | None, digest: bytes, payload_bytes: int, refers_to: int | None, kind: str, date: str) -> bytes:
    name = base64.b32encode(digest).decode()
    # The block of a revisit ends after the response's header, which still tells the payload's length.
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % payload_bytes
    block += payload or b""
    # Without id: a name of its own, from what the record holds.
    own = page_id if page_id is not None else f"none-{hashlib.sha1(repr((url, digest)).encode()).hexdigest()}"
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{ID_PREFIX}{own}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("WARC-Payload-Digest", f"sha1:{name}"),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"),
    ]
    if url is not None:
        # A line end in it would end the header.
        head.append(("WARC-Target-URI", quote(url, safe=_URI)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>")]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame, payload: str = "html") -> bytes:
    """Trained on a sample of bounded size, drawn by a hash; raw content where it is too small to train on."""
    body = F.col(payload).cast("string")
    usable = pages.select(body.alias("p")).filter((F.octet_length("p") > 0) & (F.octet_length("p") <= SAMPLE_BYTES))
    thin = max(1, usable.count() // (4 * SAMPLE_ROWS))
    drawn = usable.filter(F.pmod(F.xxhash64("p"), F.lit(thin)) == 0).orderBy(F.xxhash64("p", F.lit("order"))).limit(SAMPLE_ROWS)
    sample = [r["p"].encode() for r in drawn.collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[:DICTIONARY_BYTES] or VERSION


def write_archives(planned: DataFrame, path: str, dictionary: bytes, date: str = DATE, level: int = 3) -> None:
    """Records as ``.warc.zst`` streams under ``path``, at most RECORDS_PER_ARCHIVE in each."""
    lead = struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
        written = 0
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                if written % RECORDS_PER_ARCHIVE == 0:
                    out.append(lead)
                number = lambda v: None if pd.isna(v) else int(v)
                record = record_bytes(number(row.page_id), row.url, row.payload, row.digest, int(row.payload_bytes), number(row.refers_to), row.record_type, date)
                out.append(packer.compress(record))
                written += 1
            yield pd.DataFrame({"frame": out})

    made = planned.select(*[c.split()[0] for c in _PLAN.split(", ")]).mapInPandas(frames, "frame binary")
    # The writer starts a new file after so many rows, and each file's first row is the dictionary.
    out = made.select(F.col("frame").cast("string").alias("value")).write
    out.option("lineSep", SEPARATOR).option("maxRecordsPerFile", RECORDS_PER_ARCHIVE + 1).option("compression", "none").text(path)


def frame_length(data: memoryview, at: int) -> int:
    """Length of the Zstandard frame that starts at ``at``, from its block headers."""
    size = zstandard.frame_header_size(data[at : at + 18])
    checked = data[at + 4] >> 2 & 1
    end = at + size
    while True:
        head = int.from_bytes(data[end : end + 3], "little")
        if end + 3 > len(data):
            raise ValueError("a frame is cut off")
        # A run-length block holds one byte, whatever its length.
        end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    end += 4 * checked
    if end > len(data):
        raise ValueError("a frame is cut off")
    return end - at


def archive_records(data: bytes) -> Iterator[bytes]:
    """The decoded records of one archive."""
    view, at = memoryview(data), 0
    reader = zstandard.ZstdDecompressor()
    while at < len(view):
        if at + 8 > len(view):
            raise ValueError("bytes left over behind the last frame")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            content = bytes(view[at + 8 : at + 8 + size])
            if len(content) < size:
                raise ValueError("a skippable frame is cut off")
            if magic == DICTIONARY_FRAME and at == 0:
                if content[:4] == struct.pack("<I", ZSTD_FRAME):
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            at += 8 + size
        elif magic == ZSTD_FRAME:
            size = frame_length(view, at)
            yield reader.decompressobj().decompress(view[at : at + size])
            at += size
        else:
            raise ValueError(f"no frame starts at byte {at}")


def parse_record(record: bytes) -> dict:
    """Checked fields of one record; raises ValueError where something is wrong."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    first, _, lines = head.partition(b"\r\n")
    if not blank or first not in (b"WARC/1.0", VERSION):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header line {line!r} has no colon")
        fields[name.strip().lower()] = value.strip()
    if missing := [n for n in REQUIRED if n.lower() not in fields]:
        raise ValueError(f"{', '.join(missing)} missing")
    length = fields["content-length"]
    if not length.isascii() or not length.isdigit() or int(length) + 4 != len(rest) or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("Content-Length does not hold")
    block = rest[:-4]
    kind = fields["warc-type"]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != _sha1(block):
        raise ValueError("WARC-Block-Digest does not hold")
    http, gap, payload = block.partition(b"\r\n\r\n")
    told = [h.partition(b":")[2].strip() for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:")]
    if not gap or len(told) != 1 or not told[0].isdigit():
        raise ValueError("the block holds no HTTP response with a length")
    digest = fields.get("warc-payload-digest", "")
    if kind == "response":
        if len(payload) != int(told[0]) or digest != _sha1(payload):
            raise ValueError("the payload's length or digest does not hold")
    elif kind != "revisit" or payload or "warc-refers-to" not in fields:
        raise ValueError(f"{kind} is neither a response nor a complete revisit")
    return {
        "page_id": _page_id(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": int(told[0]),
        "payload_digest": digest.removeprefix("sha1:"),
        "record_type": kind,
        "refers_to": _page_id(fields["warc-refers-to"]) if kind == "revisit" else None,
        "error": None,
    }


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _page_id(uri: str) -> int | None:
    number = uri.strip("<>").removeprefix(ID_PREFIX)
    return int(number) if number.lstrip("-").isdigit() else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, with ``error`` where a record or archive is damaged."""
    names = [c.split()[0] for c in _RECORD.split(", ")]

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b["content"]:
                yield from _tables(_parsed(data), names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(records, _RECORD)


def _parsed(data: bytes) -> Iterator[dict]:
    try:
        for record in archive_records(data):
            try:
                yield parse_record(record)
            except ValueError as wrong:
                yield {"error": str(wrong)}
    except (ValueError, zstandard.ZstdError) as wrong:
        yield {"error": str(wrong)}


def _tables(rows: Iterator[dict], names: list[str], size: int = 512) -> Iterator[pd.DataFrame]:
    """Rows in tables of limited length."""
    part: list[dict] = []

    def made() -> pd.DataFrame:
        out = pd.DataFrame(part, columns=names)
        return out.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    for row in rows:
        part.append(row)
        if len(part) == size:
            yield made()
            part.clear()
    if part:
        yield made()


def archived(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write all pages to new archives in the shared folder and read those back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(plan_records(pages, id_col, url, payload), path, train_dictionary(pages, payload))
    return read_archives(pages.sparkSession, path)
