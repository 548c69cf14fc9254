"""WARC archives: a writer with revisit records, and a splittable reader.

Writer: one gzip member per record. Of records with equal payloads the one with
the largest page_id is a response; the others are revisits that refer to it and
hold no payload. Payloads under ``min_revisit`` bytes are always responses.

Reader: archives are dealt out as byte ranges. A task looks for gzip magic from
the start of its range, proves a candidate by decoding its header, and owns the
records that start inside the range, reading past its end to finish the last.

Defined cases: a null payload is empty; a null URL gives an empty target; a
record longer than a range is read by the range it starts in; an archive with
no record gives no rows; repeated page_ids with equal payloads are all
responses, since none has a smaller id; bytes that look like gzip inside a
payload are passed over by the header check; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.common import open_file, output_folder, put_file, stage

# Fixed values of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"

ROLL_BYTES = 32_000_000
RANGE_BYTES = 8_000_000
_READ = 1 << 18
_LEVEL = 1


def record_name(page_id: int) -> str:
    return f"<urn:x-page:{page_id}>"


def encode_record(page_id, url, html, digest, n_bytes, refers_to, refers_to_url, date) -> bytes:
    """One WARC record as a gzip member of its own."""
    payload = b"" if refers_to is not None else html.encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}"
    block = head.encode() + _END + payload
    label = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_name(page_id)}",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + re.sub(r"[\r\n]", "", url or ""),
        f"WARC-Payload-Digest: sha1:{label}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To: {record_name(refers_to)}",
            "WARC-Refers-To-Target-URI: " + re.sub(r"[\r\n]", "", refers_to_url or ""),
        ]
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + _END + block + _END) + packer.flush()


def write_archives(
    pages: DataFrame,
    *,
    min_revisit: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write all pages (``page_id, url, html``); return ``path, n_bytes, n_records``."""
    spark = pages.sparkSession
    folder, work = output_folder(spark, "warc"), stage(spark, "warc")
    html = F.coalesce(F.col("html"), F.lit(""))
    full = pages.select("page_id", "url", html.alias("html")).withColumns(
        {"digest": F.sha1("html"), "n_bytes": F.octet_length("html").cast("long")}
    )
    # SHA-1 names the payload in the archive; SHA-256 decides what is equal.
    known = full.withColumn("same", F.sha2("html", 256))
    large = known.filter(F.col("n_bytes") >= min_revisit)
    repeated = (
        large.groupBy("same")
        .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("first"))
        .filter("n > 1")
        .select("same", F.col("first.page_id").alias("to"), F.col("first.url").alias("to_url"))
    )
    repeated = work.cut(repeated, "repeated")
    revisit = (F.col("n_bytes") >= min_revisit) & (F.col("page_id") < F.col("to"))
    planned = known.join(repeated, "same", "left").select(
        "page_id",
        "url",
        F.when(revisit, F.lit("")).otherwise(F.col("html")).alias("html"),
        "digest",
        "n_bytes",
        F.when(revisit, F.col("to")).cast("string").alias("to"),
        F.when(revisit, F.col("to_url")).alias("to_url"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size, n = [], 0, 0
        for batch in batches:
            for row in batch.itertuples(index=False, name=None):
                data = encode_record(*row, date)
                parts.append(data)
                size, n = size + len(data), n + 1
                if size >= ROLL_BYTES:
                    yield _saved(folder, parts, size, n)
                    parts, size, n = [], 0, 0
        if parts:
            yield _saved(folder, parts, size, n)

    archives = planned.mapInPandas(write, "path string, n_bytes long, n_records long")
    return work.cut(archives, "archives")


def _saved(folder: str, parts: list[bytes], size: int, n: int) -> pd.DataFrame:
    path = put_file(folder, "part.warc.gz", b"".join(parts))
    return pd.DataFrame({"path": [path], "n_bytes": [size], "n_records": [n]})


class _Window:
    """Bytes of a file from a moving position on, read in pieces."""

    def __init__(self, file, start: int):
        self.file, self.at, self.data = file, start, b""
        file.seek(start)

    def more(self) -> bool:
        piece = self.file.read(_READ)
        self.data += piece
        return bool(piece)

    def drop(self, n: int) -> None:
        self.data, self.at = self.data[n:], self.at + n


def _member(window: _Window) -> bytes | None:
    """The decoded member at the window's start, which then moves past it; None if
    there is none. It counts only if it is a WARC record and ends with a right
    checksum."""
    unpack, out, given = zlib.decompressobj(31), [], 0
    try:
        while not unpack.eof:
            if given == len(window.data) and not window.more():
                return None
            out.append(unpack.decompress(window.data[given:]))
            given = len(window.data)
            if out[0] and not b"".join(out[:2])[:5] == b"WARC/"[: len(b"".join(out[:2])[:5])]:
                return None
    except zlib.error:
        return None
    data = b"".join(out)
    if not data.startswith(b"WARC/"):
        return None
    window.drop(len(window.data) - len(unpack.unused_data))
    return data


def records_in_range(file, start: int, end: int) -> Iterator[bytes]:
    """Decoded records whose first byte lies in ``[start, end)``."""
    window = _Window(file, start)
    while window.at < end:
        found = window.data.find(_MAGIC)
        if found < 0:
            window.drop(max(0, len(window.data) - len(_MAGIC) + 1))
            if not window.more():
                return
            continue
        window.drop(found)
        if window.at >= end:
            return
        data = _member(window)
        if data is None:
            window.drop(1)
        else:
            yield data


def parse_record(data: bytes) -> dict:
    head, _, rest = data.partition(_END)
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[: int(fields.get("content-length", len(rest)))]
    http, _, payload = block.partition(_END)
    length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    return {
        "record_id": fields.get("warc-record-id", ""),
        "record_type": fields.get("warc-type", ""),
        "target_uri": fields.get("warc-target-uri", ""),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": fields.get("warc-payload-digest", ""),
        "full_bytes": int(length[1]) if length else len(payload),
        "payload": payload,
    }


_RECORD = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, full_bytes long, payload binary"
)


def read_archives(archives: DataFrame, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the archives listed as ``path, n_bytes``."""
    spark = archives.sparkSession
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(range_bytes)))
    ranges = archives.filter("n_bytes > 0").select("path", starts.alias("start"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"]):
                with open_file(path) as file:
                    rows, size = [], 0
                    for data in records_in_range(file, start, start + range_bytes):
                        rows.append(parse_record(data))
                        size += len(data)
                        if size > 4_000_000:
                            yield pd.DataFrame(rows)
                            rows, size = [], 0
                    if rows:
                        yield pd.DataFrame(rows)

    return ranges.repartition(n).mapInPandas(read, _RECORD)


def page_digest(records: DataFrame) -> DataFrame:
    """The page's columns from records that ``write_archives`` wrote."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            digest = [
                base64.b32decode(d.partition(":")[2]).hex() for d in pdf["payload_digest"]
            ]
            yield pdf[["record_id", "full_bytes", "record_type", "refers_to"]].assign(digest=digest)

    schema = "record_id string, full_bytes long, record_type string, refers_to string, digest string"
    narrow = records.drop("payload", "target_uri").mapInPandas(decode, schema)
    page = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1).cast("long")
    return narrow.select(
        page("record_id").alias("page_id"),
        F.col("full_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.when(F.col("refers_to").isNotNull(), page("refers_to")).alias("refers_to"),
    )
