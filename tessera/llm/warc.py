"""WARC records in seekable Zstandard bundles.

A bundle is one binary value, a whole ``.warc.zst`` file in itself: frames that each
decompress alone, every frame holding a run of records, and at the end the seek table of
the Zstandard seekable format (a skippable frame with each frame's two sizes). Beside it
lies an index: record identifier, frame, offset in the decompressed frame, length.
Bundles are rows of a table, so Spark reads and writes them in any store, and a task
lost is a task run again.

Records of equal payload are written once: that with the largest id is the ``response``,
the others are ``revisit`` records that keep the HTTP header (and in it the length) and
name the response and the digest. Payloads are told apart by SHA-1 and length.

Defined cases: null payloads are empty ones. A null id counts as the smallest. Rows that
repeat id and payload are each written; those with the largest id are all responses.
Payloads shorter than ``least`` bytes are always responses. The column ``url``, where there
is one, is the target URI, with other bytes than printable ASCII percent-encoded; where it
is null, empty or missing, the record's own identifier is. Other columns aren't archived.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import lean, table, written

FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 8 << 20
PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "array<struct<record_id: string, frame: int, at: int, size: int>>"
BUNDLE = f"bundle binary, records {INDEX}"
RECORD = "record_id string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def digest32(payload) -> F.Column:
    """The SHA-1 of a binary column as bare upper-case base 32, without Python."""
    hexes = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexes, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uri(record_id: str | None) -> str:
    return f"<urn:record:{'' if record_id is None else record_id}>"


def record_bytes(record_id, record_type, refers_to, digest, payload: bytes, size: int, url: str | None, date: str) -> bytes:
    """One WARC/1.1 record of ``date`` (UTC, as in 2020-01-31T12:00:00Z): its block is an HTTP response, or only the header of one for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if record_type == "revisit" else http + payload
    head = [f"WARC/1.1\r\nWARC-Type: {record_type}", f"WARC-Record-ID: {_uri(record_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {quote(url, safe=PRINTABLE) if url else _uri(record_id)[1:-1]}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if record_type == "revisit":
        head += [f"WARC-Refers-To: {_uri(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(held: bytes) -> dict:
    """The fields of ``RECORD`` from a record's bytes; the digest is taken from the payload anew."""
    head, _, rest = held.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    bare = lambda x: x[len("<urn:record:") : -1] or None
    whole = fields["WARC-Type"] == "response"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if whole else fields["WARC-Payload-Digest"][len("sha1:") :]
    if whole and (len(payload) != size or f"sha1:{digest}" != fields["WARC-Payload-Digest"]):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {"record_id": bare(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "refers_to": bare(fields.get("WARC-Refers-To", _uri(None))), "payload_digest": digest, "payload_bytes": size, "payload": payload if whole else None}


def bundles_of(records: Iterator[tuple[str, bytes]], level: int = 3) -> Iterator[tuple[bytes, list[dict]]]:
    """Bundles of (identifier, record) pairs, each with its index; a record is never split."""
    packer, frames, sizes, index, open_frame, held = zstandard.ZstdCompressor(level=level), [], [], [], bytearray(), 0

    def close_frame():
        nonlocal open_frame
        if open_frame:
            frames.append(packer.compress(bytes(open_frame)))
            sizes.append((len(frames[-1]), len(open_frame)))
            open_frame = bytearray()

    def footer() -> bytes:
        entries = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
        return struct.pack("<II", SKIPPABLE, len(entries)) + entries

    for record_id, record in records:
        if open_frame and len(open_frame) + len(record) > FRAME_BYTES:
            close_frame()
        index.append({"record_id": record_id, "frame": len(frames), "at": len(open_frame), "size": len(record)})
        open_frame += record
        held += len(record)
        if held >= BUNDLE_BYTES:
            close_frame()
            yield b"".join([*frames, footer()]), index
            frames, sizes, index, held = [], [], [], 0
    close_frame()
    if frames:
        yield b"".join([*frames, footer()]), index


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """Of each frame of a bundle: where it begins, its compressed and its decompressed size."""
    n, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE or flags & 0x7C:
        raise ValueError("not a seekable Zstandard bundle")
    width = 12 if flags & 0x80 else 8
    at, out, begin = 0, [], len(bundle) - 9 - n * width
    for k in range(n):
        packed, size = struct.unpack_from("<II", bundle, begin + k * width)
        out.append((at, packed, size))
        at += packed
    return out


def records_in(bundle: bytes, wanted: list[dict]) -> Iterator[bytes]:
    """The wanted records (rows of the index); only their frames are decompressed, each once."""
    frames, unpacker, last, held = seek_table(bundle), zstandard.ZstdDecompressor(), None, b""
    for x in sorted(wanted, key=lambda x: (x["frame"], x["at"])):
        if x["frame"] != last:
            last = x["frame"]
            at, packed, size = frames[last]
            held = unpacker.decompress(bundle[at : at + packed], max_output_size=size)
        yield held[x["at"] : x["at"] + x["size"]]


def with_roles(rows: DataFrame, least: int = 0) -> DataFrame:
    """``rows`` (id, payload, and url if there is one) with digest, size, record_type and refers_to.

    Digests that occur more than once are counted first, with partial sums, and written;
    only they are joined to the payloads, so that Spark can split a crowded digest's rows.
    """
    url = F.col("url") if "url" in rows.columns else F.lit(None)
    known = rows.select("id", url.cast("string").alias("url"), F.coalesce("payload", F.lit(b"")).alias("payload")).withColumns({"payload_digest": digest32(F.col("payload")), "payload_bytes": F.octet_length("payload").cast("long")})
    key = ["payload_digest", "payload_bytes"]
    again = known.filter(F.col("payload_bytes") >= least).groupBy(*key).agg(F.max("id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = known.join(written(again, "warc-repeats").hint("shuffle_hash"), key, "left")
    is_revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return joined.select("id", "url", "payload", *key, F.when(is_revisit, "revisit").otherwise("response").alias("record_type"), F.when(is_revisit, F.col("first_id")).alias("refers_to"))


def write_bundles(rows: DataFrame, date: str | None = None) -> DataFrame:
    """Bundles (columns of ``BUNDLE``) of the rows that ``with_roles`` returns, all of one date: now, if none is given."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    wide = rows.select(F.col("id").cast("string").alias("id"), "record_type", F.col("refers_to").cast("string").alias("refers_to"), "payload_digest", "payload_bytes", F.when(F.col("record_type") == "response", F.col("payload")).alias("payload"), "url")

    def records(batches):
        for batch in batches:
            for row in zip(*(batch.column(k) for k in range(7))):
                i, kind, refers, digest, size, payload, url = (x.as_py() for x in row)
                yield i, record_bytes(i, kind, refers, digest, payload or b"", size, url, date)

    def pack(batches):
        for bundle, index in bundles_of(records(batches)):
            yield pa.RecordBatch.from_pydict({"bundle": [bundle], "records": [index]}, pa.schema([("bundle", pa.binary()), ("records", pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("at", pa.int32()), ("size", pa.int32())])))]))

    return wide.mapInArrow(lean(pack), BUNDLE)


def read_records(bundles: DataFrame, payloads: bool = True) -> DataFrame:
    """The records (columns of ``RECORD``) that the index column of ``bundles`` lists.

    Filter the index first (``F.filter``) to read some records: only their frames are
    decompressed. Without ``payloads`` the payload column is null.
    """

    def unpack(batches):
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for bundle, index in zip(batch.column(0), batch.column(1)):
                found = [parse_record(x) for x in records_in(bundle.as_py(), index.as_py())]
                for x in found if not payloads else ():
                    x["payload"] = None
                yield pa.RecordBatch.from_pylist(found, schema)

    return bundles.select("bundle", "records").mapInArrow(lean(unpack), RECORD)


def lookup(bundles: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records whose identifier is in the column ``record_id`` of ``record_ids``.

    The index, not the bundles, is joined to the identifiers; then the bundles that hold
    a match are read, and of these the frames that hold one.
    """
    numbered = bundles.withColumn("bundle_id", F.xxhash64("bundle"))
    entries = numbered.select("bundle_id", F.explode("records").alias("r"))
    found = entries.join(record_ids.select("record_id").distinct(), F.col("r.record_id").eqNullSafe(F.col("record_id")), "left_semi")
    wanted = found.groupBy("bundle_id").agg(F.collect_list("r").alias("records"))
    return read_records(numbered.drop("records").join(wanted, "bundle_id"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archives = written(write_bundles(with_roles(pages.select(F.col("page_id").alias("id"), "url", F.encode("html", "UTF-8").alias("payload")))), "warc")
    return read_records(archives, payloads=False).select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))

