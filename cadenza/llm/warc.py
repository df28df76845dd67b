"""WARC archives in seekable Zstandard bundles (operator 10).

Records are grouped into frames of about FRAME bytes, each an independent
Zstandard frame; a skippable frame at the end of a bundle is its seek table.
The index maps every record to its bundle, frame and offset within the frame,
so one record costs the footer and one frame to read.  Any Zstandard reader can
unpack a bundle from front to back.

Tasks write their bundles under names of their own attempt, and the index names
only bundles of attempts that Spark took: a task that is run again leaves an
unused file, never a wrong record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, ensure_checkpoint_dir

FRAME = 256 << 10
BUNDLE = 256 << 20
#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
# Fixed values of the Zstandard seekable format and of WARC 1.1.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder or file that every executor reaches."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if re.match(r"[a-z][a-z0-9+.-]*:", uri) else (fs.LocalFileSystem(), uri)


def record_id(page_id) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    name = uri.strip("<>").rpartition(":")[2]
    return None if name == "null" else int(name)


def make_record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record; a revisit keeps the HTTP header, which states the payload's length, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf8", "replace")) for c in url or "about:blank")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    end = stop + 4 + int(head["Content-Length"])
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end where it says")
    return head, data[stop + 4:end], end + 4


def read_page(data: bytes, at: int) -> dict:
    """Page fields of the record at ``at``; a response's payload is checked against its digest."""
    head, block, _ = parse_record(data, at)
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = head["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {head['WARC-Record-ID']} is damaged")
    return {"page_id": page_of(head["WARC-Record-ID"]), "url": head["WARC-Target-URI"], "payload_bytes": length, "payload_digest": digest,
            "record_type": head["WARC-Type"], "refers_to": page_of(head["WARC-Refers-To"]) if revisit else None,
            "payload": None if revisit else payload}


class BundleWriter:
    """A seekable bundle; ``add`` returns the record's (frame, offset in the frame)."""

    def __init__(self, out, frame: int = FRAME):
        self.out, self.size, self.pack = out, frame, zstandard.ZstdCompressor(level=3)
        self.held, self.table, self.at, self.written = [], [], 0, 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self.at and self.at + len(record) > self.size:
            self._close_frame()
        place = len(self.table), self.at
        self.held.append(record)
        self.at += len(record)
        return place

    def _close_frame(self) -> None:
        packed = self.pack.compress(b"".join(self.held))
        self.out.write(packed)
        self.table.append((len(packed), self.at))
        self.written += len(packed)
        self.held, self.at = [], 0

    def close(self) -> None:
        if self.held:
            self._close_frame()
        entries = b"".join(struct.pack("<II", *x) for x in self.table)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(self.table), 0, SEEKABLE))
        self.out.close()


class BundleReader:
    def __init__(self, path: str):
        fs, name = filesystem(path)
        self.file = fs.open_input_file(name)
        end = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        width = 12 if flags & 0x80 else 8                   # with or without checksums
        raw = self.file.read_at(frames * width, end - 9 - frames * width)
        sizes = np.frombuffer(raw, "<u4").reshape(frames, width // 4)[:, :2].astype(np.int64)
        self.starts, self.sizes = np.cumsum(sizes[:, 0]) - sizes[:, 0], sizes

    def frame(self, number: int) -> bytes:
        raw = self.file.read_at(int(self.sizes[number, 0]), int(self.starts[number]))
        return zstandard.ZstdDecompressor().decompress(raw, max_output_size=int(self.sizes[number, 1]))


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record for every row into bundles in ``folder`` and return the index, written to the shared folder.

    Index: one row per frame (bundle string, frame int, page_ids array<long>,
    offsets array<long> within the frame).  Of rows with equal payloads of at
    least REVISIT_BYTES, the one with the largest id is a response and the others
    revisit it; rows that repeat that id are responses too, and so are all if no
    id is known.  A null payload is an empty one, a null url is about:blank.
    ``folder`` is a URI (or shared path) that pyarrow opens on every executor.
    """
    body = F.coalesce(F.col(f"`{html_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), body.alias("payload"),
                        F.sha1(body).alias("digest"))
    large = F.octet_length("payload") >= REVISIT_BYTES
    keepers = rows.filter(large).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")) \
        .filter("n > 1 and keeper is not null").select(F.col("digest").alias("same"), "keeper")
    keepers = cut_lineage(keepers, "warc-keepers")
    revisit = F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id"))
    records = rows.join(keepers, F.col("digest") == F.col("same"), "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("keeper")).alias("refers_to"), revisit.alias("revisit"))
    schema = pa.schema([("bundle", pa.string()), ("frame", pa.int32()), ("page_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64()))])

    def write(batches):
        fs, base = filesystem(folder)
        writer, name, frames = None, None, {}

        def finish():
            writer.close()
            return pa.RecordBatch.from_pydict({"bundle": [name] * len(frames), "frame": list(frames),
                                               "page_ids": [x[0] for x in frames.values()], "offsets": [x[1] for x in frames.values()]}, schema=schema)
        for batch in batches:
            for values in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit"))):
                page, url, payload, digest, refers, again = (v.as_py() for v in values)
                if writer is None:
                    file = f"bundle-{uuid.uuid4().hex}.warc.zst"
                    fs.create_dir(base, recursive=True)
                    name, frames = f"{folder.rstrip('/')}/{file}", {}
                    writer = BundleWriter(fs.open_output_stream(f"{base.rstrip('/')}/{file}", compression=None))
                frame, offset = writer.add(make_record(page, url, payload, digest, refers, again))
                ids, offsets = frames.setdefault(frame, ([], []))
                ids.append(page)
                offsets.append(offset)
                if writer.written >= BUNDLE:
                    yield finish()
                    writer = None
        if writer is not None:
            yield finish()

    return cut_lineage(records.mapInArrow(write, "bundle string, frame int, page_ids array<long>, offsets array<long>"), "warc-index")


def locations(index: DataFrame) -> DataFrame:
    """(page_id, bundle, frame, offset): where each record lies."""
    return index.select("bundle", "frame", F.explode(F.arrays_zip("page_ids", "offsets")).alias("x")) \
        .select("x.page_ids", "bundle", "frame", "x.offsets").toDF("page_id", "bundle", "frame", "offset")


def read_archive(index: DataFrame, payload: bool = True) -> DataFrame:
    """Records of the frames in ``index`` (bundle, frame, offsets), read back from the bundles.

    Returns (page_id long, url string, payload_bytes long, payload_digest string, record_type string,
    refers_to long[, payload binary, null for revisits]).
    """
    kind = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64())] + ([("payload", pa.binary())] if payload else [])

    def read(batches):
        bundle, reader = None, None
        for batch in batches:
            for name, frame, offsets in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offsets"))):
                if name != bundle:
                    bundle, reader = name, BundleReader(name)
                data = reader.frame(frame)
                rows = [read_page(data, at) for at in offsets]
                yield pa.RecordBatch.from_pylist([{k: r[k] for k, _ in fields} for r in rows], schema=pa.schema(fields))

    return index.select("bundle", "frame", "offsets").mapInArrow(read, kind + ", payload binary" * payload)


def archive_folder(spark) -> str:
    """A new folder for bundles in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex[:12]}"
