"""Blocks of documents, and an exchange of counts between blocks and key buckets.

Several operators need, for each key of each document (a word, a shingle, an
anchor), how often the key occurs in the whole corpus.  One shuffled row per
occurrence would be larger than the corpus.  Instead

1. ``pack_blocks`` writes the documents once as rows of a few megabytes (a
   compressed Arrow stream), so that every later pass meets the same blocks;
2. a block sends each of its distinct keys once, with a local count, to the
   bucket named by the key's high bits (``key_slices``).  A key that holds a
   third of all rows is one entry per block: it is summed before the shuffle;
3. ``count_exchange`` adds up each bucket and answers every block in the order
   of the keys it sent;
4. ``with_replies`` meets blocks and answers by block number.

Buckets are sized from the bytes of the corpus, so a task holds a few
megabytes of keys at every scale.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage

BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20
KEYS_SCHEMA = "bucket long, block long, keys binary, counts binary"
#: total and present (keys with a count) stand in one row of each bucket, zeros in the others.
REPLY_SCHEMA = "block long, bucket long, counts binary, total long, present long"


#: Documents of one Arrow batch between the JVM and a task, in rows and bytes.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def bound_batches(spark) -> None:
    """Bound the Arrow batches of this session: rows here are whole documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def to_stream(table: pa.Table, level: int = 1) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", level))) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def from_stream(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(data) as r:
        return r.read_all()


def _sizes(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of each row, fixed columns counted as 16."""
    total = np.full(batch.num_rows, 16, np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
            total += np.asarray(pc.binary_length(c).fill_null(0), dtype=np.int64)
    return total


def slices(batch: pa.RecordBatch, size: int):
    """Runs of the rows of ``batch`` of about ``size`` bytes; a longer row alone."""
    ends, at, base = np.cumsum(_sizes(batch)), 0, 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
        yield batch.slice(at, stop - at)
        at, base = stop, int(ends[stop - 1])


def pack_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, tag: str = "blocks", level: int = 1) -> DataFrame:
    """Write ``docs`` as rows (block, n_rows, n_bytes, payload) into the shared folder and read them back.

    ``block`` numbers are unique and fixed by the write.  A block closes once it
    holds ``block_bytes``; a single longer row makes a block of its own.  ``level``
    is that of their compression.
    """
    def pack(batches):
        held, size = [], 0

        def flush():
            table = pa.Table.from_batches(held)
            return pa.RecordBatch.from_pydict({"n_rows": [table.num_rows], "n_bytes": [size], "payload": [to_stream(table, level)]},
                                              schema=pa.schema([("n_rows", pa.int64()), ("n_bytes", pa.int64()), ("payload", pa.binary())]))
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = np.cumsum(_sizes(batch))
            at, base = 0, 0
            while at < batch.num_rows:
                room = block_bytes - size
                stop = max(at + (0 if held else 1), int(np.searchsorted(ends, base + room, "right")))
                stop = min(stop, batch.num_rows)
                if stop > at:
                    held.append(batch.slice(at, stop - at))
                    size += int(ends[stop - 1]) - base
                    base, at = int(ends[stop - 1]), stop
                if at < batch.num_rows or size >= block_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    bound_batches(docs.sparkSession)
    rows = docs.mapInArrow(pack, "n_rows long, n_bytes long, payload binary")
    return cut_lineage(rows.withColumn("block", F.monotonically_increasing_id()), tag)


def bucket_bits(blocks: DataFrame, bytes_per_byte: float) -> int:
    """High key bits that name a bucket: ``bytes_per_byte`` is the key bytes sent per byte of text."""
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    want = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), total * bytes_per_byte / BUCKET_BYTES, 2)
    return int(np.ceil(np.log2(want)))


def key_slices(block: int, keys: np.ndarray, counts: np.ndarray, bits: int, wide: bool = True, encode=np.ndarray.tobytes):
    """Rows of KEYS_SCHEMA for the sorted distinct ``keys`` of a block; ``encode`` makes bytes of the counts.

    ``wide`` sends all 64 bits, else the 32 below the bucket's: keys that agree
    in those are then counted together (a bucket holds about 2 million keys, so
    one in some two thousand meets another).
    """
    cuts = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    cuts = np.append(cuts, len(keys))
    sent = keys if wide else ((keys << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    full = np.flatnonzero(np.diff(cuts))
    return pa.RecordBatch.from_arrays([
        pa.array(full, pa.int64()), pa.array(np.full(len(full), block), pa.int64()),
        pa.array([sent[cuts[b]:cuts[b + 1]].tobytes() for b in full], pa.binary()),
        pa.array([encode(counts[cuts[b]:cuts[b + 1]]) for b in full], pa.binary()),
    ], names=["bucket", "block", "keys", "counts"])


def count_exchange(keys: DataFrame, wide: bool = True, reply: str = "uint8", count: str = "uint32", encode=np.ndarray.tobytes, decode=None) -> DataFrame:
    """Sum the counts of equal keys over all blocks; answer each block in the order it sent.

    ``reply`` is the type of the answer, ``uint8`` clips at 255; ``encode`` makes bytes of the numbers, ``decode`` numbers of
    the bytes that were sent (else they are of type ``count``).
    """
    decode = decode or (lambda data: np.frombuffer(data, count))

    def merge(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(x.as_py(), np.uint64 if wide else np.uint32) for x in table.column("keys")]
        local = np.concatenate([decode(x.as_py()) for x in table.column("counts")])
        every = np.concatenate(sent)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        first = np.ones(len(ranked), bool)
        first[1:] = ranked[1:] != ranked[:-1]
        totals = np.add.reduceat(local[order].astype(np.int64), np.flatnonzero(first))
        rest = [0] * (len(sent) - 1)
        out = np.empty(len(ranked), np.int64)
        out[order] = totals[np.cumsum(first) - 1]
        out = np.minimum(out, np.iinfo(reply).max).astype(reply)
        ends = np.cumsum([len(x) for x in sent])
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "counts": pa.array([encode(out[e - len(x):e]) for x, e in zip(sent, ends)], pa.binary()),
                         "total": pa.array([int(totals.sum()), *rest], pa.int64()),
                         "present": pa.array([int((totals > 0).sum()), *rest], pa.int64())})

    return keys.groupBy("bucket").applyInArrow(merge, REPLY_SCHEMA)


def join_reply(replies: pa.Table, dtype: str, decode=None) -> np.ndarray:
    """One block's answers, in the order of its sorted keys."""
    order = np.argsort(np.asarray(replies.column("bucket")))
    parts = replies.column("counts").to_pylist()
    decode = decode or (lambda data: np.frombuffer(data, dtype))
    return np.concatenate([decode(parts[i]) for i in order]) if parts else np.zeros(0, dtype)


def with_replies(blocks: DataFrame, replies: DataFrame, fn, schema) -> DataFrame:
    """``fn(block, table, replies)`` for every block -> Arrow table of ``schema``."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.concat_tables([fn(b, from_stream(p), right) for b, p in
                                 zip(left.column("block").to_pylist(), left.column("payload").to_pylist())])

    return blocks.select("block", "payload").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def over_blocks(blocks: DataFrame, fn, schema) -> DataFrame:
    """``fn(block, table)`` -> iterator of Arrow batches, for every block, without a shuffle."""
    def run(batches):
        for batch in batches:
            for b, p in zip(batch.column("block"), batch.column("payload")):
                yield from fn(b.as_py(), from_stream(p.as_py()))

    return blocks.select("block", "payload").mapInArrow(run, schema)
