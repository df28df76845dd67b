"""Substring dedup by counting windows over shared anchors (operator 9).

Words of every window of ``window`` words that occurs twice or more are duplicate
spans.  No greedy factors are parsed: every window over a shared anchor is counted,
so a span that is copied from two references in turn is found whole.

The index is spread over key buckets, not held in one place:

* Each window of ``window`` words has one *anchor*: the smallest hash among its
  ``anchor``-word runs.  Equal windows have equal anchors, and neighbouring
  windows mostly share one, so a block indexes about one anchor for every dozen
  words.  Blocks learn which of their anchors any block (themselves included)
  holds at a second place.
* Only windows over such an anchor can be repeated.  Their own 64-bit hashes
  are then counted over all blocks, which decides each of them exactly.

A passage that a third of all documents hold is one entry per block and key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut_lineage
from . import blocks as B
from .text import Words, gram_hashes, inside

_NONE = np.uint64(2**64 - 1)


def sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (np.minimum / np.maximum) over every run of ``width`` values."""
    if len(a) < width:
        return a[:0]
    out, size = a, 1
    while size * 2 <= width:
        out = op(out[:-size], out[size:])
        size *= 2
    last = len(a) - width + 1
    return op(out[:last], out[width - size:width - size + last])


class _Parse:
    """Anchors and windows of one block's texts."""

    def __init__(self, table: pa.Table, window: int, anchor: int):
        self.words = Words(table.column("text"))
        self.window, self.width = window, window - anchor + 1
        self.hashes = self.words.hashes()
        self.grams = np.where(inside(self.words.ptr, anchor), gram_hashes(self.hashes, anchor), _NONE)
        self.valid = inside(self.words.ptr, window)
        self.least = sliding(self.grams, self.width, np.minimum)
        pad = np.zeros(self.width - 1, np.uint64)
        top = sliding(np.concatenate([pad, np.where(self.valid, self.least, 0).astype(np.uint64), pad]), self.width, np.maximum) \
            if len(self.least) else self.grams[:0]
        # a run of words is an anchor when some window that covers it has no smaller one
        self.at = np.flatnonzero((top == self.grams[:len(top)]) & (top > 0))
        self.keys, counts = np.unique(self.grams[self.at], return_counts=True)
        self.counts = counts.astype(np.uint32)

    def candidates(self, anchor_counts: np.ndarray) -> np.ndarray:
        """Starts of the windows whose anchor occurs at two places or more."""
        shared = self.at[anchor_counts[np.searchsorted(self.keys, self.grams[self.at])] >= 2]
        grams = np.full(len(self.grams), _NONE)
        grams[shared] = self.grams[shared]
        return np.flatnonzero(self.valid & (sliding(grams, self.width, np.minimum) == self.least) & (self.least != _NONE))

    def window_keys(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted distinct hashes, counts, hash of each start)."""
        h = gram_hashes(self.hashes, self.window)[starts] if len(starts) else np.zeros(0, np.uint64)
        keys, counts = np.unique(h, return_counts=True)
        return keys, counts.astype(np.uint32), h

    def covered(self, starts: np.ndarray) -> np.ndarray:
        """Words that lie in a window of ``starts``."""
        edge = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + self.window, -1)
        return np.cumsum(edge[:-1]) > 0


def remove_repeats(df: DataFrame, text_col: str = "text", carry: list[str] | None = None,
                   window: int = 35, anchor: int = 12, keep_spacing: bool = False) -> DataFrame:
    """Find and cut the words of every repeated window of ``window`` words.

    A word goes if a window that covers it has the same word sequence as a
    window that starts anywhere else, in the same text too.  Every occurrence
    goes; windows are judged on the input.

    Returns (row struct of the ``carry`` columns, n_words long, n_removed long,
    spans array<struct<start, end>> of removed words, kept_text string: the kept
    words joined by one space; with ``keep_spacing`` the text as it was between
    cuts, one space at each cut, and as it was where nothing is cut).  One row per input row: repeated rows repeat
    each other's windows.  A null or empty text has no words; texts shorter than
    a window lose none.  Columns that are not carried are not read, and carried
    ones may have any name.
    """
    if not 1 <= anchor <= window:
        raise ValueError("anchor must be 1 to window words")
    carry = [c for c in df.columns if c != text_col] if carry is None else carry
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row") if carry else F.struct(F.lit(0).alias("_")).alias("row"),
                     F.col(f"`{text_col}`").alias("text"))
    blocks = B.pack_blocks(held, tag="substring-blocks")
    bits = B.bucket_bits(blocks, 0.2)

    def anchors(block, table):
        p = _Parse(table, window, anchor)
        yield B.key_slices(block, p.keys, p.counts, bits)

    def windows(block, table, replies):
        p = _Parse(table, window, anchor)
        keys, counts, _ = p.window_keys(p.candidates(B.join_reply(replies, "uint8")))
        return pa.Table.from_batches([B.key_slices(block, keys, counts, bits)])

    def spans(block, table, replies):
        kinds = np.asarray(replies.column("kind"))
        p = _Parse(table, window, anchor)
        starts = p.candidates(B.join_reply(replies.filter(pa.array(kinds == 0)), "uint8"))
        keys, _, h = p.window_keys(starts)
        counts = B.join_reply(replies.filter(pa.array(kinds == 1)), "uint8")
        gone = p.covered(starts[counts[np.searchsorted(keys, h)] >= 2])
        ptr, kept, removed, found = p.words.ptr, [], [], []
        for d in range(table.num_rows):
            out = gone[ptr[d]:ptr[d + 1]]
            words = p.words.text(d)
            if keep_spacing:
                kept.append(p.words.slices(d, out))
            if out.any():
                edge = np.diff(np.concatenate([[0], out.view(np.int8), [0]]))
                found.append([{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))])
                words = [words[i] for i in np.flatnonzero(~out)]
            else:
                found.append([])
            removed.append(int(out.sum()))
            if not keep_spacing:
                kept.append(b" ".join(words))
        return pa.table({
            "row": table.column("row"), "n_words": pa.array(np.diff(ptr), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "spans": pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    seen = cut_lineage(B.count_exchange(B.over_blocks(blocks, anchors, B.KEYS_SCHEMA)), "substring-anchors")
    repeated = B.count_exchange(B.with_replies(blocks, seen, windows, B.KEYS_SCHEMA))
    replies = seen.withColumn("kind", F.lit(0)).unionByName(repeated.withColumn("kind", F.lit(1)))
    schema = T.StructType([T.StructField("row", held.schema["row"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()),
                           T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                           T.StructField("kept_text", T.StringType())])
    return B.with_replies(blocks, replies, spans, schema)
