"""Language-model scoring by online logistic context mixing (operator 4).

A text is coded as its lower-cased words, each followed by a space, and one
end byte.  Every byte is coded as eight binary decisions.  For each decision
several predictors, one per context length, look up a pair of counts under the
last bytes and the bits of this byte so far.  Their
probabilities, stretched to the logistic domain, are added with weights that a
gate selects (the bit's place and how much the two longest contexts have seen),
and the sum is squashed to a probability.  An adaptive map then refines that
probability by what followed it before, under the bits so far.

The counts are those of all training texts, kept exactly, and they grow with the
corpus.  A block writes its distinct types once: a type is a byte with the longest
context, nearest byte first (``turned``), so the types of a context of any length are
neighbours.  Ranges of them are the buckets (``bounds``).  A bucket adds up the types
of all blocks, counts every order's contexts and gives each block the logarithm of
each type's probability (``rate_types``).  Only shorter contexts that a bound cuts
lie in several buckets: their pairs are added up before (``shared_pairs``), at most
five contexts a bound.  So a type crosses the network once, not once for each order,
and is evaluated once for the corpus.

Weights and refining map are learned online: a chunk is predicted with what the
chunks before it left in a task's own hashed tables, the gated weights move by its
errors, the refining map counts its outcomes, and only then do the tables learn it.
Tables that are half full start anew.  Tasks train side by side; outcomes are added
and weights averaged by their evidence, which gives a broadcast of ``size_bound`` bytes.

Equal (context, byte) pairs of a chunk are evaluated once.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut_lineage
from . import blocks as B
from .text import Words, mix, utf8_buffer

#: Context lengths in bytes; WORD is the word so far, up to the longest length.  Slots of a task's tables are named by so many high hash bits.
WORD = 0
ORDERS = (2, 3, 4, WORD, 6)
SLOT_BITS = (20, 22, 22, 22, 22)
LONGEST = 6
PIECE = 1 << 16
SPACE, END = 0x20, 0x0A
#: Gate: the decision's depth (up to DEPTHS - 1), and the evidence of the last two contexts in LEVELS steps.
DEPTHS, LEVELS = 12, 6
GATES = DEPTHS * LEVELS * LEVELS
CELLS = 33
SHARPEST = 12.0
#: Bytes of a chunk: as many as were learned before, within these.
CHUNK_BYTES = (64 << 10, 4 << 20)
#: Types that are predicted together before their errors and counts are learned.
STEP = 1 << 14
#: Types (whole steps) whose pairs are found together: what the tables say of them takes some 25 MB.
SECTION = 16 * STEP
PRIOR = 0.1
#: Blocks are larger than elsewhere: a longer text repeats more of its types, so fewer are sent.
LM_BLOCK = 2 * B.BLOCK_BYTES
#: Types of a bucket, as sent by all blocks, and evenly spaced contexts of a block that the bounds are taken from.
BUCKET_TYPES, MARKS = 1 << 19, 64
#: Hash bits of the table that finds equal keys, and bytes of text that are turned to keys at once.
FIRST_BITS, SLICE_BYTES = 21, 1 << 20
#: Parts of one in which logarithms are sent: as fine as float32 holds the largest of them.
LOG_UNIT = 1 << 20
_LEVEL = np.array([min(int(n).bit_length(), LEVELS - 1) for n in range(64)], np.uint8)


def size_bound() -> int:
    """Bytes of the broadcast weights and refining map; the counts stay in their buckets."""
    return GATES * (len(ORDERS) + 1) * 8 + 256 * CELLS * 16


@dataclass
class Code:
    """Huffman code of the bytes: length, for each depth the tree node and the bit, place among the leaves, bytes by place."""
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    rank: np.ndarray
    leaf: np.ndarray


def huffman(counts: np.ndarray) -> Code:
    """Code of all 256 bytes from their counts (a byte never seen counts a little, so that it can be coded)."""
    heap = [((int(n) << 10) + 1, i, (i,)) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    paths: list[list[tuple[int, int]]] = [[] for _ in range(256)]
    number = 0
    while len(heap) > 1:
        (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
        for v, side in ((0, left), (1, right)):
            for byte in side:
                paths[byte].append((number, v))
        heapq.heappush(heap, (a + b, 256 + number, left + right))
        number += 1
    length = np.array([len(x) for x in paths])
    node, bit = np.zeros((256, length.max()), np.int64), np.zeros((256, length.max()), np.int64)
    for byte, path in enumerate(paths):
        for depth, (n, v) in enumerate(reversed(path)):
            node[byte, depth], bit[byte, depth] = n, v
    leaf = np.array(sorted(range(256), key=lambda b: [v for _, v in reversed(paths[b])]))
    return Code(length, node, bit, np.argsort(leaf), leaf)


#: Lower case, and a space for every byte that parts words; what follows a text's bytes.
_PLAIN = bytes(SPACE if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_CLOSE = bytes([SPACE, END])


def stream(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the coded texts: LONGEST end bytes to start from, every word and a space, the end byte.

    ``offsets`` are where each text's own bytes begin and, last, where the next would.
    """
    data, cuts = utf8_buffer(column)
    raw, start = memoryview(data.tobytes().translate(_PLAIN)), bytes([END]) * LONGEST
    parts = [p for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()) for p in (start, raw[a:b], _CLOSE)]
    loose = np.frombuffer(b"".join(parts or [start]), np.uint8)
    blank = loose == SPACE
    kept = ~blank                                    # of blanks those after a word
    kept[1:] |= blank[1:] & ~blank[:-1] & (loose[:-1] != END)
    ends = np.cumsum(np.diff(cuts) + LONGEST + len(_CLOSE))
    count = np.add.reduceat(kept, np.concatenate([[0], ends[:-1]]), dtype=np.int64) if len(ends) else ends
    return np.concatenate([loose[kept], np.zeros(8, np.uint8)]), np.concatenate([[0], np.cumsum(count)]) + LONGEST


def type_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(for each coded byte, it and the LONGEST bytes before it, packed; where each text's keys begin)."""
    begins, ends = offsets[:-1], offsets[1:] - LONGEST
    places = np.concatenate([[0], np.cumsum(ends - begins)])
    if not places[-1]:
        return np.zeros(0, np.uint64), places
    eight = np.ndarray(len(data) - 7, ">u8", data, strides=(1,))             # of the bytes that begin at each place
    keys = np.empty(places[-1], np.uint64)
    for a, b, at in zip(begins.tolist(), ends.tolist(), places.tolist()):
        keys[at:at + b - a] = eight[a - LONGEST:b - LONGEST]
    keys >>= np.uint64(8 * (7 - LONGEST))
    return keys, places


def _stretch(p):
    return np.log(p / (1 - p))


def _squash(x):
    return 1 / (1 + np.exp(-x))


def _word_bytes(before: np.ndarray) -> np.ndarray:
    """How many of the bytes before a place belong to its word so far."""
    size = np.zeros(len(before), np.uint8)
    open_ = np.ones(len(before), bool)
    for back in range(LONGEST):
        byte = (before >> np.uint64(8 * back)).astype(np.uint8)
        open_ &= (byte != SPACE) & (byte != END)
        size += open_
    return size


def _context_id(types: np.ndarray, i: int) -> np.ndarray:
    """Context of each type at order number ``i``, with that number in the low three bits: equal for equal contexts only."""
    before, k = types >> np.uint64(8), ORDERS[i]
    keep = np.array([(1 << (8 * n)) - 1 for n in range(LONGEST + 1)], np.uint64)
    return (before & (keep[_word_bytes(before)] if k == WORD else keep[k])) * np.uint64(8) + np.uint64(i)


def _context_ids(types: np.ndarray) -> list[np.ndarray]:
    """Contexts of each type at every order."""
    return [_context_id(types, i) for i in range(len(ORDERS))]


def turned(types: np.ndarray) -> np.ndarray:
    """Types with the nearest context byte first and the coded byte last, so that sorted types lie by context at every
    order; turned again they are as before."""
    out = types.byteswap()
    out &= np.uint64(((1 << 8 * LONGEST) - 1) << 8)
    out |= types & np.uint64(255)
    return out


def _section_pairs(types: np.ndarray):
    """For each order: (a type of each distinct (context, byte) pair, each type's pair); neighbouring contexts lie together.

    A word's pairs may come twice, as those after a space and those at a text's begin.
    """
    near = turned(types)
    order = np.argsort(near)
    near = turned(near.take(order))
    room = np.uint64(len(types).bit_length())
    for i, k in enumerate(ORDERS):
        at = np.empty(len(types), np.int32)
        if k == LONGEST:                             # the types themselves
            at[order] = np.arange(len(types), dtype=np.int32)
            yield near, at
            continue
        context = _context_id(near, i)
        run = np.zeros(len(types), np.uint64)
        np.cumsum(context[1:] != context[:-1], out=run[1:])
        both = (((run << np.uint64(8)) | (near & np.uint64(255))) << room) | np.arange(len(types), dtype=np.uint64)
        both.sort()
        place = (both & ((np.uint64(1) << room) - np.uint64(1))).view(np.int64)
        both >>= room
        first = np.ones(len(types), bool)
        first[1:] = both[1:] != both[:-1]
        at[order.take(place)] = np.cumsum(first, dtype=np.int32) - np.int32(1)
        yield near.take(place[first]), at


def _contexts(types: np.ndarray) -> list[np.ndarray]:
    """Hash of each context of each type; the code's node is still to be added."""
    return [mix(c) for c in _context_ids(types)]


def _salt(node: np.ndarray) -> np.ndarray:
    return node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _slot(context: np.ndarray, salt: np.ndarray, bits: int) -> np.ndarray:
    slot = context + salt
    slot >>= np.uint64(64 - bits)
    return slot.view(np.int64)


def _decisions(types: np.ndarray, code: Code, slots: bool = True):
    """For each depth of the code: (types that go so far, their nodes, bits, slots of each context if wanted)."""
    byte = (types & np.uint64(255)).astype(np.int64)
    contexts = _contexts(types) if slots else []
    at = np.arange(len(types))
    for depth in range(code.node.shape[1]):
        go = code.length[byte] > depth
        if not go.all():
            at, byte, contexts = at[go], byte[go], [c[go] for c in contexts]
        if not len(at):
            return
        node = code.node[byte, depth]
        yield depth, at, node, code.bit[byte, depth], [_slot(c, _salt(node), n) for c, n in zip(contexts, SLOT_BITS)]


def _cells(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell below ``x`` and the share of the cell above."""
    at = (x + np.float32(SHARPEST)) * np.float32((CELLS - 1) / (2 * SHARPEST))
    low = np.minimum(at.astype(np.int64), CELLS - 2)
    return low, (at - low).astype(np.float32)


def _gate(depth: int | np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (np.minimum(depth, DEPTHS - 1) * LEVELS + a.astype(np.int64)) * LEVELS + b


def _pairs(types: np.ndarray, code: Code, bits: int):
    """(bucket, pair) of the distinct (context, byte's place) pairs of all orders, by bucket and pair; each type's pair for each order."""
    place = code.rank[(types & np.uint64(255)).astype(np.int64)].astype(np.uint64)
    keys, at = [], []
    for context in _context_ids(types):
        codes, own = pd.factorize((context << np.uint64(8)) | place)
        at.append(codes + sum(len(k) for k in keys))
        keys.append(own)
    keys = np.concatenate(keys) if len(types) else np.zeros(0, np.uint64)
    bucket = (mix(keys >> np.uint64(8)) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    return bucket[order], keys[order], [rank[a] for a in at]


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, compressed byte place by byte place, after the width that they need."""
    kind = np.uint32 if not len(values) or values.max() < 1 << 32 else np.uint64
    width = np.dtype(kind).itemsize
    return bytes([width]) + zstandard.compress(values.astype(kind).view(np.uint8).reshape(-1, width).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"u{width}").ravel().astype(np.int64)


def sent(block: int, types: np.ndarray, times: np.ndarray, code: Code, bits: int) -> pa.RecordBatch:
    """Rows of B.KEYS_SCHEMA: a block's distinct pairs with how often its training texts hold them (0: only asked for)."""
    bucket, keys, at = _pairs(types, code, bits)
    counts = np.zeros(len(keys), np.int64)
    for a in at:
        counts += np.bincount(a, times, len(keys)).astype(np.int64)
    full, cuts = np.unique(bucket, return_index=True)
    ends = np.append(cuts, len(keys))[1:]
    return pa.RecordBatch.from_arrays([
        pa.array(full, pa.int64()), pa.array(np.full(len(full), block), pa.int64()),
        pa.array([zstandard.compress(keys[a:b].tobytes(), 1) for a, b in zip(cuts, ends)], pa.binary()),
        pa.array([_packed(counts[a:b]) for a, b in zip(cuts, ends)], pa.binary())],
        names=["bucket", "block", "keys", "counts"])


def answer(table: pa.Table, code: Code) -> pa.Table:
    """Add up a bucket's pairs; each block gets the count of each pair it sent, then for each decision on the way to the
    byte how often it went the other way.

    Pairs lie by context and place among the leaves, so the pairs below a node of a context are neighbours.
    """
    parts = [np.frombuffer(zstandard.decompress(x.as_py()), np.uint64) for x in table.column("keys")]
    local = np.concatenate([_unpacked(x.as_py()) for x in table.column("counts")])
    keys, at = np.unique(np.concatenate(parts), return_inverse=True)
    totals = np.zeros(len(keys), np.int64)
    np.add.at(totals, at, local)
    context, byte = keys >> np.uint64(8), code.leaf[(keys & np.uint64(255)).astype(np.int64)]
    length = code.length[byte]
    begin = np.cumsum(length) - length
    other = np.zeros(int(length.sum()), np.int64)
    go = np.arange(len(keys))
    for depth in range(code.node.shape[1]):
        go = go[length[go] > depth]
        if not len(go):
            break
        node, bit, c = code.node[byte[go], depth], code.bit[byte[go], depth], context[go]
        first = np.ones(len(go), bool)
        first[1:] = (node[1:] != node[:-1]) | (c[1:] != c[:-1])
        starts, run = np.flatnonzero(first), np.cumsum(first) - 1
        ones, both = np.add.reduceat(totals[go] * bit, starts), np.add.reduceat(totals[go], starts)
        other[begin[go] + depth] = np.where(bit == 1, (both - ones)[run], ones[run])
    out, done = [], 0
    for x in parts:
        mine = at[done:done + len(x)]
        done += len(x)
        size = length[mine]
        where = np.repeat(begin[mine] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        out.append(_packed(np.concatenate([totals[mine], other[where]])))
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "counts": pa.array(out, pa.binary())})


def _run_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs that begin at ``starts``; faster than ``reduceat`` for short runs."""
    total = np.cumsum(values, dtype=np.int64)
    ends = total.take(np.append(starts[1:], len(values)) - 1)
    ends[1:] -= ends[:-1].copy()
    return ends


def sorted_types(keys: np.ndarray, taught: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct turned types, how often each is at a place that is ``taught``)."""
    both = np.empty(len(keys), np.uint64)
    for a in range(0, len(keys), PIECE):             # small arrays stay in the cache
        both[a:a + PIECE] = (turned(keys[a:a + PIECE]) << np.uint64(1)) | taught[a:a + PIECE]
    both.sort()                                      # much faster than a hash table of as many keys
    times = both.astype(np.uint8) & np.uint8(1)
    both >>= np.uint64(1)
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])[:len(both)])
    return both.take(first), _run_sums(times, first) if len(first) else first


def tally(block: int, types: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """Row of TALLY_SCHEMA: a block's sorted distinct turned types with how often its training texts hold them (0: only asked
    for), and some of their contexts."""
    marks = types[np.linspace(0, len(types) - 1, min(MARKS, len(types))).astype(np.int64)] >> np.uint64(8)
    return pa.RecordBatch.from_arrays([
        pa.array([block], pa.int64()), pa.array([len(types)], pa.int64()), pa.array([marks.tobytes()], pa.binary()),
        pa.array([_packed(types)], pa.binary()), pa.array([_packed(times)], pa.binary())],
        names=["block", "n", "marks", "keys", "counts"])


TALLY_SCHEMA = "block long, n long, marks binary, keys binary, counts binary"


def bounds(tallies: DataFrame) -> np.ndarray:
    """Turned contexts where a new bucket begins, so that buckets get about BUCKET_TYPES types; any bounds are right."""
    rows = tallies.select("n", "marks").collect()    # MARKS contexts a block
    if not rows:
        return np.zeros(0, np.uint64)
    marks = [np.frombuffer(r.marks, np.uint64) for r in rows]
    share = np.concatenate([np.full(len(m), r.n / len(m)) for r, m in zip(rows, marks)])
    marks = np.concatenate(marks)
    order = np.argsort(marks)
    marks, ends = marks[order], np.cumsum(share[order])
    parts = max(int(tallies.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(np.ceil(ends[-1] / BUCKET_TYPES)))
    return np.unique(marks[np.searchsorted(ends, ends[-1] * np.arange(1, parts) / parts)])


def _in_sorted(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each value is one of the sorted ``among``."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def shared_pairs(types: np.ndarray, times: np.ndarray, cuts: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, counts) of the contexts whose types ``cuts`` may part, from sorted turned types that occurred."""
    found, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    place = code.rank[(types & np.uint64(255)).astype(np.int64)]
    for size in range(LONGEST):                      # contexts of the longest size are never parted
        shift = np.uint64(8 * (LONGEST - size))
        for i, k in enumerate(ORDERS):
            heads = np.unique(cuts >> shift)
            if k == WORD:                            # a word that the cut is in, after a space or at a text's begin
                heads = heads[_word_bytes(turned(heads << (shift + np.uint64(8))) >> np.uint64(8)) >= size]
                low = ((heads << np.uint64(8)) | np.array([[SPACE], [END]], np.uint64)) << shift
                high = low | ((np.uint64(1) << shift) - np.uint64(1))
            elif k == size:
                low = heads[None] << (shift + np.uint64(8))
                high = low | ((np.uint64(1) << (shift + np.uint64(8))) - np.uint64(1))
            else:
                continue
            begin = np.searchsorted(types, low).ravel()
            n = np.searchsorted(types, high, "right").ravel() - begin
            at = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
            head = np.repeat(np.tile(np.arange(len(heads)), len(low)), n)
            total = np.bincount(head * 256 + place[at], times[at], 256 * len(heads))
            full = np.flatnonzero(total)
            context = (turned(heads << (shift + np.uint64(8))) >> np.uint64(8)) * np.uint64(8) + np.uint64(i)
            found.append((context[full >> 8] << np.uint64(8)) | (full & 255).astype(np.uint64))
            counts.append(total[full].astype(np.int64))
    return np.concatenate(found), np.concatenate(counts)


def node_values(keys: np.ndarray, totals: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prediction and level of each decision on the way to each pair's byte, and where each pair's begin, from all pairs of
    some contexts, sorted, and their counts."""
    context, byte = keys >> np.uint64(8), code.leaf[(keys & np.uint64(255)).astype(np.int64)]
    length = code.length[byte]
    begin = np.cumsum(length) - length
    guess, level = np.zeros(int(length.sum()), np.int16), np.zeros(int(length.sum()), np.uint8)
    go = np.arange(len(keys))
    for depth in range(code.node.shape[1]):
        go = go[length[go] > depth]
        if not len(go):
            break
        node, bit, c, n = code.node[byte[go], depth], code.bit[byte[go], depth], context[go], totals[go]
        first = np.ones(len(go), bool)
        first[1:] = (node[1:] != node[:-1]) | (c[1:] != c[:-1])
        starts, run = np.flatnonzero(first), np.cumsum(first) - 1
        ones, both = np.add.reduceat(n * bit, starts), np.add.reduceat(n, starts)
        g, v = slot_values(np.stack([both - ones, ones]))
        where = begin[go] + depth
        guess[where], level[where] = g[run], v[run]
    return guess, level, begin


def counted(types: np.ndarray, times: np.ndarray, shared: tuple[np.ndarray, np.ndarray], code: Code) -> Answers:
    """What the counts of all training texts say of a bucket's types: ``times`` are the types' own, ``shared`` the sorted pairs
    of contexts that lie in other buckets too."""
    place = code.rank[(types & np.uint64(255)).astype(np.int64)].astype(np.uint64)
    guess, level, begins, done = [], [], [], 0
    for i, context in enumerate(_context_ids(types)):
        codes, own = pd.factorize((context << np.uint64(8)) | place)
        order = np.argsort(own)
        keys, totals = own[order], np.bincount(codes, times, len(own)).astype(np.int64)[order]
        rank = np.empty(len(own), np.int64)
        rank[order] = np.arange(len(own))
        pairs, counts = (x[((shared[0] >> np.uint64(8)) & np.uint64(7)) == i] for x in shared)
        here = _in_sorted(pairs >> np.uint64(8), keys >> np.uint64(8))
        if here.any():
            pairs, counts = pairs[here], counts[here]
            totals[_in_sorted(keys >> np.uint64(8), pairs >> np.uint64(8))] = 0
            more = pairs[~_in_sorted(pairs, keys)]   # bytes that a context has in other buckets only
            rank += np.searchsorted(more, own)
            at = np.searchsorted(keys, more)
            keys, totals = np.insert(keys, at, more), np.insert(totals, at, 0)
            totals[np.searchsorted(keys, pairs)] = counts
        g, v, begin = node_values(keys, totals, code)
        guess.append(g)
        level.append(v)
        begins.append(begin[rank][codes] + done)
        done += len(g)
    return Answers(np.concatenate(guess), np.concatenate(level), begins)


def rate_types(table: pa.Table, model: Model, shared: tuple[np.ndarray, np.ndarray]) -> pa.Table:
    """Add up a bucket's types; each block gets the logarithm of the probability of each type that it sent."""
    parts = [_unpacked(x.as_py()) for x in table.column("keys")]
    codes, types = pd.factorize(np.concatenate(parts).astype(np.uint64))
    times = np.bincount(codes, np.concatenate([_unpacked(x.as_py()) for x in table.column("counts")]), len(types)).astype(np.int64)
    types = turned(types)
    logs = log_types(types, model, counted(types, times, shared, model.code)).astype(np.float64)
    logs = np.rint(logs * -LOG_UNIT).astype(np.int64)[codes]
    ends = np.cumsum([len(x) for x in parts])
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                     "counts": pa.array([_packed(logs[e - len(x):e]) for x, e in zip(parts, ends)], pa.binary())})


def rated(replies: pa.Table) -> np.ndarray:
    """One block's logarithms, to 1 / LOG_UNIT, in the order of its sorted turned types."""
    return B.join_reply(replies, "int64", decode=_unpacked) / -LOG_UNIT


@dataclass
class Answers:
    """What a block was answered: prediction and level of each pair's decisions, where each type's begin, for each order."""
    guess: np.ndarray
    level: np.ndarray
    begin: list[np.ndarray]


def answered(replies: pa.Table, types: np.ndarray, code: Code, bits: int) -> Answers:
    """The answers of a block that sent these types."""
    bucket, keys, at = _pairs(types, code, bits)
    byte = code.leaf[(keys & np.uint64(255)).astype(np.int64)]
    length = code.length[byte]
    begin = np.cumsum(length) - length
    cuts = np.append(np.unique(bucket, return_index=True)[1], len(keys))
    raw = replies.column("counts").to_pylist()
    guess, level = [], []
    for i, a, b in zip(np.argsort(np.asarray(replies.column("bucket"))), cuts[:-1], cuts[1:]):
        values, size = _unpacked(raw[i]), length[a:b]
        total, other = values[:b - a], values[b - a:]
        ends, runs = np.cumsum(size), np.cumsum(other)
        same = np.repeat(total + runs[ends - 1], size) - runs              # as often as the byte's own way was taken
        depth = np.arange(len(other)) - np.repeat(ends - size, size)
        ones = code.bit[np.repeat(byte[a:b], size), depth] == 1
        g, n = slot_values(np.stack([np.where(ones, other, same), np.where(ones, same, other)]))
        guess.append(g)
        level.append(n)
    return Answers(np.concatenate(guess), np.concatenate(level), [begin[a] for a in at])


@dataclass
class Model:
    """Prediction (stretch x 2048, int16) and evidence level (uint8) per slot of one task's tables, weights per gate, refined
    stretch per cell.  The broadcast model has no slots."""
    code: Code
    guess: list[np.ndarray]
    level: list[np.ndarray]
    weights: np.ndarray
    refined: np.ndarray


class Trainer:
    """What one task learns from its training texts."""

    def __init__(self, code: Code):
        self.code = code
        self.counts = [np.zeros(1 << b, np.uint64) for b in SLOT_BITS]       # low half: zeros, high half: ones
        self.filled = [0] * len(ORDERS)              # slots in use, or more
        self.weights = np.full((len(ORDERS), GATES), 0.3, np.float32)
        self.curve = np.full(GATES, 1.0)
        self.outcomes = np.zeros((2, 256 * CELLS))
        on_way = np.arange(code.node.shape[1]) < code.length[:, None]
        self.way_begin = np.cumsum(code.length) - code.length                # each byte's decisions, one after another
        self.way_gate, self.way_bit = _gate(np.nonzero(on_way)[1], np.zeros(1), np.zeros(1, np.int64)), code.bit[on_way].astype(np.float64)
        self.way_salt, self.way_cell = _salt(code.node[on_way]), code.node[on_way] * CELLS
        self.way_unit = np.uint64(1) << (code.bit[on_way].astype(np.uint64) << np.uint64(5))

    def learn(self, types: np.ndarray, times: np.ndarray) -> None:
        """Predict a chunk, then learn it: ``types`` with how often each occurs.

        The counts move only after the whole chunk is predicted: a context that
        was met a moment ago under another byte would look less certain than it is.
        So a (context, byte) pair of a section is looked up and counted once.
        """
        pairs = []
        for a in range(0, len(types), SECTION):
            part, n = types[a:a + SECTION], times[a:a + SECTION]
            met = []
            for k, (own, at) in enumerate(_section_pairs(part)):
                met.append(self._met(k, own, at))
                pairs.append((k, own, np.bincount(at, n, len(own)).astype(np.uint32)))
            byte = (part & np.uint64(255)).astype(np.int64)
            for b in range(0, len(part), STEP):
                self._adapt([(begin[b:b + STEP], guess, level) for begin, guess, level in met], byte[b:b + STEP], n[b:b + STEP])
        for k, own, n in pairs:
            for a, steps, size, slots in self._ways(k, own):
                np.add.at(self.counts[k], slots, np.repeat(n[a:a + PIECE].astype(np.uint64), size) * self.way_unit.take(steps))
                self.filled[k] += len(slots)

    def _ways(self, k: int, own: np.ndarray):
        """For runs of an order's pairs: (where the run begins, place among the code's decisions of each decision on the way to
        each pair's byte, how many each pair has, their slots)."""
        for a in range(0, len(own), PIECE):
            part = own[a:a + PIECE]
            byte = (part & np.uint64(255)).astype(np.int64)
            size = self.code.length[byte]
            ends = np.cumsum(size)
            steps = np.repeat(self.way_begin[byte] - ends + size, size)
            steps += np.arange(ends[-1])
            yield a, steps, size, _slot(np.repeat(mix(_context_id(part, k)), size), self.way_salt.take(steps), SLOT_BITS[k])

    def _met(self, k: int, own: np.ndarray, at: np.ndarray):
        """What an order's counts say of a section: where each type's decisions begin, prediction of each pair's decisions, and
        their level (of the last two orders)."""
        size = self.code.length[(own & np.uint64(255)).astype(np.int64)]
        ends, done = np.cumsum(size), 0
        guess = np.empty(ends[-1], np.float32)
        level = np.empty(ends[-1], np.uint8) if k >= len(ORDERS) - 2 else None
        for _, _, _, slots in self._ways(k, own):
            both = self.counts[k].take(slots).view("<u4")
            n0, n1 = both[::2].astype(np.float32), both[1::2].astype(np.float32)
            guess[done:done + len(slots)] = np.log((n1 + np.float32(PRIOR)) / (n0 + np.float32(PRIOR)))
            if level is not None:
                level[done:done + len(slots)] = _LEVEL[np.minimum(n0 + n1, 63).astype(np.int8)]
            done += len(slots)
        return (ends - size).astype(np.int32)[at], guess, level

    def renew(self) -> None:
        """Empty the tables once one is half full, so that contexts do not come to share slots; weights and map go on."""
        for k, c in enumerate(self.counts):
            if 2 * self.filled[k] > len(c):          # at most so many: only then they are counted
                self.filled[k] = np.count_nonzero(c)
        if any(2 * n > len(c) for n, c in zip(self.filled, self.counts)):
            for c in self.counts:
                c[:] = 0
            self.filled = [0] * len(ORDERS)

    def maps(self):
        """Weights (-1) and outcomes (-2)."""
        yield -1, np.vstack([self.weights * self.curve, self.curve])
        yield -2, self.outcomes

    def _adapt(self, met: list, byte: np.ndarray, times: np.ndarray) -> None:
        """Predict a step and move the weights.

        Depths that have gates of their own do not touch each other's weights, so they are predicted together, type by type;
        the deepest share gates and follow one by one.
        """
        weight, length = times.astype(np.float64), self.code.length[byte]
        begins, ways = [begin.astype(np.int64) for begin, _, _ in met], self.way_begin[byte]
        size = np.minimum(length, DEPTHS - 1)
        ends = np.cumsum(size)
        *spots, steps = (np.repeat(b - ends + size, size) for b in (*begins, ways))
        place = np.arange(ends[-1])
        for s in (*spots, steps):
            s += place
        self._refine(*self._move(met, spots, steps, np.repeat(weight, size)))
        deep, done = np.flatnonzero(length >= DEPTHS), []
        begins, ways, weight, length = [b[deep] for b in begins], ways[deep], weight[deep], length[deep]
        for depth in range(DEPTHS - 1, length.max(initial=0)):
            at = np.flatnonzero(length > depth)
            done.append(self._move(met, [b[at] + depth for b in begins], ways[at] + depth, weight[at]))
        if done:
            self._refine(*map(np.concatenate, zip(*done)))

    def _refine(self, cell: np.ndarray, bit: np.ndarray, times: np.ndarray) -> None:
        """Count what followed the predictions; a cell belongs to one depth."""
        hits = np.bincount(cell, times * bit, 256 * CELLS)
        self.outcomes[1] += hits
        self.outcomes[0] += np.bincount(cell, times, 256 * CELLS) - hits

    def _move(self, met: list, spots: list[np.ndarray], ways: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Predict decisions and move the weights by their errors: ``spots`` are their places in ``met``, ``ways`` among the code's.
        Returns their cells of the refining map, bits and times."""
        inputs = [guess.take(s) for s, (_, guess, _) in zip(spots, met)]
        gate, levels = self.way_gate.take(ways), [level.take(s) for s, (_, _, level) in zip(spots, met) if level is not None]
        levels[0] *= np.uint8(LEVELS)
        levels[0] += levels[1]
        gate += levels[0]
        x, squares = self.weights[0].take(gate), inputs[0] * inputs[0]
        x *= inputs[0]
        for w, i in zip(self.weights[1:], inputs[1:]):
            part = w.take(gate)
            part *= i
            x += part
            np.multiply(i, i, out=part)
            squares += part
        np.clip(x, -SHARPEST, SHARPEST, out=x)
        p = np.negative(x)
        np.exp(p, out=p)
        p += 1
        bit = self.way_bit.take(ways)
        miss = bit - np.divide(1, p, out=p)
        error = miss * times
        miss *= error
        miss *= squares
        self.curve += np.bincount(gate, miss, GATES)
        for k, i in enumerate(inputs):
            self.weights[k] += (np.bincount(gate, np.multiply(error, i, out=miss), GATES) / self.curve).astype(np.float32)
        low, up = _cells(x)
        return self.way_cell.take(ways) + low + (up > 0.5), bit, times

    def pieces(self):
        """(piece number, values): runs of PIECE slots that hold anything, then weights (-1) and outcomes (-2)."""
        number = 0
        for c in self.counts:
            for at in range(0, len(c), PIECE):
                run = c[at:at + PIECE]
                if run.any():
                    yield number, np.stack([run & np.uint64(0xFFFFFFFF), run >> np.uint64(32)]).astype(np.float64)
                number += 1
        yield from self.maps()


def slot_values(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(guess, level) of a run of slots from its added-up (zeros, ones)."""
    n0, n1 = counts.reshape(2, -1)
    x = np.clip(np.log((n1 + PRIOR) / (n0 + PRIOR)), -SHARPEST, SHARPEST)
    return np.rint(x * 2048).astype(np.int16), _LEVEL[np.minimum(n0 + n1, 63).astype(np.int64)]


def build(code: Code, pieces: dict[int, np.ndarray]) -> Model:
    """The model from added-up pieces, those of slots as ``slot_values``; without any, it has no slots."""
    guess, level, number = [], [], 0
    for b in SLOT_BITS if any(n >= 0 for n in pieces) else ():
        guess.append(np.zeros(1 << b, np.int16))
        level.append(np.zeros(1 << b, np.uint8))
        for at in range(0, 1 << b, PIECE):
            if number in pieces:
                guess[-1][at:at + PIECE], level[-1][at:at + PIECE] = pieces[number]
            number += 1
    weights, outcomes = np.full((len(ORDERS), GATES), 0.3, np.float32), np.zeros((2, 256 * CELLS))
    if -1 in pieces:
        sums = pieces[-1].reshape(-1, GATES)
        weights, outcomes = (sums[:-1] / sums[-1]).astype(np.float32), pieces[-2].reshape(2, -1)
    centre = np.tile(_squash(np.linspace(-SHARPEST, SHARPEST, CELLS)), 256)
    p = (outcomes[1] + 32 * centre) / (outcomes.sum(0) + 32)
    refined = np.clip(_stretch(np.clip(p, 1e-9, 1 - 1e-9)), -SHARPEST, SHARPEST).astype(np.float32)
    return Model(code, guess, level, weights, refined)


def log2_types(types: np.ndarray, model: Model, answers: Answers | None = None) -> np.ndarray:
    """``log_types`` in bits."""
    return log_types(types, model, answers).astype(np.float64) / np.log(2)


def log_types(types: np.ndarray, model: Model, answers: Answers | None = None) -> np.ndarray:
    """Logarithm of the model's probability of each type's byte in its context, by the answered counts or by the model's slots."""
    out = np.zeros(len(types), np.float32)
    orders = range(len(ORDERS))
    for a in range(0, len(types), STEP):
        part = out[a:a + STEP]
        for depth, at, node, bit, slots in _decisions(types[a:a + STEP], model.code, answers is None):
            if answers is None:
                guess, level = [model.guess[k][slots[k]] for k in orders], [model.level[k][slots[k]] for k in orders[-2:]]
            else:
                spots = [answers.begin[k][a + at] + depth for k in orders]
                guess, level = [answers.guess[i] for i in spots], [answers.level[i] for i in spots[-2:]]
            gate = _gate(depth, *level)
            x = np.zeros(len(at), np.float32)
            for k, g in enumerate(guess):
                x += model.weights[k][gate] * g
            x = np.clip(x * np.float32(1 / 2048), -SHARPEST, SHARPEST)
            low, up = _cells(x)
            cell = node * CELLS + low
            x = (x + model.refined[cell] * (1 - up) + model.refined[cell + 1] * up) * np.float32(0.5)
            part[at] -= np.log1p(np.exp(x * (1 - 2 * bit).astype(np.float32)))
    return out


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, how often each is there, the places of the first, of the second, ...).

    Sorts hash and place in one number, which is faster than a hash table of as many keys; where two keys meet in
    their hash, sorts places by key.
    """
    room = np.uint64(len(keys).bit_length())
    both = (keys * np.uint64(0x9E3779B97F4A7C15)) >> room << room
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    places = (both & ((np.uint64(1) << room) - np.uint64(1))).view(np.int64)
    both >>= room
    first = np.concatenate([[True], both[1:] != both[:-1]])
    found = keys.take(places)
    if not (first[1:] == (found[1:] != found[:-1])).all():
        places = np.argsort(keys, kind="stable")
        found = keys.take(places)
        first[1:] = found[1:] != found[:-1]
    starts = np.flatnonzero(first)
    return found.take(starts), np.diff(np.append(starts, len(keys))), places


def _first_places(keys: np.ndarray) -> np.ndarray:
    """For each place the first one with the same key.

    A table by hashes keeps the first place of each hash; places whose key is another than that one's go on to a table by
    other hashes.  Takes much less memory than sorting keys with their places, or a hash table of the keys.
    """
    out, at, factor = np.empty(len(keys), np.int32), np.arange(len(keys), dtype=np.int32), 0x9E3779B97F4A7C15
    while len(at):
        bits = min(len(at).bit_length(), FIRST_BITS)
        shift, times = np.uint64(64 - bits), np.uint64(factor)
        table, other = np.empty(1 << bits, np.int32), []
        for a in reversed(range(0, len(at), PIECE)):
            part = at[a:a + PIECE][::-1]
            table[((keys.take(part) * times) >> shift).view(np.int64)] = part          # the last one written stays
        for a in range(0, len(at), PIECE):
            part = at[a:a + PIECE]
            here = keys.take(part)
            found = table.take(((here * times) >> shift).view(np.int64))
            out[part] = found
            other.append(part[keys.take(found) != here])
        at = np.concatenate(other)
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
    return out


def score_texts(column, model: Model, logs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(log2 probability, bytes) of each text as it is coded, by ``logs`` of its sorted turned types or by the model's slots."""
    keys, begins = type_keys(*stream(column))
    if not len(keys):
        return np.zeros(0), np.zeros(0, np.int64)
    types, times, places = _grouped(keys)
    del keys
    if logs is None:
        bits = log2_types(types, model)
    else:
        bits = np.empty(len(types))
        bits[np.argsort(turned(types))] = logs / np.log(2)
    each = np.empty(len(places))
    each[places] = np.repeat(bits, times)
    return np.add.reduceat(each, begins[:-1]), np.diff(begins)


_END_KEY = np.array([0x5851F42D4C957F2D], np.uint64)


def _tokens(table: pa.Table):
    """(words, sorted distinct token keys, position of each word's key, position of the end's key)."""
    words = Words(table.column("text"), lower=True)
    codes, keys = pd.factorize(np.concatenate([words.hashes(), _END_KEY]))
    order = np.argsort(keys)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    return words, keys[order], rank[codes[:-1]], rank[codes[-1]]


def _train(batches, code: Code):
    """Weights and outcomes that a task's blocks teach."""
    trainer, learned, held, waiting = Trainer(code), 0, [], 0
    pack = zstandard.ZstdCompressor(level=1)

    def learn(size):
        keys = np.concatenate(held)
        held[:] = [keys[size:].copy()]
        keys = keys[:size]
        first = _first_places(keys)
        times = np.bincount(first, minlength=size)
        own = np.flatnonzero(times)                  # in the order of the text
        types, times = keys.take(own), times.take(own)
        del keys, first                              # much larger than what is learned
        trainer.renew()
        trainer.learn(types, times)

    for batch in batches:
        for payload in batch.column("payload"):
            table = B.from_stream(payload.as_py())
            texts = table.filter(table.column("train")).select(["text"]).combine_chunks()
            for part in (p for b in texts.to_batches() for p in B.slices(b, SLICE_BYTES)):
                held.append(type_keys(*stream(part.column(0)))[0])
                waiting += len(held[-1])
                while waiting >= (size := min(max(learned, CHUNK_BYTES[0]), CHUNK_BYTES[1])):
                    learn(size)
                    waiting, learned = waiting - size, learned + size
    if waiting:
        learn(waiting)
    for number, values in trainer.maps():
        yield pa.RecordBatch.from_pydict({"piece": [number], "payload": [pack.compress(values.tobytes())]},
                                         schema=pa.schema([("piece", pa.int64()), ("payload", pa.binary())]))


def _add(table: pa.Table) -> pa.Table:
    number, total = table.column("piece")[0].as_py(), None
    for x in table.column("payload"):
        v = np.frombuffer(zstandard.decompress(x.as_py()), np.float64)
        total = v.copy() if total is None else total.__iadd__(v)
    return pa.table({"piece": [number], "payload": pa.array([zstandard.compress(total.tobytes(), 1)], pa.binary())})


def byte_code(blocks: DataFrame) -> Code:
    """Code by the bytes of the blocks' texts that are marked ``train``."""
    def histogram(batches):
        total = np.zeros(256, np.int64)
        for batch in batches:
            for payload in batch.column("payload"):
                table = B.from_stream(payload.as_py())
                texts = table.filter(table.column("train")).column("text")
                total += np.bincount(utf8_buffer(texts)[0], minlength=256)
                total[END] += len(texts)
        total[ord("a"):ord("z") + 1] += total[ord("A"):ord("Z") + 1]
        total[ord("A"):ord("Z") + 1] = 0
        yield pa.RecordBatch.from_pydict({"byte": np.arange(256), "n": total})

    seen = blocks.select("payload").mapInArrow(histogram, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(256, np.int64)
    for r in seen:                                   # 256 rows
        counts[r.byte] = r.n
    return huffman(counts)


def train(blocks: DataFrame, code: Code) -> Model:
    """Weights and refining map from the blocks' texts that are marked ``train``: ``size_bound()`` bytes at any input size."""
    fan = int(np.ceil(np.sqrt(max(1, blocks.count()))))
    kind = "piece long, payload binary"
    parts = blocks.select("payload").mapInArrow(lambda b: _train(b, code), kind) \
        .withColumn("part", F.pmod(F.spark_partition_id(), F.lit(fan)))
    sums = parts.groupBy("piece", "part").applyInArrow(lambda t: _add(t.select(["piece", "payload"])), kind)
    rows = sums.groupBy("piece").applyInArrow(_add, kind).collect()   # at most size_bound() bytes
    return build(code, {r.piece: np.frombuffer(zstandard.decompress(bytes(r.payload)), np.float64) for r in rows})


def parted_pairs(tallies: DataFrame, cuts: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """Sorted pairs of the contexts that ``cuts`` may part, at most five for each, and how often the training texts hold them."""
    def add(pairs, n):
        codes, own = pd.factorize(np.concatenate(pairs))
        total = np.zeros(len(own), np.int64)
        np.add.at(total, codes, np.concatenate(n))
        return own, total

    def find(batches):
        pairs, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column("keys"), batch.column("counts")):
                times = _unpacked(counts.as_py())
                more = shared_pairs(_unpacked(keys.as_py())[times > 0].astype(np.uint64), times[times > 0], cuts, code)
                pairs, n = add([pairs, more[0]], [n, more[1]])
        part = (mix(pairs >> np.uint64(8)) >> np.uint64(60)).astype(np.int64)
        for i in np.unique(part):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), *(pa.array([_packed(x[part == i])], pa.binary()) for x in (pairs, n))],
                                             names=["part", "pairs", "n"])

    def merge(table):
        pairs, n = add(*([_unpacked(x.as_py()) for x in table.column(c)] for c in ("pairs", "n")))
        return pa.table({"part": table.column("part")[:1], "pairs": pa.array([_packed(pairs)], pa.binary()), "n": pa.array([_packed(n)], pa.binary())})

    kind = "part long, pairs binary, n binary"
    rows = tallies.select("keys", "counts").mapInArrow(find, kind).groupBy("part").applyInArrow(merge, kind).collect()    # the result itself
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    pairs, n = (np.concatenate([_unpacked(bytes(r[c])) for r in rows]) for c in ("pairs", "n"))
    order = np.argsort(pairs)
    return pairs[order].astype(np.uint64), n[order]


def bucket_types(tallies: DataFrame, cuts: np.ndarray) -> DataFrame:
    """Rows of B.KEYS_SCHEMA: each block's types by bucket."""
    def part(batches):
        for batch in batches:
            for block, keys, counts in zip(*(batch.column(c) for c in ("block", "keys", "counts"))):
                types, times = _unpacked(keys.as_py()), _unpacked(counts.as_py())
                ends = np.concatenate([[0], np.searchsorted(types, (cuts << np.uint64(8)).astype(np.int64)), [len(types)]])
                full = np.flatnonzero(np.diff(ends))
                yield pa.RecordBatch.from_arrays([
                    pa.array(full, pa.int64()), pa.array(np.full(len(full), block.as_py()), pa.int64()),
                    pa.array([_packed(types[ends[i]:ends[i + 1]]) for i in full], pa.binary()),
                    pa.array([_packed(times[ends[i]:ends[i + 1]]) for i in full], pa.binary())],
                    names=["bucket", "block", "keys", "counts"])

    return tallies.select("block", "keys", "counts").mapInArrow(part, B.KEYS_SCHEMA)


def score(df: DataFrame, text_col: str, is_training, carry: list[str]) -> DataFrame:
    """Score every text of ``df`` with a model learned from the rows where ``is_training`` holds.

    Returns (row struct of ``carry``; train boolean; n_tokens, n_known,
    train_tokens long; base_score double: log10 probability under the smoothed
    counts of single tokens; score double: log10 probability under the mixing
    model; n_bytes long: bytes of the coded text; bits_per_byte double).

    A null or empty text is the end token alone.  Rows count one by one, so
    repeated rows teach repeatedly.  A null ``is_training`` means no.  Without
    training rows the base score is 0 and the model knows nothing.  Counts do
    not depend on how rows lie in partitions; the gated weights do, slightly, as
    each task adapts its own.
    """
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text_col}`").alias("text"),
                     F.coalesce(is_training, F.lit(False)).alias("train"))
    blocks = B.pack_blocks(held, block_bytes=LM_BLOCK, tag="lm-blocks", level=3)
    bits = B.bucket_bits(blocks, 0.4)

    def count(block, table):
        words, keys, at, end = _tokens(table)
        taught = np.asarray(table.column("train"))
        counts = np.bincount(at[np.repeat(taught, np.diff(words.ptr))], minlength=len(keys))
        counts[end] += taught.sum()
        yield B.key_slices(block, keys, counts, bits, encode=_packed)

    replies = cut_lineage(B.count_exchange(B.over_blocks(blocks, count, B.KEYS_SCHEMA), reply="int64", encode=_packed, decode=_unpacked), "lm-counts")
    n, v = (x or 0 for x in replies.agg(F.sum("total"), F.sum("present")).first())
    code = byte_code(blocks)
    model = blocks.sparkSession.sparkContext.broadcast(train(blocks, code))

    def types_of(block, table):
        column, taught = table.column("text"), np.asarray(table.column("train"))
        keys, begins = type_keys(*stream(column))
        yield tally(block, *sorted_types(keys, np.repeat(taught, np.diff(begins))))

    tallies = cut_lineage(B.over_blocks(blocks, types_of, TALLY_SCHEMA), "lm-types")
    cuts = bounds(tallies)
    shared = blocks.sparkSession.sparkContext.broadcast(parted_pairs(tallies, cuts, code))
    pairs = bucket_types(tallies, cuts).groupBy("bucket") \
        .applyInArrow(lambda t: rate_types(t, model.value, shared.value), "block long, bucket long, counts binary").withColumn("pairs", F.lit(True))
    both = replies.select("block", "bucket", "counts", F.lit(False).alias("pairs")).unionByName(pairs)

    def rate(block, table, answers):
        words, keys, at, end = _tokens(table)
        counts = B.join_reply(answers.filter(pc.invert(answers.column("pairs"))), "int64", decode=_unpacked)
        base = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
        ptr = words.ptr
        sums = np.concatenate([[0], np.cumsum(base[at])])
        known = np.concatenate([[0], np.cumsum(counts[at] > 0)])
        log2, size = score_texts(table.column("text"), model.value, rated(answers.filter(answers.column("pairs"))))
        return pa.table({
            "row": table.column("row"), "train": table.column("train"),
            "n_tokens": pa.array(np.diff(ptr) + 1, pa.int64()), "n_known": pa.array(known[ptr[1:]] - known[ptr[:-1]] + int(counts[end] > 0), pa.int64()),
            "train_tokens": pa.array(np.full(len(size), n), pa.int64()),
            "base_score": pa.array(sums[ptr[1:]] - sums[ptr[:-1]] + base[end], pa.float64()),
            "score": pa.array(log2 * np.log10(2), pa.float64()), "n_bytes": pa.array(size, pa.int64()),
            "bits_per_byte": pa.array(-log2 / size, pa.float64())})

    long, double = T.LongType(), T.DoubleType()
    schema = T.StructType([T.StructField("row", held.schema["row"].dataType), T.StructField("train", T.BooleanType()),
                           *(T.StructField(c, long) for c in ("n_tokens", "n_known", "train_tokens")),
                           T.StructField("base_score", double), T.StructField("score", double), T.StructField("n_bytes", long),
                           T.StructField("bits_per_byte", double)])
    return B.with_replies(blocks, both, rate, schema)
