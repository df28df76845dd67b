"""Language-model scores: base score by hand, a proper distribution, and gain on held-out text."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cadenza.llm import lm_mixing as L
from cadenza.llm.queries import QUERIES


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [None]


def base_scores(rows):
    """rows: (text, train) -> (n_tokens, n_known, N, base)."""
    c = Counter(t for text, train in rows if train for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return [(len(t), sum(c[x] > 0 for x in t), n, sum(math.log10((c[x] + .5) / (n + .5 * (v + 1))) for x in t))
            for t in (tokens(text) for text, _ in rows)]


def trained(texts):
    keys, _ = L.type_keys(*L.stream(pa.array(texts)))
    code = L.huffman(np.bincount((keys & np.uint64(255)).astype(int), minlength=256))
    t = L.Trainer(code)
    t.learn(*np.unique(keys, return_counts=True))
    return L.build(code, {k: L.slot_values(v.ravel()) if k >= 0 else v.ravel() for k, v in t.pieces()})


def test_stream_and_contexts():
    keys, begins = L.type_keys(*L.stream(pa.array(["Ab  c", None, "", "É\nx"])))
    assert begins.tolist() == [0, 6, 7, 8, 14]
    assert bytes((keys & np.uint64(255)).astype(np.uint8)) == b"ab c \n" + b"\n" + b"\n" + "É x \n".encode()
    full = [k.item().to_bytes(8, "big")[7 - L.LONGEST:] for k in keys]
    assert full[0] == b"\n" * L.LONGEST + b"a" and full[5] == (b"\n" * L.LONGEST + b"ab c \n")[-L.LONGEST - 1:]
    assert full[8][:-1] == b"\n" * L.LONGEST


def test_probabilities_of_all_bytes_sum_to_one():
    rng = random.Random(1)
    model = trained([" ".join(rng.choice(["the", "of", "und", "xq7", "Éa"]) for _ in range(300)) for _ in range(20)])
    for context in (b"\n\n\n\n\n\n", b" the o", b"zzzzzz", b"f und "):
        types = np.array([int.from_bytes(context[-L.LONGEST:] + bytes([b]), "big") for b in range(256)], np.uint64)
        assert abs((2.0 ** L.log2_types(types, model)).sum() - 1) < 1e-5


def test_model_learns_regular_text():
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta"]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(60)]
    model = trained(texts[:50])
    bits = -L.score_texts(pa.array(texts[50:]), model)[0].sum() / (10 * 200)
    assert 1.9 < bits < 2.6                        # two bits a word are its entropy


def test_query_rows(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    fold = [zlib.crc32(str(d.doc_id).encode()) % 5 for d in docs]
    want = base_scores([(d.text, f != 1) for d, f in zip(docs, fold)])
    got = {r.doc_id: r for r in QUERIES["op4_lm_mixing"](spark, sf).collect()}
    for d, f, (n, known, total, base) in zip(docs, fold, want):
        r = got[d.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (f == 1, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
        assert math.isclose(r.bits_per_byte * r.n_bytes, -r.score / math.log10(2), rel_tol=1e-9)
    assert len(got) == len(docs)


def test_held_out_texts_cost_less_than_by_pairs_of_bytes(spark):
    """Held-out bits per byte stay below the corpus's own entropy of a byte given the one before."""
    sf = "/root/testdata/sf0.01"
    rows = [r for r in QUERIES["op4_lm_mixing"](spark, sf).collect() if r.held_out]
    keys, _ = L.type_keys(*L.stream(pa.array([d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()])))
    data = (keys & np.uint64(255)).astype(np.uint8)
    pairs = np.bincount(data[:-1].astype(np.int64) * 256 + data[1:], minlength=65536).reshape(256, 256).astype(float)
    given = pairs / np.maximum(pairs.sum(1, keepdims=True), 1)
    entropy = -(pairs * np.log2(np.where(given > 0, given, 1))).sum() / pairs.sum()
    bits = -sum(r.score for r in rows) / math.log10(2) / sum(r.n_bytes for r in rows)
    assert bits < 0.8 * entropy


def test_edge_cases(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert L.score(none, "text", F.lit(True), ["doc_id"]).count() == 0
    rows = [(1, None, True), (1, "", True), (2, "a b", True), (2, "a b", True), (None, "q", None), (3, "w " * 50000, False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score boolean")
    got = L.score(df, "text", F.col("score"), ["doc_id", "text", "score"]).collect()
    want = Counter((r[1], *w) for r, w in zip(rows, base_scores([(t, bool(x)) for _, t, x in rows])))
    assert len(got) == 6 and all(math.isclose(r.base_score, next(w[4] for w in want if w[0] == r.row.text)) for r in got)
    untaught = L.score(df, "text", F.lit(False), ["doc_id"]).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and r.score < 0 for r in untaught)


def test_answers_are_the_exact_counts_of_every_context():
    """Two blocks' pairs, added up in buckets, against a dictionary of (context, bits so far); more keys than any fixed table's share."""
    rng = random.Random(3)
    columns = [pa.array(["".join(rng.choice("abcdefgh ") for _ in range(4000)) for _ in range(5)]) for _ in range(2)]
    keys = [L.type_keys(*L.stream(c))[0] for c in columns]
    code = L.huffman(np.bincount((keys[0] & np.uint64(255)).astype(int), minlength=256))
    want, path = Counter(), lambda b, d: code.bit[b, :d].tobytes()
    for c, byte in ((c, int(k) & 255) for k, cs in zip(keys[0], zip(*L._context_ids(keys[0]))) for c in map(int, cs)):
        want.update((c, path(byte, d), int(code.bit[byte, d])) for d in range(code.length[byte]))
    types = [np.unique(k) for k in keys]
    times = [np.unique(keys[0], return_counts=True)[1], np.zeros(len(types[1]), int)]        # the second block only asks
    rows = pa.Table.from_batches([L.sent(b, types[b], times[b], code, 3) for b in (0, 1)])
    buckets = np.asarray(rows.column("bucket"))
    replies = pa.concat_tables([L.answer(rows.filter(pa.array(buckets == b)), code) for b in np.unique(buckets)])
    for b in (0, 1):
        got = L.answered(replies.filter(pa.array(np.asarray(replies.column("block")) == b)), types[b], code, 3)
        for k, contexts in enumerate(L._context_ids(types[b])):
            for i in range(0, len(types[b]), 17):
                c, byte = int(contexts[i]), int(types[b][i]) & 255
                n = [[want[c, path(byte, d), v] for d in range(code.length[byte])] for v in (0, 1)]
                guess, level = L.slot_values(np.array(n, float))
                at = got.begin[k][i] + np.arange(code.length[byte])
                assert (got.guess[at] == guess).all() and (got.level[at] == level).all()


def test_contexts_reach_six_bytes_back_and_the_model_broadcast_holds_no_counts():
    a, b = (int.from_bytes(t, "big") for t in (b"xabcdef", b"yabcdef"))
    same = [x == y for x, y in L._context_ids(np.array([a, b], np.uint64))]
    assert len(same) == 5 and not same[-1] and not same[-2] and all(same[:3])
    code = L.huffman(np.ones(256, int))
    assert L.build(code, {}).guess == [] and L.size_bound() < 1 << 20


def test_buckets_of_types_rate_by_the_exact_counts_of_every_context():
    """Three blocks' types, parted anywhere (inside contexts of every order), against a dictionary of (context, bits so far)."""
    rng = random.Random(4)
    columns = [pa.array(["".join(rng.choice("abcé  ") for _ in range(1500)) for _ in range(4)] + [None]) for _ in range(3)]
    keys = [L.type_keys(*L.stream(c))[0] for c in columns]
    code = L.huffman(np.bincount((keys[0] & np.uint64(255)).astype(int), minlength=256))
    want, path = Counter(), lambda b, d: code.bit[b, :d].tobytes()
    for part in keys[:2]:                                                                   # the third block only asks
        for c, byte in ((c, int(k) & 255) for k, cs in zip(part, zip(*L._context_ids(part))) for c in map(int, cs)):
            want.update((c, path(byte, d), int(code.bit[byte, d])) for d in range(code.length[byte]))
    every = np.unique(L.turned(np.concatenate(keys)))
    assert (L.turned(every) == L.turned(L.turned(L.turned(every)))).all()
    times = np.bincount(np.searchsorted(every, L.turned(np.concatenate(keys[:2]))), minlength=len(every))
    cuts = np.unique(every[::97] >> np.uint64(8))
    pairs, n = L.shared_pairs(every[times > 0], times[times > 0], cuts, code)
    shared = pairs[np.argsort(pairs)], n[np.argsort(pairs)]
    bucket = np.searchsorted(cuts, every >> np.uint64(8), "right")
    assert len(pairs) and len(np.unique(bucket)) > 20
    for b in np.unique(bucket):
        types = L.turned(every[bucket == b])
        got = L.counted(types, times[bucket == b], shared, code)
        for k, contexts in enumerate(L._context_ids(types)):
            for i in range(len(types)):
                c, byte = int(contexts[i]), int(types[i]) & 255
                values = [[want[c, path(byte, d), v] for d in range(code.length[byte])] for v in (0, 1)]
                guess, level = L.slot_values(np.array(values, float))
                at = got.begin[k][i] + np.arange(code.length[byte])
                assert (got.guess[at] == guess).all() and (got.level[at] == level).all()


def test_few_and_many_buckets_give_the_same_scores(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["the", "of", "a", "und", "xq7 é"]) for _ in range(60)), i % 5 != 1) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean").coalesce(1)
    before, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in ("1", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got.append({r.row.doc_id: (r.score, r.base_score) for r in L.score(df, "text", F.col("train"), ["doc_id"]).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got[0]) == 80 and got[0] == got[1]


def test_a_block_sends_less_than_half_of_the_pairs_of_five_orders():
    rng = random.Random(6)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    column = pa.array([" ".join(rng.choice(words) for _ in range(1000)) for _ in range(60)])
    types, times = np.unique(L.type_keys(*L.stream(column))[0], return_counts=True)
    code = L.huffman(np.bincount((types & np.uint64(255)).astype(int), minlength=256))
    every, n = L.sorted_types(np.repeat(types, times), np.ones(times.sum(), bool))
    assert (every == np.sort(L.turned(types))).all() and (n == times[np.argsort(L.turned(types))]).all()
    assert not L.sorted_types(types, np.zeros(len(types), bool))[1].any()
    size, old = L.tally(0, every, n).nbytes, L.sent(0, types, times, code, 1).nbytes
    assert size < old / 2


def test_keys_are_grouped_even_where_their_hashes_meet():
    rng = np.random.default_rng(7)
    meet = np.arange(3, dtype=np.uint64) * np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))    # hashes 0, 1, 2: one in their high bits
    for keys in (rng.integers(0, 50, 1000).astype(np.uint64), rng.choice(meet, 300), np.array([5], np.uint64)):
        types, times, places = L._grouped(keys)
        out = np.empty_like(keys)
        out[places] = np.repeat(types, times)
        assert (out == keys).all() and len(types) == len(np.unique(keys))


def trained_by_loop(code, chunks):
    """Weights, evidence, outcomes and counts of ``Trainer``: every decision of every type looked up and counted on its own."""
    counts = [np.zeros(1 << b, np.uint64) for b in L.SLOT_BITS]
    weights, curve, outcomes = np.full((len(L.ORDERS), L.GATES), 0.3, np.float32), np.full(L.GATES, 1.0), np.zeros((2, 256 * L.CELLS))
    for types, times in chunks:
        for a in range(0, len(types), L.STEP):
            for depth, at, node, bit, slots in L._decisions(types[a:a + L.STEP], code):
                n = [c[s].view("<u4").reshape(-1, 2).astype(np.float32) for c, s in zip(counts, slots)]
                inputs = [np.log((x[:, 1] + np.float32(L.PRIOR)) / (x[:, 0] + np.float32(L.PRIOR))) for x in n]
                gate = L._gate(depth, *(L._LEVEL[np.minimum(x.sum(1), 63).astype(int)] for x in n[-2:]))
                x = np.clip(sum(w[gate] * i for w, i in zip(weights, inputs)), -L.SHARPEST, L.SHARPEST)
                miss, many = bit - 1 / (1 + np.exp(-x)), times[a:a + L.STEP][at]
                curve += np.bincount(gate, many * miss * miss * sum(i * i for i in inputs), L.GATES)
                for w, i in zip(weights, inputs):
                    w += (np.bincount(gate, many * miss * i, L.GATES) / curve).astype(np.float32)
                low, up = L._cells(x)
                np.add.at(outcomes, (bit, node * L.CELLS + low + (up > 0.5)), many)
        for _, at, _, bit, slots in L._decisions(types, code):
            for c, s in zip(counts, slots):
                np.add.at(c, s, times[at].astype(np.uint64) << (bit.astype(np.uint64) << np.uint64(5)))
    return weights, curve, outcomes, counts


def chunks_of_text(seed, n):
    """Types of texts with frequent and rare bytes (codes shorter and longer than the gates tell apart), in the order of the text."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 9))) for _ in range(2000)] + ["é", "日本", "~", "q#"]
        keys = L.type_keys(*L.stream(pa.array([" ".join(rng.choice(words) for _ in range(600)) for _ in range(12)] + ["", None])))[0]
        types, at, times = np.unique(keys, return_index=True, return_counts=True)
        out.append((types[np.argsort(at)], times[np.argsort(at)]))
    return L.huffman(sum(np.bincount((k & np.uint64(255)).astype(int), n, 256).astype(int) for k, n in out) ** 4), out


def test_training_equals_that_of_every_decision_on_its_own(monkeypatch):
    monkeypatch.setattr(L, "STEP", 1 << 9)
    monkeypatch.setattr(L, "SECTION", 1 << 11, raising=False)
    code, chunks = chunks_of_text(10, 3)
    assert code.length[(np.concatenate([t for t, _ in chunks]) & np.uint64(255)).astype(int)].max() > L.DEPTHS
    t = L.Trainer(code)
    for types, times in chunks:
        t.learn(types, times)
    weights, curve, outcomes, counts = trained_by_loop(code, chunks)
    assert all((a == b).all() for a, b in zip(t.counts, counts))
    assert np.allclose(t.weights, weights, rtol=1e-5, atol=1e-7) and np.allclose(t.curve, curve) and np.allclose(t.outcomes, outcomes)


def test_a_chunk_looks_up_its_pairs_and_not_each_order_of_each_type(monkeypatch):
    rng = random.Random(11)
    text = " ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(20000))
    types, times = np.unique(L.type_keys(*L.stream(pa.array([text])))[0], return_counts=True)
    code = L.huffman(np.bincount((types & np.uint64(255)).astype(int), minlength=256))
    seen, slot = [], L._slot
    monkeypatch.setattr(L, "_slot", lambda *a: seen.append(len(a[0])) or slot(*a))
    L.Trainer(code).learn(types, times)
    decisions = code.length[(types & np.uint64(255)).astype(int)].sum()
    assert sum(seen) < 0.8 * len(L.ORDERS) * decisions                                      # predicted and counted


def test_first_places_of_keys_even_where_their_hashes_meet(monkeypatch):
    rng = np.random.default_rng(13)
    monkeypatch.setattr(L, "FIRST_BITS", 4)                                                 # many keys for each hash
    for keys in (rng.integers(0, 300, 5000).astype(np.uint64), rng.integers(0, 1 << 56, 90).astype(np.uint64), np.array([5], np.uint64), np.zeros(0, np.uint64)):
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        assert (L._first_places(keys) == first[which]).all()


def test_pairs_of_parted_contexts_are_whole():
    rng = random.Random(12)
    column = pa.array([" ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 8))) for _ in range(400)) for _ in range(8)] + ["", None])
    types, times = L.sorted_types(L.type_keys(*L.stream(column))[0], np.ones(len(L.type_keys(*L.stream(column))[0]), bool))
    code = L.huffman(np.bincount((types & np.uint64(255)).astype(int), minlength=256))
    place = code.rank[(types & np.uint64(255)).astype(int)].astype(np.uint64)
    for cuts in (np.zeros(0, np.uint64), types[1:2] >> np.uint64(8), np.unique(types[::50] >> np.uint64(8))):
        want, bucket = Counter(), np.searchsorted(cuts, types >> np.uint64(8), "right")
        for context in L._context_ids(L.turned(types)):
            for c in np.unique(context):
                if len(np.unique(bucket[context == c])) > 1:                               # parted: must be there, whole
                    for p, n in zip(place[context == c], times[context == c]):
                        want[int(c) << 8 | int(p)] += int(n)
        pairs, n = L.shared_pairs(types, times, cuts, code)
        got = dict(zip(pairs.tolist(), n.tolist()))
        assert len(got) == len(pairs) and all(got[p] == m for p, m in want.items()) and (len(cuts) > 0 or not got)


def test_logarithms_are_sent_in_less_than_three_bytes():
    rng = random.Random(9)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    column = pa.array([" ".join(rng.choice(words) for _ in range(500)) for _ in range(40)])
    keys, _ = L.type_keys(*L.stream(column))
    types, times = L.sorted_types(keys, np.ones(len(keys), bool))
    model, none = trained(column[:10].to_pylist()), (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    sent = L.tally(0, types, times)
    replies = L.rate_types(pa.table({"bucket": [0], "block": [0], "keys": sent.column("keys"), "counts": sent.column("counts")}), model, none)
    want = L.log_types(L.turned(types), model, L.counted(L.turned(types), times, none, model.code))
    assert np.abs(L.rated(replies) - want).max() < 1e-6
    assert len(replies.column("counts")[0].as_py()) < 3 * len(types)
