"""Packing: ids against whole-text encoding, places against the definition, bins against bounds."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from cadenza.llm import packing
from cadenza.llm.packing import best_fit, lower_bound, pack, token_pieces
from cadenza.llm.queries import QUERIES

PATH = P.path("word_bpe_49k.json")
TEXTS = ["Hello, World's end", "", None, "  \n", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|> x", "H̱ ẖ T̈ É é",
         "́ x ́y", "İstanbul ΣΑΣ straße ﬁ", "tab\tnew\x0bline nbsp em", "x" * 500 + " " + "é" * 300, "1234 567 don't I'LL we'Ve",
         "日本語 テキスト 😀😀", "naïve, CAFÉ. «mot» œuvre! ×3÷4 x=≠y a̸ ≠ 12ab3 a1é2 ÀÉÎ-õü İx, ŞĞ... don't 'tis it's", "word " * 9000, "<|end", "a\x1cb c\x85d"]


def whole(texts):
    tok = Tokenizer.from_file(PATH)
    return [tok.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def check_places(rows, capacity):
    """rows: (sequence, offset, length)."""
    by = {}
    for s, o, n in rows:
        by.setdefault(s, []).append((o, n))
    for spots in by.values():
        at = 0
        for o, n in sorted(spots):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_ids_of_random_texts():
    rng = random.Random(7)
    signs = [*"abzAZ019.,!-'<=#$ \n\t", "é", "É", "ß", "İ", "ı", "ſ", "ø", "Ž", "ǅ", "ȳ", "ʰ", "×", "÷", "·", "«", "\u00a0", "\u0301", "\u0338", "\u0331", "Ω", "я",
             "漢", "😀", "\x01", "\x7f", "\x85", "\u2028", "'s", "'LL", "<|endoftext|>", "<|"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    encoder = packing._Encoder(PATH)
    for some in (texts[:1000], texts[1000:]):
        ids, begin = encoder.encode(pa.array(some), 1)
        for text, want, a, b in zip(some, whole(some), begin, begin[1:]):
            assert ids[a:b].tolist() == want, repr(text)


def test_ids_match_whole_text_encoding(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)
    rows = token_pieces(df, "text", PATH, ["doc_id"], capacity=100).collect()
    for i, want in enumerate(whole(TEXTS)):
        mine = sorted((r.piece, r.start, r.length, bytes(r.ids)) for r in rows if r.row.doc_id == i)
        assert np.frombuffer(b"".join(x[3] for x in mine), np.uint32).tolist() == want, TEXTS[i]
        assert [x[:3] for x in mine] == [(p, 100 * p, min(100, len(want) - 100 * p)) for p in range(-(-len(want) // 100))]


def test_best_fit_and_bound_on_random_lengths():
    rng = random.Random(1)
    for _ in range(60):
        c = rng.choice([10, 64, 100])
        lengths = np.array([rng.randint(1, c) for _ in range(rng.randint(1, 60))])
        bins, offsets = best_fit(lengths, c)
        n = check_places(zip(bins.tolist(), offsets.tolist(), lengths.tolist()), c)
        values, counts = np.unique(lengths, return_counts=True)
        low = lower_bound(values, counts, c)
        assert -(-lengths.sum() // c) <= low <= n <= max(low + 2, low * 1.3)


def least_bins(lengths, c):
    """Exact, by trying."""
    best = [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[i]:
                go(i + 1, rooms[:j] + [rooms[j] - lengths[i]] + rooms[j + 1:])
        go(i + 1, rooms + [c - lengths[i]])
    go(0, [])
    return best[0]


def test_bound_never_exceeds_the_optimum():
    rng = random.Random(2)
    for _ in range(40):
        lengths = sorted((rng.randint(1, 20) for _ in range(7)), reverse=True)
        values, counts = np.unique(lengths, return_counts=True)
        assert lower_bound(values, counts, 20) <= least_bins(lengths, 20)


def test_exchange_between_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 64)
    rng = random.Random(4)
    lengths = [rng.choice([rng.randint(1, 100), rng.randint(30, 60), 51]) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(lengths)), "item long, length long").repartition(4)
    rows = pack(df, 100).collect()
    assert sorted(r.item for r in rows) == list(range(1500))
    n = check_places([(r.sequence_id, r.offset, lengths[r.item]) for r in rows], 100)
    alone = best_fit(np.array(lengths), 100)[0].max() + 1
    assert rows[0].bound <= n <= alone + 0.02 * alone
    assert pack(df.limit(0), 100).count() == 0


def test_groups_above_their_mean_keep_sequences_apart(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 64)
    df = spark.range(1500).select("id", (F.col("id") * 0 + 60).alias("length")).toDF("item", "length")
    rows = pack(df, 100).collect()
    assert len({r.sequence_id for r in rows}) == 1500 and {r.offset for r in rows} == {0}


def test_empty_nulls_repeats(spark):
    none = spark.createDataFrame([], "doc_id long, text string, piece int")
    assert token_pieces(none, "text", PATH, ["doc_id", "piece"]).count() == 0
    df = spark.createDataFrame([(None, None, 5), (1, "a b", 5), (1, "a b", 5)], "doc_id long, text string, ids int")
    rows = token_pieces(df, "text", PATH, ["doc_id", "ids"]).collect()
    assert sorted(r.length for r in rows) == [1, 3, 3] and len({r.item for r in rows}) == 3


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op5_best_fit_packing"](spark, sf).collect()
    n = check_places([(r.sequence_id, r.offset, r.length) for r in rows], 4096)
    assert n <= rows[0].bound + 1
    ids = dict(zip(docs, whole(docs.values())))
    seen = {d: 0 for d in docs}
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.start == 4096 * r.piece and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        seen[r.doc_id] += r.length
    assert seen == {d: len(x) for d, x in ids.items()}
