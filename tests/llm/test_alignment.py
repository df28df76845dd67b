"""Token alignment against a plain walk over the bytes of both libraries' own encodings."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cadenza.llm import alignment as A, queries as Q
from cadenza.llm.byte_bpe import byte_letters

PATH_A, PATH_B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def tokens(libraries, text):
    """[(id, bytes)] of A and of B; none if they do not give back a space and the text."""
    first, second = libraries
    if not text:
        return [], []
    letter = byte_letters()
    a = [(i, bytes(letter[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        p = second.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("\u2581", " ").encode()))
    raw = (" " + text).encode()
    if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return [], []
    return a, b


def spans(ts):
    at, out = 0, []
    for i, x in ts:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(libraries, texts):
    """Per text: (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links, links)."""
    seen = []
    for text in texts:
        a, b = map(spans, tokens(libraries, text))
        held = [(x, y) for x, (_, s, e) in enumerate(a) for y, (_, t, f) in enumerate(b) if s < f and t < e] if len(a) < 300 else None
        if held is None:                                  # byte by byte, for long texts
            own = [x for x, (_, s, e) in enumerate(a) for _ in range(s, e)], [y for y, (_, s, e) in enumerate(b) for _ in range(s, e)]
            held = sorted(set(zip(*own)))
        groups, ga, gb, cuts = [], [], [], {e for *_, e in a} & {e for *_, e in b}
        y = 0
        for i, _, e in a:
            ga.append(i)
            if e in cuts:
                while True:
                    gb.append(b[y][0])
                    y += 1
                    if b[y - 1][2] == e:
                        break
                groups.append((ga, gb))
                ga, gb = [], []
        seen.append((a, b, held, groups))
    count = Counter(p for a, b, held, _ in seen for p in {(a[x][0], b[y][0]) for x, y in held})
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for a, b, held, groups in seen:
        got = [count[a[x][0], b[y][0]] for x, y in held]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((len(a), len(b), len(groups), len(held), sum(n == best[a[x][0]] for n, (x, _) in zip(got, held)), sum(got),
                    hashlib.sha256(text.encode()).hexdigest() if a else "", sum(len(p) * len(q) for p, q in groups), held))
    return out


rng = random.Random(5)
WORDS = ["alpha", "Ärger", "straße", "It's", "x=1;", "2024", "你好世界", "🙂", "foo\nbar", "\t", "don't)", "unbelievable", "   ", "\n\n"]
TEXTS = [None, "", " ", "  ", "a", " a", "a ", "\n", "a\n b\n  c\r\n", "x \u2581 y", "\u2581", "<0x41> <s> </s> <unk> <|endoftext|>", "\x00\x1c \x1d",
         "e\u0301 \ufb01 \u00a0 \u3000x", "a" * 700, "ab " * 900, "\u4e00" * 50, "same text", "same text", "word " * 40000] + [
         " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 60))) for _ in range(60)]


@pytest.mark.parametrize("block_text", [A.BLOCK_TEXT, 500])
def test_against_a_walk(spark, libraries, monkeypatch, block_text):
    monkeypatch.setattr(A, "BLOCK_TEXT", block_text)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_a string").repartition(3)
    rows = {r.row.doc_id: r for r in A.align(df, "text", PATH_A, P.PATTERN, PATH_B, ["doc_id", "n_a"], keep=("groups", "links")).collect()}
    assert len(rows) == len(TEXTS)
    for i, (want, text) in enumerate(zip(brute(libraries, TEXTS), TEXTS)):
        r = rows[i]
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "")
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.n_group_links) == want[:8], repr(text[:40])
        assert list(zip(r.link_a, r.link_b)) == want[8]
        assert r.row.n_a == "clash"


def test_products_of_any_matrices(monkeypatch):
    g = np.random.default_rng(2)
    for size in (A.PRODUCT, 3):
        monkeypatch.setattr(A, "PRODUCT", size)
        for _ in range(20):
            x, y = g.integers(0, 2, (g.integers(1, 9), 7)), g.integers(0, 2, (7, g.integers(1, 6)))
            csr = [A.CSR(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1], m.shape[1]) for m in (x, y)]
            got = np.zeros((len(x), y.shape[1]), int)
            for at, part in A.products(*csr):
                row = at + np.repeat(np.arange(part.rows), np.diff(part.ptr))
                got[row, part.col] = part.values
            assert (got == x @ y).all()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert A.align(df, "text", PATH_A, P.PATTERN, PATH_B, ["doc_id"]).count() == 0


def test_query_on_the_small_table(spark, libraries):
    from tests.conftest import SMALL
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = {d: w[:8] for (d, _), w in zip(docs, brute(libraries, [t for _, t in docs]))}
    rows = Q.op13_alignment(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.n_group_links) == want[r.doc_id]


def test_numbers_of_a_block_are_compressed():
    """A block's numbers travel compressed and come back whole, empty ones too."""
    from cadenza.llm.alignment import _planes, _unplanes
    x = np.arange(100_000) % 300
    assert len(_planes(x)) < 4 * len(x) // 3
    for y in (x, x[:0], np.array([2 ** 32 - 1])):
        assert _unplanes(_planes(y)).tolist() == y.tolist()
