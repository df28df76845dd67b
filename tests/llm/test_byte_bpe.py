"""Byte-level BPE against the tokenizers library, over whole texts and single words."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cadenza.llm import byte_bpe, queries as Q
from cadenza.llm.byte_bpe import ByteBPE, decode, encode

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return ByteBPE(PATH, P.PATTERN)


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def wanted(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


TEXTS = [None, "", " ", "\n\n  \t", "It's we'll THEY'RE 'S 'sx", "a  b   c \n d  ", "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>",
         "<|endoftext|", "naïve Straße 你好 🙂👩‍👩‍👧 \u2581 \u00a0\u3000x \x1c\x1d", "１２3 ²½ a1b2", "\x00\ufffd", "a" * 3000, "ab" * 2500 + " x",
         "!?" * 400, " " * 1000 + "end", "word " * 30000]


def test_texts(spark, library):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(3, TEXTS[4], "clash"), (None, "null id", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    enc = encode(df, "text", PATH, P.PATTERN, ["doc_id", "text", "ids"])
    out = enc.collect()
    assert len(out) == len(rows)
    for r in out:
        assert ids(r.ids) == wanted(library, r.row.text) and r.n_tokens == len(r.ids) // 4
    back = decode(enc, "ids", PATH, P.PATTERN, ["row"]).collect()
    assert len(back) == len(rows) and all(r.text == (r.row.row.text or "") for r in back)


def test_empty_table_and_null_ids(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert encode(df, "text", PATH, P.PATTERN, ["doc_id"]).count() == 0
    none = spark.createDataFrame([(None,)], "x binary")
    assert [r.text for r in decode(none, "x", PATH, P.PATTERN, []).collect()] == [""]


def test_every_kind_of_character(own, library):
    texts = [f"a{x}b 1{x}2 {x}{x} !{x}? {x}" for c in range(0, 0x110000, 211) if not 0xD800 <= c < 0xE000 for x in [chr(c)]]
    got = own.encode(texts)
    assert all(ids(g) == e.ids for g, e in zip(got, library.encode_batch(texts, add_special_tokens=False)))


def test_scans_and_heap_agree(own, library):
    rng = random.Random(3)
    pieces = [t.decode("utf-8", "ignore").strip() for t in own.token[:50000]]
    words = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 7))).encode() or b"x" for _ in range(3000)]
    short = [w for w in words if len(w) <= byte_bpe.SHORT]
    for w, got in zip(short, own.merge_short(short)):
        assert got == own.merge_long(w)
    assert own.merge_short([]) == []


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text(text):
    own, library = ANY
    assert ids(own.encode([text])[0]) == wanted(library, text)
    assert own.decode(own.encode([text])) == [text]


ANY = ByteBPE(PATH, P.PATTERN), Tokenizer.from_file(PATH)


def test_added_tokens_as_plain_text(own):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    text = "x<|endoftext|> y"
    assert ids(own.encode([text], added=False)[0]) == plain.encode(text, add_special_tokens=False).ids


def test_decode_of_broken_characters(own, library):
    # ids that cut a character: the rest becomes U+FFFD, as in the library
    for text in ("🙂x", "你好"):
        whole = ids(own.encode([text])[0])
        for cut in range(len(whole)):
            some = whole[:cut] + whole[cut + 1:]
            assert own.decode([np.array(some, "<u4").tobytes()]) == [library.decode(some, skip_special_tokens=False)]


def test_memory_bound(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    monkeypatch.setattr(byte_bpe, "RUN", 10)
    small = ByteBPE(PATH, P.PATTERN)
    texts = ["one two three four five", "six one seven", "eight nine two"] * 3
    assert [ids(x) for x in small.encode(texts)] == [wanted(library, t) for t in texts]
    assert len(small._known) <= 10


def test_query_on_the_small_table(spark, library):
    from tests.conftest import SMALL
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = Q.op11_byte_bpe(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = wanted(library, docs[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
