"""Language network: gradient against differences, states against a plain loop, held-out accuracy."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from cadenza.llm import lang_id as L
from cadenza.llm.queries import QUERIES


def small_net(seed=1):
    net = L.Network.fresh(["a", "b", "c"], 4, seed)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(seed)
    for k in net.p:
        net.p[k] += rng.normal(0, 0.1, net.p[k].shape)
    return net


def plain_positions(net, word):
    """The recurrence written out for one word."""
    def sig(x):
        return 1 / (1 + np.exp(-x))
    states = {}
    for d in "fb":
        h, n = np.zeros(4), 4
        for t in range(len(word)) if d == "f" else reversed(range(len(word))):
            x, a = net.p[f"table_{d}"][word[t]] + net.p[f"bias_{d}"], h @ net.p[f"u_{d}"]
            z, r = sig(x[:n] + a[:n]), sig(x[n:2 * n] + a[n:2 * n])
            c = np.tanh(x[2 * n:] + r * (a[2 * n:] + net.p[f"inner_{d}"]))
            h = z * h + (1 - z) * c
            states[d, t] = h
    out = [np.concatenate([states["f", t], states["b", t]]) @ net.p["out"] + net.p["out_bias"] for t in range(len(word))]
    return np.array([y - np.log(np.exp(y).sum()) for y in out])


def test_positions_match_a_plain_loop():
    net, words = small_net(), [b"x", b"hello", b"\xc3\xa9t\xc3\xa9", b"abcdefghij"]
    ids, lengths = L.padded(words)
    got = net.positions(ids, lengths)
    for i, w in enumerate(words):
        assert np.allclose(got[:len(w), i], plain_positions(net, w), atol=1e-6)
    assert np.allclose(net.word_sums(words), [plain_positions(net, w).sum(0) for w in words], atol=1e-4)


def test_backpropagation_matches_differences():
    net, (ids, lengths) = small_net(2), L.padded([b"ab", b"bcab", b"a"])
    label = np.array([0, 2, 1])
    _, g = net.gradient(ids, lengths, label)
    rng = np.random.default_rng(0)
    for k, v in net.p.items():
        spots = [(ids[1, 1], 3)] if k.startswith("table") else [tuple(rng.integers(0, n) for n in v.shape)]
        for spot in spots:
            eps, keep = 1e-4, v[spot]
            v[spot] = keep + eps
            up, _ = net.gradient(ids, lengths, label)
            v[spot] = keep - eps
            down, _ = net.gradient(ids, lengths, label)
            v[spot] = keep
            assert math.isclose((up - down) / (2 * eps), g[k][spot], rel_tol=2e-2, abs_tol=2e-5), k


def test_query_learns_and_predicts(spark):
    sf = "/root/testdata/sf0.01"
    docs = {d.doc_id: d for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op6_language_id"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    names = {d.lang for d in docs.values()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        letters = any(c.isalpha() for c in docs[r.doc_id].text or "")
        assert r.lang_pred in names if letters else (r.lang_pred, r.score) == ("und", 0)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_edge_cases(spark):
    rows = [(1, "der die das und nicht " * 40, "de"), (2, "the of and is that " * 40, "en"), (2, "the of and is that " * 40, "en"),
            (3, None, "de"), (4, "", "en"), (5, "123 ... \n", "en"), (None, "unter die", None), (6, "x" * 5000 + " and", None), (7, "漢字 Ω", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("mine"))
    name = F.col("doc_id").cast("string")
    net = L.train(df, "text", "lang", F.md5(name))
    got = L.predict(df, "text", net, ["doc_id", "score"]).collect()
    by = {r.row.doc_id: r for r in got}
    assert len(got) == 9 and by[1].lang_pred == "de" and by[2].lang_pred == "en" and by[None].lang_pred == "de"
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].labels == [] for i in (3, 4, 5))
    assert by[7].lang_pred in ("de", "en") and by[6].row.score == "mine"
    assert abs(sum(x.prob for x in by[1].labels) - 1) < 1e-9
    assert L.train(df.filter("doc_id > 2"), "text", "lang", F.md5(name)) is None
    assert {r.lang_pred for r in L.predict(df, "text", None, ["doc_id"]).collect()} == {"und"}
    assert L.predict(df.limit(0), "text", net, ["doc_id"]).count() == 0
