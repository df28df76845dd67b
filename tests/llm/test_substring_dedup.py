"""Repeated windows against a dictionary of all windows."""

import hashlib
import random
import re
from collections import Counter

from cadenza.llm.queries import QUERIES
from cadenza.llm.substring_dedup import remove_repeats


def brute(texts, window):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def check(spark, texts, window, anchor, parts=3):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    got = {r.row.doc_id: (r.n_words, r.n_removed, r.kept_text, r.spans) for r in
           remove_repeats(df, "text", ["doc_id"], window, anchor).collect()}
    for i, want in enumerate(brute(texts, window)):
        assert got[i][:3] == want, i
        assert sum(s.end - s.start for s in got[i][3]) == want[1]


def test_random_texts_with_shared_passages(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    passage = [[rng.choice(vocab) for _ in range(60)] for _ in range(6)]
    texts = []
    for _ in range(150):
        out = []
        for _ in range(rng.randint(0, 4)):
            out += [rng.choice(vocab) for _ in range(rng.randint(0, 40))]
            p = rng.choice(passage)
            a = rng.randint(0, 30)
            out += p[a:a + rng.randint(5, 60)]
        texts.append(rng.choice([" ", "\n", " \t"]).join(out))
    check(spark, texts, 35, 12)
    check(spark, texts, 10, 3)
    check(spark, texts, 10, 10)


def test_tiny_alphabet_and_self_repeats(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    check(spark, [*texts, "a " * 500, "", None, "a " * 34, "x y \x0bz q " * 3, "b " * 20000], 8, 3)


def test_factors_that_meet_at_a_boundary(spark):
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    texts = [" ".join(a), " ".join(b), " ".join(a + b), " ".join(a[20:] + b[:20]), "A0 " + " ".join(a[1:])]
    check(spark, texts, 35, 12)


def test_empty_and_columns_with_clashing_names(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string"), "text").count() == 0
    df = spark.createDataFrame([(1, "p " * 40, "x", None), (1, "p " * 40, "x", 2)], "n_words long, text string, row string, kept_text long")
    rows = remove_repeats(df, "text", window=35).collect()
    assert [r.n_removed for r in rows] == [40, 40] and {r.row.kept_text for r in rows} == {None, 2}


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = {d.doc_id: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, (n, k, t) in zip(docs, brute([d.text for d in docs], 35))}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op9_substring_dedup"](spark, sf).collect()}
    assert got == want and any(k for _, k, _ in want.values())
