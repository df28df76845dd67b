"""Spaced seeds against every alignment of every document and item."""

import random
import re
from collections import Counter

from cadenza.llm import decontaminate as D
from cadenza.llm.decontaminate import MASKS, PENALTY, SPAN, overlaps, without_overlaps
from cadenza.llm.queries import QUERIES


def split(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def planted(rng, vocab, items):
    texts = []
    for _ in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        if rng.random() < .6:
            p = split(rng.choice(items))
            p = p[rng.randint(0, 3):] if rng.random() < .4 else p
            p = [x if rng.random() > .1 else "changed" for x in p]
            at = rng.randint(0, len(w))
            w[at:at] = p
        texts.append(rng.choice([" ", ", "]).join(w).title())
    return texts


def test_matches_every_alignment(spark, monkeypatch):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(vocab) for _ in range(n)) for n in (5, 10, 12, 15, 20, 30, 40, 50)]
    items += [items[4], None, ""]
    texts = planted(rng, vocab, [i for i in items if i]) + [None, "", "a " * 3000, items[5], items[5]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(d, i, *r) for d, text in enumerate(texts) for i, item in enumerate(items) for r in every_run(text, item)}
    assert len({w[0] for w in want}) > 15
    for limit in (D.BROADCAST_SEEDS, 0):
        monkeypatch.setattr(D, "BROADCAST_SEEDS", limit)
        rows = overlaps(docs, "text", bench, "item_id", "text", ["doc_id"]).collect()
        got = {(r.row.doc_id, r.item_id, r.doc_start, r.doc_end, r.item_start, r.item_end, r.n_words, r.n_matches) for r in rows}
        assert got == want and len(rows) == len(want)
    clean = {r.doc_id for r in without_overlaps(docs, "text", bench, "item_id", "text").collect()}
    assert clean == set(range(len(texts))) - {w[0] for w in want}


def test_empty_tables_nulls_and_clashing_names(spark):
    docs = spark.createDataFrame([(None, " ".join(map(str, range(30))), 1)] * 2, "text_key long, text string, item_id long")
    bench = spark.createDataFrame([(None, " ".join(map(str, range(5, 25))))], "item_id long, text string")
    rows = overlaps(docs, "text", bench, "item_id", "text", ["text_key", "item_id"]).collect()
    assert [(r.row.item_id, r.item_id, r.doc_start, r.n_matches) for r in rows] == [(1, None, 5, 20)] * 2
    assert overlaps(docs.limit(0), "text", bench, "item_id", "text", ["item_id"]).count() == 0
    assert overlaps(docs, "text", bench.limit(0), "item_id", "text", ["item_id"]).count() == 0
    assert without_overlaps(docs, "text", bench.limit(0), "item_id", "text").columns == docs.columns


def test_query_matches_every_alignment(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    sets = [set(split(i.text)) for i in items]
    want = {(d.doc_id, i.item_id, *r) for d in docs for i, s in zip(items, sets)
            if len(s & set(split(d.text))) >= min(len(s), 5) for r in every_run(d.text, i.text)}
    got = {tuple(r) for r in QUERIES["op8_decontamination"](spark, sf).collect()}
    assert got == want and want


def every_run(doc, item, min_words=13):
    """All runs of every alignment, without masks: the best of at least ``least`` words, then of what lies before and behind."""
    d, t = split(doc), split(item)
    least, out = min(min_words, len(t)), set()

    def best(same, a, b):
        top = (0, 0, 0)
        sums = [0]
        for x in same[a:b]:
            sums.append(sums[-1] + (1 if x else -PENALTY))
        for stop in range(least, b - a + 1):
            for start in range(stop - least, -1, -1):
                if sums[stop] - sums[start] > top[0]:
                    top = (sums[stop] - sums[start], a + start, a + stop)
        return top

    for shift in range(least - len(t), len(d) - least + 1) if least else ():
        lo, hi = max(0, -shift), min(len(t), len(d) - shift)
        same, todo = [t[j] == d[j + shift] for j in range(lo, hi)], [(0, hi - lo)]
        while todo:
            a, b = todo.pop()
            score, start, stop = best(same, a, b)
            if score and (len(t) >= SPAN or stop - start == sum(same[start:stop])):
                out.add((lo + start + shift, lo + stop + shift, lo + start, lo + stop, stop - start, sum(same[start:stop])))
                todo += [(a, start), (stop, b)]
    return out


def check_every_run(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(d, i, *r) for d, text in enumerate(texts) for i, item in enumerate(items) for r in every_run(text, item)}
    rows = overlaps(docs, "text", bench, "item_id", "text", ["doc_id"]).collect()
    assert {(r.row.doc_id, *r[1:]) for r in rows} == want and len(rows) == len(want)
    clean = {r.doc_id for r in without_overlaps(docs, "text", bench, "item_id", "text").collect()}
    assert clean == set(range(len(texts))) - {w[0] for w in want}
    return want


def changed(words, *places):
    return " ".join("other" if i in places else w for i, w in enumerate(words))


def test_any_words_changed_within_tolerance_are_found(spark):
    long = [f"w{i}" for i in range(40)]
    items = [long[:n] for n in (9, 10, 13, 14, 15, 16, 18)]
    texts = [f"x{k} " + changed(t, k) for t in items[1:] for k in range(len(t))] + \
        [changed(t, k, k + 1) for t in items[1:] for k in range(len(t) - 1)] + [changed(items[2], a, b, 12) for a in range(6) for b in range(6, 12)] + \
        ["y " + " ".join(items[0])]
    for n in (9, 13, 15, 18):
        item = " ".join(long[:n])
        want = check_every_run(spark, texts, [item])
        same = [i for i, t in enumerate(texts) if every_run(t, item)]
        assert len({w[0] for w in want}) == len(same) > 0


def test_every_disjoint_run_of_an_alignment(spark):
    item = [f"w{i}" for i in range(60)]
    texts = [changed(item, 12, 13, 14, 15, 16, 20), changed(item, *range(20, 30)), changed(item, *range(14, 22), *range(40, 46))]
    want = check_every_run(spark, texts, [" ".join(item)])
    assert Counter(w[0] for w in want)[1] == 2 and Counter(w[0] for w in want)[2] == 3


def test_masks_miss_no_run_of_positive_score():
    """Every placement of the most substitutions that 10 to 22 words can hold; fewer leave more windows clear."""
    from itertools import combinations
    masks = [sum(1 << i for i, c in enumerate(m) if c == "1") for m in MASKS]
    for n in range(SPAN, 2 * SPAN + 3):
        kept = [m << at for m in masks for at in range(n - SPAN + 1)]
        for places in combinations(range(n), (n - 1) // (1 + PENALTY)):
            bad = sum(1 << i for i in places)
            assert any(not bad & k for k in kept), (n, places)


def test_sifted_windows_and_all_windows_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(40)]
    items = [" ".join(rng.choice(vocab[:25]) for _ in range(n)) for n in (10, 17, 18, 30)]
    texts = planted(rng, vocab, items) + [changed(split(items[1]), 7, 8, 9, 10), changed(split(items[2]), 7, 8, 9, 11)]
    want = check_every_run(spark, texts, items)
    assert {60, 61} <= {w[0] for w in want}
    monkeypatch.setattr(D, "SIFTING_WORDS", 0)
    assert check_every_run(spark, texts, items) == want
