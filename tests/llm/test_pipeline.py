"""Every stage of the pipeline against brute force on its own input, and the edge cases of all."""

import random
from collections import Counter

import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontaminate import every_run as overlap
from tests.llm.test_ngram_join import brute as join
from tests.llm.test_packing import check_places
from tests.llm.test_substring_dedup import brute as repeats

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_are_right_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.columns
    before = docs.collect()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == columns, name
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        after = docs.collect()
        if name == "language_id":
            assert {r.doc_id for r in after} == {r.doc_id for r in before if any(map(str.isalpha, r.text))}
        elif name == "ngram_join":
            groups = join([r.doc_id for r in before], [r.text for r in before], 5, 80, 100)
            assert sorted(r.doc_id for r in after) == sorted({c if n else r.doc_id for r, (n, c) in zip(before, groups)})
        elif name == "substring_dedup":
            want = {r.doc_id: w for r, w in zip(before, repeats([r.text for r in before], 35))}
            old = {r.doc_id: r for r in before}
            assert {r.doc_id for r in after} == {d for d, (n, k, _) in want.items() if not k or k < n}
            for r in after:
                n, k, kept = want[r.doc_id]
                assert " ".join(r.text.split()) == kept if k else r.text == old[r.doc_id].text
                assert r.n_chars == len(r.text) and (r.lang, r.source) == (old[r.doc_id].lang, old[r.doc_id].source)
        elif name == "decontamination":
            assert {r.doc_id for r in after} == {r.doc_id for r in before if not any(overlap(r.text, t, 13) for t in items)}
            assert len(after) < len(before)
        if name in ("ngram_join", "decontamination"):
            old = {r.doc_id: r for r in before}
            assert all(r == old[r.doc_id] for r in after)
        if name == "packing":
            tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
            assert check_places([(r.sequence_id, r.offset, r.length) for r in after], 4096) <= after[0].bound + 1
            sizes = Counter()
            for r in after:
                sizes[r.doc_id] += r.length
            assert sizes == {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in before}
        before = after


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) > 50 and check_places([(r.sequence_id, r.offset, r.length) for r in rows], 4096) <= rows[0].bound + 1


def test_edge_cases_in_every_stage(spark):
    rng = random.Random(9)
    text = " ".join(rng.choice(["the", "of", "and", "is"]) + str(i) for i in range(60))
    rows = [(1, text, "en", "s", 9), (1, text, "en", "s", 9), (2, text, None, None, None), (None, text, "en", "s", 1), (None, "alone and other words", "en", None, 5),
            (3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, "12 34", "en", "s", 5), (6, "word " * 30000, "en", "s", 7), (7, "ein anderes und", "de", "s", 3)]
    df = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", n_words long").repartition(2)
    sizes = {"language_id": 7, "ngram_join": 7, "substring_dedup": 5, "decontamination": 10}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        assert name == "packing" or out.columns == df.columns
        n = out.count()
        assert name == "packing" or n == sizes[name], (name, n)
        empty = stage(spark, df.limit(0), SF)
        assert empty.count() == 0
