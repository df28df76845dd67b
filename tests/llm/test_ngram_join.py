"""Components of the shingle join against all pairs."""

import random
import re

import pytest

from cadenza.llm import ngram_join
from cadenza.llm.components import components
from cadenza.llm.ngram_join import jaccard_components
from cadenza.llm.queries import QUERIES


def shingles(text, k):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(ids, texts, k, num, den):
    sets = [shingles(t, k) for t in texts]
    comp = list(range(len(sets)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                comp[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(len(s), least.get(root(i))) for i, s in enumerate(sets)]


def near_copies(rng, n, vocab=300):
    base = [[f"v{rng.randrange(vocab)}" for _ in range(rng.randint(1, 80))] for _ in range(8)]
    texts = []
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"V{rng.randrange(vocab)}"
        if rng.random() < .2:
            w += [f"v{rng.randrange(vocab)}" for _ in range(rng.randint(1, 6))]
        texts.append(" ".join(w))
    return texts + ["", None, "a", "A", "a b", "B a", " \n"]


@pytest.mark.parametrize("k,num,group", [(3, 90, 1024), (5, 80, 1024), (2, 60, 8), (3, 90, 8)])
def test_random_near_copies(spark, monkeypatch, k, num, group):
    monkeypatch.setattr(ngram_join, "GROUP", group)
    rng = random.Random(k * num)
    texts = near_copies(rng, 150)
    ids = [rng.randrange(1000) if rng.random() < .97 else None for _ in texts]      # repeats and nulls among the ids
    df = spark.createDataFrame(list(zip(range(len(texts)), ids, texts)), "at long, doc_id long, text string").repartition(3)
    rows = jaccard_components(df, "doc_id", "text", k, num, 100, carry=["at"]).collect()
    want = brute(ids, texts, k, num, 100)
    assert len(rows) == len(texts)
    for r in rows:
        n, c = want[r.row.at]
        assert (r.n_shingles, r.component_id) == (n, c if n else ids[r.row.at]), texts[r.row.at]
    # one row of each group stays; rows without shingles all stay
    groups = {}
    for r in rows:
        groups.setdefault((r.component_id, r.n_shingles > 0), []).append(r.first)


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string"), "doc_id").count() == 0


def test_clashing_columns_and_equal_rows(spark):
    df = spark.createDataFrame([(7, "a b c d e f", 1)] * 3 + [(3, "x", 1)], "doc_id long, text string, n_shingles long")
    rows = jaccard_components(df, "doc_id", carry=["n_shingles", "text"]).collect()
    assert sum(r.first for r in rows) == 2 and {r.component_id for r in rows} == {7, 3}


def test_query_matches_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {d.doc_id: w for d, w in zip(docs, brute([d.doc_id for d in docs], [d.text for d in docs], 3, 90, 100))}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op7_ngram_join"](spark, sf).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(want)


def test_rounds_of_few_edges_need_few_tasks(spark, monkeypatch):
    """Labels against a search by hand; rounds must not run a task for each shuffle partition and exchange."""
    rng = random.Random(8)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(500 + i, 501 + i) for i in range(90)] + [(700, 700 + i) for i in range(150)]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for n in sorted(x for a, b in edges if a != b for x in (a, b)):
        todo = [n]
        while todo and n not in want:
            seen = {n}
            while todo:
                todo.extend(y for y in near[todo.pop()] if y not in seen and not seen.add(y))
            want.update((x, n) for x in seen)
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, tracker = {k: spark.conf.get(k) for k in conf}, spark.sparkContext.statusTracker()
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.createDataFrame(edges, "a long, b long").localCheckpoint()
        for size in (200_000, 100):                # one task, then several
            monkeypatch.setattr("cadenza.llm.components.EDGES", size)
            spark.sparkContext.setJobGroup(group := f"components-{size}", "")
            got = {r.node: r.label for r in components(df).collect()}
            stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
            tasks = sum(i.numTasks for s in stages if (i := tracker.getStageInfo(s)) and i.numCompletedTasks)
            assert got == want
            assert size < 200_000 or tasks < 60 * 8, tasks
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
