"""Cascades over table graphs, link loads, unseen items, preference vectors and the Smooth-L1 fit, against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.functions import preferences as P
from cadenza.functions.ids import surrogate_id
from cadenza.operators import derived as D, recommend as R, regress as G, warehouse as W


def test_cascade_reaches_grandchildren(spark):
    tables = {"track": spark.createDataFrame([(1,), (2,), (3,)], "track long"),
              "comment": spark.createDataFrame([(10, 1), (11, 2), (12, None)], "comment long, track long"),
              "reply": spark.createDataFrame([(100, 10, None), (101, 11, None), (102, 11, 1), (103, None, 3)], "reply long, comment long, track long"),
              "other": spark.createDataFrame([(1,)], "x long")}
    references = [("reply", "comment", "comment", "comment"), ("comment", "track", "track", "track"), ("reply", "track", "track", "track"),
                  ("other", "x", "elsewhere", "x")]
    left = D.cascade_delete_tables(tables, references, "track", spark.createDataFrame([(1,), (1,), (None,)], "track long"))
    assert {n: sorted(r[0] for r in df.collect()) for n, df in left.items()} == {"track": [2, 3], "comment": [11, 12], "reply": [101, 103]}


def test_cascade_refuses_cycles(spark):
    t = spark.createDataFrame([(1, 1)], "a long, b long")
    with pytest.raises(ValueError, match="cycle"):
        D.cascade_delete_tables({"r": t, "x": t, "y": t}, [("x", "a", "r", "a"), ("x", "b", "y", "b"), ("y", "a", "x", "a")], "r", t.select("a"))


def test_track_links(spark):
    tracks = spark.createDataFrame([(1, 5, 7, "['3', ' 4', '3', '99']", "['6', '5']"), (2, 8, 7, "['3']", "[]"), (3, 5, None, None, None),
                                    (4, None, 7, "['3']", "['5']"), (1, 5, 7, "['3', ' 4', '3', '99']", "['6', '5']")],
                                   "track long, artist long, album long, genres string, featured string")
    links = W.load_track_links(tracks, "track", "artist", "album", spark.createDataFrame([(5,), (6,), (None,)], "k long"), "k",
                               spark.createDataFrame([(7,)], "k long"), "k", spark.createDataFrame([(3,), (4,)], "k long"), "k", "genres", "featured")

    def ids(kind, values):
        return {v: spark.range(1).select(surrogate_id(kind, F.lit(v))).first()[0] for v in values}

    t, a, g, al = ids("track", [1, 3]), ids("artist", [5, 6]), ids("genre", [3, 4]), ids("album", [7])
    assert {tuple(r) for r in links["track_artist"].collect()} == {(t[1], a[5], "main"), (t[1], a[6], "feat"), (t[1], a[5], "feat"), (t[3], a[5], "main")}
    assert [tuple(r) for r in links["album_artist"].collect()] == [(al[7], a[5])]
    assert sorted(map(tuple, links["track_genre"].collect())) == sorted([(t[1], g[3]), (t[1], g[4])])


def test_unseen_item_is_transformed_by_the_fitted_state(spark):
    items = spark.createDataFrame([(1, "red moon", 2.0), (2, "red sun", 4.0), (3, None, None)], "k long, title string, x double")
    fitted = R.fit_items(items, "k", {"titles": "title"}, ["x"])
    terms, vec = fitted.transform({"titles": "Red red comet", "x": None})
    got = {(r.comp, r.term): r.qw for r in terms.collect()}
    assert list(got) == [("titles", "red")] and math.isclose(got["titles", "red"], 2 * (math.log(4 / 3) + 1))
    mean, sd = 2.0, np.std([2.0, 4.0, 0.0])
    assert np.allclose(vec, [(0 - mean) / sd])
    rows = R.payload_similarity(fitted, {"titles": "sun"}, audio_weight=0.0, top_n=1).collect()
    assert rows[0].k == 2 and rows[0].score > 0
    none = R.payload_similarity(fitted, {}, audio_weight=0.0).collect()
    assert [r.score for r in none] == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        R.payload_similarity(fitted, {}, audio_weight=1.5)


def test_preference_vector_layout(spark):
    slots = P.vector_slots()
    assert len(slots) == 71 and len(P.PROFILE_ATTRIBUTES) == 15
    cols = list(dict.fromkeys(c for c, _ in P.VECTOR_SLOTS))
    row = {c: None for c in cols} | {"age_range": "65 ans et +", "gender": "femme", "frequency": "+ d'une fois par mois", "duration_pref": "11",
                                     "energy_pref": "avec des paroles,  inconnu", "how": "['cd', \"radio\"]", "platform": "[]", "position": "inconnue"}
    df = spark.createDataFrame([(1, *[row[c] for c in cols])], "id long, " + ", ".join(f"{c} string" for c in cols))
    vec = R.preference_vector(P.several_answers(df), "id", slots).first().vector
    want = [0.0] * 71
    names = [c for c, _ in P.VECTOR_SLOTS]
    for c, label in (("gender", "femme"), ("energy_pref", "avec des paroles"), ("how", "cd"), ("how", "radio")):
        want[next(i for i, (n, m) in enumerate(P.VECTOR_SLOTS) if n == c and m and label in m)] = 1.0
    want[names.index("age_range")] = 1.0
    want[names.index("frequency")] = 1.0
    want[names.index("duration_pref")] = 1.0
    assert vec == want


def test_smooth_l1_against_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    y = x @ [1.5, -2.0, 0.3] + 0.7 + rng.standard_t(1.5, 400)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)] + [(None, 1.0, 1.0, 1.0)], "a double, b double, c double, label double")
    fit = G.fit_smooth_l1(df, ["a", "b", "c"])
    one = np.c_[x, np.ones(400)]
    beta = np.zeros(4)
    for _ in range(20000):
        beta += 0.3 * one.T @ np.clip(y - one @ beta, -1, 1) / 400
    e = np.abs(y - one @ beta)
    loss = np.where(e < 1, e * e / 2, e - 0.5).mean()
    assert np.allclose([*fit.coefficients, fit.intercept], beta, atol=1e-5)
    assert math.isclose(fit.loss, loss, rel_tol=1e-9) and fit.passes < 100
    with pytest.raises(ValueError):
        G.fit_smooth_l1(df.filter("false"), ["a"])


def test_smooth_l1_with_dependent_columns(spark):
    random.seed(1)
    rows = [(float(i), 2.0 * i, 1.0, 3.0 * i + 1) for i in range(20)]
    fit = G.fit_smooth_l1(spark.createDataFrame(rows, "a double, b double, c double, label double"), ["a", "b", "c"])
    assert fit.loss < 1e-9


def test_fallback_tier_ranks_every_candidate(spark, tmp_path):
    """All parts of the target's genre come back, however many; a limit picks among equal scores by the seeded hash."""
    from cadenza.functions.ids import uniform_noise
    from cadenza.plans.jobs import fallback_genre_tier
    spark.createDataFrame([(i, "A" if i < 40 else "B") for i in range(60)], "p_partkey long, p_type string") \
        .write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(i % 7, i % 60) for i in range(120)], "l_orderkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = fallback_genre_tier(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in rows) == [(i, 7.0, 3) for i in range(40)]

    items = spark.createDataFrame([(i, "A") for i in range(30)], "i long, genre string")
    none = spark.createDataFrame([], "u long, i long, c long")
    prefs, target = spark.createDataFrame([(1, "A")], "u long, genre string"), spark.createDataFrame([("A",)], "genre string")
    similar = spark.createDataFrame([], "u long, score int")

    def ranked(top_n):
        out = R.fallback_recommend(none, similar, items, prefs, 9, target, user="u", item="i", count="c", top_n=top_n, seed=3)
        return [r.i for r in out.collect()]
    want = [r.i for r in items.orderBy(uniform_noise("i", 3), "i").collect()]
    assert ranked(None) == want and sorted(ranked(4)) == sorted(want[:4])


def test_vector_slots_are_computed_once(spark, tmp_path):
    """No filter repeats the vector's expressions, and the rows of one small file are spread over tasks."""
    from cadenza.plans import common
    from cadenza.plans.recommend import preference_vector, survey_vector
    spark.createDataFrame([(i, "BUILDING", 0, 1.0) for i in range(30)], "c_custkey long, c_mktsegment string, c_nationkey int, c_acctbal double") \
        .coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(0, 1)], "n_nationkey int, n_regionkey int").write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame([(1, 2, "2-HIGH", "1999-01-01")], "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate string") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    for query, slots in ((survey_vector, 71), (preference_vector, 9)):
        df = query(spark, str(tmp_path))
        assert "size(array(" not in df._jdf.queryExecution().optimizedPlan().toString()
        assert df.count() == 30 * slots
    assert common.spread(spark.read.parquet(str(tmp_path / "customer.parquet")), 10).rdd.getNumPartitions() == 3


def test_lines_of_parts_lie_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    """The partitions of a part's names and of the postings grow with the rows; a frequent term is no task of its own."""
    from cadenza import session
    from cadenza.plans import recommend as PR
    assert [session.tasks_for(n, 100) for n in (0, 1, 100, 101, 1000)] == [1, 1, 1, 2, 10]
    few = lambda rows, each=None: session.tasks_for(rows, 10)                       # noqa: E731
    monkeypatch.setattr(PR, "tasks_for", few)
    monkeypatch.setattr(R, "tasks_for", few)
    spark.createDataFrame([(i, i % 3) for i in range(50)] + [(None, 1), (4, None)], "l_partkey long, l_suppkey long") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(i, f"S{i}") for i in range(3)], "s_suppkey long, s_name string").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.createDataFrame([(i, "red ring" if i % 2 else None, "LARGE", i, 1.0) for i in range(50)],
                          "p_partkey long, p_name string, p_type string, p_size int, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    names = PR._artist_names(spark, str(tmp_path))
    assert names.rdd.getNumPartitions() == 6 and names.count() == 51
    out = PR.item_similarity_text(spark, str(tmp_path))
    assert "BroadcastHashJoin [comp" in out._jdf.queryExecution().sparkPlan().toString()
    assert len(out.collect()) == 20
