"""Inputs the test tables do not hold: quoted words, repeated tokens, bad text, NaN, extreme numbers, retried epochs."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.functions import standardise as S
from cadenza.functions.presets import SURVEY_RENAME, SURVEY_RULES
from cadenza.operators.charts import popularity_by_year
from cadenza.operators.quality import clean_table
from cadenza.operators.quantiles import exact_quantiles
from cadenza.operators.regress import fit_prep
from cadenza.operators.stats import correlation_matrix, impute_median
from cadenza.sources.csv import read_raw_csv, read_scoring_input
from cadenza.streaming import counters as C


def values(spark, fn, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, c string")
    return [r.v for r in df.select("i", fn("c").alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize("fn", [S.parse_py_list, S.normalize_tags, S.parse_python_list])
def test_literal_words_inside_quotes_stay(spark, fn):
    texts = ["['True Colors', 'None of us']", '["don\'t", "Not False"]', "['a', None, True]"]
    got = values(spark, fn, texts)
    assert got[0] == ["True Colors", "None of us"] and got[1] == ["don't", "Not False"]
    assert [x for x in got[2] if x is not None] == ["a", "true"]


def test_long_list_literal(spark):
    text = "[" + ", ".join(["'None of it'", "None"] * 3000) + "]"
    assert [x for x in values(spark, S.parse_py_list, [text])[0] if x] == ["None of it"] * 3000


def test_stop_words_keep_term_counts(spark):
    assert values(spark, lambda c: S.tokenize(c, ["the", "and"]), ["The cat and the cat sat"]) == [["cat", "cat", "sat"]]


def test_bad_text_is_null_not_an_error(spark):
    assert values(spark, lambda c: S.age_years(c, "2020-01-01"), ["not a date", None]) == [None, None]
    df = spark.createDataFrame([("2001-05-01", "a", 3.0), ("nonsense", "a", 9.0), ("2001-01-01", "a", 5.0)], "d string, l string, m double")
    got = popularity_by_year(df, "l", "d", "m", agg="mean", min_year_count=1, smooth_window=1).collect()
    assert [(r.year, r.value) for r in got] == [(2001, 4.0)]
    meta = fit_prep(spark.createDataFrame([("1", 2.0), ("x", 1.0), ("3", 0.0)], "f string, y double"), ["f"], "y")
    assert meta.medians == {"f": 2.0}


def test_nan_is_missing_in_correlations(spark):
    rows = [(1.0, 2.0), (2.0, 4.5), (float("nan"), 5.0), (4.0, 7.0)]
    df = impute_median(spark.createDataFrame(rows, "a double, b double"), ["a", "b"])
    got, _ = correlation_matrix(df, ["a", "b"])
    assert np.isclose(got[0, 1], np.corrcoef([1, 2, 2, 4], [2, 4.5, 5, 7])[0, 1])


@pytest.mark.parametrize("data", [[1e308, -1e308, 5e-324, 0.0, 1e-300, 3.0], [1e16, 1e16 + 2, 1e16 + 4, 1e16 + 2], [float("inf"), 1.0, 2.0, float("-inf"), 2.0],
                                  [2.0 ** -k for k in range(200)], [7.0] * 50, [5e-324, 1e-323, 0.0]])
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 1.0])
def test_quantiles_of_extreme_values(spark, data, q):
    df = spark.createDataFrame([(x,) for x in data], "a double")
    ranked, place = sorted(data), (len(data) - 1) * q
    lo, hi = ranked[int(np.floor(place))], ranked[int(np.ceil(place))]
    want = lo if lo == hi else lo + (hi - lo) * (place - np.floor(place))
    assert exact_quantiles(df, ["a"], q, bins=4)["a"] == pytest.approx(want, nan_ok=True)


def test_survey_header_is_renamed_and_empty_selection_fails(spark):
    answers = {"created_at": "01/02/2024 10:00:00", "is_listening": "Oui", "when": "Matin", "duration": "inconnu"}
    raw = spark.createDataFrame([tuple(answers.get(v, "Oui") for v in SURVEY_RENAME.values())], list(SURVEY_RENAME))
    assert set(clean_table(raw, SURVEY_RULES).clean.columns) == set(SURVEY_RENAME.values())
    with pytest.raises(ValueError, match="no column"):
        clean_table(raw.toDF(*[f"x{i}" for i in range(len(raw.columns))]), SURVEY_RULES)


def test_csv_folder_header_and_stable_ids(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part-{i}.csv").write_text("track_date_created,b\n" + "".join(f"2020-01-0{i + 1},{j}\n" for j in range(5)))
    assert read_raw_csv(spark, str(tmp_path), 1).count() == 15
    one = str(tmp_path / "part-1.csv")
    first = sorted(map(tuple, read_scoring_input(spark, one).collect()))
    assert [r[-1] for r in first] == [f"csv_row_{i}" for i in range(5)] and first == sorted(map(tuple, read_scoring_input(spark, one).collect()))


def test_retried_epoch_keeps_all_keys(spark, tmp_path):
    """A crash between an epoch's manifest and Spark's commit: the epoch runs again and no stored row is lost."""
    flat, run = tmp_path / "in", tmp_path / "run"
    spark.range(100).selectExpr("id as item", "1L as n").coalesce(1).write.parquet(str(flat))

    def drain():
        stream = C.file_stream(spark, str(flat), "part-*.parquet", spark.read.parquet(str(flat)).schema, max_files=1)
        return C.run_upsert(stream.groupBy("item").agg(F.sum("n").alias("n")), ["item"], "t", run_dir=str(run), buckets=4)

    assert drain().count() == 100
    spark.createDataFrame([(0, 5)], "item long, n long").coalesce(1).write.mode("append").parquet(str(flat))
    assert {r.item: r.n for r in drain().collect()} == {i: 6 if i == 0 else 1 for i in range(100)}
    commits = sorted((p for p in (run / "checkpoint" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    assert len(json.loads("[" + commits[-1].name + "]")) == 1
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert {r.item: r.n for r in drain().collect()} == {i: 6 if i == 0 else 1 for i in range(100)}


def test_watermark_must_be_named(spark):
    df = spark.createDataFrame([], "e long, u long, t timestamp, k string")
    with pytest.raises(ValueError, match="delay"):
        C.without_replays(df, "e", "t")
