"""Rule edge cases (FIXTURES §2), one table per standardiser."""

import pytest
from pyspark.sql import functions as F

from cadenza.functions import standardise as S


def run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn(F.col("s")).alias("o")).collect()]


@pytest.mark.parametrize("raw,expected", [
    ("1 234", "1234"), ("1,234", "1234"), ("1,5", "1,5"), ("2,0", "2"), ("-7", "-7"), ("3.0", "3"),
    ("3.5", "3.5"), ("abc", "abc"), ("", ""), ("+12", "12"), ("1,234,567", "1234567"), (" 42 ", "42"),
    ("1_000", "1000"), ("007", "7"), (None, None),
])
def test_to_int(spark, raw, expected):
    assert run(spark, S.to_int, [raw]) == [expected]


@pytest.mark.parametrize("raw,expected", [
    ("1,5", "1.5"), ("1,234.5", "1234.5"), ("1_000", "1000.0"), ("x", "x"), ("-2.25", "-2.25"), ("", ""),
])
def test_to_float(spark, raw, expected):
    assert run(spark, S.to_float, [raw]) == [expected]


def test_to_boolean(spark):
    assert run(spark, S.to_boolean, ["YES", "n", "maybe", "1", " False "]) == ["true", "false", "maybe", "true", "false"]
    assert run(spark, S.survey_to_boolean, ["Oui, tous les jours", "non", "peut-être"]) == ["true", "false", "peut-être"]


@pytest.mark.parametrize("raw,expected", [
    ("3:45", "225"), ("00:03:45", "225"), ("1:75", "1:75"), ("0:61:00", "0:61:00"), ("210.9", "210"), ("abc", "abc"),
    ("1:00:00", "3600"),
])
def test_normalize_duration(spark, raw, expected):
    assert run(spark, S.normalize_duration, [raw]) == [expected]


def test_extract_genre_ids(spark):
    out = run(spark, S.extract_genre_ids, ["[21, 103]", "[{'genre_id': '21'}]", "[1, 'x']", "21", None, "[]"])
    assert out == [[21, 103], [21], [1], [], [], []]


def test_normalize_tags(spark):
    out = run(spark, S.normalize_tags, ["[' a ', '', 'b']", "[{'name': 'x'}]", "a,b", "[{'tag': 't', 'x': None}]"])
    assert out == [["a", "b"], ["x"], [], ["t"]]


def test_to_array(spark):
    out = run(spark, S.to_array, ["[1.0, ' a ', '']", "solo", "", "(1, 2)"])
    assert out == [["1", "a"], ["solo"], [], ["1", "2"]]
    assert run(spark, S.survey_to_array, ["a, b/c", " , x"]) == [["a", "b", "c"], ["x"]]


def test_parse_date(spark):
    assert run(spark, S.parse_date, ["2008/11/26", "26-11-2008", "2008-11-26 10:00:00", "nope"]) == \
        ["2008-11-26", "2008-11-26", "2008-11-26", "nope"]
    assert run(spark, S.survey_parse_date, ["05/11/2025 14:03:22", "2025-11-05"]) == ["2025-11-05", "2025-11-05"]


def test_quantitative(spark):
    mapping = {"soir": 4, "D'accord": 4, "matin": 1}
    assert run(spark, lambda c: S.to_quantitative(c, mapping), [" soir ", "D'accord", "inconnu"]) == [4.0, 4.0, None]


def test_parse_python_list(spark):
    out = run(spark, S.parse_python_list, [None, "", "[]", "['a', 'b']", "[1, 2]", "[a, b]", "[\"rock'n'roll\", 'b']"])
    assert out == [[], [], [], ["a", "b"], ["1", "2"], ["a", "b"], ["rock'n'roll", "b"]]


def test_parse_track_genres(spark):
    assert run(spark, S.parse_track_genres, ["[21, 103]", "21", "21,34", "[1, 'x']", ""]) == \
        [[21, 103], [21], [21, 34], [1], []]


def test_trim_and_emoji(spark):
    assert run(spark, S.trim_spaces, ["\t a b  "]) == ["a b"]
    assert run(spark, S.trim_emoji, ["ok 🎵👍 fine"]) == ["ok  fine"]


def test_tokenize(spark):
    df = spark.createDataFrame([("Déjà vu_x a1 2b é",)], "s string")
    assert df.select(S.tokenize(F.col("s"))).collect()[0][0] == ["déjà", "vu_x", "a1", "2b"]


def test_json_list_text(spark):
    df = spark.createDataFrame([([21, 103],)], "a array<bigint>")
    assert df.select(S.json_list_text(F.col("a"))).collect()[0][0] == "[21, 103]"


def test_json_dumps_list(spark):
    df = spark.createDataFrame([(["21", "a b", 'q"t', "1.5"],)], "a array<string>")
    assert df.select(S.json_dumps_list(F.col("a"))).collect()[0][0] == '[21, "a b", "q\\"t", 1.5]'
