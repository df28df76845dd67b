"""Validation semantics: unique rejects all copies, first failure only, int truncation."""

from pyspark.sql import functions as F

from cadenza.operators.quality import TableRules, clean_table


def test_unique_and_first_failure(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "c"), (None, "d"), ("-3", None)], "id string, name string")
    rules = TableRules(standardisation={"id": ["toInt"]},
                       validation={"id": ["unique", "notNegative", "int"], "name": ["notNull"]})
    res = clean_table(df, rules)
    # the single null id is unique and passes the other rules; both 2s are rejected
    assert sorted((r["id"] is None, r["id"]) for r in res.clean.collect()) == [(False, 1), (True, None)]
    fails = {r["first_failure"]: r["failures"] for r in res.failures().collect()}
    # -3 fails id:notNegative; its null name is not counted (first failure only)
    assert fails == {"id:unique": 2, "id:notNegative": 1}
    rep = res.report().collect()[0]
    assert (rep["filtered_rows"], rep["cleaned_rows"], rep["removed_rows"]) == (5, 2, 3)
    assert rep["retention_pct"] == 40.0


def test_int_truncation_kept(spark):
    df = spark.createDataFrame([("12.7",)], "x string")
    res = clean_table(df, TableRules(validation={"x": ["int"]}))
    assert [r["x"] for r in res.clean.collect()] == [12]


def test_all_default_rules(spark):
    df = spark.createDataFrame([("1", "2.5"), ("2", "x")], "k string, v string")
    rules = TableRules(standardisation={"__all__": ["toFloat"]}, validation={"__all__": ["notNull", "float"]})
    res = clean_table(df, rules)
    assert res.selected == ["k", "v"]
    assert [(r["k"], r["v"]) for r in res.clean.collect()] == [(1.0, 2.5)]


def test_unknown_rule_is_config_error(spark):
    import pytest
    df = spark.createDataFrame([("1",)], "x string")
    with pytest.raises(ValueError):
        clean_table(df, TableRules(validation={"x": ["noSuchRule"]}))


def test_idempotent_on_clean_data(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string")
    rules = TableRules(standardisation={"id": ["toInt"], "name": ["trimSpaces"]},
                       validation={"id": ["notNull", "unique", "int"], "name": ["notNull", "string"]})
    once = clean_table(df, rules).clean
    twice = clean_table(once.select(F.col("id").cast("string"), "name"), rules).clean
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
