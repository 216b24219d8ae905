"""Reading and normalising triples, choosing types, profiling."""

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import cooccurrence, matching, profiling, selection
from lakeloom.session import fresh_folder
from lakeloom.sources import tables, triples


def triple_file(spark, rows):
    path = fresh_folder(spark, "triples")
    spark.createDataFrame(rows, "a string, b string, c string, d string, e double").coalesce(1).write.parquet(path)
    return path


def test_last_row_and_limit(spark):
    path = triple_file(spark, [(str(i), "s", "p", "o", None) for i in range(10)])
    ids = lambda df: sorted(int(r["id"]) for r in df.collect())
    assert ids(triples.read_triples(spark, path)) == list(range(9))
    assert ids(triples.read_triples(spark, path, drop_last=False)) == list(range(10))
    assert ids(triples.read_triples(spark, path, limit=4)) == list(range(4))
    with pytest.raises(ValueError):
        triples.read_triples(spark, "/root/testdata/sf0.001/region.parquet")


def test_literals_keep_rows_without_value(spark):
    rows = [("1", "s", "p", "text", None), ("2", "s", "p", "text", 1.5), ("3", "s", "p", None, None)]
    df = spark.createDataFrame(rows, "id string, subject string, predicate string, cat_object string, num_object double")
    got = {r["id"]: r["cat_object"] for r in triples.normalise_literals(df).collect()}
    assert got == {"1": "text", "2": "1.5", "3": None}


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id").cast("string"), F.lit("s").alias("subject"))
    a = {r["id"] for r in triples.sample_rows(df, 700, seed=1).collect()}
    b = {r["id"] for r in triples.sample_rows(df.repartition(5), 700, seed=1).collect()}
    c = {r["id"] for r in triples.sample_rows(df, 700, seed=2).collect()}
    assert len(a) == 700 and a == b and a != c


def test_strangers_leave_out_null_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    other = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [r["k"] for r in matching.keep_strangers(df, "k", other, "k").collect()] == ["b"]
    assert [r["k"] for r in matching.keep_members(df, "k", other, "k").collect()] == ["a"]


def test_picked_types_with_and_without_duplicates(spark, types_of):
    types = types_of([("a", "<wordnet_x_1>"), ("b", "<wordnet_x_1>"), ("a", "<wordnet_y_1>"), ("c", "<wikicat_z>")])
    top = selection.top_types(types, 1)
    both = selection.add_picked_types(top, types, ["<wordnet_x_1>", "<wikicat_z>"], 5)
    assert sorted(r["type"] for r in both.collect()) == ["<wikicat_z>", "<wordnet_x_1>"]
    twice = selection.add_picked_types(top, types, ["<wordnet_x_1>", "<wikicat_z>"], 5, dedupe=False)
    assert twice.count() == 3


def test_errors(spark, facts_of, types_of):
    facts, types = facts_of([("a", "p", "1")]), types_of([("a", "<wordnet_x_1>")])
    with pytest.raises(ValueError):
        selection.first_types(types, 0)
    with pytest.raises(ValueError):
        selection.select_types_and_subjects(facts, types, "other")
    with pytest.raises(ValueError):
        profiling.value_counts(facts)
    with pytest.raises(KeyError):
        profiling.value_counts(facts, "missing")


def test_pairs_equal_the_self_join(spark, facts_of):
    rows = [(f"s{i % 7}", f"p{i % 5}", str(i)) for i in range(60)] + [("hot", f"p{i % 3}", "x") for i in range(500)]
    facts = facts_of(rows)
    other = facts.select("subject", F.col("predicate").alias("predicate_right"))
    joined = facts.select("subject", "predicate").join(other, "subject")
    want = {(r[0], r[1], r[2]) for r in joined.groupBy("predicate", "predicate_right").count().collect()}
    assert {tuple(r) for r in cooccurrence.cooccurring_pairs(facts, "predicate").collect()} == want


def test_modes_take_the_smallest_and_skip_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "y"), ("a", 3.0, "x"), ("a", None, None), ("a", 2.0, None), ("b", 1.0, None)],
        "k string, n double, c string",
    )
    got = {r["k"]: (r["n"], r["c"]) for r in profiling.group_means_and_modes(df, ["k"], ["n"], ["c"]).collect()}
    assert got == {"a": (2.0, "x"), "b": (1.0, None)}


def test_empty_columns_go(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "i int, e string, s string")
    assert matching.drop_empty_columns(df).columns == ["i", "s"]
    assert matching.numeric_columns(df) == ["i"] and matching.text_columns(df) == ["e", "s"]


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text('﻿"State","Abbrev","Code"\n"Alabama","Ala.","AL"\n', encoding="utf-8")
    assert tables.read_csv(spark, str(path)).columns == ["State", "Abbrev", "Code"]
    assert tables.read_csv_text(spark, str(path)).collect()[0]["Code"] == "AL"


def test_labels_by_suffix(spark, facts_of):
    labels = facts_of([("s", "label", "Paris@eng"), ("s", "label", "Paris@fra")])
    assert [r["cat_object"] for r in triples.labels_not_in(labels).collect()] == ["Paris@fra"]
