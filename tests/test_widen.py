"""Seed tables against the plain chain of left joins, written out in Python."""

import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import values
from lakeloom.operators import widen


def chain(members, facts, predicates, k=None, keep_empty=True):
    """Rows (type, subject, value per predicate) of the join chain."""
    out = Counter()
    for kind, subject in members:
        columns = []
        for p in predicates:
            found = [v for s, q, v in facts if s == subject and q == p]
            found.sort(key=lambda v: (v is None, v))
            columns.append((found[:k] if k else found) or [None])
        out.update((kind, subject, *row) for row in itertools.product(*columns))
    return out


def rows_of(rows, predicates):
    cells = [F.col("attrs")[p].alias(f"c{i}") for i, p in enumerate(predicates)]
    return Counter(tuple(r) for r in rows.select("seed_table", "subject", *cells).collect())


FACTS = (
    [("a", "p", str(i)) for i in range(5)]
    + [("a", "q", x) for x in ("u", "u", "v")]
    + [("b", "p", "1"), ("b", "r", None), ("b", "r", "z"), ("c", "q", None), ("d", "r", "only")]
    + [("hot", "p", f"v{i}") for i in range(40)]
    + [("hot", "q", f"w{i % 9}") for i in range(30)]
    + [("hot", "r", "one")]
)
MEMBERS = [("T", "a"), ("T", "b"), ("T", "b"), ("T", "c"), ("T", "none"), ("U", "a"), ("U", "hot"), ("T", "hot")]
PREDICATES = ["p", "q", "r"]


@pytest.fixture()
def members(spark):
    return spark.createDataFrame(MEMBERS, "type string, subject string")


@pytest.mark.parametrize("piece", [10_000, 4, 1])
def test_all_values_equal_the_join_chain(spark, facts_of, members, piece):
    chosen = spark.createDataFrame([("T", PREDICATES), ("U", ["q", "p"])], "type string, predicates array<string>")
    rows = widen.capped_rows(facts_of(FACTS), members, chosen, piece)
    want = chain([m for m in MEMBERS if m[0] == "T"], FACTS, PREDICATES)
    want += Counter(
        {(t, s, p, q, None): n for (t, s, p, q), n in chain([m for m in MEMBERS if m[0] == "U"], FACTS, ["p", "q"]).items()}
    )
    assert rows_of(rows, PREDICATES) == want
    keys = rows.select("seed_table", "subject", "row_key")
    assert keys.count() == keys.distinct().count()


def test_type_without_predicates_keeps_its_members(spark, facts_of, members):
    chosen = spark.createDataFrame([("U", ["p"])], "type string, predicates array<string>")
    rows = widen.capped_rows(facts_of(FACTS), members, chosen).filter("seed_table = 'T'")
    assert rows.count() == 6 and rows.filter(F.size("attrs") > 0).count() == 0


def test_limited_values(spark, facts_of, members):
    subjects = widen.long_subjects(facts_of(FACTS), members, 2)
    once = [m for m in sorted(set(MEMBERS)) if m[1] != "none"]
    # b is listed twice for T, so each of its facts is there twice
    doubled = [f for f in FACTS for _ in range(2 if f[0] == "b" else 1)]
    assert rows_of(widen.product_rows(subjects), PREDICATES) == chain(once, doubled, PREDICATES, 2)


def test_sizes_are_known_before_rows_multiply(spark, facts_of, members):
    subjects = widen.long_subjects(facts_of(FACTS), members, 2)
    rows = {r["seed_table"]: r["count"] for r in widen.product_rows(subjects).groupBy("seed_table").count().collect()}
    sizes = widen.product_sizes(subjects).collect()
    assert {r["seed_table"]: r["n_rows"] for r in sizes} == rows
    assert {r["seed_table"]: r["largest"] for r in sizes} == {"T": 4, "U": 4}


def test_spread_rows_are_the_same(spark, facts_of, members, monkeypatch):
    monkeypatch.setattr(values, "RANGE_STEP", 50)
    chosen = spark.createDataFrame([("T", PREDICATES), ("U", PREDICATES)], "type string, predicates array<string>")
    subjects = widen.capped_subjects(facts_of(FACTS), members, chosen)
    want = chain(MEMBERS, FACTS, PREDICATES)
    assert rows_of(widen.product_rows(subjects, spread=True), PREDICATES) == want
    sizes = widen.product_sizes(subjects).collect()
    assert sum(r["n_rows"] for r in sizes) == sum(want.values()) and {r["largest"] for r in sizes} == {1200}


def test_repeats_are_an_axis_like_any_other(spark, facts_of, monkeypatch):
    """A triple and a member that repeat very often, next to another large pair: pieces for several tasks."""
    monkeypatch.setattr(values, "RANGE_STEP", 100)
    facts = [("a", "p", "same")] * 700 + [("a", "q", str(i)) for i in range(5)] + [("a", "r", "x"), ("a", "r", None)]
    members = spark.createDataFrame([("T", "a")] * 3, "type string, subject string")
    chosen = spark.createDataFrame([("T", PREDICATES)], "type string, predicates array<string>")
    subjects = widen.capped_subjects(facts_of(facts), members, chosen, 3)
    assert subjects.count() == 234 * 2  # pieces of both pairs
    assert subjects.select(F.max(F.aggregate(F.col("fields")["p"], F.lit(0).cast("long"), lambda a, x: a + x["n"]))).first()[0] <= 3
    for spread in (False, True):
        rows = widen.product_rows(subjects, spread)
        assert rows_of(rows, PREDICATES) == Counter({("T", "a", "same", str(i), r): 2100 for i in range(5) for r in ("x", None)})
        assert rows.select("row_key").distinct().count() == 21_000


def test_exchanges_do_not_follow_the_hot_predicates(spark, facts_of):
    """The plan has as many exchanges with one large predicate as with six."""

    def exchanges(n):
        names = [f"p{i}" for i in range(n)]
        facts = [("a", p, str(i)) for p in names for i in range(4)] + [("a", "z", "1"), ("b", "z", "2")]
        members = spark.createDataFrame([("T", "a"), ("T", "b")], "type string, subject string")
        chosen = spark.createDataFrame([("T", [*names, "z"])], "type string, predicates array<string>")
        subjects = widen.capped_subjects(facts_of(facts), members, chosen, 3)
        assert subjects.count() == 2**n + 1
        plan = subjects._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange ")

    assert exchanges(1) == exchanges(6)


def test_full_rows(spark, facts_of, members):
    subjects = widen.long_subjects(facts_of(FACTS), members, 2)
    got = {r["subject"]: r["attrs"] for r in widen.full_rows(subjects, 2).filter("seed_table = 'T'").collect()}
    assert got["a"] == {"p_0": "0", "p_1": "1", "q_0": "u", "q_1": "u"}
    assert got["d" if "d" in got else "c"] == {}
    columns = {
        r["column"]: r["is_numeric"]
        for r in widen.subject_columns(subjects, 2).filter("seed_table = 'T'").collect()
    }
    assert set(columns) == {f"{p}_{i}" for p in PREDICATES for i in (0, 1)}


def test_hot_pair_is_limited_before_the_shuffle(facts_of):
    plan = widen.first_values(facts_of(FACTS), 2)._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and exchange < partial


def test_width_cap_takes_the_most_frequent(spark):
    pairs = spark.createDataFrame([("T", f"p{i}", i % 3) for i in range(6)], "type string, predicate string, count long")
    got = widen.chosen_predicates(pairs, 5).collect()[0]["predicates"]
    assert got == ["p2", "p5", "p1"]


def test_numeric_columns_of_a_table(spark):
    df = spark.createDataFrame(
        [("1", "1", None, "<a>"), ("2", None, None, "<a>"), ("x", "2e1", None, "<b>")], "t string, n string, e string, s string"
    )
    out = widen.cast_features(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "double", "double", "string"]
    assert sorted(r["n"] or 0 for r in out.collect()) == [0, 1.0, 20.0]


def test_predicates_that_differ_in_case(spark, facts_of):
    facts = facts_of([("a", "<isA>", "1"), ("a", "<IsA>", "2")])
    owned = spark.createDataFrame([("T", "a")], "type string, subject string")
    subjects = widen.long_subjects(facts, owned)
    wide = widen.wide_table(
        widen.product_rows(subjects), "T", widen.listed_columns(widen.subject_columns(subjects), "T"), "T"
    )
    assert wide.columns == ["T", "IsA", "isA"] and wide.collect()[0].asDict() == {"T": "a", "IsA": 2.0, "isA": 1.0}


def test_names_get_a_number_on_collision(spark):
    df = spark.createDataFrame([("<wordnet_order_1>",), ("<wordnet_order_2>",), ("<wordnet_part_3>",)], "seed_table string")
    got = {r["seed_table"]: r["name"] for r in widen.seed_names(df, "wordnet").collect()}
    assert got == {"<wordnet_order_1>": "wordnet_order", "<wordnet_order_2>": "wordnet_order_2", "<wordnet_part_3>": "wordnet_part"}


def test_k_below_one(facts_of):
    with pytest.raises(ValueError):
        widen.limited_fields(facts_of(FACTS), 0)
