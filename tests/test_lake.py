"""Combinations, subtables, samples, estimates, base tables and the jobs."""

import itertools
import json
import math
import os
import random
import time

import pyarrow as pa
import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from checks import queries
from lakeloom import session
from lakeloom.operators import base_tables, combine, estimate, subtables
from lakeloom.plans import jobs
from lakeloom.session import fresh_folder
from lakeloom.sources import many_tables, sinks, star, tables, triples

COLUMNS = ["a", "b", "c", "d", "e"]
ROW_SCHEMA = "seed_table string, subject string, row_key long, attrs map<string,string>"


def seeds(spark, n=400, table="T", seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        attrs = {c: str(rng.randint(0, 3)) for c in COLUMNS[:4] if rng.random() < 0.4}
        out.append((table, f"s{i % 50}", i, attrs))
    return spark.createDataFrame(out, ROW_SCHEMA), out


def test_combination_counts_equal_brute_force(spark):
    rows, raw = seeds(spark)
    layout = spark.createDataFrame([("T", COLUMNS)], "seed_table string, columns array<string>")
    patterns = combine.null_patterns(rows)
    assert patterns.agg(F.sum("n")).collect()[0][0] == len(raw)
    for size in (1, 2, 3):
        got = {
            tuple(r["cols"]): (r["any_count"], r["all_count"])
            for r in combine.combination_counts(patterns, layout, size).collect()
        }
        want = {
            c: (sum(any(x in a for x in c) for *_, a in raw), sum(all(x in a for x in c) for *_, a in raw))
            for c in itertools.combinations(COLUMNS, size)
        }
        assert got == want
        assert all(every <= some for some, every in got.values())


@pytest.mark.parametrize("policy", ["any", "all"])
def test_combination_tables_need_more_than_the_minimum(spark, policy):
    rows, raw = seeds(spark)
    layout = spark.createDataFrame([("T", COLUMNS)], "seed_table string, columns array<string>")
    test = any if policy == "any" else all
    want = {}
    for c in itertools.combinations(COLUMNS, 2):
        kept = [(s, *[a.get(x) for x in c]) for _, s, _, a in raw if test(x in a for x in c)]
        if len(kept) >= 90 and len(set(kept)) > 90:
            want[c] = set(kept)
    manifest, kept = combine.combination_tables(rows, layout, (2,), 90, policy)
    ids = {r["subtable_id"]: tuple(r["cols"]) for r in manifest.collect()}
    assert {c: len(v) for c, v in want.items()} == {tuple(r["cols"]): r["n_rows"] for r in manifest.collect()}
    got = {}
    for r in kept.collect():
        got.setdefault(ids[r["subtable_id"]], set()).add((r["subject"], *r["cells"]))
    assert got == want


def test_combinations_of_a_subject_with_many_rows(spark, monkeypatch):
    """Subjects beyond the limit, one of them without a name, give the same tables as those within."""
    raw = [("T", None if i % 7 == 0 else f"s{i % 5}", i, {c: str(i % k) for c, k in (("a", 3), ("b", 5), ("c", 2)) if i % 4}) for i in range(300)]
    raw += [("T", f"t{i}", i, {"a": "1"}) for i in range(20)] + raw[:40]
    rows = spark.createDataFrame(raw, ROW_SCHEMA)
    layout = spark.createDataFrame([("T", ["a", "b", "c"])], "seed_table string, columns array<string>")
    want = {c: {(s, *[a.get(x) for x in c]) for _, s, _, a in raw if any(x in a for x in c)} for c in itertools.combinations("abc", 2)}
    for limit in (10_000, 25, 1):
        monkeypatch.setattr(combine, "SUBJECT_ROWS", limit)
        manifest, kept = combine.combination_tables(rows, layout, (2,), 10)
        listed = {r["subtable_id"]: tuple(r["cols"]) for r in manifest.collect()}
        got = [(listed[r["subtable_id"]], (r["subject"], *r["cells"])) for r in kept.collect()]
        assert sorted(got, key=str) == sorted(((c, x) for c, v in want.items() for x in v), key=str)
        assert {tuple(r["cols"]): r["n_rows"] for r in manifest.collect()} == {c: len(v) for c, v in want.items()}


def test_combinations_write_no_cut_rows(spark):
    """What is cut from the rows, 220 tables of them here, is counted and not written to the shared folder."""
    wide = [f"c{i:02}" for i in range(12)]
    rows = spark.createDataFrame([("T", f"s{i}", i, {c: f"{c}-{i}" for c in wide}) for i in range(300)], ROW_SCHEMA)
    layout = spark.createDataFrame([("T", wide)], "seed_table string, columns array<string>")
    shared = session.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    manifest, kept = combine.combination_tables(rows, layout, (3,), 10)
    assert [r["n_rows"] for r in manifest.collect()] == [300] * 220 and kept.count() == 300 * 220
    made = [f"{shared}/{f}" for f in set(os.listdir(shared)) - before]
    assert made and sum(spark.read.parquet(f).count() for f in made if os.listdir(f)) < 10 * 300


def test_combination_with_exactly_the_minimum(spark):
    rows = spark.createDataFrame([("T", f"s{i}", i, {"a": "1"}) for i in range(10)], ROW_SCHEMA)
    layout = spark.createDataFrame([("T", ["a", "b"])], "seed_table string, columns array<string>")
    counts = combine.combination_counts(combine.null_patterns(rows), layout, 2)
    assert combine.rich_combinations(counts, 10).count() == 1
    assert combine.combination_tables(rows, layout, (2,), 10)[0].count() == 0
    with pytest.raises(ValueError):
        combine.rich_combinations(counts, 10, "some")


def test_drawn_specs(spark):
    columns = [("T", f"c{i}", i % 2 == 0) for i in range(6)] + [("U", "x", True), ("V", "x", False), ("V", "y", True)]
    columns = spark.createDataFrame(columns, "seed_table string, column string, is_numeric boolean")

    def drawn(*args, **how):
        rows = subtables.draw_specs(columns, *args, **how).collect()
        return {(r["seed_table"], r["case"], r["attempt"]): tuple(r["cols"]) for r in rows}

    found = drawn(300)
    assert found == drawn(300) != drawn(300, seed=43) and {k: v for k, v in found.items() if k[2] < 9} == drawn(9)
    assert {k[:2] for k in found} == {("T", "all"), ("T", "num"), ("V", "all")}  # the others have too few names
    of = lambda *k: [v for key, v in found.items() if key[:2] == k]
    assert {len(c) for c in of("T", "all")} == {4, 5, 6} and all(len(set(c)) == len(c) for c in found.values())
    assert set(of("V", "all")) == {("x", "y"), ("y", "x")}
    assert set(of("T", "num")) == set(itertools.permutations(("c0", "c2", "c4"), 2)) | set(itertools.permutations(("c0", "c2", "c4")))
    assert {len(c) for k, c in drawn(100, smallest=1).items() if k[:2] == ("T", "all")} == {1, 2, 3, 4, 5, 6}
    assert drawn(0) == {}


def test_samples_of_equal_places_and_deep_cells(spark, monkeypatch):
    """Cells are cut again and again until few rows or one place are left; ties are cut by row key."""
    monkeypatch.setattr(subtables, "CELL_ROWS", 2)
    monkeypatch.setattr(subtables, "CELL_BITS", 3)
    rows = spark.range(500).select(
        F.lit("t").alias("seed_table"), F.lit("all").alias("case"), F.lit("s").alias("subtable_id"), F.lit(1).alias("replica"),
        F.col("id").alias("row_key"), F.lit(500).alias("n_rows"),
        F.when(F.col("id") < 300, F.lit(5).cast("long")).otherwise(F.col("id") * (1 << 40)).alias("place"),
    )
    for fraction, place, key in ((0.5, 5, 249), (0.6, 5, 299), (0.8, 399 << 40, 399), (1.0, 499 << 40, 499)):
        cut = subtables.sample_cuts(rows, fraction).collect()
        assert [(r["cut_place"], r["cut_key"]) for r in cut] == [(place, key)]
    assert subtables.sample_cuts(rows, 0.001).count() == 0


def test_kept_specs_follow_the_attempts(spark):
    counted = spark.createDataFrame(
        [("T", "all", 0, ["a", "b"], 500), ("T", "all", 1, ["a", "b"], 500), ("T", "all", 2, ["c", "d"], 100),
         ("T", "all", 3, ["b", "a"], 500), ("T", "all", 4, ["d", "c"], 101)],
        "seed_table string, case string, attempt int, cols array<string>, n_rows long",
    )
    kept = lambda **o: sorted(tuple(r["cols"]) for r in subtables.keep_specs(counted, 100, **o).collect())
    assert kept() == [("a", "b"), ("b", "a"), ("d", "c")]
    assert kept(limit_break=1) == [("a", "b")]
    assert kept(limit_break=5, max_tables=2) == [("a", "b"), ("b", "a")]


@pytest.mark.parametrize("cell_rows", [4096, 10])
def test_samples_are_exact_and_repeatable(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(subtables, "CELL_ROWS", cell_rows)
    rows, raw = seeds(spark, 1000)
    specs = spark.createDataFrame(
        [("T", "all", 0, ["a", "b"]), ("T", "all", 1, ["c", "b", "d"])], subtables.SPEC_SCHEMA
    )
    counted = subtables.keep_specs(subtables.count_specs(rows, specs), 10)
    sizes = {tuple(r["cols"]): r["n_rows"] for r in counted.collect()}
    assert sizes == {c: sum(any(x in a for x in c) for *_, a in raw) for c in (("a", "b"), ("c", "b", "d"))}
    out = subtables.subtable_rows(rows, counted, 2, 0.7)
    got = {(tuple(r["cols"]), r["replica"]): r["count"] for r in out.groupBy("cols", "replica").count().collect()}
    want = {(c, 0): n for c, n in sizes.items()} | {(c, i): math.floor(0.7 * n) for c, n in sizes.items() for i in (1, 2)}
    assert got == want
    listed = lambda df: sorted(map(str, df.select("cols", "replica", "subject", "cells").collect()))
    assert listed(out) == listed(subtables.subtable_rows(rows.repartition(3), counted, 2, 0.7))
    first, second = (out.filter(F.col("replica") == i).drop("replica") for i in (1, 2))
    whole = out.filter("replica = 0").drop("replica")
    assert first.exceptAll(whole).count() == 0 and first.exceptAll(second).count() > 0
    manifest = subtables.subtable_manifest(counted, 2, 0.7)
    assert {(tuple(r["cols"]), r["replica"]): r["n_rows"] for r in manifest.collect()} == want


def test_bernoulli_samples_are_near(spark):
    rows, _ = seeds(spark, 5000)
    specs = spark.createDataFrame([("T", "all", 0, COLUMNS[:4])], subtables.SPEC_SCHEMA)
    counted = subtables.keep_specs(subtables.count_specs(rows, specs), 10)
    n = counted.collect()[0]["n_rows"]
    got = subtables.subtable_rows(rows, counted, 1, 0.5, exact=False).filter("replica = 1").count()
    assert abs(got - n / 2) < n / 10


def test_resample_must_be_a_whole_number(spark):
    for bad in (-1, 1.5, True):
        with pytest.raises(ValueError):
            subtables.check_resample(bad)


STATS = [
    ("t1", 50, 8, 0, 8, 5000), ("t2", 51, 9, 1, 8, 6000), ("t3", 100, 9, 2, 7, 9000), ("t4", 101, 12, 3, 9, 20000),
    ("t5", 40, 20, 5, 15, 8000), ("t6", 1000, 8, 4, 4, 90000), ("t7", 5000, 15, 6, 9, 700000), ("t8", 200, 9, 2, 7, 20000),
]


def test_estimates_by_hand(spark):
    stats = estimate.with_cells(
        spark.createDataFrame(STATS, "seed_table string, rows long, cols long, n_num long, c_num long, size long")
    )

    def every(rows, cols, size, c):
        r = rows * (1 + 2 * 0.7)
        return size / (rows * cols) * r * (cols + cols - 2) / 2 * c if r > 100 else 0

    def numeric(rows, cols, n, size, c):
        r = rows * (1 + 2 * 0.7)
        return size / (rows * cols) * r * (n + (n - 2 if n > 2 else 2)) / 2 * c if r > 100 else 0

    want = sum(every(r, k, s, 5) for _, r, k, n, _, s in STATS if k > 8)
    want += sum(numeric(r, k, n, s, 5) for _, r, k, n, _, s in STATS if k > 8 and n >= 2)
    assert estimate.estimate_size(stats, 2, 5).collect()[0][0] == pytest.approx(want)
    swept = {r["resample_columns"]: r for r in estimate.sweep(stats).collect()}
    assert set(swept) == set(estimate.SWEEP) and swept[5]["exp_size"] == pytest.approx(want)
    n_all = sum(r > 50 and k > 8 for _, r, k, *_ in STATS)
    n_num = sum(r > 50 and k > 8 and n > 2 for _, r, k, n, *_ in STATS)
    assert swept[10]["n_tables"] == (n_all + n_num) * 3 * 10
    found = estimate.summary(stats).collect()[0]
    wide = sorted(r for _, r, k, *_ in STATS if k > 8)
    assert found["row_qle"] == wide[round(0.8 * (len(wide) - 1))] and found["len"] == len(wide)


def test_company_with_two_spaces(spark, facts_of):
    companies = spark.createDataFrame([("Big red co", 5000), ("small co", 10)], "name string, `current employee estimate` int")
    facts = facts_of([("<Big_Red co>", "p", "x"), ("<Big_Red co>", "q", "x"), ("<small_co>", "p", "x")])
    got = base_tables.companies(companies, facts).collect()
    assert [(r["name"], r["col_to_embed"], r["target"]) for r in got] == [("Big red co", "<Big_Red co>", math.log10(5000))]
    assert base_tables.unmatched_companies(companies, facts.limit(0)).count() == 1


def test_companies_of_one_name_meet_counted_targets(spark, facts_of):
    """Every company meets every target of its name; equal targets come to the join as one row."""
    sizes = [1000, 1000, 1000, 2000]
    table = spark.createDataFrame([("Big co", i, n) for i, n in enumerate(sizes)], "name string, id int, `current employee estimate` int")
    facts = facts_of([("<big_co>", "p", "x"), ("<BIG_co>", "p", "x")])
    got = sorted((r["id"], r["col_to_embed"], r["target"]) for r in base_tables.companies(table, facts).collect())
    assert got == sorted((i, s, math.log10(n)) for i in range(4) for s in ("<big_co>", "<BIG_co>") for n in sizes)
    counted = base_tables._counted_targets(base_tables._formatted(table, "current employee estimate", 1000), facts, "current employee estimate")
    assert sorted(r["__n_targets"] for r in counted.collect()) == [1, 1, 3, 3]


def test_accidents_equal_the_join_back(spark, facts_of):
    rng = random.Random(1)
    events = [("AL", rng.choice(["Mobile", "Auburn"]), rng.choice(["X", "Y"]), f"2019-0{rng.randint(1, 9)}-11", rng.randint(1, 4))
              for _ in range(300)]
    df = spark.createDataFrame(events, "Code string, City string, County string, Start_Time string, Severity int")
    states = spark.createDataFrame([("AL", "Alabama")], "Code string, State string")
    facts = facts_of([("<Mobile,_Alabama>", "p", "x")])
    out = base_tables.accidents(df, states, facts, count_by=["City", "County"], means=["Severity"], modes=["Code"])
    mobile = [e for e in events if e[1] == "Mobile"]
    targets = [math.log10(sum(e[2] == c for e in mobile)) for c in ("X", "Y")]
    got = {r["County"]: (r["target"], r["Severity"]) for r in out.collect()}
    for c in ("X", "Y"):
        severity = [e[4] for e in mobile if e[2] == c]
        assert got[c] == pytest.approx((sum(targets) / 2, sum(severity) / len(severity)))


def test_unknown_format_and_missing_folder(spark, facts_of):
    facts = facts_of([("a", "<p>", "1")])
    with pytest.raises(ValueError):
        sinks.write_table(facts, fresh_folder(spark, "out"), "tag", "name", "orc")
    with pytest.raises(FileNotFoundError):
        sinks.write_binary_tables(jobs.widen.binary_rows(facts), fresh_folder(spark, "missing"))
    with pytest.raises(ValueError):
        jobs.build_base_lake(facts, facts, fresh_folder(spark, "out"), strategy="other")


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kb(spark):
    parts = [f(spark, SF) for f in (star.entity_facts, star.literal_facts, star.date_facts)]
    return triples.stack_facts(*parts), star.types(spark, SF)


def test_long_lake_then_subtables(spark, kb):
    source = fresh_folder(spark, "lake")
    manifest = {r["name"]: r for r in jobs.build_long_seeds(*kb, source).collect()}
    stats = {r["table"]: r for r in tables.file_stats(spark, source).collect()}
    assert {f"wordnet_vldb-{n}" for n in manifest} == set(stats)
    for name, m in manifest.items():
        s = stats[f"wordnet_vldb-{name}"]
        assert (m["n_rows"], m["arity"], m["n_num"]) == (s["rows"], s["cols"], s["n_num"]) and s["size"] > 0

    made = jobs.build_subtables(spark, source, minimum_arity=5, col_resample=2)
    listed = {(r["seed_table"], r["case"], r["subtable_id"], r["replica"]): r["n_rows"] for r in made.collect()}
    rows = spark.read.parquet(f"{source}_2/{jobs.SUBTABLE_ROWS}")
    counts = {tuple(r)[:4]: r["count"] for r in rows.groupBy(*subtables.KEYS).count().collect()}
    assert counts == listed
    one = made.filter("replica = 1").limit(2)
    for path in jobs.export_subtables(spark, source, f"{source}_2", one):
        assert spark.read.parquet(path).count() in set(listed.values())


def test_base_lake_with_combinations(spark, kb):
    dest = fresh_folder(spark, "lake")
    manifest = jobs.build_base_lake(*kb, dest, top_k=2, explode_tables=True, output_format="csv")
    for m in manifest.collect():
        table = tables.read_csv_text(spark, f"{dest}/wordnet-{m['name']}.csv")
        assert len(table.columns) == m["arity"] and table.columns[:2] == ["type", "subject"]
        assert table.count() == m["n_rows"]
    sub = spark.read.parquet(f"{dest}/{jobs.SUBTABLES}")
    rows = spark.read.parquet(f"{dest}/{jobs.SUBTABLE_ROWS}")
    counts = {r["subtable_id"]: r["count"] for r in rows.groupBy("subtable_id", "seed_table").count().collect()}
    assert sub.count() > 0 and sum(r["n_rows"] for r in sub.collect()) == sum(
        r["count"] for r in rows.groupBy("subtable_id", "seed_table").count().collect()
    ) and counts


def test_binary_tables_of_all_facts(spark, kb):
    dest = fresh_folder(spark, "lake")
    spark.range(0).write.parquet(f"{dest}/_made")
    made = {r["table"]: r["n_rows"] for r in jobs.build_all_binary(kb[0], dest).collect()}
    want = {f"binary-{r['predicate'][1:-1]}": r["count"] for r in kb[0].groupBy("predicate").count().collect()}
    assert made == want
    assert dict(spark.read.parquet(f"{dest}/binary-hasSize.parquet").dtypes)["hasSize"] == "double"
    assert dict(spark.read.parquet(f"{dest}/binary-hasBrand.parquet").dtypes)["hasBrand"] == "string"


def rows_for(spark, tables, n=3):
    """Rows for tables of different width, one of them without rows."""
    rows = []
    for t in range(tables):
        names = ["key"] + [f"c{i}" for i in range(t % 4)]
        layout = json.dumps([{"name": c, "kind": "double" if i % 2 else "string"} for i, c in enumerate(names)])
        rows.append((f"d{t % 2}/t{t}", layout, None))
        rows += [(f"d{t % 2}/t{t}", layout, [f"k{r}", *[str(r + i) if i % 2 == 0 else f'say "{r}",\nx ' for i in range(len(names) - 1)]])
                 for r in range(n if t else 0)]
    return spark.createDataFrame(rows, many_tables.ROWS).repartition(7)


def jobs_of(spark, work):
    group = f"g{time.time()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        work()
    finally:
        spark.sparkContext.setJobGroup("other", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("output_format", ["parquet", "csv"])
def test_tables_of_different_schemas_are_one_write(spark, output_format):
    dest = fresh_folder(spark, "many")
    few = jobs_of(spark, lambda: many_tables.write_tables(rows_for(spark, 3), fresh_folder(spark, "few")))
    many = jobs_of(spark, lambda: many_tables.write_tables(rows_for(spark, 40), dest, output_format))
    assert many == few
    many_tables.write_tables(rows_for(spark, 40, 2), dest, output_format)  # replaces
    for t in (0, 1, 2, 3, 39):
        path = f"{dest}/d{t % 2}/t{t}.{output_format}"
        df = spark.read.parquet(path) if output_format == "parquet" else tables.read_csv_text(spark, path)
        assert df.columns == ["key"] + [f"c{i}" for i in range(t % 4)]
        assert df.count() == (2 if t else 0)
        if t == 39:
            kinds = [k for _, k in df.dtypes]
            assert kinds == (["string", "double", "string", "double"] if output_format == "parquet" else ["string"] * 4)
            assert sorted(r["c1"] for r in df.collect()) == ['say "0",\nx ', 'say "1",\nx ']
            assert sorted(float(r["c2"]) for r in df.collect()) == [2.0, 3.0]
    fs, root = many_tables.file_system(dest)
    assert not [i.path for i in fs.get_file_info(pa.fs.FileSelector(root)) if "_writing" in i.path]


def test_a_failed_write_leaves_nothing(spark):
    dest = fresh_folder(spark, "many")
    many_tables.write_tables(rows_for(spark, 4), dest)
    wrong = spark.createDataFrame([("d0/wrong", '[{"name": "key", "kind": "double"}]', ["no number"])], many_tables.ROWS)
    with pytest.raises(Exception, match="no number"):
        many_tables.write_tables(rows_for(spark, 20).unionByName(wrong), dest)
    fs, root = many_tables.file_system(dest)
    found = {i.path.removeprefix(root) for i in fs.get_file_info(pa.fs.FileSelector(root, recursive=True))}
    assert {f for f in found if f.endswith(".parquet") and "part-" not in f} == {"/d0/t0.parquet", "/d0/t2.parquet", "/d1/t1.parquet", "/d1/t3.parquet"}
    assert not [f for f in found if "_writing" in f] and spark.read.parquet(f"{dest}/d0/t2.parquet").count() == 3


def test_lakes_are_read_in_tasks(spark):
    """Footers, first rows and all rows of many tables: as many jobs as for few."""
    roots = {n: fresh_folder(spark, "many") for n in (4, 30)}
    for n, root in roots.items():
        many_tables.write_tables(rows_for(spark, n, 8), root)
    for work in (tables.footers, tables.browse, tables.lake_rows):
        assert jobs_of(spark, lambda: work(spark, roots[4]).collect()) == jobs_of(spark, lambda: work(spark, roots[30]).collect())  # noqa: B023
    rows = tables.lake_rows(spark, roots[30]).collect()
    assert len(rows) == 29 * 8 and {r["cells"]["key"] for r in rows} == {f"k{i}" for i in range(8)}
    first = tables.browse(spark, roots[30], 3).collect()
    assert len(first) == 29 * 3 and {r["row_index"] for r in first} == {0, 1, 2}
    path = f"{fresh_folder(spark, 'lake')}/one.parquet"
    spark.range(1000).selectExpr("id", "if(id % 4 = 0, null, 'x') AS v").coalesce(1).write.option("parquet.block.row.count.limit", 100).parquet(path)
    parts = {r["column"]: r for r in tables.column_sizes(spark, path.rsplit("/", 1)[0]).collect()}
    assert parts["v"]["n_null"] == 250 and parts["id"]["rows"] == 1000 and parts["id"]["bytes"] > parts["v"]["bytes"] > 0
    whole = tables.lake_rows(spark, path.rsplit("/", 1)[0]).orderBy("row_index").collect()
    assert [(r["row_index"], r["cells"]["id"]) for r in whole] == [(i, str(i)) for i in range(1000)]


def test_files_that_nobody_asks_for_are_left_unopened(spark):
    root = fresh_folder(spark, "lake")
    spark.range(3).write.parquet(f"{root}/kept/one.parquet")
    fs = pa.fs.LocalFileSystem()
    fs.create_dir(f"{root}/_own")
    with fs.open_output_stream(f"{root}/_own/rows.parquet") as out:
        out.write(b"not a table")
    rows = tables.lake_rows(spark, root, hidden=True, only=F.col("location").contains("/kept/")).collect()
    assert sorted(r["cells"]["id"] for r in rows) == ["0", "1", "2"]


def test_rows_read_from_a_folder_each_are_written_without_a_shuffle(spark):
    rows = rows_for(spark, 6, 5).coalesce(2)
    dest = {gathered: fresh_folder(spark, "many") for gathered in (False, True)}
    for gathered, path in dest.items():
        many_tables.write_tables(rows, path, gathered=gathered)
    read = {g: sorted((r["table"], str(r["cells"])) for r in tables.lake_rows(spark, p).collect()) for g, p in dest.items()}
    assert read[True] == read[False] and len(read[True]) == 25


def test_numbers_of_text_beyond_what_arrow_reads():
    got = many_tables._numbers(pa.array(["1", "+2", None, "1e999", ".5", "1."])).to_pylist()
    assert got == [1.0, 2.0, None, math.inf, 0.5, 1.0]
    assert tables._texts(pa.array([1.5, None, -0.0, 0.0, 1e22, 1.5])).to_pylist() == ["1.5", None, "-0.0", "0.0", "1e+22", "1.5"]


def test_gathered_rows_are_neither_shuffled_nor_sorted(spark, tmp_path, monkeypatch):
    """Also where a task has more folders than it keeps open, and twice over one folder."""
    rows = spark.range(600).selectExpr("id % 20 AS k", "id AS v").coalesce(2)
    want = sorted((r["k"], r["v"]) for r in rows.collect())
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    for most in (64, 3):
        monkeypatch.setattr(sinks, "OPEN_FILES", most)
        sinks.write_partitioned(rows, f"{tmp_path}/out", "k", gathered=True)
        found = spark.read.parquet(f"{tmp_path}/out")
        assert sorted((r["k"], r["v"]) for r in found.collect()) == want and spark.conf.get(key) == before
    assert 20 <= len(found.inputFiles()) <= 40


def test_last_pass_of_the_samples_takes_rows_dealt_otherwise(spark):
    """One cut row serves all replicas, and rows dealt in another way give the same subtables."""
    rows, _ = seeds(spark)
    specs = spark.createDataFrame([("T", "all", 0, ["a", "b"]), ("T", "all", 1, ["c", "b", "d"])], subtables.SPEC_SCHEMA)
    counted = subtables.keep_specs(subtables.count_specs(rows, specs), 10)
    listed = lambda df: sorted((r["subtable_id"], r["replica"], r["subject"], str(r["cells"])) for r in df.collect())
    out = subtables.subtable_rows(rows, counted, 2, 0.7)
    assert listed(out) == listed(subtables.subtable_rows(rows, counted, 2, 0.7, dealt=rows.repartition(5, "seed_table", "subject")))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    for exact in (True, False):
        assert {r["replica"] for r in subtables.subtable_rows(rows, counted, 0, 0.7, exact=exact).collect()} == {0}


def test_second_run_leaves_no_old_tables(spark):
    path = fresh_folder(spark, "lake")
    for names in ("ab", "c"):
        df = spark.createDataFrame([(n, 1) for n in names], "k string, v int")
        sinks.write_partitioned(df, path, "k")
    assert [r["k"] for r in spark.read.parquet(path).collect()] == ["c"]


def test_samples_do_not_shuffle_the_rows(spark):
    """The cuts are small written tables that go to the rows, not the other way round."""
    from pyspark.sql import functions as F

    from lakeloom.operators import subtables

    cut = spark.range(2000).select(
        F.lit("t").alias("seed_table"), F.lit("all").alias("case"), F.lit("s").alias("subtable_id"),
        F.col("id").alias("row_key"), F.lit(2000).cast("long").alias("n_rows"), F.array(F.lit("x")).alias("cells"),
    )
    out = subtables.resampled_rows(cut, 2, 0.7)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    counts = out.groupBy("replica").agg(F.count("*").alias("n"), F.countDistinct("row_key").alias("d")).collect()
    assert [(r["n"], r["d"]) for r in counts] == [(1400, 1400)] * 2


@pytest.mark.parametrize("name", ["src_6_documents", "src_7_documents"])
def test_documents_are_written_by_several_tasks(spark, tmp_path, monkeypatch, name):
    rows = [(i, f'one "{i}",\ntwo', "en", "s", 9) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    tasks, write = [], queries.sinks.write_table
    monkeypatch.setattr(queries.sinks, "write_table", lambda df, *a, **k: tasks.append(df.rdd.getNumPartitions()) or write(df, *a, **k))
    got = queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted((int(r["doc_id"]), r["text"]) for r in got) == [(i, t) for i, t, *_ in rows] and tasks[0] > 1


def test_cells_by_column_are_those_by_row():
    table = pa.table({
        "s": ["a", None, "é"], "f": [1.0, -0.0, None], "i": [1, None, -3], "b": [True, None, False], "l": [[1, None], None, []],
        "t": pa.array([0, 1_500_000, None], pa.timestamp("us")),
    })
    batch = table.to_batches()[0]
    got = tables._cell_rows("p", 7, batch).to_pylist()
    assert [dict(r["cells"]) for r in got] == [{k: tables.as_text(v) for k, v in row.items()} for row in batch.to_pylist()]
    assert [(r["path"], r["row_index"]) for r in got] == [("p", 7), ("p", 8), ("p", 9)]
    assert tables._cell_rows("p", 0, batch.slice(0, 0)).num_rows == 0


def test_shared_columns_are_joined_after_the_rebalance(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, r int, v string")
    shared = spark.createDataFrame([("a", ["c", "d"]), ("b", ["e"])], "k string, cols array<string>")
    sinks.write_partitioned(rows, f"{tmp_path}/out", "k", "r", lookup=shared)
    got = spark.read.parquet(f"{tmp_path}/out").select("k", "r", "v", "cols").collect()
    assert sorted(map(tuple, got)) == [("a", 1, "x", ["c", "d"]), ("a", 2, "y", ["c", "d"]), ("b", 1, "z", ["e"])]


def test_shuffles_follow_the_input(spark, tmp_path, monkeypatch):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    (tmp_path / "part").write_bytes(b"x" * 1000)
    assert session.size_shuffles(spark, str(tmp_path)) == 8 and spark.conf.get(key, None) is None
    monkeypatch.setattr(session, "INPUT_A_PARTITION", 10)
    try:
        assert session.size_shuffles(spark, str(tmp_path)) == 100 and spark.conf.get(key) == "100"
    finally:
        spark.conf.unset(key)
