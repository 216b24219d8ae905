"""Text, number and date rules on hand-made values."""

import random

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import text, values


def apply(spark, expression, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression("x")).collect()]


@pytest.mark.parametrize(
    "expression, inputs, outputs",
    [
        (
            text.clean_type_name,
            ["<wordnet_country_108544813>", "<name_123>", "plain", "<wordnet_o'hare_1>"],
            ["wordnet_country", "name", "plain", "<wordnet_o'hare_1>"],
        ),
        (text.clean_name, ["<abc_1>", "<wordnet_o'hare_1>", "<is,_a>"], ["abc_1", "<wordnet_o'hare_1>", "<is,_a>"]),
        (text.strip_brackets, ["<a>", "<<a>>", "a<>", "><a"], ["a", "a", "a<", "><a"]),
        (text.drop_brackets, ["<a<b>>"], ["ab"]),
        (text.title_case, ["MIAMI-DADE", "o'brien", "new york", "3rd st."], ["Miami-Dade", "O'Brien", "New York", "3Rd St."]),
        (text.replace_first_space, ["a b c", "ab", " a b"], ["a_b c", "ab", "_a b"]),
        (text.organisation_key, ["Big Red Co"], ["<big_red co>"]),
        (
            values.full_date,
            ["1955-11-##^^xsd:date", "1955^^xsd:gYear", "-0044-03-15^^xsd:date", "1999-12-31^^xsd:date", "1955-1-2^^x"],
            [None, None, "-0044-03-15", "1999-12-31", None],
        ),
        (
            values.to_number,
            ["1d", " 1 ", "1e3", "-.5", "+7.", "inf", "nan", "", None],
            [None, None, 1000.0, -0.5, 7.0, None, None, None, None],
        ),
    ],
)
def test_expression(spark, expression, inputs, outputs):
    if expression is text.strip_brackets:
        outputs = [x.strip("<").rstrip(">") for x in inputs]
    if expression is text.title_case:
        outputs = [x.title() for x in inputs]
    assert apply(spark, expression, inputs) == outputs


def test_county_key(spark):
    df = spark.createDataFrame([("New County", "Louisiana"), ("Los Angeles", "California")], "c string, s string")
    keys = [r[0] for r in df.select(text.county_key("c", "s")).collect()]
    assert keys == ["<New_Parish_Parish,_Louisiana>", "<Los_Angeles_County,_California>"]


def test_lake_table_name_starts_with_underscore(spark):
    df = spark.createDataFrame([("wordnet-wordnet_country",), ("wordnet-wordnet_a_b_c",)], "t string")
    names = [r[0] for r in df.select(text.lake_table_name("t", F.array(F.lit("x"), F.lit("y")))).collect()]
    assert names == ["_x_y", "b_c_x_y"]


def test_open_date_range(spark):
    days = ["2019-01-01", "2019-01-01 00:00:01", "2019-12-30 23:59:59", "2019-12-31", "2019-12-31 10:00:00", "x"]
    inside = apply(spark, lambda c: values.between_open(c, "2019-01-01", "2019-12-31"), days)
    assert inside == [False, True, True, False, False, None]


def test_log10_of_zero(spark):
    assert apply(spark, values.log10_or_minus_inf, ["0", "100"]) == [float("-inf"), 2.0]


def test_explode_range_crosses_blocks(spark, monkeypatch):
    monkeypatch.setattr(values, "RANGE_STEP", 3)
    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", 3)], "k string, n int")
    got = sorted((r["k"], r["i"]) for r in values.explode_range(df, F.col("n"), "i").collect())
    assert got == [("a", i) for i in range(7)] + [("c", i) for i in range(3)]


def test_numbers_end_where_the_text_ends(spark):
    from lakeloom.functions.values import is_number

    df = spark.createDataFrame([("1",), ("1\n",), ("1e3",), (" 1",)], "v string")
    assert [r[0] for r in df.select(is_number("v")).collect()] == [True, False, True, False]


def test_csv_keeps_quotes_blanks_and_line_breaks(spark, tmp_path):
    from lakeloom.sources import sinks, tables

    rows = [('Smith "Bob", Inc', " a "), ("two\nlines", '"'), ("plain", "back\\slash")]
    df = spark.createDataFrame(rows, "name string, note string")
    path = sinks.write_table(df, str(tmp_path), "", "t", "csv")
    assert {tuple(r) for r in tables.read_csv(spark, path, df.schema).collect()} == set(rows)
    text = "".join(p.read_text() for p in (tmp_path / "t.csv").glob("*.csv"))
    assert '"Smith ""Bob"", Inc"' in text


def one_task(spark, path, schema):
    return spark.read.options(header=True, quote='"', escape='"', multiLine=True).schema(schema).csv(path)


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_csv_blocks_equal_one_task(spark, tmp_path, ends):
    """Records over several lines and blocks, quotes, blank lines: as one task reads them."""
    from lakeloom.sources import csv_blocks, tables

    rng = random.Random(8)
    texts = ["plain", "", 'say "hi"', "two\nlines", '"\n"', "a,b\n\n\nc", 'x"\n"y\n' * 9, "long line\n" * 400, '""', " blank "]
    rows = [(str(i), rng.choice(texts), None if i % 7 == 0 else rng.choice(texts)) for i in range(800)]
    quoted = lambda v: "" if v is None else '"' + v.replace('"', '""') + '"'
    for part in range(2):
        body = [",".join(map(quoted, r)) for r in rows[part::2]]
        text = "id,a,b" + ends + ends.join(line + (ends if rng.random() < 0.05 else "") for line in body) + (ends if part else "")
        (tmp_path / f"{part}.csv").write_bytes(text.encode())
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "3000")
    try:
        got = tables.read_csv_text(spark, str(tmp_path)).collect()
        blocks = csv_blocks.records(spark, str(tmp_path)).select("path", "block").distinct().count()
    finally:
        spark.conf.set(size, before)
    assert blocks > 20  # of two files
    assert sorted(got, key=lambda r: int(r["id"])) == sorted(one_task(spark, str(tmp_path), "id string, a string, b string").collect(), key=lambda r: int(r["id"]))
    assert {tuple(r) for r in got} == {tuple(v or None for v in r) for r in rows}  # an empty field is null, quoted or not


def test_csv_types_are_inferred(spark, tmp_path):
    from lakeloom.sources import tables

    (tmp_path / "t.csv").write_text('i,l,d,t,s,b,n,"m\nn"\n1,12345678901,1.5,2024-01-02,x,true,,a\n-2,,1e3,2024-02-03,"y\nz",FALSE,,2024-01-01 10:00:00\n')
    df = tables.read_csv(spark, str(tmp_path / "t.csv"))
    assert df.dtypes == [("i", "int"), ("l", "bigint"), ("d", "double"), ("t", "date"), ("s", "string"), ("b", "boolean"), ("n", "string"), ("m\nn", "string")]
    assert [tuple(r)[:3] for r in df.orderBy("i").collect()] == [(-2, None, 1000.0), (1, 12345678901, 1.5)]
    (tmp_path / "empty.csv").write_text("a,b\n")
    assert tables.read_csv(spark, str(tmp_path / "empty.csv")).collect() == []


def test_quartiles_are_exact_at_any_size(spark):
    from pyspark.sql import functions as F

    from lakeloom.operators.profiling import describe

    df = spark.range(300_001).select(((F.col("id") * 7919) % 300_001).alias("n"), F.lit("x").alias("t"))
    row = describe(df).filter("column = 'n'").first()
    assert (row["q25"], row["q50"], row["q75"]) == (75000.0, 150000.0, 225000.0)


def test_codes_number_all_labels_in_order(spark):
    from pyspark.sql import functions as F

    from lakeloom.operators.profiling import category_codes

    df = spark.range(5000).select(F.format_string("l%05d", F.col("id")).alias("c"))
    assert all(int(r["label"][1:]) == r["code"] for r in category_codes(df, "c").collect())
