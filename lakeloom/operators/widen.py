"""From triples to seed tables: one wide table per type, all types in one job.

Rows of every seed table share one shape, ``(seed_table, subject, row_key, attrs)``
with ``attrs`` a map from predicate to value. A table with real columns is cut out of
it by :func:`wide_table`. Widening a type with p predicates is one grouping per
subject, not a chain of p joins:

1. values of a (subject, predicate) pair become an array – at most ``max_fields`` of
   them, or all of them in pieces of bounded length;
2. the arrays of a subject become one map;
3. the map is joined to the types of the subject, and its row product – what a chain
   of left joins would give – is numbered and picked apart by index.

No step gathers an unbounded group. With ``max_fields`` the first k values are taken
before the shuffle (``row_number() <= k`` becomes a group limit on the map side).
Without it equal triples are counted first, and a pair with more values than
``PIECE``, repeats included, is split into pieces that live in different tasks: by value
hash, and a triple that repeats more often than that into several. The large pairs of a
subject span a grid of pieces. Its cells are numbered as one range, and one join on
(subject, predicate, piece) brings each cell its values, however many predicates are large.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.text import clean_name, clean_type_name, drop_brackets, strip_brackets
from lakeloom.functions.values import explode_range, is_text, to_number
from lakeloom.session import fresh_folder, pinned

# Most values of one (subject, predicate) pair that are held in one array.
PIECE = 10_000

# Fixed value: total width of a seed table with its type and subject columns.
MAX_TABLE_WIDTH = 15


# -- binary tables ----------------------------------------------------------


def binary_table(facts: DataFrame, predicate: str) -> DataFrame:
    """``(subject, <predicate name>)`` of one predicate."""
    name = predicate.strip("<").rstrip(">")
    return facts.filter(F.col("predicate") == predicate).select("subject", F.col("cat_object").alias(name))


def binary_rows(facts: DataFrame) -> DataFrame:
    """All binary tables at once: ``(table, predicate, subject, value)``; the number wins where there is one."""
    value = F.col("cat_object")
    if "num_object" in facts.columns:
        value = F.coalesce(F.col("num_object").cast("string"), value)
    return facts.select(
        F.concat(F.lit("binary-"), drop_brackets("predicate")).alias("table"),
        "predicate",
        "subject",
        value.alias("value"),
    )


def numeric_predicates(facts: DataFrame, by: Sequence[str] = ("predicate",), value: str = "cat_object") -> DataFrame:
    """Which columns become numbers: those where every non-null value is one, in one aggregate."""
    return facts.groupBy(*by).agg((F.count_if(is_text(value)) == 0).alias("is_numeric"))


def typed_binary_rows(facts: DataFrame) -> DataFrame:
    """Binary rows with ``number`` filled for tables whose values are all numbers, ``text`` for the others.

    The verdicts, one row per predicate, are found first and then joined to the facts.
    """
    rows = binary_rows(facts)
    numeric = pinned(numeric_predicates(rows, ["predicate"], "value"))
    return rows.join(numeric, "predicate").select(
        "table",
        "subject",
        F.when(F.col("is_numeric"), to_number("value")).alias("number"),
        F.when(~F.col("is_numeric"), F.col("value")).alias("text"),
    )


# -- values of a subject ----------------------------------------------------


def first_values(facts: DataFrame, k: int) -> DataFrame:
    """The first k values per subject and predicate in value order, with their rank; nulls come last."""
    order = Window.partitionBy("subject", "predicate").orderBy(F.col("cat_object").asc_nulls_last())
    return (
        facts.select("subject", "predicate", "cat_object")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )


def _map_fields(entries: Column) -> Column:
    """Array of (predicate, v, …) structs, sorted, to a map from predicate to its array of (v, n)."""
    names = F.array_distinct(entries["predicate"])
    return F.map_from_arrays(
        names,
        F.transform(
            names,
            lambda name: F.transform(
                F.filter(entries, lambda e: e["predicate"] == name), lambda e: F.struct(e["v"], e["n"])
            ),
        ),
    )


def _maps(entries: DataFrame, *order: str) -> DataFrame:
    """Rows of ``(subject, predicate, v, n)`` to ``(subject, fields)``, sorted by predicate and then ``order``."""
    # sort_array: array_sort compares by an interpreted function
    listed = F.sort_array(F.collect_list(F.struct("predicate", *order, "n")))
    return (
        entries.groupBy("subject").agg(listed.alias("listed")).select("subject", _map_fields(F.col("listed")).alias("fields"))
    )


def limited_fields(facts: DataFrame, max_fields: int) -> DataFrame:
    """``(subject, fields)`` with at most ``max_fields`` values per predicate."""
    if max_fields < 1:
        raise ValueError(f"max_fields must be at least 1, got {max_fields}")
    ranked = first_values(facts, max_fields)
    entries = ranked.withColumnRenamed("cat_object", "v").withColumn("n", F.lit(1).cast("long"))
    return _maps(entries, "rank", "v")


def _counted_values(facts: DataFrame) -> DataFrame:
    return facts.groupBy("subject", "predicate", F.col("cat_object").alias("v")).agg(F.count("*").alias("n"))


def all_fields(facts: DataFrame, piece: int = PIECE) -> tuple[DataFrame, DataFrame | None]:
    """``(subject, fields, pieces)`` with all values, and the pieces of the large pairs, None without any.

    A pair with more than ``piece`` values, repeats included, is not in ``fields``; ``pieces``
    maps its predicate to the number of pieces, and the values are in ``(subject, predicate,
    piece, vals)``. The counted values are written once to the shared folder, because two
    passes go over them: one finds the large pairs (usually none, and then the split is not
    in the plan), one builds the maps.
    """
    stage = fresh_folder(facts.sparkSession, "values")
    _counted_values(facts).write.parquet(stage)
    counted = facts.sparkSession.read.parquet(stage)
    large = pinned(
        counted.groupBy("subject", "predicate")
        .agg(F.sum("n").alias("size"))
        .filter(F.col("size") > piece)
        .select("subject", "predicate", F.ceil(F.col("size") / piece).alias("n_pieces"))
    )
    if large.isEmpty():
        return _maps(counted, "v").withColumn("pieces", F.lit(None).cast("map<string,bigint>")), None

    marked = counted.join(large, ["subject", "predicate"], "left")
    small = _maps(marked.filter("n_pieces is null"), "v")
    numbers = large.groupBy("subject").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("predicate", "n_pieces")))).alias("pieces")
    )
    # a value that repeats is cut too, its parts to pieces that follow one another
    parts = explode_range(marked.filter("n_pieces is not null"), F.ceil(F.col("n") / piece), "__chunk")
    place = F.pmod(F.pmod(F.xxhash64("v"), F.col("n_pieces")) + F.col("__chunk"), F.col("n_pieces"))
    cut = (
        parts.select(
            "subject", "predicate", "v", place.alias("piece"),
            F.least(F.lit(piece).cast("long"), F.col("n") - F.col("__chunk") * piece).alias("n"),
        )
        .groupBy("subject", "predicate", "piece")
        .agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("vals"))
    )
    return small.join(numbers, "subject", "full_outer"), cut


# -- seed subjects: one row per (type, subject) ------------------------------


def _counted_members(members: DataFrame) -> DataFrame:
    return members.groupBy(F.col("type").alias("seed_table"), "subject").agg(F.count("*").alias("copies"))


def long_subjects(facts: DataFrame, members: DataFrame, max_fields: int = 2) -> DataFrame:
    """``(seed_table, subject, fields)`` of subjects that have facts.

    A subject listed m times for a type repeats its facts m times, and the repeats use
    up ``max_fields``; the subject itself stays one.
    """
    copies = F.least(F.col("copies"), F.lit(max_fields)).cast("int")
    repeated = F.transform_values(
        "fields", lambda _, a: F.slice(F.flatten(F.transform(a, lambda x: F.array_repeat(x, copies))), 1, max_fields)
    )
    return (
        _counted_members(members)
        .join(limited_fields(facts, max_fields), "subject")
        .select(
            "seed_table",
            "subject",
            F.when(F.col("copies") > 1, repeated).otherwise(F.col("fields")).alias("fields"),
        )
    )


def chosen_predicates(pairs: DataFrame, max_table_width: int = MAX_TABLE_WIDTH) -> DataFrame:
    """``(type, predicates)``: the most frequent predicates that fit next to the type and subject columns."""
    order = Window.partitionBy("type").orderBy(F.desc("count"), F.asc("predicate"))
    return (
        pairs.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= max_table_width - 2)
        .groupBy("type")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "predicate")))["predicate"].alias("predicates"))
    )


def capped_rows(
    facts: DataFrame, members: DataFrame, predicates: DataFrame, piece: int = PIECE
) -> DataFrame:
    """Seed rows of the width-capped kind: members with all values of the chosen predicates.

    Members without facts stay, as one row without values; members listed twice give
    their rows twice.
    """
    return product_rows(capped_subjects(facts, members, predicates, piece))


def capped_subjects(
    facts: DataFrame, members: DataFrame, predicates: DataFrame, piece: int = PIECE
) -> DataFrame:
    """``(seed_table, subject, copies, fields, part)``: what :func:`capped_rows` multiplies.

    A subject with a large pair has one line per piece, numbered in ``part``.
    """
    used = predicates.select(F.explode("predicates").alias("predicate")).distinct()
    fields, values = all_fields(facts.join(used, "predicate").select("subject", "predicate", "cat_object"), piece)
    rows = (
        _counted_members(members)
        .join(predicates.withColumnRenamed("type", "seed_table"), "seed_table", "left")
        .join(fields, "subject", "left")
    )
    wanted = F.coalesce("predicates", F.array().cast("array<string>"))
    rows = rows.select(
        "seed_table",
        "subject",
        "copies",
        F.map_filter(
            F.coalesce("fields", F.map_from_arrays(F.array(), F.array()).cast(fields.schema["fields"].dataType)),
            lambda k, _: F.array_contains(wanted, k),
        ).alias("fields"),
        F.map_filter("pieces", lambda k, _: F.array_contains(wanted, k)).alias("pieces"),
        F.lit(0).cast("long").alias("part"),
    )
    if values is None:
        return rows.drop("pieces")
    return _on_grid(rows, values)


def _strides(sizes: Column) -> Column:
    """Products of the sizes before each place, and of all at the end."""
    one = F.array(F.lit(1).cast("long"))
    return F.aggregate(sizes, one, lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) * n)))


def _on_grid(rows: DataFrame, values: DataFrame) -> DataFrame:
    """Rows with large pairs once per cell of their grid of pieces, with the values of the cell's pieces.

    A cell is the ``part``-th of the range of all cells; its place on the axis of a predicate
    is the piece it needs. Cells go to different tasks before they ask for their pieces, and
    all that they ask for comes in one join. Of what a row has besides, one of its cell's
    requests carries a copy. A cell with a piece that got no value by its hash adds no row.
    """
    plain = rows.filter(F.coalesce(F.size("pieces"), F.lit(0)) == 0)
    hot = rows.filter(F.size("pieces") > 0).withColumn("__sizes", F.map_values("pieces"))
    cells = explode_range(
        hot.withColumn("__strides", _strides(F.col("__sizes"))).drop("part"),
        F.element_at("__strides", -1), "part", ("seed_table", "subject"),
    )
    asked = F.transform(
        F.map_keys("pieces"),
        lambda name, j: F.struct(
            name.alias("predicate"),
            F.pmod(F.call_function("div", F.col("part"), F.get("__strides", j)), F.get("__sizes", j)).alias("piece"),
            (j == 0).alias("carries"),
        ),
    )
    requests = cells.select("seed_table", "subject", "copies", "fields", "part", F.size("pieces").alias("__needs"), F.inline(asked))
    requests = requests.withColumn("fields", F.when(F.col("carries"), F.col("fields")))
    brought = requests.join(values, ["subject", "predicate", "piece"]).groupBy("seed_table", "subject", "copies", "part", "__needs")
    whole = brought.agg(
        F.first("fields", ignorenulls=True).alias("fields"), F.map_from_entries(F.collect_list(F.struct("predicate", "vals"))).alias("__values")
    ).filter(F.size("__values") == F.col("__needs"))
    full = whole.select("seed_table", "subject", "copies", F.map_concat("fields", "__values").alias("fields"), "part")
    return plain.select("seed_table", "subject", "copies", "fields", "part").unionByName(full)


# -- from subjects to rows ---------------------------------------------------


def _filled(attrs: Column) -> Column:
    return F.map_filter(attrs, lambda _, v: v.isNotNull())


def product_rows(subjects: DataFrame, spread: bool = False) -> DataFrame:
    """Seed rows ``(seed_table, subject, row_key, attrs)``: the row product of the value arrays.

    Row i of a subject takes value ``(i div stride) mod size`` of each predicate, a value
    that repeats as often as it does, so the product is a numbered range and is never held
    as a whole. ``copies`` of a subject are the last axis of the range. ``spread`` sends the
    blocks of a long range to different tasks, for subjects with very many rows.
    """
    names = set(subjects.columns)
    copies = F.col("copies") if "copies" in names else F.lit(1).cast("long")
    part = F.col("part") if "part" in names else F.lit(0).cast("long")
    # bounded: a piece has about PIECE values, repeats included
    repeated = lambda a: F.flatten(F.transform(a, lambda x: F.array_repeat(x["v"], x["n"].cast("int"))))
    arrays = F.transform(
        F.map_values("fields"), lambda a: F.when(F.array_max(a["n"]) <= 1, a["v"]).otherwise(repeated(a))
    )
    numbered = subjects.select(
        "seed_table", "subject", copies.alias("copies"), part.alias("part"), F.map_keys("fields").alias("names"), arrays.alias("arrays")
    )
    numbered = numbered.withColumn("strides", _strides(F.transform("arrays", lambda a: F.size(a).cast("long"))))
    keys = ("seed_table", "subject", "part") if spread else ()
    rows = explode_range(numbered, F.element_at("strides", -1) * F.col("copies"), "i", keys)
    picked = F.transform(
        "arrays",
        lambda a, j: F.get(
            a,
            F.pmod(
                F.call_function("div", F.col("i"), F.get("strides", j)),
                F.size(a).cast("long"),
            ).cast("int"),
        ),
    )
    return rows.select(
        "seed_table",
        "subject",
        F.xxhash64("seed_table", "subject", "part", "i").alias("row_key"),
        _filled(F.map_from_arrays("names", picked)).alias("attrs"),
    )


def product_sizes(subjects: DataFrame) -> DataFrame:
    """``(seed_table, n_rows, largest)``: rows each table will have, and the most from one subject.

    A look ahead before rows multiply; a large figure calls for a smaller ``max_fields``.
    """
    copies = F.col("copies") if "copies" in subjects.columns else F.lit(1)
    values = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x["n"])
    size = F.aggregate(F.map_values("fields"), copies.cast("double"), lambda acc, a: acc * values(a))
    return subjects.groupBy("seed_table").agg(
        F.sum(size).cast("long").alias("n_rows"), F.max(size).cast("long").alias("largest")
    )


def full_rows(subjects: DataFrame, max_fields: int = 2) -> DataFrame:
    """Seed rows of the full kind: one row per subject, columns ``predicate_0 … predicate_{k-1}``."""
    entries = F.flatten(
        F.transform(
            F.map_entries("fields"),
            lambda e: F.transform(
                F.sequence(F.lit(0), F.lit(max_fields - 1)),
                lambda i: F.struct(
                    F.concat(e["key"], F.lit("_"), i.cast("string")).alias("key"),
                    F.get(e["value"], i)["v"].alias("value"),
                ),
            ),
        )
    )
    return subjects.select(
        "seed_table",
        "subject",
        F.xxhash64("seed_table", "subject").alias("row_key"),
        _filled(F.map_from_entries(entries)).alias("attrs"),
    )


# -- columns of the seed tables -----------------------------------------------


def table_columns(rows: DataFrame) -> DataFrame:
    """``(seed_table, column, n_values, is_numeric)`` of the columns that hold a value in some row."""
    return (
        rows.select("seed_table", F.explode("attrs").alias("column", "value"))
        .groupBy("seed_table", "column")
        .agg(F.count("*").alias("n_values"), (F.count_if(is_text("value")) == 0).alias("is_numeric"))
    )


def subject_columns(subjects: DataFrame, max_fields: int | None = None) -> DataFrame:
    """The same from seed subjects, before rows multiply; also finds columns without a value.

    With ``max_fields`` the columns are those of the full kind, where a predicate has
    ``max_fields`` columns even if no subject has that many values. A column without
    a value counts as numeric.
    """
    cells = subjects.select("seed_table", F.explode("fields").alias("predicate", "vals"))
    if max_fields is None:
        cells = cells.select("seed_table", F.col("predicate").alias("column"), F.explode("vals.v").alias("value"))
    else:
        places = F.array(*[F.struct(F.lit(i).alias("i")) for i in range(max_fields)])
        cells = cells.select("seed_table", "predicate", "vals", F.inline(places)).select(
            "seed_table",
            F.concat("predicate", F.lit("_"), F.col("i").cast("string")).alias("column"),
            F.get("vals", F.col("i"))["v"].alias("value"),
        )
    return cells.groupBy("seed_table", "column").agg(
        F.count("value").alias("n_values"), (F.count_if(is_text("value")) == 0).alias("is_numeric")
    )


def seed_names(tables: DataFrame, kind: str = "long") -> DataFrame:
    """``(seed_table, name)``: export names; types with the same clean name get a number from the second on."""
    clean = clean_type_name("seed_table") if kind == "wordnet" else clean_name("seed_table")
    order = Window.partitionBy("clean").orderBy("seed_table")
    return (
        tables.select("seed_table")
        .distinct()
        .withColumn("clean", clean)
        .withColumn("rank", F.row_number().over(order))
        .select(
            "seed_table",
            F.when(F.col("rank") == 1, F.col("clean"))
            .otherwise(F.concat_ws("_", "clean", F.col("rank").cast("string")))
            .alias("name"),
        )
    )


def wide_table(
    rows: DataFrame,
    seed_table: str,
    columns: Sequence[tuple[str, str, bool]],
    key: str = "subject",
    with_type: bool = False,
) -> DataFrame:
    """One seed table with real columns: ``columns`` lists (attribute, column name, numeric)."""
    chosen = rows.filter(F.col("seed_table") == seed_table)
    keys = [F.col("seed_table").alias("type")] if with_type else []
    cells = [
        (to_number(F.col("attrs")[raw]) if numeric else F.col("attrs")[raw]).alias(name)
        for raw, name, numeric in columns
    ]
    return chosen.select(*keys, F.col("subject").alias(key), *cells)


def listed_columns(columns: DataFrame, seed_table: str, kind: str = "long") -> list[tuple[str, str, bool]]:
    """The column list of one table for :func:`wide_table`, sorted by attribute: metadata, a few names."""
    clean = strip_brackets("column") if kind == "wordnet" else clean_name("column")
    found = columns.filter(F.col("seed_table") == seed_table).select("column", clean.alias("name"), "is_numeric")
    return [(r["column"], r["name"], r["is_numeric"]) for r in sorted(found.collect())]


# -- the plain chain, for a handful of predicates ------------------------------


def join_chain(base: DataFrame, tables: Sequence[DataFrame], key: str = "subject") -> DataFrame:
    """Successive left joins of ``(key, value)`` tables; the small-scale form of the row product."""
    return reduce(lambda acc, t: acc.join(t, key, "left"), tables, base)


# -- type-wide numeric casts ----------------------------------------------------


def cast_features(df: DataFrame) -> DataFrame:
    """Text columns become double where every non-null value is a number; one aggregate for all columns."""
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    if not text:
        return df
    bad = df.agg(*[F.count_if(is_text(F.col(f"`{c}`"))).alias(c) for c in text]).first()
    return df.select(
        *[
            to_number(F.col(f"`{c}`")).alias(c) if c in text and bad[c] == 0 else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
