"""Counts and summaries of triples and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import first_piece
from lakeloom.operators.ranges import running_sum
from lakeloom.operators.matching import keep_members
from lakeloom.operators.selection import type_counts


def unique_predicates(df: DataFrame) -> DataFrame:
    return df.select("predicate").distinct()


def value_counts(df: DataFrame, column: str | None = None, descending: bool = True) -> DataFrame:
    """Values of a column with their counts, sorted by count."""
    if column is None:
        raise ValueError("no column given")
    if column not in df.columns:
        raise KeyError(f"column {column} not found")
    order = F.desc("count") if descending else F.asc("count")
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy(order, column)


def first_type_and_count(types: DataFrame) -> DataFrame:
    """Per subject its smallest type and how many types it has, most types first."""
    return (
        types.groupBy("subject")
        .agg(F.min("cat_object").alias("cat_object"), F.count("*").alias("count"))
        .orderBy(F.desc("count"), "subject")
    )


def triples_per_subject(facts: DataFrame) -> DataFrame:
    return value_counts(facts, "subject")


def busiest_subject_predicates(facts: DataFrame) -> DataFrame:
    """Predicate counts of the subject with the most triples."""
    top = triples_per_subject(facts).limit(1)
    return value_counts(keep_members(facts, "subject", top, "subject"), "predicate")


def type_families(types: DataFrame) -> DataFrame:
    """Types grouped by the text before the first underscore: distinct subjects and distinct types.

    The two distinct counts are taken in two steps each (distinct rows, then a plain
    count), so that a family with a third of all rows is spread over many tasks.
    """
    family = first_piece("cat_object", "_").alias("typecat")
    subjects = (
        types.select(family, "subject").distinct().groupBy("typecat").agg(F.count("*").alias("subject"))
    )
    names = (
        types.select(family, "cat_object").distinct().groupBy("typecat").agg(F.count("*").alias("cat_object"))
    )
    return subjects.join(names, subjects["typecat"].eqNullSafe(names["typecat"])).select(
        subjects["typecat"], "subject", "cat_object"
    )


def facts_per_subject_summary(facts: DataFrame, subjects: DataFrame) -> DataFrame:
    """Mean and median number of facts per subject, for the given subjects.

    The median is taken over a histogram (fact count → subjects), which is tiny
    however many subjects there are.
    """
    per_subject = (
        keep_members(facts, "subject", subjects, "subject").groupBy("subject").agg(F.count("*").alias("count"))
    )
    histogram = per_subject.groupBy("count").agg(F.count("*").alias("subjects"))
    return histogram.agg(
        (F.sum(F.col("count") * F.col("subjects")) / F.sum("subjects")).alias("mean"),
        F.percentile("count", F.lit(0.5), F.col("subjects")).alias("median"),
    )


def group_means_and_modes(
    df: DataFrame, keys: Sequence[str], means: Sequence[str], modes: Sequence[str]
) -> DataFrame:
    """Per group the mean of some columns and the most frequent value of others.

    Modes are counted as (group, column, value) first; the winner is a minimum over
    (−count, value), so ties go to the smallest value, nulls never win, and no group
    keeps a table of its values in memory.
    """
    keys = list(keys)
    mean_part = df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in means])
    if not modes:
        return mean_part
    long = df.select(
        *keys,
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")) for c in modes])
        ).alias("__cell"),
    ).select(*keys, "__cell.name", "__cell.value")
    counts = long.filter("value is not null").groupBy(*keys, "name", "value").agg(F.count("*").alias("n"))
    winners = counts.groupBy(*keys).agg(
        *[
            F.min(F.when(F.col("name") == c, F.struct(-F.col("n"), F.col("value"))))["value"].alias(c)
            for c in modes
        ]
    )
    left, right = mean_part.alias("l"), winners.alias("r")
    same = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return left.join(right, condition, "left").select(
        *[F.col(f"l.`{c}`") for c in [*keys, *means]],
        *[F.col(f"r.`{c}`").cast(df.schema[c].dataType).alias(c) for c in modes],
    )


def log_counts(df: DataFrame, keys: Sequence[str], key: str) -> DataFrame:
    """``(key, target)`` where target is log10 of the rows in each group of ``keys``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).select(key, F.log10("n").alias("target"))


def null_share(df: DataFrame) -> DataFrame:
    """Share of nulls per column, in percent: one row, one pass."""
    return df.agg(
        *[F.avg(F.when(F.col(f"`{c}`").isNull(), 100.0).otherwise(0.0)).alias(c) for c in df.columns]
    )


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, q25, q50, q75)``: the smallest value that so many of the values do not exceed.

    Exact at any size: values are counted, and the rank is found in running counts.
    """
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    )
    counts = df.select(cells.alias("cell")).select("cell.*").filter("value is not null").groupBy("column", "value")
    upto = running_sum(counts.agg(F.count("*").alias("n")), "n", "upto", ["value"], ["column"])
    totals = upto.groupBy("column").agg(F.max("upto").alias("total"))
    parts = [
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("value"))).alias(name)
        for k, name in ((1, "q25"), (2, "q50"), (3, "q75"))
    ]
    return upto.join(totals, "column").groupBy("column").agg(*parts)


def describe(df: DataFrame) -> DataFrame:
    """One row per column: count, null count, mean, deviation, least, greatest, exact quartiles.

    Text columns have no mean, deviation or quartiles.
    """
    from lakeloom.operators.matching import numeric_columns

    numeric = set(numeric_columns(df))
    cells = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        none = F.lit(None).cast("double")
        number = x.cast("double")
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("count"),
                F.count_if(x.isNull()).alias("null_count"),
                (F.avg(number) if c in numeric else none).alias("mean"),
                (F.stddev(number) if c in numeric else none).alias("std"),
                F.min(x).cast("string").alias("min"),
                F.max(x).cast("string").alias("max"),
            )
        )
    described = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    if not numeric:
        return described.select("*", *[F.lit(None).cast("double").alias(q) for q in ("q25", "q50", "q75")])
    return described.join(quartiles(df, [c for c in df.columns if c in numeric]), "column", "left")


def types_with_prefix(types: DataFrame, prefix: str) -> DataFrame:
    return types.filter(F.col("cat_object").startswith(prefix)).select("cat_object").distinct()


def number_of_types(types: DataFrame, prefix: str) -> DataFrame:
    return types_with_prefix(types, prefix).agg(F.count("*").alias("n_groups"))


def subjects_by_type(types: DataFrame) -> DataFrame:
    """``(type, subject, count)``: the members of every type, one row each, with the number of them.

    Members stay rows, so that a type with a third of all subjects is no single row.
    """
    rows = types.select(F.col("cat_object").alias("type"), "subject")
    return rows.join(type_counts(types), "type").select("type", "subject", "count")


def node_degrees(edges: DataFrame, left: str = "type", right: str = "predicate") -> DataFrame:
    """Degree of every node in the undirected graph of the edge list."""
    both = edges.select(F.col(left).alias("node"), F.col(right).alias("other")).unionByName(
        edges.select(F.col(right).alias("node"), F.col(left).alias("other"))
    )
    return both.distinct().groupBy("node").agg(F.count("*").alias("degree"))


def largest_per_key(df: DataFrame, key: str, target: str) -> DataFrame:
    """One row per key, the one with the largest target; the other columns break ties."""
    others = [c for c in df.columns if c not in (key, target)]
    best = df.groupBy(key).agg(F.max(F.struct(target, *others)).alias("__best"))
    return best.select(key, *[F.col(f"__best.`{c}`").alias(c) for c in df.columns if c != key])


def category_codes(values: DataFrame, column: str) -> DataFrame:
    """``(label, code)``: distinct values numbered from 0 in sorted order.

    Labels are dealt into ranges and numbered there; no task holds all of them.
    """
    labels = values.select(F.col(column).alias("label")).distinct().withColumn("one", F.lit(1).cast("long"))
    return running_sum(labels, "one", "upto", ["label"]).select("label", (F.col("upto") - 1).cast("int").alias("code"))
