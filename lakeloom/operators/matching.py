"""Filters and joins by key.

Joins carry no broadcast hint: Catalyst broadcasts a side it knows to be small and
sorts and merges otherwise, with AQE splitting skewed partitions at run time. What
is done by hand is to shrink the right side first, so a key that holds a third of
all rows arrives at the join as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.values import non_null_all, non_null_any


def _keys(df: DataFrame, key: str, other: DataFrame, other_key: str) -> tuple[DataFrame, Column]:
    keys = other.select(F.col(other_key).alias("__key")).distinct()
    return keys, df[key] == keys["__key"]


def keep_members(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows whose key occurs in the other table; null keys are not members."""
    keys, same = _keys(df, key, other, other_key)
    return df.join(keys, same, "left_semi")


def keep_strangers(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows whose key does not occur in the other table; null keys are left out too."""
    keys, same = _keys(df, key, other, other_key)
    return df.filter(F.col(key).isNotNull()).join(keys, same, "left_anti")


def keep_any_value(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(non_null_any(columns))


def keep_all_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(non_null_all(columns))


def drop_empty_columns(df: DataFrame, always: Sequence[str] = ()) -> DataFrame:
    """Leave out columns without a single value: one aggregate over all columns, then a projection."""
    tested = [c for c in df.columns if c not in always]
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in tested]).first().asDict() if tested else {}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in always or filled[c] > 0])


def numeric_columns(df: DataFrame) -> list[str]:
    from pyspark.sql.types import NumericType

    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def text_columns(df: DataFrame, leave_out: Sequence[str] = ("subject",)) -> list[str]:
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c not in numeric and c not in leave_out]


def typed_facts(facts: DataFrame, types: DataFrame, inner: bool = True) -> DataFrame:
    """Facts with the type of their subject as ``type``; a subject with k types gives each fact k times."""
    named = types.select("subject", F.col("cat_object").alias("type"))
    return named.join(facts, "subject", "inner" if inner else "left")


def lookup(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join with a lookup table on a column that both have."""
    return df.join(table, key)


def match_any_case(df: DataFrame, key: str, subjects: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Distinct pairs of rows and subjects whose names agree up to upper and lower case."""
    known = subjects.select("subject").distinct().withColumn("__lower", F.lower("subject"))
    return df.join(known, df[key] == known["__lower"]).select(*keep, "subject").distinct()


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once, with the number of occurrences as ``count``."""
    counts = df.groupBy(key).agg(F.count("*").alias("count")).filter("count > 1")
    return df.join(counts, key)
