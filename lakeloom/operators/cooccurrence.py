"""Items that occur together under one key: types of a subject, predicates of a subject.

Pairs are never built from rows. A key is first reduced to its signature (its sorted
items, with counts where they matter), equal signatures are counted, and only the few
distinct signatures are paired with themselves. A key with a third of all rows is one
signature, no longer than the number of distinct items.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cooccurring_pairs(df: DataFrame, item: str, key: str = "subject", distinct: bool = False) -> DataFrame:
    """``(item, item_right, count)``, self pairs and both orders included.

    ``count`` is the number of row pairs of the self-join on the key; with ``distinct``
    each item counts once per key, so it is the number of keys that have both.
    """
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key, F.col(item).alias("item"))
    once = per_key.agg(F.lit(1).cast("long").alias("n") if distinct else F.count("*").alias("n"))
    signatures = (
        once.groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("item", "n"))).alias("signature"))
        .groupBy("signature")
        .agg(F.count("*").alias("keys"))
    )
    return (
        signatures.select("keys", "signature", F.explode("signature").alias("l"))
        .select("keys", "l", F.explode("signature").alias("r"))
        .groupBy(F.col("l.item").alias(item), F.col("r.item").alias(f"{item}_right"))
        .agg(F.sum(F.col("l.n") * F.col("r.n") * F.col("keys")).alias("count"))
    )


def one_partner(pairs: DataFrame, item: str = "predicate") -> DataFrame:
    """For every right item one left item it occurs with, the smallest."""
    return pairs.groupBy(f"{item}_right").agg(F.min(item).alias(item))


def pair_difference(left: DataFrame, right: DataFrame, item: str = "predicate") -> DataFrame:
    """Two pair-count tables compared: presence (0/1) and count of the left minus the right."""
    names = [item, f"{item}_right"]
    a = left.select(*names, F.col("count").alias("a"))
    b = right.select(*names, F.col("count").alias("b"))
    n_a, n_b = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    return a.join(b, names, "full_outer").select(
        *names,
        ((n_a > 0).cast("int") - (n_b > 0).cast("int")).alias("presence_diff"),
        (n_a - n_b).alias("count_diff"),
    )


def dense_matrix(pairs: DataFrame, item: str = "predicate", labels: Sequence[str] | None = None) -> DataFrame:
    """Pair counts as a square table, zero where a pair is missing.

    The columns are the labels given, else all distinct ones, any number of them. Where a
    table so wide is no use, give the labels block by block; the sparse pairs have it all.
    """
    if labels is None:
        labels = [r[0] for r in pairs.select(f"{item}_right").distinct().collect()]
    return pairs.groupBy(item).pivot(f"{item}_right", sorted(labels)).agg(F.sum("count")).na.fill(0)
