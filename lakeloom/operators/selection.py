"""Which types and subjects go into the lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.matching import keep_members
from lakeloom.sources.triples import WORDNET_PREFIX


def type_counts(types: DataFrame) -> DataFrame:
    return types.groupBy(F.col("cat_object").alias("type")).agg(F.count("*").alias("count"))


def largest(counts: DataFrame, k: int) -> DataFrame:
    """The k rows with the largest count, ties by name: a top-k, never a full sort."""
    return counts.orderBy(F.desc("count"), F.asc("type")).limit(k)


def top_types(types: DataFrame, k: int, prefix: str | None = WORDNET_PREFIX) -> DataFrame:
    """``(type, count)`` of the k most frequent types, with the prefix or of any kind."""
    if prefix is not None:
        types = types.filter(F.col("cat_object").startswith(prefix))
    return largest(type_counts(types), k)


def add_picked_types(
    top: DataFrame, types: DataFrame, picked: Sequence[str], k: int, dedupe: bool = True
) -> DataFrame:
    """Append hand-picked types, at most k of them.

    With ``dedupe`` a type that is already there is not appended again; without it
    an overlap is kept twice and doubles every row that is later joined to it.
    """
    extra = largest(type_counts(types.filter(F.col("cat_object").isin(list(picked)))), k)
    both = top.unionByName(extra)
    return both.dropDuplicates(["type"]) if dedupe else both


def first_types(selected: DataFrame, n: int | None) -> DataFrame:
    """The first n of the selected types, by count; all of them without n."""
    if n is None:
        return selected
    if n < 1:
        raise ValueError(f"the number of types must be at least 1, got {n}")
    return largest(selected, n)


def members(types: DataFrame, selected: DataFrame) -> DataFrame:
    """``(type, subject)`` of the selected types; duplicates stay."""
    named = types.select(F.col("cat_object").alias("type"), "subject")
    return named.join(selected.select("type"), "type")


def facts_of_types(facts: DataFrame, types: DataFrame, selected: DataFrame) -> DataFrame:
    """Facts whose subject has a selected type, with that type as ``cat_object_right``.

    A subject with k selected types gives each of its facts k times. The few selected
    types reach the types table first, so only their members meet the facts.
    """
    owned = members(types, selected).select("subject", F.col("type").alias("cat_object_right"))
    return facts.join(owned, "subject")


def subjects_of_top_types(types: DataFrame, k: int) -> DataFrame:
    """Subjects with one of the k most frequent types; one row per type they have among them."""
    return keep_members(types, "cat_object", top_types(types, k, prefix=None), "type").select("subject")


def type_predicate_counts(facts: DataFrame, types: DataFrame, selected: DataFrame | None = None) -> DataFrame:
    """``(type, predicate, count)``: how many subjects of the type have the predicate.

    Both sides are made distinct before they meet, so a subject with a huge number of
    facts reaches the join as one row per predicate and nothing is left to
    de-duplicate afterwards.
    """
    wanted = types if selected is None else keep_members(types, "cat_object", selected, "type")
    owned = wanted.select("subject", F.col("cat_object").alias("type")).distinct()
    used = facts.select("subject", "predicate").distinct()
    return (
        owned.join(used, "subject")
        .dropna()
        .groupBy("type", "predicate")
        .agg(F.count("*").alias("count"))
    )


def predicates_by_type(pairs: DataFrame) -> DataFrame:
    """Adjacency: per type the sorted set of its predicates."""
    return pairs.groupBy("type").agg(F.array_sort(F.collect_set("predicate")).alias("predicates"))


def representative_types(facts: DataFrame, types: DataFrame, n_subjects: int) -> DataFrame:
    """One type per subject for the subjects with the most facts, then subjects per type.

    Among the types of a subject the one with most members overall wins; equal
    counts go to the smaller name. This is a minimum over (−count, type), so no
    subject's types are ever gathered or sorted.
    """
    busiest = (
        facts.groupBy("subject")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "subject")
        .limit(n_subjects)
        .select("subject")
    )
    owned = types.select("subject", F.col("cat_object").alias("type")).join(busiest, "subject")
    ranked = owned.join(type_counts(types), "type")
    chosen = ranked.groupBy("subject").agg(F.min(F.struct(-F.col("count"), "type")).alias("best"))
    return (
        chosen.groupBy(F.col("best.type").alias("type"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "type")
    )


def frequent(counts: DataFrame, more_than: int) -> DataFrame:
    return counts.filter(F.col("count") > more_than)


def select_types_and_subjects(
    facts: DataFrame,
    types: DataFrame,
    strategy: str = "wordnet",
    top_k: int = 20,
    picked: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(facts of the selected types, selected types)`` for a lake-building strategy."""
    if strategy not in ("wordnet", "binary"):
        raise ValueError(f"unknown strategy {strategy}")
    selected = top_types(types, top_k)
    if picked is not None:
        selected = add_picked_types(selected, types, picked, top_k)
    return facts_of_types(facts, types, selected), selected
