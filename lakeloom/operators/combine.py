"""Column combinations: which sets of columns have enough rows, and the tables cut from them.

Counting never touches the rows more than once. Rows are reduced to null patterns
(which columns hold a value) with their counts; a combination's "all non-null" count
is the weight of the patterns that contain it, and its "any non-null" count follows
from those of its subsets by inclusion and exclusion. Everything after the patterns
works on table metadata.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.values import table_id
from lakeloom.session import pinned

POLICIES = ("any", "all")

# Rows of a subject that are held in one array, and rows that a task cuts from its subjects.
SUBJECT_ROWS = 64
TASK_ROWS = 2_000_000


def null_patterns(rows: DataFrame) -> DataFrame:
    """``(seed_table, pattern, n)``: sorted names of the filled columns, and rows that have just these."""
    return rows.groupBy("seed_table", F.array_sort(F.map_keys("attrs")).alias("pattern")).agg(
        F.count("*").alias("n")
    )


def _choose(df: DataFrame, source: str, size: int, out: str) -> DataFrame:
    """Every choice of ``size`` places of the array ``source``, in array order."""
    kept = df.columns
    step = df.withColumn(out, F.array().cast("array<string>")).withColumn("__last", F.lit(-1))
    length = F.size(source)
    for _ in range(size):
        step = (
            step.filter(F.col("__last") + 1 < length)
            .withColumn("__last", F.explode(F.sequence(F.col("__last") + 1, length - 1)))
            .withColumn(out, F.concat(out, F.array(F.get(source, F.col("__last")))))
        )
    return step.select(*kept, out)


def column_combinations(tables: DataFrame, size: int) -> DataFrame:
    """``(seed_table, cols)`` for tables given as ``(seed_table, columns)``."""
    return _choose(tables, "columns", size, "cols").drop("columns")


def combination_counts(patterns: DataFrame, tables: DataFrame, size: int) -> DataFrame:
    """``(seed_table, cols, any_count, all_count)`` for every combination of the tables' columns."""
    supports = reduce(
        DataFrame.unionByName,
        [
            _choose(patterns, "pattern", s, "key").groupBy("seed_table", "key").agg(F.sum("n").alias("n"))
            for s in range(1, size + 1)
        ],
    )
    whole = (1 << size) - 1
    subsets = F.array(
        *[
            F.struct(
                F.lit(mask == whole).alias("whole"),
                F.lit(1 if bin(mask).count("1") % 2 else -1).alias("sign"),
                F.array(*[F.lit(i) for i in range(size) if mask >> i & 1]).alias("places"),
            )
            for mask in range(1, whole + 1)
        ]
    )
    terms = (
        column_combinations(tables, size)
        .select("seed_table", "cols", F.array_sort("cols").alias("sorted"), F.inline(subsets))
        .withColumn("key", F.transform("places", lambda i: F.get("sorted", i)))
        .drop("sorted", "places")
    )
    n = F.coalesce("n", F.lit(0))
    return (
        terms.join(supports, ["seed_table", "key"], "left")
        .groupBy("seed_table", "cols")
        .agg(F.sum(F.col("sign") * n).alias("any_count"), F.sum(F.when(F.col("whole"), n)).alias("all_count"))
    )


def rich_combinations(counts: DataFrame, min_occurrences: int, policy: str = "any", strict: bool = False) -> DataFrame:
    """Specs ``(seed_table, subtable_id, cols)`` of the combinations with enough rows."""
    if policy not in POLICIES:
        raise ValueError(f"null policy must be one of {POLICIES}, got {policy}")
    count = F.col(f"{policy}_count")
    enough = count > min_occurrences if strict else count >= min_occurrences
    return counts.filter(enough).select("seed_table", table_id(F.col("cols")).alias("subtable_id"), "cols")


def passes(attrs: Column, cols: Column, policy: str) -> Column:
    """Does a row hold a value in any of the columns, or in all of them; absent keys are the nulls."""
    filled = F.map_keys(attrs)
    return F.arrays_overlap(filled, cols) if policy == "any" else F.size(F.array_except(cols, filled)) == 0


def cut_rows(rows: DataFrame, specs: DataFrame, policy: str = "any") -> DataFrame:
    """Rows of all subtables: seed columns, spec columns and ``cells``, aligned with ``cols``.

    The specs of a seed table travel as one array, so each row meets them once and
    keeps its place; the spec side is metadata and is broadcast when it is small.
    Cells are read after the null test, and not at all by who only counts rows.
    """
    extra = [c for c in specs.columns if c != "seed_table"]
    by_table = specs.groupBy("seed_table").agg(F.collect_list(F.struct(*extra)).alias("specs"))
    cut = rows.join(by_table, "seed_table").select("seed_table", "subject", "row_key", "attrs", F.inline("specs"))
    attrs = F.col("attrs")
    return (
        cut.filter(passes(attrs, F.col("cols"), policy))
        .withColumn("cells", F.transform("cols", lambda c: attrs[c]))
        .drop("attrs")
    )


def _subject_lists(rows: DataFrame, counts: DataFrame, policy: str) -> tuple[DataFrame, DataFrame | None]:
    """``(seed_table, subject, rows)`` of the subjects with few rows, and the rows of those with more than ``SUBJECT_ROWS``.

    The second is None without any, and then the split is not in the plan. How many tasks the
    first has follows from the rows that will be cut, which the counts of combinations tell.
    """
    spark = rows.sparkSession
    many = pinned(
        rows.groupBy("seed_table", "subject").agg(F.count("*").alias("n")).filter(F.col("n") > SUBJECT_ROWS).drop("n")
    )
    rows, hot = rows.select("seed_table", "subject", "attrs"), None
    if not many.isEmpty():
        named = many.select(F.col("seed_table").alias("__table"), F.col("subject").alias("__subject"))
        same = F.col("seed_table").eqNullSafe(F.col("__table")) & F.col("subject").eqNullSafe(F.col("__subject"))
        rows, hot = rows.join(named, same, "left_anti"), rows.join(named, same, "left_semi")
    cut = counts.agg(F.sum(f"{policy}_count")).first()[0] or 0
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-cut // TASK_ROWS))
    dealt = rows.repartition(tasks, "seed_table", "subject")
    return dealt.groupBy("seed_table", "subject").agg(F.collect_list("attrs").alias("rows")), hot


def _subject_cuts(subjects: DataFrame, specs: DataFrame, policy: str) -> DataFrame:
    """``(seed_table, subject, subtable_id, different)``: the different cells of a subject's rows in each of its specs."""
    by_table = specs.groupBy("seed_table").agg(F.collect_list(F.struct("subtable_id", "cols")).alias("specs"))
    met = subjects.join(by_table, "seed_table").select("seed_table", "subject", "rows", F.inline("specs"))
    kept = F.filter("rows", lambda attrs: passes(attrs, F.col("cols"), policy))
    cells = F.transform(kept, lambda attrs: F.transform("cols", lambda c: attrs[c]))
    return met.select("seed_table", "subject", "subtable_id", F.array_distinct(cells).alias("different"))


def _hot_rows(hot: DataFrame, specs: DataFrame, policy: str) -> DataFrame:
    """Different rows of subjects with many, each dealt by all that it holds."""
    bare = hot.withColumn("row_key", F.lit(None).cast("long"))
    return cut_rows(bare, specs, policy).select("seed_table", "subtable_id", "subject", "cells").distinct()


def _different_sizes(subjects: DataFrame, hot: DataFrame | None, specs: DataFrame, policy: str) -> DataFrame:
    """``(seed_table, subtable_id, n)`` that sum up to the different rows of each combination."""
    sizes = _subject_cuts(subjects, specs, policy).select("seed_table", "subtable_id", F.size("different").cast("long").alias("n"))
    if hot is not None:
        sizes = sizes.unionByName(_hot_rows(hot, specs, policy).select("seed_table", "subtable_id", F.lit(1).cast("long").alias("n")))
    return sizes


def _different_rows(subjects: DataFrame, hot: DataFrame | None, specs: DataFrame, policy: str) -> DataFrame:
    """``(seed_table, subtable_id, subject, cells)`` without repeats."""
    cuts = _subject_cuts(subjects, specs, policy)
    found = cuts.select("seed_table", "subtable_id", "subject", F.explode("different").alias("cells"))
    return found if hot is None else found.unionByName(_hot_rows(hot, specs, policy))


def combination_tables(
    rows: DataFrame,
    tables: DataFrame,
    sizes: tuple[int, ...] = (2,),
    min_occurrences: int = 100,
    policy: str = "any",
    distinct: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(manifest, rows)`` of the combination tables of all seed tables.

    With ``distinct`` (the capped kind) a combination needs at least
    ``min_occurrences`` rows and its table more than that many different ones; without
    it (the full kind) rows are kept as they are and must be more than the minimum, so
    the counts of the combinations already are the manifest.

    Equal rows of a table have one subject, so the rows of a subject are brought together
    before they are cut, and a subject's different rows are found and counted where they
    are. What is cut from the rows, many times as much, is neither shuffled nor written.
    """
    patterns = pinned(null_patterns(rows))
    counts = [combination_counts(patterns, tables, s) for s in sizes]
    every = pinned(reduce(DataFrame.unionByName, counts))
    specs = rich_combinations(every, min_occurrences, policy, strict=not distinct)
    cut = cut_rows(rows, specs, policy).select("seed_table", "subtable_id", "subject", "cells")
    if not distinct:
        sized = every.select("seed_table", "cols", F.col(f"{policy}_count").alias("n_rows"))
        return specs.join(sized, ["seed_table", "cols"]).select("seed_table", "subtable_id", "cols", "n_rows"), cut

    whole, hot = _subject_lists(rows, every, policy)
    specs = pinned(specs)
    sizes_of = (
        _different_sizes(whole, hot, specs, policy)
        .groupBy("seed_table", "subtable_id")
        .agg(F.sum("n").alias("n_rows"))
        .filter(F.col("n_rows") > min_occurrences)
    )
    manifest = pinned(
        sizes_of.join(specs, ["seed_table", "subtable_id"]).select("seed_table", "subtable_id", "cols", "n_rows")
    )
    return manifest, _different_rows(whole, hot, manifest.drop("n_rows"), policy)
