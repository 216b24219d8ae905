"""The lake-building jobs.

Each job writes its seed rows once, in long form, partitioned by seed table; column
types, manifests, subtables and wide exports all start from that written table. So the
lineage is cut by a file that survives a lost executor, and the triples are widened
only once. The driver holds metadata: chosen types, column lists, specs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.text import clean_name, lake_table_name, strip_brackets
from lakeloom.functions.values import RANGE_STEP
from lakeloom.operators import combine, selection, subtables, widen
from lakeloom.session import fresh_folder, pinned
from lakeloom.sources.many_tables import check_format, layout_of, write_tables
from lakeloom.sources.sinks import write_binary_tables, write_partitioned
from lakeloom.sources.tables import file_stats
from lakeloom.sources.triples import wordnet_subjects

SEED_ROWS = "_seed_rows"
SEED_COLUMNS = "_seed_columns"
MANIFEST = "_manifest"
SUBTABLE_ROWS = "_subtable_rows"
SUBTABLES = "_subtables"

SEED_SCHEMA = "subject string, row_key bigint, attrs map<string,string>, seed_table string"


def near_members(facts: DataFrame, types: DataFrame, selected: DataFrame) -> DataFrame:
    """Facts of the subjects of the selected types.

    The subjects are a written table, so Catalyst knows its size: it is sent to the scan
    of the facts while it is small, and meets them in a shuffle once it is not.
    """
    owned = pinned(selection.members(types, selected).select("subject").distinct())
    return facts.join(owned, "subject", "left_semi")


# -- seed rows -----------------------------------------------------------------


def base_seed_subjects(
    facts: DataFrame,
    types: DataFrame,
    top_k: int = 20,
    group_limit: int | None = None,
    max_table_width: int = widen.MAX_TABLE_WIDTH,
    picked: Sequence[str] | None = None,
    piece: int = widen.PIECE,
) -> DataFrame:
    """Seed subjects of the width-capped kind for the selected types.

    All selected types get a table; ``group_limit`` keeps the first so many where it is given.
    """
    selected = selection.top_types(types, top_k)
    if picked is not None:
        selected = selection.add_picked_types(selected, types, picked, top_k)
    selected = pinned(selected)
    facts = near_members(facts, types, selected)
    chosen = pinned(
        widen.chosen_predicates(selection.type_predicate_counts(facts, types, selected), max_table_width)
    )
    owned = selection.members(types, selection.first_types(selected, group_limit))
    return widen.capped_subjects(facts, owned, chosen, piece)


def long_seed_subjects(facts: DataFrame, types: DataFrame, max_fields: int = 2) -> DataFrame:
    """Seed subjects of every type with the prefix."""
    return widen.long_subjects(facts, wordnet_subjects(types), max_fields)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Written once below the shared folder, for what several passes go over."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def multiplied(subjects: DataFrame) -> DataFrame:
    """Rows of staged seed subjects; a subject with more rows than one block is spread over tasks."""
    largest = widen.product_sizes(subjects).agg(F.max("largest")).first()[0]
    return widen.product_rows(subjects, spread=(largest or 0) > RANGE_STEP)


def write_seeds(rows: DataFrame, columns: DataFrame, dest: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Write seed rows, their columns and the manifest; returns rows and columns read back."""
    spark = rows.sparkSession
    write_partitioned(rows, f"{dest}/{SEED_ROWS}", "seed_table")
    rows = spark.read.schema(SEED_SCHEMA).parquet(f"{dest}/{SEED_ROWS}")
    columns.write.mode("overwrite").parquet(f"{dest}/{SEED_COLUMNS}")
    columns = spark.read.parquet(f"{dest}/{SEED_COLUMNS}")
    seed_manifest(rows, columns, kind).write.mode("overwrite").parquet(f"{dest}/{MANIFEST}")
    return rows, columns


def seed_manifest(rows: DataFrame, columns: DataFrame, kind: str) -> DataFrame:
    """``(seed_table, name, n_rows, arity, n_num)`` per seed table; key columns count in the arity."""
    keys = 2 if kind == "wordnet" else 1
    counts = rows.groupBy("seed_table").agg(F.count("*").alias("n_rows"))
    shape = columns.groupBy("seed_table").agg(
        (F.count("*") + keys).alias("arity"), F.count_if("is_numeric").alias("n_num")
    )
    names = widen.seed_names(counts, kind)
    return (
        counts.join(names, "seed_table")
        .join(shape, "seed_table", "left")
        .select(
            "seed_table",
            "name",
            "n_rows",
            F.coalesce("arity", F.lit(keys).cast("long")).alias("arity"),
            F.coalesce("n_num", F.lit(0).cast("long")).alias("n_num"),
        )
    )


def seed_layouts(spark: SparkSession, dest: str, tag: str, kind: str) -> DataFrame:
    """``(seed_table, table, columns, layout)`` of the export of every seed table; ``columns`` are its attributes."""
    columns = spark.read.parquet(f"{dest}/{SEED_COLUMNS}")
    clean = strip_brackets("column") if kind == "wordnet" else clean_name("column")
    listed = columns.groupBy("seed_table").agg(
        F.array_sort(F.collect_list(F.struct("column", clean.alias("name"), "is_numeric"))).alias("listed")
    )
    tables = spark.read.parquet(f"{dest}/{MANIFEST}").select("seed_table", "name").join(listed, "seed_table", "left")
    keys = F.array(F.lit("type"), F.lit("subject")) if kind == "wordnet" else F.array("name")
    some = F.coalesce("listed", F.array().cast(listed.schema["listed"].dataType))
    return pinned(
        tables.select(
            "seed_table",
            F.concat(F.lit(f"{tag}-"), "name").alias("table"),
            some["column"].alias("columns"),
            layout_of(F.concat(keys, some["name"]), F.concat(F.transform(keys, lambda _: F.lit(False)), some["is_numeric"])).alias("layout"),
        )
    )


def export_seeds(
    spark: SparkSession, dest: str, tag: str, kind: str, output_format: str = "parquet", only: Sequence[str] | None = None
) -> list[str]:
    """Write seed tables with real columns, ``{tag}-{name}.{format}``, all in one job."""
    check_format(output_format)
    rows = spark.read.schema(SEED_SCHEMA).parquet(f"{dest}/{SEED_ROWS}")
    layouts = seed_layouts(spark, dest, tag, kind)
    if only is not None:
        layouts = layouts.filter(F.col("seed_table").isin(list(only)))
    keys = F.array("seed_table", "subject") if kind == "wordnet" else F.array("subject")
    attrs = F.col("attrs")
    filled = rows.join(layouts, "seed_table").select(
        "table", "layout", F.concat(keys, F.transform("columns", lambda c: attrs[c])).alias("cells")
    )
    write_tables(filled.unionByName(_bare(layouts)), dest, output_format)
    return sorted(f"{dest}/{r['table']}.{output_format}" for r in layouts.select("table").collect())


def _bare(layouts: DataFrame) -> DataFrame:
    """A row without cells for each table, so that it is there even if it has no rows."""
    return layouts.select("table", "layout", F.lit(None).cast("array<string>").alias("cells"))


# -- jobs ------------------------------------------------------------------------


def build_base_lake(
    facts: DataFrame,
    types: DataFrame,
    dest: str,
    strategy: str = "wordnet",
    top_k: int = 20,
    group_limit: int | None = None,
    max_table_width: int = widen.MAX_TABLE_WIDTH,
    picked: Sequence[str] | None = None,
    output_format: str = "parquet",
    explode_tables: bool = False,
    comb_sizes: Sequence[int] = (2,),
    min_count: int = 10,
    null_policy: str = "any",
    export: bool = True,
) -> DataFrame:
    """Seed tables of the most frequent types, or with ``strategy='binary'`` one table per predicate.

    Returns the manifest. ``explode_tables`` also writes the combination tables.
    """
    spark = facts.sparkSession
    if strategy == "binary":
        return build_binary_lake(facts, types, dest, top_k)
    if strategy != "wordnet":
        raise ValueError(f"unknown strategy {strategy}")
    check_format(output_format)
    subjects = staged(base_seed_subjects(facts, types, top_k, group_limit, max_table_width, picked), "subjects")
    write_seeds(multiplied(subjects), widen.subject_columns(subjects), dest, "wordnet")
    if export:
        export_seeds(spark, dest, strategy, "wordnet", output_format)
    if explode_tables:
        build_combinations(spark, dest, comb_sizes, min_count, null_policy)
        if export:
            export_combinations(spark, dest, output_format)
    return spark.read.parquet(f"{dest}/{MANIFEST}")


def build_combinations(
    spark: SparkSession, dest: str, sizes: Sequence[int] = (2,), min_count: int = 10, null_policy: str = "any"
) -> DataFrame:
    """Combination tables of all seed tables of a lake; returns their manifest."""
    rows = spark.read.schema(SEED_SCHEMA).parquet(f"{dest}/{SEED_ROWS}")
    columns = spark.read.parquet(f"{dest}/{SEED_COLUMNS}")
    manifest, kept = combine.combination_tables(
        rows, columns_by_table(columns), tuple(sizes), min_count, null_policy
    )
    names = spark.read.parquet(f"{dest}/{MANIFEST}").select("seed_table", F.col("name").alias("seed_name"))
    file_name = lake_table_name(
        F.concat(F.lit("wordnet-"), "seed_name"), F.transform("cols", strip_brackets)
    ).alias("name")
    write_partitioned(kept, f"{dest}/{SUBTABLE_ROWS}", "seed_table", "subtable_id")
    manifest.join(names, "seed_table").select(
        "seed_table", "subtable_id", "cols", file_name, "n_rows", (F.size("cols") + 2).alias("arity")
    ).write.mode("overwrite").parquet(f"{dest}/{SUBTABLES}")
    return spark.read.parquet(f"{dest}/{SUBTABLES}")


def spec_layouts(specs: DataFrame, columns: DataFrame, name: Column, keys: Sequence[str]) -> DataFrame:
    """Specs plus ``layout``: ``keys`` as text, then the columns of ``cols``, called ``name`` and typed as in the seed table."""
    flags = columns.select("seed_table", "column", name.alias("__name"), "is_numeric")
    placed = specs.withColumn("__spec", F.monotonically_increasing_id())
    placed = pinned(placed)
    listed = (
        placed.select("__spec", "seed_table", F.posexplode("cols").alias("place", "column"))
        .join(flags, ["seed_table", "column"])
        .groupBy("__spec")
        .agg(F.array_sort(F.collect_list(F.struct("place", "__name", "is_numeric"))).alias("listed"))
    )
    fixed = F.array(*[F.col(k[1:]) if k.startswith("=") else F.lit(k) for k in keys])
    texts = F.transform(fixed, lambda _: F.lit(False))
    layout = layout_of(F.concat(fixed, F.col("listed.__name")), F.concat(texts, F.col("listed.is_numeric")))
    return placed.join(listed, "__spec").withColumn("layout", layout).drop("__spec", "listed")


def export_combinations(spark: SparkSession, dest: str, output_format: str = "parquet") -> list[str]:
    """Write the combination tables of a lake with real columns, all in one job.

    They lie in a folder per seed table, ``wordnet-{seed}/{name}.{format}``, and have the
    type, the subject and the columns of the combination.
    """
    check_format(output_format)
    columns = spark.read.parquet(f"{dest}/{SEED_COLUMNS}")
    names = spark.read.parquet(f"{dest}/{MANIFEST}").select("seed_table", F.col("name").alias("seed_name"))
    specs = spark.read.parquet(f"{dest}/{SUBTABLES}").join(names, "seed_table")
    layouts = spec_layouts(specs, columns, strip_brackets("column"), ("type", "subject"))
    table = F.concat(F.lit("wordnet-"), "seed_name", F.lit("/"), "name")
    layouts = pinned(layouts.select("seed_table", "subtable_id", table.alias("table"), "layout"))
    rows = spark.read.parquet(f"{dest}/{SUBTABLE_ROWS}").join(layouts, ["seed_table", "subtable_id"])
    filled = rows.select("table", "layout", F.concat(F.array("seed_table", "subject"), "cells").alias("cells"))
    write_tables(filled, dest, output_format, gathered=True)
    return sorted(f"{dest}/{r['table']}.{output_format}" for r in layouts.select("table").collect())


def columns_by_table(columns: DataFrame) -> DataFrame:
    """``(seed_table, columns)``: sorted column names of each table."""
    return columns.groupBy("seed_table").agg(F.array_sort(F.collect_list("column")).alias("columns"))


def build_binary_lake(facts: DataFrame, types: DataFrame, dest: str, top_k: int = 20) -> DataFrame:
    """One table per predicate, from the facts of subjects with a selected type.

    Returns the manifest ``(table, n_rows)``.
    """
    spark = facts.sparkSession
    selected, _ = selection.select_types_and_subjects(facts, types, "binary", top_k)
    rows = widen.binary_rows(selected)
    write_binary_tables(rows, dest)
    return file_stats(spark, dest).select("table", F.col("rows").alias("n_rows"))


def build_all_binary(facts: DataFrame, dest: str) -> DataFrame:
    """One table per predicate over all facts, with numbers where every value is one.

    Returns the manifest ``(table, n_rows)``.
    """
    rows = widen.binary_rows(facts)
    write_binary_tables(rows, dest, pinned(widen.numeric_predicates(rows, ["table"], "value")))
    return file_stats(facts.sparkSession, dest).select("table", F.col("rows").alias("n_rows"))


def build_long_seeds(
    facts: DataFrame,
    types: DataFrame,
    dest: str,
    max_fields: int = 2,
    kind: str = "long",
    export: bool = True,
) -> DataFrame:
    """Seed tables of all types with the prefix; ``kind`` is ``long`` or ``full``. Returns the manifest."""
    spark = facts.sparkSession
    subjects = staged(long_seed_subjects(facts, types, max_fields), "subjects")
    if kind == "full":
        rows, columns = widen.full_rows(subjects, max_fields), widen.subject_columns(subjects, max_fields)
    elif kind == "long":
        rows, columns = multiplied(subjects), widen.subject_columns(subjects)
    else:
        raise ValueError(f"unknown kind {kind}")
    write_seeds(rows, columns, dest, kind)
    if export:
        export_seeds(spark, dest, "wordnet_full" if kind == "full" else "wordnet_vldb", kind)
    return spark.read.parquet(f"{dest}/{MANIFEST}")


def viable_tables(manifest: DataFrame, minimum_arity: int = 8) -> DataFrame:
    """Seed tables that get subtables: wider than the minimum, not empty."""
    return manifest.filter((F.col("arity") > minimum_arity) & (F.col("n_rows") > 0))


def draw_subtables(
    rows: DataFrame,
    columns: DataFrame,
    manifest: DataFrame,
    col_resample: int = 5,
    minimum_arity: int = 8,
    minimum_rows: int = 100,
    seed: int = 42,
    limit_break: int = 100,
    smallest: int | None = None,
    max_tables: int | None = None,
) -> DataFrame:
    """Specs of the subtables of all viable seed tables, with their row counts.

    ``max_tables`` stops a table at that many; up to ``limit_break`` further draws may fail.
    """
    viable = viable_tables(manifest, minimum_arity).select("seed_table")
    attempts = col_resample if max_tables is None else max_tables + limit_break
    specs = pinned(subtables.draw_specs(columns.join(viable, "seed_table", "left_semi"), attempts, seed, smallest))
    return pinned(subtables.keep_specs(subtables.count_specs(rows, specs), minimum_rows, limit_break, max_tables))


def build_subtables(
    spark: SparkSession,
    source: str,
    dest: str | None = None,
    col_resample: int = 5,
    row_resample: int = 2,
    sample_fraction: float = 0.7,
    minimum_arity: int = 8,
    minimum_rows: int = 100,
    seed: int = 42,
    exact: bool = True,
) -> DataFrame:
    """Subtables of a lake of seed tables, all in one write; returns their manifest.

    The default folder is the source folder with ``_{col_resample}`` appended.
    """
    subtables.check_resample(row_resample)
    dest = f"{source.rstrip('/')}_{col_resample}" if dest is None else dest
    rows = spark.read.schema(SEED_SCHEMA).parquet(f"{source}/{SEED_ROWS}")
    columns = spark.read.parquet(f"{source}/{SEED_COLUMNS}")
    manifest = spark.read.parquet(f"{source}/{MANIFEST}")
    specs = draw_subtables(rows, columns, manifest, col_resample, minimum_arity, minimum_rows, seed)
    subtables.subtable_manifest(specs, row_resample, sample_fraction).write.mode("overwrite").parquet(
        f"{dest}/{SUBTABLES}"
    )
    dealt = subtables.dealt_rows(rows, specs, row_resample, sample_fraction)
    out = subtables.subtable_rows(rows, specs, row_resample, sample_fraction, seed, exact, dealt)
    out = out.select(*subtables.KEYS, "subject", "cells", "cols")
    write_partitioned(out, f"{dest}/{SUBTABLE_ROWS}", *subtables.KEYS, gathered=True)
    return spark.read.parquet(f"{dest}/{SUBTABLES}")


def number_of_subtables(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count("*").alias("total_generated"))


def export_subtables(spark: SparkSession, source: str, dest: str, only: DataFrame | None = None) -> list[str]:
    """Write chosen subtables (default all) as ``{seed}/{seed}-{id}[-{replica}]-{case}.parquet``, all in one job."""
    names = spark.read.parquet(f"{source}/{MANIFEST}").select("seed_table", "name")
    columns = spark.read.parquet(f"{source}/{SEED_COLUMNS}")
    chosen = (spark.read.parquet(f"{dest}/{SUBTABLES}") if only is None else only).join(names, "seed_table")
    layouts = spec_layouts(chosen, columns, clean_name("column"), ("=name",))
    number = F.when(F.col("replica") > 0, F.concat(F.lit("-"), (F.col("replica") - 1).cast("string"))).otherwise("")
    case = F.when(F.col("case") == "all", "").otherwise(F.col("case"))
    table = F.concat("name", F.lit("/"), "name", F.lit("-"), F.col("subtable_id").cast("string"), number, F.lit("-"), case)
    layouts = pinned(layouts.select(*subtables.KEYS, table.alias("table"), "layout"))
    rows = spark.read.parquet(f"{dest}/{SUBTABLE_ROWS}").join(layouts, subtables.KEYS)
    filled = rows.select("table", "layout", F.concat(F.array("subject"), "cells").alias("cells"))
    write_tables(filled.unionByName(_bare(layouts)), dest)
    return sorted(f"{dest}/{r['table']}.parquet" for r in layouts.select("table").collect())
