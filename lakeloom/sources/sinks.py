"""Writing seed tables, subtables and binary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import pinned
from lakeloom.sources.many_tables import check_format, layout_of, write_tables


def write_table(df: DataFrame, dest: str, tag: str, name: str, output_format: str = "parquet") -> str:
    """One table at ``{dest}/{tag}-{name}.{format}``; returns the path."""
    check_format(output_format)
    path = f"{dest}/{tag}-{name}.{output_format}" if tag else f"{dest}/{name}.{output_format}"
    writer = df.write.mode("overwrite")
    if output_format == "csv":
        # quotes are doubled, blanks at the ends stay
        writer.options(
            header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    else:
        writer.parquet(path)
    return path


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system of the path, whichever it is."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


# Folders that a task writes to at a time, and bytes that a file holds back, where rows are not dealt by folder.
OPEN_FILES = 64
HELD = 4 << 20


def write_partitioned(df: DataFrame, path: str, *keys: str, lookup: DataFrame | None = None, gathered: bool = False) -> None:
    """One folder per value of the keys, in one job.

    The rebalance keeps the rows of a key together, so small tables make one file; a
    key with a third of all rows is split over tasks, and many small ones share a task.
    ``lookup``, a small written table, adds what all rows of some of the keys share; it is
    joined after the rebalance, so that it is not shuffled with each row.

    ``gathered`` rows, cut from tables that lie in a folder each, are written by the tasks that
    read them, to several folders at a time: neither a shuffle nor a sort goes to the disk. A
    task with more than ``OPEN_FILES`` folders sorts the rows of those beyond.
    """
    balanced = df if gathered else df.hint("rebalance", *[F.col(k) for k in keys])
    if lookup is not None:
        balanced = balanced.join(lookup, [k for k in keys if k in lookup.columns])
    # static: tables of an earlier run do not stay next to the new ones
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if not gathered:
        writer.partitionBy(*keys).parquet(path)
        return
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, str(OPEN_FILES))
    try:
        writer.option("parquet.block.size", HELD).partitionBy(*keys).parquet(path)
    finally:
        conf.set(key, before)


def write_binary_tables(rows: DataFrame, dest: str, numeric: DataFrame | None = None, output_format: str = "parquet") -> list[str]:
    """One ``(subject, name)`` table per predicate from the rows of ``widen.binary_rows``, all in one job.

    The folder must be there already. ``numeric``, ``(table, is_numeric)``, says which tables
    hold numbers; without it all hold text.
    """
    spark = rows.sparkSession
    if not folder_exists(spark, dest):
        raise FileNotFoundError(f"folder {dest} does not exist")
    tables = pinned(rows.select("table").distinct())
    flags = tables.withColumn("is_numeric", F.lit(False)) if numeric is None else tables.join(numeric, "table")
    column = F.regexp_replace("table", "^binary-", "")
    layouts = flags.select("table", layout_of(F.array(F.lit("subject"), column), F.array(F.lit(False), F.col("is_numeric"))).alias("layout"))
    write_tables(rows.select("table", F.array("subject", "value").alias("cells")).join(layouts, "table"), dest, output_format)
    return sorted(f"{dest}/{r['table']}.{output_format}" for r in tables.collect())
