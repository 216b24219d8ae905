"""CSV files with line breaks in quoted fields, read by many tasks.

Where a record starts depends on all quotes before it: a line break within quotes ends no
record. Files are read as lines, split into blocks as any text file is. Each block counts its
quotes; the sum over the blocks before, one small row each, says whether a block begins
within quotes, and with that every line knows whether it starts a record and whether it ends
one. Lines that do both are records as they are. Only the others are shuffled, to be put
together by the place at which their record starts.

Quotes within quoted fields are doubled, so that a field that holds quotes still has an even
number of them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from lakeloom.session import pinned

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the library

BOM = "﻿"
OPTIONS = {"quote": '"', "escape": '"'}
LINE = "path string, block bigint, at bigint, before bigint, quotes bigint, value string"

# fixed values: a column is of the first type whose pattern all its values have
INFERRED = [
    ("int", r"^[+-]?[0-9]{1,9}$"),
    ("bigint", r"^[+-]?[0-9]{1,18}$"),
    ("double", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?$"),
    ("boolean", r"^(?i:true|false)$"),
]


def _placed(batches: Iterable[pa.RecordBatch]):
    """Lines in file order get their number within the block and the quotes of the block before them."""
    last, count, quotes = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        path, block, value = (batch.column(i) for i in range(3))
        keys = list(zip(path.to_pylist(), block.to_pylist(), strict=True))
        start = np.array([i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]])
        size = np.diff(np.append(start, len(keys)))
        own = pc.count_substring(value, '"').to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(own)
        before = total - own
        at = np.arange(len(keys)) - np.repeat(start, size)
        before = before - np.repeat(before[start], size)
        if keys[0] == last:
            at[: size[0]] += count
            before[: size[0]] += quotes
        last, count, quotes = keys[-1], int(at[-1]) + 1, int(before[-1] + own[-1])
        yield pa.RecordBatch.from_arrays(
            [path, block, pa.array(at), pa.array(before), pa.array(own), value],
            names=["path", "block", "at", "before", "quotes", "value"],
        )


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(path, block, at, record)``: the text of every record and where it starts; blank lines between records are none."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", False).text(path)
    lines = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    # written: both passes must see the same blocks
    lines = pinned(lines.mapInArrow(_placed, LINE))
    odd = F.col("before") % 2 == 1
    blocks = lines.groupBy("path", "block").agg(
        F.sum("quotes").alias("quotes"), F.max(F.when(~odd, F.col("at"))).alias("even_at"), F.max(F.when(odd, F.col("at"))).alias("odd_at")
    )
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("within", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    # the last line of a block that starts a record
    start = F.when(F.col("within") == 0, F.col("even_at")).otherwise(F.col("odd_at"))
    known = F.when(start.isNotNull(), F.struct(F.col("block").alias("block"), start.alias("at")))
    blocks = pinned(blocks.select("path", "block", "within", F.last(known, ignorenulls=True).over(earlier).alias("open")))
    state = lines.join(blocks, ["path", "block"])
    state = state.withColumn("starts", (F.col("before") + F.col("within")) % 2 == 0)
    state = state.withColumn("ends", (F.col("before") + F.col("quotes") + F.col("within")) % 2 == 0)
    whole = state.filter("starts and ends").select("path", "block", "at", F.col("value").alias("record"))
    upto = Window.partitionBy("path", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    parts = state.filter("not (starts and ends)").withColumn("own", F.max(F.when(F.col("starts"), F.col("at"))).over(upto))
    first = F.when(F.col("own").isNotNull(), F.struct(F.col("block").alias("block"), F.col("own").alias("at"))).otherwise(F.col("open"))
    listed = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    joined = parts.groupBy("path", first.alias("first")).agg(F.array_join(listed["value"], "\n").alias("record"))
    every = whole.unionByName(joined.select("path", "first.block", "first.at", "record"))
    every = every.withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return every.filter("record <> ''")


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names, from the first record; a byte order mark is dropped."""
    names = spark.read.options(header=True, multiLine=True, **OPTIONS).csv(path).columns
    return [c.lstrip(BOM).strip('"') if c.startswith(BOM) else c for c in names]


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header in each file, every column text."""
    return read(spark, path, StructType([StructField(c, StringType()) for c in header(spark, path)]))


def read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header in each file and columns as given."""
    kinds = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    # a file's first record is its header
    body = records(spark, path).filter("block > 0 or at > 0")
    parsed = body.select(F.from_csv("record", F.lit(_ddl(kinds)), OPTIONS).alias("r"))
    return parsed.select("r.*").toDF(*[f.name for f in kinds.fields])


def _ddl(kinds: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kinds.fields)


def inferred(text: DataFrame) -> StructType:
    """The narrowest type that all values of each column have, in one aggregate; text for a column without values."""

    def misfits(c: Column, pattern: str) -> Column:
        return F.count_if(~F.regexp_like(c, F.lit(pattern)))

    cells = [misfits(F.col(f"`{c}`"), p).alias(f"{i}_{k}") for i, c in enumerate(text.columns) for k, p in INFERRED]
    some = [F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(text.columns)]
    found = text.agg(*cells, *some).first()
    kinds = []
    for i, c in enumerate(text.columns):
        fits = [k for k, _ in INFERRED if found[f"{i}_n"] and found[f"{i}_{k}"] == 0]
        kinds.append(f"`{c.replace('`', '``')}` {fits[0] if fits else 'string'}")
    return text.sparkSession.createDataFrame([], ", ".join(kinds)).schema if kinds else StructType()
