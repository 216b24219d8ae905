"""What the operators of this package share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# characters that end a word: blank, tab to carriage return
BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(docs: DataFrame) -> Column:
    """The text as a string, null as the empty text."""
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_columns(schema: StructType, *fields: tuple[str, str]) -> StructType:
    """A schema and further columns (``StructType.add`` would change the schema itself)."""
    added = StructType()
    for name, kind in fields:
        added = added.add(name, kind)
    return StructType([*schema.fields, *added.fields])


def slices(batches, rows: int = 256):
    """Batches of few rows: whole texts are Python strings for so many documents at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column of a batch as Python strings, nulls as empty ones."""
    return [v or "" for v in batch.column(batch.schema.get_field_index(name)).to_pylist()]
