"""Tables of different schemas, written in one job.

A row says which table it is for, how that table's columns are called and typed, and holds
the cells as text. Rows of a table come to a task one after the other; the task writes them
as a part of that table, in its own schema, whatever the tables before and after it are.
So the number of jobs does not follow the number of tables.

Parts are written below a folder of their own next to the tables. When all tasks have ended
the driver moves what they report into place, a folder per table, and removes the rest with
what failed attempts have left; after a failure it removes all of it.

Files are written by the Python workers, to any file system that Arrow can reach: a shared
path, ``hdfs://``, ``s3://``, ``gs://``.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute
import pyarrow.csv
import pyarrow.fs
import pyarrow.parquet
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the library

FORMATS = ("parquet", "csv")
ROWS = "table string, layout string, cells array<string>"
KINDS = {"string": pa.string(), "double": pa.float64()}
MOVES = 16  # files that are moved at a time


def check_format(output_format: str) -> None:
    if output_format not in FORMATS:
        raise ValueError(f"unknown output format {output_format}")


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path, and the path within it."""
    bare = re.sub("^file:/+", "/", path)
    if "://" not in bare:
        return pa.fs.LocalFileSystem(), bare
    return pa.fs.FileSystem.from_uri(bare)


@dataclass
class Written(WriterCommitMessage):
    """(table, path of the part) of one task."""

    parts: list[tuple[str, str]]


class _Part:
    """A file of one table that is being written."""

    def __init__(self, fs, path: str, layout: str, output_format: str):
        fields = [(f["name"], KINDS[f["kind"]]) for f in json.loads(layout)]
        self.schema = pa.schema(fields)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.stream = fs.open_output_stream(path)
        if output_format == "csv":
            options = pa.csv.WriteOptions(include_header=True, quoting_style="needed")
            self.writer = pa.csv.CSVWriter(self.stream, self.schema, write_options=options)
        else:
            self.writer = pa.parquet.ParquetWriter(self.stream, self.schema)

    def add(self, cells: pa.ListArray) -> None:
        cells = cells.drop_null()  # a row without cells only says that there is such a table
        if not len(cells):
            return
        columns = []
        for i, field in enumerate(self.schema):
            values = pa.compute.list_element(cells, i)
            if field.type == pa.float64():
                values = _numbers(values)
            columns.append(values.cast(field.type))
        self.writer.write_table(pa.Table.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        self.writer.close()
        self.stream.close()


def _numbers(texts: pa.Array) -> pa.Array:
    """Texts as doubles; Arrow refuses some that Python reads, such as ``+1`` and those beyond the range."""
    try:
        return texts.cast(pa.float64())
    except pa.ArrowInvalid:
        return pa.array([None if v is None else float(v) for v in texts.to_pylist()], pa.float64())


class ManyTablesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, output_format: str):
        self.path, self.output_format = path.rstrip("/"), output_format
        self.stage = f"{self.path}/_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, stage = file_system(self.stage)
        parts: list[tuple[str, str]] = []
        at, part = None, None
        for batch in iterator:
            tables, layouts, cells = (batch.column(i) for i in range(3))
            runs = pa.compute.run_end_encode(tables)
            start = 0
            for name, stop in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if name != at:
                    if part:
                        part.close()
                    at = name
                    path = f"{stage}/{at}/part-{uuid.uuid4().hex}.{self.output_format}"
                    part = _Part(fs, path, layouts[start].as_py(), self.output_format)
                    parts.append((at, path))
                part.add(cells.slice(start, stop - start))
                start = stop
        if part:
            part.close()
        return Written(parts)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        parts = [p for m in messages if m for p in m.parts]

        def place(table: str) -> str:
            return f"{root}/{table}.{self.output_format}"

        def renew(table: str) -> None:
            if fs.get_file_info(place(table)).type != pa.fs.FileType.NotFound:
                fs.delete_dir(place(table))
            fs.create_dir(place(table), recursive=True)

        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(renew, sorted({table for table, _ in parts})))
            list(pool.map(lambda p: fs.move(p[1], f"{place(p[0])}/{p[1].rsplit('/', 1)[1]}"), parts))
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        fs, stage = file_system(self.stage)
        if fs.get_file_info(stage).type != pa.fs.FileType.NotFound:
            fs.delete_dir(stage)


class ManyTables(DataSource):
    @classmethod
    def name(cls) -> str:
        return "many_tables"

    def schema(self) -> str:
        return ROWS

    def writer(self, schema, overwrite: bool) -> ManyTablesWriter:
        return ManyTablesWriter(self.options["path"], self.options["tableformat"])


def layout_of(names: Column, numeric: Column) -> Column:
    """The layout of a table from the array of its column names and that of which of them are numbers."""
    fields = F.zip_with(
        names, numeric, lambda n, d: F.struct(n.alias("name"), F.when(d, "double").otherwise("string").alias("kind"))
    )
    return F.to_json(fields)


def write_tables(rows: DataFrame, dest: str, output_format: str = "parquet", gathered: bool = False) -> None:
    """Rows ``(table, layout, cells)`` to one folder ``{dest}/{table}.{format}`` per table, all in one job.

    A table may lie in a folder (``a/b``). A row with null ``cells`` makes its table, if
    need be without rows. Tables of these names that are there already are replaced. Small
    tables share a task, and a table with very many rows is written by several. ``gathered``
    rows, read from a folder per table, come to a task table by table already; they are
    written from there, without a shuffle or a sort.
    """
    check_format(output_format)
    rows.sparkSession.dataSource.register(ManyTables)
    balanced = rows.select("table", "layout", "cells")
    if not gathered:
        balanced = balanced.hint("rebalance", F.col("table")).sortWithinPartitions("table")
    balanced.write.format("many_tables").mode("append").option("tableformat", output_format).save(dest)
