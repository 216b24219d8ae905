"""Run queries next to their SQL on DuckDB and compare rows; ``python -m checks.compare [folder] [name …]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES

# sizes of the files themselves: tested on their own
WITHOUT_SQL = {"src_11"}


def database(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    return v


def rows_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, folder: str, name: str) -> str | None:
    """None where both sides agree, else what differs."""
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        if name not in WITHOUT_SQL:
            return "no SQL, and not named as a query without"
        return None if sum(got[1].values()) else "no rows"
    cur = con.execute(ORACLE[name])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} but {want[0]}"
    extra, missing = got[1] - want[1], want[1] - got[1]
    if extra or missing:
        return (
            f"{sum(got[1].values())} rows but {sum(want[1].values())}; not in SQL {list(extra.items())[:3]}; "
            f"not in Spark {list(missing.items())[:3]}"
        )
    return None if sum(got[1].values()) else "no rows"


def main() -> None:
    from lakeloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:16s} {time.time() - start:6.1f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{len(names)} queries, {failed} failed; without SQL: {[n for n in names if n not in ORACLE]}")


if __name__ == "__main__":
    main()
