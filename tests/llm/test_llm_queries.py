"""The registered training-text queries: next to their SQL, or against brute force; and the pipeline."""

from __future__ import annotations

import importlib.util
import os
import re
import zlib
from collections import Counter

import pytest

from checks.compare import database, rows_of
from lakeloom.llm import decontaminate, mixing, sharding, toxicity
from lakeloom.llm.common import table
from lakeloom.llm.queries import QUERIES
from lakeloom.llm.sql import ORACLE

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = database(FOLDER).execute(ORACLE[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_query_covers_its_table(spark, name):
    key, of = ("page_id", "pages") if name.startswith(("op3", "op10")) else ("doc_id", "documents")
    got = Counter(r[0] for r in QUERIES[name](spark, FOLDER).select(key).collect())
    assert got == Counter(r[0] for r in table(spark, FOLDER, of).select(key).collect())


def test_sharding_shuffles_whole_documents(spark, monkeypatch):
    seen, shard = [], sharding.shard
    monkeypatch.setattr(sharding, "shard", lambda docs, *a, **k: seen.append(docs.columns) or shard(docs, *a, **k))
    rows = QUERIES["op2_sharding"](spark, FOLDER).select("doc_id", "size", "text_crc32").collect()
    docs = table(spark, FOLDER, "documents")
    assert seen == [docs.columns]
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {d: (len(t) + 1, zlib.crc32(t)) for d, t in texts.items()}


def test_entry_holds_every_query():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 11)} <= {re.match(r"[^_]+", q)[0] for q in entry.queries()}
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def pipeline():
    path = os.path.join(os.path.dirname(__file__), "..", "..", "corpus_pipeline.py")
    spec = importlib.util.spec_from_file_location("corpus_pipeline", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def smallest_of_groups(rows):
    """The smallest id of each group of texts whose five-word shingles have a Jaccard similarity of 0.8."""
    sets = {}
    for d, text in rows:
        words = (text or "").encode().lower().decode().split()
        shingles = frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()
        sets[shingles] = min(d, sets.get(shingles, d))
    least = dict(sets)
    by_size = sorted(least, key=len)
    posted, links = {}, []
    for x in by_size:
        shared = Counter(y for s in x for y in posted.get(s, ()))
        links += [(x, y) for y, n in shared.items() if 5 * n >= 4 * (len(x) + len(y) - n)]
        for s in x:
            posted.setdefault(s, []).append(x)
    changed = True
    while changed:
        changed = False
        for x, y in links:
            if least[x] != least[y]:
                least[x] = least[y] = min(least[x], least[y])
                changed = True
    return set(least.values())


def test_pipeline_stages_do_what_they_say(spark, pipeline, tmp_path):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    labels = table(spark, FOLDER, "labels")
    kept = []
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        kept.append((docs, out))
        assert out.columns[: len(columns)] == columns
        docs = out
    ids = [[r["doc_id"] for r in d.select("doc_id").collect()] for d in (kept[0][0], *[o for _, o in kept])]
    # toxicity: what the model rejects, and nothing else
    scored = toxicity.score(kept[0][0], toxicity.fit(kept[0][0], labels)).collect()
    assert sorted(ids[1]) == sorted(r["doc_id"] for r in scored if r["score"] < 0.3)
    # near copies: groups by exact Jaccard similarity of all pairs, the smallest id of each stays
    rows = kept[0][1].select("doc_id", "text").collect()
    assert sorted(ids[2]) == sorted(smallest_of_groups([(r["doc_id"], r["text"]) for r in rows]))
    # the benchmark
    found = decontaminate.overlaps(kept[1][1], table(spark, FOLDER, "benchmark")).select("doc_id").collect()
    assert sorted(ids[3]) == sorted(set(ids[2]) - {r[0] for r in found})
    # the mix: as often as it takes each
    times = {r["doc_id"]: r["times"] for r in mixing.mix(kept[2][1]).collect()}
    assert Counter(ids[4]) == {d: n for d, n in times.items() if n}
    # shards
    rows = kept[4][1].select("doc_id", "shard", "slot").collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(ids[4])
    sizes = Counter(r["shard"] for r in rows)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 1
    assert Counter((r["shard"], r["slot"]) for r in rows) == {(s, k): 1 for s in sizes for k in range(sizes[s])}


def test_pipeline_runs_whole(spark, pipeline):
    out = pipeline.run(spark, FOLDER)
    assert {"shard", "slot"} < set(out.columns) and out.count() > 0
