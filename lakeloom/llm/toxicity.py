"""Toxicity by a character n-gram linear classifier with naive Bayes log-count ratios.

Features are the distinct character n-grams of the lower-cased text, hashed to buckets. A
feature's value is its naive Bayes log-count ratio between toxic and other training texts;
only buckets whose ratio is clearly not zero take part, so that the length of a text by
itself says nothing. A logistic regression is fitted on those values.

Defined cases: null and empty texts have no features and get the score of the intercept.
Without labelled rows of both kinds, or without a bucket that tells them apart, every
score is the share of toxic training rows (0 without any). Labels other than 0 and 1, and
labels without a document, do not count; a doc_id labelled twice takes its highest label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakeloom.llm.common import strings, text_of, with_columns
from lakeloom.session import pinned

BITS = 20
LENGTHS = (3, 4, 5)
MAX_LABELS = 40_000  # documented bound of the sample that the classifier is fitted on
MIN_TEXTS = 5  # training texts that a bucket must occur in
MIN_Z = 3.0  # standard errors that a log-count ratio must be away from zero


def gram_buckets(text: str, bits: int = BITS, lengths=LENGTHS) -> np.ndarray:
    """The bucket of every character n-gram of a text, repeats included."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out, h = [], c
    for n in range(2, max(lengths) + 1):
        if len(c) < n:
            break
        h = h[:-1] * np.uint32(0x01000193) + c[n - 1 :]
        if n in lengths:
            x = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
            x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            out.append(x >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


@dataclass
class Model:
    """Weights of the buckets that count, already multiplied by their ratios."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _counts(batches):
    """Texts of each kind that a bucket occurs in, summed within the task."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        labels = batch.column(1).to_pylist()
        for text, label in zip(strings(batch, "text"), labels, strict=True):
            counts[label, np.unique(gram_buckets(text))] += 1
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(at.astype(np.int32)), pa.array(counts[1][at]), pa.array(counts[0][at])], names=["bucket", "toxic", "clean"]
    )


def _features(buckets: np.ndarray):
    def run(batches):
        place = np.full(1 << BITS, -1, np.int32)
        place[buckets] = np.arange(len(buckets), dtype=np.int32)
        for batch in batches:
            found = []
            for text in strings(batch, "text"):
                at = place[gram_buckets(text)]
                found.append(np.unique(at[at >= 0]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(pa.float64()), pa.array([f.tolist() for f in found], pa.list_(pa.int32()))],
                names=["label", "at"],
            )

    return run


def training_rows(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """text and label of labelled documents that are not held out, about ``max_labels`` at most.

    The sample is taken from the labels by a hash of the id before any text is read, which
    bounds the side that is broadcast.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    share = min(1.0, max_labels / max(1, known.count()))
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).join(
        F.broadcast(sample), "doc_id"
    ).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Model:
    rows = training_rows(docs, labels, max_labels)
    counts = pinned(
        rows.mapInArrow(_counts, "bucket int, toxic long, clean long")
        .groupBy("bucket")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    kinds = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = kinds.get(1, 0), kinds.get(0, 0)
    empty = Model(np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0)
    share = n_toxic / max(1, n_toxic + n_clean)
    empty.intercept = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    if not n_toxic or not n_clean:
        return empty
    p, q = F.col("toxic") + 1, F.col("clean") + 1
    sums = counts.agg(F.sum(p).alias("p"), F.sum(q).alias("q")).first()
    ratio = F.log(p / sums["p"]) - F.log(q / sums["q"])
    chosen = (  # one row per bucket at most: bounded by the number of buckets
        counts.select("bucket", ratio.alias("ratio"), (F.abs(ratio) / F.sqrt(1 / p + 1 / q)).alias("z"), (p + q - 2).alias("n"))
        .filter((F.col("n") >= MIN_TEXTS) & (F.col("z") >= MIN_Z))
        .orderBy("bucket")
        .toPandas()
    )
    if chosen.empty:
        return empty
    buckets, ratios = chosen["bucket"].to_numpy(), chosen["ratio"].to_numpy()

    @F.udf(VectorUDT())
    def vector(at):
        return SparseVector(len(ratios), at, ratios[at])

    points = pinned(rows.mapInArrow(_features(buckets), "label double, at array<int>"))
    points = points.select("label", vector("at").alias("features"))
    fitted = LogisticRegression(maxIter=60, regParam=1e-3, standardization=False).fit(points)
    return Model(buckets, (fitted.coefficients.toArray() * ratios).astype(np.float32), float(fitted.intercept))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of ``docs`` plus the score, from the text alone; an input column of that name gives way."""
    docs = docs.drop(name)
    own = docs.schema["text"].dataType == StringType()  # then the text goes to Python once
    # at most one weight per bucket
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.weights, model.intercept))

    def run(batches):
        buckets, values, intercept = shared.value
        weights = np.zeros(1 << BITS, np.float32)
        weights[buckets] = values
        for batch in batches:
            sums = []
            for text in strings(batch, "text" if own else "__text"):
                at = gram_buckets(text)
                hit = np.unique(at[weights[at] != 0])
                sums.append(intercept + float(weights[hit].sum(dtype=np.float64)))
            scores = 1 / (1 + np.exp(-np.array(sums, np.float64)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(scores)], names=[*batch.schema.names[:width], name]
            )

    schema, width = with_columns(docs.schema, (name, "double")), len(docs.columns)
    return (docs if own else docs.withColumn("__text", text_of(docs))).mapInArrow(run, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents whose score stays below the threshold; fitted on those of them that are labelled."""
    return score(docs, fit(docs, labels), "__score").filter(F.col("__score") < threshold).drop("__score")
