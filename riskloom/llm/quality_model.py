"""A quality classifier of supervised subword embeddings.

Words and runs of characters are hashed to learned vectors, a document is their mean, and a softmax layer scores it. All is
trained by stochastic gradient descent in numpy on a bounded sample of labelled documents. As mean and output layer are
linear, scoring folds the output into one number a bucket: one table of fixed size that tasks read whole texts against.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import storage, text_arrays
from riskloom.llm.hashed_features import Hashed

#: Buckets (2 ** bits), width of a vector, passes over the sample, and step size.
BITS, WIDTH, EPOCHS, RATE = 16, 16, 6, 0.15
#: Labelled documents that the model is fitted on, about: a bound on the sample.
TRAINING_ROWS = 4000
FEATURES = Hashed(BITS, (3, 4), words=True, folded=False)


def sparse_rows(rows: DataFrame, features: Hashed, target: str) -> list[tuple[np.ndarray, np.ndarray, object]]:
    """Features of a bounded sample, made by tasks from whole texts."""

    def run(batches):
        for batch in batches:
            found = features.vectors(batch.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes() for a, _ in found], pa.binary()), pa.array([b.tobytes() for _, b in found], pa.binary()), batch.column(target)], names=["ids", "shares", "target"])

    kind = rows.schema[target].dataType.simpleString()
    found = rows.select("text", target).mapInArrow(text_arrays.handing_back(run), f"ids binary, shares binary, target {kind}")
    # The driver takes a part at a time: its virtual machine never holds the whole sample beside Python's.
    out = list(storage.stored(found, "sample").toLocalIterator())
    out.sort(key=lambda r: (str(r.target), r.ids, r.shares))  # the order of training doesn't depend on that of the tasks
    return [(np.frombuffer(r.ids, np.int32), np.frombuffer(r.shares, np.float32), r.target) for r in out]


def train(sample: list, classes: int = 2, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Score of each bucket and bias, by class. Steps are scaled by past gradients, as shares of a long text are small."""
    rng = np.random.default_rng(seed)
    vectors, output, bias = rng.normal(0, 0.3, (1 << BITS, WIDTH)).astype(np.float32), rng.normal(0, 0.3, (WIDTH, classes)), np.zeros(classes)
    past, past_out = np.full(1 << BITS, 1e-8, np.float32), np.full((WIDTH, classes), 1e-4)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(sample)):
            ids, shares, target = sample[i]
            mean = shares @ vectors[ids]
            z = mean @ output + bias
            error = np.exp(z - z.max())
            error /= error.sum()
            error[target] -= 1
            back = (output @ error).astype(np.float32)
            past[ids] += shares * shares * float(back @ back)
            vectors[ids] -= np.outer(RATE * shares / np.sqrt(past[ids]), back)
            step = np.outer(mean, error)
            past_out += step * step
            output -= RATE * step / np.sqrt(past_out)
            bias -= 0.05 * error
    return vectors @ output, bias


def fit(docs: DataFrame, labels: DataFrame, training: F.Column, bound: int = TRAINING_ROWS) -> tuple[np.ndarray, float]:
    """Score difference of label 1 and 0 by bucket, and bias. ``labels``: doc_id, quality (0, 1; others are left out)."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    usable = usable.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(training)
    every = max(1, usable.count() // bound)
    picked = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # At most about twice the bound: small enough to send to the documents, wherever they are.
    sample = sparse_rows(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), FEATURES, "quality")
    if not sample:
        return np.zeros(1 << BITS, np.float32), 0.0
    scores, bias = train(sample)
    del sample
    text_arrays.hand_back()
    return (scores[:, 1] - scores[:, 0]).astype(np.float32), float(bias[1] - bias[0])


def in_fold(divisor: int, remainder: int) -> F.Column:
    """crc32 of doc_id as text leaves ``remainder``; never for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == remainder, F.lit(False))


def score_quality(docs: DataFrame, model: tuple[np.ndarray, float], into: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and ``quality_score`` (0 to 1). A null or empty text gets what the model says without features.

    ``into`` names the new column; one of that name in ``docs`` is replaced. Repeated rows are scored each, texts of any length
    whole; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias = shared.value

        def run(batches):
            for text in batches:
                z = FEATURES.means(pa.array(text, pa.string(), from_pandas=True), weights[:, None])[:, 0] + bias
                yield pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))

        yield from text_arrays.handing_back(run)(texts)

    return docs.withColumn(into, score(F.col("text").cast("string")))
