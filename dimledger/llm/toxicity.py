"""Toxicity: a character n-gram linear classifier on naive Bayes ratios.

A text is the set of its hashed character n-grams (4 to 6 characters, lower
case, white space as one blank). Each n-gram is scaled by its naive Bayes
log-count ratio between toxic and other labelled texts; n-grams whose ratio
is near zero or whose support is small have scale 0 and drop out. A logistic
regression on the scaled features gives the score.

The classifier (ratios and regression) is fitted on at most ``MAX_ROWS``
labelled rows outside the held-out fifth, the first in the order of a hash of
doc_id. That many (doc_id, label) pairs are broadcast, so no text is shuffled
to meet its label; texts of labelled documents are counted per task, then by
n-gram, and the driver gets one row per hash bucket with a scale (at most
``BUCKETS``) and the scaled features of the fitted rows. Scoring is a pass
over the texts without a shuffle.

Defined results: a NULL or empty text has no n-gram and gets the score of the
intercept; a doc_id with several labels counts as toxic if one says so; NULL
labels are none; without labels of both kinds every score is the share of
toxic labels (0 without any). Repeated rows are scored one by one; an empty
table gives an empty result. Other columns, lang and source among them, are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimledger.llm.common import mix64, relation, staged

SIZES = (4, 5, 6)
BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
MIN_SUPPORT = 8        # labelled texts that hold an n-gram, at least (a 40th of the toxic ones, if those are few)
MIN_RATIO = 2.0        # absolute log-count ratio, at least
MAX_ROWS = 40_000      # labelled rows the classifier is fitted on, at most
SMOOTH = 0.5


def ngrams(text: str | None, order: np.ndarray) -> np.ndarray:
    """Distinct buckets of a text's n-grams. ``order`` is scratch space of
    ``BUCKETS`` integers; its content does not matter."""
    clean = " ".join((text or "").lower().split())
    if not clean:
        return np.empty(0, dtype=np.int64)
    chars = np.frombuffer(f" {clean} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    found, rolling = [], chars
    for n in range(2, max(SIZES) + 1):
        if len(chars) < n:
            break
        rolling = rolling[:-1] * np.uint64(0x9E3779B97F4A7C15) + chars[n - 1:]
        if n in SIZES:
            found.append(mix64(rolling + np.uint64(n)) >> np.uint64(64 - BUCKET_BITS))
    if not found:
        return np.empty(0, dtype=np.int64)
    all_found = np.concatenate(found).astype(np.int64)
    place = np.arange(len(all_found), dtype=order.dtype)
    order[all_found] = place                       # the last of equal n-grams stays
    return all_found[order[all_found] == place]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    order = np.zeros(BUCKETS, dtype=np.int32)
    counts = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            counts[toxic, ngrams(text, order)] += 1
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(counts[0, used]), pa.array(counts[1, used])],
        names=["bucket", "clean", "toxic"])


def _selected(scale: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.zeros(BUCKETS, dtype=np.int32)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                own = ngrams(text, order)
                rows.append(np.sort(own[scale[own] != 0]).astype(np.int32))
            bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            flat = np.concatenate(rows) if rows else np.empty(0, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("toxic"),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))], names=["place", "toxic", "features"])
    return run


@dataclass
class Model:
    """``sigmoid(intercept + sum of weights of a text's n-grams)``; ``constant``
    replaces it where there is nothing to learn from."""

    weights: np.ndarray
    intercept: float
    constant: float | None = None

    def score(self, text: str | None, order: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        z = self.intercept + float(self.weights[ngrams(text, order)].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def fit_logistic(offsets: np.ndarray, features: np.ndarray, scale: np.ndarray, y: np.ndarray,
                 ridge: float = 0.1, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights of a logistic regression on ``scale``-d 0/1 features (CSR), by
    Adagrad steps over all rows with a ridge penalty."""
    used, columns = np.unique(features, return_inverse=True)
    x = scale[used][columns]
    rows = np.repeat(np.arange(len(y)), np.diff(offsets))
    w, b = np.zeros(len(used)), 0.0
    seen_w, seen_b = np.full(len(used), 1e-8), 1e-8
    for _ in range(rounds):
        z = np.bincount(rows, weights=w[columns] * x, minlength=len(y)) + b
        error = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y
        slope = np.bincount(columns, weights=error[rows] * x, minlength=len(used)) / len(y) + ridge * w / len(y) ** 0.5
        slope_b = error.mean()
        seen_w += slope ** 2
        seen_b += slope_b ** 2
        w -= 0.3 * slope / np.sqrt(seen_w)
        b -= 0.3 * slope_b / seen_b ** 0.5
    weights = np.zeros(len(scale))
    weights[used] = w * scale[used]
    return weights, float(b)


def labelled_texts(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most ``max_rows`` labels (one per doc_id)."""
    one = (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
           .agg(F.max("toxic").cast("int").alias("toxic")))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")   # max_rows pairs of numbers


def fit(labelled: DataFrame, min_support: int = MIN_SUPPORT, min_ratio: float = MIN_RATIO) -> Model:
    """Fit on (doc_id, text, toxic) rows; toxic is 0 or 1."""
    train = staged(labelled.select(F.xxhash64("doc_id").alias("place"), "text", F.col("toxic").cast("int")
                                   .alias("toxic")), "labelled")
    totals = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return Model(np.zeros(0), 0.0, constant=toxic / max(clean + toxic, 1))
    min_support = min(min_support, max(3, toxic // 40))
    ratio = F.log((F.col("toxic") + SMOOTH) / (toxic + 2 * SMOOTH)) - F.log(
        (F.col("clean") + SMOOTH) / (clean + 2 * SMOOTH))
    counted = (train.select("text", "toxic").mapInArrow(_count, "bucket int, clean long, toxic long")
               .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
               .filter(F.col("clean") + F.col("toxic") >= min_support)
               .select("bucket", ratio.alias("ratio")).filter(F.abs("ratio") >= min_ratio).toPandas())
    scale = np.zeros(BUCKETS)
    scale[counted["bucket"].to_numpy()] = counted["ratio"].to_numpy()
    rows = (train.mapInArrow(_selected(scale), "place long, toxic int, features array<int>")
            .orderBy("place", "toxic").toArrow())
    lists = rows.column("features").combine_chunks()
    y = rows.column("toxic").to_numpy().astype(np.float64)
    weights, intercept = fit_logistic(lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py(),
                                      lists.flatten().to_numpy(), scale, y)
    return Model(weights.astype(np.float32), intercept)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.zeros(BUCKETS, dtype=np.int32)
        for batch in batches:
            scores = [shared.value.score(t, order) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op10_toxicity(spark, sf_dir):
    docs = relation(spark, sf_dir, "documents")
    labels = relation(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    model = fit(labelled_texts(docs, labels))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLE = {}
