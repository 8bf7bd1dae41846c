"""Quality classifier: votes of nearest neighbours in a latent-semantic space.

A text's terms are its words (lower case, without punctuation at their ends),
the shapes of its words (classes of characters, runs as one), a term for each
level of ``REPEATED`` that the share of words repeating the word before
reaches, and one for its length in powers of two; terms are hashed to ``TERMS``
numbers. TF-IDF rows of all documents are factorised by a
randomised SVD (one pass: ``A'A`` times a Gaussian test matrix, then a Nystrom
factorisation); a text's vector is its row in that space, of length 1.

The vectors of at most ``MAX_ROWS`` labelled documents, the first in the order
of a hash of doc_id, are broadcast. Every document is compared with all of them,
block by block, by exact cosine products; the ``NEIGHBOURS`` nearest vote with
their labels, weighted by ``cosine ** POWER``.

Document frequencies and the factorisation cover all documents. Per task they
send up one number per term and one row of the sketch per term, whatever the
size of the task; texts are never shuffled. The query counts the terms of each
text once and keeps them in the shared folder (``with_terms``); the passes after
that read the counts, not the texts.

Defined results: a NULL or empty text has only the term of length 0; a text
whose vector is 0, or that no labelled vector points to, gets the share of
labels 1; a doc_id with several labels counts as 0 if one says so; NULL labels
are none; without labels every score is 0.5; equal cosines go by the order of
the labelled rows. Repeated rows are scored one by one; an empty table gives an
empty result. Other columns, lang and source among them, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimledger.llm.common import hash_strings, mix64, relation, slices, staged, words_csr

TERM_BITS = 14
TERMS = 1 << TERM_BITS
RANK, OVERSAMPLE = 48, 8
MAX_ROWS = 8_000         # labelled rows whose vectors are broadcast, at most
NEIGHBOURS = 15
POWER = 8
THRESHOLD = 0.7
BLOCK_ROWS = 512         # documents of one cosine product
SLICE_BYTES = 4 << 20    # of texts
TERM_BYTES = 1 << 20     # of terms, two bytes each
SEED = 11
REPEATED = (1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2)     # shares of words that repeat the word before
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WORD, SHAPE, REPEAT, LENGTH = (np.uint64(k) for k in (1, 2, 3, 4))     # kinds of terms


# ------------------------------------------------------------------ terms

def shapes(words: pa.Array) -> pa.Array:
    """``A`` for a run of capitals, ``a`` for one of other letters, ``0`` for one
    of digits; any other character is itself."""
    for pattern, mark in ((r"\p{Lu}+", "A"), (r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}\p{M}]+", "a"), (r"\p{N}+", "0")):
        words = pc.replace_substring_regex(words, pattern, mark)
    return words


def _numbers(values: np.ndarray, kind: np.uint64) -> np.ndarray:
    return (mix64(values * np.uint64(0x9E3779B97F4A7C15) + kind) >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of a batch, by text and term."""
    offsets, codes, distinct = words_csr(texts)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(n), sizes)
    length = _numbers(np.ceil(np.log2(sizes + 1)).astype(np.uint64), LENGTH)
    keys = [np.arange(n) * TERMS + length]
    if len(codes):
        plain = pc.utf8_trim(pc.utf8_lower(distinct), characters=EDGES)
        word = _numbers(hash_strings(plain), WORD)
        keys.append((row * TERMS + word[codes])[pc.not_equal(plain, "").to_numpy(zero_copy_only=False)[codes]])
        shape = shapes(distinct).dictionary_encode()                  # few: each is hashed once
        number = _numbers(hash_strings(shape.dictionary), SHAPE)[shape.indices.to_numpy(zero_copy_only=False)]
        keys.append(row * TERMS + number[codes])
        again = np.flatnonzero((codes[1:] == codes[:-1]) & (row[1:] == row[:-1])) + 1
        share = np.bincount(row[again], minlength=n) / np.maximum(sizes, 1)
        levels = _numbers(np.arange(len(REPEATED), dtype=np.uint64), REPEAT)
        for least, level in zip(REPEATED, levels.tolist(), strict=True):
            keys.append(row[again[share[row[again]] >= least]] * TERMS + level)
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key // TERMS, key % TERMS, count


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Values from one bound to the next as one binary each."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def with_terms(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows with ``terms`` (little-endian unsigned 16-bit, ascending) and their
    ``counts`` (32-bit) in place of the text."""
    kept = rows.drop(text_col)
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, SLICE_BYTES):
            row, term, count = term_counts(batch.column(text_col))
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), _binary(term.astype("<u2"), bounds),
                 _binary(count.astype("<u4"), bounds)], names=[*names, "terms", "counts"])

    return rows.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("terms", T.BinaryType()),
                                              T.StructField("counts", T.BinaryType())]))


def _termed(docs: DataFrame, text_col: str, *columns: Column) -> DataFrame:
    """``columns``, terms and counts of documents that have either their text or these."""
    if text_col in docs.columns:
        return with_terms(docs.select(*columns, F.col(text_col).alias("text")))
    return docs.select(*columns, "terms", "counts")


def entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of rows of ``with_terms``, as ``term_counts`` has them."""
    sizes = pc.binary_length(batch.column("terms")).to_numpy(zero_copy_only=False) // 2
    term, count = (np.frombuffer(b"".join(batch.column(c).to_pylist()), kind).astype(np.int64)
                   for c, kind in (("terms", "<u2"), ("counts", "<u4")))
    return np.repeat(np.arange(batch.num_rows), sizes), term, count


def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term; all documents as term -1."""
    total, docs = np.zeros(TERMS, np.int64), 0
    for batch in slices(batches, "terms", TERM_BYTES):
        total += np.bincount(entries(batch)[1], minlength=TERMS)
        docs += batch.num_rows
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, used), pa.int32()), pa.array(np.append(docs, total[used]))],
                                     names=["term", "n"])


def weighted(row: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """Values of unit TF-IDF rows."""
    value = (1 + np.log(count)) * idf[term]
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=n))
    return (value / np.maximum(norm, 1e-12)[row]).astype(np.float32)


def project(row: np.ndarray, term: np.ndarray, value: np.ndarray, n: int, matrix: np.ndarray) -> np.ndarray:
    """Sparse rows times ``matrix``, a bounded number of entries at a time."""
    out = np.zeros((n, matrix.shape[1]), np.float32)
    at = 0
    while at < len(row):
        stop = min(at + (1 << 16), len(row))
        while stop < len(row) and row[stop] == row[stop - 1]:
            stop += 1
        starts = at + np.flatnonzero(np.append(True, row[at + 1:stop] != row[at:stop - 1]))
        out[row[starts]] = np.add.reduceat(matrix[term[at:stop]] * value[at:stop, None], starts - at, axis=0)
        at = stop
    return out


# ------------------------------------------------------------------ the space

def test_matrix(width: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((TERMS, width)).astype(np.float32)


def sketch(idf: np.ndarray, width: int):
    """Rows (per term) of the task's share of ``A'(A Omega)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega, total = test_matrix(width), np.zeros((TERMS, width), np.float32)
        for batch in slices(batches, "terms", TERM_BYTES):
            row, term, count = entries(batch)
            value = weighted(row, term, count, batch.num_rows, idf)
            product = project(row, term, value, batch.num_rows, omega)
            order = np.argsort(term, kind="stable")
            total += project(term[order], row[order], value[order], TERMS, product)
        used = np.flatnonzero(total.any(axis=1))
        for at in range(0, len(used), 1024):
            part = used[at:at + 1024]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.FixedSizeListArray.from_arrays(
                    pa.array(total[part].ravel()), width).cast(pa.list_(pa.float32()))], names=["term", "row"])
    return run


def _add(rows: pa.Table) -> pa.Table:
    values = rows.column("row").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    return pa.table({"term": rows.column("term").slice(0, 1),
                     "row": pa.array([values.sum(axis=0, dtype=np.float64).astype(np.float32)], pa.list_(pa.float32()))})


def latent_basis(sketched: np.ndarray, rank: int) -> np.ndarray:
    """Strongest right singular vectors from ``Y = A'A Omega``: ``A'A`` is near
    ``Y (Omega'Y)^-1 Y'``."""
    omega, y = test_matrix(sketched.shape[1]).astype(np.float64), sketched.astype(np.float64)
    shift = 1e-6 * np.linalg.norm(y)
    y = y + shift * omega
    core = omega.T @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(), 0) * 1e-9
    left, strength, _ = np.linalg.svd(y @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return left[:, strength ** 2 > 2 * shift][:, :rank].astype(np.float32)


@dataclass
class Space:
    """Latent space of a corpus: weights of terms and directions."""

    idf: np.ndarray
    basis: np.ndarray

    def vectors(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        made = project(row, term, weighted(row, term, count, n, self.idf), n, self.basis)
        return made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-12)


def fit_space(docs: DataFrame, rank: int = RANK, text_col: str = "text") -> Space:
    """Term weights and directions from all texts (or rows of ``with_terms``)."""
    termed = _termed(docs, text_col)
    counted = termed.mapInArrow(frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(TERMS, np.int64)
    n = int(counted["n"][counted["term"] < 0].sum())
    held = counted[counted["term"] >= 0]
    total[held["term"].to_numpy()] = held["n"].to_numpy()
    idf = np.where(total > 0, np.log((n + 1) / (total + 1.0)) + 1e-3, 0.0)
    width = rank + OVERSAMPLE
    rows = (termed.mapInArrow(sketch(idf, width), "term int, row array<float>")
            .groupBy("term").applyInArrow(_add, "term int, row array<float>").toArrow())
    y = np.zeros((TERMS, width), np.float32)
    if rows.num_rows:
        y[rows.column("term").to_numpy()] = rows.column("row").combine_chunks().flatten().to_numpy().reshape(-1, width)
    return Space(idf.astype(np.float32), latent_basis(y, rank) if rows.num_rows else np.zeros((TERMS, 1), np.float32))


# ------------------------------------------------------------------ the vote

def vote(vectors: np.ndarray, known: np.ndarray, labels: np.ndarray, k: int = NEIGHBOURS, power: float = POWER,
         block: int = BLOCK_ROWS) -> np.ndarray:
    """Weighted share of label 1 among the ``k`` nearest known vectors."""
    if not len(labels):
        return np.full(len(vectors), 0.5)
    out = np.full(len(vectors), labels.mean())
    k = min(k, len(labels))
    for at in range(0, len(vectors), block):
        cosines = vectors[at:at + block] @ known.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1).astype(np.float64), 0) ** power
        total = weight.sum(axis=1)
        some = total > 0
        out[at:at + block][some] = (weight * labels[near]).sum(axis=1)[some] / total[some]
    return out


def labelled_vectors(docs: DataFrame, labels: DataFrame, space: Space, max_rows: int = MAX_ROWS,
                     label_col: str = "quality") -> tuple[np.ndarray, np.ndarray]:
    """Vectors and labels of at most ``max_rows`` labelled documents."""
    one = (labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
           .agg(F.min(label_col).cast("int").alias("label")))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    read = docs.select("doc_id", *(["text"] if "text" in docs.columns else ["terms", "counts"]))
    own = _termed(read.join(F.broadcast(chosen), "doc_id"), "text", F.col("doc_id"), F.col("label"))   # max_rows pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "terms", TERM_BYTES):
            made = space.vectors(*entries(batch), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.FixedSizeListArray.from_arrays(
                    pa.array(made.ravel()), made.shape[1]).cast(pa.list_(pa.float32()))],
                names=["doc_id", "label", "vector"])

    rows = staged(own.mapInArrow(run, "doc_id long, label int, vector array<float>"), "labelled")
    # A doc_id of several rows has several vectors; they too are bounded.
    table = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "vector").limit(max_rows).toArrow()
    vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(
        table.num_rows, space.basis.shape[1])
    return vectors, table.column("label").to_numpy().astype(np.float64)


def score(docs: DataFrame, space: Space, known: np.ndarray, labels: np.ndarray, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((space, known, labels))     # TERMS + max_rows vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_space, own_known, own_labels = shared.value
        for batch in slices(batches, "terms", TERM_BYTES):
            scores = vote(own_space.vectors(*entries(batch), batch.num_rows), own_known, own_labels)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])

    return _termed(docs, text_col, F.col(id_col).cast("long").alias("doc_id")).mapInArrow(
        run, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op11_quality_neighbours(spark, sf_dir):
    docs = staged(with_terms(relation(spark, sf_dir, "documents").select("doc_id", "text")), "terms")
    space = fit_space(docs)
    known, labels = labelled_vectors(docs, relation(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))), space)
    return score(docs, space, known, labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


QUERIES = {"op11_quality_neighbours": op11_quality_neighbours}
ORACLE = {}
