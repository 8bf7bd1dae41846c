"""Nearest-neighbour quality votes: brute-force votes, the space, held-out labels."""

import math

import numpy as np
import pyarrow as pa
from helpers import documents, nasty_texts

from dimledger.llm import neighbours
from dimledger.llm.common import words_csr

SF = "/root/testdata/sf0.01"


def test_votes_by_hand():
    rng = np.random.default_rng(4)
    vectors, known = rng.standard_normal((70, 6)), rng.standard_normal((40, 6))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    known /= np.linalg.norm(known, axis=1, keepdims=True)
    labels = rng.integers(0, 2, 40).astype(float)
    got = neighbours.vote(vectors, known, labels, k=7, power=3, block=16)
    for v, score in zip(vectors, got):
        near = sorted(((float(v @ o), y) for o, y in zip(known, labels)), reverse=True)[:7]
        weights = [max(c, 0) ** 3 for c, _ in near]
        want = sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights)
        assert math.isclose(score, want, rel_tol=1e-9)
    assert neighbours.vote(vectors, known[:0], labels[:0]).tolist() == [0.5] * 70
    assert neighbours.vote(np.zeros((1, 6)), known, labels).tolist() == [labels.mean()]


def test_terms_of_a_text():
    words, repeated = "The the THE, x*** a1 ça -- of", "of of of of"
    row, term, count = neighbours.term_counts(pa.array([words, repeated, None, ""]))
    held = [dict(zip(term[row == k].tolist(), count[row == k].tolist())) for k in range(4)]
    # Words the (3), x, a1, ça, of; shapes Aa, aaa, A,, x***, a0, a, --; one length.
    assert sorted(held[0].values()) == sorted([3, 1, 1, 1, 1] + [1, 3, 1, 1, 1, 1] + [1])
    assert sorted(held[1].values()) == [1, 3, 3, 3, 3, 3, 4, 4]
    assert held[2] == held[3] and list(held[2].values()) == [1]
    assert len(words_csr(pa.array([words]))[2]) == 8


def test_space_holds_what_a_dense_factorisation_holds(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()[:300]]
    texts = pa.array([t for _, t in rows])
    space = neighbours.fit_space(documents(spark, rows), rank=40)
    row, term, count = neighbours.term_counts(texts)
    dense = np.zeros((len(rows), neighbours.TERMS), np.float32)
    dense[row, term] = neighbours.weighted(row, term, count, len(rows), space.idf)
    held = np.zeros(neighbours.TERMS, int)
    np.add.at(held, term, 1)
    used = held > 0
    assert np.allclose(space.idf[used], np.log((len(rows) + 1) / (held[used] + 1)) + 1e-3, atol=1e-5)
    best = (np.linalg.svd(dense, compute_uv=False)[:40] ** 2).sum()
    assert np.allclose(space.basis.T @ space.basis, np.eye(space.basis.shape[1]), atol=1e-3)
    # One pass over texts with a flat spectrum: not the best space of that rank, but near it.
    assert ((dense @ space.basis) ** 2).sum() > 0.75 * best


def test_held_out_labels(spark):
    got = {r.doc_id: r for r in neighbours.op11_quality_neighbours(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    apart = [(r.quality, got[r.doc_id].predicted) for r in labels if got[r.doc_id].held_out]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert sum(q == p for q, p in apart) >= 0.95 * len(apart)
    assert sum(p == 0 for q, p in apart if q == 0) >= 0.85 * sum(q == 0 for q, _ in apart)


def test_labels_of_held_out_rows_are_not_read(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    from pyspark.sql import functions as F

    scores = []
    for name, column in (("a", F.col("quality")), ("b", F.when(neighbours.held_out(F.col("doc_id")), 1 - F.col("quality"))
                                                    .otherwise(F.col("quality")))):
        folder = f"{scratch}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.withColumn("quality", column).write.parquet(f"{folder}/labels.parquet")
        scores.append(sorted(map(tuple, neighbours.op11_quality_neighbours(spark, folder).collect())))
    assert scores[0] == scores[1]


def test_nulls_ties_repeats_and_empty_tables(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 1, 0), (6, None, 1), (None, 1, 0), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = documents(spark, nasty_texts())
    space = neighbours.fit_space(docs)
    known, values = neighbours.labelled_vectors(docs, labels, space)
    assert sorted(values.tolist()) == [0.0, 1.0, 1.0]
    got = neighbours.score(docs, space, known, values).collect()
    assert len(got) == len(nasty_texts()) and all(0 <= r.score <= 1 for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_id[4]) == 1 and by_id[6] == by_id[7] and by_id[1] == by_id[2] == by_id[3]
    known, values = neighbours.labelled_vectors(docs, labels.limit(0), space)
    assert {r.score for r in neighbours.score(docs, space, known, values).collect()} == {0.5}
    nothing = documents(spark, [])
    space = neighbours.fit_space(nothing)
    known, values = neighbours.labelled_vectors(nothing, labels, space)
    assert neighbours.score(nothing, space, known, values).collect() == []


def test_terms_are_counted_once(spark, scratch, monkeypatch):
    texts = pa.array([f"Word{k} of x{k} {'y' * (k % 5)}" for k in range(300)] + [None, "", "of of of"])
    hashed, hash_strings = [], neighbours.hash_strings
    monkeypatch.setattr(neighbours, "hash_strings", lambda values: hashed.append(len(values)) or hash_strings(values))
    want = neighbours.term_counts(texts)
    assert sorted(hashed) == [3, 605]        # shapes Aa0, a, a0; distinct words
    monkeypatch.undo()
    docs = documents(spark, list(enumerate(texts.to_pylist())))
    termed = neighbours.with_terms(docs.select("doc_id", "text").coalesce(1).orderBy("doc_id").coalesce(1))
    got = neighbours.entries(termed.toArrow().combine_chunks().to_batches()[0])
    assert all(np.array_equal(a, b) for a, b in zip(got, want))
    docs.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(k, k % 2) for k in range(50)], "doc_id long, quality int").write.parquet(
        f"{scratch}/labels.parquet")
    scored = neighbours.op11_quality_neighbours(spark, scratch)
    assert scored.count() == len(texts) and not [f for f in scored.inputFiles() if "documents.parquet" in f]
    whole = neighbours.fit_space(docs)
    known, labels = neighbours.labelled_vectors(docs, spark.read.parquet(f"{scratch}/labels.parquet").filter(
        ~neighbours.held_out(neighbours.F.col("doc_id"))), whole)
    plain = dict(map(tuple, neighbours.score(docs, whole, known, labels).collect()))
    assert all(math.isclose(r.score, plain[r.doc_id], abs_tol=1e-3) for r in scored.collect())
