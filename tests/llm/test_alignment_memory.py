"""What a worker of the token alignment holds, and what it hands on."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyspark
import pytest

from dimledger.llm import alignment

PATHS = [public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(autouse=True)
def task(monkeypatch):
    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 3

    monkeypatch.setattr(pyspark, "TaskContext", Task)


def batch(rows, words):
    rng = np.random.default_rng(1)
    texts = [" ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (words, 6)).tolist()) for _ in range(rows)]
    return pa.RecordBatch.from_arrays([pa.array(range(rows)), pa.array(texts)], names=["doc_id", "text"])


def test_aligning_holds_little_beside_its_texts():
    whole = batch(1300, 500)
    run = alignment._align(*PATHS, alignment.BLOCK_BYTES)
    list(run(iter([whole.slice(0, 1)])))
    tracemalloc.start()
    try:
        sizes = [(len(row.column("doc_id")[0]), row.nbytes)
                 for row in run(whole.slice(k, 300) for k in range(0, whole.num_rows, 300))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(n for n, _ in sizes) == whole.num_rows and whole.nbytes > 4 << 20
    # Mostly the tables of 650,000 different pieces of both sides; beside them, no array of a whole block's tokens.
    assert peak < 190 << 20
    # The JVM carries a block as one row: no wider than its text.
    assert max(size for _, size in sizes) < alignment.BLOCK_BYTES + alignment.BATCH_BYTES


def test_blocks_do_not_depend_on_slices_and_batches(monkeypatch):
    whole = batch(60, 40)
    texts = pa.array([None, "", "日本語" * 300] + whole.column(1).to_pylist()[3:])
    whole = pa.RecordBatch.from_arrays([whole.column(0), texts], names=["doc_id", "text"])
    run = alignment._align(*PATHS, alignment.BLOCK_BYTES)
    want = [row.to_pydict() for row in run(iter([whole]))]
    assert len(want) == 1
    monkeypatch.setattr(alignment, "SLICE_BYTES", 100)
    monkeypatch.setattr(alignment, "BATCH_BYTES", 1000)
    assert [row.to_pydict() for row in run(whole.slice(k, 7) for k in range(0, 60, 7))] == want


def test_packed_arrays_come_back():
    for values in ([], [1], [3, -5, 1 << 30], [0] * 9):
        for kind in ("<i4", "<i8"):
            assert alignment.unpacked(alignment.packed(np.array(values, kind)), kind).tolist() == values
