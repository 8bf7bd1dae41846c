"""What a worker of the token output holds while it encodes."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyspark

from dimledger.llm import huffman


def test_encoding_holds_little_beside_its_texts(monkeypatch):
    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 0

    monkeypatch.setattr(pyspark, "TaskContext", Task)
    rng = np.random.default_rng(1)
    texts = pa.array([" ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (500, 6)).tolist())
                      for _ in range(1300)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["doc_id", "text"])
    run = huffman._tokenise(public_tokenizers.path("byte_bpe_50k.json"), 0, huffman.BLOCK_IDS)
    list(run(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    try:
        rows = 0
        for row in run(iter([batch])):
            rows += sum(map(len, row.column("doc_ids").drop_null().to_pylist()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(texts) and texts.nbytes > 4 << 20
    # The table of pieces is bounded by their number; a slice by 2 MB of text.
    assert peak < 150 << 20
