"""Corpus pipeline over ``documents``: quality rules, near-dedup, benchmark
decontamination, mixing to target weights, token output.

Every stage works on all documents its predecessor kept, is written and read
again, and returns the columns of ``documents`` (the last one the digests of
the token files). ``mixing`` repeats a document once per epoch that takes it
and drops those no epoch takes; its rows are range-sorted by training
position.
"""

from pyspark.sql import functions as F

from dimledger.llm import curriculum, decontaminate, huffman, minhash, quality
from dimledger.llm.common import relation, staged


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def dedup_stage(spark, docs, sf_dir):
    """One document of each class of near copies."""
    return minhash.keep_one(docs)


def decontamination_stage(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return decontaminate.without_benchmark(docs, relation(spark, sf_dir, "benchmark"))


def mixing_stage(spark, docs, sf_dir):
    """Every copy that the mix takes of a document, in training order."""
    return curriculum.mixed_documents(docs)


def token_stage(spark, docs, sf_dir):
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    return huffman.token_digests(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("MinHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", token_stage),
]
# Near-dedup classes, latent retrieval and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; every stage is written and read again."""
    docs = relation(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "".join(c if c.isalnum() else "_" for c in name))
    return STAGES[-1][1](spark, docs, sf_dir).select(
        "doc_id", "start", "n_tokens", F.col("ids_crc32"))
