"""Helpers shared by the training-data operators.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` of a text everywhere in this
subpackage unless an operator says otherwise; a NULL text has no words.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimledger.session import checkpoint_dir

SPACE = r"[\x20\x09-\x0D]"          # separators of words
WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"     # of rows sent to a worker at once


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Where ``spark.checkpoint.dir`` is unset (tests, one machine) a temporary
    folder is registered as the checkpoint folder.
    """
    spark_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not spark_dir:
        spark_dir = checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="dimledger-ckpt-"))
    return f"{spark_dir.rstrip('/')}/dimledger-llm/{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's ``key`` is ``value`` meanwhile."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def staged(df: DataFrame, name: str = "stage", **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage so
    that a lost executor costs at most one step. The shuffle files behind the
    write are released with it, the table replaces them. ``options`` are the
    writer's."""
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{name}"
    with setting(spark, CLEANUP, "true"):
        df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_array(text: Column) -> Column:
    """Words of a text as an array (empty for NULL)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words as a long, without the array of words: a word starts
    where a separator (or the start) is followed by another character."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 8 << 20, max_rows: int = 10_000
           ) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``max_bytes`` of text (one
    row at least) and ``max_rows`` rows, which bounds the memory of the
    vectorised steps."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            stop = min(stop, start + max_rows)
            yield batch.slice(start, stop - start)
            start = stop
    # Workers live on for other operators: what this one no longer needs goes back.
    pa.default_memory_pool().release_unused()


def words_csr(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of a batch of texts: ``(offsets, codes, distinct)``; the words of
    text ``i`` are ``distinct[codes[offsets[i]:offsets[i + 1]]]``."""
    clean = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    parts = pc.ascii_split_whitespace(clean)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    flat = parts.flatten()
    offsets = offsets - offsets[0]
    blank = pc.equal(flat, "").to_numpy(zero_copy_only=False)
    if blank.any():  # texts without a word give one empty part
        keep = ~blank
        kept = np.concatenate([[0], np.cumsum(keep)])
        offsets = kept[offsets]
        flat = flat.filter(pa.array(keep))
    coded = flat.dictionary_encode()
    return offsets, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: a bijective mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_strings(values: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct strings, the same in every process."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(v) for v in values.cast(pa.binary()).to_pylist()),
                       dtype=np.uint64, count=len(values))
