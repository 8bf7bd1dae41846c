"""Token-ID / binary output: canonical length-limited Huffman coding.

``write_tokens`` turns documents into a folder of files:

* ``codebook``: one row per used id with its code length and global count;
  lengths alone define the canonical code (codes ascend by length, then id).
* ``blocks``: consecutive documents in ascending doc_id order (NULL first;
  equal ids by text digest). A block holds the documents' ids and lengths,
  the number of ids before it, the coded bits of all its ids (most
  significant bit first) and a checkpoint every ``INTERVAL`` ids: the bit
  offset where that id's code starts. Blocks decode without each other, and
  a block's checkpoints decode side by side.

``read_tokens`` decodes the files back by table lookup.

Work flow: one range shuffle of the texts by doc_id; each range is encoded
by the tokenizers library and written as staged blocks, sorted, with the
task's counts of ids, which are summed globally; the driver gets the counts (as many
rows as the vocabulary has ids, no more) and builds the code lengths; one
more pass without a shuffle writes the coded blocks.

Defined results: a NULL text is the empty text, so its document is the end
id alone; an empty table gives empty files; repeated rows are kept, each a
document of its own; other columns are not read. A text is never cut; a block
holds at least one whole document, whatever its length. The strings of the
vocabulary's added tokens in a text become these tokens, as the library has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimledger.llm.common import relation, slices, stage_folder, staged

MAX_BITS = 20          # longest code (25 at most)
INTERVAL = 128         # ids between two checkpoints
BLOCK_IDS = 1 << 18    # ids in a block, about; a longer document has a block of its own
SLICE_BYTES = 2 << 20  # text encoded at once: arrays of some 20 bytes a byte of text
END_ID = 0

STAGED = ("part int, seq long, start long, doc_ids array<bigint>, sizes array<bigint>, ids binary, "
          "used array<int>, counts array<bigint>")
BLOCKS = ("part int, seq long, start long, doc_ids array<bigint>, sizes array<bigint>, n_ids long, "
          "checkpoints binary, bits binary")


# ------------------------------------------------------------------ the code

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` by package-merge.

    Ids without a count get length 0 (no code); a single used id gets 1 bit.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) == 0:
        return lengths
    if len(used) == 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids do not fit codes of {max_bits} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    n = len(used)
    # Level by level: merge the coins with the pairs of the level below. A
    # level is kept as the order of its items (coin index, or n + pair index).
    levels = []
    packages = np.empty(0)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order)
        sums = merged[order]
        packages = sums[0:len(sums) // 2 * 2:2] + sums[1:len(sums) // 2 * 2:2]
    take = 2 * n - 2
    depth = np.zeros(n, dtype=np.int64)
    for order in reversed(levels):
        chosen = order[:take]
        coins = chosen[chosen < n]
        depth[coins] += 1
        take = 2 * int(np.sum(chosen >= n))
    lengths[used] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes that ascend by (length, id)."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    width = lengths[used].astype(np.int64)
    if len(used):
        span = np.int64(1) << (width.max() - width)          # share of the code space
        starts = np.concatenate([[0], np.cumsum(span)])[:-1]
        codes[used] = (starts >> (width.max() - width)).astype(np.uint32)
    return codes


def decode_table(lengths: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``max_bits`` bits: the id it starts with, its length."""
    ids = np.zeros(1 << max_bits, dtype=np.uint32)
    bits = np.zeros(1 << max_bits, dtype=np.uint8)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    width = lengths[used].astype(np.int64)
    span = np.int64(1) << (max_bits - width)
    end = int(span.sum())
    ids[:end] = np.repeat(used, span)
    bits[:end] = np.repeat(width, span)
    return ids, bits


def encode_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray,
                interval: int = INTERVAL) -> tuple[bytes, np.ndarray]:
    """Coded bits of ids and the checkpoints (a bit offset per ``interval`` ids)."""
    width = lengths[ids].astype(np.int64)
    ends = np.cumsum(width)
    starts = ends - width
    total = int(ends[-1]) if len(ends) else 0
    # A code lies in the 32 bits from the byte where it starts.
    shifted = codes[ids].astype(np.int64) << (32 - (starts & 7) - width)
    byte = starts >> 3
    out = np.zeros((total + 7) // 8 + 4, dtype=np.float64)
    for k in range(4):
        out += np.bincount(byte + k, weights=(shifted >> (24 - 8 * k)) & 255, minlength=len(out))
    return out[:(total + 7) // 8].astype(np.uint8).tobytes(), starts[::interval].astype("<u4")


def decode_bits(bits: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray],
                max_bits: int, interval: int = INTERVAL) -> np.ndarray:
    """Ids of a block: all checkpoints advance together, an id at a time."""
    if not n:
        return np.empty(0, dtype=np.uint32)
    symbol, width = table
    data = np.frombuffer(bits + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
    windows = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    at = checkpoints.astype(np.int64)
    lanes = len(at)
    out = np.zeros((lanes, interval), dtype=np.uint32)
    mask = (1 << max_bits) - 1
    last = n - (lanes - 1) * interval            # ids of the last lane
    for k in range(min(interval, n)):
        here = at[:-1] if k >= last else at
        window = (windows[here >> 3] >> (32 - max_bits - (here & 7)).astype(np.uint32)) & mask
        out[:len(here), k] = symbol[window]
        here += width[window]
    return out.ravel()[:n] if lanes else out.ravel()


# ------------------------------------------------------------------ the flow

_STAGED_SCHEMA = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("start", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("ids", pa.binary()),
                            ("used", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])


def _staged_row(**row) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], f.type) for f in _STAGED_SCHEMA],
                                      schema=_STAGED_SCHEMA)


def _packed(ids: np.ndarray) -> bytes:
    import zstandard

    planes = ids.view(np.uint8).reshape(-1, 4).T.copy()        # bytes of equal rank side by side
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(value: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _tokenise(vocabulary: str, end_id: int, block_ids: int):
    """Texts to rows of blocks; a task's last row has its counts of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from dimledger.llm.tokens import ByteBpe, encoder

        enc = encoder(ByteBpe, vocabulary, False)
        part = TaskContext.get().partitionId()
        seq = start = held = 0
        doc_ids, sizes, ids = [], [], []
        total = np.zeros(0, dtype=np.int64)

        def block() -> pa.RecordBatch:
            nonlocal total
            flat = np.concatenate(ids).astype("<u4")
            found = np.bincount(flat, minlength=len(total))
            found[:len(total)] += total
            total = found
            return _staged_row(part=part, seq=seq, start=start, doc_ids=doc_ids, sizes=sizes, ids=_packed(flat))

        end = np.array([end_id], dtype="<u4")
        for batch in slices(batches, "text", SLICE_BYTES):
            bounds, flat = enc.encode(batch.column("text"))
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                own = flat[bounds[i]:bounds[i + 1]]
                doc_ids.append(doc_id)
                sizes.append(len(own) + 1)
                ids += [own, end]
                held += len(own) + 1
                if held >= block_ids:
                    yield block()
                    seq, start, held = seq + 1, start + held, 0
                    doc_ids, sizes, ids = [], [], []
        if doc_ids:
            yield block()
        used = np.flatnonzero(total)
        yield _staged_row(part=part, used=used, counts=total[used])
    return run


def _encode(lengths: np.ndarray, before: dict[int, int], interval: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                ids = _unpacked(row["ids"])
                bits, checkpoints = encode_bits(ids, lengths, codes, interval)
                yield pa.RecordBatch.from_pylist(
                    [{"part": row["part"], "seq": row["seq"], "start": before[row["part"]] + row["start"],
                      "doc_ids": row["doc_ids"], "sizes": row["sizes"], "n_ids": len(ids),
                      "checkpoints": checkpoints.tobytes(), "bits": bits}], schema=_BLOCK_SCHEMA)
    return run


_BLOCK_SCHEMA = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("start", pa.int64()),
                           ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                           ("n_ids", pa.int64()), ("checkpoints", pa.binary()), ("bits", pa.binary())])


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID,
                 max_bits: int = MAX_BITS, interval: int = INTERVAL, block_ids: int = BLOCK_IDS,
                 id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the documents' ids to ``path`` (codebook and blocks); returns it.

    ``vocabulary`` is the path of a tokenizers file, readable on every
    executor.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = (source.withColumn("tie", F.xxhash64("text"))
              .repartitionByRange("doc_id", "tie")
              .sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    blocks = staged(ranged.mapInArrow(_tokenise(vocabulary, end_id, block_ids), STAGED), "ids")

    counts = (blocks.select(F.explode(F.arrays_zip(F.col("used").alias("id"), F.col("counts").alias("n"))).alias("e"))
              .groupBy("e.id").agg(F.sum("e.n").alias("count")).toPandas())
    blocks = blocks.filter("ids IS NOT NULL").drop("used", "counts")
    size = int(counts["id"].max()) + 1 if len(counts) else 0
    weights = np.zeros(size, dtype=np.int64)
    weights[counts["id"].to_numpy()] = counts["count"].to_numpy()
    lengths = code_lengths(weights, max_bits)
    used = np.flatnonzero(weights)
    spark.createDataFrame(pa.table({"id": pa.array(used, pa.int32()), "bits": pa.array(lengths[used], pa.int32()),
                                    "count": pa.array(weights[used], pa.int64())})
                          ).coalesce(1).write.parquet(f"{path}/codebook")

    # Ids before each range of doc_ids: one number per range.
    totals = (blocks.select("part", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
              .groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect())
    before, at = {}, 0
    for row in totals:
        before[row["part"]] = at
        at += row["n"]
    (blocks.mapInArrow(_encode(lengths, before, interval), BLOCKS)
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))
    return path


def _decode(lengths: np.ndarray, interval: int):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = int(lengths.max()) if len(lengths) else 1
        table = decode_table(lengths, most)
        for batch in batches:
            for row in batch.to_pylist():
                checkpoints = np.frombuffer(row["checkpoints"], dtype="<u4")
                ids = decode_bits(row["bits"], checkpoints, row["n_ids"], table, most, interval).astype("<u4")
                sizes = np.array(row["sizes"], dtype=np.int64)
                ends = np.cumsum(sizes)
                raw = [ids[e - s:e].tobytes() for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - sizes),
                     pa.array(sizes), pa.array(raw, pa.binary())], schema=schema)
    return run


def read_tokens(spark: SparkSession, path: str, interval: int = INTERVAL) -> DataFrame:
    """Documents of a folder written by ``write_tokens``: doc_id, start (ids of
    all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    book = spark.read.schema("id int, bits int, count long").parquet(f"{path}/codebook").toPandas()
    lengths = np.zeros(int(book["id"].max()) + 1 if len(book) else 0, dtype=np.uint8)
    lengths[book["id"].to_numpy()] = book["bits"].to_numpy()
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return blocks.mapInArrow(_decode(lengths, interval),
                             "doc_id long, start long, n_tokens long, ids binary")


def token_digests(docs: DataFrame) -> DataFrame:
    """Write with the production vocabulary, read back, digest each document."""
    import public_tokenizers

    spark = docs.sparkSession
    path = write_tokens(docs, f"{stage_folder(spark)}/tokens", public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32"))


def op7_token_output(spark, sf_dir):
    return token_digests(relation(spark, sf_dir, "documents"))


QUERIES = {"op7_token_output": op7_token_output}
ORACLE = {}
