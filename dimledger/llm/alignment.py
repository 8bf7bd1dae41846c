"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut a text's bytes into two sequences of tokens. Tokens that
overlap belong together; the groups are the connected parts. Every token points
to the farthest-right token it overlaps (itself, if none reaches farther);
successors are doubled, ``next = next[next]``, for all tokens of a batch at once
until nothing changes. Then every token names its group's last token, the one
at whose end both tokenizers cut.

Links are all pairs of a token of A and a token of B in one group; the count of
a pair of ids is the number of documents that hold it linked.

Flow: texts are encoded and aligned where they are read, a slice of text at a
time, and gathered to blocks of a few megabytes. A block keeps its documents'
figures, its distinct id pairs, and for each document which of these it holds
how often (packed, for the JVM only carries it). Pairs are counted over all
blocks (a row per pair and block, not per document), and the counts come back
to the blocks, where documents sum them. No pair of tokens leaves its block.

Defined results: a NULL or empty text, or one whose tokens do not spell it (a
vocabulary that changes characters), has no tokens: zeros and an empty string.
Strings of special tokens inside texts are plain text. Repeated rows are
documents of their own and count each; an empty table gives an empty result;
other columns are not read. A text is never cut: a block holds at least one,
and its links are formed a bounded number at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimledger.llm.common import BATCH, relation, setting, slices, staged

BLOCK_BYTES = 2 << 20       # text of a block, about; a longer text has a block of its own
BLOCK_ROWS = 10_000         # documents of a block, about
BATCH_BYTES = 1 << 20       # text sent to a worker, and encoded, at once, about
SLICE_BYTES = 256 << 10     # text aligned at once: arrays of some 80 bytes a byte of text
ROW_GROUP = 16 << 20        # of the blocks' files: its rows are read together
LINKS_AT_ONCE = 1 << 18     # links formed before equal ones are added up
PIECES = 400_000            # pieces that each encoder of a worker remembers
MANY = 64                   # links of a group from which equal ids in it are added up first

BLOCKS = ("block long, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
          "n_links array<bigint>, groups_sha256 array<string>, pairs array<bigint>, documents array<int>, "
          "held array<int>, pair binary, times binary")
ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(),
             "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.schema([(n, pa.list_(kinds[k[6:-1]]) if k.startswith("array") else kinds[k]) for n, k in fields])


# ------------------------------------------------------------------ groups

def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For all tokens of A, then of B (given by the ascending ends of their
    bytes, both tiling the same range): the number of the token of A that ends
    its group."""
    n = len(ends_a)
    over = np.searchsorted(ends_b, ends_a)                      # the token of B over the last byte
    follow = np.concatenate([np.where(ends_b[over] > ends_a, n + over, np.arange(n)) if n else over,
                             np.searchsorted(ends_a, ends_b)])
    while True:
        doubled = follow[follow]
        if np.array_equal(doubled, follow):
            return follow
        follow = doubled


def spelt(ids: np.ndarray, offsets: np.ndarray, table: pa.Array, widths: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Whether the bytes of each text's tokens are the text."""
    from dimledger.llm.tokens import text_bytes

    bounds, raw = text_bytes(texts)
    made = np.append(0, np.cumsum(widths[ids]))[offsets]
    good = np.diff(made) == np.diff(bounds)
    own = table.take(pa.array(ids))
    spelled = np.frombuffer(own.buffers()[2], np.uint8)[:made[-1]] if len(ids) else np.empty(0, np.uint8)
    if good.all():
        wrong = np.append(0, np.cumsum(spelled != raw))[bounds]
        return np.diff(wrong) == 0
    for k in np.flatnonzero(good).tolist():
        good[k] = np.array_equal(spelled[made[k]:made[k + 1]], raw[bounds[k]:bounds[k + 1]])
    return good


def rows_of(ids: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and sizes of texts, those that are not kept emptied."""
    sizes = np.diff(offsets)
    return ids[np.repeat(keep, sizes)], np.where(keep, sizes, 0)


def entries(group: np.ndarray, ids: np.ndarray, big: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, times) by group; equal ids of a big group are one entry."""
    much = big[group]
    if not much.any():
        return group, ids, np.ones(len(ids), np.int64)
    key, times = np.unique((group[much] << 32) | ids[much], return_counts=True)
    rest = ~much
    group = np.concatenate([group[rest], key >> 32])
    order = np.argsort(group, kind="stable")
    return (group[order], np.concatenate([ids[rest], key & 0xFFFFFFFF])[order],
            np.concatenate([np.ones(int(rest.sum()), np.int64), times])[order])


def _added_up(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    return key[starts], np.add.reduceat(times, starts) if len(starts) else times


def links(a: tuple, b: tuple, groups: int, doc: np.ndarray, width: int, at_once: int = LINKS_AT_ONCE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair of ids, times) of the entries of both sides that share a
    group, by document and pair; a pair is ``id of A * width + id of B``."""
    group_a, ids_a, times_a = a
    group_b, ids_b, times_b = b
    many = np.bincount(group_b, minlength=groups)
    first = np.cumsum(many) - many
    done = np.append(0, np.cumsum(many[group_a]))
    parts, at = [], 0
    while at < len(group_a):
        stop = max(at + 1, int(np.searchsorted(done, done[at] + at_once, side="right")) - 1)
        count = many[group_a[at:stop]]
        left = np.repeat(np.arange(at, stop), count)
        right = np.arange(len(left)) - np.repeat(np.cumsum(count) - count - first[group_a[at:stop]], count)
        # Documents and pairs are below 2^31 each; a document is cut by no group.
        key = (doc[group_a[left]] << 32) | (ids_a[left] * width + ids_b[right])
        parts.append(_added_up(key, times_a[left] * times_b[right]))
        at = stop
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    key, times = parts[0] if len(parts) == 1 else _added_up(*(np.concatenate(p) for p in zip(*parts, strict=True)))
    return key >> 32, key & 0xFFFFFFFF, times


def spellings(group: np.ndarray, side: np.ndarray, ids: np.ndarray, doc: np.ndarray, docs: int,
              labels: pa.Array) -> list[str]:
    """Hash of each document's ``a1,a2|b1;a3|b2`` for tokens by (group, side, place)."""
    out = [""] * docs
    if not len(ids):
        return out
    new_doc, new_group = doc[1:] != doc[:-1], group[1:] != group[:-1]
    mark = np.append(np.where(new_doc, 0, np.where(new_group, 1, np.where(side[1:] != side[:-1], 2, 3))), 0)
    text = labels.take(pa.array(ids * 4 + mark))
    ends = np.frombuffer(text.buffers()[1], np.int32)[1:len(ids) + 1]
    raw = memoryview(text.buffers()[2])
    last = np.flatnonzero(np.append(new_doc, True))
    start = 0
    for d, stop in zip(doc[last].tolist(), ends[last].tolist(), strict=True):
        out[d] = hashlib.sha256(raw[start:stop]).hexdigest()
        start = stop
    return out


# ------------------------------------------------------------------ blocks

class Aligner:
    """Aligns batches of texts; one per worker process."""

    def __init__(self, a_path: str, b_path: str):
        from dimledger.llm.tokens import ByteBpe, PieceBpe, encoder

        self.a, self.b = encoder(ByteBpe, a_path, True, PIECES), encoder(PieceBpe, b_path, PIECES)
        self.table_a, self.table_b = (pa.array(e.token_bytes(), pa.binary()) for e in (self.a, self.b))
        self.width_a, self.width_b = (pc.binary_length(t).to_numpy().astype(np.int64)
                                      for t in (self.table_a, self.table_b))
        most = max(len(self.width_a), len(self.width_b))
        self.labels = pa.array([f"{i}{mark}" for i in range(most) for mark in ("", ";", "|", ",")], pa.binary())

    def parts(self, texts: pa.Array) -> Iterator[dict]:
        """Figures of texts by slices, and the pairs of ids that each holds,
        ascending: ``held`` is how many."""
        from dimledger.llm.tokens import led_by_space

        some = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False)
        led = led_by_space(texts)
        off_a, ids_a = self.a.encode(led)
        off_b, ids_b = self.b.encode(led)
        at = 0
        for own in slices(iter([pa.RecordBatch.from_arrays([led], names=["text"])]), "text", SLICE_BYTES):
            to = at + own.num_rows
            yield self._part(own.column(0), some[at:to], off_a[at:to + 1] - off_a[at], ids_a[off_a[at]:off_a[to]],
                             off_b[at:to + 1] - off_b[at], ids_b[off_b[at]:off_b[to]])
            at = to

    def _part(self, led: pa.Array, some: np.ndarray, off_a: np.ndarray, ids_a: np.ndarray, off_b: np.ndarray,
              ids_b: np.ndarray) -> dict:
        n = len(led)
        keep = (some & spelt(ids_a, off_a, self.table_a, self.width_a, led)
                & spelt(ids_b, off_b, self.table_b, self.width_b, led))
        ids_a, n_a = rows_of(ids_a.astype(np.int64), off_a, keep)
        ids_b, n_b = rows_of(ids_b.astype(np.int64), off_b, keep)
        last = terminals(np.cumsum(self.width_a[ids_a]), np.cumsum(self.width_b[ids_b]))
        ending = np.zeros(len(ids_a), dtype=bool)
        ending[last] = True
        number = np.cumsum(ending) - 1                       # of the group a token of A ends
        group = number[last]
        group_a, group_b = group[:len(ids_a)], group[len(ids_a):]
        groups = int(ending.sum())
        doc_a = np.repeat(np.arange(n), n_a)
        doc = doc_a[ending]                                  # of each group
        size_a, size_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        n_links = np.zeros(n, np.int64)
        np.add.at(n_links, doc, size_a * size_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        both, side = np.concatenate([ids_a, ids_b])[order], (order >= len(ids_a)).astype(np.int64)
        hashes = spellings(group[order], side, both, doc[group[order]], n, self.labels)
        big = size_a * size_b >= MANY
        held, pair, times = links(entries(group_a, ids_a, big), entries(group_b, ids_b, big), groups, doc,
                                  len(self.width_b))
        return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc, minlength=n), "n_links": n_links,
                "groups_sha256": pa.array(hashes, pa.string()), "held": np.bincount(held, minlength=n),
                "pair": pair, "times": times}


def packed(values: np.ndarray) -> bytes:
    import zstandard

    planes = values.view(np.uint8).reshape(-1, values.itemsize).T       # bytes of equal rank side by side
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(value: bytes, kind: str) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8)
    return planes.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _block(number: int, doc_ids: list[pa.Array], parts: list[dict]) -> pa.RecordBatch:
    """What a block keeps of its texts."""
    made = {c: np.concatenate([p[c] for p in parts]) if isinstance(parts[0][c], np.ndarray)
            else pa.concat_arrays([p[c] for p in parts]) for c in parts[0]}
    pairs, place, documents = np.unique(made["pair"], return_inverse=True, return_counts=True)
    made |= {"block": [number], "doc_id": pa.concat_arrays(doc_ids), "pairs": pairs, "documents": documents,
             "pair": [packed(np.diff(place, prepend=0).astype("<i4"))],     # places ascend in a document
             "times": [packed(made["times"])]}
    schema = _schema(BLOCKS)
    return pa.RecordBatch.from_arrays([_one_list(made[f.name], f.type) if pa.types.is_list(f.type)
                                       else pa.array(made[f.name], f.type) for f in schema], schema=schema)


def _align(a_path: str, b_path: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, number = Aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        parts, doc_ids, size, rows = [], [], 0, 0
        for batch in slices(batches, "text", block_bytes):
            texts = batch.column("text")
            parts += aligner.parts(texts)
            doc_ids.append(batch.column("doc_id"))
            size, rows = size + (pc.sum(pc.binary_length(texts)).as_py() or 0), rows + len(texts)
            if size + BATCH_BYTES // 2 > block_bytes or rows >= BLOCK_ROWS:      # whole batches, as near as they come
                yield _block(number, doc_ids, parts)
                parts, doc_ids, size, rows, number = [], [], 0, 0, number + 1
        if parts:
            yield _block(number, doc_ids, parts)
    return run


def _one_list(values, kind: pa.DataType) -> pa.Array:
    flat = values if isinstance(values, pa.Array) else pa.array(values, kind.value_type)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat.cast(kind.value_type))


def _summed(block: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of a block, given the counts of its pairs in their order."""
    schema = _schema(ALIGNED)
    if not block.num_rows:
        return schema.empty_table()
    column = {c: block.column(c).combine_chunks().flatten() for c in block.column_names
              if pa.types.is_list(block.column(c).type)}
    n = len(column["doc_id"])
    order = np.argsort(counts.column("place").to_numpy())
    count, best = (counts.column(c).to_numpy()[order] for c in ("n", "best"))
    held = np.repeat(np.arange(n), column["held"].to_numpy())
    pair = np.cumsum(unpacked(block.column("pair")[0].as_py(), "<i4"), dtype=np.int64)
    times = unpacked(block.column("times")[0].as_py(), "<i8")
    n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if len(pair):
        np.add.at(n_best, held, times * best[pair])
        np.add.at(count_sum, held, times * count[pair])
    out = {**column, "n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
    return pa.table([out[f.name] for f in schema], schema=schema)


def align(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Aligned documents and the counts of linked ids.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256. Counts: a, b, n (documents that hold the pair linked), best
    (1 if no other id of B has more with this id of A). ``a_path`` is a file of
    the tokenizers library, ``b_path`` one of sentencepiece.
    """
    from dimledger.llm.tokens import PieceBpe

    width = len(PieceBpe(b_path).token_bytes())
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with setting(docs.sparkSession, BATCH, str(BATCH_BYTES)):
        blocks = staged(source.mapInArrow(_align(a_path, b_path, block_bytes), BLOCKS), "blocks",
                        **{"parquet.block.size": ROW_GROUP})
    pairs = staged(blocks.select(F.explode(F.arrays_zip("pairs", "documents")).alias("e"))
                   .groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.documents").cast("long").alias("n"))
                   .withColumn("a", F.floor(F.col("pair") / width)), "pairs")
    most = pairs.groupBy(F.col("a").alias("of_a")).agg(F.max("n").alias("most"))
    counts = staged(pairs.join(most, F.col("a") == F.col("of_a")).select(
        "pair", "a", F.pmod("pair", F.lit(width)).alias("b"), "n", (F.col("n") == F.col("most")).cast("long").alias("best")),
        "counts")
    asked = blocks.select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "of_pair"))
    answered = asked.join(counts, F.col("of_pair") == F.col("pair")).select("of_block", "place", "n", "best")
    documents = (blocks.drop("pairs", "documents").groupBy("block").cogroup(answered.groupBy("of_block"))
                 .applyInArrow(_summed, ALIGNED))
    return documents, counts.drop("pair")


def op12_token_alignment(spark, sf_dir):
    import public_tokenizers

    documents, _ = align(relation(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                         public_tokenizers.path("piece_bpe_32k.model"))
    return documents


QUERIES = {"op12_token_alignment": op12_token_alignment}
ORACLE = {}
