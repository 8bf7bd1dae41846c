"""Benchmark decontamination by latent semantic retrieval.

Terms are words in lower case without punctuation at their ends. The
vocabulary is that of the benchmark: a term no item has can neither match an
item nor move its vector. Documents are cut into passages of ``WINDOW`` words,
weighted by TF-IDF: end to end where statistics are gathered, so that every
word counts once, and ``STRIDE`` apart where they are searched. A randomised
SVD of all passages (one pass: ``A'A`` times a Gaussian test matrix, then a Nystrom
factorisation of that sketch) gives the latent space; the items' own rows
belong to the factorised matrix, weighted so that the space holds them.
Passages whose cosine with an item is at least ``COSINE`` there are candidates.
A space of bounded rank cannot vouch for every item: for those with few terms
of weight, and those that keep less than ``HELD`` of their length in it, the
stretches that hold enough of an item's rarest words (``Anchors``) are
candidates as well, a test that passes every place the check could accept. For
all others the space alone decides. A candidate counts if the longest common
subsequence of item and passage is at least ``LCS_SHARE`` of the item's words
within a stretch not much longer than the item, and, for items with an answer
part, if the answer is there too.

Flow: one pass over the texts turns each into the numbers of its terms (a
table of a tenth of the text's size; no shuffle); document frequencies, the
sketch and the search are passes over that table. Per task they send up one
number per term, one row of the sketch per term, and the links found. The
benchmark is taken in blocks of at most ``BLOCK_ITEMS`` items, which bounds
the vocabulary, the sketch and all that is broadcast.

Defined results: one row per document row and item that it holds; NULL or
empty texts and items match nothing; a text of any length is searched whole;
repeated documents give repeated rows; empty tables give an empty result;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimledger.llm.common import relation, slices, staged, words_csr

WINDOW, STRIDE = 48, 24
RANK, OVERSAMPLE = 192, 16
ANCHOR_SHARE = 6        # an item asks for a sixth of its words as anchors, 2 at least
COSINE = 0.45
LCS_SHARE = 0.6
HELD = 0.6              # items that keep less of their length in the space are searched by anchors as well
STRETCH = 1.25          # words of a matched stretch, in words of the item
MAX_DF = 0.005          # terms in more passages have no weight, unless an item has few others
MIN_DF_CUT = 20         # terms in so few passages always have weight
FEW_TERMS = 5
BLOCK_ITEMS = 512
RUN = 64                # entries of a group that are summed one after the other
SEED = 7
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ANSWER = re.compile(r"(?is)(?:^|\n|\s)(?:answer|ans|a)\s*:\s*(.+)$")


def terms(words: pa.Array) -> pa.Array:
    return pc.utf8_trim(pc.utf8_lower(words), characters=EDGES)


def item_terms(text: str) -> list[str]:
    return [t for t in terms(words_csr(pa.array([text]))[2].take(pa.array(words_csr(pa.array([text]))[1]))
                             ).to_pylist() if t]


@dataclass
class Items:
    """A block of the benchmark: items as term numbers (1 and up)."""

    ids: list[int]
    codes: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: list[str]

    @property
    def size(self) -> int:
        return len(self.vocabulary) + 1


def read_items(rows: list[tuple[int, str]]) -> Items:
    parsed = [(i, item_terms(t), item_terms(m[1]) if (m := ANSWER.search(t)) else []) for i, t in rows]
    parsed = [p for p in parsed if p[1]]
    vocabulary = sorted({t for _, ts, _ in parsed for t in ts})
    number = {t: k + 1 for k, t in enumerate(vocabulary)}
    return Items([p[0] for p in parsed], [np.array([number[t] for t in p[1]]) for p in parsed],
                 [np.array([number[t] for t in p[2]], dtype=np.int64) for p in parsed], vocabulary)


# ------------------------------------------------------------------ passages

def coded(vocabulary: list[str]):
    """Texts to the numbers of their terms, 0 for a term of no item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for batch in slices(batches, "text"):
            offsets, codes, distinct = words_csr(batch.column("text"))
            number = pc.fill_null(pc.index_in(terms(distinct), value_set=known), -1).to_numpy(zero_copy_only=False)
            flat = (number.astype(np.int64) + 1)[codes].astype("<u4") if len(codes) else np.empty(0, "<u4")
            # A text without two terms of the benchmark cannot hold an item's sequence.
            rows, doc_ids = [], batch.column("doc_id").to_pylist()
            for i, doc_id in enumerate(doc_ids):
                own = flat[offsets[i]:offsets[i + 1]]
                if own.any():
                    rows.append((doc_id, own.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                names=["doc_id", "codes"])
    return run


def passages(codes: list[np.ndarray], size: int, stride: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Term counts of the passages of documents: ``(passage, term, count)`` in
    the order of passages, then document and first word of each passage."""
    lengths = np.array([len(c) for c in codes], dtype=np.int64)
    steps = -(-lengths // stride)
    count = np.maximum(1, steps - (WINDOW // stride - 1))        # windows of a document
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    doc = np.repeat(np.arange(len(codes)), count)
    begin = (np.arange(int(count.sum())) - np.repeat(first, count)) * stride
    flat = np.concatenate(codes) if codes else np.empty(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(codes)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    hit = flat > 0
    flat, owner, place = flat[hit].astype(np.int64), owner[hit], place[hit]
    keys = []
    for back in range(WINDOW // stride):
        window = place // stride - back
        inside = (window >= 0) & (window < count[owner])
        keys.append((first[owner] + window)[inside] * size + flat[inside])
    key, times = np.unique(np.concatenate(keys), return_counts=True)
    return key // size, key % size, times, doc, begin


def frequencies(size: int):
    """Passages that hold each term; the number of passages as term 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            codes = [np.frombuffer(c, "<u4") for c in batch.column("codes").to_pylist()]
            _, term, _, doc, _ = passages(codes, size, WINDOW)
            total += np.bincount(term, minlength=size)
            total[0] += len(doc)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["term", "n"])
    return run


def term_weights(items: Items, total: np.ndarray) -> np.ndarray:
    """IDF of the terms; 0 for those in more than ``MAX_DF`` of the passages,
    but all terms of an item with fewer than ``FEW_TERMS`` others keep theirs."""
    n = max(int(total[0]), 1)
    idf = np.log((n + 1) / (total + 1.0)) + 1e-3
    idf[0] = 0
    rare = total <= max(MAX_DF * n, MIN_DF_CUT)
    keep = rare.copy()
    for own in items.codes:
        if len({t for t in own.tolist() if rare[t]}) < FEW_TERMS:
            keep[own] = True
    keep[0] = False
    return np.where(keep, idf, 0.0)


def weighted(passage: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, idf: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF rows as (passage, term, value); entries without weight are dropped."""
    value = (1 + np.log(count)) * idf[term]
    used = value > 0
    passage, term, value = passage[used], term[used], value[used]
    norm = np.sqrt(np.bincount(passage, weights=value * value, minlength=n))
    return passage, term, (value / norm[passage]).astype(np.float32)


def sums_of_rows(starts: np.ndarray, row: np.ndarray, value: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Per group of entries (from each start to the next) the sum of ``value``
    times the ``row`` of ``matrix``: first entries of all groups at once, then
    second ones, and so on. Groups of more than ``RUN`` entries go in runs."""
    sizes = np.diff(np.append(starts, len(row)))
    runs = -(-sizes // RUN)
    if len(runs) and runs.max() > 1:
        first = np.cumsum(runs) - runs
        begins = np.repeat(starts, runs) + (np.arange(int(runs.sum())) - np.repeat(first, runs)) * RUN
        return np.add.reduceat(sums_of_rows(begins, row, value, matrix), first, axis=0)
    order = np.argsort(-sizes, kind="stable")
    begins = starts[order]
    longer = np.searchsorted(-sizes[order], -np.arange(1, sizes.max(initial=1)), side="left")
    value = value[:, None]
    out = matrix[row[begins]] * value[begins]
    for k, m in enumerate(longer.tolist(), 1):
        at = begins[:m] + k
        part = matrix[row[at]]
        part *= value[at]
        out[:m] += part
    back = np.empty_like(out)
    back[order] = out
    return back


def project(passage: np.ndarray, term: np.ndarray, value: np.ndarray, matrix: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """Rows times ``matrix``, for the passages that have entries."""
    starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]])) if len(passage) else np.empty(0, int)
    if not len(starts):
        return np.empty(0, dtype=np.int64), np.empty((0, matrix.shape[1]), dtype=np.float32)
    return passage[starts], sums_of_rows(starts, term, value, matrix)


def pieces(passage: np.ndarray, entries: int = 1 << 15) -> Iterator[slice]:
    """Cut entries at passage bounds, about ``entries`` at a time."""
    at = 0
    while at < len(passage):
        end = min(at + entries, len(passage))
        while end < len(passage) and passage[end] == passage[end - 1]:
            end += 1
        yield slice(at, end)
        at = end


def test_matrix(size: int, width: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, width)).astype(np.float32)


def sketch(idf: np.ndarray, width: int):
    """Rows (per term) of the task's share of ``A'(A Omega)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega = test_matrix(len(idf), width)
        total = np.zeros((len(idf), width))
        for batch in batches:
            codes = [np.frombuffer(c, "<u4") for c in batch.column("codes").to_pylist()]
            p, t, c, doc, _ = passages(codes, len(idf), WINDOW)
            p, t, v = weighted(p, t, c, len(doc), idf)
            for cut in pieces(p):
                rows, product = project(p[cut], t[cut], v[cut], omega)
                order = np.argsort(t[cut], kind="stable")
                sorted_terms = t[cut][order]
                starts = np.flatnonzero(np.concatenate([[True], sorted_terms[1:] != sorted_terms[:-1]]))
                of_row = np.searchsorted(rows, p[cut][order])
                total[sorted_terms[starts]] += sums_of_rows(starts, of_row, v[cut][order], product)
        used = np.flatnonzero(total.any(axis=1))
        for cut in range(0, len(used), 512):
            part = used[cut:cut + 512]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)),
                 pa.array(list(total[part].astype(np.float32)), pa.list_(pa.float32()))], names=["term", "row"])
    return run


def _add(rows: "pa.Table") -> "pa.Table":
    values = np.stack(rows.column("row").to_numpy())
    return pa.table({"term": rows.column("term").slice(0, 1),
                     "row": pa.array([values.sum(axis=0)], pa.list_(pa.float32()))})


def item_rows(items: Items, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF rows of the items as (item, term, value)."""
    own = np.repeat(np.arange(len(items.codes)), [len(c) for c in items.codes])
    key, times = np.unique(own * items.size + np.concatenate(items.codes), return_counts=True)
    return weighted(key // items.size, key % items.size, times, len(items.codes), idf)


def item_sketch(items: Items, idf: np.ndarray, width: int) -> np.ndarray:
    """The items' share of ``A'(A Omega)``, before their weight."""
    i, t, v = item_rows(items, idf)
    out = np.zeros((items.size, width))
    rows, product = project(i, t, v, test_matrix(items.size, width))
    np.add.at(out, t, product[np.searchsorted(rows, i)] * v[:, None])
    return out


def latent_basis(sketched: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors of the passages from the sketch ``Y = A'A Omega``
    (Nystrom: ``A'A ~ Y (Omega'Y)^-1 Y'``), strongest first."""
    omega = test_matrix(*sketched.shape).astype(np.float64)
    y = sketched.astype(np.float64)
    shift = 1e-6 * np.linalg.norm(y)
    y = y + shift * omega
    core = omega.T @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > values.max() * 1e-10
    factor = y @ (vectors[:, good] / np.sqrt(values[good]))
    left, strength, _ = np.linalg.svd(factor, full_matrices=False)
    keep = strength ** 2 > shift * 2
    return left[:, keep][:, :rank].astype(np.float32)


# ------------------------------------------------------------------ the check

def lcs(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    masks: dict[int, int] = {}
    for i, t in enumerate(item.tolist()):
        masks[t] = masks.get(t, 0) | (1 << i)
    row = full = (1 << len(item)) - 1
    for t in text.tolist():
        hit = row & masks.get(t, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def best_stretch(item: np.ndarray, members: np.ndarray, rare: np.ndarray, text: np.ndarray, low: int, high: int,
                 enough: int, rare_enough: int) -> tuple[int, int]:
    """(longest common subsequence, first word) over stretches of the text
    that begin between ``low`` and ``high`` and are STRETCH items long.
    ``members`` marks the item's terms, ``rare`` those with weight: without
    ``rare_enough`` of these in reach, or ``enough`` of those in a stretch, no
    subsequence is long enough, and the stretch is passed over."""
    span = int(np.ceil(len(item) * STRETCH))
    step = max(1, len(item) // 8)
    low = max(0, low)
    if np.count_nonzero(rare[text[low:high + span]]) < rare_enough:
        return 0, 0
    hits = np.concatenate([[0], np.cumsum(members[text[low:high + span]])])
    begins = np.arange(0, max(1, min(high, len(text) - 1) - low + 1), step)
    within = hits[np.minimum(begins + span, len(hits) - 1)] - hits[np.minimum(begins, len(hits) - 1)]
    best = (0, 0)
    for k in np.flatnonzero(within >= enough).tolist():
        if within[k] > best[0]:
            begin = low + int(begins[k])
            length = lcs(item, text[begin:begin + span])
            if length > best[0]:
                best = (length, begin)
    return best


class Anchors:
    """The rarest words of the asked items, and where texts hold enough of them.

    A subsequence of ``enough`` of an item's words misses ``len - enough`` of
    them, so of any ``len - enough + k`` words it holds k. The rarest words are
    taken (all with weight, more where these are few), which keeps the places
    few; no place the check could accept is missed."""

    def __init__(self, items: Items, idf: np.ndarray, total: np.ndarray, enough: list[int], asked: np.ndarray):
        pairs, need = [], []
        for i, (own, least) in enumerate(zip(items.codes, enough, strict=True)):
            missed = len(own) - least
            size = min(len(own), max(int(np.count_nonzero(idf[own] > 0)),
                                     missed + max(2, len(own) // ANCHOR_SHARE)))
            rarest = own[np.argsort(total[own], kind="stable")[:size]]
            need.append(size - missed)
            if asked[i]:
                pairs += [(t, i) for t in set(rarest.tolist())]
        term, self.item = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2).T
        self.count = np.bincount(term, minlength=items.size)
        self.first = np.cumsum(self.count) - self.count
        self.need = np.array(need, dtype=np.int64)
        self.span = np.array([int(np.ceil(len(c) * STRETCH)) for c in items.codes], dtype=np.int64)

    def places(self, codes: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, first, last) word of the neighbouring places of an item."""
        lengths = np.array([len(c) for c in codes], dtype=np.int64)
        ends = np.cumsum(lengths)
        flat = np.concatenate(codes) if codes else np.empty(0, dtype=np.int64)
        at = np.flatnonzero(self.count[flat])
        times = self.count[flat[at]]
        nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        item = self.item[np.repeat(self.first[flat[at]], times) + nth]
        key = np.sort(item * max(len(flat), 1) + np.repeat(at, times))
        item, at = key // max(len(flat), 1), key % max(len(flat), 1)
        until = np.arange(len(key)) + self.need[item] - 1
        inside = until < len(key)
        item_to, at_to = item[until[inside]], at[until[inside]]
        item, at = item[inside], at[inside]
        doc = np.searchsorted(ends, at, side="right")
        hit = (item == item_to) & (at_to - at < self.span[item]) & (at_to < ends[doc])
        item, at, doc = item[hit], at[hit], doc[hit]
        if not len(at):
            return
        starts = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])
                                                | (at[1:] - at[:-1] > self.span[item[1:]])]))
        lasts = np.append(starts[1:], len(at)) - 1
        base = (ends - lengths)[doc[starts]]
        yield from zip(doc[starts].tolist(), item[starts].tolist(), (at[starts] - base).tolist(),
                       (at[lasts] - base).tolist(), strict=True)


def outside_space(items: Items, total: np.ndarray, idf: np.ndarray, basis: np.ndarray, least: float) -> np.ndarray:
    """Items the latent space cannot vouch for: those with fewer than
    ``FEW_TERMS`` terms of weight, and those that keep less than ``least`` of
    their length in it or without the terms that no passage has."""
    item, term, value = item_rows(items, idf)
    rows, latent = project(item, term, value, basis)
    kept = np.zeros(len(items.ids))
    kept[rows] = np.linalg.norm(latent, axis=1)
    seen = total[term] > 0
    kept = np.minimum(kept, np.sqrt(np.bincount(item[seen], weights=value[seen] ** 2, minlength=len(items.ids))))
    few = np.array([len({t for t in own.tolist() if idf[t] > 0}) < FEW_TERMS for own in items.codes])
    return few | (kept < least)


def search(items: Items, total: np.ndarray, idf: np.ndarray, basis: np.ndarray, cosine: float, share: float,
           held: float):
    """Links of documents and items: candidates by cosine, for the items the
    space cannot vouch for by anchors as well, checked by words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_items = len(items.ids)
        own = np.concatenate([np.full(len(c), i) for i, c in enumerate(items.codes)])
        rows, latent = project(*item_rows(items, idf), basis)
        queries = np.zeros((n_items, basis.shape[1]), dtype=np.float32)
        queries[rows] = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
        members = np.zeros((n_items, items.size), dtype=bool)
        members[own, np.concatenate(items.codes)] = True
        rare = members & (idf > 0)
        # A subsequence of ``enough`` words misses len - enough words of the item.
        enough = [int(np.ceil(share * len(c))) for c in items.codes]
        rare_enough = [int(np.count_nonzero(idf[c] > 0)) - len(c) + e for c, e in zip(items.codes, enough, strict=True)]
        anchors = Anchors(items, idf, total, enough, outside_space(items, total, idf, basis, held))
        for batch in batches:
            codes = [np.frombuffer(c, "<u4").astype(np.int64) for c in batch.column("codes").to_pylist()]
            p, t, c, doc, begin = passages(codes, items.size, STRIDE)
            p, t, v = weighted(p, t, c, len(doc), idf)
            found: dict[tuple[int, int], tuple[int, float]] = {}

            def checked(doc_no: int, item_no: int, low: int, high: int) -> tuple[int, int] | None:
                """(longest common subsequence, first word), if the check accepts it and it beats what is found."""
                item, known = items.codes[item_no], found.get((doc_no, item_no), (0, 0))[0]
                if known == len(item):
                    return None
                length, place = best_stretch(item, members[item_no], rare[item_no], codes[doc_no], low, high,
                                             enough[item_no], rare_enough[item_no])
                if length < enough[item_no] or length <= known:
                    return None
                answer = items.answers[item_no]
                around = codes[doc_no][max(0, place - len(item)):place + 3 * len(item)]
                if len(answer) and lcs(answer, around) < np.ceil(0.8 * len(answer)):
                    return None
                return length, place

            for cut in pieces(p):
                rows, latent = project(p[cut], t[cut], v[cut], basis)
                norm = np.linalg.norm(latent, axis=1, keepdims=True)
                cosines = (latent / np.maximum(norm, 1e-12)) @ queries.T
                r, i = np.nonzero(cosines >= cosine)
                if not len(r):
                    continue
                order = np.lexsort((r, i))
                r, i = r[order], i[order]
                d, at = doc[rows[r]], begin[rows[r]]
                # Neighbouring passages of a document are one place to look at.
                starts = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (d[1:] != d[:-1])
                                                        | (at[1:] - at[:-1] > WINDOW)]))
                lasts = np.append(starts[1:], len(r)) - 1
                peaks = np.maximum.reduceat(cosines[r, i], starts)
                for doc_no, item_no, low, high, peak in zip(d[starts].tolist(), i[starts].tolist(), at[starts].tolist(),
                                                            at[lasts].tolist(), peaks.tolist(), strict=True):
                    better = checked(doc_no, item_no, low - len(items.codes[item_no]), high + WINDOW)
                    if better:
                        found[(doc_no, item_no)] = (better[0], peak)
            for doc_no, item_no, low, high in anchors.places(codes):
                better = checked(doc_no, item_no, low - int(anchors.span[item_no]), high)
                if better:
                    # The passages around the place; those without weight have no direction, cosine 0.
                    of_doc = np.searchsorted(doc, [doc_no, doc_no + 1])
                    near = of_doc[0] + np.searchsorted(begin[of_doc[0]:of_doc[1]],
                                                       [better[1] - WINDOW, better[1] + len(items.codes[item_no])])
                    cut = slice(*np.searchsorted(p, near))
                    _, latent = project(p[cut], t[cut], v[cut], basis)
                    norm = np.linalg.norm(latent, axis=1)
                    cosines = latent @ queries[item_no] / np.maximum(norm, 1e-12)
                    found[(doc_no, item_no)] = (better[0], float(cosines.max(initial=0.0)))
            doc_ids = batch.column("doc_id").to_pylist()
            links = [(doc_ids[d], items.ids[i], cos, length, len(items.codes[i]))
                     for (d, i), (length, cos) in sorted(found.items())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(
                    zip(*links, strict=True) if links else [[]] * 5,
                    (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "item_id", "cosine", "lcs_words", "item_words"])
    return run


LINKS = "doc_id long, item_id long, cosine double, lcs_words long, item_words long"


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, share: float = LCS_SHARE,
                 held: float = HELD, rank: int = RANK, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, cosine of the
    candidate passage, lcs_words, item_words."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).filter(
        "item_id IS NOT NULL AND text IS NOT NULL").groupBy("item_id", "text").count().drop("count")
    n_items = asked.count()
    blocks = -(-n_items // BLOCK_ITEMS)
    out = spark.createDataFrame([], LINKS)
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        items = read_items([(r["item_id"], r["text"]) for r in sorted(rows)])
        if not items.ids:
            continue
        table = staged(source.mapInArrow(coded(items.vocabulary), "doc_id long, codes binary"), "codes")
        counts = (table.select("codes").mapInArrow(frequencies(items.size), "term int, n long")
                  .groupBy("term").agg(F.sum("n").alias("n")).toPandas())
        total = np.zeros(items.size, dtype=np.int64)
        total[counts["term"].to_numpy()] = counts["n"].to_numpy()
        idf = term_weights(items, total)
        width = min(rank + OVERSAMPLE, items.size)
        rows = (table.select("codes").mapInArrow(sketch(idf, width), "term int, row array<float>")
                .groupBy("term").applyInArrow(_add, "term int, row array<float>").toArrow())
        y = np.zeros((items.size, width), dtype=np.float32)
        if rows.num_rows:
            y[rows.column("term").to_numpy()] = np.stack(rows.column("row").to_numpy())
        # No more than ``rank`` directions of the passages are stronger than a share of 1 / rank of them.
        y += (max(int(total[0]), 1) / rank * item_sketch(items, idf, width)).astype(np.float32)
        basis = latent_basis(y, rank)
        out = out.unionByName(table.mapInArrow(search(items, total, idf, basis, cosine, share, held), LINKS))
    return out


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns unchanged."""
    found = contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("held_id")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("own_id"))
    return rows.join(found, F.col("own_id").eqNullSafe(F.col("held_id")), "left_anti").select("row.*")


def op4_decontaminate(spark, sf_dir):
    return contaminated(relation(spark, sf_dir, "documents"), relation(spark, sf_dir, "benchmark"))


QUERIES = {"op4_decontaminate": op4_decontaminate}
ORACLE = {}
