"""MinHash near-dedup with DartMinHash signatures.

A text is the bag of its five-word shingles (a shorter text is one shingle),
weighted 1 each, or by count. Elements own the strip ``[0, weight)`` of a
weight axis; darts are thrown at the plane (weight, rank) by hashing, with
Poisson counts per unit of weight and dyadic interval of rank, so every
document that has an element sees the same darts in its strip. A dart hashes
to one of ``k`` coordinates; the signature keeps the earliest rank of each.
Two documents agree in a coordinate with the probability of their (weighted)
Jaccard similarity. Only ranks up to about ``(ln k + 2) k / total weight``
are thrown, so a document costs its elements and some ``k ln k`` darts.

Banded joining: equal bands of ``rows`` coordinates make a bucket. Links are
texts of similarity ``threshold`` or more, checked on the sets of shingles;
classes are the connected documents.

Flow at scale:

* texts are hashed where they are read; equal texts (equal digests) become
  one representative before anything is joined, with a map-side combine, so
  copies in any number cost one narrow row each;
* members of a bucket are checked against the bucket's hub, not with each
  other: a star per bucket, and a pair that shares many buckets is checked
  once. The hub is the member that meets most other texts;
* buckets that then still hold several classes are gone over once more: two
  members of different classes are compared if an upper bound, from what each
  has in common with the hub, lets them reach the threshold. No cap on
  partners exists, and no pair within a class is formed;
* classes come from alternating star contraction over the links, with a
  written table per round.

Defined results: NULL and empty texts have no shingle; they are equal to each
other and form one class. Rows with one doc_id and different texts keep a row
each. A class's id is its smallest doc_id (a NULL doc_id comes last). An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimledger.llm.common import hash_strings, mix64, relation, slices, staged, words_csr

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 26, 5      # a pair of similarity 0.8 shares no band with probability 3e-5
FIRST_RANK = 1.0 / 64    # the first interval of ranks; the others double
LONGEST = 32.0           # up to this length
SLICE_ROWS = 512         # texts whose darts are thrown together: some 70 kB each
CROWD = 256              # members of a bucket from which its pairs are dealt to several tasks
U64 = np.uint64


# ------------------------------------------------------------------ elements

def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a batch: ``(offsets, elements, counts)``, elements
    sorted within a text. A text of 1 to ``size - 1`` words is one shingle."""
    offsets, codes, distinct = words_csr(texts)
    n = len(offsets) - 1
    hashed = hash_strings(distinct)[codes] if len(codes) else np.empty(0, dtype=U64)
    words = np.diff(offsets)
    value = np.zeros(len(codes), dtype=U64)
    for k in range(size):                       # order matters: a polynomial, mixed at the end
        shifted = np.zeros(len(codes), dtype=U64)
        if k < len(codes):
            shifted[:len(codes) - k] = hashed[k:]
        value = value * U64(0x9E3779B97F4A7C15) + shifted
    value = mix64(value)
    owner = np.repeat(np.arange(n), words)
    place = np.arange(len(codes)) - np.repeat(offsets[:-1], words)
    keep = place + size <= np.repeat(words, words)
    short = np.flatnonzero((words > 0) & (words < size))
    few = [mix64(np.array([_fold(hashed[offsets[i]:offsets[i + 1]])], dtype=U64))[0] for i in short]
    owner = np.concatenate([owner[keep], short])
    value = np.concatenate([value[keep], np.array(few, dtype=U64)])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    if not len(value):
        return np.zeros(n + 1, dtype=np.int64), value, np.empty(0, dtype=np.int64)
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])])
    starts = np.flatnonzero(new)
    counts = np.diff(np.concatenate([starts, [len(value)]]))
    out = np.concatenate([[0], np.cumsum(np.bincount(owner[starts], minlength=n))])
    return out.astype(np.int64), value[starts], counts


def _fold(values: np.ndarray) -> int:
    out = len(values)
    for v in values.tolist():
        out = (out * 0x9E3779B97F4A7C15 + v) & 0xFFFFFFFFFFFFFFFF
    return out


# ------------------------------------------------------------------ darts

def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> U64(11)).astype(np.float64) * (1.0 / (1 << 53))


def _poisson(u: np.ndarray, mean: float) -> np.ndarray:
    """Poisson counts by inversion of uniform numbers."""
    p = term = np.exp(-mean)
    count = np.zeros(len(u), dtype=np.int64)
    above = np.flatnonzero(u >= p)
    k = 0
    while len(above) and (term > 0 or k < mean):     # beyond that the sum is 1 to the last bit
        count[above] += 1
        k += 1
        term *= mean / k
        p += term
        above = above[u[above] >= p]
    return count


def _throw(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, begin: np.ndarray, limit: np.ndarray, k: int,
           best: np.ndarray) -> None:
    """Throw all darts of the intervals of ranks that start at ``begin`` or
    later and below the limit of their document; ``best`` (documents x k,
    flat) keeps the earliest rank per coordinate."""
    # Unit cells of the weight axis; the last one may be cut.
    cells = np.ceil(weight).astype(np.int64)
    if len(cells) and cells.max() > 1:
        index = np.repeat(np.arange(len(cells)), cells)
        cell = np.arange(len(index)) - np.repeat(np.cumsum(cells) - cells, cells)
        owner, element, begin, limit = owner[index], element[index], begin[index], limit[index]
        room = weight[index] - cell
        element = mix64(element + (cell.astype(U64) + U64(1)) * U64(0xD1B54A32D192ED03))
    else:
        room = weight
        element = mix64(element + U64(0xD1B54A32D192ED03))
    low, high, interval = 0.0, FIRST_RANK, 0
    while len(element):
        now = np.flatnonzero(begin <= low)
        seed = mix64(element[now] ^ mix64(np.array([interval + 1], dtype=U64))[0])
        count = _poisson(_uniform(seed), high - low)
        total = int(count.sum())
        if total:
            of = np.repeat(np.arange(len(count)), count)
            nth = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
            dart = mix64(seed[of] + (nth.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15))
            rank = low + (high - low) * _uniform(dart)
            second = mix64(dart ^ U64(0xA0761D6478BD642F))
            of = now[of]
            inside = _uniform(second) < room[of]
            coordinate = ((mix64(second) >> U64(32)) * U64(k)) >> U64(32)
            slot = owner[of] * k + coordinate.astype(np.int64)
            np.minimum.at(best, slot[inside], rank[inside])
        low, high, interval = high, high + min(high, LONGEST), interval + 1
        more = limit > low
        owner, element, room, begin, limit = owner[more], element[more], room[more], begin[more], limit[more]


def dart_minhash(offsets: np.ndarray, elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Signatures (documents x k) of weighted sets; rows of empty sets are inf.

    A document whose darts leave a coordinate empty goes on to twice the rank,
    until none is empty; ranks are fixed points, so the earliest dart of a
    coordinate does not depend on how far a document had to throw.
    """
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    total = np.bincount(owner, weights=weights, minlength=n)
    best = np.full((n, k), np.inf)
    limit = np.divide(k * (np.log(k) + 2.0), total, out=np.zeros(n), where=total > 0)
    begin = np.zeros(n)
    todo = np.flatnonzero(sizes)
    while len(todo):
        mine = np.zeros(n, dtype=bool)
        mine[todo] = True
        pick = mine[owner]
        _throw(owner[pick], elements[pick], weights[pick], begin[owner[pick]], limit[owner[pick]], k,
               best.reshape(-1))
        # A rank beyond the limit may not be the earliest: count it as missing.
        todo = todo[(best[todo] > limit[todo, None]).any(axis=1)]
        begin[todo] = limit[todo]
        limit[todo] *= 2
    return best


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; documents without elements get none (0)."""
    bits = signatures.view(U64).reshape(len(signatures), bands, rows)
    keys = np.zeros((len(signatures), bands), dtype=U64)
    for r in range(rows):
        keys = mix64(keys * U64(0x9E3779B97F4A7C15) + bits[:, :, r] + U64(r + 1))
    return keys


def _signatures(weighted: bool, bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", max_rows=SLICE_ROWS):
            offsets, elements, counts = shingle_sets(batch.column("text"), size)
            weights = counts.astype(np.float64) if weighted else np.ones(len(counts))
            keys = band_keys(dart_minhash(offsets, elements, weights, bands * rows), bands, rows)
            owner = np.repeat(np.arange(len(keys)), np.diff(offsets))
            total = np.bincount(owner, weights=weights, minlength=len(keys))
            held = np.where(total > 0, bands, 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(total.astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32)),
                                          pa.array(keys[total > 0].view(np.int64).ravel()))],
                names=["doc_id", "digest", "total", "bands"])
    return run


def _elements(weighted: bool, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            offsets, elements, counts = shingle_sets(batch.column("text"), size)
            bounds = pa.array(offsets.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.ListArray.from_arrays(bounds, pa.array(elements.view(np.int64))),
                 pa.ListArray.from_arrays(bounds, pa.array(counts if weighted else np.ones_like(counts)))],
                names=["digest", "elements", "weights"])
    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight in common and weighted Jaccard similarity of pairs of element lists."""
    for batch in batches:
        a, wa, b, wb = (batch.column(c) for c in ("elements_a", "weights_a", "elements_b", "weights_b"))
        out, common = np.zeros(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64)
        for i in range(batch.num_rows):
            # Sorted as unsigned when made; order does not matter to the intersection.
            x, y = a[i].values.to_numpy(), b[i].values.to_numpy()
            _, at_x, at_y = np.intersect1d(x, y, assume_unique=True, return_indices=True)
            p, q = wa[i].values.to_numpy(), wb[i].values.to_numpy()
            common[i] = np.minimum(p[at_x], q[at_y]).sum()
            out[i] = common[i] / max(p.sum() + q.sum() - common[i], 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(common), pa.array(out)],
            names=["a", "b", "common", "similarity"])


# ------------------------------------------------------------------ classes

def connected_classes(links: DataFrame, vertices: DataFrame) -> DataFrame:
    """(vertex, class) for (a, b) links: the smallest vertex of each component.

    Alternating large and small stars; every round is written, and ends when
    a round changes nothing. Rounds grow with the logarithm of the longest
    chain.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .filter("u <> v").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("x"), F.least("u", "m").alias("m"))
        # Large star: every larger neighbour of a vertex hangs on the vertex's minimum.
        large = staged(both.filter("v > u").join(low, F.col("u") == F.col("x"))
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "large")
        # Small star: every smaller neighbour and the vertex itself hang on the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        small = staged(large.join(least, F.col("u") == F.col("x"))
                       .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                 F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                       .select("e.u", "e.v").filter("u <> v").distinct(), "small")
        changed = small.exceptAll(edges).limit(1).count() + edges.exceptAll(small).limit(1).count()
        edges = small
        if not changed:
            break
    return vertices.join(edges, F.col("vertex") == F.col("u"), "left").select(
        "vertex", F.coalesce("v", "vertex").alias("class"))


# ------------------------------------------------------------------ the join

def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) pairs with the weight their sets have in common and their similarity."""
    left, right = (sets.select(F.col("digest").alias(x), F.col("elements").alias(f"elements_{x}"),
                               F.col("weights").alias(f"weights_{x}")) for x in ("a", "b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(
        _compare, "a binary, b binary, common long, similarity double")


def _upper_bound() -> Column:
    """No two members of a bucket (columns of the one, and ``other_`` ones) are
    more similar than this.

    What they share lies in the hub or outside it. In the hub it is at most
    the smaller of what each shares with the hub; outside at most the smaller
    of what each has there that any other text has as well.
    """
    inside = F.least("common", "other_common")
    outside = F.least("outside", "other_outside")
    most = F.least(inside + outside, "total", "other_total")
    return most / F.greatest(F.col("total") + F.col("other_total") - most, F.lit(1))


def near_duplicates(docs: DataFrame, weighted: bool = False, threshold: float = THRESHOLD,
                    bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, digest of the text, class_id (smallest
    doc_id of the class), class_texts (different texts in it), is_first (the
    one row of the class to keep)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.when(F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), text).otherwise("").alias("text")
                         ).withColumn("digest", F.unhex(F.md5("text")))
    signed = staged(source.select("doc_id", "digest", "text").mapInArrow(
        _signatures(weighted, bands, rows, size),
        "doc_id long, digest binary, total long, bands array<bigint>"), "signatures")
    # Equal texts are one vertex, whatever their number.
    texts = staged(signed.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("total").alias("total"), F.first("bands").alias("bands")), "texts")
    vertices = texts.select(F.col("digest").alias("vertex"))

    # Buckets of several texts. A bucket's hub is its member that meets most
    # other texts over all its buckets: in a family of copies, the original.
    keyed = staged(texts.select("digest", "total", F.explode("bands").alias("bucket")), "keyed")
    crowded = keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    met = staged(keyed.join(crowded, "bucket"), "met")
    central = met.groupBy("digest").agg(F.sum("n").alias("meets"))
    rated = staged(met.join(central, "digest"), "rated")
    hubs = rated.groupBy("bucket").agg(F.max_by(F.struct("digest", "total"), F.struct("meets", "digest")).alias("hub"))
    members = staged(rated.join(hubs, "bucket").select(
        "bucket", "n", "digest", "total", F.col("hub.digest").alias("hub"), F.col("hub.total").alias("hub_total")),
        "members")

    # Sets of the texts that share a bucket; one row of each such text is read.
    wanted = members.select("digest").distinct().join(texts.select("digest", "doc_id"), "digest").select(
        F.col("digest").alias("of_digest"), F.col("doc_id").alias("of_doc"))
    chosen = source.join(wanted, (F.col("digest") == F.col("of_digest"))
                         & F.col("doc_id").eqNullSafe(F.col("of_doc")), "left_semi")
    once = chosen.groupBy("doc_id", "digest").agg(F.first("text").alias("text")).select("digest", "text")
    sets = staged(once.mapInArrow(_elements(weighted, size),
                                  "digest binary, elements array<bigint>, weights array<bigint>"), "sets")

    # Round 1: every member against its bucket's hub.
    stars = members.filter("digest <> hub").filter(
        F.least("total", "hub_total") >= F.lit(threshold) * F.greatest("total", "hub_total"))
    spokes = staged(_compared(stars.select(F.col("hub").alias("a"), F.col("digest").alias("b")).distinct(), sets),
                    "spokes")
    links = spokes.filter(F.col("similarity") >= threshold).select("a", "b")
    classes = staged(connected_classes(links, vertices), "classes_1")

    # Round 2: buckets of three and more that still hold different classes,
    # members of different classes, and only pairs that can reach the
    # threshold by what each has in common with the hub. ``alone`` is the
    # weight of elements that no other text of these buckets has.
    mixed = staged(_mixed(members.filter("n > 2"), classes), "mixed")
    loose = mixed.select("digest").distinct()
    exploded = (sets.join(loose, "digest", "left_semi")
                .select("digest", F.explode(F.arrays_zip("elements", "weights")).alias("e"))
                .select("digest", "e.elements", "e.weights"))
    alone = (exploded.groupBy("elements").agg(F.count("*").alias("sets"), F.min("digest").alias("digest"),
                                              F.sum("weights").alias("weight"))
             .filter("sets = 1").groupBy("digest").agg(F.sum("weight").alias("alone")))
    known = spokes.select(F.col("a").alias("hub"), F.col("b").alias("digest"), "common")
    spread = staged(
        mixed.filter("digest <> hub").join(alone, "digest", "left").join(known, ["hub", "digest"], "left")
        .withColumn("shared", F.col("total") - F.coalesce("alone", F.lit(0)))
        # Too different in size for a comparison: what they have in common is not known.
        .withColumn("outside", F.col("shared") - F.coalesce("common", F.lit(0)))
        .withColumn("common", F.coalesce("common", F.least("shared", "hub_total")))
        .withColumn("parts", F.ceil(F.col("n") / CROWD).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))
        .select("bucket", "digest", "class", "total", "common", "outside", "part", "parts"), "spread")
    # Pairs of a crowded bucket are dealt to parts x parts tasks: of a task's
    # two sides each holds about CROWD members.
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    left = spread.withColumn("other_part", F.explode(every)).drop("parts")
    other = spread.withColumn("mine", F.explode(every)).select(
        "bucket", F.col("mine").alias("part"), F.col("part").alias("other_part"),
        *[F.col(c).alias(f"other_{c}") for c in ("digest", "class", "total", "common", "outside")])
    across = left.join(other, ["bucket", "part", "other_part"]).filter(
        (F.col("digest") < F.col("other_digest")) & (F.col("class") != F.col("other_class"))
        & (_upper_bound() >= threshold))
    rest = _compared(across.select(F.col("digest").alias("a"), F.col("other_digest").alias("b")).distinct(), sets)
    more = staged(rest.filter(F.col("similarity") >= threshold).select("a", "b"), "links_2")
    classes = connected_classes(links.unionByName(more), vertices)

    named = staged(texts.select("digest", "doc_id").join(classes.withColumnRenamed("vertex", "digest"), "digest"),
                   "named")
    ids = named.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_texts"),
                                     F.min_by("digest", F.struct(F.coalesce("doc_id", F.lit(2 ** 63 - 1)), "digest"))
                                     .alias("first_digest"))
    of_text = staged(named.join(ids, "class").select(F.col("digest").alias("of_digest"), "class_id", "class_texts",
                                                     "first_digest"), "of_text")
    out = signed.select("doc_id", "digest").join(of_text, F.col("digest") == F.col("of_digest"))
    return out.select("doc_id", F.lower(F.hex("digest")).alias("digest"), "class_id", "class_texts",
                      ((F.col("digest") == F.col("first_digest")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
                      .alias("is_first"))


def _mixed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members, with their classes, of the buckets that hold several classes."""
    with_class = members.join(classes.withColumnRenamed("vertex", "digest"), "digest")
    several = with_class.groupBy("bucket").agg(F.min("class").alias("c1"), F.max("class").alias("c2")).filter(
        "c1 <> c2").select("bucket")
    return with_class.join(several, "bucket", "left_semi")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without near copies: one document of each class,
    that of the smallest doc_id, stays with its columns unchanged. Of repeated
    rows (equal doc_id and text) one stays."""
    found = near_duplicates(docs, **options).filter("is_first").select(
        F.col("doc_id").alias("first_id"), F.col("digest").alias("first_digest")).distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    word = F.when(F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), text).otherwise("")
    tagged = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("own_id"),
                         F.md5(word).alias("own_digest"))
    kept = tagged.join(found, F.col("own_id").eqNullSafe(F.col("first_id"))
                       & (F.col("own_digest") == F.col("first_digest")), "left_semi")
    once = kept.groupBy("own_id", "own_digest").agg(F.first("row").alias("row"))
    return once.select("row.*")


def op1_near_dedup(spark, sf_dir):
    return near_duplicates(relation(spark, sf_dir, "documents"))


QUERIES = {"op1_near_dedup": op1_near_dedup}
ORACLE = {}
