"""Operators that SQL cannot express, against brute force, exact round trips
and held-out rows."""

import collections
import hashlib
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOCS, SMALL, documents, nasty_texts

from dimledger.llm import decontaminate, html_layout, huffman, minhash, pii, toxicity
from dimledger.llm.common import words_csr

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACES.split(text or "") if w]


def test_words_csr_follows_the_word_rule():
    texts = ["", None, "  a  b c \x0b d\x1ce ", "\n\t", "x"]
    offsets, codes, distinct = words_csr(pa.array(texts))
    got = [[distinct[int(c)].as_py() for c in codes[offsets[i]:offsets[i + 1]]] for i in range(len(texts))]
    assert got == [words(t) for t in texts]


# ------------------------------------------------------------------ near copies

def shingles(text):
    w = words(text)
    grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)] or ([tuple(w)] if w else [])
    return collections.Counter(grams)


def brute_classes(rows, threshold=0.8, weighted=True):
    """Class (smallest id) of each row by all pairs that share a shingle."""
    bags = [shingles(t) for _, t in rows]
    if not weighted:
        bags = [collections.Counter(set(b)) for b in bags]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = collections.defaultdict(list)
    for i, bag in enumerate(bags):
        for g in bag or {()}:
            inverted[g].append(i)
    overlap = collections.Counter()
    for g, hit in inverted.items():
        for k, b in enumerate(hit):
            for a in hit[:k]:
                overlap[a, b] += min(bags[a][g], bags[b][g])
    for (a, b), n in overlap.items():
        union = bags[a].total() + bags[b].total() - n
        if not bags[a] and not bags[b] or n / max(union, 1) >= threshold:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    ids = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[root(i)].append(doc_id)
    return [min((d for d in ids[root(i)] if d is not None), default=None) for i in range(len(rows))]


def family(size=60):
    """Copies of one text with ever more words replaced, which link in chains."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    out = []
    for k in range(size):
        copy = list(base)
        for at in rng.choice(120, k // 8, replace=False):
            copy[at] = f"r{k}x{at}"
        out.append((1000 + k, " ".join(copy)))
    return out


@pytest.mark.parametrize("weighted", [True, False])
def test_near_duplicates_match_brute_force(spark, weighted, monkeypatch):
    monkeypatch.setattr(minhash, "CROWD", 8)          # the family's buckets are dealt to several tasks
    small = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in small.collect()] + family() + [(5000 + i, t) for i, (_, t) in enumerate(nasty_texts())]
    rows += [(None, "an id that is missing in this table here"), (7000, "one two three four")]
    # Same set of shingles, other counts: alike only without weights.
    rows += [(7100, " ".join(["of"] * 30)), (7101, " ".join(["of"] * 300))]
    got = minhash.near_duplicates(documents(spark, rows), weighted=weighted).collect()
    assert len(got) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1]))
    want = sorted(((d, c) for (d, _), c in zip(rows, brute_classes(rows, weighted=weighted), strict=True)), key=key)
    assert sorted(((r.doc_id, r.class_id) for r in got), key=key) == want
    assert (dict((r.doc_id, r.class_id) for r in got)[7101] == 7100) != weighted


def test_counts_of_darts_are_not_cut():
    rng = np.random.default_rng(8)
    for mean in (0.02, 1.0, 32.0):
        counts = minhash._poisson(rng.random(200_000), mean)
        assert abs(counts.mean() - mean) < 0.02 * mean + 0.002 and abs(counts.var() - mean) < 0.03 * mean + 0.002
    assert minhash._poisson(np.array([1 - 2.0 ** -53]), 32.0)[0] > 60


def test_short_texts_throw_a_bounded_number_of_darts_at_once(monkeypatch):
    largest = 0
    plain = minhash._throw

    def watched(owner, element, weight, begin, limit, k, best):
        nonlocal largest
        largest = max(largest, len(best) // k)
        plain(owner, element, weight, begin, limit, k, best)

    monkeypatch.setattr(minhash, "_throw", watched)
    text = pa.array([f"few words of a text {i}" for i in range(3000)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), text, pa.array([b"d"] * 3000)],
                                       names=["doc_id", "text", "digest"])
    made = list(minhash._signatures(True, 26, 5, 5)(iter([batch])))
    assert sum(b.num_rows for b in made) == 3000 and largest <= minhash.SLICE_ROWS


def test_keep_one_of_each_class(spark):
    rows = [(3, "a b c d e f g h"), (1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "other words stand here now"),
            (None, "lonely text without id at all"), (9, None), (8, "")]
    docs = documents(spark, rows)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        [(1, "a b c d e f g h"), (2, "other words stand here now"), (0, "lonely text without id at all"), (8, "")])
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    elements = rng.integers(1, 2 ** 63, 400).astype(np.uint64)
    a, b = rng.integers(1, 6, 400).astype(float), rng.integers(1, 6, 400).astype(float)
    a[:50] = 0.25
    pick = np.arange(400) < 300, np.arange(400) >= 60
    offsets = np.array([0, 300, 640])
    sig = minhash.dart_minhash(offsets, np.concatenate([elements[pick[0]], elements[pick[1]]]),
                               np.concatenate([a[pick[0]], b[pick[1]]]), 4096)
    x, y = np.where(pick[0], a, 0), np.where(pick[1], b, 0)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum()) < 0.03
    assert np.isfinite(sig).all()
    # The signature of a text does not depend on the batch it is in.
    alone = minhash.dart_minhash(offsets[:2], elements[pick[0]], a[pick[0]], 4096)
    assert (alone[0] == sig[0]).all()


def test_connected_classes_of_a_chain(spark):
    pairs = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(40) if i != 20], "a string, b string")
    points = spark.createDataFrame([(f"{i:03}",) for i in range(43)], "vertex string")
    got = dict(minhash.connected_classes(pairs, points).collect())
    assert got == {f"{i:03}": "000" if i <= 20 else "021" if i <= 40 else f"{i:03}" for i in range(43)}


# ------------------------------------------------------------------ decontamination

def test_lcs():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0] + [0] * len(b) if not row else row
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
        return row[-1]

    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.integers(1, 5, rng.integers(1, 40)), rng.integers(0, 5, rng.integers(0, 60))
        assert decontaminate.lcs(a, b) == plain(a.tolist(), b.tolist())


def test_sums_of_rows_of_groups_of_any_length():
    rng = np.random.default_rng(4)
    sizes = np.array([1, 3, 64, 65, 2, 700, 1, 128])
    starts = np.cumsum(sizes) - sizes
    row, value = rng.integers(0, 50, sizes.sum()), rng.standard_normal(sizes.sum()).astype(np.float32)
    matrix = rng.standard_normal((50, 7)).astype(np.float32)
    got = decontaminate.sums_of_rows(starts, row, value, matrix)
    want = [(matrix[row[a:a + n]].astype(float) * value[a:a + n, None]).sum(axis=0) for a, n in zip(starts, sizes)]
    assert np.allclose(got, want, atol=1e-3)
    for few in (starts[:0], starts[:1]):
        assert decontaminate.sums_of_rows(few, row[:len(few)], value[:len(few)], matrix).shape == (len(few), 7)


def test_finds_exact_and_paraphrased_items(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [tuple(r) for r in bench.collect()]
    texts = [tuple(r) for r in docs.collect()]
    plain = texts[0][1].split()
    planted = []
    for i, text in items[:10]:
        w = [f"zz{x}" if k % 6 == 3 else x for k, x in enumerate(text.split())]
        planted.append((90_000 + i, " ".join(plain[:70] + w + plain[70:140])))
    rows = texts + planted + [(80_000, None), (80_001, ""), (80_002, items[0][1].upper() + "!"), (80_003, "the of")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents(spark, rows), bench).collect()}
    exact = {(d, i) for d, t in texts for i, q in items if q in (t or "")}
    assert exact <= got
    assert (80_002, items[0][0]) in got
    assert len([1 for i, _ in items[:10] if (90_000 + i, i) in got]) >= 9
    own = {d for d, _ in texts}
    assert {p for p in got if p[0] in own} == exact


def test_answer_must_be_there(spark):
    question = " ".join(f"q{i}" for i in range(30))
    bench = spark.createDataFrame([(1, f"{question}\nAnswer: forty two exactly"), (2, None), (3, "")],
                                  "item_id long, text string")
    docs = documents(spark, [(1, f"x y z {question} forty two exactly and more"), (2, f"x y z {question} no idea"),
                             (3, "nothing of it"), (None, f"{question} forty two exactly")])
    got = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 1), (1, 1)]
    kept = decontaminate.without_benchmark(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    empty = spark.createDataFrame([], DOCS)
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_candidates_come_from_the_latent_space(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    texts = [tuple(r) for r in docs.collect()]
    rng = np.random.default_rng(3)
    long_text = max((t for _, t in texts if t), key=len).split()
    for k, (item, text) in enumerate(tuple(r) for r in bench.collect()):
        w = text.split()
        changed = list(w)
        for at in rng.choice(len(w), len(w) // 5, replace=False):
            changed[at] = f"zz{at}"
        at = 90 * (k % 20)
        texts += [(100_000 + item, " ".join(long_text[at:at + 60] + w + long_text[at + 60:at + 90])),
                  (200_000 + item, " ".join(long_text[at:at + 60] + changed + long_text[at + 60:at + 90]))]
    docs = documents(spark, texts)

    def links(**options):
        return {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, **options).collect()}

    every = links(held=9.0)                  # anchors for all items pass every place the check could accept
    latent = links(held=-1.0)                # only items of few terms have anchors
    assert latent <= every and len(latent) >= 0.9 * len(every)
    for base in (100_000, 200_000):
        asked = {x for x in every if base <= x[0] < base + 100_000}
        assert len(asked) >= 0.9 * bench.count() and len(asked & latent) >= 0.9 * len(asked)
    assert len(links(cosine=2.0)) < 0.2 * len(every)      # without the space hardly anything is found


def test_decontamination_keeps_columns_of_any_name(spark):
    bench = spark.createDataFrame([(1, "what is the airspeed of an unladen swallow in flight")], "item_id long, text string")
    docs = documents(spark, [(1, "say: what is the airspeed of an unladen swallow in flight ok"), (2, "clean words only")])
    docs = docs.selectExpr("*", "7 AS held_id", "8 AS own_id", "9 AS item_id")
    kept = decontaminate.without_benchmark(docs, bench)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


# ------------------------------------------------------------------ token files

def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_files_round_trip(spark):
    rows = nasty_texts() + [(12, "hello </s> world"), (11, "later id first"), (13, "<|endoftext|> hi<|endoftext|>")]
    got = huffman.token_digests(documents(spark, rows)).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [own + [0] for own in reference_ids([t for _, t in ordered])]
    crc = [zlib.crc32(np.array(i, dtype="<u4").tobytes()) for i in ids]
    want = sorted((d or -1, len(i), c) for (d, _), i, c in zip(ordered, ids, crc, strict=True))
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [d for d, _ in ordered]
    assert huffman.token_digests(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 5000])
def test_huffman_code(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.2, n) % 3000).astype(np.uint32)
    counts = np.bincount(ids, minlength=3000)
    for bits in (12, 20):
        lengths = huffman.code_lengths(counts, bits)
        assert lengths.max(initial=0) <= bits and (np.exp2(-lengths[lengths > 0].astype(float))).sum() <= 1
        coded, checkpoints = huffman.encode_bits(ids, lengths, huffman.canonical_codes(lengths))
        most = max(int(lengths.max(initial=0)), 1)
        back = huffman.decode_bits(coded, checkpoints, n, huffman.decode_table(lengths, most), most)
        assert (back == ids).all()
    if n == 5000:
        used = counts[counts > 0] / n
        assert (counts * lengths).sum() / n <= -(used * np.log2(used)).sum() + 1


# ------------------------------------------------------------------ html

def test_layout():
    text = html_layout.visible_text(
        "<title>no</title><body><h1>Head &amp; <b>bold</b></h1><p>One   two<br>three<p>Next <span hidden>secret</span>"
        "<i style='DISPLAY : none'>x</i>end<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>"
        "<table><tr><th>Name<th>Qty<th>Note<tr><td>apple<td>3<td>red<tr><td colspan=2>both of them<td>z"
        "<tr><td rowspan=2>R<td>1<td>2<tr><td>3<td>4</table><pre>  keep\n   this</pre><script>x</script>"
        "<div>a<div>b</div>c</div><!-- no --><noscript>no</noscript>tail</body>")
    assert text.split("\n") == [
        "Head & bold", "", "One two", "three", "", "Next end", "", "- a", "- b", "  3. x", "  4. y", "- c", "",
        "Name   Qty    Note", "apple  3      red", "both of them  z", "R      1      2", "       3      4", "",
        "  keep", "   this", "", "a", "b", "c", "tail"]


class Words(HTMLParser):
    """Visible words in order, without layout."""

    skipped = ("script", "style", "head", "title", "noscript", "template")

    def __init__(self):
        super().__init__()
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.skipped
        self.out.append(" " if tag == "br" or tag in html_layout.BLOCKS else "")

    def handle_endtag(self, tag):
        self.depth -= tag in self.skipped and self.depth > 0
        self.out.append(" " if tag in html_layout.BLOCKS else "")

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


def test_all_visible_words_of_the_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    got = {r.page_id: r.text for r in html_layout.op8_html_layout(spark, SMALL).collect()}
    assert got.keys() == html.keys()

    def plain(text):
        return [w for w in text.split() if w not in ("-", ">") and not re.fullmatch(r"\d+\.", w)]

    for page_id, source in html.items():
        parser = Words()
        parser.feed(source or "")
        parser.close()
        assert plain(got[page_id]) == plain("".join(parser.out))


def test_html_edge_cases(spark):
    deep = "<div>" * 20_000 + "core" + "</div>" * 20_000
    pages = spark.createDataFrame(
        [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>a", "x"), (3, "u", deep, "x"), (3, "u", "< b & c", "x"),
         (4, "u", "<table><td>x<table><tr><td>in</table>y</table>", "x"), (5, "u", "</p></div></td>text</table>", "x"),
         (6, "u", "<li>loose<td>cell", "x"), (7, "u", "<script>never ends", "x")],
        "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.text) for r in html_layout.extract_layout(pages).collect())
    assert [g for g in got if g[0] not in (4, 6)] == [(0, "a"), (1, ""), (2, ""), (3, "< b & c"), (3, "core"),
                                                      (5, "text"), (7, "")]
    assert dict(got)[4].split() == ["x", "in", "y"] and dict(got)[6] == "- loosecell"
    assert html_layout.extract_layout(pages.limit(0)).count() == 0


# ------------------------------------------------------------------ personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) < 256 for p in m[0].split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and pii.luhn(digits)
                    or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


ODD = ["a@b@c.d.e", "@x.y", "a@b", "1.2.3.4.5.6.7.8", "300.1.1.1 1.1.1.1", "4111 1111-1111 1111", "4111 1111 1111 1112",
       "+1 (555) 010-9999 4111111111111111", "+49 30 1234567", "++1 222 333 4444", "0" * 500, "9" * 40 + ".1.2.3",
       "x@y.z.", "été a@b.co \U0001F600 c@d.org", "00256.1.1.1", "1.2.3.256", "+1(2", "a.b+c%d@e-f.g-h.i"]


def test_base_spans_match_the_patterns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(70_000 + i, t) for i, t in enumerate(ODD)]
    texts = dict(rows)
    found = pii.personal_data(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        spans = [(s["kind"], s["start"], s["end"]) for s in r.spans]
        assert [(s["kind"], s["start"], s["end"]) for s in r.spans if s["base"]] == base_spans(texts[r.doc_id])
        assert spans == sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0])))
    for r in pii.op9_personal_data(spark, SMALL).collect():
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_learned_spans(spark):
    rows = [(i, f"my phone is +1 (555) 010-{i:04} and card 4111111111111111 or mail a{i}@example.com") for i in range(60)]
    rows += [(100 + i, f"order id 1234567890123{i:02} of version 1.2.3.{i + 300}") for i in range(30)]
    rows += [(200, "call +1 (314) 555-6532 4663622617512349 now"), (201, None), (None, "tel (314) 555-6532 call")]
    model = pii.learn(documents(spark, rows))
    spans = {r.doc_id: [(s["kind"], s["start"], s["end"], s["base"]) for s in r.spans]
             for r in pii.personal_data(documents(spark, rows), model).collect()}
    assert ("phone", 5, 22, False) in spans[200]
    assert spans[201] == []
    assert all(s[3] for i in range(30) for s in spans[100 + i])     # nothing is added where cues speak against it
    assert [s[0] for s in spans[None]] == ["phone"]
    # The strict pattern is the labeler to trust: it says yes to real spans, no to others.
    assert model.reliability[0, 1, pii.YES] > 0.5 > model.reliability[0, 0, pii.YES]
    assert pii.personal_data(spark.createDataFrame([], DOCS)).count() == 0


# ------------------------------------------------------------------ toxicity

def test_held_out_accuracy(spark):
    sf = SMALL.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = toxicity.op10_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r.predicted for r in scored if r.toxic == 1]
    clean = [r.predicted for r in scored if r.toxic == 0]
    # About 350 toxic texts to learn from, in four languages.
    assert len(toxic) > 50 and sum(toxic) >= 0.8 * len(toxic)
    assert sum(clean) <= 0.01 * len(clean)
    assert docs.count() == toxicity.op10_toxicity(spark, sf).count()


def test_toxicity_edge_cases(spark):
    docs = documents(spark, nasty_texts())
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, None, None), (None, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0), labels.filter("toxic = 0")):
        model = toxicity.fit(toxicity.labelled_texts(docs, some))
        got = toxicity.score(docs, model).collect()
        assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(docs.limit(0), model).count() == 0
    order = np.zeros(toxicity.BUCKETS, dtype=np.int32)
    assert sorted(toxicity.ngrams("abcabcabc abc", order)) == sorted(set(toxicity.ngrams("ABC  abcabc\nabc abcabcabc abc",
                                                                                         order)) & set(
        toxicity.ngrams("abcabcabc abc", order)))
    assert len(toxicity.ngrams(None, order)) == len(toxicity.ngrams(" ", order)) == 0
