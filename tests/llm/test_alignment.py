"""Token alignment against a plain reading of the contract."""

import collections
import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
from helpers import SMALL, documents, nasty_texts

from dimledger.llm import alignment, tokens

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def by_hand(rows):
    """Sorted result rows for (doc_id, text) rows."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok_a = Tokenizer.from_file(A)
    tok_a.encode_special_tokens = True
    tok_b = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    made, count = [], collections.Counter()
    for doc_id, text in rows:
        groups = []
        if text:
            whole = " " + text
            ids_a, ids_b = tok_a.encode(whole, add_special_tokens=False).ids, tok_b.encode(text)
            bytes_a = [bytes(byte_of[c] for c in tok_a.id_to_token(i)) for i in ids_a]
            bytes_b = [bytes([int(tok_b.id_to_piece(i)[3:5], 16)]) if tok_b.is_byte(i)
                       else tok_b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(bytes_a) == b"".join(bytes_b) == whole.encode():
                ends_a = np.cumsum([len(x) for x in bytes_a]).tolist()
                ends_b = np.cumsum([len(x) for x in bytes_b]).tolist()
                i = j = 0
                for cut in sorted(set(ends_a) & set(ends_b)):
                    ga, gb = [], []
                    while i < len(ids_a) and ends_a[i] <= cut:
                        ga.append(ids_a[i])
                        i += 1
                    while j < len(ids_b) and ends_b[j] <= cut:
                        gb.append(ids_b[j])
                        j += 1
                    groups.append((ga, gb))
        held = collections.Counter((a, b) for ga, gb in groups for a in ga for b in gb)
        made.append((doc_id, groups, held))
        count.update(held.keys())
    most = collections.defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for doc_id, groups, held in made:
        spelled = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
                    sum(held.values()), sum(n for p, n in held.items() if count[p] == most[p[0]]),
                    sum(n * count[p] for p, n in held.items()),
                    hashlib.sha256(spelled.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table_by_hand(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert collected(alignment.op12_token_alignment(spark, SMALL)) == by_hand(rows)


def test_nasty_texts_in_small_blocks(spark):
    rng = random.Random(2)
    letters = "aéß .,\n  '\t1<|… 日x▁ "
    rows = nasty_texts() + [(100 + k, "".join(rng.choice(letters) for _ in range(rng.randrange(60))))
                            for k in range(300)]
    rows += [(500, "<|endoftext|> hi </s><unk>"), (501, "日本語" * 400), (502, "x" * 3000 + " " + "=" * 999),
             (503, "naïve\u0000 text"), (504, "Привет, мир! ё")]
    got, counts = alignment.align(documents(spark, rows), A, B, block_bytes=2000)
    assert collected(got) == by_hand(rows)
    pairs = counts.collect()
    assert len({(r["a"], r["b"]) for r in pairs}) == len(pairs) and any(r["best"] == 0 for r in pairs)


@pytest.mark.parametrize("at_once", [1, 7, 1 << 20])
def test_links_do_not_depend_on_their_pieces(at_once):
    rng = np.random.default_rng(1)
    group_a, group_b = np.sort(rng.integers(0, 9, 60)), np.sort(rng.integers(0, 9, 80))
    a = (group_a, rng.integers(0, 5, 60), rng.integers(1, 4, 60))
    b = (group_b, rng.integers(0, 5, 80), rng.integers(1, 4, 80))
    doc = np.sort(rng.integers(0, 3, 9))
    want = collections.Counter()
    for ga, ia, ta in zip(*a):
        for gb, ib, tb in zip(*b):
            if ga == gb:
                want[int(doc[ga]), int(ia) * 5 + int(ib)] += int(ta * tb)
    got = alignment.links(a, b, 9, doc, 5, at_once)
    assert {(int(d), int(p)): int(t) for d, p, t in zip(*got)} == dict(want)


def test_successors_double_to_the_last_token_of_a_long_group():
    n = 5000                                       # ends of A and B never meet before the last
    a, b = np.append(np.arange(1, n) * 2, 2 * n), np.append(np.arange(1, n) * 2 - 1, 2 * n)
    assert set(alignment.terminals(a, b).tolist()) == {n - 1}


def test_empty_table(spark):
    got, counts = alignment.align(documents(spark, []), A, B)
    assert got.collect() == [] and counts.collect() == []


def test_tables_of_pieces_give_the_ids_of_whole_texts():
    import pyarrow as pa

    rng = random.Random(1)
    letters = "aéß .,\n  '\t1<|… 日x×\r\u0085"
    texts = [" " + "".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(2000)]
    texts += [" it's, don't 12a3\n\nb \n c", " <|endoftext|> hi", " ", "  ", " trail ", " l'été ÷ Привет, ё"]
    for enc, whole in (
            (tokens.ByteBpe(A, True, max_pieces=50), lambda e, t: e.tokenizer.encode(t, add_special_tokens=False).ids),
            (tokens.ByteBpe(A, False), lambda e, t: e.tokenizer.encode(t, add_special_tokens=False).ids),
            (tokens.PieceBpe(B, max_pieces=50), lambda e, t: e.model.encode(t[1:]) if t != " " else [e.blank])):
        for start in range(0, len(texts), 500):
            part = texts[start:start + 500]
            offsets, ids = enc.encode(pa.array(part))
            assert [ids[offsets[k]:offsets[k + 1]].tolist() for k in range(len(part))] == [whole(enc, t) for t in part]


def test_a_full_table_keeps_the_pieces_in_use():
    import pyarrow as pa

    asked = []

    class Noted(tokens.ByteBpe):
        def ask(self, pieces):
            asked.extend(pieces)
            return super().ask(pieces)

    enc = Noted(A, True, max_pieces=60)
    for k in range(20):
        text = " ".join([f"common{chr(97 + j)}" for j in range(20)] + [f"rare{chr(97 + j)}{chr(97 + k)}" for j in range(20)])
        assert enc.encode(pa.array([text]))[1].tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(enc.places) <= 60
    assert max(asked.count(p) for p in asked) == 1
