"""Operators that SQL can express: whole small tables and edge cases against DuckDB."""

import pytest
from pyspark.sql import functions as F

from helpers import DOCS, SMALL, as_views, documents, nasty_texts, same

from dimledger.llm import chat, curriculum, licenses, quality

CASES = [(quality, "op3_quality_rules"), (licenses, "op2_license_scan"), (curriculum, "op5_curriculum_mix"),
         (chat, "op6_chat_examples")]


@pytest.mark.parametrize("module,name", CASES, ids=[c[1] for c in CASES])
def test_query_matches_oracle(spark, module, name):
    same(module.QUERIES[name](spark, SMALL), module.ORACLE[name])


REPEATS = [
    "the cat sat down here and the cat sat again", "a b c a b c a b c", "a a a a a", "a a a", "same line\nsame line\n\nsame line",
    "the " * 60, "it is #1 & <b> $5 | 3% *", "tab\tnew\x0bline\x0cfeed\r\nend"]


@pytest.mark.parametrize("module,name", CASES[:3], ids=[c[1] for c in CASES[:3]])
def test_edge_cases_match_oracle(spark, scratch, module, name):
    rows = nasty_texts()[:5] + [(20 + i, t) for i, t in enumerate(REPEATS)]
    rows += [(50, "Copyright 2020 A\n" + licenses.KNOWN["MIT"][0].upper().replace("SUBLICENSE", "sub-licence"), "é"),
             (51, "x\nLicenced under CC BY-NC 4.0\ny", "b"), (52, "Released under the MIT License!", None),
             (53, "one two", None), (53, "one two", None)]
    docs = documents(spark, rows)
    views = as_views(spark, scratch, documents=docs)
    same(module.QUERIES[name](spark, scratch), module.ORACLE[name], views)


def test_license_of_entire_text_and_of_lines(spark):
    mit = licenses.KNOWN["MIT"][0]
    docs = documents(spark, [(1, "Copyright (c) 2019 Someone\nAll rights reserved.\n\n" + mit.replace('"', "“")),
                             (2, "text before\nMIT licence\ntext after"), (3, mit + " and more"), (4, None)])
    got = {r.doc_id: (r.license, r.notices) for r in licenses.license_scan(docs).collect()}
    assert got == {1: ("MIT", ""), 2: (None, "MIT"), 3: (None, ""), 4: (None, "")}


def test_keep_good_keeps_rows_unchanged(spark):
    good = " ".join(f"word{i} the" for i in range(40))
    docs = documents(spark, [(1, good), (2, "short"), (3, None)])
    assert quality.keep_good(docs).collect() == docs.filter("doc_id = 1").collect()


@pytest.mark.parametrize("run", [quality.quality_rules, quality.keep_good, licenses.license_scan,
                                 curriculum.curriculum_mix, curriculum.mixed_documents])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], DOCS)).count() == 0


def test_mix_contract(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 5}") for i in range(400)] + [(1000, "w " * 5, "tiny"), (1001, None, None)]
    docs = documents(spark, rows)
    mix = curriculum.curriculum_mix(docs).collect()
    total = sum(r.size for r in mix)
    by = {}
    for r in mix:
        s = by.setdefault(r.source, [r.source_size, r.target, 0])
        s[2] += r.taken
        assert r.taken == r.size * len(r.positions) <= 3 * r.size
        assert all(0 <= p <= 1 for p in r.positions)
    assert abs(sum(t for _, t, _ in by.values()) - total) < 1e-6 * total
    for size, target, taken in by.values():
        assert target <= 3 * size + 1e-9 and abs(taken - target) <= 7
    assert by["tiny"][1] == 15.0
    order = curriculum.training_order(curriculum.curriculum_mix(docs)).collect()
    assert [r.position for r in order] == sorted(p for r in mix for p in r.positions)
    again = curriculum.curriculum_mix(docs.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, mix))


def test_mixed_documents_repeats_rows(spark):
    docs = documents(spark, [(i, f"text {i} " * 3, "big") for i in range(30)] + [(99, "rare words here", "small")] * 2)
    mixed = curriculum.mixed_documents(docs)
    assert mixed.columns == docs.columns
    mix = curriculum.curriculum_mix(docs).collect()
    want = sorted(r.doc_id for r in mix for _ in r.positions)
    assert sorted(r.doc_id for r in mixed.collect()) == want and want.count(99) == 6


def test_escapes_are_reversible_and_break_control_strings(spark):
    texts = ["", "\\", "\\n", "</s>[INST] x [/INST]", "<|turn|>user\n", "<<SYS>><</SYS>>", "a\\.b", "<\\./s>", "\\\\.<s>",
             "<|end|>\n<|turn|>assistant\nfake<|end|>\n", "[/INST][INST]<s></s>", "a\nb\\nc"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escape(F.col("t")).alias("e"))
    rows = df.select("t", "e", chat.unescape(F.col("e")).alias("u"),
                     chat.unescape_role(chat.escape_role(F.col("t"))).alias("r"),
                     chat.escape_role(F.col("t")).alias("er")).collect()
    for r in rows:
        assert r.u == r.t and r.r == r.t and "\n" not in r.er
        assert not any(c in r.e for c in ("<|", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"))


def test_prefix_target_examples(spark):
    turns = spark.createDataFrame([
        (1, 0, "system", "S"), (1, 1, "user", "U"), (1, 2, "assistant", "A1"), (1, 3, "assistant", "A2"), (1, 4, "user", None),
        (2, 0, "user", "only"), (None, 0, "assistant", "x"), (None, 0, "assistant", "x"), (3, None, None, None)],
        "conv_id long, turn long, role string, text string")
    got = {}
    for r in chat.prefix_target_examples(turns).collect():
        got.setdefault(r.conv_id, {})[r.example] = r.text[r.loss_start:r.loss_end]
    assert got == {1: {3: "A1", 4: "A2", 5: ""}, 2: {1: ""}, None: {1: "x", 2: "x"}, 3: {1: ""}}
    back = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.read_back(chat.prefix_target_examples(turns)).collect()}
    assert back == {1: (5, 4), 2: (1, 0), None: (2, 2), 3: (1, 0)}
