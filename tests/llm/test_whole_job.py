"""Cases in which the training-data operators once did less than the whole job."""

import random
from pathlib import Path

import pytest
from helpers import documents

from dimledger.llm import decontaminate, html_layout, licenses, quality


# ------------------------------------------------------------------ decontamination

def test_every_planted_item_is_found(spark):
    """More themes than the latent space has dimensions, each in 30 passages;
    items of 8 and 30 words that stand once in the corpus word for word and
    once with every fifth word replaced, among words of the themes."""
    rng = random.Random(4)
    themes = [[f"t{g}w{j}" for j in range(12)] for g in range(250)]
    items = [(g, " ".join(theme)) for g, theme in enumerate(themes)]
    short = [(1_000 + i, [f"s{i}k{j}" for j in range(8)]) for i in range(100)]
    longer = [(2_000 + i, [f"l{i}k{j}" for j in range(30)]) for i in range(50)]
    rows = []
    for g, theme in enumerate(themes):
        for k in range(30):
            words = rng.sample(theme, 12) + ["filler"] * 36
            rng.shuffle(words)
            rows.append((g * 30 + k, " ".join(words)))
    for i, words in short + longer:
        around = [rng.choice(rng.choice(themes)) for _ in range(60)]
        at = rng.randrange(10, 50)
        changed = [f"zz{w}" if k % 5 == 3 else w for k, w in enumerate(words)]
        rows.append((100_000 + i, " ".join(around[:at] + words + around[at:])))
        rows.append((200_000 + i, " ".join(around[:at] + changed + around[at:])))
    bench = spark.createDataFrame(items + [(i, " ".join(w)) for i, w in short + longer], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(documents(spark, rows), bench).collect()}
    for i, words in short + longer:
        assert got[(100_000 + i, i)].lcs_words == len(words)
        assert (200_000 + i, i) in got
    planted = {(base + i, i) for i, _ in short + longer for base in (100_000, 200_000)}
    assert {p for p in got if p[1] >= 1_000} == planted


# ------------------------------------------------------------------ quality rules

def test_few_lines_and_other_languages_are_kept(spark):
    body = " ".join(f"word{i} the" for i in range(40))
    foreign = " ".join(f"sana{i}" for i in range(80))
    rows = [(1, f"A short line\n{body}\nA short line"), (2, "\n".join([body] * 2 + ["x"])),
            (3, "\n".join(f"line {i % 6} of the list {i % 6}" for i in range(40)))]
    docs = documents(spark, rows)
    assert [r.doc_id for r in quality.keep_good(docs).collect()] == [1]
    strange = documents(spark, [(4, foreign)])
    assert quality.keep_good(strange).count() == 0
    for lang in ("fi", None):
        assert quality.keep_good(strange.selectExpr("* EXCEPT (lang)", f"{f"'{lang}'" if lang else 'NULL'} AS lang")
                                 .selectExpr("* EXCEPT (lang)", "CAST(lang AS string) AS lang")).count() == 1


def test_no_labelled_clean_document_falls_to_the_line_rule(spark):
    table = "/root/testdata/sf0.1"
    clean = spark.read.parquet(f"{table}/documents.parquet").join(
        spark.read.parquet(f"{table}/labels.parquet").filter("quality = 1").select("doc_id"), "doc_id")
    judged = quality.quality_rules(clean, quality.CLEAN_RULES, lang_col="lang").select("base_failed", "kept").collect()
    assert [r for r in judged if not r.base_failed and not r.kept] == []


# ------------------------------------------------------------------ licences

def test_full_licence_texts_are_known(spark):
    common = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1",
             "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = [((common / file).read_text(), name) for file, name in files.items()]
    apache = (common / "Apache-2.0").read_text()
    gpl = (common / "GPL-3").read_text()
    texts += [(apache[:apache.index("APPENDIX: ")], "Apache-2.0"),
              (apache[:apache.index("END OF TERMS")], "Apache-2.0"),
              (apache[apache.index("TERMS AND CONDITIONS FOR USE"):], "Apache-2.0"),
              (gpl[:gpl.index("END OF TERMS")], "GPL-3.0"), (gpl[:gpl.index("How to Apply These")], "GPL-3.0")]
    mit = licenses.KNOWN["MIT"][0]
    texts += [(f"{title}\n\nCopyright (c) 2020 A. Person\n\n{mit}\n", "MIT")
              for title in ("MIT License", "The MIT License (MIT)", "The MIT License")]
    texts += [(f"{title}\n\nCopyright (c) 2020, A. Person\n{rights}\n{licenses.published()[name][0]}", name)
              for name in ("BSD-2-Clause", "BSD-3-Clause") for rights in ("", "All rights reserved.\n")
              for title in ("", f"BSD {name[4]}-Clause License")]
    texts += [(licenses.published()["Unlicense"][0], "Unlicense"), (apache[:5000], None), (mit + " but not so", None)]
    docs = documents(spark, [(i, text) for i, (text, _) in enumerate(texts)])
    got = {r.doc_id: r.license for r in licenses.license_scan(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [name for _, name in texts]
    assert {r["known_digest"] for r in licenses.known_licenses(spark, licenses.KNOWN).collect()} <= {
        r["known_digest"] for r in licenses.known_licenses(spark).collect()}


# ------------------------------------------------------------------ visible text

@pytest.mark.parametrize("html,text", [
    ("<p>So <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds.</p>", "So x=1 2 holds."),
    ("<p>a <math><semantics><mi>y</mi><annotation>\\\\y</annotation></semantics></math> b</p>", "a y b"),
    ("<p>See <svg><title>t</title><desc>d</desc><defs><text>no</text></defs><path d='M0'/><g>stray"
     "<text x='1'>left <tspan>end</tspan></text><text>right</text></g></svg> here.</p>", "See left end right here."),
    ("<p>Pick</p><select><optgroup label='Fruit'><option>Apple<option selected>Pear</optgroup>"
     "<option label='Other'>x</option></select><p>now</p>", "Pick\n\nFruit\nApple\nPear\nOther\n\nnow"),
    ("<p>Note: <textarea rows=2>\none &amp; <b>\ntwo</textarea></p>", "Note: one & <b>\ntwo"),
    ("<form><input type=submit value='Send it'><input type='BUTTON' value=Go><input type=hidden value=h>"
     "<input type=password value=p><input value=Ann><input placeholder='Town'><input type=checkbox value=on></form>",
     "Send it Go Ann Town"),
    ("<p>a<datalist><option>no</option></datalist> <input type=submit value=no hidden>b</p>", "a b"),
    ("<svg/><p>after <svg><circle r='1'/><circle r='2'/></svg>all</p><title>no</title>", "after all"),
])
def test_every_visible_kind_of_text_is_kept(html, text):
    assert html_layout.visible_text(html) == text
