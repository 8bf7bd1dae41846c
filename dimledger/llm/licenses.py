"""Licence scan: canonical digests of entire texts, hash-joined to known ones.

A canonical form brings a text to a form in which wordings of the same licence
agree: lower case, curly quotes and dashes and all other punctuation as one
space, lines that are copyright notices dropped, equivalent spellings made
one. Its SHA-256 is the key of an equi-join with the digests of the known
licences. A document's units are its entire text and, because notices often
stand alone on a line, each of its lines as a text of its own.

Everything is Spark functions: no user function, no Python on the executors.
The known licences are the notices and short texts of ``KNOWN`` and the full
published texts in ``license_texts``, one file each, with and without their
title lines and appendices. A text is canonicalised once with its line feeds
kept; its entire form joins the registry by digest, its lines are looked up in
the registry inside the row. Rows are never split, so nothing has to be put
together again, and nothing is shuffled while Spark finds the registry small.

Defined results: a NULL or empty text (or one of punctuation or copyright
lines alone) has no digest and no licence; repeated rows give a row each; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import re
from functools import cache, reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimledger.llm.common import relation

# Spellings that licence texts use for the same word, as whole
# words after lower-casing. The right form replaces the left one.
SPELLINGS = {
    "licence": "license", "licenced": "licensed", "licences": "licenses", "sub license": "sublicense",
    "copyright owner": "copyright holder", "acknowledgement": "acknowledgment", "analogue": "analog",
    "authorisation": "authorization", "behaviour": "behavior", "organisation": "organization",
    "favour": "favor", "fulfil": "fulfill", "judgement": "judgment", "merchantibility": "merchantability",
    "non commercial": "noncommercial", "per cent": "percent", "redistribution s": "redistributions",
    "unauthorised": "unauthorized", "whilst": "while", "http": "https",
}

# Texts of known licences and notices, as published.
KNOWN = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Released under the MIT License.", "Licensed under the MIT License.", "MIT License"],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
        "OF THIS SOFTWARE."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at\n"
        "http://www.apache.org/licenses/LICENSE-2.0\n"
        "Unless required by applicable law or agreed to in writing, software distributed under the License "
        "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
        "or implied. See the License for the specific language governing permissions and limitations under "
        "the License.",
        "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software.\n"
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions:\n"
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the "
        "original software. If you use this software in a product, an acknowledgment in the product "
        "documentation would be appreciated but is not required.\n"
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software.\n"
        "3. This notice may not be removed or altered from any source distribution."],
}

# Title lines that stand above a licence that is published without one.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License", "zlib/libpng License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License",
                     "BSD 2-Clause \"Simplified\" License", "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License",
                     "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "Modified BSD License",
                     "BSD License", "The BSD License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
# The first line of a published text that does not belong to its title, and
# the lines at which its end or an appendix of it begins.
BODY = re.compile(r"(?m)^[ \t]*(?:TERMS AND CONDITIONS FOR USE|Everyone is permitted to copy|Preamble|Statement of Purpose"
                  r"|1\. Definitions|0\. PREAMBLE|This version of the GNU Lesser|1\. Definitions\.).*$")
APPENDIX = re.compile(r"(?mi)^[ \t]*(?:END OF TERMS AND CONDITIONS|APPENDIX: |Appendix: How to Apply|How to Apply These Terms"
                      r"|Exhibit [AB] - |EXHIBIT A|ADDENDUM: How to use|For more information, please refer to).*$")


@cache
def published() -> dict[str, list[str]]:
    """The full published texts by licence, each with and without its title
    lines and with its end at every appendix or at none."""
    out = {}
    texts = {path.stem: path.read_text(encoding="utf-8")
             for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
    texts |= {name: KNOWN[name][0] for name in ("MIT", "ISC", "Zlib")}
    for name, text in texts.items():
        ends = [text]
        for m in APPENDIX.finditer(text):
            ends += [text[:m.start()], text[:m.end()]]
        body = BODY.search(text)
        forms = ends + [f"{title}\n{end}" for title in TITLES.get(name, []) for end in ends]
        if body and name not in TITLES:
            forms += [end[body.start():] for end in ends if len(end) > body.end()]
        out[name] = list(dict.fromkeys(forms))
    return out


# A line that only says whose copyright it is, after lower-casing.
NOTICE_LINE = r"(^|\n)[\x20\t#*/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
NOTICE_SIGNS = ("copyright", "(c)", "©", "all rights reserved")
# ASCII punctuation and space, no-break space, the Latin-1 copyright signs and quotes, general punctuation.
PUNCTUATION = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\x{A0}\x{A9}\x{AB}\x{AE}\x{BB}\x{2000}-\x{206F}]+"
IN_LINES = PUNCTUATION.replace(r"\x00-", r"\x00-\x09\x0B-", 1)         # all of it but the line feed
ANY_SPELLING = " (?:" + "|".join(SPELLINGS) + ") "


def _lines_left(lowered: Column) -> Column:
    """The text without notice lines, punctuation but line feeds as one space."""
    signs = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(sign)) for sign in NOTICE_SIGNS])
    kept = F.when(signs, F.regexp_replace(lowered, NOTICE_LINE, "\n")).otherwise(lowered)
    return F.regexp_replace(kept, IN_LINES, " ")


def _one_line(lines: Column) -> Column:
    """Lines as one, runs of line feeds and spaces as one space, a space at both ends."""
    flat = F.replace(F.regexp_replace(lines, r"\n[ \n]*", " "), F.lit("  "), F.lit(" "))
    return F.concat(F.lit(" "), flat, F.lit(" "))


def _agreed(spaced: Column) -> Column:
    out = spaced
    for form, agreed in SPELLINGS.items():
        out = F.replace(out, F.lit(f" {form} "), F.lit(f" {agreed} "))
    return out


def with_forms(df: DataFrame, lowered: Column, line_forms: bool = True) -> DataFrame:
    """``df`` with ``form``, in which texts of one licence agree ('' if nothing
    is left), and ``line_forms``, those of the text's lines; ``lowered`` is the
    text in lower case. Texts without a spelling to change pass that step by."""
    marked = df.withColumn("_lines", _lines_left(lowered))
    flat = marked.withColumn("_flat", _one_line(F.col("_lines")))
    odd = flat.withColumn("_odd", F.regexp_like("_flat", F.lit(ANY_SPELLING)))
    out = odd.withColumn("form", F.trim(F.when(F.col("_odd"), _agreed(F.col("_flat"))).otherwise(F.col("_flat"))))
    if line_forms:
        wide = F.concat(F.lit(" "), F.replace(F.col("_lines"), F.lit("\n"), F.lit(" \n ")), F.lit(" "))
        lines = F.when(F.col("_odd"), _agreed(wide)).otherwise(F.col("_lines"))
        out = out.withColumn("line_forms", F.transform(F.split(lines, "\n"), lambda line: F.trim(line)))
    return out.drop("_lines", "_flat", "_odd")


def known_licenses(spark: SparkSession, known: dict[str, list[str]] | None = None) -> DataFrame:
    """(license, known_digest) of a registry of licence texts, by default
    ``KNOWN`` and the published ones."""
    registries = [known] if known else [KNOWN, published()]
    rows = [F.struct(F.lit(name).alias("license"), F.lit(text).alias("text"))
            for registry in registries for name, texts in registry.items() for text in texts]
    forms = with_forms(spark.range(1).select(F.inline(F.array(*rows))), F.lower("text"), line_forms=False)
    return (forms.filter("form <> ''").groupBy(F.sha2("form", 256).alias("known_digest"))
            .agg(F.min("license").alias("license")))


def license_scan(docs: DataFrame, known: dict[str, list[str]] | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``digest`` and ``license`` of its entire
    text, and the licences of its lines, sorted (``notices``)."""
    registry = known_licenses(docs.sparkSession, known)
    source = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"))
    pairs = registry.select(F.map_from_entries(F.collect_list(F.struct("known_digest", "license")))).scalar()
    formed = with_forms(source, F.col("_text")).drop("_text").withColumn("_known", pairs)
    # Lines: the digests that are known (a hash set per row), then their licences.
    hits = F.array_intersect(F.transform("line_forms", lambda form: F.sha2(form, 256)), F.map_keys("_known"))
    names = F.array_sort(F.array_distinct(F.transform(hits, lambda digest: F.element_at("_known", digest))))
    keyed = formed.select("doc_id", F.when(F.col("form") != "", F.sha2("form", 256)).alias("digest"),
                          F.array_join(names, ",").alias("notices"))
    # A text of one line is its own line as well, so it is listed as a notice too.
    return (keyed.join(registry, F.col("digest") == F.col("known_digest"), "left")
            .select("doc_id", "digest", "license", "notices"))


def op2_license_scan(spark, sf_dir):
    return license_scan(relation(spark, sf_dir, "documents"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_canonical(column: str) -> str:
    out = f"lower(coalesce({column}, ''))"
    for _ in range(2):
        out = f"regexp_replace({out}, {_sql_text(NOTICE_LINE)}, chr(10), 'g')"
    out = f"(' ' || regexp_replace({out}, {_sql_text(PUNCTUATION)}, ' ', 'g') || ' ')"
    for form, agreed in SPELLINGS.items():
        out = f"replace({out}, ' {form} ', ' {agreed} ')"
    return f"trim({out})"


OP2_SQL = f"""
WITH known AS (
  SELECT form, min(license) AS license FROM (
    SELECT {_sql_canonical("t")} AS form, license
    FROM (VALUES {", ".join(f"({_sql_text(n)}, {_sql_text(t)})" for n, ts in KNOWN.items() for t in ts)}) v(license, t))
  GROUP BY form),
docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
entire AS (SELECT rid, doc_id, {_sql_canonical("text")} AS form FROM docs),
line AS (
  SELECT rid, {_sql_canonical("l")} AS form FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM docs)),
noted AS (
  SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM line JOIN known USING (form) GROUP BY rid)
SELECT doc_id, CASE WHEN e.form <> '' THEN sha256(e.form) END AS digest, k.license,
       coalesce(n.notices, '') AS notices
FROM entire e LEFT JOIN known k ON e.form = k.form AND e.form <> '' LEFT JOIN noted n ON e.rid = n.rid
"""

QUERIES = {"op2_license_scan": op2_license_scan}
ORACLE = {"op2_license_scan": OP2_SQL}
