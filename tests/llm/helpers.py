"""Fixtures shared by the tests of the training-data operators."""

import os

import duckdb

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, **extra):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows, with
    columns that clash with names used inside the operators."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    clash = ["size", "digest", "bucket", "w", "t", "n", "row", "kept", "carried", "part", "class", "spans", "codes"]
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in clash])


def nasty_texts():
    """NULL, empty, blank, ties, repeats and a very long text."""
    long_text = " ".join(f"w{i % 9973}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "one two three four"), (6, long_text),
            (7, long_text), (None, "no id here"), (8, "x" * 100_000)]


def same(df, sql, views=None, sf_dir=SMALL):
    """Spark rows equal DuckDB's rows of ``sql`` over the tables of ``sf_dir``."""
    con = duckdb.connect()
    for name in ("documents", "conversations", "benchmark", "labels", "pages"):
        path = (views or {}).get(name, f"{sf_dir}/{name}.parquet")
        if os.path.isdir(path):
            path += "/*.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    order = sorted(names)
    ours = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    theirs = sorted(repr(tuple(dict(zip(names, r))[c] for c in order)) for r in result.fetchall())
    assert sorted(df.columns) == order
    assert ours == theirs


def as_views(spark, scratch, **tables):
    """Write small tables for ``same``; returns their paths by name."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{scratch}/{name}.parquet"
        df.write.parquet(paths[name])
    return paths
