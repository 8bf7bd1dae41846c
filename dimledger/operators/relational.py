"""Relational building blocks: dedupe, snapshots, hierarchies, anti-joins,
null rules of the reference's pandas steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimledger.functions.columns import exact_sum

__all__ = [
    "latest_per_key", "snapshot_as_of", "expand_hierarchy", "hierarchy_roots", "level_ids", "any_level_join",
    "deepest_level_join", "anti_join", "exclude", "fill", "normalise_missing", "sum_by",
    "null_safe_join", "union_all", "profile", "preview",
]


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep, per ``keys``, the row that is greatest by ``order`` (lexicographic).

    ``order`` should end in a unique column (an operation id) so ties cannot
    make the pick depend on row order. Written as ``max_by`` over a struct so
    the work is a partial (map-side) aggregation: a key with a third of all
    rows is reduced to one row per input partition before the shuffle, unlike
    ``row_number()`` over a window, which sends all its rows to one task.
    """
    cols = df.columns
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]),
                          F.struct(*[F.col(c) for c in order])).alias("_r"))
            .select(*[F.col("_r")[c].alias(c) for c in cols]))


def snapshot_as_of(df: DataFrame, ts_col: str, cutoff: Column) -> DataFrame:
    """All rows of the newest snapshot taken at or before ``cutoff``.

    The snapshot time is a scalar subquery: Spark runs it once and pushes the
    resulting equality into the parquet scan (row-group skipping).
    """
    newest = df.where(F.col(ts_col) <= cutoff).select(F.max(ts_col))
    return df.where(F.col(ts_col) == newest.scalar())


def expand_hierarchy(nodes: DataFrame, id_col: str, parent_col: str, root: Column,
                     depth: int = 3, prefix: str = "cat_") -> DataFrame:
    """Distinct paths below the root(s), one column per level (``cat_1`` …).

    Level ``n`` holds the children of the deepest non-null level above it, so a
    branch that ends early leaves the deeper columns NULL. Each level is one
    equi-join of the current frontier with ``nodes`` keyed by parent.
    """
    edges = nodes.select(F.col(parent_col).alias("_parent"), F.col(id_col).alias("_child"))
    paths = nodes.where(root).select(F.col(id_col).alias("_root"))
    chain = ["_root"]
    for level in range(1, depth + 1):
        name = f"{prefix}{level}"
        anchor = F.coalesce(*[F.col(c) for c in reversed(chain)])
        paths = (paths.withColumn("_anchor", anchor)
                 .join(edges.withColumnRenamed("_child", name),
                       F.col("_anchor") == F.col("_parent"), "left")
                 .drop("_anchor", "_parent"))
        chain.append(name)
    return paths.select(*chain[1:]).distinct()


def hierarchy_roots(nodes: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """(id, root, depth, cyclic) of every node of a forest of any depth.

    Pointer doubling: each node points ``depth`` steps up; a round replaces the
    pointer by the pointer's pointer, so a chain of n nodes takes log2(n)
    rounds of one equi-join, each written to the checkpoint folder, and only
    nodes that have not arrived take part. A parent that is NULL or no node of
    the table ends a chain. Nodes on a cycle or below one never arrive: once
    a pointer has gone more steps than there are nodes, those left are
    reported with ``cyclic`` and without a root. ``id_col`` must be unique.
    """
    known = nodes.select(F.col(id_col).alias("_known"))
    step = (nodes.join(known, F.col(parent_col) == F.col("_known"), "left")
            .select(F.col(id_col).alias("id"), F.col("_known").alias("up"),
                    F.when(F.col("_known").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    arrived = step.where("up IS NULL").select("id", F.col("id").alias("root"), "depth").checkpoint()
    moving = step.where("up IS NOT NULL").checkpoint()
    total = nodes.count()
    reach = 1
    while reach <= total:
        there = arrived.select(F.col("id").alias("_id"), "root", F.col("depth").alias("_more"))
        landed = moving.join(there, F.col("up") == F.col("_id")).select(
            "id", "root", (F.col("depth") + F.col("_more")).alias("depth"))
        on = moving.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("depth").alias("_more"))
        ahead = moving.join(on, F.col("up") == F.col("_id")).select(
            "id", F.col("_up").alias("up"), (F.col("depth") + F.col("_more")).alias("depth"))
        arrived = arrived.unionByName(landed).checkpoint()
        moving = ahead.checkpoint()
        if moving.isEmpty():
            break
        reach *= 2
    done = arrived.select("id", "root", "depth", F.lit(False).alias("cyclic"))
    lost = moving.select("id", F.lit(None).cast(dict(nodes.dtypes)[id_col]).alias("root"),
                         F.lit(None).cast("long").alias("depth"), F.lit(True).alias("cyclic"))
    return done.unionByName(lost)


def level_ids(cats: DataFrame, levels: list[str], out: str = "_cat_id",
              distinct: bool = True) -> DataFrame:
    """Every id that appears at any level (once, with ``distinct``)."""
    ids = (cats.select(F.explode(F.array(*[F.col(c) for c in levels])).alias(out))
           .where(F.col(out).isNotNull()))
    return ids.distinct() if distinct else ids


def any_level_join(df: DataFrame, key: str, cats: DataFrame, levels: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``key`` equals a category id at any level.

    Replaces ``ON k = a OR k = b OR k = c`` (a nested-loop join) by a semi-join
    against the exploded id set: a hash join, no pairs emitted, each row kept
    at most once.
    """
    # duplicates on the build side cannot repeat a row of a semi-join
    ids = level_ids(cats, levels, distinct=False)
    return df.join(ids, df[key] == ids["_cat_id"], "left_semi")


def deepest_level_join(df: DataFrame, key: str, cats: DataFrame, levels: list[str]) -> DataFrame:
    """Inner join on the deepest non-null level, ``coalesce(cat_n, …, cat_1)``."""
    deepest = cats.select(F.coalesce(*[F.col(c) for c in reversed(levels)]).alias("_deepest"))
    return (df.join(deepest, df[key] == F.col("_deepest"), "inner").drop("_deepest"))


def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
              null_aware: bool = False) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``.

    ``null_aware`` gives SQL ``NOT IN (subquery)`` semantics: an empty right
    side keeps everything, a NULL on the right side removes everything, and a
    NULL left key is kept only when the right side is empty. It is built from a
    hash/sort-merge ``left_anti`` plus two ``EXISTS`` scalars, so a large right
    side never becomes a broadcast nested-loop join.
    """
    right_key = right_key or left_key
    keys = right.select(F.col(right_key).alias("_nk"))
    out = left.join(keys, left[left_key] == F.col("_nk"), "left_anti")
    if not null_aware:
        return out
    right_has_null = keys.where(F.col("_nk").isNull()).exists()
    right_non_empty = keys.exists()
    return out.where(~right_has_null & (F.col(left_key).isNotNull() | ~right_non_empty))


def exclude(df: DataFrame, c: str, values: list, keep_null: bool = True) -> DataFrame:
    """``NOT IN`` a constant list. ``keep_null`` keeps NULL rows (pandas ``~isin``);
    without it NULL rows are dropped, as SQL does."""
    test = F.col(c).isin(*values)
    return df.where(~F.coalesce(test, F.lit(False))) if keep_null else df.where(~test)


def fill(df: DataFrame, values: dict) -> DataFrame:
    """Per-column NULL (and NaN) replacement, typed like the column."""
    types = dict(df.dtypes)
    out = df
    for c, v in values.items():
        col = F.col(c)
        if types[c] in ("double", "float"):
            col = F.nanvl(col, F.lit(None).cast(types[c]))
        out = out.withColumn(c, F.coalesce(col, F.lit(v).cast(types[c])))
    return out


def normalise_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN and the text 'None'/'nan' become NULL in the given columns."""
    types = dict(df.dtypes)
    out = df
    for c in cols:
        if types[c] in ("double", "float"):
            out = out.withColumn(c, F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)))
        elif types[c] == "string":
            out = out.withColumn(c, F.when(F.col(c).isin("None", "nan", "NaN"), F.lit(None))
                                 .otherwise(F.col(c)))
    return out


def sum_by(df: DataFrame, keys: list[str], cols: list[str], scale: int | None = None) -> DataFrame:
    """Group sum as pandas ``groupby().sum()`` does: NULL-key groups dropped, an
    all-NULL group sums to 0. ``scale`` sums through a fixed-scale decimal so
    the result does not depend on row order."""
    def total(c):
        s = exact_sum(c, scale) if scale is not None else F.sum(c)
        return F.coalesce(s, F.lit(0).cast(dict(df.dtypes)[c] if scale is None else "double")).alias(c)
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(not_null).groupBy(*keys).agg(*[total(c) for c in cols])


def null_safe_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]],
                   how: str = "inner") -> DataFrame:
    """Equi-join where NULL matches NULL (pandas ``merge``). ``<=>`` keys still
    plan as hash/sort-merge joins."""
    cond = reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in pairs])
    return left.join(right, cond, how)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Several inserts into one target, as one lazily unioned DataFrame."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def profile(df: DataFrame) -> DataFrame:
    """One row: total rows and non-null count per column (``DataFrame.info``)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count(F.col(c)).alias(c) for c in df.columns])


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """A few rows to look at; order is not defined."""
    return df.limit(n)
