"""Rerun-safe writers.

Parquet tables cannot be updated in place and Spark has no multi-table
transaction, so:

* a day's output is a partition replaced as a whole (dynamic partition
  overwrite): running a day twice leaves one copy;
* a table that is rewritten from itself (SCD2 history, watermarks) is written
  to a new version directory, and a small pointer file naming the current
  version is replaced last (``publish``). Readers follow the pointer, so a
  failed run leaves the previous version in force; a job that loses
  executors is simply recomputed from its inputs, which are never modified.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimledger.session import checkpoint_dir

__all__ = ["write_partition", "replace_partition", "read_if_exists", "staged", "append", "overwrite", "replace_window", "expire",
           "new_version_path", "publish", "current_version"]


def write_partition(df: DataFrame, path: str, partition_cols: list[str], fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df``; others are untouched."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(path))


def replace_partition(df: DataFrame, path: str, col: str, value) -> None:
    """Make ``df`` the whole content of the partition ``col=value``, also when it
    has no rows (a dynamic overwrite would leave the old ones). ``df`` must not
    read the partition it replaces; see ``staged``."""
    df.drop(col).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{col}={value}")


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet. Any other
    failure (permissions, storage, a damaged file) is raised: it must not look
    like a first run."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared checkpoint folder, for a table that is
    replaced from itself; the copy is removed once the block succeeded."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/dimledger-stage/{uuid.uuid4().hex}"
    df.write.parquet(path)
    yield spark.read.schema(df.schema).parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def append(df: DataFrame, path: str, partition_cols: list[str] | None = None,
           fmt: str = "parquet") -> None:
    w = df.write.mode("append").format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def replace_window(target: DataFrame, new: DataFrame, col: str, values: list) -> DataFrame:
    """The target after reloading the ``values`` of ``col``: old rows of those
    values are dropped and the new rows take their place (D-25). As a file
    write this is ``write_partition(new, path, [col])``."""
    keep = target.where(~F.col(col).isin(*values) | F.col(col).isNull())
    return keep.unionByName(new.where(F.col(col).isin(*values)))


def expire(df: DataFrame, end_col: str, lo: Column, hi: Column, status_col: str = "status",
           label: str = "expired") -> DataFrame:
    """Rows whose end falls in ``[lo, hi)`` and that have no status yet get
    ``label``; everything else is unchanged (D-26)."""
    end = F.col(end_col)
    hit = (end >= lo) & (end < hi) & F.col(status_col).isNull()
    return df.withColumn(status_col, F.when(hit, F.lit(label)).otherwise(F.col(status_col)))


def new_version_path(root: str, run_date: _dt.date | None = None) -> str:
    """A fresh directory under ``root`` for one run's output."""
    stamp = (run_date or _dt.date.today()).strftime("%Y%m%d")
    return f"{root.rstrip('/')}/v={stamp}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, root: str, version_path: str) -> None:
    """Make ``version_path`` the current version of ``root``.

    Appends one row (path, time) to ``root/_versions``. An append commits as a
    new file or not at all, so readers see the old or the new pointer.
    """
    row = [(version_path, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))]
    (spark.createDataFrame(row, "path string, published_at timestamp_ntz")
     .coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/_versions"))


def current_version(spark: SparkSession, root: str) -> str | None:
    """The last published version directory of ``root``, or None before the first run."""
    pointers = read_if_exists(spark, f"{root.rstrip('/')}/_versions")
    if pointers is None:
        return None
    last = pointers.orderBy(F.col("published_at").desc(), F.col("path").desc()).first()
    return last["path"] if last else None
