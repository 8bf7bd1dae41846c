"""All-or-nothing runs over several tables.

A ``Run`` writes every partition it replaces into a directory of its own
(``<root>/<table>/run=<id>/<column>=<value>``) and changes nothing that readers
see. ``commit`` then adds one record to ``<root>/_commits`` that names, for every
table and partition, the directory in force. A run that fails at any step has
added no record, so all tables read as before it; its directories are left
over and ``collect_leftovers`` removes them.

``Run.table(name)`` reads the tables pinned to the record the run began with,
plus what the run itself has written. ``read_table`` reads the last record, or
the one named by ``number``, so that a report over several tables sees one run
of all of them. A record is made by creating a file that must not exist: of two
runs that began with the same record the second fails and can be run again.
That needs a file system whose create is exclusive (HDFS, local).

``PlainTable`` has the same methods over a table that is replaced in place,
one table after the other.

A record lists directories, one for each partition of each table: its size
follows the number of load dates, never the rows.
"""

from __future__ import annotations

import json
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimledger.sources.sinks import (current_version, new_version_path, publish, read_if_exists, replace_partition,
                                     write_partition)

__all__ = ["PlainTable", "PublishedTable", "Run", "RunTable", "read_table", "commits", "collect_leftovers",
           "ConcurrentRun"]

RUN = "run"
WHOLE = ""          # the partition name of a table without partitions


class ConcurrentRun(RuntimeError):
    """Another run was committed since this one began."""


class PlainTable:
    """A partitioned table at ``path``, replaced in place."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame | None:
        return read_if_exists(self.spark, self.path)

    def replace(self, df: DataFrame, column: str, value: str) -> None:
        """``df`` is all of the partition ``column=value`` from now on, also without rows."""
        replace_partition(df, self.path, column, value)

    def replace_all_of(self, df: DataFrame, column: str, values: list[str]) -> None:
        """Replace the partitions ``values`` by the rows of ``df``, in one commit."""
        write_partition(df, self.path, [column])


class PublishedTable:
    """A small table that is rewritten whole, behind a pointer published last."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame | None:
        version = current_version(self.spark, self.path)
        return None if version is None else self.spark.read.parquet(version)

    def rewrite(self, df: DataFrame) -> None:
        path = new_version_path(self.path)
        df.coalesce(1).write.mode("overwrite").parquet(path)
        publish(self.spark, self.path, path)


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and modification times (milliseconds) of what lies in ``path``."""
    hadoop, fs = _fs(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(hadoop))


def commits(spark: SparkSession, root: str, last: int | None = None) -> list[dict]:
    """The committed records of ``root`` in order, or the ``last`` ones. A record
    cut short by a crash was never committed and is passed over."""
    folder = f"{root.rstrip('/')}/_commits"
    names = [n for n, _ in _children(spark, folder) if n.endswith(".json")]
    out: list[dict] = []
    for name in reversed(names):
        if last is not None and len(out) == last:
            break
        text = spark.read.text(f"{folder}/{name}", wholetext=True).first()
        try:
            out.append(json.loads(text[0]) if text else {})
        except json.JSONDecodeError:
            continue
        if not out[-1]:
            out.pop()
    return out[::-1]


def _read(spark: SparkSession, root: str, name: str, partitions: dict[str, str]) -> DataFrame | None:
    if not partitions:
        return None
    base = f"{root}/{name}"
    paths = [f"{base}/{RUN}={run}/{part}".rstrip("/") for part, run in sorted(partitions.items())]
    return spark.read.option("basePath", base).parquet(*paths).drop(RUN)


def read_table(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame | None:
    """Table ``name`` as the last committed run left it (or run ``number``), None
    where it has no rows."""
    known = commits(spark, root, None if number is not None else 1)
    chosen = [c for c in known if number is None or c["number"] == number]
    if number is not None and not chosen:
        raise ValueError(f"no committed run {number} in {root}")
    return _read(spark, root.rstrip("/"), name, chosen[-1]["tables"].get(name, {})) if chosen else None


class RunTable:
    """One table inside a run; see ``PlainTable`` and ``PublishedTable`` for the methods."""

    def __init__(self, run: "Run", name: str):
        self.run, self.name = run, name

    def read(self) -> DataFrame | None:
        return _read(self.run.spark, self.run.root, self.name, self.run.tables.get(self.name, {}))

    def replace(self, df: DataFrame, column: str, value: str) -> None:
        directory = self.run.next_directory()
        df.drop(column).write.parquet(f"{self.run.root}/{self.name}/{RUN}={directory}/{column}={value}")
        self.run.tables.setdefault(self.name, {})[f"{column}={value}"] = directory

    def replace_all_of(self, df: DataFrame, column: str, values: list[str]) -> None:
        directory = self.run.next_directory()
        path = f"{self.run.root}/{self.name}/{RUN}={directory}"
        df.where(F.col(column).isin(*values)).write.partitionBy(column).parquet(path)
        written = {n for n, _ in _children(self.run.spark, path)}
        partitions = self.run.tables.setdefault(self.name, {})
        for part in (f"{column}={v}" for v in values):
            partitions.pop(part, None)
            if part in written:            # a partition without rows has no directory
                partitions[part] = directory

    def rewrite(self, df: DataFrame) -> None:
        directory = self.run.next_directory()
        df.coalesce(1).write.parquet(f"{self.run.root}/{self.name}/{RUN}={directory}")
        self.run.tables[self.name] = {WHOLE: directory}


class Run:
    """A run over the tables below ``root``, seen by readers once committed.

    ``with Run(spark, root) as run:`` commits at the end of the block, unless the
    block raised. Every write goes to a new directory, so a table may be
    replaced by a frame that reads it, and a task that is run again after a
    lost executor writes what it wrote before.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        before = commits(spark, self.root, 1)
        self.parent = before[-1]["number"] if before else 0
        self.tables = {n: dict(p) for n, p in before[-1]["tables"].items()} if before else {}
        self.id = f"r{datetime.now(timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
        self._writes = 0

    def __enter__(self) -> "Run":
        return self

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            self.commit()

    def table(self, name: str) -> RunTable:
        return RunTable(self, name)

    def next_directory(self) -> str:
        self._writes += 1
        return f"{self.id}-{self._writes}"

    def commit(self) -> int:
        """Put everything the run wrote in force at once; the number of the record."""
        folder = f"{self.root}/_commits"
        last = commits(self.spark, self.root, 1)
        if (last[-1]["number"] if last else 0) != self.parent:
            raise ConcurrentRun(f"{self.root}: a run was committed after record {self.parent}")
        taken = [int(n.split(".")[0]) for n, _ in _children(self.spark, folder) if n.endswith(".json")]
        number = max(taken, default=0) + 1
        record = {"number": number, "parent": self.parent, "run": self.id, "tables": self.tables}
        path, fs = _fs(self.spark, f"{folder}/{number:010d}.json")
        try:
            out = fs.create(path, False)
        except Exception as e:
            if fs.exists(path):
                raise ConcurrentRun(f"{self.root}: record {number} was taken by another run") from e
            raise
        out.write(json.dumps(record, sort_keys=True).encode())
        out.close()
        self.parent = number
        return number


def collect_leftovers(spark: SparkSession, root: str, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
    """Delete directories that none of the last ``keep`` records names and that were
    not written to for ``older_than_hours`` (a run may still be under way);
    their paths. Reads pinned to an older record fail afterwards."""
    if keep < 1:
        raise ValueError("keep at least the last record")
    root = root.rstrip("/")
    used = {(name, directory) for c in commits(spark, root, keep)
            for name, parts in c["tables"].items() for directory in parts.values()}
    latest = time.time() * 1000 - older_than_hours * 3_600_000
    gone = []

    def walk(name: str) -> None:
        for child, modified in _children(spark, f"{root}/{name}".rstrip("/")):
            path = f"{name}/{child}".lstrip("/")
            if child.startswith(f"{RUN}="):
                if (name, child.removeprefix(f"{RUN}=")) not in used and modified <= latest:
                    hadoop, fs = _fs(spark, f"{root}/{path}")
                    fs.delete(hadoop, True)
                    gone.append(f"{root}/{path}")
            elif not child.startswith(("_", ".")) and "=" not in child:
                walk(path)

    walk("")
    return gone
