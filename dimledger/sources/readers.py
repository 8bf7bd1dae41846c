"""Typed readers: tables, daily delimited files, document exports."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["read_table", "read_jdbc", "daily_file_name", "read_daily_csv", "daily_csv_rejects", "read_typed_csv",
           "read_docs",
           "sql_query"]


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """A table scan. Parquet carries its own schema; other formats need one."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "parquet":
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.select(*[f.name for f in schema.fields]) if schema is not None else df


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], partition_column: str,
              lower: int, upper: int, num_partitions: int, properties: dict | None = None) -> DataFrame:
    """Full extract of a source-system table in ``num_partitions`` parallel
    range reads on a numeric ``partition_column`` (the source query is pushed
    down with only ``columns``), instead of one cursor fetching every row into
    one process. Needs the database's JDBC driver on the classpath."""
    query = f"(SELECT {', '.join(columns)} FROM {table}) src"
    return spark.read.jdbc(url, query, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties or {})


def daily_file_name(entity: str, run_date: _dt.date, ext: str = "csv") -> str:
    """``<entity>_DDMMYYYY.<ext>``, the daily drop naming."""
    return f"{entity}_{run_date.strftime('%d%m%Y')}.{ext}"


def read_daily_csv(spark: SparkSession, directory: str, entity: str, run_date: _dt.date,
                   schema: T.StructType, sep: str = ";", header: bool = True,
                   ext: str = "csv") -> DataFrame:
    """One day's delimited file with a declared schema (no inference).

    The header must name the schema's columns in its order, or reading fails.
    Lines that do not fit the schema are left out; ``daily_csv_rejects`` has
    them.
    """
    raw = _daily_lines(spark, directory, entity, run_date, schema, sep, header, ext)
    return raw.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


BAD_LINE = "_bad_line"


def _daily_lines(spark, directory, entity, run_date, schema, sep, header, ext) -> DataFrame:
    path = f"{directory.rstrip('/')}/{daily_file_name(entity, run_date, ext)}"
    with_bad = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    lines = (spark.read.schema(with_bad).option("sep", sep).option("header", header)
             .option("enforceSchema", False).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", BAD_LINE).csv(path))
    # Whether a line is bad depends on all its columns, so none may be pruned
    # from the read: the condition holds for every row and needs them all.
    return lines.where(F.xxhash64(*schema.fieldNames()) >= F.lit(-2 ** 63))


def daily_csv_rejects(spark: SparkSession, directory: str, entity: str, run_date: _dt.date,
                      schema: T.StructType, sep: str = ";", header: bool = True,
                      ext: str = "csv") -> DataFrame:
    """The lines of one day's file that do not fit the schema (``line``)."""
    raw = _daily_lines(spark, directory, entity, run_date, schema, sep, header, ext)
    return raw.where(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"))


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType,
                   header: bool = True) -> DataFrame:
    """A query result saved as CSV, with columns taken by position (D-23)."""
    df = spark.read.option("header", header).option("inferSchema", False).csv(path)
    df = df.toDF(*[f.name for f in schema.fields])
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def read_docs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A document collection exported as JSON lines, projected to ``schema``."""
    return spark.read.schema(schema).json(path)


def sql_query(spark: SparkSession, text: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run Spark SQL with named parameter markers (``:day``) bound from
    ``params`` and DataFrames referenced as ``{name}``. Values are bound as
    typed literals, never pasted into the text."""
    return spark.sql(text, args=params or {}, **frames)
