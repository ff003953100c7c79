"""Readers for the parquet tables. Callers name the columns they need so the
scan's ReadSchema holds only those."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


def jdbc_table(spark: SparkSession, url: str, table: str, *cols: str,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None,
               **props: str) -> DataFrame:
    """A database table (e.g. an archive of fixes) through JDBC. Filters and
    the column list are pushed into the database query by Spark; with a
    numeric ``partition_column`` and bounds the read runs as
    ``num_partitions`` parallel range queries instead of one. Needs the
    database's JDBC driver on the classpath."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    for k, v in props.items():
        r = r.option(k, v)
    df = r.load()
    return df.select(*cols) if cols else df
