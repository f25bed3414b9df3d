"""Reading and writing layer tables through the session catalog."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_optional_table(
    spark: SparkSession, table: str, required: list[str] = (), order_by: list[str] = ()
) -> DataFrame | None:
    """The table, or None when it is absent or lacks a required column.

    Ordered by those of `order_by` that exist.
    """
    if not spark.catalog.tableExists(table):
        return None
    df = spark.table(table)
    if set(required) - set(df.columns):
        return None
    present = [column for column in order_by if column in df.columns]
    return df.orderBy(*present) if present else df


FILE_ORDER = ["file_path", "row_index"]


def in_file_order(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files with the place of each row, by which "the first" of equal rows is defined."""
    return spark.read.parquet(*paths).selectExpr("*", *[f"_metadata.{name} as {name}" for name in FILE_ORDER])


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace the rows and keep the table's schema; creates the table when absent."""
    if df.sparkSession.catalog.tableExists(table):
        columns = df.sparkSession.table(table).columns
        df.select(*columns).write.insertInto(table, overwrite=True)
    else:
        df.write.saveAsTable(table)


def replace_table(df: DataFrame, table: str) -> None:
    """Replace rows and schema together."""
    df.write.mode("overwrite").saveAsTable(table)


@contextmanager
def _own_partitions(spark: SparkSession) -> Iterator[None]:
    """While it lasts, an overwrite replaces the partitions that it writes and no others."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_run(df: DataFrame, table: str) -> bool:
    """Store one run's rows, partitioned by run; False when there were none.

    Rows of other runs stay. A run that is stored again, as after a lost answer, replaces its own rows.
    The rows are counted while they are written, so the plan runs once.
    """
    seen, spark = Observation(), df.sparkSession
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if spark.catalog.tableExists(table):
        with _own_partitions(spark):
            counted.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    else:
        counted.write.partitionBy("run_id").saveAsTable(table)
    return seen.get["rows"] > 0


def materialize(df: DataFrame, layer: str, name: str, as_view: bool = False) -> DataFrame:
    """Publish a model of a layer: staging as a view, later layers as a stored table."""
    spark = df.sparkSession
    if as_view:
        df.createOrReplaceTempView(f"{layer}_{name}")
        return spark.table(f"{layer}_{name}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    replace_table(df, f"{layer}.{name}")
    return spark.table(f"{layer}.{name}")
