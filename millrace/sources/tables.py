"""Stored tables: reading, writing, profiling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    format: str = "parquet",
    partition_by: list[str] | None = None,
) -> None:
    """Write as parquet, csv with a header, or tab-separated text.

    ``text`` joins the columns of each row with tabs, as key/count listings are kept.
    """
    if format == "text":
        df = df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns]).alias("value"))
    writer = df.write.mode(mode).format(format)
    if format == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def first_n(df: DataFrame, n: int, order: list[str | Column]) -> DataFrame:
    """The first ``n`` rows in an order that should name a unique key last."""
    return df.orderBy(*order).limit(n)


def profile(dfs: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns, and the columns' names and types of each dataset."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("dataset"),
            "n_rows",
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
            F.lit(", ".join(f"{c} {kind}" for c, kind in df.dtypes)).alias("columns"),
        )
        for name, df in dfs.items()
    ]
    return reduce(DataFrame.unionByName, rows)
