"""Shared scratch folder and written intermediate tables.

An intermediate result that is read more than once, or that grows the plan round
by round, is written as parquet into the folder the cluster names in
``spark.checkpoint.dir``. The written table cuts the lineage, survives the loss
of any executor, and has a known size, so the planner can decide about
broadcasting it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local sessions."""
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):  # local-cluster has executors
            raise RuntimeError(f"set {_SETTING} to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="millrace-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)  # where the solvers of Spark ML cut their lineage
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/millrace-{app}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table", group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    Readers and writers hold a row group at a time, of ``group_bytes`` or one row: for rows that are large themselves.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if group_bytes:
        writer = writer.options(**{"parquet.block.size": group_bytes, **{f"parquet.page.size.row.check.{x}": 1 for x in ("min", "max")}})
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
