"""Staging in the shared folder: tables that cut lineage and outlive executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from kardex.session import ensure_checkpoint_dir


def stage_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_laid(df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
    """Write ``df`` below the shared folder in ``parts`` buckets of ``key``, one file each, and read it back: whoever
    groups or joins by the key finds the rows in place, as often as they are read, without a shuffle. Buckets need a
    table; it is an external one under a name of its own, whose entry goes once it is read (the files stay)."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}"
    df.repartition(parts, key).write.format("parquet").bucketBy(parts, key).sortBy(key).option("path", path).saveAsTable(table)
    laid = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return laid
