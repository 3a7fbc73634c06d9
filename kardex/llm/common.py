"""Helpers of the operators: staging in the shared folder, range buckets, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.session import ensure_checkpoint_dir

# Java and Python both read this as: one or more code points that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, lost executors don't
    cost a recomputation, and the table's size is known to the planner."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` at most (one row at least),
    which bounds the working memory of a task whatever the batch size of the session."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def range_bounds(df: DataFrame, key: str, buckets: int) -> list:
    """Approximate quantiles of a numeric key: at most ``buckets`` - 1 ascending bounds (a driver
    value of documented size), from a scan of the key column alone."""
    buckets = max(1, min(buckets, MAX_BUCKETS))
    if buckets == 1:
        return []
    fractions = [i / buckets for i in range(1, buckets)]
    got = df.agg(F.percentile_approx(F.col(key), fractions, max(10_000, 20 * buckets)).alias("q")).first()
    return sorted(set(got["q"] or []))


# Upper bound of the number of range buckets, so of the bounds that the driver holds.
MAX_BUCKETS = 10_000


def bucket_of(key: str, bounds: list) -> Column:
    """Range bucket of ``key`` (0 for null): how many bounds are <= key, by binary search."""
    edges = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def bucket(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, values.to_numpy(np.int64), side="right").astype(np.int32))

    return bucket(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long")))


def with_fields(df: DataFrame, keep: tuple[str, ...], ddl: str) -> T.StructType:
    """The fields of the ``keep`` columns, then those of ``ddl``."""
    return T.StructType([*df.select(*keep).schema.fields, *T.StructType.fromDDL(ddl).fields])
