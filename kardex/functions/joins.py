"""Join helpers: size-checked broadcast, unique lookups and distributed sequence numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows a dimension may have and still be shipped to every executor. At ~100 bytes a row this is
# a few hundred MB at most; anything larger takes the shuffle join (with AQE skew splitting).
DEFAULT_BROADCAST_ROWS = 2_000_000


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Reads at most ``max_rows + 1`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a measured size bound; otherwise the plain (shuffle-joined) frame."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def unique_lookup(df: DataFrame, key: str, cols: list[str], on_duplicate: str = "raise",
                  order_col: str | None = None) -> DataFrame:
    """One row per non-null ``key`` with the value columns ``cols``.

    on_duplicate:
      * "raise": a duplicate key fails the job (``raise_error`` inside the plan), like a
        dictionary built from a frame whose index must be unique.
      * "last":  keep the row with the greatest ``order_col`` (or greatest values) per key.
    """
    base = df.where(F.col(key).isNotNull())
    if on_duplicate == "raise":
        agg = base.groupBy(key).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.first(c).alias(c) for c in cols],
        )
        # the guard sits on the key: every join reads it, so column pruning cannot drop the check
        guarded_key = F.when(F.col("_n") > 1, F.raise_error(
            F.concat(F.lit(f"duplicate lookup key {key}="), F.col(key).cast("string")))).otherwise(F.col(key))
        return agg.select(guarded_key.alias(key), *[F.col(c) for c in cols])
    if on_duplicate == "last":
        order = F.col(order_col) if order_col else F.struct(*[F.col(c) for c in cols])
        picked = base.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_v"))
        return picked.select(key, *[F.col("_v." + c).alias(c) for c in cols])
    raise ValueError(f"unknown on_duplicate={on_duplicate!r}")


# One value in so many is a splitter of the numbering: the average size of a bucket.
SPLIT_EVERY = 65_536


def sequence_number(df: DataFrame, order_col: str, out_col: str = "seq", group_col: str | None = None,
                    every: int = SPLIT_EVERY) -> DataFrame:
    """1-based position of each row in ``order_col`` order (restarting per ``group_col`` when
    given), without a one-partition window, a job while planning, or anything persisted.

    Splitters are the values whose hash is divisible by ``every``: a pure function of the values, so every
    evaluation of the plan, also after the loss of an executor, cuts the same buckets. A row's
    number is the count of rows of its group in earlier buckets plus its position inside its own.
    Splitters and counts have one row per (group, bucket) or less, a ``every``-th of the rows, so they
    are broadcast with a proven bound. Meant for distinct sets.
    """
    group = F.col(group_col) if group_col else F.lit(0)
    rows = df.withColumn("_g", group)
    chosen = rows.where(F.pmod(F.xxhash64(order_col), F.lit(every)) == 0)
    splits = chosen.groupBy(F.col("_g").alias("_sg")).agg(F.sort_array(F.collect_set(order_col)).alias("_splits"))
    rows = rows.join(F.broadcast(splits), F.col("_g").eqNullSafe(F.col("_sg")), "left")
    bucket = F.coalesce(F.size(F.filter("_splits", lambda s: s <= F.col(order_col))), F.lit(0))
    rows = rows.withColumn("_bucket", bucket).drop("_sg", "_splits")
    counts = rows.groupBy(F.col("_g").alias("_cg"), F.col("_bucket").alias("_cb")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_cg").orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_cg", "_cb", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    out = rows.join(F.broadcast(offsets), F.col("_g").eqNullSafe(F.col("_cg")) & (F.col("_bucket") == F.col("_cb")))
    own = F.row_number().over(Window.partitionBy("_g", "_bucket").orderBy(order_col))
    return out.withColumn(out_col, (F.col("_before") + own).cast("bigint")).drop("_g", "_bucket", "_cg", "_cb", "_before")
