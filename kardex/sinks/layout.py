"""Access paths for several columns (SNK6): a table sorted along a space-filling curve.

Each column is cut into ``2 ** bits`` ranges of about as many rows, and the bits of the range numbers
are interleaved. Rows that are near in all columns get near numbers, so a file, and each row group
in it, covers a small box: a filter on any one of the columns skips most of them by min/max
statistics, where a plain sort serves its first column alone. Bloom filters on id columns let a
point query skip row groups whose range holds the id by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8
# One row in so many, by hash, is looked at for the cuts of a column.
SAMPLE_ROWS = 200_000


def cuts(df: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list]:
    """Per column at most ``2 ** bits`` - 1 ascending cuts at equal shares of its rows, from a sample
    of about ``SAMPLE_ROWS`` rows by hash. The driver holds the cuts; a sample row is counted, not kept."""
    n = df.count()
    every = max(1, n // SAMPLE_ROWS)
    sample = df.where(F.pmod(F.xxhash64(*columns), F.lit(every)) == 0) if every > 1 else df
    out = {}
    for c in columns:
        per_value = sample.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        # at most SAMPLE_ROWS values; weights keep a frequent value from taking several cuts
        rows = sorted((r["v"], r["n"]) for r in per_value.collect())
        total, seen, found, last = sum(k for _, k in rows), 0, [], 0
        for v, k in rows:
            share = (seen << bits) // max(1, total)  # the range in which the value's rows begin
            if share > last:
                found.append(v)
                last = share
            seen += k
        out[c] = found
    return out


def range_number(col: str, bounds: list, kind: T.DataType) -> Column:
    """How many of the bounds are at most the value (0 for null)."""
    if not bounds:
        return F.lit(0)
    edges = F.array(*[F.lit(b).cast(kind) for b in bounds])
    return F.coalesce(F.size(F.filter(edges, lambda b: b <= F.col(col))), F.lit(0))


def curve(df: DataFrame, bounds: dict[str, list], bits: int = BITS) -> Column:
    """The place of a row on the curve: interleaved bits of its range numbers."""
    place = F.lit(0).cast("long")
    columns = list(bounds)
    for j, c in enumerate(columns):
        number = range_number(c, bounds[c], df.schema[c].dataType).cast("long")
        for i in range(bits):
            place = place + F.shiftleft(F.shiftright(number, i).bitwiseAND(F.lit(1).cast("long")), i * len(columns) + j)
    return place


def write_clustered(df: DataFrame, path: str, columns: list[str], bloom: list[str] = (), files: int | None = None,
                    row_group_bytes: int | None = None, bits: int = BITS, mode: str = "overwrite") -> None:
    """Write ``df`` as parquet along the curve over ``columns``, with bloom filters on ``bloom``."""
    place = curve(df, cuts(df, columns, bits), bits)
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.withColumn("_place", place).repartitionByRange(n, "_place", *columns).sortWithinPartitions("_place", *columns).drop("_place")
    w = out.write.mode(mode)
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if row_group_bytes:
        w = w.option("parquet.block.size", str(row_group_bytes)).option("parquet.page.size", str(max(1024, row_group_bytes // 8)))
    w.parquet(path)
