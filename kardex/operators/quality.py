"""Data-quality checks (DQ1-DQ13) as distributed aggregates.

Each check returns a small DataFrame (usually one row) of violation counts or measures, so it runs
as one scan with map-side partial aggregation; ``assert_*`` helpers turn a result into an error
at the job edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row, ``<col>_nulls`` per column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"{c}_nulls") for c in cols])


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Schema check: required columns absent from ``df`` (no job)."""
    return [c for c in required if c not in df.columns]


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values present more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, distinct keys, keys seen more than once, null keys."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return per_key.agg(
        F.sum("n").cast("bigint").alias("filas"),
        F.count(F.lit(1)).cast("bigint").alias("claves_distintas"),
        F.count_if(F.col("n") > 1).cast("bigint").alias("claves_duplicadas"),
        F.coalesce(F.sum(F.when(null_key, F.col("n"))), F.lit(0)).cast("bigint").alias("filas_clave_nula"),
    )


def orphan_keys(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct non-null child keys with no parent row (referential integrity)."""
    c = child.select(*keys).where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).distinct()
    return c.join(parent.select(*keys).distinct(), keys, "left_anti")


def coverage(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """Share of rows where ``col`` is not null."""
    return df.agg(F.avg(F.col(col).isNotNull().cast("double")).alias(alias or f"{col}_coverage"))


def max_abs_diff(df: DataFrame, a, b, alias: str = "max_abs_diff") -> DataFrame:
    """Largest |a - b| over the rows where both are present (reconciliation)."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return df.agg(F.max(F.abs(ca.cast("double") - cb.cast("double"))).alias(alias))


def count_violations(df: DataFrame, checks: dict[str, F.Column]) -> DataFrame:
    """One row with the number of rows failing each named condition (null counts as failing)."""
    return df.agg(*[F.count_if(~F.coalesce(cond, F.lit(False))).cast("bigint").alias(name)
                    for name, cond in checks.items()])


def unsorted_rows(df: DataFrame, order_col: str, descending: bool = False) -> DataFrame:
    """Rows whose successor breaks the order of ``order_col`` (sortedness of an ordered result).

    Rows are numbered in the frame's own order (partition order, then row order, which a global
    sort defines) with the distributed sequence numbering, and each row is joined to the next:
    no window over the whole result, so a large ordered result is checked in parallel.
    """
    from kardex.functions.joins import sequence_number
    from kardex.sinks.staging import stage_shared

    # staged: the row ids follow from one evaluation of the frame
    rows = stage_shared(df.select(F.col(order_col).alias("_v"), F.monotonically_increasing_id().alias("_mid")), "ordered")
    numbered = sequence_number(rows, "_mid", "_i")
    nxt = numbered.select((F.col("_i") - 1).alias("_i"), F.col("_v").alias("_next"))
    pairs = numbered.join(nxt, "_i")
    bad = (F.col("_next") > F.col("_v")) if descending else (F.col("_next") < F.col("_v"))
    return pairs.where(bad).select(F.col("_i").alias("posicion"), F.col("_v").alias(order_col),
                                   F.col("_next").alias("siguiente"))


def distinct_per_group(df: DataFrame, group: str, col: str) -> DataFrame:
    """Groups in which ``col`` takes more than one value."""
    return df.groupBy(group).agg(F.count_distinct(col).alias("n")).where(F.col("n") > 1)


def sales_volume_metrics() -> dict[str, F.Column]:
    """DQ12 for the sales fact: rows per channel, credit rows, rows without cost, unmapped web SKUs."""
    return {
        "fisico": F.count_if(F.col("canal") == "fisico"),
        "ecommerce": F.count_if(F.col("canal") == "ecommerce"),
        "creditos": F.count_if((F.col("canal") == "fisico") & (F.col("monto_mxn") < 0)),
        "sin_costo": F.count_if(F.col("costo_mxn").isNull()),
        "ec_unmapped": F.count_if(F.col("sku_pos").startswith("EC-UNMAPPED")),
    }


def inventory_volume_metrics() -> dict[str, F.Column]:
    """DQ12 for the inventory fact: snapshots without product id / POS SKU."""
    return {"sin_product_id": F.count_if(F.col("product_id").isNull()),
            "sin_sku_pos": F.count_if(F.col("sku_pos").isNull())}


def observe_volumes(df: DataFrame, name: str, metrics: dict[str, F.Column]) -> tuple[DataFrame, Observation]:
    """Attach volume metrics computed while the frame is written or counted (no extra scan)."""
    obs = Observation(name)
    return df.observe(obs, *[m.alias(k) for k, m in metrics.items()]), obs


def assert_zero(row_df: DataFrame, what: str) -> None:
    """Raise when any count in a one-row check result is non-zero."""
    row = row_df.first().asDict()
    bad = {k: v for k, v in row.items() if v}
    if bad:
        raise AssertionError(f"{what}: {bad}")
