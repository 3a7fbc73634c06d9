"""The star-schema model: sources -> dim_producto, fact_ventas (with cost and margin),
dim_tiendas, fact_inventario, dim_catalogo.

Dimensions and small reference tables feed several joins each, so ``build_model`` passes them
through a ``stage`` function that materialises them once: persisted (default; lost blocks are
recomputed from lineage) or written as tables (the batch job). Materialised inputs carry their real size, so the planner's broadcast decision
(``spark.sql.autoBroadcastJoinThreshold``, re-checked by AQE at runtime) is a measured size check,
with a sort-merge join beyond it.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kardex.operators.asof import build_fact_ventas_con_costo
from kardex.operators.conform import (build_dim_tiendas, build_fact_inventario, build_fact_ventas, transform_ecommerce,
                                      transform_sales)
from kardex.operators.identity import build_dim_producto
from kardex.operators.margin import MAX_ROWS_PER_SKU

Stage = Callable[[DataFrame, str], DataFrame]


class Model(NamedTuple):
    fact_ventas: DataFrame
    fact_inventario: DataFrame
    dim_producto: DataFrame
    dim_tiendas: DataFrame
    dim_catalogo: DataFrame


def cache_stage(df: DataFrame, name: str) -> DataFrame:
    df.sparkSession.sparkContext.setJobDescription(f"stage {name}")
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    df.sparkSession.sparkContext.setJobDescription(None)
    return df


class Caches:
    """A stage function that persists, and remembers what to free."""

    def __init__(self):
        self.held: list[DataFrame] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        df = cache_stage(df, name)
        self.held.append(df)
        return df

    def release(self) -> None:
        while self.held:
            self.held.pop().unpersist()


def no_stage(df: DataFrame, name: str) -> DataFrame:
    return df


def stage_all(stage: Stage, frames: dict[str, DataFrame], pool=None) -> dict[str, DataFrame]:
    """Stage independent frames; with a thread pool their jobs are submitted concurrently and
    the scheduler interleaves their tasks (stages of small tables leave most cores idle alone)."""
    if pool is None:
        return {k: stage(v, k) for k, v in frames.items()}
    futures = {k: pool.submit(stage, v, k) for k, v in frames.items()}
    return {k: f.result() for k, f in futures.items()}


# Sales rows that one task takes where facts are laid by SKU, and the rows below which adaptive execution sizes the tasks.
ROWS_PER_TASK = 250_000
LAID_FROM_ROWS = 1_000_000


def sku_partitions(raw, rows_per_task: int = ROWS_PER_TASK, laid_from: int = LAID_FROM_ROWS,
                   max_rows: int = MAX_ROWS_PER_SKU) -> int | None:
    """Partitions for sales facts that are laid by SKU (one count per SKU and handle over the raw sales, two scalars
    to the driver). Adaptive execution sizes partitions by their compressed bytes, of which sums per SKU take many times as
    much memory; a count of rows bounds a task. None for few sales, and if a SKU or handle is so hot that one
    task should not hold its rows."""
    keys = raw.sales.select(F.xxhash64("sku").alias("clave")).unionByName(raw.ecommerce.select(F.xxhash64("product_handle").alias("clave")))
    found = keys.groupBy("clave").count().agg(F.sum("count").alias("rows"), F.max("count").alias("hottest")).first()
    rows, hottest = found["rows"] or 0, found["hottest"] or 0
    return None if hottest > max_rows else row_partitions(raw.sales.sparkSession, rows, rows_per_task, laid_from)


def row_partitions(spark: SparkSession, rows: int, rows_per_task: int = ROWS_PER_TASK, laid_from: int = LAID_FROM_ROWS) -> int | None:
    """Partitions for ``rows`` rows, never fewer than the session's; None for few rows."""
    if rows <= laid_from:
        return None
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


def build_model(raw, stage: Stage = cache_stage, pool=None, sku_parts: int | None = None) -> Model:
    """``raw`` has the seven sources (sales, tiendas, sku_map, catalogo, snapshots, ecommerce,
    exchange_rates) as attributes. The product dimension comes first: every fact keys on it.
    The facts are returned lazily; the caller stages or writes them. ``sku_parts`` lays the sales fact by SKU
    in so many partitions before it meets the cost histories, for answers that add up per SKU."""
    ref = stage_all(stage, {"dim_catalogo": raw.catalogo, "dim_tiendas": build_dim_tiendas(raw.tiendas)}, pool)
    catalogo, dim_tiendas = ref["dim_catalogo"], ref["dim_tiendas"]
    rates = raw.exchange_rates  # one consumer: planned inline, broadcast by its measured size
    dim_producto = stage(build_dim_producto(raw.sku_map, catalogo, raw.ecommerce, raw.sales), "dim_producto")
    sales_norm = transform_sales(raw.sales)
    ecom_norm = transform_ecommerce(raw.ecommerce, dim_producto, rates)
    fact = build_fact_ventas(sales_norm, ecom_norm)
    fact_costo = build_fact_ventas_con_costo(fact, catalogo, dim_producto, parts=sku_parts)
    return Model(
        fact_ventas=fact_costo,
        fact_inventario=build_fact_inventario(raw.snapshots, dim_producto),
        dim_producto=dim_producto,
        dim_tiendas=dim_tiendas,
        dim_catalogo=catalogo,
    )
