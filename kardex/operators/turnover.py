"""Inventory turnover top-k (OP8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.functions.dates import date_between, in_day_range
from kardex.functions.numeric import round_double
from kardex.operators.conform import ONLINE, PHYSICAL

TURNOVER_COLUMNS = ["sku_pos", "nombre", "categoria", "unidades_fisico", "unidades_ecommerce", "unidades_totales",
                    "stock_promedio", "rotacion_fisica", "rotacion_extendida", "pct_ventas_con_inventario"]


def units_by_sku(fact_ventas: DataFrame, start=None, end=None, exclude_prefix: str = "EC-UNMAPPED") -> DataFrame:
    """Units per SKU in the period, total and split by channel (0 when a channel has none)."""
    v = fact_ventas.where(F.col("sku_pos").isNotNull() & ~F.col("sku_pos").startswith(exclude_prefix)
                          & in_day_range("fecha", start, end))
    return v.groupBy("sku_pos", "nombre", "categoria").agg(
        F.sum("cantidad").alias("unidades_totales"),
        F.sum(F.when(F.col("canal") == PHYSICAL, F.col("cantidad")).otherwise(F.lit(0))).alias("unidades_fisico"),
        F.sum(F.when(F.col("canal") == ONLINE, F.col("cantidad")).otherwise(F.lit(0))).alias("unidades_ecommerce"),
    )


def average_stock(fact_inventario: DataFrame, start=None, end=None) -> DataFrame:
    """Mean snapshot stock per SKU over store-days, rounded to 2 places."""
    s = fact_inventario.where(F.col("sku_pos").isNotNull() & date_between("fecha", start, end))
    return s.groupBy("sku_pos").agg(round_double(F.avg("cantidad_en_stock"), 2).alias("stock_promedio"))


def turnover(fact_ventas: DataFrame, fact_inventario: DataFrame, start=None, end=None) -> DataFrame:
    """All SKUs with a defined extended turnover (SKUs without stock drop out)."""
    units = units_by_sku(fact_ventas, start, end)
    stock = average_stock(fact_inventario, start, end)
    r = units.join(stock, "sku_pos", "left")
    stock_or_0 = F.coalesce(F.col("stock_promedio"), F.lit(0.0))
    per_stock = lambda c: F.when(stock_or_0 == 0, F.lit(None).cast("double")).otherwise(
        round_double(F.col(c).cast("double") / F.col("stock_promedio"), 2))
    r = r.select(
        "sku_pos", "nombre", "categoria",
        F.col("unidades_fisico").cast("bigint").alias("unidades_fisico"),
        F.col("unidades_ecommerce").cast("bigint").alias("unidades_ecommerce"),
        F.col("unidades_totales").cast("bigint").alias("unidades_totales"),
        stock_or_0.alias("stock_promedio"),
        per_stock("unidades_fisico").alias("rotacion_fisica"),
        per_stock("unidades_totales").alias("rotacion_extendida"),
        F.when(F.col("unidades_totales") == 0, F.lit(None).cast("double")).otherwise(
            round_double(F.col("unidades_fisico").cast("double") * F.lit(100.0) / F.col("unidades_totales").cast("double"), 1)
        ).alias("pct_ventas_con_inventario"),
    )
    return r.where(F.col("rotacion_extendida").isNotNull())


def turnover_top(fact_ventas: DataFrame, fact_inventario: DataFrame, start=None, end=None, k: int = 10) -> DataFrame:
    """Top-k SKUs by extended turnover (ties broken by SKU). Planned as a per-partition top-k."""
    return turnover(fact_ventas, fact_inventario, start, end).orderBy(
        F.col("rotacion_extendida").desc_nulls_last(), F.col("sku_pos").asc_nulls_last()).limit(k)
