"""Unnesting of nested documents (SRC5, SRC6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.functions.numeric import MONEY


def unnest_array(df: DataFrame, array_col: str) -> DataFrame:
    """Top-level array of structs -> one row per element, struct fields as columns."""
    return df.select(F.explode(array_col).alias("_e")).select("_e.*")


def unnest_cost_history(products: DataFrame) -> DataFrame:
    """products[] x cost_history[] -> one row per effective cost.

    Inner explode: a product without history yields no rows. ``pos`` keeps the element order of
    the history array and breaks ties between costs that share an effective date (later wins).
    Costs are parsed strictly: text that is not a number fails the job (ANSI cast).
    """
    rows = products.select("sku_erp", "nombre", "categoria",
                           F.posexplode("cost_history").alias("pos", "h"))
    return rows.select(
        "sku_erp", "nombre", "categoria",
        F.to_date("h.fecha_vigencia").alias("fecha_vigencia"),
        F.col("h.costo_mxn").cast(MONEY).alias("costo_mxn"),
        F.col("h.proveedor").alias("proveedor"),
        F.col("pos").cast("int").alias("pos"),
    )
