"""Mergeable KPI states (AG4, AG5, OP18): per day, so that the KPIs of any period are a merge.

Counts and sums add up; distinct counts do not, so a day keeps the exact set of its stores and SKUs as bitmaps.
Codes get dense numbers from a dictionary, a bitmap covers 32,768 of them, and a set is as many
(bucket, bitmap) rows as it has buckets. Bitmaps are merged by OR and counted; nothing is estimated.
States of new days are appended, and old ones never change.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.functions.dates import date_between
from kardex.functions.joins import sequence_number
from kardex.functions.numeric import round_money
from kardex.operators.conform import ONLINE, PHYSICAL

STORE, SKU = "tienda", "sku"


class KpiStates(NamedTuple):
    totals: DataFrame  # dia, canal, filas, monto_mxn
    sets: DataFrame  # dia, conjunto, cubeta, mapa


def code_numbers(fact_ventas: DataFrame) -> DataFrame:
    """(conjunto, codigo, numero): dense numbers of the physical stores and of the SKUs."""
    kinds = F.array(F.struct(F.lit(STORE).alias("conjunto"), F.when(F.col("canal") == PHYSICAL, F.col("tienda_id")).alias("codigo")),
                    F.struct(F.lit(SKU).alias("conjunto"), F.col("sku_pos").alias("codigo")))
    codes = fact_ventas.select(F.inline(kinds)).where(F.col("codigo").isNotNull()).distinct()
    return sequence_number(codes, "codigo", "numero", group_col="conjunto")


def daily_states(fact_ventas: DataFrame, numbers: DataFrame) -> KpiStates:
    """The states of every day. A code is numbered once per day, not once per sale."""
    day = F.to_date("fecha").alias("dia")
    totals = fact_ventas.groupBy(day, "canal").agg(F.count(F.lit(1)).alias("filas"), F.sum("monto_mxn").alias("monto_mxn"))
    kinds = F.array(F.struct(F.lit(STORE).alias("conjunto"), F.when(F.col("canal") == PHYSICAL, F.col("tienda_id")).alias("codigo")),
                    F.struct(F.lit(SKU).alias("conjunto"), F.col("sku_pos").alias("codigo")))
    seen = fact_ventas.select(day, F.inline(kinds)).where(F.col("codigo").isNotNull()).distinct()
    placed = seen.join(numbers, ["conjunto", "codigo"])
    sets = placed.groupBy("dia", "conjunto", F.bitmap_bucket_number("numero").alias("cubeta")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("numero")).alias("mapa"))
    return KpiStates(totals, sets)


def kpis_of(states: KpiStates, start=None, end=None) -> DataFrame:
    """The executive KPIs of the days [start, end], from states alone: one row."""
    t = states.totals.where(date_between("dia", start, end)).agg(
        round_money(F.sum("monto_mxn")).alias("total_ventas_mxn"),
        round_money(F.sum(F.when(F.col("canal") == PHYSICAL, F.col("monto_mxn")))).alias("ventas_fisicas_mxn"),
        round_money(F.sum(F.when(F.col("canal") == ONLINE, F.col("monto_mxn")))).alias("ventas_ecommerce_mxn"),
        F.coalesce(F.sum("filas"), F.lit(0)).cast("bigint").alias("total_transacciones"))
    merged = states.sets.where(date_between("dia", start, end)).groupBy("conjunto", "cubeta").agg(F.bitmap_count(F.bitmap_or_agg("mapa")).alias("n"))
    count = lambda kind: F.coalesce(F.sum(F.when(F.col("conjunto") == kind, F.col("n"))), F.lit(0)).cast("bigint")
    d = merged.agg(count(STORE).alias("tiendas_activas"), count(SKU).alias("skus_activos"))
    return t.join(d)  # one row each
