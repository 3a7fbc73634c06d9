"""Executive KPIs (OP18): six figures from one scan of the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.functions.numeric import round_money
from kardex.operators.conform import ONLINE, PHYSICAL

KPI_COLUMNS = ["total_ventas_mxn", "ventas_fisicas_mxn", "ventas_ecommerce_mxn", "total_transacciones",
               "tiendas_activas", "skus_activos"]


def executive_kpis(fact_ventas: DataFrame) -> DataFrame:
    """One row: total / physical / online sales, rows, active physical stores, active SKUs."""
    is_phys = F.col("canal") == PHYSICAL
    return fact_ventas.agg(
        round_money(F.sum("monto_mxn")).alias("total_ventas_mxn"),
        round_money(F.sum(F.when(is_phys, F.col("monto_mxn")))).alias("ventas_fisicas_mxn"),
        round_money(F.sum(F.when(F.col("canal") == ONLINE, F.col("monto_mxn")))).alias("ventas_ecommerce_mxn"),
        F.count(F.lit(1)).cast("bigint").alias("total_transacciones"),
        F.count_distinct(F.when(is_phys, F.col("tienda_id"))).cast("bigint").alias("tiendas_activas"),
        F.count_distinct("sku_pos").cast("bigint").alias("skus_activos"),
    )


MONEY_KPIS = ["total_ventas_mxn", "ventas_fisicas_mxn", "ventas_ecommerce_mxn"]


def kpi_report(kpis: DataFrame) -> DataFrame:
    """Display rows (kpi, valor, texto) for a report: money as '$1,234 MXN', counts as '1,234'.
    Formatting belongs at the job edge; the numbers stay in ``valor``."""
    long = kpis.select(*[F.col(c).cast("double").alias(c) for c in KPI_COLUMNS]).unpivot(
        [], KPI_COLUMNS, "kpi", "valor")
    money = F.concat(F.lit("$"), F.format_number("valor", 0), F.lit(" MXN"))
    return long.select("kpi", "valor", F.when(F.col("kpi").isin(MONEY_KPIS), money)
                       .otherwise(F.format_number("valor", 0)).alias("texto"))


def dashboard_totals(fact_ventas: DataFrame) -> DataFrame:
    """Dashboard header (OP20): total sales, transactions and number of channels, one scan."""
    return fact_ventas.agg(
        round_money(F.sum("monto_mxn")).alias("ventas_totales_mxn"),
        F.count(F.lit(1)).cast("bigint").alias("transacciones"),
        F.count_distinct("canal").cast("bigint").alias("canales"),
    )
