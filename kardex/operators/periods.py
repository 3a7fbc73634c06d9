"""Monthly sales by channel, period-over-period change (OP11) and channel share (OP12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kardex.functions.dates import days_in_month, in_day_range, month_start, year_month
from kardex.functions.numeric import round_double, round_money, safe_div
from kardex.operators.conform import ONLINE, PHYSICAL

MOM_COLUMNS = ["mes", "canal", "dias_en_mes", "venta_mxn", "venta_diaria_promedio", "variacion_pct_mom",
               "share_ecommerce_pct"]


def monthly_sales(fact_ventas: DataFrame, start=None, end=None, inclusive_end_day: bool = True) -> DataFrame:
    """(month, channel) sales and day-normalised sales; months are DATE (first day)."""
    f = fact_ventas.where(in_day_range("fecha", start, end, inclusive_end_day))
    m = f.groupBy(month_start("fecha").alias("mes"), "canal").agg(F.sum("monto_mxn").alias("_s"))
    m = m.withColumn("dias_en_mes", days_in_month("mes"))
    return m.select("mes", "canal", "dias_en_mes",
                    round_money("_s", 2).alias("venta_mxn"),
                    round_double(F.col("_s").cast("double") / F.col("dias_en_mes"), 2).alias("venta_diaria_promedio"))


def month_over_month(fact_ventas: DataFrame, start=None, end=None, inclusive_end_day: bool = True) -> DataFrame:
    """MoM % of the daily average (previous row of the channel, not the previous calendar
    month) and the online share of each month, computed from the rounded monthly values."""
    m = monthly_sales(fact_ventas, start, end, inclusive_end_day)
    prev = F.lag("venta_diaria_promedio").over(Window.partitionBy("canal").orderBy("mes"))
    m = m.withColumn("_prev", prev)
    m = m.withColumn("variacion_pct_mom",
                     round_double(safe_div(F.col("venta_diaria_promedio") - F.col("_prev"), F.col("_prev")) * F.lit(100.0), 2))
    by_month = Window.partitionBy("mes")
    fis = F.max(F.when(F.col("canal") == PHYSICAL, F.col("venta_mxn"))).over(by_month)
    ecom = F.max(F.when(F.col("canal") == ONLINE, F.col("venta_mxn"))).over(by_month)
    share = safe_div(F.coalesce(ecom, F.lit(0.0)), F.coalesce(fis, F.lit(0.0)) + F.coalesce(ecom, F.lit(0.0))) * F.lit(100.0)
    m = m.withColumn("share_ecommerce_pct", round_double(share, 2))
    return m.select(year_month("mes").alias("mes"), "canal", "dias_en_mes", "venta_mxn", "venta_diaria_promedio",
                    "variacion_pct_mom", "share_ecommerce_pct").orderBy("mes", "canal")


def last_months_by_channel(mom: DataFrame, n: int = 3) -> DataFrame:
    """Last ``n`` months of each channel (dashboard feed)."""
    w = Window.partitionBy("canal").orderBy(F.col("mes").desc())
    return mom.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn").orderBy("canal", "mes")


def monthly_share(mom: DataFrame) -> DataFrame:
    """One online-share value per month (dashboard feed)."""
    return mom.select("mes", "share_ecommerce_pct").dropDuplicates().orderBy("mes")


def channel_share(fact_ventas: DataFrame, start=None, end=None, inclusive_end_day: bool = True) -> DataFrame:
    """One row per month: physical and online sales side by side (pivot with fixed values, 0
    when a channel has no sales) and the online share of the month (OP12)."""
    m = monthly_sales(fact_ventas, start, end, inclusive_end_day)
    p = m.groupBy("mes").pivot("canal", [PHYSICAL, ONLINE]).agg(F.max("venta_mxn"))
    fis = F.coalesce(F.col(PHYSICAL), F.lit(0.0))
    ecom = F.coalesce(F.col(ONLINE), F.lit(0.0))
    return p.select(year_month("mes").alias("mes"), fis.alias("venta_fisico"), ecom.alias("venta_ecommerce"),
                    round_double(safe_div(ecom, fis + ecom) * F.lit(100.0), 2).alias("share_ecommerce_pct"))
