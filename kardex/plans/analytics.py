"""The four business questions and the KPIs over a model, with their periods as parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from kardex.operators.islands import stockouts
from kardex.operators.kpis import dashboard_totals, executive_kpis
from kardex.operators.margin import MarginReport, negative_margin
from kardex.operators.periods import channel_share, last_months_by_channel, month_over_month
from kardex.operators.turnover import turnover_top


@dataclass(frozen=True)
class Periods:
    """Inclusive day ranges; None = open end (whole table)."""
    turnover: tuple = (None, None)
    stockout: tuple = (None, None)
    monthly: tuple = (None, None)
    top_k: int = 10
    min_run_days: int = 3
    lookback_days: int = 14
    inclusive_end_day: bool = True


def direct_results(model, periods: Periods = Periods(), lookback_sales: DataFrame | None = None) -> dict[str, DataFrame]:
    """The results that need no margin aggregates, as lazy frames keyed by question."""
    sales = lookback_sales if lookback_sales is not None else model.fact_ventas
    return {
        "q1_rotacion": turnover_top(model.fact_ventas, model.fact_inventario, *periods.turnover, k=periods.top_k),
        "q2_quiebres": stockouts(model.fact_inventario, sales, model.dim_tiendas, *periods.stockout,
                                 min_days=periods.min_run_days, lookback_days=periods.lookback_days),
        "q3_mom": month_over_month(model.fact_ventas, *periods.monthly, inclusive_end_day=periods.inclusive_end_day),
        "resumen": executive_kpis(model.fact_ventas),
    }


def margin_results(model, stage=None) -> dict[str, DataFrame]:
    """The negative-margin results; ``stage`` materialises their common aggregates once."""
    q4: MarginReport = negative_margin(model.fact_ventas, model.dim_tiendas, stage=stage)
    return {f"q4_{name}": getattr(q4, name) for name in ("detalle_por_tienda", "resumen_sistemico", "resumen_mixto")}


def feeds(model) -> dict[str, DataFrame]:
    """The dashboard's feeds: header totals, share per month, each channel's last months."""
    return {
        "feed_totales": dashboard_totals(model.fact_ventas),
        "feed_participacion": channel_share(model.fact_ventas),
        "feed_ultimos_meses": last_months_by_channel(month_over_month(model.fact_ventas)),
    }


def run_all(model, periods: Periods = Periods(), lookback_sales: DataFrame | None = None, stage=None) -> dict[str, DataFrame]:
    """All results; the job writes or prints exactly these."""
    return {**direct_results(model, periods, lookback_sales), **margin_results(model, stage)}
