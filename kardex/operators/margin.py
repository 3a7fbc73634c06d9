"""Negative-margin diagnosis: national price (OP13), detail with cause (OP14), SKU summary (OP15),
systemic / mixed split (OP16) and the nested list of affected stores (OP17).

All five outputs come from ONE aggregate of the sales fact at (SKU, name, category, store,
channel) grain. Every later step works on that aggregate, whose size is bounded by
SKUs x stores x channels, so a hot SKU is collapsed by the map-side partial aggregation before
any shuffle. ``margin_by_sku`` brings its groups together by SKU once, for detail and summary;
staged facts without a hot SKU meet by SKU before the aggregate (``meet_by_sku``).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kardex.functions.numeric import round_double, round_money, safe_div

DETAIL_KEYS = ["sku_pos", "nombre", "categoria", "tienda_id", "canal"]
DETAIL_COLUMNS = ["sku_pos", "nombre", "categoria", "tienda_id", "canal", "num_transacciones", "unidades",
                  "ingreso_total_mxn", "costo_total_mxn", "margen_total_mxn", "precio_venta_promedio",
                  "costo_unitario_promedio", "margen_prom_pct", "precio_nacional_promedio", "posible_causa",
                  "ciudad", "region"]
SUMMARY_COLUMNS = ["sku_pos", "nombre", "categoria", "tiendas_totales", "tiendas_con_margen_negativo",
                   "num_transacciones", "unidades_totales", "ingreso_total_mxn", "costo_total_mxn", "margen_total_mxn",
                   "precio_venta_promedio", "costo_unitario_promedio", "brecha_costo_precio"]

# Fixed values of the reference's cause rules
LOW_PRICE_FACTOR = 0.90
PROMO_MAX_TRANSACTIONS = 5
PROMO_MAX_UNITS = 10
CAUSE_LOW_PRICE = "precio_regional_bajo"
CAUSE_PROMO = "promocion_mal_configurada"
CAUSE_SHRINK = "merma_operativa"


class MarginReport(NamedTuple):
    detalle_por_tienda: DataFrame
    resumen_sistemico: DataFrame
    resumen_mixto: DataFrame


_PARTIALS = ["n", "unidades", "ingreso", "costo_total", "margen", "ratio_sum", "ratio_n", "ratio_pos_sum",
             "ratio_pos_n", "costo_sum", "costo_n", "pct_sum", "pct_n"]


UNIT = "decimal(24,6)"


def unit_price(amount="monto_mxn", units="cantidad") -> F.Column:
    """amount / units carried at 6 decimals as DECIMAL, so sums and means do not depend on the
    order rows are added in (a DOUBLE mean of ties like x.xx5 can land on either side)."""
    return round_double(safe_div(amount, units), 6).cast(UNIT)


def margin_base(fact_ventas: DataFrame) -> DataFrame:
    """Additive partial aggregates of the rows with a known cost and margin (exact DECIMAL sums)."""
    v = fact_ventas.where(F.col("costo_mxn").isNotNull() & F.col("margen_mxn").isNotNull())
    ratio = unit_price()
    pos_ratio = F.when(F.col("cantidad") > 0, ratio)
    pct = round_double("margen_pct", 6).cast(UNIT)
    return v.groupBy(*DETAIL_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("cantidad").alias("unidades"),
        F.sum("monto_mxn").alias("ingreso"),
        F.sum("costo_total_mxn").alias("costo_total"),
        F.sum("margen_mxn").alias("margen"),
        F.sum(ratio).alias("ratio_sum"), F.count(ratio).alias("ratio_n"),
        F.sum(pos_ratio).alias("ratio_pos_sum"), F.count(pos_ratio).alias("ratio_pos_n"),
        F.sum("costo_mxn").alias("costo_sum"), F.count("costo_mxn").alias("costo_n"),
        F.sum(pct).alias("pct_sum"), F.count(pct).alias("pct_n"),
    )


# Rows of a SKU that one task adds up; with a SKU beyond it the groups are formed before they meet by SKU.
MAX_ROWS_PER_SKU = 2_000_000


def meet_by_sku(fact_ventas: DataFrame) -> DataFrame:
    """Staged facts laid by SKU, so that ``margin_base`` and what follows need this one shuffle, unless a SKU is so
    hot (measured: one count per SKU, a scalar to the driver) that its rows have to be collapsed first."""
    hottest = fact_ventas.groupBy("sku_pos").count().agg(F.max("count").alias("m")).first()["m"] or 0
    return fact_ventas.repartition("sku_pos") if hottest <= MAX_ROWS_PER_SKU else fact_ventas


def _mean(s, n) -> F.Column:
    """Exact sum / count, one DOUBLE division."""
    return F.col(s).cast("double") / F.when(F.col(n) > 0, F.col(n).cast("double"))


def national_price(base: DataFrame) -> DataFrame:
    """Mean unit price per SKU over all stores and channels (rows with units > 0)."""
    p = base.groupBy("sku_pos").agg(F.sum("ratio_pos_sum").alias("s"), F.sum("ratio_pos_n").alias("c"))
    return p.select("sku_pos", round_double(_mean("s", "c"), 2).alias("precio_nacional_promedio"))


def margin_by_sku(base: DataFrame, sku_parts: int | None = None) -> DataFrame:
    """``base`` and, on each of its rows, what its SKU and store say: ``_primera`` (one row per SKU, name, category
    and store has it), ``_store_neg``, ``_sku_any_neg`` and the SKU's national price.

    Groups meet by SKU in one shuffle (none where the facts already lie by SKU) and one sort serves the three windows;
    what follows adds up rows and needs neither another aggregate per store nor a join. ``sku_parts`` is the number
    of partitions of facts that lie by SKU in a fixed number."""
    rows = base.repartition(sku_parts, "sku_pos") if sku_parts else base.repartition("sku_pos")
    one = Window.partitionBy("sku_pos", "tienda_id", "nombre", "categoria").orderBy("canal")
    store, sku = Window.partitionBy("sku_pos", "tienda_id"), Window.partitionBy("sku_pos")
    rows = rows.withColumn("_primera", F.row_number().over(one) == 1)
    rows = rows.withColumn("_store_neg", F.sum("margen").over(store) < 0)
    rows = rows.select("*", F.max("_store_neg").over(sku).alias("_sku_any_neg"),
                       F.sum("ratio_pos_sum").over(sku).alias("_s"), F.sum("ratio_pos_n").over(sku).alias("_c"))
    price = F.when(F.col("sku_pos").isNotNull(), round_double(_mean("_s", "_c"), 2))
    return rows.withColumn("precio_nacional_promedio", price).drop("_s", "_c")


def margin_detail(by_sku: DataFrame, dim_tiendas: DataFrame) -> DataFrame:
    """(SKU, store, channel) groups whose summed margin is negative, with the likely cause."""
    neg = by_sku.where(F.col("margen") < 0)
    d = neg.select(
        "sku_pos", "nombre", "categoria", "tienda_id", "canal",
        F.col("n").cast("bigint").alias("num_transacciones"),
        F.col("unidades").cast("bigint").alias("unidades"),
        round_money("ingreso").alias("ingreso_total_mxn"),
        round_money("costo_total").alias("costo_total_mxn"),
        round_money("margen").alias("margen_total_mxn"),
        round_double(_mean("ratio_sum", "ratio_n"), 2).alias("precio_venta_promedio"),
        round_double(_mean("costo_sum", "costo_n"), 2).alias("costo_unitario_promedio"),
        round_double(_mean("pct_sum", "pct_n"), 2).alias("margen_prom_pct"),
        "precio_nacional_promedio",
    )
    cause = (F.when(F.col("precio_venta_promedio") < F.col("precio_nacional_promedio") * F.lit(LOW_PRICE_FACTOR), CAUSE_LOW_PRICE)
              .when((F.col("num_transacciones") <= PROMO_MAX_TRANSACTIONS) & (F.col("unidades") <= PROMO_MAX_UNITS), CAUSE_PROMO)
              .otherwise(CAUSE_SHRINK))
    d = d.withColumn("posible_causa", cause)
    stores = dim_tiendas.select("tienda_id", "ciudad", "region")
    return d.join(stores, "tienda_id", "left").select(*DETAIL_COLUMNS)


def margin_summary(by_sku: DataFrame) -> DataFrame:
    """Per (SKU, name, category) for SKUs with at least one store whose margin is negative."""
    store = F.when(F.col("_primera"), F.col("tienda_id"))
    s = by_sku.where("_sku_any_neg").groupBy("sku_pos", "nombre", "categoria").agg(
        F.count(store).alias("tiendas_totales"),
        F.count(F.when(F.col("_store_neg"), store)).alias("tiendas_con_margen_negativo"),
        *[F.sum(c).alias(c) for c in _PARTIALS])
    avg_price = _mean("ratio_sum", "ratio_n")
    avg_cost = _mean("costo_sum", "costo_n")
    return s.select(
        "sku_pos", "nombre", "categoria",
        F.col("tiendas_totales").cast("bigint").alias("tiendas_totales"),
        F.col("tiendas_con_margen_negativo").cast("bigint").alias("tiendas_con_margen_negativo"),
        F.col("n").cast("bigint").alias("num_transacciones"),
        F.col("unidades").cast("bigint").alias("unidades_totales"),
        round_money("ingreso").alias("ingreso_total_mxn"),
        round_money("costo_total").alias("costo_total_mxn"),
        round_money("margen").alias("margen_total_mxn"),
        round_double(avg_price, 2).alias("precio_venta_promedio"),
        round_double(avg_cost, 2).alias("costo_unitario_promedio"),
        round_double(avg_cost - avg_price, 2).alias("brecha_costo_precio"),
    )


def affected_stores(detail: DataFrame, skus: DataFrame | None = None) -> DataFrame:
    """sku_pos -> array of (tienda_id, ciudad, posible_causa, margen_total_mxn), margin ascending.

    One element per negative (store, channel) group, so a list is bounded by the store count.
    ``skus`` restricts the SKUs (semi join); without it every SKU of the detail gets its list and
    the caller's join picks the ones it needs.
    """
    d = detail if skus is None else detail.join(skus.select("sku_pos").distinct(), "sku_pos", "left_semi")
    items = F.array_sort(F.collect_list(F.struct("margen_total_mxn", "tienda_id", "ciudad", "posible_causa")))
    nested = d.groupBy("sku_pos").agg(items.alias("_items"))
    return nested.select("sku_pos", F.transform("_items", lambda e: F.struct(
        e["tienda_id"].alias("tienda_id"), e["ciudad"].alias("ciudad"), e["posible_causa"].alias("posible_causa"),
        e["margen_total_mxn"].alias("margen_total_mxn"))).alias("tiendas_negativas"))


def negative_margin(fact_ventas: DataFrame, dim_tiendas: DataFrame, stage=None, sku_parts: int | None = None) -> MarginReport:
    """All three outputs from one base aggregate of the facts. ``stage`` (e.g. persist)
    materialises the base, the detail and the summary once, since each feeds two outputs; the facts are
    staged then too. Without it the lazy facts keep the layout of their plan (``sku_parts``: by SKU in so many partitions)."""
    if stage is None:
        stage = lambda df, name: df
    else:
        fact_ventas = meet_by_sku(fact_ventas)
    by_sku = stage(margin_by_sku(margin_base(fact_ventas), sku_parts), "margin_base")
    detail = stage(margin_detail(by_sku, dim_tiendas), "margin_detail")
    summary = stage(margin_summary(by_sku), "margin_summary")
    systemic = summary.where(F.col("margen_total_mxn") < 0)
    mixed = summary.where(F.col("margen_total_mxn") >= 0)
    # every summary SKU has a negative store, so each mixed SKU finds its list in the detail
    mixed = mixed.join(affected_stores(detail), "sku_pos", "left").select(*SUMMARY_COLUMNS, "tiendas_negativas")
    order = [F.col("margen_total_mxn").asc_nulls_last(), F.col("sku_pos").asc_nulls_last()]
    return MarginReport(
        detail.orderBy(F.col("margen_total_mxn").asc_nulls_last(), F.col("sku_pos").asc_nulls_last(),
                       F.col("tienda_id").asc_nulls_last(), F.col("canal").asc_nulls_last()),
        systemic.orderBy(*order),
        mixed.orderBy(*order),
    )


def flatten_affected(mixed: DataFrame) -> DataFrame:
    """The nested list as rows with their 1-based position (for checks and flat sinks)."""
    e = mixed.select("sku_pos", F.posexplode("tiendas_negativas").alias("pos", "t"))
    return e.select("sku_pos", (F.col("pos") + 1).cast("bigint").alias("posicion"), "t.tienda_id", "t.ciudad",
                    "t.posible_causa", "t.margen_total_mxn")


def top_systemic(systemic: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` SKUs with the most negative chain-wide margin (dashboard feed)."""
    return systemic.orderBy(F.col("margen_total_mxn").asc_nulls_last(), F.col("sku_pos").asc_nulls_last()).limit(n)
