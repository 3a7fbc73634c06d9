"""Registered queries over the test tables: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the whole test tables through the bindings in ``kardex.sources.testdata``;
periods are open (whole tables) unless the query is about a period rule. Money leaves as DOUBLE.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.functions.numeric import round_double, round_money
from kardex.operators import quality as dq
from kardex.operators.asof import asof_join, asof_locf, build_fact_ventas_con_costo
from kardex.operators.conform import (build_dim_tiendas, build_fact_ventas, clean_snapshots, transform_ecommerce,
                                      transform_sales)
from kardex.operators.identity import build_dim_producto, latest_attributes
from kardex.operators.islands import stockout_runs, stockouts
from kardex.operators.kpis import dashboard_totals, executive_kpis, kpi_report
from kardex.operators.margin import (MarginReport, flatten_affected, margin_base, margin_by_sku, margin_summary,
                                     national_price, negative_margin, top_systemic)
from kardex.operators.periods import channel_share, last_months_by_channel, month_over_month, monthly_share
from kardex.operators.turnover import turnover, turnover_top
from kardex.operators.kpi_states import code_numbers, daily_states, kpis_of
from kardex.operators.rules import suite
from kardex.plans.analytics import run_all
from kardex.plans.checks import answer_checks, model_checks, rate_checks
from kardex.plans.model import Model, build_model, no_stage, row_partitions, sku_partitions
from kardex.session import ensure_checkpoint_dir, planned_with
from kardex.sinks.staging import stage_laid, stage_shared
from kardex.sources import testdata as td
from kardex.sources.files import RawSources
from kardex.sources.json_document import read_inventory_document, write_document
from kardex.sources.rescue import read_sales_rescued


def money_as_double(df: DataFrame) -> DataFrame:
    """DECIMAL columns -> DOUBLE (exact money inside, plain numbers at the output)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _model(spark: SparkSession, d: str) -> Model:
    """A standalone query plans the whole model lazily in one plan (repeated dimension subplans
    share their exchanges at runtime); the batch job stages the model as tables instead."""
    return build_model(td.load_sources(spark, d), no_stage)


def _sales_sources(spark: SparkSession, d: str) -> RawSources:
    """The sources with the joined order lines landed once: the facts of both channels and the product
    dimension read them, each with other columns, so one plan would join orders and lines for each."""
    return td.load_sources(spark, d, stage=stage_shared)


def _stage_products(df: DataFrame, name: str) -> DataFrame:
    """The product dimension is landed (web orders, histories and facts look products up in it), the rest stays lazy."""
    return stage_shared(df, name) if name == "dim_producto" else df


def _sales_model(spark: SparkSession, d: str) -> Model:
    """The model for queries over the sales fact."""
    return build_model(_sales_sources(spark, d), no_stage)


def _sku_model(spark: SparkSession, d: str) -> tuple[Model, int | None]:
    """The model for queries that add up sales per SKU, and the number of partitions in which its sales lie by SKU."""
    raw = _sales_sources(spark, d)
    parts = sku_partitions(raw)
    return build_model(raw, _stage_products, sku_parts=parts), parts


def _negative_margin(spark: SparkSession, d: str) -> MarginReport:
    m, parts = _sku_model(spark, d)
    return negative_margin(m.fact_ventas, m.dim_tiendas, sku_parts=parts)


def _inventory(spark: SparkSession, d: str) -> tuple[Model, DataFrame]:
    m = _model(spark, d)
    return m, td.activity_sales(spark, d, m.dim_producto)


# ---- sources, conform, identity --------------------------------------------------------------

def q_net_sales_signed(spark, d):
    lines = td.order_lines(spark, d)
    return money_as_double(transform_sales(td.pos_sales(lines)))


def q_fx_daily_rate(spark, d):
    raw = td.load_sources(spark, d)
    dim = build_dim_producto(raw.sku_map, raw.catalogo, raw.ecommerce, raw.sales)
    return money_as_double(transform_ecommerce(raw.ecommerce, dim, raw.exchange_rates))


def q_unified_sales_union(spark, d):
    """Both channels unioned, summarised per (channel, month)."""
    raw = td.load_sources(spark, d)
    dim = build_dim_producto(raw.sku_map, raw.catalogo, raw.ecommerce, raw.sales)
    fact = build_fact_ventas(transform_sales(raw.sales), transform_ecommerce(raw.ecommerce, dim, raw.exchange_rates))
    return fact.groupBy("canal", F.date_format("fecha", "yyyy-MM").alias("mes")).agg(
        F.count(F.lit(1)).cast("bigint").alias("filas"),
        F.sum("cantidad").cast("bigint").alias("unidades"),
        round_money(F.sum("monto_mxn")).alias("monto_mxn"),
        F.count_if(F.col("sku_pos").isNull()).cast("bigint").alias("sin_sku"))


def q_asof_cost_margin(spark, d):
    return money_as_double(_sales_model(spark, d).fact_ventas)


def q_asof_cost_margin_sorted(spark, d):
    """The cost in force through the sort-based (skew-safe) as-of strategy."""
    raw = _sales_sources(spark, d)
    m = build_model(raw, _stage_products)
    fact = build_fact_ventas(transform_sales(raw.sales),
                             transform_ecommerce(raw.ecommerce, m.dim_producto, raw.exchange_rates))
    return money_as_double(build_fact_ventas_con_costo(fact, m.dim_catalogo, m.dim_producto, strategy="sorted"))


def q_asof_event_locf(spark, d):
    """Each event with the value of the same user's latest purchase at or before it."""
    e = td.table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    purchases = td.table(spark, d, "events").where(F.col("event_type") == "purchase").select(
        "user_id", F.col("ts").alias("p_ts"), F.col("event_id").alias("p_id"), F.col("value").alias("last_purchase_value"))
    return asof_join(e, purchases, ["user_id"], "ts", "p_ts", ["last_purchase_value"], tiebreak=["p_id"])


def q_product_identity_map(spark, d):
    raw = td.load_sources(spark, d)
    return build_dim_producto(raw.sku_map, raw.catalogo, raw.ecommerce, raw.sales)


def q_store_dim_virtual(spark, d):
    return build_dim_tiendas(td.tiendas(spark, d))


def q_inventory_fact_lookup(spark, d):
    return _model(spark, d).fact_inventario


def q_latest_attributes(spark, d):
    return latest_attributes(td.catalogo(spark, d))


def q_json_unnest(spark, d):
    """Events' JSON text -> struct -> per key: events and value."""
    e = td.table(spark, d, "events").select(
        F.from_json("props", "k BIGINT").alias("p"), "value", "event_type")
    return e.groupBy(F.col("p.k").alias("k")).agg(
        F.count(F.lit(1)).cast("bigint").alias("eventos"),
        F.count_distinct("event_type").cast("bigint").alias("tipos"),
        round_double(F.sum("value"), 2).alias("valor"))


def q_nested_cost_unnest(spark, d):
    """products[] x cost_history[] unnest of the nested catalogue (inner explode)."""
    return money_as_double(td.catalogo(spark, d))


def q_dirty_numeric_coerce(spark, d):
    return clean_snapshots(td.snapshots(spark, d))


# ---- analytics -------------------------------------------------------------------------------

def q_turnover_top10(spark, d):
    m = _sales_model(spark, d)
    return turnover_top(m.fact_ventas, m.fact_inventario, k=10)


def q_turnover_all(spark, d):
    m = _sales_model(spark, d)
    return turnover(m.fact_ventas, m.fact_inventario)


def q_stockout_runs(spark, d):
    return stockout_runs(_model(spark, d).fact_inventario)


def q_stockout_runs_period(spark, d):
    """Runs clipped to a period inside the snapshot calendar (a run crossing the start is cut)."""
    return stockout_runs(_model(spark, d).fact_inventario, "2024-01-10", "2024-01-25")


def q_stockout_runs_calendar(spark, d):
    return stockout_runs(_model(spark, d).fact_inventario, calendar=True)


def q_stockout_lost_sales(spark, d):
    m, act = _inventory(spark, d)
    return stockouts(m.fact_inventario, act, m.dim_tiendas)


def q_stockout_lost_sales_period(spark, d):
    """The report of a period: the lookback sales read start - 14 days to end - 1 only."""
    m, act = _inventory(spark, d)
    return stockouts(m.fact_inventario, act, m.dim_tiendas, "2024-01-10", "2024-01-25")


def q_stockout_lost_sales_model_facts(spark, d):
    """Lookback over the model's own sales fact (no sales on the snapshot days -> zero)."""
    m, parts = _sku_model(spark, d)
    inventory = stage_shared(m.fact_inventario, "fact_inventario")
    return stockouts(inventory, m.fact_ventas, m.dim_tiendas, inventory_parts=row_partitions(spark, inventory.count()), sales_parts=parts)


def q_mom_channel(spark, d):
    return month_over_month(_sales_model(spark, d).fact_ventas)


def q_mom_channel_period(spark, d):
    """One year of months; the month-end rule of the period filter applies."""
    return month_over_month(_sales_model(spark, d).fact_ventas, "1998-04-01", "1999-03-31")


def q_last3_months_by_channel(spark, d):
    return last_months_by_channel(month_over_month(_sales_model(spark, d).fact_ventas), 3)


def q_monthly_share(spark, d):
    return monthly_share(month_over_month(_sales_model(spark, d).fact_ventas))


def q_channel_share(spark, d):
    return channel_share(_sales_model(spark, d).fact_ventas)


def q_national_price(spark, d):
    return national_price(margin_base(_sales_model(spark, d).fact_ventas))


def q_neg_margin_detail(spark, d):
    return _negative_margin(spark, d).detalle_por_tienda


def q_neg_margin_summary(spark, d):
    m, parts = _sku_model(spark, d)
    return margin_summary(margin_by_sku(margin_base(m.fact_ventas), parts))


def q_neg_margin_systemic(spark, d):
    return _negative_margin(spark, d).resumen_sistemico


def q_neg_margin_mixed(spark, d):
    return _negative_margin(spark, d).resumen_mixto.drop("tiendas_negativas")


def q_mixed_affected_stores(spark, d):
    return flatten_affected(_negative_margin(spark, d).resumen_mixto)


def q_top5_systemic(spark, d):
    return top_systemic(_negative_margin(spark, d).resumen_sistemico, 5)


def q_exec_kpis(spark, d):
    return executive_kpis(_sales_model(spark, d).fact_ventas)


def q_dashboard_totals(spark, d):
    return dashboard_totals(_sales_model(spark, d).fact_ventas)


def q_exec_kpis_report(spark, d):
    return kpi_report(executive_kpis(_sales_model(spark, d).fact_ventas))


def q_conditional_pivot(spark, d):
    """Monthly units per channel side by side (pivot with fixed values; 0 when absent)."""
    f = _sales_model(spark, d).fact_ventas
    p = f.groupBy(F.date_format("fecha", "yyyy-MM").alias("mes")).pivot("canal", ["fisico", "ecommerce"]).agg(
        F.sum("cantidad"))
    return p.select("mes", F.coalesce(F.col("fisico"), F.lit(0)).cast("bigint").alias("unidades_fisico"),
                    F.coalesce(F.col("ecommerce"), F.lit(0)).cast("bigint").alias("unidades_ecommerce"))


def q_semi_anti_keys(spark, d):
    """Set differences that drive the unmapped families, as counts."""
    raw = td.load_sources(spark, d)
    m = raw.sku_map
    pos_only = raw.sales.select(F.col("sku").alias("sku_pos")).distinct().join(m.select("sku_pos"), "sku_pos", "left_anti")
    web_only = raw.ecommerce.select(F.col("product_handle").alias("handle")).distinct().join(m.select("handle"), "handle", "left_anti")
    erp_only = raw.catalogo.select("sku_erp").distinct().join(m.select("sku_erp"), "sku_erp", "left_anti")
    sold_mapped = raw.sales.select(F.col("sku").alias("sku_pos")).distinct().join(m.select("sku_pos"), "sku_pos", "left_semi")
    rows = [pos_only.select(F.lit("pos_sin_mapa").alias("conjunto")),
            web_only.select(F.lit("handles_sin_mapa").alias("conjunto")),
            erp_only.select(F.lit("erp_sin_mapa").alias("conjunto")),
            sold_mapped.select(F.lit("pos_mapeados").alias("conjunto"))]
    u = rows[0]
    for r in rows[1:]:
        u = u.unionByName(r)
    return u.groupBy("conjunto").agg(F.count(F.lit(1)).cast("bigint").alias("claves"))


def q_top3_turnover(spark, d):
    m = _sales_model(spark, d)
    return turnover_top(m.fact_ventas, m.fact_inventario, k=3)


def q_top3_stockouts(spark, d):
    m, act = _inventory(spark, d)
    return stockouts(m.fact_inventario, act, m.dim_tiendas).limit(3)


def _events_with_nulls(spark, d):
    """Events and purchases with null users and null times, derived from the events."""
    e = td.table(spark, d, "events")
    left = e.select("event_id", F.nullif("user_id", F.lit(7)).alias("user_id"), F.when(F.col("event_id") % 11 != 0, F.col("ts")).alias("ts"))
    right = e.where(F.col("event_type") == "purchase").select(
        F.nullif("user_id", F.lit(9)).alias("user_id"), F.when(F.col("event_id") % 13 != 0, F.col("ts")).alias("p_ts"),
        F.col("event_id").alias("p_id"), F.col("event_id").alias("last_purchase"))
    return left, right


def q_asof_event_locf_nulls(spark, d):
    """As-of with null keys and null times on both sides: they match nothing."""
    left, right = _events_with_nulls(spark, d)
    return asof_join(left, right, ["user_id"], "ts", "p_ts", ["last_purchase"], tiebreak=["p_id"])


def q_asof_event_locf_nulls_sorted(spark, d):
    """The same answer by the sorted strategy."""
    left, right = _events_with_nulls(spark, d)
    return asof_locf(left, right, ["user_id"], "ts", "p_ts", ["last_purchase"], tiebreak=["p_id"])


def q_asof_event_locf_window(spark, d):
    """Same answer as asof_event_locf through union + last(ignorenulls) over a window."""
    e = td.table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    purchases = td.table(spark, d, "events").where(F.col("event_type") == "purchase").select(
        "user_id", F.col("ts").alias("p_ts"), F.col("value").alias("last_purchase_value"))
    return asof_locf(e, purchases, ["user_id"], "ts", "p_ts", ["last_purchase_value"])


def register_views(model: Model) -> dict[str, str]:
    """The model's tables as named relations for SQL: temp views under names of their own, so that two
    models of a session do not meet. Returns table -> view."""
    tag = uuid.uuid4().hex[:8]
    for name, df in model._asdict().items():
        df.createOrReplaceTempView(f"{name}_{tag}")
    return {name: f"{name}_{tag}" for name in model._fields}


def q_exec_kpis_sql(spark, d):
    """The KPIs through the SQL API over temp views (filtered aggregates, one scan)."""
    views = register_views(_sales_model(spark, d))
    return spark.sql(f"""
        SELECT CAST(ROUND(SUM(monto_mxn), 2) AS DOUBLE) AS total_ventas_mxn,
               CAST(ROUND(SUM(monto_mxn) FILTER (WHERE canal = 'fisico'), 2) AS DOUBLE) AS ventas_fisicas_mxn,
               CAST(ROUND(SUM(monto_mxn) FILTER (WHERE canal = 'ecommerce'), 2) AS DOUBLE) AS ventas_ecommerce_mxn,
               COUNT(*) AS total_transacciones,
               COUNT(DISTINCT tienda_id) FILTER (WHERE canal = 'fisico') AS tiendas_activas,
               COUNT(DISTINCT sku_pos) AS skus_activos
        FROM {views['fact_ventas']}""")


# Rows that lie by one of several join keys may be joined where they are. The default lays them anew by all keys, for fear of
# one hot key; facts are laid by SKU only where no SKU is hot.
JOINS_IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
SUMMARY_FACTS = ["sku_pos", "nombre", "categoria", "tienda_id", "cantidad", "monto_mxn", "costo_mxn", "costo_total_mxn", "margen_mxn"]


def q_neg_margin_summary_sql(spark, d):
    """The SKU summary through the SQL API over temp views: one aggregate per (SKU, store), whose
    losing stores decide by EXISTS which SKUs are listed, then a second aggregate over it. The planner works the
    first aggregate out for each of its three names; so many sales are landed once by SKU (the columns that the statement
    reads), and each time they are added up and joined where they lie."""
    m, parts = _sku_model(spark, d)
    if parts:
        m = m._replace(fact_ventas=stage_laid(m.fact_ventas.select(*SUMMARY_FACTS), "fact_ventas", "sku_pos", parts))
    views = register_views(m)
    mean = lambda total, n: f"CAST(SUM({total}) AS DOUBLE) / CAST(SUM({n}) AS DOUBLE)"
    cents = lambda e: f"ROUND(({e}) * 100D, 0) / 100D"
    money = lambda e: f"CAST(ROUND(SUM({e}), 2) AS DOUBLE)"
    summary = spark.sql(f"""
        WITH per_store AS (
          SELECT sku_pos, nombre, categoria, tienda_id, COUNT(1) AS n, SUM(cantidad) AS units, SUM(monto_mxn) AS income,
                 SUM(costo_total_mxn) AS cost, SUM(margen_mxn) AS margin, SUM(costo_mxn) AS unit_cost, COUNT(costo_mxn) AS n_cost,
                 SUM(price) AS price, COUNT(price) AS n_price
          FROM (SELECT *, CAST(ROUND(try_divide(CAST(monto_mxn AS DOUBLE), CAST(cantidad AS DOUBLE)) * 1000000D, 0) / 1000000D
                               AS DECIMAL(24,6)) AS price
                FROM {views['fact_ventas']} WHERE margen_mxn IS NOT NULL AND costo_mxn IS NOT NULL)
          GROUP BY sku_pos, nombre, categoria, tienda_id),
        losing AS (SELECT sku_pos, tienda_id FROM per_store GROUP BY sku_pos, tienda_id HAVING SUM(margin) < 0)
        SELECT s.sku_pos, s.nombre, s.categoria,
               COUNT(DISTINCT s.tienda_id) AS tiendas_totales,
               COUNT(DISTINCT l.tienda_id) AS tiendas_con_margen_negativo,
               SUM(s.n) AS num_transacciones, SUM(s.units) AS unidades_totales,
               {money('s.income')} AS ingreso_total_mxn, {money('s.cost')} AS costo_total_mxn, {money('s.margin')} AS margen_total_mxn,
               {cents(mean('s.price', 's.n_price'))} AS precio_venta_promedio,
               {cents(mean('s.unit_cost', 's.n_cost'))} AS costo_unitario_promedio,
               {cents(mean('s.unit_cost', 's.n_cost') + ' - ' + mean('s.price', 's.n_price'))} AS brecha_costo_precio
        FROM per_store s LEFT JOIN losing l ON l.sku_pos = s.sku_pos AND l.tienda_id = s.tienda_id
        WHERE EXISTS (SELECT 1 FROM losing k WHERE k.sku_pos = s.sku_pos)
        GROUP BY s.sku_pos, s.nombre, s.categoria""")
    if not parts:
        return summary
    with planned_with(spark, JOINS_IN_PLACE):
        return stage_shared(summary, "neg_margin_summary")


# ---- data quality ----------------------------------------------------------------------------

def q_dq_rate_coverage(spark, d):
    """Rates start on or before the first web order (DQ5), and foreign-currency web-order days
    without a day rate (they take the fallback rate). One row, built from one union."""
    raw = td.load_sources(spark, d)
    web = raw.ecommerce.select(F.lit("orden").alias("lado"), F.to_date("fecha").alias("dia"), "currency")
    rates = raw.exchange_rates.select(F.lit("tasa").alias("lado"), F.col("fecha").alias("dia"), "currency")
    both = web.unionByName(rates)
    per_day = both.where(F.col("currency") != "MXN").groupBy("dia", "currency").agg(
        F.max(F.col("lado") == "orden").alias("con_orden"), F.max(F.col("lado") == "tasa").alias("con_tasa"))
    firsts = both.agg(F.min(F.when(F.col("lado") == "tasa", F.col("dia"))).alias("primera_tasa"),
                      F.min(F.when(F.col("lado") == "orden", F.col("dia"))).alias("primera_orden"))
    gaps = per_day.agg(F.count_if(F.col("con_orden") & ~F.col("con_tasa")).cast("bigint").alias("dias_sin_tasa"))
    return (firsts.select(F.lit("cubre_inicio").alias("regla"),
                          (F.col("primera_tasa") <= F.col("primera_orden")).cast("bigint").alias("valor"))
            .unionByName(gaps.select(F.lit("dias_sin_tasa").alias("regla"), F.col("dias_sin_tasa").alias("valor"))))


def q_dq_domain(spark, d):
    """Domain rules (DQ7) as (regla, valor) rows: channel values, the virtual store, both
    unmapped families present, no null product id."""
    m = _sales_model(spark, d)
    parts = [
        m.fact_ventas.agg(F.count_if(~F.col("canal").isin("fisico", "ecommerce")).alias("v")).select(
            F.lit("canal_invalido").alias("regla"), "v"),
        m.dim_tiendas.agg(F.count_if(F.col("tienda_id") == "ECOMMERCE").alias("v")).select(
            F.lit("tienda_virtual").alias("regla"), "v"),
        m.dim_producto.agg(F.count_if(F.col("product_id").contains("EC-UNMAPPED")).alias("v")).select(
            F.lit("ec_unmapped").alias("regla"), "v"),
        m.dim_producto.agg(F.count_if(F.col("product_id").contains("CN-UNMAPPED")).alias("v")).select(
            F.lit("cn_unmapped").alias("regla"), "v"),
        m.dim_producto.agg(F.count_if(F.col("product_id").isNull()).alias("v")).select(
            F.lit("sin_product_id").alias("regla"), "v"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("regla", F.col("v").cast("bigint").alias("valor"))


def q_dq_share_per_month(spark, d):
    """Months whose channel rows disagree on the online share (expected: none)."""
    return dq.distinct_per_group(month_over_month(_sales_model(spark, d).fact_ventas), "mes", "share_ecommerce_pct")


def q_dq_nulls(spark, d):
    f = _sales_model(spark, d).fact_ventas
    return dq.null_counts(f, ["order_id", "fecha", "tienda_id", "product_id", "sku_pos", "cantidad", "monto_mxn",
                              "costo_mxn", "margen_mxn"])


def q_dq_unique(spark, d):
    return dq.duplicate_summary(_model(spark, d).dim_producto, ["product_id"])


def q_dq_ref_integrity(spark, d):
    """Physical-sales stores without inventory snapshots (expected: all, stores differ)."""
    m = _sales_model(spark, d)
    return dq.orphan_keys(m.fact_ventas.where(F.col("canal") == "fisico"), m.fact_inventario, ["tienda_id"])


def q_dq_reconcile(spark, d):
    f = _sales_model(spark, d).fact_ventas.where(F.col("costo_mxn").isNotNull())
    diff = F.abs(F.col("monto_mxn") - F.col("costo_total_mxn") - F.col("margen_mxn"))
    return f.agg(F.max(diff).cast("double").alias("max_diff_margen"),
                 F.count(F.lit(1)).cast("bigint").alias("filas_con_costo"))


def q_dq_coverage(spark, d):
    m = _model(spark, d)
    return m.fact_inventario.agg(
        round_double(F.avg(F.col("sku_pos").isNotNull().cast("double")), 6).alias("cobertura_sku_pos"),
        round_double(F.avg(F.col("product_id").isNotNull().cast("double")), 6).alias("cobertura_product_id"))


def q_dq_ranges(spark, d):
    """Range and sign rules of the results, as violation counts."""
    m = _sales_model(spark, d)
    t = turnover(m.fact_ventas, m.fact_inventario)
    return dq.count_violations(t, {
        "rotacion_no_positiva": F.col("rotacion_extendida") > 0,
        "extendida_menor_fisica": F.col("rotacion_extendida") >= F.col("rotacion_fisica"),
        "pct_fuera_0_100": F.col("pct_ventas_con_inventario").between(0, 100),
    })


# ---- the real formats, derived from the tables -----------------------------------------------

def _shared(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _document(spark, d) -> dict[str, DataFrame]:
    """The tables as one nested JSON document in part files, read back in byte ranges."""
    path = _shared(spark, "inventory-document")
    write_document({"tiendas_info": td.tiendas(spark, d), "sku_mappings": td.sku_map(spark, d),
                    "catalogo.productos": td.catalog_products(spark, d), "snapshots": td.snapshots(spark, d)}, path)
    return read_inventory_document(spark, path, range_bytes=8 << 20)


def q_json_document_snapshots(spark, d):
    return _document(spark, d)["snapshots"]


def q_json_document_catalogue(spark, d):
    return money_as_double(_document(spark, d)["catalogo"])


def _dirty_sales(spark, d):
    """POS lines as CSV files with broken lines, read back as good and rejected rows."""
    path = _shared(spark, "sales-csv")
    td.dirty_sales_lines(spark, d).write.text(path)
    return read_sales_rescued(spark, path, header=False)


def q_csv_sales_good(spark, d):
    return money_as_double(_dirty_sales(spark, d).good)


def q_csv_sales_bad(spark, d):
    bad = _dirty_sales(spark, d).bad
    return bad.select("linea", F.array_join(F.array_sort("motivos"), " ").alias("motivos"))


def q_dirty_counts_junk(spark, d):
    """Stock readings as decimals, junk, blanks, exponents and nothing."""
    return clean_snapshots(td.junk_snapshots(spark, d))


def q_latest_attributes_changing(spark, d):
    """Names and categories that change and go missing along a product's history."""
    return latest_attributes(td.changing_catalogue(spark, d))


# ---- rules that the plain binding cannot tell apart ------------------------------------------

def q_mom_midnight_rule(spark, d):
    """Sales at all hours; the period ends at 00:00 of its last day."""
    f = _sales_model(spark, d).fact_ventas
    f = f.withColumn("fecha", F.col("fecha") + F.make_dt_interval(F.lit(0), (F.col("cantidad") % 24).cast("int")))
    return month_over_month(f, "1998-04-01", "1998-09-30", inclusive_end_day=False)


def q_stockout_store_attributes(spark, d):
    """The report with a store dimension that knows some of the stores."""
    m, act = _inventory(spark, d)
    return stockouts(m.fact_inventario, act, td.event_stores(spark, d))


def q_stockout_runs_month_blocks(spark, d):
    """Runs by a segmented scan over months."""
    return stockout_runs(_model(spark, d).fact_inventario, block="month")


def q_asof_event_locf_split(spark, d):
    """The sorted strategy with every busy user cut at quantiles of their times."""
    e = td.table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    purchases = td.table(spark, d, "events").where(F.col("event_type") == "purchase").select(
        "user_id", F.col("ts").alias("p_ts"), F.col("value").alias("last_purchase_value"))
    return asof_locf(e, purchases, ["user_id"], "ts", "p_ts", ["last_purchase_value"], max_rows=8)


def q_dq_ref_integrity_partial(spark, d):
    """Stores with sales that a list of some stores lacks."""
    some = td.table(spark, d, "supplier").where(F.col("s_acctbal") > 0).select(td.store_code("s_suppkey").alias("tienda_id"))
    return dq.orphan_keys(_sales_model(spark, d).fact_ventas.where(F.col("canal") == "fisico"), some, ["tienda_id"])


def _kpi_states(spark, d):
    fact = _sales_model(spark, d).fact_ventas.select("fecha", "canal", "tienda_id", "sku_pos", "monto_mxn")
    fact = stage_shared(fact, "kpi-facts")
    return daily_states(fact, code_numbers(fact))


def q_kpi_states_all(spark, d):
    """The KPIs of all days, merged from daily states."""
    return kpis_of(_kpi_states(spark, d))


def q_kpi_states_period(spark, d):
    return kpis_of(_kpi_states(spark, d), "1997-03-10", "1998-01-20")


def q_dq_suite(spark, d):
    """Every rule over the model, the rates and the answers: violations and the smallest key at fault."""
    raw = _sales_sources(spark, d)
    m = build_model(raw, stage_shared)
    m = m._replace(fact_ventas=stage_shared(m.fact_ventas, "fact_ventas"), fact_inventario=stage_shared(m.fact_inventario, "fact_inventario"))
    act = td.activity_sales(spark, d, m.dim_producto)
    results = run_all(m, lookback_sales=act, stage=stage_shared)
    checks = model_checks(m) + rate_checks(raw.ecommerce, raw.exchange_rates) + answer_checks(results, m)
    return suite(checks).select("tabla", "regla", "violaciones", "primera_clave")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "net_sales_signed": q_net_sales_signed,
    "fx_daily_rate": q_fx_daily_rate,
    "unified_sales_union": q_unified_sales_union,
    "asof_cost_margin": q_asof_cost_margin,
    "asof_cost_margin_sorted": q_asof_cost_margin_sorted,
    "asof_event_locf": q_asof_event_locf,
    "asof_event_locf_nulls": q_asof_event_locf_nulls,
    "asof_event_locf_nulls_sorted": q_asof_event_locf_nulls_sorted,
    "product_identity_map": q_product_identity_map,
    "store_dim_virtual": q_store_dim_virtual,
    "inventory_fact_lookup": q_inventory_fact_lookup,
    "latest_attributes": q_latest_attributes,
    "json_unnest": q_json_unnest,
    "nested_cost_unnest": q_nested_cost_unnest,
    "dirty_numeric_coerce": q_dirty_numeric_coerce,
    "turnover_top10": q_turnover_top10,
    "turnover_all": q_turnover_all,
    "stockout_runs": q_stockout_runs,
    "stockout_runs_period": q_stockout_runs_period,
    "stockout_runs_calendar": q_stockout_runs_calendar,
    "stockout_lost_sales": q_stockout_lost_sales,
    "stockout_lost_sales_period": q_stockout_lost_sales_period,
    "stockout_lost_sales_model_facts": q_stockout_lost_sales_model_facts,
    "mom_channel": q_mom_channel,
    "mom_channel_period": q_mom_channel_period,
    "last3_months_by_channel": q_last3_months_by_channel,
    "monthly_share": q_monthly_share,
    "channel_share": q_channel_share,
    "national_price": q_national_price,
    "neg_margin_detail": q_neg_margin_detail,
    "neg_margin_summary": q_neg_margin_summary,
    "neg_margin_systemic": q_neg_margin_systemic,
    "neg_margin_mixed": q_neg_margin_mixed,
    "mixed_affected_stores": q_mixed_affected_stores,
    "top5_systemic": q_top5_systemic,
    "exec_kpis": q_exec_kpis,
    "exec_kpis_report": q_exec_kpis_report,
    "dashboard_totals": q_dashboard_totals,
    "conditional_pivot": q_conditional_pivot,
    "semi_anti_keys": q_semi_anti_keys,
    "top3_turnover": q_top3_turnover,
    "top3_stockouts": q_top3_stockouts,
    "asof_event_locf_window": q_asof_event_locf_window,
    "exec_kpis_sql": q_exec_kpis_sql,
    "neg_margin_summary_sql": q_neg_margin_summary_sql,
    "dq_rate_coverage": q_dq_rate_coverage,
    "dq_domain": q_dq_domain,
    "dq_share_per_month": q_dq_share_per_month,
    "dq_nulls": q_dq_nulls,
    "dq_unique": q_dq_unique,
    "dq_ref_integrity": q_dq_ref_integrity,
    "dq_reconcile": q_dq_reconcile,
    "dq_coverage": q_dq_coverage,
    "dq_ranges": q_dq_ranges,
    "json_document_snapshots": q_json_document_snapshots,
    "json_document_catalogue": q_json_document_catalogue,
    "csv_sales_good": q_csv_sales_good,
    "csv_sales_bad": q_csv_sales_bad,
    "dirty_counts_junk": q_dirty_counts_junk,
    "latest_attributes_changing": q_latest_attributes_changing,
    "mom_midnight_rule": q_mom_midnight_rule,
    "stockout_store_attributes": q_stockout_store_attributes,
    "stockout_runs_month_blocks": q_stockout_runs_month_blocks,
    "asof_event_locf_split": q_asof_event_locf_split,
    "dq_ref_integrity_partial": q_dq_ref_integrity_partial,
    "kpi_states_all": q_kpi_states_all,
    "kpi_states_period": q_kpi_states_period,
    "dq_suite": q_dq_suite,
}
