"""The data-quality rules of the model and of the answers (DQ1-DQ13), for ``operators.rules``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.operators.conform import ONLINE, ONLINE_STORE, PHYSICAL
from kardex.operators.rules import Measure, Rule, agreement, key_counts, neighbours, references, rows_exactly

# A store that sells need not be one whose stock is counted; a broken rule of these is reported, not fatal.
REPORTED = frozenset({"tiendas_de_ventas.con_inventario"})


def _rows(expected: dict[str, int] | None, name: str) -> Measure:
    return rows_exactly(expected[name]) if expected and name in expected else Measure("con_filas", F.count(F.lit(1)), 1)


def model_checks(model, expected: dict[str, int] | None = None) -> list:
    """Rules of the model's tables; ``expected`` gives exact row counts where they are known."""
    sale = F.col("order_id")
    not_null = lambda c, key: Rule(f"{c}_presente", F.col(c).isNotNull(), key)
    fact, inv, dim = model.fact_ventas, model.fact_inventario, model.dim_producto
    return [
        ("fact_ventas", fact, [
            _rows(expected, "fact_ventas"), *(not_null(c, sale) for c in ("fecha", "tienda_id", "cantidad", "monto_mxn")),
            Rule("canal_conocido", F.col("canal").isin(PHYSICAL, ONLINE), sale),
            Rule("web_en_tienda_virtual", (F.col("canal") != ONLINE) | (F.col("tienda_id") == ONLINE_STORE["tienda_id"]), sale),
            Rule("margen_es_monto_menos_costo", F.col("costo_mxn").isNull() | (F.abs(F.col("monto_mxn") - F.col("costo_total_mxn") - F.col("margen_mxn")) < 0.01), sale),
            Measure("cobertura_producto", F.avg(F.col("product_id").isNotNull().cast("double")), 0.8)]),
        ("fact_inventario", inv, [
            _rows(expected, "fact_inventario"), Rule("stock_no_negativo", F.col("cantidad_en_stock") >= 0, F.col("sku_erp")), not_null("fecha", F.col("sku_erp")),
            Measure("cobertura_sku", F.avg(F.col("sku_pos").isNotNull().cast("double")), 0.8)]),
        ("dim_producto", dim, [not_null("product_id", F.col("sku_erp")), Rule("id_con_prefijo", F.col("product_id").startswith("PRD-"), F.col("product_id"))]),
        ("dim_producto_claves", key_counts(dim, ["product_id"]), [Rule("unica", F.col("n") == 1, F.col("product_id"))]),
        ("dim_tiendas", model.dim_tiendas, [Measure("una_tienda_virtual", F.count_if(F.col("tienda_id") == ONLINE_STORE["tienda_id"]), 1, 1)]),
        ("tiendas_de_ventas", references(fact.where(F.col("canal") == PHYSICAL), inv, "tienda_id"), [Rule("con_inventario", F.col("existe"), F.col("clave"))]),
        ("tiendas_en_dimension", references(fact, model.dim_tiendas, "tienda_id"), [Rule("conocida", F.col("existe"), F.col("clave"))]),
    ]


def rate_checks(ecommerce: DataFrame, rates: DataFrame) -> list:
    """Rates begin no later than the web orders that need them, and every day with one has orders' currencies (DQ5)."""
    orders = ecommerce.where(F.col("currency") != "MXN").select("currency", F.to_date("fecha").alias("dia"))
    first = rates.groupBy("currency").agg(F.min("fecha").alias("desde"))
    per = orders.groupBy(F.col("currency").alias("moneda")).agg(F.min("dia").alias("primera")).join(first, F.col("moneda") == F.col("currency"), "left")
    return [("tasas", per, [Rule("cubren_primera_orden", F.col("desde") <= F.col("primera"), F.col("moneda"))])]


def answer_checks(results: dict[str, DataFrame], model, top_k: int = 10, min_days: int = 3) -> list:
    """Ranges, order, sizes and reconciliation of the answers."""
    q1, q2, q3 = results["q1_rotacion"], results["q2_quiebres"], results["q3_mom"]
    detail, systemic, mixed = (results[f"q4_{n}"] for n in ("detalle_por_tienda", "resumen_sistemico", "resumen_mixto"))
    sku = F.col("sku_pos")
    costed = model.fact_ventas.where(F.col("costo_mxn").isNotNull() & F.col("margen_mxn").isNotNull())
    whole = costed.groupBy("sku_pos", "nombre", "categoria").agg(F.sum("margen_mxn").alias("margen_total_mxn"))
    listed = systemic.select("sku_pos", "nombre", "categoria", "margen_total_mxn").unionByName(mixed.select("sku_pos", "nombre", "categoria", "margen_total_mxn"))
    summary = lambda sign: [Rule("signo", sign, sku), Rule("tiendas", (F.col("tiendas_con_margen_negativo") >= 1) & (F.col("tiendas_con_margen_negativo") <= F.col("tiendas_totales")), sku)]
    return [
        ("q1_rotacion", q1, [Measure("tamano", F.count(F.lit(1)), 0, top_k), Rule("positiva", F.col("rotacion_extendida") > 0, sku),
                             Rule("extendida_no_menor", F.col("rotacion_extendida") >= F.col("rotacion_fisica"), sku),
                             Rule("porcentaje", F.col("pct_ventas_con_inventario").between(0, 100), sku)]),
        ("q1_orden", neighbours(q1, F.struct(-F.col("rotacion_extendida"), sku), "rotacion_extendida"), [Rule("descendente", F.col("previo").isNull() | (F.col("valor") <= F.col("previo")))]),
        ("q2_quiebres", q2, [Rule("dias_minimos", F.col("dias_en_quiebre") >= min_days, sku), Rule("fin_no_antes", F.col("fin_quiebre") >= F.col("inicio_quiebre"), sku),
                             Rule("no_negativa", (F.col("avg_unidades_diarias_14d") >= 0) & (F.col("ventas_perdidas_estimadas") >= 0), sku),
                             Rule("perdida_es_media_por_dias", F.abs(F.col("ventas_perdidas_estimadas") - F.col("avg_unidades_diarias_14d") * F.col("dias_en_quiebre"))
                                  <= 0.06 + 0.006 * F.col("dias_en_quiebre"), sku)]),
        ("q3_mom", q3, [Rule("canal_conocido", F.col("canal").isin(PHYSICAL, ONLINE), F.col("mes")), Rule("participacion", F.col("share_ecommerce_pct").between(0, 100), F.col("mes")),
                        Rule("diaria_por_dias", F.abs(F.col("venta_diaria_promedio") * F.col("dias_en_mes") - F.col("venta_mxn")) < 1, F.col("mes"))]),
        ("q3_por_mes", q3.groupBy("mes").agg(F.count_distinct("share_ecommerce_pct").alias("n")), [Rule("una_participacion", F.col("n") <= 1, F.col("mes"))]),
        ("q4_detalle", detail, [Rule("margen_negativo", F.col("margen_total_mxn") < 0, sku),
                                Rule("concilia", F.abs(F.col("ingreso_total_mxn") - F.col("costo_total_mxn") - F.col("margen_total_mxn")) < 1, sku)]),
        ("q4_sistemico", systemic, summary(F.col("margen_total_mxn") < 0)),
        ("q4_mixto", mixed, summary(F.col("margen_total_mxn") >= 0)),
        ("q4_contra_ventas", agreement(listed, whole, ["sku_pos", "nombre", "categoria"], "margen_total_mxn").where(F.col("a").isNotNull()),
         [Rule("mismo_margen", F.abs(F.col("a") - F.col("b")) < 0.01, sku)]),
    ]
