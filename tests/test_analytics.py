import datetime as dt

import pytest
from retail_helpers import d, dec, ts
from pyspark.sql import functions as F

from kardex.operators import margin
from kardex.operators.islands import lost_sales, stockout_runs
from kardex.operators.kpis import executive_kpis
from kardex.operators.margin import flatten_affected, margin_base, margin_by_sku, margin_summary, national_price, negative_margin
from kardex.operators.periods import month_over_month
from kardex.operators.turnover import turnover, turnover_top

INV = "fecha date, tienda_id string, product_id string, sku_pos string, sku_erp string, cantidad_en_stock bigint"
FV = ("order_id string, fecha timestamp_ntz, tienda_id string, product_id string, sku_pos string, sku_erp string, "
      "canal string, cantidad bigint, monto_mxn decimal(18,4), costo_mxn decimal(18,4), costo_total_mxn decimal(18,4), "
      "margen_mxn decimal(18,4), margen_pct double, nombre string, categoria string")
STORES = "tienda_id string, ciudad string, region string, timezone string"


def _inv(spark, stocks, start="2026-01-01", days=None):
    base = dt.date.fromisoformat(start)
    days = days or list(range(len(stocks)))
    return spark.createDataFrame([(base + dt.timedelta(days=k), "T1", "PRD-P1", "P1", "E1", s)
                                  for k, s in zip(days, stocks)], INV)


def test_islands_one_run_of_three(spark):
    runs = stockout_runs(_inv(spark, [0, 0, 0, 1, 0, 0])).collect()
    assert [(r["inicio_quiebre"], r["dias_en_quiebre"]) for r in runs] == [(d("2026-01-01"), 3)]


def test_island_over_missing_day_counts_rows(spark):
    inv = _inv(spark, [0, 0, 0], days=[0, 1, 3])
    assert [r["dias_en_quiebre"] for r in stockout_runs(inv).collect()] == [3]
    assert stockout_runs(inv, calendar=True).count() == 0


def test_run_clipped_to_period(spark):
    inv = _inv(spark, [0, 0, 0, 0], start="2025-12-30")
    assert stockout_runs(inv, start="2026-01-01").count() == 0


def test_lookback_rate_and_lost_units(spark):
    inv = _inv(spark, [0, 0, 0], start="2026-02-01")
    sales = spark.createDataFrame([(ts(t), "T1", "P1", "fisico", 14) for t in
                                   ["2026-01-18 10:00", "2026-01-17 10:00", "2026-02-01 10:00"]],
                                  "fecha timestamp_ntz, tienda_id string, sku_pos string, canal string, cantidad bigint")
    stores = spark.createDataFrame([("T1", "Ciudad1", "Region1", "x")], STORES)
    r = lost_sales(stockout_runs(inv), sales, stores).first()
    assert (r["avg_unidades_diarias_14d"], r["ventas_perdidas_estimadas"], r["ciudad"]) == (1.0, 3.0, "Ciudad1")


def _fv(spark, rows):
    out = []
    for i, (t, store, sku, canal, qty, monto, costo) in enumerate(rows):
        ct = None if costo is None else dec(costo) * qty
        mg = None if costo is None else dec(monto) - ct
        pct = None if mg is None or monto == 0 else float(mg) / monto * 100
        out.append((f"o{i}", ts(t), store, "PRD-" + sku, sku, "E" + sku, canal, qty, dec(monto),
                    None if costo is None else dec(costo), ct, mg, pct, "n" + sku, "c"))
    return spark.createDataFrame(out, FV)


def test_zero_stock_sku_dropped_from_turnover(spark):
    fv = _fv(spark, [("2026-01-05 10:00", "T1", "P1", "fisico", 4, 40, 1), ("2026-01-05 10:00", "T1", "P2", "fisico", 4, 40, 1),
                     ("2026-01-05 10:00", "ECOMMERCE", "P1", "ecommerce", 2, 20, 1)])
    inv = spark.createDataFrame([(d("2026-01-05"), "T1", "PRD-P1", "P1", "E1", 2), (d("2026-01-05"), "T1", "PRD-P2", "P2", "E2", 0)], INV)
    rows = turnover(fv, inv).collect()
    assert [r["sku_pos"] for r in rows] == ["P1"]
    r = rows[0]
    assert (r["rotacion_fisica"], r["rotacion_extendida"], r["pct_ventas_con_inventario"]) == (2.0, 3.0, 66.7)
    assert turnover_top(fv, inv, k=1).count() == 1


def test_mom_first_month_null_share_and_month_end(spark):
    fv = _fv(spark, [("2026-01-10 10:00", "T1", "P1", "fisico", 1, 310, 1),
                     ("2026-02-10 10:00", "T1", "P1", "fisico", 1, 560, 1),
                     ("2026-02-10 10:00", "ECOMMERCE", "P1", "ecommerce", 1, 560, 1),
                     ("2026-03-31 00:00", "T1", "P1", "fisico", 1, 31, 1),
                     ("2026-03-31 10:00", "T1", "P1", "fisico", 1, 31, 1)])
    rows = {(r["mes"], r["canal"]): r for r in month_over_month(fv, "2026-01-01", "2026-03-31").collect()}
    assert rows[("2026-01", "fisico")]["variacion_pct_mom"] is None
    assert rows[("2026-01", "fisico")]["share_ecommerce_pct"] == 0.0
    assert rows[("2026-02", "fisico")]["variacion_pct_mom"] == 100.0
    assert rows[("2026-02", "ecommerce")]["share_ecommerce_pct"] == 50.0
    assert rows[("2026-03", "fisico")]["venta_mxn"] == 62.0
    strict = {(r["mes"], r["canal"]): r for r in
              month_over_month(fv, "2026-01-01", "2026-03-31", inclusive_end_day=False).collect()}
    assert strict[("2026-03", "fisico")]["venta_mxn"] == 31.0


def test_cause_order_and_systemic_mixed_split(spark):
    rows = [
        # P1 at T1: low price (national avg is pulled up by T2), one transaction
        ("2026-01-01 10:00", "T1", "P1", "fisico", 1, 10, 50), ("2026-01-01 10:00", "T2", "P1", "fisico", 1, 500, 50),
        # P2 at T1: normal price, 3 transactions, 5 units -> promo
        *[("2026-01-0%d 10:00" % k, "T1", "P2", "fisico", q, 10 * q, 12) for k, q in [(1, 1), (2, 2), (3, 2)]],
        ("2026-01-05 10:00", "T2", "P2", "fisico", 50, 550, 10),
        # P3 at T1: 3 transactions, 50 units -> shrink; chain-wide negative
        *[("2026-01-0%d 10:00" % k, "T1", "P3", "fisico", q, 10 * q, 11) for k, q in [(1, 10), (2, 20), (3, 20)]],
    ]
    stores = spark.createDataFrame([("T1", "A", "R", "x"), ("T2", "B", "R", "x")], STORES)
    rep = negative_margin(_fv(spark, rows), stores)
    causes = {r["sku_pos"]: r["posible_causa"] for r in rep.detalle_por_tienda.where(F.col("tienda_id") == "T1").collect()}
    assert causes == {"P1": "precio_regional_bajo", "P2": "promocion_mal_configurada", "P3": "merma_operativa"}
    assert [r["sku_pos"] for r in rep.resumen_sistemico.collect()] == ["P3"]
    mixed = {r["sku_pos"]: r for r in rep.resumen_mixto.collect()}
    assert set(mixed) == {"P1", "P2"} and mixed["P1"]["tiendas_con_margen_negativo"] == 1
    assert [t["tienda_id"] for t in mixed["P2"]["tiendas_negativas"]] == ["T1"]
    flat = flatten_affected(rep.resumen_mixto).collect()
    assert {(r["sku_pos"], r["posicion"]) for r in flat} == {("P1", 1), ("P2", 1)}


@pytest.mark.parametrize("most, base_shuffles", [(2_000_000, 1), (0, 2)])
def test_margin_groups_meet_by_sku_once(spark, monkeypatch, most, base_shuffles):
    """Detail and summary add up rows of one table by SKU: no join for the national price, no aggregate per store."""
    rows = [("2026-01-01 10:00", t, s, c, q, m, 20) for t, s, c, q, m in
            [("T1", "P1", "fisico", 1, 10), ("T1", "P1", "fisico", 2, 90), ("T1", "P1", "ecommerce", 3, 1), ("T2", "P1", "fisico", 1, 50),
             ("T3", "P1", "fisico", 1, 25), ("T3", "P1", "ecommerce", 1, 25), ("T1", "P2", "fisico", 1, 30), ("T2", "-", "fisico", 1, 5)]]
    fv = _fv(spark, rows).withColumn("sku_pos", F.nullif("sku_pos", F.lit("-")))
    fv = fv.withColumn("nombre", F.when(F.col("tienda_id") == "T2", "otro").otherwise(F.col("nombre")))
    stores = spark.createDataFrame([("T1", "A", "R", "x"), ("T2", "B", "R", "x")], STORES)
    shuffles = {}

    def stage(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        shuffles[name] = plan.count("Exchange hashpartitioning")
        return spark.createDataFrame(df.collect(), df.schema)

    monkeypatch.setattr(margin, "MAX_ROWS_PER_SKU", most)  # beyond it a hot SKU is collapsed first
    rep = negative_margin(fv, stores, stage=stage)
    assert shuffles == {"margin_base": base_shuffles, "margin_detail": 2, "margin_summary": 1}  # detail: stores alone
    base = margin_base(fv)
    price = {r["sku_pos"]: r["precio_nacional_promedio"] for r in national_price(base).collect() if r["sku_pos"]}
    assert {(r["sku_pos"], r["precio_nacional_promedio"]) for r in rep.detalle_por_tienda.collect()} == {("P1", price["P1"]), (None, None)}
    got = {(r["sku_pos"], r["nombre"]): (r["tiendas_totales"], r["tiendas_con_margen_negativo"], r["num_transacciones"], r["margen_total_mxn"])
           for r in margin_summary(margin_by_sku(base)).collect()}
    assert got == {("P1", "nP1"): (2, 1, 5, -9.0), ("P1", "otro"): (1, 0, 1, 30.0), (None, "otro"): (1, 1, 1, -15.0)}


def test_kpis_one_scan(spark):
    fv = _fv(spark, [("2026-01-01 10:00", "T1", "P1", "fisico", 1, 10, 1), ("2026-01-01 10:00", "ECOMMERCE", "P2", "ecommerce", 1, 5, 1)])
    r = executive_kpis(fv).first()
    assert (r["total_ventas_mxn"], r["ventas_fisicas_mxn"], r["ventas_ecommerce_mxn"], r["total_transacciones"],
            r["tiendas_activas"], r["skus_activos"]) == (15.0, 10.0, 5.0, 2, 1, 2)


def test_channel_share_pivot_zero_when_missing(spark):
    from kardex.operators.periods import channel_share
    fv = _fv(spark, [("2026-01-10 10:00", "T1", "P1", "fisico", 1, 300, 1),
                     ("2026-02-10 10:00", "T1", "P1", "fisico", 1, 100, 1),
                     ("2026-02-10 10:00", "ECOMMERCE", "P1", "ecommerce", 1, 300, 1)])
    rows = {r["mes"]: r for r in channel_share(fv).collect()}
    assert (rows["2026-01"]["venta_ecommerce"], rows["2026-01"]["share_ecommerce_pct"]) == (0.0, 0.0)
    assert rows["2026-02"]["share_ecommerce_pct"] == 75.0


def test_runs_of_a_hot_pair_over_blocks(spark):
    """One (store, SKU) with a third of all rows, several snapshots a day, runs over year ends; by rows
    and by calendar days, against brute force."""
    import datetime as dt
    import random

    rng = random.Random(12)
    rows = []
    for t, p, n in [("A", "hot", 900)] + [(f"T{i}", f"P{i % 5}", 45) for i in range(40)] + [(None, "P1", 60)]:
        day = dt.date(2023, 11, 1)
        for _ in range(n):
            day += dt.timedelta(days=rng.choice((0, 1, 1, 1, 2)))
            rows.append((day, t, None, p, None, rng.choice((0, 0, 0, 0, 3, None))))
    inv = spark.createDataFrame(rows, "fecha date, tienda_id string, product_id string, sku_pos string, sku_erp string, cantidad_en_stock bigint").repartition(5)

    def brute(calendar):
        out = set()
        for pair in {(r[1], r[3]) for r in rows}:
            days = {}
            for r in rows:
                if (r[1], r[3]) == pair:
                    z, o = days.get(r[0], (0, 0))
                    days[r[0]] = (z + (r[5] == 0), o + (r[5] != 0))
            group, groups = 0, {}
            for i, d in enumerate(sorted(x for x in days if days[x][0] or not calendar)):
                z, o = days[d]
                group = d.toordinal() - i if calendar else group + o
                if z:
                    groups.setdefault(group, []).append((d, 1 if calendar else z))
            for g in groups.values():
                n = sum(z for _, z in g)
                if n >= 3:
                    out.add((*pair, g[0][0], g[-1][0], n))
        return out

    for calendar in (False, True):
        for block in (None, "year", "month"):
            got = stockout_runs(inv, calendar=calendar, block=block).collect()
            assert {(r["tienda_id"], r["sku_pos"], r["inicio_quiebre"], r["fin_quiebre"], r["dias_en_quiebre"]) for r in got} == brute(calendar)
            assert len(got) == len(brute(calendar))


def test_lookback_plan_has_no_range_join(spark):
    inv = _inv(spark, [0, 0, 0, 1, 0, 0])
    sales = spark.createDataFrame([], "fecha timestamp_ntz, tienda_id string, sku_pos string, canal string, cantidad bigint")
    stores = spark.createDataFrame([], "tienda_id string, ciudad string, region string")
    plan = lost_sales(stockout_runs(inv), sales, stores)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any(op in line.replace("<=>", "=") for line in joins for op in (">=", "<="))
