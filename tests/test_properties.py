"""Randomised cases against brute force: many (store, SKU) groups per Spark run."""

import datetime as dt
import random

from pyspark.sql import functions as F

from kardex.operators.islands import lost_sales, stockout_runs

INV = "fecha date, tienda_id string, product_id string, sku_pos string, sku_erp string, cantidad_en_stock bigint"
STORES = "tienda_id string, ciudad string, region string, timezone string"
BASE = dt.date(2026, 1, 1)


def _random_inventory(rnd, groups=60, days=25):
    rows = []
    for g in range(groups):
        store, sku = f"T{g % 7}", f"P{g}"
        for k in range(days):
            if rnd.random() < 0.15:
                continue  # missing snapshot day
            for _ in range(2 if rnd.random() < 0.1 else 1):  # duplicated day
                rows.append((BASE + dt.timedelta(days=k), store, "PRD-" + sku, sku, "E" + sku, rnd.choice([0, 0, 0, 1, 5])))
    return rows


def _brute_runs(rows, min_days=3):
    """Islands as the SQL defines them: id = running count of non-zero rows with a RANGE frame
    (rows on the same date share it); a run = zero rows with one id; keep runs of >= min_days rows."""
    by_key = {}
    for d, store, _, sku, _, stock in rows:
        by_key.setdefault((store, sku), []).append((d, stock))
    out = set()
    for (store, sku), series in by_key.items():
        groups = {}
        for d, stock in series:
            if stock != 0:
                continue
            gid = sum(1 for d2, s2 in series if d2 <= d and s2 != 0)
            groups.setdefault(gid, []).append(d)
        for days in groups.values():
            if len(days) >= min_days:
                out.add((store, sku, min(days), max(days), len(days)))
    return out


def test_islands_match_brute_force(spark):
    rows = _random_inventory(random.Random(11))
    got = {(r["tienda_id"], r["sku_pos"], r["inicio_quiebre"], r["fin_quiebre"], r["dias_en_quiebre"])
           for r in stockout_runs(spark.createDataFrame(rows, INV)).collect()}
    assert got == _brute_runs(rows) and len(got) > 20


def test_lookback_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = _random_inventory(rnd, groups=40)
    sales = []
    for g in range(40):
        for _ in range(60):
            day = BASE + dt.timedelta(days=rnd.randint(-20, 25))
            sales.append((dt.datetime.combine(day, dt.time(rnd.randint(0, 23))), f"T{g % 7}", f"P{g}",
                          rnd.choice(["fisico", "fisico", "ecommerce"]), rnd.randint(1, 9)))
    sdf = spark.createDataFrame(sales, "fecha timestamp_ntz, tienda_id string, sku_pos string, canal string, cantidad bigint")
    stores = spark.createDataFrame([(f"T{i}", f"C{i}", "R", "UTC") for i in range(7)], STORES)
    got = {(r["tienda_id"], r["sku_pos"], r["inicio_quiebre"]): (r["avg_unidades_diarias_14d"], r["ventas_perdidas_estimadas"])
           for r in lost_sales(stockout_runs(spark.createDataFrame(rows, INV)), sdf, stores).collect()}
    want = {}
    for store, sku, start, _, days in _brute_runs(rows):
        units = sum(q for t, s, k, c, q in sales if s == store and k == sku and c == "fisico"
                    and start - dt.timedelta(days=14) <= t.date() <= start - dt.timedelta(days=1))
        avg = units / 14.0
        want[(store, sku, start)] = (round(avg * 100) / 100, round(avg * days * 10) / 10)
    assert got.keys() == want.keys() and len(got) > 10
    for k, (a, lost) in want.items():
        ga, gl = got[k]
        assert abs(ga - a) < 1e-9 and abs(gl - lost) < 1e-9, k
