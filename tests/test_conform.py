from retail_helpers import d, dec, ts

from kardex.operators.conform import (build_dim_tiendas, build_fact_inventario, clean_snapshots, convert_currency,
                                      transform_sales)
from kardex.sources.files import SALES_SCHEMA


def _sales(spark, rows):
    return spark.createDataFrame(rows, SALES_SCHEMA)


def test_signed_amounts_keep_income_and_credit(spark):
    rows = [(f"v{i}", ts("2025-01-01 10:00"), "T1", "P1", 1, dec(m), t)
            for i, (t, m) in enumerate([("I", 10), ("E", 4), ("P", 9), ("N", 9), ("T", 9), (None, 9)])]
    out = transform_sales(_sales(spark, rows)).orderBy("order_id").collect()
    assert [float(r["monto_mxn"]) for r in out] == [10.0, -4.0]
    assert {r["canal"] for r in out} == {"fisico"}


def test_credit_units_stay_positive(spark):
    rows = [("v1", ts("2025-01-01 10:00"), "T1", "P1", 2, dec(5), "E")]
    out = transform_sales(_sales(spark, rows)).first()
    assert out["cantidad"] == 2 and float(out["monto_mxn"]) == -5.0
    signed = transform_sales(_sales(spark, rows), signed_units=True).first()
    assert signed["cantidad"] == -2 and float(signed["monto_mxn"]) == -5.0


def test_fx_day_rate_identity_and_fallback(spark):
    orders = spark.createDataFrame([
        ("o1", ts("2025-04-02 13:00"), dec(10), "USD"),
        ("o2", ts("2025-04-02 13:00"), dec(10), "MXN"),
        ("o3", ts("2025-04-05 09:00"), dec(10), "USD"),
    ], "order_id string, fecha timestamp_ntz, amount decimal(18,4), currency string")
    rates = spark.createDataFrame([
        (d("2025-04-01"), "USD", dec("17.5")), (d("2025-04-02"), "USD", dec("18")),
    ], "fecha date, currency string, rate_to_mxn decimal(12,6)")
    got = {r["order_id"]: float(r["monto_mxn"]) for r in convert_currency(orders, rates).collect()}
    assert got == {"o1": 180.0, "o2": 10.0, "o3": 175.0}


def test_fx_missing_currency_raises_by_default(spark):
    import pytest
    orders = spark.createDataFrame([("o1", ts("2025-04-02 13:00"), dec(10), "GBP")],
                                   "order_id string, fecha timestamp_ntz, amount decimal(18,4), currency string")
    rates = spark.createDataFrame([(d("2025-04-01"), "USD", dec("17.5"))], "fecha date, currency string, rate_to_mxn decimal(12,6)")
    assert convert_currency(orders, rates, on_missing="null").first()["monto_mxn"] is None
    with pytest.raises(Exception, match="no exchange rate"):
        convert_currency(orders, rates).collect()


def test_store_dimension_has_virtual_store(spark):
    t = spark.createDataFrame([("T1", "Ciudad1", "Region1", "UTC")], "tienda_id string, ciudad string, region string, timezone string")
    rows = {r["tienda_id"]: r for r in build_dim_tiendas(t).collect()}
    assert rows["ECOMMERCE"]["ciudad"] == "Online" and rows["ECOMMERCE"]["region"] == "ecommerce"


def test_inventory_lookup_and_dirty_stock(spark):
    snaps = spark.createDataFrame([("2026-01-01", "T1", "E1", "3.7"), ("2026-01-02", "T1", "E9", "abc")],
                                  "fecha string, tienda_id string, sku_erp string, cantidad_en_stock string")
    dim = spark.createDataFrame([("PRD-P1", "P1", "E1", None, "a", "c")],
                                "product_id string, sku_pos string, sku_erp string, handle string, nombre string, categoria string")
    out = {r["sku_erp"]: r for r in build_fact_inventario(clean_snapshots(snaps), dim).collect()}
    assert out["E1"]["product_id"] == "PRD-P1" and out["E1"]["cantidad_en_stock"] == 3
    assert out["E9"]["product_id"] is None and out["E9"]["cantidad_en_stock"] == 0
