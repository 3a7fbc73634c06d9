import json

import pytest

from kardex.sources.files import read_inventory_json, read_sales_csv, require_rows

DOC = {
    "tiendas_info": [{"tienda_id": "T1", "ciudad": "Ciudad1", "region": "Region1", "timezone": "UTC"}],
    "sku_mappings": [{"sku_pos": "P1", "sku_erp": "E1", "handle": "h1"}, {"sku_pos": "P2", "sku_erp": None, "handle": None}],
    "catalogo": {"productos": [
        {"sku_erp": "E1", "nombre": "Producto1", "categoria": "cat1", "cost_history": [
            {"fecha_vigencia": "2025-01-01", "costo_mxn": "100.5", "proveedor": "A"},
            {"fecha_vigencia": "2025-06-01", "costo_mxn": "110", "proveedor": "A"}]},
        {"sku_erp": "E2", "nombre": "Te", "categoria": "hoja", "cost_history": []},
        {"sku_erp": "E3", "nombre": "Taza", "categoria": "otros"},
    ]},
    "snapshots": [
        {"fecha": "2026-01-01", "tienda_id": "T1", "sku_erp": "E1", "cantidad_en_stock": "3.7"},
        {"fecha": "2026-01-02", "tienda_id": "T1", "sku_erp": "E1", "cantidad_en_stock": "abc"},
        {"fecha": "2026-01-03", "tienda_id": "T1", "sku_erp": "E1", "cantidad_en_stock": None},
        {"fecha": "2026-01-04", "tienda_id": "T1", "sku_erp": "E1", "cantidad_en_stock": "5"},
    ],
}


def test_nested_inventory_document(spark, tmp_path):
    p = tmp_path / "inventory.json"
    p.write_text(json.dumps(DOC, indent=2))
    t = read_inventory_json(spark, str(p))
    assert t["tiendas"].count() == 1 and t["sku_map"].count() == 2
    cat = t["catalogo"].orderBy("fecha_vigencia").collect()
    # products without history give no rows
    assert [(r["sku_erp"], float(r["costo_mxn"]), r["pos"]) for r in cat] == [("E1", 100.5, 0), ("E1", 110.0, 1)]
    assert [r["cantidad_en_stock"] for r in t["snapshots"].orderBy("fecha").collect()] == [3, 0, 0, 5]


def test_json_lines_fragments(spark, tmp_path):
    p = tmp_path / "inventory.jsonl"
    frags = [{"tiendas_info": DOC["tiendas_info"]}, {"sku_mappings": DOC["sku_mappings"]}, {"snapshots": DOC["snapshots"]}]
    p.write_text("\n".join(json.dumps(f) for f in frags))
    t = read_inventory_json(spark, str(p), multiline=False)
    assert (t["tiendas"].count(), t["sku_map"].count(), t["snapshots"].count(), t["catalogo"].count()) == (1, 2, 4, 0)


def test_sales_csv_and_empty_guard(spark, tmp_path):
    p = tmp_path / "sales.csv"
    p.write_text("venta_id,fecha_hora,tienda_id,sku,cantidad,monto,tipo_comprobante\n"
                 "1,2025-10-01 09:15:00,T1,P1,2,150.50,I\n2,2025-10-01 10:00:00,T1,P1,1,75.25,E\n")
    df = read_sales_csv(spark, str(p))
    rows = df.orderBy("venta_id").collect()
    assert [float(r["monto"]) for r in rows] == [150.5, 75.25] and rows[0]["fecha_hora"].hour == 9
    with pytest.raises(ValueError, match="no rows"):
        require_rows(df.where("cantidad > 100"), "sales")


def test_rates_csv_and_web_orders_parquet(spark, tmp_path):
    from kardex.sources.files import read_ecommerce_parquet, read_exchange_rates_csv

    p = tmp_path / "rates.csv"
    p.write_text("fecha,currency,rate_to_mxn\n2025-04-01 00:00:00,USD,17.25\n2025-04-02,EUR,18.9\n")
    rates = {r["currency"]: (str(r["fecha"]), float(r["rate_to_mxn"])) for r in read_exchange_rates_csv(spark, str(p)).collect()}
    assert rates == {"USD": ("2025-04-01", 17.25), "EUR": ("2025-04-02", 18.9)}
    web = spark.createDataFrame([("o1", "2025-04-01 10:00:00", "h1", 2, 10.5, "USD")],
                                "order_id string, fecha string, product_handle string, cantidad int, amount double, currency string")
    web.write.parquet(str(tmp_path / "web"))
    r = read_ecommerce_parquet(spark, str(tmp_path / "web")).first()
    assert r["fecha"].hour == 10 and r["cantidad"] == 2 and float(r["amount"]) == 10.5


def test_table_sink_nested_json_counts_and_overwrite(spark, tmp_path):
    from pyspark.sql import functions as F

    from kardex.sinks.tables import write_table

    df = spark.createDataFrame([("P1", "2025-01", [("T1", None, -5.0)]), ("P2", "2025-02", [])],
                               "sku_pos string, mes string, tiendas array<struct<tienda_id:string, ciudad:string, m:double>>")
    out = str(tmp_path / "t")
    observed = {}
    n = write_table(df, out, partition_by=["mes"], flat=True,
                    metrics={"vacias": F.count_if(F.size("tiendas") == 0)}, observed_out=observed)
    assert n == 2 and observed["vacias"] == 1
    back = {r["sku_pos"]: r for r in spark.read.parquet(out).collect()}
    assert json.loads(back["P1"]["tiendas"]) == [{"tienda_id": "T1", "ciudad": None, "m": -5.0}]
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("mes=")) == ["mes=2025-01", "mes=2025-02"]
    assert write_table(df, out, partition_by=["mes"], flat=True) == 2 and spark.read.parquet(out).count() == 2


def test_partitioned_write_spreads_a_hot_value(spark, tmp_path):
    from pyspark.sql import functions as F

    from kardex.sinks.tables import write_table

    # several map tasks, one hot value, and an advisory size far below the value's bytes
    df = spark.range(0, 400_000, 1, 8).select(F.lit("2025-01").alias("mes"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    out = tmp_path / "hot"
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        assert write_table(df, str(out), partition_by=["mes"]) == 400_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = [p for p in (out / "mes=2025-01").iterdir() if p.name.endswith(".parquet")]
    assert len(files) > 1 and spark.read.parquet(str(out)).count() == 400_000
