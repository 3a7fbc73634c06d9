"""The job over the real source formats, and one as-of contract for both strategies."""

import json
import random

import pytest
from retail_helpers import ts

from kardex.operators.asof import asof_join, asof_locf


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("sources")
    days = [f"2025-01-{i:02d}" for i in range(1, 29)]
    sales = ["venta_id,fecha_hora,tienda_id,sku,cantidad,monto,tipo_comprobante"]
    sales += [f"v{i},{d} 10:30:00,T{i % 2 + 1},P{i % 3 + 1},{i % 4 + 1},{50 + i}.50,{'E' if i % 9 == 8 else 'I'}" for i, d in enumerate(days)]
    (p / "sales.csv").write_text("\n".join(sales))
    (p / "rates.csv").write_text("fecha,currency,rate_to_mxn\n" + "\n".join(f"{d},USD,17.{i:02d}" for i, d in enumerate(days)))
    web = spark.createDataFrame([(f"w{i}", f"{d} 09:00:00", "h1" if i % 2 else "h9", 1, 10.0 + i, "USD" if i % 3 else "MXN") for i, d in enumerate(days)],
                                "order_id string, fecha string, product_handle string, cantidad int, amount double, currency string")
    web.write.parquet(str(p / "web"))
    doc = {
        "tiendas_info": [{"tienda_id": f"T{i}", "ciudad": f"C{i}", "region": "R", "timezone": "UTC"} for i in (1, 2)],
        "sku_mappings": [{"sku_pos": f"P{i}", "sku_erp": f"E{i}", "handle": f"h{i}"} for i in (1, 2)],
        "catalogo": {"productos": [
            {"sku_erp": "E1", "nombre": "uno", "categoria": "c", "cost_history": [
                {"fecha_vigencia": "2025-01-10", "costo_mxn": "9.0", "proveedor": "x"}, {"fecha_vigencia": "2025-01-20", "costo_mxn": "99.0", "proveedor": "x"}]},
            {"sku_erp": "E2", "nombre": "dos", "categoria": "c", "cost_history": []}]},
        "snapshots": [{"fecha": d, "tienda_id": f"T{t}", "sku_erp": f"E{e}", "cantidad_en_stock": "0" if 5 <= i <= 9 else "3.7" if i % 2 else "junk"}
                      for i, d in enumerate(days) for t in (1, 2) for e in (1, 2)]}
    (p / "inventory.json").write_text(json.dumps(doc))
    return p


def arguments(p):
    return dict(sales=str(p / "sales.csv"), rates=str(p / "rates.csv"), ecommerce=str(p / "web"), inventory=str(p / "inventory.json"))


def test_job_over_files_writes_every_result(spark, folder, tmp_path):
    from kardex.plans.analytics import Periods
    from kardex.plans.job import run_job
    from kardex.sources.files import load_all

    out = run_job(spark, output_dir=str(tmp_path / "out"), raw=load_all(spark, **arguments(folder)),
                  periods=Periods(stockout=("2025-01-01", "2025-01-20"), top_k=2))
    assert out["volumes"]["fact_ventas"]["rows"] == 56 and out["rows"]["result_resumen"] == 1
    runs = spark.read.parquet(str(tmp_path / "out/results/result_q2_quiebres")).collect()
    assert runs and all(r["dias_en_quiebre"] >= 3 and r["ciudad"] in ("C1", "C2") for r in runs)
    assert any(r["ventas_perdidas_estimadas"] > 0 for r in runs)


def test_no_persist_answers_and_writes_no_results(spark, folder, tmp_path, capsys):
    from kardex.plans.job import run_job
    from kardex.sources.files import load_all

    out = run_job(spark, output_dir=str(tmp_path / "none"), persist=False, raw=load_all(spark, **arguments(folder)))
    shown = capsys.readouterr().out
    assert {"q1_rotacion", "q2_quiebres", "q3_mom", "resumen", "q4_detalle_por_tienda"} <= set(out["rows"])
    assert "-- resumen: 1 rows" in shown and not (tmp_path / "none").exists()


def test_missing_rate_fails_and_is_counted(spark, folder):
    from kardex.operators.conform import convert_currency, missing_rates
    from kardex.sources.files import load_all

    raw = load_all(spark, **arguments(folder))
    odd = spark.createDataFrame([("JPY", 5.0, ts("2025-01-02")), (None, 1.0, ts("2025-01-02")), ("MXN", 1.0, ts("2025-01-02"))],
                                "currency string, amount double, fecha timestamp_ntz")
    with pytest.raises(Exception, match="no exchange rate for"):
        convert_currency(odd, raw.exchange_rates).collect()
    assert sum(r["filas"] for r in missing_rates(odd, raw.exchange_rates).collect()) == 2
    got = convert_currency(odd, raw.exchange_rates, on_missing="null").collect()
    assert [r["monto_mxn"] is None for r in sorted(got, key=lambda r: str(r["currency"]))] == [True, False, True]


@pytest.mark.parametrize("fallback", [False, True])
def test_strategies_agree_with_nulls_and_ties(spark, fallback):
    rng = random.Random(3)
    time = lambda: None if rng.random() < 0.15 else ts(f"2025-01-{rng.randint(1, 4):02d} {rng.randint(0, 2):02d}:00")
    key = lambda: rng.choice([None, 1, 2, 3])
    left = [(i, key(), time()) for i in range(120)]
    right = [(key(), time(), i, None if rng.random() < 0.2 else i) for i in range(25)]
    l = spark.createDataFrame(left, "id int, k int, t timestamp_ntz")
    r = spark.createDataFrame(right, "k int, rt timestamp_ntz, pos int, v int")
    how = dict(by=["k"], left_on="t", right_on="rt", value_cols=["v"], tiebreak=["pos"], fallback_first=fallback)
    one = {x["id"]: x["v"] for x in asof_join(l, r, **how).collect()}
    two = {x["id"]: x["v"] for x in asof_locf(l, r, **how).collect()}

    def brute(k, t):
        mine = sorted((x for x in right if x[0] is not None and x[0] == k and x[1] is not None), key=lambda x: (x[1], x[2]))
        if t is None or not mine:
            return None
        got = [x for x in mine if x[1] <= t]
        v = got[-1][3] if got else None
        return mine[0][3] if v is None and fallback else v

    assert one == two == {i: brute(k, t) for i, k, t in left}
    for f in (asof_join, asof_locf):
        with pytest.raises(Exception, match="null time"):
            f(l, r, **how, on_null_time="raise").collect()


def test_job_publishes_whole_versions(spark, folder, tmp_path):
    """A run whose rules fail leaves the version before it in place."""
    from kardex.plans.job import run_and_publish
    from kardex.sinks import publish
    from kardex.sources.files import load_all

    root = str(tmp_path / "published")
    raw = load_all(spark, **arguments(folder))
    out = run_and_publish(spark, root, raw=raw, expected={"fact_ventas": 56}, access_paths=True)
    model, access = (publish.read_table(spark, root, f"{kind}/fact_ventas") for kind in ("model", "access"))
    assert access.columns == model.columns and sorted(map(tuple, access.collect()), key=repr) == sorted(map(tuple, model.collect()), key=repr)
    assert {"tabla": "fact_ventas", "regla": "con_filas", "violaciones": 0, "primera_clave": None, "medida": 56.0} in out["quality"]
    assert publish.read_table(spark, root, "model/fact_ventas").count() == 56
    with pytest.raises(ValueError, match="fact_ventas has 56 rows, not 57"):
        run_and_publish(spark, root, raw=raw, expected={"fact_ventas": 57})
    assert publish.current(spark, root).endswith(out["version"])
    assert publish.read_table(spark, root, "results/result_resumen").count() == 1


def test_job_stops_at_a_broken_rule(spark, folder, tmp_path):
    """Rates that begin after the first foreign order."""
    from pyspark.sql import functions as F

    from kardex.plans.job import run_job
    from kardex.sources.files import load_all

    raw = load_all(spark, **arguments(folder))
    late = raw._replace(exchange_rates=raw.exchange_rates.where(F.col("fecha") > "2025-01-15"))
    with pytest.raises(AssertionError, match="tasas.cubren_primera_orden: 1 .first USD"):
        run_job(spark, output_dir=str(tmp_path / "late"), raw=late)
