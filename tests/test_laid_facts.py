"""Facts landed by SKU: the summary by SQL adds them up and joins them where they lie, with the same rows."""

import datetime as dt
import re
from decimal import Decimal

import pytest

from kardex.plans import registry
from kardex.plans.model import Model
from kardex.session import ensure_checkpoint_dir, planned_with
from kardex.sinks.staging import stage_laid

FACTS = ("order_id string, fecha timestamp_ntz, tienda_id string, product_id string, sku_pos string, sku_erp string, canal string, cantidad bigint, "
         "monto_mxn decimal(18,4), costo_mxn decimal(18,4), costo_total_mxn decimal(18,4), margen_mxn decimal(18,4), margen_pct double, "
         "nombre string, categoria string")
SETTING = "spark.sql.requireAllClusterKeysForCoPartition"


def rows_of(df):
    return sorted(map(str, df.collect()))


def sale(n, sku, store, units, income, cost, name="a", kind="k"):
    total = None if cost is None or units is None else Decimal(cost) * units
    margin = None if total is None or income is None else Decimal(income) - total
    return (f"V{n}", dt.datetime(2024, 1, 1), store, None, sku, None, "fisico", units, None if income is None else Decimal(income),
            None if cost is None else Decimal(cost), total, margin, None, name, kind)


def facts(spark):
    rows = [sale(1, "P1", "T1", 2, "10", "6"), sale(2, "P1", "T1", 1, "9", "1"), sale(3, "P1", "T2", 1, "1", "5"),
            sale(4, "P1", None, 1, "1", "5"), sale(5, "P2", "T1", 1, "9", "5"), sale(6, None, "T1", 1, "1", "5"),
            sale(7, "P3", None, 1, "1", "5"), sale(8, "P4", "T1", 0, "-1", "5", name=None), sale(9, "P4", "T1", 3, "1", "5", kind=None),
            sale(10, "P5", "T1", 1, None, "5"), sale(11, "P5", "T1", 1, "1", None), sale(12, "P5", "T1", None, "1", "5")]
    rows += [sale(100 + i, f"P{i % 40}", f"T{i % 7}", 1 + i % 3, str(5 + i % 11), str(1 + i % 5), name=f"n{i % 2}") for i in range(400)]
    return spark.createDataFrame(rows + rows[:9], FACTS)


@pytest.fixture
def summary(spark, monkeypatch):
    """The query over the facts above, laid in ``parts`` buckets or (None) not; ``ran`` gets the plan that wrote the result."""

    def run(parts, ran):
        f = facts(spark)
        staged = registry.stage_shared

        def note(df, name):
            ran.append(df._jdf.queryExecution().executedPlan().toString())
            return staged(df, name)

        monkeypatch.setattr(registry, "_sku_model", lambda s, d: (Model(f, f, f, f, f), parts))
        with monkeypatch.context() as m:
            m.setattr(registry, "stage_shared", note)
            return registry.q_neg_margin_summary_sql(spark, "")

    return run


def test_summary_by_sql_of_laid_facts(spark, summary):
    lazy, ran = rows_of(summary(None, [])), []
    with planned_with(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):  # joins as on large tables
        laid = rows_of(summary(5, ran))
    assert laid == lazy and len(laid) > 10 and any("nombre=None" in r for r in laid)
    exchanges = re.findall(r"Exchange hashpartitioning", ran[0])
    assert ran[0].count("Bucketed: true") == 3 and ran[0].count("SortMergeJoin") == 2
    assert len(exchanges) == 2  # of the two distinct counts: the facts themselves are not shuffled again


def test_laid_rows_are_found_in_place(spark):
    rows = spark.createDataFrame([(k, v) for k in ["a", "b", None, "c"] for v in (1, 2, 2)], "k string, v int")
    laid = stage_laid(rows, "probe", "k", 3)
    assert rows_of(laid) == rows_of(rows)
    assert "Exchange" not in laid.groupBy("k", "v").count()._jdf.queryExecution().executedPlan().toString()
    [file, *_] = laid.inputFiles()
    assert ensure_checkpoint_dir(spark).removeprefix("file:").rstrip("/") in file
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("probe")]


def test_settings_end_with_the_block(spark):
    before = spark.conf.get(SETTING)
    with pytest.raises(ZeroDivisionError), planned_with(spark, {SETTING: "false"}):
        assert spark.conf.get(SETTING) == "false"
        1 / 0
    assert spark.conf.get(SETTING) == before == "true"
    spark.conf.set(SETTING, "false")
    try:
        with planned_with(spark, {SETTING: "true"}):
            pass
        assert spark.conf.get(SETTING) == "false"
    finally:
        spark.conf.unset(SETTING)
