"""Layout by counted rows: what bounds a task where sums per SKU, pairs or keys follow a shuffle."""

import re

from pyspark.sql import functions as F

from kardex.operators.asof import asof_locf
from kardex.operators.islands import stockouts
from kardex.operators.margin import margin_base, margin_by_sku, margin_summary
from kardex.plans.model import build_model, no_stage, row_partitions, sku_partitions
from kardex.sources import testdata as td

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(str, df.collect()))


def exchanges(df, keys):
    """Exchanges of the plan whose keys are all among ``keys``: (keys, partitions)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"Exchange hashpartitioning\(([^)]*), (\d+)\)", plan)
    clean = [(tuple(re.sub(r"#\d+L?", "", k).strip() for k in ks.split(",")), int(n)) for ks, n in found]
    return [(ks, n) for ks, n in clean if set(ks) <= set(keys)]


def test_partitions_follow_the_rows(spark):
    raw = td.load_sources(spark, SF)
    rows = raw.sales.count() + raw.ecommerce.count()
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sku_partitions(raw) is None
    assert sku_partitions(raw, rows_per_task=10, laid_from=100) == max(session, -(-rows // 10))
    assert sku_partitions(raw, rows_per_task=10, laid_from=100, max_rows=5) is None  # a hot SKU is collapsed first
    assert row_partitions(spark, 10**9, 1000) == 10**6


def test_summary_on_facts_laid_by_sku(spark):
    raw = td.load_sources(spark, SF)
    plain = margin_summary(margin_by_sku(margin_base(build_model(raw, no_stage).fact_ventas)))
    laid = margin_summary(margin_by_sku(margin_base(build_model(raw, no_stage, sku_parts=37).fact_ventas), 37))
    assert rows_of(laid) == rows_of(plain) and plain.count() > 0
    per_sku = exchanges(laid, ["sku_pos", "nombre", "categoria", "tienda_id", "canal"])
    assert (("sku_pos",), 37) in per_sku and not [ks for ks, _ in per_sku if "tienda_id" in ks]  # groups form where the facts lie


def test_stockouts_in_counted_partitions(spark):
    m = build_model(td.load_sources(spark, SF), no_stage)
    act = td.activity_sales(spark, SF, m.dim_producto)
    plain = stockouts(m.fact_inventario, act, m.dim_tiendas)
    parts = stockouts(m.fact_inventario, act, m.dim_tiendas, inventory_parts=41, sales_parts=43)
    assert rows_of(parts) == rows_of(plain) and plain.count() > 0
    met = exchanges(parts, ["tienda_id", "sku_pos"])
    assert {n for _, n in met} >= {41, 43}


def test_sorted_asof_shuffles_the_rows_once(spark):
    left = spark.createDataFrame([(1, 5, "a"), (1, 1, "b"), (2, 9, "c"), (None, 3, "d"), (3, 3, "e"), (1, None, "f")], "k int, t int, x string")
    right = spark.createDataFrame([(1, 2, 20), (1, 4, None), (2, 9, 90), (2, None, 7), (None, 1, 8)], "k int, rt int, v int")
    stamp = lambda df, c: df.withColumn(c, F.timestamp_seconds(F.col(c)).cast("timestamp_ntz"))
    out = asof_locf(stamp(left, "t"), stamp(right, "rt"), ["k"], "t", "rt", ["v"], fallback_first=True)
    assert {r["x"]: r["v"] for r in out.collect()} == {"a": 20, "b": 20, "c": 90, "d": None, "e": None, "f": None}
    ran = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert ran.count("Exchange hashpartitioning") == 1
