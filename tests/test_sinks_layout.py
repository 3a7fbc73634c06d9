"""Layout along a curve, publishing in one step, rescued rows, KPI states and rules."""

import datetime as dt
import glob
import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from retail_helpers import dec, ts

from kardex.operators import rules as rl
from kardex.operators.kpi_states import code_numbers, daily_states, kpis_of
from kardex.operators.kpis import executive_kpis
from kardex.sinks import layout, publish
from kardex.sources.rescue import read_csv_rescued, read_sales_rescued


def groups_read(path, column, value):
    """(row groups whose statistics let the value in, all row groups)."""
    hit = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total += 1
            hit += s is None or s.min <= value <= s.max
    return hit, total


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(5)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 364)), f"P{rng.randint(0, 999):04d}", f"T{rng.randint(0, 199):03d}", rng.random()) for _ in range(60_000)]
    return spark.createDataFrame(rows, "fecha date, sku_pos string, tienda_id string, x double").cache()


def test_every_column_of_the_curve_skips_row_groups(spark, sales, tmp_path):
    columns = ["fecha", "sku_pos", "tienda_id"]
    layout.write_clustered(sales, f"{tmp_path}/curve", columns, bloom=["sku_pos", "tienda_id"], files=64, row_group_bytes=32 << 10)
    sales.repartitionByRange(64, *columns).sortWithinPartitions(*columns).write.option("parquet.block.size", str(32 << 10)).option("parquet.page.size", "4096").parquet(f"{tmp_path}/plain")
    rng = random.Random(1)
    probes = {"fecha": [dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 364)) for _ in range(20)],
              "sku_pos": [f"P{rng.randint(0, 999):04d}" for _ in range(20)], "tienda_id": [f"T{rng.randint(0, 199):03d}" for _ in range(20)]}
    read = lambda name, c: [hit / total for hit, total in (groups_read(f"{tmp_path}/{name}", c, v) for v in probes[c])]
    share = {name: {c: sum(read(name, c)) / 20 for c in columns} for name in ("curve", "plain")}
    assert all(v < 0.55 for v in share["curve"].values()), share
    assert share["plain"]["sku_pos"] > 0.8 and share["plain"]["tienda_id"] > 0.8, share
    back = spark.read.parquet(f"{tmp_path}/curve")
    assert back.columns == sales.columns and back.count() == 60_000 and back.exceptAll(sales).isEmpty()
    meta = pq.ParquetFile(glob.glob(f"{tmp_path}/curve/*.parquet")[0]).metadata
    assert meta.num_row_groups >= 1


def test_curve_interleaves_and_takes_nulls(spark):
    df = spark.createDataFrame([(i, j) for i in range(4) for j in range(4)] + [(None, None)], "a int, b int")
    bounds = {"a": [1, 2, 3], "b": [1, 2, 3]}
    got = {(r["a"], r["b"]): r["p"] for r in df.select("a", "b", layout.curve(df, bounds, 2).alias("p")).collect()}
    want = {(i, j): (i & 1) | (j & 1) << 1 | (i >> 1) << 2 | (j >> 1) << 3 for i in range(4) for j in range(4)}
    assert got == want | {(None, None): 0}
    assert layout.cuts(df, ["a"], 2) == {"a": [1, 2, 3]}
    assert layout.cuts(df.limit(0), ["a"], 2) == {"a": []}
    hot = spark.createDataFrame([(7,)] * 90 + [(i,) for i in range(10)], "a int")
    assert len(layout.cuts(hot, ["a"], 3)["a"]) <= 3  # a value with most rows takes no more than its cuts


def test_a_run_that_dies_leaves_the_last_version(spark, tmp_path):
    root = str(tmp_path / "tables")
    put = lambda n: lambda folder: spark.range(n).write.parquet(f"{folder}/t")
    assert publish.current(spark, root) is None
    with pytest.raises(FileNotFoundError):
        publish.read_table(spark, root, "t")
    first = publish.publish(spark, root, put(3))
    assert publish.read_table(spark, root, "t").count() == 3

    def dies(folder):
        spark.range(5).write.parquet(f"{folder}/t")
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        publish.publish(spark, root, dies)
    assert publish.read_table(spark, root, "t").count() == 3

    def refuse(table):
        assert table("t").count() < 5, "too many rows"

    with pytest.raises(AssertionError, match="too many"):
        publish.publish(spark, root, put(9), refuse)
    assert publish.current(spark, root).endswith(first)
    opened = publish.read_table(spark, root, "t")
    second = publish.publish(spark, root, put(4), refuse)
    assert publish.read_table(spark, root, "t").count() == 4 and opened.count() == 3  # who opened the old one can finish
    assert second != first and publish.prune(spark, root, keep=9) == []
    assert first in publish.prune(spark, root, keep=1) and publish.read_table(spark, root, "t").count() == 4


def test_every_line_is_good_or_rejected(spark, tmp_path):
    lines = ["venta_id,fecha_hora,tienda_id,sku,cantidad,monto,tipo_comprobante",
             "v1,2025-01-01 10:00:00,T1,P1,2,10.50,I", "v2,2025-01-01 10:00:00,,P1, 3.7 ,-1,E", 'v3,2025-01-01 10:00:00,"T,1",P1,1,2,I',
             "v4,01/02/2025,T1,P1,2,10.50,I", "v5,2025-01-01 10:00:00,T1,P1,dos,1O.5,I", "v6,2025-01-01 10:00:00,T1,P1,2", "v7,2025-01-01 10:00:00,T1,P1,2,1,I,more",
             ",2025-01-01 10:00:00,T1,P1,2,1,I", "v9,2025-01-01 10:00:00,T1,,2,1,I"]
    for part in (0, 1):
        (tmp_path / f"s{part}.csv").write_text("\n".join([lines[0]] + lines[1 + part::2]) + "\n")
    got = read_sales_rescued(spark, str(tmp_path))
    good = {r["venta_id"]: (r["tienda_id"], r["cantidad"], float(r["monto"])) for r in got.good.collect()}
    assert good == {"v1": ("T1", 2, 10.5), "v2": (None, 3, -1.0), "v3": ("T,1", 1, 2.0)}
    assert got.good.schema["fecha_hora"].dataType.simpleString() == "timestamp_ntz"
    bad = {r["linea"].split(",")[0]: (sorted(r["motivos"]), r["archivo"][-6:]) for r in got.bad.collect()}
    assert {k: v[0] for k, v in bad.items()} == {"v4": ["ilegible:fecha_hora"], "v5": ["ilegible:cantidad", "ilegible:monto"], "v6": ["numero_de_campos"],
                                                 "v7": ["numero_de_campos"], "": ["falta:venta_id"], "v9": ["falta:sku"]}
    assert all(v[1] in ("s0.csv", "s1.csv") for v in bad.values())
    assert {r["motivo"]: r["filas"] for r in got.by_reason().collect()}["numero_de_campos"] == 2
    (tmp_path / "none.csv").write_text(lines[0] + "\n")
    none = read_csv_rescued(spark, str(tmp_path / "none.csv"), got.good.schema)
    assert none.good.count() == none.bad.count() == 0


def test_kpis_of_any_period_from_daily_states(spark):
    rng = random.Random(6)
    rows = [(ts("2025-01-01 00:00") + dt.timedelta(hours=rng.randint(0, 24 * 40)), rng.choice(["fisico", "ecommerce"]), rng.choice([f"T{i}" for i in range(30)] + [None]),
             rng.choice([f"P{i}" for i in range(400)] + [None]), dec(f"{rng.randint(-500, 900)}.25")) for _ in range(4000)]
    fact = spark.createDataFrame(rows, "fecha timestamp_ntz, canal string, tienda_id string, sku_pos string, monto_mxn decimal(18,4)")
    states = daily_states(fact, code_numbers(fact))
    assert states.sets.count() <= 2 * 41
    for start, end in [(None, None), ("2025-01-05", "2025-01-05"), ("2025-01-10", "2025-02-03"), ("2030-01-01", None)]:
        lo, hi = (dt.date.fromisoformat(x) if x else None for x in (start, end))
        part = fact.where(F.lit(True) & (F.to_date("fecha") >= F.lit(lo) if lo else F.lit(True)) & (F.to_date("fecha") <= F.lit(hi) if hi else F.lit(True)))
        assert kpis_of(states, start, end).collect() == executive_kpis(part).collect()


def test_rules_compile_to_one_aggregate_and_can_fail(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "b", -1.0), (3, None, None), (4, "a", 2.0)], "id int, k string, v double")
    checks = [("t", df, [rl.Rule("positivo", F.col("v") > 0, F.col("id")), rl.Rule("con_k", F.col("k").isNotNull(), F.col("id")), rl.rows_exactly(4), rl.rows_exactly(5),
                         rl.Measure("media", F.avg("v"), 1.9, 2.1), rl.Measure("vacia", F.max(F.when(F.col("id") > 9, F.col("v"))), 0)]),
              ("unico", rl.key_counts(df, ["k"]), [rl.Rule("clave", F.col("n") == 1, F.col("k"))]),
              ("ref", rl.references(df, spark.createDataFrame([("a",)], "k string"), "k"), [rl.Rule("existe", F.col("existe"), F.col("clave"))]),
              ("suma", rl.agreement(df, df.where("id < 4"), ["id"], "v"), [rl.Rule("igual", F.abs(F.col("a") - F.col("b")) < 0.01, F.col("id"))])]
    got = [tuple(r) for r in rl.suite(checks).collect()]
    assert got == [("t", "positivo", 2, "2", None), ("t", "con_k", 1, "3", None), ("t", "filas_esperadas", 0, None, 4.0), ("t", "filas_esperadas", 1, None, 4.0),
                   ("t", "media", 0, None, 2.0), ("t", "vacia", 1, None, None), ("unico", "clave", 1, "a", None), ("ref", "existe", 1, "b", None), ("suma", "igual", 2, "3", None)]
    assert Counter(line.strip().split("(")[0] for line in rl.check(*checks[0])._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line).total() == 1
    with pytest.raises(AssertionError, match="t.positivo: 2 .first 2"):
        rl.assert_holds(rl.check(*checks[0]))
    assert rl.assert_holds(rl.check("t", df, [rl.Rule("con_k", F.col("k").isNotNull())]), frozenset({"t.con_k"}))
