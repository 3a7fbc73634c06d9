"""The batch job (OP19): sources -> model -> checks -> questions -> tables.

    python -m kardex.plans.job --data-dir /root/testdata/sf0.1 --output-dir <shared folder>
    python -m kardex.plans.job --source files --sales s.csv --rates r.csv --ecommerce web/ \\
        --inventory inv.json --monthly 2024-10-01 2025-03-31 --no-persist

Model tables are written once under the output folder and read back, so the analytics read
materialised tables (real sizes for the planner, no recomputation, lineage cut for executor
loss). Without an output folder the staging folder is taken from ``spark.checkpoint.dir``.
``--no-persist`` answers every question and prints the results; result tables are not written, and
the staged model goes to the checkpoint folder.
"""

from __future__ import annotations

import argparse
import os
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from kardex.operators import quality as dq
from kardex.operators.conform import build_dim_tiendas
from kardex.operators.quality import inventory_volume_metrics, sales_volume_metrics
from kardex.operators.rules import assert_holds, suite
from kardex.plans.analytics import Periods, direct_results, feeds, margin_results, run_all
from kardex.plans.checks import REPORTED, model_checks, rate_checks
from kardex.plans.model import Caches, Model, build_model, cache_stage, stage_all
from kardex.session import build_session, ensure_checkpoint_dir
from kardex.sinks import publish
from kardex.sinks.layout import write_clustered
from kardex.sinks.tables import write_table
from kardex.sources import testdata as td
from kardex.sources.files import RawSources, load_all

# Physical layout of the model tables (re-aims the reference's secondary indexes). Rows are
# sorted by date inside each file, so the period filters of the questions (pushed to the scan as
# half-open timestamp ranges) skip row groups by their min/max statistics; store and SKU follow.
LAYOUT = {
    "fact_ventas": {"sort_within": ["fecha", "tienda_id", "sku_pos"]},
    "fact_inventario": {"sort_within": ["fecha", "tienda_id", "sku_pos"]},
}


# Tables along a curve over day, SKU and store, for filters on any of them; bloom filters serve single ids.
ACCESS_COLUMNS = ["fecha", "sku_pos", "tienda_id"]
ACCESS_IDS = ["sku_pos", "product_id", "tienda_id"]

MODEL_TABLES = {"fact_ventas", "fact_inventario", "dim_producto", "dim_tiendas", "dim_catalogo"}
# intermediates landed as tables too: large and read by several stages (lineage cut, no
# executor-local copies of a big join)
LANDED = {"order_lines"}


VOLUME_METRICS = {"fact_ventas": sales_volume_metrics, "fact_inventario": inventory_volume_metrics}


def table_stage(spark: SparkSession, stage_dir: str, timings: dict | None = None, volumes: dict | None = None,
                caches: Caches | None = None):
    """Stage = write the model tables as parquet under ``stage_dir`` and read them back (the
    sink of the job, and a lineage cut); other intermediates are persisted. A name staged once is
    not staged again (later calls get the staged frame)."""
    done: dict[str, DataFrame] = {}

    def stage(df: DataFrame, name: str) -> DataFrame:
        if name in done:
            return done[name]
        t0 = time.time()
        if name in MODEL_TABLES or name in LANDED:
            path = os.path.join(stage_dir, name)
            spark.sparkContext.setJobDescription(f"write {name}")
            observed: dict = {}
            write_table(df, path, metrics=VOLUME_METRICS.get(name, lambda: None)(), observed_out=observed,
                        **LAYOUT.get(name, {}))
            if volumes is not None:
                volumes[name] = observed
            spark.sparkContext.setJobDescription(None)
            out = spark.read.parquet(path)
        else:
            out = (caches or cache_stage)(df, name)
        if timings is not None:
            timings[f"stage_{name}"] = round(time.time() - t0, 3)
        done[name] = out
        return out
    return stage


def build_staged_model(spark: SparkSession, sf_dir: str | None, stage_dir: str, timings: dict | None = None, pool=None,
                       volumes: dict | None = None, raw: RawSources | None = None, caches: Caches | None = None):
    """The staged model and the sales its stock-out lookback reads (None: the sales fact)."""
    stage = table_stage(spark, stage_dir, timings, volumes, caches)
    lookback_from_events = raw is None
    if raw is None:
        # the joined order lines and the catalogue / store tables do not depend on each other
        first = stage_all(stage, {"order_lines": td.order_lines(spark, sf_dir), "dim_catalogo": td.catalogo(spark, sf_dir),
                                  "dim_tiendas": build_dim_tiendas(td.tiendas(spark, sf_dir))}, pool)
        raw = td.load_sources(spark, sf_dir, lines=first["order_lines"], catalogue=first["dim_catalogo"])
    m = build_model(raw, stage, pool)  # reuses the staged catalogue and store tables
    facts = stage_all(stage, {"fact_ventas": m.fact_ventas, "fact_inventario": m.fact_inventario}, pool)
    model = Model(fact_ventas=facts["fact_ventas"], fact_inventario=facts["fact_inventario"],
                  dim_producto=m.dim_producto, dim_tiendas=m.dim_tiendas, dim_catalogo=m.dim_catalogo)
    # lookback sales of the stock-out estimate: one consumer, planned inline
    return model, td.activity_sales(spark, sf_dir, model.dim_producto) if lookback_from_events else None


def write_results(results: dict[str, DataFrame], out_dir: str, pool=None, timings: dict | None = None) -> dict:
    """Write every result table (nested columns as JSON text), concurrently with a pool."""
    futures = submit_results(results, out_dir, pool, timings)
    return {k: (f.result() if hasattr(f, "result") else f) for k, f in futures.items()}


def submit_results(results: dict[str, DataFrame], out_dir: str, pool=None, timings: dict | None = None) -> dict:
    def one(name, df):
        t = time.time()
        df.sparkSession.sparkContext.setJobDescription(f"result {name}")
        n = write_table(df, os.path.join(out_dir, name), flat=True)
        if timings is not None:
            timings[name] = round(time.time() - t, 3)
        return n
    if pool is None:
        return {k: one(k, v) for k, v in results.items()}
    return {k: pool.submit(one, k, v) for k, v in results.items()}


def answer_and_write(model: Model, lookback: DataFrame | None, out_dir: str, periods: Periods = Periods(), pool=None,
                     timings: dict | None = None, with_feeds: bool = False) -> dict:
    """The questions and their result tables. Results that do not need the margin aggregates are
    submitted first, so they run while the margin aggregates are materialised."""
    caches = Caches()
    try:
        first = {f"result_{k}": v for k, v in direct_results(model, periods, lookback).items()}
        if with_feeds:
            first |= feeds(model)
        futures = submit_results(first, out_dir, pool, timings)
        rest = {f"result_{k}": v for k, v in margin_results(model, caches).items()}
        futures.update(submit_results(rest, out_dir, pool, timings))
        return {k: (f.result() if hasattr(f, "result") else f) for k, f in futures.items()}
    finally:
        caches.release()


def check_model(model: Model, volumes: dict, raw: RawSources | None = None, expected: dict[str, int] | None = None) -> list:
    """Quality rules of the model and of the rates, one aggregation per table; a broken one fails the job,
    apart from those that are only reported (``checks.REPORTED``). ``expected`` holds exact row counts, which
    are compared with the counts of the write itself. Returns the report."""
    for name in ("fact_ventas", "fact_inventario"):
        if not volumes[name]["rows"]:
            raise ValueError(f"{name} is empty")
    for name, n in (expected or {}).items():
        if volumes[name]["rows"] != n:
            raise ValueError(f"{name} has {volumes[name]['rows']} rows, not {n}")
    for name, required in REQUIRED.items():
        if absent := dq.missing_columns(getattr(model, name), required):
            raise ValueError(f"{name} lacks {absent}")
    rules = model_checks(model) + (rate_checks(raw.ecommerce, raw.exchange_rates) if raw is not None else [])
    return [r.asDict() for r in assert_holds(suite(rules), REPORTED)]


REQUIRED = {
    "fact_ventas": ["order_id", "fecha", "tienda_id", "product_id", "canal", "cantidad", "monto_mxn", "margen_mxn"],
    "fact_inventario": ["fecha", "tienda_id", "product_id", "cantidad_en_stock"],
    "dim_producto": ["product_id", "sku_pos", "sku_erp", "handle"],
}


def answer_and_print(model: Model, lookback: DataFrame | None, periods: Periods = Periods(), rows: int = 20) -> dict:
    """Every question, its first rows on the console; returns the row counts."""
    caches = Caches()
    try:
        counts = {}
        for name, df in run_all(model, periods, lookback, stage=caches).items():
            df = caches(df, name)  # one run serves the count and the rows shown
            counts[name] = df.count()
            print(f"-- {name}: {counts[name]} rows")
            df.show(rows, truncate=60)
        return counts
    finally:
        caches.release()


def run_job(spark: SparkSession, sf_dir: str | None = None, output_dir: str | None = None, persist: bool = True,
            periods: Periods = Periods(), concurrency: int = 4, raw: RawSources | None = None, expected: dict[str, int] | None = None,
            access_paths: bool = False) -> dict:
    """``raw`` (sources read from files) or the test tables in ``sf_dir``. ``expected``: row counts that the
    model's tables must have. ``access_paths``: the facts once more, clustered (``access/``)."""
    timings: dict = {}
    volumes: dict = {}
    base = output_dir if output_dir and persist else os.path.join(ensure_checkpoint_dir(spark), "kardex-job-" + uuid.uuid4().hex[:8])
    t0 = time.time()
    caches = Caches()
    try:
        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            model, lookback = build_staged_model(spark, sf_dir, os.path.join(base, "model"), timings, pool, volumes, raw, caches)
            quality = check_model(model, volumes, raw, expected)
            timings["model"] = round(time.time() - t0, 3)
            if access_paths:
                for name in ("fact_ventas", "fact_inventario"):
                    write_clustered(getattr(model, name), os.path.join(base, "access", name), ACCESS_COLUMNS, bloom=ACCESS_IDS)
                timings["access"] = round(time.time() - t0 - timings["model"], 3)
            if persist:
                counts = answer_and_write(model, lookback, os.path.join(base, "results"), periods, pool, timings, with_feeds=True)
            else:
                counts = answer_and_print(model, lookback, periods)
    finally:
        caches.release()
    timings["total"] = round(time.time() - t0, 3)
    return {"output_dir": base, "timings": timings, "rows": counts, "volumes": volumes, "quality": quality}


def run_and_publish(spark: SparkSession, root: str, **job) -> dict:
    """The job into a fresh folder below ``root``, which readers see only once all of it is written and its rules
    hold (``sinks.publish``)."""
    out: dict = {}
    version = publish.publish(spark, root, lambda folder: out.update(run_job(spark, output_dir=folder, **job)))
    return {**out, "version": version}


def main(argv=None):
    ap = argparse.ArgumentParser(description="retail model + analytics job")
    ap.add_argument("--source", choices=["testdata", "files"], default="testdata")
    ap.add_argument("--data-dir", help="folder of the test tables")
    for name in ("sales", "rates", "ecommerce", "inventory"):
        ap.add_argument(f"--{name}", help=f"path of the {name} input (--source files)")
    ap.add_argument("--json-lines", action="store_true", help="the inventory input is JSON Lines")
    ap.add_argument("--output-dir", default=None)
    ap.add_argument("--publish", action="store_true", help="write into a fresh version below the output folder and switch to it at the end")
    ap.add_argument("--access-paths", action="store_true", help="write the facts clustered by day, SKU and store as well")
    ap.add_argument("--expect", nargs=2, action="append", metavar=("TABLE", "ROWS"), default=[], help="exact row count of a model table")
    ap.add_argument("--no-persist", action="store_true", help="answer and print, write no result tables")
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=None)
    ap.add_argument("--initial-partitions", type=int, default=None, help="partitions a shuffle starts with, before merging")
    for name in ("turnover", "stockout", "monthly"):
        ap.add_argument(f"--{name}", nargs=2, metavar=("START", "END"), default=(None, None), help="inclusive days")
    ap.add_argument("--top-k", type=int, default=10)
    ap.add_argument("--min-run-days", type=int, default=3)
    ap.add_argument("--lookback-days", type=int, default=14)
    ap.add_argument("--midnight-end", action="store_true", help="the monthly period ends at 00:00 of its last day")
    args = ap.parse_args(argv)
    if args.source == "files" and not all((args.sales, args.rates, args.ecommerce, args.inventory)):
        ap.error("--source files needs --sales, --rates, --ecommerce and --inventory")
    if args.source == "testdata" and not args.data_dir:
        ap.error("--source testdata needs --data-dir")
    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions, initial_partitions=args.initial_partitions)
    raw = load_all(spark, args.sales, args.rates, args.ecommerce, args.inventory, args.json_lines) if args.source == "files" else None
    periods = Periods(tuple(args.turnover), tuple(args.stockout), tuple(args.monthly), args.top_k, args.min_run_days,
                      args.lookback_days, not args.midnight_end)
    expected = {name: int(n) for name, n in args.expect}
    if args.publish:
        if not args.output_dir or args.no_persist:
            ap.error("--publish needs --output-dir and writes the results")
        print(run_and_publish(spark, args.output_dir, sf_dir=args.data_dir, periods=periods, raw=raw, expected=expected, access_paths=args.access_paths))
    else:
        print(run_job(spark, args.data_dir, args.output_dir, not args.no_persist, periods, raw=raw, expected=expected, access_paths=args.access_paths))


if __name__ == "__main__":
    main()
