"""Stock-out runs (OP9) and the lost-sales estimate from a lookback window (OP10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kardex.functions.dates import as_date, date_between, in_day_range
from kardex.functions.numeric import round_double
from kardex.operators.conform import PHYSICAL

RUN_KEYS = ["tienda_id", "sku_pos"]
STOCKOUT_COLUMNS = ["tienda_id", "ciudad", "region", "sku_pos", "inicio_quiebre", "fin_quiebre", "dias_en_quiebre",
                    "avg_unidades_diarias_14d", "ventas_perdidas_estimadas"]


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, block: str | None = None) -> DataFrame:
    """Sum of ``value`` over the rows of a key up to each row, in ``order`` (the first is a date).

    Without ``block`` a key is one window group, which is right where its rows are days. With it the sum has two
    levels, as an associative scan: rows run within their (key, ``block`` of time), totals of the blocks run
    over the blocks of a key, so a key with a history of any length is spread over its blocks. That reads ``df`` twice."""
    if block is None:
        rows = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value).over(rows))
    cut = df.withColumn("_bloque", F.trunc(order[0], block))
    totals = cut.groupBy(*[F.col(k).alias("_t_" + k) for k in keys], F.col("_bloque").alias("_t_bloque")).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*["_t_" + k for k in keys]).orderBy("_t_bloque").rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.withColumn("_antes", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    same = F.col("_bloque").eqNullSafe(F.col("_t_bloque"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_t_" + k))
    within = Window.partitionBy(*keys, "_bloque").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = cut.withColumn("_propio", F.sum(value).over(within))
    return own.join(ahead, same).withColumn(out, F.col("_propio") + F.col("_antes")).select(*df.columns, out)


def stockout_runs(fact_inventario: DataFrame, start=None, end=None, min_days: int = 3,
                  calendar: bool = False, block: str | None = None, parts: int | None = None) -> DataFrame:
    """Runs of zero-stock snapshots per (store, SKU), clipped to the period, of at least
    ``min_days`` rows.

    Default (gaps and islands over rows): the island id is a running count of non-zero rows,
    so a missing snapshot day does not break a run and equal dates share one id (RANGE frame).
    ``calendar=True``: runs are consecutive calendar days (day number minus its rank).

    Snapshots are first counted per (store, SKU, day), which is all that the island id depends on:
    a pair with a third of all rows shrinks to its days while it is read, and a window group holds days, not
    rows. ``block`` (a ``trunc`` unit) makes the running count a segmented scan over (pair, block), for
    histories that are long even so; a run is put together from its days wherever they were counted.
    ``parts``: the days of the pairs meet in so many partitions, so that their number bounds a task.
    """
    inv = fact_inventario.where(date_between("fecha", start, end) & F.col("sku_pos").isNotNull())
    en_quiebre = F.coalesce(F.col("cantidad_en_stock") == 0, F.lit(False))
    daily = inv.groupBy(*RUN_KEYS, "fecha").agg(F.count_if(en_quiebre).alias("_ceros"), F.count_if(~en_quiebre).alias("_otros"))
    if parts:
        daily = daily.repartition(parts, *RUN_KEYS)
    if calendar:
        days = daily.where("_ceros > 0").select(*RUN_KEYS, "fecha", F.lit(1).alias("_dias"))
        days = running_total(days, RUN_KEYS, ["fecha"], "_dias", "_rango", block)
        days = days.withColumn("_grupo", F.datediff("fecha", F.lit("1970-01-01").cast("date")) - F.col("_rango"))
    else:
        days = running_total(daily, RUN_KEYS, ["fecha"], "_otros", "_grupo", block).where("_ceros > 0").withColumnRenamed("_ceros", "_dias")
    runs = days.groupBy(*RUN_KEYS, "_grupo").agg(F.min("fecha").alias("inicio_quiebre"), F.max("fecha").alias("fin_quiebre"),
                                                 F.sum("_dias").alias("dias_en_quiebre"))
    return runs.where(F.col("dias_en_quiebre") >= min_days).drop("_grupo")


def daily_units(fact_ventas: DataFrame, channel: str = PHYSICAL, start=None, end=None) -> DataFrame:
    """Units per (store, SKU, day) of one channel: the facts shrink before any range join, so a
    hot (store, SKU) pair contributes at most one row per day. [start, end] bounds the days; it is a
    range on the raw timestamp, so it reaches the scan."""
    return (fact_ventas.where((F.col("canal") == channel) & in_day_range("fecha", start, end))
            .groupBy(*RUN_KEYS, F.to_date("fecha").alias("dia"))
            .agg(F.sum("cantidad").alias("unidades")))


def lost_sales(runs: DataFrame, fact_ventas: DataFrame, dim_tiendas: DataFrame,
               lookback_days: int = 14, channel: str = PHYSICAL, start=None, end=None, parts: int | None = None) -> DataFrame:
    """Mean daily units in the ``lookback_days`` before each run x run length.

    No sales in the window gives 0. Units up to a day are a running total per (store, SKU); a run asks
    for it at two days, the last of its window and the last before it, and the answer is the difference. Questions
    and daily sales run together through one sorted scan, so there is no range join and no row per
    (run, day). If the runs begin in [start, end], only sales from ``start`` - lookback to ``end`` - 1
    can count, and only those are read. ``parts``: sales and questions meet in so many partitions.
    """
    lo = as_date(start) - dt.timedelta(days=lookback_days) if start is not None else None
    hi = as_date(end) - dt.timedelta(days=1) if end is not None else None
    daily = daily_units(fact_ventas, channel, lo, hi).where(F.col("tienda_id").isNotNull() & F.col("sku_pos").isNotNull())
    run = F.struct("inicio_quiebre", "fin_quiebre", "dias_en_quiebre")
    ask = lambda days, sign: F.struct(F.date_sub("inicio_quiebre", days).alias("dia"), F.lit(sign).alias("signo"))
    asked = runs.select(*RUN_KEYS, run.alias("_run"), F.inline(F.array(ask(1, 1), ask(lookback_days + 1, -1))))
    asked = asked.select(*RUN_KEYS, "dia", F.lit(1).alias("_lado"), F.lit(0).cast("bigint").alias("unidades"), "signo", "_run")
    sold = daily.select(*RUN_KEYS, "dia", F.lit(0).alias("_lado"), F.coalesce("unidades", F.lit(0)).cast("bigint").alias("unidades"),
                        F.lit(None).cast("int").alias("signo"), F.lit(None).cast(asked.schema["_run"].dataType).alias("_run"))
    both = sold.unionByName(asked)
    if parts:
        both = both.repartition(parts, *RUN_KEYS)
    total = running_total(both, RUN_KEYS, ["dia", "_lado"], "unidades", "_hasta")
    look = total.where("_lado = 1").groupBy(*RUN_KEYS, "_run").agg(
        (F.sum(F.col("signo") * F.col("_hasta")).cast("double") / F.lit(float(lookback_days))).alias("_avg"))
    look = look.select(*RUN_KEYS, "_run.*", "_avg")
    stores = dim_tiendas.select("tienda_id", "ciudad", "region")
    out = look.join(stores, "tienda_id", "left")
    return out.select(
        "tienda_id", "ciudad", "region", "sku_pos", "inicio_quiebre", "fin_quiebre",
        F.col("dias_en_quiebre").cast("bigint").alias("dias_en_quiebre"),
        round_double("_avg", 2).alias("avg_unidades_diarias_14d"),
        round_double(F.col("_avg") * F.col("dias_en_quiebre"), 1).alias("ventas_perdidas_estimadas"),
    )


def stockouts(fact_inventario: DataFrame, fact_ventas: DataFrame, dim_tiendas: DataFrame, start=None, end=None,
              min_days: int = 3, lookback_days: int = 14, calendar: bool = False, inventory_parts: int | None = None,
              sales_parts: int | None = None) -> DataFrame:
    """Stock-out report ordered by estimated lost units, then run length. ``inventory_parts`` and ``sales_parts`` are the
    partitions in which the days of the snapshots and of the sales meet (None: sized by adaptive execution)."""
    runs = stockout_runs(fact_inventario, start, end, min_days, calendar, parts=inventory_parts)
    return lost_sales(runs, fact_ventas, dim_tiendas, lookback_days, start=start, end=end, parts=sales_parts).orderBy(
        F.col("ventas_perdidas_estimadas").desc(), F.col("dias_en_quiebre").desc(),
        "tienda_id", "sku_pos", "inicio_quiebre")
