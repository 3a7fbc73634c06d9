"""As-of (backward) joins.

``asof_join`` turns the right side into validity intervals per key, ``[ts_i, ts_{i+1})``, and
left-joins on the key plus the range condition. Each left row matches at most one interval, so
the output has exactly the left rows. The join is an equi-join with a range residual:
broadcast hash join when the interval table passes the size check, else a sort-merge join on
the key, where AQE splits a hot key's left partition across tasks.

It costs O(left rows x right rows) per key inside the join, which is right for short histories
(cost versions per SKU). ``asof_locf`` sorts the union of both sides instead, inside (key, time
bucket) groups, and carries the latest right row across buckets: it stays balanced when one key, or
one instant of a key, holds a large share of either side.

Both follow one contract, so the choice between them is a choice of plan only: a left row with a
null key or a null time matches nothing (null values, also with ``fallback_first``;
``on_null_time="raise"`` fails the job on a null time instead); a right row with a null key or a
null time is never in force; on equal times the last row by ``tiebreak`` wins. Left rows that
cannot match are spread over salts, so null keys form no hot group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kardex.functions.joins import bounded_broadcast, unique_lookup
from kardex.functions.numeric import MONEY, safe_div
from kardex.sinks.staging import stage_shared


def validity_intervals(right: DataFrame, by: list[str], right_on: str, value_cols: list[str],
                       tiebreak: list[str] | None = None, open_start: bool = False) -> DataFrame:
    """One row per right row with ``_lo`` (inclusive) and ``_hi`` (exclusive) bounds.

    Equal timestamps give the earlier row an empty interval, so the last row (by ``tiebreak``)
    wins. With ``open_start`` the first row of each key also covers all earlier times, and the
    first row's values are attached as ``_first_<col>``.
    """
    order = [F.col(right_on)] + [F.col(c) for c in (tiebreak or [])]
    w = Window.partitionBy(*by).orderBy(*order)
    cols = [F.col(c) for c in by + value_cols]
    hi = F.lead(right_on).over(w).alias("_hi")
    if open_start:
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        lo = F.when(F.row_number().over(w) > 1, F.col(right_on)).alias("_lo")
        firsts = [F.first(c).over(whole).alias("_first_" + c) for c in value_cols]
        return right.select(*cols, hi, lo, *firsts)
    return right.select(*cols, hi, F.col(right_on).alias("_lo"))


# Groups that left rows without a match are spread over.
NULL_SALTS = 1024


def _matchable(left: DataFrame, by: list[str], left_on: str, on_null_time: str) -> tuple[DataFrame, list[str]]:
    """``left`` with ``_can`` (key and time are there) and ``_salt`` (0 where it can match)."""
    if on_null_time not in ("null", "raise"):
        raise ValueError(f"unknown on_null_time={on_null_time!r}")
    can = F.col(left_on).isNotNull()
    if on_null_time == "raise":
        can = F.when(F.col(left_on).isNull(), F.raise_error(F.lit(f"null time in {left_on}")).cast("boolean")).otherwise(True)
    for b in by:
        can = can & F.col(b).isNotNull()
    salt = F.when(F.col("_can"), 0).otherwise(1 + F.pmod(F.xxhash64(*left.columns), F.lit(NULL_SALTS)).cast("int"))
    return left.withColumn("_can", can).withColumn("_salt", salt), left.columns


def _in_force(right: DataFrame, by: list[str], right_on: str) -> DataFrame:
    """Right rows that can be in force at all."""
    keep = F.col(right_on).isNotNull()
    for b in by:
        keep = keep & F.col(b).isNotNull()
    return right.where(keep)


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str,
              value_cols: list[str], tiebreak: list[str] | None = None, fallback_first: bool = False,
              broadcast_rows: int | None = None, on_null_time: str = "null") -> DataFrame:
    """Left rows + the right values in force at ``left_on`` (latest ``right_on <= left_on``).

    ``fallback_first``: rows earlier than the first right row take the first row's values, and a
    matched null value is replaced by the first row's value.
    """
    left, columns = _matchable(left, by, left_on, on_null_time)
    iv = validity_intervals(_in_force(right, by, right_on), by, right_on, value_cols, tiebreak, open_start=fallback_first)
    ren = {c: "_r_" + c for c in by + value_cols}
    iv = iv.select(*[F.col(c).alias(ren.get(c, c)) for c in iv.columns])
    if broadcast_rows:
        iv = bounded_broadcast(iv, broadcast_rows)
    ts = F.col(left_on).cast("timestamp_ntz")
    cond = [F.col(b) == F.col(ren[b]) for b in by] + [F.col("_salt") == F.col("_r_salt"), F.col("_can")]
    iv = iv.withColumn("_r_salt", F.lit(0))
    cond.append(F.col("_lo").isNull() | (ts >= F.col("_lo").cast("timestamp_ntz")))
    cond.append(F.col("_hi").isNull() | (ts < F.col("_hi").cast("timestamp_ntz")))
    j = left.join(iv, cond, "left")
    vals = [(F.coalesce(F.col(ren[c]), F.col("_first_" + c)) if fallback_first else F.col(ren[c])).alias(c)
            for c in value_cols]
    keep = [F.col(c) for c in columns if c not in value_cols]
    return j.select(*keep, *vals)


# Rows of a key that one task carries; a key with more is split in time.
MAX_ROWS_PER_BUCKET = 2_000_000
# Finest division of a key: its rows are cut at that many quantiles at most.
MAX_SPLITS = 1_000


def _micros(ts) -> F.Column:
    """Microseconds of a TIMESTAMP_NTZ, without a time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def hot_splits(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str,
               max_rows: int = MAX_ROWS_PER_BUCKET) -> DataFrame | None:
    """Times at which the keys with more than ``max_rows`` rows are cut: (keys, ``_splits``), ascending
    microseconds, or None if there is no such key (one count per key). Times are quantiles of the key's rows, so
    a crowded second is cut as well; a time that fills several parts by itself occurs as often. The
    few rows are staged, since all later steps must see the same cuts."""
    keys = [F.col(b).alias(f"_s{i}") for i, b in enumerate(by)]
    names = [f"_s{i}" for i in range(len(by))]
    times = lambda df, on: _in_force(df, by, on).select(*keys, _micros(F.col(on).cast("timestamp_ntz")).alias("_us"))
    both = times(left, left_on).unionByName(times(right, right_on))
    hot = both.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows)
    hot = stage_shared(hot, "hot-keys")
    if hot.isEmpty():
        return None
    grid = [i / MAX_SPLITS for i in range(1, MAX_SPLITS)]
    cuts = both.join(hot, names).groupBy(*names).agg(F.first("_n").alias("_n"), F.percentile_approx("_us", grid, 10 * MAX_SPLITS).alias("_at"))
    cuts = cuts.withColumn("_paso", F.greatest(F.lit(1), F.floor(F.lit(MAX_SPLITS) * max_rows / F.col("_n"))))
    return stage_shared(cuts.select(*names, F.expr("filter(_at, (x, i) -> (i + 1) % _paso = 0)").alias("_splits")), "splits")


def asof_locf(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str,
              value_cols: list[str], tiebreak: list[str] | None = None, fallback_first: bool = False,
              bucket: str = "auto", on_null_time: str = "null", max_rows: int = MAX_ROWS_PER_BUCKET) -> DataFrame:
    """As-of join by sorting instead of joining: skew-safe on BOTH sides.

    Left and right rows are unioned and grouped by (key, bucket). By default a key with at most
    ``max_rows`` rows is one bucket (without larger keys one sort then does the whole join), and one with more is
    cut at quantiles of its own times (``hot_splits``); if one instant fills several buckets, its left rows are dealt over them and its right
    row comes first. ``bucket`` may name a ``date_trunc`` unit instead.
    Inside each group the latest right row is carried forward (right rows sort first at equal
    times, so exact matches count; ``tiebreak`` orders right rows on equal times, the last wins).
    The value in force when a group starts comes from a boundary table with one row per (key,
    bucket): the last right row of each, carried to later buckets by a window per key whose size
    is the number of buckets of that key. Buckets are a pure function of the row, so every pass
    sees the same grouping. The right row is carried whole (a struct): its values stay together.
    """
    right = _in_force(right, by, right_on)
    splits = hot_splits(left, right, by, left_on, right_on, max_rows) if bucket == "auto" else None
    tb = tiebreak or []
    left, columns = _matchable(left, by, left_on, on_null_time)
    keys = [f"_k{i}" for i in range(len(by))] + ["_salt"]
    row_type = left.select(F.struct(*columns).alias("r")).schema["r"].dataType
    val_type = right.select(F.struct(*value_cols).alias("v")).schema["v"].dataType
    tb_types = {c: right.schema[c].dataType for c in tb}
    t_l = F.col(left_on).cast("timestamp_ntz")
    t_r = F.col(right_on).cast("timestamp_ntz")
    l = left.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], "_salt", "_can", t_l.alias("_t"), F.lit(1).alias("_side"),
                    *[F.lit(None).cast(tb_types[c]).alias("_tb_" + c) for c in tb],
                    F.struct(*columns).alias("_row"), F.lit(None).cast(val_type).alias("_val"))
    r = right.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], F.lit(0).alias("_salt"), F.lit(True).alias("_can"), t_r.alias("_t"), F.lit(0).alias("_side"),
                     *[F.col(c).alias("_tb_" + c) for c in tb],
                     F.lit(None).cast(row_type).alias("_row"), F.struct(*value_cols).alias("_val"))
    order = ["_t", "_side"] + ["_tb_" + c for c in tb]
    vals_of = lambda out, vals: out.select(*[F.col("_row." + c) for c in columns if c not in value_cols], *[v.alias(c) for v, c in zip(vals, value_cols)])
    if bucket == "auto" and splits is None:  # a key is one group: nothing to carry, and its first right row is in it
        group = Window.partitionBy(*keys).orderBy(*order)
        so_far, whole = (group.rowsBetween(Window.unboundedPreceding, end) for end in (0, Window.unboundedFollowing))
        latest = F.last("_val", ignorenulls=True).over(so_far).alias("_v")
        first = [F.first("_val", ignorenulls=True).over(whole).alias("_first")] if fallback_first else []
        out = l.unionByName(r).select("_can", "_side", "_row", latest, *first).where(F.col("_side") == 1)
        return vals_of(out, [F.when(F.col("_can"), F.coalesce(F.col("_v." + c), F.col("_first." + c)) if fallback_first else F.col("_v." + c))
                             for c in value_cols])
    every_r = r
    if splits is not None:  # of the right rows at one time only the last is ever in force
        last = F.struct(*["_tb_" + c for c in tb]) if tb else F.struct("_val")
        r = r.groupBy(*keys, "_can", "_t", "_side").agg(F.max_by("_val", last).alias("_val"), *[F.max_by("_tb_" + c, last).alias("_tb_" + c) for c in tb])
        r = r.withColumn("_row", F.lit(None).cast(row_type)).select(*l.columns)
    l, r = (_with_bucket(side, bucket, splits, keys[:-1]) for side in (l, r))
    u = l.unionByName(r)
    # latest right row so far inside (key, bucket)
    w_local = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = u.withColumn("_local", F.last("_val", ignorenulls=True).over(w_local)).where(F.col("_side") == 1)
    # last right row of each (key, bucket), carried to the later buckets of the key
    bounds = r.groupBy(*keys, "_b").agg(F.max_by("_val", F.struct(*order)).alias("_last"))
    left_buckets = l.select(*keys, "_b").distinct()
    all_buckets = bounds.unionByName(left_buckets.withColumn("_last", F.lit(None).cast(val_type)))
    w_carry = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = all_buckets.groupBy(*keys, "_b").agg(F.max("_last").alias("_last")) \
        .select(*keys, "_b", F.last("_last", ignorenulls=True).over(w_carry).alias("_carry"))
    out = filled.join(carry, [*keys, "_b"], "left")
    out = out.withColumn("_v", F.when(F.col("_can"), F.coalesce(F.col("_local"), F.col("_carry"))))
    vals = [F.col("_v." + c) for c in value_cols]
    if fallback_first:  # before the first right row, or a null value in force: the first row's value
        firsts = every_r.groupBy(*keys).agg(F.min_by("_val", F.struct(*order)).alias("_first"))
        out = out.join(firsts, keys, "left")
        vals = [F.when(F.col("_can"), F.coalesce(F.col("_v." + c), F.col("_first." + c))) for c in value_cols]
    return vals_of(out, vals)


def _with_bucket(side: DataFrame, bucket: str, splits: DataFrame | None, keys: list[str]) -> DataFrame:
    """``_b``: the bucket of each row of one side of the sorted strategy."""
    if bucket != "auto":
        return side.withColumn("_b", F.date_trunc(bucket, F.col("_t")))
    same = F.col("_can")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_s{i}"))
    found = side.join(splits, same, "left").withColumn("_us", _micros(F.col("_t")))
    below = F.coalesce(F.size(F.filter("_splits", lambda s: s < F.col("_us"))), F.lit(0))
    equal = F.coalesce(F.size(F.filter("_splits", lambda s: s == F.col("_us"))), F.lit(0))
    dealt = 1 + F.pmod(F.xxhash64(F.to_json(F.struct("_row"))), F.greatest(equal, F.lit(1))).cast("int")
    place = F.when(equal == 0, 0).when(F.col("_side") == 0, 1).otherwise(dealt)
    return found.withColumn("_b", below + place).select(*side.columns, "_b")


# Longest history per key the interval join takes; beyond it the sort-based strategy is used.
MAX_VERSIONS_FOR_INTERVALS = 10_000


def choose_strategy(right: DataFrame, by: list[str], max_versions: int = MAX_VERSIONS_FOR_INTERVALS) -> str:
    """'intervals' when every key's history is short (measured: one aggregate over the history
    side, a scalar to the driver), else 'sorted'. The interval join costs left x right rows per
    key, so a key holding a large share of the history needs the sorted strategy."""
    longest = right.dropna(subset=by).groupBy(*by).count().agg(F.max("count").alias("m")).first()["m"] or 0
    return "intervals" if longest <= max_versions else "sorted"


def build_fact_ventas_con_costo(fact_ventas: DataFrame, catalogo: DataFrame, dim_producto: DataFrame,
                                strategy: str = "auto", parts: int | None = None) -> DataFrame:
    """product_id and ERP code by SKU, the cost in force at each sale, and the margin.

    Sales whose SKU has no ERP code, or whose code has no cost history, keep null cost and margin.
    Before the first effective date the earliest cost applies; a null cost in force also falls
    back to the earliest. Name and category come from the matched catalogue row the same way.
    ``strategy``: "intervals" (join; cost histories are short per SKU), "sorted" (skew-safe on
    both sides, for long histories per key) or "auto" (measured by ``choose_strategy``).

    Histories get their SKUs before they meet the sales: both joins then are on the SKU, so the facts
    are shuffled once, and aggregates per SKU find them in place. ``parts`` lays facts and histories in so many
    partitions before, for aggregates whose tasks a number of rows should bound.
    """
    by_sku = unique_lookup(dim_producto, "sku_pos", ["product_id", "sku_erp"], on_duplicate="raise")
    cat = catalogo.select("sku_erp", "fecha_vigencia", "pos", "costo_mxn", "nombre", "categoria")
    if strategy == "auto":
        strategy = choose_strategy(cat, ["sku_erp"])
    if parts:
        fact_ventas, cat = fact_ventas.repartition(parts, "sku_pos"), cat.repartition(parts, "sku_erp")
    asof = asof_join if strategy == "intervals" else asof_locf
    history = cat.join(by_sku.select("sku_pos", "sku_erp"), "sku_erp").drop("sku_erp")
    fv = asof(fact_ventas, history, ["sku_pos"], "fecha", "fecha_vigencia", ["costo_mxn", "nombre", "categoria"],
              tiebreak=["pos"], fallback_first=True)
    fv = fv.join(by_sku, "sku_pos", "left")
    costo_total = (F.col("costo_mxn") * F.col("cantidad")).cast(MONEY)
    margen = (F.col("monto_mxn") - costo_total).cast(MONEY)
    return fv.select("order_id", "fecha", "tienda_id", "product_id", "sku_pos", "sku_erp", "canal", "cantidad",
                     "monto_mxn", "costo_mxn", costo_total.alias("costo_total_mxn"), margen.alias("margen_mxn"),
                     (safe_div(margen, "monto_mxn") * F.lit(100.0)).alias("margen_pct"), "nombre", "categoria")
