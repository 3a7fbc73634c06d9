"""Binding of the TPC-H-like test tables to the retail source roles.

The retail sources (POS lines, web orders, exchange rates, SKU map, cost catalogue, stores,
stock snapshots) are derived from the test tables with DataFrame expressions, so every role
grows with the tables:

* order lines = lineitem JOIN orders; '1-URGENT' orders are web orders, the rest POS lines
* POS document type from l_returnflag; web currency from o_orderstatus
* money = l_extendedprice * (1 - l_discount), exact DECIMAL
* SKU = part key, store = supplier key; stores get city/region from nation and region
* SKU map: one row per part, except parts of the unmapped sizes (their POS SKUs, web handles
  and ERP codes exercise the three "unmapped" families of the product dimension)
* cost catalogue: every part with a three-step cost history built as a nested array and
  unnested like the JSON source
* exchange rates: one rate per business day of the order dates and per foreign currency,
  from a formula of the date; weekend orders use the fallback rate
* stock snapshots: events, one row per (event type = store, user = SKU, day) over the snapshot
  calendar; the stock reading is the day's event count as text, missing when there was none
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kardex.functions.numeric import MONEY
from kardex.sources.files import RawSources
from kardex.sources.nested import unnest_cost_history

# Fixed values of the binding
ONLINE_PRIORITY = "1-URGENT"
DOC_TYPE_BY_RETURNFLAG = {"N": "I", "R": "E", "A": "T"}
CURRENCY_BY_STATUS = {"P": "MXN", "O": "USD", "F": "EUR"}
UNMAPPED_MIN_SIZE = 46
COST_HISTORY = [("1996-01-01", "0.40"), ("1998-07-01", "0.44"), ("2000-03-15", "0.48")]
RATE_FORMULAS = {
    "USD": "17.20 + 0.01 * day(d) + 0.05 * (month(d) - 1)",
    "EUR": "18.90 + 0.02 * day(d) - 0.03 * (month(d) - 1)",
}
SNAPSHOT_CALENDAR = ("2024-01-01", "2024-01-30")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map(col: str, mapping: dict[str, str]) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v))
    return expr


def _money_amount() -> F.Column:
    return (F.col("l_extendedprice").cast("decimal(15,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast(MONEY)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    # fact-to-fact join on the order key: sort-merge, as it must be once orders outgrows any
    # broadcast; the shuffle also spreads the lines over the shuffle partitions when the input
    # arrives as a few large row groups
    return li.join(o.hint("merge"), li["l_orderkey"] == o["o_orderkey"])


def sku_code(col: str) -> F.Column:
    return F.concat(F.lit("P"), F.col(col).cast("string"))


def erp_code(col: str) -> F.Column:
    return F.concat(F.lit("E"), F.col(col).cast("string"))


def handle_code(col: str) -> F.Column:
    return F.concat(F.lit("item-"), F.col(col).cast("string"))


def store_code(col: str) -> F.Column:
    return F.concat(F.lit("T"), F.col(col).cast("string"))


def _line_id(prefix: str) -> F.Column:
    return F.concat(F.lit(prefix), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def pos_sales(lines: DataFrame) -> DataFrame:
    """POS lines: venta_id, fecha_hora, tienda_id, sku, cantidad, monto, tipo_comprobante."""
    p = lines.where(F.col("o_orderpriority") != ONLINE_PRIORITY)
    return p.select(
        _line_id("V").alias("venta_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("fecha_hora"),
        store_code("l_suppkey").alias("tienda_id"),
        sku_code("l_partkey").alias("sku"),
        F.col("l_quantity").cast("bigint").alias("cantidad"),
        _money_amount().alias("monto"),
        _map("l_returnflag", DOC_TYPE_BY_RETURNFLAG).alias("tipo_comprobante"),
    )


def web_orders(lines: DataFrame) -> DataFrame:
    """Web orders: order_id, fecha, product_handle, cantidad, amount, currency."""
    w = lines.where(F.col("o_orderpriority") == ONLINE_PRIORITY)
    return w.select(
        _line_id("W").alias("order_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("fecha"),
        handle_code("l_partkey").alias("product_handle"),
        F.col("l_quantity").cast("bigint").alias("cantidad"),
        _money_amount().alias("amount"),
        _map("o_orderstatus", CURRENCY_BY_STATUS).alias("currency"),
    )


def exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate per (business day of an order, foreign currency)."""
    days = (table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
            .where(F.weekday("d") < 5))
    parts = [days.select(F.col("d").alias("fecha"), F.lit(cur).alias("currency"),
                         F.expr(f"CAST({formula} AS DECIMAL(12,6))").alias("rate_to_mxn"))
             for cur, formula in RATE_FORMULAS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sku_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").where(F.col("p_size") < UNMAPPED_MIN_SIZE)
    return part.select(sku_code("p_partkey").alias("sku_pos"), erp_code("p_partkey").alias("sku_erp"),
                       handle_code("p_partkey").alias("handle"))


def catalog_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue products with a nested cost history (as in the JSON document)."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")
    history = F.array(*[
        F.struct(F.lit(day).alias("fecha_vigencia"),
                 (F.col("p_retailprice").cast("decimal(12,2)") * F.lit(factor).cast("decimal(4,2)")).cast(MONEY)
                 .cast("string").alias("costo_mxn"),
                 F.col("p_brand").alias("proveedor"))
        for day, factor in COST_HISTORY])
    return part.select(erp_code("p_partkey").alias("sku_erp"), F.col("p_name").alias("nombre"),
                       F.col("p_type").alias("categoria"), history.alias("cost_history"))


def catalogo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unnest_cost_history(catalog_products(spark, sf_dir))


def tiendas(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = s.join(n, s["s_nationkey"] == n["n_nationkey"], "left").join(r, n["n_regionkey"] == r["r_regionkey"], "left")
    return j.select(store_code("s_suppkey").alias("tienda_id"), F.col("n_name").alias("ciudad"),
                    F.col("r_name").alias("region"), F.lit("UTC").alias("timezone"))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as (store, ERP code, day) activity rows."""
    e = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    return e.select(F.col("event_type").alias("tienda_id"), erp_code("user_id").alias("sku_erp"),
                    F.to_date("ts").alias("fecha"), F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


def snapshots(spark: SparkSession, sf_dir: str, calendar=SNAPSHOT_CALENDAR) -> DataFrame:
    """Raw daily snapshot rows (text fields) for every (store, ERP code) seen in the events.

    The calendar is generated per key with ``sequence`` (no cross join); the reading of a day
    without events is missing.
    """
    act = activity(spark, sf_dir)
    daily = act.groupBy("tienda_id", "sku_erp", "fecha").agg(F.count(F.lit(1)).alias("n"))
    keys = act.select("tienda_id", "sku_erp").distinct()
    start, end = calendar
    grid = keys.select("tienda_id", "sku_erp", F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("fecha"))
    g = grid.join(daily, ["tienda_id", "sku_erp", "fecha"], "left")
    return g.select(F.col("fecha").cast("string").alias("fecha"), "tienda_id", "sku_erp",
                    F.col("n").cast("string").alias("cantidad_en_stock"))


def junk_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows whose readings are dirty text by a rule on the user number: a decimal, junk, blanks around the
    number, nothing, an empty text or an exponent."""
    n, kind = F.col("cantidad_en_stock"), F.substring("sku_erp", 2, 20).cast("long") % 7
    dirty = (F.when(kind == 0, F.concat(n, F.lit(".7"))).when(kind == 1, "n/a").when(kind == 2, F.concat(F.lit(" "), n, F.lit(" ")))
             .when(kind == 3, F.lit(None).cast("string")).when(kind == 4, "").when(kind == 5, "1e2").otherwise(n))
    return snapshots(spark, sf_dir).withColumn("cantidad_en_stock", dirty)


def changing_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of three rows per part, two of them on one day; names and categories change and go missing."""
    part = table(spark, sf_dir, "part")
    none = F.lit(None).cast("string")
    steps = [("1996-01-01", F.col("p_name"), F.col("p_type")),
             ("1998-07-01", F.when(F.col("p_size") % 2 == 1, F.upper("p_name")), none),
             ("1998-07-01", F.when(F.col("p_size") % 3 != 0, F.concat("p_name", F.lit("-v3"))), F.when(F.col("p_size") % 5 == 0, F.lower("p_type")))]
    rows = F.array(*[F.struct(F.lit(day).cast("date").alias("fecha_vigencia"), name.alias("nombre"), kind.alias("categoria"), F.lit(pos).alias("pos"))
                     for pos, (day, name, kind) in enumerate(steps)])
    return part.select(erp_code("p_partkey").alias("sku_erp"), F.inline(rows))


def event_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store dimension over the events' stores that lacks one and has no region for some."""
    stores = table(spark, sf_dir, "events").select("event_type").where(F.col("event_type") != "purchase").distinct()
    return stores.select(F.col("event_type").alias("tienda_id"), F.upper("event_type").alias("ciudad"),
                         F.when(F.length("event_type") % 2 == 0, "par").alias("region"), F.lit("UTC").alias("timezone"))


def dirty_sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """POS lines as CSV text without a header; lines are broken by a rule on the order number: an unreadable count,
    amount or time, no SKU, a field too few or too many."""
    lines = order_lines(spark, sf_dir).where(F.col("o_orderpriority") != ONLINE_PRIORITY)
    k = F.col("l_orderkey")
    broken = lambda m, bad, good: F.when(k % m == 0, F.lit(bad)).otherwise(good)
    fields = [_line_id("V"), broken(83, "31/31/2020", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")), store_code("l_suppkey"),
              broken(71, "", sku_code("l_partkey")), broken(97, "n/a", F.col("l_quantity").cast("bigint").cast("string")),
              broken(89, "abc", _money_amount().cast("string")), _map("l_returnflag", DOC_TYPE_BY_RETURNFLAG)]
    line = (F.when(k % 79 == 0, F.concat_ws(",", *fields[:-1])).when(k % 101 == 0, F.concat_ws(",", *fields, F.lit("x")))
            .otherwise(F.concat_ws(",", *fields)))
    return lines.select(line.alias("value"))


def clean_snapshots_of(spark: SparkSession, sf_dir: str, calendar=SNAPSHOT_CALENDAR) -> DataFrame:
    """Typed snapshots, as the ingest step delivers them (stock text coerced to BIGINT)."""
    from kardex.operators.conform import clean_snapshots

    return clean_snapshots(snapshots(spark, sf_dir, calendar))


def activity_sales(spark: SparkSession, sf_dir: str, dim_producto: DataFrame) -> DataFrame:
    """Events as physical sale lines of their (store, SKU): units = ceil(value). Used as the
    lookback sales of the stock-out estimate on the events' calendar."""
    from kardex.functions.joins import unique_lookup

    act = activity(spark, sf_dir)
    lookup = unique_lookup(dim_producto, "sku_erp", ["sku_pos"], on_duplicate="raise")
    j = act.join(lookup, "sku_erp", "left")
    return j.select(F.col("ts").alias("fecha"), "tienda_id", "sku_pos", F.lit("fisico").alias("canal"),
                    F.ceil("value").cast("bigint").alias("cantidad"))


def load_sources(spark: SparkSession, sf_dir: str, stage=None, lines: DataFrame | None = None, catalogue: DataFrame | None = None) -> RawSources:
    """The seven sources. Both channels and the product dimension read the joined order lines:
    ``stage`` (the job's table stage) lands them once as a table; ``lines`` / ``catalogue`` pass in
    already staged ones."""
    if lines is None:
        lines = order_lines(spark, sf_dir)
        if stage is not None:
            lines = stage(lines, "order_lines")
    return RawSources(
        sales=pos_sales(lines),
        tiendas=tiendas(spark, sf_dir),
        sku_map=sku_map(spark, sf_dir),
        catalogo=catalogue if catalogue is not None else catalogo(spark, sf_dir),
        snapshots=clean_snapshots_of(spark, sf_dir),
        ecommerce=web_orders(lines),
        exchange_rates=exchange_rates(spark, sf_dir),
    )
