"""Conforming the sources into the star schema: net sales (OP2), FX conversion (OP3), the unified
sales fact (OP4), the store dimension (OP6) and the inventory fact (OP7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.functions.joins import unique_lookup
from kardex.functions.numeric import MONEY, parse_count, signed_by_type

FACT_COLUMNS = ["order_id", "fecha", "tienda_id", "sku_pos", "cantidad", "monto_mxn", "canal"]

# Fixed values of the reference's model
INCOME_TYPE, CREDIT_TYPE = "I", "E"
PHYSICAL, ONLINE = "fisico", "ecommerce"
ONLINE_STORE = {"tienda_id": "ECOMMERCE", "ciudad": "Online", "region": "ecommerce",
                "timezone": "America/Mexico_City"}
HOME_CURRENCY = "MXN"


def clean_snapshots(snapshots: DataFrame) -> DataFrame:
    """Raw snapshot rows (text fields) -> typed rows; junk stock becomes 0, '3.7' becomes 3."""
    return snapshots.select(
        F.to_date("fecha").alias("fecha"), "tienda_id", "sku_erp",
        parse_count("cantidad_en_stock").alias("cantidad_en_stock"),
    )


def transform_sales(sales: DataFrame, keep_types=(INCOME_TYPE, CREDIT_TYPE),
                    negative_type: str = CREDIT_TYPE, signed_units: bool = False) -> DataFrame:
    """POS lines -> physical-channel fact rows. Only income and credit documents are sales;
    credits subtract money but keep their units positive (as the reference does, so returns count
    as units sold downstream). ``signed_units=True`` negates the units of credits too."""
    df = sales.where(F.col("tipo_comprobante").isin(list(keep_types)))
    units = F.col("cantidad").cast("bigint")
    if signed_units:
        units = signed_by_type(units, "tipo_comprobante", negative_type)
    return df.select(
        F.col("venta_id").cast("string").alias("order_id"),
        F.col("fecha_hora").alias("fecha"),
        "tienda_id",
        F.col("sku").alias("sku_pos"),
        units.alias("cantidad"),
        signed_by_type(F.col("monto").cast(MONEY), "tipo_comprobante", negative_type).cast(MONEY).alias("monto_mxn"),
        F.lit(PHYSICAL).alias("canal"),
    )


def fx_tables(exchange_rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(day rate per (fx_day, fx_currency), fallback rate per fx_currency = earliest published rate)."""
    rates = exchange_rates.select(F.to_date("fecha").alias("fx_day"), F.col("currency").alias("fx_currency"),
                                  "rate_to_mxn")
    day_rate = rates.groupBy("fx_day", "fx_currency").agg(F.max("rate_to_mxn").alias("day_rate"))
    fallback = rates.groupBy("fx_currency").agg(
        F.min_by("rate_to_mxn", F.struct("fx_day", "rate_to_mxn")).alias("fallback_rate"))
    return day_rate, fallback


def convert_currency(df: DataFrame, exchange_rates: DataFrame, amount_col: str = "amount",
                     currency_col: str = "currency", ts_col: str = "fecha",
                     out_col: str = "monto_mxn", on_missing: str = "raise") -> DataFrame:
    """amount -> home currency with the rate of the sale's day, else the currency's fallback rate.

    Home-currency rows are not multiplied. An amount in a currency (null included) that has no rate at
    all fails the job; with ``on_missing="null"`` its money is null, and ``missing_rates`` counts
    such rows. The day-rate table is bounded by days x currencies; the planner
    broadcasts it when its measured size is under the broadcast threshold.
    """
    day_rate, fallback = fx_tables(exchange_rates)
    j = (df.withColumn("_fx_day", F.to_date(ts_col))
           .join(day_rate, (F.col("_fx_day") == F.col("fx_day")) & (F.col(currency_col) == F.col("fx_currency")), "left")
           .drop("fx_day", "fx_currency")
           .join(fallback, F.col(currency_col) == F.col("fx_currency"), "left")
           .drop("fx_currency"))
    rate = F.coalesce(F.col("day_rate"), F.col("fallback_rate"))
    if on_missing == "raise":
        lost = rate.isNull() & F.col(amount_col).isNotNull() & ~F.col(currency_col).eqNullSafe(HOME_CURRENCY)
        rate = F.when(lost, F.raise_error(F.concat(F.lit("no exchange rate for "), F.coalesce(F.col(currency_col), F.lit("a null currency"))))
                      .cast("decimal(12,6)")).otherwise(rate)
    elif on_missing != "null":
        raise ValueError(f"unknown on_missing={on_missing!r}")
    converted = F.when(F.col(currency_col) == HOME_CURRENCY, F.col(amount_col).cast(MONEY)) \
                 .otherwise((F.col(amount_col).cast(MONEY) * rate).cast(MONEY))
    return j.withColumn(out_col, converted).drop("_fx_day", "day_rate", "fallback_rate")


def missing_rates(df: DataFrame, exchange_rates: DataFrame, amount_col: str = "amount",
                  currency_col: str = "currency") -> DataFrame:
    """Rows and amount per foreign currency without any rate: what ``on_missing="null"`` would lose."""
    known = exchange_rates.select(F.col("currency").alias(currency_col)).where(F.col(currency_col).isNotNull()).distinct()
    foreign = df.where(F.col(amount_col).isNotNull() & ~F.col(currency_col).eqNullSafe(HOME_CURRENCY))
    return (foreign.join(known, currency_col, "left_anti").groupBy(currency_col)
            .agg(F.count(F.lit(1)).alias("filas"), F.sum(amount_col).alias("importe")))


def transform_ecommerce(ecommerce: DataFrame, dim_producto: DataFrame, exchange_rates: DataFrame,
                        on_missing_rate: str = "raise") -> DataFrame:
    """Web orders -> online-channel fact rows on the virtual store.

    handle -> sku_pos comes from the product dimension (including EC-UNMAPPED rows); a handle
    listed twice keeps one deterministic row.
    """
    handles = unique_lookup(dim_producto, "handle", ["sku_pos"], on_duplicate="last")
    df = ecommerce.join(handles, ecommerce["product_handle"] == handles["handle"], "left").drop("handle")
    df = convert_currency(df, exchange_rates, on_missing=on_missing_rate)
    return df.select(
        F.col("order_id").cast("string").alias("order_id"), "fecha",
        F.lit(ONLINE_STORE["tienda_id"]).alias("tienda_id"), "sku_pos",
        F.col("cantidad").cast("bigint").alias("cantidad"), "monto_mxn",
        F.lit(ONLINE).alias("canal"),
    )


def build_fact_ventas(sales_norm: DataFrame, ecom_norm: DataFrame) -> DataFrame:
    """Both channels in one fact (bag union by column name)."""
    return sales_norm.select(*FACT_COLUMNS).unionByName(ecom_norm.select(*FACT_COLUMNS))


def build_dim_tiendas(tiendas: DataFrame) -> DataFrame:
    """Store dimension plus the virtual online store."""
    spark: SparkSession = tiendas.sparkSession
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["tienda_id", "ciudad", "region", "timezone"]])
    virtual = spark.createDataFrame([tuple(ONLINE_STORE[c] for c in schema.fieldNames())], schema)
    return tiendas.select(*schema.fieldNames()).unionByName(virtual)


def build_fact_inventario(snapshots: DataFrame, dim_producto: DataFrame) -> DataFrame:
    """Snapshots + (product_id, sku_pos) looked up by ERP code; an ERP code listed twice in the
    product dimension fails the job."""
    lookup = unique_lookup(dim_producto, "sku_erp", ["product_id", "sku_pos"], on_duplicate="raise")
    df = snapshots.join(lookup, "sku_erp", "left")
    return df.select("fecha", "tienda_id", "product_id", "sku_pos", "sku_erp",
                     F.col("cantidad_en_stock").cast("bigint").alias("cantidad_en_stock"))
