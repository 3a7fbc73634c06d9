"""Readers for the retail source formats, with fixed schemas (no inference).

* POS sales: CSV with header (SRC1)
* exchange rates: CSV (SRC2)
* web orders: Parquet (SRC3)
* inventory: one nested JSON document, or JSON Lines fragments with the same top-level
  schema (SRC4). A single multi-line document is read by one task, so large inputs should
  arrive as JSON Lines or be landed once as parquet.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.functions.numeric import MONEY, RATE
from kardex.sources.nested import unnest_array, unnest_cost_history

SALES_SCHEMA = T.StructType([
    T.StructField("venta_id", T.StringType()),
    T.StructField("fecha_hora", T.TimestampNTZType()),
    T.StructField("tienda_id", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("cantidad", T.LongType()),
    T.StructField("monto", T.DecimalType(18, 4)),
    T.StructField("tipo_comprobante", T.StringType()),
])

RATES_SCHEMA = T.StructType([
    T.StructField("fecha", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("rate_to_mxn", T.DecimalType(12, 6)),
])

class RawSources(NamedTuple):
    sales: DataFrame
    tiendas: DataFrame
    sku_map: DataFrame
    catalogo: DataFrame
    snapshots: DataFrame
    ecommerce: DataFrame
    exchange_rates: DataFrame


_S = T.StringType()
INVENTORY_SCHEMA = T.StructType([
    T.StructField("tiendas_info", T.ArrayType(T.StructType([
        T.StructField("tienda_id", _S), T.StructField("ciudad", _S),
        T.StructField("region", _S), T.StructField("timezone", _S)]))),
    T.StructField("sku_mappings", T.ArrayType(T.StructType([
        T.StructField("sku_pos", _S), T.StructField("sku_erp", _S), T.StructField("handle", _S)]))),
    T.StructField("catalogo", T.StructType([
        T.StructField("productos", T.ArrayType(T.StructType([
            T.StructField("sku_erp", _S), T.StructField("nombre", _S), T.StructField("categoria", _S),
            T.StructField("cost_history", T.ArrayType(T.StructType([
                T.StructField("fecha_vigencia", _S), T.StructField("costo_mxn", _S),
                T.StructField("proveedor", _S)])))])))])),
    T.StructField("snapshots", T.ArrayType(T.StructType([
        T.StructField("fecha", _S), T.StructField("tienda_id", _S),
        T.StructField("sku_erp", _S), T.StructField("cantidad_en_stock", _S)]))),
])


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Fail when a source is empty (one short job that stops at the first row)."""
    if df.isEmpty():
        raise ValueError(f"source {name} has no rows (empty input, wrong folder, or a format that yields nothing)")
    return df


def read_sales_csv(spark: SparkSession, path: str, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    return (spark.read.schema(SALES_SCHEMA)
            .option("header", "true").option("mode", "FAILFAST")
            .option("timestampNTZFormat", timestamp_format)
            .csv(path))


def read_exchange_rates_csv(spark: SparkSession, path: str) -> DataFrame:
    df = (spark.read.schema(RATES_SCHEMA).option("header", "true").option("mode", "FAILFAST").csv(path))
    # the date may carry a midnight time part; keep the day
    return df.select(F.to_date(F.substring("fecha", 1, 10)).alias("fecha"), "currency",
                     F.col("rate_to_mxn").cast(RATE).alias("rate_to_mxn"))


def read_ecommerce_parquet(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("fecha").cast("timestamp_ntz").alias("fecha"),
        F.col("product_handle").cast("string").alias("product_handle"),
        F.col("cantidad").cast("bigint").alias("cantidad"),
        F.col("amount").cast(MONEY).alias("amount"),
        F.col("currency").cast("string").alias("currency"),
    )


def read_inventory_json(spark: SparkSession, path: str, multiline: bool = True) -> dict[str, DataFrame]:
    """The nested inventory document -> {tiendas, sku_map, catalogo, snapshots}."""
    doc = spark.read.schema(INVENTORY_SCHEMA).option("multiLine", str(multiline).lower()).json(path)
    return inventory_tables(doc)


def inventory_tables(doc: DataFrame) -> dict[str, DataFrame]:
    from kardex.operators.conform import clean_snapshots

    products = unnest_array(doc.select(F.col("catalogo.productos").alias("productos")), "productos")
    return {
        "tiendas": unnest_array(doc, "tiendas_info"),
        "sku_map": unnest_array(doc, "sku_mappings"),
        "catalogo": unnest_cost_history(products),
        "snapshots": clean_snapshots(unnest_array(doc, "snapshots")),
    }


def load_all(spark: SparkSession, sales: str, rates: str, ecommerce: str, inventory: str,
             json_lines: bool = False) -> RawSources:
    """The seven sources from the four inputs: sales CSV, rates CSV, web orders Parquet and the
    inventory document (``json_lines``: fragments, one per line). An input without rows fails here."""
    tables = read_inventory_json(spark, inventory, multiline=not json_lines)
    raw = RawSources(sales=read_sales_csv(spark, sales), tiendas=tables["tiendas"], sku_map=tables["sku_map"],
                     catalogo=tables["catalogo"], snapshots=tables["snapshots"],
                     ecommerce=read_ecommerce_parquet(spark, ecommerce), exchange_rates=read_exchange_rates_csv(spark, rates))
    return RawSources(*(require_rows(df, name) for name, df in raw._asdict().items()))
