"""Product identity reconciliation (OP1) and latest non-null attributes (AG12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.functions.joins import sequence_number

DIM_PRODUCTO_COLUMNS = ["product_id", "sku_pos", "sku_erp", "handle", "nombre", "categoria"]

# Fixed values of the reference's identity rules
UNCLASSIFIED = "sin_clasificar"
WEB_UNMAPPED_PREFIX = "EC-UNMAPPED-"
ERP_UNMAPPED_PREFIX = "CN-UNMAPPED-"
PRODUCT_ID_PREFIX = "PRD-"


def latest_attributes(catalogo: DataFrame, key: str = "sku_erp", cols=("nombre", "categoria"),
                      order_cols=("fecha_vigencia", "pos")) -> DataFrame:
    """Per key, each column's latest non-null value (columns are picked independently).

    ``max_by`` ignores rows whose ordering value is null, so nulling the ordering for null values
    skips them; (date, position) makes the pick deterministic on equal dates.
    """
    order = F.struct(*[F.col(c) for c in order_cols if c in catalogo.columns])
    return catalogo.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in cols]
    )


def build_dim_producto(sku_map: DataFrame, catalogo: DataFrame, ecommerce: DataFrame,
                       sales: DataFrame | None = None) -> DataFrame:
    """Canonical product dimension.

    1. every SKU-map row, with the catalogue's latest name and category by ERP code;
    2. POS SKUs sold but absent from the map (name = SKU, category unclassified);
    3. web handles absent from the map -> EC-UNMAPPED-001.. in handle order;
    4. ERP codes in the catalogue absent from the map -> CN-UNMAPPED-001.. in code order,
       with the catalogue's name and category;
    product_id = 'PRD-' || sku_pos (null when sku_pos is null).
    Each "absent" set is a left anti join of distinct keys; both unmapped families are numbered
    in one distributed pass.
    """
    cat_latest = latest_attributes(catalogo)
    base = sku_map.select("sku_pos", "sku_erp", "handle").join(cat_latest, "sku_erp", "left")
    parts = [base.select("sku_pos", "sku_erp", "handle", "nombre", "categoria")]
    none = F.lit(None).cast("string")

    if sales is not None:
        pos_only = (sales.select(F.col("sku").alias("sku_pos")).where(F.col("sku_pos").isNotNull()).distinct()
                    .join(sku_map.select("sku_pos"), "sku_pos", "left_anti"))
        parts.append(pos_only.select("sku_pos", none.alias("sku_erp"), none.alias("handle"),
                                     F.col("sku_pos").alias("nombre"), F.lit(UNCLASSIFIED).alias("categoria")))

    web_only = (ecommerce.select(F.col("product_handle").alias("handle")).where(F.col("handle").isNotNull())
                .distinct().join(sku_map.select("handle"), "handle", "left_anti"))
    erp_only = cat_latest.join(sku_map.select("sku_erp"), "sku_erp", "left_anti")
    unmapped = web_only.select(F.lit(WEB_UNMAPPED_PREFIX).alias("_fam"), F.col("handle").alias("_key"),
                               none.alias("sku_erp"), "handle", F.col("handle").alias("nombre"),
                               F.lit(UNCLASSIFIED).alias("categoria")).unionByName(
        erp_only.select(F.lit(ERP_UNMAPPED_PREFIX).alias("_fam"), F.col("sku_erp").alias("_key"), "sku_erp",
                        none.alias("handle"), "nombre", "categoria"))
    # number the keys alone: the passes of the numbering then share one exchange
    seq = sequence_number(unmapped.select("_fam", "_key"), "_key", "_seq", group_col="_fam")
    numbered = unmapped.join(seq, ["_fam", "_key"])
    parts.append(numbered.select(F.concat(F.col("_fam"), F.format_string("%03d", F.col("_seq"))).alias("sku_pos"),
                                 "sku_erp", "handle", "nombre", "categoria"))

    dim = parts[0]
    for p in parts[1:]:
        dim = dim.unionByName(p)
    return dim.select(
        F.when(F.col("sku_pos").isNotNull(), F.concat(F.lit(PRODUCT_ID_PREFIX), F.col("sku_pos"))).alias("product_id"),
        "sku_pos", "sku_erp", "handle", "nombre", "categoria")
