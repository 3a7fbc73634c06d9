"""CSV with a table of rejected rows beside the good ones (SRC1, FN13).

``FAILFAST`` stops a job at the first bad line and a lenient parse turns it into nulls or zeros without a trace. Here
every line ends in exactly one of two tables: ``good``, typed, or ``bad``, with the file, the line as it
was read, the columns at fault and the reason. Both come from one scan expression with the fields as
text, so a value is judged by itself: a reason names the column, not the line.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WRONG_FIELDS = "numero_de_campos"
MISSING = "falta"
UNREADABLE = "ilegible"


class Rescued(NamedTuple):
    good: DataFrame
    bad: DataFrame  # archivo, linea, motivos: array of "reason:column"

    def by_reason(self) -> DataFrame:
        """Rejected lines per reason; a line with two faults counts under both."""
        return self.bad.select(F.explode("motivos").alias("motivo")).groupBy("motivo").agg(F.count(F.lit(1)).alias("filas"))


def typed(text: Column, kind: T.DataType, timestamp_format: str) -> Column:
    """The value of a field, null where it cannot be read. Counts may carry decimals, which are cut off."""
    clean = F.trim(text)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.try_to_timestamp(clean, F.lit(timestamp_format)).cast(kind)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return clean.try_cast("double").try_cast(kind)
    if isinstance(kind, T.StringType):
        return text
    return clean.try_cast(kind)


def read_csv_rescued(spark: SparkSession, path: str, schema: T.StructType, required: tuple[str, ...] = (),
                     timestamp_format: str = "yyyy-MM-dd HH:mm:ss", header: bool = True) -> Rescued:
    """Lines of CSV files as ``schema`` (``header``: the first line of a file is one). A line is rejected if it has another number of
    fields, if a field that is not empty cannot be read, or if a ``required`` one is empty."""
    names = schema.fieldNames()
    fields = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("_line", T.StringType())])
    raw = (spark.read.schema(fields).option("header", str(header).lower()).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_line")
           .option("columnPruning", "false").csv(path))  # fields are counted whatever the query reads
    values = {f.name: typed(F.col(f.name), f.dataType, timestamp_format) for f in schema}
    faults = [F.when(F.col("_line").isNotNull(), F.lit(WRONG_FIELDS))]
    for f in schema:
        c, whole = F.col(f.name), F.col("_line").isNull()
        empty = c.isNull() | (F.trim(c) == "")
        if f.name in required:
            faults.append(F.when(whole & empty, F.lit(f"{MISSING}:{f.name}")))
        if not isinstance(f.dataType, T.StringType):
            faults.append(F.when(whole & ~empty & values[f.name].isNull(), F.lit(f"{UNREADABLE}:{f.name}")))
    judged = raw.select("*", F.col("_metadata.file_path").alias("_file"), F.filter(F.array(*faults), lambda x: x.isNotNull()).alias("_faults"))
    good = judged.where(F.size("_faults") == 0).select(*[values[n].alias(n) for n in names])
    line = F.coalesce("_line", F.to_csv(F.struct(*names)))
    bad = judged.where(F.size("_faults") > 0).select(F.col("_file").alias("archivo"), line.alias("linea"), F.col("_faults").alias("motivos"))
    return Rescued(good, bad)


def read_sales_rescued(spark: SparkSession, path: str, header: bool = True) -> Rescued:
    """Sales lines and the rejected ones."""
    from kardex.sources.files import SALES_SCHEMA

    return read_csv_rescued(spark, path, SALES_SCHEMA, required=("venta_id", "fecha_hora", "sku", "cantidad", "monto"), header=header)
