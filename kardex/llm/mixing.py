"""Mixing sources to target weights with a time-varying curriculum. DataFrame functions only.

Targets: the budget (``budget`` x all sizes) is shared by weight; a source stops at ``max_epochs``
times its size and the excess goes to the others by weight, until none is above. That is one
water level: with sources in ascending order of cap / weight, the first k are full and the rest
share what is left.

Positions: the run is the interval [0, 1]. Every source has a weight schedule over it, a density
that goes linearly from (1 - tilt) to (1 + tilt), so its integral is 1 and its demand up to
time x is target * (x + tilt * (x^2 - x)). A source's documents, in the order of a hash, supply its
demand: the document whose words begin after c words of supply meets the demand at the time where
the cumulative demand reaches c plus half the document, found by inverting that quadratic. Whole
passes come first; of the last, partial pass a document is taken if its middle lies below what is
left, so a source misses its target by half a document at most.

The running sum over a source is two-level: rows are in the order of a 64-bit hash, whose top bits
are a bucket: as many buckets as a bucket has rows, about the square root of their number. Sums per
bucket are added up first, and the running sum of rows stays within a bucket. The order is that of the whole hash, so neither the number of buckets nor
any setting of the session changes the result, and a source with a third of all rows is spread over
all buckets. Equal rows are counted and take their places as one group, which is dealt out in blocks of
``COPIES``.

Defined results: null text has size 0; a document without words is taken once per whole pass with
no words (``taken`` 0). A null source is a source of its own, last in order. Rows are ordered by hash
of id, source and text (training samples: of all columns), so reruns agree; equal rows are
interchangeable. If no document has a word, all targets are 0. No rows give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import WORD, shuffle_partitions, stage

COPIES = 10_000


def size_of(text: str = "text") -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def measure(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", order: Column | None = None) -> DataFrame:
    """Key, source, size and order of every document: the one pass over the texts, staged."""
    if order is None:
        order = F.xxhash64(F.col(key).cast("string"), F.col(source), F.col(text))
    return stage(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), size_of(text).alias("size"), order.alias("order")), "sizes")


def targets(sizes: DataFrame, budget: float = 1.5, max_epochs: float = 2.0, weights: tuple[float, ...] = (3.0, 1.0, 2.0)) -> DataFrame:
    """A row per source: ``source_size``, ``weight``, ``target`` and ``tilt``. Its windows run over
    one row per source."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Binary order of UTF-8 is code point order.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*map(F.lit, weights))
    w = by_source.withColumn("place", place).withColumn("weight", F.get(cycle, F.col("place") % len(weights)))
    w = w.withColumn("cap", F.col("source_size") * max_epochs)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(0, Window.unboundedFollowing)
    w = w.withColumn("total", F.sum("source_size").over(everything) * budget)
    w = w.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # Sources are full up to the first one whose cap is not below its share at that level.
    w = w.withColumn("open", F.col("cap") >= F.col("level") * F.col("weight"))
    w = w.withColumn("water", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("cap"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap")))
    tilt = F.get(F.array(F.lit(0.5), F.lit(0.0), F.lit(-0.5)), F.col("place") % 3)
    return w.select(F.col("source"), "source_size", "weight", F.greatest(target, F.lit(0.0)).alias("target"), tilt.alias("tilt"))


def bucket_bits(n: int) -> int:
    return math.ceil(math.log2(max(1, n)) / 2)


def place(sizes: DataFrame, by_source: DataFrame) -> DataFrame:
    """Staged, one row per group of equal rows: ``copies``, ``before`` (words of its source ahead of it),
    ``source_size``, ``target`` and ``tilt``."""
    by_source = stage(by_source, "targets").select(F.col("source").alias("t_source"), "source_size", "target", "tilt")
    groups = stage(sizes.groupBy("doc_id", "source", "size", "order").agg(F.count("*").alias("copies")), "groups")
    bits = bucket_bits(groups.count())
    groups = groups.withColumn("bucket", F.shiftright("order", 64 - bits) if bits else F.lit(0).cast("long"))
    words = F.col("size") * F.col("copies")
    # Sums of the buckets, added up within a source: as many rows as buckets, not as documents.
    of_buckets = groups.groupBy("source", "bucket").agg(F.sum(words).alias("sum"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    of_buckets = stage(of_buckets.select(F.col("source").alias("b_source"), F.col("bucket").alias("b"), F.coalesce(F.sum("sum").over(run), F.lit(0)).alias("ahead")), "buckets")
    within = Window.partitionBy("source", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("own", F.coalesce(F.sum(words).over(within), F.lit(0)))
    groups = groups.join(of_buckets, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b")))
    groups = groups.join(by_source, F.col("source").eqNullSafe(F.col("t_source")))
    return stage(groups.select("doc_id", "source", "size", "order", "copies", (F.col("ahead") + F.col("own")).alias("before"), "source_size", "target", "tilt"), "placed")


def each_copy(groups: DataFrame) -> DataFrame:
    """A row per copy with its number ``nth``. A group of many copies is dealt to tasks in blocks."""
    one = groups.where("copies = 1").withColumn("nth", F.lit(0).cast("long"))
    many = groups.where("copies > 1").withColumn("block", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES}L)")))
    many = many.repartition(shuffle_partitions(groups.sparkSession), "order", "block")
    nth = F.expr(f"sequence(block * {COPIES}L, least(copies, (block + 1) * {COPIES}L) - 1)")
    return one.unionByName(many.withColumn("nth", F.explode(nth)).drop("block"))


def positions() -> Column:
    """Ascending training positions in [0, 1] of copy ``nth`` of a placed group, one per pass that takes it."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    passes = F.floor(ratio + 1e-9)
    middle = F.col("before") + F.col("nth") * F.col("size") + F.col("size") / 2
    left = F.col("target") - passes * F.col("source_size")
    more = (middle <= left) & (F.col("size") > 0) & (left > 1e-6)
    times = (passes + more.cast("long")).cast("int")
    # Inverse of y = x + tilt * (x^2 - x) on [0, 1].
    y = lambda e: F.least(F.lit(1.0), (e * F.col("source_size") + middle) / F.col("target"))
    b = 1 - F.col("tilt")
    x = lambda e: F.when(F.col("tilt") == 0, y(e)).otherwise((F.sqrt(b * b + 4 * F.col("tilt") * y(e)) - b) / (2 * F.col("tilt")))
    none = F.array().cast("array<double>")
    return F.when((times > 0) & (F.col("target") > 0), F.transform(F.sequence(F.lit(0), F.greatest(times - 1, F.lit(0))), x)).otherwise(none)


def assign(sizes: DataFrame, by_source: DataFrame) -> DataFrame:
    """The columns of ``sizes``, ``source_size``, ``target``, ``taken`` and ``positions`` (ascending
    training positions in [0, 1], one per pass that takes the document)."""
    rows = each_copy(place(sizes, by_source)).withColumn("positions", positions())
    return rows.select("doc_id", "source", "size", "order", "source_size", "target", "positions", (F.col("size") * F.size("positions")).alias("taken"))


def by_position(assigned: DataFrame) -> DataFrame:
    """Documents range-sorted by first training position; those not taken come last."""
    first = F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0))
    return (assigned.withColumn("_first", first).repartitionByRange(shuffle_partitions(assigned.sparkSession), "_first", "order", "doc_id")
            .sortWithinPartitions("_first", "order", "doc_id").drop("_first"))


def training_order(assigned: DataFrame) -> DataFrame:
    """A row per training sample: ``position`` and the document's columns, range-sorted by position."""
    rows = assigned.withColumn("position", F.explode("positions")).drop("positions")
    return (rows.repartitionByRange(shuffle_partitions(assigned.sparkSession), "position", "order", "doc_id")
            .sortWithinPartitions("position", "order", "doc_id"))


def mix(docs: DataFrame) -> DataFrame:
    """Targets and positions of all documents, sorted by first position."""
    sizes = measure(docs)
    return by_position(assign(sizes, targets(sizes)))


def mixed_rows(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` as training samples: each as often as the mix takes it, range-sorted by
    training position. The texts meet their own places in one join; of equal rows one meets the
    places of all. Rows travel as one struct, so their columns may have any names."""
    spark = docs.sparkSession
    # Maps have no hash; all other columns tell rows apart.
    hashed = [c for c in docs.columns if not holds_map(docs.schema[c].dataType)]
    order = F.xxhash64(F.col(key).cast("string"), *hashed)
    sizes = measure(docs, text, source, key, order)
    placed = place(sizes, targets(sizes, **how)).withColumnsRenamed({"doc_id": "id", "order": "spot"}).drop("source")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), order.alias("order"))
    rows = rows.join(placed, F.col("key").eqNullSafe(F.col("id")) & (F.col("order") == F.col("spot"))).drop("id", "spot")
    many = rows.where("copies > 1").dropDuplicates(["key", "order"])
    samples = each_copy(rows.where("copies = 1").unionByName(many))
    samples = samples.select("row", "order", "nth", F.explode(positions()).alias("position"))
    return (samples.repartitionByRange(shuffle_partitions(spark), "position", "order", "nth")
            .sortWithinPartitions("position", "order", "nth").select("row.*"))


def holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and holds_map(kind.elementType)
