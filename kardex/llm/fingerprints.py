"""Document fingerprints by Order MinHash, sensitive to edit distance.

Of every text the k-mers (``K`` code points) are numbered by occurrence, so that repeats count, and
hashed. A sketch has ``SKETCHES`` entries. Entry j takes the ``PICK`` k-mers whose hashes follow its
place on the circle of hashes, puts them back into text order, and hashes that tuple: equal entries mean
the same k-mers in the same order, which is what an edit script keeps. One hash function serves
all entries, whose places are evenly spread, so the work is linear in the text, whatever the number
of entries. Which k-mers of two texts together follow a place first is decided by their hashes
alone, so every entry is a fair draw at any length; in a text with few k-mers neighbouring entries share
draws, and no entry is left short.

Likeness of two fingerprints is (share of equal entries) ** (1 / PICK): an entry of PICK k-mers
agrees with about the PICK-th power of the overlap.

Defined results: null text is the empty text; its fingerprint is the empty string, its likeness 1
to itself and 0 to others. A text shorter than K has one k-mer, itself, and no order. Equal texts have equal
fingerprints. Very long texts take memory in proportion to their own length alone.

``with_next`` brings every document together with the one that follows it by id: rows are
shuffled once, by ranges of the id, sorted within each range and read as a stream; the first row of
every range is also sent to the range before it. Ties of the id are ordered by text, repeated rows
follow each other; null ids come first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.pandas.types import to_arrow_schema

from kardex.llm.common import bucket_of, range_bounds, shuffle_partitions, stage, text_or_empty, with_fields

K = 9
PICK = 2
SKETCHES = 64
# Hashes per entry that are looked at where a text has more; all are where an entry then lacks picks.
DENSE = 12
_TOP = np.uint64(48)
_SHIFT = np.uint64(64 - (SKETCHES - 1).bit_length())
_REST = np.uint64((1 << int(_SHIFT)) - 1)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(0xD6E8FEB86659FD93, i, 1 << 64) for i in range(K)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def kmers(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value of each k-mer, in text order."""
    n = len(codes) - K + 1
    if n < 1:
        codes = np.r_[codes, np.full(K - len(codes), 0x110000, codes.dtype)]
        n = 1
    c = codes.astype(np.uint64) + np.uint64(1)
    out = c[:n].copy()
    for i in range(1, K):
        out += c[i:i + n] * _POWERS[i]
    return out


def numbered(values: np.ndarray) -> np.ndarray:
    """Hash of each k-mer and its occurrence number (0 for the first in the text)."""
    s = np.sort(values)
    twice = s[1:][s[1:] == s[:-1]]
    if len(twice):  # only values that occur again need their occurrences in order
        maybe = np.zeros(1 << 16, bool)
        maybe[(twice >> _TOP).astype(np.int64)] = True
        again = np.flatnonzero(maybe[(values >> _TOP).astype(np.int64)])
        v = values[again]
        again = again[twice[np.minimum(np.searchsorted(twice, v), len(twice) - 1)] == v]
        order = again[np.argsort(values[again], kind="stable")]
        v = values[order]
        first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
        nth = np.arange(len(v)) - np.repeat(first, np.diff(np.append(first, len(v))))
        values = values.copy()
        values[order] += nth.astype(np.uint64) * _MULT
    return mix(values)


def sketch(text: str) -> np.ndarray:
    """The entries of a text's fingerprint (uint16); empty for the empty text."""
    if not text:
        return np.empty(0, np.uint16)
    h = numbered(kmers(np.frombuffer(text.encode("utf-32-le"), np.uint32)))
    # The top bits say the entry, the rest orders within it: sorted hashes are sorted by both.
    at = np.arange(len(h))
    if len(h) > DENSE * SKETCHES:  # only small hashes can be picked: leave out most of the others
        low = np.flatnonzero((h & _REST) < np.uint64(int(_REST) * DENSE * SKETCHES // len(h)))
        if np.bincount((h[low] >> _SHIFT).astype(np.int64), minlength=SKETCHES).min() >= PICK:
            at = low
    at = at[np.argsort(h[at], kind="stable")]
    entry = (h[at] >> _SHIFT).astype(np.int64)
    begin = np.searchsorted(entry, np.arange(SKETCHES))
    n = min(PICK, len(at))
    picks = np.sort(at[(begin[:, None] + np.arange(n)) % len(at)], axis=1)  # round the circle; back in text order
    got = np.zeros(SKETCHES, np.uint64)
    for i in range(n):
        got = got * _MULT + h[picks[:, i]]
    return (mix(got) >> np.uint64(48)).astype(np.uint16)


def fingerprint(entries: np.ndarray) -> str:
    return entries.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if len(a) != len(b):
        return 0.0
    return float((a == b).mean() ** (1 / PICK)) if len(a) else 1.0


def with_next(docs: DataFrame, keep: tuple[str, ...], ddl: str, pair: Callable[[str, str, dict], tuple],
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """``keep`` columns of every document and what ``pair(text, next text, state)`` returns for it
    (the fields of ``ddl``). The document after the last is the first. ``state`` is a dictionary
    that lives as long as the stream of a task, for what a caller wants to carry to the next row."""
    spark = docs.sparkSession
    ids = docs.select(F.col(key).alias("_key"))
    bounds = range_bounds(ids, "_key", 2 * shuffle_partitions(spark))
    rows = docs.select(*keep, F.col(key).alias("_key"), text_or_empty(text).alias("_text")).withColumn("_bucket", bucket_of("_key", bounds))
    # The first (key, text) of each range, by an aggregation of keys, then a join on the few first keys.
    firsts = ids.withColumn("_bucket", bucket_of("_key", bounds)).groupBy("_bucket").agg(F.min(F.struct(F.col("_key").isNotNull().alias("n"), F.col("_key").alias("_key")))["_key"].alias("_key"))
    firsts = [(r["_bucket"], r["_key"]) for r in firsts.orderBy("_bucket").collect()]  # at most MAX_BUCKETS keys
    if not firsts:
        return spark.createDataFrame([], with_fields(docs, keep, ddl))
    to = [(k, firsts[i - 1][0] if i else firsts[-1][0]) for i, (_, k) in enumerate(firsts)]
    to = F.broadcast(spark.createDataFrame(to, T.StructType([T.StructField("_first", ids.schema["_key"].dataType), T.StructField("_to", T.IntegerType())])))
    heads = rows.join(to, F.col("_key").eqNullSafe(F.col("_first"))).groupBy("_key", "_to").agg(F.min("_text").alias("_text"))
    fields = rows.schema
    heads = stage(heads.withColumnRenamed("_to", "_bucket"), "heads")
    blank = [F.lit(None).cast(fields[c].dataType).alias(c) for c in keep]
    both = rows.withColumn("_head", F.lit(False)).unionByName(heads.select(*blank, "_key", "_text", "_bucket", F.lit(True).alias("_head")))
    # Sorted within a range; its head of the next range comes last.
    sent = both.repartition(shuffle_partitions(spark), "_bucket").sortWithinPartitions("_bucket", "_head", F.col("_key").asc_nulls_first(), "_text")
    n = len(keep)
    out_schema = with_fields(docs, keep, ddl)
    names = [f.name for f in out_schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        held = None  # (kept columns as a one-row batch, text) of the row that waits for its next
        for b in batches:
            texts, head = b.column("_text").to_pylist(), b.column("_head").to_pylist()
            rows_out, got = [], []
            for i, t in enumerate(texts):
                if held is not None:
                    got.append(pair(held[1], t, state))
                    rows_out.append(held[0])
                held = None if head[i] else (b.slice(i, 1).select(list(keep)), t)
            if got:
                kept = pa.Table.from_batches(rows_out).combine_chunks().to_batches()[0]
                yield pa.RecordBatch.from_arrays([*(kept.column(i) for i in range(n)), *(pa.array(x, out_schema_arrow[n + i].type) for i, x in enumerate(zip(*got)))], names)
            if held is not None:  # do not hold on to the whole batch
                held = (pa.Table.from_batches([held[0]]).take([0]).to_batches()[0], held[1])

    out_schema_arrow = to_arrow_schema(out_schema)
    return sent.select(*keep, "_text", "_head").mapInArrow(run, out_schema)


DDL = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare(text: str, after: str, state: dict) -> tuple:
    """Digests of a text, of its edited form (second half replaced by the start of the next text)
    and their likeness. The sketch of the next text is carried over to the next row."""
    own = state["sketch"] if state.get("text") == text else sketch(text)
    following = own if after == text else sketch(after)
    state["text"], state["sketch"] = after, following
    cut = len(text) // 2
    edited = text[:len(text) - cut] + after[:cut]
    other = own if edited == text else sketch(edited)
    return (len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprint(own), fingerprint(other),
            likeness(own, other), likeness(own, following))


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``keep`` columns and the fingerprints of every text and of its edited form (``DDL``)."""
    return with_next(docs, keep, DDL, compare, key, text)
