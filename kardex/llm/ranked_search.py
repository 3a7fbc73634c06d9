"""Ranked lexical search, term at a time, with a limited set of accumulators.

The searched rows become a forward index: per document its number of terms and, of the terms that
occur in any item, how often each occurs. It is staged, and N, L, document frequencies and the
largest impact of each term are aggregates of it.

A task then takes its slices of the index one after another. Within a slice it serves an item term
by term, rarest first. While new documents may still enter the top ``k``, every document of the
term's list gets an accumulator. As soon as the bound of all remaining terms (weight times
repeats times the term's largest impact) is below the kth score known so far, no accumulator is
created any more and the ones that exist are updated exactly to the end. The kth score is that of
the slice's partial scores or of what the task has finished before, whichever is larger; a document
without an accumulator stays strictly below it, so the ranking is exact. A slice hands on its own
top ``k`` above that score; a window over (item, score) keeps the best ``k`` of all slices, cut down
to ``k`` rows per task before the shuffle.

Items come in blocks of about ``BLOCK_BYTES`` of text, by a hash of the row, since their vocabulary
and plans go to every task; a larger table of items means more passes over the documents, never a
larger broadcast.

Defined results: null or empty texts have no terms, match nothing and are not counted in N. Items
without terms or without matching documents give no rows. Scores of 0 (a weight is 0 for terms that
nearly every document holds) are no results. Equal scores rank by ascending id, null ids last; equal
rows are documents of their own. Repeated items are ranked each. Ids may be of any type that has an
order. No documents or no items: no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import slices, stage, text_or_empty, with_fields

BLOCK_BYTES = 4 << 20
# Documents of a slice, and of the terms in it: bounds of a task's memory.
SLICE_ROWS, SLICE_POSTINGS = 16_384, 2_000_000

# Digits, letters and bytes beyond ASCII stay, A-Z are lower-cased, the rest is a blank.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split()


def blocks_of(items: DataFrame, id_col: str, text: str) -> Iterator[list]:
    """The items in blocks of about ``BLOCK_BYTES``: (id, text) rows, collected one block at a time."""
    items = items.select(F.col(id_col).alias("id"), text_or_empty(text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    for i in range(n):
        yield items.where(F.pmod(F.xxhash64("text", F.col("id").cast("string")), F.lit(n)) == i).collect()


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text: str) -> DataFrame:
    """(id, n, terms, tfs) of every document with a term; ``terms`` are numbers of the vocabulary."""
    docs = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("text"))
    schema = with_fields(docs, ("id",), "n long, terms array<int>, tfs array<int>")
    known = frozenset(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sizes, ends, terms, tfs = [], [0], [], []
            for t in b.column("text").to_pylist():
                words = terms_of(t)
                found = Counter(filter(known.__contains__, words))
                sizes.append(len(words))
                terms.extend(map(vocabulary.__getitem__, found))
                tfs.extend(found.values())
                ends.append(len(terms))
            lists = lambda v: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32()))
            out = pa.RecordBatch.from_arrays([b.column("id"), pa.array(sizes, pa.int64()), lists(terms), lists(tfs)], schema.names)
            yield out.filter(pc.greater(out.column("n"), 0))

    return stage(docs.mapInArrow(run, schema), "search-index")


IMPACT = "(1000000000L * tf) div (1000L * tf + 12L * m)"


def length_norm(n_docs: int, n_terms: int) -> str:
    return f"100L - 25L + ((25L * n * {n_docs}L) div {n_terms}L)"


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Plan:
    """Terms of an item in the order of service: number, weight times repeats, and the bound of all
    terms from each place on."""

    def __init__(self, counts: Counter, df: dict[int, int], best: dict[int, int], n_docs: int):
        order = sorted((t for t in counts if t in df), key=lambda t: (df[t], t))
        self.terms = order
        self.weights = [weight(n_docs, df[t]) * counts[t] for t in order]
        bounds = [w * best[t] for w, t in zip(self.weights, order)]
        self.remaining = np.cumsum(bounds[::-1], dtype=np.int64)[::-1].tolist() + [0]


def kth_largest(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


def serve(plan: Plan, lists: dict[int, tuple[np.ndarray, np.ndarray]], rows: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a slice that have accumulators, and their exact scores. A row without one scores below
    ``floor`` or below the slice's kth score."""
    acc = np.zeros(rows, np.int64)
    alive = np.zeros(rows, bool)
    creating = True
    for j, term in enumerate(plan.terms):
        if creating and plan.remaining[j] < max(floor, int(acc.max(initial=0))):
            # the kth partial score is only worth its cost once the bound is below the best one
            creating = plan.remaining[j] >= max(floor, kth_largest(acc, k))
        if term not in lists:
            continue
        at, values = lists[term]
        if creating:
            alive[at] = True
        else:
            stay = alive[at]
            at, values = at[stay], values[stay]
        acc[at] += plan.weights[j] * values
    chosen = np.flatnonzero(alive)
    return chosen, acc[chosen]


def postings(b: pa.RecordBatch, n_docs: int, n_terms: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per term the rows of a slice that hold it and their impacts."""
    n = b.column("n").to_numpy().astype(np.int64)
    norm = 75 + (25 * n * n_docs) // n_terms
    terms, tfs = (pc.list_flatten(b.column(c)).to_numpy().astype(np.int64) for c in ("terms", "tfs"))
    rows = pc.list_parent_indices(b.column("terms")).to_numpy()
    values = (1_000_000_000 * tfs) // (1000 * tfs + 12 * norm[rows])
    order = np.argsort(terms, kind="stable")
    cuts = np.flatnonzero(np.diff(terms[order])) + 1
    return {int(terms[part[0]]): (rows[part], values[part]) for part in np.split(order, cuts) if len(part)}


def index_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ends = np.cumsum(pc.list_value_length(b.column("terms")).to_numpy().astype(np.int64))
        at = 0
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            to = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(ends, base + SLICE_POSTINGS, side="right"))))
            yield b.slice(at, to - at)
            at = to


def best_of_slices(index: DataFrame, plans: list[Plan], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item number, id, score): every row that may be in an item's top ``k``."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), *with_fields(index, ("id",), "score long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, np.int64) for _ in plans]  # at most k finished scores per item
        for b in index_slices(batches):
            lists = postings(b, n_docs, n_terms)
            place = np.empty(b.num_rows, np.int64)  # rows by ascending id, null last
            place[pc.sort_indices(b.column("id"), null_placement="at_end").to_numpy()] = np.arange(b.num_rows)
            items, rows, scores = [], [], []
            for i, plan in enumerate(plans):
                floor = kth_largest(best[i], k)
                at, score = serve(plan, lists, b.num_rows, k, floor)
                fit = score >= max(1, floor)
                at, score = at[fit], score[fit]
                if len(at) > k:
                    top = np.lexsort((place[at], -score))[:k]
                    at, score = at[top], score[top]
                if len(at):
                    merged = np.concatenate([best[i], score])
                    best[i] = np.sort(merged)[-k:]
                    items.append(np.full(len(at), i, np.int32))
                    rows.append(at)
                    scores.append(score)
            if items:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(items)), b.column("id").take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(scores))], schema.names)

    return index.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", item_id: str = "item_id", doc_text: str = "text", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    spark = docs.sparkSession
    kinds = [items.schema[item_id].dataType, docs.schema[doc_id].dataType]
    schema = T.StructType([T.StructField("item_id", kinds[0]), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", kinds[1]), T.StructField("score", T.LongType())])
    found = []
    for block in blocks_of(items, item_id, item_text):
        counts = [Counter(terms_of(r["text"])) for r in block]
        vocabulary = {w: i for i, w in enumerate(sorted(set().union(*counts)))}
        if not vocabulary:
            continue
        index = forward_index(docs, vocabulary, doc_id, doc_text)
        n_docs, n_terms = index.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        each = index.select(F.expr(length_norm(n_docs, n_terms)).alias("m"), F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
        stats = (each.select(F.col("p.terms").alias("term"), F.col("p.tfs").cast("long").alias("tf"), "m")
                 .groupBy("term").agg(F.count("*").alias("df"), F.max(F.expr(IMPACT)).alias("best")).collect())  # a row per vocabulary word at most
        df, best = {r["term"]: r["df"] for r in stats}, {r["term"]: r["best"] for r in stats}
        plans = [Plan(Counter({vocabulary[w]: c for w, c in cs.items()}), df, best, n_docs) for cs in counts]
        rows = best_of_slices(index, plans, n_docs, n_terms, k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        top = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r["id"]) for i, r in enumerate(block)], T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kinds[0])]))
        found.append(top.join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, rid, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS rid FROM documents)
), sizes AS (SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY rid
), totals AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM sizes
), asked AS (
  SELECT item_id, term, count(*) AS repeats
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), held AS (SELECT rid, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals GROUP BY term
), scores AS (
  SELECT item_id, doc_id, rid, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * big_n) // big_l)))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (rid), totals
  GROUP BY item_id, doc_id, rid
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 20
"""
