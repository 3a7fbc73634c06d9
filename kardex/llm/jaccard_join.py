"""N-gram Jaccard self-join by MinHash banding.

Texts are cut into words (runs of letters and digits, lower-cased), ``NGRAM`` consecutive words
make an n-gram; a text with fewer words is one n-gram, itself. In a text without letters and digits
(symbols, emoji) the pieces between white space are the words. Two texts link if the Jaccard
similarity of their n-gram sets reaches ``THRESHOLD``.

1. ``signatures``: one pass over the texts gives a 128-bit key of the n-gram set, its size, and
   band hashes of a MinHash signature. ``choose_bands`` takes the most rows per band, so the most
   selective bands, that still reach the target recall at the threshold within a hash budget.
2. Texts with equal sets form a class, by an aggregation; only one representative goes on, so a
   hot group of copies costs one row.
3. Band hashes of representatives are counted. Buckets of one are dropped, and so are buckets whose
   members already share one and the same earlier band: their pairs are found there.
4. Members get their n-gram sets back (a second pass over the texts, one shuffle), and buckets are
   verified on full sets. A bucket over ``TILE`` members or ``TILE_GRAMS`` n-grams is spread over
   blocks of pairs of tiles, each a task's worth, so no bucket is one task's. A pair is counted in its first common band
   only. Blocks return counts per member and a spanning forest of the verified links, never pairs:
   rows out are at most rows in.
5. Class ids are the smallest ids of connected components, by min-label propagation with pointer
   jumping over the forest; every round is a staged table.

Result, one row per row of the input: id, ``class_id`` (smallest id linked directly or through
others), ``copy_id`` (smallest id with the same n-gram set) and ``n_links`` (different n-gram sets
it links to).

Defined results: null text is empty; empty and blank texts have the empty set and are copies of each
other (similarity 1) and of nothing else. Ids may be of any type that has an order. Null ids are rows of their own right, represented last
within a class. Ties are decided by the smaller id, then by the hash of the set. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.llm.common import shuffle_partitions, slices, stage, text_or_empty, with_fields

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.999  # of a pair exactly at the threshold
HASHES = 160  # budget of the signature
TILE = 256
TILE_GRAMS = 1 << 21  # 16 MB of n-gram hashes; a longer text has a tile of its own
WORDS = re.compile(r"[^\W_]+")
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(NGRAM)], np.uint64)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the largest number of rows whose bands reach the recall within the budget."""
    best = None
    for rows in range(1, hashes + 1):
        bands = int(np.ceil(np.log1p(-recall) / np.log1p(-(threshold ** rows))))
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches this recall within the budget")
    return best


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """64-bit hash of each word, the same in every process."""

    def __missing__(self, word: str) -> int:
        h = self[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        return h


class Shingler:
    """N-gram sets of texts; lives in a worker process. The word cache is emptied when large."""

    def __init__(self):
        self.words = WordHashes()

    def __call__(self, text: str) -> np.ndarray:
        """Sorted distinct n-gram hashes."""
        words = WORDS.findall(text.lower()) or text.split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.words) > 1_000_000:
            self.words.clear()
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        n = max(1, len(words) - NGRAM + 1)
        out = np.full(n, min(len(words), NGRAM), np.uint64)
        for i in range(min(NGRAM, len(words))):
            out += h[i:i + n] * _POWERS[i]
        return np.unique(mix(out))


class Signer:
    """Band hashes of a MinHash signature."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(20240501)
        self.mult = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        self.powers = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(rows)], np.uint64)
        self.shape = (bands, rows)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        low = np.full(len(self.mult), 0xFFFFFFFF, np.uint64)
        for i in range(0, len(grams), 2048):  # bounds the working array of a very long text
            block = (grams[i:i + 2048, None] * self.mult + self.add) >> np.uint64(32)
            low = np.minimum(low, block.min(0))
        return mix((low.reshape(self.shape) * self.powers).sum(1, dtype=np.uint64)).view(np.int64)


def set_key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, bands: int, rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Staged: id, text hash, key and size of the n-gram set, band hashes."""
    taken = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text_or_empty(text)).alias("text_hash"), text_or_empty(text).alias("_text"))
    schema = with_fields(taken, ("doc_id", "text_hash"), "set_key binary, n_grams int, bands array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sign = Shingler(), Signer(bands, rows)
        for b in slices(batches, "_text"):
            sets = [shingle(t) for t in b.column("_text").to_pylist()]
            flat = np.concatenate([sign(s) for s in sets])
            ends = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(map(set_key, sets), pa.binary()), pa.array(map(len, sets), pa.int32()),
                                              pa.ListArray.from_arrays(ends, pa.array(flat))], [f.name for f in schema.fields])

    return stage(taken.mapInArrow(run, schema), "signatures")


def classes(signed: DataFrame) -> DataFrame:
    """Staged, one row per distinct n-gram set: ``copy_id`` (null only if all its ids are), text hash
    of the representative, size and bands."""
    first = F.min_by(F.struct("doc_id", "text_hash"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    # Bands follow from the set, so any row's will do; map-side aggregation leaves one per task.
    got = signed.groupBy("set_key").agg(first.alias("first"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"))
    return stage(got.select("set_key", F.col("first.doc_id").alias("copy_id"), F.col("first.text_hash").alias("text_hash"), "n_grams", "bands"), "classes")


def buckets(sets: DataFrame, bands: int) -> DataFrame:
    """Staged (band, hash, tiles) of the buckets to verify."""
    rows = sets.where("n_grams > 0").select(F.posexplode("bands").alias("band", "hash"), "bands", "n_grams")
    lows, highs = zip(*((F.min(F.col("bands")[i]).alias(f"lo{i}"), F.max(F.col("bands")[i]).alias(f"hi{i}")) for i in range(bands)))
    counted = rows.groupBy("band", "hash").agg(F.count("*").alias("size"), F.sum("n_grams").alias("grams"), *lows, *highs).where("size > 1")
    earlier = F.lit(False)
    for i in range(bands):
        earlier = earlier | ((F.col("band") > i) & (F.col(f"lo{i}") == F.col(f"hi{i}")))
    return stage(counted.where(~earlier).select(F.col("band").alias("b"), F.col("hash").alias("h"), F.greatest(F.ceil(F.col("size") / TILE), F.ceil(F.col("grams") / TILE_GRAMS)).cast("int").alias("tiles")), "buckets")


def verify(docs: DataFrame, sets: DataFrame, found: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Staged (set_key, n_links, root): per member and block how many verified links it has there,
    and the smallest member key of its part of the block's forest."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    members = (sets.where("n_grams > 0").select("set_key", "copy_id", "text_hash", "bands", F.posexplode("bands").alias("band", "hash"))
               .join(found, (F.col("band") == F.col("b")) & (F.col("hash") == F.col("h"))))
    members = members.select("set_key", "copy_id", "text_hash", "bands", "band", "hash", "tiles")
    wanted = members.groupBy("set_key").agg(F.first("copy_id").alias("copy_id"), F.first("text_hash").alias("text_hash"), F.first("bands").alias("bands"),
                                            F.collect_list(F.struct("band", "hash", "tiles")).alias("buckets"))
    wanted = stage(wanted.withColumnRenamed("text_hash", "_hash"), "members")
    rows = docs.select(F.col(key).alias("_id"), F.xxhash64(text_or_empty(text)).alias("_text_hash"), text_or_empty(text).alias("_text"))
    # The representative's text, once: rows with its id and hash may repeat.
    same = (F.col("_text_hash") == F.col("_hash")) & F.col("_id").eqNullSafe(F.col("copy_id"))
    texts = rows.join(wanted, same).select("set_key", "bands", "buckets", "_text")
    out = "set_key binary, bands array<long>, grams binary, buckets array<struct<band:int,hash:long,tiles:int>>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for b in slices(batches, "_text"):
            sets_ = [shingle(t) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("set_key"), b.column("bands"), pa.array([s.tobytes() for s in sets_], pa.binary()), b.column("buckets")], ["set_key", "bands", "grams", "buckets"])

    with_sets = texts.mapInArrow(cut, out)
    one = with_sets.select("set_key", "bands", "grams", F.explode("buckets").alias("k")).select("set_key", "bands", "grams", "k.*")
    # Blocks: pairs (i, j) of tiles with i <= j; a member goes to every block of its tile.
    mine = F.pmod(F.xxhash64("set_key", "band"), F.col("tiles")).cast("int")
    spread = one.withColumn("tile", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    spread = spread.select("set_key", "bands", "grams", "band", F.xxhash64("band", "hash", F.least("tile", "other"), F.greatest("tile", "other")).alias("block"),
                           (F.col("tile") <= F.col("other")).alias("left"), (F.col("tile") >= F.col("other")).alias("right"))
    sent = spread.repartition(4 * n, "block").sortWithinPartitions("block", "set_key")
    schema = pa.schema([("set_key", pa.binary()), ("n_links", pa.int64()), ("root", pa.binary())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups(batches, "block"):
            got = verify_block(block, threshold)
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got), schema)], schema=schema)

    return stage(sent.mapInArrow(check, "set_key binary, n_links long, root binary"), "links")


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` of a sorted stream, each as a table; holds one run at a time."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and held[0].column(key)[0].as_py() != k[lo]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def overlaps(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``rows`` x ``cols``: products of 0/1 matrices over blocks
    of the n-grams that occur more than once."""
    lens = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), lens)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    count = np.diff(np.append(np.flatnonzero(new), len(flat)))
    shared = np.repeat(count > 1, count)
    number = (np.cumsum(new) - 1)[shared]
    owner = owner[shared]
    out = np.zeros((len(rows), len(cols)), np.float32)
    if not len(owner):
        return out
    number = np.unique(number, return_inverse=True)[1]
    step = 4096
    edges = np.searchsorted(number, np.arange(0, number[-1] + step + 1, step))
    for at, (lo, hi) in enumerate(zip(edges, edges[1:])):
        m = np.zeros((len(sets), step), np.float32)
        m[owner[lo:hi], number[lo:hi] - at * step] = 1
        out += m[rows] @ m[cols].T
    return out


def verify_block(block: pa.Table, threshold: float) -> list[tuple[bytes, int, bytes]]:
    """Links among the members of a block: those of its left tile with those of its right tile."""
    keys = block.column("set_key").to_pylist()
    first = [i for i, k in enumerate(keys) if not i or keys[i - 1] != k]  # a repeated representative counts once
    if len(first) < len(keys):
        block = block.take(first)
        keys = [keys[i] for i in first]
    left = np.flatnonzero(block.column("left").to_numpy())
    right = np.flatnonzero(block.column("right").to_numpy())
    if not len(left) or not len(right) or len(keys) < 2:
        return []
    band = block.column("band")[0].as_py()
    bands = np.array(block.column("bands").to_pylist(), np.int64).reshape(len(keys), -1)
    pair = np.ones((len(left), len(right)), bool)
    for i in range(band):
        pair &= bands[left, i][:, None] != bands[right, i][None, :]
    inner = len(left) == len(keys) and len(right) == len(keys)
    pair &= (left[:, None] < right[None, :]) if inner else (left[:, None] != right[None, :])
    use = np.union1d(left[pair.any(1)], right[pair.any(0)])
    if not len(use):
        return []
    sets = [np.frombuffer(g, np.uint64) for g in block.column("grams").take(use).to_pylist()]
    place = np.full(len(keys), -1)
    place[use] = np.arange(len(use))
    l_in, r_in = pair.any(1), pair.any(0)
    both = overlaps(sets, place[left[l_in]], place[right[r_in]])
    size = np.zeros(len(keys))
    size[use] = list(map(len, sets))
    union = size[left[l_in]][:, None] + size[right[r_in]][None, :] - both
    link = pair[np.ix_(l_in, r_in)] & (both >= threshold * union - 1e-9)
    a, b = np.nonzero(link)
    a, b = left[l_in][a], right[r_in][b]
    if not len(a):
        return []
    degree = np.bincount(a, minlength=len(keys)) + np.bincount(b, minlength=len(keys))
    root = np.arange(len(keys))
    while True:  # smallest member of each part; keys are sorted, so places compare like keys
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return [(keys[i], int(degree[i]), keys[root[i]]) for i in np.flatnonzero(degree)]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for edges (node, root): the smallest key of each connected component. Every
    round links nodes to their neighbours' smallest label and jumps pointers; rounds grow with the
    logarithm of the longest path."""
    both = stage(edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root"))).distinct(), "edges")
    labels = stage(both.groupBy("node").agg(F.least(F.min("root"), F.first("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("root"), "label"), "root").groupBy("node").agg(F.min("label").alias("near"))
        hop = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        far = hop.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = stage(hop.join(far, "label", "left").select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, class_id, copy_id, n_links and ``class_key``,
    which tells classes apart even where ids repeat."""
    bands, rows = choose_bands(threshold, recall, hashes)
    signed = signatures(docs, bands, rows, key, text)
    sets = classes(signed)
    links = verify(docs, sets, buckets(sets, bands), threshold, key, text)
    labels = components(links.select(F.col("set_key").alias("node"), "root").where("node <> root"))
    degrees = links.groupBy("set_key").agg(F.sum("n_links").alias("n_links"))
    ids = sets.select("set_key", "copy_id")
    placed = ids.join(labels.withColumnRenamed("node", "set_key"), "set_key", "left").join(degrees, "set_key", "left")
    placed = placed.select("set_key", "copy_id", F.coalesce("label", "set_key").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    linked = placed.where("n_links > 0").groupBy("label").agg(F.min("copy_id").alias("low"))
    placed = placed.join(linked, "label", "left").select("set_key", F.col("label").alias("class_key"), "copy_id", "n_links", F.coalesce("low", "copy_id").alias("class_id"))
    # Staged, so that a hot group of copies meets a plain table: it can be broadcast or its side split.
    placed = stage(placed, "placed")
    return signed.select("doc_id", "text_hash", "set_key").join(placed, "set_key").select("doc_id", "class_id", "copy_id", "n_links", "class_key", "text_hash")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the one with the smallest id (null last), then the
    smallest text hash; of equal rows one."""
    joined = join(docs, key, text, **how)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    per_text = joined.groupBy("class_key", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    best = per_text.groupBy("class_key").agg(F.min_by(F.struct("doc_id", "text_hash", "n"), place).alias("best"))
    best = stage(best.select(F.col("best.doc_id").alias("best_id"), F.col("best.text_hash").alias("best_hash"), F.col("best.n").alias("n")), "representatives")
    # Rows travel as one struct, so their columns may have any names.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("id"), F.xxhash64(text_or_empty(text)).alias("text_hash"))
    kept = rows.join(best, F.col("id").eqNullSafe(F.col("best_id")) & (F.col("text_hash") == F.col("best_hash")))
    # Only repeated rows need a shuffle of their own.
    once = kept.where("n = 1").unionByName(kept.where("n > 1").dropDuplicates(["id", "text_hash"]))
    return once.select("row.*")
