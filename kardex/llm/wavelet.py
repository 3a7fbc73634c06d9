"""Token ids in wavelet matrices: one compressed file per shard.

A shard holds the ids of consecutive documents as succinct bit planes, from the highest bit to the
lowest; at every plane the ids with a 0 bit move, in order, before those with a 1 bit. With rank
and select over the planes one file gives access to any token, counts of an id in a range and the
places of its occurrences, without a copy of the plain array.

File: the magic ``WVM1``; the length of the header (4 bytes, little-endian); the header as JSON
(``n`` ids, ``bits`` planes, ``docs``: id column values and lengths of the documents, ``planes``:
byte lengths); the planes, each a zstd frame of its packed bits. Ranks are rebuilt on loading from
one prefix sum per 64-bit word.

``write_shards`` shuffles documents once by ranges of their id and streams each range, sorted, into
shard files of at most ``shard_tokens`` ids (a longer document has a shard of its own).
``documents_of`` reads the files back; the ids before each shard come from a running sum over the
manifest, one row per shard.

Defined results: null text is the empty text: its document holds the end id alone. Ties of the
id are ordered by text, null ids first; repeated rows are written repeatedly. No rows give no file.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from kardex.llm import files
from kardex.llm.bpe import SEPARATORS, SPACE, ChunkCache, byte_alphabet, gather
from kardex.llm.common import bucket_of, range_bounds, shared_path, shuffle_partitions, slices, stage, text_or_empty

MAGIC = b"WVM1"
SHARD_TOKENS = 1 << 21
PLAIN = regex.compile(r"([a-zß-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
CACHE_IDS = 1 << 16  # ids moved at a time, so that they stay in the processor's cache


class WaveletMatrix:
    """Bit planes of an array of non-negative integers with rank and select."""

    def __init__(self, n: int, planes: list[np.ndarray]):
        self.n, self.planes = n, planes  # packed bits, lowest bit of a byte first
        self._ranks: list[np.ndarray | None] = [None] * len(planes)

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        x = np.array(values, np.uint16 if bits <= 16 else np.uint32)
        planes, out = [], np.empty_like(x)
        for b in range(bits - 1, -1, -1):
            bit = (x & x.dtype.type(1 << b)).astype(bool)
            planes.append(np.packbits(bit, bitorder="little"))
            zero, one = 0, len(x) - int(np.count_nonzero(bit))
            for at in range(0, len(x), CACHE_IDS):
                part, mask = x[at:at + CACHE_IDS], bit[at:at + CACHE_IDS]
                ones = np.compress(mask, part)
                zeros = np.compress(~mask, part)
                out[one:one + len(ones)] = ones
                out[zero:zero + len(zeros)] = zeros
                one, zero = one + len(ones), zero + len(zeros)
            x, out = out, x
        return cls(len(values), planes)

    def _rank(self, k: int) -> tuple[np.ndarray, int]:
        """Ones before each 64-bit word of plane k, and the number of its zeros."""
        if self._ranks[k] is None:
            p = self.planes[k]
            words = np.frombuffer(np.concatenate([p, np.zeros(-len(p) % 8 + 8, np.uint8)]).tobytes(), np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
            self._ranks[k] = (words, ones)
        words, ones = self._ranks[k]
        return words, ones, self.n - int(ones[-1])

    def ones_before(self, k: int, i: np.ndarray) -> np.ndarray:
        words, ones, _ = self._rank(k)
        i = np.asarray(i, np.int64)
        w, r = i >> 6, (i & 63).astype(np.uint64)
        mask = (np.uint64(1) << r) - np.uint64(1)
        return ones[w] + np.bitwise_count(words[w] & mask).astype(np.int64)

    def _step(self, k: int, i: np.ndarray, bit) -> np.ndarray:
        ones = self.ones_before(k, i)
        return np.where(bit, self._rank(k)[2] + ones, i - ones)

    def access(self, i) -> np.ndarray:
        """The ids at places ``i``."""
        i = np.atleast_1d(np.asarray(i, np.int64))
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.planes)):
            words = self._rank(k)[0]
            bit = (words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            out = out << 1 | bit
            i = self._step(k, i, bit)
        return out

    def count(self, value: int, start: int, end: int) -> int:
        """How often ``value`` occurs in [start, end)."""
        span = np.array([start, end])
        for k in range(len(self.planes)):
            span = self._step(k, span, bool(value >> (len(self.planes) - 1 - k) & 1))
        return int(span[1] - span[0])

    def occurrences(self, value: int) -> np.ndarray:
        """All places of ``value``, ascending: down to its block on the last plane, then back up by select."""
        span = np.array([0, self.n])
        for k in range(len(self.planes)):
            span = self._step(k, span, bool(value >> (len(self.planes) - 1 - k) & 1))
        at = np.arange(span[0], span[1])
        for k in range(len(self.planes) - 1, -1, -1):
            at = self.select(k, at - self._rank(k)[2], True) if value >> (len(self.planes) - 1 - k) & 1 else self.select(k, at, False)
        return at

    def select(self, k: int, nth: np.ndarray, bit: bool) -> np.ndarray:
        """Places of the nth (from 0) ones or zeros of plane k."""
        words, ones, _ = self._rank(k)
        before = ones if bit else np.minimum(np.arange(len(ones)) * 64, self.n) - ones
        w = np.searchsorted(before, nth, side="right") - 1
        word = words[w] if bit else ~words[w]
        left = nth - before[w]
        at = np.zeros(len(nth), np.int64)
        for size in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count(word >> at.astype(np.uint64) & np.uint64((1 << size) - 1)).astype(np.int64)
            go = left >= low
            left = np.where(go, left - low, left)
            at = np.where(go, at + size, at)
        return w * 64 + at

    def values(self) -> np.ndarray:
        """The whole array: planes are undone from the last to the first."""
        x = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        up = np.empty_like(x)
        for b, plane in enumerate(reversed(self.planes)):
            bit = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            zero, one = 0, self.n - int(np.count_nonzero(bit))
            x[one:] |= x.dtype.type(1 << b)
            for at in range(0, self.n, CACHE_IDS):
                mask, part = bit[at:at + CACHE_IDS], up[at:at + CACHE_IDS]
                ones, zeros = np.flatnonzero(mask), np.flatnonzero(~mask)
                part[ones] = x[one:one + len(ones)]
                part[zeros] = x[zero:zero + len(zeros)]
                one, zero = one + len(ones), zero + len(zeros)
            x, up = up, x
        return x


def dump(ids: np.ndarray, docs: list, lengths: list[int], bits: int) -> bytes:
    """A shard file's bytes."""
    codec = pa.Codec("zstd", compression_level=1)
    planes = [codec.compress(p.tobytes(), asbytes=True) for p in WaveletMatrix.build(ids, bits).planes]
    header = json.dumps({"n": len(ids), "bits": bits, "docs": docs, "lengths": lengths, "planes": [len(p) for p in planes]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *planes])


def load(data: bytes) -> tuple[WaveletMatrix, list, list[int]]:
    """The matrix, document ids and document lengths of a shard file."""
    if data[:4] != MAGIC:
        raise ValueError("not a wavelet shard")
    size = struct.unpack_from("<I", data, 4)[0]
    head = json.loads(data[8:8 + size])
    codec, at, planes = pa.Codec("zstd"), 8 + size, []
    for n in head["planes"]:
        planes.append(np.frombuffer(codec.decompress(data[at:at + n], (head["n"] + 7) // 8, asbytes=True), np.uint8))
        at += n
    return WaveletMatrix(head["n"], planes), head["docs"], head["lengths"]


class Encoder(ChunkCache):
    """The tokenizers library behind a cache of white-space chunks: the vocabulary drops white space
    before it splits, so a text's ids are those of its chunks in order, and the library encodes each new
    chunk. Lower case, which the vocabulary's normalizer applies anyway, makes chunks repeat; it is
    applied first where it commutes with NFC."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.bits = max(1, (self.library.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.between = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.space = regex.compile(f"[{SPACE}]+")
        self.words = Tokenizer(self.library.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        letters = byte_alphabet()
        self.bytes = "".join(letters[:32] + [" "] + letters[33:])  # the model's symbol of each byte
        self.tails: dict[str, int] = {}
        self.tail_ids, self.tail_at = np.empty(0, np.int32), np.zeros(1, np.int64)
        spec = json.loads(self.library.to_str())["model"]
        self.final = np.zeros(1 << self.bits, bool)  # tokens that end a word
        self.final[[i for t, i in spec["vocab"].items() if t.endswith(spec["end_of_word_suffix"])]] = True
        self.clear()

    def chunks(self, text: str) -> list[str]:
        low = text.lower()
        if any(x in low for x in self.special):
            pass  # capitals must not become a special token
        elif text.isascii() or ("Σ" not in text and is_normalized("NFC", text) and is_normalized("NFC", low)):
            text = low
        if any(s in text for s in SEPARATORS):  # Python's split() would cut there, the vocabulary doesn't
            return [c for c in self.space.split(text) if c]
        return text.split()

    def _learn(self, new: list[str]) -> None:
        """A word of small Latin-1 letters is left alone by the normalizer and is one word to the pattern; so
        is the punctuation behind it. Such words are encoded as one text, cut after the tokens that end
        words, and the few kinds of punctuation are known. Other chunks are encoded one by one."""
        found = list(map(PLAIN.fullmatch, new))
        plain = np.fromiter((m is not None for m in found), bool, len(new))
        stems, tails = zip(*(m.groups() for m in found if m is not None)) if plain.any() else ((), ())
        flat, lens = self._words(stems)
        rest = self._each([c for c, m in zip(new, found) if m is None])
        for t in set(tails).difference(self.tails):
            self.tails[t] = len(self.tail_at) - 1
            ids = self._each([t])[0] if t else []
            self.tail_ids = np.r_[self.tail_ids, np.array(ids, np.int32)]
            self.tail_at = np.r_[self.tail_at, self.tail_at[-1] + len(ids)]
        tail = np.fromiter(map(self.tails.__getitem__, tails), np.int64, len(tails))
        more = self.tail_at[tail + 1] - self.tail_at[tail]
        size = np.empty(len(new), np.int64)
        size[plain] = lens + more
        size[~plain] = np.fromiter(map(len, rest), np.int64, len(rest))
        end = np.cumsum(size)
        ids = np.empty(int(end[-1]), np.int32)
        begin = end - size
        ids[spread(begin[plain], lens)] = flat
        ids[spread(begin[plain] + lens, more)] = gather(self.tail_ids, self.tail_at[tail], more)
        ids[spread(begin[~plain], size[~plain])] = np.fromiter(chain.from_iterable(rest), np.int32, int(size[~plain].sum()))
        self.ids = np.concatenate([self.ids, ids])
        self.at = np.concatenate([self.at, self.at[-1] + end])

    def _each(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(chunks, add_special_tokens=False)]

    def _words(self, words: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of small Latin-1 letters, and how many each has."""
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        text = charmap_decode(" ".join(words).encode(), "strict", self.bytes)[0]
        flat = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
        ends = np.flatnonzero(self.final[flat]) + 1
        if len(ends) != len(words):
            raise ValueError("the vocabulary has no word ends")
        return flat, np.diff(ends, prepend=0)


def spread(begin: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places b to b + n of all (b, n), in order."""
    return np.repeat(begin - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))


# A worker has one core: threads of the library would only wait for each other.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


MANIFEST = "bucket int, part int, path string, n_docs long, n_tokens long, bytes long"


def write_shards(docs: DataFrame, vocab_path: str, folder: str | None = None, key: str = "doc_id", text: str = "text",
                 end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode all texts, append ``end_id`` to each and write shards in ascending ``key`` order below
    ``folder`` (the shared folder by default). Returns the manifest, itself a staged table."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "tokens")
    n = shuffle_partitions(spark)
    bounds = range_bounds(docs.select(F.col(key).alias("_key")), "_key", 2 * n)
    rows = docs.select(F.col(key).cast("long").alias("_key"), text_or_empty(text).alias("_text"))
    sent = (rows.withColumn("_bucket", bucket_of("_key", bounds)).repartition(n, "_bucket")
            .sortWithinPartitions("_bucket", F.col("_key").asc_nulls_first(), "_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, attempt = encoder(vocab_path), uuid.uuid4().hex
        open_bucket, part, ids, keys, lengths, size = None, 0, [], [], [], 0

        def flush():
            path = f"{folder}/{open_bucket:05d}-{part:05d}.wvm"
            written = files.write_whole(path, lambda out: out.write(dump(np.concatenate(ids), keys, lengths, enc.bits)), attempt)
            row = [open_bucket, part, path, len(keys), size, written]
            return pa.RecordBatch.from_pylist([dict(zip(MANIFEST_SCHEMA.names, row))], MANIFEST_SCHEMA)

        for b in slices(batches, "_text"):
            buckets, doc_keys = b.column("_bucket").to_pylist(), b.column("_key").to_pylist()
            for bucket, k, got in zip(buckets, doc_keys, enc.encode(b.column("_text").to_pylist())):
                if keys and (bucket != open_bucket or size + len(got) + 1 > shard_tokens):
                    yield flush()
                    part, ids, keys, lengths, size = (part + 1 if bucket == open_bucket else 0), [], [], [], 0
                open_bucket = bucket
                ids += [got, np.array([end_id], got.dtype)]
                keys.append(k)
                lengths.append(len(got) + 1)
                size += len(got) + 1
        if keys:
            yield flush()

    return stage(sent.select("_bucket", "_key", "_text").mapInArrow(run, MANIFEST), "manifest")


MANIFEST_SCHEMA = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("bytes", pa.int64())])


def with_starts(manifest: DataFrame) -> DataFrame:
    """``start``: ids before each shard. Sums per range first, so that the one running sum over all
    has a row per range (at most ``MAX_BUCKETS``); within a range it runs over its few shards."""
    whole = manifest.groupBy("bucket").agg(F.sum("n_tokens").alias("t"))
    before = whole.select("bucket", (F.sum("t").over(Window.orderBy("bucket")) - F.col("t")).alias("before"))
    own = F.sum("n_tokens").over(Window.partitionBy("bucket").orderBy("part")) - F.col("n_tokens")
    return manifest.withColumn("own", own).join(F.broadcast(before), "bucket").withColumn("start", F.col("before") + F.col("own")).drop("own", "before")


def documents_of(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """Read the shards back: per document ``key``, ``start`` (ids before it), ``n_tokens`` and
    ``ids_crc32`` (of its ids as little-endian unsigned 32-bit integers)."""
    spark: SparkSession = manifest.sparkSession
    shards = stage(with_starts(manifest).select("path", "start"), "starts").repartition(2 * shuffle_partitions(spark), "path")
    schema = pa.schema([(key, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                matrix, keys, lengths = load(files.read_whole(path))
                raw = matrix.values().astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                begin = ends - lengths
                crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(begin.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(begin + start), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())], schema=schema)

    return shards.mapInArrow(run, f"{key} long, start long, n_tokens long, ids_crc32 long")
