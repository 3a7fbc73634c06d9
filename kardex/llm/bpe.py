"""BPE encoding and decoding in batched numpy merge rounds.

The vocabulary file is the JSON of a public word-level BPE (``end_of_word_suffix``, byte-level
alphabet, NFC and lower-case normalizer); its path is a parameter.

Encoding a batch of texts:

1. Special tokens are cut out of the raw text, the rest is normalised (NFC, lower case per code
   point) and cut at white space into chunks. A chunk that was met before is a dictionary hit.
2. The new chunks are cut into words by the vocabulary's pattern, and the words into byte symbols.
   All symbols of all new words lie in one flat array.
3. Merge rounds: the key ``left << 32 | right`` of every adjacent pair is found by binary search in
   the sorted array of pair keys; every word takes its lowest rank, all its occurrences of that
   pair (left to right, not overlapping) merge at once, and the array closes up. Words without a
   known pair leave the working array.
4. A document's ids are gathered from the flat array of its chunks.

Memory of a task is bounded: batches are cut to a few MB of text and the chunk cache keeps its most
used half beyond ``CACHE_CHUNKS`` entries. Null text is encoded as the empty text (no ids, empty decoding).
Repeated rows are encoded alike. Columns that are not named are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.llm.common import slices, with_fields

CACHE_CHUNKS = 700_000
# The chunks used most, in a dictionary of their own that stays in the processor's cache, and how
# often they are chosen anew.
HOT_CHUNKS, HOT_EVERY = 16_384, 65_536
# White space of the Unicode property, which the vocabulary's pattern drops. Python's own split()
# also cuts at the four information separators U+001C to U+001F, which are no white space there.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
# Code points that became letters or numbers after Unicode 16, the version of the
# tokenizers library's tables. The regex module may already know them; here they are neither.
NEWER = regex.compile("[" + "".join(
    "-".join(f"\\U{int(x, 16):08X}" for x in r.split("-"))
    for r in (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
    "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F "
    "12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 "
    "18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF "
    "1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E "
    "2CEA2-2CEAD 323B0-33479 3D000-3FC3F "
    ).split()) + "]")
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
# Small letters of capitals that the library's tables have and Python's (Unicode 15.1) lack.
SMALL = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
         **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}
CAPITALS = regex.compile("[" + "".join(map(chr, SMALL)) + "]")


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stands for
    itself, the others follow from U+0100 on in byte order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, n = [""] * 256, 0
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + n)
            n += 1
    return out


class Numbered(dict):
    """Numbers keys from 0 as they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class ChunkCache:
    """Ids of texts from the ids of their white-space chunks. A chunk met before is a dictionary hit;
    a new one is cut into pieces (``cut``), and all new pieces are encoded at once (``encode_pieces``)."""

    special: dict[str, int]
    between: regex.Pattern  # special tokens, as a capturing group

    def clear(self) -> None:
        self.chunk = Numbered()
        self.ids = np.empty(0, np.int32)
        self.at = np.zeros(1, np.int64)  # chunk i has ids[at[i]:at[i + 1]]
        self.uses = np.zeros(0, np.int64)
        self.hot: dict[str, int] = {}
        self.hot_at = 0

    def _choose_hot(self) -> None:
        best = set(np.argsort(-self.uses, kind="stable")[:HOT_CHUNKS].tolist())
        self.hot = {c: i for c, i in self.chunk.items() if i in best}
        self.hot_at = len(self.chunk)

    def _numbers(self, chunks: list[str]) -> np.ndarray:
        out = np.fromiter(map(self.hot.get, chunks, repeat(-1)), np.int64, len(chunks))
        other = np.flatnonzero(out < 0)
        out[other] = np.fromiter(map(self.chunk.__getitem__, map(chunks.__getitem__, other.tolist())), np.int64, len(other))
        return out

    def _shrink(self) -> None:
        """Keep the half of the cache that was used most."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[:CACHE_CHUNKS // 2])
        names, self.chunk = list(self.chunk), Numbered()
        self.chunk.update((names[i], n) for n, i in enumerate(kept.tolist()))
        lens = self.at[kept + 1] - self.at[kept]
        self.ids = gather(self.ids, self.at[kept], lens)
        self.at = np.concatenate(([0], np.cumsum(lens)))
        self.uses = self.uses[kept]
        self._choose_hot()

    def chunks(self, text: str) -> list[str]:
        raise NotImplementedError

    def cut(self, chunk: str) -> list[str]:
        raise NotImplementedError

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def _learn(self, new: list[str]) -> None:
        """Ids of chunks that were just numbered, in their order, go to the end of the flat array."""
        cut = list(map(self.cut, new))
        place = Numbered()
        per_chunk = np.fromiter(map(len, cut), np.int64, len(cut))
        order = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), np.int64, int(per_chunk.sum()))
        ids, lens = self.encode_pieces(list(place))
        begin = np.cumsum(lens) - lens
        ends = np.r_[0, np.cumsum(lens[order])][np.cumsum(per_chunk)]
        self.ids = np.concatenate([self.ids, gather(ids, begin[order], lens[order])])
        self.at = np.concatenate([self.at, self.at[-1] + ends])

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids (int32) of each text."""
        if len(self.chunk) > CACHE_CHUNKS:
            self._shrink()
        known, rows = len(self.chunk), []
        for text in texts:
            row: list[int | np.ndarray] = []
            for p in self.between.split(text) if self.special else [text]:
                if p in self.special:
                    row.append(self.special[p])
                elif p:
                    chunks = self.chunks(p)
                    row.append(self._numbers(chunks))
            rows.append(row)
        if len(self.chunk) > known:
            self._learn(list(islice(self.chunk, known, None)))
        self.uses = np.concatenate([self.uses, np.zeros(len(self.chunk) - len(self.uses), np.int64)])
        met = [p for row in rows for p in row if not isinstance(p, int)]
        if met:
            self.uses += np.bincount(np.concatenate(met), minlength=len(self.uses))
        if len(self.chunk) >= self.hot_at + HOT_EVERY:
            self._choose_hot()
        out = []
        for row in rows:
            got = [np.array([p], np.int32) if isinstance(p, int) else gather(self.ids, self.at[p], self.at[p + 1] - self.at[p]) for p in row]
            out.append(got[0] if len(got) == 1 else np.concatenate(got) if got else np.empty(0, np.int32))
        return out


class Codec(ChunkCache):
    """Encoder and decoder of one vocabulary file; lives in a worker process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.between = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.space = regex.compile(f"[{SPACE}]+")
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = t
        letters = byte_alphabet()
        self.inner = np.array([vocab.get(c, -1) for c in letters], np.int64)
        self.final = np.array([vocab.get(c + suffix, -1) for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        self.clear()

    # -- merge rounds -----------------------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of each pair in the sorted keys, and its rank (a large number if unknown)."""
        k = left << 32 | right
        pos = np.minimum(np.searchsorted(self.key, k), len(self.key) - 1)
        return pos, np.where(self.key[pos] == k, self.rank[pos], len(self.key))

    def encode_pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of ids of each word."""
        raw = [w.encode() for w in words]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[flat]
        last = np.cumsum(lens) - 1
        sym[last] = self.final[flat[last]]
        word = np.repeat(np.arange(len(raw)), lens)
        known = sym >= 0  # a byte that the vocabulary lacks gives no id
        sym, word = sym[known], word[known]
        done_sym, done_word, unknown = [], [], len(self.key)
        pos, rank = self._pairs(sym, word)
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(rank, starts)
            span = np.diff(np.r_[starts, len(word)])
            live = np.repeat(low < unknown, span)
            if not live.all():
                done_sym.append(sym[~live])
                done_word.append(word[~live])
                low, span = low[low < unknown], span[low < unknown]
                sym, word, pos, rank = sym[live], word[live], pos[live], rank[live]
                if not len(sym):
                    break
            hit = rank == np.repeat(low, span)
            hit = self._leftmost(hit)
            sym[hit] = self.made[pos[hit]]
            gone = np.r_[False, hit[:-1]]
            keep = ~gone
            redo = (hit | np.r_[hit[1:], False])[keep]  # the pair that starts at, and that ends at, a merge
            sym, word, pos, rank = sym[keep], word[keep], pos[keep], rank[keep]
            self._refresh(sym, word, pos, rank, np.flatnonzero(redo))
        out_sym = np.concatenate([*done_sym, sym]) if done_sym or len(sym) else sym
        out_word = np.concatenate([*done_word, word]) if done_word or len(word) else word
        order = np.argsort(out_word, kind="stable")
        return out_sym[order].astype(np.int32), np.bincount(out_word, minlength=len(raw))

    def _pairs(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pos = np.zeros(len(sym), np.int64)
        rank = np.full(len(sym), len(self.key), np.int64)
        if len(sym) > 1:
            self._refresh(sym, word, pos, rank, np.arange(len(sym)))
        return pos, rank

    def _refresh(self, sym, word, pos, rank, at) -> None:
        """Look up again the pairs that start at ``at``."""
        rank[at] = len(self.key)
        at = at[at < len(sym) - 1]
        at = at[word[at] == word[at + 1]]
        if len(at):
            pos[at], rank[at] = self._ranks(sym[at], sym[at + 1])

    @staticmethod
    def _leftmost(hit: np.ndarray) -> np.ndarray:
        """Of hits at consecutive places (the same symbol repeated) only every other one merges.
        Hits of different words never touch: a word's last symbol starts no pair."""
        run = np.flatnonzero(hit)
        if len(run) < 2 or not (run[1:] == run[:-1] + 1).any():
            return hit
        first = np.r_[True, run[1:] != run[:-1] + 1]
        begin = run[first][np.cumsum(first) - 1]
        out = np.zeros_like(hit)
        out[run[(run - begin) % 2 == 0]] = True
        return out

    # -- texts ------------------------------------------------------------------------------

    def chunks(self, text: str) -> list[str]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ").lower()  # code point by code point: no final sigma
        if not text.isascii() and CAPITALS.search(text):
            text = text.translate(SMALL)
        if any(s in text for s in SEPARATORS):
            return [c for c in self.space.split(text) if c]
        return text.split()

    def cut(self, chunk: str) -> list[str]:
        """Words of a chunk."""
        if not chunk.isascii() and NEWER.search(chunk):
            shadow = NEWER.sub("\ue000", chunk)  # a private code point: neither letter nor number
            return [chunk[m.start():m.end()] for m in self.words.finditer(shadow)]
        return self.words.findall(chunk)

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary file names no decoder: tokens are joined by single spaces."""
        return " ".join(map(self.token.__getitem__, ids.tolist()))


def gather(flat: np.ndarray, begin: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of flat[b:b + n] over all (b, n)."""
    total = int(lens.sum())
    shift = np.repeat(begin - (np.cumsum(lens) - lens), lens)
    return flat[np.arange(total) + shift]


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of this file; read once a process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, vocab_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the ``keep`` columns, ``n_tokens`` and ``ids`` (array of int)."""
    schema = with_fields(docs, keep, "n_tokens long, ids array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab_path)
        for b in slices(batches, "_text"):
            ids = c.encode(x or "" for x in b.column("_text").to_pylist())
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lens)].astype(np.int32)), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(lens), flat], [*keep, "n_tokens", "ids"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocab_path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``decoded`` text of a table with an array of ids."""
    schema = with_fields(encoded, keep, "decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab_path)
        for b in batches:
            texts = [c.decode(np.asarray(x.values, np.int32)) if x.is_valid else "" for x in b.column("_ids")]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(texts, pa.string())], [*keep, "decoded"])

    return encoded.select(*keep, F.col(ids).alias("_ids")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocab_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode, decode the ids, and keep digests of both: ``n_tokens``, ``ids_sha256`` (of the ids as
    little-endian unsigned 32-bit integers) and ``decoded_sha256`` (of the decoded text in UTF-8).
    One Python pass: neither ids nor decoded texts travel back to the JVM."""
    schema = with_fields(docs, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab_path)
        for b in slices(batches, "_text"):
            n, one, two = [], [], []
            for ids in c.encode(x or "" for x in b.column("_text").to_pylist()):
                n.append(len(ids))
                one.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                two.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(n, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())], [*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)
