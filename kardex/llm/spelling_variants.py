"""Spelling variants of words: pairs one edit apart by a variable-length gram index, then forms.

Gram dictionary: every gram of ``MIN_GRAM`` characters, and a longer one (up to ``MAX_GRAM``) if the
gram without its last character stands in more words than a limit and the gram itself in two words
or more. Long lists are thus split into those of longer grams, short ones are not. The limit is the
smallest power of two from ``MIN_LIST`` on that leaves ``MAX_GRAMS`` grams at most, so the dictionary
that goes to every task is bounded; another limit gives other lists and the same pairs.

A word is decomposed from left to right: at each place the longest gram of the dictionary, dropped
if it lies within an earlier one. For each word the largest number of grams that one edit can affect
is computed: those over the edited place, those to its left that a gram of the dictionary could
extend across it, and those to its right that a gram reaching across it could swallow. All others
are in the decomposition of the edited word as well, at the same place or shifted by one. So two
words one edit apart share a gram among the ``affected + 1`` rarest of either: only these short
lists are merged. Grams are at most half as long as the shorter word of a pair, hence the first and
the last gram are never affected together and the bound leaves one shared gram at least. As this
limits grams by length, pairs are looked for per length of the shorter word; a word takes part
with its own length and, as the longer word, with its length less one.

A list is split by where the edit is: left or right of the shared gram, and on a side of more than
``MAX_WINDOW`` letters in which half of it; all letters outside that part agree. That makes the merge an equi-join over
small groups, whose rows are verified in the join condition by edit distance: no group is collected and no
unverified pair is written.

Defined results: words are compared by code point. Null texts have no words; a null id counts as an
empty one. Repeated rows count each time. A word's form is its near word of largest count (ties: the
smallest by code point) if that is at least ``ratio`` times its own; counts grow tenfold along forms,
so they hold no cycle and five doublings reach every root. No words: no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.llm.common import slices, stage, text_or_empty

MIN_GRAM, MAX_GRAM = 2, 6
MIN_LIST, MAX_GRAMS = 64, 50_000
# A side of the shared gram with more letters is looked at in halves.
MAX_WINDOW = 2
WORDS = 50_000  # of a task

# Latin-1: A-Z are lower-cased, a-z and U+00C0 to U+00FF stay, the rest is a blank.
LETTER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs_of(text: str) -> list[bytes]:
    """Runs of letters, one byte a letter. Code points beyond Latin-1 separate runs."""
    return text.encode("latin-1", "replace").translate(LETTER_BYTES).split()


def with_slip(run: bytes, seed: int, every: int) -> bytes:
    """The run as document ``seed`` writes it: one letter less where ``every`` divides the checksum."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def words_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = 7, min_count: int = 2, every: int = 31) -> DataFrame:
    """(word, n): the words of all documents, as their documents write them."""
    docs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), text_or_empty(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            seen: Counter = Counter()
            for i, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                seed = zlib.crc32(f"{i}:".encode())
                for w, n in Counter(w for w in runs_of(t) if len(w) >= min_length).items():
                    w = with_slip(w, seed, every)
                    if len(w) >= min_length:
                        seen[w] += n
            yield pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in seen], pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """Gram -> words that hold it; ``MAX_GRAMS`` and the two-letter grams at most."""
    grams = F.expr(f"array_distinct(flatten(transform(sequence({MIN_GRAM}, least({MAX_GRAM}, length(word))), q -> transform(sequence(1, length(word) - q + 1), p -> substring(word, p, q)))))")
    counted = stage(words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("words")), "grams")
    parents = counted.select(F.col("gram").alias("parent"), F.col("words").alias("parent_words"))
    longer = counted.where((F.length("gram") > MIN_GRAM) & (F.col("words") > 1)).withColumn("parent", F.expr("left(gram, length(gram) - 1)")).join(parents, "parent")
    limits = [MIN_LIST << i for i in range(40)]
    kept = longer.agg(*(F.count_if(F.col("parent_words") > t).alias(str(t)) for t in limits)).first()
    limit = next(t for t in limits if kept[str(t)] <= MAX_GRAMS)
    chosen = longer.where(F.col("parent_words") > limit).select("gram", "words")
    return {r["gram"]: r["words"] for r in chosen.unionByName(counted.where(F.length("gram") == MIN_GRAM)).collect()}


class Grams:
    """Decomposition by a dictionary, and how many grams one edit affects."""

    def __init__(self, dictionary: dict[str, int]):
        self.words = dictionary
        self.extended = {g[:-1] for g in dictionary}  # what a longer gram begins with: the dictionary holds every prefix
        self.shortest: dict[str, int] = {}  # end of a gram -> length of the shortest such gram
        for g in dictionary:
            for i in range(1, len(g)):
                self.shortest[g[i:]] = min(len(g), self.shortest.get(g[i:], len(g)))

    def decompose(self, word: str, longest: int) -> tuple[list[int], list[int]]:
        """Starts and ends of the word's grams, both ascending."""
        starts, ends, covered, size = [], [], 0, len(word)
        for p in range(size - MIN_GRAM + 1):
            end, most = p + MIN_GRAM, min(size, p + longest)
            while end < most and word[p:end + 1] in self.words:
                end += 1
            if end > covered:
                starts.append(p)
                ends.append(end)
                covered = end
        return starts, ends

    def affected(self, word: str, longest: int, starts: list[int], ends: list[int]) -> int:
        """Most grams that one deleted, replaced (``hole`` 1) or inserted (``hole`` 0) letter affects."""
        size, most = len(word), 0
        for hole in (0, 1):
            for i in range(size + 1 - hole):
                right = i + hole
                first = i  # leftmost place from which a gram may reach across the edit
                for p in range(max(0, i - longest + 1), i):
                    if i - p < MIN_GRAM or word[p:i] in self.extended:
                        first = p
                        break
                last = right  # rightmost place up to which one may reach
                for e in range(min(size, right + longest - 1), right, -1):
                    if self.shortest.get(word[right:e], longest + 1) <= longest:
                        last = e
                        break
                # starts and ends ascend, so the affected grams are neighbours
                lo = min(bisect_left(starts, first), bisect_right(ends, i))
                hi = max(bisect_left(starts, right), bisect_right(ends, last))
                most = max(most, hi - lo)
        return most

    def rarest(self, word: str, base: int) -> list[tuple[int, int]]:
        """(start, end) of the grams whose lists are merged, when pairs of shorter length ``base`` are
        looked for: one more than an edit affects, rarest first."""
        longest = min(MAX_GRAM, base // 2)
        starts, ends = self.decompose(word, longest)
        ranked = sorted((self.words[word[p:e]], word[p:e], p, e) for p, e in zip(starts, ends))
        return [(p, e) for _, _, p, e in ranked[:self.affected(word, longest, starts, ends) + 1]]


def windows(a: int, b: int) -> list[tuple[int, int]]:
    """The letters from a to b as one part, or in halves."""
    half = (a + b) // 2
    return [(a, b)] if b - a <= MAX_WINDOW else [(a, half), (half, b)]


def keys_of(word: str, base: int, p: int, e: int) -> Iterator[str]:
    """Keys of the groups that a word joins for the gram at [p, e): base length, place of the gram, the part
    that may hold the edit, and all letters outside it. ``extra`` letters more than the base stand
    in that part."""
    extra = len(word) - base
    at, to = p - extra, e - extra  # the gram in the shorter word, if the edit is to its left
    parts = [(at, to, a, b) for a, b in windows(0, at)] if at >= 0 else []
    if e <= base:
        parts += [(p, e, a, b) for a, b in windows(e, base)]
    for at, to, a, b in parts:
        yield f"{base} {at} {to} {a} {b} {word[:a]} {word[b + extra:]}"


def gram_lists(words: DataFrame, dictionary: dict[str, int], min_length: int) -> DataFrame:
    """(key, longer, word, n): the groups of all words; ``longer`` marks a word with a letter more than
    the group's base length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(dictionary)
        for b in slices(batches, "word", 16 << 10):
            keys: list[str] = []
            at, longer, ends = [], [], []  # of each run of keys: the word's row, its side, where it ends
            for i, word in enumerate(b.column("word").to_pylist()):
                for base in range(max(min_length, len(word) - 1), len(word) + 1):
                    for p, e in grams.rarest(word, base):
                        keys.extend(keys_of(word, base, p, e))
                    at.append(i)
                    longer.append(len(word) > base)
                    ends.append(len(keys))
            many = np.diff(ends, prepend=0)
            row = pa.array(np.repeat(np.array(at, np.int64), many))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(np.repeat(np.array(longer, bool), many)),
                                              b.column("word").take(row), b.column("n").take(row)], ["key", "longer", "word", "n"])

    return words.mapInArrow(run, "key string, longer boolean, word string, n long").withColumn("key", F.xxhash64("key"))


def near_pairs(words: DataFrame, min_length: int = 7) -> DataFrame:
    """(a, n_a, b, n_b): every pair of ``words`` (word, n) one edit apart, once."""
    if min_length < 2 * MIN_GRAM:
        raise ValueError(f"words need {2 * MIN_GRAM} letters: a shorter one may lose all its grams to one edit")
    words = words.where(F.length("word") >= min_length)
    # Words are short and their decomposition is work: tasks by number of words, not by bytes.
    tasks = max(1, -(-words.count() // WORDS))
    lists = stage(gram_lists(words.repartition(tasks, "word"), gram_dictionary(words), min_length), "gram-lists")
    # Which side is the shorter word is asked of both at once, so that neither side is filtered by itself
    # and one shuffle serves both.
    ordered = F.expr("x.longer < y.longer or (x.longer = y.longer and not y.longer and x.word < y.word)")
    met = lists.alias("x").join(lists.alias("y"), (F.col("x.key") == F.col("y.key")) & ordered & (F.levenshtein(F.col("x.word"), F.col("y.word"), 1) == 1))
    return met.select(F.col("x.word").alias("a"), F.col("x.n").alias("n_a"), F.col("y.word").alias("b"), F.col("y.n").alias("n_b")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words that have a form: (word, form) followed to its end, twice as far each time."""
    known = forms.select("word", F.col("form").alias("root"))
    while True:
        known = stage(known, "roots")
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if known.join(ahead, "root", "left_semi").isEmpty():
            return known
        known = known.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, ratio: int = 10, min_length: int = 7) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all ``words`` (word, n)."""
    pairs = near_pairs(words, min_length)
    side = lambda w, n, o, m: F.struct(F.col(w).alias("word"), F.col(n).alias("n"), F.col(o).alias("other"), F.col(m).alias("m"))
    links = pairs.select(F.inline(F.array(side("a", "n_a", "b", "n_b"), side("b", "n_b", "a", "n_a"))))
    best = links.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    near = stage(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                                         F.when(-F.col("best.m") >= ratio * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.m")).alias("n"))).alias("to")), "variants")
    near = near.select("word", "n", "n_near", F.col("to.form").alias("form"), F.col("to.n").alias("form_n"))
    ends = roots(near.where(F.col("form").isNotNull()).select("word", "form"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
