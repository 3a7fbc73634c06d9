"""Language identification of mixed-language text.

Method: the script of a word (Unicode block ranges) narrows its candidate languages; each candidate
gets a per-word score (log posterior of character n-grams under naive Bayes, learned from labelled
documents); Viterbi decoding over the words with a penalty for every change of language labels
spans. The document's language is the one with the most letters.

Training is a Spark aggregation over labelled rows. Copies of a text count as one, and of a
language's different texts about ``train_per_lang`` are read (the text's hash decides, in the
proportion the counts give). Every n-gram and letter of those rows is
learned: the model is sparse, with an entry per n-gram and language that has it, so a language keeps
its own n-grams however many the others have. Prediction reads the text and nothing else.

Defined results: null text, empty text and text without a letter give ``und``, score 0 and no
span. Words in a script that no learned language uses score alike for all languages. Ties go to
the language that comes first by code point. Equal texts get equal results. With no labelled
row nothing is learned and every document is ``und``. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kardex.llm.common import slices, stage, text_or_empty, with_fields

UND = "und"
LETTERS = re.compile(r"[^\W\d_]+")
CACHE_WORDS = 500_000
# Words scored together and bytes of text decoded together: bounds of a task's memory.
LEARN_WORDS, SLICE_BYTES = 10_000, 4 << 20

# Code point ranges of scripts, by the Unicode block table.
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF),
    ("arabic", 0x750, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("gurmukhi", 0xA00, 0xA7F),
    ("gujarati", 0xA80, 0xAFF), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F), ("kannada", 0xC80, 0xCFF),
    ("malayalam", 0xD00, 0xD7F), ("sinhala", 0xD80, 0xDFF), ("thai", 0xE00, 0xE7F), ("lao", 0xE80, 0xEFF),
    ("tibetan", 0xF00, 0xFFF), ("myanmar", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF), ("ethiopic", 0x1200, 0x137F),
    ("khmer", 0x1780, 0x17FF), ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("han", 0x20000, 0x3FFFF),
]
_STARTS = np.array(sorted(lo for _, lo, _ in SCRIPTS))
_BY_START = {lo: (name, hi) for name, lo, hi in SCRIPTS}


def script_of(char: str) -> str:
    i = int(np.searchsorted(_STARTS, ord(char), side="right")) - 1
    if i >= 0:
        name, hi = _BY_START[int(_STARTS[i])]
        if ord(char) <= hi:
            return name
    return "other"


def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bigrams and trigrams of the words between their edges: code (21 bits a code point), word and
    size of each."""
    padded = [f" {w} " for w in words]
    c = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    word = np.repeat(np.arange(len(words)), np.fromiter(map(len, padded), np.int64, len(padded)))
    two, three = word[1:] == word[:-1], word[2:] == word[:-2]
    pairs = c[:-1] << 21 | c[1:]
    codes = np.r_[pairs[two], (pairs[:-1] << 21 | c[2:])[three]]
    size = np.repeat([2, 3], [int(two.sum()), int(three.sum())])
    return codes, np.r_[word[:-1][two], word[:-2][three]], size


def code_of(gram: str) -> int:
    code = 0
    for c in gram:
        code = code << 21 | ord(c)
    return code


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", train_per_lang: int = 4000, train_rows: int = 200_000,
        prior: float = 200.0, script_share: float = 0.01) -> dict:
    """Learn the per-word model from labelled rows (null text or label: left out): about
    ``train_per_lang`` different texts of each language and about ``train_rows`` of all, which bounds what the
    driver holds; every language keeps one text at least, however many there are.

    Returns languages in code point order, the scripts each one uses (at least ``script_share`` of
    its letters) and the log probabilities of its n-grams, less what is the same for all languages:
    ``known`` for an n-gram that the language lacks and more by ``logs`` for one that it has (row i
    has entries ``starts[i]`` to ``starts[i + 1]`` for the languages in ``at``). Counts are smoothed
    with ``prior`` n-grams of the distribution over all languages, and an n-gram that none has says
    nothing, so a language with few labelled rows neither wins unknown words nor is ruled out by
    them."""
    rows = labelled.select(F.col(text).alias("t"), F.col(lang).alias("l"), F.xxhash64(F.col(text)).alias("h"))
    rows = rows.where(F.col("t").isNotNull() & F.col("l").isNotNull())
    unit = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    sizes = stage(rows.select("l", "h").distinct().groupBy("l").agg(F.count("*").alias("n"), F.min(unit).alias("least")), "languages")
    each = min(train_per_lang, max(1, train_rows // max(1, sizes.count())))
    sizes = sizes.select(F.col("l").alias("of"), "n", "least")
    # The text with the smallest hash is always in.
    words = (rows.join(sizes, F.col("l") == F.col("of")).where((unit < each / F.col("n")) | (unit <= F.col("least"))).dropDuplicates(["l", "h"])
             .select("l", F.explode(F.split(F.lower("t"), r"[^\p{L}]+")).alias("w")).where("w <> ''")
             .groupBy("l", "w").count())
    padded = F.concat(F.lit(" "), F.col("w"), F.lit(" "))

    def pieces(n: int) -> Column:  # the lambda has one argument: a second one would be the position
        return F.transform(F.sequence(F.lit(1), F.length("w") + (3 - n)), lambda i: F.substr(padded, i, F.lit(n)))

    chars = F.transform(F.split("w", ""), lambda c: F.concat(F.lit("="), c))
    counts = (words.select("l", "count", F.explode(F.concat(pieces(2), pieces(3), chars)).alias("g"))
              .groupBy("g", "l").agg(F.sum("count").alias("n")))
    got = counts.toArrow()
    names = got["l"].to_pylist()
    langs = sorted(set(names))
    of = {x: i for i, x in enumerate(langs)}
    lang_at = np.fromiter(map(of.__getitem__, names), np.int32, len(names))
    n = got["n"].to_numpy().astype(np.float64)
    text_of = got["g"].to_pylist()
    is_letter = np.fromiter((len(g) == 2 and g[0] == "=" for g in text_of), bool, len(text_of))
    letters: dict[str, np.ndarray] = {}
    for i in np.flatnonzero(is_letter):
        letters.setdefault(script_of(text_of[i][1]), np.zeros(len(langs)))[lang_at[i]] += n[i]
    rest = np.flatnonzero(~is_letter)
    size = np.fromiter((len(text_of[i]) for i in rest), np.int8, len(rest))
    codes = np.fromiter((code_of(text_of[i]) for i in rest), np.int64, len(rest))
    order = np.lexsort((lang_at[rest], codes))
    size, codes, lang_at, n = size[order], codes[order], lang_at[rest][order], n[rest][order]
    grams, first, row = np.unique(codes, return_index=True, return_inverse=True)
    everywhere = np.bincount(row, n, len(grams)).astype(np.float64)
    known, missing = {}, {k: np.zeros(len(langs)) for k in (2, 3)}
    for k in (2, 3):
        pick = size == k
        everywhere[size[first] == k] /= max(n[pick].sum(), 1)
        known[k] = -np.log(np.bincount(lang_at[pick], n[pick], len(langs)) + prior)
    logs = np.log1p(n / (prior * everywhere[row]))
    all_letters = sum(letters.values()) if letters else np.zeros(len(langs))
    uses = {s: (v / np.maximum(all_letters, 1)) >= script_share for s, v in letters.items()}
    return {"langs": langs, "grams": grams, "starts": np.r_[first, len(codes)], "at": lang_at, "logs": logs.astype(np.float32),
            "known": known, "missing": missing, "uses": uses}


class Labeller:
    """Scores words and decodes texts; lives in a worker process."""

    def __init__(self, model: dict, switch: float, floor: float):
        self.langs, self.switch, self.floor = model["langs"], switch, floor
        grams, logs, n = np.asarray(model["grams"]), model["logs"], len(self.langs)
        starts, at = model.get("starts"), model.get("at")
        if logs.ndim == 2:  # a row of n-gram texts and languages: every entry is there
            codes = np.fromiter(map(code_of, grams), np.int64, len(grams))
            order = np.argsort(codes)
            grams, logs = codes[order], logs[order].ravel()
            starts, at = np.arange(len(grams) + 1) * n, np.tile(np.arange(n), len(grams))
        self.grams, self.logs, self.starts, self.at = grams, logs, starts, at
        zero = np.zeros(n)
        known = model.get("known", {})
        # What an n-gram says by itself: of size 2 or 3, without a row or with one.
        self.plain = np.vstack([model["missing"][2], known.get(2, zero), model["missing"][3], known.get(3, zero)])
        self.uses = model["uses"]
        self.clear()

    def clear(self):
        self.word: dict[str, int] = {}
        self.score = np.empty((0, len(self.langs)), np.float32)
        self.size = np.empty(0, np.int64)

    def _learn(self, new: list[str]) -> None:
        """Log posteriors of new words: n-gram evidence over the script's candidates, floored."""
        codes, word, size = codes_of(new)
        k = len(self.langs)
        ids = np.searchsorted(self.grams, codes)
        hit = np.zeros(len(codes), bool)
        inside = ids < len(self.grams)
        hit[inside] = self.grams[ids[inside]] == codes[inside]
        s = np.bincount(word * 4 + (size - 2) * 2 + hit, minlength=4 * len(new)).reshape(-1, 4) @ self.plain
        # All entries of the rows met: (word, language) cells and their sums.
        first, lens = self.starts[ids[hit]], np.diff(self.starts)[ids[hit]]
        entry = np.repeat(first - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
        s += np.bincount(np.repeat(word[hit], lens) * k + self.at[entry], self.logs[entry], len(new) * k).reshape(-1, k)
        s /= 2  # each letter counts in two orders
        for script in {script_of(w[0]) for w in new}:
            ok = self.uses.get(script)
            if ok is None or not ok.any():
                s[[i for i, w in enumerate(new) if script_of(w[0]) == script]] = 0
            elif not ok.all():
                s[np.ix_([i for i, w in enumerate(new) if script_of(w[0]) == script], ~ok)] = -1e6
        s -= s.max(1, keepdims=True)
        s -= np.log(np.exp(s).sum(1, keepdims=True))
        base = len(self.word)
        self.word.update((w, base + i) for i, w in enumerate(new))
        if base + len(new) > len(self.score):  # room doubles, so growth costs the same per word
            room = max(base + len(new), 2 * len(self.score))
            self.score = np.vstack([self.score, np.empty((room - len(self.score), len(self.langs)), np.float32)])
            self.size = np.r_[self.size, np.empty(room - len(self.size), np.int64)]
        self.score[base:base + len(new)] = np.maximum(s, self.floor)
        self.size[base:base + len(new)] = np.fromiter(map(len, new), np.int64, len(new))

    def decode(self, texts: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """(language, score, spans) of each text; spans are (start, end, language) in code points."""
        found = [[w for w in LETTERS.findall(t.lower()) if w.isalpha() or any(map(str.isalpha, w))] if self.langs else [] for t in texts]
        if len(self.word) > CACHE_WORDS:
            self.clear()
        new = list(dict.fromkeys(w for f in found for w in f if w not in self.word))
        for i in range(0, len(new), LEARN_WORDS):
            self._learn(new[i:i + LEARN_WORDS])
        ids = [np.fromiter(map(self.word.__getitem__, f), np.int64, len(f)) for f in found]
        labels = viterbi([self.score[i] for i in ids], self.switch)
        out = []
        for text, i, lab in zip(texts, ids, labels):
            if not len(i):
                out.append((UND, 0.0, []))
                continue
            size = self.size[i]
            mass = np.bincount(lab, weights=size, minlength=len(self.langs))
            best = int(mass.argmax())
            own = lab == best
            sure = float((np.exp(self.score[i[own], best]) * size[own]).sum() / size.sum())
            out.append((self.langs[best], min(1.0, max(0.0, sure)), self._spans(text, lab)))
        return out

    def _spans(self, text: str, lab: np.ndarray) -> list[tuple[int, int, str]]:
        """Spans from the first to the last letter of each run of equal labels."""
        where = [(m.start(), m.end()) for m in LETTERS.finditer(text) if any(map(str.isalpha, m[0]))] if (lab != lab[0]).any() else None
        if where is None or len(where) != len(lab):  # lower-casing may cut a word at a mark: one span then
            start = next(i for i, c in enumerate(text) if c.isalpha())
            end = next(i for i in range(len(text), 0, -1) if text[i - 1].isalpha())
            return [(start, end, self.langs[int(np.bincount(lab).argmax())])]
        cuts = np.flatnonzero(np.diff(lab)) + 1
        return [(where[a][0], where[b - 1][1], self.langs[lab[a]]) for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(lab)].tolist())]


def viterbi(scores: list[np.ndarray], switch: float) -> list[np.ndarray]:
    """Best label path of every sequence: the sum of its word scores minus ``switch`` for each
    change of label. All sequences advance together, longest first, so one step of the loop works
    on the t-th word of every text that has one."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(scores)
    lens = np.fromiter(map(len, scores), np.int64, len(scores))
    order = np.argsort(-lens, kind="stable")
    order = order[lens[order] > 0]
    if not len(order):
        return out
    lens = lens[order]
    flat = np.concatenate([scores[i] for i in order])
    begin = np.cumsum(lens) - lens
    alive = np.searchsorted(-lens, -np.arange(1, lens[0] + 1), side="right")  # sequences with a word t
    step = np.r_[0, np.cumsum(alive)]
    k = flat.shape[1]
    back = np.empty((len(flat), k), np.int16 if k > 120 else np.int8)
    own = np.arange(k, dtype=back.dtype)
    v = flat[begin].astype(np.float64)
    ends = np.zeros(len(lens), np.int64)
    for t in range(1, int(lens[0])):
        n = alive[t]
        if n < len(v):
            ends[n:len(v)] = v[n:].argmax(1)
            v = v[:n]
        top = v.argmax(1)
        jump = v[np.arange(n), top] - switch
        turn = jump[:, None] > v
        back[step[t]:step[t + 1]] = np.where(turn, top[:, None].astype(back.dtype), own)
        v = np.where(turn, jump[:, None], v) + flat[begin[:n] + t]
    ends[:len(v)] = v.argmax(1)
    labels = np.empty(len(flat), np.int64)
    for t in range(int(lens[0]) - 1, -1, -1):
        n = alive[t]
        labels[begin[:n] + t] = ends[:n]
        if t:
            ends[:n] = back[step[t] + np.arange(n), ends[:n]]
    for j, i in enumerate(order):
        out[i] = labels[begin[j]:begin[j] + lens[j]]
    return out


def predict(docs: DataFrame, model: dict, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
            switch: float = 6.0, floor: float = -4.0) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` (0 to 1: share of the letters in spans of that
    language, weighted by the words' posteriors) and ``spans``. ``floor`` bounds what one word can
    say, ``switch`` is the price of a change: two odd words don't make a span, a sentence does."""
    schema = with_fields(docs, keep, "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value, switch, floor)
        for b in slices(batches, "_text", SLICE_BYTES):
            got = labeller.decode(b.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keep))), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([[{"start": s, "end": e, "lang": x} for s, e, x in g[2]] for g in got], span_type)],
                [*keep, "lang_pred", "score", "spans"])

    return docs.select(*keep, text_or_empty(text).alias("_text")).mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    """Fold of a row: true where crc32 of the id as text leaves no remainder by 5."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 0
