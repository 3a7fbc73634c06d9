"""Quality rules: a decision list learned by sequential covering from labelled statistics.

``statistics`` measures every whole text. ``learn`` grows and prunes threshold conjunctions that
cover low-quality rows (the RIPPER scheme): on a grow part a rule takes the condition with the
highest FOIL gain until it covers no good row; on a prune part trailing conditions are dropped
while precision doesn't fall; a rule enters the list only if, over all training rows that no
earlier rule covers, the lower confidence bound of its precision reaches ``min_precision``.
``verdict`` turns the list into one ordered Spark conditional expression.

Learning uses at most ``train_rows`` labelled rows in expectation (the hash of the id decides);
all statistics are computed over all documents.

Defined results: null text counts as empty: all statistics 0, so the base rule fails it. A document
labelled twice takes its lowest label; null ids and null labels teach nothing. Without labels, or with one class
only, the list is empty and the base rule alone decides. Repeated rows are judged alike. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kardex.llm.common import slices, stage, text_or_empty, with_fields

WINDOW = 8  # words of a repetition window
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_distinct_words long, n_upper long, n_digits long"
# What the learner may put a threshold on: ratios, so that thresholds hold at any length.
FEATURES = {
    "word_length": "word_chars / n_words",
    "symbol_ratio": "n_symbols / n_words",
    "dup_line_ratio": "n_dup_lines / n_lines",
    "repeat_ratio": "n_repeat_words / n_words",
    "distinct_ratio": "n_distinct_words / n_words",
    "upper_ratio": "n_upper / word_chars",
    "digit_ratio": "n_digits / word_chars",
    "words_per_line": "n_words / n_lines",
}
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(WINDOW)], np.uint64)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of ``WINDOW`` words which the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = ids[:n].copy()
    for i in range(1, WINDOW):
        window += ids[i:i + n] * _POWERS[i]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    at = np.flatnonzero(hit)
    edge[at] += 1
    edge[at + WINDOW] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    """The statistics of one text, in the order of ``STATS``. Splitting UTF-8 bytes cuts at exactly
    the six ASCII white-space characters."""
    words = text.encode().split()
    if not words:
        return (0,) * 9
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words), len(lines), len(set(words)),
            sum(map(text.count, UPPER)), sum(map(text.count, DIGITS)))


UPPER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``STATS`` of every text."""
    schema = with_fields(docs, keep, STATS)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            got = list(zip(*map(measure, b.column("_text").to_pylist())))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), *(pa.array(x, pa.int64()) for x in got)], names)

    return docs.select(*keep, text_or_empty(text).alias("_text")).mapInArrow(run, schema)


def features(stats: DataFrame) -> DataFrame:
    """Ratios of ``FEATURES`` beside the statistics; 0 where the denominator is 0."""
    ratio = lambda e: F.expr(f"coalesce(try_divide(cast({e.split(' / ')[0]} as double), {e.split(' / ')[1]}), 0d)")
    return stats.withColumns({k: ratio(e) for k, e in FEATURES.items()})


@dataclass(frozen=True)
class Rule:
    """Reject where every condition (feature, "<=" or ">", threshold) holds."""

    conditions: tuple[tuple[str, str, float], ...]
    covered: int
    bad: int

    def column(self) -> Column:
        out = F.lit(True)
        for name, op, t in self.conditions:
            out = out & ((F.col(name) <= t) if op == "<=" else (F.col(name) > t))
        return out


def covers(conditions, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, op, t in conditions:
        v = x[:, names.index(name)]
        out &= (v <= t) if op == "<=" else (v > t)
    return out


def wilson(bad: int, n: int, z: float = 1.64) -> float:
    """Lower confidence bound of a share."""
    if not n:
        return 0.0
    p = bad / n
    return (p + z * z / (2 * n) - z * ((p * (1 - p) + z * z / (4 * n)) / n) ** 0.5) / (1 + z * z / n)


def best_condition(x: np.ndarray, bad: np.ndarray, names: list[str]):
    """The threshold with the highest FOIL gain over rows ``x``, or None."""
    p0, n0 = int(bad.sum()), len(bad)
    best, base = None, np.log2(p0 / n0)
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        v, b = x[order, j], np.cumsum(bad[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        low_n, low_p = cut + 1, b[cut]
        for op, p, n in (("<=", low_p, low_n), (">", p0 - low_p, n0 - low_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - base), -1.0)
            i = int(gain.argmax())
            if gain[i] > 1e-9 and (best is None or gain[i] > best[0]):
                best = (float(gain[i]), (name, op, float((v[cut[i]] + v[cut[i] + 1]) / 2)))
    return best and best[1]


def tightest(conditions: list) -> list:
    """One threshold per feature and direction: a later condition narrows an earlier one."""
    last = {(name, op): (name, op, t) for name, op, t in conditions}
    return list(last.values())


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], min_precision: float = 0.9, min_covered: int = 5,
          max_rules: int = 16, max_conditions: int = 4) -> list[Rule]:
    """Ordered rules that cover bad rows. Every third row of either class is a prune row."""
    rules: list[Rule] = []
    prune = np.zeros(len(bad), bool)
    for value in (True, False):
        prune[np.flatnonzero(bad == value)[2::3]] = True
    left = np.ones(len(bad), bool)
    while len(rules) < max_rules:
        grow_on, prune_on = left & ~prune, left & prune
        if bad[grow_on].sum() < 2 or bad[grow_on].all():
            break
        conditions: list = []
        inside = grow_on.copy()
        while len(conditions) < max_conditions and bad[inside].any() and not bad[inside].all():
            c = best_condition(x[inside], bad[inside], names)
            if c is None:
                break
            conditions.append(c)
            inside = grow_on & covers(conditions, x, names)

        def worth(k: int) -> float:
            hit = prune_on & covers(conditions[:k], x, names)
            return (bad[hit].sum() + 1) / (hit.sum() + 2)

        while len(conditions) > 1 and worth(len(conditions) - 1) >= worth(len(conditions)):
            conditions.pop()
        conditions = tightest(conditions)
        hit = left & covers(conditions, x, names)
        n, p = int(hit.sum()), int(bad[hit].sum())
        if not conditions or n < min_covered or wilson(p, n) < min_precision:
            break
        rules.append(Rule(tuple(conditions), n, p))
        left &= ~hit
    return rules


def fit(measured: DataFrame, labels: DataFrame, train_rows: int = 50_000, key: str = "doc_id", label: str = "quality", **how) -> list[Rule]:
    """Rules from the statistics of labelled documents (label 0: bad) that the base rule, first in
    the list, lets through. ``train_rows`` bounds the rows that reach the driver."""
    marks = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.min(label).alias("_label"))
    n = marks.count()
    unit = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    names = list(FEATURES)
    rows = (features(measured.where(~base_failed())).join(marks.where(unit < F.lit(min(1.0, train_rows / max(n, 1)))), key)
            .select(*names, "_label", key).distinct().orderBy(key, *names).drop(key).toPandas())
    if rows.empty:
        return []
    return learn(rows[names].to_numpy(float), (rows["_label"] == 0).to_numpy(), names, **how)


def base_failed() -> Column:
    """The fixed rule: under 20 words, or over 30 % of the words in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def verdict(rules: list[Rule]) -> Column:
    """The decision list as an ordered conditional expression: the number of the first rule that
    rejects (0 the base rule, then the learned rules from 1), null where none does."""
    out = F.when(base_failed(), F.lit(0))
    for i, rule in enumerate(rules, 1):
        out = out.when(rule.column(), F.lit(i))
    return out


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", **how) -> tuple[DataFrame, list[Rule]]:
    """The rows of ``docs`` that no rule rejects, and the learned rules. Rows travel as one struct, so
    their columns may have any names; texts are measured once and staged with their statistics."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_key"), F.col(text).alias("_measured"))
    measured = stage(statistics(packed, "_measured", ("_row", "_key")), "measured")
    rules = fit(measured.drop("_row").withColumnRenamed("_key", key), labels, key=key, **how)
    return features(measured).where(verdict(rules).isNull()).select("_row.*"), rules
