"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

Learning takes a bounded sample of labelled texts, each different text once: about ``train_rows`` of
either class and ``train_bytes`` of both. Two thirds of it, by a hash of the text, make the dictionaries:

* ordinary: a zstandard dictionary trained on windows of ordinary texts;
* toxic: one trained on the passages that set toxic texts apart, as most of a toxic text is prose like any
  other. They are the runs of bytes covered by k-grams that occur in more toxic than ordinary texts by
  ``MIN_Z`` standard errors and hardly ever in ordinary ones.

A text is lower-cased and cut into windows of ``WINDOW`` bytes, overlapping by half. Each window is compressed
twice, with the ordinary dictionary and with the ordinary one followed by the toxic one. Both sides know
ordinary prose equally well, so the bytes saved by the second (the margin) come from toxic passages. The
last third of the sample calibrates a logistic threshold on the margins of a text: the largest ones, their
means and the number of windows, as long texts save a byte by chance more often. Classes are weighed by their share
among all labelled texts.

Defined results: null text is empty, with one empty window; it is scored like all others. Without
labels of both classes nothing can be learned: every score is then the share of toxic labels (0 without
labels). Copies train once and are scored alike. Very long texts are scored whole, window by window.
Labels without a document, null labels and null ids of labels are left out.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kardex.llm.common import slices, stage, text_or_empty, with_fields

WINDOW, STRIDE = 48, 24
LEVEL = 3
ORDINARY_BYTES, TOXIC_BYTES = 64 << 10, 4 << 10
SAMPLES, PER_TEXT = 20_000, 30  # windows or passages that train a dictionary, and of one text
GRAMS = (5, 7, 8)  # bytes; a gram fits a 64-bit integer
MIN_Z, MAX_ORDINARY, MIN_TEXTS = 5.0, 0.05, 4
RIDGE = 0.3


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 3 == 1


def raw(text: str) -> bytes:
    return text.lower().encode()


def windows(data: bytes) -> Iterator[bytes]:
    return (data[i:i + WINDOW] for i in range(0, max(1, len(data) - WINDOW + STRIDE), STRIDE))


def grams(data: bytes, k: int) -> np.ndarray:
    """The k-gram at every place as an integer."""
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = max(0, len(b) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out << np.uint64(8) | b[i:i + n]
    return out


def marks(toxic: list[bytes], ordinary: list[bytes]) -> dict[int, np.ndarray]:
    """Per k the grams, sorted, that set toxic texts apart."""
    out = {}
    for k in GRAMS:
        count = lambda texts: np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(grams(t, k)) for t in texts)]), return_counts=True)
        (found, a), (plain, b) = count(toxic), count(ordinary)
        at = np.minimum(np.searchsorted(plain, found), max(0, len(plain) - 1))
        other = np.where(plain[at] == found, b[at], 0) if len(plain) else np.zeros(len(found))
        p, q = a / len(toxic), other / len(ordinary)
        mean = (a + other) / (len(toxic) + len(ordinary))
        z = (p - q) / np.sqrt(mean * (1 - mean) * (1 / len(toxic) + 1 / len(ordinary)) + 1e-12)
        out[k] = found[(z >= MIN_Z) & (q <= MAX_ORDINARY * p) & (a >= MIN_TEXTS)]
    return out


def passages(data: bytes, marked: dict[int, np.ndarray]) -> list[bytes]:
    """Runs of bytes that marks cover."""
    step = np.zeros(len(data) + 1, np.int32)
    for k, known in marked.items():
        at = np.flatnonzero(np.isin(grams(data, k), known))
        np.add.at(step, at, 1)
        np.add.at(step, at + k, -1)
    inside = np.concatenate(([False], np.cumsum(step)[:-1] > 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return [data[a:b] for a, b in zip(edges[::2], edges[1::2])]


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary; of too few samples for training their bytes themselves."""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    frame = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(LEVEL, **frame)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(LEVEL, dict_data=data, **frame)


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    share: float = 0.0  # of toxic labels
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray | None = None


class Scorer:
    """Compressors of a model; lives in a worker process."""

    def __init__(self, model: Model):
        self.model = model
        self.one, self.two = (compressor(d).compress for d in (model.ordinary, model.ordinary + model.toxic))

    def features(self, text: str) -> np.ndarray:
        data = raw(text)
        one, two = (np.fromiter(map(len, map(f, windows(data))), np.int64) for f in (self.one, self.two))
        d = (one - two).astype(np.float64)
        n = len(d)
        top = np.zeros(16)
        most = np.sort(np.partition(d, n - 16)[n - 16:] if n > 16 else d)[::-1]
        top[:len(most)] = most
        return np.array([*top[:4], top[4:8].mean(), top[8:].mean(), np.log(n), np.maximum(d - 2, 0).mean(), np.maximum(d, 0).mean(), d.mean()])

    def __call__(self, text: str) -> float:
        m = self.model
        if m.weights is None:
            return m.share
        x = (self.features(text) - m.mean) / m.scale
        return float(1 / (1 + np.exp(-np.clip(m.weights[0] + x @ m.weights[1:], -30, 30))))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps; a ridge keeps separable classes finite."""
    x = np.c_[np.ones(len(x)), x]
    ridge = RIDGE * np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(toxic: list[str], ordinary: list[str], share: float) -> Model:
    """The model of a sample: different texts in a fixed order, and the share of toxic ones among all."""
    fold = lambda texts, last: [t for i, t in enumerate(texts) if (i % 3 == 2) == last]
    if len(toxic) < 3 or len(ordinary) < 3:
        return Model(share=share)
    rng = random.Random(13)
    bad, good = ([raw(t) for t in fold(texts, False)] for texts in (toxic, ordinary))
    some = lambda found: found if len(found) <= PER_TEXT else rng.sample(found, PER_TEXT)
    mixed = lambda found: [s for s in rng.sample(found, min(len(found), SAMPLES)) if s]
    marked = marks(bad, good)
    found = mixed([p for t in bad for p in some(passages(t, marked))])
    if not found:  # nothing sets the classes apart: toxic text as it is
        found = mixed([w for t in bad for w in some(list(windows(t)))])
    model = Model(train(mixed([w for t in good for w in some(list(windows(t)))]), ORDINARY_BYTES), train(found, TOXIC_BYTES), share)
    score = Scorer(model)
    bad, good = fold(toxic, True), fold(ordinary, True)
    x = np.array([score.features(t) for t in bad + good])
    y = np.r_[np.ones(len(bad)), np.zeros(len(good))]
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-9
    weight = np.where(y == 1, share / len(bad), (1 - share) / len(good)) * len(y)
    model.weights = calibrate((x - model.mean) / model.scale, y, weight)
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        train_rows: int = 3000, train_bytes: int = 48 << 20) -> Model:
    """Learn from the labelled rows of ``docs``. The driver holds the sample: texts of more than a
    hundredth of ``train_bytes`` are not part of it."""
    marked = labels.where(F.col(label).isNotNull()).select(F.col(key).alias("of"), (F.col(label) == 1).alias("toxic"))
    rows = docs.select(F.col(key).alias("id"), text_or_empty(text).alias("text"))
    # Labels meet hashes of texts; only the texts of the sample travel.
    texts = rows.select("id", F.xxhash64("text").alias("hash"), F.octet_length("text").alias("size"))
    each = texts.join(marked, F.col("id") == F.col("of")).groupBy("toxic", "hash", "size").agg(F.count("*").alias("n"))
    each = stage(each, "labelled")
    counts = {r["toxic"]: r for r in each.groupBy("toxic").agg(F.count("*").alias("texts"), F.sum("n").alias("rows"), F.sum("size").alias("bytes")).collect()}
    total = sum(r["rows"] for r in counts.values())
    share = counts[True]["rows"] / total if True in counts else 0.0
    if len(counts) < 2:
        return Model(share=share)
    part = {c: min(train_rows / r["texts"], train_bytes / 2 / max(1, r["bytes"])) for c, r in counts.items()}
    unit = F.pmod("hash", F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = each.where((unit < F.when(F.col("toxic"), part[True]).otherwise(part[False])) & (F.col("size") <= train_bytes // 100))
    drawn = drawn.select("toxic", F.col("hash").alias("chosen"))  # about train_rows rows of either class
    sample = (rows.join(F.broadcast(drawn), F.xxhash64("text") == F.col("chosen")).groupBy("toxic", "chosen")
              .agg(F.first("text").alias("text")).orderBy("chosen", "toxic").collect())
    return learn([r["text"] for r in sample if r["toxic"]], [r["text"] for r in sample if not r["toxic"]], share)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted`` of every whole text."""
    schema = with_fields(docs, keep, "score double, predicted int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in slices(batches, "_text"):
            got = np.fromiter(map(scorer, b.column("_text").to_pylist()), np.float64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(got), pa.array((got >= threshold).astype(np.int32))], schema.names)

    return docs.select(*keep, text_or_empty(text).alias("_text")).mapInArrow(run, schema)
