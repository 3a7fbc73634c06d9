"""Results do not depend on sizes, settings or lengths."""

import random
from collections import Counter

import numpy as np
import pytest

from llm_helpers import syllables


def mixed(spark, docs, parts):
    from kardex.llm import mixing

    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        return Counter((r["doc_id"], r["taken"], tuple(r["positions"])) for r in mixing.mix(docs).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_mix_is_the_same_under_any_partitioning(spark, monkeypatch):
    from kardex.llm import mixing

    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 9), rng.choice("aaab")) for i in range(60_000)] + [(None, "same row", "b")] * 25_000
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5).cache()
    want = mixed(spark, docs, 4)
    assert mixed(spark, docs, 8) == want == mixed(spark, docs, 60)
    monkeypatch.setattr(mixing, "bucket_bits", lambda n: 3)
    monkeypatch.setattr(mixing, "COPIES", 64)
    assert mixed(spark, docs, 8) == want
    docs.unpersist()


def test_samples_of_equal_and_almost_equal_rows(spark, monkeypatch):
    """Rows that differ in another column only are rows of their own; equal ones come as often as they are."""
    from kardex.llm import mixing

    monkeypatch.setattr(mixing, "COPIES", 3)
    rows = [(1, "one two three", "a", {"k": 1}, "x")] * 10 + [(1, "one two three", "a", {"k": 2}, "y"), (1, "one two three", "b", None, "y"), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, more map<string,int>, note string")
    got = Counter((r["source"], r["note"]) for r in mixing.mixed_rows(docs, budget=2.0).collect())
    assert got == {("a", "x"): 20, ("a", "y"): 2, ("b", "y"): 2}  # a source without words has the target 0


def test_different_texts_without_words_stay(spark):
    from kardex.llm import jaccard_join as j

    texts = ["🎉🎈 " * 30, "★ ☆ ♪ " * 20, "+--+ |  | +--+ " * 10, "🎉🎈 " * 30, None, "", " \n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["copy_id"]) for r in j.join(docs).collect()}
    assert got == {0: (0, 0), 1: (1, 1), 2: (2, 2), 3: (0, 0), 4: (4, 4), 5: (4, 4), 6: (4, 4)}
    assert {r["doc_id"] for r in j.representatives(docs).collect()} == {0, 1, 2, 4}


def test_ids_that_are_texts(spark):
    from kardex.llm import jaccard_join as j

    base = syllables(random.Random(1), 80)
    docs = spark.createDataFrame([("b", base), ("a", base + " more"), ("é", syllables(random.Random(2), 80)), (None, base)], "doc_id string, text string")
    assert {r["doc_id"]: r["class_id"] for r in j.join(docs).collect()} == {"b": "a", "a": "a", "é": "é", None: "a"}
    assert {r["doc_id"] for r in j.representatives(docs).collect()} == {"a", "é"}


def test_tiles_bounded_by_bytes(spark, monkeypatch):
    from pyspark.sql import functions as F

    from kardex.llm import jaccard_join as j

    base = syllables(random.Random(3), 400).split()
    docs = spark.createDataFrame([(i, " ".join(base[:i] + ["zz"] + base[i + 1:])) for i in range(20)], "doc_id long, text string")
    sets = j.classes(j.signatures(docs, *j.choose_bands()))
    monkeypatch.setattr(j, "TILE_GRAMS", 1000)
    assert j.buckets(sets, j.choose_bands()[0]).agg(F.max("tiles")).first()[0] == 8
    assert {(r["class_id"], r["n_links"]) for r in j.join(docs).collect()} == {(0, 19)}


def test_every_language_is_learned(spark):
    """More than 500 languages, each with few texts."""
    from kardex.llm import langid

    rng = random.Random(7)
    words = {f"l{i:03d}": [chr(0x4E00 + 20 * i + j) * 2 for j in range(20)] for i in range(620)}
    rows = [(" ".join(rng.choices(words[x], k=12)), x) for x in words for _ in range(3)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), train_rows=700)
    assert model["langs"] == sorted(words)
    full = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    probe = spark.createDataFrame([(i, " ".join(words[x] * 2)) for i, x in enumerate(words)], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(probe, full).collect()}
    assert all(got[i] == x for i, x in enumerate(words))


MASK = (1 << 64) - 1


def plain_sketch(text, k=9, entries=64, pick=2):
    """The sketch from its definition: per entry the k-mers that follow its place on the circle."""
    if not text:
        return []

    def mix(x):
        x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & MASK
        x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & MASK
        return x ^ (x >> 32)

    codes = [ord(c) for c in text] + [0x110000] * max(0, k - len(text))
    powers = [pow(0xD6E8FEB86659FD93, i, 1 << 64) for i in range(k)]
    hashes, seen = [], Counter()
    for p in range(max(1, len(text) - k + 1)):
        v = sum((c + 1) * m for c, m in zip(codes[p:p + k], powers)) & MASK
        hashes.append(mix(v + seen[v] * 0x9E3779B97F4A7C15 & MASK))
        seen[v] += 1
    order = sorted(range(len(hashes)), key=lambda p: (hashes[p], p))
    out = []
    for j in range(entries):
        first = next((i for i, p in enumerate(order) if hashes[p] >= j << 58), 0)
        picks = sorted(order[(first + i) % len(order)] for i in range(min(pick, len(order))))
        got = 0
        for p in picks:
            got = got * 0x9E3779B97F4A7C15 + hashes[p] & MASK
        out.append(mix(got) >> 48)
    return out


def test_sketch_from_its_definition():
    from kardex.llm.fingerprints import sketch

    rng = random.Random(5)
    texts = ["", "a", "ab", "é" * 9, "abcabcabc" * 5, "🎉" * 40] + ["".join(rng.choices("abc é", k=rng.randint(1, 400))) for _ in range(150)] + [syllables(rng, 3000), "xy" * 4000]
    for t in texts:
        assert sketch(t).tolist() == plain_sketch(t)


@pytest.mark.parametrize("size", [70, 100, 140, 250, 1000])
def test_order_counts_at_every_length(size):
    """Swapped halves keep nearly all k-mers and about half of the order."""
    from kardex.llm.fingerprints import likeness, sketch

    rng = random.Random(size)
    near = []
    for _ in range(200):
        t = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=size))
        near.append(likeness(sketch(t), sketch(t[size // 2:] + t[:size // 2])))
    assert 0.45 < np.mean(near) < 0.78


def test_any_column_names_pass_all_stages(spark, odd):
    """Columns named like anything the stages use inside come back with their own values."""
    import corpus_pipeline

    names = ("row key id hash text_hash body body_hash found blocks last masked order spot copies before tilt target nth position block "
             "best_id best_hash n _row _key _measured _text _text_hash _id _n _hash _found _before _order _position _positions _best_hash _place").split()
    folder, rows = odd
    docs = spark.createDataFrame([(*r, *(f"{n}-{r[0]}" for n in names)) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    for name, f in corpus_pipeline.STAGES[:4]:
        out = f(spark, docs, folder)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all(r[n] == f"{n}-{r['doc_id']}" for r in got for n in names), name
        if name == "secret scans":
            assert any("[SECRET]" in (r["text"] or "") for r in got) and not any("hunter22" in (r["text"] or "") for r in got)


def test_very_many_secrets_in_one_text(spark):
    """100,000 spans in one text are masked in linear time."""
    import time

    from kardex.llm import secret_scan as s

    text = "".join(f"é{i:016x} " for i in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, "clean"), (3, "password=" + "x" * 9000 + " tail")], "doc_id long, text string")
    start = time.time()
    got = {r["doc_id"]: r["text"] for r in s.redact(docs, s.report(docs)).collect()}
    assert got == {1: "é[SECRET] " * 100_000, 2: "clean", 3: "[SECRET] tail"} and time.time() - start < 120
