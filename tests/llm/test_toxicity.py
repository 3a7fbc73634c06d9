"""Toxicity: held-out accuracy, the parts by brute force, odd rows."""

import random
import zlib

import numpy as np
import pytest
import zstandard

from kardex.llm import toxicity as tx
from llm_helpers import syllables

MARKS = ["vermin", "numbskull", "garbage", "blöder"]


def corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = syllables(rng, rng.choice((6, 40, 150, 600))).split()
        bad = rng.random() < 0.25
        if bad:
            for _ in range(rng.randint(1, 1 + len(words) // 30)):
                words.insert(rng.randint(0, len(words)), rng.choice(MARKS))
        rows.append((i, " ".join(words).capitalize() + ".", "xx", "s", int(bad)))
    return rows


def test_held_out_documents(spark):
    rows = corpus(1, 900)
    docs = spark.createDataFrame([(*r[:4], 0.5, 1) for r in rows], "doc_id long, text string, lang string, source string, score double, predicted int").repartition(4)
    labels = spark.createDataFrame([(r[0], 1, r[4]) for r in rows], "doc_id long, quality int, toxic int")
    model = tx.fit(docs.where(~tx.held_out()), labels)
    got = {r["doc_id"]: r for r in tx.score(docs, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    toxic = [got[r[0]] for r in held if r[4]]
    clean = [got[r[0]] for r in held if not r[4]]
    assert len(got) == 900 and all(0 <= g["score"] <= 1 and g["predicted"] == (g["score"] >= 0.7) for g in got.values())
    assert np.mean([g["predicted"] for g in toxic]) > 0.85 and np.mean([g["predicted"] for g in clean]) < 0.02


def test_labels_of_held_out_rows_change_nothing(spark):
    rows = corpus(2, 240)
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    flipped = [(r[0], 1 - r[4] if zlib.crc32(str(r[0]).encode()) % 3 == 1 else r[4]) for r in rows]
    scores = []
    for label in ([(r[0], r[4]) for r in rows], flipped):
        model = tx.fit(docs.where(~tx.held_out()), spark.createDataFrame(label, "doc_id long, toxic int"))
        scores.append(sorted((r["doc_id"], r["score"]) for r in tx.score(docs, model).collect()))
    assert scores[0] == scores[1]


def test_score_sees_the_text_alone():
    model = tx.learn([r[1] for r in corpus(3, 300) if r[4]], [r[1] for r in corpus(3, 300) if not r[4]], 0.25)
    score = tx.Scorer(model)
    long = syllables(random.Random(8), 60_000)
    assert score(long) < 0.7 < score(long[:2000] + " vermin garbage numbskull vermin garbage " + long[2000:4000])
    assert 0 <= score("") <= 1 and score("x") == score("X")


def plain_marks(toxic, ordinary, k):
    held = [{t[i:i + k] for i in range(len(t) - k + 1)} for t in toxic], [{t[i:i + k] for i in range(len(t) - k + 1)} for t in ordinary]
    out = set()
    for g in set().union(*held[0]):
        a, b = (sum(g in h for h in side) for side in held)
        p, q, mean = a / len(toxic), b / len(ordinary), (a + b) / (len(toxic) + len(ordinary))
        z = (p - q) / (mean * (1 - mean) * (1 / len(toxic) + 1 / len(ordinary)) + 1e-12) ** 0.5
        if z >= tx.MIN_Z and q <= tx.MAX_ORDINARY * p and a >= tx.MIN_TEXTS:
            out.add(g)
    return out


def test_marks_and_passages_by_brute_force():
    rows = corpus(4, 120)
    toxic, ordinary = ([tx.raw(r[1]) for r in rows if r[4] == x] + [b"", b"abc"] for x in (1, 0))
    found = tx.marks(toxic, ordinary)
    texts = {k: {int(v).to_bytes(k, "big") for v in found[k]} for k in tx.GRAMS}
    assert texts == {k: plain_marks(toxic, ordinary, k) for k in tx.GRAMS} and any(texts.values())
    for t in toxic:
        covered = [any(t[i:i + k] in texts[k] for k in tx.GRAMS for i in range(max(0, p - k + 1), p + 1)) for p in range(len(t))]
        want, run = [], b""
        for p, c in enumerate([*covered, False]):
            if c:
                run += t[p:p + 1]
            elif run:
                want.append(run)
                run = b""
        assert tx.passages(t, found) == want


def test_features_by_plain_compression():
    model = tx.learn([r[1] for r in corpus(5, 200) if r[4]], [r[1] for r in corpus(5, 200) if not r[4]], 0.25)

    def size(dictionary, window):
        data = zstandard.ZstdCompressionDict(dictionary)
        return len(zstandard.ZstdCompressor(tx.LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False).compress(window))

    text = "Some vermin here, " + syllables(random.Random(2), 60)
    data = text.lower().encode()
    cuts = [data[i:i + 48] for i in range(0, len(data) - 24, 24)]
    margins = sorted((size(model.ordinary, w) - size(model.ordinary + model.toxic, w) for w in cuts), reverse=True)
    got = tx.Scorer(model).features(text)
    assert got[:4].tolist() == margins[:4] and got[6] == np.log(len(cuts)) and abs(got[9] - np.mean(margins)) < 1e-9


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, 1), (2, 1)], [(0, 0), (1, None), (None, 1)], [(0, 1), (1, 0), (2, 1), (2, 0), (2, 0)]])
def test_few_labels(spark, labels):
    docs = spark.createDataFrame([(0, "a b"), (1, None), (2, ""), (2, "a b"), (None, "c")], "doc_id long, text string")
    got = tx.score(docs, tx.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_registered_query_on_odd_rows(spark, odd):
    from kardex.llm.queries import QUERIES

    folder, rows = odd
    got = QUERIES["op13_toxicity"](spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    found = got.collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 1) for r in found)
