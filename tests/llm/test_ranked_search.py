"""Ranked search against a full scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kardex.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, items, k):
    """All (item, rank, id, score) by scoring every document in full."""
    held = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall(lower(text)))
        scored = []
        for i, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in asked.items() if c[t])
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k, parts=3):
    d = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in docs], "doc_id long, text string, item string, id long, n long, score long").repartition(parts)
    q = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, rank int")
    return sorted(map(tuple, rs.search(d, q, k).collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ärger", "été", "İx", "7", "ñ"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda size: " ".join(rng.choices(words, weights, k=size))
    docs = [(i, text(rng.choice((1, 5, 30, 200)))) for i in range(n)]
    docs += [(i, docs[0][1]) for i in range(n, n + 40)]  # copies: equal scores
    return docs, text, rng


@pytest.mark.parametrize("seed,k", [(1, 20), (2, 1), (3, 5)])
def test_equals_full_scoring(spark, seed, k):
    docs, text, rng = corpus(seed, 300)
    docs += [(None, docs[3][1]), (None, None), (5, None), (6, ""), (7, " .,;\n"), (docs[9][0], docs[9][1]), docs[9], (8, "W1 w2-W3_w4 " * 5000)]
    items = [(i, text(rng.choice((1, 4, 12, 40)))) for i in range(25)] + [(25, None), (26, ""), (27, "unseen words"), (None, "w1 w50"), (3, text(5)), (28, docs[0][1])]
    assert found(spark, docs, items, k) == brute(docs, items, k)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")], 5) == [] == found(spark, [(1, "a")], [], 5) == found(spark, [(1, None)], [(1, "a")], 5)


def test_items_in_blocks_and_many_slices(spark, monkeypatch):
    """Small blocks and slices change the work, not the result."""
    docs, text, rng = corpus(4, 400)
    items = [(i, text(10)) for i in range(12)]
    monkeypatch.setattr(rs, "BLOCK_BYTES", 100)
    monkeypatch.setattr(rs, "SLICE_ROWS", 16)
    assert found(spark, docs, items, 10) == brute(docs, items, 10)


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("é", "x"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "x y")], "item_id string, text string")
    got = [(r["rank"], r["doc_id"]) for r in rs.search(docs, items, 4).orderBy("rank").collect()]
    assert got == [(1, "a"), (2, "b"), (3, None), (4, "é")]


def test_accumulators_stop():
    """Rare terms decide; the frequent term's list creates none beyond them."""
    plan = rs.Plan(Counter({0: 1, 1: 1}), {0: 3, 1: 1000}, {0: 900_000, 1: 900_000}, 1000)
    lists = {0: (np.array([5, 6, 7]), np.array([800_000, 700_000, 600_000])), 1: (np.arange(1000), np.full(1000, 500_000))}
    rows, scores = rs.serve(plan, lists, 1000, 3, 0)
    assert rows.tolist() == [5, 6, 7] and scores.tolist() == [plan.weights[0] * v + plan.weights[1] * 500_000 for v in (800_000, 700_000, 600_000)]
    assert len(rs.serve(plan, lists, 1000, 4, 0)[0]) == 1000  # the fourth place is open


def test_registered_query_and_sql(spark, tmp_path):
    import duckdb

    from kardex.llm.queries import ORACLE, QUERIES

    docs, text, _ = corpus(6, 200)
    spark.createDataFrame([*docs, (None, "w1"), (900, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, text(8)) for i in range(9)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op11_ranked_search"](spark, str(tmp_path))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    cur = con.execute(ORACLE["op11_ranked_search"])
    assert [c[0] for c in cur.description] == got.columns
    assert Counter(map(tuple, got.collect())) == Counter(cur.fetchall())
