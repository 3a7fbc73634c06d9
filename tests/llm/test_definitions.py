"""Learned models against their definitions, computed another way."""

import math
import random
import re
from collections import Counter

import numpy as np
from test_queries import brute_stats

from kardex.llm import langid, quality
from llm_helpers import syllables


def test_language_counts_and_logs(spark):
    """Every n-gram's count per language and its log probability, from the texts."""
    rng = random.Random(4)
    rows = [(syllables(rng, rng.randint(3, 30)).capitalize() + "!", "aa") for _ in range(30)]
    rows += [(syllables(rng, rng.randint(3, 30), "ß"), "bb") for _ in range(20)] + [("да нет это Мир 42", "cc"), (None, "aa"), ("x", None)]
    rows += rows[:5] * 3  # copies count once
    prior = 200.0
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3), prior=prior)
    counts = {x: Counter() for x in ("aa", "bb", "cc")}
    for text, lang in {r for r in rows if None not in r}:
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            for n in (2, 3):
                counts[lang].update(f" {w} "[i:i + n] for i in range(len(w) + 3 - n))
    assert model["langs"] == sorted(counts)
    every = sorted({g for c in counts.values() for g in c}, key=langid.code_of)
    assert model["grams"].tolist() == [langid.code_of(g) for g in every]
    total = {n: {x: sum(v for g, v in counts[x].items() if len(g) == n) for x in counts} for n in (2, 3)}
    for i, g in enumerate(every):
        n = len(g)
        share = sum(counts[x][g] for x in counts) / sum(total[n].values())
        for at in range(model["starts"][i], model["starts"][i + 1]):
            x = model["langs"][model["at"][at]]
            # log of the smoothed probability, less that of a language that lacks the n-gram
            assert math.isclose(model["logs"][at], math.log((counts[x][g] + prior * share) / (prior * share)), rel_tol=1e-5)
        assert sorted(model["langs"][a] for a in model["at"][model["starts"][i]:model["starts"][i + 1]]) == [x for x in sorted(counts) if counts[x][g]]
    for n in (2, 3):
        assert np.allclose(model["known"][n], [-math.log(total[n][x] + prior) for x in model["langs"]])


def test_kept_by_the_rules_in_order(spark):
    """The verdict column against the rules applied one by one to statistics counted another way."""
    rng = random.Random(8)
    texts = []
    for i in range(360):
        words = syllables(rng, rng.randint(5, 90)).split()
        if i % 3 == 0:
            words = [w + rng.choice(["###", "$$$", ""]) for w in words]
        if i % 7 == 0:
            words = words[:8] * rng.randint(1, 9)
        texts.append(" ".join(words) + ("\nsame line\nsame line" if i % 5 == 0 else ""))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1) for i in range(0, 360, 2)], "doc_id long, quality int")
    measured = quality.statistics(docs).cache()
    rules = quality.fit(measured, labels)
    got = {r["doc_id"]: r["v"] for r in quality.features(measured).select("doc_id", quality.verdict(rules).alias("v")).collect()}
    others = {r["doc_id"]: r.asDict() for r in measured.collect()}
    assert rules
    for i, t in enumerate(texts):
        stats = dict(others[i])
        stats.update(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), brute_stats(t)))
        value = dict(stats)
        for name, expression in quality.FEATURES.items():
            over, under = (stats[x] for x in expression.split(" / "))
            value[name] = over / under if under else 0.0
        want = 0 if stats["n_words"] < 20 or 100 * stats["n_repeat_words"] > 30 * stats["n_words"] else None
        for k, rule in enumerate(rules, 1):
            if want is None and all((value[n] <= t) if op == "<=" else (value[n] > t) for n, op, t in rule.conditions):
                want = k
        assert got[i] == want
