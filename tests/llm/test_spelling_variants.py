"""Spelling variants against all pairs by brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from kardex.llm import spelling_variants as sv


def edits(w, letters):
    out = {w[:i] + w[i + 1:] for i in range(len(w))}
    out |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
    return (out | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}) - {w}


def brute(counts, ratio=10):
    letters = set("".join(counts))
    near = {w: [o for o in edits(w, letters) if o in counts] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def counted(texts, every=31):
    seen = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


@pytest.mark.parametrize("seed,letters,sizes,limit", [(1, "ab", range(7, 15), 1), (2, "abc", range(7, 10), 2), (3, "aé", range(12, 18), 1), (4, "abcdefgh", range(7, 12), 64)])
def test_all_pairs_one_edit_apart(spark, monkeypatch, seed, letters, sizes, limit):
    """Few letters and a small limit: long grams, long lists, many words that lose most grams."""
    monkeypatch.setattr(sv, "MIN_LIST", limit)
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.choice(sizes))) for _ in range(250)}
    for w in sorted(words)[:60]:
        words |= set(rng.sample(sorted(edits(w, letters)), 4))
    counts = {w: rng.choice((2, 3, 25, 40, 500, 7000)) for w in words if len(w) >= 7}
    got = sv.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(counts) and set(rows) == brute(counts)


def test_bound_leaves_a_shared_gram():
    """Over random dictionaries and every edit: unaffected grams are in both decompositions, among the rarest."""
    rng = random.Random(9)
    for _ in range(150):
        letters = rng.choice(("ab", "abc", "abcdef"))
        size = rng.randint(7, 14)
        word = "".join(rng.choices(letters, k=size))
        text = ["".join(rng.choices(letters, k=10)) for _ in range(30)] + [word]
        held = Counter(w[i:i + q] for w in text for q in range(2, 7) for i in range(len(w) - q + 1))
        limit = rng.choice((1, 3, 8))
        dictionary = {g: n for g, n in held.items() if len(g) == 2 or held[g[:-1]] > limit}
        dictionary |= {a + b: 1 for a in letters for b in letters if a + b not in dictionary}
        grams = sv.Grams(dictionary)
        for other in edits(word, letters):
            if len(other) < 7:
                continue
            base = min(len(word), len(other))
            keys = [{k for p, e in grams.rarest(w, base) for k in sv.keys_of(w, base, p, e)} for w in (word, other)]
            assert keys[0] & keys[1], (word, other)
            longest = min(sv.MAX_GRAM, base // 2)
            mine, its = (Counter(w[p:e] for p, e in zip(*grams.decompose(w, longest))) for w in (word, other))
            assert (mine & its).total() >= mine.total() - grams.affected(word, longest, *grams.decompose(word, longest)) >= 1


def test_words_of_documents(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdeÀéß×ÿ", k=rng.randint(5, 12))) for _ in range(80)]
    texts = [(i, " ".join(rng.choices(vocabulary, k=120)) + " Straßen-Ähnlich_İstanbulx 東京abcdefghĀijklmnop") for i in range(60)]
    texts += [(None, None), (1, ""), (None, "alphabet ALPHABET"), (7, "x" * 200), (7, "x" * 200), (9, " 12 \n")] + texts[:3]
    docs = spark.createDataFrame([(i, t, "w", 1, "k") for i, t in texts], "doc_id long, text string, word string, n long, key string").repartition(3)
    got = sv.words_of(docs)
    assert Counter(map(tuple, got.collect())) == Counter(counted(texts).items())
    assert set(map(tuple, sv.variants(got).collect())) == brute(counted(texts))


def test_chain_of_forms(spark):
    counts = {"aaaaaaaaa": 100_000, "aaaaaaaab": 9_000, "aaaaaaabb": 800, "aaaaaabbb": 70, "aaaaabbbb": 6, "aaaabbbbb": 2, "zzzzzzzzzz": 6, "zzzzzzzzzy": 60, "zzzzzzzzzx": 60}
    got = {r["word"]: r for r in sv.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got["aaaaabbbb"]["root"] == "aaaaaaaaa" and got["aaaaabbbb"]["form"] == "aaaaaabbb"
    assert got["aaaabbbbb"]["form"] is None and got["aaaabbbbb"]["root"] == "aaaabbbbb" and got["aaaabbbbb"]["n_near"] == 1
    assert got["zzzzzzzzzz"]["form"] == "zzzzzzzzzx"  # the smallest of equal counts


def test_no_words_and_short_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert sv.variants(empty).collect() == []
    with pytest.raises(ValueError):
        sv.near_pairs(empty, 3)
    assert len(sv.near_pairs(spark.createDataFrame([("abcd", 1), ("abce", 2), ("abc", 1)], "word string, n long"), 4).collect()) == 1


def test_dictionary_is_bounded(spark, monkeypatch):
    rng = random.Random(5)
    words = spark.createDataFrame([("".join(rng.choices("abcde", k=9)), 2) for _ in range(2000)], "word string, n long").distinct()
    full = sv.gram_dictionary(words)
    monkeypatch.setattr(sv, "MAX_GRAMS", 40)
    few = sv.gram_dictionary(words)
    assert len(few) <= 40 + 25 < len(full) and set(few) <= set(full)


def test_registered_query(spark, odd):
    from kardex.llm.queries import QUERIES

    folder, rows = odd
    got = QUERIES["op12_spelling_variants"](spark, folder)
    assert sorted(got.columns) == ["form", "form_n", "n", "n_near", "root", "word"]
    found = Counter(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect()))
    assert found == Counter(brute(counted([(r[0], r[1]) for r in rows])))
