"""The pipeline against brute force, its stages over odd rows and empty tables."""

from collections import Counter

import numpy as np
from test_queries import brute_secrets, brute_stats

import corpus_pipeline
from kardex.llm import quality
from kardex.llm.jaccard_join import Shingler


def read(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_stage_by_stage(spark, odd, library, tmp_path):
    folder, rows = odd
    docs = read(spark, folder)
    columns = docs.columns
    kept = {}
    for i, (name, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, folder).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == columns
        kept[name] = [r.asDict() for r in docs.collect()]

    stats = {t: brute_stats(t) for t in {r[1] for r in rows}}
    passes = Counter((r[0], r[1]) for r in rows if not (stats[r[1]][0] < 20 or 100 * stats[r[1]][4] > 30 * stats[r[1]][0]))
    first = Counter((r["doc_id"], r["text"]) for r in kept["quality rules"])
    assert not first - passes and all("#" in t for _, t in passes - first)  # clean rows stay

    cut = Shingler()
    sets = lambda names: [frozenset(cut(r["text"]).tolist()) for r in names]
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    stayed, all_before = sets(kept["near duplicates"]), sets(kept["quality rules"])
    assert not any(near(a, b) for i, a in enumerate(stayed) for b in stayed[i + 1:])
    assert all(any(near(a, b) for b in stayed) for a in all_before if len(a) > 10)  # each group has one that stayed

    texts = {r["text"] for r in kept["secret scans"]}
    assert len(kept["secret scans"]) == len(kept["near duplicates"]) and not any(brute_secrets(t) for t in texts)
    untouched = {r["text"] for r in kept["near duplicates"] if not brute_secrets(r["text"])}
    assert untouched <= texts
    masked = [r for r in kept["secret scans"] if "[SECRET]" in r["text"]]
    assert masked and all(r["n_chars"] == len(r["text"]) for r in masked)

    sizes, mixed = Counter(), Counter()
    for r in kept["secret scans"]:
        sizes[r["source"]] += len(r["text"].split())
    for r in kept["mixing"]:
        mixed[r["source"]] += len(r["text"].split())
    assert set((r["doc_id"], r["text"]) for r in kept["mixing"]) <= set((r["doc_id"], r["text"]) for r in kept["secret scans"])
    assert max(Counter((r["doc_id"], r["text"]) for r in kept["mixing"]).values()) <= 2
    assert all(mixed[s] <= 2 * sizes[s] for s in sizes)

    want = Counter((r["doc_id"], tuple(library.encode(r["text"], add_special_tokens=False).ids)) for r in kept["mixing"])
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in kept["bpe encoding"]) == want

    whole = Counter((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, folder).collect())
    assert whole == want


def test_each_stage_takes_odd_rows_and_empty_tables(spark, odd, nothing):
    folder, rows = odd
    for i, (name, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, read(spark, folder), folder)
        got = out.collect()
        if name == "near duplicates":
            assert len({(r["doc_id"], r["text"]) for r in got}) == len(got) < len(rows)
            assert sum(r["text"] is None or not r["text"].strip() for r in got) <= 1
        if name == "secret scans" or name == "bpe encoding":
            assert len(got) == len(rows)
        assert f(spark, read(spark, nothing), nothing).collect() == []
        if i < 4:
            assert out.columns == read(spark, folder).columns


def test_repeated_rows_mix_as_often_as_they_are(spark):
    rows = [(1, "one two three four", "a")] * 4 + [(2, "five six", "a"), (3, None, "b"), (4, "seven", None)]
    from kardex.llm.mixing import mixed_rows

    got = Counter(r["doc_id"] for r in mixed_rows(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    assert set(got) <= {1, 2, 3, 4} and 4 <= got[1] <= 8


def test_learned_rule_rejects_symbols(spark):
    """Labels teach a rule that the base rule does not have; clean rows stay."""
    rng = np.random.default_rng(3)
    words = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))
    rows = [(i, words(60) if i % 3 else " ".join(w + "###" for w in words(60).split())) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0) for i in range(0, 240, 2)], "doc_id long, quality int")
    kept, rules = quality.accepted(docs, labels)
    assert rules and {r["doc_id"] for r in kept.collect()} == {i for i in range(240) if i % 3}
