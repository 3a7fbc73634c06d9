"""Registered queries of the ten operators (``QUERIES``) and their DuckDB SQL (``ORACLE``).

Each query applies its operator to the whole table with production parameters and derives the
contract's columns from what the operator returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Where the public vocabulary file is on this machine and, installed alike, on executors."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import langid

    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs, model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "spans")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import mixing

    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "positions")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import fingerprints

    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import licenses

    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, *licenses.document_frequencies(docs))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import quality
    from kardex.llm.common import stage

    measured = stage(quality.statistics(table(spark, sf_dir, "documents")), "quality")
    rules = quality.fit(measured, table(spark, sf_dir, "labels"))
    judged = quality.features(measured).withColumn("rule", quality.verdict(rules))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         quality.base_failed().alias("base_failed"), F.col("rule").isNull().alias("kept"), "rule")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import secret_scan as scan

    found = scan.report(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(scan.listed(base), 256).alias("base_sha256"), scan.listed(F.col("found")).alias("spans"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import bpe

    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import jaccard_join

    return jaccard_join.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_id", "n_links")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import warc

    records = warc.capture(table(spark, sf_dir, "pages"))
    found = warc.read(warc.normalise(warc.decide(records)))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op10_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import wavelet

    return wavelet.documents_of(wavelet.write_shards(table(spark, sf_dir, "documents"), vocabulary()))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import ranked_search

    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import spelling_variants as sv
    from kardex.llm.common import stage

    return sv.variants(stage(sv.words_of(table(spark, sf_dir, "documents")), "words"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kardex.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    held = toxicity.held_out()
    model = toxicity.fit(docs.where(~held), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_mixing": op2_mixing,
    "op3_fingerprints": op3_fingerprints,
    "op4_licenses": op4_licenses,
    "op5_quality_rules": op5_quality_rules,
    "op6_secrets": op6_secrets,
    "op7_bpe": op7_bpe,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_warc": op9_warc,
    "op10_wavelet_shards": op10_wavelet_shards,
    "op11_ranked_search": op11_ranked_search,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_toxicity": op13_toxicity,
}

def oracle() -> dict[str, str]:
    from kardex.llm import ranked_search

    return {"op11_ranked_search": ranked_search.ORACLE_SQL}


ORACLE: dict[str, str] = oracle()
