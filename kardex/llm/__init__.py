"""Operations of a training-data pipeline: language identification, source mixing, fingerprints,
licence and secret scans, quality rules, BPE, near-duplicate join, WARC and token-id files.

Nothing outside this subpackage imports it.
"""
