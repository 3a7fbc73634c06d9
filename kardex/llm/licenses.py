"""Licence scan with a positional rare-token index over licence passages.

A template is a notice or identifier that must stand word for word, or a passage of a licence's text that may have
been edited. The index maps words to postings (template, position). IDF comes from document
frequencies over the whole corpus, so a rare word is one that is rare there, whatever the corpus.

Exact templates are indexed under their rarest word alone: each place of it in a file is a place where the
template may stand, and is compared word by word.

Passages are looked up by the file: of all licence words in it the ``FILE_WORDS`` with the highest IDF are taken, and each
place of one votes for (passage, place - position), the relative position of the passage. A candidate is a relative position at
which ``AGREE`` different words agree within ``SLACK`` words. It counts if every mandatory key phrase
stands there, word by word. A passage whose key phrases have a word that the file lacks is left out before.

Defined results: text is lower-cased in A-Z only; words are runs of ASCII digits and letters and of
all code points beyond ASCII. Null text is empty: no words, no places, empty labels, score 0.
``score`` is the share of a template's IDF found at the template's relative positions, of the best
accepted template. Ties of IDF go to the word that sorts first. Repeated rows are scanned alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.llm.common import slices, text_or_empty, with_fields

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
SLACK = 2
FILE_WORDS, AGREE = 32, 3

# The phrases whose places every result must carry, with their labels.
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

# Notices that must stand word for word, with their labels.
NOTICES = [
    ("mit", "mit license"), ("apache-2", "apache license 2 0"), ("gpl-2", "gnu general public license version 2"), ("gpl-3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"), ("agpl-3", "gnu affero general public license"), ("mpl-2", "mozilla public license version 2 0"),
    ("epl-2", "eclipse public license 2 0"), ("cc-by", "creative commons attribution 4 0 international"), ("cc-by", "cc by 4 0"), ("cc-by-sa", "cc by sa"),
    ("cc-by-nd", "cc by nd"), ("cc0", "cc0 1 0"), ("all-rights-reserved", "all rights reserved"),
]

# SPDX identifiers by label; a file names one behind "SPDX-License-Identifier:".
SPDX = {
    "mit": "MIT MIT-0", "apache-2": "Apache-2.0", "gpl-2": "GPL-2.0-only GPL-2.0-or-later GPL-2.0", "gpl-3": "GPL-3.0-only GPL-3.0-or-later GPL-3.0",
    "lgpl": "LGPL-2.1-only LGPL-2.1-or-later LGPL-2.1 LGPL-3.0-only LGPL-3.0-or-later LGPL-3.0", "agpl-3": "AGPL-3.0-only AGPL-3.0-or-later AGPL-3.0",
    "bsd": "BSD-2-Clause 0BSD", "bsd-3": "BSD-3-Clause", "isc": "ISC", "mpl-2": "MPL-2.0", "epl-2": "EPL-2.0", "unlicense": "Unlicense", "zlib": "Zlib",
    "bsl-1": "BSL-1.0", "cc0": "CC0-1.0", "cc-by": "CC-BY-4.0", "cc-by-sa": "CC-BY-SA-4.0", "cc-by-nc": "CC-BY-NC-4.0", "cc-by-nd": "CC-BY-ND-4.0",
}

# Label, a passage of the licence's text, the key phrases that must stand in it.
PASSAGES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ["permission is hereby granted free of charge"]),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ["this permission notice shall be included"]),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ["except in compliance with the license", "apache org licenses license 2 0"]),
    ("apache-2", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license", ["each contributor hereby grants to you", "royalty free irrevocable"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["gnu general public license", "free software foundation"]),
    ("gpl-2", "you may copy and distribute verbatim copies of the program s source code as you receive it in any medium provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice", ["copy and distribute verbatim copies of the program"]),
    ("gpl-3", "you may convey verbatim copies of the program s source code as you receive it in any medium provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice", ["convey verbatim copies of the program"]),
    ("agpl-3", "if you modify the program your modified version must prominently offer all users interacting with it remotely through a computer network an opportunity to receive the corresponding source", ["interacting with it remotely through a computer network"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", ["binary form must reproduce the above copyright notice"]),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", ["nor the names of its contributors"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify"]),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software released into the public domain"]),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", ["origin of this software must not be misrepresented"]),
    ("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", ["to any person or organization obtaining a copy"]),
]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[bytes, ...], ...]
    base: bool


def templates() -> list[Template]:
    cut = lambda s: tuple(words_of(s))
    exact = [(label, text, True) for label, text in BASE] + [(label, text, False) for label, text in NOTICES]
    exact += [(label, f"SPDX-License-Identifier: {name}", False) for label, names in SPDX.items() for name in names.split()]
    return ([Template(label, cut(text), (cut(text),), base) for label, text, base in exact]
            + [Template(label, cut(text), tuple(map(cut, keys)), False) for label, text, keys in PASSAGES])


def words_of(text: str) -> list[bytes]:
    """Bytes are lower-cased in A-Z only, and every byte beyond ASCII belongs to a word."""
    return WORDS.findall(text.encode().lower())


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of those with each template word: two small results over all rows."""
    vocabulary = {w for t in templates() for w in t.words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in slices(batches, "_text"):
            for t in b.column("_text").to_pylist():
                seen.update(vocabulary.intersection(words_of(t)))
                seen[b""] += 1
        yield pa.RecordBatch.from_pydict({"w": pa.array([w.decode() for w in seen], pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    got = docs.select(text_or_empty(text).alias("_text")).mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    counts = {r["w"].encode(): r["n"] for r in got}  # a row per template word at most
    return counts.pop(b"", 0), counts


class Index:
    """Postings of the templates' words."""

    def __init__(self, n_docs: int, df: dict[bytes, int]):
        self.templates = templates()
        self.idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) + 1e-9 for t in self.templates for w in t.words}
        rank = lambda w: (-self.idf[w], w)
        self.exact: dict[bytes, list[tuple[int, int]]] = defaultdict(list)  # rarest word -> (template, position)
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.keys: dict[int, frozenset] = {}  # words of a passage's key phrases
        for i, t in enumerate(self.templates):
            if (t.words,) == t.keys:
                rarest = min(t.words, key=rank)
                self.exact[rarest].append((i, t.words.index(rarest)))
                continue
            self.keys[i] = frozenset(w for k in t.keys for w in k)
            for q, w in enumerate(t.words):
                self.postings[w].append((i, q))
        self.place = {w: n for n, w in enumerate(sorted(self.idf, key=rank))}
        self.words = frozenset(self.exact) | frozenset(self.postings)

    def places(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """Accepted (template, start, coverage) of a file."""
        found = self.words.intersection(words)
        seeds = found.intersection(self.exact)
        alive = {i for i, key in self.keys.items() if key <= found}
        chosen: frozenset = frozenset()
        if alive:
            ranked = sorted(found.intersection(self.postings), key=self.place.__getitem__)
            chosen = frozenset(w for w in ranked[:FILE_WORDS] if any(i in alive for i, _ in self.postings[w]))
        if not seeds and not chosen:
            return []
        out = []
        votes: dict[int, dict[int, set]] = defaultdict(lambda: defaultdict(set))
        wanted = chosen | seeds
        for p, w in enumerate(words):
            if w in wanted:
                for i, q in self.exact.get(w, ()):
                    t = self.templates[i].words
                    if p >= q and tuple(words[p - q:p - q + len(t)]) == t:
                        out.append((i, p - q, 1.0))
                if w in chosen:
                    for i, q in self.postings[w]:
                        if i in alive:
                            votes[i][p - q].add(w)
        for i, by_place in votes.items():
            t, end = self.templates[i], None
            for o in sorted(by_place):
                if end is not None and o <= end:
                    continue
                near = set().union(*(by_place.get(x, ()) for x in range(o, o + SLACK + 1)))
                lo, hi = max(0, o - SLACK), max(0, o + len(t.words) + 2 * SLACK)
                if len(near) >= AGREE and all(holds(words, lo, hi, k) for k in t.keys):
                    total = sum(self.idf[w] for w in t.words)
                    hit = sum(self.idf[w] for q, w in enumerate(t.words) if w in words[max(0, o + q - SLACK):max(0, o + q + 2 * SLACK + 1)])
                    out.append((i, max(0, o), hit / total))
                    end = o + SLACK
        return out


def holds(words: list[bytes], lo: int, hi: int, phrase: tuple[bytes, ...]) -> bool:
    return any(tuple(words[p:p + len(phrase)]) == phrase for p in range(lo, min(hi, len(words)) - len(phrase) + 1))


SCAN = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, places array<struct<label:string,start:long,base:boolean>>"


def scan(docs: DataFrame, n_docs: int, df: dict[bytes, int], keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and what the index finds in every whole text (``SCAN``)."""
    schema = with_fields(docs, keep, SCAN)
    place_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("base", pa.bool_())]))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), place_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(n_docs, df)

        def one(text: str) -> tuple:
            words = words_of(text)
            got = [(index.templates[i], o, c) for i, o, c in index.places(words)]
            base = [o for t, o, _ in got if t.base]
            join = lambda x: ",".join(sorted(set(x)))
            return (len(words), len(base), min(base, default=None), max(base, default=None), join(t.label for t, _, _ in got if t.base),
                    join(t.label for t, _, _ in got), max((min(1.0, c) for _, _, c in got), default=0.0),
                    [{"label": t.label, "start": o, "base": t.base} for t, o, _ in sorted(got, key=lambda x: (x[1], x[0].label))])

        for b in slices(batches, "_text"):
            cols = zip(*map(one, b.column("_text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), *(pa.array(c, t) for c, t in zip(cols, types))], [f.name for f in schema.fields])

    return docs.select(*keep, text_or_empty(text).alias("_text")).mapInArrow(run, schema)
