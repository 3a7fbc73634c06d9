"""The shard encoder and the codec against the tokenizers library on adversarial strings."""

import random

import pytest

from kardex.llm import wavelet
from kardex.llm.bpe import Codec

ATOMS = (list("abzABZ019.,;:!?-_'\"<>|#") + [" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", " ", " ", " ", " ", " ", "​",
         " ", " ", " ", "　", "﻿", "İ", "ı", "ß", "ẞ", "Σ", "σ", "ς", "é", "é", "É", "H̱", "́", "̇", "ﬁ", "Å", "Å", "日", "本", "٣", "Ⅷ", "½",
         "🎉", "👩‍💻", "Ǆ", "ŉ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "don't", "word", "WORD", "the ", "Ᲊ", "Ɤ", "\U00010d50", "՘", "\x00", "\x7f"])


def strings(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(ATOMS, k=rng.randint(1, 9))) for _ in range(n)]


@pytest.mark.parametrize("kind", ["shards", "codec"])
def test_fuzzed_strings(vocab, library, kind):
    own = wavelet.Encoder(vocab) if kind == "shards" else Codec(vocab)
    for seed in range(10):
        texts = strings(seed, 10_000 if kind == "shards" else 1_000)
        want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
        wrong = [(t, g.tolist(), w) for t, g, w in zip(texts, own.encode(texts), want) if g.tolist() != w]
        assert not wrong, wrong[:3]


def test_every_code_point(vocab, library):
    """Each code point between letters, after one, and before punctuation."""
    own = wavelet.Encoder(vocab)
    for lo in range(0, 0x110000, 1 << 16):
        texts = [f"a{chr(c)}b Σ{chr(c)}. x{chr(c)}" for c in range(lo, lo + (1 << 16)) if not 0xD800 <= c < 0xE000]
        want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
        wrong = [t for t, g, w in zip(texts, own.encode(texts), want) if g.tolist() != w]
        assert not wrong, list(map(ascii, wrong[:5]))


def test_cases_that_once_differed(vocab, library):
    own = wavelet.Encoder(vocab)
    for t in ("x\x1cy-z", "a b\x1ec-d", "<|startoftext|>Σİ. ", "İ.", "ΣİX?!", "-\x1f-"):
        assert own.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids, ascii(t)


def test_shrunk_cache(vocab, library, monkeypatch):
    """A cache that is cut again and again gives the same ids."""
    from kardex.llm import bpe

    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 50)
    own = wavelet.Encoder(vocab)
    for seed in range(20, 40):
        texts = strings(seed, 60)
        assert [g.tolist() for g in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
