"""Speculative BPE against the tokenizers library."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from velotide.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.Encoder(PATH)

TEXTS = [
    "",
    "<|endoftext|>",
    "a<|endoftext|>b <|endoftext|><|endoftext|>",
    "  \n\n x  \t",
    "I'll we've don't DON'T 's",
    "é" * 50 + "日本語 😀😀\x00\x7f​",
    "aaaaaaaaaaaaaaaaaaaaa",
    "a" * 5000 + " " + "-" * 5000,
    "unhappinesses antidisestablishmentarianism 1234567890",
]


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_equals_the_library(text):
    assert OWN.encode([text])[0].tolist() == expected(text)
    assert OWN.decode(expected(text)) == LIBRARY.decode(expected(text), skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abehinorstTE 01éß_-\n\t.'\"日😀", max_size=80))
def test_random_texts(text):
    assert OWN.encode([text])[0].tolist() == expected(text)


def test_pairs_are_judged_as_merging_does():
    m = OWN.merges
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 50256, (2, 4000))
    exact = [m.exact(m.bytes[i] + m.bytes[j]) == [i, j] for i, j in zip(a, b, strict=True)]
    assert m.compatible(a, b).tolist() == exact
    assert m.sound[:50256].all()


def test_words_merged_together_equal_words_merged_alone():
    m = OWN.merges
    words = [b"thonererin", b" aaab", b"x", "süßé".encode(), b"    ", b"ing" * 15]
    assert m.exact_many(words) == [m.exact(w) for w in words]


def test_failing_words_are_repaired():
    own = bpe.Encoder(PATH)
    own.encode(["thonererin erheou ndthha"])
    assert own.repaired > 0


def test_cache_may_be_dropped(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = bpe.Encoder(PATH)
    for _ in range(3):
        assert own.encode([TEXTS[4]])[0].tolist() == expected(TEXTS[4])


def test_rows(spark, odd_docs):
    rows = bpe.decode(bpe.encode(odd_docs, PATH), PATH).select("doc.text", "ids", "decoded").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert list(r["ids"]) == expected(r["text"] or "")
        assert r["decoded"] == (r["text"] or "")
    both = bpe.round_trip(odd_docs, PATH).select("ids", "decoded")
    assert sorted(map(repr, both.collect())) == sorted(repr(r) for r in bpe.decode(bpe.encode(odd_docs, PATH), PATH).select("ids", "decoded").collect())
