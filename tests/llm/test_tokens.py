"""Encoding and decoding against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from strata.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encode(encoder, texts):
    parts = [t.encode() for t in texts]
    ids, counts = encoder.encode(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if len(texts) else []


def test_hard_texts(encoder, library):
    texts = [
        "", " ", "   a  b ", "it's I'LL we'll 's 're'save ''s", "\n\n\t x y　z ", "a" * 3000, "ab" * 2000 + "!!" * 999,
        "<|endoftext|>", "a<|endoftext|><|endoftext|> b's", "日本語テキスト", "🙂🙂👍🏽", "1234567 12.5% ²½", "étude naïve", "\x00\x1c\x85",
    ]
    assert encode(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40), max_size=4))
def test_any_text(encoder, library, texts):
    assert encode(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aeinrst' ", max_size=60), min_size=1, max_size=4))
def test_likely_merges(encoder, library, texts):
    assert encode(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_merging_of_long_words(encoder, library):
    word = "".join(chr(97 + i * i % 26) for i in range(700))
    assert encoder.merge(word.encode()) == library.encode(word, add_special_tokens=False).ids


def test_round_trip(odd, odd_rows, library):
    found = bpe.round_trip(odd, PATH).collect()
    assert len(found) == len(odd_rows)
    texts = [t or "" for _, t, _ in odd_rows]
    want = sorted(
        (i or -1, len(e.ids), hashlib.sha256(",".join(map(str, e.ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        for (i, _, _), t, e in zip(odd_rows, texts, library.encode_batch(texts, add_special_tokens=False)))
    assert sorted((r[0] or -1, *r[1:]) for r in found) == want


def test_encode_then_decode(odd, odd_rows):
    back = bpe.decode(bpe.encode(odd, PATH), PATH).collect()
    assert sorted(r["text"] for r in back) == sorted(t or "" for _, t, _ in odd_rows)


def test_no_rows(none):
    assert bpe.round_trip(none, PATH).collect() == []
