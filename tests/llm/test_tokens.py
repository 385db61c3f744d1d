"""Ids of whole texts against the tokenizer itself."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from perilspark.llm import packing

NAME = "word_bpe_49k.json"
REFERENCE = Tokenizer.from_file(public_tokenizers.path(NAME))
TEXTS = [
    "", " \t\n", "a<|endoftext|>b x <|endoftext|>", "<|ENDOFTEXT|> <|startoftext|> <|", "İstanbul Σς ΑΣ. K Å ẞtraße é éx", "it's don't, O'Neil's 'tis x's!! we'll,",
    "ª º µ × ÷x a÷b 12ab,, x9 ab-cd a.b.c $$$ &&&abc abc'&& abc&&&", "日本語、です กขค a​b a b a\u0085b ﻿abc ab̀! ſt ǅ Ａ", "wordnever" * 500,
]


def ids(tokens, text):
    return np.frombuffer(tokens([text.encode()])[0], tokens.kind).tolist()


def expected(text):
    return [*REFERENCE.encode(text, add_special_tokens=False).ids, packing.END_ID]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_tokenizers(text):
    tokens = packing.Tokens(NAME)
    assert tokens.apart and ids(tokens, text) == expected(text)
    tokens.apart = False
    tokens.known = {}
    assert ids(tokens, text) == expected(text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abzéßÉ'.,&<|>1 ñ́Σ- "), max_size=30))
def test_ids_of_any_text(text):
    assert ids(packing.tokens_of(NAME), text) == expected(text)


def test_words_that_were_let_go_keep_their_ids(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 4)
    tokens = packing.Tokens(NAME)
    for text in ("one two three, four.", "five two! three, six", "one two three, seven", "four. one five"):
        assert ids(tokens, text) == expected(text)
    assert len(tokens.known) + len(tokens.earlier) < 12
