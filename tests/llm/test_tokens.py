"""The encoder gives the library's ids for every text."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from actiontally.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
FULL, ENC = Tokenizer.from_file(PATH), tokens.Encoder(PATH)

HARD = [
    "", " ", "\n\t \x0b\x0c\r", "It's we'LL they've I'M don't 'tis ''s", "Straße ÀÉÎÕÜ ÿ Ÿ ǅ ß ẞ", "naïve café café é́",
    "İstanbul ΣΑΣ ς ſ ŉ", "a\x00b\x01c\x1cd\x85e\xa0f g​h", "<|endoftext|>x <|startoftext|> <|endoftext |>", "漢字かな 한국어 русский العربية हिन्दी",
    "x²³½ ٣٤ Ⅷ 123 4a5", "😀👍🏽 — … “q” ‘s’", "a" * 5000, "!?" * 300 + "word", "ª º µ × ÷ ¼ ¬", " ￿ \U0010ffff", "can't\n\nwon't\r\nI'd",
]


def ids(payload: bytes) -> list[int]:
    return np.frombuffer(payload, dtype="<u4").tolist()


def want(text: str) -> list[int]:
    return FULL.encode(text, add_special_tokens=False).ids


def test_hard_texts_one_by_one_and_together():
    assert ENC.by_word
    raws = [t.encode() for t in HARD]
    assert [ids(p) for p in ENC.payloads(raws)] == [want(t) for t in HARD]
    assert [ids(ENC.payloads([r])[0]) for r in raws] == [want(t) for t in HARD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text(alphabet="aZé'sÉtß 1\n<|.é"), st.sampled_from(HARD)), max_size=6))
def test_any_texts(texts):
    assert [ids(p) for p in ENC.payloads([t.encode() for t in texts])] == [want(t) for t in texts]


def test_null_is_empty():
    assert ENC.payloads([None, b""]) == [b"", b""]


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 50)
    text = "Some words, don't cut them; naïve ones 漢字 too.\n" * 20 + "z" * 300
    assert ids(ENC.payloads([text.encode()])[0]) == want(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "PARTS_KEPT", 3)
    monkeypatch.setattr(tokens, "WORDS_KEPT", 1)
    own = tokens.Encoder(PATH)
    for t in HARD * 2:
        assert ids(own.payloads([t.encode()])[0]) == want(t)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_vocabularies_go_text_by_text(name):
    path = public_tokenizers.path(name)
    own, full = tokens.Encoder(path), Tokenizer.from_file(path)
    assert not own.by_word
    assert [ids(p) for p in own.payloads([t.encode() for t in HARD])] == [full.encode(t, add_special_tokens=False).ids for t in HARD]
