"""Token ids of whole texts, by the tokenizers library.

White space ends a pre-token of the word-BPE vocabulary and is dropped, so a text's ids are its
words' ids one after the other. The encoder keeps the ids of pre-tokens it has met (a bounded memo
in each Python worker) and hands only new ones to the library. Other vocabularies are encoded text
by text.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
from tokenizers import Tokenizer, normalizers, pre_tokenizers

#: Id appended to every document.
END_ID = 2
#: Pre-tokens, and words with rarer characters, remembered per Python worker (about 200 bytes each).
PARTS_KEPT, WORDS_KEPT = 900_000, 200_000
#: A longer text is encoded in pieces cut at white space.
PIECE = 1 << 20
# The vocabulary's own pre-token pattern, and the same one over plain characters: ASCII and the
# letters of Latin-1, whose case, composition and class are the same by any Unicode version.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PARTS = re.compile("[a-zß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\0\t-\r a-zß-öø-ÿ0-9]+|\0")
_PLAIN = bytes([*range(9, 14), *range(32, 127), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
_BLANK = re.compile(rb"[ \t-\r]")
#: Stands between texts; no id has these bytes.
_GAP = b"\xff\xff\xff\xff"


class Encoder:
    """``payloads(texts)``: the ids of each text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.full = Tokenizer.from_file(path)
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {"\0": _GAP}
        form = json.loads(self.full.to_str())
        self.by_word = self._is_word_bpe(form)
        if self.by_word:
            self.inner = Tokenizer.from_file(path)
            self.inner.normalizer = normalizers.Sequence([])
            self.inner.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocab = self.full.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
            self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
            self.special = [t["content"] for t in form["added_tokens"]]

    @staticmethod
    def _is_word_bpe(form: dict) -> bool:
        try:
            norm = [n["type"] for n in form["normalizer"]["normalizers"]]
            split = form["pre_tokenizer"]["pretokenizers"][0]
            return (norm == ["NFC", "Replace", "Lowercase"] and split["pattern"] == {"Regex": _SPLIT} and split["invert"]
                    and form["model"]["end_of_word_suffix"] == "</w>" and not form["post_processor"]
                    and all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in form["added_tokens"]))
        except (KeyError, TypeError, IndexError):
            return False

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.full.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_parts(self, new: list[str]) -> None:
        """Ids of lower-cased pre-tokens; the suffix of a word's last id marks where each ends."""
        for a in range(0, len(new), 4096):
            some = new[a : a + 4096]
            ids = np.array(self.inner.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some) and len(ids) == cuts[-1]:
                raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
                self.parts.update((w, raw[i:j]) for w, i, j in zip(some, at, at[1:]))
            else:
                self.parts.update(zip(some, self._library(some)))

    def _plain(self, text: bytes) -> str | None:
        """The text in lower case, or None if it has other characters or a special token."""
        t = text.decode("utf-8", "replace")
        try:
            if t.encode("latin-1").translate(None, _PLAIN):
                return None
        except UnicodeEncodeError:
            return None
        return None if any(s in t for s in self.special) else t.lower()

    def _by_parts(self, texts: list[str]) -> list[bytes]:
        """Plain lower-case texts: one pass over the pre-tokens of all."""
        found = _PARTS.findall("\0".join(texts))
        new = set(found).difference(self.parts)
        if new:
            self._learn_parts(sorted(new))
        return b"".join(map(self.parts.__getitem__, found)).split(_GAP)

    def _by_words(self, text: bytes) -> bytes:
        """Any other text: word by word, those not met before by the library as they are."""
        split = text.split()
        new = sorted(set(split).difference(self.words))
        if new:
            self.words.update(zip(new, self._library([w.decode("utf-8", "replace") for w in new])))
        return b"".join(map(self.words.__getitem__, split))

    def payloads(self, texts: list[bytes | None]) -> list[bytes]:
        """Null counts as empty; empty text has no ids."""
        if not self.by_word:
            return self._library([(t or b"").decode("utf-8", "replace") for t in texts])
        self._forget()
        out, plain = [b""] * len(texts), {}
        for i, t in enumerate(texts):
            if t and len(t) > PIECE:
                out[i] = b"".join(self._long(t))
            elif t:
                p = self._plain(t)
                if p is None:
                    out[i] = self._by_words(t)
                else:
                    plain[i] = p
        if plain:
            for i, p in zip(plain, self._by_parts(list(plain.values()))):
                out[i] = p
        return out

    def _forget(self) -> None:
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        if len(self.parts) > PARTS_KEPT:
            self.parts = {"\0": _GAP}

    def release(self) -> None:
        """Forget everything learned, at the end of a task whose worker has other work to do next."""
        self.words.clear()
        self.parts = {"\0": _GAP}

    def _long(self, text: bytes) -> Iterator[bytes]:
        a = 0
        while a < len(text):
            m = _BLANK.search(text, min(len(text), a + PIECE))
            b = m.start() if m else len(text)
            p = self._plain(text[a:b])
            yield self._by_words(text[a:b]) if p is None else self._by_parts([p])[0]
            self._forget()
            a = b


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary, kept between tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
    return Encoder(path)
