"""Whole-text encoding with a public tokenizer, one lookup per distinct word.

Both supported tokenizer families cut a text at white space before they merge
anything, so the ids of a text are the ids of its words in order. A batch of
texts is split into words and each distinct word looked up once in Arrow; the
tokenizers library is called only for words not met before.

Cuts are made only where the tokenizer surely cuts too:

* ``drop_space`` tokenizers (white space removed, words end-marked): at every
  space and line break;
* byte-level tokenizers, which carry the space in front of a word: in front
  of each space and on both sides of each line break. A text in which two
  white-space characters meet, or with other white space, goes to the library
  as it is;
* in front of a last '.' or ',' of a word if a letter stands before it: it is
  then a token of its own.
"""
from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one task on each core already

_SPACE = re.compile(r"[\s\x1c-\x1f\x85​﻿]")
_LONE_STOP = re.compile(r"[A-Za-zÀ-ÖØ-öø-įı-ɏ][.,]\Z")
_LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-įı-ɏ]+\Z")
_MAX_WORDS = 200_000    # in each of two generations; words in use move to the younger one
_ENCODERS: dict[tuple[str, bool, bool], "WordEncoder"] = {}


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable
    Latin-1 characters for themselves, the rest counted on from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


class WordEncoder:
    def __init__(self, path: str, drop_space: bool, plain_specials: bool):
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain_specials
        self.merges = self.tok.model
        self.drop_space = drop_space
        self.letters = _byte_letters()
        self.space = self.letters[0x20]
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _library(self, words: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(words), 500):
            for e in self.tok.encode_batch_fast(words[at:at + 500], add_special_tokens=False):
                out.append(array("I", e.ids).tobytes())
        return out

    def _word(self, word: str) -> bytes:
        """Ids of a word of Latin letters: one pre-token, so the library's merges alone."""
        marked = word.replace(" ", self.space) if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.merges.tokenize(marked)]).tobytes()

    def _ids(self, word: str) -> bytes:
        """Ids of ``word`` (with its space in front, if it carries one)."""
        if (ids := self.known.get(word)) is not None:
            return ids
        if (ids := self.older.get(word)) is None:
            if word[-1] in ".," and _LONE_STOP.search(word[-2:]):
                return self._ids(word[:-1]) + self._ids(word[-1])      # made again from the word's ids
            if not _LETTERS.match(word):
                ids = self._library([word])[0]
            elif self.drop_space:
                low = word.lower()
                ids = self._word(low) if low == word else self._ids(low)
            else:
                ids = self._word(word)
        self.known[word] = ids
        return ids

    def encode(self, texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and, for each text, where its ids begin, with the end last.

        Null is the empty text.
        """
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts, "")
        n = len(texts)
        if len(self.known) > _MAX_WORDS:
            self.older, self.known = self.known, {"": b""}
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " " if self.drop_space else " \n "), " ")
        starts = lists.offsets.to_numpy().astype(np.int64)
        starts = starts - starts[0]
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        at = coded.indices.to_numpy().astype(np.int64)
        whole = np.zeros(n, bool)
        if self.drop_space:
            keys = at
            forms = words
        else:
            odd = np.fromiter((not w or (w != "\n" and _SPACE.search(w) is not None) for w in words), bool, len(words))
            if odd.any():
                hits = np.concatenate([[0], np.cumsum(odd[at])])
                whole = hits[starts[1:]] > hits[starts[:-1]]
            spaced = np.ones(len(at), bool)      # whether a space stands in front of the word
            spaced[starts[:-1][starts[:-1] < len(at)]] = False
            if "\n" in words:
                breaks = np.flatnonzero(at == words.index("\n"))
                spaced[breaks] = False
                follow = breaks[breaks + 1 < len(at)] + 1
                spaced[follow] = False
            both = at * 2 + spaced
            used = np.flatnonzero(np.bincount(both, minlength=2))
            place = np.zeros(2 * len(words) + 2, np.int64)
            place[used] = np.arange(len(used))
            keys = place[both]
            forms = [" " + words[k >> 1] if k & 1 else words[k >> 1] for k in used.tolist()]
        get, ids = self.known.get, self._ids
        table = pa.array([x if (x := get(w)) is not None else ids(w) for w in forms], pa.binary())
        joined = table.take(pa.array(keys))
        ends = np.frombuffer(joined.buffers()[1], np.int32, len(keys) + 1, joined.offset * 4) if len(keys) else np.zeros(1, np.int32)
        data = joined.buffers()[2]
        flat = np.frombuffer(data, np.uint32, int(ends[-1]) // 4) if data is not None and ends[-1] else np.zeros(0, np.uint32)
        bounds = ends[starts].astype(np.int64) // 4
        if not whole.any():
            return flat, bounds
        parts = []
        for i in range(n):
            parts.append(np.frombuffer(self._library([texts[i].as_py()])[0], np.uint32) if whole[i] else flat[bounds[i]:bounds[i + 1]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def encoder(path: str, drop_space: bool, plain_specials: bool = False) -> WordEncoder:
    """One encoder for each Python worker, kept between tasks."""
    key = (path, drop_space, plain_specials)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(*key)
    return _ENCODERS[key]
