"""Encoding of many texts with a word-level tokenizer: every distinct word is encoded once per worker.

For tokenizers that compose characters (NFC), lower their case, take white space as a break and drop it,
break between letters and other characters and mark the end of a word in its last token, the ids of a
text are those of its words put together. Words are known by 64-bit hashes of their bytes, which numpy
takes of all texts at once, and become strings only when they are new. Words are split at spaces and newlines. Where that cannot change
the ids, case is lowered first and a mark behind a letter begins a word of its own, so that a word is one
entry in all its guises.
"""

from __future__ import annotations

import os
import re
import sys
import types
import unicodedata
from itertools import chain

import numpy as np

from .shingles import _VALUES, mix64, running_hash, span_hash, spans

#: Distinct words held, some 50 bytes each; when there are more, the cache starts anew.
HELD_WORDS = 700_000
#: A mark behind a letter, where the tokenizer breaks too; the apostrophe may begin a contraction.
_MARK = re.compile(r"(?<=[^\W\d_])([!\"#$%&()*+,\-./:;<=>?@\[\\\]^`{|}~])")


def plain(text: str) -> str:
    """The text in fewer guises with the same ids. Left alone: texts that may hold special tokens, whose
    case counts, characters whose lower case depends on their composition, and the one letter whose lower
    case ends in a combining mark, which the tokenizer joins to a mark behind it. Of texts with the letter
    whose lower case depends on its neighbours the case is left alone."""
    text = text.replace("\n", " ")
    if "<|" in text or "İ" in text:
        return text
    if text.isascii():
        text = text.lower()
    elif not unicodedata.is_normalized("NFC", text):
        return text
    elif "Σ" not in text:
        low = text.lower()
        if unicodedata.is_normalized("NFC", low):
            text = low
    return _MARK.sub(r" \1", text)


def one_word(word: str) -> bool:
    """Letters only, whatever is composed and lowered: one word to the tokenizer."""
    if not word.isalpha():
        return False
    return word.isascii() or ("İ" not in word and unicodedata.is_normalized("NFC", word))


def worker_cache(tokenizer_path: str) -> WordCache:
    """The cache of this Python worker, which later tasks of the worker find filled."""
    name = "_llm_word_cache"  # functions come to a worker by value, so its modules are where it lasts
    module = sys.modules.setdefault(name, types.ModuleType(name))
    if getattr(module, "path", None) != tokenizer_path:
        module.path, module.cache = tokenizer_path, WordCache(tokenizer_path)
    return module.cache


class WordCache:
    def __init__(self, tokenizer_path: str, held: int = HELD_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.held = held
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.keys, self.codes = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes in order, words
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts, self.lengths = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = self.words = 0

    def _append(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        first, n = self.words, len(lengths)
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.starts) < first + n:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + n] = lengths
        self.used += len(ids)
        self.words += n

    def _add(self, words: list[str], keys: np.ndarray) -> None:
        letters = np.fromiter(map(one_word, words), bool, len(words))
        if letters.any():
            # One text of them all, cut after the tokens that end a word.
            text = " ".join(w for w, plain_ in zip(words, letters) if plain_)
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) == letters.sum():
                self._append(ids, np.diff(ends, prepend=-1))
            else:  # a letter to one library is none to the other
                letters[:] = False
        others = [w for w, plain_ in zip(words, letters) if not plain_]
        if others:
            ids = [e.ids for e in self.tokenizer.encode_batch(others, add_special_tokens=False)]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            self._append(np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths)
        # Words were appended letters first.
        added = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
        codes = np.empty(len(words), np.int64)
        codes[added] = np.arange(self.words - len(words), self.words)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.codes = np.insert(self.keys, at, keys), np.insert(self.codes, at, codes)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, n + 1 bounds of each text's ids)."""
        if self.words > self.held:
            self._clear()
        raw = [plain(t).encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts, ends, rows = spans(data != 0x20, offsets)
        keys = span_hash(running_hash(data, _VALUES), starts, ends) + (ends - starts).astype(np.uint64)
        distinct, first, of = np.unique(mix64(keys), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            whole = data.tobytes()
            self._add([whole[starts[i] : ends[i]].decode() for i in first[new]], distinct[new])
            at = np.searchsorted(self.keys, distinct)
        codes = self.codes[at][of]
        lengths = self.lengths[codes]
        until = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(self.starts[codes] - until[:-1], lengths) + np.arange(until[-1])]
        return ids, until[np.searchsorted(rows, np.arange(len(texts) + 1))]
