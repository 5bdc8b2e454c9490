"""Token ids of whole texts by the public word BPE, with bounded caches of words."""

from __future__ import annotations

import re

import numpy as np

#: Words kept per worker before the cache starts anew.
CACHE_WORDS = 400_000
#: Characters for which the tokenizer's normal form is plain lower-casing and whose classes Python's ``re`` knows
#: alike (no white space beyond ASCII, no combining marks, no number signs). Other texts are encoded whole.
_PLAIN = re.compile("[\t-\r -~¡-±´-¸º»¿-įıĲ-ňŊ-ɏ]*")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


class WordBpe:
    """Little-endian 32-bit ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    The tokenizer never joins across white space, so ids are looked up word by word; unseen words are cut
    into the tokenizer's pre-tokens and those are encoded together.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        cut = [_PIECES.findall(w) for w in words]
        new = list({p for parts in cut for p in parts} - self.pieces.keys())
        for i in range(0, len(new), 256):
            some = new[i:i + 256]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                for piece, lo, hi in zip(some, [0, *stops[:-1]], stops, strict=True):
                    self.pieces[piece] = ids[lo:hi].tobytes()
            else:
                self.pieces.update((piece, self._whole(piece)) for piece in some)
        for word, parts in zip(words, cut, strict=True):
            self.words[word] = b"".join([self.pieces[p] for p in parts])

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        if len(self.pieces) > CACHE_WORDS:
            self.pieces.clear()
        split = [t.lower().split() if _PLAIN.fullmatch(t) and "<|" not in t else None for t in texts]
        unseen = {w for words in split if words for w in words} - self.words.keys()
        if unseen:
            self._learn(list(unseen))
        look = self.words.__getitem__
        return [self._whole(t) if words is None else b"".join(map(look, words))
                for t, words in zip(texts, split, strict=True)]


_loaded: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """One tokenizer per worker process; its caches outlive a task."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]
