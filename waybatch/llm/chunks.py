"""Encoding texts piece by piece: each distinct piece is tokenized once in a
task and looked up from then on. Used where a tokenizer treats the pieces of
a text independently of each other."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np

from waybatch.llm.common import gather

#: A task forgets its pieces when it holds so many, or so many ids; and words
#: that it hasn't met since it learned half as many others.
MOST_PIECES, MOST_WORDS, MOST_IDS = 300_000, 400_000, 6_000_000

#: A word of Latin letters (NFC leaves them; U+0130 has a lower case of two
#: characters and is left out) and what follows it of ASCII punctuation but
#: the apostrophe: such a piece has these two matches of the usual patterns.
PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-įı-ʯ]+)([!-&(-/:-@\[-`{-~]*)")


class Encoder:
    """Encodes pieces with a byte-level tokenizer of the tokenizers library:
    the matches of plain pieces go to its model one by one, each distinct one
    once; all other pieces go through the whole tokenizer."""

    def __init__(self, tokenizer, shown: list[str], lower: bool, most_words: int = MOST_WORDS):
        self.tokenizer, self.model, self.shown, self.lower, self.most_words = tokenizer, tokenizer.model, shown, lower, most_words
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def __call__(self, pieces: list[str]) -> list[bytes]:
        plain = [PLAIN.fullmatch(p) for p in pieces]
        others = [p for p, m in zip(pieces, plain, strict=True) if not m]
        rest = iter([array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)])
        if len(self.words) > self.most_words // 2:
            self.older, self.words = self.words, {"": b""}
        words = self.words
        out = []
        for m in plain:
            if not m:
                out.append(next(rest))
                continue
            word, mark = m.groups()
            if self.lower:
                word = word.lower()
            a, b = words.get(word), words.get(mark)
            out.append((a if a is not None else self._word(word)) + (b if b is not None else self._word(mark)))
        return out

    def _word(self, match: str) -> bytes:
        got = self.older.get(match)
        if got is None:
            got = array("I", [t.id for t in self.model.tokenize("".join([self.shown[b] for b in match.encode()]))]).tobytes()
        self.words[match] = got
        return got


class Pieces:
    """``split(text)`` gives a text's pieces, ``encode(pieces)`` their ids as
    unsigned 32-bit integers in bytes."""

    def __init__(self, split: Callable[[str], list[str]], encode: Encoder, most_pieces: int = MOST_PIECES):
        self.split, self.encode, self.most_pieces = split, encode, most_pieces
        self._forget()

    def forget(self) -> None:
        """Drops all pieces and words that were learned."""
        self._forget()
        self.encode.forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)  # ends[i]: after the ids of piece i - 1
        self.used = 0

    def _learn(self, pieces: list[str]) -> None:
        codes = self.encode(pieces)
        n, ids = len(self.known), np.frombuffer(b"".join(codes), np.uint32)
        while n + len(pieces) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.ends[n + 1:n + 1 + len(pieces)] = self.used + np.cumsum(np.fromiter(map(len, codes), np.int64, len(codes)) // 4)
        self.used += len(ids)
        self.known.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def codes_of(self, pieces: list[str]) -> np.ndarray:
        """Numbers of pieces; new ones are learned."""
        if len(self.known) > self.most_pieces or self.used > MOST_IDS:
            self._forget()
        new = list(set(pieces).difference(self.known))
        if new:
            self._learn(new)
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all texts' pieces, joined, and how many each text has."""
        parts = [self.split(t) for t in texts]
        codes = self.codes_of(list(chain.from_iterable(parts)))
        return codes, np.fromiter(map(len, parts), np.int64, len(parts))

    def joined(self, codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and how many each text has, from the numbers of their pieces."""
        ids, lengths = gather(self.flat, self.ends, codes)
        before = np.concatenate([[0], np.cumsum(lengths)])
        edges = before[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(edges)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and how many each text has."""
        return self.joined(*self.codes(texts))
