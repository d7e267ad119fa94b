"""Token ids of whole texts by the tokenizers library, run by run.

ASCII white space always ends what the word tokenizer joins, so a text's ids are
those of its runs without white space in order, and a run is encoded once for
all its occurrences a worker sees. What a worker remembers is bounded.
"""

from __future__ import annotations

import json
import os
from array import array
from codecs import charmap_decode
from unicodedata import is_normalized

import numpy as np
import regex
from tokenizers import Tokenizer

WORD_VOCABULARY = "word_bpe_49k.json"
# Bytes of runs a worker remembers in each of two generations, with what a place costs besides
# the run and what is known of it; and marks for runs met once.
REMEMBERED, PLACE_BYTES, MARKS = 20 << 20, 180, 1 << 20
# Marks that never join with a letter before them; the last of the Latin
# letters, whose classes and lower case no edition of the standard changes.
TAIL, LATIN = ".,;:!?", "\u024f"
TAIL_BYTES = TAIL.encode()

_ENCODERS: dict[str, Encoder] = {}


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others for the
    characters from U+0100 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(0x100)]


ALL_LETTERS = "".join(byte_letters())


# Composed Latin letters, each with a lower case of one letter.
PLAIN = frozenset(c for c in map(chr, range(ord(LATIN) + 1))
                  if c.isalpha() and c != "\u0130" and is_normalized("NFC", c))


def _letters_of(word: str) -> str:
    """The letters that stand for the bytes of a word."""
    return charmap_decode(word.encode(), "strict", ALL_LETTERS)[0]


def vocabulary_path(name: str) -> str:
    """The file of a public vocabulary; a path that exists stands for itself."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def runs_of(raw: bytes) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased as the tokenizer does anyway.

    Where a special string might stand in the text case matters and is left alone.
    """
    return raw.split() if b"<|" in raw else raw.lower().split()


class Remembered(dict):
    """What ``learn`` gives for runs, kept for runs that come again.

    A run takes a place when it is met for the second time; most never are.
    Once the places take ``most`` bytes they become the old generation, from
    which a run that is met returns, and the generation before is forgotten:
    what is used stays.
    """

    def __init__(self, most: int = REMEMBERED):
        super().__init__()
        self.most, self.held = most, 0
        self.old: dict = {}
        self.met = bytearray(MARKS)

    def __missing__(self, run: bytes):
        found = self.old.get(run)
        if found is None:
            found = self.learn(run)
            mark = hash(run) & (MARKS - 1)
            if not self.met[mark]:
                self.met[mark] = 1
                return found
        self[run] = found
        self.held += PLACE_BYTES + len(run) + (len(found) if type(found) is bytes else 0)
        return found

    def trim(self) -> None:
        """Keep what a worker remembers bounded; called between slices of texts."""
        if self.held > self.most:
            self.old = self.copy()
            self.clear()
            self.held, self.met = 0, bytearray(MARKS)

    def learn(self, run: bytes):
        raise NotImplementedError


class Encoder(Remembered):
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, name: str, most: int = REMEMBERED):
        super().__init__(most)
        self.library = Tokenizer.from_file(vocabulary_path(name))
        self.library.no_truncation()
        self.library.no_padding()
        # The library's own steps, which need not all be taken for every run.
        self.normalizer, self.cutter = self.library.normalizer, self.library.pre_tokenizer
        self.tokenize = self.library.model.tokenize
        self.size = self.library.get_vocab_size()
        cut = json.loads(self.library.to_str())["pre_tokenizer"]["pretokenizers"][0]
        self.piece = regex.compile(cut["pattern"]["Regex"])

    def learn(self, run: bytes) -> bytes:
        if run.isalpha():  # the letters of ASCII stand for themselves
            return array("I", [t.id for t in self.tokenize(run.lower().decode())]).tobytes()
        word = run.rstrip(TAIL_BYTES)
        if word.isalpha():
            return self[word] + self[run[len(word):]]
        text = run.decode("utf-8", "replace")
        word = text.rstrip(TAIL)
        if word and PLAIN.issuperset(word):  # one word as it stands, and the marks that follow it
            if len(word) < len(text):
                return self[word.encode()] + self[text[len(word):].encode()]
            return self.ids([_letters_of(text.lower())])
        if "<|" in text:
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if text.isascii() and text.isprintable():
            pieces = self.piece.findall(text.lower())
            if len(pieces) > 1:
                return b"".join([self[p.encode()] for p in pieces])
            return self.ids(pieces)
        plain = self.normalizer.normalize_str(text)
        return self.ids([p for p, _ in self.cutter.pre_tokenize_str(plain)])

    def ids(self, words: list[str]) -> bytes:
        """Ids of words in the letters that stand for their bytes."""
        tokenize = self.tokenize
        return array("I", [t.id for w in words for t in tokenize(w)]).tobytes()

    def encode(self, texts: list[bytes], end_id: int | None = None) -> list[bytes]:
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        get = self.__getitem__
        found = [b"".join(map(get, runs_of(t))) + end for t in texts]
        self.trim()
        return found


def encoder(name: str) -> Encoder:
    """The worker's encoder for a vocabulary, kept from task to task."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]
