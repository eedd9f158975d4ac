"""Token ids of whole texts by a public tokenizer, with repeated words encoded once.

The tokenizer of word_bpe_49k.json composes, lower-cases and splits text without looking across a space, a tab or a line
feed, so a text's ids are those of its words in turn. `encode` keeps the ids of words it has met, up to a bound.
"""

from __future__ import annotations

import os
import sys
from array import array

import numpy as np

#: Words that a worker remembers in each of two generations; words that are met again move to the younger one.
KEPT_WORDS = 100_000
#: ASCII punctuation, but for the apostrophe, which may begin a piece of its own ('s, 't, ...).
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def within_latin(text: str) -> bool:
    """Whether all characters are below U+0100, where composing changes nothing and lower-casing goes by single ones."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True

#: Texts that tell a tokenizer apart for which words are not encoded one by one.
PROBES = ("The quick  Brown fox's can't,\n\tdon't -- (it's) 12,345.67!", "Éléphant naïve straße «œuvre» 北京 слово", "a" * 40 + " ...!? x_y @z #1", " leading and trailing ")


def byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """With `plain_specials`, the strings of special tokens in a text are ordinary text."""

    def __init__(self, path: str, plain_specials: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.model, self.bytes = self.tokenizer.model, byte_letters()
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        # The way by words holds for the tokenizer above; any other one that tells itself apart here encodes whole texts.
        self.by_words = True
        self.by_words = all(self.encode(t).tobytes() == self._whole(t) for t in PROBES)

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of one text as uint32; a null text has none."""
        if not text:
            return np.zeros(0, np.uint32)
        if not self.by_words or "<|" in text:  # may hold the strings of special tokens
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        if within_latin(text):
            text = text.lower()
        pieces = text.replace("\n", " ").replace("\t", " ").split(" ")
        known = self.known
        missing = set(pieces).difference(known)
        if missing:
            if len(known) + len(missing) > KEPT_WORDS:
                self.older, self.known = known, {"": b""}
                known, missing = self.known, [p for p in set(pieces) if p]
            older = self.older
            for p in missing:
                known[p] = older[p] if p in older else self._piece(p)
        return np.frombuffer(b"".join(map(known.__getitem__, pieces)), np.uint32)

    def _piece(self, piece: str) -> bytes:
        """The ids of a run without blanks. Letters, and marks behind them, are cut where the tokenizer cuts too."""
        if piece.isalpha() and piece.islower() and within_latin(piece):
            return self._letters(piece)
        stem = piece.rstrip(MARKS)
        if stem != piece and stem.isalpha() and stem.islower() and within_latin(stem):
            for part in (stem, piece[len(stem) :]):
                if part not in self.known:
                    self.known[part] = self.older.get(part) or (self._letters(part) if part is stem else self._whole(part))
            return self.known[stem] + self.known[piece[len(stem) :]]
        return self._whole(piece)

    def _letters(self, word: str) -> bytes:
        if not word.isascii():
            word = "".join(map(self.bytes.__getitem__, word.encode()))
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _whole(self, piece: str) -> bytes:
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()


def worker_encoder(path: str, plain_specials: bool = False) -> Encoder:
    """The worker process's encoder, kept from one task to the next."""
    kept = sys.__dict__.setdefault("_kept_encoders", {})
    if (path, plain_specials) not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept[path, plain_specials] = Encoder(path, plain_specials)
    return kept[path, plain_specials]
