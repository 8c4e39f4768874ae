"""Encoding texts with a public tokenizer, each distinct word once per worker."""

from __future__ import annotations

import json
import os
import re
import string
import struct
from functools import lru_cache

from finlake.llm.common import SPACE_CLASS

CACHE_WORDS = 3 << 18     # a chunk, or the lower-case letters of one, is held once
_SPACE = re.compile(f"[{SPACE_CLASS}]+")
_MARKS = string.punctuation
# str.split takes these for white space, the tokenizers' \s does not
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


def word_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def load(path: str):
    """The tokenizer at ``path`` without truncation or padding, one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others for U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class SpacedEncoder(dict):
    """Ids of whole texts for a tokenizer that drops white space.

    Such a tokenizer never joins characters across white space, so a text's
    ids are the ids of its space-separated chunks in order.  The chunks' ids
    are the entries of this dict (cleared at ``CACHE_WORDS``); a new chunk of
    Latin-1 letters, with or without ASCII marks behind them, goes to the BPE
    model directly, as its letters (an entry in lower case) and its marks are
    one word each; any other goes through the whole tokenizer.  Ids are
    little-endian unsigned 32-bit integers.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        split = (kind["pre_tokenizer"].get("pretokenizers") or [{}])[0]
        if split.get("behavior") != "Removed" or not split.get("invert"):
            raise ValueError("the tokenizer keeps white space; its chunks can't be encoded one by one")
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.marks: dict[str, bytes] = {}
        self.letters = byte_letters()
        self.packed = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]

    def _word(self, word: str, known: dict[str, bytes]) -> bytes:
        got = known.get(word)
        if got is None:
            mapped = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            got = known[word] = b"".join([self.packed[t.id] for t in self.model.tokenize(mapped)])
        return got

    def __missing__(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        stem = chunk.rstrip(_MARKS)
        mark = chunk[len(stem):]
        if stem.isalpha() and (stem.isascii() or max(stem) < "\u0100"):
            got = self._word(stem.lower(), self)
            if mark:
                got += self._word(mark, self.marks)
        else:
            got = b"".join([self.packed[i] for i in self.tokenizer.encode(chunk, add_special_tokens=False).ids])
        self[chunk] = got
        return got

    def encode(self, text: str) -> bytes:
        """The ids of ``text``."""
        if len(self) + len(self.marks) > CACHE_WORDS:
            self.clear()
            self.marks.clear()
        odd = any(c in text for c in _SEPARATORS)
        return b"".join(map(self.__getitem__, _SPACE.split(text) if odd else text.split()))


@lru_cache(maxsize=2)
def spaced_encoder(path: str) -> SpacedEncoder:
    """One encoder per worker process; its cache outlives a task."""
    return SpacedEncoder(path)
