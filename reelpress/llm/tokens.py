"""Token ids of whole texts, word by word from a bounded cache.

A byte-level BPE encodes every match of its splitting pattern on its own, so the ids of a text
are the ids of its words in a row, and a word need be encoded only once. Texts of plain characters
are split by an equal, simpler pattern of the standard library; texts with other characters are
split by the pattern itself, or encoded as a whole, since regular expression libraries may class
rare characters differently.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import islice

import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer

#: Words a worker remembers, at most; it then forgets the later half, since frequent words come early.
CACHE_WORDS = 300_000

#: Letters of Latin-1 and Latin Extended-A.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
#: Those letters and ASCII, without control characters but for tab, line feed and carriage return.
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e{_LETTERS}]*")
#: The splitting pattern, for plain characters; letters are tried first, being most frequent.
_PLAIN_WORDS = re.compile(
    rf" ?[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+"
)


def word_finder() -> Callable[[str], list[str]]:
    """Function from a text to all matches of the splitting pattern."""
    every = regex.compile(public_tokenizers.PATTERN).findall

    def find(text: str) -> list[str]:
        return _PLAIN_WORDS.findall(text) if _PLAIN.fullmatch(text) else every(text)

    return find


class _Words(dict):
    """Word -> its ids as little-endian 32-bit numbers."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        found = np.array(self.encode(word), "<u4").tobytes()
        self[word] = found
        return found


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level models write each byte: printable ones stand for
    themselves, the others in their order for the code points from 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def encoder(path: str) -> Callable[[str], bytes]:
    """Function from a text to its ids, as little-endian unsigned 32-bit numbers.

    ``path`` is a byte-level BPE file. Words are given to the file's model, other texts to the whole
    tokenizer, as are texts with a string of an added token, which is one id, as the library's plain call has it.
    """
    tokenizer = Tokenizer.from_file(path)
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    model, letters = tokenizer.model, byte_letters()
    model._resize_cache(0)  # this module has its own

    def by_model(word: str) -> list[int]:
        written = word.encode("utf-8").decode("latin-1").translate(letters)
        return [token.id for token in model.tokenize(written)]

    words = _Words(by_model)

    def encode(text: str) -> bytes:
        if any(token in text for token in added) or not _PLAIN.fullmatch(text):
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(words) > CACHE_WORDS:
            for word in list(islice(words, CACHE_WORDS // 2, None)):
                del words[word]
        return b"".join(map(words.__getitem__, _PLAIN_WORDS.findall(text)))

    return encode
