"""Token ids of the lower-casing word-level BPE file, as little-endian bytes.

The library itself encodes each distinct pre-token; a bounded table keeps the bytes of its ids, so that
a text's ids are one lookup for each pre-token.  Texts of Latin letters and common signs are cut by the
same pattern with its classes written out for those characters, which Python's own ``re`` matches faster.
Texts that hold a special token's string, and those whose lower-casing depends on context, go through the
library whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

#: Fixed value of the file's format: how the normalised text is cut into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Code points whose class differs between the Unicode versions of the two libraries.
ODD = "[\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u1c89\u208f\u209d-\u209f\ua7cb-\ua7dd\ua7e2\ua7f1\uab6c\uab6d\U00010000-\U0010ffff]"


#: Fixed values of byte-level BPE: bytes that stand for themselves.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_symbols() -> list[str]:
    """The stand-in of each byte: itself if printable, else the next code point from 256 on."""
    odd = [b for b in range(256) if b not in set(PRINTABLE)]
    return [chr(b) if b not in odd else chr(256 + odd.index(b)) for b in range(256)]


#: Characters of the faster pattern: Latin letters up to U+024F, general punctuation, the euro sign.
LATIN = [*range(0x250), *range(0x2010, 0x203B), 0x20AC]


def latin_patterns():
    """(finds a character beyond ``LATIN``, finds all pre-tokens of a text without any)."""
    import regex

    def of(kind: str) -> str:
        return "".join(f"\\u{c:04x}" for c in LATIN if regex.fullmatch(kind, chr(c)))

    letters, numbers, blanks, rest = (of(kind) for kind in (r"\p{L}", r"\p{N}", r"\s", r"[^\s\p{L}\p{N}]"))
    return re.compile(f"[^{letters}{numbers}{blanks}{rest}]").search, re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{letters}]+|[{numbers}]|[{rest}]+").findall


class Pieces(dict):
    """Pre-token to the bytes of its ids, from the library's model; starts afresh beyond ``most`` entries."""

    def __init__(self, model, most: int):
        super().__init__()
        self.model, self.most, self.symbols = model, most, byte_symbols()

    def __missing__(self, word: str) -> bytes:
        of, mapped = self.symbols, word if word.isascii() and word.isalpha() else None
        ids = array("I", [t.id for t in self.model.tokenize(mapped or "".join([of[b] for b in word.encode()]))]).tobytes()
        if len(word) <= 32:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class WordIds:
    """Encodes texts to unsigned 32-bit ids."""

    def __init__(self, path: str, most: int = 300_000):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"] != {"Regex": PATTERN}:
            raise ValueError("not the word-level file this encoder is made for")
        self.whole = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.find, (self.beyond, self.find_latin) = regex.compile(PATTERN).findall, latin_patterns()
        self.odd = regex.compile(ODD).search
        self.ids_of = Pieces(self.whole.model, most)

    def __call__(self, text: str) -> bytes:
        if "<|" in text and any(s in text for s in self.special) or not text.isascii() and self.odd(text):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if text.isascii():
            text = text.lower()
        elif "Σ" not in text and "İ" not in text and unicodedata.is_normalized("NFC", text):
            text = text.lower()
        else:
            text = self.whole.normalizer.normalize_str(text)
        find = self.find_latin if text.isascii() or not self.beyond(text) else self.find
        return b"".join(map(self.ids_of.__getitem__, find(text)))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One encoder for each Python worker and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)
