"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token's bytes are the initial symbols of a doubly linked list.  A heap holds the adjacent pairs
that have a merge rank; the lowest rank (leftmost of equals) is popped, the pair is joined, and the two
new neighbours are pushed.  The count is the number of initial symbols less the number of merges: no
token id is ever made.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); a null id is passed through; repeated
rows give repeated results; an empty table gives an empty result; other columns are left out, so their
names can't clash.  Strings of special tokens inside a text count one token each, as the library's
default has it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame

from .storage import lean, text_batches
from .word_ids import ODD, byte_symbols

#: Fixed value of byte-level BPE: the pre-token pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def merges_left(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols that remain once no adjacent pair has a rank."""
    n = len(symbols)
    if n < 2:
        return n
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    if not heap:
        return n
    symbols, left = list(symbols), n
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        # an entry is stale if either symbol has changed since it was pushed
        if j < 0 or symbols[i] is None or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = None
        k = after[i] = after[j]
        left -= 1
        if k >= 0:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heappush(heap, (r, i))
        h = before[i]
        if h >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heappush(heap, (r, h))
    return left


class Counts(dict):
    """Pre-token to count; holds at most ``most`` short pre-tokens, then starts afresh."""

    def __init__(self, ranks: dict[tuple[str, str], int], most: int = 400_000):
        super().__init__()
        self.ranks, self.most, self.symbols = ranks, most, byte_symbols()

    def __missing__(self, token: str) -> int:
        n = merges_left([self.symbols[b] for b in token.encode()], self.ranks)
        if len(token) <= 32:
            if len(self) >= self.most:
                self.clear()
            self[token] = n
        return n


class Counter:
    """Counts the tokens of texts for one byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        import regex
        from tokenizers import pre_tokenizers

        self.cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without a normalizer is needed")
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.counts = Counts({(a, b): i for i, (a, b) in enumerate(merges)})
        self.plain, self.odd = regex.compile(PATTERN).findall, regex.compile(ODD).search
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = special
        self.split = regex.compile("|".join(map(regex.escape, special))).split if special else None

    def find(self, text: str) -> list[str]:
        """The text's pre-tokens; where Unicode versions differ, as the library itself cuts them."""
        if text.isascii() or not self.odd(text):
            return self.plain(text)
        return [text[a:b] for _, (a, b) in self.cut.pre_tokenize_str(text)]

    def __call__(self, text: str) -> int:
        count = self.counts.__getitem__
        if not any(s in text for s in self.special):
            return sum(map(count, self.find(text)))
        parts = self.split(text)
        return len(parts) - 1 + sum(sum(map(count, self.find(p))) for p in parts)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter for each Python worker and file."""
    return Counter(path)


def count_tokens(df: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text; one narrow pass, nothing shuffled."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count = counter(tokenizer)
        for batch in text_batches(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return df.select(id_col, text_col).mapInArrow(lean(run), SCHEMA)
