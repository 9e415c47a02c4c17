"""Operator 10: token counts by heap-and-linked-list byte-pair merging.

A text's count is its initial byte symbols minus the merges made; no identifiers are emitted.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm.bpe import BITS, Memo, forget, merge, pair_value

# Unicode's white space, and the word pattern of byte-level byte-pair encoding, to be filled with the
# classes of letters, numbers and white space.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"


def category(first: str) -> str:
    """The inside of a character class: all characters whose Unicode category begins with `first`."""
    ranges: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] == first:
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where printable in Latin-1, else the next from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class TokenCounter:
    """Counts the tokens that a byte-level tokenizer file of the tokenizers library gives a text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        splitter, model = spec["pre_tokenizer"] or {}, spec["model"]
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or spec["normalizer"] or odd:
            raise ValueError(f"{path} is no plain byte-level BPE file")
        letters, vocab = byte_letters(), model["vocab"]
        self.symbols = [vocab[c] for c in letters]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.table = {vocab[a] << BITS | vocab[b]: pair_value(i, vocab[a + b]) for i, (a, b) in enumerate(pairs)}
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that strip or want whole words")
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.words = re.compile(PATTERN.format(L=category("L"), N=category("N"), S=SPACE))
        self.word_count = Memo(self._count_word)

    def _count_word(self, word: str) -> int:
        data = word.encode("utf-8")
        return len(data) - merge(list(map(self.symbols.__getitem__, data)), self.table)[1]

    def _count_plain(self, text: str) -> int:
        return sum(map(self.word_count.__getitem__, self.words.findall(text)))

    def count(self, text: str) -> int:
        """Tokens of the whole text; an added token inside it counts as one, as the library has it by default."""
        if self.added is None or not self.added.search(text):
            return self._count_plain(text)
        return len(self.added.findall(text)) + sum(map(self._count_plain, self.added.split(text)))


@lru_cache(maxsize=4)
def counter(path: str) -> TokenCounter:
    """One counter for each file and Python worker."""
    return TokenCounter(path)


def token_count(text: Column, path: str) -> Column:
    """The number of tokens of a text column, long; null for null."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = counter(path)
        forget(made.word_count)
        for batch in batches:
            yield pa.array([made.count(t.as_py()) if t.is_valid else None for t in batch], pa.int64())

    return count(text)


def count_tokens(df: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """Add the token count of df's text column as `into`.

    Nulls: a null text counts as the empty text, 0 tokens. Other columns pass through as they are,
    null or not; an existing column named `into` is replaced. Texts of any length are counted
    whole. Repeated rows are counted each; an empty table stays empty.
    """
    return df.withColumn(into, token_count(F.coalesce(F.col(text), F.lit("")), path))
