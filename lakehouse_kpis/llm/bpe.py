"""Byte-level BPE, encoding and decoding, with the vocabulary of a public tokenizer file.

A word is a doubly linked list of symbols. A priority queue holds the ranks of the merges of
neighbours; the best one is taken, the list is relinked and the new neighbours queued. Entries whose
symbols have changed since are stale and skipped, so a word of n bytes costs O(n log n) however
long it is. Decoding concatenates the byte strings of the vocabulary.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.llm.tables import text_batches

CACHE_WORDS = 500_000  # encoded words that a Python worker remembers
CACHE_LENGTH = 48      # longer words are encoded each time

# fixed value: how the tokenizer's format cuts a text into words
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORDS = regex.compile(_CUT)
# The same cut for the standard library's faster matcher. Its classes are a little wider, so texts
# with a character of _APART go to the other one.
_FAST_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)


LATIN = 0x250  # code points from here on are left to the slower matcher


@functools.cache
def _apart() -> re.Pattern:
    """Characters that the two matchers put into different classes, and all beyond LATIN."""
    kinds = [
        (regex.compile(r"\p{L}"), re.compile(r"[^\W\d_]")),
        (regex.compile(r"\p{N}"), re.compile(r"\d")),
        (regex.compile(r"\s"), re.compile(r"\s")),
    ]
    odd = [
        c for c in map(chr, range(LATIN))
        if any(bool(p.match(c)) != bool(q.match(c)) for p, q in kinds)
    ]
    return re.compile(f"[{re.escape(''.join(odd))}{chr(LATIN)}-{chr(0x10FFFF)}]")


def words(text: str) -> list[str]:
    """The pieces within which symbols are merged; together they are the text."""
    return (_WORDS if _apart().search(text) else _FAST_WORDS).findall(text)


@functools.cache
def _byte_symbols() -> list[str]:
    """The printable character that the format writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain}
    for b in range(256):
        shown.setdefault(b, chr(256 + len(shown) - len(plain)))
    return [shown[b] for b in range(256)]


class Vocabulary:
    """Tokens and merges of one tokenizer file, and the words encoded lately."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        byte_of = {s: b for b, s in enumerate(_byte_symbols())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        top = max([*ids.values(), *self.special.values()]) + 1
        self.strings = [b""] * top
        for token, i in ids.items():
            self.strings[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.numerals = [str(i) for i in range(top)]
        self.byte_ids = [ids[s] for s in _byte_symbols()]
        # rank of a pair of neighbours, and by rank the two and what they become
        self.ranks: dict[int, int] = {}
        self.lefts, self.rights, self.merged = [], [], []
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks.setdefault(ids[a] << 32 | ids[b], rank)
            self.lefts.append(ids[a])
            self.rights.append(ids[b])
            self.merged.append(ids[a + b])
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("|".join(map(re.escape, longest_first))) if self.special else None
        self.known = _Known(self)

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """The ids of one word, by merging. Queue entries are rank and place in one number."""
        ids = list(map(self.byte_ids.__getitem__, word))
        n = len(ids)
        if n < 2:
            return tuple(ids)
        rank_of, lefts, rights, all_merged = self.ranks.get, self.lefts, self.rights, self.merged
        shift = n.bit_length()
        mask = (1 << shift) - 1
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        left = ids[0]
        for i in range(1, n):
            right = ids[i]
            rank = rank_of(left << 32 | right)
            if rank is not None:
                queue.append(rank << shift | i - 1)
            left = right
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i, rank = entry & mask, entry >> shift
            j = after[i]
            if ids[i] != lefts[rank] or j == n or ids[j] != rights[rank]:
                continue  # stale: one of the two has been merged otherwise since
            merged = ids[i] = all_merged[rank]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(merged << 32 | ids[k])
                if rank is not None:
                    heappush(queue, rank << shift | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(ids[h] << 32 | merged)
                if rank is not None:
                    heappush(queue, rank << shift | h)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text. Special tokens written out in the text get their ids."""
        known = self.known.__getitem__
        if self.split is None:
            return list(chain.from_iterable(map(known, words(text))))
        out, at = [], 0
        for m in self.split.finditer(text):
            out.extend(chain.from_iterable(map(known, words(text[at:m.start()]))))
            out.append(self.special[m[0]])
            at = m.end()
        out.extend(chain.from_iterable(map(known, words(text[at:]) if at else words(text))))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of some ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


class _Known(dict):
    """Words and their ids. When full it is emptied, so its size is bounded."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.vocabulary.encode_word(word.encode())
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _rows(documents: DataFrame, path: str, columns: str, row) -> DataFrame:
    text_batches(documents.sparkSession)
    names = ["doc_id", *(c.split()[0] for c in columns.split(", "))]

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = vocabulary(path)
        for batch in batches:
            texts = ((t or b"").decode("utf-8", "replace") for t in batch["text"])
            out = pd.DataFrame([row(known, t) for t in texts], columns=names[1:])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("binary").alias("text")).mapInPandas(
        made, f"doc_id {id_type}, {columns}"
    )


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """doc_id and ids, the tokens of the whole text of every row.

    `path` is the tokenizer file, at the same place on every executor. A null text is an empty one
    and has no tokens. Repeated rows and null ids are rows like any other; other columns are not
    looked at; an empty table gives an empty result. Bytes that are not UTF-8 are read as
    replacement characters.
    """
    return _rows(documents, path, "ids array<int>", lambda known, t: (known.encode(t),))


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and text for rows of doc_id and ids; null ids are none, and give an empty text."""
    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = vocabulary(path)
        for ids in batches:
            yield pd.Series([known.decode(i) if i is not None else "" for i in ids], dtype=object)

    return tokens.select("doc_id", text("ids").alias("text"))


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; rows as for `encoded`.

    Encodes and decodes in one pass, so that the tokens need not be written in between.
    """
    def row(known: Vocabulary, text: str) -> tuple:
        ids = known.encode(text)
        listed = ",".join(map(known.numerals.__getitem__, ids))
        back = known.decode(ids).encode()
        return len(ids), hashlib.sha256(listed.encode()).hexdigest(), (
            hashlib.sha256(back).hexdigest()
        )

    return _rows(
        documents, path, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", row
    )
