"""Byte-level BPE by a monoid tree reduction.

The encoding of a byte string is the product of the encodings of its halves.
To join two neighbours, the tokens next to the seam are encoded again in a
window that doubles until both ends of it fit what lies outside: a sequence of
tokens is the encoding of its bytes exactly if each two adjacent tokens are the
encoding of theirs, so nothing beyond a fitting end can change. Decoding
concatenates up the same tree.

Defined results: null and empty texts have no tokens and decode to no bytes;
repeated rows and null ids give a row each; an empty table gives none; texts of
any length are read whole (a match of the pattern is never cut: the tree works
inside it). Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_chunks

LEAF = 16
#: Segments kept by a Python worker, at most about 70 MB; and short strings and pairs of tokens, about 15 MB each. Full, each starts anew.
CACHE = 300_000
SMALL_CACHE = 100_000


@lru_cache(maxsize=4)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Encodes by merge ranks; each match of the pattern separately."""

    def __init__(self, path: str, pattern: str):
        self.ranks = ranks_of(path)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for t, i in self.ranks.items():
            self.tokens[i] = t
        self.matches = regex.compile(pattern).findall
        self.fits: dict[tuple[int, int], bool] = {}
        self.short: dict[bytes, list[int]] = {}

    def leaf(self, b: bytes) -> list[int]:
        """Merge the adjacent pair of least rank, leftmost first, until none is left."""
        ranks = self.ranks
        if (whole := ranks.get(b)) is not None:
            return [whole]
        rank, none = ranks.get, len(self.tokens)
        parts = [b[i : i + 1] for i in range(len(b))]
        pairs = [rank(b[i : i + 2], none) for i in range(len(b) - 1)]
        while pairs and (best := min(pairs)) < none:
            i = pairs.index(best)
            parts[i : i + 2] = [self.tokens[best]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
        return [ranks[p] for p in parts]

    def fit(self, a: int, b: int) -> bool:
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) >= SMALL_CACHE:
                self.fits.clear()
            known = self.fits[a, b] = self.leaf(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of both halves' bytes, from theirs."""
        if not left or not right or self.fit(left[-1], right[0]):
            return left + right
        k = 2
        while True:
            i, j = max(0, len(left) - k), min(len(right), k)
            inner = self.decode(left[i:] + right[:j])
            mid = self.window(inner)
            if (not i or self.fit(left[i - 1], mid[0])) and (j == len(right) or self.fit(mid[-1], right[j])):
                return left[:i] + mid + right[j:]
            k *= 2

    def window(self, b: bytes) -> list[int]:
        if len(b) > LEAF:
            return self.heap(b) if len(b) > 4 * LEAF else self.leaf(b)
        known = self.short.get(b)
        if known is None:
            if len(self.short) >= SMALL_CACHE:
                self.short.clear()
            known = self.short[b] = self.leaf(b)
        return known

    def heap(self, b: bytes) -> list[int]:
        """As leaf, in n log n: merges of least rank first, from a heap over linked parts."""
        ranks, n = self.ranks, len(b)
        end, prev, gone = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(n)
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(b[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if gone[i] or j >= n or gone[j] or end[j] != stop:
                continue
            gone[j], end[i] = 1, stop
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(b[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := ranks.get(b[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[b[i : end[i]]])
            i = end[i]
        return out

    def encode_bytes(self, b: bytes) -> list[int]:
        """One match of the pattern: halves, joined."""
        if len(b) <= LEAF // 2:
            return self.window(b)
        if (whole := self.ranks.get(b)) is not None:
            return [whole]
        half = len(b) // 2
        return self.join(self.encode_bytes(b[:half]), self.encode_bytes(b[half:]))

    def encode(self, text: str) -> list[int]:
        return [i for m in self.matches(text) for i in self.encode_bytes(m.encode())]

    def decode(self, ids: list[int]) -> bytes:
        """Halves concatenated up the tree; b"".join does it in one allocation."""
        return b"".join(map(self.tokens.__getitem__, ids))


class Segments(dict):
    """ids of a segment as little-endian 32-bit numbers, remembered in bounded memory."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, s: str) -> bytes:
        ids = array("I", self.encode(s)).tobytes()
        if len(s) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[s] = ids
        return ids


_rare_space = re.compile("[\\t\\x0b\\x0c\\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]").search
_beside_space = re.compile(r"\s |(?: |^)\s|^ | $").search


def divisible(text: str) -> bool:
    """Whether each blank of the text stands between two other characters that are no white space.

    Such a blank is always the first of its match, so every match of the pattern lies between two of them.
    """
    return not (_beside_space(text) if _rare_space(text) else "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ")


def segments(text: str) -> list[str]:
    """The text cut before each blank, where that divides no match; else the text as it is."""
    if not text:
        return []
    if not divisible(text):
        return [text]
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]]


_workers: dict[tuple[str, str], tuple[Codec, Segments]] = {}


def _worker(path: str, pattern: str) -> tuple[Codec, Segments]:
    if (path, pattern) not in _workers:
        codec = Codec(path, pattern)
        _workers[path, pattern] = codec, Segments(codec.encode)
    return _workers[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and ids (binary: little-endian unsigned 32-bit numbers) of each whole text."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _worker(path, pattern)[1]
        for batch in batches:
            for part, texts in text_chunks(batch):
                ids = [b"".join(map(cache.__getitem__, segments(t.decode("utf-8", "replace")))) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=[id_col, "n_tokens", "ids"])

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """id, n_tokens, ids and bytes (the decoded text) of each row that encode made."""
    kind = dict(encoded.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _worker(path, pattern)[0]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = [codec.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[id_col, "n_tokens", "ids", "bytes"])

    return encoded.select(id_col, "n_tokens", "ids").mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids binary, bytes binary")


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return decoded.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
