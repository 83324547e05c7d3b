"""Packing of documents into token sequences by lexical retrieval.

A document is cut after each LENGTH tokens; whole cuts are sequences of their own.
What is left of it is its tail. Tails are dealt by content: by the rarest of their terms that at
least SHARD tails hold (the commoner of these in several parts), sorted by that and their next rarest ones, and each SHARD
adjacent ones are a shard with a BM25 inverted index, weighted by document frequencies over all tails of
the corpus. Seeds are taken longest first; the index returns the unused tails nearest
to a seed, which fill its window greedily, the last one cut to fit; the rest of that
one stays unused. Only the last window of a shard can fall short: it is cut into powers
of two, which need no padding.

Defined results: a null text counts as empty and is its end token alone; null and
repeated ids give each row its own pieces (told apart by sequence and offset); an empty
table gives none; texts are tokenized whole. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import divisible, ranks_of
from .common import staged, text_chunks

LENGTH = 1024
END = 0
SHARD = 2048
#: BM25.
K1, B = 1.2, 0.75
#: Terms that tails are sorted by; shards in a partition, about, and partitions at most.
KEYS, SHARDS, PARTITIONS = 4, 4, 10_000
#: Neighbours looked at before the rest of the shard is sorted.
FIRST = 48
PIECE = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a tokenizer's file, which it finds in texts before anything else; only plain ones are known here."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    if any(x[k] for x in found for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("only plain added tokens are supported")
    return {x["content"]: x["id"] for x in found}


class _Encoder:
    """Ids of many texts, as 32-bit numbers. What follows each blank is remembered; what a batch has anew is encoded in
    one call, as the vocabulary's pattern divides it at the blanks anyway."""

    #: Remembered segments; about 100 MB. Over it, all is forgotten before the next batch.
    MOST = 600_000

    def __init__(self, path: str, pattern: str, added: dict[str, int]):
        import tiktoken

        ranks = ranks_of(path)
        self.encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.sizes[i] = len(token)
        self.known: dict[str, bytes] = {}
        self.added = {s: array("I", [i]).tobytes() for s, i in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def plain(self, s: str) -> bool:
        return not any(a in s for a in self.added)

    def one(self, s: str) -> bytes:
        if self.plain(s):
            return array("I", self.encode(s)).tobytes()
        return b"".join(self.added[x] if k % 2 else array("I", self.encode(x)).tobytes() for k, x in enumerate(self.cut.split(s)))

    def learn(self, segments: list[str]) -> None:
        ids = np.array(self.encode(" " + " ".join(segments)), "<u4")
        ends = np.cumsum([len(s.encode()) + 1 for s in segments])
        stops = (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1) * 4
        raw, at = ids.tobytes(), 0
        for s, stop in zip(segments, stops.tolist(), strict=True):
            self.known[s] = raw[at:stop]
            at = stop

    def many(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.MOST:
            self.known.clear()
        get, out, open_ = self.known.get, [], []
        for t in texts:
            if not divisible(t) or not self.plain(t):
                out.append(self.one(t))
                continue
            first, *rest = t.split(" ")
            found = list(map(get, rest))
            if None in found:
                at = [i for i, x in enumerate(found) if x is None]
                open_.append((len(out), first, found, at, [rest[i] for i in at]))
                out.append(b"")
            else:
                out.append(self.one(first) + b"".join(found))
        if open_:
            self.learn(list(set().union(*(o[4] for o in open_))))
        for k, first, found, at, new in open_:
            for i, s in zip(at, new, strict=True):
                found[i] = self.known[s]
            out[k] = self.one(first) + b"".join(found)
        return out


_encoders: dict[tuple, _Encoder] = {}


def _encoder(path: str, pattern: str, added: dict[str, int]) -> _Encoder:
    key = (path, pattern, *added.items())
    if key not in _encoders:
        _encoders[key] = _Encoder(path, pattern, added)
    return _encoders[key]


def tokenized(docs: DataFrame, path: str, pattern: str, added: dict[str, int], id_col: str, text_col: str, length: int = LENGTH) -> DataFrame:
    """Cuts of each document with its end token: whole ones, then the tail (which may be empty and is then left out). ids are 16-bit where they fit; salt is the row's number in its task and tells equal rows apart."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, rows = _encoder(path, pattern, added).many, np.array([END], "<u4").tobytes(), 0
        for batch in batches:
            for part, texts in text_chunks(batch):
                row, start, size, ids, tokens = [], [], [], [], []
                for i, raw in enumerate(encode([t.decode("utf-8", "replace") for t in texts])):
                    own = np.frombuffer(raw + end, "<u4")
                    for at in range(0, len(own), length):
                        cut = own[at : at + length]
                        row.append(i)
                        start.append(at)
                        size.append(len(cut))
                        ids.append(cut.astype("<u2").tobytes() if len(cut) == 0 or cut.max() < 65536 else b"+" + cut.tobytes())
                        tokens.append(len(own))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), *(pa.array(x, pa.int64()) for x in (start, size)), pa.array(ids, pa.binary()), pa.array(tokens, pa.int64()), pa.array(np.array(row, np.int64) + rows)], names=["doc_id", "start", "length", "ids", "doc_tokens", "salt"])
                rows += len(texts)

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, salt long")


def _ids(b: bytes, length: int) -> np.ndarray:
    return np.frombuffer(b, "<u2").astype("<u4") if len(b) == 2 * length else np.frombuffer(b, "<u4", offset=1)


def frequencies(tails: DataFrame) -> DataFrame:
    """(term, n): in how many tails each token stands. A task sends a row for each token it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for b, n in zip(batch.column("ids").to_pylist(), batch.column("length").to_pylist(), strict=True):
                t = np.unique(_ids(b, n))
                if len(t) and t[-1] >= len(total):
                    total = np.concatenate([total, np.zeros(int(t[-1]) + 1 - len(total), np.int64)])
                total[t] += 1
        t = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int64)), pa.array(total[t])], names=["term", "n"])

    return tails.select("ids", "length").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Index:
    """BM25 over a shard's tails: postings sorted by term, with each posting's weight; terms of many tails as rows of a matrix."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray):
        sizes = np.array([len(d) for d in docs], np.int64)
        of = np.repeat(np.arange(len(docs), dtype=np.int64), sizes)
        key, n = np.unique(np.concatenate(docs).astype(np.int64) * len(docs) + of, return_counts=True)
        term, self.doc = key // len(docs), key % len(docs)
        norm = K1 * (1 - B + B * sizes / max(1.0, sizes.mean()))
        self.weight = (idf[term] * n * (K1 + 1) / (n + norm[self.doc])).astype(np.float32)
        self.term, self.begin = np.unique(term, return_index=True)
        self.stop = np.append(self.begin[1:], len(term))
        self.n = len(docs)
        many = np.flatnonzero(16 * (self.stop - self.begin) > self.n)
        self.row = np.full(len(self.term), -1, np.int64)
        self.row[many] = np.arange(len(many))
        self.dense = np.zeros((len(many), self.n), np.float32)
        for r, i in enumerate(many.tolist()):
            a, b = self.begin[i], self.stop[i]
            self.dense[r, self.doc[a:b]] = self.weight[a:b]

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Each tail's score for these different terms, all of which the shard holds."""
        at = np.searchsorted(self.term, terms)
        row = self.row[at]
        common = self.dense[row[row >= 0]].sum(0)
        at = at[row < 0]
        begin, size = self.begin[at], self.stop[at] - self.begin[at]
        place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return (common + np.bincount(self.doc[place], self.weight[place], self.n)).astype(np.float32)


def _nearest(score: np.ndarray, n: int) -> Iterator[int]:
    """The n best, best first, ties by number; the first few are found without sorting all."""
    if n > FIRST:
        at = np.flatnonzero(score >= np.partition(score, len(score) - FIRST)[len(score) - FIRST])
        at = at[np.argsort(-score[at], kind="stable")]
        yield from at.tolist()
        yield from np.argsort(-score, kind="stable")[len(at) : n].tolist()
    else:
        yield from np.argsort(-score, kind="stable")[:n].tolist()


def fill(docs: list[np.ndarray], idf: np.ndarray, length: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Sequences of (tail, from, to): every token of every tail in one place."""
    index = Index(docs, idf)
    left = np.array([len(d) for d in docs], np.int64)  # of a tail its last tokens are cut off last
    used = np.zeros(len(docs), np.int64)
    sequences = []
    for seed in np.argsort(-left, kind="stable").tolist():
        if not left[seed]:
            continue
        window = [(seed, int(used[seed]), len(docs[seed]))]
        room = length - int(left[seed])
        used[seed], left[seed] = len(docs[seed]), 0
        if room:
            score = index.scores(np.unique(docs[seed]))
            score[left == 0] = -1
            for d in _nearest(score, np.count_nonzero(left)):
                take = min(room, int(left[d]))
                window.append((d, int(used[d]), int(used[d]) + take))
                used[d] += take
                left[d] -= take
                room -= take
                if not room:
                    break
        sequences.append(window)
    last = sequences.pop() if sequences and sum(b - a for _, a, b in sequences[-1]) < length else []
    size = sum(b - a for _, a, b in last)
    while size:
        part, room = [], 1 << (size.bit_length() - 1)
        size -= room
        while room:
            d, a, b = last[0]
            take = min(room, b - a)
            part.append((d, a, a + take))
            last[0] = (d, a + take, b)
            if a + take == b:
                last.pop(0)
            room -= take
        sequences.append(part)
    return sequences


def pack(docs: DataFrame, path: str, pattern: str, added: dict[str, int] | None = None, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids (binary: little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``added`` are tokens that are found in texts before the pattern divides them, with their ids.
    """
    kind = dict(docs.dtypes)[id_col]
    cuts = staged(tokenized(docs, path, pattern, added or {}, id_col, text_col, length), "cuts")
    tails = cuts.where(F.col("length") < length)
    # One row for each token of the vocabulary at most, whatever the corpus.
    got = frequencies(tails).toArrow()
    number = tails.count()
    idf = np.zeros(max(1 << 16, int(max(got.column("term").to_pylist(), default=0)) + 1))
    n, term = got.column("n").to_numpy(), got.column("term").to_numpy()
    idf[term] = np.log1p((number - n + 0.5) / (n + 0.5))
    # Sorting terms by place, rarest first, and in how many parts each one's tails are dealt.
    sorting = np.flatnonzero(n >= min(SHARD, number / 16))
    sorting = sorting[np.lexsort((term[sorting], n[sorting]))]
    place, size = np.full(len(idf), len(idf), np.int64), SHARD * SHARDS
    place[term[sorting]] = np.arange(len(sorting))
    known = docs.sparkSession.sparkContext.broadcast((idf, place, -(-n[sorting] // size)))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 34
        for batch in batches:
            n, size = batch.num_rows, batch.column("length").to_pylist()
            ids = [_ids(b, k).tobytes() for b, k in zip(batch.column("ids").to_pylist(), size, strict=True)]
            sequence = at + 2 * np.arange(n, dtype=np.int64)
            at += 2 * n
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("length"), pa.array(ids, pa.binary()), batch.column("doc_tokens"), pa.array(sequence), pa.array(np.zeros(n, np.int64))], names=PIECE)

    def content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each tail with the part it is dealt to and its rarest sorting terms, rarest first."""
        _, place, parts = known.value
        for batch in batches:
            keys, first = [], []
            for b, n in zip(batch.column("ids").to_pylist(), batch.column("length").to_pylist(), strict=True):
                own = np.unique(place[_ids(b, n)])[:KEYS]
                keys.append(own[own < len(place)].astype(">u4").tobytes())
                first.append(own[0])
            first, h = np.array(first, np.int64), batch.column("h").to_numpy()
            salt = np.where(first < len(place), h % parts[np.minimum(first, len(parts) - 1)] if len(parts) else 0, h)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary()), pa.array(first), pa.array(salt)], names=[*batch.schema.names, "content", "first", "part"])

    def shard(table: pa.Table, number: int) -> tuple[pa.RecordBatch, int]:
        """The pieces of a shard's sequences, which are numbered from number."""
        size = table.column("length").to_pylist()
        docs = [_ids(b, k) for b, k in zip(table.column("ids").to_pylist(), size, strict=True)]
        row, begin, count, ids, sequence, offset = [], [], [], [], [], []
        for window in fill(docs, known.value[0], length):
            at = 0
            for d, a, b in window:
                row.append(d)
                begin.append(a)
                count.append(b - a)
                ids.append(docs[d][a:b].tobytes())
                sequence.append(number)
                offset.append(at)
                at += b - a
            number += 2
        row = np.array(row, np.int64)
        columns = [table.column("doc_id").take(pa.array(row)).combine_chunks(), pa.array(table.column("start").to_numpy()[row] + np.array(begin, np.int64)), pa.array(count, pa.int64()), pa.array(ids, pa.binary()), table.column("doc_tokens").take(pa.array(row)).combine_chunks(), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=PIECE), number

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each SHARD adjacent tails; what remains is a shard with the last of them if it is under half a shard."""
        number, held, size = (TaskContext.get().partitionId() << 34) + 1, [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= SHARD * 3 // 2:
                table = pa.Table.from_batches(held)
                at = 0
                while size - at >= SHARD * 3 // 2:
                    out, number = shard(table.slice(at, SHARD).combine_chunks(), number)
                    yield out
                    at += SHARD
                held, size = table.slice(at).combine_chunks().to_batches(), size - at
        if size:
            yield shard(pa.Table.from_batches(held).combine_chunks(), number)[0]

    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    hashed = tails.withColumn("h", F.xxhash64("doc_id", "salt", "ids"))
    keyed = hashed.mapInArrow(content, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, salt long, h long, content binary, first long, part long")
    dealt = keyed.repartition(max(1, min(PARTITIONS, -(-number // size))), "first", "part").sortWithinPartitions("content", "h")
    return cuts.where(F.col("length") == length).mapInArrow(whole, schema).union(dealt.mapInArrow(shards, schema)).withColumnRenamed("doc_id", id_col)


def digest(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return pieces.select(id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
