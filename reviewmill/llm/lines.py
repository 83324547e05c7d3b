"""Line dedup: documents probe sharded arrays behind minimal perfect hashes.

Every distinct key of a line (trimmed, A-Z lower-cased, long enough) is counted once with the
smallest document that holds it. Keys are dealt to shards by hash. A shard is a
minimal perfect hash, built level by level: at each, the keys that alone fall on a bit
take it and the others go on to the next. Ranks of the bits number three arrays: a
32-bit fingerprint, a saturating 16-bit count of rows (1 where one document has them all), and, by the rank of the counts
over 1, the document that keeps the line. A document sends a row for each shard that its lines fall
into, with their hashes; a shard's arrays come before its documents in the sorted
partition, so only one shard is in memory. What comes back are line numbers
to drop, by document.

Keys in more than one in HOT of all lines would make their shards hot: there are fewer than HOT of
them, and they form one small shard that every task has.

Defined results: a null or empty text is one empty line; a document is a doc_id, so rows
that share one never count as two documents, and each of them keeps what its document keeps; a null
id is one document after all others; an empty table gives no rows. Other columns are never
read. Keys are told apart by 96 bits of hash; an index asked about keys that it was
not built from takes one in 2 ** 32 of them for another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_chunks
from .shingles import mix

#: Code points of a key, at least; shorter lines always stay.
LEAST = 10
#: Keys of a shard, about.
SHARD = 1 << 16
#: A key that more than one in HOT of all lines have is looked up without the shuffle.
HOT = 4096
#: Bits of a level for each key that is left.
GAMMA = 2
BLANK = b" \t\n\v\f\r"
LAST = (1 << 63) - 1

KEYS = pa.schema([("doc", pa.int64()), ("t1", pa.int64()), ("t2", pa.int32()), ("at", pa.binary()), ("h", pa.binary()), ("f", pa.binary())])


def _hash(data: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(data, digest_size=12).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def line_keys(text: bytes, least: int = LEAST) -> tuple[list[int], list[bytes]]:
    """Numbers and keys of the lines of a text whose keys are long enough."""
    at, keys = [], []
    for k, line in enumerate(text.split(b"\n")):
        if len(line) >= least:
            key = line.strip(BLANK).lower()
            if len(key) >= 4 * least or len(key) >= least and len(key.decode("utf-8", "replace")) >= least:
                at.append(k)
                keys.append(key)
    return at, keys


def _hashed(docs: DataFrame, least: int) -> DataFrame:
    """A row a document that has keys: its id, the hash of its text, and as arrays the lines' numbers and their 64 and 32 bits of hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                rows = []
                for doc, text in zip(part.column("doc").to_pylist(), texts, strict=True):
                    at, keys = line_keys(text, least)
                    if keys:
                        raw = np.frombuffer(b"".join(hashlib.blake2b(k, digest_size=12).digest() for k in keys), np.dtype([("h", "<i8"), ("f", "<i4")]))
                        rows.append((doc, *_hash(text), np.array(at, "<i4").tobytes(), raw["h"].tobytes(), raw["f"].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), KEYS, strict=True)], schema=KEYS)

    return docs.mapInArrow(run, "doc long, t1 long, t2 int, at binary, h binary, f binary")


def _column(batch: pa.RecordBatch, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's arrays end to end, and their lengths."""
    rows = batch.column(name).to_pylist()
    return np.frombuffer(b"".join(rows), kind), np.array([len(r) for r in rows], np.int64) // np.dtype(kind).itemsize


def count_keys(hashed: DataFrame) -> DataFrame:
    """(h, f, low, n, shared): each distinct key, the smallest document that holds it, in how many rows it is, and whether another document holds it too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, sizes = _column(batch, "h", "<i8")
            f, _ = _column(batch, "f", "<i4")
            doc = np.repeat(batch.column("doc").to_numpy(), sizes)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            order = np.lexsort((f, h, row))
            row, h, f, doc = row[order], h[order], f[order], doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1]) | (f[1:] != f[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(h[new]), pa.array(f[new]), pa.array(doc[new])], names=["h", "f", "doc"])

    rows = hashed.select("doc", "h", "f").mapInArrow(run, "h long, f int, doc long")
    found = rows.groupBy("h", "f").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n"))
    return found.select("h", "f", "low", "n", (F.col("low") < F.col("high")).alias("shared"))


def _spread(h: np.ndarray, f: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(h.astype(np.int64).view(np.uint64) + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)) ^ (f.astype(np.int64).view(np.uint64) << np.uint64(17)))


class PerfectHash:
    """Distinct keys (h, f) to 0 .. n - 1 without gaps, about 3 bits a key."""

    def __init__(self, levels: list[np.ndarray]):
        self.sizes = [len(b) for b in levels]
        self.bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        self.ranks = np.cumsum(self.bits, dtype=np.int32) - self.bits

    @classmethod
    def build(cls, h: np.ndarray, f: np.ndarray) -> PerfectHash:
        levels = []
        while len(h):
            size = max(64, GAMMA * len(h))
            at = (_spread(h, f, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            h, f = h[~alone[at]], f[~alone[at]]
        return cls(levels)

    def slots(self, h: np.ndarray, f: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for some keys that are none of the set's, any number for others."""
        out, rest, base = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
        for level, size in enumerate(self.sizes):
            if not len(rest):
                break
            at = base + (_spread(h[rest], f[rest], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            out[rest[hit]] = self.ranks[at[hit]]
            rest, base = rest[~hit], base + size
        return out

    def pack(self) -> tuple[bytes, bytes]:
        return np.array(self.sizes, "<i4").tobytes(), np.packbits(self.bits).tobytes()

    @classmethod
    def unpack(cls, sizes: bytes, bits: bytes) -> PerfectHash:
        n = np.frombuffer(sizes, "<i4").astype(np.int64)
        flat = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(n.sum())).astype(bool)
        return cls(np.split(flat, np.cumsum(n)[:-1]) if len(n) else [])


class Shard:
    """A perfect hash and its arrays: fingerprints, counts, and the keeper of each key with a count over 1."""

    FIELDS = ("sizes", "bits", "prints", "counts", "keepers")

    def __init__(self, hashes: PerfectHash, prints: np.ndarray, counts: np.ndarray, keepers: np.ndarray):
        self.hashes, self.prints, self.counts, self.keepers = hashes, prints, counts, keepers
        self.repeated = np.cumsum(counts > 1) - 1

    @classmethod
    def build(cls, h: np.ndarray, f: np.ndarray, low: np.ndarray, n: np.ndarray, shared: np.ndarray) -> Shard:
        hashes = PerfectHash.build(h, f)
        order = np.argsort(hashes.slots(h, f))
        counts = np.where(shared[order], np.minimum(n[order], 0xFFFF), 1).astype("<u2")
        return cls(hashes, f[order].astype("<i4"), counts, low[order][counts > 1].astype("<i8"))

    def pack(self) -> tuple[bytes, ...]:
        return (*self.hashes.pack(), self.prints.tobytes(), self.counts.tobytes(), self.keepers.tobytes())

    @classmethod
    def unpack(cls, sizes: bytes, bits: bytes, prints: bytes, counts: bytes, keepers: bytes) -> Shard:
        return cls(PerfectHash.unpack(sizes, bits), np.frombuffer(prints, "<i4"), np.frombuffer(counts, "<u2"), np.frombuffer(keepers, "<i8"))

    def holds(self, h: np.ndarray, f: np.ndarray) -> np.ndarray:
        at = self.hashes.slots(h, f)
        return (at >= 0) & (self.prints[at] == f) if len(self.prints) else np.zeros(len(h), bool)

    def drops(self, h: np.ndarray, f: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Which of these lines go: those of repeated keys that another document keeps."""
        out = np.zeros(len(h), bool)
        at = np.flatnonzero(self.holds(h, f))
        slot = self.hashes.slots(h[at], f[at])
        more = self.counts[slot] > 1
        out[at[more]] = self.keepers[self.repeated[slot[more]]] != doc[at[more]]
        return out


def _shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (mix(h.astype(np.int64).view(np.uint64)) % np.uint64(shards)).astype(np.int64)


KEY = ("h", "f", "low", "n", "shared")
INDEX = "shard long, sizes binary, bits binary, prints binary, counts binary, keepers binary"


def build_index(keys: DataFrame, shards: int) -> DataFrame:
    """A row a shard with the arrays of its keys."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_shard_of(batch.column("h").to_numpy(), shards)), *batch.columns], names=["shard", *KEY])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _groups(batches):
            packed = Shard.build(*(rows.column(c).to_numpy(zero_copy_only=False) for c in KEY)).pack()
            yield pa.RecordBatch.from_arrays([pa.array([shard]), *(pa.array([x], pa.binary()) for x in packed)], names=["shard", *Shard.FIELDS])

    dealt = keys.select(*KEY).mapInArrow(number, "shard long, h long, f int, low long, n long, shared boolean")
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(build, INDEX)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows sorted by shard, one shard's (some SHARD keys) at a time."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        s = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(s[1:] != s[:-1]) + 1).tolist(), len(s)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                if rest and rest[0].column("shard")[0].as_py() != s[a]:
                    yield rest[0].column("shard")[0].as_py(), pa.Table.from_batches(rest).combine_chunks()
                    rest = []
                rest.append(batch.slice(a, b - a))
    if rest:
        yield rest[0].column("shard")[0].as_py(), pa.Table.from_batches(rest).combine_chunks()


PROBE = "shard long, kind int, doc long, t1 long, t2 int, at binary, h binary, f binary"


def _probes(hashed: DataFrame, shards: int, hot: tuple[bytes, ...]) -> DataFrame:
    """Rows of kind 1: a document's lines in one shard; of kind 2: its lines that the hot keys drop, under any shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = Shard.unpack(*hot)
        for batch in batches:
            (h, sizes), (f, _), (at, _) = (_column(batch, c, k) for c, k in (("h", "<i8"), ("f", "<i4"), ("at", "<i4")))
            row = np.repeat(np.arange(batch.num_rows), sizes)
            doc = batch.column("doc").to_numpy()
            known = common.holds(h, f)
            gone = common.drops(h, f, doc[row])
            shard = np.where(known, row % shards, _shard_of(h, shards))
            kind = np.where(known, 2, 1)
            keep = np.flatnonzero(~known | gone)
            order = keep[np.lexsort((shard[keep], kind[keep], row[keep]))]
            if not len(order):
                continue
            row, kind, shard, h, f, at = row[order], kind[order], shard[order], h[order], f[order], at[order]
            edge = np.flatnonzero((row[1:] != row[:-1]) | (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])) + 1
            cuts, first = np.concatenate([[0], edge, [len(row)]]), np.concatenate([[0], edge])
            own = row[first]
            pieces = (pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((cuts * x.itemsize).astype("<i4").tobytes()), pa.py_buffer(np.ascontiguousarray(x).tobytes())]) for x in (at, h, f))
            yield pa.RecordBatch.from_arrays([pa.array(shard[first]), pa.array(kind[first].astype(np.int32)), *(batch.column(c).take(pa.array(own)) for c in ("doc", "t1", "t2")), *pieces], names=["shard", "kind", "doc", "t1", "t2", "at", "h", "f"])

    return hashed.mapInArrow(run, PROBE)


def dropped(hashed: DataFrame, index: DataFrame, shards: int, hot: tuple[bytes, ...]) -> DataFrame:
    """(doc, t1, t2, at): numbers of the lines to drop, one or more rows a document that loses some."""
    arrays = index.withColumn("kind", F.lit(0))
    both = arrays.unionByName(_probes(hashed, shards, hot), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = number = None
        for batch in batches:
            s, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edge = np.flatnonzero((s[1:] != s[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            cuts = [0, *edge.tolist(), len(s)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(a, b - a)
                if not part.num_rows:
                    continue
                if kinds[a] == 0:
                    shard, number = Shard.unpack(*(part.column(c)[0].as_py() for c in Shard.FIELDS)), s[a]
                    continue
                names = ["doc", "t1", "t2", "at"]
                if kinds[a] == 2:
                    yield part.select(names)
                    continue
                if number != s[a]:
                    raise ValueError("a shard's arrays are missing")
                (h, sizes), (f, _), (at, _) = (_column(part, c, k) for c, k in (("h", "<i8"), ("f", "<i4"), ("at", "<i4")))
                row = np.repeat(np.arange(part.num_rows), sizes)
                gone = shard.drops(h, f, part.column("doc").to_numpy()[row])
                left = np.bincount(row[gone], minlength=part.num_rows)
                keep = np.flatnonzero(left)
                if len(keep):
                    cut = np.split(at[gone], np.cumsum(left[keep])[:-1])
                    yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(keep)) for c in names[:3]), pa.array([x.tobytes() for x in cut], pa.binary())], names=names)

    return both.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(run, "doc long, t1 long, t2 int, at binary")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the lines that stay, as UTF-8 bytes) of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    hashed = staged(_hashed(rows.select("doc", "text"), least), "line-hashes")
    keys = staged(count_keys(hashed), "line-keys")
    distinct, total = keys.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    common = keys.where(F.col("n") > max(1, total // HOT)).toPandas()  # fewer than HOT + 1 rows: their counts add up to the total at most
    hot = Shard.build(*(common[c].to_numpy() for c in KEY)).pack()
    shards = max(1, -(-int(distinct) // SHARD))
    index = staged(build_index(keys.where(F.col("n") <= max(1, total // HOT)), shards), "line-index")
    gone = dropped(hashed, index, shards, hot).groupBy("doc", "t1", "t2").agg(F.collect_set("at").alias("gone"))
    kind = dict(rows.dtypes)["id"]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                keys = np.array([_hash(t) for t in texts], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("doc"), pa.array(keys[:, 0]), pa.array(keys[:, 1].astype(np.int32)), pa.array(texts, pa.binary())], names=["id", "doc", "t1", "t2", "text"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                out = []
                for i, t, gone in zip(part.column("id").to_pylist(), texts, part.column("gone").to_pylist(), strict=True):
                    lines = t.split(b"\n")
                    numbers = set(np.frombuffer(b"".join(gone or ()), "<i4").tolist())
                    out.append((i, len(lines), len(numbers), b"\n".join(x for k, x in enumerate(lines) if k not in numbers) if numbers else t))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (part.column("id").type, pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["id", "n_lines", "n_dropped", "kept"])

    texts = rows.mapInArrow(keyed, f"id {kind}, doc long, t1 long, t2 int, text binary")
    found = texts.join(gone, ["doc", "t1", "t2"], "left").select("id", "text", "gone").mapInArrow(cut, f"id {kind}, n_lines long, n_dropped long, kept binary")
    return found.withColumnRenamed("id", id_col)
