"""Exact repeats of a given length, in bytes, across and within documents.

Each string of that length belongs to one anchor: the quarter as long piece inside it
of least hash (the first of equals). Equal strings have equal anchors at equal offsets,
so only documents that share an anchor need comparing. What a document has around an
anchor (all its strings that belong to it) is a fragment; equal fragments are
settled by counting. The rest are compared exactly by building the suffix order and
common prefixes of the fragments, aligned at their anchors, column by column: each
round inserts one symbol of every fragment, right to left, as a stable sort of the
order so far, and updates the common prefixes; a suffix whose common prefix with a
neighbour in that order reaches the length starts a repeated string. The collection is
read as sequential files sorted by anchor (a shuffle), a bounded block at a time. A
group of more than LIMIT different fragments is split before that: the first and the
second half of each fragment's strings are keyed by the bytes that all strings of the
half contain, which are more than the anchor, and go through the same steps again. After
at most as many splits as halving the fragment's strings takes, one string is left and equal
fragments are equal strings.

A longer length may be reported beside the one that anchors: fragments then reach so far to
the right, and the common prefixes tell both.

Defined results: a null text counts as empty; texts shorter than the length keep all;
rows with equal texts get equal results whatever their ids (so null and repeated ids
need no care); an empty table gives none; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_chunks
from .shingles import _BYTE, _INV, _MUL, mix, powers

LENGTH = 400
#: Different fragments of a group that are compared together, at most; larger groups are split.
LIMIT = 4096
#: Fragments compared at a time, about.
BLOCK = 4096
#: Bytes of text whose hashes are in memory at a time; a longer text comes alone.
CHUNK = 1 << 20

_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        with np.errstate(over="ignore"):
            _tables["up"], _tables["down"] = powers(_MUL, n), powers(_INV, n)
    return _tables["up"][:n], _tables["down"][:n]


def _key(text: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(text, digest_size=12).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each width adjacent values."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def seed_length(length: int) -> int:
    """Bytes of an anchor; it starts at most length less these into its string."""
    return max(1, length // 4)


def anchors(texts: list[bytes], length: int = LENGTH, reach: int | None = None) -> tuple[np.ndarray, ...]:
    """For each run of strings with one anchor: number of the text, anchor hash, fragment hash, first string's start, how many more strings, and the anchor's start from the first string's.

    A fragment is what its strings hold, with ``reach`` bytes from the last one's start, as far as the text goes.
    """
    reach, seed = reach or length, seed_length(length)
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    if len(data) < length:
        return (np.empty(0, np.int64),) * 6
    with np.errstate(over="ignore"):
        up, down = _powers(len(data) + 1)
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
        seeds = mix((sums[seed:] - sums[:-seed]) * down[: len(sums) - seed])
        order = (seeds & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(seeds), dtype=np.uint64)
        at = (_least(order, length - seed + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)  # by start of the string
        text = np.repeat(np.arange(len(texts)), sizes)[: len(at)]
        inside = np.arange(len(at)) + length <= ends[text]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new & inside)
        cut = np.flatnonzero(new | ~inside)  # a run ends before the next of these
        stop = np.append(cut, len(at))[np.searchsorted(cut, first, side="right")]
        q, more = at[first] - first, stop - 1 - first
        end = np.minimum(stop - 1 + reach, ends[text[first]])
        whole = _shape(mix((sums[end] - sums[first]) * down[first]), q, more, end - first)
    begin = (ends - sizes)[text[first]]
    return text[first], seeds[at[first]].view(np.int64), whole.view(np.int64), first - begin, more, q


def _shape(h: np.ndarray, q, more, size) -> np.ndarray:
    return mix(mix(h ^ (np.asarray(q).astype(np.uint64) << np.uint64(32)) ^ np.asarray(more).astype(np.uint64)) + np.asarray(size).astype(np.uint64))


def _anchor_rows(docs: DataFrame, length: int, reach: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_chunks(batch, limit=CHUNK):
                text, seed, frag, first, more, q = anchors(texts, length, reach)
                keys = np.array([_key(t) for t in texts], np.int64).reshape(-1, 2)
                if len(text):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[text, 0]), pa.array(keys[text, 1].astype(np.int32)), pa.array(seed), pa.array(frag), pa.array(first.astype(np.int32)), pa.array((more << 16 | q).astype(np.int32))], names=["t1", "t2", "seed", "frag", "first", "shape"])

    return docs.select("text").mapInArrow(run, "t1 long, t2 int, seed long, frag long, first int, shape int")


def _keyed(docs: DataFrame, carried: str | None = None) -> DataFrame:
    """(t1, t2, text as bytes) and the carried column."""
    names = ["t1", "t2", "text", *([carried] if carried else [])]
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                keys = np.array([_key(t) for t in texts], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1].astype(np.int32)), pa.array(texts, pa.binary()), *([part.column(carried)] if carried else [])], names=names)

    return docs.select("text", *([carried] if carried else [])).mapInArrow(run, "t1 long, t2 int, text binary" + (f", {carried} {kinds[carried]}" if carried else ""))


FRAGMENT = "seed long, frag long, t1 long, t2 int, first int, more int, at int, bytes binary"
_FRAGMENT_ARROW = pa.schema([("seed", pa.int64()), ("frag", pa.int64()), ("t1", pa.int64()), ("t2", pa.int32()), ("first", pa.int32()), ("more", pa.int32()), ("at", pa.int32()), ("bytes", pa.binary())])


def _cut_out(rows: DataFrame, reach: int) -> DataFrame:
    """The bytes of each fragment listed with its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("t1").to_pylist(), batch.column("t2").to_pylist(), batch.column("text").to_pylist(), batch.column("parts").to_pylist(), strict=True)
            rows, size = [], 0
            for t1, t2, text, parts in keys:
                for p in parts:
                    first, more = p["first"], p["shape"] >> 16
                    rows.append((p["seed"], p["frag"], t1, t2, first, more, p["shape"] & 0xFFFF, text[first : first + more + reach]))
                    size += reach
                    if size > CHUNK:
                        yield _batch(rows)
                        rows, size = [], 0
            if rows:
                yield _batch(rows)

    return rows.mapInArrow(run, FRAGMENT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FRAGMENT_ARROW, strict=True)], schema=_FRAGMENT_ARROW)


def _halves(fragments: DataFrame, length: int, reach: int) -> DataFrame:
    """Each fragment as two, of its strings that start at least half as far from the anchor as they can, and the others; keyed by what all strings of the half have in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                data, near = r["bytes"], r["at"] - r["more"]  # the last string's distance to the anchor
                low, high = r["low"], r["high"]  # distances that strings of this group can have
                mid = (low + high + 1) // 2
                for a, b in ((mid, high), (low, mid - 1)):
                    c, d = max(a, near), min(b, r["at"])
                    if a > b or c > d:
                        continue
                    start = r["at"] - d  # of the half's first string
                    own = data[start : r["at"] - c + reach]
                    # All strings from distance b to a contain what lies from a before the anchor to length less b after.
                    core = data[r["at"] - a : r["at"] - b + length]
                    key = int.from_bytes(hashlib.blake2b(core + b"%d %d %d" % (r["seed"], a, b), digest_size=8).digest(), "little", signed=True)
                    frag = int.from_bytes(hashlib.blake2b(own + b"%d %d" % (c, d), digest_size=8).digest(), "little", signed=True)
                    rows.append((key, frag, r["t1"], r["t2"], r["first"] + start, d - c, d, own, a, b))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), [*_FRAGMENT_ARROW, pa.field("low", pa.int32()), pa.field("high", pa.int32())], strict=True)], names=[*_FRAGMENT_ARROW.names, "low", "high"])

    return fragments.mapInArrow(run, FRAGMENT + ", low int, high int")


def columnwise(fragments: list[bytes], offsets: np.ndarray, length: int = LENGTH, reach: int | None = None) -> np.ndarray:
    """What the string that starts c - span from fragment i's anchor has in common with the most alike of the other fragments' there.

    Column by column from the right: order is the sorted order of the suffixes that start there, shared[k] what the k-th
    has in common with the one before it.
    """
    span = length - seed_length(length)
    m, width = len(fragments), span + (reach or length)
    symbols = np.zeros((width, m), np.uint16)  # 0: outside the fragment, equal to nothing
    for i, b in enumerate(fragments):
        at = span - int(offsets[i])
        symbols[at : at + len(b), i] = np.frombuffer(b, np.uint8).astype(np.uint16) + 1
    order, shared = np.arange(m), np.zeros(m, np.int32)
    common = np.zeros((m, span + 1), np.int32)
    low = symbols.min(1) == symbols.max(1)
    for c in range(width - 1, -1, -1):
        if low[c]:  # one symbol for all: the order stays
            shared = shared + 1 if symbols[c, 0] else np.zeros(m, np.int32)
            shared[0] = 0
        else:
            s = symbols[c, order]
            to = np.argsort(s, kind="stable")
            t = s[to]
            same = np.flatnonzero((t[1:] == t[:-1]) & (t[1:] > 0))
            fresh = np.zeros(m, np.int32)
            if len(same):
                a, b = to[same] + 1, to[same + 1]  # shared over a..b, both included, is what the two had
                near = a == b
                got = np.empty(len(same), np.int32)
                got[near] = shared[b[near]]
                if not near.all():
                    fa, fb = a[~near], b[~near]
                    pairs = np.empty(2 * len(fa), np.int64)
                    pairs[::2], pairs[1::2] = fa, fb + 1
                    got[~near] = np.minimum.reduceat(np.append(shared, 0), pairs)[::2]
                fresh[same + 1] = got + 1
            order, shared = order[to], fresh
        if c <= span:
            hit = np.flatnonzero(shared >= length)
            if len(hit):
                common[order, c] = np.maximum(shared, np.append(shared[1:], 0))
    return common


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by low, high and seed, about BLOCK at a time, a seed's rows together (at most LIMIT).

    Parts of one fragment, which overlap beyond their own strings, differ in low and never share a block.
    """
    rest, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        size += batch.num_rows
        if size < BLOCK:
            continue
        t = pa.Table.from_batches(rest).combine_chunks()
        s, low = t.column("seed").to_numpy(), t.column("low").to_numpy()
        part = low[1:] != low[:-1]
        cuts = np.flatnonzero(part | (s[1:] != s[:-1])) + 1
        start, part = 0, set((np.flatnonzero(part) + 1).tolist())
        for cut in cuts.tolist():
            if cut in part or cut - start >= BLOCK:
                yield t.slice(start, cut - start)
                start = cut
        if len(cuts) and cuts[-1] > start and t.num_rows - start >= BLOCK:
            yield t.slice(start, int(cuts[-1]) - start)
            start = int(cuts[-1])
        rest, size = t.slice(start).to_batches(), t.num_rows - start
    if size:
        t = pa.Table.from_batches(rest).combine_chunks()
        low = t.column("low").to_numpy()
        cuts = [0, *(np.flatnonzero(low[1:] != low[:-1]) + 1).tolist(), len(low)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield t.slice(a, b - a).combine_chunks()


def _ranges(flags: np.ndarray) -> np.ndarray:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge.reshape(-1, 2)


#: The strings of a length that start from first to last.
RANGE = "t1 long, t2 int, first int, last int, size int"


def _compare(fragments: DataFrame, lengths: list[int]) -> DataFrame:
    """The repeated strings of each fragment, as ranges of starts in its text."""
    length, reach = lengths[0], lengths[-1]
    span = length - seed_length(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches):
            first, at = t.column("first").to_numpy(), t.column("at").to_numpy()
            common = columnwise(t.column("bytes").to_pylist(), at, length, reach)
            rows, a, b, sizes = [], [], [], []
            for size in lengths:
                repeated = common >= size
                for i in np.flatnonzero(repeated.any(1)).tolist():
                    for x, y in _ranges(repeated[i]).tolist():
                        base = int(first[i]) + int(at[i]) - span
                        rows.append(i)
                        a.append(base + x)
                        b.append(base + y - 1)
                        sizes.append(size)
            if rows:
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays([t.column("t1").combine_chunks().take(take), t.column("t2").combine_chunks().take(take), *(pa.array(x, pa.int32()) for x in (a, b, sizes))], names=["t1", "t2", "first", "last", "size"])

    return fragments.repartition("seed").sortWithinPartitions("low", "seed").mapInArrow(run, RANGE)


def _settled(rows: DataFrame, keep: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Of rows with a shared seed: (t1, t2, first, more) of fragments that occur twice, and one place (with the columns keep) of each fragment of a seed that has several."""
    shared = rows.groupBy("seed").agg(F.count("*").alias("n"), F.min("frag").alias("low"), F.max("frag").alias("high")).where("n > 1")
    # Written first: a join of two plain exchanges can be split where one anchor is hot, one with an aggregate in it can't.
    shared = staged(shared.select("seed", (F.col("low") != F.col("high")).alias("mixed")), f"{name}-counts")
    rows = staged(rows.join(shared, "seed"), f"{name}-shared")
    mixed = rows.where("mixed")
    counts = mixed.groupBy("seed", "frag").agg(F.count("*").alias("c"), F.min(F.struct(*keep)).alias("one"))
    counts = staged(counts, f"{name}-fragments")
    found = ["t1", "t2", "first", "more"]
    equal = mixed.join(counts.where("c > 1").select("seed", "frag"), ["seed", "frag"], "left_semi").select(found)
    return rows.where("NOT mixed").select(found).union(equal), counts.select("seed", "frag", "one.*")


def repeated_ranges(docs: DataFrame, *lengths: int) -> DataFrame:
    """(t1, t2, first, last, size): by key of the text, where repeated strings of each of the lengths start. docs has a column text. Ranges may reach past the last start a text has."""
    lengths = sorted(set(lengths))
    length, reach = lengths[0], lengths[-1]
    rows = staged(_anchor_rows(docs, length, reach), "anchors")
    equal, one = _settled(rows.withColumn("more", F.shiftright("shape", 16)), ["t1", "t2", "first", "shape"], "anchor")
    found = [equal]
    crowds = staged(one.groupBy("seed").count().where(F.col("count") > LIMIT).select("seed"), "crowds")
    parts = one.groupBy("t1", "t2").agg(F.collect_list(F.struct("seed", "frag", "first", "shape")).alias("parts"))
    texts = _keyed(docs).dropDuplicates(["t1", "t2"])
    fragments = _cut_out(texts.join(parts, ["t1", "t2"]).select("t1", "t2", "text", "parts"), reach).withColumns({"low": F.lit(0), "high": F.lit(length - seed_length(length))})
    ready, single = [], []
    if not crowds.isEmpty():
        fragments = staged(fragments, "fragments")
        ready.append(fragments.join(crowds, "seed", "left_anti"))
        crowded = fragments.join(crowds, "seed", "left_semi")
        while True:
            equal, one = _settled(staged(_halves(crowded, length, reach), "halves"), ["t1", "t2", "first", "more", "at", "bytes", "low", "high"], "half")
            found.append(equal)
            # One string each, equal at the shortest length; at longer ones equal where the fragments are.
            single.append(one.where("low = high").select("t1", "t2", "first", F.col("first").alias("last"), F.lit(length).alias("size")))
            one = one.where("low < high")
            crowds = staged(one.groupBy("seed").count().where(F.col("count") > LIMIT).select("seed"), "crowds")
            ready.append(one.join(crowds, "seed", "left_anti").select(fragments.columns))
            if crowds.isEmpty():
                break
            crowded = one.join(crowds, "seed", "left_semi")
    else:
        ready.append(fragments)
    compared = _compare(reduce(DataFrame.union, ready), lengths)
    equal = reduce(DataFrame.union, found)
    # What equal fragments hold is repeated at every length, as far as the text goes.
    sizes = F.explode(F.array(*map(F.lit, lengths)))
    equal = equal.select("t1", "t2", "first", (F.col("first") + F.col("more")).cast("int").alias("last"), sizes.alias("size"))
    return reduce(DataFrame.union, [equal, *single, compared])


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, passage: int | None = None) -> DataFrame:
    """docs' columns as struct ``row``, with n_bytes, n_removed, n_spans, kept (the remaining bytes), text (those of them that form whole characters), spans (removed byte ranges) and n_passage_bytes (bytes covered by repeated strings of ``passage`` bytes, which stay; as n_removed if none is given)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row") if len(docs.columns) > 1 else F.struct(F.lit(1).alias("_")).alias("row"), F.col(f"`{text_col}`").alias("text"))
    passage = passage or length
    ranges = repeated_ranges(rows, length, passage).distinct().groupBy("t1", "t2").agg(F.collect_list(F.struct("first", "last", "size")).alias("ranges"))
    kind = dict(rows.dtypes)["row"]

    def covered(n: int, ranges, size: int) -> np.ndarray:
        """Which bytes of a text of n lie in a repeated string of that size."""
        change = np.zeros(n + 1, np.int32)
        own = [(r["first"], min(r["last"], n - size)) for r in ranges or () if r["size"] == size and r["first"] <= n - size]
        if own:
            first, last = np.array(own).T
            np.add.at(change, first, 1)
            np.add.at(change, last + size, -1)
        return np.cumsum(change[:-1]) > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, count, kept, texts, spans, also = [], [], [], [], [], [], []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                out = covered(len(text), ranges, length)
                runs = _ranges(out)
                n.append(len(text))
                gone.append(int(out.sum()))
                count.append(len(runs))
                kept.append(np.frombuffer(text, np.uint8)[~out].tobytes() if len(runs) else text)
                texts.append(kept[-1].decode("utf-8", "ignore"))
                spans.append([{"start": a, "stop": b} for a, b in runs.tolist()])
                also.append(gone[-1] if passage == length else int(covered(len(text), ranges, passage).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(x, pa.int64()) for x in (n, gone, count)), pa.array(kept, pa.binary()), pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), pa.array(also, pa.int64())], names=["row", "n_bytes", "n_removed", "n_spans", "kept", "text", "spans", "n_passage_bytes"])

    joined = _keyed(rows, "row").join(ranges, ["t1", "t2"], "left").select("row", "text", "ranges")
    return joined.mapInArrow(run, f"row {kind}, n_bytes long, n_removed long, n_spans long, kept binary, text string, spans array<struct<start:int,stop:int>>, n_passage_bytes long")
