"""Language-model scores by a probabilistic suffix tree over bytes.

A text is the words it has, lower-cased, each followed by one blank, and an end symbol;
the symbols are its bytes. The context of a symbol is the DEPTH symbols that precede it in
the text, across words, with blanks before the first one. A context is retained if it stands at least LEAST times
in the training documents and the divergence of its next symbols from those of its
longest retained suffix, times its count, reaches DIVERGENCE. A retained context's
distribution is its counts smoothed by WEIGHT observations, for each symbol seen after it,
drawn from that suffix's distribution. A symbol is scored in the state of the longest retained suffix of what
precedes it. LEAST and DIVERGENCE are absolute, so the tree grows with the corpus.

The tree is a table: for each string of DEPTH symbols and the next one that any
document holds, the probability of the next one; it is made level by level, by aggregates
and joins, and never leaves the cluster. Documents are dealt into blocks of about BLOCK
bytes; a block asks once for each of its distinct strings and words, and the FREQUENT
commonest of both, a fixed number, are known everywhere.

Defined results: a null or empty text is its end alone; a null id counts as the empty
text in the split; repeated rows get a row each; an empty table gives none; an empty
training set leaves N = V = 0 and a uniform model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_chunks
from .shingles import word_hashes

DEPTH = 5
LEAST = 8
DIVERGENCE = 6.0
WEIGHT = 2.0
FREQUENT = 1 << 18
BLOCK = 32 << 20
#: Bytes of text in arrays at a time.
CHUNK = 2 << 20
#: Different keys a task holds before it sends them on, and rows it sends at a time.
HELD = 1 << 22
ROWS = 1 << 17
SPACE, END = b" ", b"\n"
_PAD = SPACE * DEPTH
#: What a counted key is: a word's hash, a string, the training documents, the bytes of all texts.
WORD, STRING, DOCUMENTS, BYTES = range(4)


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(7)) == 2


def _strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of DEPTH symbols and the next, one for each symbol of each text, and where each text's begin (one more entry at the end)."""
    own = [b"".join([w + SPACE for w in t.lower().split()]) + END for t in texts]
    sizes = np.array([len(o) for o in own], np.int64)
    data = np.frombuffer(_PAD + _PAD.join(own), np.uint8).astype(np.uint64)
    keys = data[DEPTH:].copy()
    for k in range(1, DEPTH + 1):
        keys |= data[DEPTH - k : len(data) - k] << np.uint64(8 * k)
    keep = np.ones(len(keys), bool)  # without the positions of the padding between texts
    ends = np.cumsum(sizes + DEPTH)[:-1] - DEPTH
    keep[(ends[:, None] + np.arange(DEPTH)[None, :]).ravel()] = False
    return keys[keep].view(np.int64), np.concatenate([[0], np.cumsum(sizes)])


class _Sums:
    """Counts by key, in parts that are merged when they hold more than most keys together."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, learned: bool) -> None:
        keys, n = np.unique(keys, return_counts=True)
        self.parts.append((keys, n if learned else np.zeros(len(n), np.int64)))
        self.size += len(keys)

    def full(self) -> bool:
        """Whether so many keys differ that they have to be sent on."""
        if self.size <= self.most:
            return False
        self.merge()
        return self.size > self.most // 2

    def merge(self) -> None:
        if len(self.parts) > 1:
            keys, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.parts = [(keys[first], np.add.reduceat(n, first))] if len(keys) else []
        self.size = sum(len(k) for k, _ in self.parts)

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        keys, n = self.parts[0] if self.parts else (np.empty(0, np.int64), np.empty(0, np.int64))
        self.parts, self.size = [], 0
        return keys, n


def gather(docs: DataFrame) -> DataFrame:
    """(kind, key, n) over docs (text, held): how often each word stands in training documents, and each string of any document; the number of training documents and the bytes of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(keys), ROWS):
                k = keys[a : a + ROWS]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int8)), pa.array(k), pa.array(n[a : a + ROWS])], names=["kind", "key", "n"])

        held, totals = {WORD: _Sums(HELD), STRING: _Sums(HELD)}, np.zeros(2, np.int64)
        for batch in batches:
            apart, at = batch.column("held").to_numpy(zero_copy_only=False), 0
            for part, texts in text_chunks(batch, limit=CHUNK):
                out = apart[at : at + part.num_rows]
                at += part.num_rows
                totals += [int((~out).sum()), sum(map(len, texts))]
                learned = [t for t, h in zip(texts, out, strict=True) if not h]
                if learned:
                    held[WORD].add(word_hashes([t.lower() for t in learned])[0].view(np.int64), True)
                    held[STRING].add(_strings(learned)[0], True)
                if len(learned) < len(texts):
                    held[STRING].add(_strings([t for t, h in zip(texts, out, strict=True) if h])[0], False)
                for kind, sums in held.items():
                    if sums.full():
                        yield from sent(kind, *sums.taken())
        for kind, sums in held.items():
            yield from sent(kind, *sums.taken())
        for kind, n in zip((DOCUMENTS, BYTES), totals, strict=True):
            yield from sent(kind, np.zeros(1, np.int64), np.array([n], np.int64))

    # A task's keys are distinct, so they go out as they are: to merge them before the shuffle as well would find nothing equal.
    return docs.select("text", "held").mapInArrow(run, "kind byte, key long, n long").repartition("key").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def grow(counts: DataFrame, least: int = LEAST, divergence: float = DIVERGENCE, weight: float = WEIGHT) -> DataFrame:
    """(key, p, state, n) from counts (key, n) of strings of DEPTH symbols and the next: the next one's probability in the state that the others lead to, and that state's length."""
    mask = lambda c, d: c.bitwiseAND((1 << 8 * (d + 1)) - 1)
    levels = [counts]
    for d in range(DEPTH - 1, -1, -1):  # each length summed from the next longer one
        levels.insert(0, staged(levels[0].groupBy(mask(F.col("key"), d).alias("key")).agg(F.sum("n").alias("n")), "strings"))
    seen = {r["key"]: r["n"] for r in levels[0].collect()}  # at most 256
    total = sum(seen.values())
    above = counts.sparkSession.createDataFrame([(x, (n + 1) / (total + 256), 0) for x, n in seen.items()], "low long, q double, above int")
    for d in range(1, DEPTH + 1):
        rows = levels[d].withColumns({"low": mask(F.col("key"), d - 1), "context": F.shiftright("key", 8)})
        own = Window.partitionBy("context")
        rows = rows.join(above.select("low", "q", "above"), "low").withColumn("total", F.sum("n").over(own)).withColumn("kinds", F.count(F.when(F.col("n") > 0, 1)).over(own)).withColumn("gain", F.sum(F.when(F.col("n") > 0, F.col("n") * F.log(F.col("n") / F.col("total") / F.col("q"))).otherwise(0.0)).over(own))
        keep = (F.col("total") >= least) & (F.col("gain") >= divergence)
        drawn = weight * F.col("kinds")
        p = F.when(keep, (F.col("n") + drawn * F.col("q")) / (F.col("total") + drawn)).otherwise(F.col("q"))
        above = staged(rows.select(F.col("key").alias("low"), p.alias("q"), F.when(keep, d).otherwise(F.col("above")).alias("above"), "n"), "tree")
    return above.select(F.col("low").alias("key"), F.col("q").alias("p"), F.col("above").alias("state"), "n")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("held", held_out(F.col("id")))
    counts = staged(gather(rows), "counts")
    tree = grow(counts.where(F.col("kind") == STRING).select("key", "n"), LEAST, DIVERGENCE, WEIGHT)
    sums = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("distinct")).collect()}
    number = lambda kind, name: (kind in sums and sums[kind][name]) or 0
    learned = number(DOCUMENTS, "n")
    total, distinct = number(WORD, "n") + learned, number(WORD, "distinct") + (learned > 0)
    blocks = max(1, -(-number(BYTES, "n") // BLOCK))

    words = counts.where(F.col("kind") == WORD).select("kind", "key", "n", F.col("n").cast("double").alias("value"))
    told_strings = tree.select(F.lit(STRING).cast("byte").alias("kind"), "key", "n", F.log10("p").alias("value"))

    def most(known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        top = known.where("n > 0").orderBy(F.desc("n"), "key").limit(FREQUENT).select("key", "value").toArrow()
        order = np.argsort(k := top.column("key").to_numpy())
        return k[order], top.column("value").to_numpy()[order]

    common = spark.sparkContext.broadcast({WORD: most(words), STRING: most(told_strings)})
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int")).repartition(blocks, "block")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, kind, key): the words and strings of each block that are not known everywhere."""
        held: dict[tuple[int, int], _Sums] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for (b, kind), asked in held.items():
                keys = asked.taken()[0]
                for a in range(0, len(keys), ROWS):
                    k = keys[a : a + ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), b, np.int32)), pa.array(np.full(len(k), kind, np.int8)), pa.array(k)], names=["block", "kind", "key"])
            held.clear()

        for batch in batches:
            block = batch.column("block").to_numpy()
            at = 0
            for part, texts in text_chunks(batch, limit=CHUNK):
                own = block[at : at + part.num_rows]
                at += part.num_rows
                for b in np.unique(own).tolist():
                    these = [t for t, x in zip(texts, own, strict=True) if x == b]
                    for kind, keys in ((WORD, word_hashes([t.lower() for t in these])[0].view(np.int64)), (STRING, _strings(these)[0])):
                        keys = np.unique(keys)
                        held.setdefault((b, kind), _Sums(HELD)).add(keys[~_found(common.value[kind][0], keys)[1]], True)
                if any([asked.full() for asked in held.values()]):
                    yield from sent()
        yield from sent()

    asked = dealt.select("id", "text", "held", "block").mapInArrow(ask, "block int, kind byte, key long")
    told = asked.join(words.unionByName(told_strings).drop("n"), ["kind", "key"])
    end = np.log10(learned + 1.0)
    each = np.log10(total + distinct + 1.0)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {}
        kinds, keys, values = (right.column(c).to_numpy() for c in ("kind", "key", "value"))
        for kind, (k, v) in common.value.items():
            k, at = np.unique(np.concatenate([k, keys[kinds == kind]]), return_index=True)
            known[kind] = k, np.concatenate([v, values[kinds == kind]])[at]
        out = []
        for batch in left.combine_chunks().to_batches():
            for part, texts in text_chunks(batch, limit=CHUNK):
                hashes, begin = word_hashes([t.lower() for t in texts])
                at, sure = _found(known[WORD][0], hashes.view(np.int64))
                n = np.zeros(len(hashes))
                n[sure] = known[WORD][1][at[sure]]
                summed = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[begin])
                size = np.diff(begin) + 1
                keys, first = _strings(texts)
                logs = known[STRING][1][np.searchsorted(known[STRING][0], keys)]  # every string is known here
                model = np.add.reduceat(logs, first[:-1])
                out.append(pa.RecordBatch.from_arrays([part.column("id"), part.column("held"), pa.array(size), pa.array(summed(n > 0).astype(np.int64) + (learned > 0)), pa.array(np.full(len(size), total)), pa.array(summed(np.log10(n + 1.0)) + end - size * each), pa.array(model)], names=names))
        return pa.Table.from_batches(out)

    names = [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.select("id", "text", "held", "block").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(answer, schema)


def _found(sorted_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of x would stand in sorted_, and whether it does."""
    if not len(sorted_):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return at, sorted_[at] == x
