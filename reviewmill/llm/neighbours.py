"""Approximate nearest neighbours by a forest of random-projection trees.

The forest's upper planes are fitted on a bounded sample of the vectors (SAMPLE, those of smallest
hash); it indexes every one. Its depth follows from the number of vectors, so that a leaf
holds about LEAF of them at any size: below the planes that the sample can place, planes of random directions
go through the mean of the sample's leaf. A query walks all trees through one priority queue,
nearest planes first, until it has seen about EFFORT * n^(2/3) of n vectors; the vectors of those leaves are
ranked by exact inner products in double precision. The queue takes leaves by the largest distance to a plane
on whose wrong side they stand, so the leaves that it takes are found for many queries at once, as the
smallest of these distances. The sample's vectors in a query's leaves give it a floor: what scores less
than their K + 1 best can't be among the nearest. Inner products become angles by one
more coordinate that gives every indexed vector the same length.

Equal vectors are indexed once, as a class with its K + 1 smallest ids: no query can use
more of them. Adjacent leaves form a cell of at most CELL bytes of vectors, or parts of it. A query goes to a cell
once, with a bit for each leaf that it takes there, and at most ASKED bytes of queries go together: neither rows nor
memory follow the number of leaves, and neither a popular leaf nor a popular vector ends up in one task.

Defined results: vectors that are null, zero, hold null or non-finite components, or
whose dimension isn't the commonest one take no part, as queries or candidates; equal
scores rank by smaller id; rows that repeat an id are one candidate at their best score;
fewer candidates than K are all returned; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

K = 20
TREES = 8
#: Vectors in a leaf, about.
LEAF = 64
#: A query sees this times n^(2/3) of n vectors, counted once for each tree. On vectors without any clusters in 64 dimensions this finds over
#: 0.9 of the true neighbours at 50,000 vectors and at 400,000; clustered vectors need less.
EFFORT = 26
SAMPLE = 20_000
#: Sample vectors in a leaf of the upper trees, at least; so their size is bounded by the sample's.
LEAST = 12
#: Bytes of the vectors and of the queries that a task takes together, at most.
CELL, ASKED = 80 << 20, 32 << 20
#: Cells of a tree, as 2^SPREAD at least.
SPREAD = 2
#: Elements of an array that is made for some rows at a time, at most.
TILE = 1 << 21


class Forest:
    """Complete binary trees: planes of node i lead to 2i + 1 (below) and 2i + 2; the leaves of the upper trees have ``more`` levels below them."""

    def __init__(self, sample: np.ndarray, reach: float, depth: int, trees: int = TREES, seed: int = 11):
        r = np.random.default_rng(seed)
        self.sample, self.reach, self.depth, self.trees = sample, reach, depth, trees
        x = self.lifted(sample)
        self.top = top = min(depth, max(0, (len(x) // LEAST).bit_length() - 1))
        self.more = depth - top
        self.normals = np.zeros((trees, (1 << top) - 1, x.shape[1]), np.float32)
        self.cuts = np.zeros((trees, (1 << top) - 1), np.float32)
        self.means = np.zeros((trees, 1 << top, x.shape[1]), np.float32)
        self.below = r.normal(size=(trees, self.more, x.shape[1])).astype(np.float32)
        self.below /= np.maximum(np.linalg.norm(self.below, axis=2, keepdims=True), 1e-9)
        for t in range(trees):
            own = [np.arange(len(x))]
            for i in range((1 << top) - 1):
                rows = own[i]
                n = r.normal(size=x.shape[1])
                if len(rows) >= 2:  # between two of its vectors, so that planes follow the data
                    a, b = x[r.choice(rows, 2, replace=False)]
                    if np.abs(a - b).max() > 0:
                        n = (a - b).astype(float)
                n /= np.linalg.norm(n) or 1.0
                side = x[rows] @ n if len(rows) else np.zeros(0)
                cut = float(np.median(side)) if len(rows) else 0.0
                self.normals[t, i], self.cuts[t, i] = n, cut
                own += [rows[side <= cut], rows[side > cut]]
            for j, rows in enumerate(own[(1 << top) - 1 :]):
                if len(rows):
                    self.means[t, j] = x[rows].mean(0)
        #: Where the planes below the upper trees lie along their directions: (tree, level, leaf of the upper tree).
        self.lower = np.einsum("tld,tud->tlu", self.below, self.means)
        self.own = self.leaves(sample)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.reach**2 - (x.astype(float) ** 2).sum(1)))
        return np.concatenate([x, rest[:, None]], 1).astype(np.float32)

    def leaves(self, x: np.ndarray, depth: int | None = None) -> np.ndarray:
        """(vector, tree) -> number of its leaf among all; with depth, of the node there among all of that depth."""
        depth = self.depth if depth is None else depth
        top = min(self.top, depth)
        x = self.lifted(x)
        out = np.zeros((len(x), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(top):
                node = 2 * node + 1 + ((x * self.normals[t, node]).sum(1) > self.cuts[t, node])
            leaf = upper = node - ((1 << top) - 1)
            for n in self.below[t, : depth - top]:
                leaf = 2 * leaf + (((x - self.means[t, upper]) @ n) > 0)
            out[:, t] = (t << depth) + leaf
        return out

    def distances(self, q: np.ndarray) -> np.ndarray:
        """(query, leaf among all) -> the largest distance to a plane on whose wrong side the leaf stands; -inf for each tree's own leaf."""
        q = np.concatenate([q, np.zeros((len(q), 1))], 1).astype(np.float32)
        upper = (q @ self.normals.reshape(-1, q.shape[1]).T).reshape(len(q), self.trees, -1) - self.cuts
        below = (q @ self.below.reshape(-1, q.shape[1]).T).reshape(len(q), self.trees, -1)
        far = np.full((len(q), self.trees, 1, 1), -np.inf, np.float32)
        for k in range(self.depth):
            side = (upper[:, :, (1 << k) - 1 : (2 << k) - 1] if k < self.top else below[:, :, k - self.top, None] - self.lower[:, k - self.top])[..., None]
            above, far = side > 0, far.reshape(*side.shape[:3], -1)
            both = np.empty((*far.shape, 2), np.float32)
            np.maximum(far, np.where(above, side, -np.inf), out=both[..., 0])
            np.maximum(far, np.where(above, -np.inf, -side), out=both[..., 1])
            far = both
        return far.reshape(len(q), -1)

    def search(self, q: np.ndarray, wanted: int) -> np.ndarray:
        """(query, leaf among all) -> whether the query takes it: the first of a queue that all trees share, the smallest distance to the wrong side of a plane first."""
        if not self.depth:  # all vectors are in every tree's one leaf
            return np.repeat(np.arange(self.trees)[None] == 0, len(q), 0)
        far = self.distances(q)
        if wanted >= far.shape[1]:
            return np.ones(far.shape, bool)
        taken = np.zeros(far.shape, bool)
        np.put_along_axis(taken, np.argpartition(far, wanted - 1, axis=1)[:, :wanted], True, 1)
        return taken

    @functools.cached_property
    def exact(self) -> np.ndarray:
        return self.sample.astype(float)

    def floors(self, q: np.ndarray, taken: np.ndarray, k: int) -> np.ndarray:
        """The k-th best score among the sample's vectors in the leaves that a query takes, -inf if there are fewer."""
        if len(self.sample) < k:
            return np.full(len(q), -np.inf)
        shown = taken[:, self.own[:, 0]]
        for t in range(1, self.trees):
            shown |= taken[:, self.own[:, t]]
        score = np.where(shown, q.astype(float) @ self.exact.T, -np.inf)
        return _lowered(np.partition(score, len(self.sample) - k, axis=1)[:, len(self.sample) - k], q, self.reach)


def _lowered(score: np.ndarray, q: np.ndarray, reach: float) -> np.ndarray:
    """Products of the same vectors may differ in the last bits from one block to another."""
    with np.errstate(all="ignore"):
        out = score - 1e-12 * reach * np.linalg.norm(q.astype(float), axis=1)
    return np.where(np.isnan(out), -np.inf, out)


def _usable(v: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return v.isNotNull() & F.coalesce(F.forall(v, finite), F.lit(False)) & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _runs(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by part, and where in it each part begins, with the end."""
    order = np.argsort(part, kind="stable")
    return order, np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(part))


def _packed(x: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A row's bytes for each run of x."""
    at = (ends * (x[:1].nbytes if len(x) else 1)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(x))])


def _unpacked(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), kind) for chunk in column.chunks for x in chunk])


def _listed(column: pa.Array, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), column)


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """(h1, h2, cid, ids, v): each different vector with its k + 1 smallest ids; cid is the first."""
    w = Window.partitionBy("h1", "h2").orderBy("id")
    return (
        rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)  # pruned before the shuffle too
        .groupBy("h1", "h2").agg(F.array_sort(F.collect_set("id")).alias("ids"), F.first("v").alias("v")).withColumn("cid", F.col("ids")[0])
    )


def nearest(table: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, trees: int = TREES, leaf: int = LEAF, effort: float = EFFORT, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of table where queries holds, its k nearest other rows."""
    kinds = dict(table.dtypes)
    kind = kinds[id_col]
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), queries.alias("asks")).where(_usable(F.col("v")) & F.col("id").isNotNull()).withColumn("n", F.size("v"))
    sizes = rows.groupBy("n").count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.where(F.col("n") == (sizes[0]["n"] if sizes else 0)).withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    classes = staged(classes_of(rows, k), "classes")
    asking = staged(rows.where("asks").select("id", "h1", "h2").distinct().join(classes.select("h1", "h2", "cid"), ["h1", "h2"]).select(F.col("id").alias("query_id"), "cid"), "asking")
    stats = classes.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("m")).first()
    number, reach = stats["n"], float(stats["m"] or 0.0) ** 0.5
    some = classes.orderBy(F.xxhash64("cid"), "cid").limit(sample).select("v").toArrow().column("v").combine_chunks()
    some = some.combine_chunks() if isinstance(some, pa.ChunkedArray) else some
    x = _matrix(some)
    depth = (max(1, -(-number // leaf)) - 1).bit_length()
    leaves = max(trees, math.ceil(effort * number ** (2 / 3) * (1 << depth) / max(1, number)))
    # A cell is a node of a tree with all leaves below it, so that a query and a vector meet there once.
    row, dtype = max(1, x.shape[1] * x.itemsize), x.dtype
    level = min(depth, max(SPREAD, math.ceil(math.log2(max(1, 2 * number * row / CELL)))))
    below = depth - level
    wide = max(trees << depth, len(x), (trees << level) * row // 8)
    forest = table.sparkSession.sparkContext.broadcast(Forest(x, reach, depth, trees))
    slices = lambda b, width: (b.slice(i, n) for n in [max(1, TILE // max(1, width))] for i in range(0, b.num_rows, n))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(trees << level, np.int64)
        for b in (s for b in batches for s in slices(b, row)):
            total += np.bincount(forest.value.leaves(_matrix(b.column("v")), level).ravel(), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["cell", "n"])

    cut = np.ones(trees << level, np.int64)  # parts of each cell
    for cell, n in classes.select("v").mapInArrow(fill, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        cut[cell] = max(1, -(-n * row // CELL))
    first = np.cumsum(cut) - cut  # a cell's first part
    crowds = max(1, -(-asking.select("cid").distinct().count() * row // ASKED))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for b in batches for s in slices(b, row * trees)):
            v = _matrix(b.column("v"))
            at = forest.value.leaves(v).ravel()
            cell, of = at >> below, np.repeat(np.arange(len(v)), trees)
            part = first[cell] + b.column("h").to_numpy()[of] % cut[cell]
            order, ends = _runs(part)
            at, of, part = at[order] & ((1 << below) - 1), of[order], part[order[ends[:-1]]]
            rest = [_packed(at.astype(np.int32), ends), _listed(b.column("cid").take(pa.array(of)), ends), _packed(v[of], ends)]
            for crowd in range(crowds):
                yield pa.RecordBatch.from_arrays([pa.array(part * crowds + crowd), *rest], names=["part", "leaf", "cid", "v"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for b in batches for s in slices(b, wide)):
            v = _matrix(b.column("v"))
            taken = forest.value.search(v, leaves)
            floor = forest.value.floors(v, taken, k + 1)
            taken = taken.reshape(len(v), len(cut), -1)
            of, cell = np.nonzero(taken.any(2))
            of, cell, start = (np.repeat(y, cut[cell]) for y in (of, cell, np.cumsum(cut[cell]) - cut[cell]))
            part = (first[cell] + np.arange(len(cell)) - start) * crowds + b.column("h").to_numpy()[of] % crowds
            order, ends = _runs(part)
            of, cell, part = of[order], cell[order], part[order[ends[:-1]]]
            bits = [pa.compress(np.packbits(taken[of[i:j], cell[i:j]], axis=1).tobytes(), "zstd", asbytes=True) for i, j in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(bits, pa.binary()), _listed(b.column("cid").take(pa.array(of)), ends), _packed(v[of], ends), _packed(floor[of], ends)], names=["part", "leaves", "cid", "v", "floor"])

    hashed = classes.select("cid", "v", F.pmod(F.xxhash64("cid"), F.lit(1 << 30)).alias("h"))
    members = hashed.mapInArrow(index, f"part long, leaf binary, cid array<{kind}>, v binary")
    seekers = hashed.join(asking.select("cid").distinct(), "cid", "left_semi").mapInArrow(search, f"part long, leaves binary, cid array<{kind}>, v binary, floor binary")

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        """The k + 1 best that each query of a part meets in its leaves there."""
        qid, cid = (pa.compute.list_flatten(t.column("cid")).combine_chunks() for t in (left, right))
        if not len(qid) or not len(cid):
            return pa.Table.from_arrays([qid.slice(0, 0), _listed(pa.StructArray.from_arrays([cid.slice(0, 0), pa.array([], pa.float64())], ["c", "score"]), np.zeros(1))], names=["q", "near"])
        order = np.argsort(leaf := _unpacked(right.column("leaf"), np.dtype(np.int32)), kind="stable")
        has = np.searchsorted(leaf[order], np.arange((1 << below) + 1))
        b, to_cid = _unpacked(right.column("v"), dtype).reshape(len(cid), -1)[order], pa.compute.rank(cid).to_numpy()[order]
        a, floor = _unpacked(left.column("v"), dtype).reshape(len(qid), -1), _unpacked(left.column("floor"), np.dtype(float))
        found = [(np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0))]
        held = 0

        def blocks() -> Iterator[tuple[int, np.ndarray]]:
            """Adjacent queries that take about TILE leaves together: the first one's place, and whether each takes a leaf, by leaf."""
            start, some, seen, width = 0, [], 0, -(-(1 << below) // 8)
            for packed, n in zip(left.column("leaves").to_pylist(), pa.compute.list_value_length(left.column("cid")).to_pylist(), strict=True):
                some.append(np.frombuffer(pa.decompress(packed, n * width, "zstd"), np.uint8).reshape(n, width))
                seen += max(int(np.bitwise_count(some[-1]).sum()), n * width // 2)
                if seen >= TILE:
                    yield start, np.unpackbits(np.concatenate(some), axis=1, count=1 << below).T
                    start, some, seen = start + sum(map(len, some)), [], 0
            if some:
                yield start, np.unpackbits(np.concatenate(some), axis=1, count=1 << below).T

        def settle() -> None:
            """Only the k + 1 best of each query stay; what comes later has to reach the last of them."""
            nonlocal found, held
            rows, cols, scores = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((to_cid[cols], -scores, rows))
            rows, cols, scores = rows[order], cols[order], scores[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            last = place == k
            floor[rows[last]] = np.maximum(floor[rows[last]], _lowered(scores[last], a[rows[last]], reach))
            found, held = [(rows[place <= k], cols[place <= k], scores[place <= k])], 0

        for start, bits in blocks():
            some = a[start : start + bits.shape[1]].astype(float)
            of, asks = np.nonzero(np.ascontiguousarray(bits))
            ends = np.searchsorted(of, np.arange((1 << below) + 1))
            for f in np.flatnonzero((np.diff(ends) > 0) & (np.diff(has) > 0)).tolist():
                for i in range(has[f], has[f + 1], 4096):
                    to = b[i : min(i + 4096, has[f + 1])].astype(float).T
                    step = max(1, TILE // to.shape[1])
                    for j in range(ends[f], ends[f + 1], step):
                        at = asks[j : min(j + step, ends[f + 1])]
                        score, least = some[at] @ to, floor[at + start]
                        if to.shape[1] > k + 1 and np.isneginf(least).any():
                            least = np.maximum(least, np.partition(score, to.shape[1] - k - 1, axis=1)[:, to.shape[1] - k - 1])  # ties at the edge stay in sight
                        n, m = np.nonzero(score >= least[:, None])
                        found.append(((at[n] + start).astype(np.int32), (m + i).astype(np.int32), score[n, m]))
                        held += len(n)
                        if held > TILE:
                            settle()
        settle()
        rows, cols, scores = found[0]
        has = np.flatnonzero(np.diff(rows, prepend=-1))
        near = pa.StructArray.from_arrays([cid.take(pa.array(order[cols])), pa.array(scores)], ["c", "score"])
        return pa.Table.from_arrays([qid.take(pa.array(rows[has])), _listed(near, np.append(has, len(rows)))], names=["q", "near"])

    pairs = seekers.groupBy("part").cogroup(members.groupBy("part")).applyInArrow(rank, f"q {kind}, near array<struct<c {kind}, score double>>")
    # A candidate that is met in several leaves may differ in the last bit there: one value for it.
    found = pairs.repartition("q").select("q", F.inline("near")).groupBy("q", "c").agg(F.max("score").alias("score"))
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "c"))).where(F.col("r") <= k + 1)
    ids = best.join(classes.select(F.col("cid").alias("c"), "ids"), "c").select("q", "score", F.explode("ids").alias("vec_id")).groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    lists = ids.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))
    own = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return asking.join(lists, asking["cid"] == lists["q"]).select("query_id", F.posexplode(own).alias("p", "x")).select("query_id", (F.col("p") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
