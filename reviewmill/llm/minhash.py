"""Near-duplicates by a MinHash LSH forest, links confirmed on whole shingle sets.

Documents with equal shingle sets form a class; its smallest doc_id stands for it.
TREES orders of the classes are kept, each sorted by its own DEPTH signature values. What
adjacent classes have in common (their longest common prefix) divides an order into
regions: runs that share the first LEAST values, and where such a run has more than
REGION classes, as many more values as bring its parts down to that; so the depth
follows each region's density. What shares all DEPTH values is cut into runs of REGION
classes. Each part of a divided region also gets the region's first class, so that the
parts stay joined. Neighbours inside a region are compared on signatures: round one
confirms the edges of a maximum spanning forest of the promising pairs; round two brings
the whole sets of members whose components still differ to their regions and confirms
what joins them there. In round two a region of more than REGION classes is read whole, at
depth LEAST: its classes are dealt into blocks, and each pair of blocks is a region of
its own, but for two blocks of one component, which have nothing left to join. So each
promising pair that agrees on LEAST values of an order is seen; a group of m copies costs
about m confirmations and never sends out m squared pairs.

Defined results: a null, empty or blank text has no shingles and links with nothing;
rows of one doc_id are one document for links; a row with a null doc_id takes no part
in links, its component_id is null and it is kept; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_chunks
from .components import connected_components
from .shingles import mix, shingle_sets

WORDS = 5
PERCENT = 75
TREES, DEPTH, LEAST = 16, 6, 2
REGION = 512
#: Rows of a sorted order whose common prefixes are in memory at a time.
RUN = 1 << 19
#: A block of a large region has up to this many times REGION classes: signatures alone are compared there.
WIDE = 8
#: Pairs whose signatures agree on at least this share are confirmed; four standard errors below 0.75.
PROMISING = 0.57
_K = TREES * DEPTH
_A = np.random.default_rng(7).integers(1, 2**63, _K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(s: np.ndarray) -> np.ndarray:
    """The _K least hashes of a non-empty set, 32 bits each."""
    out = np.full(_K, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(s), 2048):
            h = (s[at : at + 2048, None] * _A[None, :]) >> np.uint64(32)
            np.minimum(out, h.min(0).astype(np.uint32), out=out)
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, h1, h2, sig): 128 bits of the set and its signature (null if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                sets = shingle_sets(texts, WORDS)
                with np.errstate(over="ignore"):
                    h = np.array([[mix(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(s * _A[0]), initial=np.uint64(len(s)))] for s in sets], np.uint64).view(np.int64)
                sigs = [signature(s).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(sigs, pa.binary())], names=["id", "n_shingles", "h1", "h2", "sig"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_shingles long, h1 long, h2 long, sig binary")


def orders(reps: DataFrame) -> DataFrame:
    """(key, id): each class once in each tree, a key being the tree and its DEPTH values, big-endian; sorted across the partitions."""
    kind = dict(reps.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).astype(">u4")
            keys = np.empty((n, TREES, 1 + 4 * DEPTH), np.uint8)
            keys[:, :, 0] = np.arange(TREES)
            keys[:, :, 1:] = v.view(np.uint8).reshape(n, TREES, 4 * DEPTH)
            keys = pa.Array.from_buffers(pa.binary(), n * TREES, [None, pa.py_buffer(np.arange(n * TREES + 1, dtype=np.int32) * keys.shape[2]), pa.py_buffer(keys)])
            yield pa.RecordBatch.from_arrays([keys, pa.compute.take(batch.column("id"), pa.array(np.repeat(np.arange(n), TREES)))], names=["key", "id"])

    rows = reps.select("id", "sig").mapInArrow(run, f"key binary, id {kind}").withColumn("h", F.xxhash64("id"))
    return rows.repartitionByRange("key", "h").sortWithinPartitions("key", "h").select("key", "id")


_PREFIX = [f"p{d}" for d in range(LEAST, DEPTH + 1)]
_SIZE = [f"n{d}" for d in range(LEAST, DEPTH + 1)]


def depths(keys: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
    """For the rows of a part of an order (numbers of tree and values): hashes of their prefixes, sizes of the runs that share them, whether such a run touches an end of the part, and the depth.

    The depth is the least at which the run has at most limit rows; DEPTH + 1 if none has; 0 if that takes what lies beyond the ends.
    """
    m = len(keys)
    differ = keys[1:] != keys[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), keys.shape[1])  # values in common with the row before, the tree included
    hashes, sizes, edge = [], [], []
    with np.errstate(over="ignore"):
        h = mix(keys[:, 0].astype(np.uint64) + np.uint64(1))
        for d in range(1, DEPTH + 1):
            h = mix(h * _A[1] + keys[:, d].astype(np.uint64))
            if d < LEAST:
                continue
            start = np.flatnonzero(np.concatenate([[True], shared <= d]))
            of = np.cumsum(np.concatenate([[True], shared <= d])) - 1
            sizes.append(np.diff(np.append(start, m))[of])
            edge.append((of == 0) | (of == of[-1]))
            hashes.append(h)
    depth, open_ = np.full(m, DEPTH + 1), np.ones(m, bool)
    for i in range(len(sizes)):
        fits = open_ & (sizes[i] <= limit)
        depth[fits] = np.where(edge[i][fits], 0, LEAST + i)
        open_ &= ~fits
    return np.stack(hashes), np.stack(sizes), np.stack(edge), depth


def regions(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(region, id) with two to about REGION classes each, and (region, id) of the whole regions of depth LEAST of more; regions of the same classes come once."""
    kind, limit, most = dict(reps.dtypes)["id"], REGION, RUN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, table in enumerate(_runs(batches, most)):
            n = table.num_rows
            raw = np.frombuffer(b"".join(table.column("key").to_pylist()), np.uint8).reshape(n, -1)
            keys = np.concatenate([raw[:, :1].astype(np.uint32), np.ascontiguousarray(raw[:, 1:]).view(">u4").astype(np.uint32)], 1)
            hashes, sizes, edge, depth = depths(keys, limit)
            own = np.where(depth > DEPTH, hashes[-1], hashes[np.clip(depth - LEAST, 0, DEPTH - LEAST), np.arange(n)])
            deep = np.flatnonzero(depth > DEPTH)
            if len(deep):  # runs of REGION rows of those that share all values
                with np.errstate(over="ignore"):
                    own[deep] = mix(own[deep] + np.uint64(TaskContext.get().partitionId() << 32 | k) * _A[2] + (deep // limit).astype(np.uint64))
            crowded = sizes[0] > limit
            keep = np.flatnonzero(crowded | (depth == 0) | (sizes[0] > 1))
            out = [pa.compute.take(table.column("id").combine_chunks(), pa.array(keep)), pa.array(own[keep].view(np.int64)), pa.array(depth[keep].astype(np.int32)), pa.array(crowded[keep])]
            yield pa.RecordBatch.from_arrays([*out, *(pa.array(x[keep].view(np.int64)) for x in hashes), *(pa.array(x[keep].astype(np.int64)) for x in sizes), pa.array(np.zeros(len(keep), bool))], names=names)
            # The runs at the two ends, whose other parts may lie beyond them.
            ends = [(hashes[d, i].view(np.int64), sizes[d, i]) for d in range(len(sizes)) for i in ([0] if sizes[d, 0] == n else [0, n - 1])]
            none = pa.array([None] * len(ends), out[0].type)
            p, c = (pa.array(np.array(x, np.int64)) for x in zip(*ends, strict=True))
            yield pa.RecordBatch.from_arrays([none, p, pa.array(np.zeros(len(ends), np.int32)), pa.array(np.zeros(len(ends), bool)), *[p] * len(_PREFIX), *[c] * len(_SIZE), pa.array(np.ones(len(ends), bool))], names=names)

    names = ["id", "region", "depth", "crowded", *_PREFIX, *_SIZE, "is_end"]
    schema = f"id {kind}, region long, depth int, crowded boolean, " + ", ".join(f"{x} long" for x in [*_PREFIX, *_SIZE]) + ", is_end boolean"
    rows = staged(orders(reps).mapInArrow(run, schema), "orders")
    # What depends on rows beyond an end: sizes over all parts.
    ends = rows.where("is_end").groupBy(F.col("region").alias("p")).agg(F.sum(_SIZE[0]).alias("all"))
    open_ = rows.where("NOT is_end AND depth = 0")
    each = open_.select("id", F.col(_PREFIX[0]).alias("top"), F.explode(F.array(*(F.struct(F.lit(LEAST + i).alias("d"), F.col(p).alias("p"), F.col(n).alias("n")) for i, (p, n) in enumerate(zip(_PREFIX, _SIZE, strict=True))))).alias("x")).select("id", "top", "x.*")
    each = each.join(ends, "p", "left").withColumn("n", F.coalesce("all", "n"))
    solved = each.groupBy("id", "top").agg(F.max(F.when(F.col("d") == LEAST, F.col("n"))).alias("n0"), F.min(F.when(F.col("n") <= limit, F.struct("d", "p"))).alias("best"), F.max(F.when(F.col("d") == DEPTH, F.struct("p", "n"))).alias("last"))
    region = F.coalesce(F.col("best.p"), F.xxhash64(F.col("last.p"), F.pmod(F.xxhash64("id"), F.ceil(F.col("last.n") / limit))))
    solved = solved.select("id", region.alias("region"), "top", (F.col("n0") > limit).alias("crowded"))
    known = rows.where("NOT is_end AND depth > 0").select("id", "region", F.col(_PREFIX[0]).alias("top"), "crowded")
    every = staged(known.union(solved), "regions")
    large = every.where("crowded")
    first = staged(large.groupBy("top").agg(F.min("id").alias("first")), "firsts")
    joined = large.select("top", "region").distinct().join(first, "top").select("region", F.col("first").alias("id"))
    parts = every.select("region", "id").union(joined).distinct()
    return _once(staged(parts, "parts")), _once(large.select(F.col("top").alias("region"), "id"))


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows in order, about most at a time."""
    held, size = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most - size)
            batch = batch.slice(part.num_rows)
            held.append(part)
            size += part.num_rows
            if size >= most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def _once(every: DataFrame) -> DataFrame:
    same = every.groupBy("region").agg(F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("x")).where("n > 1")
    return every.join(same.groupBy("n", "s", "x").agg(F.min("region").alias("region")).select("region"), "region", "left_semi")


def block_pairs(rows: DataFrame) -> DataFrame:
    """(region, id, root, side): each large region's pairs of blocks as regions; rows are (region, id, root), staged.

    A component of more members of a region than a block holds has blocks of its own, which are not paired with each other.
    A pair of two different blocks has both sides and is compared across them only.
    """
    sizes = rows.groupBy("region", "root").agg(F.count("*").alias("n")).withColumn("own", F.col("n") > WIDE * REGION)
    open_ = sizes.groupBy("region").agg(F.count("*").alias("roots"), F.sum(F.when(F.col("own"), 0).otherwise(F.col("n"))).alias("rest")).where("roots > 1")
    parts = F.ceil(F.when(F.col("own"), F.col("n")).otherwise(F.col("rest")) / (WIDE * REGION))
    dealt = rows.join(sizes, ["region", "root"]).join(open_, "region").select("region", "id", "root", F.when(F.col("own"), F.col("root")).alias("of"), F.pmod(F.xxhash64("id"), parts).alias("salt"))
    dealt = staged(dealt.select("region", "id", "root", "of", F.xxhash64(F.col("of").isNull(), "of", "salt").alias("block")), "blocks")
    blocks = dealt.select("region", "block", "of").distinct()
    two = blocks.withColumnsRenamed({"block": "x", "of": "of_x"}).join(blocks.withColumnsRenamed({"block": "y", "of": "of_y"}), "region")
    two = two.where("x <= y AND (of_x IS NULL OR of_y IS NULL OR of_x <> of_y)").select("region", "x", "y", F.xxhash64("region", "x", "y").alias("pair"))
    left = dealt.join(two.withColumnRenamed("x", "block"), ["region", "block"]).withColumn("side", F.lit(0))
    right = dealt.join(two.where("x < y").withColumnRenamed("y", "block"), ["region", "block"]).withColumn("side", F.lit(1))
    return left.select(F.col("pair").alias("region"), "id", "root", "side").union(right.select("pair", "id", "root", "side"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Each region's rows, from batches sorted by region; a region is bounded, so what is carried over is too."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])]).combine_chunks()
        if not t.num_rows:
            continue
        r = t.column("region").to_numpy()
        cuts = [0, *(np.flatnonzero(r[1:] != r[:-1]) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield t.slice(a, b - a)
        rest = t.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _alike(sig: np.ndarray, side: np.ndarray | None = None, code: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The promising pairs of a region, the most alike first; only those across its sides if it has two, and of different codes."""
    left, right, score = [], [], []
    far = None if side is None or side.min() == side.max() else np.flatnonzero(side != side[0])
    other = None if far is None else sig[far]
    for i in range(len(sig) - 1) if far is None else np.flatnonzero(side == side[0]).tolist():
        same = ((sig[i + 1 :] if far is None else other) == sig[i]).sum(1)
        at = np.flatnonzero(same >= PROMISING * _K)
        to = at + i + 1 if far is None else far[at]
        if code is not None:
            at, to = at[code[to] != code[i]], to[code[to] != code[i]]
        left.append(np.full(len(at), i))
        right.append(to)
        score.append(same[at])
    order = np.argsort(-np.concatenate(score), kind="stable")
    return np.concatenate(left)[order], np.concatenate(right)[order]


def _signatures(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(t.num_rows, _K)


def spanning_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): a maximum spanning forest of the promising pairs of each region; rows are (region, id, sig)."""
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _members(batches):
            if t.num_rows < 2:
                continue
            left, right = _alike(_signatures(t))
            parent, kept = list(range(t.num_rows)), []
            for i, j in zip(left.tolist(), right.tolist(), strict=True):
                x, y = _root(parent, i), _root(parent, j)
                if x != y:
                    parent[x] = y
                    kept.append((i, j))
            if kept:
                ids = t.column("id").combine_chunks()
                yield pa.RecordBatch.from_arrays([ids.take(pa.array([k[0] for k in kept])), ids.take(pa.array([k[1] for k in kept]))], names=["a", "b"])

    pairs = rows.repartition("region").sortWithinPartitions("region").mapInArrow(run, f"a {kind}, b {kind}")
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def unsettled(rows: DataFrame) -> DataFrame:
    """(region, id, sig, root, side) of the members that have a promising pair with another root; rows likewise. Many members come in pairs of parts, as whole sets are brought to them."""

    limit = REGION

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _members(batches):
            roots = t.column("root").to_pylist()
            if len(set(roots)) < 2:
                continue
            code = {r: k for k, r in enumerate(dict.fromkeys(roots))}
            left, right = _alike(_signatures(t), t.column("side").to_numpy(), np.array([code[r] for r in roots]))
            at, of = np.unique(np.concatenate([left, right]), return_inverse=True)
            if 0 < len(at) <= 2 * limit:
                yield from t.take(pa.array(at)).combine_chunks().to_batches()
            elif len(at):
                part, n = of // limit, len(left)
                for a, b in np.unique(np.sort(np.stack([part[:n], part[n:]], 1), 1), axis=0).tolist():
                    mine = np.concatenate([at[k * limit : (k + 1) * limit] for k in sorted({a, b})])
                    side = (np.arange(len(mine)) >= limit).astype(np.int32)
                    with np.errstate(over="ignore"):
                        name = mix(mix(t.column("region").to_numpy()[:1].view(np.uint64) + np.uint64(a + 1)) + np.uint64(b + 1)).view(np.int64)
                    got = t.take(pa.array(mine)).combine_chunks()
                    columns = [pa.array(np.repeat(name, len(mine))), got.column("id"), got.column("sig"), got.column("root"), pa.array(side)]
                    yield from pa.Table.from_arrays(columns, schema=t.schema).to_batches()

    kinds = dict(rows.dtypes)
    columns = rows.select("region", "id", "sig", "root", "side")
    return columns.repartition("region").sortWithinPartitions("region").mapInArrow(run, f"region long, id {kinds['id']}, sig binary, root {kinds['id']}, side int")


def settled(rows: DataFrame) -> DataFrame:
    """(a, b): links, confirmed on whole sets, that join members of different roots; rows are (region, id, sig, root, side, words).

    A pair that is joined already is not compared, so a region yields fewer links than it has members.
    """
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _members(batches):
            if t.num_rows < 2:
                continue
            roots, first = t.column("root").to_pylist(), {}
            parent = [first.setdefault(r, i) for i, r in enumerate(roots)]
            sets = [np.frombuffer(w, np.uint64) for w in t.column("words").to_pylist()]
            left, right = _alike(_signatures(t), t.column("side").to_numpy())
            kept = []
            for i, j in zip(left.tolist(), right.tolist(), strict=True):
                x, y = _root(parent, i), _root(parent, j)
                if x != y and _linked(sets[i], sets[j]):
                    parent[x] = y
                    kept.append((i, j))
            if kept:
                ids = t.column("id").combine_chunks()
                yield pa.RecordBatch.from_arrays([ids.take(pa.array([k[0] for k in kept])), ids.take(pa.array([k[1] for k in kept]))], names=["a", "b"])

    return rows.repartition("region").sortWithinPartitions("region").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * intersection >= PERCENT * union, of two sorted sets."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if not len(small) or 100 * len(small) < PERCENT * len(large):
        return False
    both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def sets_of(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, words): the whole shingle sets of the named documents, as sorted 64-bit hashes."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in shingle_sets(texts, WORDS)], pa.binary())], names=["id", "words"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, "id", "left_semi")
    return rows.mapInArrow(run, f"id {kind}, words binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets have 100 * intersection >= PERCENT * union."""
    kind = dict(pairs.dtypes)["a"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ([np.frombuffer(w, np.uint64) for w in batch.column(c).to_pylist()] for c in "xy")
            ok = [_linked(x, y) for x, y in zip(*sets, strict=True)]
            out = batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
            if out.num_rows:
                yield out

    rows = pairs.join(sets.select(F.col("id").alias("a"), F.col("words").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("words").alias("y")), "b")
    return rows.select("a", "b", "x", "y").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (the smallest id reachable by links) and kept (id = component_id)."""
    all_rows = staged(signatures(docs, id_col, text_col), "signatures")
    linked = all_rows.where("n_shingles > 0 AND id IS NOT NULL")
    classes = linked.groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    members = staged(linked.select("id", "h1", "h2").join(classes, ["h1", "h2"]).select("id", "rep").distinct(), "classes")
    reps = staged(linked.join(members.where("id = rep").select("id"), "id", "left_semi").select("id", "sig").dropDuplicates(["id"]), "representatives")
    every, crowded = regions(reps)
    small = _bytes_of(reps)
    near = staged(every.join(small, "id"), "region-members")

    first = staged(spanning_pairs(near), "pairs")
    ids = first.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = staged(sets_of(docs, ids, id_col, text_col), "sets")
    links = staged(confirmed(first, sets), "links")
    roots = connected_components(links)
    # Round two, for the members of regions by the component they have reached, and for the large regions whole.
    labels = roots.withColumnsRenamed({"node": "id"})
    root = F.coalesce("root", "id")
    labelled = near.join(labels, "id", "left").withColumns({"root": root, "side": F.lit(0)})
    open_ = staged(unsettled(labelled), "unsettled")
    crowded = staged(crowded.join(labels, "id", "left").select("region", "id", root.alias("root")), "crowded-regions")
    if not crowded.isEmpty():
        open_ = open_.union(staged(unsettled(block_pairs(crowded).join(small, "id")), "unsettled"))
        # Who has a promising pair in the small regions has its set by now; who has one only in a large region may not.
        late = staged(open_.select("id").distinct().join(ids, "id", "left_anti"), "late")
        if not late.isEmpty():
            sets = sets.union(staged(sets_of(docs, late, id_col, text_col), "sets"))
    more = staged(settled(open_.join(sets, "id")), "links")
    if not more.isEmpty():
        roots = connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    # Rows of one id are one document, so an id may stand in several classes.
    own = members.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    if not members.groupBy("id").count().where("count > 1").isEmpty():
        roots = connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(own))
    final = members.groupBy("id").agg(F.min("rep").alias("rep")).join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select("id", F.coalesce("root", "rep").alias("component_id"))
    out = all_rows.select("id", "n_shingles").join(final, "id", "left")
    whole = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", whole.alias("component_id"), F.coalesce(F.col("id") == whole, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component, the one of smallest id, and one row of each id; rows without an id stay."""
    kept = near_duplicates(docs, id_col, text_col).where(F.col("kept") & F.col(id_col).isNotNull()).select(id_col)
    one = docs.join(kept, id_col, "left_semi").dropDuplicates([id_col])
    return one.unionByName(docs.where(F.col(id_col).isNull())).select(*docs.columns)


def _bytes_of(reps: DataFrame) -> DataFrame:
    """(id, sig) with one byte of each 32-bit value: enough to compare by, and a quarter of the size."""
    kind = dict(reps.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([np.frombuffer(s, np.uint32).astype(np.uint8).tobytes() for s in batch.column("sig").to_pylist()], pa.binary())], names=["id", "sig"])

    return reps.mapInArrow(run, f"id {kind}, sig binary")
