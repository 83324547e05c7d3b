"""Centroid clustering by Lloyd's rounds that follow changes only.

Vectors are kept as integers, packed in blocks, in a table bucketed by block. What a round
knows of them, owner and distance by vector, is a second table bucketed the same way, so
that the two meet without a shuffle. A round compares a vector with the centroids that
changed since; only where its owner is among these, with all. It writes the new
assignments and, beside them, what owners that changed mean for the centroids' sums: the
vector taken from the one and given to the other, added up by block. The driver holds
the global sums and counts, k rows of integers, and adds the aggregated transfers to them.

Defined results: a vector takes part if it has exactly DIMENSIONS components and none is
null or not finite; others have no row. An integer beyond 2 ** 27 either way is taken as that, so
that squared distances fit a long. A null id counts as the empty text in the seed order
and stays null; repeated ids are rows of their own, and of equal ids the smaller vector
comes first in that order. With fewer than k vectors there are as many centroids; with none
an empty table. Equal distances go to the smaller centroid. Sums are exact.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged

K, ROUNDS, SEED, DIMENSIONS, SCALE = 8, 10, 3, 64, 1024
#: Vectors in a block, and bytes of blocks in a bucket, about.
BLOCK, BUCKET_BYTES = 512, 32 << 20
#: Integers are held to this.
BOUND = 1 << 27


def integers(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """(id, x) of the vectors that take part, x an array of integers."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("x")).where((F.size("x") == dimensions) & sound).select("id", F.transform("x", lambda x: F.greatest(F.least(F.floor(x * float(scale)), F.lit(BOUND)), F.lit(-BOUND)).cast("int")).alias("x"))


def _packed(rows: DataFrame, dimensions: int) -> DataFrame:
    """Blocks of up to BLOCK vectors as little-endian integers; block numbers are added as the blocks are written."""
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                part = batch.slice(k, BLOCK)
                ids = part.column("id")
                matrix = part.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i4")
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(ids)], ids), pa.array([matrix.tobytes()], pa.binary())], names=["ids", "x"])

    return rows.mapInArrow(run, f"ids array<{kind}>, x binary").withColumn("block", F.monotonically_increasing_id())


class Tables:
    """Bucketed tables of one run in the warehouse; dropped when they are no longer read."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.run, self.names = spark, buckets, uuid.uuid4().hex[:12], []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        name = f"centroids_{self.run}_{name}"
        df.write.option("compression", "zstd").bucketBy(self.buckets, "block").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def drop(self, upto: int, first: int = 1) -> None:
        """Drop all but the first and the last upto tables."""
        for name in self.names[first : len(self.names) - upto]:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.names.remove(name)


def nearest(x: np.ndarray, owner: np.ndarray, distance: np.ndarray, centroids: np.ndarray, changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners and distances after the centroids numbered in changed have moved; owner -1: none yet."""
    owner, distance = owner.copy(), distance.copy()
    lost = np.isin(owner, changed) | (owner < 0)
    distance[lost], owner[lost] = np.iinfo(np.int64).max, len(centroids)
    for c in range(len(centroids)):
        at = np.arange(len(x)) if c in changed else np.flatnonzero(lost)
        if not len(at) or (c not in changed and not lost.any()):
            continue
        gap = x[at] - centroids[c]
        d = np.einsum("ij,ij->i", gap, gap)
        better = (d < distance[at]) | ((d == distance[at]) & (c < owner[at]))
        owner[at[better]], distance[at[better]] = c, d[better]
    return owner, distance


def _round(blocks: DataFrame, centroids: np.ndarray, changed: np.ndarray, first: bool, dimensions: int) -> DataFrame:
    """(block, owner, distance, transfers): transfers are rows of dimensions + 1 integers by centroid, the last one a count; null where no vector moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x = np.frombuffer(batch.column("x")[k].as_py(), "<i4").reshape(-1, dimensions).astype(np.int64)
                was = np.full(len(x), -1) if first else np.frombuffer(batch.column("owner")[k].as_py(), "<i4").astype(np.int64)
                had = np.zeros(len(x), np.int64) if first else np.frombuffer(batch.column("distance")[k].as_py(), "<i8")
                owner, distance = nearest(x, was, had, centroids, changed)
                moved = np.flatnonzero(owner != was)
                transfers = None
                if len(moved):
                    signed = np.zeros((len(centroids), dimensions + 1), np.int64)
                    rows = np.hstack([x[moved], np.ones((len(moved), 1), np.int64)])
                    np.add.at(signed, owner[moved], rows)
                    left = was[moved] >= 0
                    np.subtract.at(signed, was[moved][left], rows[left])
                    transfers = signed.astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(k, 1), pa.array([owner.astype("<i4").tobytes()], pa.binary()), pa.array([distance.astype("<i8").tobytes()], pa.binary()), pa.array([transfers], pa.binary())], names=["block", "owner", "distance", "transfers"])

    return blocks.mapInArrow(run, "block long, owner binary, distance binary, transfers binary")


def _transfers(assigned: DataFrame, k: int, dimensions: int) -> list[list[int]]:
    """The sums of all blocks' transfers: k rows of dimensions + 1 integers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # 2 ** 27 in each of 2 ** 9 vectors of a block, 10,000 blocks in a batch: far below a long
            total = sum(np.frombuffer(t, "<i8") for t in batch.column("transfers").to_pylist())
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "v"])

    found = assigned.select("transfers").where("transfers IS NOT NULL").mapInArrow(run, "at int, v long").groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    out = [[0] * (dimensions + 1) for _ in range(k)]
    for at, v in found.collect():
        out[at // (dimensions + 1)][at % (dimensions + 1)] = int(v)
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector that takes part."""
    spark, kind = vectors.sparkSession, dict(vectors.dtypes)[id_col]
    rows = integers(vectors, id_col, vector_col, dimensions, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    starts = [list(r.x) for r in rows.select("x", order.alias("h")).orderBy("h", "x").limit(k).collect()]
    if not starts:
        return rows.select(F.col("id").alias(id_col), *(F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))))
    centroids = np.array(starts, np.int64)
    size = vectors.select(F.count("*")).first()[0] * dimensions * 4
    tables = Tables(spark, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES)))
    packed = _packed(rows, dimensions)
    # The numbers must be fixed before anything is dealt by them: blocks are written, then bucketed.
    blocks = tables.keep(staged(packed, "blocks").repartition(tables.buckets, "block"), "blocks")
    sums, assigned = [[0] * (dimensions + 1) for _ in starts], None
    changed = np.arange(len(starts))
    for n in range(rounds + 1):
        known = blocks.select("block", "x") if assigned is None else blocks.select("block", "x").join(assigned.select("block", "owner", "distance"), "block")
        assigned = tables.keep(_round(known, centroids, changed, assigned is None, dimensions), f"round{n}")
        tables.drop(1)
        if n == rounds:
            break
        sums = [[a + b for a, b in zip(x, y, strict=True)] for x, y in zip(sums, _transfers(assigned, len(starts), dimensions), strict=True)]
        new = np.array([[v // s[-1] for v in s[:-1]] if s[-1] else c.tolist() for s, c in zip(sums, centroids, strict=True)], np.int64)
        changed = np.flatnonzero((new != centroids).any(1))
        centroids = new
        if not len(changed):
            break  # every later round would find the same
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    found = blocks.select("block", "ids").join(assigned.select("block", "owner", "distance"), "block")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner = np.concatenate([np.frombuffer(b, "<i4") for b in batch.column("owner").to_pylist()] or [np.empty(0, "<i4")])
            distance = np.concatenate([np.frombuffer(b, "<i8") for b in batch.column("distance").to_pylist()] or [np.empty(0, "<i8")])
            yield pa.RecordBatch.from_arrays([batch.column("ids").flatten(), pa.array(owner, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    result = found.select("ids", "owner", "distance").mapInArrow(opened, f"id {kind}, cluster int, distance long")
    result = staged(result, "clusters")
    inertia = {c: int(v) for c, v in result.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # k rows
    tables.drop(0, 0)
    by = lambda values, t: F.element_at(F.array(*(F.lit(v).cast(t) for v in values)), F.col("cluster") + 1)
    return result.select(F.col("id").alias(id_col), "cluster", "distance", by([inertia.get(c, 0) for c in range(len(starts))], "long").alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), by(hashes, "string").alias("centroid_sha256"))
