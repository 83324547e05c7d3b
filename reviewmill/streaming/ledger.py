"""Incremental ledger: a stream of harvests merged by the batch operator.

The ledger lies in buckets of listings. A micro-batch reads and writes only the buckets its harvests fall into; a manifest, written last,
names each bucket's version and the run it came from. So what is written follows the harvest and not the ledger, a crash
leaves the last manifest in force, and a batch that comes again is known by its stream and number. Versions that no kept manifest names
are deleted.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..lineage import cut_lineage
from ..operators.merge import reconcile, record_harvests

HARVESTS = "listing string, updated_at string, last_full_harvest_at string"
LEDGER = "listing string, id string, content_hash string, state string, first_seen_at string, last_seen_at string, last_updated_at string, revision int, missing_streak int, tombstoned_at string, history array<string>"
MANIFEST = "bucket int, version long, source string, batch long"
#: Buckets of a new ledger; an old one keeps its number. Manifests that are kept.
BUCKETS, KEPT = 64, 2
#: From the worst to the best; of several claims about one harvest the worst counts.
COMPLETENESS = ("failed", "partial", "full_capped", "full")


class LedgerUnreadable(RuntimeError):
    """There is a ledger, but not one to merge with."""


def columns(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def bucket_of(listing: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(listing), F.lit(buckets)).cast("int")


class Store:
    """A ledger's folder: manifest, and by version and bucket its reviews and harvests."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.jvm = spark, folder, spark.sparkContext._jvm
        self.fs = self.jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def versions(self) -> list[int]:
        """Committed manifests."""
        if not self.fs.exists(self.path("manifest")):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self.path("manifest"))]
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith("version=") and self.fs.exists(self.path("manifest", n, "_SUCCESS")))

    def manifest(self, version: int) -> list:
        """A row a bucket (as many as the ledger has buckets, whatever its size), of which -1 tells the number of buckets."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest/version={version}").collect()

    def open(self, name: str, schema: str, rows: list, check: bool) -> DataFrame:
        """The rows of the buckets that the manifest's rows name."""
        paths = [f"{self.folder}/{name}/version={r.version}/bucket={r.bucket}" for r in rows if r.bucket >= 0]
        # A bucket whose rows have all gone has no folder, but its version was committed.
        paths = [p for p in paths if self.fs.exists(self.jvm.org.apache.hadoop.fs.Path(p)) or self._missing(p)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        if check:
            self._probe(name, schema, paths)
        return self.spark.read.schema(schema).parquet(*paths)

    def _missing(self, path: str) -> bool:
        if not self.fs.exists(self.jvm.org.apache.hadoop.fs.Path(path.rpartition("/")[0] + "/_SUCCESS")):
            raise LedgerUnreadable(f"{path} is named by the manifest, but its version is not there")
        return False

    def _probe(self, name: str, schema: str, paths: list[str]) -> None:
        """Read every file's footer (as tasks) and compare the columns."""
        try:
            found = {f.name: f.dataType.simpleString() for f in self.spark.read.option("mergeSchema", True).parquet(*paths).schema}
        except Exception as problem:  # whatever a damaged file makes Spark say
            raise LedgerUnreadable(f"{name}: {str(problem)[:300]}") from problem
        want = dict(c.split(" ", 1) for c in schema.split(", "))
        wrong = [c for c, t in want.items() if found.get(c) != t]
        if wrong:
            raise LedgerUnreadable(f"{name}: missing or of another type: {', '.join(wrong)}")

    def clean(self) -> None:
        """Delete manifests but the last, and the bucket versions that none of those names."""
        versions = self.versions()
        kept = versions[-KEPT:]
        named = {(r.version, r.bucket) for v in kept for r in self.manifest(v)}
        live = {v for v, _ in named}
        for name in ("reviews", "harvests"):
            for s in self.fs.listStatus(self.path(name)) if self.fs.exists(self.path(name)) else []:
                v = int(s.getPath().getName().partition("=")[2])
                if kept and v > kept[-1]:
                    continue  # being written, or left by a crash and to be written again
                if v not in live:
                    self.fs.delete(s.getPath(), True)
                    continue
                for b in self.fs.listStatus(s.getPath()):
                    n = b.getPath().getName()
                    if n.startswith("bucket=") and (v, int(n.partition("=")[2])) not in named:
                        self.fs.delete(b.getPath(), True)
        for v in versions[:-KEPT]:
            self.fs.delete(self.path("manifest", f"version={v}"), True)


def read_ledger(spark: SparkSession, folder: str) -> tuple[str, DataFrame | None, str]:
    """(found, rows, ""), (absent, None, "") where there never was a ledger, or (unreadable, None, why), which must not be merged with."""
    store = Store(spark, folder)
    versions = store.versions()
    if not versions:
        return "absent", None, ""
    try:
        return "found", store.open("reviews", LEDGER, store.manifest(versions[-1]), True), ""
    except (LedgerUnreadable, AnalysisException) as problem:
        return "unreadable", None, str(problem)


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger's last version; empty before the first."""
    return _version(spark, folder, "reviews", LEDGER)


def harvests(spark: SparkSession, folder: str) -> DataFrame:
    """When each listing was harvested last, and last completely."""
    return _version(spark, folder, "harvests", HARVESTS)


def _version(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    store = Store(spark, folder)
    versions = store.versions()
    return store.open(name, schema, store.manifest(versions[-1]) if versions else [], False)


def merge_stream(harvested: DataFrame, folder: str, checkpoint: str, denylist: DataFrame, buckets: int = BUCKETS) -> StreamingQuery:
    """Merge a stream of (listing, now, completeness, id, content_hash) rows into the ledger under folder.

    The harvests of a listing in one micro-batch are merged one after the other, in order of their times. A listing's last complete
    harvest is kept with the ledger, so one that comes again at the same instant, in whatever batch, counts no absence
    twice. A harvest without reviews is a row whose id is null. Where rows of one harvest differ in completeness, the worst counts. A ledger
    that can't be read stops the stream; nothing is written then.
    """
    spark = harvested.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        source = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]  # the stream's own, new with each checkpoint
        apply(batch, folder, source, number, denylist, buckets)

    return harvested.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def apply(batch: DataFrame, folder: str, source: str, number: int, denylist: DataFrame, buckets: int = BUCKETS) -> int | None:
    """Merge one batch; the version it made, or None if that source's batch was merged before."""
    spark = batch.sparkSession
    store = Store(spark, folder)
    versions = store.versions()
    known = store.manifest(versions[-1]) if versions else []
    if any(r.source == source and r.batch >= number for r in known):
        return None
    buckets = next((r.version for r in known if r.bucket == -1), buckets)
    batch = cut_lineage(batch.withColumn("bucket", bucket_of(F.col("listing"), buckets)))
    touched = {r.bucket for r in batch.select("bucket").distinct().collect()}  # at most as many as there are buckets
    own = [r for r in known if r.bucket in touched]
    ledger, times = store.open("reviews", LEDGER, own, True), store.open("harvests", HARVESTS, own, True)
    # A listing's harvests in a batch are few; each round merges one of every listing.
    rank = F.array_position(F.array(*map(F.lit, COMPLETENESS)), F.col("completeness"))
    worst = F.element_at(F.array(*map(F.lit, COMPLETENESS)), F.greatest(F.coalesce(F.min(F.coalesce(rank, F.lit(1))), F.lit(1)), F.lit(1)).cast("int"))
    runs = cut_lineage(batch.groupBy("listing", "now").agg(worst.alias("completeness")).withColumn("turn", F.row_number().over(Window.partitionBy("listing").orderBy("now"))))
    for turn in range(1, (runs.agg(F.max("turn")).first()[0] or 0) + 1):
        now = runs.where(F.col("turn") == turn).drop("turn")
        seen = batch.where("id IS NOT NULL").join(now.select("listing", "now"), ["listing", "now"], "left_semi").groupBy("listing", "id").agg(F.max("content_hash").alias("content_hash"))
        merged = reconcile(ledger, seen, now.join(times.select("listing", "last_full_harvest_at"), "listing", "left"), denylist)
        ledger = cut_lineage(merged.select(*columns(LEDGER)))
        times = cut_lineage(record_harvests(times, now))
    version = (versions[-1] if versions else 0) + 1
    for name, rows in (("reviews", ledger), ("harvests", times)):
        placed = rows.withColumn("bucket", bucket_of(F.col("listing"), buckets)).repartition("bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/{name}/version={version}")
    # Each source's last batch is remembered, also where another one has written all its buckets since.
    last = {r.source: r.batch for r in sorted((r for r in known if r.bucket <= -2), key=lambda r: r.batch)} | {source: number}
    rows = [(r.bucket, r.version, None, None) for r in known if r.bucket >= 0 and r.bucket not in touched] + [(b, version, None, None) for b in sorted(touched)]
    rows += [(-1, buckets, None, None), *((-2, version, s, b) for s, b in last.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest/version={version}")
    store.clean()
    return version


def hourly_counts(requests: DataFrame, late: str = "2 hours") -> DataFrame:
    """Requests by key and hour (key, ts), for reporting; rows later than the watermark are left out."""
    return requests.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), "key").agg(F.count("*").alias("n"))
