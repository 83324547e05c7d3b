"""Publishing artifacts: only what changed is written, payload first, then state.

A run compares candidates with what the state says is published. The changed ones go to a payload of their own version; then the state gets one row for each, which
makes them published. A run that finds a whole payload without its state completes that first, so a crash between the two steps
neither repeats nor loses a write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEYS = ("client", "listing", "artifact")
PAYLOAD = "client string, listing string, artifact string, body string, content_hash string"
STATE = "client string, listing string, artifact string, body_hash string, content_hash string, version long"


def _versions(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Those whose writer has committed them."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("version=")]
    return sorted(int(p.getName().partition("=")[2]) for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def state(spark: SparkSession, folder: str) -> DataFrame:
    """The published artifacts: of each the row of its last version."""
    versions = _versions(spark, folder, "state")
    if not versions:
        return spark.createDataFrame([], STATE)
    rows = spark.read.schema(STATE).parquet(*(f"{folder}/state/version={v}" for v in versions))
    return rows.groupBy(*KEYS).agg(F.max_by(F.struct("body_hash", "content_hash", "version"), "version").alias("s")).select(*KEYS, "s.*")


def published(spark: SparkSession, folder: str) -> DataFrame:
    """The published artifacts with their bodies."""
    versions = _versions(spark, folder, "state")
    if not versions:
        return spark.createDataFrame([], PAYLOAD)
    bodies = spark.read.schema(f"{PAYLOAD}, version long").option("basePath", f"{folder}/payload").parquet(*(f"{folder}/payload/version={v}" for v in versions))
    return bodies.join(state(spark, folder).select(*KEYS, "version"), [*KEYS, "version"], "left_semi").select(*KEYS, "body", "content_hash")


def changed(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates (client, listing, artifact, body, content_hash) that must be written: neither the bytes nor the content hash (where both have one) are those published. Of several candidates for an artifact, the greatest body counts."""
    last = Window.partitionBy(*KEYS).orderBy(F.desc("body"), F.desc("content_hash"))
    one = candidates.select(*KEYS, "body", "content_hash").withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    before = known.select(*KEYS, F.col("body_hash").alias("_body"), F.col("content_hash").alias("_content"))
    same = (F.sha2("body", 256) == F.col("_body")) | (F.col("content_hash") == F.col("_content"))
    return one.join(before, list(KEYS), "left").where(~F.coalesce(same, F.lit(False))).drop("_body", "_content")


def _seal(spark: SparkSession, folder: str, version: int) -> int:
    rows = spark.read.schema(PAYLOAD).parquet(f"{folder}/payload/version={version}")
    rows.select(*KEYS, F.sha2("body", 256).alias("body_hash"), "content_hash", F.lit(version).cast("long").alias("version")).write.mode("overwrite").parquet(f"{folder}/state/version={version}")
    return rows.count()


def publish(candidates: DataFrame, folder: str) -> int:
    """Write what changed; how many artifacts that was. Nothing is written if nothing did."""
    spark = candidates.sparkSession
    payloads, states = _versions(spark, folder, "payload"), _versions(spark, folder, "state")
    for version in (v for v in payloads if v not in states):
        _seal(spark, folder, version)  # what a run before left between its steps
    version = max([0, *payloads, *states]) + 1
    rows = changed(candidates, state(spark, folder))
    if rows.isEmpty():
        return 0
    rows.write.mode("overwrite").parquet(f"{folder}/payload/version={version}")
    return _seal(spark, folder, version)
