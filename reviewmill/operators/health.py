"""Health metrics, their bands, and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Healthy and act limits of each metric, and which side is better.
BANDS = {
    "success_rate": (0.98, 0.95, "higher"), "coverage": (0.97, 0.95, "higher"), "gate_rejection_rate": (0.02, 0.10, "lower"), "index_0_share": (1.0, 0.95, "higher"),
    "p95_duration_ms": (150_000.0, 240_000.0, "lower"), "challenges": (0.0, 1.0, "lower"), "commits_per_run": (1.0, 3.0, "lower"), "peak_rss_bytes": (700_000_000.0, 900_000_000.0, "lower"),
}


def metrics(health: DataFrame, *by: str) -> DataFrame:
    """Columns: outcome, coverage, gate_decision, duration_ms, challenged, commits, peak_rss, index_0, indices."""
    c = F.col
    ratio = lambda a, b: F.when(b > 0, a / b)
    counted = F.count_if(c("outcome") != "deferred")
    return health.groupBy(*by).agg(
        ratio(F.count_if(c("outcome") == "succeeded"), counted).alias("success_rate"), F.avg("coverage").alias("coverage"),
        ratio(F.count_if(c("gate_decision") == "REJECT"), F.count("gate_decision")).alias("gate_rejection_rate"), ratio(F.sum("index_0"), F.sum("indices")).alias("index_0_share"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY duration_ms)").alias("p95_duration_ms"), F.count_if("challenged").cast("double").alias("challenges"),
        ratio(F.sum("commits"), F.count("*")).alias("commits_per_run"), F.nullif(F.max("peak_rss"), F.lit(0)).alias("peak_rss_bytes"),
    )


def status(value: Column, healthy: float, act: float, better: str) -> Column:
    good, bad = (value >= healthy, value < act) if better == "higher" else (value <= healthy, value > act)
    return F.when(value.isNull(), "unknown").when(good, "healthy").when(bad, "act").otherwise("watch")


def band_report(found: DataFrame, *by: str) -> DataFrame:
    """A row for each metric with its value and status."""
    each = F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value"), status(F.col(k), *band).alias("status")) for k, band in BANDS.items()))
    return found.select(*by, F.explode(each).alias("m")).select(*by, "m.metric", "m.value", "m.status")


def alerts(report: DataFrame, *by: str) -> DataFrame:
    """Metrics to act on, with a fingerprint that stays the same while the condition lasts."""
    return report.where("status = 'act'").withColumn("fingerprint", F.left(F.sha2(F.concat_ws("|", *by, "metric"), 256), F.lit(16)))


def error_alerts(health: DataFrame, classes: DataFrame, prefix: str = "alert") -> DataFrame:
    """(fingerprint, severity, condition, title, body) of each health record that has an error class; classes (code, scope, severity) is the table of errors.

    A condition of scope source is one alert a source, of scope run one a run, else one a listing, also where it hit forty of its reviews. Unknown classes count as errors of a target.
    """
    c, known = F.col, F.broadcast(classes.select(F.col("code").alias("error_class"), F.col("scope").alias("_scope"), F.col("severity").alias("_severity")))  # a fixed table
    or_ = lambda name, other: F.coalesce(c(name), F.lit(other))
    rows = health.where("error_class IS NOT NULL").join(known, "error_class", "left")
    severity = or_("_severity", "error")
    target = F.concat(or_("client_slug", "unknown"), F.lit("/"), or_("listing_key", "all"))
    scope = F.when(or_("_scope", "target") == "source", F.concat(F.lit("source/"), or_("adapter", "unknown"))).when(c("_scope") == "run", "run").otherwise(F.concat(F.lit("client/"), target))
    name = F.concat(F.lit(f"[{prefix}:"), severity, F.lit(":"), c("error_class"), F.lit(":"), scope, F.lit("]"))
    title = F.concat(c("error_class"), F.lit(" — "), target)
    body = F.concat_ws("\n", F.concat(F.lit("Condition: "), c("error_class"), F.lit(" ("), severity, F.lit(")")), F.concat(F.lit("Target: "), target), F.concat(F.lit("Stop reason: "), or_("stop_reason", "n/a")), name)
    return rows.select(name.alias("fingerprint"), severity.alias("severity"), c("error_class").alias("condition"), title.alias("title"), body.alias("body")).groupBy("fingerprint").agg(*(F.min(x).alias(x) for x in ("severity", "condition", "title", "body")))


def deliverable(alerts_: DataFrame, maintenance: bool = False) -> DataFrame:
    """What may be sent: all, in maintenance only what is critical."""
    return alerts_.where(F.col("severity") == "critical") if maintenance else alerts_


def deliveries(current: DataFrame, opened: DataFrame) -> DataFrame:
    """(fingerprint, action): open new ones, comment on the first open issue of a known one, close what is gone."""
    first = opened.groupBy("fingerprint").agg(F.min("issue").alias("issue"))
    j = current.select("fingerprint").distinct().withColumn("now", F.lit(True)).join(first, "fingerprint", "full_outer")
    return j.select("fingerprint", "issue", F.when(F.col("now").isNull(), "close").when(F.col("issue").isNull(), "open").otherwise("comment").alias("action"))
