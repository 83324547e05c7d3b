"""Rule families as arrays of structs: records, gate, limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The gate's limits; a value at its limit passes.
GATE = {"max_drop": 0.2, "max_mean_shift": 0.5, "max_quarantine": 0.05, "min_coverage": 0.95, "max_mean_gap": 0.3, "max_bytes": 2_097_152, "max_cluster": 3, "max_advertised_drop": 0.4}
MAX_TEXT = 5000


def findings(rules: list[tuple[str, Column, Column]]) -> Column:
    """(code, severity) of the rules that hold; rules are (code, severity, condition)."""
    each = [F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(code).alias("code"), severity.alias("severity"))) for code, severity, cond in rules]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def record_findings(rating: Column, id_: Column, text: Column, author: Column, date: Column) -> Column:
    fatal, warn, info = F.lit("fatal"), F.lit("warn"), F.lit("info")
    bad = rating.isNull() | (rating != F.floor(rating)) | ~rating.between(1, 5)
    return findings([
        ("rating", fatal, bad), ("identity", fatal, id_.isNull() | (id_.cast("string") == "")), ("text_length", fatal, F.length(text) > MAX_TEXT),
        ("anonymous_without_text", info, (author.isNull() | (author == "")) & (text.isNull() | (text == ""))), ("undated", warn, date.isNull()),
    ])


def quarantined(found: Column) -> Column:
    return F.exists(found, lambda f: f["severity"] == "fatal")


def gate(rows: DataFrame, limits: dict = GATE) -> DataFrame:
    """rows with reasons (rule:verdict) and decision.

    Columns: count, mean, prior_count, prior_mean (null without a prior), prior_readable, completeness, schema_errors,
    quarantine_rate, fatal_findings, coverage, advertised_mean, bytes, largest_cluster, advertised, prior_advertised,
    force (an allowed, reasoned override that turns G-03, G-04 and G-05 into warnings).
    """
    c = F.col
    has = c("prior_count").isNotNull()
    soft = F.when(c("force"), "WARN").otherwise("REJECT")
    reject, warn = F.lit("REJECT"), F.lit("WARN")
    rules = [
        ("G-00", reject, ~c("prior_readable")), ("G-01", reject, c("schema_errors") > 0), ("G-02", reject, has & (c("count") == 0) & (c("prior_count") > 0)),
        ("G-03", soft, has & (c("prior_count") > 0) & ((c("prior_count") - c("count")) / F.nullif(c("prior_count"), F.lit(0)) > limits["max_drop"])),
        ("G-04", soft, has & (c("prior_count") > 0) & (F.abs(c("mean") - c("prior_mean")) > limits["max_mean_shift"])),
        ("G-05", soft, has & (c("completeness") == "partial") & (c("count") < c("prior_count"))),
        ("G-06", reject, c("quarantine_rate") > limits["max_quarantine"]), ("G-07", reject, c("fatal_findings") > 0),
        ("G-08", warn, (c("coverage") < limits["min_coverage"]) & (c("completeness") != "full_capped")), ("G-09", warn, F.abs(c("mean") - c("advertised_mean")) > limits["max_mean_gap"]),
        ("G-10", warn, c("bytes") > limits["max_bytes"]), ("G-11", warn, c("largest_cluster") > limits["max_cluster"]),
        ("G-12", warn, has & (c("prior_advertised") > 0) & ((c("prior_advertised") - c("advertised")) / F.nullif(c("prior_advertised"), F.lit(0)) > limits["max_advertised_drop"])),
    ]
    found = findings(rules)
    decision = F.when(F.exists("reasons", lambda r: r["severity"] == "REJECT"), "REJECT").when(F.size("reasons") > 0, "ACCEPT_WITH_WARNINGS").otherwise("ACCEPT")
    return rows.withColumn("reasons", found).withColumn("decision", decision)
