"""Registered queries on runs, configuration, health records and identities."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import lineage
from ..functions import canonical, numbers, urls
from ..operators import enrich, health, merge, redaction, runs
from ..sources import extraction, port, publish, readers
from ..sources.views import table
from .queries import query

_STATE = "CASE event_type WHEN 'error' THEN CASE WHEN value > 60 THEN 'failed' ELSE 'blocked' END WHEN 'signup' THEN 'deferred' WHEN 'click' THEN 'skipped' ELSE 'succeeded' END"
_CODE = "CASE WHEN event_type = 'error' THEN CASE WHEN user_id % 3 = 0 THEN 'ERR-BLOCKED-CHALLENGE' WHEN user_id % 3 = 1 THEN 'ERR-NET-DNS' ELSE 'ERR-NO-SUCH' END WHEN event_type = 'signup' AND user_id % 2 = 0 THEN 'ERR-GATE-REJECTED' END"


def _outcomes(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", F.expr(_STATE).alias("state"), F.expr(_CODE).alias("code"))


@query("SELECT c_custkey AS target, CASE c_mktsegment WHEN 'BUILDING' THEN 'premium' WHEN 'MACHINERY' THEN 'standard' WHEN 'HOUSEHOLD' THEN 'economy' ELSE 'paused' END AS tier, CAST(row_number() OVER (ORDER BY CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 WHEN 'HOUSEHOLD' THEN 2 ELSE 3 END, CAST(floor(c_acctbal) AS BIGINT) DESC, c_custkey) - 1 AS BIGINT) AS place FROM customer")
def priority_order(spark, sf_dir):
    segment = F.col("c_mktsegment")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("target"), F.when(segment == "BUILDING", "premium").when(segment == "MACHINERY", "standard").when(segment == "HOUSEHOLD", "economy").otherwise("paused").alias("tier"), F.floor("c_acctbal").alias("stale_hours"))
    return _placed(runs.priority(c), "target", "tier")


def _placed(ordered, *keep):
    """Places of a sorted table: counts of the partitions before, then the rank within; no partition holds all rows."""
    part = ordered.select(*keep, F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i"))
    # Written once: each sort of a large table draws other bounds, so counts of one don't fit the rows of another.
    part = lineage.cut_lineage(part.withColumn("_at", F.col("_i") - F.shiftleft(F.col("_p").cast("long"), 33)))
    sizes = [(r["_p"], r["n"]) for r in part.groupBy("_p").agg(F.count("*").alias("n")).orderBy("_p").collect()]
    before, rows = 0, []
    for p, n in sizes:
        rows.append((p, before))
        before += n
    starts = ordered.sparkSession.createDataFrame(rows, "_p int, _before long")
    return part.join(F.broadcast(starts), "_p").select(*keep, (F.col("_before") + F.col("_at")).alias("place"))


@query("""SELECT c_custkey AS target, CASE WHEN d > 0 THEN greatest(1.0, d) WHEN n > 0 THEN greatest(1.0, CAST(n AS DOUBLE)) ELSE 200.0 END AS cost FROM customer LEFT JOIN (SELECT user_id, CAST(floor(max(value)) - 20 AS DOUBLE) AS d, count(*) FILTER (event_type = 'view') AS n FROM events WHERE user_id % 3 > 0 GROUP BY 1) ON user_id = c_custkey""")
def estimated_cost(spark, sf_dir):
    health = table(spark, sf_dir, "events").where("user_id % 3 > 0").groupBy(F.col("user_id").alias("target")).agg((F.floor(F.max("value")) - 20).alias("last_duration_ms"), F.count_if(F.col("event_type") == "view").alias("last_review_count"))
    return runs.estimated_cost(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("target")), health, "target")


@query(f"""SELECT event_id, code, CASE code WHEN 'ERR-BLOCKED-CHALLENGE' THEN 'never' WHEN 'ERR-NET-DNS' THEN 'backoff' END AS strategy, CAST(CASE code WHEN 'ERR-BLOCKED-CHALLENGE' THEN 0 WHEN 'ERR-NET-DNS' THEN 3 END AS INT) AS attempts,
  CASE code WHEN 'ERR-BLOCKED-CHALLENGE' THEN 'source' WHEN 'ERR-NET-DNS' THEN 'target' END AS scope, CASE code WHEN 'ERR-BLOCKED-CHALLENGE' THEN 'critical' WHEN 'ERR-NET-DNS' THEN 'warn' END AS severity, CASE code WHEN 'ERR-BLOCKED-CHALLENGE' THEN TRUE WHEN 'ERR-NET-DNS' THEN FALSE END AS opens_breaker
  FROM (SELECT event_id, {_CODE} AS code FROM events) WHERE code IS NOT NULL""")
def error_taxonomy(spark, sf_dir):
    return runs.classified(_outcomes(spark, sf_dir).where("code IS NOT NULL")).select("event_id", "code", "strategy", "attempts", "scope", "severity", "opens_breaker")


@query(f"""WITH o AS (SELECT user_id, {_STATE} AS state, {_CODE} AS code, value < 0.2 AS missing FROM events), g AS (SELECT user_id, count(*) FILTER (missing) AS m, count(*) FILTER (NOT missing) AS n, count(*) FILTER (NOT missing AND state = 'failed') AS f, count(*) FILTER (state = 'blocked') AS b,
  count(*) FILTER (state = 'blocked' AND code = 'ERR-BLOCKED-CHALLENGE') AS c, count(*) FILTER (code = 'ERR-GATE-REJECTED') AS r, count(*) FILTER (state = 'deferred') AS d FROM o GROUP BY 1),
  x AS (SELECT user_id, CASE WHEN m > 0 THEN 1 WHEN f > 0 THEN CASE WHEN f = n THEN 3 ELSE 4 END WHEN c > 0 THEN 7 WHEN b > 0 THEN 6 WHEN r > 0 THEN 5 WHEN d > 0 THEN 4 ELSE 0 END AS exit_code FROM g)
  SELECT user_id, CAST(exit_code AS INT) AS exit_code, CASE WHEN exit_code = 0 THEN 'none' WHEN exit_code IN (1, 7) THEN 'critical' WHEN exit_code IN (2, 3, 5) THEN 'error' ELSE 'warn' END AS severity, exit_code IN (1, 2, 3) AS fails_job FROM x""")
def exit_codes(spark, sf_dir):
    found = runs.exit_codes(_outcomes(spark, sf_dir).withColumn("missing", F.col("value") < 0.2), "user_id")
    return found.select("user_id", "exit_code", runs.exit_severity(F.col("exit_code")).alias("severity"), runs.fails_job(F.col("exit_code")).alias("fails_job"))


@query(f"""SELECT event_id, 1 AS schema_version, outcome, observed_count, coverage, duration_ms IS NULL AND published_count IS NULL AS others_null,
  array_to_string(list_filter([CASE WHEN client_slug = '' THEN 'client_slug is missing' END, CASE WHEN outcome = 'unknown' THEN 'outcome "unknown" is not one of succeeded, failed, blocked, deferred, skipped' END], lambda x: x IS NOT NULL), '; ') AS problems
  FROM (SELECT event_id, CASE WHEN user_id % 10 = 0 THEN '' ELSE 'client-' || user_id % 10 END AS client_slug, CASE WHEN value > 150 THEN 'unknown' ELSE {_STATE} END AS outcome, CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) END AS observed_count, CASE WHEN event_type = 'view' THEN CAST(1 AS DOUBLE) END AS coverage, CAST(NULL AS BIGINT) AS duration_ms, CAST(NULL AS BIGINT) AS published_count FROM events)""")
def health_records(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    own = e.select(
        F.col("event_id").cast("string").alias("run_id"), F.col("ts").cast("string").alias("recorded_at"), F.when(F.col("user_id") % 10 == 0, "").otherwise(F.concat(F.lit("client-"), F.col("user_id") % 10)).alias("client_slug"), F.lit("main").alias("listing_key"),
        F.when(F.col("value") > 150, "unknown").otherwise(F.expr(_STATE)).alias("outcome"), F.when(F.col("event_type") != "error", F.floor("value")).alias("observed_count"), F.when(F.col("event_type") == "view", 1.0).alias("coverage"),
    )
    r = runs.health_records(own)
    return r.select(F.col("run_id").cast("long").alias("event_id"), "schema_version", "outcome", "observed_count", "coverage", (F.col("duration_ms").isNull() & F.col("published_count").isNull()).alias("others_null"), F.array_join(runs.health_problems(), "; ").alias("problems"))


@query("SELECT p_partkey, regexp_full_match(k, '[a-z0-9][a-z0-9._-]{0,63}') AND NOT contains(k, '..') AS safe FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN lower(replace(p_name, ' ', '-')) WHEN 1 THEN p_name WHEN 2 THEN 'a..b' WHEN 3 THEN '.hidden' ELSE repeat('x', 60 + CAST(p_partkey % 9 AS INT)) END AS k FROM part)")
def safe_segments(spark, sf_dir):
    k = F.expr("CASE p_partkey % 5 WHEN 0 THEN lower(replace(p_name, ' ', '-')) WHEN 1 THEN p_name WHEN 2 THEN 'a..b' WHEN 3 THEN '.hidden' ELSE repeat('x', 60 + CAST(p_partkey % 9 AS INT)) END")
    return table(spark, sf_dir, "part").select("p_partkey", runs.safe_segment(k).alias("safe"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'author_key,state' WHEN doc_id % 3 = 1 THEN 'tombstoned_at' ELSE '' END AS leaked FROM documents")
def leaked_fields(spark, sf_dir):
    given = F.to_json(F.struct("doc_id", "lang", F.when(F.col("doc_id") % 3 == 0, F.col("lang")).alias("state"), F.when(F.col("doc_id") % 3 == 0, F.col("source")).alias("author_key"), F.when(F.col("doc_id") % 3 == 1, F.col("lang")).alias("tombstoned_at")))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(runs.leaked(given), ",").alias("leaked"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' OR c_nationkey % 2 = 0 THEN 'absent' ELSE 'unsupported' END AS reply, CASE WHEN c_nationkey % 3 = 0 THEN 'owner_replies' ELSE '' END AS unknown FROM customer")
def capabilities(spark, sf_dir):
    has = F.filter(F.array(F.lit("review_text"), F.when((F.col("c_mktsegment") == "BUILDING") | (F.col("c_nationkey") % 2 == 0), "owner_reply"), F.when(F.col("c_nationkey") % 3 == 0, "owner_replies")), lambda x: x.isNotNull())
    return table(spark, sf_dir, "customer").select("c_custkey", runs.explain_null(has, F.lit("owner_reply")).alias("reply"), F.array_join(runs.unknown_capabilities(has), ",").alias("unknown"))


_RESOLVED = "SELECT lang AS pack, 'field' || n_chars % 4 AS field, CASE WHEN n_chars % 11 = 0 THEN NULL ELSE CAST(CASE WHEN n_chars % (5 + n_chars % 4 * 10) = 0 THEN 1 ELSE 0 END AS INT) END AS strategy FROM documents"


@query(f"SELECT pack, field, strategy, count(*) AS n FROM ({_RESOLVED}) GROUP BY ALL")
def strategy_histogram(spark, sf_dir):
    return runs.strategy_health(_resolved(spark, sf_dir), "pack")


@query(f"SELECT pack, field, count(*) FILTER (strategy = 0) / count(*) AS primary_rate FROM ({_RESOLVED}) GROUP BY ALL HAVING count(*) FILTER (strategy = 0) / count(*) < 0.9")
def degraded_fields(spark, sf_dir):
    return runs.degraded_fields(runs.strategy_health(_resolved(spark, sf_dir), "pack"), "pack")


def _resolved(spark, sf_dir):
    n = F.col("n_chars")
    won = F.when(n % 11 == 0, None).otherwise(F.when(n % (5 + n % 4 * 10) == 0, 1).otherwise(0)).cast("int")
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("pack"), F.concat(F.lit("field"), n % 4).alias("field"), won.alias("strategy"))


@query("""WITH c AS (SELECT page_id, unnest([{'position': 1, 'matched': (length(html) - length(replace(html, '<article', ''))) // 8, 'least': 1, 'most': NULL, 'severity': 'fatal'}, {'position': 2, 'matched': (length(html) - length(replace(html, '<p>', ''))) // 3, 'least': 5, 'most': 40, 'severity': NULL},
    {'position': 3, 'matched': (length(html) - length(replace(html, '<nav', ''))) // 4, 'least': NULL, 'most': 1, 'severity': 'warn'}]) AS x FROM pages WHERE html IS NOT NULL), p AS (SELECT page_id, x.position, x.matched, x.severity, coalesce(x.matched >= x.least, TRUE) AND coalesce(x.matched <= x.most, TRUE) AS passed FROM c)
  SELECT page_id, CAST(position AS INT) AS position, CAST(matched AS INT) AS matched, coalesce(severity, 'error') AS severity, passed FROM p WHERE position = 1 OR NOT EXISTS (SELECT 1 FROM p q WHERE q.page_id = p.page_id AND q.position < p.position AND q.severity = 'fatal' AND NOT q.passed)""")
def page_assertions(spark, sf_dir):
    count = lambda s: ((F.length("html") - F.length(F.replace("html", F.lit(s), F.lit("")))) / len(s)).cast("int")
    row = lambda k, s, least, most, severity: F.struct(F.lit(k).alias("position"), count(s).alias("matched"), F.lit(least).cast("int").alias("least"), F.lit(most).cast("int").alias("most"), F.lit(severity).cast("string").alias("severity"))
    each = F.array(row(1, "<article", 1, None, "fatal"), row(2, "<p>", 5, 40, None), row(3, "<nav", None, 1, "warn"))
    counts = table(spark, sf_dir, "pages").where("html IS NOT NULL").select("page_id", F.explode(each).alias("x")).select("page_id", "x.*")
    return runs.assertions(counts, "page_id").select("page_id", "position", "matched", "severity", "passed")


@query("SELECT name, value, CASE WHEN value > ceiling THEN 'ceiling' ELSE 'floor' END AS bound, CAST(CASE WHEN value > ceiling THEN ceiling ELSE floor END AS DOUBLE) AS \"limit\" FROM (SELECT n AS name, CAST(p_partkey % 7 * 150 AS DOUBLE) AS value, f AS floor, c AS ceiling FROM part, (VALUES ('max_parallel', NULL, 8.0), ('source_hourly_budget', NULL, 600.0), ('min_request_delay_ms', 250.0, NULL), ('cadence_floor_hours', 1.0, NULL)) AS l(n, f, c)) WHERE value > ceiling OR value < floor")
def limit_violations(spark, sf_dir):
    names = F.explode(F.array(*map(F.lit, ("max_parallel", "source_hourly_budget", "min_request_delay_ms", "cadence_floor_hours"))))
    return runs.limit_violations(table(spark, sf_dir, "part").select(names.alias("name"), (F.col("p_partkey") % 7 * 150).cast("double").alias("value")))


@query("""SELECT c_custkey, array_to_string(list_filter([CASE WHEN slug <> c_name THEN 'V-1' END, CASE WHEN c_nationkey % 5 = 0 THEN 'V-2:main' END, CASE WHEN c_nationkey % 2 = 0 THEN 'V-3:main' END, CASE WHEN c_nationkey % 5 = 0 AND c_nationkey % 2 = 0 THEN 'V-3:main' END, CASE WHEN c_custkey % 3 = 0 THEN 'V-4:API' END,
    CASE WHEN c_custkey % 4 = 0 AND c_acctbal < 0 THEN 'V-6:main' END, CASE WHEN c_custkey % 4 = 0 AND c_acctbal < 0 AND c_nationkey % 5 = 0 THEN 'V-6:main' END, CASE WHEN c_acctbal > 9000 THEN 'V-8' END, CASE WHEN c_custkey % 6 = 0 THEN 'V-9' END, CASE WHEN c_custkey % 8 = 0 THEN 'V-10' END,
    CASE WHEN c_custkey % 4 > 0 AND c_acctbal < 0 THEN 'V-11:main' END, CASE WHEN c_custkey % 4 > 0 AND c_acctbal < 0 AND c_nationkey % 5 = 0 THEN 'V-11:main' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'V-12' END], lambda x: x IS NOT NULL), ',') AS findings
  FROM (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN 'other' ELSE c_name END AS slug FROM customer)""")
def config_findings(spark, sf_dir):
    c, k, n = table(spark, sf_dir, "customer"), F.col("c_custkey"), F.col("c_nationkey")
    given = F.struct(F.lit("a").alias("authorized_by"), F.lit("2024-01-01").alias("authorization_date"), F.when(n % 2 == 0, "friend").otherwise("owner").alias("relationship"), F.lit("e").alias("evidence_ref"), F.lit(True).alias("scope_ack"))
    listing = F.struct(F.lit("main").alias("key"), F.lit("google:dom").alias("adapter"), F.when(F.col("c_acctbal") >= 0, "place-0123456789").alias("place_id"), F.lit(None).cast("string").alias("cid"), F.lit("").alias("url"), F.lit("Name").alias("expected_name"), given.alias("authorization"))
    config = c.select(
        k, F.when(k % 7 == 0, "other").otherwise(F.col("c_name")).alias("slug"), F.concat("c_name", F.lit(".config.json")).alias("filename"), F.when(F.col("c_mktsegment") == "BUILDING", "premium").otherwise("economy").alias("tier"), F.lit("daily").alias("cadence"), F.lit(" ").alias("notes"),
        F.when(F.col("c_acctbal") > 9000, 4).alias("min_rating"), (k % 6 == 0).alias("schema_org"), F.lit(None).cast("boolean").alias("schema_org_acknowledged"), F.when(k % 8 == 0, 0.6).otherwise(0.5).alias("max_count_drop_ratio"), F.when(k % 4 == 0, False).alias("allow_search"),
        F.array(F.lit("API")).alias("secrets"), F.when(k % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("API"))).alias("environment"), F.when(n % 5 == 0, F.array(listing, listing)).otherwise(F.array(listing)).alias("listings"),
    )
    said = F.transform(runs.config_findings(), lambda x: F.concat_ws(":", x["rule"], x["listing"]))
    return config.select("c_custkey", F.array_join(said, ",").alias("findings"))


@query("""SELECT p_partkey, array_to_string(list_filter([CASE WHEN NOT n > 0 THEN 'navigation_timeout_ms' WHEN n >= 120000 THEN 'navigation_timeout_ms>pagination_budget_ms' END, CASE WHEN s >= 120000 THEN 'surface_timeout_ms>pagination_budget_ms' END], lambda x: x IS NOT NULL), ',') AS problems
  FROM (SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 30000 ELSE p_size * 5000 END AS n, CASE WHEN p_size % 5 = 0 THEN 15000 ELSE p_size * 4000 END AS s FROM part)""")
def timeout_nesting(spark, sf_dir):
    size = F.col("p_size")
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(size % 4 == 0, 0).otherwise(size * 5000).alias("navigation_timeout_ms"), F.when(size % 5 == 0, -1).otherwise(size * 4000).alias("surface_timeout_ms"))
    return p.select("p_partkey", F.array_join(runs.nesting_problems(runs.budgets("navigation_timeout_ms", "surface_timeout_ms")), ",").alias("problems"))


@query("""WITH c AS (SELECT c_custkey, c_custkey % 40 <> 1 AS global_on, CASE c_mktsegment WHEN 'MACHINERY' THEN FALSE WHEN 'BUILDING' THEN TRUE END AS source_on, c_nationkey <> 7 AS client_on, c_custkey % 2 = 0 AS dom, c_acctbal < 0 AS unsigned, c_custkey % 10 = 4 AS stranger, c_custkey % 5 AS robots, c_custkey % 3 AS mode, n, e FROM customer LEFT JOIN (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS e FROM events GROUP BY 1) ON user_id = c_custkey),
  f AS (SELECT c_custkey, CASE WHEN NOT global_on THEN 1 WHEN NOT source_on THEN 2 WHEN NOT client_on THEN 3 WHEN dom AND (unsigned OR stranger) THEN 4 WHEN robots = 0 AND mode <> 2 THEN 5 WHEN robots = 1 AND mode = 0 THEN 5 WHEN n >= 5 THEN 6 WHEN e > 0 THEN 7 END AS failed FROM c)
  SELECT c_custkey, failed IS NULL AS allow, CASE WHEN failed <= 3 THEN 'ERR-POLICY-KILLSWITCH' WHEN failed = 4 THEN 'ERR-POLICY-UNAUTHORIZED' WHEN failed = 5 THEN 'ERR-POLICY-ROBOTS' WHEN failed = 6 THEN 'ERR-POLICY-BUDGET' WHEN failed = 7 THEN 'ERR-POLICY-BREAKER-OPEN' END AS code, CAST(coalesce(failed, 7) AS INT) AS checked FROM f""")
def preflight(spark, sf_dir):
    """The seven checks of every customer taken as a target."""
    k = F.col("c_custkey")
    used = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("e"))
    record = F.struct(F.lit("Ann").alias("authorized_by"), F.lit("2024-01-01").alias("authorization_date"), F.when(k % 10 == 4, "friend").otherwise("owner").alias("relationship"), F.when(F.col("c_acctbal") < 0, " ").otherwise("ref").alias("evidence_ref"), F.lit(True).alias("scope_ack"))
    c = table(spark, sf_dir, "customer").join(used, "c_custkey", "left").select(
        k, (k % 40 != 1).alias("global_enabled"), F.when(F.col("c_mktsegment") == "MACHINERY", False).when(F.col("c_mktsegment") == "BUILDING", True).alias("source_enabled"), (F.col("c_nationkey") != 7).alias("client_enabled"), F.when(k % 2 == 0, "dom").otherwise("api").alias("access_method"), record.alias("authorization"),
        F.when(k % 3 == 0, "block").when(k % 3 == 1, "odd").otherwise("ignore").alias("robots_mode"), F.when(k % 5 == 0, False).when(k % 5 > 1, True).alias("robots_allowed"), (F.col("n") < 5).alias("budget_allowed"), (F.col("e") > 0).alias("breaker_open"),
    )
    allow, code, reasons = runs.preflight()
    return c.select("c_custkey", allow.alias("allow"), code.alias("code"), F.size(reasons).alias("checked"))


@query("""SELECT p_partkey, TRY_CAST(nullif(trim(raw), '') AS DOUBLE) AS number, CASE WHEN TRY_CAST(nullif(trim(raw), '') AS DOUBLE) IS NULL THEN 'a number' END AS number_expected,
  CASE WHEN lower(trim(raw)) IN ('true', '1', 'yes', 'on') THEN TRUE WHEN lower(trim(raw)) IN ('false', '0', 'no', 'off') THEN FALSE END AS flag, array_to_string(list_filter(list_transform(string_split(raw, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS list
  FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN ' 12.5 ' WHEN 1 THEN 'YES' WHEN 2 THEN '0' WHEN 3 THEN 'a, b,,c' WHEN 4 THEN '  ' ELSE 'no1' END AS raw FROM part)""")
def environment_values(spark, sf_dir):
    raw = F.expr("CASE p_partkey % 6 WHEN 0 THEN ' 12.5 ' WHEN 1 THEN 'YES' WHEN 2 THEN '0' WHEN 3 THEN 'a, b,,c' WHEN 4 THEN '  ' ELSE 'no1' END")
    number, expected = runs.coerced(raw, "number")
    return table(spark, sf_dir, "part").select("p_partkey", number.alias("number"), expected.alias("number_expected"), runs.coerced(raw, "boolean")[0].alias("flag"), F.array_join(runs.coerced(raw, "list")[0], "|").alias("list"))


_IDENTITY = ("CASE WHEN c_custkey % 6 = 0 THEN 'ChIJ' || replace(c_name, '#', '-') WHEN c_custkey % 6 = 1 THEN 'short' END AS place_id", "CASE WHEN c_custkey % 5 = 0 THEN CAST(1000000 + c_custkey AS VARCHAR) END AS cid", "CASE WHEN c_custkey % 3 = 0 THEN 'http://x/' || c_custkey END AS stored")


@query(f"""SELECT c_custkey, CASE WHEN regexp_full_match(coalesce(place_id, ''), '[A-Za-z0-9_-]{{10,}}') THEN 'explicit_place_id' WHEN cid IS NOT NULL THEN 'explicit_cid' WHEN last > TIMESTAMP '2024-01-02' THEN 'cache' WHEN c_custkey % 7 = 0 THEN 'url' WHEN c_nationkey % 2 = 0 THEN 'search' ELSE 'none' END AS via,
  CASE WHEN place_id IS NOT NULL THEN 'https://www.google.com/maps/place/?q=place_id:' || place_id WHEN cid IS NOT NULL THEN 'https://www.google.com/maps?cid=' || cid ELSE stored END AS url
  FROM (SELECT c_custkey, c_nationkey, {', '.join(_IDENTITY)} FROM customer) LEFT JOIN (SELECT user_id, max(ts) AS last FROM events GROUP BY 1) ON user_id = c_custkey""")
def listing_resolution(spark, sf_dir):
    seen = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.max("ts").cast("timestamp").alias("last"))
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_nationkey", *(x.replace("VARCHAR", "STRING") for x in _IDENTITY)).join(seen, "c_custkey", "left")
    fresh = runs.is_fresh(F.col("last"), F.lit("2024-02-01").cast("timestamp"))
    way = runs.resolution(F.col("place_id"), F.col("cid"), F.lit("place"), fresh, F.when(F.col("c_custkey") % 7 == 0, "cid"), F.lit("1"), F.lit("a search"), runs.may_search(F.when(F.col("c_nationkey") % 2 == 1, False), F.lit("test")))
    return c.select("c_custkey", way["via"].alias("via"), runs.listing_url(F.col("place_id"), F.col("cid"), F.col("stored")).alias("url"))


@query("SELECT doc_id, '«redacted:api_key»' AS masked, CASE WHEN length(t) <= 120 THEN t ELSE substr(t, 1, 120) || '…' END AS cut, CAST(3 AS INT) AS n FROM (SELECT doc_id, replace(coalesce(text, ''), 'the the', '«redacted:phrase»') AS t FROM documents)")
def log_redaction(spark, sf_dir):
    fields = F.create_map(F.lit("api_key"), F.lit("abc"), F.lit("Authorization"), F.lit("x"), F.lit("text"), F.coalesce("text", F.lit("")), F.lit("lang"), F.coalesce("lang", F.lit("")))
    r = table(spark, sf_dir, "documents").select("doc_id", runs.redacted(fields, {"phrase": "the the"}).alias("r"))
    return r.select("doc_id", F.col("r")["api_key"].alias("masked"), F.col("r")["text"].alias("cut"), F.size("r").alias("n"))


@query("SELECT o_orderpriority, count(*) FILTER (outcome IN ('HELD', 'IGNORED_TERMINAL')) AS no_op, count(*) FILTER (outcome NOT IN ('HELD', 'IGNORED_TERMINAL')) AS changed FROM (SELECT o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'HELD' WHEN 'O' THEN 'UPDATED' ELSE 'IGNORED_TERMINAL' END AS outcome FROM orders) GROUP BY 1")
def no_op_outcomes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("outcome", F.when(F.col("o_orderstatus") == "F", "HELD").when(F.col("o_orderstatus") == "O", "UPDATED").otherwise("IGNORED_TERMINAL"))
    return o.groupBy("o_orderpriority").agg(F.count_if(runs.is_no_op(F.col("outcome"))).alias("no_op"), F.count_if(~runs.is_no_op(F.col("outcome"))).alias("changed"))


@query("SELECT source, array_to_string(list_filter([CASE WHEN n1 + n2 <> total THEN 'distribution' END, CASE WHEN coverage > 1 THEN 'coverage' END], lambda x: x IS NOT NULL), ',') AS problems FROM (SELECT source, count(*) AS total, count(*) FILTER (n_chars % 7 < 3) AS n1, count(*) FILTER (n_chars % 7 >= 3 AND n_chars > 40) AS n2, count(*) FILTER (lang = 'en') / 100.0 AS coverage FROM documents GROUP BY 1)")
def stats_consistency(spark, sf_dir):
    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("n_chars") % 7 < 3).alias("n1"), F.count_if((F.col("n_chars") % 7 >= 3) & (F.col("n_chars") > 40)).alias("n2"), (F.count_if(F.col("lang") == "en") / 100.0).alias("coverage"), F.count("text").alias("texts"))
    return d.select("source", F.array_join(runs.stats_problems(F.col("total"), [F.col("n1"), F.col("n2")], F.col("texts"), F.lit(0), F.col("coverage")), ",").alias("problems"))


@query("SELECT source, review_id, rating, text_md5, likes FROM (SELECT 'orders' AS source, o_orderkey AS review_id, CAST(o_orderkey % 5 + 1 AS INT) AS rating, NULL AS text_md5, CAST(o_custkey AS BIGINT) AS likes FROM orders UNION ALL SELECT 'documents', doc_id, NULL, md5(text), NULL FROM documents)")
def union_of_sources(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("review_id"), (F.col("o_orderkey") % 5 + 1).cast("int").alias("rating"), F.col("o_custkey").cast("long").alias("likes"))
    d = table(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("review_id"), F.md5("text").alias("text_md5"))
    return runs.union_of_sources(o, d)


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'long' END AS summary, CASE WHEN lang = 'en' OR n_chars > 3000 THEN lang END AS language_detected, lang = 'en' OR n_chars > 3000 AS annotated FROM documents")
def enrichment(spark, sf_dir):
    first = {"summary": F.when(F.col("lang") == "en", "short"), "language_detected": F.when(F.col("n_chars") > 3000, F.col("lang"))}
    second = {"summary": F.when(F.col("lang") == "en", "long"), "language_detected": F.when(F.col("lang") == "en", "en")}
    d = runs.enriched(table(spark, sf_dir, "documents"), first, second)
    return d.select("doc_id", "ai.summary", "ai.language_detected", F.col("ai").isNotNull().alias("annotated"))


# --- extraction

def _ways(*ways):
    """Strategies from (selector, attribute, pattern)."""
    return {"strategies": [{"selector": s, **dict(zip(("attribute", "pattern"), more, strict=False))} for s, *more in ways]}


PACK = extraction.read_pack({
    "containers": {"surface": _ways((":broken",), ("#surface",)), "review_node": _ways((".none",), ("div.review",)), "reply_node": _ways(("div.reply",))},
    "fields": {
        "rating": _ways((".stars", "aria-label")), "author_name": _ways(("span.old-author",), ("span.author",)), "text": _ways(("span.text",)), "author_badges": _ways(("span.badge",)), "likes": _ways(("span[data-likes]", "data-likes")),
        "reply_text": _ways(("span.text",)),
    },
})


def _escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _review_pages(spark, sf_dir):
    """A page for each conversation: each user turn is a review, the assistant's turn after it the owner's reply."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations").withColumns({"reply": F.when(F.lead("role").over(w) == "assistant", F.lead("text").over(w))}).where("role = 'user'")
    piece = F.concat(
        F.lit('<div class="big review"><img src=x><span class=stars aria-label="Rated '), (F.length("text") % 7).cast("string"), F.lit(' stars"></span>'),
        F.when(F.col("turn") % 8 == 4, "").otherwise(F.concat(F.lit('<span class="author">Author '), F.col("conv_id").cast("string"), F.lit("</i></span><span class=badge>Guide</span><span class=badge>Local</span>"))),
        F.when(F.col("reply").isNotNull(), F.concat(F.lit("<div class=reply><span class=text>"), _escaped(F.col("reply")), F.lit("</span></div>"))).otherwise(""),
        F.lit("<span class=text>"), _escaped(F.coalesce("text", F.lit(""))), F.lit('</span><span data-likes="1.234 likes">x</span></div>'),
    )
    pages = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", piece.alias("piece")))), lambda x: x["piece"]), "").alias("body"))
    return pages.select("conv_id", F.when(F.col("conv_id") % 10 == 3, F.col("body")).when(F.col("conv_id") % 10 == 7, '<p id="surface">').otherwise(F.concat(F.lit('<p id="surface">'), "body")).alias("html"))


_REVIEWS = r"""WITH u AS (SELECT *, CASE WHEN lead(role) OVER w = 'assistant' THEN lead(text) OVER w END AS reply FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS o, length(text) % 7 AS stars FROM u WHERE role = 'user')
  SELECT conv_id, CAST(o AS INT) AS ordinal, CASE WHEN stars BETWEEN 1 AND 5 THEN CAST(stars AS INT) END AS rating, CASE WHEN turn % 8 <> 4 THEN 'Author ' || conv_id END AS author_name, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS text_md5, CASE WHEN turn % 8 <> 4 THEN 'Guide|Local' ELSE '' END AS badges, CAST(1234 AS BIGINT) AS likes,
    md5(trim(regexp_replace(reply, '\s+', ' ', 'g'))) AS reply_md5, CAST(CASE WHEN turn % 8 <> 4 THEN 1 END AS INT) AS author_strategy, CASE WHEN stars NOT BETWEEN 1 AND 5 THEN 'ERR-PARSE-RATING-INVALID' WHEN turn % 8 = 4 THEN 'ERR-PARSE-FIELD-REQUIRED' END AS code FROM r WHERE conv_id % 10 NOT IN (3, 7)
  UNION ALL SELECT DISTINCT conv_id, CAST(NULL AS INT), CAST(NULL AS INT), NULL, NULL, NULL, CAST(NULL AS BIGINT), NULL, CAST(NULL AS INT), CASE conv_id % 10 WHEN 3 THEN 'ERR-PARSE-STRUCTURE' ELSE 'ERR-PARSE-EMPTY-UNEXPECTED' END FROM r WHERE conv_id % 10 IN (3, 7)"""


def _reviews(spark, sf_dir):
    return extraction.extracted(extraction.located(_review_pages(spark, sf_dir), PACK, "conv_id"), F.lit("de"))


@query(_REVIEWS)
def page_reviews(spark, sf_dir):
    r = _reviews(spark, sf_dir)
    return r.select("conv_id", "ordinal", "rating", "author_name", F.md5("text").alias("text_md5"), F.array_join("badges", "|").alias("badges"), "likes", F.md5("reply_text").alias("reply_md5"), F.col("strategies")["author_name"].alias("author_strategy"), F.col("quarantine.code").alias("code"))


@query(f"""SELECT conv_id, count(*) FILTER (code IS NULL) AS accepted, count(*) FILTER (code IS NOT NULL) AS quarantined, count(*) FILTER (code IS NOT NULL) / count(*) AS quarantine_rate, least(1.0, count(ordinal) / 4) AS coverage, CAST(count(DISTINCT text_md5) - count(DISTINCT CASE WHEN copies = 1 THEN text_md5 END) AS BIGINT) AS duplicates,
  count(*) FILTER (code IN ('ERR-PARSE-STRUCTURE', 'ERR-PARSE-EMPTY-UNEXPECTED')) > 0 AS has_fatal FROM (SELECT *, count(*) OVER (PARTITION BY conv_id, text_md5) AS copies FROM ({_REVIEWS})) GROUP BY 1""")
def harvest_validation(spark, sf_dir):
    r = _reviews(spark, sf_dir).withColumns({"id": F.md5("text"), "fatal": F.col("quarantine.code").isin("ERR-PARSE-STRUCTURE", "ERR-PARSE-EMPTY-UNEXPECTED"), "rejected": F.col("quarantine").isNotNull()})
    return runs.validation(r, "conv_id", advertised=F.lit(4)).select("conv_id", "accepted", "quarantined", "quarantine_rate", "coverage", "duplicates", "has_fatal")


@query("""WITH r AS (SELECT o_custkey AS harvest, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN 'short' ELSE md5(CAST(floor(o_totalprice / 50000) AS BIGINT)::VARCHAR) END AS id, o_orderkey % 8 AS rating, o_orderstatus = 'P' AS nameless, o_orderpriority = '5-LOW' AS textless, o_orderpriority = '1-URGENT' AS endless, o_orderdate < DATE '1994-01-01' AS dateless FROM orders)
  SELECT harvest, 'ERR-PARSE-RATING-INVALID' AS code, 'fatal' AS severity, id, 'rating' AS field FROM r WHERE rating NOT IN (1, 2, 3, 4, 5) UNION ALL SELECT harvest, 'ERR-INTERNAL-INVARIANT', 'fatal', id, 'identity_hash' FROM r WHERE id IS NULL OR length(id) <> 32 UNION ALL SELECT harvest, 'ERR-CLEAN-MARKUP-SURVIVED', 'fatal', id, 'text' FROM r WHERE endless
  UNION ALL SELECT harvest, 'ERR-PARSE-FIELD-REQUIRED', 'info', id, 'author.name' FROM r WHERE nameless AND textless UNION ALL SELECT harvest, 'ERR-PARSE-FIELD-REQUIRED', 'warn', id, 'date_estimated' FROM r WHERE dateless UNION ALL SELECT harvest, 'ERR-VALIDATE-AGGREGATE', 'warn', id, 'identity_hash' FROM r WHERE id IS NOT NULL GROUP BY harvest, id HAVING count(*) >= 2""")
def harvest_findings(spark, sf_dir):
    """Every finding of harvests made from orders."""
    k = F.col("o_orderkey") % 10
    o = table(spark, sf_dir, "orders").withColumn("id", F.when(k == 0, None).when(k == 1, "short").otherwise(F.md5(F.floor(F.col("o_totalprice") / 50000).cast("long").cast("string"))))
    text = F.when(F.col("o_orderpriority") == "1-URGENT", F.repeat(F.lit("x"), F.lit(5001))).when(F.col("o_orderpriority") != "5-LOW", "fine")
    found = runs.record_findings(F.col("o_orderkey") % 8, F.col("id"), text, F.when(F.col("o_orderstatus") != "P", "Ann"), F.when(F.col("o_orderdate") >= "1994-01-01", F.col("o_orderdate")))
    return runs.findings(o.select(F.col("o_custkey").alias("harvest"), "id", found.alias("findings")), "harvest")


#: Selectors with descendants, children, attributes and lists.
SELECTORS = ["nav li > a", "nav a[href^='/t'], nav a[href^='/T']", "body > article > h1", "head title", "ul > a", "html[lang='en'] article", "div.ad, [class='ad'], #none"]


@query(r"""SELECT page_id, selector, CAST(n AS BIGINT) AS n, CASE WHEN n > 0 THEN first END AS first FROM (SELECT page_id, 'nav li > a' AS selector, len(regexp_extract_all(nav, '<li><a ')) AS n, regexp_extract(nav, '<li><a href="([^"]*)"', 1) AS first FROM (SELECT page_id, regexp_extract(html, '<nav>.*?</nav>') AS nav FROM pages)
  UNION ALL SELECT page_id, 'nav a[href^=''/t''], nav a[href^=''/T'']', len(regexp_extract_all(nav, '<a href="/[tT]')), regexp_extract(nav, '<a href="(/[tT][^"]*)"', 1) FROM (SELECT page_id, regexp_extract(html, '<nav>.*?</nav>') AS nav FROM pages)
  UNION ALL SELECT page_id, 'body > article > h1', len(regexp_extract_all(html, '<article><h1>')), NULL FROM pages UNION ALL SELECT page_id, 'head title', len(regexp_extract_all(html, '<title>')), NULL FROM pages UNION ALL SELECT page_id, 'ul > a', 0, NULL FROM pages
  UNION ALL SELECT page_id, 'html[lang=''en''] article', CASE WHEN html LIKE '<!DOCTYPE html><html lang="en">%' THEN len(regexp_extract_all(html, '<article>')) ELSE 0 END, NULL FROM pages UNION ALL SELECT page_id, 'div.ad, [class=''ad''], #none', len(regexp_extract_all(html, '<div class="ad">')), NULL FROM pages)""")
def selector_matches(spark, sf_dir):
    return extraction.matches(table(spark, sf_dir, "pages"), SELECTORS)


FEED = extraction.read_pack({
    "containers": {"surface": _ways(("[role='main'] [role='feed']",), ("[data-review-list]",)), "review_node": _ways(("[role='feed'] > [role='article']",), ("[data-review-id]",)), "reply_node": _ways(("[data-owner-reply]",), ("[role='article'] [role='comment']",))},
    "fields": {
        "author_name": {"required": True, **_ways(("[aria-label^='Review by']", "aria-label", "^Review by (.+)$"), ("[role='article'] > :first-child a",), ("header a[href*='/contrib/']",))}, "author_profile_url": _ways(("header a[href*='/contrib/']", "href")),
        "rating": _ways(("[role='img'][aria-label]", "aria-label", "([0-9](?:[.,][0-9])?)")), "rating_numeric": _ways(("[data-rating-value]", "data-rating-value")), "text": _ways(("[data-review-text]",)), "reply_text": _ways(("[role='comment'] [lang]", ), ("p > [lang], p > em",)),
    },
    "rating_stars": {"filled_selector": "[role='img'] [data-star-filled]", "total_selector": "[role='img'] [data-star]"}, "truncation_markers": ["More", "Mehr"],
    "signals": {"challenge": {"patterns": ["Unusual traffic"], "confidence": "high"}, "empty_state": {"patterns": ["No reviews yet"], "confidence": "high"}, "consent": {"patterns": ["before you continue"], "confidence": "medium"}, "robot": {"patterns": ["robot check"], "confidence": "medium"}},
})


def _feed_pages(spark, sf_dir):
    """A page for each conversation in the markup that FEED reads; its turns rate by label, by stars or by a number."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations").withColumns({"reply": F.when(F.lead("role").over(w) == "assistant", F.lead("text").over(w))}).where("role = 'user'")
    k = F.length("text") % 7
    label = F.concat(F.lit('<i role=img aria-label="'), k.cast("string"), F.lit(' of five"></i>'))
    stars = F.concat(F.lit("<i role=img>"), F.repeat(F.lit("<b data-star data-star-filled></b>"), F.least(k, F.lit(5))), F.repeat(F.lit("<b data-star></b>"), 5 - F.least(k, F.lit(5))), F.lit("</i>"))
    number = F.concat(F.lit('<i data-rating-value="'), k.cast("string"), F.lit('">x</i>'))
    piece = F.concat(
        F.lit("<div role=article><header><a href='/maps/contrib/"), F.col("conv_id").cast("string"), F.lit("'>Guest "), F.col("conv_id").cast("string"), F.lit("</a></header>"), F.when(F.col("turn") % 3 == 0, label).when(F.col("turn") % 3 == 1, stars).otherwise(number),
        F.when(F.col("turn") % 4 == 0, F.concat(F.lit('<u aria-label="Review by Ann '), F.col("turn").cast("string"), F.lit('"></u>'))).otherwise(""),
        F.when(F.col("reply").isNotNull(), F.concat(F.lit("<section data-owner-reply><p><em>"), _escaped(F.col("reply")), F.lit("</em></p></section>"))).otherwise(""), F.lit("<p data-review-text>"), _escaped(F.coalesce("text", F.lit(""))), F.when(F.length("text") % 5 == 0, " More").otherwise(""), F.lit("</p></div>"),
    )
    pages = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", piece.alias("piece")))), lambda x: x["piece"]), "").alias("body"))
    kind, feed = F.col("conv_id") % 9, lambda x: F.concat(F.lit("<div role=main><div role=feed>"), x, F.lit("</div></div>"))
    return pages.select("conv_id", F.when(kind == 1, F.lit("<b>UNUSUAL TRAFFIC</b>")).when(kind == 2, feed(F.lit("<i>No reviews yet</i>"))).when(kind == 3, F.concat(feed("body"), F.lit("Before you continue"))).when(kind == 4, F.concat(F.lit("robot check"), feed("body"))).when(kind == 5, feed(F.lit(""))).when(kind == 6, F.concat(F.lit("<div role=main></div><div role=feed>"), "body", F.lit("</div>"))).otherwise(feed("body")).alias("html"))


@query(r"""WITH u AS (SELECT *, CASE WHEN lead(role) OVER w = 'assistant' THEN lead(text) OVER w END AS reply FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS o, length(text) % 7 AS k, trim(regexp_replace(text, '\s+', ' ', 'g')) AS body FROM u WHERE role = 'user'), s AS (SELECT *, CASE turn % 3 WHEN 1 THEN CASE WHEN k > 0 THEN least(k, 5) END ELSE k END AS given, length(text) % 5 = 0 AS cut FROM r)
  SELECT conv_id, CAST(o AS INT) AS ordinal, CASE WHEN given BETWEEN 1 AND 5 THEN CAST(given AS INT) END AS rating, CASE WHEN turn % 4 = 0 THEN 'Ann ' || turn ELSE 'Guest ' || conv_id END AS author_name, CAST(CASE WHEN turn % 4 = 0 THEN 0 ELSE 2 END AS INT) AS author_strategy, '/maps/contrib/' || conv_id AS profile, md5(nullif(body, '')) AS text_md5, cut AS text_truncated,
    md5(trim(regexp_replace(reply, '\s+', ' ', 'g'))) AS reply_md5, CASE WHEN given IS NULL THEN 'ERR-PARSE-FIELD-REQUIRED' WHEN given NOT BETWEEN 1 AND 5 THEN 'ERR-PARSE-RATING-INVALID' END AS code FROM s WHERE conv_id % 9 IN (0, 7, 8)
  UNION ALL SELECT DISTINCT conv_id, CAST(NULL AS INT), CAST(NULL AS INT), NULL, CAST(NULL AS INT), NULL, NULL, CASE WHEN conv_id % 9 IN (5, 6) THEN false END, NULL, CASE conv_id % 9 WHEN 1 THEN 'ERR-BLOCKED-CHALLENGE' WHEN 3 THEN 'ERR-NAV-CONSENT-WALL' WHEN 4 THEN 'ERR-NAV-SURFACE-NOT-FOUND' WHEN 5 THEN 'ERR-PARSE-EMPTY-UNEXPECTED' ELSE 'ERR-PARSE-STRUCTURE' END FROM r WHERE conv_id % 9 BETWEEN 1 AND 6 AND conv_id % 9 <> 2""")
def pack_reviews(spark, sf_dir):
    """Every step of extraction by a pack: signals, surface, nodes, replies cut off, rating cascade, truncation markers, quarantine."""
    r = extraction.extract_reviews(_feed_pages(spark, sf_dir), FEED, F.lit("en"), "conv_id")
    return r.select("conv_id", "ordinal", "rating", "author_name", F.col("strategies")["author_name"].alias("author_strategy"), F.col("author_profile_url").alias("profile"), F.md5("text").alias("text_md5"), "text_truncated", F.md5("reply_text").alias("reply_md5"), F.col("quarantine.code").alias("code"))


@query(r"""SELECT page_id, CASE WHEN NOT regexp_matches(coalesce(html, ''), '\S') THEN 'empty' ELSE concat_ws('|', CASE WHEN regexp_matches(html, '(?i)<(html|body|head)\b') THEN 'document-level element' END, CASE WHEN regexp_matches(html, '(?i)<script\b') THEN 'script element' END) END AS problems
  FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN html WHEN 1 THEN regexp_extract(html, '(?s)<article>.*</article>') WHEN 2 THEN regexp_extract(html, '(?s)<script>.*</script>') END AS html FROM pages)""")
def fixture_check(spark, sf_dir):
    h, k = F.col("html"), F.col("page_id") % 4
    cut = F.when(k == 0, h).when(k == 1, F.regexp_extract(h, "(?s)(<article>.*</article>)", 1)).when(k == 2, F.regexp_extract(h, "(?s)(<script>.*</script>)", 1))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(extraction.fixture_problems(cut), "|").alias("problems"))


@query(r"""SELECT CASE WHEN doc_id % 13 > 0 THEN CAST(doc_id AS VARCHAR) END AS external_id, CASE WHEN doc_id % 6 = 0 THEN 'rating' WHEN doc_id % 17 = 0 THEN 'date' END AS reject_reason, md5(nullif(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '')) AS text_md5, source AS author_name FROM documents""")
def csv_reviews(spark, sf_dir):
    """Documents written as CSV files, texts quoted with their line breaks, and read back by blocks."""
    d = table(spark, sf_dir, "documents")
    rows = d.select(F.col("source").alias("Author_Name"), (F.col("doc_id") % 6).alias("rating"), F.when(F.col("doc_id") % 17 > 0, "2024-01-01").otherwise(" ").alias("Date"), F.col("text").alias("TEXT"), F.when(F.col("doc_id") % 13 > 0, F.col("doc_id")).alias("external_id"))
    folder = lineage.shared_path(spark, "csv")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(folder)
    return readers.read_csv(spark, folder).select("external_id", "reject_reason", F.md5("text").alias("text_md5"), "author_name")


# --- records, functions of the user's, publishing


@query("""SELECT o_orderkey, sha256('{"a":{"b":"' || o_orderstatus || '","k":[1,null,true,0.5,100]},"id":' || o_orderkey || ',"z":' || regexp_replace(CAST(o_totalprice AS VARCHAR), '\\.0$', '') || ',"é":"' || o_orderpriority || '"}') AS hash FROM orders""")
def canonical_hashes(spark, sf_dir):
    """Records whose keys come in one order or the other and whose numbers are written in several ways."""
    price, key = F.col("o_totalprice").cast("string"), F.col("o_orderkey").cast("string")
    inner = F.concat(F.lit('{"k": [1.0, null, true, 5e-1, 1E2], "b": "'), "o_orderstatus", F.lit('"}'))
    one = F.concat(F.lit('{"é":"'), "o_orderpriority", F.lit('","z":'), price, F.lit(',"a":'), inner, F.lit(',"id":'), key, F.lit(".0}"))
    other = F.concat(F.lit('{"id": '), key, F.lit(', "a": '), inner, F.lit(', "\\u00e9": "'), "o_orderpriority", F.lit('", "z": '), price, F.lit("}"))
    return table(spark, sf_dir, "orders").select("o_orderkey", canonical.hash_of(F.when(F.col("o_orderkey") % 2 == 0, one).otherwise(other)).alias("hash"))


@query(r"""SELECT conv_id, turn, role, md5(CASE WHEN length(t) <= 120 THEN t ELSE substr(t, 1, 120) || '…' END) AS text_md5, '«redacted:authToken»' AS token, 'https://a.example/c?w=5' AS link, 'see «redacted:both»!' AS note, true AS no_cookie, '«redacted:depth»' AS deepest, '«redacted:author»' AS author FROM (SELECT *, replace(text, 'the', 'the') AS t FROM conversations)""")
def nested_redaction(spark, sf_dir):
    """Nested records of conversations, with secrets of which one holds another."""
    c = table(spark, sf_dir, "conversations")
    deep = F.concat(F.repeat(F.lit('{"d":'), F.lit(12)), F.lit("1"), F.repeat(F.lit("}"), F.lit(12)))
    record = F.concat(F.lit('{"msg":{"text":'), F.to_json(F.struct(F.col("text").alias("t")), {"ignoreNullFields": "false"}).substr(F.lit(6), F.length(F.to_json(F.struct(F.col("text").alias("t")), {"ignoreNullFields": "false"})) - 6), F.lit(',"meta":[{"authToken":"x"},{"note":"see abc-secret-long!","url":"https://a.example/c?id=7&w=5#x"}],"Name":"Ann"},"Cookie":"c","deep":'), deep, F.lit("}"))
    r = c.select("conv_id", "turn", "role", redaction.redacted(record, {"part": "secret", "both": "abc-secret-long"}).alias("r"))
    at = lambda p: F.get_json_object("r", p)
    return r.select("conv_id", "turn", "role", F.md5(at("$.msg.text")).alias("text_md5"), at("$.msg.meta[0].authToken").alias("token"), at("$.msg.meta[1].url").alias("link"), at("$.msg.meta[1].note").alias("note"), (~F.col("r").contains("ookie")).alias("no_cookie"), at("$.deep.d.d.d.d.d.d.d.d").alias("deepest"), at("$.msg.Name").alias("author"))


def _summary(frame):
    if (frame["doc_id"] % 97 == 0).any():
        raise ValueError("a row that can't be read")
    return pd.DataFrame({"summary": frame["text"].fillna("").str.slice(0, 20), "sentiment_score": frame["n_chars"] / 2.0, "rating": 1})


def _language(frame):
    return pd.DataFrame({"language_detected": frame["lang"].where(frame["n_chars"] > 3000, None), "summary": frame["lang"].where(frame["lang"] == "de", None)})


@query("SELECT doc_id, CASE WHEN lang = 'de' THEN lang WHEN doc_id % 97 > 0 THEN substr(coalesce(text, ''), 1, 20) END AS summary, CASE WHEN doc_id % 97 > 0 THEN n_chars / 2.0 END::DOUBLE AS score, CASE WHEN n_chars > 3000 THEN lang END AS language, CASE WHEN doc_id % 97 = 0 THEN 'summary' ELSE '' END AS failed, CASE WHEN doc_id % 97 > 0 THEN 'rating' ELSE '' END AS rejected FROM documents")
def enrichment_functions(spark, sf_dir):
    """Two functions over batches of documents, of which one raises on some rows and writes a field it may not."""
    d = enrich.enriched(table(spark, sf_dir, "documents"), {"summary": _summary, "language": _language})
    return d.select("doc_id", "ai.summary", F.col("ai.sentiment_score").alias("score"), F.col("ai.language_detected").alias("language"), F.array_join("ai_failed", "|").alias("failed"), F.array_join("ai_rejected", "|").alias("rejected"))


@query("""SELECT o_orderkey::VARCHAR AS artifact, CASE WHEN o_custkey % 3 = 0 THEN 'second ' || o_orderstatus WHEN o_orderkey % 10 = 0 THEN 'first ' || o_orderstatus WHEN o_orderkey % 5 = 0 THEN 'second ' || o_orderstatus ELSE 'first ' || o_orderstatus END AS body, CAST(CASE WHEN o_custkey % 3 = 0 OR o_orderkey % 10 = 5 THEN 2 ELSE 1 END AS BIGINT) AS version FROM orders""")
def published_changes(spark, sf_dir):
    """Artifacts of orders published twice: what the second run writes is what is new, or differs in bytes and in content hash."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    row = lambda body, content: [F.lit("c").alias("client"), F.lit("l").alias("listing"), key.cast("string").alias("artifact"), F.concat(F.lit(body), F.lit(" "), "o_orderstatus").alias("body"), content.alias("content_hash")]
    first = o.where("o_custkey % 3 > 0").select(*row("first", key.cast("string")))
    second = o.where((key % 5 == 0) | (F.col("o_custkey") % 3 == 0)).select(*row("second", F.when(key % 10 == 0, key.cast("string")).otherwise(F.concat(key.cast("string"), F.lit("b")))))
    same = o.where((key % 5 > 0) & (F.col("o_custkey") % 3 > 0)).select(*row("first", key.cast("string")))
    folder = lineage.shared_path(spark, "published")
    publish.publish(first, folder)
    publish.publish(second.union(same), folder)
    return publish.published(spark, folder).select("artifact", "body").join(publish.state(spark, folder).select("artifact", "version"), "artifact")


@query("""WITH h AS (SELECT CASE user_id % 6 WHEN 0 THEN 'ERR-BLOCKED-CHALLENGE' WHEN 1 THEN 'ERR-NET-DNS' WHEN 2 THEN 'ERR-CONFIG-INVALID' ELSE 'ERR-NO-SUCH' END AS code, CASE WHEN user_id % 7 > 0 THEN 'c' || user_id % 50 END AS client, CASE WHEN user_id % 11 > 0 THEN 'l' || user_id % 3 END AS listing, 'a' || user_id % 2 AS adapter FROM events WHERE event_type = 'error'),
  t AS (SELECT *, coalesce(client, 'unknown') || '/' || coalesce(listing, 'all') AS target, CASE code WHEN 'ERR-BLOCKED-CHALLENGE' THEN 'source' WHEN 'ERR-CONFIG-INVALID' THEN 'run' ELSE 'target' END AS scope, CASE code WHEN 'ERR-BLOCKED-CHALLENGE' THEN 'critical' WHEN 'ERR-NET-DNS' THEN 'warn' ELSE 'error' END AS severity FROM h)
  SELECT '[alert:' || severity || ':' || code || ':' || CASE scope WHEN 'source' THEN 'source/' || adapter WHEN 'run' THEN 'run' ELSE 'client/' || target END || ']' AS fingerprint, severity, code AS condition, min(code || ' — ' || target) AS title, bool_or(severity = 'critical') AS in_maintenance FROM t GROUP BY 1, 2, 3""")
def error_alerts(spark, sf_dir):
    """Alerts of the error classes of a health series made from events, and which are still sent in maintenance."""
    u = F.col("user_id")
    h = table(spark, sf_dir, "events").where("event_type = 'error'").select(
        F.when(u % 6 == 0, "ERR-BLOCKED-CHALLENGE").when(u % 6 == 1, "ERR-NET-DNS").when(u % 6 == 2, "ERR-CONFIG-INVALID").otherwise("ERR-NO-SUCH").alias("error_class"), F.when(u % 7 > 0, F.concat(F.lit("c"), (u % 50).cast("string"))).alias("client_slug"), F.when(u % 11 > 0, F.concat(F.lit("l"), (u % 3).cast("string"))).alias("listing_key"),
        F.concat(F.lit("a"), (u % 2).cast("string")).alias("adapter"), F.lit(None).cast("string").alias("stop_reason"),
    )
    classes = spark.createDataFrame([("ERR-BLOCKED-CHALLENGE", "source", "critical"), ("ERR-NET-DNS", "target", "warn"), ("ERR-CONFIG-INVALID", "run", "error")], "code string, scope string, severity string")
    found = health.error_alerts(h, classes)
    sent = health.deliverable(found, maintenance=True).select("fingerprint", F.lit(True).alias("in_maintenance"))
    return found.join(sent, "fingerprint", "left").select("fingerprint", "severity", "condition", "title", F.coalesce("in_maintenance", F.lit(False)).alias("in_maintenance"))


@query(r"""WITH t AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations), r AS (SELECT * FROM t WHERE k < 5 AND conv_id % 8 > 0 AND (turn % 4 > 0 OR text IS NOT NULL))
  SELECT 'c' || conv_id || '-' || turn AS author_name, CASE WHEN turn % 4 > 0 THEN CAST(turn % 5 + 1 AS VARCHAR) END AS rating, md5(text) AS text_md5, n AS advertised_total, 'cap_reached' AS stop_reason, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS ordinal FROM r UNION ALL SELECT NULL, NULL, NULL, NULL, 'error', NULL FROM (SELECT DISTINCT conv_id FROM t WHERE conv_id % 8 = 0)""")
def acquired_files(spark, sf_dir):
    """Place details made of conversations, written as files and read by the data source; some of them are broken."""
    one = F.struct(F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("author_name"), F.when(F.col("turn") % 4 > 0, F.col("turn") % 5 + 1).alias("rating"), "text")
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", one.alias("r")))), lambda x: x["r"]).alias("reviews"), F.count("*").alias("n"))
    whole = F.to_json(F.struct(F.struct(F.col("reviews"), F.col("n").alias("user_ratings_total")).alias("result")))
    folder = lineage.shared_path(spark, "places")
    c.select(F.when(F.col("conv_id") % 8 == 0, F.left(whole, F.lit(20))).otherwise(whole).alias("value")).write.text(folder)
    port.register(spark)
    rows = spark.read.format("review_files").option("path", folder).option("adapter", "places").load()
    return rows.select("author_name", "rating", F.md5("text").alias("text_md5"), "advertised_total", "stop_reason", "ordinal")


# --- sources


@query("SELECT conv_id, turn // 2 AS page, count(*) OVER (PARTITION BY conv_id ORDER BY turn // 2) AS growth, CAST(row_number() OVER (PARTITION BY conv_id, turn // 2 ORDER BY turn) - 1 AS INT) AS pos, CASE WHEN turn % 6 > 0 THEN CAST(turn % 6 AS INT) END AS rating FROM conversations WHERE turn // 2 < 40")
def paged_reviews(spark, sf_dir):
    word = F.element_at(F.array(*map(F.lit, ("NONE", "ONE", "TWO", "THREE", "FOUR", "FIVE"))), (F.col("turn") % 6 + 1).cast("int"))
    one = F.struct(F.struct(F.col("role").alias("displayName")).alias("reviewer"), word.alias("starRating"), F.col("text").alias("comment"), F.lit("2024-01-01").alias("createTime"), F.col("turn"))
    pages = table(spark, sf_dir, "conversations").groupBy("conv_id", F.floor(F.col("turn") / 2).alias("page")).agg(F.array_sort(F.collect_list(one), lambda a, b: (a["turn"] - b["turn"]).cast("int")).alias("reviews"), F.lit(9).alias("totalReviewCount"))
    return readers.paged_reviews(pages, "conv_id").select("conv_id", "page", F.col("growth"), "pos", "rating")


@query("SELECT source, CAST(pos AS INT) AS pos, rating, md5(text) AS text_md5 FROM (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, CASE WHEN n_chars % 3 > 0 THEN CAST(n_chars % 5 + 1 AS INT) END AS rating, CASE WHEN n_chars % 2 = 0 THEN text END AS text FROM documents) WHERE pos < 5 AND (rating IS NOT NULL OR text IS NOT NULL)")
def place_reviews(spark, sf_dir):
    w = Window.partitionBy("source").orderBy("doc_id")
    d = table(spark, sf_dir, "documents").withColumn("r", F.row_number().over(w)).where("r <= 8")
    one = F.struct("doc_id", F.lit("a").alias("author_name"), F.when(F.col("n_chars") % 3 > 0, F.col("n_chars") % 5 + 1).cast("int").alias("rating"), F.when(F.col("n_chars") % 2 == 0, F.col("text")).alias("text"), F.lit("a week ago").alias("relative_time_description"), F.lit(1).alias("time"), F.lit("en").alias("language"), F.lit("u").alias("profile_photo_url"), F.lit("u").alias("author_url"))
    places = d.groupBy("source").agg(F.array_sort(F.collect_list(one), lambda a, b: (a["doc_id"] - b["doc_id"]).cast("int")).alias("reviews")).select("source", F.struct(F.lit(4.5).alias("rating"), F.lit(100).alias("user_ratings_total"), "reviews").alias("result"))
    return readers.place_reviews(places, "source").select("source", "pos", "rating", F.md5("text").alias("text_md5"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus = 'F' OR o_custkey % 2 = 0 ELSE FALSE END AS published, CASE o_orderpriority WHEN '1-URGENT' THEN 'full' WHEN '2-HIGH' THEN 'full_capped' WHEN '3-MEDIUM' THEN 'partial' ELSE 'failed' END AS completeness FROM orders")
def published_rows(spark, sf_dir):
    status, even = F.col("o_orderstatus"), F.col("o_custkey") % 2 == 0
    state = F.when(status == "F", F.when(even, "active").otherwise("unconfirmed")).when(status == "O", F.when(even, "active").otherwise("suppressed")).otherwise("tombstoned")
    priority = F.col("o_orderpriority")
    stop = F.when(priority == "1-URGENT", "exhausted").when(priority == "2-HIGH", "cap_reached").when(priority == "3-MEDIUM", "stalled").when(priority == "5-LOW", "who knows").otherwise("error")
    return table(spark, sf_dir, "orders").select("o_orderkey", merge.publishable(state).alias("published"), merge.completeness_of(stop).alias("completeness"))


@query("""WITH h AS (SELECT user_id, event_type, max(ts) AS now FROM events GROUP BY 1, 2), k AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '2023-12-01 00:00:00' END AS last FROM customer WHERE c_custkey < 1000)
  SELECT coalesce(c_custkey, user_id) AS listing, coalesce(strftime(now, '%Y-%m-%d %H:%M:%S'), '2023-12-31 00:00:00') AS updated_at, CASE WHEN user_id IS NOT NULL AND user_id % 3 = 0 THEN strftime(now, '%Y-%m-%d %H:%M:%S') ELSE last END AS last_full_harvest_at FROM k FULL JOIN (SELECT user_id, now FROM h WHERE event_type = 'view') ON user_id = c_custkey""")
def harvest_times(spark, sf_dir):
    h = table(spark, sf_dir, "events").where("event_type = 'view'").groupBy(F.col("user_id").alias("listing")).agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("now")).withColumn("completeness", F.when(F.col("listing") % 3 == 0, "full").otherwise("partial"))
    known = table(spark, sf_dir, "customer").where("c_custkey < 1000").select(F.col("c_custkey").alias("listing"), F.lit("2023-12-31 00:00:00").alias("updated_at"), F.when(F.col("c_custkey") % 2 == 0, "2023-12-01 00:00:00").alias("last_full_harvest_at"))
    return merge.record_harvests(known, h)


@query("SELECT page_id, 'https://x/' || page_id || '=s128-c' AS avatar, CAST(greatest(1, floor(page_id * least(greatest(page_id % 15 / 10.0, 0.1), 1.0))) AS BIGINT) AS step FROM pages")
def display_rules(spark, sf_dir):
    k = F.col("page_id")
    return table(spark, sf_dir, "pages").select("page_id", urls.avatar(F.concat(F.lit("https://x/"), k, F.lit("=s40-p-k"))).alias("avatar"), numbers.scroll_step(k, k % 15 / 10.0).alias("step"))
