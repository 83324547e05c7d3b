"""What a run of harvests costs, in which order it goes, how it ends, and what it records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls

# Tiers, first served first; costs without history; exit codes; outcomes of a target.
TIERS = ("premium", "standard", "economy", "paused")
DEFAULT_COST, MIN_COST = 200, 1
EXIT = {"OK": 0, "INTERNAL": 1, "USAGE": 2, "ALL_FAILED": 3, "PARTIAL": 4, "GATE_REJECTED": 5, "POLICY_BLOCKED": 6, "CHALLENGE": 7}
OUTCOMES = ("succeeded", "failed", "blocked", "deferred", "skipped")
# Error classes as code, retry (n: never, b: backoff, i: at once; with the attempts), scope, severity; two open the breaker.
ERRORS = """
ERR-POLICY-KILLSWITCH n target info
ERR-POLICY-UNAUTHORIZED n target error
ERR-POLICY-ROBOTS n target warn
ERR-POLICY-BUDGET n target info
ERR-POLICY-BREAKER-OPEN n source warn
ERR-CONFIG-INVALID n target error
ERR-CONFIG-VERSION n run error
ERR-CONFIG-SECRET-MISSING n run error
ERR-RESOLVE-NO-IDENTIFIER n target error
ERR-RESOLVE-NOTFOUND n target error
ERR-RESOLVE-AMBIGUOUS n target error
ERR-IDENTITY-DRIFT n target high
ERR-NET-DNS b3 target warn
ERR-NET-TIMEOUT b3 target warn
ERR-NET-RESET b3 target warn
ERR-NET-TLS b2 target warn
ERR-HTTP-429 b2 source high
ERR-HTTP-5XX b3 target warn
ERR-HTTP-4XX n target error
ERR-HTTP-403 n source high
ERR-BROWSER-LAUNCH i1 run error
ERR-BROWSER-CRASH b1 target warn
ERR-BROWSER-OOM n target error
ERR-NAV-TIMEOUT b2 target warn
ERR-NAV-SURFACE-NOT-FOUND n target high
ERR-NAV-CONSENT-WALL n source high
ERR-BUDGET-TARGET n target warn
ERR-BLOCKED-CHALLENGE n source critical
ERR-BLOCKED-UNUSUAL-TRAFFIC n source critical
ERR-BLOCKED-GEO n source warn
ERR-PARSE-STRUCTURE n target high
ERR-PARSE-EMPTY-UNEXPECTED n target high
ERR-PARSE-FIELD-REQUIRED n record warn
ERR-PARSE-RATING-INVALID n record warn
ERR-PARSE-SELECTOR-PACK n run error
ERR-CLEAN-MARKUP-SURVIVED n record critical
ERR-VALIDATE-QUARANTINE-RATE n target error
ERR-VALIDATE-AGGREGATE n target error
ERR-STATE-CORRUPT n target high
ERR-STATE-WRITE b2 target error
ERR-GATE-REJECT-COUNT-DROP n target error
ERR-GATE-REJECT-RATING-SHIFT n target error
ERR-GATE-REJECT-EMPTY n target critical
ERR-GATE-REJECT-COVERAGE n target warn
ERR-GATE-REJECT-SCHEMA n target critical
ERR-PUBLISH-CONFLICT b3 shard warn
ERR-PUBLISH-AUTH n run critical
ERR-INTERNAL-INVARIANT n run critical
ERR-INTERNAL-UNCLASSIFIED n target critical
"""
OPENS_BREAKER = ("ERR-BLOCKED-CHALLENGE", "ERR-BLOCKED-UNUSUAL-TRAFFIC")
# Budgets in milliseconds, and pairs of which the first must end before the second.
BUDGETS = {"navigation_timeout_ms": 30_000, "surface_timeout_ms": 15_000, "pagination_budget_ms": 120_000, "budget_target_ms": 300_000, "budget_run_ms": 900_000}
NESTED = (("action_timeout_ms", "navigation_timeout_ms"), ("navigation_timeout_ms", "pagination_budget_ms"), ("surface_timeout_ms", "pagination_budget_ms"), ("pagination_budget_ms", "budget_target_ms"), ("budget_target_ms", "budget_run_ms"))


def tier_rank(tier: Column) -> Column:
    """Place of a tier in the order of service; an unknown one goes before all, as it has no place."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, TIERS)), tier), F.lit(0)).cast("int") - 1


def priority(targets: DataFrame, tier: str = "tier", stale: str = "stale_hours", key: str = "target") -> DataFrame:
    """targets sorted by tier, then the longest stale, then key."""
    return targets.orderBy(tier_rank(F.col(tier)), F.desc(stale), key)


def estimated_cost(targets: DataFrame, health: DataFrame, *by: str) -> DataFrame:
    """targets with cost: the last duration if there is one, else the last number of reviews, else the default."""
    known = health.select(*by, F.col("last_duration_ms").cast("double").alias("_d"), F.col("last_review_count").cast("double").alias("_n"))
    cost = F.when(F.col("_d") > 0, F.greatest(F.lit(float(MIN_COST)), "_d")).when(F.col("_n") > 0, F.greatest(F.lit(float(MIN_COST)), "_n")).otherwise(float(DEFAULT_COST))
    return targets.join(known, list(by), "left").withColumn("cost", cost).drop("_d", "_n")


def error_classes(spark) -> DataFrame:
    """code, strategy, attempts, base_delay_ms, scope, severity, opens_breaker."""
    rows = []
    for code, retry, scope, severity in (x.split() for x in ERRORS.split("\n") if x):
        strategy = {"n": "never", "b": "backoff", "i": "immediate"}[retry[0]]
        rows.append((code, strategy, int(retry[1:] or 0), 60_000 if code == "ERR-HTTP-429" else None, scope, severity, code in OPENS_BREAKER))
    return spark.createDataFrame(rows, "code string, strategy string, attempts int, base_delay_ms long, scope string, severity string, opens_breaker boolean")


def classified(failures: DataFrame, code: str = "code") -> DataFrame:
    """failures with the attributes of their error class, null for a code that no class has; the classes are some fifty rows."""
    return failures.join(F.broadcast(error_classes(failures.sparkSession).withColumnRenamed("code", code)), code, "left")


def exit_codes(outcomes: DataFrame, *by: str) -> DataFrame:
    """exit_code of each run of (state, code, missing: a planned target without outcome); the first rule that holds decides."""
    c = F.col
    n, failed = F.count_if(~c("missing")), F.count_if(~c("missing") & (c("state") == "failed"))
    blocked, deferred = F.count_if(c("state") == "blocked"), F.count_if(c("state") == "deferred")
    challenge = F.count_if((c("state") == "blocked") & (c("code") == "ERR-BLOCKED-CHALLENGE"))
    found = outcomes.groupBy(*by).agg(F.count_if("missing").alias("m"), n.alias("n"), failed.alias("f"), blocked.alias("b"), challenge.alias("ch"), F.count_if(c("code") == "ERR-GATE-REJECTED").alias("g"), deferred.alias("d"))
    code = (
        F.when(c("m") > 0, EXIT["INTERNAL"]).when(c("f") > 0, F.when(c("f") == c("n"), EXIT["ALL_FAILED"]).otherwise(EXIT["PARTIAL"])).when(c("ch") > 0, EXIT["CHALLENGE"])
        .when(c("b") > 0, EXIT["POLICY_BLOCKED"]).when(c("g") > 0, EXIT["GATE_REJECTED"]).when(c("d") > 0, EXIT["PARTIAL"]).otherwise(EXIT["OK"])
    )
    return found.select(*by, code.alias("exit_code"))


def exit_severity(code: Column) -> Column:
    return F.when(code == EXIT["OK"], "none").when(code.isin(EXIT["INTERNAL"], EXIT["CHALLENGE"]), "critical").when(code.isin(EXIT["USAGE"], EXIT["ALL_FAILED"], EXIT["GATE_REJECTED"]), "error").otherwise("warn")


def fails_job(code: Column) -> Column:
    return code.isin(EXIT["INTERNAL"], EXIT["USAGE"], EXIT["ALL_FAILED"])


#: Characters of a normalised text, at most.
MOST_TEXT = 5000


def record_findings(rating: Column, identity: Column, text: Column, author: Column, date: Column) -> Column:
    """What is wrong with one review, in order: (code, severity, id, field). Something fatal sets it apart."""
    finding = lambda code, severity, name: F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), identity.alias("id"), F.lit(name).alias("field"))
    sound = F.coalesce((rating == F.floor(rating)) & rating.between(1, 5), F.lit(False))
    return F.array_compact(F.array(
        F.when(~sound, finding("ERR-PARSE-RATING-INVALID", "fatal", "rating")), F.when(~F.coalesce(identity.rlike(r"\A[0-9a-f]{32}\z"), F.lit(False)), finding("ERR-INTERNAL-INVARIANT", "fatal", "identity_hash")),
        F.when(F.length(text) > MOST_TEXT, finding("ERR-CLEAN-MARKUP-SURVIVED", "fatal", "text")), F.when(author.isNull() & text.isNull(), finding("ERR-PARSE-FIELD-REQUIRED", "info", "author.name")), F.when(date.isNull(), finding("ERR-PARSE-FIELD-REQUIRED", "warn", "date_estimated")),
    ))


def findings(reviews: DataFrame, *by: str, near: DataFrame | None = None) -> DataFrame:
    """All findings (by..., code, severity, id, field) of harvests: those of each review (columns id, findings), one for each id that stands more than once, one for each pair of near-duplicates (near: by..., id)."""
    own = reviews.select(*by, F.explode("findings").alias("f")).select(*by, "f.*")
    of = lambda rows, name: rows.select(*by, F.lit("ERR-VALIDATE-AGGREGATE").alias("code"), F.lit("warn").alias("severity"), "id", F.lit(name).alias("field"))
    twice = reviews.where("id IS NOT NULL").groupBy(*by, "id").count().where("count > 1")
    found = own.unionByName(of(twice, "identity_hash"))
    return found if near is None else found.unionByName(of(near, "text"))


def validation(reviews: DataFrame, *by: str, advertised: Column, clusters: DataFrame | None = None) -> DataFrame:
    """The report of each harvest (by..., id, ordinal, rejected, fatal): accepted and quarantined counts and their rate, the share of the advertised number that was read (1 at most, null
    where none is advertised), duplicates (ids that stand more than once), whether anything is fatal, and near-duplicate clusters (by..., size) where given.
    """
    c = F.col
    each = reviews.withColumn("_advertised", advertised).groupBy(*by, "id").agg(
        F.count_if(~c("rejected")).alias("a"), F.count_if("rejected").alias("q"), F.count("ordinal").alias("n"), ((F.count("*") > 1) & c("id").isNotNull()).cast("int").alias("d"), F.first("_advertised").alias("_advertised"), F.coalesce(F.bool_or("fatal"), F.lit(False)).alias("fatal"),
    )
    found = each.groupBy(*by).agg(
        F.sum("a").alias("accepted"), F.sum("q").alias("quarantined"), (F.sum("q") / F.sum(c("a") + c("q"))).alias("quarantine_rate"),
        F.when(F.first("_advertised") > 0, F.least(F.lit(1.0), F.sum("n") / F.first("_advertised"))).alias("coverage"), F.sum("d").alias("duplicates"), F.bool_or("fatal").alias("has_fatal"),
    )
    if clusters is None:
        return found.withColumns({"near_duplicate_clusters": F.lit(0), "largest_duplicate_cluster": F.lit(0)})
    sizes = clusters.groupBy(*by).agg(F.count("*").cast("int").alias("near_duplicate_clusters"), F.max("size").cast("int").alias("largest_duplicate_cluster"))
    return found.join(sizes, list(by), "left").fillna(0, ["near_duplicate_clusters", "largest_duplicate_cluster"])


# --- health records

HEALTH_VERSION = 1
HEALTH = {
    "client_slug": "string", "listing_key": "string", "adapter": "string", "pack_version": "string", "engine_version": "string", "outcome": "string", "error_class": "string",
    "observed_count": "long", "extracted_count": "long", "quarantined_count": "long", "published_count": "long", "stop_reason": "string", "completeness": "string", "coverage": "double",
    "duration_ms": "long", "stage_timings": "map<string,long>", "strategy_histogram": "map<string,long>", "peak_rss_bytes": "long", "gate_decision": "string", "gate_reasons": "array<string>",
}


def health_records(outcomes: DataFrame) -> DataFrame:
    """Every column of a health record, null (never 0) where the outcome has none; outcomes has run_id and recorded_at."""
    own = set(outcomes.columns)
    return outcomes.select(F.lit(HEALTH_VERSION).alias("schema_version"), "recorded_at", "run_id", *((F.col(k) if k in own else F.lit(None)).cast(t).alias(k) for k, t in HEALTH.items()))


def health_problems() -> Column:
    """What is wrong with a health record."""
    needed = [F.when(F.coalesce(F.col(k).cast("string"), F.lit("")) == "", F.lit(f"{k} is missing")) for k in ("recorded_at", "run_id", "client_slug", "listing_key", "outcome")]
    version = F.when(~F.col("schema_version").eqNullSafe(HEALTH_VERSION), F.lit(f"schema_version must be {HEALTH_VERSION}"))
    unknown = F.when(~F.col("outcome").isin(*OUTCOMES), F.concat(F.lit('outcome "'), "outcome", F.lit('" is not one of ' + ", ".join(OUTCOMES))))
    return F.filter(F.array(*needed, version, unknown), lambda x: x.isNotNull())


def append_health(records: DataFrame, folder: str) -> DataFrame:
    """Append the sound records to a JSONL series; returns the others with their problems. The series is never rewritten."""
    checked = records.withColumn("problems", health_problems())
    checked.where("size(problems) = 0").drop("problems").write.mode("append").option("ignoreNullFields", "false").json(folder)
    return checked.where("size(problems) > 0")


def save_state(rows: DataFrame, folder: str, *by: str) -> None:
    """Budgets, breakers and cached identities as a small table, one partition each by a safe key: what is written replaces that key's rows only."""
    if not rows.where(reduce(Column.__or__, (~safe_segment(F.col(k)) for k in by))).isEmpty():
        raise ValueError("a key can't be part of a path")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(folder)


def safe_segment(key: Column) -> Column:
    """Whether a key may be part of a path."""
    return F.coalesce(key.rlike(r"\A[a-z0-9][a-z0-9._-]{0,63}\z") & ~F.contains(key, F.lit("..")), F.lit(False))


# --- selectors


def strategy_health(resolutions: DataFrame, *by: str) -> DataFrame:
    """by..., field, strategy (null: none resolved), n: how often each strategy won; resolutions are (by..., field, strategy)."""
    return resolutions.groupBy(*by, "field", "strategy").agg(F.count("*").alias("n"))


def degraded_fields(health: DataFrame, *by: str, least: float = 0.9) -> DataFrame:
    """Fields whose first strategy wins less than the least share."""
    rate = F.sum(F.when(F.col("strategy") == 0, F.col("n")).otherwise(0)) / F.sum("n")
    return health.groupBy(*by, "field").agg(rate.alias("primary_rate")).where(F.col("primary_rate") < least)


def assertions(counts: DataFrame, *by: str) -> DataFrame:
    """passed of each assertion (by..., position, matched, least, most, severity), without what follows a fatal failure."""
    passed = F.coalesce(F.col("matched") >= F.col("least"), F.lit(True)) & F.coalesce(F.col("matched") <= F.col("most"), F.lit(True))
    severity = F.coalesce("severity", F.lit("error"))
    before = Window.partitionBy(*by).orderBy("position").rowsBetween(Window.unboundedPreceding, -1)  # an assertion file has some ten
    fatal = F.coalesce(F.max((~F.col("passed") & (F.col("severity") == "fatal")).cast("int")).over(before), F.lit(0))
    return counts.withColumns({"passed": passed, "severity": severity}).withColumn("_after", fatal).where("_after = 0").drop("_after")


# --- configuration

# Names and bounds of settings.
LIMITS = (
    ("nav.max_reviews", None, 5000.0), ("nav.scroll_timeout_ms", None, 120_000.0), ("nav.expansion_cap", None, 1000.0), ("reconcile.removal_confirmations", 2.0, 10.0), ("reconcile.coverage_min", 0.5, 1.0),
    ("reconcile.near_duplicate_threshold", 0.8, 1.0), ("budget_target_ms", None, 300_000.0), ("budget_run_ms", None, 900_000.0), ("inter_target_delay_ms", 5000.0, None), ("min_request_delay_ms", 250.0, None),
    ("source_hourly_budget", None, 600.0), ("source_daily_budget", None, 6000.0), ("max_parallel", None, 8.0), ("cadence_floor_hours", 1.0, None),
)
AUTHORISATION = ("authorized_by", "authorization_date", "relationship", "evidence_ref")
RELATIONSHIPS = ("owner", "authorized_agent")
DOM_ADAPTERS = ("google:dom",)


def limit_violations(values: DataFrame) -> DataFrame:
    """name, value, bound, limit: settings (name, value) outside their bounds; a value is never clamped. The bounds are fourteen rows."""
    limits = values.sparkSession.createDataFrame(LIMITS, "name string, floor double, ceiling double")
    j = values.join(F.broadcast(limits), "name")
    each = F.array(F.when(F.col("value") > F.col("ceiling"), F.struct(F.lit("ceiling").alias("bound"), F.col("ceiling").alias("limit"))), F.when(F.col("value") < F.col("floor"), F.struct(F.lit("floor").alias("bound"), F.col("floor").alias("limit"))))
    return j.select("name", "value", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x")).select("name", "value", "x.*")


def present(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def config_findings(limits_broken: Column | None = None) -> Column:
    """(rule, severity, listing) of a client's settings, V-1 to V-12.

    Columns: slug, filename, tier, cadence, notes, min_rating, schema_org, schema_org_acknowledged, max_count_drop_ratio, allow_search (nullable),
    secrets and environment (arrays of names), and listings: structs of key, adapter, place_id, cid, url, expected_name and authorization
    (a struct of authorized_by, authorization_date, relationship, evidence_ref, scope_ack).
    """
    c = F.col
    kind = "struct<rule:string,severity:string,listing:string>"
    finding = lambda rule, severity, listing=None: F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), (F.lit(None) if listing is None else listing).cast("string").alias("listing")).cast(kind)
    one = lambda rule, severity, cond: F.when(F.coalesce(cond, F.lit(False)), F.array(finding(rule, severity))).otherwise(F.array().cast(f"array<{kind}>"))
    each = lambda rule, severity, cond: F.transform(F.filter(F.coalesce(c("listings"), F.array()), cond), lambda x: finding(rule, severity, x["key"]))
    stem = F.regexp_replace(F.regexp_replace("filename", r"\.config\.json$", ""), r"\.json$", "")
    keys = F.transform("listings", lambda x: x["key"])
    doubled = F.filter(F.array_distinct(keys), lambda k: F.size(F.filter(keys, lambda o: o == k)) > 1)
    reachable = lambda x: present(x["place_id"]) | present(x["cid"].cast("string")) | present(x["url"])

    def unauthorised(x: Column) -> Column:
        a = x["authorization"]
        lacking = ~F.coalesce(a["scope_ack"], F.lit(False))
        for name in AUTHORISATION:
            lacking = lacking | ~present(a[name].cast("string"))
        return x["adapter"].isin(*DOM_ADAPTERS) & (lacking | ~F.coalesce(a["relationship"].isin(*RELATIONSHIPS), F.lit(False)))

    no_search = F.coalesce(~c("allow_search"), F.lit(False))
    return F.concat(
        one("V-1", "error", c("filename").isNotNull() & c("slug").isNotNull() & (c("slug") != stem)),
        F.transform(doubled, lambda k: finding("V-2", "error", k)),
        each("V-3", "error", unauthorised),
        F.transform(F.array_except("secrets", "environment"), lambda s: finding("V-4", "error", s)),
        one("V-5", "error", F.lit(False) if limits_broken is None else limits_broken),
        F.when(no_search, each("V-6", "error", lambda x: ~reachable(x))).otherwise(F.array().cast(f"array<{kind}>")),
        each("V-7", "error", lambda x: ~present(x["expected_name"])),
        one("V-8", "warning", c("min_rating").isNotNull() & ~present(c("notes"))),
        one("V-9", "warning", c("schema_org") & ~F.coalesce("schema_org_acknowledged", F.lit(False))),
        one("V-10", "warning", c("max_count_drop_ratio") > 0.5),
        F.when(~no_search, each("V-11", "warning", lambda x: ~reachable(x))).otherwise(F.array().cast(f"array<{kind}>")),
        one("V-12", "warning", (c("tier") == "premium") & (c("cadence") == "daily")),
    )


def budgets(*given: str) -> dict[str, Column]:
    """The six budgets in milliseconds: columns of those names where they are positive, else the defaults; an action gets a sixth of navigation."""
    out = {k: F.when(F.col(k) > 0, F.col(k)).otherwise(v) if k in given else F.lit(v) for k, v in BUDGETS.items()}
    return {"action_timeout_ms": F.floor(out["navigation_timeout_ms"] / 6)} | out


def nesting_problems(of: dict[str, Column]) -> Column:
    """'inner>outer' for each inner budget that doesn't end before its outer one, 'inner' if it isn't positive."""
    each = [F.when(~F.coalesce(of[a] > 0, F.lit(False)), F.lit(a)).when(~F.coalesce(of[a] < of[b], F.lit(False)), F.lit(f"{a}>{b}")) for a, b in NESTED]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


#: The checks before a run, in order, with the code of each.
CHECKS = (
    ("global-kill-switch", "ERR-POLICY-KILLSWITCH"), ("source-enabled", "ERR-POLICY-KILLSWITCH"), ("client-enabled", "ERR-POLICY-KILLSWITCH"), ("authorisation-record", "ERR-POLICY-UNAUTHORIZED"), ("robots-directive", "ERR-POLICY-ROBOTS"),
    ("rate-budget", "ERR-POLICY-BUDGET"), ("circuit-breaker", "ERR-POLICY-BREAKER-OPEN"),
)
PREFLIGHT = "global_enabled boolean, source_enabled boolean, client_enabled boolean, access_method string, authorization struct<authorized_by:string,authorization_date:string,relationship:string,evidence_ref:string,scope_ack:boolean>, robots_mode string, robots_allowed boolean, budget_allowed boolean, breaker_open boolean"


def preflight_failures() -> list[Column]:
    """Whether each of the seven checks fails, from columns as in PREFLIGHT. What isn't said doesn't forbid; only pages that are rendered need an authorisation; a robots
    directive that can't be found out stops a run in mode block only, one that forbids does unless the mode is ignore. Another mode counts as warn.
    """
    c = F.col
    off = lambda name: F.coalesce(~c(name), F.lit(False))
    record = c("authorization")
    lacking = ~F.coalesce(record["scope_ack"], F.lit(False)) | ~F.coalesce(record["relationship"].isin(*RELATIONSHIPS), F.lit(False))
    for name in AUTHORISATION:
        lacking = lacking | (F.coalesce(F.trim(record[name].cast("string")), F.lit("")) == "")
    mode = F.when(c("robots_mode").isin("block", "ignore"), c("robots_mode")).otherwise("warn")
    robots = F.when(c("robots_allowed").isNull(), mode == "block").when(c("robots_allowed"), False).otherwise(mode != "ignore")
    return [off("global_enabled"), off("source_enabled"), off("client_enabled"), F.coalesce(c("access_method") == "dom", F.lit(False)) & lacking, robots, off("budget_allowed"), F.coalesce("breaker_open", F.lit(False))]


def preflight() -> tuple[Column, Column, Column]:
    """(allow, code, reasons) of each target: its checks in order up to the first that fails, as (check, name, passed, code)."""
    failures = preflight_failures()
    all_ = F.array(*(F.struct(F.lit(k + 1).alias("check"), F.lit(name).alias("name"), (~f).alias("passed"), F.when(f, code).alias("code")) for k, ((name, code), f) in enumerate(zip(CHECKS, failures, strict=True))))
    first = F.get(F.filter(all_, lambda x: ~x["passed"]), 0)
    return first.isNull(), first["code"], F.slice(all_, 1, F.coalesce(first["check"], F.lit(len(CHECKS))))


def coerced(raw: Column, kind: str) -> tuple[Column, Column]:
    """(value, expected): an environment string as number, boolean or list; expected says what it should have been, else null."""
    t = F.trim(raw)
    if kind == "number":
        value = F.when(t != "", t.try_cast("double"))
        return value, F.when(raw.isNotNull() & (value.isNull() | F.isnan(value)), "a number")
    if kind == "boolean":
        low = F.lower(t)
        value = F.when(low.isin("true", "1", "yes", "on"), True).when(low.isin("false", "0", "no", "off"), False)
        return value, F.when(raw.isNotNull() & value.isNull(), "a boolean (true/false)")
    if kind == "list":
        return F.filter(F.transform(F.split(raw, ","), lambda x: F.trim(x)), lambda x: x != ""), F.lit(None).cast("string")
    return raw, F.lit(None).cast("string")


# --- identity of a listing


def is_fresh(verified_at: Column, now: Column, days: int = 30) -> Column:
    return F.coalesce(F.unix_micros(now) - F.unix_micros(verified_at) < days * 86_400_000_000, F.lit(False))


def resolution(place_id: Column, cid: Column, cached: Column, fresh: Column, url_kind: Column, url_id: Column, search: Column, search_allowed: Column) -> Column:
    """(via, kind, value) by the first route that applies: the given id, the given number, a fresh cached id, the url's, a search where allowed."""
    way = lambda via, kind, value: F.struct(F.lit(via).alias("via"), kind.alias("kind"), value.alias("value"))
    none = way("none", F.lit(None).cast("string"), F.lit(None).cast("string"))
    return (
        F.when(F.coalesce(place_id.rlike(r"\A[A-Za-z0-9_-]{10,}\z"), F.lit(False)), way("explicit_place_id", F.lit("place_id"), place_id))
        .when(F.coalesce(cid.rlike(r"\A[0-9]{5,25}\z"), F.lit(False)), way("explicit_cid", F.lit("cid"), cid))
        .when(F.coalesce(fresh, F.lit(False)), way("cache", F.lit("place_id"), cached)).when(url_kind.isNotNull(), way("url", url_kind, url_id))
        .when(search.isNotNull() & F.coalesce(search_allowed, F.lit(False)), way("search", F.lit("search"), search)).otherwise(none)
    )


def may_search(explicit: Column, environment: Column) -> Column:
    return F.coalesce(explicit, environment != "production")


def listing_url(place_id: Column, cid: Column, stored: Column) -> Column:
    """The page of a listing by its id, else by its number, else as stored; empty strings count as none."""
    some = lambda c: F.when(c != "", c)
    quoted = lambda c: F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    return F.coalesce(F.concat(F.lit("https://www.google.com/maps/place/?q=place_id:"), quoted(some(place_id))), F.concat(F.lit("https://www.google.com/maps?cid="), quoted(some(cid))), some(stored))


# --- what may be seen

FORBIDDEN = ("author_key", "missing_streak", "content_hash_history", "tombstoned_at", "state", "last_seen_at")
CAPABILITIES = ("review_text", "owner_reply", "likes", "photo_count", "verified", "author_name", "author_profile_url", "author_avatar_url", "author_badges", "author_review_count", "relative_date", "absolute_date", "advertised_total", "advertised_rating", "full_pagination", "sort_by_newest")


def leaked(json: Column) -> Column:
    """Names of a published review (a JSON object) that must not be published."""
    return F.array_intersect(F.array(*map(F.lit, FORBIDDEN)), F.coalesce(F.json_object_keys(json), F.array().cast("array<string>")))


def explain_null(supported: Column, capability: Column) -> Column:
    """Why a field is null: the source has no such thing, or this review has none."""
    return F.when(F.array_contains(supported, capability), "absent").otherwise("unsupported")


def unknown_capabilities(supported: Column, known: tuple[str, ...] = CAPABILITIES) -> Column:
    return F.filter(supported, lambda x: ~x.isin(*known))


def is_no_op(outcome: Column) -> Column:
    """Whether an outcome leaves the ledger as it is."""
    return outcome.isin("HELD", "IGNORED_TERMINAL")


def stats_problems(total: Column, distribution: list[Column], with_text: Column, with_reply: Column, coverage: Column) -> Column:
    """Which of a listing's statistics contradict each other."""
    rules = {"distribution": sum(distribution, F.lit(0)) != total, "with_text_count": with_text > total, "with_reply_count": with_reply > total, "coverage": (coverage < 0) | (coverage > 1)}
    return F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules.items())), lambda x: x.isNotNull())


def redacted(fields: Column, secrets: dict[str, str] | None = None, text_limit: int = 120) -> Column:
    """A log record (a map of strings) as it may be written: names that must not be seen are left out or masked, texts cut, queries of urls and known secrets removed.

    Secrets are replaced longest first; one under six characters only where it is the whole value.
    """
    mask = lambda label: F.concat(F.lit("«redacted:"), label, F.lit("»"))

    def scrub(v: Column) -> Column:
        for label, secret in sorted((secrets or {}).items(), key=lambda x: (-len(x[1]), x[0])):
            v = F.replace(v, F.lit(secret), mask(F.lit(label))) if len(secret) >= 6 else F.when(v == secret, mask(F.lit(label))).otherwise(v)
        return v

    def value(k: Column, v: Column) -> Column:
        cut = F.when(F.length(scrub(v)) <= text_limit, scrub(v)).otherwise(F.concat(F.left(scrub(v), F.lit(text_limit)), F.lit("…")))
        plain = scrub(urls.strip_query(v))
        return (
            F.when(k.rlike("(?i)token|secret|key|password|cookie|auth|credential|refresh"), mask(k)).when(k.rlike(r"(?i)\A(text|review_text|body|reviewbody|snippet)\z"), cut)
            .when(k.rlike(r"(?i)\A(author_name|authorname|reviewer_name|name)\z"), mask(F.lit("author"))).otherwise(plain)
        )

    seen = F.filter(F.map_entries(fields), lambda e: ~e["key"].rlike(r"(?i)\A(authorization|cookie|set-cookie|storage_state|storagestate)\z"))
    return F.map_from_entries(F.transform(seen, lambda e: F.struct(scrub(e["key"]).alias("key"), value(e["key"], e["value"]).alias("value"))))


def author_prefix(key: Column) -> Column:
    """How an author is named in logs."""
    return F.left(key, F.lit(8))


def union_of_sources(*sources: DataFrame) -> DataFrame:
    """Reviews of several sources under one set of columns, null where a source has none."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


AI_FIELDS = {"summary": "string", "sentiment": "string", "sentiment_score": "double", "topics": "array<string>", "keywords": "array<string>", "spam_score": "double", "language_detected": "string", "model": "string", "generated_at": "string", "content_hash_at_generation": "string"}


def enriched(reviews: DataFrame, *steps: dict[str, Column]) -> DataFrame:
    """reviews with ai: what each step gives for the ten fields it may write, later steps over earlier ones; null if none gives anything.

    A step is a column for each field it writes (a function that failed gives null and so changes nothing); other names are refused.
    """
    refused = {k for s in steps for k in s} - set(AI_FIELDS)
    if refused:
        raise ValueError(f"not a field of ai: {sorted(refused)}")
    null = F.lit(None)
    own = {k: F.coalesce(*(s[k].cast(t) for s in reversed(steps) if k in s), null.cast(t)) for k, t in AI_FIELDS.items()}
    any_ = F.lit(False)
    for c in own.values():
        any_ = any_ | c.isNotNull()
    return reviews.withColumn("ai", F.when(any_, F.struct(*(c.alias(k) for k, c in own.items()))))
