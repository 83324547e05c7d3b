"""Further registered queries: names, projections, runs, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers
from ..operators import projection, runs, schedule
from ..sources import views
from ..sources.views import table
from .queries import _AUTHOR, _SOURCE, query

_TOKENS = r"list_distinct(list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace(lower({x}), '[&+]', ' and ', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' '), lambda w: w <> ''))"
_PART = _TOKENS.format(x="p_name")


@query(f"SELECT p_partkey, len(list_intersect({_PART}, ['red', 'widget'])) / least(len({_PART}), 2) AS score, len(list_intersect({_PART}, ['red', 'widget'])) / least(len({_PART}), 2) >= 0.82 AS same FROM part")
def name_similarity(spark, sf_dir):
    score = projection.name_similarity(projection.name_tokens(F.col("p_name")), projection.name_tokens(F.lit("Red Widget Inc")))
    scored = table(spark, sf_dir, "part").select("p_partkey", score.alias("score"))
    return scored.select("p_partkey", "score", (F.col("score") >= projection.MATCH).alias("same"))


@query(f"WITH s AS (SELECT p_brand, p_partkey, len(list_intersect({_PART}, ['red', 'widget'])) / least(len({_PART}), 2) AS score FROM part), g AS (SELECT p_brand, count(*) FILTER (score >= 0.82) AS m, min(p_partkey) FILTER (score >= 0.82) AS b FROM s GROUP BY 1) SELECT p_brand, CASE m WHEN 1 THEN 'MATCH' WHEN 0 THEN 'NOTFOUND' ELSE 'AMBIGUOUS' END AS verdict, CASE m WHEN 1 THEN b END AS candidate FROM g")
def choose_candidate(spark, sf_dir):
    scored = name_similarity(spark, sf_dir).join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey").withColumnRenamed("p_partkey", "candidate")
    return projection.choose(scored, "p_brand")


@query("SELECT n_nationkey, arg_min(r_name, levenshtein(n_name, r_name) * 100 + r_regionkey) AS nearest FROM nation CROSS JOIN region GROUP BY 1")
def nearest_name(spark, sf_dir):
    # The five regions are the known names; a fixed list, so it becomes a literal.
    known = [(r.r_name, r.r_regionkey) for r in table(spark, sf_dir, "region").collect()]
    each = F.array(*(F.struct((F.levenshtein("n_name", F.lit(n)) * 100 + F.lit(k)).alias("d"), F.lit(n).alias("name")) for n, k in known))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.array_min(each)["name"].alias("nearest"))


@query(f"SELECT CAST(id AS VARCHAR) AS review_id, author AS author_name, rating, CASE WHEN trim(text) <> '' THEN text END AS text, CASE WHEN source > 'src2' THEN '2024-01-01' END AS date FROM ({_AUTHOR})")
def public_projection(spark, sf_dir):
    d = views.documents_by_author(spark, sf_dir)
    return projection.public_review(d.withColumn("date", F.when(F.col("source") > "src2", "2024-01-01")))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, '{"@type":"Review","author":{"@type":"Person","name":"' || l_returnflag || '"},"reviewRating":{"@type":"Rating","ratingValue":' || (l_linenumber % 5 + 1) || '}' || CASE WHEN l_linestatus = 'O' THEN ',"datePublished":"' || strftime(l_shipdate, '%Y-%m-%d') || '"' ELSE '' END || '}' AS json FROM lineitem""")
def schema_org(spark, sf_dir):
    precision = F.when(F.col("l_linestatus") == "O", "day").otherwise("year")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", projection.json_ld(F.col("l_returnflag"), F.col("l_linenumber") % 5 + 1, F.date_format("l_shipdate", "yyyy-MM-dd"), precision).alias("json"))


_RUN = """SELECT strftime(ts, '%Y-%m-%d') AS run, CASE event_type WHEN 'error' THEN CASE WHEN CAST(strftime(ts, '%d') AS INT) % 3 = 0 THEN 'blocked' ELSE 'failed' END WHEN 'signup' THEN CASE WHEN user_id % 5 = 0 THEN 'deferred' ELSE 'succeeded' END WHEN 'click' THEN 'skipped' ELSE 'succeeded' END AS outcome,
  CASE WHEN event_type = 'error' THEN CASE user_id % 9 WHEN 0 THEN 'ERR-BLOCKED-CHALLENGE' ELSE 'ERR-NET-DNS' END WHEN event_type = 'view' AND user_id % 50 = 0 THEN 'ERR-GATE-REJECTED' END AS code FROM events WHERE CAST(strftime(ts, '%d') AS INT) % 4 > 0 OR event_type <> 'error'"""


@query(f"""SELECT run, {', '.join(f"sum(CASE outcome WHEN '{s}' THEN 1 ELSE 0 END)::BIGINT AS {s}" for s in projection.OUTCOMES)}, CAST(CASE WHEN bool_and(outcome = 'failed') THEN 3 WHEN bool_or(outcome = 'failed') THEN 4 WHEN bool_or(outcome = 'blocked' AND code = 'ERR-BLOCKED-CHALLENGE') THEN 7 WHEN bool_or(outcome = 'blocked') THEN 6
  WHEN bool_or(coalesce(code, '') = 'ERR-GATE-REJECTED') THEN 5 WHEN bool_or(outcome = 'deferred') THEN 4 ELSE 0 END AS INT) AS exit_code FROM ({_RUN}) GROUP BY run""")
def manifest_counts(spark, sf_dir):
    k, u, day = F.col("event_type"), F.col("user_id"), F.dayofmonth("ts")
    state = F.when(k == "error", F.when(day % 3 == 0, "blocked").otherwise("failed")).when((k == "signup") & (u % 5 == 0), "deferred").when(k == "click", "skipped").otherwise("succeeded")
    code = F.when(k == "error", F.when(u % 9 == 0, "ERR-BLOCKED-CHALLENGE").otherwise("ERR-NET-DNS")).when((k == "view") & (u % 50 == 0), "ERR-GATE-REJECTED")
    e = table(spark, sf_dir, "events").where((day % 4 > 0) | (k != "error")).select(F.date_format("ts", "yyyy-MM-dd").alias("run"), state.alias("outcome"), state.alias("state"), code.alias("code"), F.lit(False).alias("missing"))
    return projection.state_counts(e, "run").join(runs.exit_codes(e, "run"), "run")


@query("SELECT CASE WHEN max(c) = 0 AND min(c) = 0 THEN 1.0 WHEN min(c) = 0 THEN CAST('inf' AS DOUBLE) ELSE max(c) / min(c) END AS balance, sum(c) AS total FROM (SELECT user_id % 16 AS shard, count(*) AS c FROM events GROUP BY 1)")
def shard_balance(spark, sf_dir):
    loads = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 16).alias("shard")).agg(F.count("*").alias("c"))
    return loads.agg(schedule.balance(F.col("c")).alias("balance"), F.sum("c").alias("total"))


@query("SELECT page_id, url AS value, CAST(CASE WHEN url LIKE '%#%' THEN 0 ELSE 1 END AS INT) AS strategy FROM pages")
def first_strategy(spark, sf_dir):
    value, at = projection.first_strategy(F.when(F.contains("url", F.lit("#")), F.col("url")), F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", value.alias("value"), at.alias("strategy"))


@query("""WITH r AS (SELECT event_id, user_id, ts, event_type <> 'error' AS present, event_type = 'error' AND value > 100 AS counts FROM events), g AS (SELECT *, sum(CAST(present AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM r)
  SELECT event_id, CAST(CASE WHEN present THEN 0 ELSE sum(CAST(counts AS INT)) OVER (PARTITION BY user_id, g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) END AS INT) AS streak FROM g""")
def missing_streak_replay(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.struct("ts", "event_id").alias("at"), (F.col("event_type") != "error").alias("present"), (F.col("value") > 100).alias("complete"))
    return projection.missing_streaks(e, "user_id", order="at").select("event_id", "streak")


@query("SELECT doc_id, trim(text) IN (SELECT trim(text) FROM benchmark) AS known FROM documents")
def known_identity(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select(F.trim("text").alias("t"), F.lit(True).alias("k")).distinct()
    return table(spark, sf_dir, "documents").withColumn("t", F.trim("text")).join(b, "t", "left").select("doc_id", F.col("k").isNotNull().alias("known"))


@query("SELECT count(DISTINCT o_custkey) AS denied, count(*) FILTER (o_totalprice < 1000) AS junk FROM orders WHERE o_orderstatus = 'P'")
def denylist_build(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").agg(F.count_distinct("o_custkey").alias("denied"), F.count_if(F.col("o_totalprice") < 1000).alias("junk"))


@query(f"SELECT id, rating BETWEEN 1 AND 5 AS accepted, CASE WHEN rating NOT BETWEEN 1 AND 5 THEN 'rating' END AS quarantine_code FROM ({_SOURCE})")
def accepted_rejected(spark, sf_dir):
    ok = numbers.valid_rating(F.col("rating"))
    return views.documents_by_source(spark, sf_dir).select("id", ok.alias("accepted"), F.when(~ok, "rating").alias("quarantine_code"))


@query("SELECT md5(a.text) AS digest, count(*) AS pairs FROM documents a JOIN (SELECT md5(text) AS h, source, min(doc_id) AS first FROM documents GROUP BY 1, 2) b ON md5(a.text) = b.h AND a.source <> b.source GROUP BY 1")
def cross_source_identity(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", F.md5("text").alias("digest"))
    b = d.distinct().select("digest", F.col("source").alias("other"))
    return d.join(b, "digest").where("source <> other").groupBy("digest").agg(F.count("*").alias("pairs"))


@query("SELECT event_id, CASE WHEN value >= 300 THEN 'cap_reached' WHEN value >= 200 THEN 'target_reached' WHEN user_id % 5 >= 3 THEN CASE WHEN value >= 95 THEN 'exhausted' ELSE 'stalled' END WHEN user_id % 7 = 0 THEN 'budget_exceeded' ELSE 'continue' END AS reason FROM events")
def growth_curve_stop(spark, sf_dir):
    reason = schedule.stop_reason(F.col("value"), F.lit(300), F.lit(200), F.col("user_id") % 5, F.lit(100), F.col("user_id") % 7)
    return table(spark, sf_dir, "events").select("event_id", reason.alias("reason"))
