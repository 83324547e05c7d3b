"""Registered queries on single fields: text, scripts, numbers, URLs and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, language, numbers, text, urls
from ..sources.views import table
from .queries import query


@query(r"SELECT doc_id, md5(regexp_replace(t, '<[!?/A-Za-z][^>]*(>|$)', '', 'g')) AS stripped, regexp_matches(t, '<[!?/A-Za-z]') AS has_markup FROM (SELECT doc_id, replace(coalesce(text, ''), ' the ', ' <b>the</b> <3 ') || CASE WHEN doc_id % 4 = 0 THEN '<a href=x' ELSE '' END AS t FROM documents)")
def markup_stripped(spark, sf_dir):
    t = F.concat(F.replace(F.coalesce("text", F.lit("")), F.lit(" the "), F.lit(" <b>the</b> <3 ")), F.when(F.col("doc_id") % 4 == 0, "<a href=x").otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.strip_markup(t)).alias("stripped"), text.has_markup(t).alias("has_markup"))


@query(r"SELECT c_custkey, 'C' || CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE '' END AS initials, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS kept, CASE WHEN length(c_name) > 10 THEN substr(c_name, 1, 10) || '…' ELSE c_name END AS cut FROM customer")
def author_fields(spark, sf_dir):
    k = F.col("c_custkey")
    name = F.concat(F.lit("  "), "c_name", F.when(k % 2 == 0, "  maria ").otherwise(" "))
    return table(spark, sf_dir, "customer").select("c_custkey", text.initials(name).alias("initials"), text.blank_to_null(F.when(k % 3 == 0, " \t").otherwise(F.col("c_name"))).alias("kept"), text.truncate(F.col("c_name"), 10).alias("cut"))


@query(r"SELECT doc_id, md5(CASE WHEN m THEN rtrim(left(t, length(t) - 6), ' ' || chr(10) || chr(9)) ELSE t END) AS text_md5, m AS truncated FROM (SELECT doc_id, doc_id % 3 = 0 AS m, trim(regexp_replace(coalesce(text, '') || CASE WHEN doc_id % 3 = 0 THEN ' … More' ELSE '' END, '\s+', ' ', 'g')) AS t FROM documents)")
def marked_ends(spark, sf_dir):
    t = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 3 == 0, " … More").otherwise(""))
    body, cut = text.extract_text(t, ["… More", "Read all"])
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(body).alias("text_md5"), cut.alias("truncated"))


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'ja' WHEN 1 THEN 'zh' WHEN 2 THEN 'ko' WHEN 3 THEN 'ar' WHEN 4 THEN 'hi' END AS language FROM part")
def script_languages(spark, sf_dir):
    words = ("漢字とかな", "漢字", "한국어", "مرحبا", "नमस्ते", "plain")
    of = F.element_at(F.array(*map(F.lit, words)), (F.col("p_partkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", language.script_language(F.concat("p_name", F.lit(" "), of)).alias("language"))


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 4.5 WHEN 1 THEN -3.0 WHEN 2 THEN CAST(o_custkey AS DOUBLE) WHEN 3 THEN 1.234 END::DOUBLE AS number, CAST(CASE o_orderkey % 5 WHEN 2 THEN o_custkey WHEN 3 THEN 1234 WHEN 0 THEN 45 END AS BIGINT) AS count_de, CAST(CASE o_orderkey % 5 WHEN 2 THEN o_custkey WHEN 0 THEN 45 END AS BIGINT) AS count_en, CAST(least(100 * pow(2, o_orderkey % 5), 500) AS BIGINT) AS delay FROM orders")
def numbers_read(spark, sf_dir):
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, "Rated 4,5 of").when(k == 1, "-3 days").when(k == 2, F.concat(F.col("o_custkey").cast("string"), F.lit(" likes"))).when(k == 3, "1.234").otherwise("none")
    point = F.when(k == 0, "45").otherwise(raw)
    return table(spark, sf_dir, "orders").select("o_orderkey", numbers.read_number(raw).alias("number"), numbers.read_count(point, F.lit("de")).alias("count_de"), numbers.read_count(point, F.lit("en")).alias("count_en"), numbers.backoff_ms(100, k + 1, 500).alias("delay"))


@query(r"SELECT page_id, CASE WHEN regexp_matches(url, '^(?i)https?://') THEN rtrim(regexp_replace(regexp_replace(url, '#.*$', ''), '\?.*$', '') || '?' || array_to_string(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda x: regexp_matches(x, '^(?i)(w|h|s|size|sz)(=|$)')), '&'), '?') ELSE url END AS plain, lower(regexp_extract(url, '://([^/?#:]*)', 1)) AS host, CASE WHEN url LIKE 'https://%' AND (regexp_matches(lower(url), '^https://([^/?#]*\.)?example\.com([/?#]|$)')) THEN TRUE ELSE FALSE END AS allowed FROM pages WHERE url IS NOT NULL")
def page_urls(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").where("url IS NOT NULL").select("page_id", urls.strip_query(u).alias("plain"), urls.host_of(u).alias("host"), urls.is_valid(u, ("example.com",)).alias("allowed"))


@query("SELECT event_id, event_type IN ('error') OR user_id % 4 = 0 AS blocked FROM events")
def blocked_requests(spark, sf_dir):
    kind = F.when(F.col("event_type") == "error", "image").otherwise("document")
    host = F.when(F.col("user_id") % 4 == 0, "metrics.example").otherwise("www.example")
    return table(spark, sf_dir, "events").select("event_id", urls.is_blocked(kind, host, ("metrics.example",)).alias("blocked"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, unit, CASE WHEN unit IN ('second', 'minute', 'hour', 'day') THEN 'day' WHEN unit IN ('week', 'month', 'year') THEN unit ELSE 'unknown' END AS precision, CASE WHEN unit IN ('second', 'minute', 'hour', 'day', 'week') THEN 'high' WHEN unit = 'month' THEN 'medium' ELSE 'low' END AS confidence,
  unit IN ('month', 'year', 'aeon') AS coarser_than_week, CASE WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') END AS day FROM (SELECT *, CASE l_linenumber % 7 WHEN 0 THEN 'second' WHEN 1 THEN 'hour' WHEN 2 THEN 'day' WHEN 3 THEN 'week' WHEN 4 THEN 'month' WHEN 5 THEN 'year' ELSE 'aeon' END AS unit FROM lineitem)""")
def date_precision(spark, sf_dir):
    units = F.array(*map(F.lit, ("second", "hour", "day", "week", "month", "year", "aeon")))
    rows = table(spark, sf_dir, "lineitem").withColumn("unit", F.element_at(units, (F.col("l_linenumber") % 7 + 1).cast("int")))
    precision, confidence = dates.precision_of(F.col("unit"))
    raw = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T10:00:00Z"))).otherwise("last week")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "unit", precision.alias("precision"), confidence.alias("confidence"), dates.is_coarser(precision, F.lit("week")).alias("coarser_than_week"), dates.absolute_date(raw).alias("day"))
