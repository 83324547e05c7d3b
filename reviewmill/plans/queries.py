"""Each query applies operators to whole tables; SQL[name] returns the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, identity, language, numbers, text, urls
from ..operators import duplicates, health, merge, ordering, rules, schedule, stats
from ..sources import readers, views
from ..sources.views import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Views, as SQL.
_SOURCE = "SELECT d.source AS listing, d.doc_id AS id, CAST(d.n_chars % 7 AS INT) AS rating, d.text, d.lang AS language, l.quality AS flag, d.n_chars FROM documents d LEFT JOIN labels l USING (doc_id)"
_AUTHOR = "SELECT d.lang AS listing, d.doc_id AS id, c.c_name AS author, CAST(d.n_chars % 7 AS INT) AS rating, d.text, d.n_chars, d.source FROM documents d LEFT JOIN customer c ON c.c_custkey = (d.n_chars // 64) % 150 + 1"
_ITEMS = """SELECT l_suppkey AS listing, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, CAST(l_linenumber % 5 + 1 AS INT) AS rating,
  CASE WHEN l_returnflag <> 'R' THEN strftime(l_shipdate, '%Y-%m-%d') END AS date, strftime(l_shipdate + INTERVAL 1 MONTH, '%Y-%m') AS first_seen, l_linestatus AS language, l_discount > 0.02 AS has_text FROM lineitem"""
_HALF2 = "CAST(floor(({x}) * 100.0 + 0.5) AS DOUBLE) / 100.0"


# --- statistics


@query(f"""SELECT listing, count(*) AS total_count, coalesce({_HALF2.format(x="avg(CAST(rating AS DOUBLE))")}, 0.0) AS mean_rating, count(*) FILTER (rating = 1) AS rating_1, count(*) FILTER (rating = 2) AS rating_2,
  count(*) FILTER (rating = 3) AS rating_3, count(*) FILTER (rating = 4) AS rating_4, count(*) FILTER (rating = 5) AS rating_5, count(*) FILTER (has_text) AS with_text_count, max(date) AS newest_review_date, min(date) AS oldest_review_date
  FROM ({_ITEMS}) GROUP BY listing""")
def listing_stats(spark, sf_dir):
    return stats.listing_stats(views.lineitem_reviews(spark, sf_dir), "listing")


@query(f"SELECT listing, {', '.join(f'count(*) FILTER (rating = {k}) AS rating_{k}' for k in range(1, 6))} FROM ({_SOURCE}) GROUP BY listing")
def rating_distribution(spark, sf_dir):
    return views.documents_by_source(spark, sf_dir).groupBy("listing").agg(*(F.count_if(F.col("rating") == k).alias(f"rating_{k}") for k in range(1, 6)))


@query(f"SELECT listing, string_agg(language || ':' || n, ',' ORDER BY language) AS languages FROM (SELECT listing, language, count(*) AS n FROM ({_SOURCE}) WHERE language <> '' GROUP BY 1, 2) GROUP BY listing")
def language_counts(spark, sf_dir):
    return stats.language_counts(views.documents_by_source(spark, sf_dir), "listing")


@query("""SELECT s_suppkey AS listing, CASE WHEN a > 0 THEN floor(n / a * 10000.0 + 0.5) / 10000.0 END AS payload_coverage, CASE WHEN a > 0 THEN least(1.0, n / a) END AS harvest_coverage
  FROM (SELECT s_suppkey, CAST(floor(s_acctbal / 20) AS BIGINT) AS a, coalesce(n, 0) AS n FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey)""")
def coverage_both(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"))
    s = table(spark, sf_dir, "supplier").withColumn("a", F.floor(F.col("s_acctbal") / 20)).join(n, "s_suppkey", "left")
    payload, harvest = stats.coverage(F.coalesce("n", F.lit(0)), F.col("a"))
    return s.select(F.col("s_suppkey").alias("listing"), payload.alias("payload_coverage"), harvest.alias("harvest_coverage"))


@query(f"SELECT listing, coalesce({_HALF2.format(x='avg(CASE WHEN rating BETWEEN 1 AND 5 THEN CAST(rating AS DOUBLE) END)')}, 0.0) AS payload_mean, {_HALF2.format(x='sum(CASE WHEN rating BETWEEN 1 AND 5 THEN CAST(rating AS DOUBLE) ELSE 0.0 END) / count(*)')} AS harvest_mean FROM ({_SOURCE}) GROUP BY listing")
def mean_both(spark, sf_dir):
    return stats.mean_both(views.documents_by_source(spark, sf_dir), "listing")


@query(f"SELECT listing, count(*) FILTER (rating BETWEEN 1 AND 5) AS accepted, count(*) FILTER (rating NOT BETWEEN 1 AND 5) AS quarantined, count(*) FILTER (rating NOT BETWEEN 1 AND 5) / count(*) AS quarantine_rate FROM ({_SOURCE}) GROUP BY listing")
def quarantine_rate(spark, sf_dir):
    ok = numbers.valid_rating(F.col("rating"))
    g = views.documents_by_source(spark, sf_dir).groupBy("listing").agg(F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("quarantined"))
    return g.withColumn("quarantine_rate", stats.quarantine_rate(F.col("accepted"), F.col("quarantined")))


@query(f"SELECT md5(text) AS digest, count(*) AS copies FROM ({_SOURCE}) GROUP BY 1 HAVING count(*) > 1")
def exact_duplicates(spark, sf_dir):
    return stats.exact_duplicates(views.documents_by_source(spark, sf_dir).withColumn("digest", F.md5("text")), "digest")


# --- order


@query(f"SELECT listing, id, date, first_seen, CAST(row_number() OVER (PARTITION BY listing ORDER BY date DESC NULLS LAST, first_seen DESC NULLS LAST, id ASC) AS INT) AS position FROM ({_ITEMS})")
def publish_order_newest(spark, sf_dir):
    return ordering.ranked(views.lineitem_reviews(spark, sf_dir), "listing").select("listing", "id", "date", "first_seen", "position")


@query(f"SELECT listing, id, date, first_seen, CAST(row_number() OVER (PARTITION BY listing ORDER BY date ASC NULLS FIRST, first_seen ASC NULLS FIRST, id DESC) AS INT) AS position FROM ({_ITEMS})")
def publish_order_oldest(spark, sf_dir):
    return ordering.ranked(views.lineitem_reviews(spark, sf_dir), "listing", oldest=True).select("listing", "id", "date", "first_seen", "position")


@query(f"SELECT listing, id, position, CAST(ceil(position / 10) AS INT) AS page FROM (SELECT listing, id, CAST(row_number() OVER (PARTITION BY listing ORDER BY date DESC NULLS LAST, first_seen DESC NULLS LAST, id ASC) AS INT) AS position FROM ({_ITEMS})) WHERE position <= 20")
def latest_k(spark, sf_dir):
    return ordering.latest(views.lineitem_reviews(spark, sf_dir), "listing").select("listing", "id", "position", ordering.page_number(F.col("position")).alias("page"))


@query(f"SELECT id FROM ({_SOURCE}) WHERE rating BETWEEN 3 AND 5 AND length_grapheme(text) >= 200 AND language IN ('en', 'de')")
def display_filters(spark, sf_dir):
    d = views.documents_by_source(spark, sf_dir)
    return d.where(F.col("rating").between(3, 5) & (text.graphemes(F.col("text")) >= 200) & F.col("language").isin("en", "de")).select("id")


@query(f"""WITH r AS (SELECT *, CAST(author IS NOT NULL AS INT) + CAST(rating IS NOT NULL AS INT) + CAST(text IS NOT NULL AS INT) AS filled, sha256(text) AS h FROM ({_AUTHOR})),
  k AS (SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY author, rating, h) AS copies FROM r WINDOW w AS (PARTITION BY author, rating, h ORDER BY filled DESC, length(text) DESC, id ASC NULLS LAST, h))
  SELECT author, rating, id, copies FROM k WHERE n = 1""")
def collapse_intra_run(spark, sf_dir):
    d = views.documents_by_author(spark, sf_dir).withColumn("h", F.sha2("text", 256))
    return ordering.collapse_identities(d, ["author", "rating", "h"], ["author", "rating", "text"], "text", "id", "h").select("author", "rating", "id", "copies")


# --- identity

_UNIT = "chr(31)"
_BOUND = "CASE WHEN length(t) <= 512 THEN t ELSE rtrim(left_grapheme(t, 512), ' ' || chr(9) || chr(10) || chr(13)) END"
_COLLAPSE = r"trim(regexp_replace({x}, '\s+', ' ', 'g'))"
_DIGEST = "SELECT *, left(sha256(replace(" + _COLLAPSE.format(x=f"lower({_BOUND})") + r", '\', '\\')), 32) AS text_digest FROM (SELECT *, coalesce(text, '') AS t FROM (" + _AUTHOR + "))"
_FOLDED = r"trim(regexp_replace(regexp_replace(trim(regexp_replace(lower(coalesce(author, '')), '\s+', ' ', 'g')), '[\p{P}\p{S}]', '', 'g'), '\s+', ' ', 'g'))"
_KEYED = f"SELECT *, CASE WHEN {_FOLDED} <> '' THEN left(sha256('author' || {_UNIT} || {_FOLDED}), 32) ELSE left(sha256('anon' || {_UNIT} || listing || {_UNIT} || text_digest), 32) END AS author_key FROM ({_DIGEST})"


def _identified(spark, sf_dir):
    d = views.documents_by_author(spark, sf_dir)
    return d.withColumns({"text_digest": identity.text_digest(F.col("text")), "author_key": identity.author_key(F.col("author"), F.col("listing"), F.col("text"))})


@query(f"SELECT id, text_digest, author_key FROM ({_KEYED})")
def author_key(spark, sf_dir):
    return _identified(spark, sf_dir).select("id", "text_digest", "author_key")


@query(f"SELECT id, left(sha256('1' || {_UNIT} || listing || {_UNIT} || lower(source) || {_UNIT} || author_key || {_UNIT} || text_digest || {_UNIT} || rating), 32) AS identity_hash FROM ({_KEYED})")
def identity_hash(spark, sf_dir):
    d = _identified(spark, sf_dir)
    return d.select("id", identity.identity_hash(F.col("listing"), F.col("source"), F.col("author_key"), F.col("text"), F.col("rating")).alias("identity_hash"))


@query(f"""SELECT id, sha256('{{"author":' || CASE WHEN author IS NULL THEN 'null' ELSE '"' || author || '"' END || ',"id":' || id || ',"rating":' || rating || ',"source":"' || source || '"}}') AS content_hash FROM ({_AUTHOR})""")
def content_hash(spark, sf_dir):
    d = views.documents_by_author(spark, sf_dir)
    return d.select("id", identity.content_hash({c: F.col(c) for c in ("rating", "author", "source", "id")}).alias("content_hash"))


@query(f"""WITH s AS (SELECT listing, count(*) AS n, sum(rating) AS total FROM ({_SOURCE}) GROUP BY 1), h AS (SELECT listing, sha256('{{"listing":"' || listing || '","n":' || n || ',"total":' || total || '}}') AS new_hash FROM s),
  p AS (SELECT listing, sha256('{{"listing":"' || listing || '","n":' || count(*) || ',"total":' || sum(CASE WHEN listing < 'src5' THEN rating ELSE 0 END) || '}}') AS old_hash FROM ({_SOURCE}) GROUP BY 1)
  SELECT listing, new_hash <> old_hash AS changed FROM h LEFT JOIN p USING (listing)""")
def artifact_changed(spark, sf_dir):
    d = views.documents_by_source(spark, sf_dir)
    sealed = lambda total: d.groupBy("listing").agg(F.count("*").alias("n"), F.sum(total).alias("total")).select("listing", identity.content_hash({c: F.col(c) for c in ("listing", "n", "total")}).alias("h"))
    new, old = sealed(F.col("rating")).withColumnRenamed("h", "new_hash"), sealed(F.when(F.col("listing") < "src5", F.col("rating")).otherwise(0)).withColumnRenamed("h", "old_hash")
    return new.join(old, "listing", "left").select("listing", (F.col("new_hash") != F.col("old_hash")).alias("changed"))


# --- text

_STRIP = r"regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?(-->|$)', '', 'gs'), '<!\[CDATA\[.*?(\]\]>|$)', '', 'gs'), '<[!?/A-Za-z][^>]*(>|$)', '', 'gs')"


@query(f"SELECT page_id, CAST(length({_STRIP}) AS INT) AS n, md5({_STRIP}) AS digest, regexp_matches({_STRIP}, '<[!?/A-Za-z]') AS left_over FROM pages")
def strip_markup(spark, sf_dir):
    s = text.strip_markup(F.col("html"))
    return table(spark, sf_dir, "pages").withColumn("s", s).select("page_id", F.length("s").alias("n"), F.md5("s").alias("digest"), text.has_markup(F.col("s")).alias("left_over"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[\t\f\v ]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10))) AS digest FROM documents")
def canonical_space(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.canonical_space(F.col("text"))).alias("digest"))


@query("SELECT doc_id, CAST(length_grapheme(text) AS INT) AS graphemes, md5(CASE WHEN length(text) <= 100 THEN text ELSE rtrim(left_grapheme(text, 100), ' ' || chr(10)) END) AS head FROM documents")
def grapheme_bound(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", text.graphemes(t).alias("graphemes"), F.md5(text.bound(t, 100)).alias("head"))


@query(r"SELECT doc_id, regexp_matches(text, '(…|\.\.\.)\s*((read|show|see)?\s*more)?\s*$', 'i') AS truncated, CASE WHEN length(text) > 120 THEN left(text, 120) || '…' ELSE text END AS short FROM documents")
def truncation_marker(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.is_truncated(F.col("text")).alias("truncated"), text.truncate(F.col("text")).alias("short"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(text), '[\p{P}\p{S}]', ' ', 'g'), '\s+', ' ', 'g'))) AS digest FROM documents")
def fold_compare(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.fold(F.col("text"))).alias("digest"))


@query("SELECT p_partkey, upper(left(split_part(p_name, ' ', 1), 1) || left(split_part(p_name, ' ', 2), 1)) AS initials, CASE WHEN trim(p_type) <> '' THEN p_type END AS kind FROM part")
def initials(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.initials(F.col("p_name")).alias("initials"), text.blank_to_null(F.col("p_type")).alias("kind"))


# --- numbers


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL WHEN n BETWEEN 1 AND 5 THEN n END AS rating, n AS brand_number, -n AS negative FROM (SELECT *, CAST(regexp_extract(p_brand, '\\d+') AS INT) AS n FROM part)".replace("\\\\", "\\"))
def rating_cascade(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    label = F.when(F.col("p_size") % 3 != 0, F.col("p_brand"))
    n = numbers.read_number(F.replace("p_brand", F.lit("#"), F.lit(" -")))
    return p.select("p_partkey", numbers.rating_of(label, F.lit(None).cast("int"), F.lit(None).cast("string")).alias("rating"), numbers.read_number(F.col("p_brand")).cast("int").alias("brand_number"), n.cast("int").alias("negative"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_extendedprice) AS BIGINT) AS read FROM lineitem")
def read_count(spark, sf_dir):
    shown = F.format_number(F.floor("l_extendedprice"), 0)
    lang = F.when(F.col("l_linenumber") % 2 == 0, "de").otherwise("en")
    given = F.when(lang == "de", F.translate(shown, ",", ".")).otherwise(shown)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", numbers.read_count(F.concat(F.lit("("), given, F.lit(" reviews)")), lang).alias("read"))


@query("SELECT p_partkey, CASE WHEN p_size < 25 THEN -1 WHEN p_size > 25 THEN 1 WHEN p_partkey % 10 < 5 THEN -1 WHEN p_partkey % 10 > 5 THEN 1 ELSE 0 END AS compared FROM part")
def versions_compare(spark, sf_dir):
    v = F.concat_ws(".", F.col("p_size").cast("string"), (F.col("p_partkey") % 10).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", numbers.compare_versions(v, F.lit("25.5.0")).alias("compared"))


@query("SELECT event_id, CAST(least(900.0 * pow(2.0, n - 1), 21600000) AS BIGINT) AS wait_ms, CAST(greatest(1, floor(800 * least(greatest(value / 300.0, 0.1), 1.0))) AS BIGINT) AS step FROM (SELECT *, user_id % 20 + 1 AS n FROM events)")
def backoff(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", numbers.backoff_ms(900, F.col("user_id") % 20 + 1, 21_600_000).alias("wait_ms"), numbers.scroll_step(F.lit(800), F.col("value") / 300.0).alias("step"))


# --- urls


@query(r"""SELECT page_id, regexp_extract(url, '^([a-z]+):', 1) = 'https' AND regexp_matches(regexp_extract(url, '://([^/?#]*)', 1), '(^|\.)example\.com$') AS valid, CASE WHEN regexp_matches(url, '^(?i)https?://') THEN regexp_replace(url, '[?#].*$', '') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END ELSE url END AS plain
  FROM (SELECT page_id, url, list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda x: regexp_matches(x, '^(?i)(w|h|s|size|sz)(=|$)')) AS kept FROM (SELECT page_id, url || CASE page_id % 3 WHEN 0 THEN '?W=5&utm=x&sz=9#top' WHEN 1 THEN '&h=2' ELSE '' END AS url FROM pages))""")
def url_validate(spark, sf_dir):
    u = F.concat("url", F.when(F.col("page_id") % 3 == 0, "?W=5&utm=x&sz=9#top").when(F.col("page_id") % 3 == 1, "&h=2").otherwise(""))
    return table(spark, sf_dir, "pages").select("page_id", urls.is_valid(F.col("url"), ("example.com",)).alias("valid"), urls.strip_query(u).alias("plain"))


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN 'image' WHEN event_type = 'error' THEN 'media' ELSE 'document' END AS kind, event_type IN ('view', 'error') AS blocked FROM events""")
def route_decision(spark, sf_dir):
    kind = F.when(F.col("event_type") == "view", "image").when(F.col("event_type") == "error", "media").otherwise("document")
    return table(spark, sf_dir, "events").select("event_id", kind.alias("kind"), urls.is_blocked(kind, F.lit("example.com")).alias("blocked"))


# --- dates

#: Phrases, their language, and what they say.
PHRASES = [("3 days ago", "en", 3, "day"), ("a week ago", "en", 1, "week"), ("yesterday", "en", 1, "day"), ("vor 2 Monaten", "de", 2, "month"), ("vorgestern", "de", 2, "day"), ("il y a un an", "fr", 1, "year"), ("hace 5 horas", "es", 5, "hour"), ("anteayer", "es", 2, "day"), ("há ٣ semanas", "pt-BR", 3, "week"), ("nonsense", "en", None, None), ("just now", "xx", 0, "minute")]
_PHRASES = ", ".join(f"({i}, {'NULL' if n is None else n}, {'NULL' if u is None else repr(u)})" for i, (_, _, n, u) in enumerate(PHRASES))


@query(f"""SELECT event_id, CAST(n AS INT) AS n, u AS unit, epoch_us(ts) // 1000 - n * CASE u {' '.join(f"WHEN '{k}' THEN {v}" for k, v in dates.UNIT_MS.items())} END AS at_ms,
  CASE WHEN u IN ('week', 'month', 'year') THEN u WHEN u IS NULL THEN 'unknown' ELSE 'day' END AS precision, CASE WHEN u = 'month' THEN 'medium' WHEN u IS NULL OR u = 'year' THEN 'low' ELSE 'high' END AS confidence
  FROM events JOIN (VALUES {_PHRASES}) AS p(i, n, u) ON i = event_id % {len(PHRASES)}""")
def relative_dates(spark, sf_dir):
    phrase = F.element_at(F.array(*(F.lit(p[0]) for p in PHRASES)), (F.col("event_id") % len(PHRASES) + 1).cast("int"))
    locale = F.element_at(F.array(*(F.lit(p[1]) for p in PHRASES)), (F.col("event_id") % len(PHRASES) + 1).cast("int"))
    e = table(spark, sf_dir, "events").withColumns({"phrase": phrase, "locale": locale})
    e = e.withColumn("said", dates.parsed(F.col("phrase"), F.col("locale"))).select("event_id", "ts", "said.*")
    precision, confidence = dates.precision_of(F.col("unit"))
    return e.select("event_id", "n", "unit", dates.resolve_ms(F.unix_millis(F.col("ts").cast("timestamp")), F.col("n"), F.col("unit")).alias("at_ms"), precision.alias("precision"), confidence.alias("confidence"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d') AS day_key, strftime(ts, '%Y-%m-%dT%H') AS hour_key FROM events")
def hour_day_keys(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf_dir, "events").select("event_id", dates.absolute_date(iso).alias("day"), F.left(iso, F.lit(10)).alias("day_key"), F.left(iso, F.lit(13)).alias("hour_key"))


# --- language

_HITS = ", ".join(f"len(list_filter(ws, lambda w: list_contains({list(v)!r}, w))) AS {k}" for k, v in language.STOPWORDS.items())
_BEST = f"greatest({', '.join(language.STOPWORDS)})"


@query(rf"""WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(trim(text)), '[^\p{{L}}]+'), lambda x: x <> '') AS ws FROM documents), h AS (SELECT *, {_HITS} FROM w)
  SELECT doc_id, CASE WHEN length_grapheme(trim(text)) >= 12 AND {_BEST} >= 2 THEN CASE {' '.join(f"WHEN {k} = {_BEST} THEN '{k}'" for k in language.STOPWORDS)} END END AS language,
  CASE WHEN length_grapheme(trim(text)) >= 12 AND {_BEST} >= 2 THEN least(0.9, {_BEST} / len(ws) + 0.5) ELSE 0.0 END AS confidence FROM h""")
def language_stopwords(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", language.words_of(F.col("text")).alias("ws"))
    return d.select("doc_id", language.detected(F.col("text"), F.col("ws")).alias("found")).select("doc_id", "found.language", "found.confidence")


# --- duplicates

_PAIRS = rf"""
  k AS (SELECT id, author_key, trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[\p{{P}}\p{{S}}]', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM ({_KEYED})),
  g AS (SELECT id, author_key, size, g, count(*) AS n FROM (SELECT id, author_key, length(t) - 1 AS size, unnest(list_transform(range(1, length(t)), lambda i: substr(t, CAST(i AS INT), 2))) AS g FROM k WHERE length(t) >= 2) GROUP BY ALL),
  s AS (SELECT a.author_key, a.id AS l, b.id AS r, 2.0 * sum(least(a.n, b.n)) / (a.size + b.size) AS x FROM g a JOIN g b ON a.author_key = b.author_key AND a.g = b.g AND a.id < b.id GROUP BY a.author_key, a.id, b.id, a.size, b.size),
  pairs AS (SELECT author_key, l, r, floor(x * 10000.0 + 0.5) / 10000.0 AS similarity FROM s WHERE x >= 0.92)"""


@query(f'WITH {_PAIRS} SELECT author_key, l AS "left", r AS "right", similarity FROM pairs')
def near_duplicate_pairs(spark, sf_dir):
    return duplicates.similarity_pairs(_identified(spark, sf_dir))


@query(f"WITH {_PAIRS} SELECT author_key, count(*) AS pairs, count(*) + 1 AS stated_size FROM pairs GROUP BY 1")
def author_clusters(spark, sf_dir):
    return duplicates.pair_counts(_identified(spark, sf_dir))


@query(f"""WITH RECURSIVE {_PAIRS}, e AS (SELECT author_key, l AS a, r AS b FROM pairs UNION SELECT author_key, r, l FROM pairs), reach AS (SELECT author_key, a, a AS b FROM e UNION SELECT reach.author_key, reach.a, e.b FROM reach JOIN e ON e.author_key = reach.author_key AND e.a = reach.b)
  SELECT author_key, root, count(*) AS size FROM (SELECT author_key, a, min(b) AS root FROM reach GROUP BY 1, 2) GROUP BY 1, 2""")
def largest_cluster(spark, sf_dir):
    return duplicates.text_clusters(_identified(spark, sf_dir))


# --- ledger

_NOW = "2024-06-01T00:00:00Z"
_LEDGER = f"""
  prior AS (SELECT o_orderpriority AS listing, o_orderkey AS id, md5(o_orderstatus || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)) AS content_hash, CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'unconfirmed' ELSE CASE WHEN o_totalprice > 400000 THEN 'suppressed' ELSE 'tombstoned' END END AS state,
    strftime(o_orderdate, '%Y-%m-%d') AS first_seen_at, strftime(o_orderdate, '%Y-%m-%d') AS last_seen_at, CAST(CASE o_orderstatus WHEN 'O' THEN 1 + o_custkey % 2 ELSE 0 END AS INT) AS missing_streak FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
  obs AS (SELECT o_orderpriority AS listing, o_orderkey AS id, md5(CASE WHEN o_totalprice > 250000 THEN 'edited' ELSE o_orderstatus || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END) AS o_hash FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderpriority <> '5-LOW'),
  harvest AS (SELECT * FROM (VALUES ('1-URGENT', 'full', NULL), ('2-HIGH', 'partial', NULL), ('3-MEDIUM', 'full_capped', NULL), ('4-NOT SPECIFIED', 'full', '{_NOW}')) AS h(listing, completeness, last_full)),
  j AS (SELECT coalesce(p.listing, o.listing) AS listing, coalesce(p.id, o.id) AS id, p.id IS NOT NULL AS known, o.id IS NOT NULL AS seen, content_hash, o_hash, state, first_seen_at, missing_streak FROM prior p FULL JOIN obs o ON p.listing = o.listing AND p.id = o.id),
  d AS (SELECT j.*, completeness, last_full, h.listing IS NOT NULL AS ran, j.id IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 450000) AS denied FROM j LEFT JOIN harvest h USING (listing)),
  m AS (SELECT *, CASE WHEN NOT ran THEN NULL WHEN seen THEN CASE WHEN denied THEN 'SUPPRESSED' WHEN known AND state IN ('tombstoned', 'suppressed') THEN 'IGNORED_TERMINAL' WHEN NOT known THEN 'INSERTED' WHEN content_hash = o_hash THEN 'UNCHANGED' ELSE 'UPDATED' END
    ELSE CASE WHEN state IN ('tombstoned', 'suppressed') THEN 'IGNORED_TERMINAL' WHEN completeness NOT IN ('full', 'full_capped') THEN 'HELD' WHEN last_full = '{_NOW}' THEN 'HELD' WHEN missing_streak + 1 >= 3 THEN 'TOMBSTONED' ELSE 'MISSING' END END AS outcome FROM d),
  merged AS (SELECT * FROM m WHERE known OR outcome <> 'SUPPRESSED')"""


def _merged(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    plain = F.concat("o_orderstatus", F.floor("o_totalprice").cast("string"))
    day, status = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus")
    prior = o.where("o_orderdate < TIMESTAMP '1998-01-01'").select(
        F.col("o_orderpriority").alias("listing"), F.col("o_orderkey").alias("id"), F.md5(plain).alias("content_hash"),
        F.when(status == "F", "active").when(status == "O", "unconfirmed").when(F.col("o_totalprice") > 400000, "suppressed").otherwise("tombstoned").alias("state"),
        day.alias("first_seen_at"), day.alias("last_seen_at"), day.alias("last_updated_at"), F.lit(1).alias("revision"),
        F.when(status == "O", 1 + F.col("o_custkey") % 2).otherwise(0).cast("int").alias("missing_streak"), F.when(status == "P", day).alias("tombstoned_at"), F.array().cast("array<string>").alias("history"),
    )
    seen = o.where("o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderpriority <> '5-LOW'").select(F.col("o_orderpriority").alias("listing"), F.col("o_orderkey").alias("id"), F.md5(F.when(F.col("o_totalprice") > 250000, "edited").otherwise(plain)).alias("content_hash"))
    harvests = spark.createDataFrame([("1-URGENT", _NOW, "full", None), ("2-HIGH", _NOW, "partial", None), ("3-MEDIUM", _NOW, "full_capped", None), ("4-NOT SPECIFIED", _NOW, "full", _NOW)], "listing string, now string, completeness string, last_full_harvest_at string")
    return merge.reconcile(prior, seen, harvests, o.where("o_totalprice > 450000").select(F.col("o_orderkey").alias("id")))


@query(f"WITH {_LEDGER} SELECT listing, id, outcome FROM merged")
def reconcile_outcomes(spark, sf_dir):
    return _merged(spark, sf_dir).select("listing", "id", "outcome")


@query(f"""WITH {_LEDGER} SELECT listing, id, CASE WHEN outcome IN ('INSERTED', 'UPDATED') THEN o_hash ELSE content_hash END AS content_hash,
  CASE WHEN denied AND known AND ran THEN 'suppressed' WHEN outcome IN ('INSERTED', 'UPDATED', 'UNCHANGED') THEN 'active' WHEN outcome = 'MISSING' THEN 'unconfirmed' WHEN outcome = 'TOMBSTONED' THEN 'tombstoned' ELSE state END AS state,
  CASE WHEN outcome = 'INSERTED' THEN '{_NOW}' ELSE first_seen_at END AS first_seen_at, CASE WHEN outcome IN ('INSERTED', 'UPDATED', 'UNCHANGED') THEN '{_NOW}' ELSE first_seen_at END AS last_seen_at, CAST(CASE outcome WHEN 'UPDATED' THEN 2 ELSE 1 END AS INT) AS revision,
  CAST(CASE WHEN outcome IN ('INSERTED', 'UPDATED', 'UNCHANGED') THEN 0 WHEN outcome IN ('MISSING', 'TOMBSTONED') THEN missing_streak + 1 ELSE missing_streak END AS INT) AS missing_streak, CAST(CASE outcome WHEN 'UPDATED' THEN 1 ELSE 0 END AS INT) AS changes FROM merged""")
def reconcile_ledger(spark, sf_dir):
    return _merged(spark, sf_dir).select("listing", "id", "content_hash", "state", "first_seen_at", "last_seen_at", "revision", "missing_streak", F.size("history").alias("changes"))


@query(f"WITH {_LEDGER} SELECT listing, {', '.join(f'''count(*) FILTER (outcome = '{o}') AS {o.lower()}''' for o in merge.OUTCOMES)} FROM merged GROUP BY listing")
def decision_tally(spark, sf_dir):
    return merge.tally(_merged(spark, sf_dir), "listing")


@query("""WITH p AS (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day, 'month' AS precision, 'was ' || o_orderstatus AS text FROM orders WHERE o_custkey % 4 > 0), n AS (SELECT o_orderkey AS id, strftime(DATE '2024-06-01' - CAST(o_custkey % 20 + 1 AS INT) * CASE WHEN o_orderkey % 2 = 0 THEN 7 ELSE 1 END, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 2 = 0 THEN 'week' ELSE 'day' END AS precision, 'is ' || o_orderstatus AS text, o_orderkey % 3 = 0 AS edited FROM orders WHERE o_custkey % 3 > 0)
  SELECT id, CASE WHEN p.id IS NULL THEN 'INSERTED' WHEN n.id IS NULL THEN 'MISSING' WHEN edited THEN 'UPDATED' ELSE 'UNCHANGED' END AS outcome, coalesce(p.day, n.day) AS day, coalesce(p.precision, n.precision) AS precision, CASE WHEN p.id IS NULL OR edited THEN n.text ELSE p.text END AS text FROM p FULL JOIN n USING (id)""")
def pinned_dates(spark, sf_dir):
    """A harvest with relative dates merged into a ledger: a date is estimated once, texts follow the source."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    day, none = F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(None).cast("string")
    prior = o.where("o_custkey % 4 > 0").select(
        F.lit("l").alias("listing"), k.alias("id"), F.lit("h").alias("content_hash"), F.lit("active").alias("state"), day.alias("first_seen_at"), day.alias("last_seen_at"), day.alias("last_updated_at"), F.lit(1).alias("revision"), F.lit(0).alias("missing_streak"), none.alias("tombstoned_at"), F.array().cast("array<string>").alias("history"),
        day.alias("day"), F.lit("month").alias("precision"), F.concat(F.lit("was "), "o_orderstatus").alias("text"),
    )
    phrase = F.concat((F.col("o_custkey") % 20 + 1).cast("string"), F.when(k % 2 == 0, " weeks ago").otherwise(" days ago"))
    count, unit = dates.parse_phrase(phrase, F.lit("en"))
    seen = o.where("o_custkey % 3 > 0").select(
        F.lit("l").alias("listing"), k.alias("id"), F.when(k % 3 == 0, "new").otherwise("h").alias("content_hash"), F.date_format(F.timestamp_millis(dates.resolve_ms(F.unix_millis(F.lit("2024-06-01T00:00:00Z").cast("timestamp")), count, unit)), "yyyy-MM-dd").alias("day"), dates.precision_of(unit)[0].alias("precision"), F.concat(F.lit("is "), "o_orderstatus").alias("text"),
    )
    harvest = spark.createDataFrame([("l", _NOW, "full", None)], "listing string, now string, completeness string, last_full_harvest_at string")
    merged = merge.reconcile(prior, seen, harvest, o.where("false").select(k.alias("id")), carried=("text",), pinned=("day", "precision"))
    return merged.select("id", "outcome", "day", "precision", "text")


@query("""WITH l AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey + 1 ELSE o_orderkey END AS own, CASE o_orderstatus WHEN 'P' THEN 'tombstoned' ELSE 'active' END AS state, o_custkey % 4 - 1 AS streak, o_custkey % 5 AS revision, o_custkey % 3 AS hashes, o_orderdate AS first, o_orderdate + to_days(CAST(o_custkey % 10 - 1 AS INT)) AS last, o_custkey % 2 = 0 AS timed FROM orders),
  v AS (SELECT id, 'key' AS rule FROM l WHERE own <> id UNION ALL SELECT id, 'revision' FROM l WHERE revision < 1 UNION ALL SELECT id, 'streak' FROM l WHERE streak < 0 UNION ALL SELECT id, 'tombstone_without_time' FROM l WHERE state = 'tombstoned' AND NOT timed UNION ALL SELECT id, 'seen_before_first' FROM l WHERE first > last UNION ALL SELECT id, 'history' FROM l WHERE hashes <> revision - 1)
  SELECT id, string_agg(rule, '|' ORDER BY rule) AS broken FROM v GROUP BY id""")
def ledger_invariants(spark, sf_dir):
    """Records made from orders, of which most break something."""
    k, day = F.col("o_custkey"), lambda c: F.date_format(c, "yyyy-MM-dd")
    records = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 11 == 0, F.col("o_orderkey") + 1).otherwise(F.col("o_orderkey")).alias("own"), F.when(F.col("o_orderstatus") == "P", "tombstoned").otherwise("active").alias("state"), (k % 4 - 1).alias("missing_streak"), (k % 5).alias("revision"),
        F.array_repeat(F.lit("h"), (k % 3).cast("int")).alias("history"), day("o_orderdate").alias("first_seen_at"), day(F.date_add("o_orderdate", (k % 10 - 1).cast("int"))).alias("last_seen_at"), F.when(k % 2 == 0, "t").alias("tombstoned_at"),
    )
    return merge.violations(records, identity="own").select("id", F.array_join(F.array_sort("broken"), "|").alias("broken"))


# --- rules


@query(f"""SELECT id, array_to_string(list_filter([CASE WHEN rating NOT BETWEEN 1 AND 5 THEN 'rating:fatal' END, CASE WHEN length(text) > 5000 THEN 'text_length:fatal' END, CASE WHEN (author IS NULL OR author = '') AND (text IS NULL OR text = '') THEN 'anonymous_without_text:info' END, CASE WHEN source < 'src3' THEN 'undated:warn' END], lambda x: x IS NOT NULL), ',') AS findings,
  rating NOT BETWEEN 1 AND 5 OR coalesce(length(text) > 5000, FALSE) AS quarantined FROM ({_AUTHOR})""")
def validate_records(spark, sf_dir):
    d = views.documents_by_author(spark, sf_dir)
    found = rules.record_findings(F.col("rating"), F.col("id"), F.col("text"), F.col("author"), F.when(F.col("source") >= "src3", F.lit("2024-01-01")))
    return d.withColumn("f", found).select("id", F.array_join(F.transform("f", lambda x: F.concat_ws(":", x["code"], x["severity"])), ",").alias("findings"), rules.quarantined(F.col("f")).alias("quarantined"))


@query("""WITH c AS (SELECT l_suppkey AS listing, count(*) AS n, floor(avg(l_linenumber) * 100.0 + 0.5) / 100.0 AS mean, count(*) FILTER (l_shipdate < TIMESTAMP '1998-06-01') AS pn, floor(avg(l_linenumber) FILTER (l_shipdate < TIMESTAMP '1998-06-01') * 100.0 + 0.5) / 100.0 AS pm, count(*) FILTER (l_linenumber > 6) / count(*) AS q, count(*) FILTER (l_returnflag = 'N') AS kept FROM lineitem GROUP BY 1),
  r AS (SELECT listing, list_filter([CASE WHEN kept = 0 AND pn > 0 THEN 'G-02:REJECT' END, CASE WHEN pn > 0 AND (pn - kept) / pn > 0.2 THEN 'G-03:REJECT' END, CASE WHEN pn > 0 AND abs(mean - pm) > 0.5 THEN 'G-04:REJECT' END, CASE WHEN listing % 2 = 0 AND kept < pn THEN 'G-05:REJECT' END, CASE WHEN q > 0.05 THEN 'G-06:REJECT' END, CASE WHEN kept / n < 0.95 THEN 'G-08:WARN' END], lambda x: x IS NOT NULL) AS v FROM c)
  SELECT listing, array_to_string(v, ',') AS reasons, CASE WHEN len(list_filter(v, lambda x: x LIKE '%REJECT')) > 0 THEN 'REJECT' WHEN len(v) > 0 THEN 'ACCEPT_WITH_WARNINGS' ELSE 'ACCEPT' END AS decision FROM r""")
def gate_verdict(spark, sf_dir):
    early = F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp")
    c = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("listing")).agg(
        F.count_if(F.col("l_returnflag") == "N").alias("count"), numbers.half_up(F.avg("l_linenumber"), 2).alias("mean"), F.count_if(early).alias("prior_count"),
        numbers.half_up(F.avg(F.when(early, F.col("l_linenumber"))), 2).alias("prior_mean"), (F.count_if(F.col("l_linenumber") > 6) / F.count("*")).alias("quarantine_rate"), (F.count_if(F.col("l_returnflag") == "N") / F.count("*")).alias("coverage"),
    )
    none = F.lit(None).cast("double")
    c = c.withColumns({"prior_readable": F.lit(True), "completeness": F.when(F.col("listing") % 2 == 0, "partial").otherwise("full"), "schema_errors": F.lit(0), "fatal_findings": F.lit(0), "advertised_mean": none, "bytes": none, "largest_cluster": none, "advertised": none, "prior_advertised": none, "force": F.lit(False)})
    return rules.gate(c).select("listing", F.array_join(F.transform("reasons", lambda x: F.concat_ws(":", x["code"], x["severity"])), ",").alias("reasons"), "decision")


# --- health

_HEALTH = "SELECT user_id AS target, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'deferred' ELSE 'succeeded' END AS outcome, CASE WHEN event_type = 'view' THEN least(1.0, value / 100.0) END AS coverage, CASE event_type WHEN 'purchase' THEN 'ACCEPT' WHEN 'error' THEN 'REJECT' END AS gate_decision, value * 1000.0 AS duration_ms, event_type = 'error' AND value > 200 AS challenged FROM events"
_METRICS = f"""SELECT target, count(*) FILTER (outcome = 'succeeded') / nullif(count(*) FILTER (outcome <> 'deferred'), 0) AS success_rate, avg(coverage) AS coverage, count(*) FILTER (gate_decision = 'REJECT') / nullif(count(gate_decision), 0) AS gate_rejection_rate,
  quantile_disc(duration_ms, 0.95) AS p95_duration_ms, CAST(count(*) FILTER (challenged) AS DOUBLE) AS challenges FROM ({_HEALTH}) GROUP BY target"""


def _metrics(spark, sf_dir):
    k, v = F.col("event_type"), F.col("value")
    h = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("target"), F.when(k == "error", "failed").when(k == "signup", "deferred").otherwise("succeeded").alias("outcome"), F.when(k == "view", F.least(F.lit(1.0), v / 100.0)).alias("coverage"),
        F.when(k == "purchase", "ACCEPT").when(k == "error", "REJECT").alias("gate_decision"), (v * 1000.0).alias("duration_ms"), ((k == "error") & (v > 200)).alias("challenged"),
        F.lit(1).alias("commits"), F.lit(0).alias("peak_rss"), F.lit(9).alias("index_0"), F.lit(10).alias("indices"),
    )
    return health.metrics(h, "target")


@query(_METRICS)
def health_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir).select("target", "success_rate", "coverage", "gate_rejection_rate", "p95_duration_ms", "challenges")


def _status_sql(name):
    good, act, better = health.BANDS[name]
    a, b = (f"{name} >= {good}", f"{name} < {act}") if better == "higher" else (f"{name} <= {good}", f"{name} > {act}")
    return f"SELECT target, '{name}' AS metric, CASE WHEN {name} IS NULL THEN 'unknown' WHEN {a} THEN 'healthy' WHEN {b} THEN 'act' ELSE 'watch' END AS status FROM m"


@query(f"WITH m AS (SELECT *, 0.9 AS index_0_share, 1.0 AS commits_per_run, NULL AS peak_rss_bytes FROM ({_METRICS})) " + " UNION ALL ".join(map(_status_sql, health.BANDS)))
def metric_bands(spark, sf_dir):
    return health.band_report(_metrics(spark, sf_dir), "target").select("target", "metric", "status")


@query(f"WITH m AS (SELECT *, 0.9 AS index_0_share, 1.0 AS commits_per_run, NULL AS peak_rss_bytes FROM ({_METRICS})), r AS (" + " UNION ALL ".join(map(_status_sql, health.BANDS)) + ") SELECT target, metric, left(sha256(target || '|' || metric), 16) AS fingerprint FROM r WHERE status = 'act'")
def alerts(spark, sf_dir):
    return health.alerts(health.band_report(_metrics(spark, sf_dir), "target"), "target").select("target", "metric", "fingerprint")


# --- scheduling


@query("""WITH h AS (SELECT event_id, user_id, ts, strftime(ts, '%Y-%m-%dT%H') AS hk, strftime(ts, '%Y-%m-%d') AS dk, row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%dT%H') ORDER BY ts, event_id) <= 1 AS ok FROM events)
  SELECT event_id, hk AS hour_key, dk AS day_key, ok AND sum(CAST(ok AS INT)) OVER (PARTITION BY user_id, dk ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) <= 3 AS granted FROM h""")
def token_bucket(spark, sf_dir):
    r = table(spark, sf_dir, "events").select("user_id", "ts", F.col("event_id").alias("id"))
    return schedule.budget_grants(r, "user_id", per_hour=1, per_day=3).select(F.col("id").alias("event_id"), "hour_key", "day_key", "granted")


@query("""WITH e AS (SELECT c_custkey, c_mktsegment, max(ts) AS last_run FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1, 2)
  SELECT c_custkey AS target, CASE WHEN c_mktsegment = 'BUILDING' THEN 'disabled' WHEN c_mktsegment = 'MACHINERY' THEN 'paused' WHEN last_run IS NULL THEN 'never_run' WHEN TIMESTAMP '2024-01-31' >= last_run + INTERVAL 24 HOUR THEN 'due' ELSE 'fresh' END AS reason,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN FALSE WHEN last_run IS NULL THEN TRUE ELSE TIMESTAMP '2024-01-31' >= last_run + INTERVAL 24 HOUR END AS due FROM e""")
def due_targets(spark, sf_dir):
    runs = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.unix_micros(F.max("ts").cast("timestamp")).alias("last_run"))
    c = table(spark, sf_dir, "customer").join(runs, "c_custkey", "left")
    hour = 3_600_000_000
    is_due, reason = schedule.due(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment") == "MACHINERY", F.col("last_run"), F.unix_micros(F.lit("2024-01-31").cast("timestamp")), F.lit(24 * hour), F.lit(6 * hour))
    return c.select(F.col("c_custkey").alias("target"), reason.alias("reason"), is_due.alias("due"))


@query("""WITH r AS (SELECT user_id, ts, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events), c AS (SELECT *, sum(CASE WHEN p IS NOT NULL AND p <> event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM r)
  SELECT user_id, event_type AS last_value, CAST(count(*) - 1 AS INT) AS quiet FROM c WHERE g = (SELECT max(x.g) FROM c x WHERE x.user_id = c.user_id) GROUP BY 1, 2""")
def growth_curve_quiet(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    return schedule.quiet_run(e, "user_id", order="at", value="event_type")


@query("SELECT count(*) AS planned, count(*) FILTER (NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)) AS missing FROM customer")
def missing_outcomes(spark, sf_dir):
    ran = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"), F.lit(True).alias("ran")).distinct()
    return table(spark, sf_dir, "customer").join(ran, "c_custkey", "left").agg(F.count("*").alias("planned"), F.count_if(F.col("ran").isNull()).alias("missing"))


# --- sources


@query("""SELECT conv_id, turn, length(text) AS n_chars, length(reply) AS reply_chars FROM (SELECT conv_id, turn, role, text, lead(text) OVER w AS reply, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant'""")
def reply_pairs(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations").withColumns({"reply": F.lead("text").over(w), "next_role": F.lead("role").over(w)})
    return c.where("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", F.length("text").cast("long").alias("n_chars"), F.length("reply").cast("long").alias("reply_chars"))


@query("SELECT page_id, CASE WHEN h LIKE '%captcha%' OR m >= 2 THEN 'ERR-BLOCKED-CHALLENGE' WHEN h LIKE '%consent%' THEN 'ERR-NAV-CONSENT-WALL' WHEN m = 1 THEN 'ERR-NAV-SURFACE-NOT-FOUND' END AS signal FROM (SELECT page_id, lower(html) AS h, CAST(lower(html) LIKE '%unusual%' AS INT) + CAST(lower(html) LIKE '%verify%' AS INT) AS m FROM pages)")
def signal_classify(spark, sf_dir):
    h = F.lower("html")
    return table(spark, sf_dir, "pages").select("page_id", urls.classify_signals(h, high=["captcha"], medium=["unusual", "verify"], consent=["consent"]).alias("signal"))


@query()
def html_extract(spark, sf_dir):
    return readers.html_elements(table(spark, sf_dir, "pages"), ("article", "h1", "p", "a"))


@query()
def entity_decode(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.decode_and_strip(F.col("html"))).alias("digest"))


@query("SELECT c_name AS target, list_reduce(list_concat([CAST(2166136261 AS BIGINT)], list_transform(string_split('run-1:' || c_name, ''), lambda x: CAST(unicode(x) AS BIGINT))), lambda h, c: (xor(h, c) * 16777619) & 4294967295) AS order_hash FROM customer")
def seeded_order(spark, sf_dir):
    return schedule.seeded_order(table(spark, sf_dir, "customer").select(F.col("c_name").alias("target")), "run-1")
