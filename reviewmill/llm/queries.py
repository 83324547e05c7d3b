"""The registered queries: thin wrappers that apply each operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, divergence, html_text, lines, minhash, neighbours, packing, pii, quality, repeats, suffix_tree, urls
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    kept = quality.verdict(quality.POLICIES["v1"])
    return rows.select("doc_id", *quality.MEASURES[:5], (~quality.verdict(quality.BASE)).alias("base_failed"), kept.alias("kept"), "fail_bits")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The rank file holds the vocabulary of byte_bpe_50k.json; with its added tokens the two give the same ids.
    path, added = public_tokenizers.path("byte_bpe_50k.tiktoken"), packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, added))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, pattern), path, pattern))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), passage=200)
    return cleaned.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passage_bytes")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_pii, op3_packing, op4_bpe, op5_neighbours, op6_suffix_tree, op7_minhash, op8_url_filter, op9_repeats, op10_html_text, op11_line_dedup, op12_divergence, op13_centroids)}


_OP1 = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, row_number() OVER () AS r FROM documents
), lines AS (
  SELECT r, x AS line FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM w) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), per_line AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r
), windows AS (
  SELECT r, i, array_to_string(ws[i:i+7], ' ') AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(8) AS o(k) GROUP BY r
), tops AS (
  SELECT r, max(c) AS n_top_word FROM (SELECT r, x, count(*) AS c FROM (SELECT r, unnest(ws) AS x FROM w) GROUP BY r, x) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_top_word, 0) AS n_top_word, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_ascii_letters, length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits, length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs
  FROM w LEFT JOIN per_line USING (r) LEFT JOIN covered USING (r) LEFT JOIN tops USING (r)
), b AS (
  SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT + 8 * (n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)::INT
    + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT + 32 * (n_ascii_letters >= 20 AND 2 * n_upper > n_ascii_letters)::INT + 64 * (n_bangs >= 5 AND 5 * n_bangs > n_words)::INT
    + 128 * (2 * n_digits > word_chars)::INT + 256 * (n_words >= 20 AND 10 * n_top_word > 4 * n_words)::INT AS BIGINT) AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""


_OP7 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * c >= 75 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), root AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN root USING (doc_id)
"""


_OP11 = r"""
WITH l AS (
  SELECT r, doc_id, k, ls[k] AS line FROM (SELECT r, doc_id, ls, unnest(range(1, len(ls) + 1)) AS k FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), repeated AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT r, keyed.doc_id, k, line, keeper IS NOT NULL AND keeper <> keyed.doc_id AS gone FROM keyed LEFT JOIN repeated USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256 FROM marked GROUP BY r
"""


_OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), t AS (
  SELECT r, lang, source, unnest(ts) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS ln FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), sizes AS (
  SELECT lang, count(*) AS v, sum(ln) AS ltotal FROM kept GROUP BY lang
), own AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM d
), known AS (
  SELECT lang, source, v, ltotal, coalesce(total, 0) AS total FROM groups JOIN sizes USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM own GROUP BY ALL) USING (lang, source)
), dense AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0) + 5)::HUGEINT // (total + 5 * v)::HUGEINT AS p, 1 + 1000000000 * (ln + 5)::HUGEINT // (ltotal + 5 * v)::HUGEINT AS q
  FROM kept JOIN known USING (lang) LEFT JOIN own USING (lang, source, term)
), gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
), both_parts AS (
  SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM dense WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts) WHERE part = 'pair' OR rank <= 50
"""


def _op13() -> str:
    """Eleven assignments and ten updates, a table each."""
    steps = [
        """kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS cluster, x FROM (SELECT x, sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM kept ORDER BY h, x LIMIT 8))",
    ]
    for k in range(11):
        gap = "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"a{k} AS MATERIALIZED (SELECT r, min(CAST({gap} AS HUGEINT) * 8 + c.cluster) AS best FROM kept v, c{k} c GROUP BY r)")
        if k < 10:
            steps.append(f"""s{k} AS (SELECT cluster, i, CAST(sum(e) AS BIGINT) AS total, count(*) AS n FROM (SELECT CAST(best % 8 AS INTEGER) AS cluster, unnest(range(1, 65)) AS i, unnest(x) AS e FROM kept JOIN a{k} USING (r)) GROUP BY ALL)""")
            # // cuts towards zero; a negative remainder takes one off.
            steps.append(f"c{k + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN (SELECT cluster, list(total // n - CASE WHEN total % n < 0 THEN 1 ELSE 0 END ORDER BY i) AS x FROM s{k} GROUP BY cluster) m USING (cluster))")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, CAST(best % 8 AS INTEGER) AS cluster, CAST(best // 8 AS BIGINT) AS distance, CAST(sum(best // 8) OVER (PARTITION BY best % 8) AS BIGINT) AS cluster_inertia, CAST(sum(best // 8) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.x, lambda e: CAST(e AS VARCHAR)), ',')) AS centroid_sha256
FROM a10 JOIN kept USING (r) JOIN c10 c ON c.cluster = best % 8
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": _OP1, "op7_minhash": _OP7, "op11_line_dedup": _OP11, "op12_divergence": _OP12, "op13_centroids": _op13()}
