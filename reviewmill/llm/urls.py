"""URL filter: allow and block rules, then gradient-boosted trees on lexical features.

The longest rule that fits a url decides it. Urls that no rule fits get the
verdict of trees trained on the different urls that rules do label: at most SAMPLE of
them, those of smallest hash, so the sample is the same in every run and no url that
fills a table can fill it.

Defined results: a null url, or one without ``://``, has an empty host and path
and fits no rule; its verdict is the trees' verdict on those empty parts, as for
any other url. Without labelled urls everything unruled is allowed. Repeated rows
and null ids give a row each; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, fit

#: (verdict, rule): host and path prefix.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Different labelled urls that train the trees, at most.
SAMPLE = 20_000
#: Suffixes with statistics of their own, at most; the commonest of all labelled urls.
SUFFIXES = 64


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or no ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, r in sorted(rules, key=lambda x: (len(x[1]), x[1])):  # the longest is asked first
        at, start = r.partition("/")[0], "/" + r.partition("/")[2]
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _count(c: Column, pattern: str) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, pattern, ""))


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features: length, depth, digit ratio, entropy, parameters, marks and language of the path."""
    u = F.coalesce(url, F.lit(""))
    letters = F.regexp_replace(F.lower(host), r"[^a-z0-9.-]", "")
    n = F.greatest(F.length(host), F.lit(1))
    share = [(F.length(letters) - F.length(F.replace(letters, F.lit(ch), F.lit("")))) / n for ch in "abcdefghijklmnopqrstuvwxyz0123456789.-"]
    entropy = sum((F.when(p > 0, -p * F.log2(p)).otherwise(0.0) for p in share), F.lit(0.0))
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    parts = F.size(F.split(host, r"\."))
    out = {
        "length": F.length(u), "host_length": F.length(host), "path_length": F.length(path), "labels": parts, "depth": _count(path, "/"),
        "digit_ratio": _count(u, "[0-9]") / F.greatest(F.length(u), F.lit(1)), "host_digits": _count(host, "[0-9]"), "entropy": entropy,
        "parameters": F.when(query == "", 0).otherwise(_count(query, "&") + 1), "query_length": F.length(query), "dashes": _count(host, "-"),
        "fragment": F.contains(u, F.lit("#")).cast("int"), "https": F.startswith(F.lower(u), F.lit("https")).cast("int"), "ends_html": F.endswith(path, F.lit(".html")).cast("int"), "ends_slash": F.endswith(path, F.lit("/")).cast("int"),
        "longest_label": F.array_max(F.transform(F.split(host, r"\."), lambda x: F.length(x))), "first_part": F.length(F.regexp_extract(path, r"^/([^/]*)", 1)),
    }
    return {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in out.items()}


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def judged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """id, url, host, path, rule and the rule's verdict."""
    rows = pages.select(F.col(id_col), F.col(url_col).alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    return rows.withColumns({"rule": rule, "said": said})


def train(rows: DataFrame, sample: int = SAMPLE) -> tuple[Boosted, dict[str, float]]:
    """Trees, from a sample, and suffix statistics (the smoothed share of blocked urls), from all urls that a rule labels."""
    own = features(F.col("url"), F.col("host"), F.col("path"))
    labelled = rows.where(F.col("said").isNotNull()).withColumns({"h": F.xxhash64("url"), "y": (F.col("said") == "block").cast("int")})
    all_ = labelled.agg(F.avg("y").alias("prior")).first()
    prior = float(all_["prior"] or 0.0)
    suffixes = labelled.groupBy(suffix_of(F.col("host")).alias("suffix")).agg(F.count("*").alias("n"), F.sum("y").alias("blocked")).orderBy(F.desc("n"), "suffix").limit(SUFFIXES).collect()
    shares = {r["suffix"]: (r["blocked"] + 10 * prior) / (r["n"] + 10) for r in suffixes} | {"": prior}
    # Hashes are even, so a share of their range holds that share of the urls, about: twice the sample is set apart before any sorting.
    number = labelled.agg(F.approx_count_distinct("h", 0.02).alias("n")).first()["n"]
    top = min(2**63 - 1, 2 * sample * 2**64 // max(1, number) - 2**63)
    labelled = labelled.where(F.col("h") <= top).select("url", "host", "path", "said", "h").distinct().orderBy("h", "url").limit(sample)
    got = labelled.withColumn("y", (F.col("said") == "block").cast("int")).select("y", suffix_of(F.col("host")).alias("suffix"), *(c.alias(k) for k, c in own.items())).collect()
    if not got:
        return Boosted([*own, "suffix_share"]), {}
    y = np.array([r["y"] for r in got], float)
    x = np.array([[r[k] for k in own] + [shares.get(r["suffix"], prior)] for r in got], float)
    return fit([*own, "suffix_share"], x, y), shares


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """id, host, path, rule, verdict and blocked_probability (the trees', null where a rule decides)."""
    rows = judged(pages, id_col, url_col, rules)
    model, shares = train(rows, sample)
    if not model.trees:
        score = F.lit(0.0)
    else:
        known = F.create_map(*[F.lit(v) for s, p in shares.items() if s for v in (s, float(p))]) if len(shares) > 1 else None
        share = F.coalesce(known[suffix_of(F.col("host"))], F.lit(float(shares[""]))) if known is not None else F.lit(float(shares[""]))
        # The features become columns first, so that each is computed once.
        rows = rows.withColumns({f"_f_{k}": c for k, c in features(F.col("url"), F.col("host"), F.col("path")).items()} | {"_f_suffix_share": share})
        score = model.expression({k: F.col(f"_f_{k}") for k in model.names})
    score = F.when(F.col("rule").isNull(), score)
    return rows.withColumn("blocked_probability", score).select(
        id_col, "host", "path", "rule", F.coalesce("said", F.when(F.col("blocked_probability") >= threshold, "block").otherwise("allow")).alias("verdict"), "blocked_probability"
    )
