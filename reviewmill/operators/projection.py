"""Published shapes: public reviews, JSON-LD, names, candidates, run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fields that no payload may carry, legal suffixes of names, states of outcomes and their exit codes.
FORBIDDEN = ("identity_hash_inputs", "email", "phone", "raw_html", "session", "cookies")
SUFFIXES = ("inc", "llc", "ltd", "gmbh", "co", "corp", "sa", "srl", "bv", "plc")
OUTCOMES = ("succeeded", "failed", "blocked", "deferred", "skipped")
MATCH = 0.82


def name_tokens(name: Column) -> Column:
    """Lower-case words; & and + are "and"; trailing legal suffixes go while a word is left."""
    c = F.regexp_replace(F.lower(name), r"[&+]", " and ")
    words = F.array(F.split(F.trim(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " ")), " "))
    # The list is the element of an array of one, so that it is split once.
    for _ in range(2):
        words = F.transform(words, lambda w: F.when((F.size(w) > 1) & F.element_at(w, -1).isin(*SUFFIXES), F.slice(w, 1, F.size(w) - 1)).otherwise(w))
    return F.array_distinct(F.filter(words[0], lambda w: w != ""))


def name_similarity(a: Column, b: Column) -> Column:
    """Overlap coefficient of two token sets; 0 if either is empty."""

    def overlap(x: Column) -> Column:
        least = F.least(F.size(x["a"]), F.size(x["b"]))
        return F.when(least > 0, F.size(F.array_intersect(x["a"], x["b"])) / least).otherwise(F.lit(0.0))

    return F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))), overlap)[0]


def choose(scored: DataFrame, *by: str, threshold: float = MATCH) -> DataFrame:
    """One candidate at the threshold wins; none is NOTFOUND, several are AMBIGUOUS."""
    good = F.col("score") >= threshold
    g = scored.groupBy(*by).agg(F.count_if(good).alias("matches"), F.min(F.when(good, F.col("candidate"))).alias("best"))
    return g.select(*by, F.when(F.col("matches") == 1, "MATCH").when(F.col("matches") == 0, "NOTFOUND").otherwise("AMBIGUOUS").alias("verdict"), F.when(F.col("matches") == 1, F.col("best")).alias("candidate"))


def public_review(rows: DataFrame) -> DataFrame:
    """The published columns of (id, author, rating, text, date)."""
    out = rows.select(F.col("id").cast("string").alias("review_id"), F.col("author").alias("author_name"), "rating", F.when(F.trim("text") != "", F.col("text")).alias("text"), "date")
    if set(out.columns) & set(FORBIDDEN):
        raise ValueError("a forbidden field in the payload")
    return out


def json_ld(author: Column, rating: Column, date: Column, precision: Column) -> Column:
    """schema.org review; the date only where it is known to the week."""
    shown = F.when(precision.isin("day", "week"), date)
    return F.to_json(F.struct(F.lit("Review").alias("@type"), F.struct(F.lit("Person").alias("@type"), author.alias("name")).alias("author"), F.struct(F.lit("Rating").alias("@type"), rating.alias("ratingValue")).alias("reviewRating"), shown.alias("datePublished")))


def state_counts(outcomes: DataFrame, *by: str) -> DataFrame:
    """How many targets ended in each state, also states that none had. ``runs.exit_codes`` tells a run's exit code."""
    return outcomes.groupBy(*by).agg(*(F.count_if(F.col("outcome") == s).alias(s) for s in OUTCOMES))


def first_strategy(*candidates: Column) -> tuple[Column, Column]:
    """(value, index) of the first that isn't blank; index -1 if none is."""
    clean = [F.when(F.trim(c) != "", c) for c in candidates]
    at = F.lit(-1)
    for i in reversed(range(len(clean))):
        at = F.when(clean[i].isNotNull(), i).otherwise(at)
    return F.coalesce(*clean), at


def missing_streaks(absences: DataFrame, *by: str, order: str) -> DataFrame:
    """streak: how many qualifying absences in a row end at each run; columns present and complete."""
    w = Window.partitionBy(*by).orderBy(order)
    groups = absences.withColumn("_g", F.sum(F.col("present").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*by, "_g").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return groups.withColumn("streak", F.when(F.col("present"), 0).otherwise(F.sum((~F.col("present") & F.col("complete")).cast("int")).over(inside)).cast("int")).drop("_g")
