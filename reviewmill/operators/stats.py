"""Statistics of published reviews and of harvests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import half_up, valid_rating


def listing_stats(reviews: DataFrame, *by: str) -> DataFrame:
    """Counts, mean of the rated rows (0 if none), oldest and newest date as strings, all five rating counts."""
    ok = valid_rating(F.col("rating"))
    return reviews.groupBy(*by).agg(
        F.count("*").alias("total_count"),
        F.coalesce(half_up(F.avg(F.when(ok, F.col("rating").cast("double"))), 2), F.lit(0.0)).alias("mean_rating"),
        *(F.count_if(F.col("rating") == k).alias(f"rating_{k}") for k in range(1, 6)),
        F.count_if("has_text").alias("with_text_count"),
        F.max("date").alias("newest_review_date"), F.min("date").alias("oldest_review_date"),
    )


def language_counts(reviews: DataFrame, *by: str) -> DataFrame:
    """Counts by language, sorted, as one text; null and empty languages are left out."""
    each = reviews.where("language IS NOT NULL AND language <> ''").groupBy(*by, "language").agg(F.count("*").alias("n"))
    return each.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "language", F.col("n").cast("string")))), ",").alias("languages"))


def coverage(total: Column, advertised: Column) -> tuple[Column, Column]:
    """(payload: 4 places, may exceed 1; harvest: at most 1, unrounded); null where nothing is advertised."""
    ratio = F.when(advertised > 0, total / advertised)
    return half_up(ratio, 4), F.when(ratio.isNotNull(), F.least(F.lit(1.0), ratio))


def mean_both(reviews: DataFrame, *by: str) -> DataFrame:
    """The payload's mean over rated rows, and the harvest's over all rows, where an invalid rating adds nothing."""
    ok, x = valid_rating(F.col("rating")), F.col("rating").cast("double")
    return reviews.groupBy(*by).agg(F.coalesce(half_up(F.avg(F.when(ok, x)), 2), F.lit(0.0)).alias("payload_mean"), F.coalesce(half_up(F.sum(F.when(ok, x).otherwise(0.0)) / F.count("*"), 2), F.lit(0.0)).alias("harvest_mean"))


def exact_duplicates(reviews: DataFrame, *key: str) -> DataFrame:
    return reviews.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")


def quarantine_rate(accepted: Column, quarantined: Column) -> Column:
    return F.when(accepted + quarantined > 0, quarantined / (accepted + quarantined)).otherwise(F.lit(0.0))
