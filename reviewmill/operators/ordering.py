"""Publication order, latest reviews, pages, and the winner of rows with one identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEWEST = (F.desc_nulls_last, F.desc_nulls_last, F.asc)
OLDEST = (F.asc_nulls_first, F.asc_nulls_first, F.desc)


def _orders(oldest: bool) -> list[Column]:
    return [f(c) for f, c in zip(OLDEST if oldest else NEWEST, ("date", "first_seen", "id"), strict=True)]


def ranked(reviews: DataFrame, *by: str, oldest: bool = False) -> DataFrame:
    """position within the listing: date, first seen, id; oldest first is the exact reverse.

    A date's rows (without a date: those first seen at one time) are numbered by themselves, after the number of rows of
    all that come before, so that a busy listing is spread over its dates. The key is one struct, in which nulls
    are equal: rows are shuffled and sorted once, for the numbering and the join alike.
    """
    order = _orders(oldest)
    key = F.struct(*by, "date", F.when(F.col("date").isNull(), F.col("first_seen")).alias("first_seen"))
    listing = [F.col(f"_key.{c}") for c in by]
    earlier = Window.partitionBy(*listing).orderBy(*(f(F.col(f"_key.{c}")) for f, c in zip(OLDEST if oldest else NEWEST, ("date", "first_seen"), strict=False))).rowsBetween(Window.unboundedPreceding, -1)
    counts = reviews.select(key.alias("_key")).groupBy("_key").agg(F.count("*").alias("_n")).select("_key", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_key").orderBy(*order[1:]))
    placed = reviews.withColumn("_key", key).withColumn("_own", own).join(counts, "_key")
    return placed.withColumn("position", (F.col("_before") + F.col("_own")).cast("int")).drop("_key", "_own", "_before")


def latest(reviews: DataFrame, *by: str, k: int = 20) -> DataFrame:
    # Only the first k of each listing leave a task.
    return reviews.withColumn("position", F.row_number().over(Window.partitionBy(*by).orderBy(*_orders(False)))).where(F.col("position") <= k)


def page_number(position, size: int = 10):
    return F.ceil(position / size).cast("int")


def collapse_identities(rows: DataFrame, keys: list[str], fields: list[str], text: str, ordinal: str, content: str) -> DataFrame:
    """One row of each identity: most fields filled, longest text, lowest ordinal, content hash; copies says how many there were."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in fields), F.lit(0))
    order = [F.desc("_filled"), F.desc(F.length(F.coalesce(F.col(text), F.lit("")))), F.asc_nulls_last(ordinal), F.asc(content)]
    w = Window.partitionBy(*keys)
    return rows.withColumn("_filled", filled).withColumns({"_r": F.row_number().over(w.orderBy(*order)), "copies": F.count("*").over(w)}).where("_r = 1").drop("_r", "_filled")
