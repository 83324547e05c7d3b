"""Review-shaped views of the star-schema and text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """listing, id, rating (0 and 6 are invalid), text, language, flag (nullable)."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("flag"))
    return table(spark, sf_dir, "documents").join(labels, "doc_id", "left").select(F.col("source").alias("listing"), F.col("doc_id").alias("id"), (F.col("n_chars") % 7).cast("int").alias("rating"), "text", F.col("lang").alias("language"), "flag", "n_chars")


def documents_by_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    """listing, id, author, rating, text: an author for each 64-character class of length."""
    authors = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("author"))
    d = table(spark, sf_dir, "documents").withColumn("k", (F.floor(F.col("n_chars") / 64) % 150 + 1).cast("long"))
    return d.join(authors, "k", "left").select(F.col("lang").alias("listing"), F.col("doc_id").alias("id"), "author", (F.col("n_chars") % 7).cast("int").alias("rating"), "text", "n_chars", F.col("source"))


def lineitem_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """listing, id, rating, date, first_seen, language, has_text of every line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("listing"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id"),
        (F.col("l_linenumber") % 5 + 1).cast("int").alias("rating"),
        F.when(F.col("l_returnflag") != "R", F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date"),
        F.date_format(F.add_months("l_shipdate", 1), "yyyy-MM").alias("first_seen"),
        F.col("l_linestatus").alias("language"),
        (F.col("l_discount") > 0.02).alias("has_text"),
    )
