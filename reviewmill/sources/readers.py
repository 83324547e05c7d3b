"""CSV, JSON, HTML and JSONL readers."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .csv import read_rows

REQUIRED = ("author_name", "rating", "date")
OPTIONAL = ("text", "author_initials", "author_avatar_url", "author_profile_url", "source_url", "external_id", "language", "likes", "photo_count", "owner_reply_text", "owner_reply_date")
WORD_RATINGS = {"ONE": 1, "TWO": 2, "THREE": 3, "FOUR": 4, "FIVE": 5}
MAX_PLACE_REVIEWS, MAX_PAGES = 5, 40


def read_csv(spark: SparkSession, path: str, cap: int | None = None) -> DataFrame:
    """(path, line, columns as strings, reject_reason): rows of every file; a file without a required column has one row that says so. A file of no bytes has none, as Spark lists no such files."""
    names = [*REQUIRED, *OPTIONAL]
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    rows = read_rows(spark, path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path).select(F.col("_metadata.file_path").alias("path"))
    headers = rows.where("line = 1").select("path", F.transform("fields", lambda h: F.lower(strip(h))).alias("header"))
    headers = files.join(headers, "path", "left").withColumn("header", F.coalesce("header", F.array().cast("array<string>")))
    missing = F.element_at(F.filter(F.array(*map(F.lit, REQUIRED)), lambda c: ~F.array_contains(F.col("header"), c)), 1)
    headers = headers.withColumn("missing", F.when(F.size(F.array_except(F.array(*map(F.lit, REQUIRED)), "header")) > 0, missing))
    data = rows.where("line > 1" if cap is None else F.col("line").between(2, cap + 1)).join(headers.where("missing IS NULL").drop("missing"), "path")
    place = lambda c: F.array_size("header") - F.array_position(F.reverse("header"), c) + 1  # noqa: E731  the last of equal names
    values = [F.when(F.array_contains("header", c), F.nullif(strip(F.get("fields", (place(c) - 1).cast("int"))), F.lit(""))).alias(c) for c in names]
    found = data.select("path", F.col("line").cast("int").alias("line"), *values)
    reason = F.when(F.col("author_name").isNull(), "author_name").when(~F.coalesce(F.col("rating").rlike(r"\A0*[1-5]\z"), F.lit(False)), "rating").when(F.col("date").isNull(), "date")
    refused = headers.where("missing IS NOT NULL").select("path", F.lit(1).alias("line"), F.concat(F.lit("missing column "), "missing").alias("reject_reason"))
    return found.withColumn("reject_reason", reason).unionByName(refused, allowMissingColumns=True)


def csv_stop_reason(rows: Column, cap: Column) -> Column:
    return F.when(rows >= cap, "cap_reached").otherwise("target_reached")


def place_reviews(df: DataFrame, *by: str) -> DataFrame:
    """Reviews of place details (by..., result): the first five that have a rating or a text."""
    each = df.select(*by, F.col("result.rating").alias("advertised_rating"), F.col("result.user_ratings_total").alias("advertised_total"), F.posexplode("result.reviews").alias("pos", "r"))
    return each.where((F.col("pos") < MAX_PLACE_REVIEWS) & (F.col("r.rating").isNotNull() | F.col("r.text").isNotNull())).select(*by, "advertised_rating", "advertised_total", "pos", "r.author_name", "r.rating", "r.text", F.col("r.relative_time_description").alias("relative_date"), F.lit("cap_reached").alias("stop_reason"))


def paged_reviews(df: DataFrame, *by: str, page: str = "page") -> DataFrame:
    """Reviews of each listing's business-profile pages (by..., page, totalReviewCount, reviews), the first MAX_PAGES of them: words as ratings, and how many were seen after each page."""
    words = F.create_map(*[F.lit(v) for k, n in WORD_RATINGS.items() for v in (k, n)])
    # A listing has at most MAX_PAGES pages here.
    seen = F.sum(F.size("reviews")).over(Window.partitionBy(*by).orderBy(page).rowsBetween(Window.unboundedPreceding, 0))
    rows = df.where(F.col(page) < MAX_PAGES).withColumn("growth", seen)
    return rows.select(*by, page, F.col("totalReviewCount").alias("advertised_total"), "growth", F.posexplode("reviews").alias("pos", "r")).select(*by, page, "advertised_total", "growth", "pos", F.col("r.reviewer.displayName").alias("author_name"), words[F.col("r.starRating")].alias("rating"), F.col("r.comment").alias("text"), F.col("r.createTime").alias("date"))


def read_health(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, lines that can't be read) of a JSONL series."""
    rows = spark.read.text(path).select("value", F.from_json("value", schema + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    return rows.where("r._corrupt IS NULL").select("r.*").drop("_corrupt"), rows.where("r._corrupt IS NOT NULL").select("r._corrupt")


class _Blocks(HTMLParser):
    """Texts of the wanted elements; an end closes the nearest open element of its name, others are ignored."""

    def __init__(self, tags: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.tags, self.open, self.out, self.raw = tags, [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.raw += 1
        if tag in self.tags:
            self.open.append((tag, [], dict(reversed(attrs))))

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.raw = max(0, self.raw - 1)
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                for t, text, attrs in self.open[k:]:
                    self.out.append((t, " ".join("".join(text).split()), attrs.get("href"), attrs.get("class")))
                del self.open[k:]
                return

    def handle_data(self, data):
        if not self.raw:
            for _, text, _ in self.open:
                text.append(data)


def html_elements(pages: DataFrame, tags: tuple[str, ...], id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, ordinal, tag, text, href, class) of each wanted element of captured pages; no tree leaves the task."""
    kind, wanted = dict(pages.dtypes)[id_col], frozenset(tags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                p = _Blocks(wanted)
                p.feed(text or "")
                p.close()
                for t in p.open:
                    p.out.append((t[0], " ".join("".join(t[1]).split()), t[2].get("href"), t[2].get("class")))
                n = len(p.out)
                columns = [pa.array([c[i] for c in p.out], pa.string()) for i in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * n, key.type), pa.array(range(n), pa.int32()), *columns], names=["id", "ordinal", "tag", "text", "href", "class"])

    return pages.select(id_col, html_col).mapInArrow(run, f"id {kind}, ordinal int, tag string, text string, href string, class string")
