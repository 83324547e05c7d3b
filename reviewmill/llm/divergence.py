"""How far the sources of a language differ in the terms they use.

Terms are exploded from what a regular expression finds and counted by language, source and
term. A language keeps the terms that stand in enough of its documents; crossed with its
groups (an equi-join on the language, dealt in parts) they give every group a smoothed
share of every kept term, zeros included, in integers of a billionth. A self-join on
language and term compares groups with each other; a window ranks them, and the terms
that a group uses more than its language does.

Defined results: null texts, languages and sources count as empty strings, and the empty
language and source are groups like others; every row is a document of its own, also
where ids repeat or are null; a group without terms has N = 0 and is compared too; a
language that keeps no term has distance 0 between its groups and no term rows; ties go
to the smaller item in UTF-8 order; an empty table gives no rows. Other columns are never
read. Numbers are exact at any size: shares are computed in decimals of 38 digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lower_ascii, staged

#: What stands between terms; a term is a longest run of anything else, as [^\x00-\x40\x5B-\x60\x7B-\x7F]+ matches it.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that a kept term stands in, at least.
DOCUMENTS = 30
#: Term rows of a group, at most.
TOP = 50
#: Added to each count, and the unit of the shares.
PRIOR, UNIT = 5, 1_000_000_000
#: Parts that the kept terms of one language are dealt to.
PARTS = 64


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n occurrences and n_docs documents; docs has lang, source and text without nulls.

    Each document sends its terms and, once more, its different terms: both counts come from one scan and
    are added up before they are shuffled.
    """
    # Splitting costs a tenth of regexp_extract_all; only before the first and after the last separator may an empty string be left.
    found = docs.select("lang", "source", F.array_remove(F.split(lower_ascii(F.col("text")), BETWEEN), "").alias("terms"))
    once = F.array(F.struct(F.col("terms").alias("terms"), F.lit(False).alias("once")), F.struct(F.array_distinct("terms").alias("terms"), F.lit(True).alias("once")))
    rows = found.select("lang", "source", F.explode(once).alias("s")).select("lang", "source", "s.once", F.explode("s.terms").alias("term"))
    return rows.groupBy("lang", "source", "term").agg(F.count_if(~F.col("once")).alias("n"), F.count_if("once").alias("n_docs"))


def share(count, total, kept):
    """1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * kept)), exactly."""
    wide = lambda c: c.cast("decimal(26,0)")
    return F.lit(1) + F.call_function("div", wide(count + PRIOR) * F.lit(UNIT).cast("decimal(10,0)"), wide(total) + wide(kept) * F.lit(PRIOR).cast("decimal(2,0)"))


def shares(docs: DataFrame, documents: int = DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n, p, q) of every group and kept term of its language, and the groups (lang, source)."""
    clean = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = staged(term_counts(clean), "term-counts")
    groups = staged(clean.select("lang", "source").distinct(), "groups")
    kept = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("d"), F.sum("n").alias("lang_n")).where(F.col("d") >= documents).drop("d")
    kept = staged(kept, "kept-terms")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    own = counts.select("lang", "source", "term", "n").join(kept.select("lang", "term"), ["lang", "term"], "left_semi")
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = groups.join(sizes, "lang").join(totals, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    part = F.pmod(F.xxhash64("term"), F.lit(PARTS))
    dealt = known.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    dense = kept.withColumn("part", part).join(dealt, ["lang", "part"]).join(own, ["lang", "source", "term"], "left")
    n = F.coalesce("n", F.lit(0))
    dense = dense.select("lang", "source", "term", n.alias("n"), share(n, F.col("total"), F.col("v")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))
    return staged(dense, "shares"), groups


def audit(docs: DataFrame, documents: int = DOCUMENTS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part ``pair`` ranks the other sources of a group's language by distance, part ``term`` the terms it uses more than the language."""
    dense, groups = shares(docs, documents)
    a, b = dense.select("lang", "term", "source", "p"), dense.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("item_p"))
    # Each pair is compared once and told to both sides.
    gaps = a.join(b, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(F.sum(F.abs(F.col("p") - F.col("item_p"))).alias("value"))
    gaps = gaps.union(gaps.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = groups.join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item").join(gaps, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = dense.where("n > 0 AND p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).cast("long").alias("value"))
    best = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)
