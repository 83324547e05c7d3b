"""Steps whose results or work depended on how large their tables are."""

import math
from collections import Counter
from itertools import combinations
from random import Random

import pandas as pd
from pyspark.sql import functions as F

from reviewmill.functions import dates, language
from reviewmill.operators import duplicates, enrich, projection, runs
from reviewmill.plans import harvests


def test_places_of_a_table_larger_than_its_sample(spark):
    rows = spark.range(300_000, numPartitions=4).select(F.col("id").alias("target"), F.lit("premium").alias("tier"), (F.xxhash64("id") % 1000).alias("stale_hours"))
    placed = harvests._placed(runs.priority(rows), "target", "stale_hours")
    assert placed.agg(F.min("place"), F.max("place"), F.count_distinct("place")).first() == (0, 299_999, 300_000)
    before = placed.select((F.col("place") + 1).alias("place"), F.col("target").alias("t"), F.col("stale_hours").alias("s"))
    assert placed.join(before, "place").where("stale_hours > s OR stale_hours = s AND target < t").isEmpty()


def test_pairs_counts_and_clusters_over_many_blocks_and_copies(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "BLOCK", 300)
    random = Random(5)
    stems = [" ".join(random.choice(["ab", "cde", "fö", "ghij", "𝒳k", "l"]) for _ in range(n)) for n in (6, 9, 30, 31, 60, 120)]
    texts = [s + random.choice(["", "", "!", " x", " yz ab"]) for s in stems for _ in range(12)] + ["", "q", "Q", "ab " * 600]
    rows = [(i, f"a{i % 2}", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, author_key string, text string")
    grams = {}
    for r in df.select("id", "author_key", duplicates.fold(F.col("text")).alias("t")).collect():
        grams[r.id] = (r.author_key, r.t, Counter(r.t[k : k + 2] for k in range(len(r.t) - 1)))
    want, root = {}, {i: i for i in grams}
    for a, b in combinations(sorted(grams), 2):
        (ka, ta, x), (kb, tb, y) = grams[a], grams[b]
        whole = x.total() + y.total()
        dice = 1.0 if ta == tb else 2.0 * (x & y).total() / whole if whole else 0.0
        if ka == kb and dice >= duplicates.THRESHOLD:
            want[ka, a, b] = math.floor(dice * 10000 + 0.5) / 10000
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    got = duplicates.similarity_pairs(df).collect()
    assert len(got) == len(want) and {(r.author_key, r.left, r.right): r.similarity for r in got} == want
    assert {(r.author_key, r.pairs, r.stated_size) for r in duplicates.pair_counts(df).collect()} == {(k, n, n + 1) for k, n in Counter(k for k, _, _ in want).items()}
    sizes = Counter(root.values())
    assert sorted((r.root, r["size"]) for r in duplicates.text_clusters(df).collect()) == sorted((r, n) for r, n in sizes.items() if n > 1)


def test_blocks_send_out_as_many_pairs_as_connect_their_texts(spark):
    df = spark.range(60).select(F.col("id"), F.lit("a").alias("author_key"), F.concat(F.lit("the very same long text of a review, but for its end " * 3), F.col("id")).alias("text"))
    texts = duplicates._texts(duplicates._folded(df, "author_key"), duplicates.THRESHOLD)
    assert duplicates._compared(texts, duplicates.THRESHOLD, "pairs").count() == 60 * 59 // 2
    assert duplicates._compared(texts, duplicates.THRESHOLD, "forest").count() == 59


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_held_against_all_stopwords_once(spark):
    d = spark.createDataFrame([("The cat and the dog were here",)], "text string").select("text", language.words_of(F.col("text")).alias("ws"))
    found = d.select(language.detected(F.col("text"), F.col("ws")).alias("found")).select("found.*")
    assert tuple(found.first()) == ("en", 0.9)
    assert plan(found).count("filter(") <= 8 and "regexp_count" not in plan(found)


def test_a_phrase_is_folded_once(spark):
    d = spark.createDataFrame([("Vor 2 Monaten.", "de")], "p string, l string")
    found = d.select(dates.parsed(F.col("p"), F.col("l")).alias("said")).select("said.*")
    assert tuple(found.first()) == (2, "month")
    assert plan(found).count("translate(") == 1


def test_a_name_is_split_once(spark):
    d = spark.createDataFrame([("Red & Blue Widget Co. Ltd",)], "name string")
    score = d.select(projection.name_similarity(projection.name_tokens(F.col("name")), projection.name_tokens(F.lit("blue widget inc"))).alias("score"))
    assert score.first().score == 1.0
    assert plan(score).count("split(") <= 2


def test_functions_get_few_rows_at_once(spark):
    rows = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"))
    got = enrich.enriched(rows, {"size": lambda frame: pd.DataFrame({"sentiment_score": [float(len(frame))] * len(frame)})})
    assert got.agg(F.count("*"), F.count_distinct("doc_id"), F.max("ai.sentiment_score") <= enrich.ROWS).first() == (3000, 3000, True)
