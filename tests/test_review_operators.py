"""Reference operators on micro-fixtures; parity with SQL is checked over the registered queries."""

import duckdb
import pytest
from pyspark.sql import functions as F

from reviewmill.functions import dates, identity, language, numbers, text, urls
from reviewmill.operators import duplicates, health, merge, ordering, rules, runs, schedule, stats
from reviewmill.plans import QUERIES, SQL
from reviewmill.plans.queries import PHRASES
from reviewmill.sources import extraction, readers
from reviewmill.streaming import ledger

SMALL = "/root/testdata/sf0.001"


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr.alias("r")).first().r


@pytest.mark.parametrize("phrase,locale,n,unit", PHRASES)
def test_phrases(spark, phrase, locale, n, unit):
    got = spark.createDataFrame([(phrase, locale)], "p string, l string").select(*dates.parse_phrase(F.col("p"), F.col("l"))).first()
    assert tuple(got) == (n, unit)


def test_phrases_in_table_order(spark):
    got = spark.createDataFrame([("vorgestern", "de")], "p string, l string").select(*dates.parse_phrase(F.col("p"), F.col("l"), compat=True)).first()
    assert tuple(got) == (1, "day")


def test_text(spark):
    c = F.col("v")
    assert one(spark, "a<!-- x --><b>c</b> 1 < 2 <i", text.strip_markup(c)) == "ac 1 < 2 "
    assert one(spark, " a  b \r\n\r\n\r\n c ", text.canonical_space(c)) == "a b\n\nc"
    assert one(spark, "Good … read more", text.strip_marker(c)) == "Good"
    assert one(spark, "&amp;lt;b&amp;gt;x &eacute; &#x41; &nope;", text.decode_entities(c)) == "<b>x é A &nope;"
    assert one(spark, "&lt;b&gt;x", text.decode_and_strip(c)) == "x"
    assert one(spark, "é", text.nfc(c)) == "é" and one(spark, "é", text.nfd(c)) == "é"
    assert one(spark, "a‍b 👨‍👩", text.strip_joiners(c)) == "ab 👨‍👩"
    assert one(spark, "か\u200dな 👨\u200d👩\u200d👧\u200d \u200d👨 ❤\ufe0f\u200d🔥", text.strip_joiners(c)) == "かな 👨\u200d👩\u200d👧 👨 ❤\ufe0f🔥"
    assert one(spark, "ada  lovelace", text.initials(c)) == "AL"
    assert one(spark, "éa🙂" * 10, text.bound(c, 4)) == "éa🙂é"
    assert one(spark, "  ", text.blank_to_null(c)) is None
    got = spark.createDataFrame([("nice place More",)], "v string").select(*text.extract_text(c, ["More", "Mehr"])).first()
    assert tuple(got) == ("nice place", True)


def test_numbers_and_urls(spark):
    c = F.col("v")
    assert one(spark, "about -3,5 stars", numbers.read_number(c)) == -3.5
    assert one(spark, -2.5, numbers.half_up(c, 0), "double") == -2.0 and one(spark, 1.005, numbers.half_up(c, 2), "double") == 1.0
    assert one(spark, "1.2.10", numbers.compare_versions(c, F.lit("1.2.9"))) == 1
    assert one(spark, "1.234 Rezensionen", numbers.read_count(c, F.lit("de"))) == 1234
    assert one(spark, "https://a.example.com/x", urls.is_valid(c, ("example.com",))) and not one(spark, "https://u@example.com/", urls.is_valid(c, ("example.com",)))
    got = spark.createDataFrame([("https://x/maps/0x1:0xffffffffffffffff",)], "v string").select(*urls.listing_id(c)).first()
    assert tuple(got) == ("cid", "18446744073709551615")


def test_language(spark):
    rows = [("The food was very good and they have it", "en"), ("これはとても良いです、また来ます", "ja"), ("short", None), ("Das Essen ist sehr gut und nicht teuer", "de")]
    df = spark.createDataFrame(rows, "t string, want string").withColumn("ws", language.words_of(F.col("t")))
    assert all(r.want == r.got for r in df.select("want", language.detect(F.col("t"), F.col("ws"))[0].alias("got")).collect())


def test_identity(spark):
    df = spark.createDataFrame([("Ann", "l", "x"), ("ann.", "l", "y"), (None, "l", "x"), (None, "l", "y")], "a string, l string, t string")
    keys = [r.k for r in df.select(identity.author_key(F.col("a"), F.col("l"), F.col("t")).alias("k")).collect()]
    assert keys[0] == keys[1] and len({*keys}) == 3 and all(len(k) == 32 for k in keys)


def test_merge_never_removes_on_an_incomplete_harvest(spark):
    cols = "listing string, id string, content_hash string, state string, first_seen_at string, last_seen_at string, last_updated_at string, revision int, missing_streak int, tombstoned_at string, history array<string>"
    prior = spark.createDataFrame([("a", "1", "h", "active", "t0", "t0", "t0", 1, 0, None, []), ("a", "2", "h", "unconfirmed", "t0", "t0", "t0", 1, 2, None, []), ("b", "3", "h", "active", "t0", "t0", "t0", 1, 0, None, []), ("c", "4", "h", "active", "t0", "t0", "t0", 1, 0, None, [])], cols)
    seen = spark.createDataFrame([("a", "1", "h2"), ("a", "9", "n"), ("a", "8", "d")], "listing string, id string, content_hash string")
    runs = spark.createDataFrame([("a", "t1", "full", None), ("b", "t1", "partial", None)], "listing string, now string, completeness string, last_full_harvest_at string")
    out = {r.id: r for r in merge.reconcile(prior, seen, runs, spark.createDataFrame([("8",)], "id string")).collect()}
    assert {k: r.outcome for k, r in out.items()} == {"1": "UPDATED", "2": "TOMBSTONED", "3": "HELD", "4": None, "9": "INSERTED"}
    assert out["1"].history == ["h"] and out["1"].revision == 2 and out["2"].tombstoned_at == "t1" and out["4"].state == "active"


def test_streamed_ledger_equals_batches(spark, tmp_path):
    rows = [[("a", "t1", "full", "1", "h"), ("a", "t1", "full", "2", "h")], [("a", "t2", "full", "1", "x")], [("a", "t3", "partial", None, None)]]
    source = tmp_path / "in"
    for i, r in enumerate(rows):
        spark.createDataFrame(r, "listing string, now string, completeness string, id string, content_hash string").coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("listing string, now string, completeness string, id string, content_hash string").parquet(str(source))
        ledger.merge_stream(stream, str(tmp_path / "ledger"), str(tmp_path / "check"), spark.createDataFrame([], "id string")).awaitTermination()
    out = {r.id: (r.state, r.revision, r.missing_streak) for r in ledger.current(spark, str(tmp_path / "ledger")).collect()}
    assert out == {"1": ("active", 2, 0), "2": ("unconfirmed", 1, 1)}


def test_streamed_harvests_in_order_and_replayed(spark, tmp_path):
    """Two harvests in one batch count twice; one that comes again at the same instant in a later batch counts nothing."""
    schema = "listing string, now string, completeness string, id string, content_hash string"
    batches = [
        [("a", "t1", "full", "1", "h"), ("a", "t1", "full", "2", "h")],
        [("a", "t2", "full", "1", "h"), ("a", "t3", "partial", "1", "x"), ("a", "t4", "full", "1", "x")],
        [("a", "t4", "full", "1", "x")],
        [("a", "t5", "full", "1", "x"), ("b", "t5", "full", None, None)],
    ]
    source, seen = tmp_path / "in", []
    for r in batches:
        spark.createDataFrame(r, schema).coalesce(1).write.mode("append").parquet(str(source))
        ledger.merge_stream(spark.readStream.schema(schema).parquet(str(source)), str(tmp_path / "ledger"), str(tmp_path / "check"), spark.createDataFrame([], "id string")).awaitTermination()
        seen.append({x.id: (x.state, x.revision, x.missing_streak) for x in ledger.current(spark, str(tmp_path / "ledger")).collect()})
    assert [x["2"] for x in seen] == [("active", 1, 0), ("unconfirmed", 1, 2), ("unconfirmed", 1, 2), ("tombstoned", 1, 3)]
    assert [x["1"] for x in seen] == [("active", 1, 0), ("active", 2, 0), ("active", 2, 0), ("active", 2, 0)]
    assert {(x.listing, x.updated_at, x.last_full_harvest_at) for x in ledger.harvests(spark, str(tmp_path / "ledger")).collect()} == {("a", "t5", "t5"), ("b", "t5", "t5")}


def test_health_series_is_appended(spark, tmp_path):
    own = spark.createDataFrame([("r1", "t1", "c", "l", "succeeded", 5), ("r2", "t2", "", "l", "who", None)], "run_id string, recorded_at string, client_slug string, listing_key string, outcome string, observed_count long")
    for _ in range(2):
        bad = runs.append_health(runs.health_records(own), str(tmp_path / "health")).collect()
    assert [(x.run_id, x.problems) for x in bad] == [("r2", ["client_slug is missing", 'outcome "who" is not one of succeeded, failed, blocked, deferred, skipped'])]
    lines = [x.value for x in spark.read.text(str(tmp_path / "health")).collect()]
    assert len(lines) == 2 and '"coverage":null' in lines[0]
    (tmp_path / "health" / "broken.json").write_text("{not json\n")
    good, broken = readers.read_health(spark, str(tmp_path / "health"), "run_id string, observed_count long, coverage double")
    assert [(x.run_id, x.observed_count, x.coverage) for x in good.collect()] == [("r1", 5, None)] * 2 and broken.count() == 1


def test_state_is_replaced_by_key(spark, tmp_path):
    state = lambda *rows: spark.createDataFrame(list(rows), "n int, source string")
    runs.save_state(state((1, "a"), (2, "b")), str(tmp_path / "s"), "source")
    runs.save_state(state((3, "b")), str(tmp_path / "s"), "source")
    assert {(x.source, x.n) for x in spark.read.parquet(str(tmp_path / "s")).collect()} == {("a", 1), ("b", 3)}
    with pytest.raises(ValueError):
        runs.save_state(state((3, "../b")), str(tmp_path / "s"), "source")


def test_extraction_reads_what_the_pack_says(spark):
    html = """<body><div id=s><div class="r x"><b class=n>Ann</b><i data-stars="4,0">x</i><p class=t>One<br>two<script>no</script></p><div class=o><p class=t>Thanks</p></div></div>
      <div class=r><b class=n>Bob</b><i data-stars="9">x</i></div><div class=r><i data-stars="5">x</i><p class=t>No name</p></div></div></div></body>"""
    ways = lambda *w: {"strategies": [dict(zip(("selector", "attribute"), x, strict=False)) for x in w]}
    pack = extraction.read_pack({
        "containers": {"surface": ways(("#none",), ("div[id^=s]",)), "review_node": ways(("b > .r",), ("div > .r",)), "reply_node": ways((".o",))},
        "fields": {"rating": ways(("i[data-stars]", "data-stars")), "author_name": ways(("b.n",)), "text": ways(("p.t",)), "reply_text": ways(("p.t",))},
    })
    pages = spark.createDataFrame([(1, html), (2, "<div id=s></div>"), (3, None)], "page_id long, html string")
    rows = extraction.extracted(extraction.located(pages, pack), F.lit("en")).orderBy("page_id", "ordinal").collect()
    got = [(x.page_id, x.ordinal, x.rating, x.author_name, x.text, x.reply_text, x.quarantine and tuple(x.quarantine)) for x in rows]
    assert got == [
        (1, 0, 4, "Ann", "One two", "Thanks", None), (1, 1, None, "Bob", None, None, ("ERR-PARSE-RATING-INVALID", "rating")), (1, 2, 5, None, "No name", None, ("ERR-PARSE-FIELD-REQUIRED", "author_name")),
        (2, None, None, None, None, None, ("ERR-PARSE-EMPTY-UNEXPECTED", None)), (3, None, None, None, None, None, ("ERR-PARSE-STRUCTURE", None)),
    ]
    calm = extraction.extracted(extraction.located(pages, pack), F.lit("en"), emptied=F.col("page_id") == 2)
    assert {x.page_id for x in calm.collect()} == {1, 3}


def test_versions_and_secrets(spark):
    c = F.col("v")
    assert one(spark, "1.2.3.4", numbers.compare_versions(c, F.lit("1.2.3.5"))) == -1 and one(spark, "1.2", numbers.compare_versions(c, F.lit("1.2.0.0"))) == 0 and one(spark, "10", numbers.compare_versions(c, F.lit("9.9.9"))) == 1
    fields = spark.createDataFrame([({"note": "has abcdefgh and abcdef", "abcdef": "1", "short": "xyz", "url": "https://a.b/c?token=1", "Cookie": "z"},)], "m map<string,string>")
    got = fields.select(runs.redacted(F.col("m"), {"long": "abcdefgh", "part": "abcdef", "tiny": "xyz"}).alias("r")).first().r
    assert got == {"note": "has «redacted:long» and «redacted:part»", "«redacted:part»": "1", "short": "«redacted:tiny»", "url": "https://a.b/c"}
    with pytest.raises(ValueError):
        runs.enriched(fields, {"rating": F.lit(1)})


def test_gate_limits_pass_at_the_limit(spark):
    base = {"count": 80, "mean": 4.0, "prior_count": 100, "prior_mean": 4.0, "prior_readable": True, "completeness": "full", "schema_errors": 0, "quarantine_rate": 0.05, "fatal_findings": 0, "coverage": 0.95, "advertised_mean": 4.0, "bytes": 1, "largest_cluster": 3, "advertised": 100, "prior_advertised": 100, "force": False}
    rows = [base, base | {"count": 79}, base | {"count": 79, "force": True}, base | {"prior_readable": False}, base | {"coverage": 0.9}, base | {"coverage": 0.9, "completeness": "full_capped"}]
    df = spark.createDataFrame([tuple(float(v) if isinstance(v, int) and not isinstance(v, bool) else v for v in r.values()) for r in rows], list(base))
    got = [(r.decision, [x.code for x in r.reasons]) for r in rules.gate(df).collect()]
    assert got == [("ACCEPT", []), ("REJECT", ["G-03"]), ("ACCEPT_WITH_WARNINGS", ["G-03"]), ("REJECT", ["G-00"]), ("ACCEPT_WITH_WARNINGS", ["G-08"]), ("ACCEPT", [])]


def test_budget_is_the_sequential_rule(spark):
    import random

    r = random.Random(1)
    rows = sorted((f"2024-01-0{r.randint(1, 2)} {r.randint(0, 5):02d}:{r.randint(0, 59):02d}:00", i) for i in range(120))
    df = spark.createDataFrame(rows, "ts string, id long").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("k", F.lit("x"))
    got = {x.id: x.granted for x in schedule.budget_grants(df, "k", per_hour=3, per_day=8).collect()}
    hours, days = {}, {}
    for ts, i in rows:
        ok = hours.get(ts[:13], 0) < 3 and days.get(ts[:10], 0) < 8
        hours[ts[:13]], days[ts[:10]] = hours.get(ts[:13], 0) + ok, days.get(ts[:10], 0) + ok
        assert got[i] == ok


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿Author_Name,rating,DATE,text\r\nAnn,5,2024-01-01,"a ""b"", c"\n\nBob,9,2024-01-02,x\n,4,2024-01-02,y', newline="")
    (tmp_path / "b.csv").write_text("author_name,rating\nAnn,5\n")
    got = sorted((r.line, r.author_name, r.text, r.reject_reason) for r in readers.read_csv(spark, str(tmp_path)).collect())
    assert got == [(1, None, None, "missing column date"), (2, "Ann", 'a "b", c', None), (3, "Bob", "x", "rating"), (4, None, "y", "author_name")]


def test_schedule_and_order(spark):
    assert schedule.shards([("a", 5), ("b", 4), ("c", 3), ("d", 3)], 2) == [("a", 0), ("b", 1), ("c", 1), ("d", 0)]
    hashes = spark.createDataFrame([("",), ("a",), ("😀é",)], "t string").select(schedule.fnv1a(F.col("t")).alias("h")).collect()
    units, smile = "😀é".encode("utf-16-le"), 0x811C9DC5
    for k in range(0, len(units), 2):
        smile = ((smile ^ int.from_bytes(units[k : k + 2], "little")) * 0x01000193) % 2**32
    assert [x.h for x in hashes] == [0x811C9DC5, 0xE40C292C, smile]
    rows = spark.createDataFrame([("1", None, None), ("2", "2024", "a"), ("3", "2024", None)], "id string, date string, first_seen string").withColumn("l", F.lit(1))
    assert [r.id for r in ordering.ranked(rows, "l").orderBy("position").collect()] == ["2", "3", "1"]
    assert [r.id for r in ordering.ranked(rows, "l", oldest=True).orderBy("position").collect()] == ["1", "3", "2"]


def test_order_of_rows_without_listing_or_date(spark):
    days, seen = [None, "2024-01-01", "2024-02-01"], [None, "a", "b"]
    data = [(l, f"{i}{d}{f}", d, f) for l in (None, "x") for i in range(3) for d in days for f in seen] + [("x", "same", None, "a")] * 2
    rows = spark.createDataFrame(data, "l string, id string, date string, first_seen string")
    for oldest in (False, True):
        got = [(r.l, r.id) for r in ordering.ranked(rows, "l", oldest=oldest).orderBy("l", "position").collect()]
        want = []
        for l in (None, "x"):
            own = sorted([r for r in data if r[0] == l], key=lambda r: r[1])
            own.sort(key=lambda r: (r[2] or "", r[3] or ""), reverse=True)  # newest first, nulls last, ties by id
            want += [(l, r[1]) for r in (own[::-1] if oldest else own)]
        assert got == want
        assert sorted(r.position for r in ordering.ranked(rows, "l", oldest=oldest).where("l = 'x'").collect()) == list(range(1, 30))


def test_near_duplicates(spark):
    df = spark.createDataFrame([(1, "k", "the same text here"), (2, "k", "The same text, here!"), (3, "k", "another"), (4, "k", ""), (5, "k", " "), (6, "j", "the same text here")], "id long, author_key string, text string")
    got = sorted(map(tuple, duplicates.similarity_pairs(df).select("left", "right", "similarity").collect()))
    assert got == [(1, 2, 1.0), (4, 5, 1.0)]


def test_health_deliveries(spark):
    now, opened = spark.createDataFrame([("a",), ("b",)], "fingerprint string"), spark.createDataFrame([("b", 7), ("b", 3), ("c", 9)], "fingerprint string, issue int")
    got = {r.fingerprint: (r.action, r.issue) for r in health.deliveries(now, opened).collect()}
    assert got == {"a": ("open", None), "b": ("comment", 3), "c": ("close", 9)}
    assert stats.coverage and set(SQL) <= set(QUERIES)


def norm(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted((tuple(norm(r[c]) for c in names) for r in df.collect()), key=repr) == sorted((tuple(map(norm, r)) for r in want.fetchall()), key=repr)


def test_clusters_settle_or_fail(spark):
    pairs = spark.createDataFrame([("a", k, k + 1) for k in range(1, 12)], "author_key string, left long, right long")
    assert [tuple(r) for r in duplicates.cluster_sizes(pairs).collect()] == [("a", 1, 12)]
    with pytest.raises(RuntimeError, match="settle"):
        duplicates.cluster_sizes(pairs, rounds=1)
