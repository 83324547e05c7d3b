"""Breaker, budgets and the ledger as streams."""

import random
import time

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import schedule
from reviewmill.streaming import breaker, budget, ledger

MINUTE = 60_000


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    breaker.state_store(spark)
    yield spark
    spark.conf.set(key, before)


def play(b, events):
    seen = []
    for at, event in events:
        if event == "request":
            b, ok = b.admit(at)
            seen.append((ok, b.state))
        else:
            b = b.result(at, event == "ok")
            seen.append((None, b.state))
    return b, seen


def test_breaker_rules():
    b, seen = play(breaker.Breaker(), [(0, "failed")] * 4 + [(0, "ok")] + [(0, "failed")] * 5)
    assert [s for _, s in seen] == ["closed"] * 9 + ["open"] and (b.failures, b.trips, b.retry_at) == (0, 1, 15 * MINUTE)
    b, seen = play(b, [(15 * MINUTE - 1, "request"), (15 * MINUTE, "request"), (15 * MINUTE, "request"), (16 * MINUTE, "failed")])
    assert seen == [(False, "open"), (True, "half_open"), (False, "half_open"), (None, "open")] and (b.trips, b.retry_at) == (2, 46 * MINUTE)
    b, seen = play(b, [(46 * MINUTE, "request"), (47 * MINUTE, "ok")])
    # A success closes it, but what has tripped is not forgotten: the third cooldown is four times the first.
    assert b == breaker.Breaker(trips=2)
    b, _ = play(b, [(50 * MINUTE, "failed")] * 5)
    assert (b.state, b.trips, b.retry_at) == ("open", 3, 110 * MINUTE)
    assert [breaker.cooldown(n) // MINUTE for n in (1, 2, 3, 4, 5, 6, 20)] == [15, 30, 60, 120, 240, 360, 360]


def run_batches(spark, tmp_path, batches, schema, build):
    """Each batch of rows as one micro-batch of the same stream, which is started anew for each; the output rows of each."""
    source, out = tmp_path / "in", []
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = build(spark.readStream.schema(schema).parquet(str(source)))
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination(120)
        seen = spark.read.parquet(str(tmp_path / "out")).collect()
        out.append([r for r in seen if r not in sum(out, [])])
    return out


def test_streamed_breaker(rocks, tmp_path):
    now = int(time.time() * 1000)
    long_ago, soon = now - 20 * MINUTE, now - MINUTE
    batches = [
        [("a", long_ago, "failed")] * 5 + [("b", soon, "failed")] * 5 + [("c", soon, "failed")] * 4 + [("c", soon, "ok")],
        [("other", soon, "request")],
        [("a", now, "request"), ("a", now + 1, "request"), ("b", now, "request"), ("c", now, "failed")],
        [("a", now + 2, "failed"), ("a", now + 16 * MINUTE, "request")],
    ]
    schema, source, got = "key string, at_ms long, event string", tmp_path / "in", []
    source.mkdir()
    # Timers make a batch due even without data, so the query runs until it is stopped.
    query = breaker.breaker(rocks.readStream.schema(schema).parquet(str(source))).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="100 milliseconds").start(str(tmp_path / "out"))
    try:
        for k, rows in enumerate(batches):
            rocks.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
            want, end = sum(map(len, batches[: k + 1])), time.time() + 60
            while True:
                assert time.time() < end and query.exception() is None
                done = [p for p in query.recentProgress]
                full = [p["batchId"] for p in done if p["numInputRows"]]
                if sum(p["numInputRows"] for p in done) >= want and done[-1]["batchId"] > max(full):
                    break
                time.sleep(0.2)
            got.append([(r.key, r.at_ms, r.event, r.admitted, r.state, r.trips) for r in rocks.read.parquet(str(tmp_path / "out")).orderBy("at_ms").collect()])
    finally:
        query.stop()
    of = lambda k, key: [r[2:] for r in got[k] if r[0] == key]
    # Nothing of a came after its fifth failure: the timer alone moved it. b's cooldown has not ended.
    assert ("timer", None, "half_open", 1) in of(1, "a") and not [r for r in of(3, "b") if r[0] == "timer"]
    assert of(2, "a")[-2:] == [("request", True, "half_open", 1), ("request", False, "half_open", 1)] and of(2, "b")[-1] == ("request", False, "open", 1)
    assert of(3, "a")[-2:] == [("failed", None, "open", 2), ("request", False, "open", 2)] and of(3, "c")[-1] == ("failed", None, "closed", 0)


def test_streamed_budget_equals_the_batch(rocks, tmp_path):
    r = random.Random(3)
    rows = sorted((f"2024-01-0{r.randint(1, 3)} {r.randint(0, 5):02d}:{r.randint(0, 59):02d}:{r.randint(0, 59):02d}", r.choice("xy"), i) for i in range(240))
    schema = "ts string, key string, id long"
    build = lambda s: budget.enforced(s.withColumn("ts", F.col("ts").cast("timestamp")), per_hour=3, per_day=8, late="1 hour")
    got = {x.id: x.granted for rows in run_batches(rocks, tmp_path, [rows[:100], rows[100:170], rows[170:]], schema, build) for x in rows}
    df = rocks.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp"))
    want = {x.id: x.granted for x in schedule.budget_grants(df, "key", per_hour=3, per_day=8).collect()}
    assert len(want) == 240 and got == want and 0 < sum(want.values()) < 240


HARVEST = "listing string, now string, completeness string, id string, content_hash string"


def files(folder, name):
    return {str(p.relative_to(folder)): p.stat().st_size for p in (folder / name).rglob("*.parquet")}


def apply(spark, folder, rows, source, number, buckets=16):
    return ledger.apply(spark.createDataFrame(rows, HARVEST), str(folder), source, number, spark.createDataFrame([], "id string"), buckets)


def test_what_a_batch_writes_follows_its_harvest(spark, tmp_path):
    whole = [(f"l{k}", "t1", "full", str(i), f"h{i}") for k in range(60) for i in range(20)]
    assert apply(spark, tmp_path, whole, "s", 0) == 1
    first = files(tmp_path, "reviews")
    assert apply(spark, tmp_path, [("l7", "t2", "full", "1", "new"), ("l7", "t2", "full", "2", "h2")], "s", 1) == 2
    after = files(tmp_path, "reviews")
    new = {p: n for p, n in after.items() if "version=2" in p}
    assert len({p.split("/")[2] for p in new}) == 1 and sum(new.values()) < sum(first.values()) / 6
    rows = {(r.listing, r.id): (r.state, r.revision) for r in ledger.current(spark, str(tmp_path)).collect()}
    assert len(rows) == 1200 and rows["l7", "1"] == ("active", 2) and rows["l7", "2"] == ("active", 1) and rows["l7", "3"] == ("unconfirmed", 1) and rows["l8", "3"] == ("active", 1)
    # The same batch again does nothing; one of another stream that has the same number does.
    assert apply(spark, tmp_path, [("l7", "t3", "full", None, None)], "s", 1) is None
    assert apply(spark, tmp_path, [("l7", "t3", "full", None, None)], "other", 0) == 3
    assert apply(spark, tmp_path, [("l7", "t4", "full", None, None)], "s", 1) is None
    assert {r.missing_streak for r in ledger.current(spark, str(tmp_path)).where("listing = 'l7' AND id = '3'").collect()} == {2}
    # Of a bucket that was written three times, what no kept manifest names has gone.
    bucket = next(iter(new)).split("/")[2]
    assert sorted({p.split("/")[1] for p in files(tmp_path, "reviews") if f"/{bucket}/" in p}) == ["version=2", "version=3"]
    assert sorted(p.name for p in (tmp_path / "manifest").iterdir() if p.is_dir()) == ["version=2", "version=3"]


def test_increments_equal_whole_merges(spark, tmp_path):
    r = random.Random(4)
    batches = [[(f"l{r.randrange(12)}", f"t{b}{r.randrange(2)}", r.choice(["full", "full", "partial"]), str(r.randrange(6)), r.choice("xy")) for _ in range(25)] for b in range(4)]
    for folder, buckets in (("one", 1), ("many", 7)):
        for k, rows in enumerate(batches):
            apply(spark, tmp_path / folder, rows, "s", k, buckets)
    got = [sorted(map(str, ledger.current(spark, str(tmp_path / f)).collect())) for f in ("one", "many")]
    assert got[0] == got[1] and len(got[0]) > 20
    times = [sorted(map(str, ledger.harvests(spark, str(tmp_path / f)).collect())) for f in ("one", "many")]
    assert times[0] == times[1]


def test_the_worst_claim_counts(spark, tmp_path):
    apply(spark, tmp_path, [("a", "t1", "full", "1", "h"), ("a", "t1", "full", "2", "h")], "s", 0)
    apply(spark, tmp_path, [("a", "t2", "full", "1", "h"), ("a", "t2", "failed", "1", "h")], "s", 1)
    assert {x.id: x.missing_streak for x in ledger.current(spark, str(tmp_path)).collect()} == {"1": 0, "2": 0}


def test_a_crash_leaves_the_last_manifest_in_force(spark, tmp_path, monkeypatch):
    apply(spark, tmp_path, [("a", "t1", "full", "1", "h"), ("a", "t1", "full", "2", "h")], "s", 0)
    before = sorted(map(str, ledger.current(spark, str(tmp_path)).collect()))
    with monkeypatch.context() as m:
        m.setattr(ledger, "MANIFEST", "no schema")
        with pytest.raises(Exception):
            apply(spark, tmp_path, [("a", "t2", "full", "1", "new")], "s", 1)
    assert sorted(map(str, ledger.current(spark, str(tmp_path)).collect())) == before
    assert apply(spark, tmp_path, [("a", "t2", "full", "1", "new")], "s", 1) == 2
    assert {x.id: (x.revision, x.missing_streak) for x in ledger.current(spark, str(tmp_path)).collect()} == {"1": (2, 0), "2": (1, 1)}


def test_three_outcomes_of_reading(spark, tmp_path):
    assert ledger.read_ledger(spark, str(tmp_path / "none"))[0] == "absent"
    apply(spark, tmp_path / "x", [(f"l{k}", "t1", "full", "1", "h") for k in range(30)], "s", 0)
    outcome, rows, _ = ledger.read_ledger(spark, str(tmp_path / "x"))
    assert outcome == "found" and rows.count() == 30
    part = next((tmp_path / "x" / "reviews").rglob("part-*.parquet"))
    sound = part.read_bytes()
    part.write_bytes(sound[: len(sound) // 2])
    part.with_name("." + part.name + ".crc").unlink(missing_ok=True)
    outcome, rows, why = ledger.read_ledger(spark, str(tmp_path / "x"))
    assert (outcome, rows) == ("unreadable", None) and why
    with pytest.raises(ledger.LedgerUnreadable):
        apply(spark, tmp_path / "x", [(f"l{k}", "t2", "full", "1", "h") for k in range(30)], "s", 1)
    part.write_bytes(sound)
    assert ledger.read_ledger(spark, str(tmp_path / "x"))[0] == "found"
    # Other columns are no ledger either.
    spark.createDataFrame([("a", 1)], "listing string, revision long").write.mode("overwrite").parquet(str(part.parent))
    assert ledger.read_ledger(spark, str(tmp_path / "x"))[0] == "unreadable"


def test_dates_are_pinned_and_texts_follow(spark):
    from reviewmill.operators import merge

    ledger_rows = spark.createDataFrame([("l", "1", "h", "active", "t0", "t0", "t0", 1, 0, None, [], "2024-01-01", "old"), ("l", "2", "h", "tombstoned", "t0", "t0", "t0", 1, 3, "t0", [], None, "old")], ledger.LEDGER + ", day string, text string")
    seen = spark.createDataFrame([("l", "1", "new", "2024-02-02", "now"), ("l", "2", "new", "2024-02-02", "now"), ("l", "3", "h", None, "now")], "listing string, id string, content_hash string, day string, text string")
    harvest = spark.createDataFrame([("l", "t1", "full", None)], "listing string, now string, completeness string, last_full_harvest_at string")
    got = {r.id: (r.outcome, r.day, r.text) for r in merge.reconcile(ledger_rows, seen, harvest, spark.createDataFrame([], "id string"), carried=("text",), pinned=("day",)).collect()}
    assert got == {"1": ("UPDATED", "2024-01-01", "now"), "2": ("IGNORED_TERMINAL", None, "old"), "3": ("INSERTED", None, "now")}
