"""The data source of captured files, checks before a run, alerts by error class."""

import json
import time

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import health, runs
from reviewmill.sources import port


def place(*reviews, **more):
    return json.dumps({"result": {"reviews": [dict(zip(("author_name", "rating", "text", "relative_time_description"), r, strict=False)) for r in reviews], **more}})


def test_adapters_have_one_schema(spark, tmp_path):
    port.register(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join([place(("Ann", 5, "good", "a week ago"), ("Bo", None, None), *[("x", 1, None)] * 6, rating=4.5, user_ratings_total=8), "{broken", place()]))
    (folder / "_hidden").write_text("x")
    read = lambda adapter, where=folder, **o: sorted(map(tuple, spark.read.format("review_files").option("path", str(where)).option("adapter", adapter).options(**o).load().drop("file").collect()), key=str)
    rows = read("places")
    assert (0, 0, "Ann", "5", "good", "a week ago", None, 8, 4.5, "cap_reached") in rows and len(rows) == 6
    assert [r for r in rows if r[-1] == "error"] == [(1, *[None] * 8, "error")] and (2, *[None] * 8, "cap_reached") in rows
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "1.json").write_text(json.dumps({"reviews": [{"reviewer": {"displayName": "Cy"}, "starRating": "FOUR", "comment": "c", "createTime": "2024"}, {"starRating": "SIX"}], "totalReviewCount": 2, "nextPageToken": "t"}))
    assert read("profile", tmp_path / "p") == [(0, 0, "Cy", "4", "c", None, "2024", 2, None, "budget_exceeded"), (0, 1, *[None] * 5, 2, None, "budget_exceeded")]
    (tmp_path / "h").mkdir()
    ways = lambda s, a=None: {"strategies": [{"selector": s, "attribute": a} if a else {"selector": s}]}
    pack = {"containers": {"surface": ways("main"), "review_node": ways("main > .r")}, "fields": {"rating": ways("i", "data-n"), "text": ways("p"), "author_name": ways("b")}}
    (tmp_path / "h" / "1.html").write_text("<main><div class=r><b>Di</b><i data-n=3></i><p>fine\nindeed</p></div></main>")
    (tmp_path / "h" / "2.html").write_text("<p>nothing")
    assert read("pages", tmp_path / "h", pack=json.dumps(pack)) == [(0, 0, "Di", "3", "fine indeed", None, None, None, None, "target_reached"), (0, *[None] * 8, "error")]
    assert read("places", tmp_path / "none") == []
    with pytest.raises(Exception, match="ERR-CONFIG-INVALID"):
        read("nope")


def test_stream_takes_each_file_once(spark, tmp_path):
    port.register(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(3):
        (folder / f"{k}.jsonl").write_text(place((f"a{k}", 5, "t")))
        time.sleep(0.02)
        stream = spark.readStream.format("review_files").option("path", str(folder)).option("adapter", "places").load().select("author_name")
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).start(str(tmp_path / "out"))
        query.processAllAvailable()
        query.stop()
        assert sorted(r.author_name for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [f"a{i}" for i in range(k + 1)]


def test_checks_before_a_run(spark):
    signed = ("Ann", "2024-01-01", "owner", "ref", True)
    base = {"global_enabled": True, "source_enabled": None, "client_enabled": True, "access_method": "dom", "authorization": signed, "robots_mode": None, "robots_allowed": True, "budget_allowed": True, "breaker_open": False}
    rows = [
        (base, None, 7), (base | {"global_enabled": False, "client_enabled": False}, "ERR-POLICY-KILLSWITCH", 1), (base | {"source_enabled": False}, "ERR-POLICY-KILLSWITCH", 2), (base | {"client_enabled": False}, "ERR-POLICY-KILLSWITCH", 3),
        (base | {"authorization": None}, "ERR-POLICY-UNAUTHORIZED", 4), (base | {"authorization": None, "access_method": "api"}, None, 7), (base | {"authorization": ("Ann", " ", "owner", "r", True)}, "ERR-POLICY-UNAUTHORIZED", 4), (base | {"authorization": (*signed[:4], False)}, "ERR-POLICY-UNAUTHORIZED", 4),
        (base | {"authorization": ("Ann", "d", "friend", "r", True)}, "ERR-POLICY-UNAUTHORIZED", 4), (base | {"robots_allowed": False}, "ERR-POLICY-ROBOTS", 5), (base | {"robots_allowed": False, "robots_mode": "ignore"}, None, 7), (base | {"robots_allowed": None}, None, 7),
        (base | {"robots_allowed": None, "robots_mode": "block"}, "ERR-POLICY-ROBOTS", 5), (base | {"robots_allowed": False, "robots_mode": "what"}, "ERR-POLICY-ROBOTS", 5), (base | {"budget_allowed": False}, "ERR-POLICY-BUDGET", 6), (base | {"breaker_open": True}, "ERR-POLICY-BREAKER-OPEN", 7), (dict.fromkeys(base), None, 7),
    ]
    df = spark.createDataFrame([tuple(r.values()) for r, _, _ in rows], runs.PREFLIGHT)
    allow, code, reasons = runs.preflight()
    got = df.select(allow.alias("a"), code.alias("c"), reasons.alias("r")).collect()
    assert [(x.c, len(x.r)) for x in got] == [(c, n) for _, c, n in rows] and [x.a for x in got] == [c is None for _, c, _ in rows]
    assert [r.passed for r in got[4].r] == [True, True, True, False] and got[4].r[3].name == "authorisation-record" and got[4].r[0].code is None


def test_alerts_of_error_classes(spark):
    schema = "error_class string, client_slug string, listing_key string, adapter string, stop_reason string"
    rows = [("E-S", "c", "l", "a", "blocked"), ("E-S", "d", "m", "a", None), ("E-T", "c", "l", "a", None), ("E-T", "c", "l", "b", "error"), ("E-T", None, None, None, None), ("E-R", "c", "l", "a", None), ("E-R", "d", "l", "b", None), ("E-?", "c", "l", "a", None), (None, "c", "l", "a", None)]
    classes = spark.createDataFrame([("E-S", "source", "critical"), ("E-T", "record", "warn"), ("E-R", "run", "error")], "code string, scope string, severity string")
    found = health.error_alerts(spark.createDataFrame(rows, schema), classes)
    got = {x.fingerprint: x for x in found.collect()}
    assert set(got) == {"[alert:critical:E-S:source/a]", "[alert:warn:E-T:client/c/l]", "[alert:warn:E-T:client/unknown/all]", "[alert:error:E-R:run]", "[alert:error:E-?:client/c/l]"}
    assert got["[alert:warn:E-T:client/c/l]"].title == "E-T — c/l" and "Stop reason: " in got["[alert:warn:E-T:client/c/l]"].body
    assert [x.condition for x in health.deliverable(found, maintenance=True).collect()] == ["E-S"] and health.deliverable(found).count() == 5
    opened = spark.createDataFrame([("[alert:error:E-R:run]", 1), ("gone", 2)], "fingerprint string, issue int")
    assert {(x.fingerprint, x.action) for x in health.deliveries(found, opened).collect() if x.action != "open"} == {("[alert:error:E-R:run]", "comment"), ("gone", "close")}
