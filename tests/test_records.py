"""Canonical JSON, nested redaction, functions of the user's, publishing."""

import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewmill.functions import canonical
from reviewmill.operators import enrich, redaction
from reviewmill.sources import publish


@pytest.mark.parametrize(("x", "want"), [
    (0, "0"), (-0.0, "0"), (1.0, "1"), (100.0, "100"), (0.1, "0.1"), (-12.5, "-12.5"), (1e21, "1e+21"), (1e20, "100000000000000000000"), (123456789012345680000.0, "123456789012345680000"), (1e-6, "0.000001"), (1e-7, "1e-7"), (1.5e-9, "1.5e-9"), (1.25e300, "1.25e+300"),
    (2**53, "9007199254740992"), (2**53 + 1, "9007199254740992"), (12345678901234567890123, "1.2345678901234568e+22"), (5e-324, "5e-324"), (0.30000000000000004, "0.30000000000000004"), (1e16, "10000000000000000"), (4.35, "4.35"),
])
def test_numbers_as_ecmascript_writes_them(x, want):
    assert canonical.number(x) == want


def shuffled(r, value):
    if isinstance(value, dict):
        keys = list(value)
        r.shuffle(keys)
        return {k: shuffled(r, value[k]) for k in keys}
    return [shuffled(r, x) for x in value] if isinstance(value, list) else value


def made(r, depth=0):
    kind = r.randrange(8 if depth < 5 else 5)
    if kind < 5:
        return [None, True, r.choice([1, -2.5, 1e30, 7.0]), r.choice(["", "é\n\"", "\x1f", "😀"]), r.randrange(10**18)][kind]
    return {r.choice("abcdé😀～Z") + str(k): made(r, depth + 1) for k in range(r.randrange(5))} if kind < 7 else [made(r, depth + 1) for _ in range(r.randrange(4))]


def test_hash_does_not_depend_on_the_order_of_keys(spark):
    r = random.Random(1)
    values = [made(r) for _ in range(60)]
    rows = [(k, json.dumps(v), json.dumps(shuffled(r, v), ensure_ascii=False, indent=1)) for k, v in enumerate(values)]
    got = spark.createDataFrame(rows, "k long, a string, b string").select(canonical.hash_of(F.col("a")).alias("a"), canonical.hash_of(F.col("b")).alias("b")).collect()
    assert all(x.a == x.b for x in got) and len({x.a for x in got}) == len({canonical.canonical(v) for v in values})


def test_what_has_no_canonical_text(spark):
    rows = [('{"b":1,"a":[null,{}]}', '{"a":[null,{}],"b":1}'), ('{"a":1,"a":2}', '{"a":2}'), ("NaN", None), ('{"a":Infinity}', None), ("[1e400]", None), ("{} tail", None), ("nope", None), (None, None), ("[" * 5000 + "]" * 5000, None), (' "x\\u001F" ', '"x\\u001f"'), ('"\\ud800"', '"\\ud800"'), ('{"～":1,"😀":2}', '{"😀":2,"～":1}')]
    got = [x.c for x in spark.createDataFrame([(a,) for a, _ in rows], "j string").select(canonical.canonical_json("j").alias("c")).collect()]
    assert got == [w for _, w in rows]


def test_nested_redaction(spark):
    secrets = {"long": "abcdefgh", "part": "cdefgh", "other": "fghijklm", "tiny": "xyz", "none": ""}
    record = {
        "Authorization": "x", "a": {"set-cookie": 1, "list": [{"apiKey": {"deep": 1}, "note": "has abcdefgh and cdefgh"}, "xyz", "xyz!"]}, "abcdefgh": 1, "text": "t" * 130, "body": 5, "name": "Ann", "n": {"author_name": None, "reviewer_name": "Bo"},
        "url": "https://a.b/c?token=1&W=2&h=3&h=4#f", "mail": "see https://a.b/c?token=1", "overlap": "abcdefghijklm", "yes": True, "x": 1.5,
    }
    deep = "leaf"
    for _ in range(12):
        deep = {"d": deep}
    rows = [(json.dumps(record),), (json.dumps(deep),), ("no json abcdefgh",), (None,), ("[]",)]
    got = [x.r for x in spark.createDataFrame(rows, "j string").select(redaction.redacted(F.col("j"), secrets).alias("r")).collect()]
    assert json.loads(got[0]) == {
        "a": {"list": [{"apiKey": "«redacted:apiKey»", "note": "has «redacted:long» and «redacted:part»"}, "«redacted:tiny»", "xyz!"]}, "«redacted:long»": 1, "text": "t" * 120 + "…", "body": 5, "name": "«redacted:author»", "n": {"author_name": "«redacted:author_name»", "reviewer_name": "«redacted:author»"},
        "url": "https://a.b/c?W=2&h=4", "mail": "see https://a.b/c?token=1", "overlap": "«redacted:long»ijklm", "yes": True, "x": 1.5,
    }
    x = json.loads(got[1])
    for _ in range(9):
        assert isinstance(x, dict)
        x = x["d"]
    assert x == "«redacted:depth»" and got[2:] == ["no json «redacted:long»", None, "[]"]


def test_functions_that_fail_leave_the_others_alone(spark):
    calls = []

    def summary(frame):
        calls.append(len(frame))
        if (frame["n"] == 7).any():
            raise RuntimeError("no")
        return pd.DataFrame({"summary": "s" + frame["n"].astype(str), "topics": [["a", "b"]] * len(frame), "rating": 5})

    def model(frame):
        return pd.DataFrame({"summary": [f"later {n}" if n == 3 else None for n in frame["n"]], "model": [None] * len(frame)})

    def short(frame):
        return frame.head(len(frame) - 1)[[]]

    rows = spark.range(20).select(F.col("id").alias("n"), F.lit("x").alias("ai")).drop("ai").coalesce(1)
    got = {x.n: x for x in enrich.enriched(rows, {"summary": summary, "model": model}).collect()}
    assert got[7].ai is None and got[7].ai_failed == ["summary"] and got[7].ai_rejected == []
    assert got[3].ai.summary == "later 3" and got[3].ai.topics == ["a", "b"] and got[3].ai.model is None
    assert all(got[k].ai.summary == f"s{k}" and got[k].ai_failed == [] and got[k].ai_rejected == ["rating"] for k in range(20) if k not in (3, 7))
    assert tuple(enrich.tally(enrich.enriched(rows, {"summary": summary})).first()) == (19, 1)
    assert {tuple(x.ai_failed) for x in enrich.enriched(rows, {"short": short}).collect()} == {("short",)}
    assert enrich.enriched(rows, {}) is rows and enrich.enriched(rows.limit(0), {"m": model}).count() == 0
    assert [n for _, n in enrich.attempt(summary, pd.DataFrame({"n": range(16)}))] == [4, 2, 1, 1, 8]


def test_publishing_in_two_steps(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "p")
    frame = lambda rows: spark.createDataFrame([("c", "l", *r) for r in rows], publish.PAYLOAD)
    shown = lambda: sorted((r.artifact, r.body) for r in publish.published(spark, folder).collect())
    assert shown() == [] and publish.publish(frame([]), folder) == 0
    assert publish.publish(frame([("a", "1", "h1"), ("b", "1", None), ("a", "1", "h1")]), folder) == 2
    assert publish.publish(frame([("a", "1", "h1"), ("b", "1", None)]), folder) == 0
    assert not (tmp_path / "p" / "payload" / "version=2").exists()
    # Other bytes with the same content hash are no change; without a hash they are.
    assert publish.publish(frame([("a", "2", "h1"), ("b", "2", None), ("c", "1", "h")]), folder) == 2
    assert shown() == [("a", "1"), ("b", "2"), ("c", "1")]
    with monkeypatch.context() as m:
        m.setattr(publish, "_seal", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            publish.publish(frame([("d", "1", "h")]), folder)
    assert shown() == [("a", "1"), ("b", "2"), ("c", "1")]  # the payload is there, but not published
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "p" / "payload").rglob("*.parquet")}
    assert publish.publish(frame([("d", "1", "h")]), folder) == 0
    assert shown() == [("a", "1"), ("b", "2"), ("c", "1"), ("d", "1")] and files == {p: p.stat().st_mtime_ns for p in (tmp_path / "p" / "payload").rglob("*.parquet")}
