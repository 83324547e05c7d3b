"""Line dedup, the divergence audit and centroid clustering against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import centroids, divergence, lines


def clash():
    return {"doc": F.lit("clash"), "h": F.lit(1), "shard": F.lit("s"), "kind": F.lit(None).cast("int"), "id": F.lit(3), "gone": F.lit(4), "term": F.lit("t"), "p": F.lit(1.5)}


def brute_lines(rows, least=10):
    key = lambda x: x.strip(b" \t\n\v\f\r").lower()
    rank = lambda d: math.inf if d is None else d
    holders = defaultdict(set)
    for d, t in rows:
        for x in (t or "").encode().split(b"\n"):
            if len(key(x).decode()) >= least:
                holders[key(x)].add(rank(d))
    out = []
    for d, t in rows:
        own = (t or "").encode().split(b"\n")
        kept = [x for x in own if not (len(holders.get(key(x), ())) > 1 and min(holders[key(x)]) != rank(d))]
        out.append((rank(d), len(own), len(own) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return sorted(out)


def line_rows(seed=1):
    r = random.Random(seed)
    pool = [f"A shared line number {k}" for k in range(40)] + ["ééééééééé", "éééééééééé", " no-break start", "short", "   spaces around it  ", "SPACES AROUND IT\r"]
    rows = [(1, None), (2, ""), (None, "null id\nA shared line number 1\n"), (None, "null id twice over\nA shared line number 1"), (5, "\n\n\n"), (6, "x" * 200_000 + "\n" + "a shared LINE number 2"), (6, "the same id again\nthe same id again"), (6, "the same id again")]
    for d in range(10, 300):
        own = [r.choice(pool) if r.random() < 0.6 else f"line of its own {r.random()}" for _ in range(r.randint(0, 12))]
        rows.append((d, "\n".join(x.upper() if r.random() < 0.2 else f"\t{x} " for x in own)))
    return [*rows, rows[-1], rows[50]] + [(9000, "very\tcommon line of all\nand more of it")] * 60


def found_lines(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash())
    got = lines.dedup_lines(df).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()
    return sorted((math.inf if d is None else d, *rest) for d, *rest in map(tuple, got))


def test_line_dedup(spark):
    assert found_lines(spark, line_rows()) == brute_lines(line_rows())


def test_line_dedup_of_many_shards(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD", 16)
    monkeypatch.setattr(lines, "HOT", 30)
    rows = line_rows(2) + [(20_000 + k, "one line that every document has\nand another " + str(k)) for k in range(200)]
    assert found_lines(spark, rows) == brute_lines(rows)


def test_line_dedup_empty(spark):
    assert found_lines(spark, []) == []
    assert found_lines(spark, [(1, None), (2, None)]) == brute_lines([(1, None), (2, None)])


def test_perfect_hash_is_minimal_and_survives_packing():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 20_000):
        h, f = rng.integers(-(2**63), 2**63, n), rng.integers(-(2**31), 2**31, n).astype(np.int32)
        h[: n // 2] = h[n // 2 : n // 2 * 2]  # equal in the first 64 bits, told apart by the rest
        built = lines.PerfectHash.build(h, f)
        again = lines.PerfectHash.unpack(*built.pack())
        assert sorted(built.slots(h, f).tolist()) == list(range(n)) and (again.slots(h, f) == built.slots(h, f)).all()
        assert sum(built.sizes) <= 8 * n + 64 * len(built.sizes)


def test_a_shard_answers_for_its_own_keys_and_knows_strangers():
    rng = np.random.default_rng(4)
    h, f, low = rng.integers(-(2**63), 2**63, 5000), rng.integers(-(2**31), 2**31, 5000).astype(np.int32), rng.integers(0, 99, 5000)
    n, shared = rng.integers(1, 200_000, 5000), rng.random(5000) < 0.4
    shard = lines.Shard.unpack(*lines.Shard.build(h, f, low, n, shared).pack())
    assert shard.holds(h, f).all() and (shard.drops(h, f, low + 1) == (shared & (n > 1))).all() and not shard.drops(h, f, low).any()
    assert not shard.holds(h, f + 1).any()


def brute_audit(rows, documents, top=50):
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, inside, groups = Counter(), Counter(), set()
    for t, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        ts = term.findall((t or "").translate(low))
        counts.update((lang, source, x) for x in ts)
        inside.update((lang, x) for x in set(ts))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [x for (g, x), n in inside.items() if g == lang and n >= documents]
        sources = [s for g, s in groups if g == lang]
        whole = {x: sum(counts[lang, s, x] for s in sources) for x in kept}

        def shares(n, kept=kept):
            total = sum(n.values()) + 5 * len(kept)
            return {x: 1 + 10**9 * (n[x] + 5) // total for x in kept}

        q, p = shares(whole), {s: shares({x: counts[lang, s, x] for x in kept}) for s in sources}
        for s in sources:
            pairs = sorted((-sum(abs(p[s][x] - p[o][x]) for x in kept), o.encode(), o) for o in sources if o != s)
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)]
            more = sorted((q[x] - p[s][x], x.encode(), x) for x in kept if counts[lang, s, x] and p[s][x] > q[x])[:top]
            out += [(lang, s, "term", x, -v, k + 1) for k, (v, _, x) in enumerate(more)]
    return sorted(out)


@pytest.mark.parametrize("documents", [1, 5, 1000])
def test_divergence(spark, documents):
    r = random.Random(5)
    words = ["the", "The", "naïve", "ЖУК", "жук", "a1b2", "don't", "x_y", "😀z", *(f"w{chr(97 + k)}" for k in range(20))]
    rows = [(None, None, None), ("", "en", "a"), (None, "en", "empty"), ("word " * 5000, "en", "a"), ("1 2 3 ...", "xx", "only")]
    rows += [(" ".join(r.choice(words) for _ in range(r.randint(0, 30))), r.choice(["en", "de", None]), r.choice(["a", "b", "c", "é", "", None])) for _ in range(150)]
    rows += rows[-3:]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumns(clash())
    got = sorted(map(tuple, divergence.audit(df, documents=documents).select("lang", "source", "part", "item", "value", "rank").collect()))
    assert got == brute_audit(rows, documents)


def test_divergence_empty(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_shares_are_exact_beyond_a_long(spark):
    n, total = 3 * 10**14, 10**18 + 7
    got = spark.createDataFrame([(n, total, 11)], "n long, total long, v long").select(divergence.share(F.col("n"), F.col("total"), F.col("v")).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 5) // (total + 55)


def brute_clusters(rows, k=8, rounds=10, dims=64):
    """Lloyd without any delta, in Python integers."""
    hold = lambda v: max(-centroids.BOUND, min(centroids.BOUND, v))
    kept = [(i, [hold(math.floor(1024 * x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in kept)
    cs = [x for _, x in order[:k]]
    gap = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    best = lambda x: min((gap(x, c), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, x in kept:
            own[best(x)[1]].append(x)
        cs = [[sum(col) // len(own[n]) for col in zip(*own[n], strict=True)] if n in own else c for n, c in enumerate(cs)]
    found = [(i, *best(x)[::-1]) for i, x in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted((i is None, i or 0, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in found)


def found_clusters(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit("x"), "x": F.lit(1), "block": F.lit(2), "owner": F.lit(3)})
    got = centroids.cluster(df, **kw).collect()
    return sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got)


def test_clusters(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 16)
    r = random.Random(6)
    vec = lambda m: [m + r.gauss(0, 0.3) for _ in range(64)]
    rows = [(i, vec(r.choice([-1, 0, 0, 2]))) for i in range(240)] + [(1000 + i, [0.25] * 64) for i in range(80)]
    rows += [(None, vec(0)), (None, vec(1)), (7, vec(0)), (2000, None), (2001, []), (2002, [1.0] * 63), (2003, [None] + [1.0] * 63), (2004, [math.nan] * 64), (2005, [math.inf] * 64), (2006, [1e300] + [0.0] * 63), (2007, [-1e-9] * 64), (2008, [0.0] * 64)]
    assert found_clusters(spark, rows) == brute_clusters(rows)
    few = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.5] * 64)]
    assert found_clusters(spark, few) == brute_clusters(few)
    assert found_clusters(spark, []) == [] and found_clusters(spark, [(1, None)]) == []


def test_unsettled_clusters_and_ties(spark, monkeypatch):
    """Few dimensions and small integers: many ties, and rounds that end before anything settles."""
    monkeypatch.setattr(centroids, "BLOCK", 7)
    r = random.Random(7)
    rows = [(i, [r.randrange(9) / 1024 for _ in range(2)]) for i in range(300)]
    for rounds in (0, 1, 3):
        assert found_clusters(spark, rows, dimensions=2, rounds=rounds) == brute_clusters(rows, rounds=rounds, dims=2)


def test_tables_of_a_run_go(spark):
    found_clusters(spark, [(i, [float(i)] * 64) for i in range(30)])
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("centroids_")]
