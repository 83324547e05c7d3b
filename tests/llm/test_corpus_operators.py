"""Near-duplicates, repeats, packing, neighbours and the language model against brute force."""

import functools
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from reviewmill.llm import minhash, neighbours, packing, pii, quality, repeats, suffix_tree
from reviewmill.llm.common import staged


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("clash"), "t1": F.lit(1), "block": F.lit(2), "sig": F.lit(None).cast("int")})


def vary(r, words, n):
    out = list(words)
    for _ in range(n):
        out[r.randrange(len(out))] = f"v{r.randrange(10**6)}"
    return out


def near_rows(seed=5):
    r = random.Random(seed)
    rows = [(1, None), (2, ""), (3, "one two"), (4, "ONE  two"), (5, "one two three"), (6, "\n")]
    for g in range(25):
        base = [f"w{r.randrange(3000)}" for _ in range(r.randint(20, 150))]
        for _ in range(r.randint(1, 7)):
            rows.append((len(rows) + 1, " ".join(vary(r, base, r.choice([0, 1, 2, 3, 5])))))
    base = [f"h{k}" for k in range(120)]
    rows += [(len(rows) + 1 + k, " ".join(vary(r, base, k % 4))) for k in range(150)]
    r.shuffle(rows)
    return rows


def components(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def test_near_duplicates(spark):
    rows = near_rows()
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == components(rows)


def test_near_duplicates_in_regions_that_are_split(spark, monkeypatch):
    monkeypatch.setattr(minhash, "REGION", 16)
    monkeypatch.setattr(minhash, "RUN", 150)
    rows = near_rows(6)
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == components(rows)


def crowded_rows(seed=1):
    """One crowded group of unlinked documents (about 0.65 alike) with pairs of about 0.76, none through the smallest id."""
    r, out = random.Random(seed), []
    base = [f"b{k}" for k in range(300)]
    for g in range(125):
        tail = [f"t{g}_{k}" for k in range(80)]
        out += [base + tail, base + tail[:-46] + [f"u{g}_{k}" for k in range(46)]]
    rows = [(0, " ".join(base + [f"z{k}" for k in range(80)]))] + [(k + 1, " ".join(w)) for k, w in enumerate(out)]
    r.shuffle(rows)
    return rows


def test_near_duplicates_in_a_crowded_region(spark, monkeypatch):
    monkeypatch.setattr(minhash, "REGION", 8)
    monkeypatch.setattr(minhash, "WIDE", 2)
    rows = crowded_rows()
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert len({c for _, c, _ in got.values()}) == 126
    assert got == components(rows)


def test_near_duplicates_of_very_long_texts(spark):
    long = [f"w{k}" for k in range(30_000)]
    rows = [(1, " ".join(long)), (2, " ".join([*long[:-900], *(f"x{k}" for k in range(900))])), (3, " ".join(long[:15_000])), (4, "y" * 80_000)]
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == components(rows)


def test_near_duplicates_edges(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "q r s t u v w"), (4, "a b c d e f"), (7, "q r s t u v w")]
    got = sorted((x.doc_id or 0, x.component_id or 0, x.kept) for x in minhash.near_duplicates(frame(spark, rows)).collect())
    # Id 4 stands in both groups and so joins them.
    assert got == [(0, 0, True)] * 2 + [(3, 3, True)] * 2 + [(4, 3, False)] * 2 + [(7, 3, False)]
    assert sorted(x.doc_id or 0 for x in minhash.deduplicate(frame(spark, rows)).collect()) == [0, 0, 3]


def brute_repeats(texts, n=repeats.LENGTH):
    c = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if c[t[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest()))
    return out


def repeat_rows():
    r = random.Random(3)
    some = lambda n: "".join(r.choice("abcdé \n") for _ in range(n))
    shared = [some(1000), some(500), some(399), some(401), some(2000)]
    rows = [(0, None), (1, ""), (2, "a" * 2000), (3, "ab" * 700 + some(300)), (4, "ab" * 500), (None, shared[0]), (None, shared[0])]
    rows += [(i, "".join(r.choice([some(r.randint(0, 600)), r.choice(shared)[r.randint(0, 100) :]]) for _ in range(r.randint(1, 5)))) for i in range(5, 60)]
    return rows + [(200 + i, shared[4] + "x") for i in range(5)]


def check_repeats(spark, rows, length, passage=None):
    got = repeats.remove_repeats(frame(spark, rows), length=length, passage=passage).select("n_bytes", "n_removed", "n_spans", F.sha2("kept", 256), "n_passage_bytes").collect()
    texts = [(t or "").encode() for _, t in rows]
    assert sorted(map(tuple, got)) == sorted((*x, y[1]) for x, y in zip(brute_repeats(texts, length), brute_repeats(texts, passage or length), strict=True))


@pytest.mark.parametrize(("length", "passage"), [(400, None), (400, 200), (200, None), (60, 150)])
def test_repeats(spark, length, passage):
    check_repeats(spark, repeat_rows(), length, passage)


@pytest.mark.parametrize(("length", "passage"), [(400, None), (400, 200), (60, 150)])
def test_repeats_of_crowded_anchors(spark, monkeypatch, length, passage):
    monkeypatch.setattr(repeats, "LIMIT", 4)
    r = random.Random(4)
    some = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    common = some(700)
    rows = [(i, some(r.randint(0, 90)) + common[r.choice([0, 0, 7, 150]) : r.choice([700, 700, 690, 430])] + some(r.randint(0, 90))) for i in range(60)]
    check_repeats(spark, repeat_rows() + rows, length, passage)


def test_repeats_of_texts_beyond_a_chunk(spark, monkeypatch):
    """Texts that are longer than what a task holds of several texts together; their repeats lie far apart and across them."""
    monkeypatch.setattr(repeats, "CHUNK", 1 << 12)
    r = random.Random(6)
    some = lambda n: "".join(r.choice("abcdefé \n") for _ in range(n))
    common = some(900)
    long = common + some(15_000) + common[100:] + some(9_000)
    rows = [(1, long), (2, some(12_000) + long[3_000:9_000] + some(50)), (3, some(400)), (4, common[:450]), (5, "ab" * 6_000), (6, None)]
    check_repeats(spark, rows, 400, 200)


def test_repeats_empty(spark):
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def test_repeats_keeps_columns_of_any_name(spark):
    text = "".join(random.Random(5).choice("abcd ") for _ in range(900))
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string").withColumns({"row": F.lit(7), "_row": F.lit(8), "_": F.lit(9), "ranges": F.lit(1), "kept": F.lit(2)})
    got = repeats.remove_repeats(docs).select("row.*", "text").collect()
    assert [(x.row, x._row, x["_"], x.ranges, x.kept, x.text) for x in got] == [(7, 8, 9, 1, 2, "")] * 2
    assert pii.redact(docs).select("row", "_row", "_", "text").first()[:3] == (7, 8, 9)


def test_columnwise_order_is_exact():
    r = random.Random(8)
    left, right = (["".join(r.choice("ab") for _ in range(n)).encode() for _ in range(3)] for n in (300, 300))
    frags = [r.choice(left)[-k:] + b"S" * 100 + r.choice(right)[:m] for k, m in ((r.randint(0, 300), r.randint(0, 300)) for _ in range(60))]
    frags = [f for f in set(frags) if len(f) >= 400]
    at = np.array([f.index(b"S" * 100) for f in frags])
    got = repeats.columnwise(frags, at) >= 400
    for i, f in enumerate(frags):
        for c in range(301):
            a = c - 300 + at[i]
            want = a >= 0 and a + 400 <= len(f) and any(j != i and 0 <= c - 300 + at[j] and g[c - 300 + at[j] :][:400] == f[a : a + 400] for j, g in enumerate(frags))
            assert got[i, c] == want


PATH, PATTERN, ADDED = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))


def check_packing(rows, got):
    """Every token of every row in exactly one piece; sequences gapless; padding only where allowed."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for (d, t), e in zip(rows, tok.encode_batch([t or "" for _, t in rows], add_special_tokens=False), strict=True):
        ids = [*e.ids, 0]
        want.update((d, i, x, len(ids)) for i, x in enumerate(ids))
    have, seq = Counter(), defaultdict(list)
    for p in got:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and zlib.crc32(bytes(p.ids)) == p.crc
        have.update((p.doc_id, p.start + i, int(x), p.doc_tokens) for i, x in enumerate(ids))
        seq[p.sequence_id].append((p.offset, p.length))
    assert have == want
    for s in seq.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 1024
    full = sum(sum(n for _, n in s) in (1 << k for k in range(11)) for s in seq.values())
    assert full == len(seq)


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 40)
    r = random.Random(9)
    rows = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "null id"), (5, "word " * 3000), (6, "<|endoftextish|>  double  blanks\n\n")]
    rows += [(7, "x <|endoftext|> y"), (8, "<|endoftext|>"), (9, "<|endoftext|><|endoftext|> a  <|endoftext|>\n<|endoftext|>z <|endof text|>")]
    rows += [(10 + i, " ".join(f"t{r.randrange(200)}" for _ in range(r.randint(0, 900)))) for i in range(120)]
    check_packing(rows, packing.pack(frame(spark, rows).withColumn("content", F.lit(1)), PATH, PATTERN, ADDED).withColumn("crc", F.crc32("ids")).collect())
    assert packing.pack(frame(spark, []), PATH, PATTERN, ADDED).count() == 0


def test_packing_of_long_texts(spark):
    r = random.Random(10)
    rows = [(1, " ".join(f"w{r.randrange(5000)}" for _ in range(20_000))), (2, "x" * 40_000), (3, "\n" * 20_000), (4, "é🙂" * 9_000), (5, "short"), (5, "short")]
    check_packing(rows, packing.pack(frame(spark, rows), PATH, PATTERN, ADDED).withColumn("crc", F.crc32("ids")).collect())


def test_retrieval_prefers_lexical_neighbours():
    docs = [np.array([1, 2, 3, 4] * 100), np.array([9, 8, 7] * 100), np.array([1, 2, 3] * 100)]
    idf = np.ones(10)
    index = packing.Index(docs, idf)
    assert index.scores(np.array([1, 2, 3])).argmax() in (0, 2)
    first = packing.fill(docs, idf, 1024)[0]
    assert [d for d, _, _ in first][:2] == [0, 2]


def test_scores_are_bm25():
    r = random.Random(2)
    docs = [np.array([r.randrange(60) if r.random() < 0.5 else r.randrange(3) for _ in range(r.randint(1, 40))]) for _ in range(50)]
    idf = np.random.default_rng(1).random(60)
    index = packing.Index(docs, idf)
    mean = sum(map(len, docs)) / len(docs)
    for seed in docs[:10]:
        want = [sum(idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t, n in Counter(d.tolist()).items() if t in seed) for d in docs]
        assert np.allclose(index.scores(np.unique(seed)), want, rtol=1e-4)


def test_depths_follow_the_common_prefixes():
    r = random.Random(15)
    keys = np.array(sorted([r.randrange(2), *(r.randrange(2) for _ in range(minhash.DEPTH))] for _ in range(300)), np.uint32)
    hashes, sizes, edge, depth = minhash.depths(keys, 20)
    rows = [tuple(k) for k in keys.tolist()]
    for i, k in enumerate(rows):
        n = [sum(x[: d + 1] == k[: d + 1] for x in rows) for d in range(minhash.LEAST, minhash.DEPTH + 1)]
        assert sizes[:, i].tolist() == n
        at = [k[: d + 1] in (rows[0][: d + 1], rows[-1][: d + 1]) for d in range(minhash.LEAST, minhash.DEPTH + 1)]
        assert edge[:, i].tolist() == at
        fit = [d for d, x in enumerate(n) if x <= 20]
        assert depth[i] == (minhash.DEPTH + 1 if not fit else 0 if at[fit[0]] else minhash.LEAST + fit[0])


def brute_nearest(rows, k=20):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 8]
    out = {}
    for i, v in ok:
        if i % 20 == 0:
            out[i] = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in ok if j != i))[:k]
    return out


def test_neighbours_recall_and_edges(spark):
    r = random.Random(10)
    vec = lambda: [float(np.float32(r.gauss(0, 1))) for _ in range(8)]
    hot = vec()
    rows = [(i, vec()) for i in range(3000)] + [(3000 + i, hot) for i in range(600)]
    rows += [(4000, None), (4020, [0.0] * 8), (4040, [1.0, None] * 4), (4060, [float("nan")] * 8), (4080, [1.0] * 3), (None, vec()), (4100, [float("inf")] * 8), (4120, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"leaf": F.lit(1), "cid": F.lit("x")})
    got = defaultdict(list)
    for x in neighbours.nearest(df, F.col("vec_id") % 20 == 0, leaf=128).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.vec_id, x.score, x.rank))
    want = brute_nearest(rows)
    assert set(got) == set(want)
    hits = sum(len({j for j, *_ in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q in got:
        assert [x[2] for x in got[q]] == list(range(1, 21))
    for q in (3000, 3020):  # a vector with hundreds of copies: itself apart, the smallest ids win
        top = [j for _, j in want[q]]
        assert [j for j, *_ in got[q]] == top


def test_neighbours_small_tables(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (20, [0.5, 0.5])], "vec_id long, embedding array<float>")
    got = sorted((x.query_id, x.rank, x.vec_id) for x in neighbours.nearest(few, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1), (0, 2, 20), (20, 1, 0), (20, 2, 1)]
    assert neighbours.nearest(few.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_leaves_of_many_queries_are_those_of_one_queue():
    r = np.random.default_rng(3)
    x = r.normal(size=(2000, 6)).astype(np.float32)
    for sample, depth in ((2000, 5), (300, 7), (20, 3)):
        f = neighbours.Forest(x[:sample], float(np.linalg.norm(x, axis=1).max()), depth)
        far = f.distances(x[:5])
        for q, found in zip(np.append(x[:5], np.zeros((5, 1), np.float32), axis=1), far.reshape(5, f.trees, -1), strict=True):
            for t, leaf in ((t, leaf) for t in range(f.trees) for leaf in range(1 << depth)):
                node, want = 0, -np.inf
                for level in range(depth):
                    side = q @ f.normals[t, node] - f.cuts[t, node] if level < f.top else (q - f.means[t, leaf >> (depth - f.top)]) @ f.below[t, level - f.top]
                    high = leaf >> (depth - level - 1) & 1
                    want = max(want, -np.inf if (side > 0) == bool(high) else abs(side))
                    node = 2 * node + 1 + high
                assert found[t, leaf] == want or abs(found[t, leaf] - want) < 1e-5
        taken = f.search(x[:5], 20)
        assert (taken.sum(1) == 20).all() and (np.where(taken, far, -np.inf).max(1) <= np.where(taken, np.inf, far).min(1)).all()
        assert np.isneginf(far).sum() == 5 * f.trees and taken[np.isneginf(far)].all()


def written(spark):
    """Rows that stages have written to shuffles so far."""
    jvm, store = spark.sparkContext._jvm, spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(jvm.double, 0)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    stages = store.stageList(jvm.java.util.ArrayList(), False, False, none, jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


@pytest.mark.parametrize("blocks", [{}, {"CELL": 30_000, "ASKED": 6_000, "TILE": 3_000}])
def test_neighbours_see_every_leaf_by_small_parts(spark, monkeypatch, blocks):
    for name, size in blocks.items():
        monkeypatch.setattr(neighbours, name, size)
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 8)).astype(np.float32)
    x[:900] = x[0] + r.normal(size=(900, 8)).astype(np.float32) * 1e-3  # a crowded corner
    rows = list(enumerate(x.tolist()))
    before = written(spark)
    # So much effort that all leaves are seen: the result is exact.
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 3 == 0, k=5, leaf=8, effort=200).orderBy("query_id", "rank").collect()
    assert blocks or written(spark) - before < 200_000  # 1,000 queries take 4,096 leaves each
    score = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(score, -np.inf)
    want = [(q, k + 1, int(c)) for q in range(0, 3000, 3) for k, c in enumerate(np.lexsort((np.arange(3000), -score[q]))[:5])]
    assert [(g.query_id, g["rank"], g.vec_id) for g in got] == want
    assert all(abs(g.score - score[g.query_id, g.vec_id]) < 1e-9 for g in got)


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "FREQUENT", 50)
    monkeypatch.setattr(suffix_tree, "BLOCK", 5000)
    r = random.Random(11)
    vocabulary = ["".join(r.choice(["th", "er", "in", "on", "Re", "é"]) for _ in range(r.randint(1, 4))) for _ in range(300)]
    rows = [(1, None), (2, ""), (None, "Null ID here"), (4, "x " * 3000)] + [(10 + i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 80)))) for i in range(300)]
    rows.append(rows[-1])
    held = lambda d: zlib.crc32(str(d).encode() if d is not None else b"") % 7 == 2
    words = lambda t: (t or "").encode().lower().split() + [b"\n"]
    c = Counter(w for d, t in rows if not held(d) for w in words(t))
    total, distinct = sum(c.values()), len(c)
    got = suffix_tree.score(frame(spark, rows)).collect()
    key = lambda d, h, n, k, b: (d or 0, h, n, k, round(b, 6))
    want = sorted(key(d, held(d), len(words(t)), sum(c[w] > 0 for w in words(t)), sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in words(t))) for d, t in rows)
    assert sorted(key(x.doc_id, x.held_out, x.n_tokens, x.n_known, x.base_score) for x in got) == want
    assert all(x.train_tokens == total and x.score < 0 for x in got)
    assert suffix_tree.score(frame(spark, [])).count() == 0


def test_tree_is_a_distribution_and_beats_its_root(spark):
    r = random.Random(12)
    words = Counter(r.choice([b"abra", b"cadabra", b"hocus", b"pocus"]) for _ in range(4000))
    contexts = [b"     ", b" abra", b"zzzzz", b"  cus"]
    asked = {int.from_bytes(c + bytes([x]), "big"): 0 for c in contexts for x in range(256)}
    for w, n in words.items():
        for k in suffix_tree._strings([w])[0].tolist()[:-1]:
            asked[k] = asked.get(k, 0) + n
    # What the tree also has to hold: every symbol after every suffix.
    tree = {x.key: x for x in suffix_tree.grow(spark.createDataFrame(list(asked.items()), "key long, n long")).collect()}
    for c in contexts:
        own = [tree[int.from_bytes(c + bytes([x]), "big")] for x in range(256)]
        assert abs(sum(x.p for x in own) - 1) < 1e-9
    assert tree[int.from_bytes(b" abra ", "big")].state >= 2 and tree[int.from_bytes(b"zzzzza", "big")].state == 0
    assert tree[int.from_bytes(b" hocus", "big")].p > 0.9


def suffix_tree_scores(rows, held):
    """By counting every context of every training text, one at a time."""
    plain = lambda t: b"".join(w + b" " for w in (t or "").encode().lower().split()) + b"\n"
    placed = lambda t: [((b" " * suffix_tree.DEPTH + plain(t))[i : i + suffix_tree.DEPTH], x) for i, x in enumerate(plain(t))]
    after = {}
    for d, t in rows:
        for context, x in placed(t) if d not in held else ():
            for k in range(suffix_tree.DEPTH + 1):
                after.setdefault(context[k:], Counter())[x] += 1

    @functools.cache
    def p(context, x):
        own = after.get(context, Counter())
        n = sum(own.values())
        if not context:
            return (own[x] + 1) / (n + 256)
        drawn = suffix_tree.WEIGHT * len(own)
        return (own[x] + drawn * p(context[1:], x)) / (n + drawn) if retained(context) else p(context[1:], x)

    @functools.cache
    def retained(context):
        own = after.get(context, Counter())
        n = sum(own.values())
        return n >= suffix_tree.LEAST and sum(c * math.log(c / n / p(context[1:], x)) for x, c in own.items()) >= suffix_tree.DIVERGENCE

    return {d: sum(math.log10(p(*at)) for at in placed(t)) for d, t in rows}, sum(retained(c) for c in after if c)


def test_suffix_tree_scores_across_words(spark, monkeypatch):
    """Scores equal those of a tree built by hand, whatever the blocks and the rows sent at a time; words predict the next ones."""
    monkeypatch.setattr(suffix_tree, "FREQUENT", 3)
    monkeypatch.setattr(suffix_tree, "BLOCK", 3000)
    monkeypatch.setattr(suffix_tree, "CHUNK", 500)
    monkeypatch.setattr(suffix_tree, "HELD", 64)
    monkeypatch.setattr(suffix_tree, "ROWS", 10)
    r = random.Random(14)
    tongues = [["ab", "c", "bca", "aabbcc"], ["xy", "Z", "é", "yz"]]
    rows = [(i, r.choice([" ", "\n", "\t  "]).join(r.choice(tongues[i % 2]) for _ in range(r.randint(0, 40)))) for i in range(120)] + [(900, "x" * 50_000), (901, None), (902, " \n ")]
    held = {d for d, _ in rows if zlib.crc32(str(d).encode()) % 7 == 2}
    want, states = suffix_tree_scores(rows, held)
    got = {x.doc_id: x.score for x in suffix_tree.score(frame(spark, rows)).collect()}
    assert states > 20 and len(got) == len(rows)
    for d, _ in rows:
        assert abs(got[d] - want[d]) < 1e-6 * max(1, abs(want[d]))
    monkeypatch.setattr(suffix_tree, "LEAST", 10**9)  # no context at all
    alone = {x.doc_id: x.score for x in suffix_tree.score(frame(spark, rows)).collect()}
    assert sum(got[d] for d in held - {900}) > sum(alone[d] for d in held - {900}) * 0.7


def test_pipeline_stages(spark):
    r = random.Random(13)
    prose = lambda n: " ".join(f"{r.choice(['lorem', 'ipsum', 'dolor'])}{r.randrange(9999)}" for _ in range(n))
    passage, near = prose(80), prose(100).split()
    rows = [(1, "too short"), (2, None), (3, prose(60) + " " + passage), (4, prose(60) + " " + passage), (5, " ".join(near)), (6, " ".join([*near[:-1], "other"])), (7, prose(50) + " write to some.one@mail.example.com today"), (8, "BUY!! " * 40)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, ""), name)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    ids = lambda name: {x.doc_id for x in seen[name].collect()}
    assert ids("quality_rules") == {3, 4, 5, 6, 7} and ids("near_duplicates") == {3, 4, 5, 7}
    texts = {x.doc_id: x.text for x in seen["repeated_passages"].collect()}
    assert passage[:300] not in texts[3] and passage[:300] not in texts[4] and texts[5] == " ".join(near)
    assert "[email]" in {x.doc_id: x.text for x in seen["personal_data"].collect()}[7]
    final = [(x.doc_id, x.text) for x in seen["personal_data"].collect()]
    check_packing(final, seen["packing"].withColumn("crc", F.crc32("ids")).collect())
    assert pii.KINDS and quality.RULES
