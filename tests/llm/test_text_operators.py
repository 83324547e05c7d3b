"""Quality rules, personal data, BPE, HTML and URLs against plain brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from reviewmill.llm import bpe, html_text, pii, quality, urls

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def frame(spark, rows, **extra):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"n_words": F.lit("clash"), "spans": F.lit(1), "ids": F.lit(None).cast("int")})


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c " * 40), (5, "a b c " * 40), (None, "null id 1.2.3.4"), (7, "x" * 50_000), (8, "été 🙂 " * 30)]


def brute_quality(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    cover = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover)


def test_quality_measures(spark):
    r = random.Random(1)
    rows = ODD + [(100 + i, "".join(r.choice(["a ", "b ", "c\n", "#d ", "<e> ", "a b c d e f g h i "]) for _ in range(r.randint(0, 120)))) for i in range(40)]
    got = quality.ledger(frame(spark, rows)).collect()
    want = sorted((d is not None, d or 0, *brute_quality(t)) for d, t in rows)
    assert sorted((x.doc_id is not None, x.doc_id or 0, *(x[m] for m in quality.MEASURES[:5])) for x in got) == want


def test_policies_and_ablation(spark):
    rows = quality.ledger(frame(spark, ODD + [(9, " ".join(f"word{i}" for i in range(50)))])).cache()
    kept = {x.doc_id for x in rows.where(quality.verdict(quality.POLICIES["v1"])).collect()}
    assert kept == {9}
    got = {x.rule: x for x in quality.ablation(rows, quality.BASE).collect()}
    bits = [x.fail_bits for x in rows.collect()]
    for rule in quality.BASE.rules:
        b = quality.BIT[rule]
        assert got[rule].n_failed == sum(x & b != 0 for x in bits)
        assert got[rule].n_only == sum(x & quality.BASE.mask == b for x in bits)
        assert got[rule].n_kept_without == sum(x & quality.BASE.mask & ~b == 0 for x in bits)


def luhn(m):
    d = [int(c) for c in m if c.isdigit()]
    return 12 <= len(d) <= 19 and sum(c if i % 2 == 0 else c * 2 - 9 * (c > 4) for i, c in enumerate(reversed(d))) % 10 == 0


GRAMMAR = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", luhn),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c.isdigit() for c in m) <= 15),
}


def brute_pii(t):
    out = sorted((m.start(), k, m.end(), n) for k, (n, (g, ok)) in enumerate(GRAMMAR.items()) for m in re.finditer(g, t or "") if ok(m.group()))
    return hashlib.sha256(",".join(f"{n}:{a}:{b}" for a, _, b, n in out).encode()).hexdigest(), *(sum(n == k for *_, n in out) for k in GRAMMAR)


def test_personal_data(spark):
    r = random.Random(2)
    bits = ["a@b.co", "x.y@z", "@", "1.2.3.4", "300.1.1.1", ".5", "4111 1111 1111 1111", "4111-1111", "+1 (23) 555-0000", "+", "12", " ", "é", "🙂", "_", "-", "\n", "token = \"abe29cfcdae4f03e1e339fcaa4c5bb6c83ba0102\" "]
    rows = ODD + [(100 + i, "".join(r.choice(bits) for _ in range(r.randint(0, 60)))) for i in range(150)] + [(900, "1.2.3.4 " * 400)]
    got = pii.digest(pii.find(frame(spark, rows))).collect()
    assert sorted((x.doc_id or 0, x.base_sha256, x.n_email, x.n_ip, x.n_card, x.n_phone) for x in got) == sorted((d or 0, *brute_pii(t)) for d, t in rows)


def test_model_adds_secrets_and_leaves_prose_alone(spark):
    secret = 'the key token = "abe29cfcdae4f03e1e339fcaa4c5bb6c83ba0102" end'
    rows = [(1, secret), (2, "Plain prose with internationalization and words of every length, 2024-01-02, page 12."), (3, "mail me: some.one@mail.example.com now")]
    got = {x.doc_id: x.spans for x in pii.digest(pii.find(frame(spark, rows))).collect()}
    assert got[1] == "secret:17:57" and got[2] == "" and got[3].startswith("email:")
    text = {x.doc_id: x.text for x in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert text == {1: 'the key token = "[secret]" end', 2: rows[1][1], 3: "mail me: [email] now"}


def test_bpe_is_tiktoken_and_round_trips(spark):
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks_of(PATH), special_tokens={})
    r = random.Random(3)
    parts = ["a", "the", "tion", "é", "  ", " ", "\n", "\t", "\u00a0", "的", "🙂", "##", "aaaa", "1", "<|endoftext|>", "'ll"]
    rows = ODD + [(100 + i, "".join(r.choice(parts) for _ in range(r.randint(0, 90)))) for i in range(120)]
    got = bpe.decode(bpe.encode(frame(spark, rows), PATH, PATTERN), PATH, PATTERN).collect()
    want = sorted(((t or "").encode(), b"".join(i.to_bytes(4, "little") for i in enc.encode_ordinary(t or ""))) for _, t in rows)
    assert sorted((bytes(x.bytes), bytes(x.ids)) for x in got) == want
    assert all(x.n_tokens == len(x.ids) // 4 for x in got)


def test_bpe_tree_joins_any_cut():
    c = bpe.Codec(PATH, PATTERN)
    r = random.Random(4)
    for _ in range(400):
        b = "".join(r.choice(["a", "aa", "th", "er", "é", "x"]) for _ in range(r.randint(2, 60))).encode()
        k = r.randint(1, len(b) - 1)
        assert c.join(c.encode_bytes(b[:k]), c.encode_bytes(b[k:])) == c.heap(b) == c.encode_bytes(b)


def test_html(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Menu</ul></nav>
    <div class="ad">Buy</div><article><h1>Head &amp; more</h1><p>First   para<br>graph <b>bold<p>Second &lt;p&gt; one</p></article>
    <section id="comments"><p>Nice!</p></section><form><p>mail</p></form><aside>x</aside><script>var t="</p>";</script><footer>F</footer></body></html>"""
    loose = "<div class=menu>a b c</div><h1>Title</h1><p>" + "Long text here. " * 10 + "</p><p>Short.</p><p>" + "And more of the text. " * 9 + "</p><div id=sidebar>s</div>"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", loose), (None, "u", "<p>only"), (4, "u", loose)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(9))
    got = html_text.extract(df).collect()
    assert len(got) == 6 and all(x.n_chars == len(x.text) for x in got)
    by = {x.page_id: x.text for x in got}
    assert by[1] == "Head & more\nFirst para graph bold\nSecond <p> one" and by[2] == "" and by[3] == "" and by[None] == "only"
    assert by[4] == "Title\n" + ("Long text here. " * 10).strip() + "\nShort.\n" + ("And more of the text. " * 9).strip()
    assert html_text.extract(df.limit(0)).count() == 0


def test_html_keeps_short_parts_of_marked_and_loose_pages():
    long = "A long body with many words in it. " * 60
    cut = f"<article><h1>Head</h1><p>Lead.</p><div class=ad>Buy</div><p>{long}</p><form>mail</form><p>Close.</p></article><article><p>Brief.</p></article>"
    assert html_text.main_text(cut) == f"Head\nLead.\n{long.strip()}\nClose.\nBrief."
    paragraphs = [f"Paragraph {k} of some thirty words or so, " + "as they stand on most pages. " * 6 for k in range(30)]
    loose = "".join(f"<p>{x}</p>" for x in [*paragraphs, long * 20])
    assert html_text.main_text(loose).split("\n") == [x.strip() for x in [*paragraphs, long * 20]]


def random_page(r, marked):
    """(html, the article's text): an article among everything that is none of it, some of it inside the article."""
    words = lambda a, b: " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(1, 9))) for _ in range(r.randint(a, b)))
    inline = lambda t: t if r.random() < 0.5 else f"<b>{t}</b>" if r.random() < 0.5 else f"<a href='x'><i>{t}</i></a>"
    noise = [
        lambda: f"<div class='ad'>{words(3, 20)}</div>", lambda: f"<form><label>{words(1, 4)}</label><input></form>", lambda: f"<aside><p>{words(5, 30)}</p></aside>", lambda: f"<script>var a = '<p>{words(3, 9)}</p>';</script>",
        lambda: f"<div id=cookie-notice>{words(5, 15)}<button>ok</button></div>", lambda: "<!-- <p>hidden</p> -->", lambda: f"<style>p {{ content: '{words(2, 5)}' }}</style>", lambda: f"<nav><a href=/>{words(1, 2)}</a></nav>",
    ]
    blocks, out = [words(3, 8)], ["<h1>" + "{0}</h1>"]
    for k in range(r.randint(2, 25)):
        blocks.append(words(8, 90) + (" &amp; more" if r.random() < 0.2 else "") if k % 4 else words(1, 60))
        out.append(f"<p>{{{k + 1}}}" + ("</p>" if r.random() < 0.7 else ""))
        if marked and r.random() < 0.15:
            out.append(r.choice(noise)().replace("{", "{{").replace("}", "}}"))
    body = "".join(out).format(*map(inline, blocks))
    around = lambda n: "".join(r.choice(noise)() for _ in range(n))
    tag = r.choice(["article", "main"]) if marked else "div"
    menu = "<nav><ul>" + "".join(f"<li><a href=/{k}>{words(1, 1)}</a></li>" for k in range(6)) + "</ul></nav>"
    html = f"<!DOCTYPE html><html><head><title>{words(2, 5)}</title></head><body><header>{words(2, 6)}</header>{menu}{around(3)}<{tag}>{body}</{tag}>{around(2)}<section id=comments><p>{words(5, 60)}</p></section><footer>&copy; {words(2, 9)}</footer></body></html>"
    return html, "\n".join(b.replace("&amp;", "&") for b in blocks)


def test_html_against_pages_of_known_text():
    r = random.Random(21)
    for _ in range(150):
        html, text = random_page(r, True)
        assert html_text.main_text(html) == text
    found = total = extra = 0
    for _ in range(150):
        html, text = random_page(r, False)
        got, want = html_text.main_text(html).split("\n"), text.split("\n")
        found, total, extra = found + sum(len(x) for x in want if x in got), total + sum(map(len, want)), extra + sum(len(x) for x in got if x not in want)
    assert found >= 0.97 * total and extra <= 0.02 * total


def test_html_ratios_by_definition():
    r = random.Random(22)
    for _ in range(50):
        x = np.array([r.choice([0.0, r.random(), 5 * r.random()]) for _ in range(r.randint(1, 40))])
        weight = lambda d: math.exp(-d * d / 8) if abs(d) <= 6 else 0.0
        want = [sum(weight(i - j) * x[j] for j in range(len(x))) / sum(weight(i - j) for j in range(len(x))) for i in range(len(x))]
        assert np.allclose(html_text.smoothed(x), want)
        if x.max() > 0:
            cut = html_text.threshold(x)
            high = x[x >= cut]
            assert len(high) and abs(high.mean() / 2 - cut) < 1e-12  # each value is nearer to its own cluster's centre
    assert html_text.main_text("<article><p>" + "very long " * 60_000 + "</p></article>") == ("very long " * 60_000).strip()


def brute_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group().translate({c: c + 32 for c in range(65, 91)})
        path = re.match(r"[^?#]*", rest[re.match(r"[^/?#]*", rest).end() :], re.S).group()
    fits = [(len(r), r, v) for v, r in urls.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_urls(spark):
    given = [None, "", "no scheme", "http://", "http://a.com", "https://WWW.Example.com/en/x?a=1#f", "http://blog.example.com/en/1", "http://xexample.com/en/1", "http://a.net/es/1", "http://a.net/fr", "http://a.net/fr/\n?x", "http://b.org/en", "ftp://a:80/x://y", "http://net/es/", "http://a.com/" + "x" * 60_000]
    rows = [(i, u) for i, u in enumerate(given)] + [(100 + i, f"http://adult{i % 3}.example.com/en/{i}") for i in range(60)] + [(300 + i, f"http://site{i % 7}.com/de/{i}") for i in range(60)]
    got = {x.page_id: x for x in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string").withColumns({k: F.lit(1) for k in ("host", "path", "rule", "said", "h", "y", "blocked_probability")})).collect()}
    for i, u in rows:
        host, path, rule, said = brute_rule(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict in ("allow", "block") and (said is None or got[i].verdict == said)
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_repeated_pages_are_judged_and_extracted_alike(spark):
    """Each of the repeated rows has its own result, and all of them the same, with null ids too."""
    some = [f"http://site{i % 5}.{'com' if i % 2 else 'net'}/{'en' if i % 3 else 'es'}/{i}?q={i * i}" for i in range(40)]
    rows = [(i % 20 or None, u, f"<nav>menu</nav><p>{u} {'words of the page ' * (i % 7)}</p>") for i, u in enumerate(some)] * 3
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for got in (urls.filter_urls(df).select("page_id", "host", "path", "rule", "verdict"), html_text.extract(df).select("page_id", "url", "text", "n_chars")):
        times = Counter(map(tuple, got.collect()))
        assert sum(times.values()) == len(rows) and set(times.values()) == {3}


def test_url_trees_learn_held_out_labels(spark):
    """Labels withheld from training are found again by the trees alone."""
    rows = [(i, f"http://{'shop-deal' if i % 2 else 'paper'}{i % 9}.com/{'buy/now' if i % 2 else 'article'}/{i}{'?ref=1&x=2' if i % 2 else ''}") for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    rules = (*((("block" if k % 2 else "allow"), f"{'shop-deal' if k % 2 else 'paper'}{k % 9}.com/") for k in range(0, 10)),)
    got = urls.filter_urls(df, rules=rules).where("rule IS NULL").collect()
    right = sum((x.verdict == "block") == (x.page_id % 2 == 1) for x in got)
    assert len(got) > 50 and right >= 0.9 * len(got)


@pytest.mark.parametrize("run", [lambda d: quality.ledger(d), lambda d: pii.digest(pii.find(d)), lambda d: bpe.decode(bpe.encode(d, PATH, PATTERN), PATH, PATTERN)])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string")).count() == 0
