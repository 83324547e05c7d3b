"""Selectors against a plain reading of CSS, and extraction by packs."""

import random

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import numbers
from reviewmill.sources import extraction, selectors
from reviewmill.sources.extraction import parse


def fits(part, node):
    """A compound on its own, by rules written out once more."""
    compound = selectors.parse(part)[0][0]
    return compound.fits(node.tag, node.attrs)


def plain(root, selector):
    """Every element tried against every way to place the parts on its ancestors."""

    def placed(parts, path):
        if not parts:
            return True
        *rest, (link, part) = parts
        at = [len(path) - 1] if link == ">" else range(len(path))
        return any(path[k] is not None and fits(part, path[k]) and placed(rest, path[:k]) for k in at if k >= 0 and (link != ">" or k == len(path) - 1))

    def chain(text):
        out, link = [], " "
        for token in text.replace(">", " > ").split():
            if token == ">":
                link = ">"
            else:
                out.append((link, token))
                link = " "
        return [(out[k + 1][0] if k + 1 < len(out) else "end", p) for k, (_, p) in enumerate(out)]

    def matches(node, path):
        for group in selector.split(","):
            parts = chain(group)
            if fits(parts[-1][1], node) and placed([(link, p) for link, p in parts[:-1]], path):
                return True
        return False

    found = []

    def walk(node, path):
        for c in node.children:
            if not isinstance(c, str):
                if matches(c, [*path, node]):
                    found.append(c)
                walk(c, [*path, node])

    walk(root, [])
    return found


def tree(r, depth=0):
    inner = "".join(tree(r, depth + 1) for _ in range(r.randint(0, 3))) if depth < 6 else ""
    return f"<{(t := r.choice(['div', 'p', 'b']))} class='{r.choice(['x', 'y', 'x y', ''])}' id={r.choice('mn')}>{inner}</{t}>"


@pytest.mark.parametrize("seed", range(6))
def test_selectors_match_css(seed):
    r = random.Random(seed)
    root = parse("".join(tree(r) for _ in range(4)).replace("<p ", "<u ").replace("</p>", "</u>"))
    parts = ["div", "u", "b", ".x", ".y", "#m", "div.x", "*", "[class]", "[class$=y]", ".x.y"]
    asked = [", ".join("".join(r.choice([" ", " > ", " "]) * (k > 0) + r.choice(parts) for k in range(r.randint(1, 4))) for _ in range(r.randint(1, 2))) for _ in range(40)]
    together = selectors.Selectors(asked).find(root)
    for s in asked:
        want = plain(root, s)
        assert [id(n) for n in together[s]] == [id(n) for n in want], s
        assert [id(n) for n in selectors.select(root, s)] == [id(n) for n in want]


def test_a_farther_ancestor_may_fit():
    root = parse("<i><b><u><b><em>x</em></b></u></b></i>")
    assert len(list(selectors.select(root, "i > b em"))) == 1


@pytest.mark.parametrize("selector", ["", "  ", "a:first-child", "a + b", "a ~ b", "[a~=b]", "[a|=b]", "a >", "> a", "a > > b", "a,", ",a", "[a", "[a='b]", ".x p:not(.y)", "a]", ".", "[role='article'] > :first-child a[href*='/contrib/']"])
def test_unsupported_selectors_raise(selector):
    with pytest.raises(selectors.UnsupportedSelector):
        selectors.Selectors([selector])


def test_blanks_and_marks_inside_quotes():
    root = parse("""<p aria-label="Review by Ann, a > b"><i aria-label=x></i></p>""")
    for s in ("[aria-label^='Review by']", """[ aria-label = "Review by Ann, a > b" ]""", "[aria-label*=', a > b']", "P[aria-label]"):
        assert [n.tag for n in selectors.select(root, s)] == ["p"]
    assert not list(selectors.select(root, "[aria-label^='']")) and len(list(selectors.select(root, "[aria-label]"))) == 2


def ways(*found):
    return {"strategies": [dict(zip(("selector", "attribute", "pattern"), w, strict=False)) for w in found]}


PACK = {
    "containers": {"surface": ways(("[role='main'] [role='feed']",), ("[data-review-list]",)), "review_node": ways(("[role='article']",)), "reply_node": ways(("[data-owner-reply]",), ("[role='article'] [role='comment']",))},
    "fields": {
        "author_name": {"required": True, **ways(("[aria-label^='Review by']", "aria-label", "^Review by (.+)$"), ("[role='article'] > :first-child a",), (".author",))}, "author_badges": ways(("[data-badge]",)), "author_avatar_url": ways(("a[href*='/contrib/'] img", "src")),
        "rating": ways(("[role='img'][aria-label]", "aria-label", "([0-9](?:[.,][0-9])?)")), "rating_numeric": ways((".number",)), "text": ways(("[lang]",)), "likes": ways(("[data-likes]",)), "reply_text": ways(("[role='comment'] [lang]",), ("[lang]",)),
    },
    "rating_stars": {"filled_selector": "[role='img'] [data-on]", "total_selector": "[role='img'] [data-star]"}, "truncation_markers": ["…More", "More"],
    "signals": {"challenge": {"patterns": ["verify you are human"], "confidence": "high"}, "empty_state": {"patterns": ["No reviews yet"]}},
}


def test_packs(spark):
    star, on = "<b data-star></b>", "<b data-star data-on></b>"
    article = lambda inside: f"<div role=article>{inside}</div>"
    pages = [
        article("<u aria-label='Review by Ann'></u><i role=img aria-label='4 stars'></i><p lang=en>Good  food\n…More</p><div role=comment><p lang=en>Thanks</p></div><s data-badge>Guide</s><s data-badge> </s><s data-badge>Top</s><q data-likes>1 234</q>"),
        article(f"<a class=author href='/contrib/1'>Bob<img src=b.png></a><i role=img>{on * 3}{star * 2}</i><p lang=en>More</p>"),
        article(f"<a class=author>Cy</a><i role=img>{on * 3}{star}</i><i class=number>2,0</i>"),
        article("<a class=author>Di</a><i role=img aria-label='4.3'></i>") + article("<i role=img aria-label='5'></i>"),
        article("<a class=author>Ed</a><i role=img aria-label='no digits'></i>"),
    ]
    rows = [(k, f"<div role=main><div role=feed>{p}</div></div>") for k, p in enumerate(pages)]
    rows += [(10, "<div role=main><div role=feed>no REVIEWS yet</div></div>"), (11, "<div data-review-list></div>"), (12, "<p>nothing</p>"), (13, "Verify you are HUMAN<div role=feed></div>"), (14, None)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumns({"_key": F.lit(1), "fields": F.lit("x")})
    pack = extraction.read_pack(PACK)
    assert pack.unsupported == [("author_name", 1, "[role='article'] > :first-child a")]
    with pytest.raises(selectors.UnsupportedSelector):
        extraction.read_pack(PACK, strict=True)
    got = {(x.page_id, x.ordinal): x for x in extraction.extract_reviews(df, pack, F.lit("en")).collect()}
    assert set(got) == {(0, 0), (1, 0), (2, 0), (3, 0), (3, 1), (4, 0), (11, None), (12, None), (13, None), (14, None)}
    a, b = got[0, 0], got[1, 0]
    assert (a.rating, a.author_name, a.text, a.text_truncated, a.reply_text, a.badges, a.likes, a.quarantine) == (4, "Ann", "Good food", True, "Thanks", ["Guide", "Top"], 1234, None)
    assert a.strategies["author_name"] == 0 and b.strategies["author_name"] == 2 and b.strategies["author_badges"] is None
    assert (b.rating, b.author_name, b.text, b.text_truncated, b.author_avatar_url) == (3, "Bob", None, True, "b.png")
    assert got[2, 0].rating == 2 and got[2, 0].quarantine is None
    codes = {k: tuple(x.quarantine) for k, x in got.items() if x.quarantine}
    assert codes == {
        (3, 0): ("ERR-PARSE-RATING-INVALID", "rating"), (3, 1): ("ERR-PARSE-FIELD-REQUIRED", "author_name"), (4, 0): ("ERR-PARSE-FIELD-REQUIRED", "rating"), (11, None): ("ERR-PARSE-EMPTY-UNEXPECTED", None),
        (12, None): ("ERR-PARSE-STRUCTURE", None), (13, None): ("ERR-BLOCKED-CHALLENGE", None), (14, None): ("ERR-PARSE-STRUCTURE", None),
    }


def test_counts_of_any_grouping(spark):
    rows = [("1.234", "de", 1234), ("1,234 likes", "en", 1234), ("12 345", "fr", 12345), ("1 234", "pt-BR", 1234), ("1.5", "en", None), ("-3", "en", None), ("none", "en", None), (None, "en", None), ("99999999999999999", "en", None)]
    df = spark.createDataFrame(rows, "raw string, lang string, want long")
    assert [x.got for x in df.select(numbers.read_count(F.col("raw"), F.col("lang")).alias("got")).collect()] == [w for _, _, w in rows]


def test_fixture_problems(spark):
    rows = [(None, ["empty"]), (" \n", ["empty"]), ("<div>x</div>", []), ("<BODY><script>", ["document-level element", "script element"]), ("<header>", [])]
    df = spark.createDataFrame(rows, "html string, want array<string>")
    assert [x.p for x in df.select(extraction.fixture_problems(F.col("html")).alias("p")).collect()] == [w for _, w in rows]
