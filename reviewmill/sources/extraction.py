"""Reviews of captured pages by a selector pack, with what can't be used set apart.

A pack is the JSON document that operators write: ``containers`` (surface, review_node, reply_node), ``fields``, ``rating_stars``,
``truncation_markers`` and ``signals``; a container or field has strategies that are tried in order, each a selector, an attribute
(else the text is read) and a pattern whose first group is taken. ``read_pack`` compiles it. A strategy whose selector is beyond the supported part
of CSS never matches, as the next one has to be tried; it is listed in ``Pack.unsupported``, and ``strict`` raises instead.

The parser only reads; what a value means, what is required and what is set apart is decided by columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers
from .selectors import Selectors, UnsupportedSelector

# HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe".split())
PADDED = frozenset("address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


class _Tree(HTMLParser):
    """An end closes the nearest open element of its name; others are ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def text_of(node: Node, without: Node | None = None) -> str:
    out, todo = [], [node]
    while todo:
        at = todo.pop()
        if isinstance(at, str):
            out.append(at)
        elif at is not without and at.tag not in RAW:
            pad = [" "] if at.tag in PADDED else []
            todo.extend(reversed([*pad, *at.children, *pad]))
    return " ".join("".join(out).split())


@dataclass(frozen=True)
class Strategy:
    place: int
    selector: str
    attribute: str | None = None
    pattern: str | None = None

    def value(self, node: Node, without: Node | None) -> str | None:
        if self.attribute is None:
            raw = text_of(node, without)
        elif (raw := node.attrs.get(self.attribute)) is None:
            return None
        if self.pattern is None:
            return " ".join(raw.split())
        found = re.search(self.pattern, raw)
        return found and (found[1] if found.re.groups and found[1] is not None else found[0])


@dataclass
class Pack:
    surface: list[Strategy] | None
    node: list[Strategy]
    reply: list[Strategy]
    fields: dict[str, list[Strategy]]
    required: tuple[str, ...] = ()
    stars: tuple[str | None, str | None] = (None, None)
    markers: tuple[str, ...] = ()
    signals: dict = field(default_factory=dict)
    unsupported: list[tuple[str, int, str]] = field(default_factory=list)

    @property
    def of_review(self) -> list[str]:
        return [n for n in self.fields if not n.startswith("reply_")]

    @property
    def of_reply(self) -> list[str]:
        return [n for n in self.fields if n.startswith("reply_")]


def read_pack(pack: dict, strict: bool = False) -> Pack:
    """A pack from its JSON document."""
    unsupported: list[tuple[str, int, str]] = []

    def sound(name: str, place: int, selector: str) -> bool:
        try:
            Selectors([selector])
            return True
        except UnsupportedSelector as problem:
            if strict:
                raise UnsupportedSelector(f"{name}, strategy {place}: {problem}") from problem
            unsupported.append((name, place, selector))
            return False

    def strategies(name: str, spec: dict | None) -> list[Strategy]:
        found = (spec or {}).get("strategies", [])
        return [Strategy(k, s["selector"], s.get("attribute"), s.get("pattern")) for k, s in enumerate(found) if sound(name, k, s["selector"])]

    boxes, fields, stars = pack.get("containers", {}), pack.get("fields", {}), pack.get("rating_stars", {})
    counted = tuple(s if s and sound("rating_stars", k, s) else None for k, s in enumerate((stars.get("filled_selector"), stars.get("total_selector"))))
    return Pack(
        strategies("surface", boxes["surface"]) if "surface" in boxes else None, strategies("review_node", boxes.get("review_node")), strategies("reply_node", boxes.get("reply_node")),
        {n: strategies(n, spec) for n, spec in fields.items()}, tuple(n for n, spec in fields.items() if spec.get("required")), counted,
        tuple(pack.get("truncation_markers", ())), pack.get("signals", pack.get("detectors", {})), unsupported,
    )


def signal_of(page: Column, signals: dict) -> tuple[Column, Column]:
    """What a page's text says: the code of a page that mustn't be read (null otherwise), and whether it tells that there are no reviews."""
    low = F.lower(page)
    seen = {name: F.lit(False) for name in ("empty_state", "consent")}
    high = medium = F.lit(0)
    for name, s in signals.items():
        hit = F.coalesce(F.greatest(*(F.contains(low, F.lit(p.lower())) for p in s.get("patterns", ())), F.lit(False), F.lit(False)), F.lit(False))
        if name in seen:
            seen[name] = hit
        elif s.get("confidence") == "high":
            high = high + hit.cast("int")
        elif s.get("confidence") == "medium":
            medium = medium + hit.cast("int")
    code = F.when((high >= 1) | (medium >= 2), "ERR-BLOCKED-CHALLENGE").when(seen["consent"], "ERR-NAV-CONSENT-WALL").when(medium == 1, "ERR-NAV-SURFACE-NOT-FOUND")
    return code, seen["empty_state"]


def matches(pages: DataFrame, selectors: list[str], attribute: str = "href", id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, selector, n, first): how many elements of each page each selector matches, and that attribute of the first; an unsupported one raises. A null page has no elements."""
    kind, compiled = dict(pages.dtypes)[id_col], Selectors(selectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, html in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = compiled.find(parse(html or ""))
                first = [n[0].attrs.get(attribute) if n else None for n in found.values()]
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(found), key.type), pa.array(list(found)), pa.array([len(n) for n in found.values()], pa.int64()), pa.array(first, pa.string())], names=["id", "selector", "n", "first"])

    return pages.select(id_col, html_col).mapInArrow(run, f"id {kind}, selector string, n long, first string").withColumnRenamed("id", id_col)


FIELDS = "map<string,string>"
LOCATED = f"ordinal int, fields {FIELDS}, badges array<string>, stars int, reply {FIELDS}, strategies map<string,int>, error_code string"
_STRINGS, _PLACES = pa.map_(pa.string(), pa.string()), pa.map_(pa.string(), pa.int32())
_ARROW = (pa.int32(), _STRINGS, pa.list_(pa.string()), pa.int32(), _STRINGS, _PLACES, pa.string())


class _Reader:
    """Reads the pages of a partition: all selectors that are asked of a node are matched in one walk."""

    def __init__(self, pack: Pack):
        self.pack = pack
        surface = pack.surface or []
        self.outer = Selectors(s.selector for s in surface)
        self.nodes = Selectors(s.selector for s in pack.node)
        self.reply = Selectors(s.selector for s in pack.reply)
        self.inner = Selectors([*(s.selector for n in pack.of_review for s in pack.fields[n]), *(s for s in pack.stars if s)])
        self.said = Selectors(s.selector for n in pack.of_reply for s in pack.fields[n])

    @staticmethod
    def first(found: dict[str, list], strategies: list[Strategy]) -> list[Node]:
        return next((found[s.selector] for s in strategies if found[s.selector]), [])

    @staticmethod
    def resolve(found: dict[str, list], strategies: list[Strategy], without: Node | None = None) -> tuple[str | None, int | None]:
        """The value of the first strategy that has one, and its place; a strategy reads the first node it matches."""
        for s in strategies:
            if found[s.selector] and (value := s.value(found[s.selector][0], without)):
                return value, s.place
        return None, None

    def stars(self, found: dict[str, list]) -> int | None:
        filled, total = (len(found[s]) if s else 0 for s in self.pack.stars)
        return None if not filled or total and (total != 5 or filled > total) else filled

    def page(self, html: str) -> list[tuple]:
        pack, root = self.pack, parse(html)
        scope = root if pack.surface is None else next(iter(self.first(self.outer.find(root), pack.surface)), None)
        nodes = [] if scope is None else self.first(self.nodes.find(scope), pack.node)
        if not nodes:
            missing = scope is None or pack.surface is None or not pack.node
            return [(None, None, None, None, None, None, "ERR-PARSE-STRUCTURE" if missing else "ERR-PARSE-EMPTY-UNEXPECTED")]
        return [(k, *self.review(node), None) for k, node in enumerate(nodes)]

    def review(self, node: Node) -> tuple:
        pack = self.pack
        reply = next(iter(self.first(self.reply.find(node), pack.reply)), None)  # cut off before any field is read
        found = self.inner.find(node, reply)
        fields, strategies, badges = {}, {}, []
        for name in pack.of_review:
            if name == "author_badges":
                first = [s for s in pack.fields[name] if s.place == 0]
                badges = [t for s in first for n in found[s.selector] if (t := text_of(n, reply))]
                strategies[name] = first[0].place if badges else None
                continue
            fields[name], strategies[name] = self.resolve(found, pack.fields[name], reply)
        said = None
        if reply is not None:
            of_reply, said = self.said.find(reply), {}
            for name in pack.of_reply:
                said[name], strategies[name] = self.resolve(of_reply, pack.fields[name])
        keep = lambda m: [(k, v) for k, v in m.items() if v is not None]
        return keep(fields), badges, self.stars(found), None if said is None else keep(said), list(strategies.items())


def located(pages: DataFrame, pack: Pack, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """A row for each review node of each page: raw fields and the strategy that gave each; a page without its surface or nodes has one row that says so."""
    kind = dict(pages.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(pack)
        for batch in batches:
            for key, html in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                rows = reader.page(html or "")
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_ARROW)]
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(rows), key.type), *columns], names=["id", "ordinal", "fields", "badges", "stars", "reply", "strategies", "error_code"])

    return pages.select(id_col, html_col).mapInArrow(run, f"id {kind}, {LOCATED}").withColumnRenamed("id", id_col)


def without_marker(text: Column, markers: tuple[str, ...]) -> tuple[Column, Column]:
    """A text without the first of the markers that it ends with, and whether there was one; an empty text is null."""
    cut, short = text, F.lit(False)
    for m in reversed([m.strip() for m in markers if m.strip()]):
        ends = F.endswith(text, F.lit(m))
        cut = F.when(ends, F.rtrim(F.substring(text, F.lit(1), F.length(text) - len(m)))).otherwise(cut)
        short = ends | short
    return F.when(cut != "", cut), F.coalesce(short, F.lit(False))


def extracted(rows: DataFrame, language: Column, required: tuple[str, ...] = ("author_name",), emptied: Column | None = None, markers: tuple[str, ...] = ()) -> DataFrame:
    """located rows as reviews: rating (label, then stars, then the number), author, text and whether it was cut, relative date, counts, badges, the owner's reply,
    and quarantine (code, field) where a rating can't be read or a required field is missing. emptied: whether the page says that it has no reviews; then an
    empty surface is no error.
    """
    got = lambda k: F.col("fields")[k]
    rating = numbers.rating_of(got("rating"), F.col("stars"), got("rating_numeric"))
    present = F.coalesce(numbers.read_number(got("rating")), F.col("stars").cast("double"), numbers.read_number(got("rating_numeric")))
    problem = lambda code, name: F.struct(F.lit(code).alias("code"), F.lit(name).cast("string").alias("field"))
    bad = F.when(F.col("error_code").isNotNull(), F.struct(F.col("error_code").alias("code"), F.lit(None).cast("string").alias("field")))
    bad = bad.when(rating.isNull(), F.when(present.isNull(), problem("ERR-PARSE-FIELD-REQUIRED", "rating")).otherwise(problem("ERR-PARSE-RATING-INVALID", "rating")))
    for name in required:
        bad = bad.when(got(name).isNull(), problem("ERR-PARSE-FIELD-REQUIRED", name))
    if emptied is not None:
        rows = rows.where(~(emptied & (F.col("error_code") == "ERR-PARSE-EMPTY-UNEXPECTED")) | F.col("error_code").isNull())
    text, short = without_marker(got("text"), markers)
    return rows.withColumns({
        "rating": rating, "author_name": got("author_name"), "author_profile_url": got("author_profile_url"), "author_avatar_url": got("author_avatar_url"), "text": text, "text_truncated": short, "relative_date": got("relative_date"),
        "likes": numbers.read_count(got("likes"), language), "photo_count": numbers.read_count(got("photo_count"), language), "visited": got("visited"), "reply_text": F.col("reply")["reply_text"], "reply_date": F.col("reply")["reply_date"], "quarantine": bad,
    }).drop("fields", "reply", "error_code", "stars")


def extract_reviews(pages: DataFrame, pack: Pack, language: Column, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """All steps: a page that signals a challenge or a wall is never parsed and has one row with that code; the others are located, read and set apart."""
    code, emptied = signal_of(F.col(html_col), pack.signals)
    marked = pages.select(id_col, html_col).withColumns({"_code": code, "_emptied": emptied})
    open_pages, blocked = marked.where("_code IS NULL"), marked.where("_code IS NOT NULL")
    # The id of a page that tells it has no reviews carries that along.
    keyed = open_pages.select(F.struct(F.col(id_col).alias("id"), F.col("_emptied").alias("emptied")).alias("_key"), html_col)
    rows = located(keyed, pack, "_key", html_col).withColumns({id_col: F.col("_key.id"), "_emptied": F.col("_key.emptied")}).drop("_key")
    needed = tuple(n for n in ("author_name",) if n in pack.fields)
    found = extracted(rows, language, needed, F.col("_emptied"), pack.markers).drop("_emptied")
    said = blocked.select(id_col, F.struct(F.col("_code").alias("code"), F.lit(None).cast("string").alias("field")).alias("quarantine"))
    return found.unionByName(said, allowMissingColumns=True)


#: A captured subtree holds no document and no script.
_DOCUMENT, _SCRIPT = r"(?i)<(?:html|body|head)\b", r"(?i)<script\b"


def fixture_problems(html: Column) -> Column:
    """Why a captured page can't serve as a fixture, as an array; empty if it can. Null counts as empty."""
    h = F.coalesce(html, F.lit(""))
    problems = F.array(F.when(h.rlike(_DOCUMENT), "document-level element"), F.when(h.rlike(_SCRIPT), "script element"))
    return F.when(~h.rlike(r"\S"), F.array(F.lit("empty"))).otherwise(F.array_compact(problems))
