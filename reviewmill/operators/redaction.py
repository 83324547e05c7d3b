"""Nested log records as they may be written.

Records are JSON texts of any shape. All secrets are found in one pass by an automaton; where they overlap the longer one
counts. What a name means is decided by the name as it came, and names are scrubbed like values.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Names in log records, by what is done with them.
FORBIDDEN = re.compile(r"(authorization|cookie|set-cookie|storage_state|storagestate)", re.I)
SENSITIVE = re.compile(r"token|secret|key|password|cookie|auth|credential|refresh", re.I)
TEXT = re.compile(r"(text|review_text|body|reviewbody|snippet)", re.I)
AUTHOR = re.compile(r"(author_name|authorname|reviewer_name|name)", re.I)
SIZES = ("w", "h", "s", "size", "sz")
TEXT_LIMIT, DEPTH, SHORT = 120, 8, 6


def mask(label: str) -> str:
    return f"«redacted:{label}»"


def scrubber(secrets: dict[str, str]) -> Callable[[str], str]:
    """Replaces every secret by its label; one under six characters only where it is all of a text."""
    import ahocorasick

    short, found = {}, ahocorasick.Automaton()
    for label, secret in sorted(secrets.items()):
        if secret and len(secret) < SHORT:
            short.setdefault(secret, label)
        elif secret and secret not in found:
            found.add_word(secret, (len(secret), label))
    if len(found):
        found.make_automaton()

    def scrub(t: str) -> str:
        if t in short:
            return mask(short[t])
        if not len(found):
            return t
        hits = sorted(((-n, end - n + 1, end + 1, label) for end, (n, label) in found.iter(t)))
        taken: list[tuple[int, int, str]] = []
        for _, a, b, label in hits:
            if all(b <= x or y <= a for x, y, _ in taken):
                taken.append((a, b, label))
        out, at = [], 0
        for a, b, label in sorted(taken):
            out += [t[at:a], mask(label)]
            at = b
        return "".join([*out, t[at:]])

    return scrub


def strip_query(t: str) -> str:
    """A web address without its fragment and the parameters that don't only give a size."""
    if not re.match(r"https?://", t, re.I):
        return t
    base, _, query = t.partition("#")[0].partition("?")
    kept = {k: v for k, _, v in (p.partition("=") for p in query.split("&")) if k.lower() in SIZES}
    return base + ("?" + "&".join(f"{k}={v}" for k, v in kept.items()) if kept else "")


def walk(value, scrub: Callable[[str], str], depth: int = 0):
    if depth > DEPTH:
        return mask("depth")
    if isinstance(value, str):
        return scrub(strip_query(value))
    if isinstance(value, list):
        return [walk(x, scrub, depth + 1) for x in value]
    if not isinstance(value, dict):
        return value
    out = {}
    for name, x in value.items():
        if FORBIDDEN.fullmatch(name):
            continue
        if SENSITIVE.search(name):
            kept = mask(name)
        elif isinstance(x, str) and TEXT.fullmatch(name):
            kept = scrub(x)
            kept = kept if len(kept) <= TEXT_LIMIT else kept[:TEXT_LIMIT] + "…"
        elif isinstance(x, str) and AUTHOR.fullmatch(name):
            kept = mask("author")
        else:
            kept = walk(x, scrub, depth + 1)
        out[scrub(name)] = kept
    return out


def redacted(record: Column, secrets: dict[str, str] | None = None) -> Column:
    """A JSON record as it may be written; what is no JSON is scrubbed as one text, null stays null."""
    known = dict(secrets or {})

    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        scrub = scrubber(known)

        def one(t: str | None) -> str | None:
            if t is None:
                return None
            try:
                value = json.loads(t)
            except (ValueError, RecursionError):
                return scrub(strip_query(t))
            return json.dumps(walk(value, scrub), ensure_ascii=False, separators=(",", ":"))

        return s.map(one)

    return run(record)
