"""Identity and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, collapse

UNIT = "\x1f"
ALGORITHM = 1


def join_for_hash(parts: list[Column]) -> Column:
    """Parts escaped (backslash, then unit separator) and joined by the unit separator; null counts as empty."""
    safe = [F.replace(F.replace(F.coalesce(p.cast("string"), F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit(UNIT), F.lit("\\u")) for p in parts]
    return F.concat_ws(UNIT, *safe)


def digest(parts: list[Column]) -> Column:
    return F.left(F.sha2(join_for_hash(parts), 256), F.lit(32))


def text_digest(text: Column) -> Column:
    """Of the first 512 graphemes, lower-cased and collapsed; null as the empty text."""
    return digest([collapse(F.lower(bound(F.coalesce(text, F.lit("")), 512)))])


def fold_author(name: Column) -> Column:
    """Lower-case, marks and punctuation dropped, collapsed."""
    c = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"\p{Mn}", "")
    return collapse(F.regexp_replace(collapse(c), r"[\p{P}\p{S}]", ""))


def author_key(name: Column, listing: Column, text: Column) -> Column:
    """By folded name; authors without one are told apart by listing and text, so that no bucket holds them all."""
    folded = fold_author(name)
    return F.when(folded != "", digest([F.lit("author"), folded])).otherwise(digest([F.lit("anon"), listing, text_digest(text)]))


def identity_hash(listing: Column, source: Column, author: Column, text: Column, rating: Column) -> Column:
    return digest([F.lit(ALGORITHM), listing, F.lower(source), author, text_digest(text), rating])


def canonical_json(fields: dict[str, Column]) -> Column:
    """Keys sorted, nulls kept."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def content_hash(fields: dict[str, Column]) -> Column:
    return F.sha2(canonical_json(fields), 256)
