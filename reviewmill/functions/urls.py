"""URLs of reviews and pages, and what captured pages signal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCKED_KINDS = ("image", "media", "font")


def host_of(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def is_valid(u: Column, hosts: tuple[str, ...]) -> Column:
    """https, an allowed host or subdomain, no credentials."""
    h = host_of(u)
    allowed = F.lit(False)
    for a in hosts:
        allowed = allowed | (h == a) | h.endswith("." + a)
    return F.coalesce(u.startswith("https://") & ~u.rlike(r"^https://[^/?#]*@") & allowed, F.lit(False))


#: Parameters that only say how large a picture is.
SIZES = ("w", "h", "s", "size", "sz")


def strip_query(u: Column) -> Column:
    """A web address without its fragment and without parameters that don't only give a size; the last of equal names counts, at the place of the first. What isn't http or https stays as it is."""
    pairs = F.filter(F.split(F.regexp_extract(u, r"\?([^#]*)", 1), "&"), lambda p: F.lower(F.substring_index(p, "=", 1)).isin(*SIZES))
    name = lambda p: F.substring_index(p, "=", 1)
    names = F.array_distinct(F.transform(pairs, name))
    kept = F.transform(names, lambda n: F.element_at(F.filter(pairs, lambda p: name(p) == n), -1))
    plain = F.concat(F.regexp_extract(u, r"^([^?#]*)", 1), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(u.rlike("(?i)^https?://"), plain).otherwise(u)


def avatar(u: Column) -> Column:
    """The size suffix replaced by the one we show."""
    return F.regexp_replace(u, r"=s\d+[^/]*$", "=s128-c")


def listing_id(u: Column) -> tuple[Column, Column]:
    """(kind, id): place_id, else cid, else the hexadecimal cid of the path as an unsigned decimal."""
    place = F.regexp_extract(u, r"[?&](?:place_id|query_place_id)=([^&#]+)", 1)
    cid = F.regexp_extract(u, r"[?&]cid=(\d+)", 1)
    hexa = F.conv(F.regexp_extract(u, r"0x[0-9a-fA-F]+:0x([0-9a-fA-F]+)", 1), 16, 10)
    kind = F.when(place != "", "place_id").when(cid != "", "cid").when(F.coalesce(hexa, F.lit("")) != "", "cid")
    return kind, F.when(place != "", place).when(cid != "", cid).when(F.coalesce(hexa, F.lit("")) != "", hexa)


def is_blocked(kind: Column, host: Column, telemetry: tuple[str, ...] = ()) -> Column:
    return kind.isin(*BLOCKED_KINDS) | (host.isin(*telemetry) if telemetry else F.lit(False))


def classify_signals(page: Column, high: list[str], medium: list[str], consent: list[str]) -> Column:
    """What a lower-cased page says: one strong or two medium signs are a challenge, to be stopped at."""
    has = lambda words: sum((F.contains(page, F.lit(w)).cast("int") for w in words), F.lit(0))
    return F.when((has(high) >= 1) | (has(medium) >= 2), "ERR-BLOCKED-CHALLENGE").when(has(consent) >= 1, "ERR-NAV-CONSENT-WALL").when(has(medium) == 1, "ERR-NAV-SURFACE-NOT-FOUND")
