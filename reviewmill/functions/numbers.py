"""Numbers, versions and counts read from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Languages that group digits by points.
POINT_GROUPED = ("de", "es", "pt", "it", "nl", "tr", "id", "da")


def half_up(x: Column, places: int) -> Column:
    """floor(x * p + 0.5) / p: halves go up, also below zero."""
    p = float(10**places)
    return F.floor(x * p + F.lit(0.5)).cast("double") / p


def read_number(c: Column) -> Column:
    """The first signed number, with a comma or point."""
    return F.regexp_replace(F.regexp_extract(c, r"(-?\d+(?:[.,]\d+)?)", 1), ",", ".").try_cast("double")


def read_count(c: Column, language: Column) -> Column:
    """A count with its language's grouping, spaces of any width included; null if there is none, if it is below zero or if a decimal mark is left."""
    found = F.regexp_replace(F.regexp_extract(c, r"(-?\d[\d.,\u00A0\u202F\u2009 ]*)", 1), r"[\u00A0\u202F\u2009\s]", "")
    plain = F.when(F.lower(F.substring(language, 1, 2)).isin(*POINT_GROUPED), F.replace(found, F.lit("."), F.lit(""))).otherwise(F.replace(found, F.lit(","), F.lit("")))
    value = F.when(plain.rlike(r"^\d+$"), plain.try_cast("long"))
    return F.when(value <= (1 << 53) - 1, value)


def rating_of(label: Column, stars: Column, numeric: Column) -> Column:
    """The first present value decides; then it must be a whole 1 to 5."""
    value = F.coalesce(read_number(label), stars.cast("double"), read_number(numeric))
    return F.when((value == F.floor(value)) & value.between(1, 5), value.cast("int"))


def valid_rating(c: Column) -> Column:
    return F.coalesce((c == F.floor(c)) & c.between(1, 5), F.lit(False))


def compare_versions(a: Column, b: Column) -> Column:
    """-1, 0 or 1 by dotted numeric parts, however many; a missing part is 0."""
    parts = lambda v: F.transform(F.split(F.coalesce(v, F.lit("")), r"\."), lambda x: F.coalesce(x.try_cast("long"), F.lit(0)))
    steps = F.zip_with(parts(a), parts(b), lambda x, y: F.signum(F.coalesce(x, F.lit(0)) - F.coalesce(y, F.lit(0))).cast("int"))
    return F.coalesce(F.get(F.filter(steps, lambda s: s != 0), F.lit(0)), F.lit(0))


def backoff_ms(base: int, attempt: Column, most: int) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt - 1), F.lit(most)).cast("long")


def scroll_step(height: Column, ratio: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(height * F.least(F.greatest(ratio, F.lit(0.1)), F.lit(1.0)))).cast("long")
