"""One text for each JSON value, whatever the order of its keys, and hashes of it.

Numbers are written as ECMAScript writes them and keys are ordered by UTF-16 units, so that hashes agree with those made by a
JavaScript engine. VARIANT sorts keys too, but writes numbers and control characters in Java's way and takes text
after the value, so values are walked here, in Arrow batches.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Levels of a value that are walked, at most.
DEEPEST = 200


class Refused(ValueError):
    """A value that has no canonical text."""


def number(x: int | float) -> str:
    """As ECMAScript's Number::toString."""
    x = float(x) if not isinstance(x, int) or abs(x) > 2**53 else x
    if isinstance(x, int):
        return str(x)
    if not math.isfinite(x):
        raise Refused("not finite")
    if x == 0:
        return "0"
    sign, digits = ("-" if x < 0 else ""), repr(abs(x))
    mantissa, _, power = digits.partition("e")
    whole, _, part = mantissa.partition(".")
    point = len(whole) + int(power or 0)
    all_digits = (whole + part).lstrip("0")
    point -= len(whole + part) - len((whole + part).lstrip("0"))
    all_digits = all_digits.rstrip("0")
    n = len(all_digits)
    if n <= point <= 21:
        return sign + all_digits + "0" * (point - n)
    if 0 < point <= 21:
        return f"{sign}{all_digits[:point]}.{all_digits[point:]}"
    if -6 < point <= 0:
        return f"{sign}0.{'0' * -point}{all_digits}"
    e = f"{'+' if point > 0 else '-'}{abs(point - 1)}"
    return f"{sign}{all_digits[0]}{'.' + all_digits[1:] if n > 1 else ''}e{e}"


def text(s: str) -> str:
    out = json.dumps(s, ensure_ascii=False)
    return "".join(f"\\u{ord(c):04x}" if 0xD800 <= ord(c) < 0xE000 else c for c in out) if any(0xD800 <= ord(c) < 0xE000 for c in out) else out


def canonical(value, depth: int = 0) -> str:
    if depth > DEEPEST:
        raise Refused("too deep")
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int | float):
        return number(value)
    if isinstance(value, str):
        return text(value)
    if isinstance(value, list):
        return f"[{','.join(canonical(x, depth + 1) for x in value)}]"
    keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
    return "{" + ",".join(f"{text(k)}:{canonical(value[k], depth + 1)}" for k in keys) + "}"


def _refuse(name: str):
    raise Refused(name)


def canonical_text(source: str | None) -> str | None:
    try:
        return None if source is None else canonical(json.loads(source, parse_constant=_refuse))
    except (ValueError, RecursionError, OverflowError):
        return None


@F.pandas_udf(StringType())
def canonical_json(s: pd.Series) -> pd.Series:
    """The canonical text of a JSON text; null if it is none, holds a number that isn't finite or is nested too deeply. Of equal keys the last counts."""
    return s.map(canonical_text)


def hash_of(value: Column) -> Column:
    """SHA-256 of a JSON text's canonical form; null where there is none."""
    return F.sha2(canonical_json(value), 256)
