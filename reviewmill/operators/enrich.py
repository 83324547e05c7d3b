"""Functions of the user's that annotate reviews; what fails leaves its row as it is.

A function takes a pandas frame of reviews and returns a frame of the same length with columns for some of the ten fields it may write. Where it
raises, the batch is halved until the rows that make it raise stand alone; all others get their annotations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runs import AI_FIELDS

Enricher = Callable[[pd.DataFrame], pd.DataFrame]

#: Rows that the functions get at once: what they return and its copies grow with these, not with a batch of Spark's.
ROWS = 256


def attempt(fn: Enricher, frame: pd.DataFrame) -> list[tuple[pd.DataFrame | None, int]]:
    """(annotations, rows) of each part of the frame in order; None where the function raised on a single row or gave another number of rows."""
    try:
        out = fn(frame.reset_index(drop=True))
        if len(out) != len(frame):
            raise ValueError(f"{len(out)} rows for {len(frame)}")
        return [(out.reset_index(drop=True), len(frame))]
    except Exception:  # whatever it is, the review survives
        if len(frame) == 1:
            return [(None, 1)]
        half = len(frame) // 2
        return attempt(fn, frame.iloc[:half]) + attempt(fn, frame.iloc[half:])


def absent(x) -> bool:
    return x is None or isinstance(x, float) and x != x


def enriched(reviews: DataFrame, enrichers: dict[str, Enricher]) -> DataFrame:
    """reviews with ai (null if no function gave anything; of several the later one's fields count), ai_failed (functions that failed on the row) and ai_rejected (columns
    they returned that are none of the ten). Functions are named; they run in the order of the dict.
    """
    if not enrichers:
        return reviews
    names = reviews.columns
    schema = ", ".join(f"{k} {t}" for k, t in AI_FIELDS.items())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in (whole.iloc[at : at + ROWS] for whole in frames for at in range(0, len(whole), ROWS)):
            ai: list[dict] = [{} for _ in range(len(frame))]
            failed: list[list[str]] = [[] for _ in range(len(frame))]
            rejected: list[list[str]] = [[] for _ in range(len(frame))]
            for name, fn in enrichers.items():
                at = 0
                for out, n in attempt(fn, frame):
                    if out is None:
                        failed[at].append(name)
                    else:
                        other = sorted(c for c in out.columns if c not in AI_FIELDS)
                        known = [c for c in out.columns if c in AI_FIELDS]
                        for k, row in enumerate(out[known].to_dict("records")):
                            ai[at + k] |= {c: v for c, v in row.items() if not absent(v)}
                            rejected[at + k] += other
                    at += n
            result = frame.copy()
            result["ai"] = [({k: a.get(k) for k in AI_FIELDS} if a else None) for a in ai]
            result["ai_failed"], result["ai_rejected"] = failed, rejected
            yield result

    kinds = ", ".join(f"`{n}` {t}" for n, t in reviews.dtypes)
    return reviews.mapInPandas(run, f"{kinds}, ai struct<{schema.replace(' ', ':').replace(',:', ',')}>, ai_failed array<string>, ai_rejected array<string>").select(*names, "ai", "ai_failed", "ai_rejected")


def tally(rows: DataFrame) -> DataFrame:
    """One row: how many reviews were annotated and on how many a function failed."""
    return rows.agg(F.count("ai").alias("annotated"), F.count_if(F.size("ai_failed") > 0).alias("failures"))
