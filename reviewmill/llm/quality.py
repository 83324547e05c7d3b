"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document. The ledger row keeps the
measurements and one bit for each failed rule, so a policy (a versioned set of
rules and a tolerated number of failures) or an ablation of it is bit arithmetic
on the ledger and never reads a text again.

Defined results: a null or empty text measures 0 everywhere and fails
``few_words``; a null doc_id, repeated rows and ties give a ledger row each;
an empty table gives an empty ledger; columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_chunks

WINDOW = 8
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_ascii_letters", "n_digits", "n_bangs", "n_top_word")


@dataclass(frozen=True)
class Rule:
    name: str
    failed: str  # SQL over the measurements


#: Bit i of the ledger belongs to rule i; append only, so that old ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("shouting", "n_ascii_letters >= 20 AND 2 * n_upper > n_ascii_letters"),
    Rule("exclamations", "n_bangs >= 5 AND 5 * n_bangs > n_words"),
    Rule("digits", "2 * n_digits > word_chars"),
    Rule("one_word", "n_words >= 20 AND 10 * n_top_word > 4 * n_words"),
)
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]
    tolerated: int = 0

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
POLICIES = {p.version: p for p in (BASE, Policy("v1", tuple(BIT)), Policy("v1-lenient", tuple(BIT), 1))}


def _repeat_words(words: list[bytes]) -> tuple[int, int]:
    """Words in windows found twice or more, and the count of the commonest word."""
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    n = len(ids)
    if not n:
        return 0, 0
    top = int(np.bincount(ids).max())
    if n <= WINDOW or top == 1:
        return 0, top
    # Mixed ids summed under odd weights: equal windows have equal sums, so no equal sums means no repeat.
    mix = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mix ^= mix >> np.uint64(29)
    mix *= np.uint64(0xBF58476D1CE4E5B9)
    mix ^= mix >> np.uint64(32)
    m = n - WINDOW + 1
    sums = np.zeros(m, np.uint64)
    for k in range(WINDOW):
        sums = sums * np.uint64(0x94D049BB133111EB) + mix[k : k + m]
    order = np.sort(sums)
    if not (order[1:] == order[:-1]).any():
        return 0, top
    # Exact: number pairs, then fours, then eights.
    codes = ids
    for step in (1, 2, 4):
        pairs = codes[:-step] * np.int64(n + 1) + codes[step:]
        codes = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    twice = np.bincount(codes)[codes] > 1
    change = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(change, at, 1)
    np.add.at(change, at + WINDOW, -1)
    return int((np.cumsum(change[:n]) > 0).sum()), top


def _without(b: bytes, chars: bytes) -> int:
    return len(b) - len(b.translate(None, chars))


def _measure(b: bytes) -> tuple[int, ...]:
    words = b.split()
    lines = [x for x in b.split(b"\n") if x.strip()]
    repeated, top = _repeat_words(words)
    points = len(b) if b.isascii() else len(b.decode("utf-8", "replace"))
    return (len(words), points - _without(b, SPACE), _without(b, SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines), _without(b, UPPER), _without(b, LETTERS), _without(b, DIGITS), b.count(b"!"), top)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of MEASURES for each document, from one pass over its whole text."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                found = np.array([_measure(t) for t in texts], np.int64).reshape(-1, len(MEASURES))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(found[:, i]) for i in range(len(MEASURES)))], names=[id_col, *MEASURES])

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{m} long" for m in MEASURES))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``fail_bits``: bit i is set if RULES[i] failed."""
    bits = sum((F.when(F.expr(r.failed), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(RULES)), F.lit(0).cast("long"))
    return measure(docs, id_col, text_col).withColumn("fail_bits", bits)


def verdict(policy: Policy, bits: str = "fail_bits"):
    """Whether a ledger row is kept under the policy."""
    return F.bit_count(F.col(bits).bitwiseAND(policy.mask)) <= policy.tolerated


def keep_good(docs: DataFrame, policy: Policy, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that the policy keeps."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    return ledger(rows, "row", "text").where(verdict(policy)).select("row.*")


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: failures, rejections that only it causes, and documents kept without it.

    One aggregation to a row for each bit pattern (at most 2^rules), then sums over those.
    """
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(policy.mask).alias("bits")).agg(F.count("*").alias("n"))
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules))).alias("r")
    failed = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    left = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit")))) <= policy.tolerated
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias
    return (
        patterns.select("bits", "n", each)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(total(failed)("n_failed"), total(left & (F.bit_count("bits") > policy.tolerated))("n_only"), total(left)("n_kept_without"))
        .withColumn("policy", F.lit(policy.version))
    )
