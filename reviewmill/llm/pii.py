"""Personal data: overlapping candidate spans, boosted trees, calibrated thresholds.

Everything on the main path is DataFrame expressions. Generators propose spans of
each kind with high recall; each span carries format features (length, digit and
letter shares, marks) and context features (words before it, what encloses it);
gradient-boosted trees, fitted once on a generated labelled sample of SAMPLE rows
with fixed seed (the corpus has no labelled spans), score it; a span is redacted if
its calibrated probability reaches its kind's threshold. Spans that the base
grammars and their checks accept are redacted whatever the trees say.

Defined results: a null text counts as empty and has no spans; null ids and repeated
rows give a row each; an empty table gives none; texts are searched whole. Columns
other than id and text are ignored.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, fit, threshold_for

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "iban", "ssn")
SAMPLE = 6000
PRECISION = 0.98
#: Matches are counted off in blocks of so many, and blocks likewise, so that a text of m matches costs m^1.5.
BLOCK = 64
CONTEXT = 32

# The base grammars, each with only such starts as leftmost matching can take: where a run of
# the first class begins, or where the last match ended inside one. Possessive, as no later
# part can use what an earlier one gives back; so no text costs more than a linear scan.
GRAMMARS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{16,}+={0,2}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without this has no match of the grammar.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "secret": r"[0-9](?:[A-Za-z0-9_+/-]{8}|(?<=[A-Za-z0-9_+/-]{9}))", "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]{2}-[0-9]"}
WORDS = {
    "says_secret": r"(?i)(token|secret|passw(or)?d|pwd|api.?key|access.?key|private.?key|credential|bearer|auth)\W{0,6}$",
    "says_account": r"(?i)(iban|account|konto|cuenta|compte|bank)\W{0,6}$",
    "says_person": r"(?i)(ssn|social security|tax id|passport)\W{0,8}$",
    "says_number": r"(?i)(version|isbn|order|invoice|ref|page|http\S*|www\S*|sha\w*|md5|commit|hash)\W{0,6}$",
    "assigned": r"[=:]\s*[\"']?$",
    "quoted": r"[\"']$",
}


def _starts(gaps: Column, found: Column) -> Column:
    """Start of each match in code points, from the texts between the matches and the matches."""
    steps = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))  # gap and match
    def running(xs: Column, first: Column) -> Column:
        """first + the sum of what stands before each element."""
        return F.aggregate(
            xs, F.struct(first.cast("int").alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct((acc["at"] + x).cast("int").alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")), lambda b: F.slice(steps, b * BLOCK + 1, BLOCK))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
    firsts = running(totals, F.lit(0))
    ends = F.flatten(F.transform(blocks, lambda b, i: running(b, F.get(firsts, i))))
    return F.transform(ends, lambda at, i: at + F.length(F.get(gaps, i)))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = _digits(m)
    n = F.length(d)
    worth = F.transform(F.split(d, "(?<=.)(?=.)"), lambda c, i: F.when((n - 1 - i) % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return n.between(12, 19) & (F.when(n.between(12, 19), F.aggregate(worth, F.lit(0), lambda a, x: a + x)) % 10 == 0)


#: What a base match must pass besides its grammar.
CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"),
    "card": _luhn,
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}

SPAN = "array<struct<kind:string,start:int,stop:int,found:string,before:string>>"


def candidates(text: Column) -> Column:
    """All spans that any generator proposes: kind, start, stop (code points, exclusive), the match and what stands before it."""

    def of(kind: str) -> Column:
        g = GRAMMARS[kind]
        found, gaps = F.regexp_extract_all(text, F.lit(g), F.lit(0)), F.split(text, g, -1)
        spans = F.transform(
            F.arrays_zip(_starts(gaps, found).alias("at"), found.alias("found")),
            lambda x, i: F.struct(F.lit(kind).alias("kind"), x["at"].alias("start"), (x["at"] + F.length(x["found"])).alias("stop"), x["found"].alias("found"), F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before")),
        )
        spans = F.filter(spans, lambda s: CHECKS[kind](s["found"])) if kind in CHECKS else spans
        none = F.array().cast(SPAN)
        return F.when(text.rlike(NEEDS[kind]), F.when(F.size(found) > 0, spans).otherwise(none)).otherwise(none).cast(SPAN)

    return F.concat(*(of(k) for k in KINDS))


def _share(m: Column, kept_out: str) -> Column:
    return 1.0 - F.length(F.regexp_replace(m, kept_out, "")) / F.greatest(F.length(m), F.lit(1))


FEATURES = ("length", "digits", "upper", "lower", "hex", "marks", "changes", *WORDS, *(f"is_{k}" for k in KINDS))


def features(kind: Column, found: Column, before: Column) -> dict[str, Column]:
    """Format and context of a span."""
    out = {
        "length": F.length(found), "digits": _share(found, "[0-9]"), "upper": _share(found, "[A-Z]"), "lower": _share(found, "[a-z]"), "hex": _share(found, "[0-9a-f]"),
        "marks": _share(found, "[^A-Za-z0-9]"), "changes": F.length(F.regexp_replace(F.regexp_replace(found, "[0-9]+", "0"), "[A-Za-z]+", "a")) / F.greatest(F.length(found), F.lit(1)),
    }
    out |= {k: before.rlike(p) for k, p in WORDS.items()} | {f"is_{k}": kind == k for k in KINDS}
    return {k: v.cast("double") for k, v in out.items()}


def sample_rows(n: int = SAMPLE, seed: int = 7) -> list[tuple[str, str, str, int]]:
    """(kind, match, before, personal) of n generated spans."""
    r = random.Random(seed)
    word = lambda a=2, b=9: "".join(r.choice("etaoinshrdlucmfwyp") for _ in range(r.randint(a, b)))
    pick = lambda chars, a, b=None: "".join(r.choice(chars) for _ in range(r.randint(a, b or a)))
    hexa, alnum, digit = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "0123456789"
    plain = lambda: " ".join(word() for _ in range(3)) + " "
    keyed = lambda: r.choice(["token", "api_key", "secret", "password", "access-key", "auth token", "Bearer", "apikey"]) + r.choice([" = \"", ": ", "='", " = ", "=\"", " "])
    rows = []
    for i in range(n):
        before = plain()
        match i % 10:
            case 0:
                rows.append(("secret", r.choice([pick(hexa, 32), pick(hexa, 40), pick(alnum, 20, 44), pick(hexa, 64)]), before + keyed(), 1))
            case 1:
                rows.append(("secret", r.choice(["AKIA" + pick(alnum.upper()[:26] + digit, 16), "ghp_" + pick(alnum, 36), "sk-" + pick(alnum, 40)]), before + r.choice(["", "\"", keyed()]), 1))
            case 2:
                rows.append(("secret", r.choice([word(8, 10) + word(8, 12), word(5, 9) + "-" + word(6, 9) + "-" + word(4, 8), word(6, 8).upper() + word(9, 12).upper(), word(8) + "_" + word(9)]), before + r.choice(["", "\"", "the ", keyed()]) * (r.random() < 0.4), 0))
            case 3:
                rows.append(("secret", r.choice([pick(digit, 16, 24), word(4, 6) + "/" + word(4, 7) + "/" + word(5, 8), pick("-_", 16, 40), "2024-01-" + pick(digit, 8), pick(hexa, 40)]), before + r.choice(["", "commit ", "sha1 ", "order ", "https://"]), 0))
            case 4:
                rows.append(("iban", pick("DEFRGBES", 2) + pick(digit, 18, 20), before + r.choice(["IBAN ", "account: ", "IBAN: ", "Konto "]), 1))
            case 5:
                rows.append(("iban", r.choice([pick("DEFRGBES", 2) + pick(digit, 18, 20), "AB12 " + " ".join(word(4, 4).upper() for _ in range(3))]), before + r.choice(["order ", "ref ", "", "part "]), 0))
            case 6:
                rows.append(("ssn", f"{r.randint(1, 899):03d}-{r.randint(1, 99):02d}-{r.randint(1, 9999):04d}", before + r.choice(["SSN ", "ssn: ", "social security ", "Tax ID: "]), 1))
            case 7:
                rows.append(("ssn", f"{r.randint(0, 999):03d}-{r.randint(0, 99):02d}-{r.randint(0, 9999):04d}", before + r.choice(["", "order ", "part ", "invoice "]), 0))
            case 8:
                kind = r.choice(BASE_KINDS)
                rows.append((kind, {"email": f"{word()}.{word()}{r.randint(1, 99)}@{word()}.com", "ip": ".".join(str(r.randint(1, 255)) for _ in range(4)), "card": pick(digit, 16), "phone": f"+1 ({pick(digit, 3)}) 555-{pick(digit, 4)}"}[kind], before, 1))
            case _:
                rows.append((r.choice(("ip", "card")), r.choice([pick(digit, 12, 13), "1.2.3.4", "10." + pick(digit, 1) + ".0.1"]), before + r.choice(["version ", "isbn ", "order ", "page "]), 0))
    return rows


def _python_features(kind: str, m: str, before: str) -> list[float]:
    """The same numbers as features(), for the training rows alone."""
    share = lambda p: len(re.findall(p, m)) / max(1, len(m))
    own = [len(m), share("[0-9]"), share("[A-Z]"), share("[a-z]"), share("[0-9a-f]"), share("[^A-Za-z0-9]"), len(re.sub("[A-Za-z]+", "a", re.sub("[0-9]+", "0", m))) / max(1, len(m))]
    return [*map(float, own), *(float(bool(re.search(p, before[-CONTEXT:]))) for p in WORDS.values()), *(float(kind == k) for k in KINDS)]


@lru_cache(maxsize=2)
def model(sample: int = SAMPLE) -> tuple[Boosted, dict[str, float]]:
    """Trees and each kind's threshold: the least with PRECISION on rows that neither trees nor calibration saw."""
    rows = sample_rows(sample)
    x, y = np.array([_python_features(*r[:3]) for r in rows]), np.array([r[3] for r in rows], float)
    cut = len(rows) * 4 // 5
    trees = fit(list(FEATURES), x[:cut], y[:cut], trees=16, depth=3)
    p, kinds = trees.probability(x[cut:]), np.array([r[0] for r in rows[cut:]])
    return trees, {k: threshold_for(p[kinds == k], y[cut:][kinds == k], PRECISION) for k in KINDS}


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``spans``: array of (start, rank of the kind in KINDS, stop, kind, base, probability) in that order; probability is null for base spans."""
    trees, cut = model()

    def described(s: Column) -> Column:
        """The span with its features, each computed once; none where the base grammar has decided."""
        own = F.struct(*(c.alias(k) for k, c in features(s["kind"], s["found"], s["before"]).items()))
        return F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"), s["kind"].isin(*BASE_KINDS).alias("base"), F.when(~s["kind"].isin(*BASE_KINDS), own).alias("own"))

    def scored(s: Column) -> Column:
        p = F.when(~s["base"], trees.expression({k: s["own"][k] for k in FEATURES}))
        return F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).cast("int").alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"), s["base"].alias("base"), p.alias("probability"))

    least = F.create_map(*[F.lit(v) for k in KINDS for v in (k, float(cut[k]))])
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text")).select(id_col, candidates(text).alias("c"))
    none = F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string,base:boolean,probability:double>>")
    taken = F.filter(F.transform(F.transform("c", described), scored), lambda s: s["base"] | (s["probability"] >= least[s["kind"]]))
    return rows.select(id_col, F.when(F.size("c") == 0, none).otherwise(F.array_sort(taken)).alias("spans"))


def _is(kind: str):
    return lambda s: s["kind"] == kind


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    said = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        id_col,
        *(F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(F.concat_ws(",", F.transform(base, said)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", said)).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """docs with each chosen span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    trees_spans = find(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text_col).alias("text")), "_row", "text")
    row_text = F.coalesce(F.col("_row").getField(text_col), F.lit(""))
    step = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, s: F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["stop"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(s["stop"].alias("at"), F.concat(a["out"], F.array(F.substring(row_text, a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("["), s["kind"], F.lit("]")))).alias("out"))
        ),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(row_text, a["at"] + 1, F.length(row_text))),
    )
    text = F.when(F.size("spans") == 0, F.col("_row").getField(text_col)).otherwise(step)
    return trees_spans.select(*(text.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns))
