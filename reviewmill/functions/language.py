"""Language by script, then by stopwords."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import trim

# Scripts in the order they are asked, stopwords of six languages in their order.
SCRIPTS = (("hi", r"\p{IsDevanagari}"), ("ar", r"\p{IsArabic}"), ("he", r"\p{IsHebrew}"), ("ja", r"[\p{IsHiragana}\p{IsKatakana}]"), ("ko", r"\p{IsHangul}"), ("zh", r"\p{IsHan}"), ("th", r"\p{IsThai}"), ("el", r"\p{IsGreek}"), ("ru", r"\p{IsCyrillic}"))
STOPWORDS = {
    "en": ("the", "and", "was", "were", "very", "with", "this", "that", "they", "have", "for"),
    "es": ("el", "la", "los", "las", "muy", "con", "para", "pero", "que", "una", "está"),
    "fr": ("le", "la", "les", "très", "avec", "pour", "mais", "que", "une", "est", "nous"),
    "de": ("der", "die", "das", "und", "sehr", "mit", "für", "aber", "ist", "nicht", "war"),
    "pt": ("o", "os", "as", "muito", "com", "para", "mas", "que", "uma", "está", "foi"),
    "it": ("il", "lo", "gli", "molto", "con", "per", "ma", "che", "una", "sono", "era"),
}
MIN_GRAPHEMES, MIN_HITS, SURE, FLOOR = 12, 2, 0.9, 0.5


def words_of(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: w != "")


def script_language(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for code, pattern in reversed(SCRIPTS):
        out = F.when(c.rlike(pattern), code).otherwise(out)
    # All of these scripts lie beyond Latin and its marks: most texts are told by one cheap look.
    return F.when(c.rlike(r"[^\x{0}-\x{36F}]"), out)


def stopword_hits(words: Column, code: str) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*STOPWORDS[code])))


def detected(text: Column, words: Column) -> Column:
    """language and confidence as a struct; words is words_of(text). Each costly part is the element of an array of one, so that it is computed once."""
    stops = F.filter(words, lambda w: w.isin(*sorted({w for k in STOPWORDS.values() for w in k})))
    hits = F.transform(F.array(stops), lambda s: F.array(*(stopword_hits(s, k) for k in STOPWORDS)))[0]
    # Twelve graphemes are looked for, not all counted.
    long_enough = trim(text).rlike(rf"\A\X{{{MIN_GRAPHEMES}}}")
    once = F.struct(hits.alias("hits"), F.size(words).alias("n"), F.when(long_enough, F.coalesce(script_language(text), F.lit(""))).alias("script"))

    def judge(x: Column) -> Column:
        best = F.array_max(x["hits"])
        code = F.array(*map(F.lit, STOPWORDS))[F.array_position(x["hits"], best).cast("int") - 1]
        told, counted = x["script"] != "", x["script"].isNotNull() & (best >= MIN_HITS)
        said = F.when(told, x["script"]).when(counted, code)
        sure = F.when(told, F.lit(SURE)).when(counted, F.least(F.lit(SURE), best / x["n"] + F.lit(FLOOR))).otherwise(F.lit(0.0))
        return F.struct(said.alias("language"), sure.alias("confidence"))

    return F.transform(F.array(once), judge)[0]


def detect(text: Column, words: Column) -> tuple[Column, Column]:
    """(language, confidence), the fields of ``detected``."""
    found = detected(text, words)
    return found["language"], found["confidence"]
