"""Relative dates: phrases in seven languages to instants with precision and confidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds of each unit (month and year are fixed averages), precision and confidence, and each
# language's articles, unit words and special phrases.
UNIT_MS = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000, "month": 2_629_746_000, "year": 31_556_952_000}
PRECISION = {"second": ("day", "high"), "minute": ("day", "high"), "hour": ("day", "high"), "day": ("day", "high"), "week": ("week", "high"), "month": ("month", "medium"), "year": ("year", "low")}
SCALE = ("day", "week", "month", "year", "unknown")
ARTICLES = {
    "en": ("a", "an", "one"), "de": ("ein", "eine", "einem", "einer", "einen"), "fr": ("un", "une"), "es": ("un", "una"), "pt": ("um", "uma"), "hi": ("एक",), "ar": ("واحد", "واحدة"),
}
UNITS = {
    "en": {"second": ("second", "seconds"), "minute": ("minute", "minutes"), "hour": ("hour", "hours"), "day": ("day", "days"), "week": ("week", "weeks"), "month": ("month", "months"), "year": ("year", "years")},
    "de": {"second": ("sekunde", "sekunden"), "minute": ("minute", "minuten"), "hour": ("stunde", "stunden"), "day": ("tag", "tagen", "tage"), "week": ("woche", "wochen"), "month": ("monat", "monaten", "monate"), "year": ("jahr", "jahren", "jahre")},
    "fr": {"second": ("seconde", "secondes"), "minute": ("minute", "minutes"), "hour": ("heure", "heures"), "day": ("jour", "jours"), "week": ("semaine", "semaines"), "month": ("mois",), "year": ("an", "ans", "année", "années")},
    "es": {"second": ("segundo", "segundos"), "minute": ("minuto", "minutos"), "hour": ("hora", "horas"), "day": ("día", "días", "dia", "dias"), "week": ("semana", "semanas"), "month": ("mes", "meses"), "year": ("año", "años", "ano", "anos")},
    "pt": {"second": ("segundo", "segundos"), "minute": ("minuto", "minutos"), "hour": ("hora", "horas"), "day": ("dia", "dias"), "week": ("semana", "semanas"), "month": ("mês", "meses", "mes"), "year": ("ano", "anos")},
    "hi": {"second": ("सेकंड", "सेकेंड"), "minute": ("मिनट",), "hour": ("घंटा", "घंटे"), "day": ("दिन",), "week": ("सप्ताह", "हफ्ते", "हफ़्ते", "हफ्ता"), "month": ("महीना", "महीने", "माह"), "year": ("साल", "वर्ष", "बरस")},
    "ar": {"second": ("ثانية", "ثواني", "ثوان"), "minute": ("دقيقة", "دقائق"), "hour": ("ساعة", "ساعات"), "day": ("يوم", "أيام", "يومين", "ايام"), "week": ("أسبوع", "أسابيع", "اسبوع", "أسبوعين"), "month": ("شهر", "أشهر", "شهور", "شهرين"), "year": ("سنة", "سنوات", "عام", "أعوام", "سنتين")},
}
SPECIAL = {
    "en": {"yesterday": (1, "day"), "today": (0, "day"), "just now": (0, "minute"), "a moment ago": (0, "minute"), "last week": (1, "week"), "last month": (1, "month"), "last year": (1, "year")},
    "de": {"gestern": (1, "day"), "heute": (0, "day"), "vorgestern": (2, "day"), "letzte woche": (1, "week"), "letzten monat": (1, "month"), "letztes jahr": (1, "year")},
    "fr": {"hier": (1, "day"), "aujourd'hui": (0, "day"), "avant-hier": (2, "day"), "la semaine dernière": (1, "week"), "le mois dernier": (1, "month"), "l'année dernière": (1, "year")},
    "es": {"ayer": (1, "day"), "hoy": (0, "day"), "anteayer": (2, "day"), "la semana pasada": (1, "week"), "el mes pasado": (1, "month"), "el año pasado": (1, "year")},
    "pt": {"ontem": (1, "day"), "hoje": (0, "day"), "anteontem": (2, "day"), "semana passada": (1, "week"), "mês passado": (1, "month"), "ano passado": (1, "year")},
    "hi": {"कल": (1, "day"), "आज": (0, "day"), "परसों": (2, "day"), "पिछले सप्ताह": (1, "week"), "पिछले महीने": (1, "month"), "पिछले साल": (1, "year")},
    "ar": {"أمس": (1, "day"), "اليوم": (0, "day"), "الآن": (0, "minute"), "يومين": (2, "day"), "أسبوعين": (2, "week"), "شهرين": (2, "month"), "سنتين": (2, "year")},
}
DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹०१२३४५६७८९"


def fold_phrase(c: Column) -> Column:
    c = F.translate(F.lower(c), DIGITS, "0123456789" * 3)
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[.,!?;:()\[\]]", ""), r"(?U)\s+", " "))


def primary(locale: Column) -> Column:
    p = F.lower(F.substring_index(F.replace(F.coalesce(locale, F.lit("en")), F.lit("_"), F.lit("-")), "-", 1))
    return F.when(p.isin(*UNITS), p).otherwise("en")


def _has_article(p: Column, code: str) -> Column:
    return F.exists(F.split(p, " "), lambda w: w.isin(*ARTICLES[code])) if ARTICLES[code] else F.lit(True)


def parsed(phrase: Column, locale: Column, compat: bool = False) -> Column:
    """count and unit as a struct, both null if the phrase doesn't say both. Special phrases win, the longest first (compat: in table order).

    The folded phrase is the element of an array of one, so that it is folded once, and only its language's words are looked for.
    """

    def read(x: Column) -> Column:
        p, out = x["p"], F.lit(None).cast("struct<n:int,unit:string>")
        for code in UNITS:
            words = sorted([(w, u) for u, ws in UNITS[code].items() for w in ws][::-1], key=lambda x: len(x[0]))
            of = F.lit(None).cast("string")
            for w, u in words:
                of = F.when(F.contains(p, F.lit(w)), u).otherwise(of)
            n = F.coalesce(x["given"], F.when(_has_article(p, code), F.lit(1)))
            said = F.struct(n.alias("n"), of.alias("unit"))
            special = list(SPECIAL[code].items())
            for w, (k, u) in special[::-1] if compat else sorted(special, key=lambda x: len(x[0])):
                said = F.when(F.contains(p, F.lit(w)), F.struct(F.lit(k).alias("n"), F.lit(u).alias("unit"))).otherwise(said)
            out = F.when(x["language"] == code, said).otherwise(out)
        return out

    p = F.transform(F.array(fold_phrase(phrase)), lambda p: F.struct(p.alias("p"), F.regexp_extract(p, r"(\d+)", 1).try_cast("int").alias("given"), primary(locale).alias("language")))
    return F.transform(F.transform(p, read), lambda r: F.when(r["n"].isNotNull() & r["unit"].isNotNull(), r))[0]


def parse_phrase(phrase: Column, locale: Column, compat: bool = False) -> tuple[Column, Column]:
    """(count, unit), the fields of ``parsed``."""
    found = parsed(phrase, locale, compat)
    return found["n"], found["unit"]


def resolve_ms(observed_ms: Column, count: Column, unit: Column) -> Column:
    ms = F.create_map(*[F.lit(v) for u, m in UNIT_MS.items() for v in (u, m)])
    return observed_ms - count.cast("long") * ms[unit]


def precision_of(unit: Column) -> tuple[Column, Column]:
    p = F.create_map(*[F.lit(v) for u, (a, _) in PRECISION.items() for v in (u, a)])
    c = F.create_map(*[F.lit(v) for u, (_, b) in PRECISION.items() for v in (u, b)])
    return F.coalesce(p[unit], F.lit("unknown")), F.coalesce(c[unit], F.lit("low"))


def absolute_date(c: Column) -> Column:
    """The first ten characters where they are YYYY-MM-DD."""
    d = F.regexp_extract(F.coalesce(c, F.lit("")), r"^(\d{4}-\d{2}-\d{2})", 1)
    return F.when(d != "", d)


def is_coarser(a: Column, b: Column) -> Column:
    scale = F.array(*map(F.lit, SCALE))
    return F.array_position(scale, a) > F.array_position(scale, b)
