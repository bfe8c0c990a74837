"""Citations of acts in titles and speeches: one scanner over a table of forms.

Every form is a pattern for one type of reference; what its named groups hold becomes the reference. Matches of all forms are sorted, and of those that overlap the first and longest stays. Free prose yields unknown references too, where something is shaped like a citation and no known type claims it.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of the patterns, then the forms as (type, kind, pattern, whether case matters).
NUMBER = r"(?P<number>\d+(?:\.\d+)*)"
OF_YEAR = NUMBER + r"\s*/\s*(?P<year>\d{4})\b"
NR = r"(?:nr\.?\s*)?"
ARTICLE = r"(?P<article>\d+(?:\s+alin\.?\s*\(\d+(?:\^\d+)?\))?(?:\s+(?:lit\.|litera)\s*[a-zA-Z]\)?)?)"
SHORT_ARTICLE = r"(?P<article>\d+(?:\s+alin\.?\s*\(\d+(?:\^\d+)?\))?)"
TITLE = r"(?:\s+(?:nr\.?\s*)?(?P<number>\d+(?:\.\d+)*)(?:\s*/\s*(?P<year>\d{4}))?)?(?:\s+(?:privind\s+|cu\s+titlul\s+|intitulat[ăa]\s+)?(?:„|\")(?P<title>[^„\"\n]{3,200})(?:”|\"))?"
NAME_END = r"(?=[.,;:\n]|\s+(?:din|privind|pentru|este|a\s+fost|adoptat[ăa]?|semnat[ăa]?|ratificat[ăa]?|asupra|[șs]i\s+|sau\s+|iar\s+|plus\s+))"
PROPER = r"(?P<name>[A-ZȘȚĂÎÂ][^.,;:\n]{2,120}?)"
ANY_NAME = r"(?P<name>[A-ZȘȚĂÎÂa-z][^.,;:\n]{2,120}?)"
SCOPE = r"(?P<scope>Camerei\s+Deputa[țt]ilor(?:\s+[șs]i\s+Senatului)?|Senatului|activit[ăa][țt]ilor\s+comune[^.\n]{0,80}"
CODE = r"(?P<code>de\s+procedur[ăa]\s+(?:civil[ăa]|penal[ăa])|muncii|fiscal|civil|penal|administrativ|silvic|aerian|rutier|vamal|comercial|familiei|naviga[țt]iei|consumului|insolven[țt]ei)"
CHARTER = (
    r"(?P<name>(?:Na[țt]iunilor\s+Unite|drepturilor\s+fundamentale(?:\s+a\s+(?:Uniunii\s+Europene|UE))?|social[ăa]\s+european[ăa](?:\s+revizuit[ăa])?|european[ăa]\s+a\s+autonomiei\s+locale|"
    r"european[ăa]\s+a\s+limbilor[^.,;:\n]{0,80}|olimpic[ăa]|alb[ăa](?:\s+a\s+[A-ZȘȚĂÎÂa-z][^.,;:\n]{2,80})?|de\s+la\s+[A-ZȘȚĂÎÂ][^.,;:\n]{2,80}))"
)
FORMS = (
    ("bill", None, r"\b(?P<prefix>P[Ll]-?x|L)\s*" + NUMBER + r"\s*/\s*(?P<year>\d{4})(?:\s*/\s*(?P<secondary>\d{4}))?\b", True),
    ("chamber_resolution", None, r"\b(?P<prefix>PHCDS|PHCD|PHS)\s*" + NR + OF_YEAR, True),
    ("parliamentary_resolution", None, r"\bHot[ăa]r[âa]r(?:i(?:i|le|lor)?|ea)\s+(?:a\s+|ale\s+)?Parlamentului\s+Rom[âa]niei\s+nr\.?\s*" + OF_YEAR, False),
    ("law", None, r"\bLeg(?:ea|ii)\s+" + NR + OF_YEAR, False),
    ("oug", None, r"\bOUG\s+" + NR + OF_YEAR, True),
    ("oug", None, r"\b[Oo]rdonan[țt]a\s+de\s+urgen[țt][ăa]\s+(?:a\s+Guvernului\s+)?" + NR + OF_YEAR, True),
    ("og", None, r"\bOG\s+" + NR + OF_YEAR, True),
    ("og", None, r"\b[Oo]rdonan[țt]a\s+(?:a\s+Guvernului\s+)?(?!de\s+urgen[țt][ăa])" + NR + OF_YEAR, True),
    ("motion", "simple", r"\bMo[țt]iun(?:e|ea|ii|i)\s+simpl[ăa]\b" + TITLE, False),
    ("motion", "censure", r"\bMo[țt]iun(?:e|ea|ii|i)\s+de\s+cenzur[ăa]\b" + TITLE, False),
    ("court_decision", "CCR", r"\b(?:Decizia(?:\s+nr\.?)?\s+CCR|Decizia\s+Cur[țt]ii\s+Constitu[țt]ionale|Decizia(?:\s+nr\.?)?(?:\s+\d+(?:\.\d+)*\s*/\s*\d{4})?\s+a\s+Cur[țt]ii\s+Constitu[țt]ionale)\s+" + NR + OF_YEAR, False),
    ("court_decision", "CCR", r"\bDecizi(?:a|ei)\s+Cur[țt]ii\s+Constitu[țt]ionale(?:\s+a\s+Rom[âa]niei)?\s+" + NR + OF_YEAR, False),
    ("constitution", None, r"\bart\.?\s+" + ARTICLE + r"\s+(?:din\s+)?Constitu[țt]i(?:a|e|ei|ile|ilor)(?:\s+Rom[âa]niei)?", False),
    ("constitution", None, r"\bConstitu[țt]ia(?:\s+Rom[âa]niei)?(?:,\s+republicat[ăa])?(?:,\s+art\.?\s+" + SHORT_ARTICLE + ")", False),
    ("regulation", None, r"\bart\.?\s+" + ARTICLE + r"\s+(?:din\s+)?Regulament(?:ul|elor)?\s+" + SCOPE + r"|[șs]edin[țt]elor\s+comune[^.\n]{0,40})", False),
    ("regulation", None, r"\bRegulamentul\s+" + SCOPE + r")(?:,\s+art\.?\s+" + SHORT_ARTICLE + ")?", False),
    ("eu_doc", "code", r"\b(?P<prefix>COM|JOIN|JOCE|SWD)\s*\(\s*(?P<year>\d{4})\s*\)\s*" + NUMBER + r"(?:\s+final)?", False),
    ("eu_doc", "regulation", r"\bRegulamentul\s*\(UE\)\s*(?P<year>\d{4})\s*/\s*(?P<number>\d+)", False),
    ("eu_doc", "directive", r"\bDirectiva\s+(?P<year>\d{4})\s*/\s*(?P<number>\d+)\s*/\s*(?:UE|CE)\b", False),
    ("eu_doc", "decision", r"\bDecizia\s*\(UE\)\s*(?P<year>\d{4})\s*/\s*(?P<number>\d+)", False),
    ("treaty", None, r"\bTratat(?:ul|ului)\s+(?:de\s+la\s+)?" + PROPER + NAME_END, True),
    ("treaty", None, r"\bConven[țt]i(?:a|ei)\s+(?:de\s+la\s+|european[ăa]\s+|interna[țt]ional[ăa]\s+)?" + PROPER + NAME_END, True),
    ("treaty", None, r"\bAcord(?:ul|ului)\s+(?:de\s+la\s+|dintre\s+|privind\s+|asupra\s+)" + ANY_NAME + NAME_END, True),
    ("treaty", None, r"\bProtocol(?:ul|ului)\s+(?:de\s+la\s+|adi[țt]ional\s+|op[țt]ional\s+|nr\.?\s*\d+(?:\.\d+)*\s+)" + ANY_NAME + NAME_END, True),
    ("treaty", None, r"\bCart(?:a|ei)\s+" + CHARTER, False),
    ("code", None, r"\bCodul(?:ui)?\s+" + CODE + r"(?:\s+art\.?\s+" + ARTICLE + ")?", False),
    ("code", None, r"\bart\.?\s+" + ARTICLE + r"\s+din\s+Codul(?:ui)?\s+" + CODE, False),
)
# The inclusive years of each type, and the types that may go without one.
YEARS = {"bill": (1990, 2100), "law": (1900, 2100), "oug": (1990, 2100), "og": (1990, 2100), "chamber_resolution": (1990, 2100), "parliamentary_resolution": (1990, 2100), "motion": (1990, 2100), "court_decision": (1990, 2100), "eu_doc": (1950, 2100)}
YEAR_OPTIONAL = ("motion", "eu_doc")
# What is shaped like a citation, with a hint at what it may be.
SHAPES = (
    ("law-ish", r"\bHG\s+(?:nr\.?\s*)?\d+(?:\.\d+)*\s*/\s*\d{4}\b"),
    ("law-ish", r"\bHot[ăa]r[âa]re(?:a|ii)?\s+(?:a\s+)?Guvernului(?:\s+Rom[âa]niei)?\s+nr\.?\s*\d+(?:\.\d+)*\s*/\s*\d{4}\b"),
    ("law-ish", r"\bDecret(?:-?lege)?\s+(?:nr\.?\s*)?\d+(?:\.\d+)*\s*/\s*\d{4}\b"),
    ("court-ish", r"\bDecizi(?:a|ei)\s+(?:nr\.?\s*\d+(?:\.\d+)*\s*/\s*\d{4}\s+(?:a\s+)?)?(?:Cur[țt]ii\s+Supreme|Înaltei\s+Cur[țt]i\s+de\s+Casa[țt]ie|ICCJ)"),
    ("law-ish", r"\bart\.?\s+(\d+(?:\s+alin\.?\s*\(\d+(?:\^\d+)?\))?(?:\s+(?:lit\.|litera)\s*[a-zA-Z]\)?)?)(?!\s+(?:din\s+)?(?:Constitu[țt]i|Regulament|Legea\s+nr|OUG|OG|Codul|Hot[ăa]r[âa]rea))"),
)
# Phrases that lead to what an act is about, where it ends, the characters after a citation that are read, and the types that have a subject.
SUBJECT_LEADS = (r"\b(?:pentru\s+aprobarea|pentru\s+modificarea|pentru\s+completarea)\s+", r"\bcu\s+privire\s+la\s+", r"\breferitoare\s+la\s+", r"\basupra\s+", r"\bprivind\s+")
SUBJECT_END = r"(?=[.,;:\n]|\s+(?:[șs]i\s+|iar\s+|dar\s+|sau\s+|precum)|\Z)"
SUBJECT_REACH, SUBJECT_MOST, URGENCY_REACH = 200, 200, 80
WITH_SUBJECT = ("bill", "law", "parliamentary_resolution")
URGENCY = r"în\s+procedur[ăa]\s+de\s+urgen[țt][ăa]"
# Chambers of resolutions by prefix, and of regulations by what their scope holds, in order.
RESOLUTION_CHAMBER = {"PHCD": "camera", "PHS": "senat"}
REGULATION_CHAMBER = ((("camerei deputaților", "și senatului"), "joint"), (("activităților comune",), "joint"), (("ședințelor comune",), "joint"), (("camerei deputaților",), "camera"), (("senatului",), "senat"))

FIELDS = ("type", "raw", "prefix", "number", "year", "secondary_year", "title", "name", "kind", "article", "chamber", "subject", "procedure", "hint", "start", "end")
CITATION = "array<struct<" + ",".join(f"{f}:{'int' if f in ('year', 'secondary_year', 'start', 'end') else 'string'}" for f in FIELDS) + ">>"
_ARROW = pa.list_(pa.struct([(f, pa.int32() if f in ("year", "secondary_year", "start", "end") else pa.string()) for f in FIELDS]))

_forms = [(kind, detail, re.compile(p, 0 if cased else re.I)) for kind, detail, p, cased in FORMS]
_shapes = [(hint, re.compile(p, re.I)) for hint, p in SHAPES]
_subjects = [re.compile(p + r"(?P<subject>[^.,;:\n]{3,200}?)" + SUBJECT_END, re.I) for p in SUBJECT_LEADS]
_urgency = re.compile(URGENCY, re.I)


def code_kind(tail: str) -> str:
    """A code's name without marks, as one word."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", tail.lower()) if not unicodedata.combining(c))
    return re.sub(r"\s+", "_", re.sub(r"^de\s+", "", plain.strip()))


def regulation_chamber(scope: str) -> str | None:
    low = scope.lower()
    return next((chamber for marks, chamber in REGULATION_CHAMBER if all(m in low for m in marks)), None)


def subject_after(text: str, end: int) -> str | None:
    """What the first phrase after a citation says it is about."""
    window = text[end : end + SUBJECT_REACH]
    hits = [m for p in _subjects if (m := p.search(window))]
    if not hits:
        return None
    return min(hits, key=lambda m: m.start())["subject"].strip().strip(".,;:—-–")[:SUBJECT_MOST].rstrip().rstrip(".,;:—-–") or None


def _reference(kind: str, detail: str | None, m: re.Match, text: str) -> dict | None:
    """The reference of a match; a year out of bounds makes it unknown, or goes where the type needs none."""
    g = m.groupdict()
    year = int(g["year"]) if g.get("year") else None
    low, high = YEARS.get(kind, (0, 9999))
    out = dict.fromkeys(FIELDS) | {"type": kind, "raw": m[0], "start": m.start(), "end": m.end()}
    if year is not None and not low <= year <= high:
        if kind not in YEAR_OPTIONAL:
            return out | {"type": "unknown", "hint": "court-ish" if kind == "court_decision" else "law-ish"}
        year = None
    article = g.get("article")
    out |= {"prefix": g.get("prefix"), "number": g.get("number"), "year": year, "secondary_year": int(g["secondary"]) if g.get("secondary") else None, "title": (g.get("title") or "").strip() or None, "kind": detail, "article": article.strip() if article else None}
    if kind == "bill":
        out |= {"prefix": "PL-x" if g["prefix"].upper().startswith("PL") else "L", "procedure": "procedură de urgență" if _urgency.search(text, m.end(), m.end() + URGENCY_REACH) else None}
    if kind == "chamber_resolution":
        out["chamber"] = RESOLUTION_CHAMBER.get(g["prefix"])
    if kind == "regulation":
        out["chamber"] = regulation_chamber(g["scope"])
    if kind == "code":
        out["kind"] = code_kind(g["code"])
    if kind == "treaty":
        out["name"] = g["name"].strip()
        if not out["name"]:
            return None
    if kind in WITH_SUBJECT:
        out["subject"] = subject_after(text, m.end())
    return out


def citations_of(text: str) -> list[dict]:
    """References of known types, without overlap: by start, the longer first, then as the forms stand."""
    found = [(m.start(), -m.end(), rank, r) for rank, (kind, detail, p) in enumerate(_forms) for m in p.finditer(text) if (r := _reference(kind, detail, m, text))]
    kept, reach = [], 0
    for start, end, _, r in sorted(found, key=lambda x: x[:3]):
        if start >= reach:
            kept.append(r)
            reach = -end
    return kept


def mentions_of(text: str) -> list[dict]:
    """As citations_of, with unknown references for what else is shaped like a citation."""
    known = citations_of(text)
    starts = [r["start"] for r in known]
    seen = {}
    for hint, p in _shapes:
        for m in p.finditer(text):
            k = bisect_left(starts, m.end())  # known ones don't overlap, so the last that starts before the end tells
            if k == 0 or known[k - 1]["end"] <= m.start():
                seen.setdefault(m.span(), dict.fromkeys(FIELDS) | {"type": "unknown", "raw": m[0], "hint": hint, "start": m.start(), "end": m.end()})
    return sorted([*known, *seen.values()], key=lambda r: (r["start"], r["end"]))


def _over(f):
    @F.arrow_udf(CITATION)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([f(t or "") for t in texts.to_pylist()], _ARROW)

    return run


def citations(text: Column) -> Column:
    """The references of a title or announcement."""
    return _over(citations_of)(text)


def mentions(text: Column) -> Column:
    """The references of free prose, unknown ones too."""
    return _over(mentions_of)(text)
