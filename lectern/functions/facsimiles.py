"""Activity reports: title, issuing body, period, where they were received, headings, and how sure that is. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.rules import MONTHS, extracted, first_of

# Titles in the summary and as headings, issuing bodies in a title, periods, receptions, headings that don't count.
MONTH = "|".join(MONTHS)
IN_YEAR = r"(?:[îiî]n|pe|pentru)\s+anul"
TITLE = r"(?imu)^[^\n]*?(Raport(?:ul)?\s+[^\n.|]+?(?:" + IN_YEAR + r"\s+\d{4}|din\s+(?:\d{1,2}\s+)?(?:" + MONTH + r")\s+\d{4}))"
TITLE_HEADING = r"(?m)^##\s+\*\*\s*(RAPORT[^\n*]+?)\s*\*\*\s*$"
ISSUER_END = r"(?=\s+" + IN_YEAR + r"\b)"
ISSUERS = (
    r"\bRaport(?:ul)?\s+privind\s+activitatea\s+desf[ăa][șş]urat[ăa]\s+de\s+([^\n]+?)" + ISSUER_END,
    r"\bRaport(?:ul)?\s+privind\s+activitatea\s+(?!desf[ăa][șş]urat)([^\n]+?)" + ISSUER_END,
    r"\bRaport(?:ul)?\s+asupra\s+activit[ăa][țţt]ii\s+desf[ăa][șş]urat[eaă]\s+de\s+([^\n]+?)" + ISSUER_END,
    r"\bRaport(?:ul)?\s+de\s+activitate\s+al\s+([^\n]+?)" + ISSUER_END,
    r"\bRaportul\s+([^\n]+?)\s+(?:privind|asupra)\b",
)
YEARS = r"(?iu)\b[îiî]n\s+perioada\s+(\d{4})\s*[-–—]\s*(\d{4})\b"
YEAR = r"(?iu)\b" + IN_YEAR + r"\s+(\d{4})\b"
DATED = r"(?iu)\bdin\s+(?:\d{1,2}\s+)?(?:" + MONTH + r")\s+(\d{4})\b"
RECEIVED = r"(?iu)(?:##\s+)?\*?\*?\s*[ŞȘŞS]edin[țţt]a\s+din\s+ziua\s+de\s+(\d{1,2})\s+(" + MONTH + r")\s+(\d{4})"
JOINT = r"(?iu)\b[ȘŞS]EDIN[ȚŢT]E\s+COMUNE\s+ALE\s+CAMEREI\s+DEPUTA[ȚŢT]ILOR\s+[ȘŞS]I\s+SENATULUI\b"
SKIPPED = r"(?iu)^(?:\*\*\s*)?(?:DEZBATERI\s+PARLAMENTARE|CAMERA\s+DEPUTA[ȚŢT]ILOR|SENATUL|EDITOR\s*:\s*GUVERNUL|EDITOR\s*:\s*PARLAMENTUL|[ŞȘS]edin[țţt]a\s+din\s+ziua\s+de|N\s+O\s+T\s+[ĂA]\s*:?|SUMAR|PA\s*R\s*T\s*E\s*A\s+A\s+I\s*I)"
KINDS = {"Camera Deputaților": "camera", "Senatul": "senat"}
HEAD, EXCERPT = 2000, 500
FIRST_YEAR, LAST_YEAR = 1990, 2100


def _tidy(t: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(F.replace(t, F.lit("<br>"), F.lit(" ")), r"\.{3,}.*$", ""), r"\s{2,}", " ")
    return F.nullif(F.regexp_replace(bare, r"^[ .\t\n]+|[ .\t\n]+$", ""), F.lit(""))


def title(body: Column) -> Column:
    """The title that the summary gives, else the first heading that is one."""
    return F.coalesce(_tidy(extracted(body, TITLE)), _tidy(extracted(body, TITLE_HEADING)))


def issuer(title_: Column) -> Column:
    t = F.replace(title_, F.lit("<br>"), F.lit(" "))
    found = F.coalesce(*(extracted(t, "(?iu)" + p) for p in ISSUERS))
    return F.regexp_replace(F.regexp_replace(found, r"\s{2,}", " "), r"^[ .\t,;:]+|[ .\t,;:]+$", "")


def period(title_: Column, body: Column) -> Column:
    """(start, end): whole years that the title or the head of the text names; else the year of the title's date."""

    def of(t: Column) -> list[Column]:
        span = F.when(t.rlike(YEARS), F.struct(F.regexp_extract(t, YEARS, 1).alias("a"), F.regexp_extract(t, YEARS, 2).alias("b")))
        one = F.when(t.rlike(YEAR), F.struct(F.regexp_extract(t, YEAR, 1).alias("a"), F.regexp_extract(t, YEAR, 1).alias("b")))
        return [span, one]

    named = F.coalesce(title_, F.lit(""))
    dated = F.when(named.rlike(DATED), F.struct(F.regexp_extract(named, DATED, 1).alias("a"), F.regexp_extract(named, DATED, 1).alias("b")))
    years = F.coalesce(*of(named), *of(F.substring(body, 1, HEAD)), dated)
    return F.struct(F.concat(years["a"], F.lit("-01-01")).alias("start"), F.concat(years["b"], F.lit("-12-31")).alias("end"))


def received(body: Column, session_date: Column, chamber: Column) -> Column:
    """(session_kind, session_date): of the sitting that the text names, else of the frontmatter. Days are not held against the calendar."""
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(body, RECEIVED, 2)))
    day, year = F.regexp_extract(body, RECEIVED, 1).try_cast("int"), F.regexp_extract(body, RECEIVED, 3).try_cast("int")
    named = F.when((month > 0) & day.between(1, 31) & year.between(FIRST_YEAR, LAST_YEAR), F.format_string("%04d-%02d-%02d", year, month, day))
    kind = F.when(body.rlike(JOINT), "joint").otherwise(first_of(*((chamber == c, k) for c, k in KINDS.items())))
    return F.struct(kind.alias("session_kind"), F.coalesce(named, F.when(session_date.rlike(r"^\d{4}-\d{2}-\d{2}$"), session_date)).alias("session_date"), F.lit(None).cast("string").alias("received_in_document"))


def headings(body: Column) -> Column:
    """(level, text, line) of first and second level headings but the recurring ones, without bold marks."""
    lines = F.transform(F.split(body, "\n"), lambda x, i: F.struct(x.alias("x"), (i + 1).alias("line")))
    heads = F.filter(lines, lambda h: h["x"].rlike(r"^#{1,2}\s+\S"))
    bare = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(x, r"^#{1,2}\s+", "")), r"^\*\*\s*", ""), r"\s*\*\*$", ""))
    named = F.transform(heads, lambda h: F.struct(F.length(F.regexp_extract(h["x"], r"^(#+)", 1)).alias("level"), bare(h["x"]).alias("text"), h["line"].alias("line")))
    return F.filter(named, lambda h: (h["text"] != "") & ~h["text"].rlike(SKIPPED))


def report(body: Column, session_date: Column, chamber: Column) -> Column:
    """All facts of a report, with its confidence: 0.6, more for each fact that is there."""
    t = title(body)
    named, when, where = issuer(t), period(t, body), received(body, session_date, chamber)
    has = lambda c, worth: F.when(c.isNotNull() & (c != ""), worth).otherwise(0.0)
    sure = F.least(F.lit(0.95), F.round(F.lit(0.6) + has(t, 0.15) + has(named, 0.1) + has(when["start"], 0.05) + has(where["session_date"], 0.05), 4))
    return F.struct(t.alias("title"), named.alias("issuing_body"), when.alias("reporting_period"), where.alias("received_at"), headings(body).alias("headings"), F.substring(body, 1, EXCERPT).alias("excerpt"), sure.alias("confidence"))
