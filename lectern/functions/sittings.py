"""Facts of a sitting: times, who led it, attendance and quorum, format, how it ended, special procedures; and the lines that recur in every issue."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import speakers
from lectern.functions.rules import extracted, first_of, quorum

# Words of openings and closings, with the letters that conversion leaves for marked ones.
SITTING = r"(?:[ŞȘª™S]edin[țtţþ˛]a|[Ss]edinta)"
BEGAN, ENDED = r"(?:a\s+[îÓŒÑ]nceput|[îÓŒÑ]ncepe)", r"(?:s-a\s+[îÓŒÑ]ncheiat|se\s+[îÓŒÑ]ncheie)"
AT = r"\s+la\s+ora\s+(\d{1,2})[.,:](\d{2})"
CHAIR_OPENS = r"_\s*(?:Lucr[ăaãâ„]rile\s+(?:[șsşº∫]edin[țtţþ˛]ei\s+)?(?:au\s+fost\s+conduse|sunt\s+conduse)|[ŞȘª™S]edin[țtţþ˛]a\s+a\s+fost\s+condus[ăaã„])"
CHAIR_MOST = 3000
PARTS = (
    (r"\b[îÓŒÑ]n\s+prima\s+parte\b", "prima parte"),
    (r"\b[îÓŒÑ]n\s+(?:cea\s+de-)?a\s+doua\s+parte\b", "a doua parte"),
    (r"\b[Aa]\s+doua\s+parte\s+a\s+[șsşº∫]edin[țtţþ˛]ei", "a doua parte"),
    (r"\b[Uu]ltima\s+parte\s+a\s+[șsşº∫]edin[țtţþ˛]ei", "ultima parte"),
)
PERSON = r"\b(?:domnul|doamna)\s+(?:(?P<rank>deputat|senator)\s+)?(?P<name>[A-ZȘȚÂÎĂ][\w\-]+(?:\s+[A-ZȘȚÂÎĂ][\w\-]+){0,4})(?:\s*,\s*(?P<role>[^,_;]+?(?:Camerei|Senatului|Deputa[țtţþ˛]ilor)[^,_;]*?))?"
ASSISTED = r"\basista[țt][i]?\s+de\b"
PART_TIME = r"la\s+ora\s+(?P<h>\d{1,2})[.:](?P<m>\d{2})"
ATTENDANCE = (
    r"(?ius)din\s+totalul\s+(?:celor\s+)?(?:de\s+)?(\d+)\s+(?:de\s+)?(?:deputa[țtţþ˛]i|senatori|deputa[țtţþ˛]i\s+[șsşº∫]i\s+senatori)[^.]*?"
    r"(?:[șs∫]i-au\s+[îÓŒÑ]nregistrat\s+prezen[țtţþ˛]a|[îÓŒÑ]n\s+acest\s+moment[,]?\s*[șs∫]i-au\s+[îÓŒÑ]nregistrat\s+prezen[țtţþ˛]a|prezen[țtţþ˛]a)[^.\n]*?(\d+)"
)
FORMATS = (
    (r"\bformat\s+mixt(?:\s+de\s+prezen[țt][ăa])?", "mixed"),
    (r"\bprin\s+mijloace\s+electronice\b", "mixed"),
    (r"\bonline\s+(?:[șs]i\s+)?fizic\b", "mixed"),
    (r"\bnumai\s+online\b|\bdoar\s+online\b", "online"),
    (r"\bîn\s+format\s+fizic\b|\ben\s+prezen[țt]a\s+fizic[ăa]\b", "in_person"),
)
IN_PERSON_BEFORE = 2020
ENDINGS = (
    (r"[Ss]uspend\s+[șsşº∫]edin[țtţþ˛]a\s+pentru\s+lipsa\s+cvorumului", "suspended_no_quorum"),
    (r"Declar\s+[îÓŒÑ]nchis[ăaã„]\s+[șsşº∫]edin[țtţþ˛]a", "completed"),
    (r"[Șșª™]edin[țtţþ˛]a\s+continu[ăaã„]\s+m[âaã]ine|se\s+va\s+relua\s+m[âaã]ine", "adjourned"),
    (r"[Ss]uspend\s+[șsşº∫]edin[țtţþ˛]a\b", "suspended_other"),
)
SPECIAL = (
    (r"[Șș]edin[țt][ăa]\s+solemn[ăa]\s+(?:comun[ăa]\s+)?consacrat[ăa]", "sedinta_solemna"),
    (r"[Dd]eschiderea\s+sesiunii\s+(?:ordinare|extraordinare)", "deschiderea_sesiunii"),
    (r"[Dd]eschiderea\s+legislaturii", "deschiderea_legislaturii"),
    (r"[Mm]esaj(?:ul)?\s+al?\s+Pre[șs]edintelui\s+Rom[âa]niei|[Dd]iscurs(?:ul)?\s+al?\s+Pre[șs]edintelui\s+Rom[âa]niei", "mesaj_prezidential"),
)
JOINT = r"[ȘS]EDIN[ȚT]E\s+COMUNE\s+ALE\s+CAMEREI\s+DEPUTA[ȚT]ILOR\s+[ȘS]I\s+SENATULUI"
JOINT_CHAMBERS = ("Camera Deputaților", "Senatul")
# Lines that recur in every issue, with the name of each.
RECURRING = (
    ("year_issue_banner", r"^Anul\s+\d+\s*\([IVXM]+\)\s*[—–-]\s*Nr\.\s*[0-9A-Za-z]+\s*$", False),
    ("weekday_date_line", r"^(?:Luni|Marți|Marţi|Marti|Miercuri|Joi|Vineri|Sâmbătă|S[âaă]mb[ăa]t[ăa]|Duminică|Duminica)\s*,\s*\d{1,2}\s+\w+\s+\d{4}\s*$", True),
    ("partea_header", r"^#{1,2}\s+\*\*\s*PA\s*R\s*T\s*E\s*A\s+A\s+I\s*I\s*-\s*A\s+DEZBATERI\s+PARLAMENTARE\s*\*\*\s*$", True),
    ("dezbateri_header", r"^#{1,2}\s+\*\*\s*DEZBATERI\s+PARLAMENTARE\s*\*\*\s*$", True),
    ("chamber_heading", r"^#{1,2}\s+\*\*\s*(?:CAMERA\s+DEPUTA[ȚTÞ]ILOR|SENATUL|CAMERA\s+DEPUTATILOR)\s*\*\*\s*$", True),
    ("session_label", r"^SESIUNEA[^\n]{0,200}$", False),
    ("legislature_paren", r"^\(\s*Legislatura[^\n)]{0,80}\)\s*$", True),
)

_parts = [(re.compile(p, re.I), label) for p, label in PARTS]
_recurring = [(name, re.compile(p, re.M | (re.I if any_case else 0))) for name, p, any_case in RECURRING]


def clock(text: Column, pattern: str) -> Column:
    """HH:MM of the first match's hour and minute."""
    p = "(?iu)" + pattern
    return F.when(text.rlike(p), F.format_string("%02d:%02d", F.regexp_extract(text, p, 1).cast("int"), F.regexp_extract(text, p, 2).cast("int")))


def opened_at(text: Column) -> Column:
    return clock(text, SITTING + r"\s+" + BEGAN + AT)


def closed_at(text: Column) -> Column:
    return clock(text, SITTING + r"\s+" + ENDED + AT)


def attendance(text: Column) -> Column:
    """registered, total_seats, and whether that makes a quorum (null where a number is missing or zero)."""
    total, registered = (extracted(text, ATTENDANCE, g).try_cast("int") for g in (1, 2))
    return F.struct(registered.alias("registered"), total.alias("total_seats"), F.when(total != 0, quorum(registered, total)).alias("quorum_met"))


def sitting_format(text: Column, year: Column) -> Column:
    """mixed, online or in person; years before it became possible to join online are in person."""
    return F.coalesce(first_of(*((text.rlike("(?iu)" + p), v) for p, v in FORMATS)), F.when(year < IN_PERSON_BEFORE, "in_person"))


def ending(text: Column) -> Column:
    return F.coalesce(first_of(*((text.rlike("(?iu)" + p), v) for p, v in ENDINGS)), F.when(closed_at(text).isNotNull(), "completed"))


def special_procedure(text: Column) -> Column:
    head = F.substring(text, 1, 5000)
    return first_of(*((head.rlike("(?iu)" + p), v) for p, v in SPECIAL))


def chambers_present(text: Column) -> Column:
    """Both chambers in a joint sitting, else none."""
    return F.when(text.rlike("(?iu)" + JOINT), F.array(*map(F.lit, JOINT_CHAMBERS))).otherwise(F.array().cast("array<string>"))


def facts(text: Column, year: Column) -> Column:
    seen = attendance(text)
    return F.struct(
        opened_at(text).alias("opened_at"), closed_at(text).alias("closed_at"), F.struct(seen["registered"].alias("registered"), seen["total_seats"].alias("total_seats")).alias("attendance"), seen["quorum_met"].alias("quorum_met"),
        sitting_format(text, year).alias("format"), ending(text).alias("outcome"), special_procedure(text).alias("special_procedure"), chambers_present(text).alias("chambers_present"), chair_segments(text).alias("chair_segments"),
    )


# ---- who led it


def _persons(text: str) -> list[dict]:
    """People named with a rank or an office, once each."""
    found: dict[str, dict] = {}
    for m in re.finditer(PERSON, text):
        role = re.sub(r"\s+", " ", m["role"].strip()) if m["role"] else None
        if m["rank"] or role:
            title = m["rank"].lower() if m["rank"] else "senator" if "Senatului" in role else "deputat"
            found.setdefault(m["name"].strip(), dict.fromkeys(speakers.KEYS) | {"raw": re.sub(r"\s+", " ", m[0].strip()), "name": m["name"].strip(), "title": title, "role": role})
    return list(found.values())


def segments_of(text: str) -> list[dict]:
    """Who led which part: chair, secretaries, the part's label and when it began. The block goes from its opening to the first speaker."""
    opens = re.search(CHAIR_OPENS, text, re.I)
    if opens is None:
        return []
    speaker = re.compile(r"^##\s+\*\*", re.M).search(text, opens.end())
    block = text[opens.start() : speaker.start() if speaker else min(len(text), opens.end() + CHAIR_MOST)]
    label_of = lambda s: next((label for p, label in _parts if p.search(s)), None)
    parts = [p for p in re.split(r"\n\s*\n", block) if p.strip()] if label_of(block) else [block]
    out = []
    for part in parts or [block]:
        aid = re.search(ASSISTED, part, re.I)
        secretaries = _persons(part[aid.end() :]) if aid else []
        began = re.search(PART_TIME, part, re.I)
        out += [{"chair": c, "secretaries": secretaries, "segment_label": label_of(part), "started_at": f"{int(began['h']):02d}:{int(began['m']):02d}" if began else None} for c in _persons(part[: aid.start()] if aid else part)]
    return out


_WHO = "struct<" + ",".join(f"{k}:string" for k in speakers.KEYS) + ">"
SEGMENTS = f"array<struct<chair:{_WHO},secretaries:array<{_WHO}>,segment_label:string,started_at:string>>"
_who = pa.struct([(k, pa.string()) for k in speakers.KEYS])
_segments = pa.list_(pa.struct([("chair", _who), ("secretaries", pa.list_(_who)), ("segment_label", pa.string()), ("started_at", pa.string())]))


def chair_segments(text: Column) -> Column:
    @F.arrow_udf(SEGMENTS)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([segments_of(t or "") for t in texts.to_pylist()], _segments)

    return run(text)


# ---- recurring lines


def recurring_of(text: str) -> list[dict]:
    """(reason, start, end) of lines that recur in every issue, by kind, then place."""
    return [{"reason": f"shared_boilerplate.{name}", "start": m.start(), "end": m.end()} for name, p in _recurring for m in p.finditer(text) if m.end() > m.start()]


def recurring(text: Column) -> Column:
    @F.arrow_udf("array<struct<reason:string,start:int,`end`:int>>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([recurring_of(t or "") for t in texts.to_pylist()], pa.list_(pa.struct([("reason", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))

    return run(text)
