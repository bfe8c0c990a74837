"""Syntheses of committee work: the period, and per committee its kind, dates, hours, format, purpose, agenda, roster and whom it sat with.

A roster stands in a table, as a list of a day or in prose; where several do, the table's entry for a name comes first and later ones only add to it.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import citations
from lectern.functions.rules import MONTHS

# The layouts of a period, in order, with the groups of first and last day and month.
DASH = r"\s*[-–—]\s*"
PERIODS = (
    (r"Perioada\s*:?\s*(?P<d1>\d{1,2})\s*\.\s*(?P<m1>\d{1,2})\s*\.?" + DASH + r"(?P<d2>\d{1,2})\s*\.\s*(?P<m2>\d{1,2})\s*\.\s*(?P<y>\d{4})"),
    (r"Perioada\s*:?\s*(?P<d1>\d{1,2})" + DASH + r"(?P<d2>\d{1,2})\s*\.\s*(?P<m1>\d{1,2})\s*\.\s*(?P<y>\d{4})"),
    (r"Perioada\s*:?\s*(?P<d1>\d{1,2})\s*\.\s*(?P<m1>\d{1,2})" + DASH + r"(?P<d2>\d{1,2})\s*\.\s*(?P<m2>\d{1,2})\s*[;,][^\n]*?(?P<y>\d{4})"),
    (r"Perioada\s*:?\s*(?P<d1>\d{1,2})\s*\.\s*(?P<m1>\d{1,2})\s*\.\s*(?P<y>\d{4})"),
)
FIRST_YEAR, LAST_YEAR, ORDINAL_MOST, OUTCOME_MOST = 1990, 2100, 200, 600
# Headers of committees, where the publisher's lines begin, names of a committee that stands alone.
HEADER = (
    r"^##\s+(?:\d+\s*\.\s*\*\*\s*(?P<a>Comisia[^*\n]+?)\s*\*\*|\d+\s+\*\*\s*\.\s*(?P<b>Comisia[^*\n]+?)\s*\*\*|\*\*\s*\d+\s*\.\s*(?P<c>Comisia[^*\n]+?)\s*\*\*|\*\*\s*(?P<d>Comisia[^*\n]+?)\s*\*\*)\s*$"
)
FOOTER = r"^(?:##\s+)?\*\*EDITOR\s*:\s*PARLAMENTUL\s+ROM[ÂA¬‚]NIEI"
ALONE_LISTED = r"^\s*1\.\s*(?P<name>Comisia[^\n]+?)(?:\.{3,}|\s+\d+(?:[-–]\d+)?\s*$)"
ALONE_TITLED = r"\bSINTEZA\s+LUCR[ĂÃA√]RILOR\s+COMISIEI(?P<name>[^*\n]+?)\*\*"
ALONE_TOLD = r"^\s*(?P<name>Comisi(?:a|ile)\s+pentru[^\n.]{5,200}?)\s+(?:s-au\s+[îÓo]ntrunit|[șş]i-au?\s+desf[ăa][șş]urat|au\s+dezb[ăa]tut)"
# What tells a committee's kind; dates after the words that announce them; hours.
INQUIRY, SPECIAL = r"\banchet[ăaã]\b", r"\bspecial(?:[ăaã]|„)"
TOGETHER = r"\bcomun[ăaã]?\b|\bdeputa[țţt]ilor\s+[șşs][iî]\s+senatului\b"
DATES_LEAD = r"[șş]i-a\s+desf[ăa][șş]urat\s+(?:lucr[ăa]rile|activit[ăa][țţþt]ea)\s+(?:[îi]n\s+)?(?:zilele\s+de|ziua\s+de|perioada(?:\s+(?:de|cuprins[ăa]))?)\s+"
MONTH_YEAR = r"\b(?P<month>" + "|".join(MONTHS) + r")\s+(?P<year>\d{4})\b"
DATES_REACH = 200
HOURS = r"(\d{1,2})[.:,](\d{2})" + DASH + r"(\d{1,2})[.:,](\d{2})"
# Formats, purposes, roles, kinds of output, outcomes and majorities, each in order.
FORMATS = (
    ("mixed", r"\b(?:cu\s+prezen[țţt][ăa]\s+fizic[ăa]\s+[șşs]i\s+online|prezen[țţt][ăa]\s+fizic[ăa]\s+[șşs]i\s+online|în\s+sistem\s+mixt|atât\s+la\s+sediul\s+Camerei\s+Deputa[țţt]ilor[^\n]*?(?:cât\s+[șşs]i\s+prin|prin)\s+(?:intermediul\s+)?mijloacelor?\s+electronice|fizic\s+[șşs]i\s+online)\b"),
    ("online", r"\b(?:exclusiv\s+(?:prin\s+(?:intermediul\s+)?mijloacelor?\s+electronice|online)|integral\s+online|în\s+întregime\s+online)\b"),
)
PURPOSES = (
    ("audiere_candidați", r"\bAudierea?\s+(?:domnului|doamnei)?[^\n]{0,80}?candidat\s+pentru\s+ocuparea\s+func[țţt]iei"),
    ("documentare_consultare", r"\bdocumentare\s+[șşs]i\s+consultare\b"),
    ("aprobare_raport", r"\baprobarea?\s+raport(?:ului)?\b"),
)
ROLES = (("fond_comun", r"\bfond\s+comun\b|\bfond\s+împreună\b"), ("aviz", r"\baviz\b(?!\s+pentru\s+Comisi)|\baviz\s+pentru\s+Comisi"), ("fond", r"\b(?:sesiz(?:are|at[ăa])\s+)?(?:în\s+)?fond\b"))
OUTPUTS = (
    ("raport_comun_suplimentar", r"\braport\s+comun\s+suplimentar\b"), ("raport_comun", r"\braport\s+comun\b"), ("raport_preliminar", r"\braport\s+preliminar\b"), ("raport_suplimentar", r"\braport\s+suplimentar\b"),
    ("proiect_de_opinie", r"\bproiect\s+de\s+opinie\b"), ("studiu", r"\bstudiu\b"), ("amânare", r"\b(?:am[âa]nat[ăa]?|am[âa]nare)\b"), ("raport", r"\braport(?:ul)?\b"), ("aviz", r"\baviz(?:are)?\b"),
)
OUTCOMES = (
    ("deferred", r"\b(?:am[âa]nat[ăa]?|s-a\s+amânat|amânare(?:a)?)\b"),
    ("rejected", r"\b(?:respin(?:s|g)\w*|nefavorabil\w*|aviz(?:\s+|are\s+)negativ\w*|raport\s+de\s+respingere)\b"),
    ("approved", r"\b(?:aprob\w*|adopt\w*|favorabil\w*|aviz(?:\s+|are\s+)favorabil\w*|raport\s+de\s+adoptare)\b"),
)
MAJORITIES = (("unanimous", r"\b(?:cu\s+unanimitate(?:a)?\s+(?:de\s+)?voturi(?:lor)?|în\s+unanimitate)\b"), ("majority", r"\b(?:cu\s+majoritate\s+(?:de\s+)?voturi)\b"))
COUNTS = {"for": r"(\d+)\s+(?:de\s+)?voturi?\s+pentru\b", "against": r"(\d+)\s+(?:vot(?:uri)?|de\s+voturi)?\s*(?:împotriv[ăa]|contra)", "abstain": r"(\d+|dou[ăa]|trei|patru|cinci)\s+(?:ab[țţt]ineri?|de\s+ab[țţt]ineri)"}
NUMERALS = {"două": 2, "doua": 2, "trei": 3, "patru": 4, "cinci": 5}
# Items of an agenda as a list, the paragraphs that tell an outcome, and an agenda as a table.
ITEM = r"^\s*(?P<ord>\d+)\.\s+(?P<title>[^\n]+(?:\n(?!\s*\d+\.\s|\s*$)[^\n]+)*)"
OUTCOME_LEAD = r"\b(?:În\s+urma|Supus[ăa]\s+la\s+vot|Proiectul\s+de\s+lege\s+a\s+fost|Propunerea\s+legislativ[ăa]\s+a\s+fost|Am[âa]nat[ăa]?|Membrii\s+comisiei\s+au\s+hot[ăa]r[âa]t)\b"
OUTCOME_PARAGRAPHS = 5
TABLE_HEAD = r"^\|\s*(?:[^|\n]*?\bNr[\.<]|Nr\.<br)[^\n]*?(?:PL-?x|P\s*L-?x|Titlu|Scopul|Rezolu[țţt]ie)[^\n]*\|"
CELL_ORDINAL, CELL_BILL = r"^(\d+)\.?$", r"\b(?:PL-?x|Pl-?x)\b"
CELL_OUTCOME = r"^(?:[ÎIi]n\s+urma|[ÎIi]n\s+formă|deputa[țţt]ii\s+prezen[țţt]i|cu\s+majoritate|cu\s+unanimitate|Supus[ăa]\s+la\s+vot|Aprobat|Respin[gs])"
CELL_ROLE = r"^(?:Raport|Aviz|Studiu|Proiect\s+de\s+opinie|Am[âa]nare)\b"
# Attendance in a table's cell, in order; names in cells; substitutes.
STATUSES = ((r"^[ÎIi]nlocuit", "substituted"), (r"^Prezen[țţt][ăa]?\s+fizic", "physical"), (r"^Prezen[țţt][ăa]?\s+la\s+sediul", "physical"), (r"^Prezen[țţt][ăa]?\s+online", "online"), (r"^Absen[țţt][ăa]?", "absent"))
CELL_NAME = r"^[A-ZȘȚĂÂÎŞŢ][A-ZȘȚĂÂÎŞŢa-zșțăâîşţăáàäéèëíìïóòöúùüçÉÈÀ-ſ\-–—\.\s]+$"
NOT_NAMES = r"\b(?:Numele|Prezen[țţt][ăa]?|Absen[țţt][ăa]?|Pagina|MONITORUL|OFICIAL|Nr\.\s*crt\.|PL-x|Titlu|Scopul|Rezolu[țţt]ie|Ordine|Neafiliat[ăa]?|Grupul\s+parlamentar|UDMR|PSD|PNL|USR|AUR|POT|UNESCO|min(?:o|ó)rit[ăa]ti?|na[țţ]ionale)\b"
OFFICE = r"(?P<role>pre[șşs]edinte|vicepre[șşs]edinte|secretar|membru)\b"
CELL_SUBSTITUTE = r"[ÎIi]nlocuit(?:or|[ăa])?(?:\s+(?:online|fizic|par[țţt]ial))?(?:\s*[:,]\s*|\s+(?:de|prin)\s+)(?P<name>[^|\n]+)"
# A day's list; prose of presence, absence and substitution; names in prose.
DAY_LINE = r"^\s*(?P<ord>\d+)\.\s+(?P<name>[^,\n–-]+?)(?:\s*[–-]\s*" + OFFICE[:-2].replace("<role>", "<before>") + r")?\s*,\s*Grupul\s+parlamentar\s+al\s+(?P<tail>[^\n]+)$"
DAY_GROUP = r"^(?P<group>[A-Z][A-Za-z\.\-]*(?:\s+[A-Z][A-Za-z\.\-]*)*)"
PROSE = (
    ("physical", r"\b(?:au\s+fost\s+prezen[țţt]i\s+urm[ăa]torii\s+deputa[țţt]i|au\s+fost\s+prezen[țţt]i|[șşs]i-au\s+înregistrat\s+prezen[țţt]a\s+(?:la\s+lucr[ăa]ri\s+)?(?:urm[ăa]torii\s+deputa[țţt]i)?|Membrii\s+prezen[țţt]i\s+la\s+lucr[ăa]ri)(?:[^:.]{0,120}?)?\s*[:,]\s*(?P<list>[^.]+)"),
    ("online", r"(?:Domnii\s+deputa[țţt]i|Domnul\s+deputat|Doamnele\s+deputat|Doamna\s+deputat)\s+(?P<list>[^.]+?)\s+au?\s+fost\s+prezen[țţt]i\s+(?:on-?line|online)"),
    ("substituted", r"(?P<subject>[A-ZȘȚĂÂÎŞŢ][\w\-]+(?:\s+[A-ZȘȚĂÂÎŞŢ][\w\-]+)+)\s*[–-]\s*[ÎIi]nlocuit(?:[ăa])?(?:\s+par[țţt]ial)?\s+de\s+(?:domnul|doamna)?\s*deputat[ăa]?\s+(?P<sub>[A-ZȘȚĂÂÎŞŢ][\w\-]+(?:\s+[A-ZȘȚĂÂÎŞŢ][\w\-]+)+)"),
    ("absent", r"(?:Au\s+absentat\s+motivat|au\s+absentat\s+motivat|au\s+absentat)\s*[:,]?\s*(?P<list>[^.]+)"),
)
NAMES_APART, NAME_TAIL = r",\s*|\s+[șşs][ii]\s+", r"\s*[–-]\s*(?:pre[șs]edinte|vicepre[șs]edinte|secretar|membru|membri)\b[^,\n]*|\s*\([^)]*\)"
# Sittings with other committees.
JOINT = r"\b[îi]n\s+(?:[șş]edin[țţt][ăa]\s+)?comun[ăa]?\s+cu\s+(?P<list>Comisi(?:a|ile|ilor|ei)\b[^.\n;:]+)"
JOINT_NOT_AFTER, NOT_AFTER_REACH = r"\b(?:raport(?:\s+comun)?|aviz(?:\s+comun)?|sesizar[eo]|sesizat[ăa]|fond|studiu|raportor)\b", 30
JOINT_EACH = r"\bComisi(?:a|ile|ilor|ei)\b"
JOINT_NAMED = r"^Comisi(?:a|ile|ilor|ei)\s+(?:pentru|juridic[ăa]|economic[ăa]|de|permanent[ăa]|comun[ăa]|special[ăa]|parlamentar[ăa]|na[țţ]ional[ăa]|central[ăa]|anchet[ăa])\b"
JOINT_CHAMBER = r"\b(?:din(?:\s+cadrul)?|a)\s+(?P<chamber>(?:Camer[ae]i?\s+Deputa[țţt]ilor|Senat(?:ul|ului)?))\b"
JOINT_TAIL = r"\s+(?:din(?:\s+cadrul)?|a)\s+(?:Camer[ae]i?\s+Deputa[țţt]ilor|Senat(?:ul|ului)?).*$|\s+(?:a\s+desf[ăa][șş]urat|s-a\s+desf[ăa][șş]urat|a\s+avut\s+loc).*$|,\s+a\s+desf[ăa][șş]urat.*$|,\s+a\s+deliberat.*$"
# Signatures of chair and secretary, in order.
CHAIR = tuple(r"\bPRE(?:[ȘŞS�])?EDINTE" + x + r"\s*(?P<name>[^*\n]+?)\s*\*\*" for x in (r"\s*,\s*\*\*", r"\s*,?\s*\n+##\s*\*\*", r"\s*,?\s*\n+\*\*"))
SECRETARY = tuple(r"(?<!\w)" + x + r"\s*(?P<name>[^*\n]+?)\s*\*\*" for x in (r"SECRETAR\s*,\s*\*\*", r"##\s+SECRETAR\s*,\s*\*\*", r"SECRETAR\s*,?\s*\n+##\s*\*\*", r"SECRETAR\s*,?\s*\n+\*\*"))


def _line(s: str) -> str:
    return " ".join(s.split())


def _label(rules, text: str) -> str | None:
    return next((label for label, p in rules if re.search(p, text, re.I)), None)


def _date(year: int, month: int, day: int) -> str | None:
    return f"{year:04d}-{month:02d}-{day:02d}" if FIRST_YEAR <= year <= LAST_YEAR and 1 <= month <= 12 and 1 <= day <= 31 else None


def period_of(text: str) -> tuple[str | None, str | None]:
    """First and last day, by the first layout that fits; days aren't held against the calendar."""
    for p in PERIODS:
        if m := re.search(p, text, re.I):
            g = m.groupdict()
            year, month = int(g["y"]), int(g["m1"])
            return _date(year, month, int(g["d1"])), _date(year, int(g.get("m2") or month), int(g.get("d2") or g["d1"]))
    return None, None


def kind_of(name: str) -> str:
    """inquiry, special or permanent; joint where both chambers take part."""
    low = name.lower()
    joint = bool(re.search(TOGETHER, low))
    base = "inquiry" if re.search(INQUIRY, low) else "special" if re.search(SPECIAL, low) or joint else "permanent"
    return f"{base}_joint" if joint else base


def dates_of(text: str) -> list[str]:
    """The days before the first month and year after the words that announce them."""
    lead = re.search(DATES_LEAD, text, re.I)
    if lead is None:
        return []
    window = re.sub(r"[*_]+", "", text[lead.end() : lead.end() + DATES_REACH])
    when = re.search(MONTH_YEAR, window, re.I)
    if when is None:
        return []
    month, year = MONTHS.index(when["month"].lower()) + 1, int(when["year"])
    days = [int(d) for d in re.findall(r"\b(\d{1,2})\b", window[: when.start()])]
    return list(dict.fromkeys(d for d in (_date(year, month, day) for day in days) if d))


def hours_of(text: str) -> list[dict]:
    found = [tuple(map(int, m)) for m in re.findall(HOURS, text)]
    return [{"start": f"{a:02d}:{b:02d}", "end": f"{c:02d}:{d:02d}"} for a, b, c, d in found if a < 24 and c < 24 and b < 60 and d < 60]


def votes_summed(text: str | None) -> dict | None:
    """Outcome, majority and counts that a paragraph tells; null where it tells no outcome."""
    outcome = _label(OUTCOMES, text or "")
    if outcome is None:
        return None
    told = {k: m[1].lower() if (m := re.search(p, text, re.I)) else None for k, p in COUNTS.items()}
    return {"outcome": outcome, "majority": _label(MAJORITIES, text)} | {k: None if v is None else int(v) if v.isdigit() else NUMERALS[v] for k, v in told.items()}


# ---- agendas


def _outcome_after(text: str) -> str | None:
    paragraphs = [p.strip() for p in re.split(r"\n\s*\n", text)[:OUTCOME_PARAGRAPHS]]
    return next((p if len(p) <= OUTCOME_MOST else p[: OUTCOME_MOST - 1] + "…" for p in paragraphs if re.match(OUTCOME_LEAD, p, re.I)), None)


def _item(ordinal: int, title: str, cited: str, role_text: str, told: str | None, start: int, end: int) -> dict:
    refs = [r for r in citations.citations_of(cited) if FIRST_YEAR <= (r["year"] or 0) <= LAST_YEAR]
    role = _label(ROLES, role_text) if role_text else None
    kinds = [_label(OUTPUTS, t) for t in (role_text, title, told or "") if t]
    summed = votes_summed(told)
    out = {"ordinal": ordinal, "title": title, "references": [{"type": r["type"], "prefix": r["prefix"], "number": r["number"], "year": r["year"], "raw": r["raw"]} for r in refs], "committee_role": role or _label(ROLES, title), "output_type": next((k for k in kinds if k), None), "outcome_text": told, "vote_summary": summed, "start": start, "end": end}
    sure = 0.6 + 0.15 * bool(refs) + 0.05 * sum(bool(out[k]) for k in ("committee_role", "output_type", "outcome_text", "vote_summary"))
    return out | {"confidence": round(min(0.95, sure), 4)}


def _bare(title: str) -> str:
    return re.sub(r"[\s.]+$", "", title)


def agenda_of(text: str) -> list[dict]:
    """Items of a list whose numbers follow each other (or begin anew at 1), else of a table."""
    kept: list[tuple[int, int, str]] = []
    for m in re.finditer(ITEM, text, re.M):
        ordinal, title = int(m["ord"]), _bare(_line(m["title"]))
        if title and 1 <= ordinal <= ORDINAL_MOST and (ordinal == (kept[-1][0] if kept else 0) + 1 or (ordinal == 1 and kept)):
            kept.append((ordinal, m.start(), title))
    ends = [*(at for _, at, _ in kept[1:]), len(text)]
    listed = [_item(o, t, t, "", _outcome_after(text[at + len(t) : end]), at, end) for (o, at, t), end in zip(kept, ends, strict=False)]
    return listed or _table_of(text)


def cells_of(line: str) -> list[str]:
    """A table row's cells; none for a rule or another line."""
    if not line.startswith("|") or re.match(r"^\|\s*[-:|\s]+\s*$", line.strip()):
        return []
    return [c.strip() for c in line.rstrip().removesuffix("|").removeprefix("|").split("|")]


def _table_of(text: str) -> list[dict]:
    """Rows that begin with a number below an agenda's head; their cells are told apart by what they say."""
    rows, inside, at = [], False, 0
    for line in text.splitlines(keepends=True):
        here, at = at, at + len(line)
        if re.match(TABLE_HEAD, line, re.I):
            inside = True
        elif inside and not line.strip():
            inside = False
        elif inside:
            cells = [_line(re.sub(r"<br\s*/?>", " ", c, flags=re.I)) for c in cells_of(line)]
            filled = [c for c in cells[:4] if c]
            number = re.match(CELL_ORDINAL, filled[0]) if filled else None
            if number and 1 <= int(number[1]) <= ORDINAL_MOST:
                found = {"ref": "", "role": "", "told": "", "title": ""}
                for c in cells:
                    if not c or (c == cells[0] and re.match(CELL_ORDINAL, c)):
                        continue
                    slot = next((k for k, p in (("ref", CELL_BILL), ("role", CELL_ROLE), ("told", CELL_OUTCOME)) if not found[k] and re.search(p, c, re.I)), None)
                    if slot:
                        found[slot] = c
                    elif len(c) > len(found["title"]):
                        found["title"] = c
                if found["title"] or found["ref"]:
                    rows.append((int(number[1]), here, found))
    ends = [*(at for _, at, _ in rows[1:]), len(text)]
    short = lambda t: t if len(t) <= OUTCOME_MOST else t[: OUTCOME_MOST - 1] + "…"
    return [_item(o, _bare(f["title"] or f["ref"]), f["ref"] or f["title"], f["role"], short(f["told"]) or None, at, end) for (o, at, f), end in zip(rows, ends, strict=False)]


# ---- rosters


def _entry(name: str, mode: str, role: str | None = None, substitute: str | None = None, group: str | None = None) -> dict:
    return {"name": name, "mode": mode, "role": role.lower().replace("ş", "ș") if role else None, "substituted_by": substitute, "party_group": group}


def roster_table(text: str) -> list[dict]:
    """Pairs of a name's cell and the next cell that tells attendance, a name once."""
    found: dict[str, dict] = {}
    for line in text.splitlines():
        name = None
        for c in cells_of(line):
            mode = next((m for p, m in STATUSES if re.search(p, c, re.I)), None)
            if mode is None:
                if not re.search(NOT_NAMES, c, re.I) and re.match(CELL_NAME, c) and len(c.split()) > 1:
                    name = c
            elif name:
                office = re.match(r"^(?P<name>.+?)\s*[–-]\s*" + OFFICE, name, re.I)
                who = _line(office["name"] if office else name)
                sub = re.search(CELL_SUBSTITUTE, c, re.I) if mode == "substituted" else None
                found.setdefault(who.lower(), _entry(who, mode, office["role"] if office else None, _line(sub["name"]) or None if sub else None))
                name = None
    return list(found.values())


def roster_day(text: str) -> list[dict]:
    found: dict[str, dict] = {}
    for m in re.finditer(DAY_LINE, text, re.M | re.I):
        name, tail = _line(m["name"]), m["tail"].strip()
        if name and 1 <= int(m["ord"]) <= ORDINAL_MOST:
            group, office = re.match(DAY_GROUP, tail), re.search(r"\b" + OFFICE, tail, re.I)
            found.setdefault(name, _entry(name, "physical", m["before"] or (office["role"] if office else None), None, group["group"].rstrip(" .,") or None if group else None))
    return list(found.values())


def _names_in(text: str) -> list[tuple[str, str | None]]:
    out = []
    for part in re.split(NAMES_APART, text, flags=re.I):
        office = re.search(r"\s*[–-]\s*" + OFFICE, part, re.I)
        name = re.sub(NAME_TAIL, "", part.strip(), flags=re.I).strip(" ,.;–-")
        if 3 <= len(name) <= 100 and name[0].isupper() and not any(c.isdigit() for c in name):
            out.append((name, office["role"] if office else None))
    return out


def roster_prose(text: str) -> list[dict]:
    """Presence told in prose; then who joined online, who was substituted, who was absent. Absence changes only who was there in person."""
    found: dict[str, dict] = {}
    for mode, p in PROSE:
        for m in re.finditer(p, text, re.I):
            people = [(_line(m["subject"]), None)] if mode == "substituted" else _names_in(m["list"])
            sub = _line(m["sub"]) if mode == "substituted" else None
            for name, role in people:
                old = found.get(name)
                if old is None:
                    found[name] = _entry(name, mode, role, sub)
                elif mode == "physical":
                    old["role"] = old["role"] or _entry(name, mode, role)["role"]
                elif mode != "absent" or old["mode"] == "physical":
                    old |= {"mode": mode} | ({"substituted_by": sub} if sub else {})
    return list(found.values())


def roster_of(text: str) -> list[dict]:
    merged: dict[str, dict] = {}
    for e in [*roster_table(text), *roster_day(text), *roster_prose(text)]:
        old = merged.setdefault(e["name"].lower(), e)
        old |= {k: old[k] or e[k] for k in ("substituted_by", "role")}
    return list(merged.values())


# ---- committees


def joint_with_of(text: str) -> list[dict]:
    """(name, chamber) of committees that sat along. One chamber named for the last holds for all where no other is named."""
    out: dict[tuple, dict] = {}
    for m in re.finditer(JOINT, text, re.I):
        if re.search(JOINT_NOT_AFTER, text[max(0, m.start() - NOT_AFTER_REACH) : m.start()], re.I):
            continue
        listed = m["list"].strip()
        cuts = [x.start() for x in re.finditer(JOINT_EACH, listed, re.I)]
        parts = [re.sub(r"\s+[șşs][ii]\s*$", "", listed[a:b].strip().strip(",; \t\n"), flags=re.I) for a, b in zip(cuts, [*cuts[1:], len(listed)], strict=True)]
        named = [(p, "camera" if "camer" in c["chamber"].lower() else "senat") if (c := re.search(JOINT_CHAMBER, p, re.I)) else (p, None) for p in parts if re.match(JOINT_NAMED, p, re.I)]
        chambers = {c for _, c in named if c}
        if named and named[-1][1] and len(chambers) == 1:
            named = [(p, named[-1][1]) for p, _ in named]
        for p, chamber in named:
            if name := _line(re.sub(JOINT_TAIL, "", p, flags=re.I).strip(" .,;")):
                out.setdefault((name.lower(), chamber), {"name": name, "chamber": chamber})
    return list(out.values())


def _signed(patterns: tuple, text: str) -> str | None:
    return next((n for p in patterns if (m := re.search(p, text, re.I)) and (n := _line(m["name"]))), None)


def alone_of(text: str) -> str | None:
    """The name of a committee that has the synthesis for itself."""
    if m := re.search(ALONE_LISTED, text, re.M):
        return _tidy_name(m["name"])
    if (m := re.search(ALONE_TITLED, text, re.I)) and _line(m["name"]):
        return f"Comisia {_line(m['name'])}"
    return _line(m["name"]) if (m := re.search(ALONE_TOLD, text, re.M | re.I)) else None


def _tidy_name(name: str) -> str:
    return _line(re.sub(r"\.{3,}\s*\d+(?:[-–]\d+)?\s*$", "", name))


def committees_of(text: str) -> list[dict]:
    """The committees of a synthesis, each with what its block tells."""
    footer = re.search(FOOTER, text, re.M | re.I)
    last = footer.start() if footer else len(text)
    heads = [(m.start(), _tidy_name(next(filter(None, m.groups())))) for m in re.finditer(HEADER, text, re.M | re.I)]
    if not heads and (name := alone_of(text)):
        heads, last = [(0, name)], last or len(text)
    out = []
    for (start, name), stop in zip(heads, [*(s for s, _ in heads[1:]), last], strict=False):
        end = min(stop, last)
        if end <= start:
            continue
        block = text[start:end]
        agenda, dates = agenda_of(block), dates_of(block)
        chair, secretary = _signed(CHAIR, block), _signed(SECRETARY, block)
        sure = sum(i["confidence"] for i in agenda) / len(agenda) if agenda else min(0.85, 0.6 + 0.1 * bool(chair) + 0.05 * bool(secretary) + 0.1 * bool(dates))
        agenda = [i | {"start": i["start"] + start, "end": i["end"] + start} for i in agenda]
        out.append({"name": name, "kind": kind_of(name), "chair": chair, "secretary": secretary, "dates": dates, "time_windows": hours_of(block), "format": _label(FORMATS, block), "purpose": _label(PURPOSES, block), "joint_with": joint_with_of(block), "agenda": agenda, "roster": roster_of(block), "start": start, "end": end, "confidence": round(sure, 4)})
    return out


_VOTES = "struct<outcome:string,majority:string,`for`:int,against:int,abstain:int>"
_AGENDA = f"array<struct<ordinal:int,title:string,references:array<struct<type:string,prefix:string,number:string,year:int,raw:string>>,committee_role:string,output_type:string,outcome_text:string,vote_summary:{_VOTES},start:int,`end`:int,confidence:double>>"
COMMITTEES = (
    "array<struct<name:string,kind:string,chair:string,secretary:string,dates:array<string>,time_windows:array<struct<start:string,`end`:string>>,format:string,purpose:string,joint_with:array<struct<name:string,chamber:string>>,"
    f"agenda:{_AGENDA},roster:array<struct<name:string,mode:string,role:string,substituted_by:string,party_group:string>>,start:int,`end`:int,confidence:double>>"
)


def committees(text: Column) -> Column:
    """The committees of each synthesis."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType

    kind = to_arrow_type(DataType.fromDDL(COMMITTEES))

    @F.arrow_udf(COMMITTEES)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([committees_of(t or "") for t in texts.to_pylist()], kind)

    return run(text)


def period(text: Column) -> Column:
    @F.arrow_udf("struct<start:string,`end`:string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([dict(zip(("start", "end"), period_of(t or ""), strict=True)) for t in texts.to_pylist()], pa.struct([("start", pa.string()), ("end", pa.string())]))

    return run(text)
