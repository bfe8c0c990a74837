"""Agendas: the summary table, the spans of items in the body, and what happens in an item, in order.

A summary is written in one of three layouts; items are found in the body by their numbers. A turn is split at the votes, stage directions and deferrals in it.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import extract, speakers
from lectern.functions.rules import extracted, first_of

# Where a summary begins and ends, and how many characters it has at most.
SUMMARY_OPENS = r"^(?:##?\s+)?SUMAR\s*$|^\|SUMAR(?=<br>|\|)"
SUMMARY_ENDS = r"_\s*(?:[ŞȘª™S]edin[țtţþ˛]a|[Ss]edinta)\s+a\s+[îÓŒÑ]nceput|^##\s"
SUMMARY_MOST, ORDINAL_MOST = 50_000, 200
# The layouts of a summary's items: within a cell, as rows, as lines.
LAYOUTS = (
    (r"(?:<br>|^|\|)\s*(?P<ord>\d{1,3})\.\s*(?P<rest>(?:(?!<br>\d{1,3}\.).)+?)(?=<br>\d{1,3}\.|<br>\||\|Pagina\||$)", re.S),
    (r"^\|\s*(?P<ord>\d{1,3})\.\s*\|(?P<rest>(?:(?!^\|\s*\d{1,3}\.\s*\|).)+?)(?=^\|\s*\d{1,3}\.\s*\||\Z)", re.M | re.S),
    (r"^(?P<ord>\d{1,3})\.\s+(?P<rest>[^\n]{20,400})\.{2,}\s*(?P<page>\d+(?:[–\-]\d+)?)?", re.M),
)
# Where a title runs on into later items, as (pattern, the group that is cut at); pages in a cell and at the end of a title.
RUNS_ON = (
    (r"(?:^|\s)\d{1,4}(?:[–\-]\d{1,4})?(?:\s*[;,]\s*\d{1,4}(?:[–\-]\d{1,4})?)*\s+(?P<cut>\d{1,3})\.\s+(?=[A-ZȘȚÂÎĂ])", "cut"),
    (r"\s+-{2,}(?:\s+-{2,})+(?:\s+|$)", 0),
    (r"\s+-\s+\d{1,3}\.\s+(?=[A-ZȘȚÂÎĂ])", 0),
)
PAGE_CELL = r"\|\s*(?P<pages>[\d–\-;,\s]+)\s*\|?\s*$"
PAGES_LAST = r"(?P<pages>\b\d{1,4}(?:[–\-]\d{1,4})?(?:\s*;\s*\d{1,4})*\b)\s*$"
PAGES, PAGE_MOST, RANGE_MOST = r"(\d{1,4})(?:[–\-](\d{1,4}))?", 9999, 200
# Headers of items and of speakers in a body, and a numbered line.
ITEM_HEADER = r"^##\s+(?:\*\*\s*)?(?P<ord>\d{1,3})\.\s+(?P<title>[^*\n]+?)(?:\s*\*\*)?\s*$"
SPEAKER_HEADER = r"^##\s+\*\*\s*[^*\n]+?\s*\*\*\s*$"
NUMBERED_LINE = r"^\s*(?P<ord>\d{1,3})\.\s+"
IMPLICIT_TITLE = "Ședința"
# Italics, what makes them procedural, and a deferral that stands alone.
ITALICS = r"^_(?P<text>[^_\n]+(?:\s*\n[^_\n]+)*)_\s*$|_(?P<inline>\([^)]+\))_"
PROCEDURAL = (r"\bPauz[ăa]\b", r"\b(?:relu[ăa]m|continu[ăa]m)\s+(?:ședin[țt]a|lucr[ăa]rile)", r"\bSuspend(?:[ăa]m?|a[țt]i|am|au)?\s+(?:ședin[țt]a|lucr[ăa]rile)", r"\bSe\s+ridic[ăa]\s+ședin[țt]a\b")
DEFERRAL = r"^[^\n]*?Aceasta\s+(?:r[ăa]m[âa]ne|se\s+va\s+da)[^\n]*?votul[uli]?\s+final[^\n]*$"
# How an item ends, in order; who asked for it; why it is examined again.
OUTCOMES = (
    ("adoptat_tacit", r"(?iu)adoptat[ăa]?\s+tacit"),
    ("votul_final_deferred", r"(?iu)r[ăa]m[âa]ne\s+pentru\s+votul\s+final|r[ăa]mas\s+pentru\s+votul\s+final"),
    ("vot_amânat", r"(?ius)votul\s+final\s+(?:se\s+va\s+da|asupra[^.]*?va\s+fi\s+dat).*?(?:într-o\s+[șs]edin[țt][ăa]\s+viitoare)"),
    ("retras", r"(?iu)a\s+fost\s+retras"),
    ("retrimis", r"(?iu)retrimitere\s+la\s+(?:Comisia|Comisii)"),
    ("respins", r"(?iu)a\s+fost\s+respin[șs]"),
    ("informare", r"(?iu)^Informare\s+"),
    ("adoptat", r"(?iu)a\s+fost\s+(?:adoptat|aprobat)"),
)
GROUP = r"la\s+solicitarea\s+Grupului\s+parlamentar\s+al\s+([A-ZȘȚÂÎĂ][\w\-+ăâîșțĂÂÎȘȚ]*(?:\s+(?:și|şi)\s+[A-ZȘȚÂÎĂ][\w\-+ăâîșțĂÂÎȘȚ]*)?)"
AGAIN = (("presidential_request", r"(?iu)Pre[șs]edintelui\s+Rom[âa]niei"), ("constitutional_court", r"(?iu)Cur[țt]ii\s+Constitu[țt]ionale|Deciziei?\s+Cur[țt]ii"))
AGAIN_OTHERWISE = "parliamentary_majority"

_layouts = [re.compile(p, flags) for p, flags in LAYOUTS]
_runs_on = [(re.compile(p), group) for p, group in RUNS_ON]
_procedural = re.compile("|".join(PROCEDURAL), re.I)


# ---- the summary


def summary_span(text: str) -> tuple[int, int] | None:
    m = re.search(SUMMARY_OPENS, text, re.M)
    if m is None:
        return None
    end = re.compile(SUMMARY_ENDS, re.M).search(text, m.end())
    return m.start(), end.start() if end else min(len(text), m.end() + SUMMARY_MOST)


def pages_of(s: str) -> list[int]:
    """The pages of a list such as 3-5; 12."""
    found = set()
    for a, b in re.findall(PAGES, s):
        first, last = int(a), int(b or a)
        if first > 0 and 0 < last <= PAGE_MOST and last - first <= RANGE_MOST:
            found.update(range(first, last + 1))
    return sorted(found)


def titled(rest: str) -> tuple[str, list[int]]:
    """An item's title and pages, without leaders and table marks, cut where it runs on into later items."""
    title = re.sub(r"\s{2,}", " ", re.sub(r"\.{3,}", "", rest).replace("<br>", " ").replace("|", " ")).strip()
    cut = min((m.start(group) for p, group in _runs_on if (m := p.search(title))), default=0)
    title = title[:cut].rstrip() if cut > 0 else title
    cell = re.search(PAGE_CELL, rest)
    pages = pages_of(cell["pages"]) if cell else []
    if not pages and (last := re.search(PAGES_LAST, title)):
        pages, title = pages_of(last["pages"]), title[: last.start()].strip()
    return title, pages


def summary_of(text: str) -> list[dict]:
    """Items (ordinal, title, pages) of a summary, by number; each from the first layout that shows it."""
    found: dict[int, dict] = {}
    for p in _layouts:
        for m in p.finditer(text):
            ordinal = int(m["ord"])
            if 1 <= ordinal <= ORDINAL_MOST and ordinal not in found:
                title, pages = titled(m["rest"])
                if title:
                    found[ordinal] = {"ordinal": ordinal, "title": title, "pages": pages}
    return [found[k] for k in sorted(found)]


# ---- items in the body


def item_spans(text: str, start: int, end: int, ordinals: list[int]) -> list[tuple[int, int] | None]:
    """The span of each listed number: from its first numbered line to the next one's. The first found reaches back to the start, the last to the end. Lines out of order count for nothing; then the first item has all."""
    marks: dict[int, int] = {}
    for m in re.compile(NUMBERED_LINE, re.M).finditer(text, start, end):
        if int(m["ord"]) in ordinals:
            marks.setdefault(int(m["ord"]), m.start())
    order = sorted(marks)
    if not order or any(marks[a] > marks[b] for a, b in zip(order, order[1:], strict=False)):
        return [(start, end) if k == 0 else None for k in range(len(ordinals))]
    cuts = [start, *(marks[o] for o in order[1:]), end]
    spans = dict(zip(order, zip(cuts, cuts[1:], strict=False), strict=True))
    return [spans.get(o) for o in ordinals]


def items_of(text: str, end: int | None = None) -> list[dict]:
    """Agenda items up to an end: those of the summary, else those with headers in the body, else one for all where anyone speaks. Each with its span (null if not found) and activities."""
    end = len(text) if end is None else end
    span = summary_span(text)
    listed = summary_of(text[span[0] : span[1]]) if span else []
    if listed:
        spans = item_spans(text, span[1], end, [i["ordinal"] for i in listed])
    else:
        heads = list(re.compile(ITEM_HEADER, re.M).finditer(text, 0, end))
        listed = [{"ordinal": int(m["ord"]), "title": m["title"].strip(), "pages": []} for m in heads]
        starts = [m.start() for m in heads]
        spans = list(zip(starts, [*starts[1:], end], strict=False))
    if not listed:
        start = span[1] if span else 0
        acts = activities_of(text[start:end], start) if re.search(SPEAKER_HEADER, text[start:end], re.M) else []
        return [{"ordinal": 1, "title": IMPLICIT_TITLE, "pages": [], "start": start, "end": end, "activities": acts}] if acts else []
    return [i | {"start": s[0] if s else None, "end": s[1] if s else None, "activities": activities_of(text[s[0] : s[1]], s[0]) if s else []} for i, s in zip(listed, spans, strict=True)]


# ---- what happens in an item

_ACT = dict.fromkeys(("type", "text", *speakers.KEYS, "delivery_mode", "start", "end", *extract.VOTE_FIELDS))


def _events(turn: str) -> list[dict]:
    """Votes, stage directions and lone deferrals of a turn, by start."""
    votes = [_ACT | {k: v[k] for k in ("start", "end", *extract.VOTE_FIELDS)} | {"type": "vote", "text": turn[v["start"] : v["end"]].strip()} for v in extract.votes_of(turn)]
    italics = [(m, (m["text"] or m["inline"]).strip()) for m in re.finditer(ITALICS, turn, re.M)]
    stage = [_ACT | {"type": "procedural" if _procedural.search(t) else "narrator", "text": t, "start": m.start(), "end": m.end()} for m, t in italics if t]
    alone = [_ACT | {"type": "deferral", "text": m[0].strip(), "start": m.start(), "end": m.end()} for m in re.finditer(DEFERRAL, turn, re.M | re.I) if all(m.end() <= v["start"] or m.start() >= v["end"] for v in votes)]
    return sorted([*votes, *stage, *alone], key=lambda e: e["start"])


def _split(turn: str, speech: dict) -> list[dict]:
    """A turn's speech in pieces, with the events between them."""
    events = _events(turn)
    if not events:
        return [speech]
    out, at = [], 0
    for e in [*events, None]:
        stop = e["start"] if e else len(turn)
        if stop > at and (piece := turn[at:stop].strip()):
            out.append(speech | {"text": piece, "start": at, "end": stop})
        if e:
            out.append(e)
            at = e["end"]
    return out


def activities_of(text: str, base: int = 0) -> list[dict]:
    """What happens in a text, in order and without overlap: speeches, votes, stage directions, deferrals. Offsets count from the base."""
    found = []
    for t in extract.turns_of(text):
        narrated = t["name"] == "<chair narration>"
        who, mode = (speakers.speaker_of("") | {"raw": t["name"]}, None) if narrated else speakers.turn_speaker(t["name"], t["role"])
        speech = _ACT | who | {"type": "speech", "text": t["text"], "delivery_mode": mode, "start": 0, "end": t["end"] - t["start"]}
        found += [a | {"start": a["start"] + t["start"], "end": a["end"] + t["start"]} for a in _split(text[t["start"] : t["end"]], speech)]
    out: list[dict] = []
    for a in sorted(found, key=lambda a: a["start"]):
        if out and a["start"] < out[-1]["end"]:  # the one before ends here, or goes
            if a["start"] <= out[-1]["start"]:
                out.pop()
            else:
                out[-1] = out[-1] | {"end": a["start"]}
        out.append(a)
    return [a | {"start": a["start"] + base, "end": a["end"] + base} for a in out]


# ---- as columns

_NUMBERS = ("start", "end", "for", "against", "abstain", "not_voting")
_FIELDS = tuple(_ACT)
_kind = lambda f: "int" if f in _NUMBERS else "boolean" if f == "unanimous" else "string"
ACTIVITY = "array<struct<" + ",".join(f"`{f}`:{_kind(f)}" for f in _FIELDS) + ">>"
ITEMS = f"array<struct<ordinal:int,title:string,pages:array<int>,start:int,`end`:int,activities:{ACTIVITY}>>"
_ACTS = pa.list_(pa.struct([(f, {"int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}[_kind(f)]) for f in _FIELDS]))
_ITEMS = pa.list_(pa.struct([("ordinal", pa.int32()), ("title", pa.string()), ("pages", pa.list_(pa.int32())), ("start", pa.int32()), ("end", pa.int32()), ("activities", _ACTS)]))


def items(text: Column, end: Column | None = None) -> Column:
    """The agenda items of each text, up to an offset where one is given."""

    @F.arrow_udf(ITEMS)
    def run(texts: pa.Array, ends: pa.Array) -> pa.Array:
        return pa.array([items_of(t or "", e) for t, e in zip(texts.to_pylist(), ends.to_pylist(), strict=True)], _ITEMS)

    return run(text, F.lit(None).cast("int") if end is None else end.cast("int"))


def activities(text: Column) -> Column:
    @F.arrow_udf(ACTIVITY)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([activities_of(t or "") for t in texts.to_pylist()], _ACTS)

    return run(text)


def outcome(body: Column, title: Column) -> Column:
    """How an item ended, by the first phrase that its body or title holds."""
    body, title = F.coalesce(body, F.lit("")), F.coalesce(title, F.lit(""))
    return first_of(*((body.rlike(p) | title.rlike(p), label) for label, p in OUTCOMES))


def requested_by(title: Column) -> Column:
    return F.trim(extracted(title, GROUP))


def reexamination(title: Column) -> Column:
    """Why an item is examined again; null where it isn't."""
    reason = F.coalesce(first_of(*((title.rlike(p), label) for label, p in AGAIN)), F.lit(AGAIN_OTHERWISE))
    return F.when(F.lower(title).contains("reexaminare"), reason)
