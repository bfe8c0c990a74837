"""Interpellations of a sitting: the block they stand in, each with questioner, addressee, topic, text and answer."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import speakers

# Phrases that open the block.
OPENINGS = (
    (r"trecem\s+la\s+primirea\s+r[ăa]spunsurilor\s+la\s+interpel[ăa]ri", 0),
    (r"începem\s+(?:sesiunea|ora)\s+(?:de\s+)?(?:întreb[ăa]r(?:i|ilor)?\s+)?(?:[șs]i\s+)?interpel[ăa]r(?:i|ilor)?", 0),
    (r"(?:vom\s+)?intr[ăa]m?\s+în\s+ora\s+(?:întreb[ăa]rilor|interpel[ăa]rilor)", 0),
    (r"trecem\s+la\s+prezentarea\s+interpel[ăa]rilor\s+noi", 0),
    (r"trecem\s+la\s+(?:ultimul\s+)?punct\s+(?:de\s+pe\s+|din\s+)?ordinea\s+de\s+zi[\s,:.;]+(?:[^\n]{0,40})(?:întreb[ăa]ri|interpel[ăa]ri)", 0),
    (r"declar\s+deschis[ăa]\s+(?:[șs]edin[țt]a|sesiunea)\s+(?:consacrat[ăa]\s+|de\s+|pentru\s+)?[^\n]{0,80}(?:interpel[ăa]r|întreb[ăa]r)", 0),
    (r"urmeaz[ăa]\s+(?:prezentarea|sesiunea)\s+(?:pe\s+scurt\s+)?(?:de\s+|a\s+)?[^\n]{0,80}interpel[ăa]r", 0),
    (r"deschidem\s+[șs]edin[țt]a\s+consacrat[ăa]\s+r[ăa]spunsurilor", 0),
    (r"(?<![|])^\s*R[ăa]spunsuri\s+la\s+interpel[ăa]ri[ie]?[^\n|]{0,160}\s*$", re.M),
    (r"^##?\s+\*\*?\s*Întreb[ăa]ri\s+orale", re.M),
)
# Headers of questioners and of those who answer, and the offices that answer.
HEADER = r"^##\s+\*\*\s*(?P<inner>[^*\n]+?)\s*:\s*\*\*\s*$"
ANSWER = r"^##\s+\*\*\s*(?P<name>[^*\n]+?)\s*\*\*\s*_\s*[-–]\s*(?P<role>[^_\n]+?)\s*_(?P<tail>\s*\*\*:\*\*\s*)?$"
ANSWER_MORE = r"^(?:##\s+)?_\s*(?P<more>[^_\n]+?)\s*_\s*\*\*:\*\*\s*$"
ANSWER_REACH = 400
OFFICES = (
    r"\b(?:secretar(?:ul|i)?\s+de\s+stat|ministru(?:l|lui)?|viceprim-?ministru|prim-?ministru|consilier(?:ul)?|[șs]eful|director(?:ul|i|ii)?|"
    r"pre[șs]edinte(?:le)?\s+(?:Cur[țt]ii|Consiliului)|avocatul\s+poporului|guvernator(?:ul)?)\b"
)
# How an addressee is named, in order, after a verb of asking within the first 800 characters.
LOWER, UPPER = r"a-zșțăîâşţãþ", r"A-ZȘȚĂÎÂŞŢÃ"
ASKING = r"(?i:\b(?:adresat[ăaã]?|adresez(?:[ăaã])?|adreseaz[ăã]|c[ăa]tre|interpel[ăaã]rii|întreb[ăaã]rii)\b)[^\n]{0,200}?"
MINISTRY = ASKING + rf"\bMinisterul(?:ui)?\s+(?P<to>[{UPPER}][^.,;\n]*)"
PREMIER = ASKING + r"\b(?:[Vv]ice-?)?[Pp]rim-?ministru(?:l|lui)?\b"
MINISTER = ASKING + rf"(?<![-{LOWER}{UPPER}])ministru(?:lui|l)?\s+(?:(?:al|a|ale)\s+)?(?P<to>(?:de\s+)?[{LOWER}][^.,;\n]*)"
PERSON = ASKING + rf"(?:doamnei|domnului|doamna|domnul)\s+(?:ministru(?:lui|l)?\s+)?(?P<to>[{UPPER}][^.,;\n]*)"
ADDRESS_REACH = 800
NUMBER = r"\bNr\.\s*(?P<num>\d+(?:\.\d+)*[A-Za-z]?)"
IN_WRITING = r"\(\s*în\s+scris\s*\)|răspuns(?:ul)?\s+în\s+scris"
# Lines of courtesy, lines that address someone, and lines that only announce.
COURTESY = (
    r"^\s*(?:(?:v[ăa]\s+)?mul[țt]umesc(?:[\s,!.][^\n]*)?|bun[ăa]\s+(?:diminea[țt]a|seara|ziua)(?:[\s,!.][^\n]*)?|doamn[ăa]\s+pre[șs]edint[eă][^\n]*|domnule\s+pre[șs]edint[eă][^\n]*|stima[țt]i\s+colegi[^\n]*|"
    r"stimate\s+colege[^\n]*|stima[țt]i\s+(?:domni\s+(?:senatori|deputa[țt]i)|senatori|deputa[țt]i)[^\n]*|dragi\s+români[^\n]*|doamnelor\s+[șs]i\s+domnilor[^\n]*)\s*$"
)
SALUTE = (
    r"^\s*(?:(?:stimat[eă]\s+)?(?:doamn[ăa]|domnule)\s+(?:pre[șs]edint[eă]|ministru|secretar(?:[ăa])?\s+de\s+stat|viceprim-?ministru|prim-?ministru|deputat|senator)\b[^\n]*|"
    r"stima[țt]i?\s+colegi[^\n]*|stimate\s+colege[^\n]*|doamnelor\s+[șs]i\s+domnilor[^\n]*|dragi\s+români[^\n]*)\s*$"
)
ANNOUNCED = (
    r"^\s*(?:voi\s+(?:da\s+curs|prezenta|citi)[^.\n]*(?:întreb[ăa]rii|interpel[ăa]rii|întreb[ăa]ri|interpel[ăa]ri)[^\n]*|interpelarea\s+(?:este\s+adresat[ăa]|se\s+adreseaz[ăa])[^\n]*|"
    r"întrebarea\s+(?:este\s+adresat[ăa]|se\s+adreseaz[ăa])[^\n]*|obiectul\s+interpel[ăa]rii\s*[:.]?\s*[^\n]*|obiectul\s+întreb[ăa]rii\s*[:.]?\s*[^\n]*|"
    r"adresez(?:[ăa])?\s+(?:aceast[ăa]\s+)?(?:întrebare|interpelare)[^\n]*)\s*$"
)
# Phrases that close a question, and those that lead to something else.
CLOSINGS = ((r"\bSolicit\s+r[ăa]spuns\b", 0), (r"\bA[șs]tept(?:[ăa]m)?\s+r[ăa]spuns(?:ul)?\b", 0), (r"\bDoresc\s+un\s+r[ăa]spuns\b", 0), (r"^\s*Cu\s+stim[ăa]\s*[,.]", re.M), (r"^\s*Cu\s+respect\s*[,.]", re.M))
BREAKS = (
    (r"\bvoi\s+(?:citi|prezenta|continua\s+cu)\s+(?:[șs]i\s+)?declara[țt]ia\s+politic[ăa]\b", 0),
    (r"\bdeclara[țt]ia\s+politic[ăa]\s+(?:cu\s+titlul|cu\s+tema|pe\s+care\s+(?:vreau|doresc))\b", 0),
    (r"\b(?:trec(?:em)?|voi\s+trece)\s+(?:acum\s+)?la\s+(?:a\s+doua|cea\s+de-a\s+doua|cealalt[ăa])\s+(?:întrebare|interpelare)\b", 0),
    (r"\bvoi\s+citi\s+[șs]i\s+declara[țt]ia\b", 0),
    (r"\bTitlul\s+declara[țt]iei\b", 0),
    (r"(?:^|(?<=[.!?]\s)|(?<=[.!?]\s\s))\s*(?:[Aa]ceast[ăa]\s+|[Pp]rima\s+|[Oo]\s+)?Declara[țt]i(?:e|a)\s+politic[ăa](?:\s*[:.]|\s+(?:privind|cu\s+titlul|cu\s+tema|adresat[ăa]|este\s+adresat[ăa]|în\s+calitate|pe\s+care|face\s+referire)\b)", re.M),
    (r"\b(?:supun(?:e|em)?\s+(?:aten[țt]iei|votului)|prezint(?:[ăa])?|aleg(?:em)?\s+s[ăa]\s+prezint)\s+o\s+declara[țt]ie\s+politic[ăa]\b", 0),
    (r"\b(?:Senator|Deputat)(?:\s+(?:AUR|PNL|PSD|USR|UDMR|REPER|SOS|S\.O\.S\.|independent))?\s+[A-ZȘȚĂÎÂ][^.\n]{0,80}[.,]\s+Declara[țt]ie\s+politic[ăa]", 0),
    (r"\bSunt\s+[A-ZȘȚĂÎÂ][^.\n]{0,80},\s*(?:senator|deputat)[^\n]{0,200}declara[țt]ie\s+politic[ăa]", 0),
)
DECLARATION = r"(?:\bTitlul\s+declara[țt]iei\b|\bdeclara[țt]i(?:e|a|ei)\s+politic[ăa])"
ASKS = r"\b(?:interpel[ăa]r|am\s+(?:o\s+)?(?:întrebare|interpelare)|adresez(?:[ăa])?\s+(?:aceast[ăa]\s+)?(?:întrebare|interpelare)|obiectul\s+(?:întreb[ăa]rii|interpel[ăa]rii))\b"
PUBLISHER = r"\b(?:ABONAMENTE|MONITORUL\s+OFICIAL|PUBLICA[ȚT]III?LE|EDITOR|GUVERNUL\s+ROM[ÂA]NIEI|DISTRIBU[ȚT]IE|R\.A\.|S\.A\.|SOCIET[ĂA][ȚT]I)\b"
QUOTED = r"(?:„|«|\")(?P<topic>[^„«\"\n]{8,280}?)(?:”|»|\")"
OBJECT = r"\b(?:obiectul\s+(?:interpel[ăa]rii|întreb[ăa]rii)|cu\s+obiectul|obiect(?:ul)?|subiectul|tema)\s*[:.]?\s*(?P<topic>[^\n]{8,280})"
# Who leads the block, as they say themselves, in its first 1500 characters.
LEADS = r"conducerea\s+fiind\s+asigurat[ăa]\s+de\s+subsemnat[ăa]?,?\s+(?P<a>[A-ZȘȚĂÎÂa-zșțăîâ\-' .]+?),\s+pre[șs]edinte"
ASSISTS = r"asistat[ăa]?\s+de\s+(?:domnul|doamna)\s+(?:senator|deputat)\s+(?P<a>[A-ZȘȚĂÎÂ][A-ZȘȚĂÎÂa-zșțăîâ\-' .]+?)(?:\s+[șs]i\s+(?:domnul|doamna)\s+(?:senator|deputat)\s+(?P<b>[A-ZȘȚĂÎÂ][A-ZȘȚĂÎÂa-zșțăîâ\-' .]+?))?\s*,\s*(?:secretari|asistat)"
LEAD_REACH, DECLARATION_REACH, TOPIC_REACH, TOPIC_MOST, LEAST_TOPIC, LEAST_TEXT, LONG_NAME = 1500, 600, 2500, 300, 8, 40, 30

_openings = [re.compile(p, re.I | f) for p, f in OPENINGS]
_stops = [re.compile(p, re.I | f) for p, f in (*BREAKS, *CLOSINGS)]
_courtesy, _salute, _announced = (re.compile(p, re.I) for p in (COURTESY, SALUTE, ANNOUNCED))


def block_start(text: str) -> int | None:
    return min((m.start() for p in _openings if (m := p.search(text))), default=None)


def addressee_of(text: str) -> str | None:
    """A ministry, the prime minister, a minister's ministry, or a person."""
    head = text[:ADDRESS_REACH]
    tidy = lambda m: m["to"].strip().rstrip(".,;: ") if m else ""
    if to := tidy(re.search(MINISTRY, head)):
        return f"Ministerul {to}"
    if re.search(PREMIER, head):
        return "Prim-ministrul"
    if to := tidy(re.search(MINISTER, head)):
        return f"Ministerul {to[0].upper()}{to[1:]}"
    return tidy(re.search(PERSON, head)) or None


def topic_of(text: str) -> str | None:
    """What is quoted, else what an object marker names, else the first line that says something."""
    head = text[:TOPIC_REACH]
    if m := re.search(QUOTED, head, re.M):
        return m["topic"].strip()[:TOPIC_MOST]
    if (m := re.search(OBJECT, head, re.I)) and len(named := m["topic"].strip().lstrip(":–- ").strip()) >= LEAST_TOPIC:
        return named[:TOPIC_MOST]
    lines = (x.strip() for x in text.splitlines())
    return next((x[:TOPIC_MOST] for x in lines if x and x[0] not in "_#" and not any(p.match(x) for p in (_courtesy, _salute, _announced))), None)


def _stripped(text: str, skip: tuple) -> str | None:
    """The text from its first line that says something, without blank lines in a row; null if that is too short."""
    lines = text.splitlines()
    at = next((k for k, x in enumerate(map(str.strip, lines)) if x and x[0] not in "#_" and not any(p.match(x) for p in skip)), len(lines))
    whole = re.sub(r"\n{3,}", "\n\n", "\n".join(lines[at:]).strip())
    return whole if len(whole) >= LEAST_TEXT else None


def question_of(text: str) -> str | None:
    """The question: up to what closes it or leads elsewhere."""
    stop = min((m.start() for p in _stops if (m := p.search(text))), default=len(text))
    return _stripped(text[:stop], (_courtesy, _announced))


def is_declaration(text: str) -> bool:
    return bool(re.search(DECLARATION, text[:DECLARATION_REACH], re.I)) and not re.search(ASKS, text, re.I)


def is_publisher(name: str) -> bool:
    """Whether a header is the publisher's, not a speaker's."""
    s = name.strip()
    return bool(re.search(PUBLISHER, s, re.I)) or (len(s) > LONG_NAME and not any(c.islower() for c in s if c.isalpha()))


def _lead_names(block: str, named: list[str]) -> set[str]:
    head = block[:LEAD_REACH]
    said = [v for p in (LEADS, ASSISTS) if (m := re.search(p, head, re.I)) for v in m.groupdict().values() if v]
    return {" ".join(n.strip().strip(",").lower().split()) for n in [*named, *said] if n and n.strip()}


def _answers(block: str) -> list[dict]:
    """Headers of those who answer for an office: start, where the text begins, name, role. A role may go on in the next line."""
    out = []
    for m in re.finditer(ANSWER, block, re.M):
        role, at = m["role"].strip(), m.end()
        if m["tail"] is None and (more := re.compile(ANSWER_MORE, re.M).search(block, at, min(at + ANSWER_REACH, len(block)))):
            role, at = f"{role} {more['more'].strip()}", more.end()
        if re.search(OFFICES, role, re.I):
            out.append({"start": m.start(), "at": at, "name": m["name"].strip(), "role": role.lstrip("-–").strip()})
    return out


def interpellations_of(text: str, chairs: list[str] = ()) -> list[dict]:
    """Interpellations in order. Turns of those who lead, declarations and the publisher's lines go; an answer belongs to the last question that ends before it, and of several the last counts."""
    begin = block_start(text)
    if begin is None:
        return []
    block = text[begin:]
    leads = _lead_names(block, list(chairs or ()))
    heads, answers = list(re.finditer(HEADER, block, re.M)), _answers(block)
    cuts = sorted([*(m.start() for m in heads), *(a["start"] for a in answers), len(block)])
    after = lambda at: next(c for c in cuts if c > at)
    out = []
    for m in heads:
        end = after(m.start())
        turn = block[m.start() : end]
        body = "\n".join(turn.splitlines()[1:])
        who = speakers.speaker_of(speakers.delivery_of(m["inner"])[0].removesuffix(":").strip())
        if is_publisher(m["inner"]) or " ".join((who["name"] or "").lower().split()) in leads or is_declaration(body):
            continue
        numbers = re.findall(NUMBER, turn, re.I)
        asked = question_of(body)
        genre = "întrebare" if re.search(r"întreb[ăa]r", turn, re.I) and not re.search(r"interpel[ăa]r", turn, re.I) else "interpelare"
        out.append({"genre": genre, "questioner": who, "addressed_to": addressee_of(body), "interpellation_number": numbers[-1] if numbers else None, "topic": topic_of(body), "question_text": asked, "response_deferred": bool(re.search(IN_WRITING, turn, re.I)), "response": None, "start": begin + m.start(), "end": begin + end, "confidence": 0.85 if asked else 0.7})
    for a in answers:
        said = _stripped(block[a["at"] : after(a["start"])], (_courtesy,))
        asked = next((q for q in reversed(out) if q["end"] <= begin + a["start"]), None)
        if asked and said:
            asked["response"] = {"speaker": speakers.speaker_of(a["name"]) | {"role": a["role"]}, "text": said}
            asked["confidence"] = max(asked["confidence"], 0.9)
    return out


_WHO = "struct<" + ",".join(f"{k}:string" for k in speakers.KEYS) + ">"
RECORDS = f"array<struct<genre:string,questioner:{_WHO},addressed_to:string,interpellation_number:string,topic:string,question_text:string,response_deferred:boolean,response:struct<speaker:{_WHO},text:string>,start:int,`end`:int,confidence:double>>"
_who = pa.struct([(k, pa.string()) for k in speakers.KEYS])
_records = pa.list_(
    pa.struct([("genre", pa.string()), ("questioner", _who), *((k, pa.string()) for k in ("addressed_to", "interpellation_number", "topic", "question_text")), ("response_deferred", pa.bool_()), ("response", pa.struct([("speaker", _who), ("text", pa.string())])), ("start", pa.int32()), ("end", pa.int32()), ("confidence", pa.float64())])
)


def interpellations(text: Column, chairs: Column | None = None) -> Column:
    """The interpellations of each text; chairs: names of those who lead, whose turns don't count."""

    @F.arrow_udf(RECORDS)
    def run(texts: pa.Array, names: pa.Array) -> pa.Array:
        return pa.array([interpellations_of(t or "", n) for t, n in zip(texts.to_pylist(), names.to_pylist(), strict=True)], _records)

    return run(text, F.array().cast("array<string>") if chairs is None else chairs)


def block_offset(text: Column) -> Column:
    """Where the block begins, which is where the agenda ends; null without one."""

    @F.arrow_udf("int")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([block_start(t or "") for t in texts.to_pylist()], pa.int32())

    return run(text)
