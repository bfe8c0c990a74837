"""Speakers and questioners as they are written: name, title, role, party and how a speech was delivered."""

from __future__ import annotations

import re

# How a speech is delivered, by what stands in brackets, in order; honorifics and ranks before a name; titles after one.
DELIVERY = (
    (r"\(\s*de\s+la\s+tribun[ăa]\s*\)", "tribune"),
    (r"\(\s*din\s+sal[ăa]\s*\)", "from_floor"),
    (r"\(\s*prin\s+(?:audio|video)conferin[țt][ăa]\s*\)", "online"),
    (r"\(\s*online\s*\)", "online"),
    (r"\(\s*de\s+la\s+balcon\s*\)", "from_balcony"),
    (r"\(\s*în\s+scris\s*\)", "written"),
)
HONORIFIC = r"^\s*(?:[Dd]omnul|[Dd]oamna|[Dd]omni[șs]oara)(?:\s+(?P<rank>deputat(?:ul)?|senator(?:ul|oare)?))?\s+(?P<rest>.+?)\s*$"
RANKS = {"deputat": "deputat", "deputatul": "deputat", "senator": "senator", "senatorul": "senator"}
TITLE = r"^(?P<title>deputat|deputatã|deputatul|senator|senatoare|senatorul)\b\s*(?P<after>.*)$"
KEYS = ("raw", "name", "title", "role", "party_group")

_delivery = [(re.compile(p, re.I), mode) for p, mode in DELIVERY]
_honorific, _title = re.compile(HONORIFIC, re.S), re.compile(TITLE, re.I | re.S)


def one_line(s: str) -> str | None:
    return " ".join(s.split()) or None


def delivery_of(raw: str) -> tuple[str, str | None]:
    """What is left without the first mark of delivery, and the mode that it tells."""
    for p, mode in _delivery:
        if m := p.search(raw):
            return re.sub(r"\s{2,}", " ", (raw[: m.start()] + raw[m.end() :]).strip()), mode
    return raw, None


def speaker_of(raw: str) -> dict:
    """A speaker: after an honorific and a rank the name, and past a comma the role."""
    raw = raw.strip()
    m = _honorific.match(raw)
    name, comma, role = (m["rest"] if m else raw).partition(",")
    rank = m["rank"] if m else None
    known = dict.fromkeys(KEYS) | {"raw": raw, "name": one_line(name) if m or comma else raw or None, "role": one_line(role)}
    return known | {"title": RANKS.get(rank.lower(), rank.lower()) if rank else None}


def turn_speaker(inner: str, role: str | None = None) -> tuple[dict, str | None]:
    """Speaker and delivery mode of a turn's header."""
    bare, mode = delivery_of(inner)
    bare = bare[:-1].strip() if bare.endswith(":") else bare
    found = speaker_of(bare)
    return found | {"name": found["name"] or bare or None, "role": found["role"] or ((role or "").strip() or None)}, mode


def questioner_of(raw: str) -> dict:
    """Name, title and party of `name, title party, ...`."""
    raw = raw.strip()
    name, comma, rest = raw.partition(",")
    out = dict.fromkeys(KEYS) | {"raw": raw}
    if not comma:
        return out
    m = _title.match(rest.strip())
    return out | {"name": one_line(name)} | ({"title": m["title"].lower(), "party_group": one_line(m["after"].partition(",")[0])} if m else {})
