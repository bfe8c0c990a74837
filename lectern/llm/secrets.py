"""Secret scans with multipart credential linking.

Strong spans (assign, access, hex) are reported wherever they stand. Weak candidates (random-looking strings, user names, endpoints) are reported only when complementary parts stand within one scope: intervals around the parts are joined, and a weak candidate needs a part of another role in reach. Spans are in code points, the end exclusive.

A null text is empty and has no spans. Texts of any length are scanned whole. Each row is scanned by itself, so repeated rows give equal results. Further columns stay as they are.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import common

SCOPE = 200
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # runs end where the class ends, so a longer least length drops just the short ones
HEX = re.compile(r"[0-9a-f]{16,}")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}")
USER = re.compile(r"""(?ai)(?:user(?:name)?|login|client_id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""")
ENDPOINT = re.compile(r"(?:https?|postgres|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]+")
#: What must occur for a text to hold any base span.
NEEDED = r"(?i:(password|passwd|secret|token|api_?key)[\"']? *[:=])|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"
ROLES = {"assign": "secret", "hex": "secret", "random": "secret", "access": "identifier", "user": "identifier", "endpoint": "endpoint"}
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("scope", T.IntegerType())]))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _random_looking(s: str) -> bool:
    if not (re.search("[a-z]", s) and re.search("[A-Z]", s) and re.search("[0-9]", s)):
        return False
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) >= 3.5


def link(parts: list[tuple[str, int, int]], scope: int) -> dict[tuple[str, int, int], int]:
    """Interval join: parts whose role differs and whose gap is at most the scope form a set; gives the set's number for each linked part.

    Parts come by their start. For each part only the nearest earlier one of every other role is looked at, which joins the same sets as all pairs would.
    """
    parent = list(range(len(parts)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    reach: dict[str, int] = {}  # by role, the part that ends last so far
    linked: set[int] = set()
    for i, (kind, start, _) in enumerate(parts):
        for role, j in reach.items():
            if role != ROLES[kind] and start - parts[j][2] <= scope:
                parent[root(i)] = root(j)
                linked |= {i, j}
        role = ROLES[kind]
        if role not in reach or parts[i][2] >= parts[reach[role]][2]:
            reach[role] = i
    for role in {ROLES[k] for k, _, _ in parts}:  # and the nearest later one, for those without any earlier
        latest: int | None = None
        for i in range(len(parts) - 1, -1, -1):
            if ROLES[parts[i][0]] == role:
                latest = i
            elif latest is not None and parts[latest][1] - parts[i][2] <= scope:
                parent[root(i)] = root(latest)
                linked |= {i, latest}
    numbers: dict[int, int] = {}
    return {parts[i]: numbers.setdefault(root(i), len(numbers)) for i in sorted(linked)}


def scan(text: str, scope: int = SCOPE) -> list[tuple[str, int, int, int | None]]:
    """All spans by start and kind; the last value numbers the set of linked parts, or is null."""
    base = base_spans(text)
    ends = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in ends]
    furthest = list(accumulate((e for _, e in ends), max))  # of the spans up to each

    def free(s: int, e: int) -> bool:
        k = bisect_left(starts, e)
        return k == 0 or furthest[k - 1] <= s

    weak = [("random", m.start(), m.end()) for m in RANDOM.finditer(text) if _random_looking(m[0])]
    weak += [("user", m.start(), m.end()) for m in USER.finditer(text)]
    weak += [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    weak = [w for w in weak if free(*w[1:])]
    order = [*BASE_KINDS, "random", "user", "endpoint"]
    key = lambda p: (p[1], order.index(p[0]), p[2])
    sets = link(sorted([*base, *weak], key=key), scope)
    return [(*p, sets.get(p)) for p in sorted([*base, *(w for w in weak if w in sets)], key=key)]


def spans(text: Column, scope: int = SCOPE) -> Column:
    """The spans of each text as an array of (kind, start, end, scope)."""

    @F.arrow_udf(SPANS)
    def run(texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts, "")
        some = pc.match_substring_regex(texts, NEEDED + "|://|(?i:(user(name)?|login|client_id)[\"']? *[:=])").to_pylist()
        names = ("kind", "start", "end", "scope")
        found = [[dict(zip(names, s, strict=True)) for s in scan(texts[i].as_py(), scope)] if x else [] for i, x in enumerate(some)]
        return pa.array(found, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int32())])))

    return run(text)


def redacted(text: Column, scope: int = SCOPE) -> Column:
    """The text with every span replaced by its kind in brackets; null stays null."""

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array) -> pa.Array:
        some = pc.match_substring_regex(texts, NEEDED + "|://|(?i:(user(name)?|login|client_id)[\"']? *[:=])").to_pylist()
        if not any(some):
            return texts
        out = []
        for value, hit in zip(texts, some, strict=True):
            t = value.as_py()
            if hit:
                pieces, at = [], 0
                for kind, start, end, _ in scan(t, scope):
                    if end > at:
                        pieces += [t[at : max(at, start)], f"[{kind}]"] if start >= at else []
                        at = end
                t = "".join(pieces) + t[at:]
            out.append(t)
        return pa.array(out, texts.type)

    return run(text)


def scan_documents(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id and its spans."""
    common.small_batches(docs.sparkSession)
    return docs.select("doc_id", spans(F.col("text"), scope).alias("found"))
