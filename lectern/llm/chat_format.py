"""Chat formatting, in DataFrame functions only.

The nested field paths of a layout, sorted and hashed, are its schema fingerprint. The fingerprint selects a declarative mapping that turns prompt, instruction, message or turn-row layouts into canonical turns (role, text). Frames are fingerprinted by their schema; JSON records one by one, so that a table may mix layouts.

The template writes `### role: text</turn>` and a newline per turn. Inside roles and texts a backslash, the closing mark and the heading mark are escaped with a backslash, and a colon in a role too, so that the output reads back exactly.

Nulls: a null role or text is empty; rows without a conversation id form one conversation with a null id. Turns are ordered by turn (null first), then role and text, so repeated rows stay as repeated turns. An empty table gives no rows. Columns and fields that no mapping names, nested ones too, are left out before hashing. An unknown layout raises an error for frames and gives null turns for JSON records; so does what is no JSON.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"
CLOSE = "</turn>"

#: Layouts: the field paths that identify one, and how its turns are made. `each` walks an array of messages; `fixed` lists (role, paths to join).
MAPPINGS = {
    "messages": {"paths": ["messages", "messages[].content", "messages[].role"], "each": ("messages", "role", "content")},
    "conversations": {"paths": ["conversations", "conversations[].from", "conversations[].value"], "each": ("conversations", "from", "value")},
    "turns": {"paths": ["turns", "turns[].role", "turns[].text"], "each": ("turns", "role", "text")},
    "prompt_response": {"paths": ["prompt", "response"], "fixed": [("user", ["prompt"]), ("assistant", ["response"])]},
    "prompt_completion": {"paths": ["completion", "prompt"], "fixed": [("user", ["prompt"]), ("assistant", ["completion"])]},
    "question_answer": {"paths": ["answer", "question"], "fixed": [("user", ["question"]), ("assistant", ["answer"])]},
    "instruction": {"paths": ["instruction", "output"], "fixed": [("user", ["instruction"]), ("assistant", ["output"])]},
    "instruction_input": {"paths": ["input", "instruction", "output"], "fixed": [("user", ["instruction", "input"]), ("assistant", ["output"])]},
    "system_prompt": {"paths": ["prompt", "response", "system"], "fixed": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]},
    "turn_rows": {"paths": ["conv_id", "role", "text", "turn"], "rows": ("conv_id", "turn", "role", "text")},
}
#: Names of speakers in the layouts, and the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths; an array's elements are written as []."""
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for x in [f"{at}.{f.name}" if at else f.name] for p in [x, *field_paths(f.dataType, x)]]
    return []


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


FINGERPRINTS = {fingerprint(m["paths"]): name for name, m in MAPPINGS.items()}
#: Paths that any layout has; others are left out before hashing.
KNOWN = sorted({p for m in MAPPINGS.values() for p in m["paths"]})


def layout_of(df: DataFrame, wanted: list[str] | None = None) -> str:
    """The layout of a frame, by its nested field paths or those below the fields wanted."""
    paths = [p for p in field_paths(df.schema) if p in KNOWN and (wanted is None or re.split(r"[.\[]", p)[0] in wanted)]
    name = FINGERPRINTS.get(fingerprint(paths))
    if name is None:
        raise ValueError(f"no mapping for the layout {sorted(paths)}")
    return name


def _role(role: Column) -> Column:
    low = F.lower(F.coalesce(role, F.lit("")))
    out = F.coalesce(role, F.lit(""))
    for a, b in ROLES.items():
        out = F.when(low == a, F.lit(b)).otherwise(out)
    return out


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _mapped(mapping: dict, get) -> Column:
    """Turns by a mapping; get(path, type) reads a field of the record."""
    if "each" in mapping:
        array, role, text = mapping["each"]
        return F.transform(get(array, f"array<struct<`{role}`:string,`{text}`:string>>"), lambda m: _turn(_role(m[role].cast("string")), m[text]))
    return F.array(*(_turn(F.lit(role), F.array_join(F.filter(F.array(*(get(p, "string") for p in paths)), lambda x: x != ""), "\n")) for role, paths in mapping["fixed"]))


def turns_of_frame(df: DataFrame) -> Column:
    """Canonical turns of a frame with one record a row."""
    return _mapped(MAPPINGS[layout_of(df)], lambda p, kind: F.col(f"`{p}`") if kind.startswith("array") else F.col(f"`{p}`").cast(kind))


def json_fingerprint(record: Column) -> Column:
    """The fingerprint of each JSON record, from those of its nested field paths that any layout has. A path through an array is there if any element has it."""
    v = F.try_parse_json(record)

    def has(path: str) -> Column:
        outer, inside, inner = path.partition("[].")
        if not inside:
            return F.try_variant_get(v, f"$.{outer}", "variant").isNotNull()
        elements = F.try_variant_get(v, f"$.{outer}", "array<variant>")
        return F.coalesce(F.exists(elements, lambda e: F.try_variant_get(e, f"$.{inner}", "variant").isNotNull()), F.lit(False))

    there = F.array_compact(F.array(*(F.when(has(p), F.lit(p)) for p in KNOWN)))
    return F.sha2(F.array_join(there, "\n"), 256)


def turns_of_json(record: Column) -> Column:
    """Canonical turns of each JSON record by its own layout; null where no mapping fits."""
    v, mark = F.try_parse_json(record), json_fingerprint(record)
    out = F.lit(None).cast(TURNS)
    for name, mapping in MAPPINGS.items():
        if "rows" not in mapping:
            out = F.when(mark == fingerprint(mapping["paths"]), _mapped(mapping, lambda p, kind: F.try_variant_get(v, f"$.{p}", kind))).otherwise(out)
    return out


def turns_of_rows(df: DataFrame) -> DataFrame:
    """(conv_id, turns) of a table with one row a turn."""
    conv, turn, role, text = MAPPINGS[layout_of(df, list(MAPPINGS["turn_rows"]["rows"]))]["rows"]
    one = F.struct(F.col(turn).alias("turn"), _role(F.col(role)).alias("role"), F.coalesce(text_ := F.col(text), F.lit("")).alias("text"))
    del text_
    rows = df.groupBy(F.col(conv).alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(CLOSE), F.lit("<\\/turn>")), F.lit("### "), F.lit("\\### "))
    return F.replace(out, F.lit(":"), F.lit("\\:")) if role else out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\/#:])", "$1")


def formatted(turns: Column) -> Column:
    """The formatted conversation."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("### "), escape(t["role"], True), F.lit(": "), escape(t["text"]), F.lit(CLOSE + "\n"))), "")


def read_back(text: Column) -> Column:
    """The turns of a formatted conversation, with the escaped text's length and whether it is under the loss mask."""
    pattern = r"(?s)^### ((?:[^\\:]|\\.)*): (.*)$"
    pieces = F.filter(F.split(text, re.escape(CLOSE + "\n")), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.regexp_extract(p, pattern, 1)).alias("role"),
            unescape(F.regexp_extract(p, pattern, 2)).alias("text"),
            F.length(p).alias("chars"),
            F.length(F.regexp_extract(p, pattern, 2)).alias("masked_chars"),
            (F.regexp_extract(p, pattern, 1) == "assistant").alias("loss"),
        ),
    )


def format_rows(df: DataFrame) -> DataFrame:
    """(conv_id, formatted) of a table of turn rows, fingerprinted and mapped first."""
    return turns_of_rows(df).select("conv_id", formatted(F.col("turns")).alias("formatted"))


def loss_spans(text: Column) -> Column:
    """The loss mask: (start, end) in code points of each assistant text, as escaped, in the formatted conversation."""
    close = len(CLOSE) + 1
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        end = acc["at"] + p["chars"]
        span = F.array(F.struct((end - p["masked_chars"]).alias("start"), end.alias("end")))
        return F.struct((end + close).alias("at"), F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(read_back(text), start, step)["spans"]


def digests(df: DataFrame) -> DataFrame:
    """Digest columns of (conv_id, formatted), all read back from the formatted text."""
    back = df.select("conv_id", "formatted", read_back(F.col("formatted")).alias("back"))
    loss = F.array_join(F.transform(F.filter("back", lambda p: p["loss"]), lambda p: p["text"]), "")
    return back.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("back", lambda p: F.concat(p["role"], F.lit("\n"), p["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
