"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch keeps the k smallest distinct 48-bit shingle hashes of a text, in ascending order, base64-encoded six bytes each. Sketches of a text's parts merge into the sketch of their union. Two sketches give resemblance, containment and the number of distinct shingles; sets of fewer than k shingles give these exactly.

A null text is empty. A text without words has an empty sketch; two of those are alike (1.0), and one beside any other is not (0.0). Equal texts have equal sketches.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import common

K = 256
WIDTH = 5
_SPACE = float(1 << 48)


def bottom_k(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct values of ascending 64-bit hashes, by their upper 48 bits."""
    head = hashes[: k + 64] >> np.uint64(16)
    head = head[np.concatenate([[True], head[1:] != head[:-1]])] if len(head) else head
    return head[:k]


def encode(values: np.ndarray) -> str:
    """Six big-endian bytes a value, as base64."""
    return base64.b64encode(values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def decode(fingerprint: str | None) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint or ""), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def merge(sketches: list[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of the union."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *sketches]))[:k]


def distinct(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) * _SPACE / float(sketch[k - 1] + np.uint64(1))


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity, from the k smallest values of the union."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    joint = np.sort(np.concatenate([a, b]))
    twice = joint[1:] == joint[:-1]
    firsts = np.concatenate([[True], ~twice])
    if firsts.sum() <= k:
        return float(twice.sum() / firsts.sum())
    last = joint[np.flatnonzero(firsts)[k - 1]]
    return float((joint[1:][twice] <= last).sum() / k)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    j = resemblance(a, b, k)
    union = distinct(merge([a, b], k), k)
    return float(min(1.0, j * union / distinct(a, k)))


def fingerprint(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The fingerprint of each text."""

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array) -> pa.Array:
        out: list[str] = []
        for part in common.slices(pa.RecordBatch.from_arrays([texts], names=["text"])):
            out += [encode(bottom_k(s, k)) for s in common.shingle_sets(part.column(0), width)]
        return pa.array(out, pa.string())

    return run(text)


def merged(df: DataFrame, keys: list[str], column: str = "fingerprint", k: int = K) -> DataFrame:
    """Merges the fingerprints of parts: one per key. Partial sums of at most k values are formed before the shuffle and again in `salted` groups, so that a hot key isn't gathered whole."""
    schema = T.StructType([*(df.schema[x] for x in keys), T.StructField(column, T.StringType())])

    def combine(batches):
        held: dict[tuple, list] = {}
        for batch in batches:
            for *key, value in zip(*(batch.column(x).to_pylist() for x in [*keys, column]), strict=True):
                mine = held.setdefault(tuple(key), [])
                mine.append(decode(value))
                if len(mine) > 64:
                    mine[:] = [merge(mine, k)]
            if len(held) > 20_000:
                yield rows(held)
                held = {}
        if held:
            yield rows(held)

    def rows(held):
        columns = [pa.array([key[i] for key in held]) for i in range(len(keys))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([encode(merge(v, k)) for v in held.values()], pa.string())], names=[*keys, column])

    parts = df.select(*keys, column).mapInArrow(combine, schema)
    salted = parts.repartition(*keys, F.pmod(F.xxhash64(column), F.lit(32))).mapInArrow(combine, schema)
    return salted.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_by_run(keys, column, k), schema)


def _by_run(keys, column, k):
    """Combines runs of rows with equal keys in sorted input."""

    def run(batches):
        last, mine = None, []

        def row():
            return pa.RecordBatch.from_arrays([*(pa.array([x]) for x in last), pa.array([encode(merge(mine, k))], pa.string())], names=[*keys, column])

        for batch in batches:
            for *key, value in zip(*(batch.column(x).to_pylist() for x in [*keys, column]), strict=True):
                if last is not None and key != last:
                    yield row()
                    mine = []
                last = key
                mine.append(decode(value))
                if len(mine) > 64:
                    mine[:] = [merge(mine, k)]
        if last is not None:
            yield row()

    return run


def compare_edited(docs: DataFrame, k: int = K, width: int = WIDTH, rows_per_part: int = 8192) -> DataFrame:
    """Per document: the fingerprints of its text and of its edited text, and their likeness and that to the next document.

    The edited text has the last floor(n/2) code points replaced by the first as many of the next document by ascending doc_id (after the last: the first document). Null ids come first; equal ids are ordered by their text. An only document is its own next.

    Documents go once through a shuffle, to ranges of doc_id, sorted; the first id of each range is also dealt to the range before it, so that every document meets its next one.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = common.bounds_of(ids.select("doc_id"), "doc_id", rows_per_part)
    placed = ids.withColumn("part", common.part_of(F.col("doc_id"), bounds))
    found = placed.groupBy("part").agg(F.min("doc_id").alias("first")).toArrow()  # one row a part
    firsts = sorted(zip(found["part"].to_pylist(), found["first"].to_pylist(), strict=True))
    least = F.col("doc_id").isNull() if ids.filter("doc_id is null").limit(1).count() else F.col("doc_id") == (firsts[0][1] if firsts else 0)
    first = ids.filter(least).orderBy("text").limit(1).collect()  # one document, which follows the last one
    opening = first[0].text if first else ""
    final = firsts[-1][0] if firsts else 0
    heads = np.array([f for _, f in firsts[1:]], np.int64)
    before = np.array([p for p, _ in firsts[:-1]], np.int32)

    @F.arrow_udf("array<int>")
    def where(doc_id: pa.Array, part: pa.Array) -> pa.Array:
        at = np.searchsorted(heads, values := pc.fill_null(doc_id, 0).to_numpy(zero_copy_only=False))
        is_head = (at < len(heads)) & (heads[np.minimum(at, len(heads) - 1)] == values) & pc.is_valid(doc_id).to_numpy(zero_copy_only=False)
        return pa.array([[p, int(before[i])] if h else [p] for p, i, h in zip(part.to_pylist(), at.tolist(), is_head.tolist(), strict=True)], pa.list_(pa.int32()))

    placed = placed.withColumn("own", F.col("part"))
    if len(heads):
        placed = placed.withColumn("part", F.explode(where("doc_id", "part")))
    placed = placed.repartitionById(max(1, len(bounds) + 1), F.col("part")).sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def flush(rows):
        """rows: (doc_id, text, the next text), one after another."""
        if not rows:
            return
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for _, t, n in rows]
        texts = [t for _, t, _ in rows]
        sketches = [bottom_k(s, k) for s in common.shingle_sets(pa.array([*texts, rows[-1][2]], pa.string()), width)]
        changed = [bottom_k(s, k) for s in common.shingle_sets(pa.array(edited, pa.string()), width)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                pa.array([encode(s) for s in sketches[:-1]], pa.string()),
                pa.array([encode(s) for s in changed], pa.string()),
                pa.array([resemblance(a, b, k) for a, b in zip(sketches, changed, strict=False)], pa.float64()),
                pa.array([resemblance(a, b, k) for a, b in zip(sketches, sketches[1:], strict=False)], pa.float64()),
            ],
            names=[c.split()[0] for c in schema.split(", ")],
        )

    def run(batches):
        held, size, last = [], 0, None  # last: the row that still waits for the next one
        for batch in batches:
            for some in common.slices(batch):
                for part, own, doc_id, text in zip(*(some.column(c).to_pylist() for c in ("part", "own", "doc_id", "text")), strict=True):
                    if last is not None and last[0] == last[1]:  # others only end the part before theirs
                        held.append((last[2], last[3], text if last[0] == part else opening))
                        size += len(last[3]) + len(text)
                    if size > 2 * common.SLICE_CHARS or held and (last[0] != part or last[0] != last[1]):
                        yield from flush(held)
                        held, size = [], 0
                    last = (part, own, doc_id, text)
        if last is not None and last[0] == last[1]:
            held.append((last[2], last[3], opening))
        yield from flush(held)

    if not first:
        return spark.createDataFrame([], schema)
    return placed.select("part", "own", "doc_id", "text").mapInArrow(run, schema)
