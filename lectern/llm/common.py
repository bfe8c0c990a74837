"""What the operators of this subpackage share: scratch folders, word splitting and label folds."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_CHARS = 4_000_000
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession, most: int = SLICE_CHARS) -> None:
    """Bounds the bytes of an Arrow batch where the session has no bound below the default, for long texts come in whole batches to workers and to the executor's buffers."""
    if spark.conf.get(BATCH_BYTES, None) in (None, "67108864b"):
        spark.conf.set(BATCH_BYTES, most)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder in spark.checkpoint.dir. Where that is unset, a local session gets a folder of its own; on a cluster it is an error."""
    small_batches(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='lectern-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Removes what `stored` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def freed(spark: SparkSession):
    """Within it, a query's shuffle files go when the query ends. Else they stay until the driver happens to collect its garbage, however large they are."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is in fold -1, which is none of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds, F.lit(-1))


def release() -> None:
    """Gives freed memory back to the system, for workers live on and share an executor's memory."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_CHARS):
    """Splits a batch at rows so that a slice holds about `most` bytes of text, or one long row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(at, stop - at)
        at = stop
    release()


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row offsets, word codes and the words these stand for. Words are runs without ASCII white space; null is empty."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.list_flatten(parts).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    vocabulary = coded.dictionary
    offsets = np.concatenate([[0], np.cumsum(counts)])
    blank = pc.index(vocabulary, pa.scalar("", vocabulary.type)).as_py()
    if blank >= 0:  # white space at either end of a text
        keep = codes != blank
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return offsets, codes, vocabulary


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(vocabulary: pa.Array) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(w) for w in vocabulary.to_pylist()), np.uint64, len(vocabulary))


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles. Fewer words than the width: all as one shingle; none: empty."""
    offsets, codes, vocabulary = words(texts)
    hashes = word_hashes(vocabulary)[codes] if len(codes) else np.zeros(0, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        rolled = rolled * factor + hashes[k : k + len(rolled)]
    rolled = mix(rolled)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= width:
            s = np.sort(rolled[a : b - width + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for h in hashes[a:b]:
                one = mix(one * factor + h)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def bounds_of(df: DataFrame, column: str, per_part: int, most: int = 1_000_000) -> list[int]:
    """Ascending quantiles of an integer column that cut the rows in parts of about so many, from a sample by hash: 64 rows a part, `most` in all, which bounds what comes to the driver. The same rows give the same bounds."""
    n = df.count()
    parts = -(-n // per_part)
    if parts < 2:
        return []
    cells = 1 << 40
    share = min(1.0, 64 * parts / n, most / n)
    drawn = df.filter(F.pmod(F.xxhash64(column, F.lit("bounds")), F.lit(cells)) < int(share * cells)).select(F.col(column).cast("long").alias("v")).filter("v is not null")
    values = np.sort(drawn.toArrow()["v"].to_numpy())
    return sorted({int(values[len(values) * i // parts]) for i in range(1, parts)}) if len(values) else []


def part_of(column: Column, bounds: list[int]) -> Column:
    """The number of bounds that a value reaches; null: 0."""
    cuts = np.array(bounds, np.int64)

    @F.arrow_udf("int")
    def run(values: pa.Array) -> pa.Array:
        found = np.searchsorted(cuts, pc.fill_null(values, 0).to_numpy(zero_copy_only=False), side="right")
        return pa.array(np.where(pc.is_null(values).to_numpy(zero_copy_only=False), 0, found).astype(np.int32))

    return run(column.cast("long")) if bounds else F.lit(0)
