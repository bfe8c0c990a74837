"""Streaming counterparts: file sources with availableNow, windows with watermarks, de-duplication and keyed upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.plans.lifecycle import upserted


def events(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the events table's files. New files alone are read in each run; the schema is that of the table."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(stream: DataFrame, width: str = "1 hour", late: str = "1 day", slide: str | None = None) -> DataFrame:
    """Counts and sums per window and type, closed by the watermark."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return stream.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    return stream.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "n")


def once_each(stream: DataFrame, keys: list[str], late: str = "7 days") -> DataFrame:
    """Late arrivals within the watermark are dropped where their key was seen."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def _batches(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batches that were written whole."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listStatus(root) if fs.exists(root) else []
    done = [f.getPath() for f in found if f.getPath().getName().startswith("batch=")]
    return sorted(int(p.getName().partition("=")[2]) for p in done if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def drained(stream: DataFrame, path: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """All that is there now, as a table below a shared folder. Each batch is written under its number, so a batch that runs again replaces itself; of complete output the last batch counts."""
    spark = stream.sparkSession
    schema = stream.schema
    put = lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/batch={n}")
    stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    done = _batches(spark, path)
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/batch={n}" for n in (done[-1:] if mode == "complete" else done)))


def journal(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Appends what is new to a journal, each batch once, and reads it whole."""
    return drained(stream, path, checkpoint, "append")


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The last whole state of an upserted table."""
    done = _batches(spark, path)
    return spark.read.parquet(f"{path}/batch={done[-1]}") if done else None


def upsert_into(stream: DataFrame, path: str, keys: list[str], order: list[str], checkpoint: str) -> DataFrame:
    """Upserts each batch into a table by key and gives its state. Of several rows of a key the last by `order` counts. Each batch writes a whole new state beside the old one, which stays until then; a batch that runs again starts from the state before it."""
    spark = stream.sparkSession

    def put(batch: DataFrame, n: int) -> None:
        s = batch.sparkSession
        one = batch.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), F.struct(*order, F.xxhash64(*batch.columns))).alias("_r")).select("_r.*")
        before = [b for b in _batches(s, path) if b < n]
        old = s.read.parquet(f"{path}/batch={before[-1]}") if before else one.limit(0)
        upserted(old, one, keys).write.mode("overwrite").parquet(f"{path}/batch={n}")
        for b in before[:-1]:
            folder = s._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={b}")
            folder.getFileSystem(s._jsc.hadoopConfiguration()).delete(folder, True)

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return current(spark, path)


def waiting(stream: DataFrame, days: int = 60, late: str = "1 day") -> DataFrame:
    """(match_key, document_id, defers_to, waited) of votes (match_key, document_id, at timestamp, outcome): each deferred vote with the first later vote on its matter within the days, or with null once the watermark shows that none came. A vote per key and time counts once.

    State per matter: the deferred votes that still wait, and the votes that could be theirs.
    """
    import pandas as pd

    schema = "match_key string, document_id string, defers_to string, waited double"
    state_schema = "rows array<struct<document_id:string,at:timestamp,deferred:boolean>>"
    span = pd.Timedelta(days=days)

    def step(key, frames, state):
        held = {(r["document_id"], pd.Timestamp(r["at"]), bool(r["deferred"])) for r in (state.get[0] if state.exists else [])}
        for f in frames:
            held |= {(d, pd.Timestamp(t), o == "deferred") for d, t, o in zip(f["document_id"], f["at"], f["outcome"], strict=True)}
        mark = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
        rows, out, kept = sorted(held, key=lambda r: (r[1], r[0])), [], set()
        for document, at, deferred in rows:
            if not deferred:
                continue
            later = next((r for r in rows if at < r[1] <= at + span), None)
            # a later row decides once nothing earlier can still come
            if later is not None and later[1] <= mark:
                out.append((key[0], document, later[0], (later[1] - at) / pd.Timedelta(days=1)))
            elif at + span < mark:
                out.append((key[0], document, None, None))
            else:
                kept.add((document, at, True))
        since = min((at for _, at, _ in kept), default=None)
        recent = {r for r in rows if not r[2] and (r[1] > mark or (since is not None and r[1] > since))}
        told = {(r[0], r[1], False) for r in rows if r[2] and (document_done(r, kept)) and (r[1] > mark or (since is not None and r[1] > since))}
        left = sorted(kept | recent | told, key=lambda r: (r[1], r[0], r[2]))
        if left:
            state.update(([{"document_id": d, "at": t.to_pydatetime(), "deferred": w} for d, t, w in left],))
            state.setTimeoutTimestamp(int(max(state.getCurrentWatermarkMs() + 1, (min(t for _, t, _ in left) + span).timestamp() * 1000 + 1)))
        else:
            state.remove()
        yield pd.DataFrame(out, columns=["match_key", "document_id", "defers_to", "waited"])

    def document_done(row, kept) -> bool:
        """A deferred vote that is told already still answers earlier ones."""
        return (row[0], row[1], True) not in kept

    votes = stream.select("match_key", "document_id", F.col("at").cast("timestamp").alias("at"), "outcome").withWatermark("at", late)
    return votes.groupBy("match_key").applyInPandasWithState(step, schema, state_schema, "append", "EventTimeTimeout")
