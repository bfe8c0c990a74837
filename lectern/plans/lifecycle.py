"""Idempotent upserts, orphan deletion, state gates and generations of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators.joins import orphans


def upserted(old: DataFrame, new: DataFrame, keys: list[str], scope: str | None = None) -> DataFrame:
    """New rows, and old rows whose key they lack. With a scope column, old rows of the scopes that the new ones cover and that are not among them go (orphans)."""
    kept = old.join(new.select(*keys), keys, "left_anti")
    if scope:
        kept = kept.join(new.select(scope).distinct(), scope, "left_anti").select(old.columns)
    return new.unionByName(kept, allowMissingColumns=True)


def changed(rows: DataFrame, state: DataFrame, key: str, marks: list[str], force: bool = False) -> DataFrame:
    """Rows whose marks differ from the recorded ones, or that have none; all if forced."""
    if force:
        return rows
    held = state.select(F.col(key).alias("_k"), *(F.col(m).alias(f"_{m}") for m in marks))
    same = rows[key] == held["_k"]
    for m in marks:
        same = same & rows[m].eqNullSafe(held[f"_{m}"])
    return rows.join(held, same, "left_anti")


def latest_version(df: DataFrame, keys: list[str], version: str, pinned: str | None = None) -> DataFrame:
    """The pinned version's rows, or per key those of the numerically highest version."""
    if pinned is not None:
        return df.filter(F.col(version) == pinned)
    parts = F.transform(F.split(F.col(version), r"\."), lambda x: x.try_cast("int"))
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(parts.desc()))
    return df.withColumn("_r", rank).filter("_r = 1").drop("_r")


def fetch_due(day: Column, seen: Column, today: Column, rescrape_days: int, force: bool = False) -> Column:
    """Whether a day's index is due: never seen, recent enough to be looked at again, or forced."""
    return F.lit(force) | seen.isNull() | (F.datediff(today, day) <= rescrape_days)


def row_digest(*columns: Column) -> Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def lines_digest(df: DataFrame, keys: list[str], line: Column) -> DataFrame:
    """Per key the sha256 of its lines in order."""
    return df.groupBy(*keys).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("digest"))


def grain_of(record_id: Column) -> Column:
    out = F.lit("documents")
    for mark, name in (("#q-", "questions"), ("#cmt-", "committee_meetings"), ("#interp-", "interpellations"), ("#agenda-", "agenda_items"), ("#act-", "speeches"), ("#vote-", "votes")):
        out = F.when(F.instr(record_id, mark) > 0, name).otherwise(out) if mark not in ("#act-", "#vote-") else F.when(record_id.contains(mark), name).otherwise(out)
    return out


def index_one(rows: DataFrame, table: DataFrame, state: DataFrame, marks: list[str], key: str = "document_id", record: str = "record_id", force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(table, state) after one run. Documents whose marks are those of the state are skipped; the rows of the others replace what the table has of them, so that records that are gone go too."""
    due = changed(rows.select(key, *marks).distinct(), state, key, marks, force).select(key, *marks)
    fresh = rows.join(due.select(key), key, "left_semi").drop(*[m for m in marks if m not in table.columns])
    kept = table.join(due.select(key), key, "left_anti")
    return kept.unionByName(fresh.select(*[c for c in fresh.columns if c in table.columns]), allowMissingColumns=True), upserted(state, due, [key])


def versions_current(cached: Column, schema_version: Column, expected: dict[str, str], schema: str) -> Column:
    """Whether a document was extracted by exactly these component versions and schema."""
    pairs = lambda m: F.array_sort(F.map_entries(m))
    want = F.create_map(*(F.lit(x) for kv in expected.items() for x in kv)) if expected else F.create_map().cast("map<string,string>")
    return F.coalesce((schema_version == schema) & (pairs(cached) == pairs(want)), F.lit(False))


def envelope(df: DataFrame, extractor: str, versions: dict[str, str], schema: str, at: str) -> DataFrame:
    """Adds the provenance of an extraction: schema_version and extraction."""
    marks = F.create_map(*(F.lit(x) for kv in versions.items() for x in kv))
    return df.withColumns({"schema_version": F.lit(schema), "extraction": F.struct(F.lit(extractor).alias("extractor"), F.lit(at).alias("extracted_at"), marks.alias("extractor_versions"))})


def restamped(items: DataFrame, parent: str, kind: str, *order: Column) -> DataFrame:
    """Ids by place, anew: votes have a counter of their own within an item, everything else shares another."""
    vote = F.col(kind) == "vote"
    n = F.row_number().over(Window.partitionBy(parent, vote).orderBy(*order))
    return items.withColumn("id", F.concat(F.col(parent), F.when(vote, "#vote-").otherwise("#act-"), n))


def carried(rows: DataFrame, prior: DataFrame, record: str = "record_id", column: str = "slug") -> DataFrame:
    """A column as it was minted before, by record; the new value where there was none."""
    old = prior.select(record, F.col(column).alias("_old"))
    return rows.join(old, record, "left").withColumn(column, F.coalesce(F.nullif("_old", F.lit("")), F.col(column))).drop("_old")


def invalid(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the names of all rules they break; a rule that is null counts as kept."""
    broken = F.array_compact(F.array(*(F.when(~c, F.lit(k)) for k, c in rules.items())))
    return df.withColumn("errors", broken).filter(F.size("errors") > 0)


def widened(old: DataFrame, new: DataFrame) -> list[str]:
    """The columns that a table gains by a new frame. Changes of type are an error: schemas only grow."""
    held = dict(old.dtypes)
    if clash := {c: (held[c], t) for c, t in new.dtypes if c in held and held[c] != t}:
        raise ValueError(f"types differ: {clash}")
    return [c for c in new.columns if c not in held]


class Generations:
    """Versions of a table as folders; a view of the table's name reads the live one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, name: str, suffix: str, df: DataFrame) -> str:
        path = f"{self.root}/{name}/generation={suffix}"
        df.write.mode("overwrite").parquet(path)
        return path

    def swap(self, name: str, suffix: str) -> None:
        self.spark.read.parquet(f"{self.root}/{name}/generation={suffix}").createOrReplaceTempView(name)

    def bootstrap(self, frames: dict[str, DataFrame], suffix: str = "v1") -> dict[str, int]:
        """Writes and serves a generation of each table that has none; gives the rows of all that are served."""
        for name, df in frames.items():
            held = self.listed(name)
            if not held:
                self.write(name, suffix, df)
            self.swap(name, held[-1] if held else suffix)
        return {name: self.spark.table(name).count() for name in frames}

    def listed(self, name: str) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName().partition("=")[2] for s in fs.listStatus(path)) if fs.exists(path) else []

    def drop(self, name: str, suffix: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/generation={suffix}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


__all__ = [
    "Generations", "carried", "changed", "envelope", "fetch_due", "grain_of", "index_one", "invalid", "latest_version", "lines_digest", "orphans", "restamped", "row_digest", "upserted", "versions_current", "widened",
]
