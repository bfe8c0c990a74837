"""Parsers of source texts: issue links, frontmatter, day ranges, scan triage, enrichment files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Enrichment file names, and bounds of the scan triage (average characters a page, share of image pages).
ENRICHMENT = r"^(.+?)\.([a-z_]+)(?:\.([A-Za-z0-9_-]+))?\.v(\d+(?:_\d+)*)\.json$"


def links(pages: DataFrame, html: str, pattern: str, keys: list[str], group_names: list[str]) -> DataFrame:
    """Links of each page by a pattern whose groups have names, first of each key per page in order of appearance."""
    found = F.regexp_extract_all(F.col(html), F.lit(pattern), 0)
    rows = pages.select("page_id", F.posexplode(found).alias("at", "_m"))
    rows = rows.select("page_id", "at", *(F.regexp_extract("_m", pattern, i + 1).alias(g) for i, g in enumerate(group_names)))
    rank = F.row_number().over(Window.partitionBy("page_id", *keys).orderBy("at"))
    return rows.withColumn("_r", rank).filter("_r = 1").drop("_r")


def days(spark: SparkSession, start: str, end: str, reverse: bool = False) -> DataFrame:
    """One row a day, both ends included."""
    seq = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(F.reverse(seq) if reverse else seq).alias("day"))


def frontmatter(text: Column) -> Column:
    """(fields, body): key: value lines between two --- lines, quotes taken off; without them no fields."""
    pattern = r"(?s)\A---\n(.*?)\n---\n?(.*)\z"
    has = text.rlike(pattern)
    lines = F.filter(F.split(F.regexp_extract(text, pattern, 1), "\n"), lambda x: x.rlike(r"^\w+:"))
    fields = F.map_from_entries(F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"^(\w+):", 1), F.regexp_replace(F.trim(F.regexp_extract(x, r"^\w+:(.*)$", 1)), r'^"(.*)"$', "$1"))))
    return F.struct(F.when(has, fields).otherwise(F.create_map().cast("map<string,string>")).alias("fields"), F.when(has, F.regexp_extract(text, pattern, 2)).otherwise(text).alias("body"))


def request_outcome(status: Column, transport_error: Column, is_pdf: Column) -> Column:
    """transient (worth a retry), gone (permanent) or ok."""
    return F.when(transport_error | (status >= 500) | (status == 429), "transient").when((status >= 400) | ~is_pdf, "gone").otherwise("ok")


def backoff(attempt: Column) -> Column:
    return F.least(F.pow(F.lit(2.0), attempt - 1), F.lit(8.0))


def scan_triage(avg_chars: Column, image_share: Column) -> Column:
    """likely_scanned, mixed, suspicious or text, by characters a page and share of image pages."""
    return F.when((avg_chars < 200) & (image_share >= 0.5), "likely_scanned").when((avg_chars < 500) & (image_share >= 0.2), "mixed").when((image_share >= 0.5) & (avg_chars < 2000), "suspicious").otherwise("text")


def enrichment_name(file: Column) -> Column:
    """base, producer, model and version of an enrichment file name; null where it doesn't fit."""
    get = lambda g: F.nullif(F.regexp_extract(file, ENRICHMENT, g), F.lit(""))
    return F.when(file.rlike(ENRICHMENT), F.struct(get(1).alias("base"), get(2).alias("producer"), get(3).alias("model"), F.replace(get(4), F.lit("_"), F.lit(".")).alias("version")))


def enrichments(files: DataFrame, content_sha: DataFrame | None = None) -> DataFrame:
    """(record_id, producer, version, payload) of files (file, json): the numerically highest version per base and producer; entries of another source text are dropped."""
    named = files.withColumn("n", enrichment_name(F.col("file"))).filter("n is not null").select("n.*", F.from_json("json", "map<string,string>").alias("m"))
    parts = F.transform(F.split("version", r"\."), lambda x: x.cast("int"))
    rank = F.rank().over(Window.partitionBy("base", "producer").orderBy(parts.desc()))
    rows = named.withColumn("_r", rank).filter("_r = 1").select("base", "producer", "version", F.explode("m").alias("record_id", "payload"))
    rows = rows.withColumn("sha", F.get_json_object("payload", "$._meta.source_sidecar_content_sha"))
    if content_sha is not None:
        rows = rows.join(content_sha.withColumnRenamed("content_sha", "_c"), "base", "left").filter("sha is null or sha = _c").drop("_c")
    return rows.drop("sha")


# How a link to an issue's page ends: part, number and year.
ISSUE = r'href="(/[^"]*--P([IVXM]+)--([0-9A-Za-z]+)--(\d{4})\.html)"'


def issues(pages: DataFrame, html: str = "html", part: str = "II", pattern: str = ISSUE, key: str = "page_id") -> DataFrame:
    """(key, href, part, number, year) of links to issues of a part, the first of each number and year per page. The pattern's groups are href, part, number and year."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(pattern), 0)).alias("at", "_m"))
    get = lambda g: F.regexp_extract("_m", pattern, g)
    rows = found.select(key, "at", get(1).alias("href"), get(2).alias("part"), get(3).alias("number"), get(4).try_cast("int").alias("year")).filter(F.col("part") == part)
    return rows.groupBy(key, "part", "number", "year").agg(F.min_by("href", "at").alias("href")).select(key, "href", "part", "number", "year")


def typed(value: Column) -> Column:
    """(number, day, text) of a frontmatter value: a whole number, a date, or else text, without quotes and with its escapes undone; all null where it is empty."""
    raw = F.nullif(F.trim(value), F.lit(""))
    quoted = raw.rlike(r"""^(?s)(".*"|'.*')$""") & (F.length(raw) > 1)
    bare = F.replace(F.replace(F.substring(raw, F.lit(2), F.length(raw) - 2), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
    number = F.when(~quoted & raw.rlike(r"^-?\d+$"), raw.try_cast("long"))
    day = F.when(~quoted & raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(raw, "yyyy-MM-dd"))
    return F.struct(number.alias("number"), day.alias("day"), F.when(quoted, bare).when(number.isNull() & day.isNull(), raw).alias("text"))


def collected(spark: SparkSession, paths: list[str], suffix: str = ".pdf", reverse: bool = False) -> DataFrame:
    """(path) of the files with a suffix under files and folders, each once, in order of their names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", False).load(paths).select("path").distinct()
    name = F.element_at(F.split("path", "/"), -1)
    return files.orderBy(name.desc() if reverse else name, "path")


def flat_enrichment(producer: Column, payload: Column, allowed: list[str]) -> Column:
    """What an entry of a producer adds to a record, as a map of names to JSON: without its provenance; an only key that is named like the producer stands for the whole; an embedding becomes vector and fingerprint. Only allowed names stay."""
    fields = F.map_filter(F.from_json(payload, "map<string,string>"), lambda k, v: (k != "_meta") & v.isNotNull())
    alone = (F.size(fields) == 1) & F.map_contains_key(fields, producer)
    embedding = F.map_filter(F.create_map(F.lit("embedding"), fields["vector"], F.lit("embedding_text_fingerprint"), fields["text_fingerprint"]), lambda k, v: v.isNotNull())
    plain = F.create_map(producer, F.when(alone, fields[producer]).otherwise(F.to_json(fields)))
    out = F.when(fields.isNull(), F.create_map(producer, payload)).when((producer == "embedding") & F.map_contains_key(fields, F.lit("vector")), embedding).otherwise(plain)
    return F.map_filter(out, lambda k, v: k.isin(*allowed))
