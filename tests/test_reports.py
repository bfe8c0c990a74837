"""Reports, eligibility, lifecycle, rankings, resampling and streams, on rows of our own."""

from __future__ import annotations

import datetime
import json
import math

from pyspark.sql import functions as F

from lectern.operators import windows
from lectern.plans import eligibility, grains, lifecycle, linking, rankings, reports
from lectern.streaming import streams


def sidecars(spark, docs):
    return spark.read.schema(grains.SIDECAR).json(spark.sparkContext.parallelize([json.dumps(d) for d in docs]))


def corpus(spark):
    ref = lambda kind, raw, **more: {"type": kind, "raw": raw, **more}
    acts = [{"id": "s", "type": "speech", "text": "abcd", "speaker": {"name": "Ion", "role": "x"}, "references_mentioned": [ref("law", "L"), ref("unknown", "art. 5", resolved_to={"char_offsets": [1, 2]}), ref("unknown", "HG")]}, {"id": "t", "type": "speech", "text": " ", "speaker": {}}, {"id": "v", "type": "vote", "defers_to": "d2", "proposed_by": {"role": "Guvern"}}]
    plenary = {"document_id": "d1", "schema_version": "1", "document_type": "plenary_stenogram", "body": {"agenda_items": [{"id": "a", "title": "Titlu <br> rău", "category": "motion", "outcome": "adoptat", "primary_references": [ref("bill", "B")], "activities": acts}, {"id": "b", "title": "Bun"}], "interpellations": [{"id": "i", "addressed_to": "Ministerul X", "addressed_to_normalized": "x", "question_text": "?"}, {"id": "j"}]}}
    register = {"document_id": "d2", "schema_version": "1", "document_type": "question_register", "body": {"questions": [{"id": "q", "addressee": {"ministry_normalized": "m"}}, {"id": "r"}]}}
    report = {"document_id": "d3", "schema_version": "2", "document_type": "report_facsimile", "body": {"report": {"issuing_body": "Curtea"}}}
    committee = {"document_id": "d4", "schema_version": "2", "document_type": "committee_synthesis", "body": {"committees": [{"name": "c", "meetings": [{"agenda": [{"ordinal": 1}]}]}, {"name": "e"}]}}
    return sidecars(spark, [plenary, register, report, committee])


def test_smoke_and_probes(spark):
    docs = corpus(spark)
    got = {r.name: r.value for r in reports.smoke(docs).collect()}
    want = {"agenda_items": 2, "votes": 1, "votes_proposed_by": 1, "votes_deferring": 1, "votes_resolving": 0, "interpellations": 2, "interpellations_text": 1, "interpellations_normalised": 1, "questions": 2, "questions_normalised": 1, "reports": 1, "reports_issued": 1, "committees": 2, "committees_with_agenda": 1, "committees_with_roster": 0, "unknown_references": 2, "unknown_resolved": 1, "type:plenary_stenogram": 1, "schema:1": 2, "reference:unknown": 2, "reference:bill": 1, "category:motion": 1, "category:<missing>": 1, "outcome:adoptat": 1}
    assert {k: got[k] for k in want} == want
    probes = {r.probe: (r.value, r.passed) for r in reports.probes(docs, rejected=0, invalid=1).collect()}
    assert probes == {"P1": (1.0, False), "P2": (0.0, True), "P3": (100.0, True), "P4": (0.0, True), "P5": (100.0, True), "P6": (1.0, False)}
    rows, sums = reports.speech_coverage(docs, spark.createDataFrame([("d1", "## **Ion:**\nabcd\n## **Ana**\n## **Dan**\n## **E**\n")], "document_id string, body_text string"))
    r, s = rows.first(), sums.first()
    assert (r.headers, r.speeches, r.capture, r.speech_chars, r.named, r.with_text) == (4, 2, 0.5, 5, 1, 1)
    assert (s.documents, s.capture_pct, s.named_pct, s.above_50, s.whole, s.p50) == (1, 50.0, 50.0, 1, 0, 0.5)
    assert reports.smoke(docs.limit(0)).filter("value > 0").count() == 0
    scores = spark.createDataFrame([([0.5, None, 1.0],), ([],), (None,)], "c array<double>")
    assert [r.m for r in scores.select(reports.confidence_mean(F.col("c")).alias("m")).collect()] == [0.75, 1.0, 1.0]
    classed = spark.createDataFrame([("a", False), ("a", True), ("other", False)], "top_type string, ambiguous boolean")
    assert [tuple(r) for r in reports.classes(classed).collect()] == [("a", 2, 1), ("other", 1, 0)] and reports.outliers(classed).count() == 2


def test_runs(spark, tmp_path):
    models = spark.createDataFrame([("a", 0.5, 0.9, 2.0, 2), ("b", 0.5, None, 0.0, 0), ("c", None, None, 1.0, 1), ("d", 0.9, 0.1, 9.0, 1)], "model string, h_rate double, d_rate double, cost_usd double, n_total int")
    assert [r.model for r in reports.benchmark(models).collect()] == ["d", "a", "b", "c"]
    pairs = spark.createDataFrame([("x", 1, 1), ("x", 2, 1), (None, 0, None), ("y", 2, 0)], "tier string, g int, c int")
    got = {r.tier: (r.matches, r.abs_delta, r.null_pairs) for r in reports.agreement_by_tier(pairs, "g", "c").collect()}
    assert got == {"x": (1, 1, 0), "?": (0, None, 1), "y": (0, 2, 0), None: (1, 3, 1)}
    calls = "kind string, tokens_in int, fresh int, cache_creation int, cache_read int, tokens_out int, cost_usd double, latency_ms int, retries_used int, parse_repaired boolean, error string, fragments_missed int, score int, level int, constructive string, marker_kinds array<string>, voices array<string>"
    rows = [("hawkins", 10, 1, 0, 0, 5, 0.5, 100, 1, True, None, 2, 1, None, None, ["a", "a"], None), ("voice", 1, 0, 0, 0, 1, None, 1, 0, False, "bad", 0, None, None, None, None, ["me"]), ("dqi", 1, 0, 0, 0, 1, 0.1, 1, 0, False, None, 0, None, 2, "positional", None, None), ("other", 9, 9, 9, 9, 9, 9.0, 9, 9, True, "x", 9, 9, 9, "x", ["z"], ["z"])]
    s = reports.model_summary(spark.createDataFrame(rows, calls))
    t = s["totals"].first()
    assert (t.calls, t.tokens_in, t.tokens_out, round(t.cost_usd, 3), t.calls_with_retries, t.calls_with_repair) == (3, 12, 7, 0.6, 1, 1)
    flat = {k: [tuple(r) for r in s[k].collect()] for k in s if k != "totals"}
    assert flat == {"errors": [("voice", "bad", 1)], "fragments": [("hawkins", 2)], "scores": [("hawkins", 1, 1)], "markers": [("hawkins", "a", 2)], "voices": [("me", 1)], "levels": [(2, 1)], "constructive": [("positional", 1)]}
    one = spark.createDataFrame([("5", 429, "schema_invalid", "'x' is a required property", 95, 100), ("900", 429, "schema_invalid", None, 99, 100), ("x", 500, None, None, None, None)], "h string, s int, e string, d string, o int, m int")
    got = [tuple(r) for r in one.select(reports.retry_after(F.col("h"), F.col("s")), reports.truncated(F.col("e"), F.col("d"), F.col("o"), F.col("m")), reports.cost(F.col("o"), F.col("m"), 1.0, 2.0)).collect()]
    assert got[0] == (5.0, True, 295.0) and got[1] == (60.0, False, 299.0) and got[2][0] is None and got[2][2] == 0.0
    for form in ("json", "text"):
        reports.write_report(pairs, f"file://{tmp_path}/{form}", form)
    assert spark.read.json(f"file://{tmp_path}/json").count() == 4 and "tier=x g=1 c=1" in {r.value for r in spark.read.text(f"file://{tmp_path}/text").collect()}


def test_eligibility(spark):
    long = "cuvânt " * 30
    rows = [("a", long, "Ion Pop", "Ion Pop"), ("b", long, "Din sală", None), ("c", "scurt", "Ion", "Ion"), (None, long, "Ion", "Ion"), ("e", long * 40, "Ana", "Ana"), ("f", long, None, "Voci din sală"), ("g", long, "din sală mare", "x"), ("h", long, None, None)]
    df = spark.createDataFrame(rows, "record_id string, text string, speaker_name string, speaker_raw string")
    few, many = eligibility.codable(df)
    assert sorted(r.record_id for r in few.collect()) == ["a", "g", "h"] and [r.record_id for r in many.collect()] == ["e"]
    assert sorted(r.record_id for r in eligibility.pool(df, 10, 100).collect()) == ["a"]
    assert [r.n for r in spark.createDataFrame([("x" * 99,), ("y" * 9000,), (None,)], "t string").select(F.length(eligibility.embeddable(F.col("t"))).alias("n")).collect()] == [None, 8000, None]


def test_lifecycle(spark, tmp_path):
    rows = spark.createDataFrame([("d1", "r1", "s1", 1), ("d1", "r2", "s1", 2), ("d2", "r3", "s2", 3)], "document_id string, record_id string, sha string, v int")
    empty_table, empty_state = rows.drop("sha").limit(0), rows.select("document_id", "sha").limit(0)
    table, state = lifecycle.index_one(rows, empty_table, empty_state, ["sha"])
    assert table.count() == 3 and state.count() == 2
    later = spark.createDataFrame([("d1", "r1", "s9", 7), ("d2", "r3", "s2", 8)], rows.schema)
    table2, state2 = lifecycle.index_one(later, table, state, ["sha"])
    assert {(r.record_id, r.v) for r in table2.collect()} == {("r1", 7), ("r3", 3)} and {r.sha for r in state2.collect()} == {"s9", "s2"}
    cached = spark.createDataFrame([({"a": "1", "b": "2"}, "9"), ({"a": "1"}, "9"), ({"b": "2", "a": "1"}, "8"), (None, None)], "m map<string,string>, s string")
    assert [r.x for r in cached.select(lifecycle.versions_current(F.col("m"), F.col("s"), {"b": "2", "a": "1"}, "9").alias("x")).collect()] == [True, False, False, False]
    made = lifecycle.envelope(rows, "regex", {"a": "1"}, "9", "now").first()
    assert (made.schema_version, made.extraction.extractor_versions) == ("9", {"a": "1"})
    acts = spark.createDataFrame([("i", "speech", 1), ("i", "vote", 2), ("i", "narrator", 3), ("i", "vote", 4)], "parent string, kind string, at int")
    assert [r.id for r in lifecycle.restamped(acts, "parent", "kind", F.col("at")).orderBy("at").collect()] == ["i#act-1", "i#vote-1", "i#act-2", "i#vote-2"]
    prior = spark.createDataFrame([("r1", "old"), ("r2", "")], "record_id string, slug string")
    assert {r.record_id: r.slug for r in lifecycle.carried(rows.select("record_id", F.lit("new").alias("slug")), prior).collect()} == {"r1": "old", "r2": "new", "r3": "new"}
    bad = lifecycle.invalid(rows, {"small": F.col("v") < 3, "named": F.col("record_id").isNotNull(), "unknown": F.lit(None).cast("boolean")}).collect()
    assert [(r.record_id, r.errors) for r in bad] == [("r3", ["small"])]
    assert lifecycle.widened(rows, rows.withColumn("more", F.lit(1))) == ["more"]
    g = lifecycle.Generations(spark, f"file://{tmp_path}/g")
    assert g.bootstrap({"t_one": rows}) == {"t_one": 3} == g.bootstrap({"t_one": rows.limit(1)})
    assert windows.suffixed(spark.createDataFrame([("a", 1), ("a", 2), ("a-2", 3), ("a", 4), ("b", 5)], "k string, o int"), "k", F.col("o")).orderBy("o").select("unique_key").collect() == [("a",), ("a-3",), ("a-2",), ("a-4",), ("b",)]
    tiers = spark.createDataFrame([("p", "x"), ("q", "y")], "person string, tier string")
    speeches = spark.createDataFrame([("p", str(i % 5)) for i in range(20)] + [("q", "9"), ("r", "8")], "person string, id string")
    assert sorted((r.tier, r.person) for r in windows.per_tier(speeches, tiers, "person", "id", 3).collect()) == [("x", "p")] * 3 + [("y", "q")]


def test_rankings_against_loops(spark):
    marks = "array<struct<framework:string,kind:string,complete:boolean>>"
    dqi = "struct<level_of_justification:int,content_of_justification:string,respect_for_groups:int,respect_for_demands:int,respect_for_counterarguments:int,constructive_politics:string>"
    rows = []
    for i in range(120):
        m = [("fear", "invasion", True)] * (i % 3) + [("vparty", "media_hostility", False)] * (i % 2) + [("securitization", "nation" if i % 4 else "family", i % 5 == 0), ("conspiracy", "parallel_state", True), ("geopolitical_alignment", "nato_skeptic", True), ("audience", "heckling", True), ("fallacy", "strawman", True)]
        rows.append((f"r{i}", f"p{i % 4}", f"party{i % 2}", "c1", datetime.date(2016 + i % 8, 5, 1), "floor" if i % 3 else "committee", 600, i % 3, 0.9, "first_person", (i % 4, "common_good", 2, 1, 0, "positional"), m, float(i % 5 - 2), float(i % 7 - 3), 1.0 if i % 2 else -1.0, 0.5))
    c = spark.createDataFrame(rows, f"record_id string, person_id string, party string, cycle string, session_date date, context string, words int, hawkins int, confidence double, voice string, dqi {dqi}, markers {marks}, econ double, cultural double, party_econ double, party_cultural double")
    registry = spark.createDataFrame([("party0", "2010-01-01", 1.0), ("party1", "2010-01-01", 0.0), ("party1", "2020-01-01", 2.0)], "party string, cycle string, value double")
    for name, ranking in rankings.RANKINGS.items():
        more = {"party_manifesto_divergence@v1": {"registry": registry}, "speeches_with_marker@v1": {"kind": "media_hostility"}}.get(name, {})
        assert ranking(c, **more).count() > 0, name
    mine = [r for r in rows if r[1] == "p1"]
    fear = rankings.RANKINGS["most_fearmongering@v1"](c).filter("person_id = 'p1'").first()
    assert (fear.total, fear.invasion, fear.enemy_within) == (sum(i % 3 for i in range(1, 120, 4)), sum(i % 3 for i in range(1, 120, 4)), 0)
    best = rankings.RANKINGS["highest_dqi_speakers@v1"](c).filter("person_id = 'p1'").first()
    assert math.isclose(best["mean"], (1 / 3 + 1 + 1 + 0.5 + 0 + 0) / 6) and math.isclose(best.level_of_justification, 1 / 3)
    cross = rankings.RANKINGS["cross_axis_divergence@v1"](c).filter("person_id = 'p1'").first()
    flips = [max(r[12] * r[14] < 0, r[13] * r[15] < 0) for r in mine]
    assert math.isclose(cross.per_kword, 1000 * sum(flips) / (600 * len(mine)))
    assert rankings.RANKINGS["most_conspiracy_framing@v1"](c).filter("out_of_era").count() == 1
    assert {r.person_id: r.speeches for r in rankings.RANKINGS["most_pro_russia@v1"](c).collect()} == {"p2": 15, "p3": 15}
    only = rankings.most_securitizing(c, ("family",)).filter("person_id = 'p0'").first()
    assert (only.total, only.family, only.nation) == (6, 6, 0)
    gap = {r.party: (r.mean, r.registry) for r in rankings.manifesto_divergence(c, F.col("econ"), registry, 50).collect()}
    for p in ("party0", "party1"):
        own = [r for r in rows if r[2] == p]
        value = [1.0 if p == "party0" else 2.0 if r[4].year >= 2020 else 0.0 for r in own]
        assert math.isclose(gap[p][0], sum(r[12] for r in own) / len(own), abs_tol=1e-9) and math.isclose(gap[p][1], sum(value) / len(own))
    assert rankings.quarters(c, F.col("hawkins")).count() == len({(r[1], r[4].year) for r in rows})


def test_resampling_draws_each_row(spark):
    same = spark.range(400).select("id", F.lit("g").alias("g"), F.lit(1).alias("v"), F.lit(2).alias("w"))
    drawn = windows.resampled(same, "id", 50).groupBy("_b").agg(F.sum("_t").alias("n"), F.countDistinct("_t").alias("k")).collect()
    assert all(300 < r.n < 500 and r.k > 2 for r in drawn) and len({r.n for r in drawn}) > 10


def test_streams(spark, tmp_path):
    schema = "k string, v int, t timestamp"
    at = datetime.datetime(2024, 1, 1)
    for n, rows in enumerate(([("a", 1, at), ("a", 2, at + datetime.timedelta(1))], [("a", 0, at), ("b", 5, at)], [("b", 6, at + datetime.timedelta(2))])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{tmp_path}/in/{n}")
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/in")
    for _ in range(2):  # the second run has nothing new
        state = streams.upsert_into(stream(), f"file://{tmp_path}/state", ["k"], ["t"], f"file://{tmp_path}/c1")
        assert {r.k: r.v for r in state.collect()}.keys() == {"a", "b"}
        assert streams.journal(stream(), f"file://{tmp_path}/journal", f"file://{tmp_path}/c2").count() == 5
    assert len(list((tmp_path / "state").glob("batch=*"))) <= 2


def test_deferrals_wait_for_what_takes_them_up(spark, tmp_path):
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(n)
    schema = "match_key string, document_id string, at timestamp, outcome string"
    votes = [("k", "d1", 0, "deferred"), ("k", "d2", 10, "deferred"), ("k", "d3", 30, "approved"), ("m", "e1", 0, "deferred"), ("m", "e2", 90, "approved"), ("n", "f1", 5, "approved")]
    batches = [[votes[0], votes[3], votes[5]], [votes[1]], [votes[2], votes[4]], [("z", "z1", 400, "approved")], [("z", "z2", 800, "approved")]]
    for n, rows in enumerate(batches):
        spark.createDataFrame([(k, d, day(t), o) for k, d, t, o in rows], schema).coalesce(1).write.parquet(f"file://{tmp_path}/in/{n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/in")
    got = streams.drained(streams.waiting(stream), f"file://{tmp_path}/out", f"file://{tmp_path}/c", "append")
    assert {(r.document_id, r.defers_to) for r in got.collect()} == {("d1", "d2"), ("d2", "d3"), ("e1", None)}
    assert linking.DAYS == 60
