"""Grain projections, rules and functions on small fixtures of our own."""

from __future__ import annotations

import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lectern.functions import rules, text
from lectern.operators import joins, sets, windows
from lectern.plans import grains, lifecycle, rankings, search
from lectern.sources import parsers

LONG = "Stimați colegi, " * 10


@pytest.fixture(scope="module")
def sidecars(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sidecars")
    speaker = {"raw": "Domnul Ion Pop", "name": "Ion Pop", "title": None, "role": None, "party_group": "X", "person_id": "ion-pop"}
    doc = {
        "schema_version": "1.13.0", "document_id": "mo://2018/II/7", "content_sha": "abc", "document_type": "plenary_stenogram",
        "metadata": {"issue": "7", "part": "II", "published": "2018-02-30", "chamber": "", "session_date": "2018-03-01", "year": 2018},
        "coverage": {"claimed_pct": 0.99, "body_chars": 10},
        "body": {
            "session": {"chambers_present": ["Senatul", "Camera Deputaților"]},
            "agenda_items": [
                {
                    "id": "mo://2018/II/7#agenda-1", "ordinal": 1, "title": "T", "slug": "t-abc", "topics": {"primary": ["buget"]},
                    "primary_references": [{"type": "bill", "number": "100", "year": 2018}, {"type": "law", "raw": "Legea 5/2010", "number": "5", "year": 2010}, {"type": "bill", "number": "100", "year": 2018}],
                    "activities": [
                        {"id": "s1", "type": "speech", "text": LONG, "speaker": speaker, "slug": "s-1", "source_span": {"chars": [5, 9]}},
                        {"id": "n1", "type": "narrator", "text": "x"},
                        {"id": "s2", "type": "speech", "text": "Da.", "speaker": speaker},
                        {"id": "", "type": "speech", "text": "no id"},
                        {"id": "v1", "type": "vote", "outcome": "deferred", "slug": "vot-k9", "counts": {"for": "unanimous", "against": 2}, "proposed_by": {"name": " Guvernul "}},
                        {"id": "v2", "type": "vote", "outcome": "approved", "counts": {"for": 132, "against": 5, "abstain": 2, "total_voting": 139}},
                    ],
                }
            ],
            "interpellations": [{"id": "i1", "questioner": speaker, "response": {"speaker": speaker, "text": "r"}, "slug": "i-1"}],
            "questions": [{"id": "q1", "registration_date": "2018-11-31", "addressee": {"ministry": "", "name": "N"}}],
            "committees": [{"name": "Comisia pentru Sănătate", "meetings": [{"id": "c1", "dates": ["2018-01-02"], "agenda": [{"ordinal": 1, "primary_references": [{"type": "bill", "prefix": "L", "number": "3", "year": 2018}, {"type": "code", "raw": "Codul civil"}]}], "roster": [{"speaker": speaker, "mode": "present"}]}]}],
        },
    }
    report = {"document_id": "mo://2014/II/1R", "content_sha": "r", "document_type": "report_facsimile", "metadata": {"issue": "1R", "year": 2014, "published": "2014-01-20"}, "body": {"report": {"title": "Raport", "slug": "raport-1"}, "headings": [{"level": 1, "text": "H"}]}}
    for name, d in (("a", doc), ("b", report)):
        (folder / f"{name}.json").write_text(json.dumps(d))
    (folder / "c.json").write_text("{broken")
    good, bad = grains.read_sidecars(spark, str(folder))
    assert bad.count() == 1
    return good


def test_documents(sidecars):
    got = {r.record_id: r for r in grains.documents(sidecars).collect()}
    d, r = got["mo://2018/II/7"], got["mo://2014/II/1R"]
    assert (d.chamber, d.session_date, d.published, d.title) == ("Senatul, Camera Deputaților", "2018-03-01", None, "MO 7/2018 · 2018-03-01")
    assert (d.agenda_count, d.speech_count, d.vote_count, d.interpellation_count, d.question_count, d.committee_count, d.report_count) == (1, 3, 2, 1, 1, 1, 0)
    assert (d.slug, d.url_path, r.title, r.slug, r.report_count) == ("2018-II-7", "/mo/2018/II/7", "Raport", "raport-1", 1)


def test_children(sidecars):
    item = grains.agenda_items(sidecars).first()
    assert (item.refs.bills, item.refs.laws, item.refs.types, item.speaker_person_ids) == (["PL-x:100/2018"], ["5/2010"], ["bill", "law"], ["ion-pop"])
    assert (item.vote_summary.total_votes, item.vote_summary.outcomes, item.url_path) == (2, ["deferred", "approved"], "/agenda/t-abc")
    speeches = grains.speeches(sidecars).orderBy("position_in_agenda").collect()
    assert [(s.record_id, s.position_in_agenda, s.is_substantive, s.position_in_document, s.url_path) for s in speeches] == [("s1", 1, True, 5, "/discurs/s-1"), ("s2", 2, False, None, None)]
    v1, v2 = grains.votes(sidecars).orderBy("record_id").collect()
    assert (v1.counts["for"], v1.counts.for_unanimous, v1.deferred, v1.proposed_by.is_government, v1.url_path) == (None, True, True, True, "/vot/k9")
    assert (v2.counts["for"], v2.counts.for_unanimous, v2.counts.total, v2.deferred, v2.proposed_by, v2.refs.bills) == (132, False, 139, False, None, ["PL-x:100/2018"])
    q = grains.questions(sidecars).first()
    assert (q.regdate, q.addressee.raw) == (None, "N")
    m = grains.committee_meetings(sidecars).first()
    assert (m.committee_id, m.meeting_date, m.agenda_items[0].primary_references, m.roster[0].status) == ("comisia-pentru-sănătate", "2018-01-02", ["L:3/2018", "Codul civil"], "present")
    assert grains.reports(sidecars).first().record_id == "mo://2014/II/1R"
    assert grains.interpellations(sidecars).first().response.text == "r"
    ids = {(r.grain, tuple(r.ids)) for r in grains.child_ids(grains.project(sidecars)).filter("document_id = 'mo://2018/II/7'").collect()}
    assert ("votes", ("v1", "v2")) in ids and ("questions", ("q1",)) in ids
    with pytest.raises(ValueError, match="unknown"):
        grains.project(sidecars, ["nope"])


def test_classifier_and_file_names(spark):
    rows = [
        ("x (STENOGRAMA) DEZBATERI PARLAMENTARE", "", "plenary_stenogram", 0.85, False),
        ("ȘEDINȚE COMUNE ALE CAMEREI DEPUTAȚILOR ȘI SENATULUI ( stenograma )", "", "plenary_joint_session", 0.95, False),
        ("LISTA ÎNTREBĂRILOR ADRESATE", "", "question_register", 0.95, False),
        ("SINTEZA LUCRĂRILOR COMISIEI (RAPOARTE DE ACTIVITATE)", "", "committee_synthesis", 0.9, True),
        ("anything", "c", "committee_synthesis", 1.0, False),
        ("anything", "R", "report_facsimile", 1.0, False),
        ("nothing", "", "other", 0.0, False),
    ]
    df = spark.createDataFrame([(t, s) for t, s, *_ in rows], "t string, s string")
    got = [(c.top_type, c.top_score, c.ambiguous) for (c,) in df.select(rules.classified(F.col("t"), F.col("s"))).collect()]
    assert got == [tuple(r[2:]) for r in rows]
    names = spark.createDataFrame([("2026-04-29_MO-PII-12c-2026.md",), ("2026-02-30_MO-PII-1-2026.pdf",), ("other.pdf",)], "n string")
    meta = [r.m for r in names.select(rules.file_meta(F.col("n")).alias("m")).collect()]
    assert (str(meta[0].published), meta[0].part, meta[0].issue, meta[0].year) == ("2026-04-29", "II", "12c", 2026) and meta[1:] == [None, None]
    assert spark.range(1).select(rules.issue_suffix(F.lit("358Bis"))).first()[0] == "Bis"


def test_topics(spark):
    titles = [("Proiect de lege privind bugetul de stat și învățământul", ["Educație", "Buget-finanțe"]), ("SĂNĂTATEA publică; Comisia pentru sănătate", ["Sănătate"]), ("Acorduri NATO și relații internaționale", ["Apărare", "Politică externă"]), ("Diverse", []), (None, [])]
    df = spark.createDataFrame([(t,) for t, _ in titles], "t string")
    assert [r.x for r in df.select(rules.topics(F.col("t")).alias("x")).collect()] == [x for _, x in titles]


def test_headers_and_votes(spark):
    head = "PARLAMENTUL\nSENATUL\nSESIUNEA A II-A (Legislatura a VIII-a)\nȘedința din ziua de 9 aprilie 2019"
    h = spark.range(1).select(rules.header_meta(F.lit(head)).alias("h")).first().h
    assert (h.chamber, h.session, str(h.session_date), h.legislature) == ("Senatul", "SESIUNEA A II-A", "2019-04-09", "VIII")
    long = F.concat(F.lit("ă" * 4990 + " "), F.lit("DEZBATERI PARLAMENTARE"), F.lit("(STENOGRAMA)"))  # beyond 10,000 bytes nothing counts
    assert spark.range(1).select(rules.classified(F.lit("x"), F.lit("")).alias("c"), rules.classified(long, F.lit("")).alias("d")).select("c.top_type", F.col("d.top_type").alias("x")).first() == ("other", "other")
    page = "**==> picture [10 x 20] intentionally omitted <==**\nText com-\nplet  \n  MONITORUL OFICIAL AL ROMÂNIEI, PARTEA a II-a\n 12 \n\n\n\nsfârșit"
    assert spark.range(1).select(rules.clean_markdown(F.lit(page)).alias("x")).first().x == "Text complet\nsfârșit\n"


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(text.fold(F.lit("Țăranu ŞTEFAN� é"))) == "Taranu STEFAN e"
    assert one(text.fold_aggressive(F.lit("V„c„roiu Bolca∫"))) == "Vacaroiu Bolcas"
    assert one(text.person_tokens(F.lit("Ion-Marcel I. Vela"))) == ["ion", "marcel", "vela"]
    peeled = {"Domnul deputat  Ion  Pop, PSD": "Ion Pop", "domnul Ion Pop, vicepreședinte": "Ion Pop", "Senatoare Ana Rus.:": "Ana Rus", "Dl. Prim-ministru Ion Pop": "Ion Pop", "Domnulescu Ion": "Domnulescu Ion", "doamna": "", "Ministrul Sănătății": "Sănătății"}
    for raw, want in peeled.items():
        assert one(text.peel(F.lit(raw))) == want
    digest = hashlib.sha256(b"2018|7|o1|s2").digest()[:6]
    want = base64.b32encode(digest).decode().rstrip("=").lower()
    assert one(text.short_id(F.lit("2018"), F.lit("7"), F.lit("o1"), F.lit("s2"))) == want
    assert one(text.slug(F.lit("Lege privind bugetul de stat pe anul 2018, nou"), F.lit("k9"))) == "lege-privind-bugetul-de-stat-pe-anul-2018-k9"
    assert one(text.slug(F.lit("!!"), F.lit("k9"))) == "k9"
    assert one(text.capped_distance(F.lit("abcdef"), F.lit("uvwxyz"), 2)) == 3


def test_spans_and_folds(spark):
    df = spark.createDataFrame([([(5, 9), (0, 6), (0, 3), (9, 12), (6, 8)],)], "s array<struct<start:bigint,end:bigint>>")
    assert [(x.start, x.end) for x in df.select(windows.greedy_spans(F.col("s")).alias("x")).first().x] == [(0, 6), (6, 8), (9, 12)]
    seq = spark.createDataFrame([([1, 2, 4, 3, 9, 1, 2],)], "o array<int>")
    assert seq.select(windows.consecutive(F.col("o"))).first()[0] == [1, 2, 3, 1, 2]
    assert windows.page_bounds(0, None) == (1, 20, 0) and windows.page_bounds(3, 99) == (3, 50, 100) and windows.page_bounds(None, 0) == (1, 1, 0)


def test_names_and_mandates(spark):
    probe = spark.createDataFrame([("Florian Nicolae",), ("Ion Popescu",), ("Maria",)], "raw string")
    names = spark.createDataFrame([("Florin Niculae", "a"), ("Ion Popescv", "b"), ("Ion Popescu", "c"), ("Mario", "d")], "name string, id string")
    assert [tuple(r) for r in joins.fuzzy_names(probe, names, "raw", "name", "id", text.person_tokens).collect()] == [("Ion Popescu", "b")]
    m = spark.createDataFrame([([(2000, 2004)],), ([(None, 2010)],), ([(None, None)],), ([],), (None,)], "m array<struct<`from`:int,`to`:int>>")
    assert [r[0] for r in m.select(joins.active_mandate(F.col("m"), F.lit(2008))).collect()] == [False, True, False, True, True]


def test_search_routes(spark):
    rows = spark.createDataFrame([("a", "red fox", "2020-01-01", [1.0, 0.0], True), ("b", "red red fox dog", "2021-01-01", [0.0, 1.0], True), ("c", "cat", "2022-01-01", None, True), ("d", "red", "2023-01-01", [1.0, 0.1], False)], "record_id string, text string, session_date string, embedding array<double>, is_substantive boolean")
    ids = lambda df: [r.record_id for r in df.collect()]
    assert ids(search.search_speeches(rows, "red", {"text": 1.0})) == ["b", "a"]
    assert ids(search.search_speeches(rows, None, {"text": 1.0})) == ["c", "b", "a"]
    assert ids(search.search_speeches(rows, "x", {"text": 1.0}, rank_fusion="knn", query_vector=[1.0, 0.0])) == ["a", "b"]
    assert ids(search.search_speeches(rows, "x", {"text": 1.0}, rank_fusion="knn")) == []
    assert set(ids(search.search_speeches(rows, "cat", {"text": 1.0}, rank_fusion="rrf", query_vector=[0.0, 1.0]))) == {"a", "b", "c"}
    legs = [spark.createDataFrame([(x, -float(i)) for i, x in enumerate(o)], "id string, score double") for o in ("ABC", "BDA")]
    assert [r.id for r in search.fused(legs, "id").collect()] == ["B", "A", "D", "C"]


def test_versions_generations_and_rosters(spark, tmp_path):
    v = spark.createDataFrame([("a", "1.9"), ("a", "1.10"), ("b", "2.0")], "k string, version string")
    assert sorted(tuple(r) for r in lifecycle.latest_version(v, ["k"], "version").collect()) == [("a", "1.10"), ("b", "2.0")]
    g = lifecycle.Generations(spark, str(tmp_path))
    g.write("votes", "v1", v)
    g.write("votes", "v2", v.limit(1))
    g.swap("votes", "v2")
    assert g.listed("votes") == ["v1", "v2"] and spark.table("votes").count() == 1
    g.drop("votes", "v1")
    assert g.listed("votes") == ["v2"]
    names = spark.createDataFrame([("x.embedding.bge.v1_10.json", '{"r1": {"_meta": {"source_sidecar_content_sha": "s"}}, "r2": {"_meta": {"source_sidecar_content_sha": "old"}}}'), ("x.embedding.bge.v1_9.json", '{"r3": {}}'), ("readme.txt", "")], "file string, json string")
    kept = parsers.enrichments(names, spark.createDataFrame([("x", "s")], "base string, content_sha string")).collect()
    assert [(r.record_id, r.version) for r in kept] == [("r1", "1.10")]
    f = spark.range(1).select(parsers.frontmatter(F.lit('---\nissue: "7"\nyear: 2018\n---\nbody\n')).alias("f")).first().f
    assert (f.fields, f.body) == ({"issue": "7", "year": "2018"}, "body\n")
    assert sorted(spark.createDataFrame([(["a", "b"], ["b", "c"])], "a array<string>, b array<string>").select(sets.appended(F.col("a"), F.col("b"))).first()[0]) == ["a", "b", "c"]
    days = spark.createDataFrame([("#vote-1", "votes"), ("mo://x", "documents"), ("mo#agenda-1#act-2", "speeches"), ("mo#agenda-1", "agenda_items")], "r string, g string")
    assert all(r.g == r.x for r in days.select("g", lifecycle.grain_of(F.col("r")).alias("x")).collect())


def test_named_queries(spark, sidecars):
    from lectern.plans import named

    people = spark.createDataFrame([("ion-pop", "Ion Pop", "Ion Pop", ["I. Pop"], None), ("ana-rus", "Ana Rus", "Ana Rus", [], None)], "id string, canonical_name string, diacritic_form string, aliases array<string>, wikidata_qid string")
    store = named.Store(grains.project(sidecars) | {"persons": people})
    hits = named.run(store, "search_speeches", {"q": "colegi"})
    assert [r.record_id for r in hits.hits.collect()] == ["s1"] and hits.total == 1
    assert [r.record_id for r in named.run(store, "search_speeches", {"is_substantive": False}).hits.collect()] == ["s1", "s2"]
    children = named.run(store, "list_document_children", {"document_id": "mo://2018/II/7"})
    assert children.total == 8 and children.hits.first().record_id == "s1"
    assert named.run(store, "get_document", {"document_id": "mo://2014/II/1R"}).first().title == "Raport"
    assert named.run(store, "list_documents_by_date", {"date": "2018-03-01"}).hits.count() == 1
    page = named.run(store, "person_page", {"person_slug": "ion-pop"})
    assert page.total == 1 and page.aggregations["party"].first().key == "X" and page.aggregations["person"].count() == 1
    assert [r.id for r in named.run(store, "search_persons", {"q": "pop ion"}).hits.collect()] == ["ion-pop"]
    assert named.run(store, "search_persons", {"q": " "}).total == 0
    assert named.run(store, "list_committee_meetings", {"committee_id": "comisia-pentru-sănătate"}).total == 1
    assert named.run(store, "get_report", {"record_id": "mo://2014/II/1R"}).count() == 1
    by_party = named.run(store, "agg_speeches_by_party_year").aggregations
    assert by_party["party_year"].first()["count"] == 1 and by_party["speakers"].first()[0] == 1
    for name in ("get_agenda_item", "get_speech"):
        assert named.run(store, name, {"record_id": "none"}).count() == 0
    with pytest.raises(KeyError):
        named.run(store, "nope")


def test_files_are_collected_once(spark, tmp_path):
    for name in ("b.pdf", "a.pdf", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    paths = [f"file://{tmp_path}", f"file://{tmp_path}/a.pdf"]
    assert [r.path.rsplit("/", 1)[1] for r in parsers.collected(spark, paths).collect()] == ["a.pdf", "b.pdf"]
    assert [r.path.rsplit("/", 1)[1] for r in parsers.collected(spark, paths, reverse=True).collect()] == ["b.pdf", "a.pdf"]


def test_backfills(spark):
    from lectern.plans import backfills

    aliases = spark.createDataFrame([("Ministerul Sănătății", "ms", 0), ("Ministerul Educației Naționale", "men", 1), ("Curtea de Conturi", "cc", 2)], "alias string, id string, seq int")
    raws = ["Ministerul Sănătății", "MINISTERUL SĂNĂTĂȚII", "ministerul sanatatii", "Conturi de Curtea", "Ministerul Sănătății Publice", "Naționale Educației Ministerul", "x"]
    probe = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = {r.raw: (r.match, r.via) for r in backfills.ministries(probe, aliases).collect()}
    assert [got[r] for r in raws] == [("ms", "exact"), ("ms", "case"), ("ms", "diacritic"), ("cc", "token_set"), ("ms", "prefix"), ("men", "token_set"), (None, None)]
    assert {r.raw: r.match for r in backfills.institutions(probe, aliases).collect()}["Ministerul Sănătății Publice"] is None
    registry = spark.createDataFrame([("a1", "Ion Pop", [], [(1990, 2000)]), ("a2", "Ion Pop", ["Popică"], [(2004, 2012)]), ("b", "Maria-Elena Tudor", [], [])], "id string, canonical_name string, aliases array<string>, mandates array<struct<`from`:int,`to`:int>>")
    asked = [("Domnul deputat Ion Pop, PSD", 1995), ("GUVERNUL", 1995), ("ION POP", 1995), ("Ion Pop", 2008), ("Ion Pop", 2002), ("Popică", None), ("Tudor Maria Elena", 2001), ("Maria Elena Tudoro", 2001), ("Din sală", 2001)]
    people = spark.createDataFrame(asked, "raw string, year int")
    got = {(r.raw, r.year): (r.match, r.via) for r in backfills.persons(people, registry).collect()}
    assert [got[a] for a in asked] == [("a1", "exact"), (None, None), ("a1", "case"), ("a2", "exact"), (None, None), ("a2", "exact"), ("b", "token_set"), ("b", "fuzzy"), (None, None)]
    rows = spark.createDataFrame([("x", None), (None, "y"), ("x", "x"), ("x", "y"), (None, None)], "old string, new string")
    for force, want in ((False, ["kept", "filled", "same", "mismatch", "unmatched"]), (True, ["cleared", "filled", "same", "replaced", "unmatched"])):
        value, action = backfills.overwritten(F.col("old"), F.col("new"), force)
        assert [r.a for r in rows.select(action.alias("a"), value.alias("v")).collect()] == want
    new = backfills.stubs(spark.createDataFrame([("Ion Pop", 2001), ("ION POP", 2003), ("Ion Pop", 2002), ("Ana Rus", 2001)], "n string, y int"), "n", "y", spark.createDataFrame([("ana-rus",), ("ana-rus-2",), ("ion",)], "id string"))
    assert sorted(tuple(r) for r in new.collect()) == [("ana-rus-3", "Ana Rus", 1, 2001, 2001), ("ion-pop", "Ion Pop", 3, 2001, 2003)]


def test_meetings_do_not_carry_their_committee(spark):
    """One row a meeting with the committee's own fields; committees and documents are not copied to every meeting, and parts are gathered as they are."""
    from lectern import queries
    from lectern import grain_queries  # queries come first

    sf = "/root/testdata/sf0.001"
    plan = grains.committee_meetings(grain_queries.syntheses(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1
    assert "collect_list(struct(p_partkey" in plan
    meeting = "struct<id:string,dates:array<string>>"
    rows = spark.createDataFrame([("d1", 1), ("d2", 2), ("d3", 3)], "document_id string, k int")
    body = F.when(F.col("k") == 1, F.lit(None)).when(F.col("k") == 2, F.array(F.lit(None))).otherwise(F.array(F.struct(F.lit("c1").alias("id"), F.array(F.struct(F.lit("m1").alias("id"), F.array(F.lit("2020-01-05")).alias("dates")), F.struct(F.lit("").alias("id"), F.array(F.lit("2020-01-06")).alias("dates"))).cast(f"array<{meeting}>").alias("meetings"))))
    docs = rows.select("document_id", body.cast(f"array<struct<id:string,meetings:array<{meeting}>>>").alias("c"))
    full = docs.select(*(grain_queries.shaped(f.dataType, {"document_id": F.col("document_id")}.get(f.name)).alias(f.name) if f.name != "body" else grain_queries.shaped(f.dataType, {"committees": [{"id": F.get("c", F.lit(0))["id"], "meetings": [{"id": F.get(F.get("c", F.lit(0))["meetings"], F.lit(i))["id"]} for i in range(2)]}]}).alias("body") for f in grain_queries.schema().fields))
    assert [(r.record_id, r.document_id, r.committee_id) for r in grains.committee_meetings(full).collect()] == [("m1", "d3", "c1")]
    assert queries.QUERIES["p8_committee_meetings"](spark, sf).count() == spark.read.parquet(f"{sf}/part.parquet").count()


def test_fuzzy_names_meet_by_the_token_that_differs(spark):
    """Names that share all tokens but one form no pairs; every edit in any token is found, as by comparing all pairs."""
    from itertools import product

    names = ["om ab popescu", "om abc popescu", "om abd popescu", "om ac popescu", "om b popescu", "oms ab popescu", "om ab popesc", "om popescu", "om acb popescu", "ab om popescu", "om zz popescu", "a", "om xyz ion"]
    probe = spark.createDataFrame([(n,) for n in names], "raw string")
    index = spark.createDataFrame([(n, f"p{i}") for i, n in enumerate(names)], "name string, id string")
    own = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda x: x != ""))

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    want = set()
    for (i, a), (_, b) in product(enumerate(names), enumerate(names)):
        p, q = sorted(set(b.split())), sorted(set(a.split()))
        if len(p) == len(q) >= 2 and sum(map(edits, p, q)) == 1:
            want.add((b, f"p{i}"))
    assert want and {tuple(r) for r in joins.fuzzy_names(probe, index, "raw", "name", "id", own).collect()} == want
    # 40,000 names that share two tokens: pairs by a shared token would be 1.6e9
    many = spark.range(40_000).select(F.concat(F.lit("Om "), F.translate(F.lpad(F.col("id").cast("string"), 5, "0"), "0123456789", "abcdefghij"), F.lit(" Popescu")).alias("name"), F.col("id").cast("string").alias("id"))
    found = joins.fuzzy_names(many.select(F.col("name").alias("raw")), many, "raw", "name", "id", own)
    # each of five letters has nine others, three in the first place
    assert found.count() == 40_000 * (4 * 9 + 3)


def test_class_of_a_text_cut_within_a_character(spark):
    texts = {1: "DEZBATERI PARLAMENTARE" + "a" * (9_999 - 22) + "ă" * 50, 2: "x" * 9_999 + "€", 3: "x" * 9_998 + "😀", 4: "x" * 9_978 + "DEZBATERI PARLAMENTAREă", 5: None}
    rows = spark.createDataFrame(list(texts.items()), "k int, t string").select("k", rules.classified(F.col("t"), F.lit(""))["top_type"].alias("top"))
    assert {r.k: r.top for r in rows.collect()} == {1: "plenary_stenogram", 2: "other", 3: "other", 4: "plenary_stenogram", 5: "other"}


def test_benchmark_places_do_not_hang_on_the_order_of_rows(spark, tmp_path):
    from lectern import queries

    values = [0.1, 0.2, 0.3]
    rows = [(0, v) for v in values] + [(1, v) for v in reversed(values)]
    spark.createDataFrame(rows, "user_id long, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    assert (0.1 + 0.2) + 0.3 > (0.3 + 0.2) + 0.1  # as doubles
    got = {r.model: r.place for r in queries.QUERIES["a9_benchmark"](spark, str(tmp_path)).collect()}
    assert got == {0: 1, 1: 2}


def test_benchmark_costs_of_any_size_and_length(spark, tmp_path):
    import duckdb

    from lectern import queries

    inf, nan = float("inf"), float("nan")
    rows = [(1, 2e-10), (2, 1e-10), (3, 0.1234567891234), (4, 0.1234567891233), (5, 1e-320), (6, 0.0), (7, -0.0), (None, 7.0), (8, 7.0), (9, None), (10, None), (10, 5.0)]
    rows += [(None, None), (8, None), (11, nan), (12, inf), (13, -inf), (14, 1e20), (15, 3e-5), (15, 1e8), (16, 1e8), (16, 2e-5), (17, 1e308), (17, 1e308), (18, 12345678.123456789)]
    spark.createDataFrame(rows, "user_id long, value double").repartition(3).write.parquet(f"{tmp_path}/a/events.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/a/events.parquet/*.parquet'")
    got = dict(map(tuple, queries.QUERIES["a9_benchmark"](spark, f"{tmp_path}/a").collect()))
    assert got == dict(con.sql(queries.ORACLE_SQL["a9_benchmark"]).fetchall()) and got[None] > got[8]
    # sums in which doubles lose the small value, or keep it, by their order
    orders = [[1e20, -1e20, 3e-12], [3e-12, 1e20, -1e20], [-1e20, 3e-12, 1e20]]
    rows = [(i, v) for i, values in enumerate(orders) for v in values] + [(3, v) for v in (1e20, -1e20, 2e-12)]
    spark.createDataFrame(rows, "user_id long, value double").write.parquet(f"{tmp_path}/b/events.parquet")
    got = dict(map(tuple, queries.QUERIES["a9_benchmark"](spark, f"{tmp_path}/b").collect()))
    assert got == {3: 1, 0: 2, 1: 3, 2: 4}
