"""Playback checks and registry merges, on rows of our own."""

from __future__ import annotations

from lectern.plans import audit, registry

BODY = "## **Domnul Ion Pop:**\nBună ziua tuturor colegilor.\n_(Aplauze.)_\nContinui aici.\n## **Doamna Ana Rus** – _ministru_ **:**\nSupun votului legea. Nr. 12A\n## **S E N A T U L**\n"


def spot(s):
    return BODY.index(s)


def test_speeches(spark):
    rows = [
        ("ok", "speech", 0, spot("_(Apl"), "Domnul Ion Pop", "Ion Pop", "Bună ziua tuturor"), ("ev", "narrator", spot("_(Apl"), spot("Continui"), None, None, ""), ("cont", "speech", spot("Continui"), spot("## **Doamna"), "x", "Ion Pop", "Continui  aici."),
        ("who", "speech", spot("## **Doamna"), spot("## **S E"), "Dan Voicu", "Dan Voicu", "Supun votului legea."), ("where", "speech", spot("Supun"), spot("## **S E"), "Ana Rus", "Ana Rus", "Alt text cu totul"), ("sec", "speech", spot("## **S E"), len(BODY), "Ana", "Ana", ""),
        ("far", "speech", 9999, None, "a", "a", ""), ("none", "speech", None, None, "a", "a", ""), ("chair", "speech", spot("votului"), spot("legea"), "<chair narration>", None, "alta"),
    ]
    df = spark.createDataFrame([("d", "p", *r) for r in rows], "document_id string, parent string, record_id string, kind string, position int, span_end int, speaker_raw string, speaker_name string, text string")
    bodies = spark.createDataFrame([("d", BODY)], "document_id string, body string")
    got = sorted((r.record_id, r.kind) for r in audit.speeches(df, bodies).collect())
    assert got == sorted([("who", "speaker_mismatch"), ("where", "invented_or_misplaced_speech"), ("where", "span_text_mismatch"), ("far", "position_oor_sidecar"), ("none", "span_missing")])
    assert audit.speeches(df.limit(0), bodies).count() == 0


def test_other_records(spark):
    bodies = spark.createDataFrame([("d", BODY)], "document_id string, body string")
    q = spark.createDataFrame([("d", "a", 0, "Domnul Ion Pop"), ("d", "b", spot("## **Doamna"), "Ion Voicescu"), ("d", "c", -1, "x"), ("d", "e", 0, "Pop Marin")], "document_id string, record_id string, position int, speaker_name string")
    assert sorted((r.record_id, r.kind) for r in audit.questioners(q, bodies).collect()) == [("b", "interpellation_questioner_missing"), ("c", "position_oor_sidecar")]
    n = spark.createDataFrame([("d", "a", 0, len(BODY), "12A"), ("d", "b", 0, 20, "12A"), ("d", "c", 0, 20, None)], "document_id string, record_id string, position int, span_end int, regnum string")
    assert [(r.record_id, r.kind) for r in audit.questions(n, bodies).collect()] == [("b", "question_regnum_missing")]
    v = spark.createDataFrame([("d", "a", spot("Supun")), ("d", "b", len(BODY) - 3)], "document_id string, record_id string, position int")
    assert [(r.record_id, r.kind) for r in audit.votes(v, bodies).collect()] == [("b", "vote_open_missing")]
    t = spark.createDataFrame([("d", "a", "Bună  ziua TUTUROR<br>colegilor 12"), ("d", "b", "Cu totul altceva"), ("d", "c", " ")], "document_id string, record_id string, title string")
    assert [r.record_id for r in audit.agenda_titles(t, bodies).collect()] == ["b"]
    heads = spark.createDataFrame([("d", 10, "Ion Pop"), ("d", 400, "Ana Rus"), ("d", 900, "Dan Voicu"), ("d", 950, "SUMAR"), ("d", 1500, "Maria Ene")], "document_id string, position int, name string")
    starts = spark.createDataFrame([("d", 110), ("d", 2000)], "document_id string, position int")
    out = spark.createDataFrame([("d", 850, 901)], "document_id string, start int, end int")
    assert sorted(r.detail for r in audit.dropped_turns(heads, starts, out).collect()) == ["Ana Rus", "Maria Ene"]
    assert [audit.occurrences(v.withColumn("speaker_raw", audit.F.lit("x")), bodies, "x", 5).count()] == [2]


def test_served_and_idempotent(spark):
    hits = spark.createDataFrame([("d", "speeches", "a", 5, 1), ("d", "speeches", "b", 3, 2), ("d", "votes", "c", None, 3), ("d", "votes", "e", 99, 4), ("d", "votes", "e", 7, 5)], "document_id string, grain string, record_id string, position int, seq int")
    made = spark.createDataFrame([("d", "a"), ("d", "b"), ("d", "c"), ("d", "z")], "document_id string, record_id string")
    docs = spark.createDataFrame([("d", 50, {"speeches": 2, "votes": 2, "questions": 1})], "document_id string, body_chars int, counts map<string,int>")
    got = sorted((r.kind, r.record_id or r.detail) for r in audit.served(hits, made, docs).collect())
    assert got == sorted([("dup_record_id", "e"), ("missing_position", "c"), ("position_oor", "e"), ("non_monotonic", "b"), ("count_mismatch", "votes:2:3"), ("count_mismatch", "questions:1:0"), ("missing_in_es", "z"), ("orphan_in_es", "e")])
    assert audit.idempotent(made, made).count() == 0 and audit.idempotent(made, made.limit(3)).count() == 1


def test_registry_merges(spark):
    people = spark.createDataFrame([("ion-pop", "Ion Pop", None, ["Pop Ion"], None, None), ("ana-rus", "Ana Rus", None, [], "Q1", "1960-01-01")], "id string, canonical_name string, diacritic_form string, aliases array<string>, wikidata_qid string, birth_date string")
    rows = spark.createDataFrame([("POP Ion", "2008", "deputat", "PSD", "2008", "2012"), ("Dan Voicu", "2012", "deputat", "PNL", "2012", "2016"), ("Voicu Dan", "2012", "deputat", "PNL", "2012", "2016"), ("Dan Voicu", "2008", "senator", "PNL", "2008", "2012"), ("", "x", "x", "x", None, None)], "name string, legislature string, role string, party string, `from` string, `to` string")
    new, counts = registry.merged_mandates(people, rows)
    entry = new.first()
    assert (entry.id, [m["from"] for m in entry.mandates], tuple(counts.first())) == ("dan-voicu", ["2008", "2012"], (1, 2, 1))
    outside = spark.createDataFrame([("Q1", "Ana Rus", None, None), ("Q2", "Ion Pop", None, "1970-05-05T00"), ("Q3", "Ion Popp", "Pop  Ion", None), ("Q4", "Maria Ene", None, "1980-01-01"), ("Q5", "Q5", None, None), (None, "x", None, None), ("Q6", "Maria Ene", None, None)], "qid string, label_en string, label_ro string, birth_date string")
    merged = registry.merged_outside(people, outside)
    assert {r.qid: (r.action, r.id) for r in merged.collect() if r.qid} == {"Q1": ("skip", "ana-rus"), "Q2": ("augment", "ion-pop"), "Q3": ("skip", "ion-pop"), "Q4": ("add", "maria-ene"), "Q5": ("skip", None), "Q6": ("skip", None)}
    final = {r.id: (r.wikidata_qid, r.birth_date) for r in registry.augmented(people, merged).collect()}
    assert final == {"ion-pop": ("Q2", "1970-05-05"), "ana-rus": ("Q1", "1960-01-01"), "maria-ene": ("Q4", "1980-01-01")}


def test_candidates(spark):
    people = spark.createDataFrame([("a", "1960-05-05"), ("b", None), ("c", None), ("d", "1950")], "id string, birth_date string")
    found = spark.createDataFrame([("a", "Q1", "Romanian politician and senator", "1960-05-05"), ("a", "Q2", "footballer", "1960-01-01"), ("b", "Q3", "politician", None), ("c", "Q4", "senator", None), ("c", "Q5", "senator", None), ("d", "Q6", "disambiguation page", None)], "id string, qid string, description string, birth_date string")
    got = {r.id: (r.qid, r.score, r.matched_via, r.alternates, r.status) for r in registry.suggestions(people, found).collect()}
    assert got == {"a": ("Q1", 30, "exact_name+birth", 1, "ok"), "b": ("Q3", 4, "exact_name", 0, "ok"), "c": ("Q4", 6, "exact_name", 1, "ambiguous"), "d": (None, None, None, None, "no_match")}
