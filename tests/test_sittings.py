"""Agendas, sittings, interpellations and reports, on texts of our own."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import agenda, facsimiles, interpellations, sittings, speakers

SUMMARY = """SUMAR
|Nr.<br>1. Aprobarea ordinii de zi ....... 3<br>2. Proiectul de lege privind drumurile|4-6|
|3.|Declarații politice ale deputaților|7; 9|
|---|---|---|
4. Supunerea la votul final a unor proiecte de lege ........ 12
_Ședința a început la ora 9.05_
## **Domnul Ion Pop:**
1. Ordinea de zi. Supun votului ordinea de zi. 120 de voturi pentru, 3 împotrivă. A fost aprobată.
Mulțumesc tuturor.
## **Doamna Ana Rus** – _ministru_ **:**
2. Despre drumuri vorbim acum.
_(Aplauze.)_
Continuăm discuția. Aceasta rămâne pentru votul final de marți.
"""


def test_summary_and_spans():
    a, b = agenda.summary_span(SUMMARY)
    got = agenda.summary_of(SUMMARY[a:b])
    assert [i["ordinal"] for i in got] == [1, 2, 3, 4]
    assert got[0] == {"ordinal": 1, "title": "Aprobarea ordinii de zi", "pages": [3]}
    assert got[2]["pages"] == [7, 9] and got[3]["title"].startswith("Supunerea la votul final")
    assert agenda.pages_of("3-5; 12") == [3, 4, 5, 12] and agenda.pages_of("0; 9-300") == []
    assert agenda.titled("Primul titlu 12; 14 3. Al treilea titlu") == ("Primul titlu", [12, 14])
    assert agenda.titled("Titlu --- --- rest")[0] == "Titlu"
    text = "intro\n1. a\n2. b\n9. stray\n3. c\n"
    spans = agenda.item_spans(text, 0, len(text), [1, 2, 3, 4])
    assert spans == [(0, text.index("2. b")), (text.index("2. b"), text.index("3. c")), (text.index("3. c"), len(text)), None]
    assert agenda.item_spans("2. x\n1. y\n", 0, 10, [1, 2]) == [(0, 10), None]
    assert agenda.item_spans("", 0, 0, []) == []


def test_items_and_activities():
    items = agenda.items_of(SUMMARY)
    assert [i["ordinal"] for i in items] == [1, 2, 3, 4] and items[2]["start"] is None and items[2]["activities"] == []
    first, second = items[0]["activities"], items[1]["activities"]
    assert [x["type"] for x in first] == ["speech", "vote", "speech", "speech"] and second[0]["type"] == "speech"
    kinds = [x["type"] for x in agenda.activities_of(SUMMARY[SUMMARY.index("## **Doamna") :])]
    assert kinds == ["speech", "narrator", "deferral"]
    whole = agenda.activities_of(SUMMARY)
    assert all(x["end"] <= y["start"] for x, y in zip(whole, whole[1:], strict=False))
    assert {x["type"] for x in whole} >= {"speech", "vote", "narrator", "deferral"}
    vote = next(x for x in whole if x["type"] == "vote")
    assert (vote["outcome"], vote["for"], vote["against"], vote["motion_type"]) == ("approved", 120, 3, "agenda_approval")
    heads = agenda.items_of("## **1. Primul punct**\n## **Ion Pop**\nSalut\n## 2. Al doilea\n")
    assert [(i["ordinal"], i["title"]) for i in heads] == [(1, "Primul punct"), (2, "Al doilea")]
    alone = agenda.items_of("## **Ion Pop**\nUn discurs.")
    assert [(i["title"], len(i["activities"])) for i in alone] == [("Ședința", 1)] and agenda.items_of("nimic") == [] == agenda.items_of("")


def test_item_attributes(spark):
    rows = [("a fost respinsă", "x", "respins", None, None), ("", "Informare privind apa", "informare", None, None), ("rămâne pentru votul final și a fost adoptată", "x", "votul_final_deferred", None, None), ("", "Ora Guvernului, la solicitarea Grupului parlamentar al USR și PNL cu tema", None, "USR și PNL", None), ("", "Reexaminare la cererea Președintelui României", None, None, "presidential_request"), ("", "Reexaminare", None, None, "parliamentary_majority"), (None, None, None, None, None)]
    df = spark.createDataFrame([r[:2] for r in rows], "b string, t string")
    got = [tuple(r) for r in df.select(agenda.outcome(F.col("b"), F.col("t")), agenda.requested_by(F.col("t")), agenda.reexamination(F.col("t"))).collect()]
    assert got == [r[2:] for r in rows]
    frame = spark.createDataFrame([(SUMMARY,), (None,), ("## **Ion Pop**\nUn discurs.",)], "t string")
    assert [len(r.x) for r in frame.select(agenda.items(F.col("t")).alias("x")).collect()] == [4, 0, 1]
    assert frame.select(agenda.activities(F.col("t")).alias("x")).first().x[0].name == "Ion Pop"


def test_speakers():
    assert speakers.speaker_of("Domnul deputat Ion  Pop, lider PSD") == {"raw": "Domnul deputat Ion  Pop, lider PSD", "name": "Ion Pop", "title": "deputat", "role": "lider PSD", "party_group": None}
    assert (speakers.speaker_of("Doamna senatorul Ana Rus")["title"], speakers.speaker_of("Ana Rus")["name"], speakers.speaker_of("")["name"]) == ("senator", "Ana Rus", None)
    assert speakers.turn_speaker("Domnul Ion Pop (din sală) :", " ministru ") == ({"raw": "Domnul Ion Pop", "name": "Ion Pop", "title": None, "role": "ministru", "party_group": None}, "from_floor")
    assert speakers.questioner_of("Ion Pop, deputat PSD, Cluj") == {"raw": "Ion Pop, deputat PSD, Cluj", "name": "Ion Pop", "title": "deputat", "role": None, "party_group": "PSD"}
    assert speakers.questioner_of("Ion Pop")["name"] is None


SITTING = """Anul 5 (IV) — Nr. 12
## **SENATUL**
SESIUNEA a II-a
(Legislatura a VI-a)
_Ședința a început la ora 9.05._
_Lucrările ședinței au fost conduse, în prima parte, de domnul senator Ion Pop, președintele Senatului, asistat de doamna Ana Rus, secretar al Senatului.

În cea de-a doua parte, la ora 11.30, de domnul senator Dan Voicu._
## **Domnul Ion Pop:**
Din totalul de 136 de senatori, și-au înregistrat prezența 70. Ne aflăm în format mixt de prezență.
Declar închisă ședința. Ședința s-a încheiat la ora 13,40."""


def test_sitting_facts(spark):
    df = spark.createDataFrame([(SITTING, 2021), ("nimic", 2001), (None, None), ("Suspend ședința pentru lipsa cvorumului. Deschiderea legislaturii. Din totalul de 100 de deputați, prezența 49", 2021), ("ȘEDINȚE COMUNE ALE CAMEREI DEPUTAȚILOR ȘI SENATULUI", 2021)], "t string, y int")
    a, b, c, d, e = (r.f for r in df.select(sittings.facts(F.col("t"), F.col("y")).alias("f")).collect())
    assert (a.opened_at, a.closed_at, tuple(a.attendance), a.quorum_met, a.format, a.outcome) == ("09:05", "13:40", (70, 136), True, "mixed", "completed")
    assert [(s.chair.name, s.segment_label, s.started_at) for s in a.chair_segments] == [("Ion Pop", "prima parte", None), ("Dan Voicu", "a doua parte", "11:30")]
    assert [x.name for x in a.chair_segments[0].secretaries] == ["Ana Rus"] and a.chair_segments[0].chair.title == "senator"
    assert (b.format, b.outcome, b.quorum_met, b.chair_segments) == ("in_person", None, None, []) and c.opened_at is None
    assert (d.outcome, d.special_procedure, d.quorum_met) == ("suspended_no_quorum", "deschiderea_legislaturii", False) and e.chambers_present == ["Camera Deputaților", "Senatul"]
    names = [x["reason"].split(".")[1] for x in sittings.recurring_of(SITTING)]
    assert names == ["year_issue_banner", "chamber_heading", "session_label", "legislature_paren"]
    assert [len(r.x) for r in df.select(sittings.recurring(F.col("t")).alias("x")).collect()] == [4, 0, 0, 0, 0]


BLOCK = """Vorbim despre altele.
Trecem la prezentarea interpelărilor noi.
## **Domnul Ion Pop:**
Stimate colege,
Interpelarea este adresată Ministerului Sănătății din România.
Obiectul interpelării: starea spitalelor din județ
Vă rog să ne spuneți câte spitale noi se construiesc anul acesta în țară. Nr. 15A
Aștept răspunsul dumneavoastră.
## **Doamna Ana Rus** _– secretar de stat în Ministerul Sănătății_ **:**
Mulțumesc, domnule președinte.
Se construiesc trei spitale noi, iar alte două sunt în plan.
## **Doamna Maria Ene:**
Voi citi declarația politică cu titlul „Despre noi înșine și alții”.
## **EDITOR: PARLAMENTUL ROMÂNIEI:**
text
## **Domnul Șef Mare:**
Trecem mai departe la următorul punct.
"""


def test_interpellations(spark):
    got = interpellations.interpellations_of(BLOCK, ["Șef  Mare"])
    assert [(q["questioner"]["name"], q["genre"], q["addressed_to"], q["interpellation_number"], q["topic"], q["confidence"]) for q in got] == [("Ion Pop", "interpelare", "Ministerul Sănătății din România", "15A", "starea spitalelor din județ", 0.9)]
    assert got[0]["question_text"].startswith("Vă rog") and got[0]["question_text"].endswith("Nr. 15A") and got[0]["response"]["text"].startswith("Se construiesc") and got[0]["response"]["speaker"]["role"].startswith("secretar de stat")
    assert BLOCK[got[0]["start"] :].startswith("## **Domnul Ion Pop") and interpellations.interpellations_of("fără") == []
    assert interpellations.addressee_of("Întrebarea adresată domnului Prim-ministru Ionescu") == "Prim-ministrul"
    assert interpellations.addressee_of("adresată ministrului de interne, privind") == "Ministerul De interne"
    assert interpellations.addressee_of("adresată doamnei Ana Rus, șefa") == "Ana Rus" and interpellations.addressee_of("nimic") is None
    assert interpellations.topic_of("Bună ziua!\n„Drumul spre munte”") == "Drumul spre munte" and interpellations.topic_of("Mulțumesc.\nO linie cu sens.") == "O linie cu sens."
    df = spark.createDataFrame([(BLOCK, ["Șef Mare"]), (None, None), ("x", [])], "t string, c array<string>")
    rows = df.select(F.size(interpellations.interpellations(F.col("t"), F.col("c"))).alias("n"), interpellations.block_offset(F.col("t")).alias("o")).collect()
    assert [tuple(r) for r in rows] == [(1, BLOCK.index("Trecem la")), (0, None), (0, None)]


def test_reports(spark):
    body = "## **CAMERA DEPUTAȚILOR**\n## **Ședința din ziua de 9 aprilie 2019**\n(RAPOARTE DE ACTIVITATE)\n|1. Raport privind activitatea desfășurată de Curtea de Conturi în anul 2018......3|\n# **Capitolul I**\n## Venituri\ntext"
    rows = [(body, "2019-04-10", "Senatul"), ("Raportul Băncii Naționale privind inflația din 3 martie 2015", "2015-05-05", "Camera Deputaților"), ("nimic", "x", None), (None, None, None), ("## **RAPORT de activitate al Avocatului Poporului pentru anul 2011**\n în perioada 2009 - 2010 ȘEDINȚE COMUNE ALE CAMEREI DEPUTAȚILOR ȘI SENATULUI", None, None)]
    df = spark.createDataFrame(rows, "b string, d string, c string")
    a, b, c, d, e = (r.r for r in df.select(facsimiles.report(F.col("b"), F.col("d"), F.col("c")).alias("r")).collect())
    assert (a.title, a.issuing_body, tuple(a.reporting_period), a.received_at.session_date, a.received_at.session_kind, a.confidence) == ("Raport privind activitatea desfășurată de Curtea de Conturi în anul 2018", "Curtea de Conturi", ("2018-01-01", "2018-12-31"), "2019-04-09", "senat", 0.95)
    assert [(h.level, h.text, h.line) for h in a.headings] == [(1, "Capitolul I", 5), (2, "Venituri", 6)]
    assert (b.issuing_body, b.reporting_period.start, b.received_at.session_kind, b.received_at.session_date) == ("Băncii Naționale", "2015-01-01", "camera", "2015-05-05")
    assert (c.title, c.confidence, c.received_at.session_date, d.title) == (None, 0.6, None, None)
    assert (e.issuing_body, e.reporting_period.end, e.received_at.session_kind) == ("Avocatului Poporului", "2011-12-31", "joint")
