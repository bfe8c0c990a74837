"""Extraction with offsets, on texts of our own."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import citations, extract

TALK = """## **Domnul Ion Pop:**
Supun votului ordinea de zi. Vă rog! 1.132 de voturi pentru, 5 voturi împotrivă, 2 abțineri. Cu majoritate de voturi, a fost aprobată.
Supun votului proiectul prin vot electronic. Rămâne pentru votul final.
**Doamna Ana Rus** – _ministru_ **:**
Trecem la vot. Nu avem cvorum.
## **Domnul Dan Voicu**
Să înceapă votul! Mulțumesc."""


def test_citations():
    text = "Pl-x 100/2018/2019 și L 3/2020; OUG nr. 5/2017, Legea 12/1850, Moțiunea simplă „Drumuri rele”, COM(2024) 45 final, Decizia CCR nr. 7/2015."
    got = [(c["type"], c["prefix"], c["number"], c["year"]) for c in citations.citations_of(text)]
    assert got == [("bill", "PL-x", "100", 2018), ("bill", "L", "3", 2020), ("oug", None, "5", 2017), ("unknown", None, None, None), ("motion", None, None, None), ("eu_doc", "COM", "45", 2024), ("court_decision", None, "7", 2015)]
    assert all(text[c["start"] : c["end"]] == c["raw"] for c in citations.citations_of(text))


def test_citations_of_all_types():
    cases = {
        "PHCD nr. 12/2019": ("chamber_resolution", "12", 2019, {"chamber": "camera"}), "PHCDS 3/2020": ("chamber_resolution", "3", 2020, {"chamber": None}), "Hotărârea Parlamentului României nr. 4/2019": ("parliamentary_resolution", "4", 2019, {}),
        "Ordonanța de urgență a Guvernului nr. 114/2018": ("oug", "114", 2018, {}), "ordonanţa Guvernului": None, "Ordonanța a Guvernului nr. 3/2011": ("og", "3", 2011, {}),
        "Moțiunea de cenzură cu titlul „Guvernul pleacă”": ("motion", None, None, {"kind": "censure", "title": "Guvernul pleacă"}), "moțiunea simplă nr. 3/1850": ("motion", "3", None, {"kind": "simple"}),
        "art. 53 alin. (2) din Constituția României": ("constitution", None, None, {"article": "53 alin. (2)"}), "Constituția României, art. 7": ("constitution", None, None, {"article": "7"}),
        "art. 9 din Regulamentul Camerei Deputaților": ("regulation", None, None, {"chamber": "camera", "article": "9"}), "Regulamentul activităților comune ale Camerei": ("regulation", None, None, {"chamber": "joint"}), "Regulamentul Senatului": ("regulation", None, None, {"chamber": "senat"}),
        "Regulamentul (UE) 2016/679": ("eu_doc", "679", 2016, {"kind": "regulation"}), "Directiva 2004/38/CE": ("eu_doc", "38", 2004, {"kind": "directive"}), "Decizia (UE) 2020/1": ("eu_doc", "1", 2020, {"kind": "decision"}),
        "Tratatul de la Lisabona, care": ("treaty", None, None, {"name": "Lisabona"}), "Protocolul adițional semnat la Paris.": ("treaty", None, None, {"name": "semnat la Paris"}), "Carta Națiunilor Unite": ("treaty", None, None, {"name": "Națiunilor Unite"}),
        "Codul de procedură penală art. 5": ("code", None, None, {"kind": "procedura_penala", "article": "5"}), "art. 12 din Codul muncii": ("code", None, None, {"kind": "muncii", "article": "12"}), "Codului insolvenței": ("code", None, None, {"kind": "insolventei"}),
        "Decizia Curții Constituționale a României nr. 3/2014": ("court_decision", "3", 2014, {}), "Decizia CCR nr. 3/1800": ("unknown", None, None, {"hint": "court-ish"}), "L 5/1900": ("unknown", None, None, {"hint": "law-ish"}),
    }
    for text, want in cases.items():
        got = citations.citations_of(text)
        if want is None:
            assert got == []
            continue
        kind, number, year, more = want
        assert [(c["type"], c["number"] if kind != "unknown" else None, c["year"]) for c in got] == [(kind, number, year)], text
        assert {k: got[0][k] for k in more} == more, text


def test_subjects_and_procedures():
    one = citations.citations_of("Pl-x 5/2019 pentru aprobarea Ordonanței despre drumuri, în procedură de urgență")[0]
    assert (one["subject"], one["procedure"]) == ("Ordonanței despre drumuri", "procedură de urgență")
    assert citations.citations_of("Legea 5/2019 asupra apelor privind râurile și lacurile")[0]["subject"] == "apelor privind râurile"
    assert citations.citations_of("Legea 5/2019. Nimic")[0]["subject"] is None and citations.subject_after("", 0) is None


def test_mentions():
    text = "HG nr. 5/2000, art. 7 alin. (2) lit. b), art. 53 din Constituție, Decret-lege 3/1990, Decizia ICCJ, Hotărârea Guvernului nr. 7/2001, art. 4 din Codul penal, Legea 5/2010"
    got = citations.mentions_of(text)
    assert [(c["type"], c["raw"]) for c in got] == [("unknown", "HG nr. 5/2000"), ("unknown", "art. 7 alin. (2) lit. b)"), ("constitution", "art. 53 din Constituție"), ("unknown", "Decret-lege 3/1990"), ("unknown", "Decizia ICCJ"), ("unknown", "Hotărârea Guvernului nr. 7/2001"), ("code", "art. 4 din Codul penal"), ("law", "Legea 5/2010")]
    assert [c["hint"] for c in got if c["type"] == "unknown"] == ["law-ish", "law-ish", "law-ish", "court-ish", "law-ish"]
    assert all(text[c["start"] : c["end"]] == c["raw"] for c in got) and citations.mentions_of("") == []


def test_votes_and_turns(spark):
    votes = extract.votes_of(TALK)
    assert [v["outcome"] for v in votes] == ["approved", "deferred", "no_quorum", "deferred"]
    assert votes[0]["motion_type"] == "agenda_approval" and votes[1]["voting_method"] == "electronic"
    alone = extract.votes_of("Supunem votului proiectul de lege, vot nominal. 10 voturi pentru, 20 contra.")[0]
    assert (alone["motion_type"], alone["voting_method"], alone["outcome"]) == ("item_adoption", "nominal", "rejected")
    assert (votes[0]["for"], votes[0]["against"], votes[0]["abstain"]) == (1132, 5, 2)
    turns = extract.turns_of(TALK)
    assert [(t["name"], t["role"]) for t in turns] == [("Domnul Ion Pop", None), ("Doamna Ana Rus", "ministru"), ("Domnul Dan Voicu", None)] and turns[-1]["end"] == len(TALK)
    df = spark.createDataFrame([(TALK,), (None,), ("no heads",)], "t string")
    rows = df.select(F.size(extract.votes(F.col("t"))), F.size(extract.turns(F.col("t"))), F.size(citations.citations(F.col("t")))).collect()
    assert [tuple(r) for r in rows] == [(4, 3, 0), (0, 0, 0), (0, 1, 0)]


def test_answers_that_were_cut_off(spark):
    import json

    whole = {"a": 1, "b": [1, {"c": 'x, y: " z'}, 2.5], "d": {"e": None, "f": True}, "g": "end"}
    text = json.dumps(whole)
    for k in range(1, len(text) + 1):
        got = json.loads(closed) if (closed := extract.closed(text[:k])) else None
        assert got is not None and set(got) <= set(whole), text[:k]
        assert all(got[x] == whole[x] for x in list(got)[:-1]), text[:k]
    assert extract.closed(text) == text and extract.closed("") == ""
    df = spark.createDataFrame([('Iată: ```json\n{"a": 1, "b": [1, 2,',), ('{"a": 3, "b": [], "z": 9,}',), ("nimic",), (None,)], "t string")
    got = [r.x and (r.x.a, r.x.b) for r in df.select(extract.salvaged(F.col("t"), "a int, b array<int>").alias("x")).collect()]
    assert got[:2] == [(1, [1, 2]), (3, [])] and got[2] in (None, (None, None))


def test_quotes_and_answers(spark):
    text = "El a spus: „Nu  vom\nceda” — și a plecat…"
    for quote in ("Nu vom ceda", 'spus: "nu vom', "ceda” - și", "plecat..."):
        a, b = extract.tolerant_span(text, quote)
        assert text[a:b].lower()[:2] == quote.lower()[:2]
    assert extract.tolerant_span(text, "altceva") is None
    df = spark.createDataFrame([("x ```json\n{\"a\": 1, \"b\": [2,],}\n``` y",), ("none",)], "t string")
    got = [r.x for r in df.select(extract.salvaged(F.col("t"), "a int, b array<int>").alias("x")).collect()]
    assert (got[0].a, got[0].b) == (1, [2]) and got[1] is None or got[1].a is None
    assert spark.range(1).select(extract.quoted_at(F.lit("abc Def"), F.lit("DEF")).alias("q")).first().q == [4, 7]


REGISTER = """## **DEZBATERI PARLAMENTARE**
## **Domnului Dan Popa, ministrul energiei**
## 1. **Ana Rus, deputat PNL, Circumscripția 1**
Obiectul întrebării: Prețul gazelor.
Text. Nr. 12A/5.03.2019
2. **Ion Pop, senator USR**
Fără obiect.
## **Curții de Conturi**
3. **Ana Rus, deputat PNL**
Întrebare privind auditul
"""


def test_question_register(spark):
    got = spark.range(1).select(extract.questions(F.lit(REGISTER)).alias("q")).first().q
    assert [(q.ordinal, q.questioner, q.party, q.addressee, q.addressee_role, q.topic) for q in got] == [(1, "Ana Rus", "PNL", "Dan Popa", "ministrul energiei", "Prețul gazelor"), (2, "Ion Pop", "USR", "Dan Popa", "ministrul energiei", None), (3, "Ana Rus", "PNL", "Curții de Conturi", None, "auditul")]
    assert (got[0].registration_number, got[0].registration_date) == ("12A", "2019-03-05")
    assert REGISTER[got[0].start :].startswith("## **Domnului") and REGISTER[got[1].start :].startswith("2. **Ion") and got[2].end == len(REGISTER)
    heads = spark.range(1).select(extract.report_headings(F.lit("# **Raport**\n\n## SENATUL\ntext\n## Capitolul I")).alias("h")).first().h
    assert [(h.level, h.text, h.line) for h in heads] == [(1, "Raport", 1), (2, "Capitolul I", 5)]


def test_agenda_categories(spark):
    from lectern.functions import rules

    titles = [("Aprobarea ordinii de zi", "procedural", 0.95, []), ("Moțiune de cenzură", "government_confidence", 0.75, ["motion"]), ("Dezbaterea Proiectului de lege", "bill_debate", 0.7, []), ("Nimic", "other", 0.4, []), (None, "other", 0.4, [])]
    df = spark.createDataFrame([(t[0],) for t in titles], "t string")
    got = [r.c for r in df.select(rules.agenda_category(F.col("t")).alias("c")).collect()]
    assert [(c.category, c.confidence, c.runners_up) for c in got] == [t[1:] for t in titles]
    assert spark.range(1).select(rules.confidence_type(F.lit("Moțiunea de cenzură"))).first()[0] == "cenzură"
