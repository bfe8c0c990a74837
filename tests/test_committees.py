"""Committee syntheses, on texts of our own."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import committees as c

TEXT = """## **SINTEZA LUCRĂRILOR COMISIILOR**
## **Perioada 3-7.02.2020**
## **1. Comisia pentru sănătate .......... 5**
Comisia și-a desfășurat lucrările în zilele de 3, 4 și 5 februarie 2020, între orele 10,00 - 14,30, fizic și online, în ședință comună cu Comisia pentru muncă și Comisia juridică din cadrul Senatului.
1. Proiectul de lege privind sănătatea, PL-x 12/2019, sesizare în fond.

În urma dezbaterilor, proiectul a fost aprobat cu unanimitate de voturi, 12 voturi pentru și două abțineri.

2. Propunere legislativă pentru aviz

Amânată pentru altă ședință.

7. Rând străin
Au fost prezenți: Ion Pop – președinte, Ana Rus și Dan Voicu. Domnul deputat Dan Voicu a fost prezenti online. Au absentat motivat: Maria Ene. Ana Rus – înlocuită de doamna deputat Elena Dinu.
PREȘEDINTE,
**Ion Pop**
SECRETAR, **Ana Rus**
## **Comisia specială comună de anchetă**
|Nr. crt.|PL-x|Titlu|Rezoluție|
|---|---|---|---|
|1.|PL-x 5/2020|Lege despre ape și râuri|Raport comun|În urma votului s-a respins|
|x|nu|e|rând|

|Numele și prenumele|Prezență|
|Ion Pop – vicepreședinte|Prezent fizic|
|Ana Maria Rus|Înlocuită de Dan Voicu|
## **EDITOR: PARLAMENTUL ROMÂNIEI**
1. Altceva
"""


def test_periods_kinds_and_dates():
    assert c.period_of("Perioada: 28.01 - 3.02.2020") == ("2020-01-28", "2020-02-03") and c.period_of("Perioada 3-7.02.2020") == ("2020-02-03", "2020-02-07")
    assert c.period_of("Perioada 3.02 - 5.03; 9.03.2021") == ("2021-02-03", "2021-03-05") and c.period_of("Perioada 4.05.2021") == ("2021-05-04", "2021-05-04") and c.period_of("x") == (None, None) == c.period_of("Perioada 3-7.13.2020")
    kinds = {"Comisia pentru muncă": "permanent", "Comisia specială": "special", "Comisia comună": "special_joint", "Comisia de anchetă": "inquiry", "Comisia de anchetă a Camerei Deputaților și Senatului": "inquiry_joint"}
    assert {k: c.kind_of(k) for k in kinds} == kinds
    assert c.dates_of("și-a desfășurat lucrările în ziua de **9** mai 2021") == ["2021-05-09"] and c.dates_of("în ziua de 9 mai 2021") == []
    assert c.hours_of("10.00 - 12.30, 25.00-26.00, 9:15–9:45") == [{"start": "10:00", "end": "12:30"}, {"start": "09:15", "end": "09:45"}]


def test_votes_roles_and_outputs():
    assert c.votes_summed("Aprobat cu majoritate de voturi, 3 voturi împotrivă, trei abțineri") == {"outcome": "approved", "majority": "majority", "for": None, "against": 3, "abstain": 3}
    assert c.votes_summed("amânat, deși adoptat")["outcome"] == "deferred" and c.votes_summed("aviz nefavorabil")["outcome"] == "rejected" and c.votes_summed("nimic") is None is c.votes_summed(None)
    label = lambda rules, t: c._label(rules, t)
    assert [label(c.ROLES, t) for t in ("fond comun", "pentru aviz", "în fond", "x")] == ["fond_comun", "aviz", "fond", None]
    assert [label(c.OUTPUTS, t) for t in ("raport comun suplimentar", "raport comun", "raport", "studiu", "avizare", "x")] == ["raport_comun_suplimentar", "raport_comun", "raport", "studiu", "aviz", None]


def test_synthesis(spark):
    a, b = c.committees_of(TEXT)
    assert (a["name"], a["kind"], a["chair"], a["secretary"], a["format"]) == ("Comisia pentru sănătate", "permanent", "Ion Pop", "Ana Rus", "mixed")
    assert a["dates"] == ["2020-02-03", "2020-02-04", "2020-02-05"] and a["time_windows"] == [{"start": "10:00", "end": "14:30"}]
    assert a["joint_with"] == [{"name": "Comisia pentru muncă", "chamber": "senat"}, {"name": "Comisia juridică", "chamber": "senat"}]
    first, second = a["agenda"]
    assert (first["ordinal"], first["committee_role"], first["vote_summary"]["outcome"], first["vote_summary"]["abstain"], first["vote_summary"]["for"]) == (1, "fond", "approved", 2, 12)
    assert [(r["type"], r["number"]) for r in first["references"]] == [("bill", "12")] and second["vote_summary"]["outcome"] == "deferred" and second["committee_role"] == "aviz"
    people = {p["name"]: (p["mode"], p["role"], p["substituted_by"]) for p in a["roster"]}
    assert people["Ion Pop"] == ("physical", "președinte", None) and people["Ana Rus"] == ("substituted", None, "Elena Dinu") and people["Maria Ene"][0] == "absent"
    assert (b["kind"], b["agenda"][0]["title"], b["agenda"][0]["output_type"], b["agenda"][0]["vote_summary"]["outcome"], b["agenda"][0]["references"][0]["number"]) == ("inquiry_joint", "Lege despre ape și râuri", "raport_comun", "rejected", "5")
    assert [(p["name"], p["mode"], p["role"], p["substituted_by"]) for p in b["roster"]] == [("Ion Pop", "physical", "vicepreședinte", None), ("Ana Maria Rus", "substituted", None, "Dan Voicu")]
    assert TEXT[b["start"] : b["end"]].startswith("## **Comisia specială") and "EDITOR" not in TEXT[b["start"] : b["end"]]
    day = c.roster_day("1. Ion Pop – secretar, Grupul parlamentar al PSD\n2. Ana Rus, Grupul parlamentar al U.S.R., membru\n")
    assert [(p["name"], p["role"], p["party_group"]) for p in day] == [("Ion Pop", "secretar", "PSD"), ("Ana Rus", "membru", "U.S.R")]
    assert c.alone_of("SINTEZA LUCRĂRILOR COMISIEI pentru agricultură**") == "Comisia pentru agricultură" and c.alone_of("nimic") is None
    df = spark.createDataFrame([(TEXT,), (None,), ("nimic",)], "t string")
    rows = df.select(c.committees(F.col("t")).alias("x"), c.period(F.col("t")).alias("p")).collect()
    assert [len(r.x) for r in rows] == [2, 0, 0] and tuple(rows[0].p) == ("2020-02-03", "2020-02-07") and rows[0].x[0].agenda[0].vote_summary["for"] == 12
