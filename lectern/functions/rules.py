"""Ordered pattern rules as expressions: document classes, file names, votes, session facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# File names, months, chambers and body marks of the gazette.
FILE_NAME = r"^(\d{4}-\d{2}-\d{2})_MO-P([IVXM]+)-([0-9A-Za-z]+)-(\d{4})\.(?:md|pdf)$"
MONTHS = ("ianuarie", "februarie", "martie", "aprilie", "mai", "iunie", "iulie", "august", "septembrie", "octombrie", "noiembrie", "decembrie")
CHAMBER = r"(?iu)\b(SENATULUI|SENATUL|CAMEREI\s+DEPUTA[ȚTÞ]ILOR|CAMERA\s+DEPUTA[ȚTÞ]ILOR)\b"
SESSION = r"(?m)(SESIUNEA[^\n]+?)(?:\s*\(Legislatura|\s*$)"
SESSION_DATE = r"(?iu)Ședința\s+din\s+ziua\s+de\s+(\d{1,2})\s+(\p{L}+)\s+(\d{4})"
LEGISLATURE = r"(?iu)Legislatura\s+a\s+([IVXM]+)-a"
# Fixed values: (class, score, pattern that must occur, pattern that must not), classes in the order that breaks ties.
CLASSES = ("plenary_stenogram", "plenary_joint_session", "committee_synthesis", "report_facsimile", "question_register")
MARKS = (
    ("question_register", 0.95, r"LISTA\s+[ÎI]NTREB[ĂA]RILOR\s+ADRESATE", r"\(\s*STENOGRAMA\s*\)"),
    ("plenary_joint_session", 0.95, r"[ȘS]EDIN[ȚTÞ]E\s+COMUNE\s+ALE\s+CAMEREI\s+DEPUTA[ȚTÞ]ILOR\s+[ȘS]I\s+SENATULUI", None),
    ("report_facsimile", 0.9, r"\(\s*RAPOARTE\s+DE\s+ACTIVITATE\s*\)", None),
    ("committee_synthesis", 0.9, r"SINTEZA\s+LUCR[ĂA]RILOR\s+COMISI", None),
    ("plenary_stenogram", 0.85, r"\(\s*STENOGRAMA\s*\)", None),
    ("plenary_stenogram", 0.65, r"DEZBATERI\s+PARLAMENTARE", None),
)
# Classes that hold another one, so that the pair is not ambiguous.
IMPLIED = (("plenary_joint_session", "plenary_stenogram"), ("report_facsimile", "plenary_joint_session"), ("report_facsimile", "plenary_stenogram"))
# What the markdown cleaner replaces, in order: image notes, running headers, page numbers, hyphens at line ends, blanks at line ends, blank lines.
CLEANING = (
    (r"(?m)^\*\*==> picture \[[^\]]+\] intentionally omitted <==\*\*\s*\n", ""),
    (r"(?m)^\s*MONITORUL\s+OFICIAL\s+AL\s+ROM[ÂA]NIEI[^\n]*\n", ""),
    (r"(?m)^\s*\d{1,3}\s*\n", ""),
    (r"(?U)(\w)-\n(\w)", "$1$2"),
    (r"(?m)[ \t]+$", ""),
    (r"\n{3,}", "\n\n"),
)
# The bytes at the head of a text that its class is read from.
HEAD_BYTES = 10_000


def first_of(*rules: tuple[Column, str]) -> Column:
    """The value of the first condition that holds, else null."""
    return reduce(lambda rest, r: F.when(r[0], F.lit(r[1])).otherwise(rest), reversed(rules), F.lit(None).cast("string"))


def extracted(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def file_meta(name: Column) -> Column:
    """published, part, issue and year of a file name; null where it doesn't fit or the date is none."""
    get = lambda g: F.regexp_extract(name, FILE_NAME, g)
    published = F.try_to_date(get(1), "yyyy-MM-dd")
    return F.when(name.rlike(FILE_NAME) & published.isNotNull(), F.struct(published.alias("published"), get(2).alias("part"), get(3).alias("issue"), get(4).cast("int").alias("year")))


def issue_suffix(issue: Column) -> Column:
    """The letters at the end of an issue number."""
    return F.regexp_extract(issue, r"^\d+([A-Za-z]*)$", 1)


def header_meta(text: Column) -> Column:
    """Chamber, session, session date and legislature from the first 5000 characters."""
    head = F.substring(text, 1, 5000)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(head, SESSION_DATE, 2)))
    chamber = F.upper(F.regexp_extract(head, CHAMBER, 1))
    day = F.try_to_date(F.format_string("%s-%02d-%02d", F.regexp_extract(head, SESSION_DATE, 3), month, F.coalesce(F.regexp_extract(head, SESSION_DATE, 1).try_cast("int"), F.lit(0))), "yyyy-MM-dd")
    return F.struct(
        F.when(chamber.startswith("SENAT"), "Senatul").when(chamber != "", "Camera Deputaților").alias("chamber"),
        F.trim(extracted(head, SESSION)).alias("session"),
        F.when(month > 0, day).alias("session_date"),
        F.upper(extracted(head, LEGISLATURE)).alias("legislature"),
    )


def clean_markdown(md: Column) -> Column:
    for pattern, by in CLEANING:
        md = F.regexp_replace(md, pattern, by)
    return F.concat(F.regexp_replace(md, r"^\s+|\s+$", ""), F.lit("\n"))


def classified(text: Column, suffix: Column) -> Column:
    """top_type, top_score, second_type, second_score and ambiguous of a document, from marks in the first 10,000 bytes of its text and its issue's suffix."""
    text = F.make_valid_utf8(F.substring(F.coalesce(text, F.lit("")).cast("binary"), 1, HEAD_BYTES).cast("string"))  # the cut may lie within a character
    scores = {k: F.lit(0.0) for k in CLASSES}
    low = F.lower(F.coalesce(suffix, F.lit("")))
    for kind, letter in (("committee_synthesis", "c"), ("report_facsimile", "r")):
        scores[kind] = F.greatest(scores[kind], F.when(low == letter, 1.0).otherwise(0.0))
    for kind, score, pattern, but in MARKS:
        hit = text.rlike("(?iu)" + pattern)
        scores[kind] = F.greatest(scores[kind], F.when(hit & ~text.rlike("(?iu)" + but) if but else hit, score).otherwise(0.0))
    ranked = F.array_sort(F.array(*(F.struct((-s).alias("s"), F.lit(i).alias("i"), F.lit(k).alias("k")) for i, (k, s) in enumerate(scores.items()))))
    top, second = ranked[0], ranked[1]
    none = top["s"] == 0
    implied = reduce(lambda a, b: a | b, [(top["k"] == a) & (second["k"] == b) for a, b in IMPLIED])
    kind = lambda x: F.when(none, "other").otherwise(x["k"])
    return F.struct(
        kind(top).alias("top_type"), (-top["s"]).alias("top_score"), kind(second).alias("second_type"), F.when(none, 0.0).otherwise(-second["s"]).alias("second_score"),
        (~none & ~implied & ((second["s"] - top["s"]) < 0.2)).alias("ambiguous"),
    )


def session_type(text: Column) -> Column:
    return first_of((text.rlike("(?i)extraordinar"), "extraordinary"), (text.rlike("(?i)ordinar"), "ordinary"))


def quorum(registered: Column, total: Column) -> Column:
    """Whether at least half of all members are registered."""
    return registered >= F.ceil(total / 2)


def year_in_bounds(kind: Column, year: Column, bounds: dict[str, tuple[int, int]]) -> Column:
    """Whether a year fits its kind's inclusive bounds; null passes."""
    ok = reduce(lambda rest, b: F.when(kind == b[0], year.between(*b[1])).otherwise(rest), bounds.items(), F.lit(True))
    return year.isNull() | ok


# The closed topic vocabulary in canonical order, each with the patterns that name it in a title.
TOPICS = (
    ("Educație", (r"\b(?:educa[țt]i(?:e|onal[ăa]?)|(?:în|in)v[ăa][țt][ăa]m[âaî]nt(?:ul|ului)?|[șs]coli(?:lor|i)?|universit[ăa][țt]i|elevi(?:lor)?|studen[țt]i(?:lor)?|profesori(?:lor)?)\b", r"\bComisia\s+pentru\s+(?:în|in)v[ăa][țt][ăa]m[âaî]nt")),
    ("Sănătate", (r"\b(?:s[ăa]n[ăa]tat(?:e|ii)|spital(?:e|ele|ului|elor)?|medic(?:al[ăa]?|amente?|i(?:lor)?)|farmac(?:ie|euti)|asisten[țt][ăa]\s+medical[ăa])\b", r"\bComisia\s+pentru\s+s[ăa]n[ăa]tate\b")),
    ("Apărare", (r"\b(?:ap[ăa]rare(?:a|ii)?|armat[ăa]|militar(?:[ăa]|i|e|elor)?|NATO|sigura?n[țt][ăa]\s+na[țt]ional[ăa])\b", r"\bComisia\s+pentru\s+ap[ăa]rare(?:,\s+ordine\s+public[ăa])?", r"\bMinisterul\s+Ap[ăa]r[ăa]rii\s+Na[țt]ionale\b")),
    ("Economie", (r"\b(?:economie(?:i)?|economic[ăa]?|industri(?:e|ei|al[ăa])|comer[țt](?:ul|ului)?|antreprenor|IMM|întreprinderi(?:lor)?)\b", r"\bComisia\s+pentru\s+(?:industrii|economie|politic[ăa]\s+economic[ăa])\b")),
    ("Transporturi", (r"\b(?:transport(?:uri(?:le|lor)?|ul|ului)?|drumuri(?:le|lor)?|autostr[ăa]zi(?:le|lor)?|feroviar[ăa]?|aerian[ăa]?|navigabil|c[ăa]i\s+ferate)\b", r"\bComisia\s+pentru\s+transporturi(?:\s+[șs]i\s+infrastructur[ăa])?")),
    ("Afaceri europene", (r"\b(?:afaceri(?:lor)?\s+europene|Uniunea\s+European[ăa]|UE|(?:Comisi(?:a|ei|ile|ilor)|Consiliul|Parlamentul)\s+Europen[ăaeio]+|directiv[ăa]\s+european[ăa])\b", r"\bComisia\s+(?:pentru\s+)?afaceri(?:lor)?\s+europene\b", r"\bComunic[ăa]ri[ie]?\s+(?:a\s+)?Comisiei\s+Europen")),
    ("Justiție", (r"\b(?:justi[țt]ie(?:i)?|judec[ăa]tor(?:i|ilor)?|procurori(?:lor)?|penal[ăa]?|infrac[țt]iuni(?:lor)?|magistrat(?:i|ilor|ur[ăa])?)\b", r"\bComisia\s+juridic[ăa](?:,\s+de\s+disciplin[ăa]\s+[șs]i\s+imunit[ăa][țt]i)?", r"\bComisia\s+pentru\s+(?:legisla[țt]ie|drepturile\s+omului)\b")),
    ("Muncă", (r"\b(?:munc(?:[ăa]|ii|ito(?:r|ri))|salaria[țt]i(?:lor)?|sindicat(?:e|elor)?|pensi(?:e|i|ilor)|[șs]omaj(?:ul|ului)?|asisten[țt][ăa]\s+social[ăa])\b", r"\bComisia\s+pentru\s+munc[ăa](?:\s+[șs]i\s+protec[țt]ie\s+social[ăa])?")),
    ("Agricultură", (r"\b(?:agricultur(?:[ăa]|ii)|fermier(?:i|ilor)?|crescatori(?:lor)?|culturi(?:lor)?\s+agricole|zootehni[ce]|p[ăa]duri(?:lor)?\s+(?:[șs]i\s+)?dezvoltare)\b", r"\bComisia\s+pentru\s+agricultur[ăa](?:,\s+silvicultur[ăa])?")),
    ("Mediu", (r"\b(?:mediul(?:ui)?\s+înconjur[ăa]tor|protec[țt]ia\s+mediului|polu[ăa]r(?:e|ii)|p[ăa]duri(?:lor)?|defri[șs][ăa]r(?:e|i)|climatic[ăa]|biodiversitate)\b", r"\bComisia\s+pentru\s+mediu(?:\s+[șs]i\s+echilibru\s+ecologic)?")),
    ("Cultură", (r"\b(?:cultur(?:[ăa]|ii|al[ăa]?)|patrimoniu(?:lui)?|art(?:[ăa]|ist(?:ic[ăa]?|i))|monumente(?:lor)?\s+istorice)\b", r"\bComisia\s+pentru\s+cultur[ăa](?:,\s+arte)?")),
    ("Buget-finanțe", (r"\b(?:buget(?:ul|ului|are)?|finan[țt][ăa]ri?|fiscal[ăa]?|impozit(?:e|are)|TVA|taxa(?:elor)?|deficit(?:ul|ului)?|datorie\s+public[ăa]|trezorerie)\b", r"\bComisia\s+pentru\s+buget(?:,\s+finan[țt]e\s+[șs]i\s+b[ăa]nci)?", r"\bCodul\s+fiscal\b")),
    ("Administrație", (r"\b(?:administra[țt]ie\s+public[ăa]?|autorit[ăa][țt]i\s+locale|prim[ăa]ri(?:e|ile|ilor)|consilii\s+locale|consilii\s+jude[țt]ene)\b", r"\bComisia\s+pentru\s+administra[țt]ie\s+public[ăa](?:,\s+amenajarea\s+teritoriului)?")),
    ("Politică externă", (r"\b(?:politic[ăa]\s+extern[ăa]|diploma[țt]i(?:e|lor|ic[ăa])|ambasad(?:[ăa]|ei|elor)|tratat(?:e|ul|elor)\s+interna[țt]ional|rela[țt]ii\s+(?:bilaterale|interna[țt]ionale))\b", r"\bComisia\s+pentru\s+politic[ăa]\s+extern[ăa]")),
    ("Drepturile omului", (r"\b(?:drepturile?\s+omului|libert[ăa][țt]i\s+fundamentale|egalitatea?\s+de\s+[șs]anse|nediscriminare|minorit[ăa][țt]i)\b", r"\bComisia\s+pentru\s+drepturile\s+omului(?:,\s+culte(?:\s+[șs]i\s+problemele\s+minorit[ăa][țt]ilor)?)?")),
)


def topics(title: Column) -> Column:
    """The topics that a title names, in canonical order; none for an empty title."""
    named = [F.when(F.coalesce(title, F.lit("")).rlike("(?iuU)" + "|".join(patterns)), F.lit(topic)) for topic, patterns in TOPICS]
    return F.array_compact(F.array(*named))


# Agenda categories with the patterns that a title matches, all of weight 1 but the last.
CATEGORIES = (
    ("oath_taking", r"Depunerea jur[ăa]m[âa]ntului"),
    ("government_hour", r"\bOra\s+Guvernului\b"),
    ("government_confidence", r"vot\s+de\s+încredere|mo[țt]iun(?:e|ea|ii|ile|ilor)\s+de\s+cenzur[ăa]|angajare(?:a)?\s+r[ăa]spunderii|investitur(?:a|ii)?\s+Guvernului|învestire\s+a\s+Guvernului"),
    ("tacit_adoption", r"adoptat[ăa]?\s+tacit|împlinirea\s+termenului\s+constitu[țt]ional"),
    ("commemorative", r"Alocu[țt]iune\s+cu\s+prilejul|Moment\s+de\s+reculegere"),
    ("final_vote_batch", r"Supunerea\s+la\s+votul\s+final"),
    ("political_declarations", r"Declara[țt]ii\s+politice|interven[țt]ii\s+ale\s+deputa[țt]ilor"),
    ("appointment", r"Numirea\s+(?:unor\s+)?membri(?:lor)?|alegerea\s+(?:unor\s+)?membri"),
    ("motion", r"mo[țt]iun(?:e|ea)\s+(?:simpl[ăa]|de\s+cenzur[ăa])"),
    ("committee_report_presentation", r"Prezentarea\s+Raportului\s+privind\s+activitatea\s+Comisiei"),
    ("legislative_transmission", r"Aprobarea\s+transmiterii\s+c[ăa]tre\s+Camera\s+Deputa[țt]ilor|ca\s+prim[ăa]\s+Camer[ăa]\s+sesizat[ăa]"),
    ("withdrawal", r"solicitarea\s+de\s+retragere\s+din\s+procesul\s+legislativ"),
    ("notification", r"Not[ăa]\s+pentru\s+exercitarea|Informare\s+privind\s+depunerea|Informare\s+(?:din\s+partea|privind)"),
    ("regulation_amendment", r"modificarea\s+Regulamentului\s+(?:Senatului|Camerei\s+Deputa[țt]ilor)"),
    ("party_membership_change", r"trecere(?:a)?\s+(?:de\s+)?la\s+Grupul|demisie\s+din\s+Grupul|activarea\s+doamnei?\s+(?:deputat|senator)|activarea\s+domnului\s+(?:deputat|senator)"),
    ("subsidiarity_check", r"control\s+de\s+subsidiaritate|în\s+temeiul\s+Protocolului\s+nr\.?\s*2"),
    ("foreign_address", r"(?:Mesaj(?:ul)?|Discurs(?:ul)?|Alocu[țt]iune)\s+(?:al\s+)?Pre[șs]edintelui\s+(?!Rom[âa]niei)"),
    ("seat_vacancy", r"vacantarea\s+func[țt]iei|Validarea\s+func[țt]iei"),
    ("parliamentary_declaration", r"Declara[țt](?:ia|iei)?\s+Parlamentului\s+Rom[âa]niei"),
    ("delegation_membership", r"Componen[țt]a\s+nominal[ăa]\s+(?:[șs]i\s+a\s+)?(?:conducerii\s+)?Delega[țt]iei\s+permanente"),
    ("mandate_validation", r"Validarea\s+mandatelor"),
    ("chamber_officer", r"alegerea\s+(?:vicepre[șs]edin[țt]ilor?|(?:unui|unor)\s+vicepre[șs]edinte)\s+(?:al(?:e)?\s+)?(?:Senatului|Camerei\s+Deputa[țt]ilor)"),
    ("committee_membership", r"constituirea\s+Comisiei\s+(?:speciale|permanente)|componen[țt]a\s+(?:nominal[ăa]\s+)?Comisiei"),
    ("eu_consultation", r"opinie\s+referitoare\s+la\s+Comunicarea\s+Comisiei|adoptarea\s+opiniei\s+referitoare\s+la"),
    ("questions_interpellations", r"[ÎI]ntreb[ăa]ri\s+orale\s+adresate\s+Guvernului|R[ăa]spunsuri\s+(?:scrise\s+)?la\s+întreb[ăa]ri"),
    ("deadline_extension", r"prelungirea\s+termenului"),
    ("procedural", r"Aprobarea\s+ordinii\s+de\s+zi|programul(?:ui)?\s+de\s+lucru|Discu[țt]ii\s+procedurale|modificarea\s+ordinii"),
    ("bill_debate", r"(?:Dezbaterea\s+)?(?:Proiectul(?:ui)?\s+(?:de\s+lege|de\s+hot[ăa]r[âa]re)|Propunerii\s+legislative)"),
)
# Categories of less weight; kinds of confidence votes, in order.
LIGHT = {"bill_debate": 0.5}
CONFIDENCE_TYPES = (
    ("învestitură", r"învestir|investitur"),
    ("cenzură", r"mo[țt]iun(?:e|ea|ii|ile|ilor)\s+de\s+cenzur[ăa]"),
    ("angajare_răspundere", r"angajare(?:a)?\s+r[ăa]spunderii"),
    ("demitere", r"demitere"),
)


def agenda_category(title: Column) -> Column:
    """category, confidence and runners-up (within 0.2 of the top weight, by name) of an agenda title."""
    t = F.coalesce(title, F.lit(""))
    hits = F.array_compact(F.array(*(F.when(t.rlike("(?iuU)" + p), F.struct(F.lit(-LIGHT.get(k, 1.0)).alias("w"), F.lit(k).alias("k"))) for k, p in CATEGORIES)))
    ranked = F.array_sort(hits)
    top, n = F.get(ranked, F.lit(0)), F.size(hits)
    sure = F.when(n == 0, 0.4).when(n > 1, 0.75).when(top["w"] <= -1.0, 0.95).otherwise(0.7)
    runners = F.transform(F.filter(F.slice(ranked, 2, len(CATEGORIES)), lambda h: h["w"] - top["w"] < 0.2), lambda h: h["k"])
    return F.struct(F.coalesce(top["k"], F.lit("other")).alias("category"), sure.alias("confidence"), runners.alias("runners_up"))


def confidence_type(title: Column) -> Column:
    return first_of(*((title.rlike("(?iuU)" + p), k) for k, p in CONFIDENCE_TYPES))
