"""The twelve named queries over a store of grains, and their dispatcher.

A store maps grain names to DataFrames (or to Parquet folders). Results are frames; `SearchResult` adds the total and the page.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import aggregates, sets, windows
from lectern.plans import search

# Boosts of searched fields, and the grains below a document.
FIELDS = {"text": 3.0, "agenda_title": 2.0, "speaker_name": 2.0}
PERSON_FIELDS = {"canonical_name": 2.0, "diacritic_form": 1.5, "alias_text": 1.0}
CHILDREN = ("agenda_items", "speeches", "votes", "interpellations", "questions", "committee_meetings")


@dataclass
class SearchResult:
    hits: DataFrame | None
    page: int = 1
    page_size: int = 20
    aggregations: dict[str, DataFrame] = field(default_factory=dict)
    matched: DataFrame | None = None

    @property
    def total(self) -> int:
        return self.matched.count() if self.matched is not None else 0


class Store:
    def __init__(self, grains: dict[str, DataFrame]):
        self.grains = grains

    @classmethod
    def of_folder(cls, spark: SparkSession, root: str, names: list[str]) -> Store:
        return cls({n: spark.read.parquet(f"{root}/{n}") for n in names})

    def _flat_speeches(self) -> DataFrame:
        """Speeches with the columns that searches filter by."""
        s = self.grains["speeches"]
        out = s.withColumns({"speaker_person_id": F.col("speaker.person_id"), "speaker_name": F.col("speaker.name_search"), "party": F.col("speaker.party_group_at_time"), "ref_bills": F.col("refs.bills")})
        return out if "topics" in s.columns else out.withColumn("topics", F.array().cast("array<string>"))

    def _point(self, grain: str, key: str, value: str) -> DataFrame:
        return self.grains[grain].filter(F.col(key) == value).limit(1)

    def search_speeches(self, q: str | None = None, page: int = 1, page_size: int = 20, **more) -> SearchResult:
        page, size, _ = windows.page_bounds(page, page_size)
        rows = self._flat_speeches()
        hits = search.search_speeches(rows, q, FIELDS, page=page, page_size=size, **more)
        filters = {k: v for k, v in more.items() if k not in ("rank_fusion", "query_vector")}
        matched = search.filtered(rows, **filters)
        if q:
            matched = matched.join(search.bm25(rows, "record_id", FIELDS, q).select("record_id"), "record_id")
        return SearchResult(hits, page, size, matched=matched)

    def search_speeches_knn(self, query_vector: list[float] | None = None, **more) -> SearchResult:
        """By vector alone; never by text."""
        return self.search_speeches(None, rank_fusion="knn", query_vector=query_vector, **more)

    def list_document_children(self, document_id: str, grains: list[str] | None = None, page: int = 1, page_size: int = 500) -> SearchResult:
        if unknown := set(grains or []) - set(CHILDREN):
            raise ValueError(f"unknown grains: {sorted(unknown)}")
        page, size = max(1, page or 1), min(500, max(1, page_size))
        picked = {g: self.grains[g].filter(F.col("document_id") == (document_id or "")).select("record_id", "document_id", F.col("position_in_document").alias("position")) for g in (grains or CHILDREN) if g in self.grains}
        rows = sets.union_grains(picked)
        return SearchResult(windows.paged(rows, [F.asc_nulls_last("position"), F.asc("record_id")], page, size, 500), page, size, matched=rows)

    def get_document(self, document_id: str) -> DataFrame:
        return self._point("documents", "record_id", document_id)

    def list_documents_by_date(self, date: str, chamber: str | None = None, page_size: int = 20) -> SearchResult:
        rows = self.grains["documents"].filter(F.col("session_date") == date)
        rows = rows if chamber is None else rows.filter(F.col("chamber") == chamber)
        return SearchResult(windows.paged(rows, [F.desc_nulls_last("published"), F.asc("record_id")], 1, page_size), 1, page_size, matched=rows)

    def get_agenda_item(self, record_id: str) -> DataFrame:
        return self._point("agenda_items", "record_id", record_id)

    def get_speech(self, record_id: str) -> DataFrame:
        return self._point("speeches", "record_id", record_id)

    def person_page(self, person_slug: str) -> SearchResult:
        """The newest twenty substantive speeches, with facets by chamber, year and party."""
        rows = self._flat_speeches().filter((F.col("speaker_person_id") == person_slug) & F.col("is_substantive"))
        facets = {
            "person": self._point("persons", "id", person_slug) if "persons" in self.grains else None,
            "chamber": aggregates.terms(rows, F.col("chamber"), 8),
            "year": aggregates.terms(rows, F.col("year"), 50).orderBy("key"),
            "party": aggregates.terms(rows, F.col("party"), 30, aggregates.UNKNOWN),
        }
        return SearchResult(windows.paged(rows, [F.desc_nulls_last("session_date"), F.asc("record_id")]), aggregations=facets, matched=rows)

    def search_persons(self, q: str, page: int = 1, page_size: int = 20) -> SearchResult:
        page, size, offset = windows.page_bounds(page, page_size)
        persons = self.grains["persons"].withColumn("alias_text", F.array_join("aliases", " "))
        if not (q or "").strip():
            return SearchResult(persons.limit(0), page, size)
        scored = search.bm25(persons, "id", PERSON_FIELDS, q, "and")
        return SearchResult(persons.join(scored, "id").orderBy(F.desc("score"), "id").offset(offset).limit(size), page, size, matched=scored)

    def list_committee_meetings(self, committee_id: str, date_from: str | None = None, page: int = 1, page_size: int = 20) -> SearchResult:
        rows = self.grains["committee_meetings"].filter(F.col("committee_id") == committee_id)
        rows = rows if date_from is None else rows.filter(F.col("meeting_date") >= date_from)
        return SearchResult(windows.paged(rows, [F.desc_nulls_last("meeting_date"), F.asc("record_id")], page, page_size), page, page_size, matched=rows)

    def get_report(self, record_id: str) -> DataFrame:
        return self._point("reports", "record_id", record_id)

    def agg_speeches_by_party_year(self, year: int | None = None, chamber: str | None = None, size: int = 100) -> SearchResult:
        rows = self._flat_speeches().filter("is_substantive")
        rows = rows if year is None else rows.filter(F.col("year") == year)
        rows = rows if chamber is None else rows.filter(F.col("chamber") == chamber)
        size = min(1000, max(1, size))
        parts = {"party_year": aggregates.nested_terms(rows, aggregates.known(F.col("party")), F.col("year"), size), "speakers": rows.agg(F.approx_count_distinct("speaker_person_id").alias("speakers"))}
        return SearchResult(None, 1, 0, parts, rows)


NAMED: dict[str, Callable] = {
    name: getattr(Store, name)
    for name in (
        "search_speeches search_speeches_knn list_document_children get_document list_documents_by_date get_agenda_item get_speech person_page search_persons list_committee_meetings get_report agg_speeches_by_party_year"
    ).split()
}


def run(store: Store, name: str, params: dict | None = None, explain: bool = False):
    """Runs a named query; with `explain` its plan is printed too. An unknown name is a KeyError that lists the names."""
    if name not in NAMED:
        raise KeyError(f"{name}: one of {', '.join(NAMED)}")
    out = NAMED[name](store, **(params or {}))
    frame = out.hits if isinstance(out, SearchResult) else out
    if explain and frame is not None:
        frame.explain("formatted")
    return out
