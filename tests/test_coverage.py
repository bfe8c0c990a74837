"""Span coverage against a loop, and the run reports."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from lectern.plans import coverage


def by_loop(text: str, claims: list[tuple[int, int]], least: int):
    held = [False] * len(text)
    for s, e in claims:
        for i in range(max(0, s), min(len(text), e)):
            held[i] = True
    gaps, i = [], 0
    while i < len(text):
        j = i
        while j < len(text) and held[j] == held[i]:
            j += 1
        if not held[i] and j - i >= least and text[i:j].strip():
            gaps.append((i, j))
        i = j
    return sum(held), gaps


def test_coverage_against_a_loop(spark):
    draw = random.Random(3)
    rows = []
    for n in range(40):
        text = "".join(draw.choice("ab \n") for _ in range(draw.choice([0, 5, 60])))
        rows.append((str(n), text, [(s := draw.randrange(-5, 60), s + draw.randrange(0, 20)) for _ in range(draw.randrange(0, 5))]))
    df = spark.createDataFrame(rows, "document_id string, text string, claims array<struct<start:int,end:int>>")
    got = {r.document_id: r.coverage for r in coverage.covered(df, least=4).collect()}
    for key, text, claims in rows:
        claimed, gaps = by_loop(text, claims, 4)
        c = got[key]
        assert (c.body_chars, c.claimed_chars, [(g.start, g.end) for g in c.gaps]) == (len(text), claimed, gaps)
        assert [g.first_line for g in c.gaps] == [text[:s].count("\n") + 1 for s, _ in gaps]
        assert c.claimed_pct == (round(claimed / len(text), 6) if text else 1.0)
    assert coverage.below(coverage.covered(df), 0.5).count() == sum(got[k].claimed_pct < 0.5 for k in got)


def test_reports(spark):
    codings = spark.createDataFrame([(2001, 0, 2.0, 1, 4), (2001, 2, None, 1, 0), (2001, None, 4.0, 0, 0), (None, 1, 1.0, 0, 1)], "year int, hawkins int, dqi_level double, missed int, markers int")
    r = coverage.year_drift(codings).first()
    assert (r.n, r.h0, r.h1, r.h2, r.h_err, r.dqi_mean, r.missed_pct) == (3, 1, 0, 1, 1, 3.0, 50.0)
    calls = spark.range(30).withColumn("cost", F.lit(1.0))
    assert coverage.within_budget(calls, "id", "cost", 7.5).count() == 8
    records = spark.createDataFrame([("a", "x" * 120), ("b", "y" * 120), ("c", "short")], "record_id string, text string")
    todo = coverage.to_embed(records, spark.createDataFrame([("a", "0", [0.0])], "record_id string, text_fingerprint string, vector array<double>"), "speeches", 1)
    prints = {r.record_id: r.fingerprint for r in todo.collect()}
    assert set(prints) == {"a", "b"}
    prior = spark.createDataFrame([("a", prints["a"], [0.0])], "record_id string, text_fingerprint string, vector array<double>")
    assert [r.record_id for r in coverage.to_embed(records, prior, "speeches", 1).collect()] == ["b"]
