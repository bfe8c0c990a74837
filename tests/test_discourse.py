"""Flattened discourse codings, on payloads of our own."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from lectern.plans import discourse


def test_flattened_and_evidence(spark):
    payload = {
        "hawkins": {"score": 2, "framework_confidence": 1, "framework_version": "", "markers": [{"kind": "elite", "evidence": {"text": "elita coruptă"}}, {"value": 3}, {"kind": "people", "evidence": {"text": "Poporul  SUVERAN"}}, {"kind": "elite", "evidence": {"text": "nu e aici"}}]},
        "voice": {"classifications": [{"voice": "quoted"}, {"voice": "first_person"}, {"voice": "first_person"}, {"voice": "quoted"}, {"x": 1}]},
        "dqi": {"level_of_justification": 2, "content_of_justification": "common_good", "markers": [{"kind": "respect", "value": 1}]},
        "text_fingerprint": "abc",
    }
    rows = [("a", "Despre elita coruptă și poporul suveran.", json.dumps(payload)), ("b", "t", "{}"), ("c", "t", None)]
    df = spark.createDataFrame(rows, "record_id string, text string, payload string")
    got = {r.record_id: r for r in discourse.flattened(df).collect()}
    d = got["a"].discourse
    assert (d.hawkins.score, d.hawkins.marker_count, d.hawkins.marker_kinds, len(d.hawkins.markers), d.hawkins.framework_version) == (2, 4, ["elite", "people"], 3, None)
    assert (d.voice.dominant_voice, d.voice.voices_seen, d.vparty) == ("quoted", ["quoted", "first_person"], None)
    assert (d.dqi.level_of_justification, d.dqi.content_of_justification, d.dqi.markers[0].value) == (2, "common_good", "1")
    assert (got["a"].discourse_producer, got["a"].discourse_text_fingerprint) == ("flash-lite", "abc")
    assert got["b"].discourse.hawkins is None and got["b"].discourse_producer is None and got["c"].discourse.voice is None
    found = discourse.evidence(discourse.flattened(df), "record_id", "text", F.col("discourse.hawkins.markers"))
    places = {r.evidence: r.char_range for r in found.collect()}
    text = rows[0][1]
    assert text[slice(*places["elita coruptă"])] == "elita coruptă" and text[slice(*places["Poporul  SUVERAN"])] == "poporul suveran" and places["nu e aici"] is None
    assert [tuple(r) for r in discourse.missing_evidence(found, "record_id").collect()] == [("a", ["nu e aici"])]
