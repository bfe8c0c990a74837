"""Every registered query of the subpackage over a whole small table: against its SQL, or a plain computation of its columns."""

from __future__ import annotations

import base64
import glob
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lectern.llm import packing, queries, sketch, toxicity
from lectern.llm.common import shingle_sets

SF = "/root/testdata/sf0.001"


def table(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def documents():
    return table("documents")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_against_its_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {path.rsplit('/', 1)[1].removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    want = con.sql(queries.ORACLE_SQL[name])
    columns = sorted(want.columns)
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got.select(columns).collect())) == sorted(map(key, want.select(*columns).fetchall()))


def test_op2(spark):
    pages = sorted(table("pages"), key=lambda r: r["page_id"])
    first: dict = {}
    want = []
    for r in pages:
        data = (r["html"] or "").encode()
        want.append((r["page_id"], len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if data in first else "response", first.get(data)))
        first.setdefault(data, r["page_id"])
    assert sorted(map(tuple, queries.op2_warc(spark, SF).collect())) == want


def test_op3(spark, documents):
    got = {r.doc_id: r for r in queries.op3_sketch(spark, SF).collect()}
    rows = sorted(documents, key=lambda r: r["doc_id"])
    assert len(got) == len(rows)
    code = lambda t: sketch.encode(sketch.bottom_k(shingle_sets(pa.array([t]))[0]))
    for k, r in enumerate(rows):
        t, n = r["text"] or "", rows[(k + 1) % len(rows)]["text"] or ""
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        out = got[r["doc_id"]]
        assert (out.n_chars, out.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (out.fingerprint, out.edited_fingerprint) == (code(t), code(edited))
        assert 0 <= out.near_edited <= 1 and 0 <= out.near_next <= 1


@pytest.mark.parametrize(("name", "folds", "held"), [("op4_quality", 5, 0), ("op10_toxicity", 4, 2)])
def test_classifiers(spark, documents, name, folds, held):
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, SF).collect()}
    assert set(got) == {r["doc_id"] for r in documents}
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    texts: dict = {}
    for r in documents:
        texts.setdefault(r["text"], set()).add(got[r["doc_id"]].score)
    assert all(max(s) - min(s) < 1e-12 for s in texts.values())


def test_op10_against_a_fit_of_plain_lists(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents}
    labels = {r["doc_id"]: r["toxic"] for r in table("labels") if r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    ids = sorted(labels)
    model = toxicity.train([texts[i] or "" for i in ids], np.array([labels[i] for i in ids]), float(np.mean(list(labels.values()))))
    got = {r.doc_id: r.score for r in queries.op10_toxicity(spark, SF).collect()}
    order = sorted(texts)
    assert np.allclose(model.scores(pa.array([texts[i] for i in order], pa.string())), [got[i] for i in order])


def test_op5(spark, documents):
    got = {r.doc_id: r for r in queries.op5_secrets(spark, SF).collect()}
    assert len(got) == len(documents)
    rules = [("assign", r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 12), ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 16)]
    some = 0
    for r in documents:
        found = [(m.start(), k, m.end()) for k, (_, pattern, good) in enumerate(rules) for m in re.finditer(pattern, r["text"] or "") if good(m)]
        names = [f"{rules[k][0]}:{s}:{e}" for s, k, e in sorted(found)]
        out = got[r["doc_id"]]
        assert [out.n_assign, out.n_access, out.n_hex] == [sum(f[1] == k for f in found) for k in range(3)]
        assert out.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(out.spans.split(","))
        some += bool(names)
    assert some


def test_op6(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    pieces: dict = {}
    sequences: dict = {}
    for r in queries.op6_packing(spark, SF).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for r in documents:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        at = 0
        for start, length, crc, total in sorted(pieces[r["doc_id"]]):
            assert (start, total) == (at, len(ids)) and crc == zlib.crc32(np.array(ids[at : at + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_op4_against_rules_by_hand(spark, documents):
    from pyspark.sql import functions as F

    from lectern.llm import quality_rules
    from lectern.llm.common import fold

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules = quality_rules.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), fold("doc_id", 5) != 0)
    assert rules.rules
    names = list(quality_rules.statistics(F.col("text")))
    told = {r.doc_id: r for r in docs.select("doc_id", *(c.alias(k) for k, c in quality_rules.statistics(F.col("text")).items())).collect()}
    got = {r.doc_id: r for r in queries.op4_quality(spark, SF).collect()}
    for d in documents:
        text = d["text"] or ""
        words, lines = re.findall(r"[^ \t\n\x0b\f\r]+", text), [x for x in text.split("\n") if x]
        share = lambda chars: sum(c in chars for c in text) / max(1, len(text))  # noqa: B023, E731
        plain = {
            "chars": len(text), "words": len(words), "mean_word": (len(text) - len(words)) / max(1, len(words)), "distinct_words": len(set(words)) / max(1, len(words)), "distinct_lines": len(set(lines)) / max(1, len(lines)), "line_chars": len(text) / len(lines) if lines else 0.0,
            "upper": share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": share("0123456789"), "symbols": share("#$%&*@!?|<>{}[]\\/=+_~^"), "stops": share(".,;:"),
        }
        row = told[d["doc_id"]]
        assert np.allclose([row[k] for k in names], [plain[k] for k in names])
        z = rules.intercept + sum(w for terms, w in rules.rules if all(row[c] <= v if op == "<=" else row[c] > v for c, op, v in terms))
        assert np.isclose(got[d["doc_id"]].score, 1 / (1 + np.exp(-z)))


def test_classifiers_tell_held_out_rows(spark):
    """On a larger table, labels of rows that were never learned from."""
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    for name, label, least in (("op4_quality", "quality", 0.9), ("op10_toxicity", "toxic", 0.85)):
        rows = [r for r in queries.QUERIES[name](spark, sf).collect() if r.held_out and r.doc_id in labels and labels[r.doc_id][label] is not None]
        assert len(rows) > 50
        assert np.mean([r.predicted == labels[r.doc_id][label] for r in rows]) > least
