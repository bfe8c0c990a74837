"""WARC, packing, mixing, the Jaccard join, top-k search and the pipeline against brute force, and their edge cases."""

from __future__ import annotations

import base64
import glob
import hashlib
import os
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lectern.llm import common, components, mixing, ngram_join, occurrence, packing, topk_nra, toxicity, warc_writer
from tests.llm.test_text_operators import ODD, shingles


def test_warc_round_trip(spark, tmp_path):
    pages = [(5, "u5", "same"), (2, "u2\r\nx", "same"), (9, None, None), (8, "u", ""), (7, "u7", "é\U0001f600\r\n\r\nWARC/1.1"), (2, "u2b", "other"), (2, "u2c", "other"), (None, "n", "null id"), (11, "u", "x" * 200_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    for folder in ("a", "b"):
        warc_writer.write(df.repartition(3), f"file://{tmp_path}/{folder}", roll_bytes=400, rows_per_shard=3)
    files = [sorted(glob.glob(f"{tmp_path}/{x}/*.warc.gz")) for x in "ab"]
    assert len(files[0]) > 3 and [open(f, "rb").read() for f in files[0]] == [open(f, "rb").read() for f in files[1]]
    assert not glob.glob(f"{tmp_path}/a/_tmp*")
    got = warc_writer.read(spark, f"file://{tmp_path}/a").collect()
    assert len(got) == len(pages) and all(r.verified for r in got)
    order = sorted(pages, key=lambda p: (p[0] is not None, p[0] or 0, p[1] or ""))
    first: dict = {}
    want = []
    for page_id, _, html in order:
        data = (html or "").encode()
        kind = ("revisit", first[data]) if data in first else ("response", None)
        first.setdefault(data, page_id)
        want.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), *kind))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    assert {bytes(r.payload) for r in got if r.payload is not None} == set(first)


def test_warc_least_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    warc_writer.write(df, f"file://{tmp_path}/m", least=3)
    assert sorted((r.page_id, r.record_type) for r in warc_writer.read(spark, f"file://{tmp_path}/m").collect()) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]
    (tmp_path / "e").mkdir()
    assert warc_writer.write(df.limit(0), f"file://{tmp_path}/e").count() == 0
    assert warc_writer.read(spark, f"file://{tmp_path}/e").count() == 0


def test_warc_repeated_and_damaged_files(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"page {i}") for i in range(40)], "page_id long, url string, html string")
    path = f"file://{tmp_path}/w"
    for _ in range(2):  # files of a task that ran before are replaced
        warc_writer.write(df, path, rows_per_shard=10)
    files = sorted(glob.glob(f"{tmp_path}/w/*.warc.gz"))
    assert len(files) > 1 and warc_writer.read(spark, path).count() == 40
    whole = open(files[0], "rb").read()
    for damaged in (whole[:-1], whole[:-9] + bytes(9), whole * 2):
        with open(files[0], "wb") as f:
            f.write(damaged)
        with pytest.raises(Exception, match="is not the file that the manifest names"):
            warc_writer.read(spark, path).count()


def test_packing_ids_pieces_and_padding(spark):
    from tokenizers import Tokenizer

    rng = np.random.default_rng(0)
    words = ["Thing", "señal", "don't", "x1y22", "...", "<|endoftext|>", "ΣΑΣ", "naïve,", "end.", "\U0001f600", "á", "ﬁ"]
    texts = [" ".join(rng.choice(words, n)) for n in (1, 5, 50, 300, 900, 3000, 9000)] + ODD + ["dup", "dup"]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)] + [(None, "no id", 7)], "doc_id long, text string, length int")
    pieces = packing.pack(docs.coalesce(1), buffer_tokens=6000, group_size=2).collect()
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    by_doc: dict = {}
    by_sequence: dict = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length, bytes(p.ids), p.doc_tokens))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, t in enumerate([*texts, "no id"]):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        at = 0
        for start, length, raw, total in sorted(by_doc[i if i < len(texts) else None]):
            assert start == at and total == len(ids) and np.frombuffer(raw, "<u4").tolist() == ids[at : at + length]
            at += length
        assert at == len(ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding < 4096
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_refuses_other_tokenizers(tmp_path):
    import json

    from tokenizers import Tokenizer, models, pre_tokenizers

    joins = Tokenizer(models.WordLevel({"<unk>": 0, "a b": 1, "a": 2, "b": 3}, "<unk>"))
    large = Tokenizer(models.WordLevel({f"w{i}": i for i in range(70_000)}, "w0"))
    large.pre_tokenizer = pre_tokenizers.Whitespace()
    for name, tokenizer, why in (("joins", joins, "across white space"), ("large", large, "65,535")):
        tokenizer.save(f"{tmp_path}/{name}.json")
        with pytest.raises(ValueError, match=why):
            packing.WordTokenizer(f"{tmp_path}/{name}.json")
    assert json.load(open(f"{tmp_path}/joins.json"))["model"]


def test_packing_groups_are_balanced():
    packer = packing.Packer(group_size=4)
    rng = np.random.default_rng(1)
    for i in range(3000):
        packer.add(i, np.zeros(int(rng.integers(1, 3000)), np.uint16))
    packer.finish()
    cost: dict = {}
    for _, _, size, _, _, _, _, tier, group in packer.out:
        cost.setdefault(tier, {}).setdefault(group, []).append(size**2)
    whole = [sum(v) for v in list(cost[4096].values())[:8]]
    assert max(whole) < 1.5 * min(whole)


def test_mixing_against_numpy(spark):
    rng = np.random.default_rng(2)
    rows = [(i, f"s{min(int(rng.exponential(1.5)), 4)}", str(rng.choice(["en", "de"])), "word " * int(rng.integers(1, 60)), 3) for i in range(600)]
    rows += [(600, None, None, None, 3), (None, "s0", "en", "", 3), (601, "s0", "en", "same", 3), (601, "s0", "en", "same", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string, tokens int")
    out = mixing.mix(docs, {"lang": {"de": 0.5}}, rounds=12).collect()
    assert len(out) == len(rows)
    cells: dict = {}
    for r in out:
        cells.setdefault((r.source, r.lang, r.topic), [0.0, r.ratio])[0] += r.tokens
    keys = list(cells)
    tokens = np.array([cells[k][0] for k in keys])
    total, w = tokens.sum(), tokens.copy()
    goals = []
    for m in range(3):
        values = list({k[m] for k in keys})
        sums = np.array([tokens[[k[m] == v for k in keys]].sum() for v in values]) ** mixing.TEMPER
        if m == 1:
            named = np.array([0.5 if v == "de" else 0.0 for v in values])
            share = np.where(named > 0, named, 0.5 * sums / sums[named == 0].sum())
        else:
            share = sums / sums.sum()
        goals.append(dict(zip(values, share, strict=True)))
    for _ in range(12):
        for m in range(3):
            s: dict = {}
            for k, x in zip(keys, w, strict=True):
                s[k[m]] = s.get(k[m], 0) + x
            w = np.array([x * goals[m][k[m]] * total / s[k[m]] for k, x in zip(keys, w, strict=True)])
    assert np.allclose([cells[k][1] for k in keys], w / tokens, rtol=1e-6)
    most = max(r.ratio for r in out)
    assert all(abs(r.probability - max(mixing.FLOOR, r.ratio / most)) < 1e-9 for r in out)
    assert len({r.kept for r in out if r.doc_id == 601}) == 1
    kept = sum(r.kept for r in out)
    expected = sum(r.probability for r in out)
    assert abs(kept - expected) < 5 * np.sqrt(expected) + 5
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_keeps_its_budget_beside_a_rare_source(spark):
    rows = [(i, f"s{i % 2}", "en", "word " * (20 + i % 30)) for i in range(400)]
    one = (400, "rare", "en", "word " * 10)
    for docs in (rows, [*rows, one]):
        out = mixing.mix(spark.createDataFrame(docs, "doc_id long, source string, lang string, text string"), budget=0.6).collect()
        total, expected = sum(r.tokens for r in out), sum(r.tokens * r.probability for r in out)
        assert abs(expected / total - 0.6) < 1e-9
        assert max(r.probability for r in out) <= 1.0
    assert {r.probability for r in out if r.source == "rare"} == {1.0}
    below = [r for r in out if r.probability < 1.0]
    assert max(r.probability / r.ratio for r in below) - min(r.probability / r.ratio for r in below) < 1e-9
    everything = mixing.mix(spark.createDataFrame([*rows, one], "doc_id long, source string, lang string, text string"), budget=1.0).collect()
    assert all(r.probability > 1 - 1e-9 for r in everything)
    assert mixing.mix(spark.createDataFrame([], "doc_id long, source string, lang string, text string"), budget=0.6).count() == 0


def test_mixing_meets_its_marginals(spark):
    rng = np.random.default_rng(31)
    rows = [(i, f"s{min(int(rng.exponential(1.2)), 3)}", str(rng.choice(["en", "de", "fr"], p=[0.7, 0.2, 0.1])), "word " * int(rng.integers(20, 90))) for i in range(3000)]
    docs = spark.createDataFrame([*rows, (3000, None, None, None)], "doc_id long, source string, lang string, text string")
    goals = {"lang": {"en": 0.5, "de": 0.3}}
    met = mixing.marginals(mixing.mix(docs, goals, rounds=20, budget=0.3), goals).collect()
    assert all(abs(r.target - r.reached) < 2e-3 for r in met) and {r.marginal for r in met} == set(mixing.MARGINALS)
    assert abs(next(r.reached for r in met if r.value == "en") - 0.5) < 2e-3


def test_mixing_budget_against_sql(spark):
    import duckdb

    from lectern.llm import queries

    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = duckdb.sql(queries.ORACLE_SQL["op7_mixing_budget"]).fetchall()
    assert sorted(map(tuple, queries.op7_mixing_budget(spark, sf).collect())) == sorted(want)


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    parent: dict = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= 80 * len(sets[a] | sets[b]):
                x, y = root(rows[a][0]), root(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i)) for (i, _), s in zip(rows, sets, strict=True))


@pytest.mark.parametrize("hot", [0, 2, 32])
def test_jaccard_classes_against_brute_force(spark, hot):
    rng = np.random.default_rng(hot)
    words = [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choice(words, 30))
    rows = []
    for g in range(12):
        base = list(rng.choice(words, int(rng.integers(3, 120))))
        for c in range(9):
            w = list(base)
            for k in rng.choice(len(w), int(rng.integers(0, 1 + len(w) // 25)), replace=False):
                w[k] = f"e{rng.integers(1000)}"
            if c == 3:
                w += passage.split()
            rows.append((int(rng.integers(10_000)) * 100 + g * 9 + c, " ".join(w)))
    rows += [(10**7 + i, t) for i, t in enumerate(ODD)] + [(10**7 + 50, rows[0][1]), (10**7 + 51, rows[0][1].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash"))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df.repartition(4), hot=hot).collect())
    assert got == brute_components(rows)


def test_jaccard_beyond_the_largest_bitmap(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LARGEST_BITS", 10)
    test_jaccard_beyond_the_bitmaps(spark, monkeypatch)


def test_jaccard_bitmap_grows_with_the_shared_shingles(spark, monkeypatch):
    """Beyond the spare bits of a bitmap shared shingles are still told apart, so texts without near copies send next to nothing."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choice(words, 200)) for _ in range(60)]
    copies = [t + " one more" for t in texts[:20]]  # about 4,000 shingles in two documents
    df = spark.createDataFrame(list(enumerate(texts + copies)), "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "MOST_BITS", 12)
    lists = ngram_join.long_lists(df, df.count(), ngram_join.HOT, 5)
    assert lists[3]  # all of them are in it
    rows = {r.doc_id: r for r in ngram_join.prepared(df, lists, 5, 80).collect()}
    assert all(len(rows[k].head) == 0 and rows[k].skip > 0 for k in range(20, 60))
    assert all(len(rows[k].head) > 0 for k in range(20))
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_classes(df).collect()}
    assert got == {k: k for k in range(60)} | {60 + k: k for k in range(20)}


def test_bitmap_holds_every_key_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PIECE_BITS", 8)
    keys = spark.range(3000).withColumnRenamed("id", "key")
    for most, bits in ((12, 13), (17, 17)):  # beyond the spare bits, and with them
        monkeypatch.setattr(ngram_join, "MOST_BITS", most)
        found = ngram_join.bitmap(keys, "key")
        assert found.dtype == np.int64 and len(found) << 6 == 1 << bits
        h = ngram_join.spark_hash(np.arange(3000)) >> np.uint64(64 - bits)
        want = np.zeros(1 << bits, np.uint8)
        want[h.astype(np.int64)] = 1
        assert np.array_equal(np.unpackbits(found.view(np.uint8), bitorder="little"), want)


def test_jaccard_beyond_the_bitmaps(spark, monkeypatch):
    """More shared shingles than a bitmap tells apart: lists of single members stay, links are the same."""
    rng = np.random.default_rng(21)
    words = [f"w{i}" for i in range(50)]
    rows = []
    for g in range(30):
        base = list(rng.choice(words, 60))
        for c in range(4):
            w = list(base)
            w[int(rng.integers(60))] = f"e{g}_{c}"
            rows.append((g * 4 + c, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "MOST_BITS", 12)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df, hot=2).collect())
    assert got == brute_components(rows)


def test_jaccard_edge_rows(spark):
    same = "a b c d e f g"
    rows = [(3, same), (3, "h i j k l m n"), (5, "h i j k l m n"), (1, same), (None, same), (7, None), (8, ""), (3, same)]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("1", 3, 1), ("3", 3, 1), ("3", 3, 1), ("3", 3, 1), ("5", 3, 1), ("7", 0, 7), ("8", 0, 8), ("None", 3, None)]
    assert ngram_join.jaccard_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_jaccard_of_a_large_group_of_near_copies(spark):
    """2000 documents, most at a similarity of some 0.6, of which a few link."""
    rng = np.random.default_rng(11)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(2000):
        w = list(base)
        for k in rng.choice(120, 3, replace=False):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    for i in range(2000, 2040):  # one edit more than another document has
        w = rows[i * 7 % 2000][1].split()
        w[int(rng.integers(5, 115))] = f"y{i}"
        rows.append((i, " ".join(w)))
    order = {i: {t: None for t in shingles(x)} for i, x in rows}
    lists: dict = {}
    for i, s in order.items():
        for t in s:
            lists.setdefault(t, []).append(i)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    many = np.zeros(len(rows), int)
    for i, s in order.items():
        many[:] = 0
        for t in s:
            many[lists[t]] += 1
        sizes = np.array([len(order[j]) for j in range(len(rows))])
        for j in np.flatnonzero(100 * many >= 80 * (len(s) + sizes - many)):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    want = sorted((i, len(order[i]), root(i)) for i in order)
    assert 40 < len({c for _, _, c in want}) < 2040
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(df, block_shingles=30_000).collect())
    assert got == want


def test_occurrence_search_against_counting():
    rng = np.random.default_rng(12)
    sets = [np.unique(rng.integers(0, 80, rng.integers(1, 60)).astype(np.uint64)) for _ in range(150)] + [np.zeros(0, np.uint64)]
    block = occurrence.Block(sets)
    every = np.ones(len(sets), bool)
    for percent in (30, 60, 80, 100):
        for s in sets:
            want = [j for j, t in enumerate(sets) if len(s) and (o := len(np.intersect1d(s, t))) and 100 * o >= percent * (len(s) + len(t) - o)]
            assert block.search(s, every, percent).tolist() == want
        groups = np.arange(len(sets))
        links = occurrence.spanning_links(list(groups), None, groups, sets, percent)
        assert len(links) == len({tuple(x) for x in links}) < len(sets)
    assert occurrence.spanning_links([], None, np.zeros(0, int), [], 80) == []


def test_spark_hash(spark):
    values = np.array([0, 1, 2**40 + 7, 2**62 + 11], np.uint64)
    got = [r.h for r in spark.createDataFrame([(int(v),) for v in values], "v long").select(F.xxhash64("v").alias("h")).collect()]
    assert ngram_join.spark_hash(values).view(np.int64).tolist() == got


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 180)] + [(500, 400)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 180)}, 500: 400}
    odd = spark.createDataFrame([(1, None), (None, 2), (3, 3), (5, 4), (4, 5), (5, 4)], "a long, b long")
    assert [tuple(r) for r in components.components(odd).collect()] == [(5, 4)] and components.components(odd.limit(0)).count() == 0


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 8]) for i in range(300)]
    rows += [(400, None), (500, [None] * 6), (600, [float("nan")] * 6), (700, [float("inf")] + [0.0] * 5), (800, []), (900, [1.0, 2.0]), (1000, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit(0))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk_nra.top_k(df, F.col("vec_id") % 100 == 0, chunk=64, query_block=2).collect())
    good = {i: np.pad(np.floor(1024 * np.array(x)).astype(int), (0, 6 - len(x))) for i, x in rows if x is not None and all(v is not None and np.isfinite(v) for v in x)}
    want = []
    for q in good:
        if q % 100 == 0:
            best = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:10]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert topk_nra.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    few = topk_nra.top_k(df.filter("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert len(few) == 2


def test_bounds_stop_early_and_stay_exact():
    rng = np.random.default_rng(7)
    X = rng.integers(-400, 400, (5000, 64))
    lists = topk_nra.Lists(np.arange(5000), X)
    for q in [*X[:20], np.zeros(64, int), np.eye(64, dtype=int)[3]]:
        s = X @ q
        assert lists.search(q, -1, 10, []) == sorted((-int(v), i) for i, v in enumerate(s))[:10]
    assert lists.finished < 0.1 * 22 * 5000 and lists.read < 0.95 * 22 * 5000 * 64


def test_top_k_of_large_components_and_odd_ids(spark):
    rows = [(0, [2.0**52, 1.0]), (1, [2.0**52, 3.0]), (2, [-(2.0**52), 0.0]), (3, [1.0, 1.0]), (4, [1e300, 0.0]), (None, [1.0, 1.0]), (5, [2.0**14, 2.0**14])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in topk_nra.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    clip = lambda v: max(min(v, 2**63 - 1), -(2**63))
    vectors = {i: [clip(int(np.floor(1024 * x))) if abs(x) < 1e17 else 2**63 - 1 for x in v] for i, v in rows if i is not None}
    want = sorted((-clip(sum(a * b for a, b in zip(vectors[0], v, strict=True))), i) for i, v in vectors.items() if i)
    assert got == [(i, -s) for s, i in want]
    one = topk_nra.top_k(df.filter("vec_id in (3, 5)"), F.col("vec_id") == 3).collect()
    assert [(r.vec_id, r.score) for r in one] == [(5, 2 * 1024 * 1024 * 2**14)]


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf)
    assert clean.columns == docs.columns and 0.5 * docs.count() < clean.count() <= docs.count()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    texts = {i: t or "" for i, t in rows}
    known = sorted(i for i in labels if i in texts)
    model = toxicity.train([texts[i] for i in known], np.array([labels[i] for i in known]), float(np.mean(list(labels.values()))))
    scores = model.scores(pa.array([t or "" for _, t in rows]))
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for (i, _), s in zip(rows, scores, strict=True) if s < toxicity.THRESHOLD)
    kept = stages["ngram_join"](spark, docs, sf)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute_components(rows)})
    odd = spark.createDataFrame([(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "password = 'abcdefghijkl'", "en", "s", 3)], docs.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert stage(spark, odd.limit(0), sf).count() == 0
    masked = {r.doc_id: r for r in stages["secrets"](spark, odd, sf).collect()}
    assert masked[2].text == "[assign]'" and masked[2].n_chars == 9
    assert sum(r.doc_id == 1 for r in stages["ngram_join"](spark, odd, sf).collect()) == 1
    total = sum(zlib.crc32(bytes(r.ids)) >= 0 for r in stages["packing"](spark, odd, sf).collect())
    assert total == 5


def shuffle_bytes(spark) -> int:
    """Bytes of the shuffle files in the session's folders, once their number stays the same for a second."""
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    seen: list[int] = []
    while len(seen) < 3 or len(set(seen[-3:])) > 1:
        files = [f for d in manager.localDirs() for f in glob.glob(f"{d.getPath()}/*/shuffle_*")]
        seen.append(sum(os.path.getsize(f) for f in files if os.path.exists(f)))
        time.sleep(0.5)
    return seen[-1]


def test_near_copies_go_without_shuffled_texts_or_files_left(spark, tmp_path):
    """What the search for near copies shuffles goes as soon as it is used, and the result does not shuffle texts."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(9000)]
    texts = [" ".join(rng.choice(words, 1500)) for _ in range(150)]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts + [t + " one more" for t in texts[:50]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"file://{tmp_path}/docs")
    docs = spark.read.parquet(f"file://{tmp_path}/docs")
    before = shuffle_bytes(spark)
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    out.write.parquet(f"file://{tmp_path}/out")
    assert shuffle_bytes(spark) - before < 100_000 < 0.1 * sum(len(r[1]) for r in rows)
    assert sorted(r.doc_id for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == list(range(150))
    assert spark.conf.get(common.SHUFFLE_CLEANUP, None) is None


def test_near_copies_where_the_bitmaps_take_ids_for_others(spark, monkeypatch):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words, 20)) for _ in range(3000)]
    rows = [(int(k), texts[int(i)], "en", "s", 0) for k, i in enumerate(rng.integers(0, 3000, 6000))]
    rows += [(k, texts[k % 3000] + " other", "en", s, 1) for k in range(0, 6000, 50) for s in "ba"] + [(10_000, None, None, None, None), (10_000, "", "en", "s", 0), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, n_chars long").repartition(4)
    monkeypatch.setattr(ngram_join, "MOST_BITS", 12)
    monkeypatch.setattr(ngram_join, "LARGEST_BITS", 12)
    monkeypatch.setattr(ngram_join, "LOAD", 1e9)
    first = ngram_join.jaccard_classes(docs).filter("component_id = doc_id").select("doc_id").distinct()
    stay = {r.doc_id for r in first.collect()}
    best: dict = {}
    for r in rows:
        if r[0] in stay and (r[0] not in best or (r[1] or "", r[1] is not None, r[3] or "") < (best[r[0]][1] or "", best[r[0]][1] is not None, best[r[0]][3] or "")):
            best[r[0]] = r
    got = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [*best.values(), rows[-1]]))


def test_gaps_are_packed_in_two_bytes_where_few_are_long():
    rng = np.random.default_rng(10)
    for n, least, most in ((1, 2, 4), (3900, 2, 2), (244, 2, 2.2), (30, 2, 4)):  # keys of a range, bytes a key; 244: as for 3 million documents
        for _ in range(20):
            keys = np.unique(rng.integers(0, 1 << ngram_join.KEY_BITS, n)).astype(np.uint32)
            packed = ngram_join.packed_gaps(keys)
            assert least * len(keys) <= len(packed) <= most * len(keys)
            assert np.array_equal(ngram_join.unpacked_gaps(packed, len(keys)), keys)
    for keys in ([0], [65534], [65535], [65536], [65535, 131070, 131071], [0, 1, 2, 3, 4_000_000], [0, 4_000_000], [65534, 131069, 131070]):
        keys = np.array(keys, np.uint32)
        assert np.array_equal(ngram_join.unpacked_gaps(ngram_join.packed_gaps(keys), len(keys)), keys)
