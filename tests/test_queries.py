"""Every registered core query against its SQL on the smallest tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from lectern import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 5) if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in queries.ORACLE_SQL:
        want = duck.sql(queries.ORACLE_SQL[name])
        assert sorted(want.columns) == columns
        at = [want.columns.index(c) for c in columns]
        assert got == Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())
    else:
        assert got


def test_fold_covers_whole_texts(spark, tmp_path):
    import hashlib

    long = "a" * 400 + "ț" + "e\u0301\ufffd"
    spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = dict(map(tuple, queries.QUERIES["t1_fold_whole"](spark, str(tmp_path)).collect()))
    assert got == {1: hashlib.sha256(("a" * 400 + "te").encode()).hexdigest(), 2: None}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT doc_id, text FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert dict(con.sql(queries.ORACLE_SQL["t1_fold_whole"]).fetchall()) == got


def test_lookups_cover_all_rows(spark, duck, tmp_path):
    lines = queries.QUERIES["j1_report_to_session_all"](spark, SF)
    assert lines.count() == duck.sql("SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate FROM lineitem)").fetchall()[0][0]
    rows = [(1, "A", "x y", "b"), (900, "A", "far y", "b")]
    spark.createDataFrame(rows, "p_partkey long, p_type string, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    aliases = sorted({"A", "A x", "A far"})
    got = dict(map(tuple, queries.QUERIES["j9_longest_prefix_all"](spark, str(tmp_path)).collect()))
    assert got == {"A x y b": aliases.index("A x") + 1, "A far y b": aliases.index("A far") + 1}
