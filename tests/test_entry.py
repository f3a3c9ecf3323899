"""Driver contract, oracle agreement on the smallest tables, and plan shapes."""

import duckdb
import pytest

import __spark_entry__ as E
from triad.plans import registry
from triad.sources.testviews import TABLES

from .conftest import SMALL

ROWS_ONLY = {"communities", "louvain_sizes", "louvain_top_genres", "louvain_quality"}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["artist", "track_count", "avg_popularity"]


def test_every_query_has_oracle_or_is_rows_only():
    q, o = registry.queries(), registry.oracle_sql()
    assert set(q) - set(o) == ROWS_ONLY
    assert set(o) <= set(q)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.mark.parametrize("name", ["top_artists", "tempo_outliers", "recommend", "supernodes",
                                  "sentence_chunks", "bm25", "hybrid_search", "co_rated_edges", "weighted_path_far", "ann_knn", "chunk_search", "load_text_rows"])
def test_oracle_agrees_on_smallest_tables(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    mine = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = duck.sql(E.oracle_sql()[name])
    idx = [cur.columns.index(c) for c in cols]
    theirs = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert mine == theirs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["recommend", "bm25", "hybrid_search", "similar_edges", "genre_quality"])
def test_no_cartesian_products(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["party_tracks"](spark, SMALL))
    assert "TakeOrderedAndProject" in plan
    schema = [line for line in plan.splitlines() if "ReadSchema" in line and "lineitem" in line.lower()]
    for line in schema:
        assert "l_shipdate" not in line and "l_linestatus" not in line
