"""Session helpers and plan properties claimed in the README."""

import __spark_entry__ as E
from triad.session import checkpoint_dir, scratch_path
from triad.sources.testviews import table

from .conftest import SMALL


def test_checkpoint_dir_is_set_once(spark):
    d = checkpoint_dir(spark)
    assert d and checkpoint_dir(spark) == d
    assert scratch_path(spark, "x").startswith(d.rstrip("/") + "/triad-x-")


def test_table_reads_add_no_shuffle(spark):
    assert "Exchange" not in _physical(table(spark, SMALL, "documents"))


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_per_query_is_group_limited(spark):
    assert "WindowGroupLimit" in _physical(E.queries()["bm25"](spark, SMALL))


def test_outliers_without_genre_window(spark):
    plan = _physical(E.queries()["tempo_outliers"](spark, SMALL))
    assert "Window " not in plan and "WindowGroupLimit" not in plan
