"""Plan assertions: the physical plans are the ones we want at scale."""

import pytest

import __spark_entry__ as entry
from reelcat.operators import planning
from reelcat.operators.dedup import dedup_videos
from reelcat.sources import derived

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_uses_partial_window_group_limit(spark):
    p = plan_of(dedup_videos(derived.videos(spark, SF)))
    assert "WindowGroupLimit" in p


def test_substring_skip_is_an_equi_join(spark):
    df = planning.skip_substring(planning.anti_held(
        __import__("reelcat.operators.manifest", fromlist=["x"]).manifest_rows(derived.videos(spark, SF)),
        derived.inventory(spark, SF)), derived.inventory(spark, SF))
    p = plan_of(df)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_python_udfs_or_pair_products(spark, name):
    df = entry.queries()[name](spark, SF)
    p = plan_of(df)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p
    if name not in ("select_terms_join", "select_terms_like_broadcast"):  # the size-checked broadcast term table is the one nested loop
        assert "BroadcastNestedLoopJoin" not in p
