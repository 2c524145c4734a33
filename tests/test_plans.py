"""Plan guards: properties of the physical plans that matter at cluster scale."""

import contextlib
import io

import pytest

from beatstream.plans import catalog
from beatstream.plans.catalog_io import IO_QUERIES
from conftest import SF_SMALL

# Batch queries (the I/O and stream queries write files before they return a frame).
BATCH = sorted(n for n in catalog.QUERIES if n not in IO_QUERIES)


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_scans_read_only_needed_columns(spark):
    p = plan(catalog.QUERIES["mobile_trend"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    p = plan(catalog.QUERIES["daily_spend"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in p


def test_top_n_limits_rows_before_the_shuffle(spark):
    for name in ["top_regions_and_users", "top_tracks_by_gender", "applink_by_age"]:
        p = plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert "WindowGroupLimit" in p and "Partial" in p, name


def test_recent_window_filter_reaches_the_play_scan(spark):
    # the time filter of top tracks is applied to plays before the customer lookup
    p = plan(catalog.QUERIES["top_tracks_by_gender"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in p  # customer side pruned


def test_global_top_n_is_take_ordered(spark):
    p = plan(catalog.QUERIES["trending_tags"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_nested_terms_scan_once(spark):
    df = catalog.QUERIES["top_regions_and_users"](spark, SF_SMALL)
    df.collect()
    p = plan(df)
    final = p[:p.index("== Initial Plan ==")] if "== Initial Plan ==" in p else p
    assert final.count("Scan parquet") == 1 and "ReusedExchange" in final
