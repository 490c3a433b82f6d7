"""Plan properties that must hold at any scale: no Cartesian products, no
unconditioned nested-loop joins, column pruning at the scan, partial
aggregation / window group limits where a hot key could otherwise land in
one task."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from inkwell.plans import catalog

from .conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cartesian_and_pruned_scans(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    for m in re.finditer(r"BroadcastNestedLoopJoin (\w+) (\w+) \((\d+)\)", plan):
        # every nested-loop join must carry a join condition
        section = plan[plan.index(f"({m.group(3)}) BroadcastNestedLoopJoin"):]
        assert "Join condition: None" not in section.split("\n\n")[0], name
    # column pruning: no scan reads every column of documents/pages/lineitem for a narrow query
    for schema in re.findall(r"ReadSchema: (struct<.*>)", plan):
        assert schema.count(":") <= 11


def test_top_k_per_key_is_limited_before_the_shuffle(spark):
    plan = _plan(E.queries()["last_two_closes"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    plan = _plan(E.queries()["quote_fallback"](spark, SF_SMALL))
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["last_two_closes", "macro_quotes", "macro_report", "quote_fallback"])
def test_only_recent_prices_are_read(spark, name):
    assert re.search(r"PushedFilters: \[[^\n]*GreaterThanOrEqual\(ts", _plan(E.queries()[name](spark, SF_SMALL))) or \
        re.search(r"DataFilters: [^\n]*ts#\d+ >= (Reused)?[sS]ubquery", E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString())


def test_hot_key_reductions_are_partial_aggregates(spark):
    for name, fn in [("latest_per_label", "partial_min_by"), ("last_two_closes", "partial_max_by"),
                     ("rulebook_candidates", "partial_count"), ("playback_sessions", "merge_min")]:
        assert fn in _plan(E.queries()[name](spark, SF_SMALL)), name


def test_phrase_hits_is_a_projection(spark):
    plan = _plan(E.queries()["phrase_hits"](spark, SF_SMALL))
    # no join and no keyed shuffle
    assert "Join" not in plan and "hashpartitioning" not in plan


def test_scans_are_dealt_out_only_where_the_session_says_so(spark):
    from inkwell.plans.tables import SCAN_PARTITIONS, load

    plain = spark.read.parquet(f"{SF_SMALL}/documents.parquet").rdd.getNumPartitions()
    assert load(spark, SF_SMALL, "documents").rdd.getNumPartitions() == plain
    spark.conf.set(SCAN_PARTITIONS, "5")
    try:
        assert load(spark, SF_SMALL, "documents").rdd.getNumPartitions() == 5
        assert load(spark, SF_SMALL, "orders").rdd.getNumPartitions() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").rdd.getNumPartitions()
    finally:
        spark.conf.unset(SCAN_PARTITIONS)
