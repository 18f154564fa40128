"""Plan properties of the registered queries (executed final plans at the
small scale): no Python evaluation outside the stateful batcher, no
Cartesian or nested-loop joins, pruned text scans."""

import pytest

from signalyard.plans.jobs import QUERIES
from tools.plan_report import summarise

from .conftest import SF_SMALL

BATCH_QUERIES = [n for n in QUERIES if n not in
                 {"window_join_stream", "stream_batches", "refresh_news_counts", "refresh_weather", "refresh_open",
                  "lake_roundtrip", "envelope_to_lake", "stream_predictions", "envelope_quarantine", "lake_restart",
                  "refresh_replace", "refresh_replace_weather", "window_join_parts", "late_rows"}]


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan()
    if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        p = p.executedPlan()
    return summarise(p.toString())


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_python_no_cartesian(spark, name):
    s = _plan(spark, name)
    assert not s["python"]
    assert "CartesianProduct" not in s["joins"] and "BroadcastNestedLoopJoin" not in s["joins"]


@pytest.mark.parametrize("name,table,absent", [
    ("news_daily_counts", "documents", "text"),
    ("clean_text_intended", "documents", "n_chars"),
    ("sentiment_label", "documents", "source"),
    ("page_paragraphs", "pages", "url"),
    ("weather_daily", "events", "props"),
])
def test_scans_are_pruned(spark, name, table, absent):
    scans = [s for s in _plan(spark, name)["scans"] if s[0] == table]
    assert scans and all(absent not in schema for _, schema, _ in scans)
