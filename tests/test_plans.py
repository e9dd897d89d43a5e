"""Plan-shape checks: the scale properties the design relies on, for every query."""

import contextlib
import io

import pytest

from cityweave.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


# Queries that find nearest cities: they read the dictionary when they are built, and write the keyed search's result.
SEARCHES = ("nearest_city", "window_events", "_city", "cities", "travel", "profile", "zone", "recommendations")


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(fn(spark, SF_SMALL)) for name, fn in QUERIES.items()}


def test_no_cross_joins_and_no_python_udfs(plans):
    for name, plan in plans.items():
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert node not in plan, (name, node)


def test_event_scans_read_only_used_columns(plans):
    for name, plan in plans.items():
        for section in plan.split("Scan parquet")[1:]:
            block = section.split("\n\n")[0]
            if "events.parquet" not in block:
                continue
            schema = block.split("ReadSchema: ")[1].splitlines()[0]
            assert "props" not in schema and "value" not in schema, (name, schema)


def test_building_a_query_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name, fn in QUERIES.items():
        if any(x in name for x in SEARCHES):  # the dictionary's index and the keyed search are built with the query
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        fn(spark, SF_SMALL)
        # reading a Parquet footer is a job of Spark's own; nothing else may run
        assert len(tracker.getJobIdsForGroup(f"build-{name}")) <= 4, name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
