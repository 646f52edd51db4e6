"""Plan checks: the shapes that make the queries scale."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tidemark.plans.catalog import BATCH_QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_flagship_has_group_limit_before_the_exchange(spark):
    plan = _plan(entry.entry(spark))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    # the partial limit sits below the shuffle on the group key
    partial = plan.index("Partial")
    assert plan.index("Exchange hashpartitioning(gender") < partial


def test_flagship_scans_are_pruned_and_filtered(spark):
    df = entry.entry(spark)
    df.explain("formatted")  # must not fail
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(c_custkey)]" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text
    assert "c_nationkey" not in text          # unused column never read


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_no_python_in_batch_plans(spark, name):
    plan = _plan(BATCH_QUERIES[name](spark, SF_SMALL))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_current_state_uses_partial_aggregation(spark):
    plan = _plan(BATCH_QUERIES["cdc_current_state"](spark, SF_SMALL))
    assert "partial_max_by" in plan
    assert "Window" not in plan               # no window over the (possibly hot) key


def test_full_ranking_is_not_a_single_group_window(spark):
    plan = _plan(BATCH_QUERIES["row_number_by_group"](spark, SF_SMALL))
    assert "Window" not in plan.split("Scan ExistingRDD")[0]


def test_lines_and_envelopes_are_parsed_once(spark):
    """No predicate or projection repeats the parse of a row."""
    plan = BATCH_QUERIES["cdc_parse_envelope"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    for name in ("parse_id_int", "parse_id_text", "parse_rejects"):
        plan = _plan(BATCH_QUERIES[name](spark, SF_SMALL))
        assert plan.count("split(") == 1, name
        assert plan.count("RLIKE") <= (2 if name == "parse_id_int" else 1), name
