import os

import pytest

import __spark_entry__ as E
from sylva.plans.queries import QUERIES as Q
from sylva.streaming import read_clicks_stream, start_toggle_query
from sylva.operators import labels
from tests.conftest import SF001

# queries whose plans must not contain a product of two inputs
NO_PRODUCT = ["ok_pt_pairs", "ok_pt_pairs_limited", "other_solutions", "train_val_split", "flatten_corpus",
              "sample_per_problem", "toggled_lines", "text_lines", "duplicate_keys", "problem_counts"]


@pytest.mark.parametrize("name", NO_PRODUCT)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_query_has_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {n for n in q if n in Q}
    assert own - set(o) == {"html_nodes", "html_branches", "html_terminal_values", "vector_clusters", "top_clusters"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["problem_id", "user_id", "ok_id", "pt_id", "line"]
    assert df.count() > 0


def test_click_stream_matches_batch(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "clicks")
    clicks = spark.createDataFrame(
        [("p", "u1", 3, None), ("p", "u1", 3, None), ("p", "u1", 4, None), ("p", "u2", 1, None)],
        "problem_id string, user_id string, line int, ts timestamp_ntz")
    clicks.write.parquet(src)
    q = start_toggle_query(read_clicks_stream(spark, src), os.path.join(tmpdir_fresh, "ckpt"),
                           sink="memory", query_name="toggles_test", trigger_once=True)
    q.awaitTermination(120)
    got = {(r.user_id, r.line) for r in spark.sql("SELECT * FROM toggles_test WHERE selected").collect()}
    want = {(r.user_id, r.line) for r in labels.toggled_lines(clicks).collect()}
    assert got == want == {("u1", 4), ("u2", 1)}


@pytest.mark.parametrize("name", ["train_val_split", "sample_per_problem", "flatten_corpus", "ok_pt_pairs_limited",
                                  "top_problems", "train_size"])
def test_single_partition_only_over_aggregates(spark, name):
    """A gather into one partition may only read an aggregate (e.g. the bucket-count table), never base rows."""
    lines = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1].strip()
            assert "HashAggregate" in below or "SortAggregate" in below, (name, below)


@pytest.mark.parametrize(("name", "most"), [("error_lines", 4), ("review_sheet", 10), ("branches", 4), ("label_lines", 6)])
def test_shared_parts_are_read_not_computed_again(spark, name, most):
    """Nodes, pairs, signatures and error lines are written once: the plan of the result reads few tables."""
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= most, plan.count("Relation [")
