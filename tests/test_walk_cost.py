"""What the walk and its fixture must not do again: costly forms of the same rows."""
import re

from pyspark.sql import functions as F

from sylva.operators import contexts, trees
from sylva.plans import extract_contexts, queries
from sylva.session import deal_table
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_nodes_are_not_exploded_as_structs(spark):
    assert "named_struct" not in _plan(queries._nodes(spark, SF001))


def test_a_task_writes_one_bucket_of_a_dealt_table(spark):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("doc_id"), (F.col("id") % 2 == 0).alias("even"))
    table = deal_table(rows, buckets=40, apart="even")
    of_task = {}
    for name in table.inputFiles():
        task, bucket = re.search(r"part-(\d+)-.*_(\d+)\.c000", name).groups()
        of_task.setdefault(task, set()).add(bucket)
    assert len(of_task) == 40 and all(len(b) == 1 for b in of_task.values())
    assert sorted(table.collect()) == sorted(rows.collect())


def test_the_walk_writes_only_columns_that_are_read(spark, monkeypatch):
    written = []
    monkeypatch.setattr(trees, "deal_table", lambda df, *a, **k: written.append(df.columns) or deal_table(df, *a, **k))
    out = trees.encoded_paths(queries._nodes(spark, SF001), only=["path_ids"])
    assert "path_ids" in written[-1] and "node_id" not in written[-1]
    assert not any("end_byte" in columns for columns in written)
    assert out.columns == [*trees._LEAF_COLUMNS.values(), "path_ids"]


def test_start_and_leaf_filter_may_read_any_column(spark):
    nodes = queries._nodes(spark, SF001)
    got = trees.encoded_paths(nodes.withColumn("mine", F.col("type") == "part_ref"), start=F.col("mine"), only=["path_ids"],
                              leaf_filter=F.col("end_col") == 0)
    want = trees.encoded_paths(nodes, start=F.col("type") == "part_ref", only=["path_ids"])
    assert got.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_lines_are_sorted_without_a_comparator(spark):
    branches = spark.createDataFrame([("d", 2, "b"), ("d", 1, "c"), ("d", 3, "a"), ("d", 10, "b")], "doc_id string, leaf_ord int, branch string")
    docs = spark.createDataFrame([("d", "s"), ("e", "t")], "doc_id string, stem string")
    for order, want in (("document", "s c b a b"), ("sorted", "s a b b c")):
        lines = contexts.corpus_lines(branches, docs, order=order)
        assert {r.line for r in lines.collect()} == {want, "t"} and "array_sort" not in _plan(lines)


def test_two_runs_share_one_walk(spark, monkeypatch):
    walks = []
    written = trees._written
    monkeypatch.setattr(trees, "_written", lambda *a, **k: walks.append(1) or written(*a, **k))
    queries.QUERIES["vocabulary_runs"](spark, SF001)
    assert len(walks) == 1
    nodes, docs = queries._nodes(spark, SF001), queries._order_docs(spark, SF001)
    first = extract_contexts(nodes, docs)
    again = extract_contexts(nodes, docs, min_len=6, encoded=first.leaf_paths).branches
    own = extract_contexts(nodes, docs, min_len=6).branches
    assert again.count() > 0 and again.exceptAll(own).isEmpty() and own.exceptAll(again).isEmpty()


def test_functions_read_paths_dealt_by_document(spark):
    lines = queries.QUERIES["sql_error_lines"](spark, SF001)
    plan = lines._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))
    assert re.search(r"sylva_dealt_encoded", plan)
