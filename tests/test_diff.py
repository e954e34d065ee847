from pyspark.sql import Window
from pyspark.sql import functions as F

from sylva.operators import diff, meta
from sylva.sources import fixtures as fx
from tests.conftest import SF001
from tests.trees_fixture import hand_nodes


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "problem_id string, user_id string, ok_id string, pt_id string")


def test_diff_of_tree_with_itself_is_empty(spark):
    nodes = hand_nodes(spark)
    copy = nodes.withColumn("doc_id", F.concat(F.col("doc_id"), F.lit("_copy")))
    pairs = _pairs(spark, [("p", "u", "t1", "t1_copy")])
    assert diff.error_lines(pairs, nodes.unionByName(copy)).count() == 0


def test_existence_not_multiset(spark):
    # PT has two leaves with the same signature on lines 5 and 6; OK has it once -> neither is flagged
    def tree(doc, extra_rows):
        base = [(doc, 0, None, 0, 1, "r", True, False, len(extra_rows), 0, None)]
        return base + extra_rows
    ok = tree("ok", [("ok", 1, 0, 0, 9, "x", True, False, 0, 1, "a"), ("ok", 2, 0, 1, 9, "x", True, False, 0, 2, "b")])
    pt = tree("pt", [("pt", 1, 0, 0, 9, "x", True, False, 0, 5, "a"), ("pt", 2, 0, 1, 9, "x", True, False, 0, 6, "a"),
                     ("pt", 3, 0, 2, 9, "x", True, False, 0, 7, "c")])
    nodes = hand_nodes(spark, ok + pt)
    lines = sorted(r.line for r in diff.error_lines(_pairs(spark, [("p", "u", "ok", "pt")]), nodes).collect())
    assert lines == [7]


def test_missing_document_gives_no_lines(spark):
    pairs = _pairs(spark, [("p", "u", "t1", "missing")])
    assert diff.error_lines(pairs, hand_nodes(spark)).count() == 0


def test_signature_has_no_separator_by_default(spark):
    from sylva.operators.trees import encoded_paths
    sig = {(r.doc_id, r.leaf_ord): r.signature for r in diff.signatures(encoded_paths(hand_nodes(spark))).collect()}
    assert sig[("t1", 7)] == "0010041234;"
    assert sig[("t3", 4)] == "008hello"


def test_pairs_equal_literal_self_join(spark):
    """The aggregate pairing equals the ranked OK x PT self-join it replaces (brute force on sf0.001)."""
    subs = fx.submissions_from_orders(fx.load(spark, SF001, "orders"))
    fast = meta.ok_pt_pairs(subs).select("problem_id", "user_id", "ok_id", "pt_id")
    a = subs.where("status = 'OK'").alias("a")
    b = subs.where("status = 'PT'").alias("b")
    cross = a.join(b, (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.problem_id") == F.col("b.problem_id")))
    w = Window.partitionBy("a.problem_id", "a.user_id").orderBy("a.submission_id", "b.submission_id")
    slow = (cross.select(F.col("a.problem_id").alias("problem_id"), F.col("a.user_id").alias("user_id"),
                         F.col("a.submission_id").alias("ok_id"), F.col("b.submission_id").alias("pt_id"),
                         F.row_number().over(w).alias("rk"))
            .where("rk = 1").drop("rk"))
    assert fast.count() > 0
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def test_pairs_limit_per_problem(spark):
    subs = fx.submissions_from_orders(fx.load(spark, SF001, "orders"))
    lim = meta.ok_pt_pairs(subs, limit=3)
    counts = {r.problem_id: r["count"] for r in lim.groupBy("problem_id").count().collect()}
    assert counts and all(v <= 3 for v in counts.values())
    plan = lim._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
