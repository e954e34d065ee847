import pytest

from sylva.functions.text import file_stem
from sylva.operators import contexts, diff, labels, meta, trees
from sylva.sql import register_functions
from pyspark.sql import functions as F
from tests.trees_fixture import hand_nodes


@pytest.fixture()
def tables(spark):
    subs = spark.createDataFrame([("t1", "p", "u", "cpp", "OK"), ("t3", "p", "u", "cpp", "PT"), ("t2", "p", "v", "cpp", "PT"), ("x", "q", "u", "cpp", None)],
                                 "submission_id string, problem_id string, user_id string, language string, status string")
    sources = spark.createDataFrame([("d", "a\nb\n")], "doc_id string, text string")
    clicks = spark.createDataFrame([("p", "u", 3), ("p", "u", 3), ("p", "u", 4)], "problem_id string, user_id string, line int")
    enc = trees.encoded_paths(hand_nodes(spark))
    assert register_functions(spark, subs, enc, sources, clicks) == ["ok_pt_pairs", "path_contexts", "error_lines", "numbered_lines", "toggled_lines"]
    return subs, enc, sources, clicks


def _rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_functions_give_what_the_operators_give(spark, tables):
    subs, enc, sources, clicks = tables
    pairs = meta.ok_pt_pairs(subs)
    assert _rows(spark.sql("SELECT * FROM ok_pt_pairs()")) == _rows(pairs.select("problem_id", "user_id", "ok_id", "pt_id"))
    assert _rows(spark.sql("SELECT * FROM error_lines('OK', 'PT')")) == _rows(diff.error_lines(pairs, hand_nodes(spark)))
    back = meta.ok_pt_pairs(subs, "PT", "OK")
    assert _rows(spark.sql("SELECT * FROM error_lines(ok => 'PT', pt => 'OK')")) == _rows(diff.error_lines(back, hand_nodes(spark)))
    assert spark.sql("SELECT * FROM error_lines('none', 'PT')").count() == 0
    for n in (1, 3, 5):
        assert _rows(spark.sql(f"SELECT * FROM path_contexts(n => {n})")) == _rows(contexts.branches(enc, min_len=n))
    assert _rows(spark.sql("SELECT * FROM numbered_lines()")) == _rows(labels.numbered_lines(sources))
    assert _rows(spark.sql("SELECT * FROM toggled_lines()")) == _rows(labels.toggled_lines(clicks))


def test_unknown_policies_raise(spark, tables):
    for call, word in (("path_contexts('no_such')", "unknown tokenizer"), ("path_contexts(split => 'x')", "unknown split")):
        with pytest.raises(Exception, match=word):
            spark.sql(f"SELECT * FROM {call}").collect()


def test_filters_reach_into_the_function(spark, tmpdir_fresh):
    subs = spark.createDataFrame([("a", "p", "u", "cpp", "OK"), ("b", "p", "u", "cpp", "PT")],
                                 "submission_id string, problem_id string, user_id string, language string, status string")
    subs.write.parquet(f"{tmpdir_fresh}/subs")
    register_functions(spark, spark.read.parquet(f"{tmpdir_fresh}/subs"))
    plan = spark.sql("SELECT ok_id FROM ok_pt_pairs() WHERE problem_id = 'p'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(problem_id,p)" in plan and "language" not in plan.split("ReadSchema")[1]


def test_functions_join_with_other_tables(spark, tables):
    name = spark.createDataFrame([("p", "f.x.cpp")], "problem_id string, file string").select("problem_id", file_stem(F.col("file")).alias("stem"))
    name.createOrReplaceTempView("names")
    got = spark.sql("SELECT n.stem, e.line FROM error_lines() e JOIN names n USING (problem_id)").collect()
    assert got and {r.stem for r in got} == {"f.x"}
