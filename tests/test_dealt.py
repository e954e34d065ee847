"""Tables dealt by document: what reads them by document moves no row again."""

import os

import pytest

from sylva import session
from sylva.operators import subtrees, trees
from sylva.plans import queries
from sylva.session import bucket_count, by_document, deal_table, union_dealt
from sylva.sources import fixtures as fx
from tests.test_trees import _bushy


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_dealt_table_is_read_without_an_exchange(spark):
    t = deal_table(_bushy(spark, 6))
    assert "Exchange" not in _plan(t.groupBy("doc_id", "symbol").count())
    assert t.count() == _bushy(spark, 6).count()


def test_nodes_of_the_fixture_come_dealt(spark):
    d = "/root/testdata/sf0.001"
    nodes = fx.nodes_from_orders(*[fx.load(spark, d, t) for t in ("orders", "lineitem", "part")])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before, after = (_plan(x).count("Exchange hashpartitioning") for x in (nodes, nodes.repartition(n, "doc_id")))
    assert before == after


def test_dot_reads_the_nodes_once(spark):
    assert _plan(trees.dot_graph(deal_table(_bushy(spark, 6)))).count("FileScan") == 1


def test_numbers_of_equal_subtrees_are_not_broadcast_with_salts(spark, monkeypatch):
    nodes = _bushy(spark, 6)
    want = sorted(map(tuple, subtrees.equal_subtrees(nodes).collect()))
    for most in (0, 1, 2):  # all, some and none of the fingerprints are frequent
        monkeypatch.setattr(subtrees, "MOST_ALIKE", most)
        got = subtrees.equal_subtrees(nodes)
        assert "SortMergeJoin" in _plan(got) and "explode" not in _plan(got)
        assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("hashed", [0, 1_000_000])
def test_a_short_walk_moves_no_row_after_its_first_write(spark, monkeypatch, hashed):
    nodes, plans, real = _bushy(spark, 6), [], trees.deal_table
    want = sorted(map(tuple, trees.encode_leaf_paths(trees.root_paths(nodes)).select("doc_id", "leaf_ord", "path_ids").collect()))

    def deal(df, tag, buckets=None, apart=None):
        with by_document(spark):
            plans.append(_plan(df))
        return real(df, tag, buckets=buckets, apart=apart)

    monkeypatch.setattr(trees, "deal_table", deal)
    monkeypatch.setattr(trees, "HASHED_NODES", hashed)
    monkeypatch.setattr(trees, "JUMPS", 6)
    got = trees.encoded_paths(nodes, only=["path_ids"]).select("doc_id", "leaf_ord", "path_ids")
    assert sorted(map(tuple, got.collect())) == want
    assert len(plans) == 3 and not any("Exchange hashpartitioning" in p for p in plans[1:])
    assert all(("ShuffledHashJoin" in p) == bool(hashed) for p in plans[1:])


def test_more_input_makes_more_buckets(spark, monkeypatch, tmpdir_fresh):
    _bushy(spark, 6).write.parquet(f"{tmpdir_fresh}/nodes")
    nodes, n = spark.read.parquet(f"{tmpdir_fresh}/nodes"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bucket_count(nodes) == n == bucket_count(_bushy(spark, 6))
    monkeypatch.setattr(session, "INPUT_PER_BUCKET", 50)
    more = bucket_count(nodes)
    assert more > n and bucket_count(deal_table(nodes, buckets=more)) == more
    want, got = ([sorted(map(tuple, trees.encoded_paths(df, only=["path_ids"]).select("doc_id", "leaf_ord", "path_ids").collect()))
                  for df in (_bushy(spark, 6), nodes)])
    assert got == want


def test_node_equality_moves_no_node_after_its_first_write(spark, monkeypatch):
    plans, real = [], queries.deal_table

    def deal(df, tag, buckets=None):
        with by_document(spark):
            plans.append(_plan(df))
        return real(df, tag, buckets=buckets)

    monkeypatch.setattr(queries, "deal_table", deal)
    got = queries.q_node_equality(spark, "/root/testdata/sf0.001")
    assert len(plans) == 2 and "Exchange hashpartitioning" not in plans[1] and "Exchange" not in _plan(got)


@pytest.mark.parametrize("apart", [None, "big"])
def test_a_table_written_in_several_goes_holds_every_row_once(spark, monkeypatch, tmpdir_fresh, apart):
    spark.range(300).selectExpr("if(id % 50 = 0, NULL, cast(id % 90 AS string)) AS doc_id", "id AS v").write.parquet(f"{tmpdir_fresh}/in")
    counts = spark.read.parquet(f"{tmpdir_fresh}/in").groupBy("doc_id", "v").count().selectExpr("*", "v > 100 AS big")
    want = sorted(map(str, counts.collect()))
    assert session._goes(counts) == 1
    monkeypatch.setattr(session, "INPUT_PER_WRITE", 500)
    assert session._goes(counts) > 2 and session._goes(spark.read.parquet(f"{tmpdir_fresh}/in")) == 1
    t = deal_table(counts, buckets=3, apart=apart)
    assert sorted(map(str, t.select(counts.columns).collect())) == want
    assert "Exchange" not in _plan(t.groupBy("doc_id").count())


def test_a_union_of_dealt_tables_stays_dealt(spark):
    t = deal_table(_bushy(spark, 6))
    parts = [t.selectExpr("doc_id", "node_id", "1 AS n"), t.where("child_count > 0").selectExpr("doc_id", "parent_id AS node_id", "2 AS n")]
    with by_document(spark):
        assert "Exchange" not in _plan(union_dealt(parts).groupBy("doc_id", "node_id").agg({"n": "sum"}))
    assert sorted(map(str, union_dealt(parts).collect())) == sorted(map(str, parts[0].unionByName(parts[1]).collect()))


def test_dropped_tables_are_gone(spark):
    kept, dealt = (write(_bushy(spark, 6)) for write in (session.write_table, deal_table))
    names = {t.name for t in spark.catalog.listTables()}
    for t in (kept, dealt):
        folder = t.inputFiles()[0].removeprefix("file:").rpartition("/")[0]
        assert os.path.isdir(folder)
        session.drop_table(t)
        assert not os.path.exists(folder)
    assert dealt.dealt_name in names and dealt.dealt_name not in {t.name for t in spark.catalog.listTables()}
