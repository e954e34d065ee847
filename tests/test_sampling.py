import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sylva.operators import sampling
from sylva.plans import preprocess_corpus
from sylva.sources import fixtures as fx
from tests.conftest import SF001


def _sources(spark):
    return fx.sources_from_documents(fx.load(spark, SF001, "documents"))


def test_first_n_is_one_scan_and_one_exchange(spark):
    df = sampling.sample_per_problem(_sources(spark), 30, 42)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "WindowGroupLimit" in plan


def test_first_n_equals_brute_force_with_a_hot_group(spark):
    rows = [("hot" if i % 10 else f"g{i % 7}", f"id{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, id string")
    for n in (0, 1, 17, 500, 5000):
        groups = {}
        for g, i in rows:
            groups.setdefault(g, []).append(i)
        want = {i for ids in groups.values() for i in sorted(ids)[:n]}
        assert {r.id for r in sampling.first_n(df, ["g"], ["id"], n).collect()} == want


def test_split_plan_has_few_scans(spark):
    r = preprocess_corpus(_sources(spark), n_problems=5, n_files=20)
    assert r.split._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 8


def test_train_val_partition_the_pool(spark):
    r = preprocess_corpus(_sources(spark), n_problems=5, n_files=20, split=75, seed=7)
    pool_ids = {x.doc_id for x in r.pool.collect()}
    split = r.split.collect()
    train = {x.doc_id for x in split if x.split == "train"}
    val = {x.doc_id for x in split if x.split == "val"}
    assert train.isdisjoint(val) and train | val == pool_ids
    total = r.sampled.count()
    assert r.total == total and all(x.text is not None for x in split)
    assert len(train) == min(len(pool_ids), 75 * (total // 100))


def test_integer_division_of_train_size(spark):
    df = spark.createDataFrame([(99,), (250,)], "t long")
    got = [r[0] for r in df.select(sampling.train_size(F.col("t"), 75)).collect()]
    assert got == [0, 150]
    exact = [r[0] for r in df.select(sampling.train_size(F.col("t"), 75, exact=True)).collect()]
    assert exact == [74, 187]


def test_top_problems_ties_and_distinct_counts(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", 9)], "problem_id string, n_files long")
    assert [r.problem_id for r in sampling.top_problems(counts, 3).collect()] == ["d", "a", "b"]
    assert [r.problem_id for r in sampling.top_problems(counts, 3, distinct_counts=True).collect()] == ["d", "a", "c"]


def test_sample_all_when_n_large(spark):
    src = _sources(spark)
    assert sampling.sample_per_problem(src, 10 ** 6).count() == src.count()
    with pytest.raises(ValueError):
        sampling.sample_per_problem(src, -1)


def test_flatten_later_copy_wins(spark):
    sampled = spark.createDataFrame(
        [("1", "big", "x.cpp"), ("2", "small", "x.cpp"), ("3", "big", "y.cpp")],
        "doc_id string, problem_id string, file_name string")
    counts = spark.createDataFrame([("big", 10), ("small", 2)], "problem_id string, n_files long")
    out = {r.file_name: r.doc_id for r in sampling.flatten_corpus(sampled, counts).collect()}
    assert out == {"x.cpp": "2", "y.cpp": "3"}


def test_range_rank_equals_row_number(spark):
    # ids with one common start and a hot group: ranges follow the keys themselves
    rows = [("hot" if i % 5 else None if i % 3 else "cold", f"s00{i * 7919 % 1000:04d}", f"t{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, k string, t string").repartition(3)
    fast = sampling.range_rank(df, ["g"], ["k", "t"], "rk")
    slow = df.withColumn("rk", F.row_number().over(Window.partitionBy("g").orderBy("k", "t")).cast("long"))
    assert sorted(map(str, fast.select(slow.columns).collect())) == sorted(map(str, slow.collect()))
    whole = sampling.range_rank(df, [], ["k", "t"], "rk")
    assert sorted(r.rk for r in whole.collect()) == list(range(1, 2001))
    assert [r.k for r in whole.orderBy("rk").collect()] == sorted(r[1] for r in rows)
