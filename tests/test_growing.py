import os

import pytest
from pyspark.sql import functions as F

from sylva.operators import growing, meta, sampling
from sylva.session import write_table


def _pool(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("doc_id"), F.concat(F.lit("p"), F.col("id") % 7).alias("problem_id"),
                                 F.concat(F.lit("f"), "id").alias("file_name"))


@pytest.mark.parametrize("n", [0, 1, 99, 100, 250, 20_000])
@pytest.mark.parametrize("split", [0, 33, 100])
def test_selection_gives_the_split_of_the_sort(spark, n, split):
    pool = _pool(spark, n)
    want = sorted(map(tuple, sampling.train_val_split(pool, split=split).collect()))
    assert sorted(map(tuple, sampling.train_val_select(pool, split=split).collect())) == want
    if n == 250:
        assert sorted(map(tuple, sampling.train_val_select(pool, 100_000, split).collect())) == sorted(
            map(tuple, sampling.train_val_split(pool, 100_000, split).collect()))


def test_every_rank_is_found_in_few_passes(spark, monkeypatch):
    monkeypatch.setattr(sampling, "FEW", 3)
    monkeypatch.setattr(sampling, "DIGITS", 1)
    keys = write_table(_pool(spark, 300).select(sampling.rank_key(1, "x", "doc_id").alias("key"), "doc_id"), "t")
    ordered = sorted((r.key, r.doc_id) for r in keys.collect())
    for k in (1, 2, 150, 299, 300):
        assert sampling.kth_key(keys, k) == ordered[k - 1]
    assert sampling.kth_key(keys, 301) is None and sampling.kth_key(keys, 0) is None


def test_rows_that_share_an_id_stay_together(spark):
    pool = spark.createDataFrame([("same", "p", f"f{i}") for i in range(150)] + [("other", "p", "g")], "doc_id string, problem_id string, file_name string")
    got = sampling.train_val_select(pool, split=50).groupBy("doc_id").agg(F.collect_set("split").alias("s")).collect()
    assert all(len(r.s) == 1 for r in got)


def test_no_sort_and_no_shuffle_of_the_pool(spark):
    plan = sampling.train_val_select(_pool(spark, 1000), split=50)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "Window" not in plan


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_two_half_loads_equal_one_whole_load(spark, tmpdir_fresh):
    pool = _pool(spark, 2000)
    state = growing.GrowingSample(spark, f"{tmpdir_fresh}/a", 9)
    state.add(pool.where("CAST(doc_id AS INT) % 2 = 0"), "one")
    state.add(pool.where("CAST(doc_id AS INT) % 2 = 1"), "two")
    want = sorted(map(tuple, sampling.sample_per_problem(pool, 9, 42).select("doc_id", "problem_id", "file_name").collect()))
    assert sorted(map(tuple, state.sample().collect())) == want
    assert {r.problem_id: r.n_files for r in state.counts().collect()} == {r.problem_id: r["count"] for r in pool.groupBy("problem_id").count().collect()}
    # the same load again, as after a job that was run twice, changes nothing
    state.add(pool.where("CAST(doc_id AS INT) % 2 = 1"), "two")
    assert sorted(map(tuple, state.sample().collect())) == want and state.counts().agg(F.sum("n_files")).first()[0] == 2000
    state.add(pool.where("false"), "two")
    assert state.counts().agg(F.sum("n_files")).first()[0] == 1000


def test_a_load_rewrites_only_the_buckets_it_touches(spark, tmpdir_fresh):
    state = growing.GrowingSample(spark, tmpdir_fresh, 5)
    state.add(_pool(spark, 700), "first")
    before = _files(f"{tmpdir_fresh}/sample")
    touched = state.add(_pool(spark, 800).where("problem_id = 'p3' AND CAST(doc_id AS INT) >= 700"), "second")
    after = _files(f"{tmpdir_fresh}/sample")
    assert len(touched) == 1 and {f for f in before if before[f] != after.get(f)} == {f for f in before if f"_bucket={touched[0]}/" in f}
    want = sampling.sample_per_problem(_pool(spark, 800).where("CAST(doc_id AS INT) < 700 OR problem_id = 'p3'"), 5, 42)
    assert sorted(r.doc_id for r in state.sample().collect()) == sorted(r.doc_id for r in want.collect())


def test_the_last_run_wins_and_unchanged_buckets_stay(spark, tmpdir_fresh):
    v = growing.VersionedVocabulary(spark, tmpdir_fresh)

    def entries(pairs):
        return spark.createDataFrame(pairs, "key string, token string")
    assert v.entries().count() == 0
    v.merge(entries([(f"k{i}", f"t{i}") for i in range(200)]), 1)
    before = _files(tmpdir_fresh)
    touched = v.merge(entries([("k7", "new"), ("k500", "t500"), ("k500", "t499")]), 2)
    after = _files(tmpdir_fresh)
    assert 1 <= len(touched) <= 2
    assert {f for f in before if f not in after} == {f for f in before if any(f"_bucket={b}/" in f for b in touched)}
    got = {r.key: (r.token, r.run) for r in v.entries().collect()}
    assert got == {**{f"k{i}": (f"t{i}", 1) for i in range(200)}, "k7": ("new", 2), "k500": ("t500", 2)}
    assert v.merge(entries([("k7", "new"), ("k500", "t500")]), 2) == []      # a run merged again
    assert v.merge(entries([("k7", "old")]), 1) == [] and v.merge(entries([]), 3) == []
    assert {r.key: (r.token, r.run) for r in v.entries().collect()} == got


def test_a_lookup_reads_few_rows(spark, tmpdir_fresh):
    subs = spark.range(50_000).select(F.format_string("s%07d", F.col("id") * 2).alias("submission_id"), F.lit("p").alias("problem_id"),
                                      F.lit("u").alias("user_id"), F.lit("cpp").alias("language"), F.lit("OK").alias("status"))
    meta.write_lookup_layout(subs, tmpdir_fresh, files=25)
    hit = meta.point_lookup(spark, tmpdir_fresh, "s0050000")
    assert [r.submission_id for r in hit.collect()] == ["s0050000"]
    read = _rows_scanned(hit)
    assert 0 < read <= 50_000 / 25 * 1.5, read
    gone = meta.point_lookup(spark, tmpdir_fresh, "s0050001")  # between the ids of a file: the Bloom filter says no
    assert gone.collect() == [] and _rows_scanned(gone) == 0


def _rows_scanned(df):
    df.collect()
    todo, plan = [df._jdf.queryExecution().executedPlan()], None
    while todo:
        p = todo.pop()
        if p.nodeName().startswith("Scan"):
            plan = p
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return plan.metrics().get("numOutputRows").get().value()
