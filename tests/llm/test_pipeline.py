import collections

import corpus_pipeline
from sylva.llm import stages
from sylva.llm.common import save
from tests.llm import odd_docs

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, columns = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    assert len(names) == 5
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = save(stage(spark, before, SF), "test")
        assert after.columns == columns, name
        if name != "mixing":
            assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert collections.Counter(r.doc_id for r in last.collect()) == collections.Counter(r.doc_id for r in before.collect())


def test_stages_take_odd_and_empty_tables(spark, tmp_path):
    odd_docs.labels(spark, [(3, 1, 0), (5, 0, 1)]).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, odd_docs.rows()[30][1])], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    for docs in (odd_docs.table(spark), odd_docs.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            n = out.count()
            if name != "sharding":
                assert out.columns == docs.columns, name
            assert (n > 0) == (docs.count() > 0), name


def test_mixing_stage_repeats_rows_by_budget(spark):
    docs = odd_docs.table(spark)
    mixed = stages.mix(spark, docs, "")
    times = collections.Counter(str(r) for r in mixed.collect())
    assert max(times.values()) <= 4 and mixed.columns == docs.columns       # two rows of the table are equal


def test_one_row_of_a_component_stays_with_null_and_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(None, a), (None, a), (None, a + " near"),            # copies without an id only
            (3, b), (None, b), (None, b + " near"),               # copies of a kept document
            (5, c), (5, b + " end"), (5, c + " near"), (5, c),    # id 5 stands for c, not for its row in b's component
            (7, d), (8, d + " near"),
            (None, ""), (None, None), (9, ""), (9, ""), (10, " ")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int")
    kept = stages.drop_near_copies(spark, docs, "").collect()
    assert collections.Counter((r.text or "")[:1].strip() for r in kept) == {"a": 1, "b": 1, "c": 1, "d": 1, "": 4}
    assert {r.doc_id for r in kept if r.text and r.text.strip() and r.text[0] != "a"} == {3, 5, 7}
    assert len({r.n for r in kept}) == len(kept)
