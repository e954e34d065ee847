import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sylva.llm import mixing, sharding
from tests.llm import odd_docs


def best_capacity(sizes, n):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, now = (low + high) // 2, 1, 0
        for s in sizes:
            used, now = (used + 1, s) if now + s > mid else (used, now + s)
        low, high = (low, mid) if used <= n else (mid + 1, high)
    return low


@pytest.mark.parametrize("n", [1, 3, 24])
def test_shards_have_the_smallest_possible_maximum(spark, n):
    docs = odd_docs.table(spark)
    got = sharding.shard_documents(docs, n).collect()
    assert len(got) == docs.count()
    keyed = docs.select("doc_id", sharding.text_group().alias("k"), sharding.text_size().alias("s"),
                        F.crc32("text").alias("crc")).collect()
    groups = defaultdict(int)
    for r in keyed:
        groups[r.k] += r.s
    by_shard, rows_of, shard_of = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        by_shard[r.shard] += r["size"]
        rows_of[r.shard].append(r.slot)
        shard_of[r.text_crc32].add(r.shard)
    assert max(by_shard.values()) == best_capacity([groups[k] for k in sorted(groups)], n)
    assert all(sorted(v) == list(range(len(v))) for v in rows_of.values())
    assert all(len(v) == 1 for v in shard_of.values()) and max(by_shard) < n
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32 or -1) for r in got) == sorted(
        (r.doc_id or -1, r.s, r.crc or -1) for r in keyed)
    assert all(r.law == "bytes" and r.grown_shard is None for r in got)


def test_sharding_is_native_and_takes_empty_tables(spark):
    out = sharding.shard_documents(odd_docs.table(spark))
    assert not any(x in out._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
    assert sharding.shard_documents(odd_docs.empty(spark)).count() == 0


def test_mix_meets_targets_and_keeps_rows(spark):
    docs = odd_docs.table(spark)
    got = mixing.mix_sources(docs).collect()
    data = odd_docs.rows()
    assert len(got) == len(data)
    size = defaultdict(int)
    for r in data:
        size[r[3]] += len(odd_docs.words(r[1]))
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: [3.0, 1.0, 2.0][i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:
        left = 1.5 * sum(size.values()) - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * size[s]}
        if not over:
            break
        target |= {s: 2.0 * size[s] for s in over}
        open_ -= over
    target |= {s: weight[s] * level for s in open_}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.taken == r.copies * r["size"] <= 2 * r["size"]
        assert r["size"] == len(odd_docs.words(r.text)) and r.source_size == size[r.source]
        assert abs(r.target - target[r.source]) < 1e-6
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in order:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-9
    again = mixing.mix_sources(docs.repartition(5)).collect()
    key = lambda r: (r.doc_id or -1, r.text or "", r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix_sources(odd_docs.empty(spark)).count() == 0


def test_text_crc_is_of_utf8(spark):
    got = {r.doc_id: r for r in sharding.shard_documents(odd_docs.table(spark)).collect()}
    assert got[10].text_crc32 == zlib.crc32("日本 語 🙂".encode()) and got[10]["size"] == len("日本 語 🙂".encode()) + 8
    assert got[0].text_crc32 is None and got[0]["size"] == 8


@pytest.mark.parametrize("hot", [0, 2000, 3999])
def test_a_hot_group_leaves_no_shard_empty(spark, hot):
    """4,000 groups of one size and one that holds a third of all bytes: every shard gets its part of the rest."""
    rows = [(f"g{i:04d}", 100) for i in range(4000)] + [(f"g{hot:04d}", 100)] * 2000
    df = spark.createDataFrame(rows, "k string, s long")
    got = sharding.shard_minimax(df, F.col("k"), F.col("s"), [], 24).groupBy("shard").agg(F.sum("s").alias("b"), F.min("k").alias("k")).collect()
    sizes = sorted(r.b for r in got)
    assert len(got) == 24 and sizes[-1] == 200_100 and sizes[0] >= 0.85 * 399_900 / 23 and sizes[-2] <= 1.15 * 399_900 / 23
    order = sorted(got, key=lambda r: r.shard)
    assert [r.k for r in order] == sorted(r.k for r in order)


def test_several_hot_groups_and_few_groups(spark):
    import random
    rnd = random.Random(2)
    for sizes, n in (([900, 1, 1, 800, 1, 1, 1, 700, 1], 6), ([5, 5, 5], 24), ([1000], 24), ([1, 1000], 4), ([1000, 1], 4),
                     ([rnd.randint(1, 9) for _ in range(60)] + [500] + [rnd.randint(1, 9) for _ in range(20)], 7)):
        df = spark.createDataFrame([(f"{i:03d}", s) for i, s in enumerate(sizes)], "k string, s long")
        got = sharding.shard_minimax(df, F.col("k"), F.col("s"), [], n).collect()
        by = defaultdict(int)
        for r in got:
            by[r.shard] += r.s
        assert max(by.values()) == best_capacity(sizes, n) and len(got) == len(sizes) and max(by) < n
        assert len(by) == min(n, len(sizes))
        shards = [r.shard for r in sorted(got, key=lambda r: r.k)]
        assert shards == sorted(shards)
        for s in by:
            assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_mix_agrees_for_repeated_and_missing_ids(spark):
    import random
    rnd = random.Random(6)
    rows = [(rnd.choice([None, *range(50)]), "w " * rnd.randint(0, 40) + str(rnd.randint(0, 5)), rnd.choice(["a", "b", "c", None])) for _ in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def taken(df):
        return sorted(map(str, ((r.doc_id, r.text, r.source, r.taken) for r in mixing.mix_sources(df).collect())))
    want = taken(docs.repartition(3))
    assert taken(docs.repartition(11, "text")) == want
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    assert taken(spark.createDataFrame(shuffled, docs.schema)) == want
