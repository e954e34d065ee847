import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sylva.llm import jaccard_join as J
from sylva.llm import stages
from sylva.llm.components import components
from tests.llm import odd_docs


def shingles(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in odd_docs.words(text)]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted((str(r[0]), len(sets[i]), str(least.get(find(i)))) for i, r in enumerate(rows))


def found(spark, rows, exact=False):
    got = J.jaccard_components(odd_docs.table(spark, rows), exact=exact).collect()
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got)


def check(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_components_equal_brute_force_on_odd_documents(spark):
    check(spark, odd_docs.rows())
    assert J.jaccard_components(odd_docs.empty(spark)).count() == 0


def near_copies(n, seed, length, edits):
    rnd = random.Random(seed)
    base = [f"b{rnd.randint(0, 10**6)}" for _ in range(length)]
    passage = [f"p{i}" for i in range(30)]
    out = []
    for i in range(n):
        w = list(base) if i % 3 else [f"u{rnd.randint(0, 10**6)}" for _ in range(length)] + passage
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 10**6)}"
        out.append((i, " ".join(w), "en", "s", None, 1, 0, 0, 0, 0, 0.0))
    return out


@pytest.mark.parametrize(("length", "edits", "block", "crowd"), [(60, 5, 8192, 200), (150, 9, 7, 5), (20, 2, 8192, 3)])
def test_components_equal_brute_force_on_near_copies_around_the_limit(spark, monkeypatch, length, edits, block, crowd):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "CROWD", crowd)
    check(spark, near_copies(150, length, length, edits))


def pairs_near_the_limit(n, seed):
    """Texts of 65 to 500 shingles in pairs whose similarity is just above or just below the limit, and a shared passage."""
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(12)]
    out = []
    for i in range(n):
        words = [f"d{i}w{rnd.randint(0, 10**6)}" for _ in range(rnd.randint(69, 504) - len(passage))] + passage
        united = len(words) - 4
        for edits in (0, rnd.choice([0.9, 1.4])):
            w = list(words)
            if edits:  # every edit far from the others removes and adds five shingles
                for at in range(int(edits * 0.25 / 1.75 * united * 2 / 10)):
                    w[5 + 7 * at % (len(w) - 20)] = f"e{i}x{at}"
            out.append((2 * i + bool(edits), " ".join(w), "en", "s", None, 1, 0, 0, 0, 0, 0.0))
    return out


def test_the_exact_way_misses_nothing_whatever_the_number_of_keys(spark, monkeypatch):
    monkeypatch.setattr(J, "KEYS", 1)
    monkeypatch.setattr(J, "CROWD", 5)
    rows = pairs_near_the_limit(60, 3)
    want = brute(rows)
    linked = len(rows) - len({r[2] for r in want})
    assert 15 < linked < 55
    assert found(spark, rows, exact=True) == want
    assert found(spark, rows) != want  # one key a class is too few without it


def test_the_exact_way_on_odd_documents_and_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(J, "PIECE", 5)
    monkeypatch.setattr(J, "BLOCK", 7)
    assert found(spark, odd_docs.rows(), exact=True) == brute(odd_docs.rows())
    rows = near_copies(90, 2, 70, 6)
    assert found(spark, rows, exact=True) == found(spark, rows) == brute(rows)
    assert J.jaccard_components(odd_docs.empty(spark), exact=True).count() == 0


def test_points_bound_overlaps_from_above():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        n = int(rnd.integers(1, 400))
        a = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(rnd.integers(0, n + 1))], rnd.integers(0, 2**63, int(rnd.integers(1, 300)), dtype=np.uint64)]))
        p, q = J.Point(J.pack_point(a)), J.Point(J.pack_point(b))
        assert p.n == len(a) and q.n == len(b)
        rows, spare = J.bit_table([p, q])
        common = len(np.intersect1d(a, b))
        assert J.overlap_bound(rows[0], spare[0], rows[1:], spare[1:])[0] >= common
        groups = min(p.coarse, q.coarse)
        assert np.minimum(p.counts(groups), q.counts(groups)).sum() >= common


def test_tree_finds_all_pairs_the_bound_allows():
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 2**63, 120, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rnd.choice(base, 100, False), rnd.integers(0, 2**63, int(k), dtype=np.uint64)]))
            for k in rnd.integers(0, 40, 300)]
    order = np.argsort([len(s) for s in sets])
    sets = [sets[i] for i in order]
    labels = rnd.integers(0, 3, 300)
    tree = J.CountTree([J.Point(J.pack_point(s)) for s in sets], labels, np.zeros((300, 1), np.uint64))
    found = {(min(p), max(p)) for p in tree.pairs()}
    for i in range(300):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            linked = 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)
            assert not (linked and labels[i] != labels[j]) or (j, i) in found
    assert all(labels[i] != labels[j] for i, j in found)


def test_star_rounds_equal_union_find(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root}


def test_stage_keeps_one_of_each_group(spark):
    docs = odd_docs.table(spark)
    kept = stages.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    keep = {int(c) for d, n, c in brute(odd_docs.rows()) if c != "None"}
    assert set(ids) == keep
    assert kept.where(F.col("doc_id").isNull()).count() == 1


def test_rows_without_an_id_do_not_multiply(spark):
    """Texts of rows whose id is null or repeated are joined to their own class only."""
    from pyspark.sql import functions as F

    from sylva.llm import jaccard_join as J
    n = 5000
    words = F.concat_ws(" ", *[F.concat(F.lit(f"w{j}x"), (F.col("id") * 7 + j) % 9973) for j in range(12)])
    docs = spark.range(n).select(F.when(F.col("id") % 2 == 0, F.lit(7)).cast("long").alias("doc_id"), words.alias("text"))
    points = J.save(J.document_points(docs), "t")
    wanted = points.groupBy("cid").agg(F.min(F.struct("doc_id", "text_key")).alias("of"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    of = wanted.select("cid", F.col("of.doc_id").alias("_doc"), F.col("of.text_key").alias("_key"))
    joined = rows.join(of, rows["doc_id"].eqNullSafe(of["_doc"]) & (rows["text_key"] == of["_key"])).count()
    assert joined <= n
    assert J.class_texts(docs, wanted).count() == points.select("cid").distinct().count()
