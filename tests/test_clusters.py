import numpy as np
import pytest

from sylva.operators import clusters

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(x)], SCHEMA)


def blobs(n, k, dim, seed):
    rnd = np.random.default_rng(seed)
    sizes = np.arange(1, k + 1)
    at = rnd.choice(k, n, p=sizes / sizes.sum())
    return (rnd.normal(0, 4, (k, dim))[at] + rnd.normal(0, 1, (n, dim))).astype(np.float32).astype(float)


def lloyd(x, k, seed, rounds=20):
    """The plain method: random rows as first centres, every distance in every round."""
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        c = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(k)])
    return ((x[:, None] - c) ** 2).sum(2).min(1).sum()


@pytest.mark.parametrize(("k", "dim"), [(2, 3), (8, 16)])
def test_objective_is_not_worse_than_plain_lloyd(spark, k, dim):
    x = blobs(600, k, dim, seed=k)
    found = clusters.vector_clusters(vectors(spark, x), k)
    members, centres = found.members.collect(), found.centres.collect()
    assert sorted(r.vec_id for r in members) == list(range(600))
    c = np.array([r.centre for r in sorted(centres, key=lambda r: r.cluster)])
    gaps = ((x[:, None] - c) ** 2).sum(2)
    for r in members:  # each in its nearest centre, at that distance
        assert gaps[r.vec_id, r.cluster] == pytest.approx(gaps[r.vec_id].min())
        assert r.distance == pytest.approx(gaps[r.vec_id, r.cluster])
    total = sum(r.cost for r in centres)
    assert total == pytest.approx(sum(r.distance for r in members))
    assert total <= 1.001 * np.median([lloyd(x, k, s) for s in range(9)])


def test_numbering_representatives_and_report(spark):
    x = blobs(300, 6, 4, seed=1)
    found = clusters.vector_clusters(vectors(spark, x), 6)
    rows = sorted(found.centres.collect(), key=lambda r: r.cluster)
    assert [r.cluster for r in rows] == list(range(6))
    assert [r.n_vectors for r in rows] == sorted((r.n_vectors for r in rows), reverse=True)
    by = {}
    for r in found.members.collect():
        by.setdefault(r.cluster, []).append((r.distance, r.vec_id))
    assert [(r.n_vectors, r.nearest) for r in rows] == [(len(by[i]), min(by[i])[1]) for i in range(6)]
    top = clusters.top_clusters(found, 3)
    assert top.columns == ["cluster", "n_vectors", "cost", "nearest"]
    assert sorted(r.cluster for r in top.collect()) == [0, 1, 2]


def test_rows_that_cannot_be_clustered(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, [0.0, 0.0]), (7, [0.0, 0.0]), (None, [9.0, 9.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in odd], SCHEMA)
    found = clusters.vector_clusters(df, 5)  # two distinct vectors: two clusters
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in found.members.collect()) == [
        ("6", 0, 0.0), ("7", 0, 0.0), ("None", 1, 0.0)]
    tied = clusters.vector_clusters(df.where("vec_id IS NULL OR vec_id = 6"), 2)
    assert sorted((str(r.vec_id), r.cluster) for r in tied.members.collect()) == [("6", 1), ("None", 0)]
    none = clusters.vector_clusters(df.where("false"), 5)
    assert none.members.count() == none.centres.count() == clusters.top_clusters(none).count() == 0
    assert none.members.columns == found.members.columns and none.centres.columns == found.centres.columns
    with pytest.raises(ValueError, match="components"):
        clusters.vector_clusters(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0)], SCHEMA), 2)
    with pytest.raises(ValueError, match="k must"):
        clusters.vector_clusters(df, 1)
