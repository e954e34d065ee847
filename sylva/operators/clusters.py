"""k-means over a vector table and the report of its largest clusters.

Fitting is Spark's own ``KMeans``: seeds by k-means||, passes with distance bounds, sums per centre in partial aggregates.
Around it: rows that cannot be clustered are left out by rule, clusters are numbered by size, and each has a
representative vector. Only the centres (k of them) are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.session import write_table

MOST_CLUSTERS = 10_000  # centres are broadcast


@dataclass(frozen=True)
class Clusters:
    """``members``: (id, cluster, distance), ``centres``: (cluster, n_vectors, cost, nearest, centre)."""

    members: DataFrame
    centres: DataFrame


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as doubles) of the rows whose vector is not null or empty and has finite components only."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & finite).select(id_col, v.alias("vector"))


def vector_clusters(vectors: DataFrame, k: int, seed: int = 42, max_iter: int = 20, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> Clusters:
    """Cluster the usable vectors into at most ``k`` clusters by k-means.

    ``distance`` is the squared distance to the cluster's centre, ``cost`` its sum over the members and
    ``nearest`` the id of the member with the smallest one (ties: smallest id). Clusters are numbered from 0 by
    size, largest first (ties: smallest ``nearest``, null first). Fewer distinct vectors than ``k`` give fewer clusters, an empty
    table gives none; vectors of different lengths raise ``ValueError``.
    """
    if not 2 <= k <= MOST_CLUSTERS:
        raise ValueError(f"k must be between 2 and {MOST_CLUSTERS}")
    spark = vectors.sparkSession
    rows = write_table(usable_vectors(vectors, id_col, vector_col), "vectors")
    sizes = rows.agg(F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most")).first()
    id_type = rows.schema[id_col].dataType.simpleString()
    if sizes.least is None:
        return Clusters(spark.createDataFrame([], f"{id_col} {id_type}, cluster int, distance double"),
                        spark.createDataFrame([], f"cluster int, n_vectors long, cost double, nearest {id_type}, "
                                                  "centre array<double>"))
    if sizes.least != sizes.most:
        raise ValueError(f"vectors have between {sizes.least} and {sizes.most} components")
    featured = rows.withColumn("features", array_to_vector("vector"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, initMode="k-means||").fit(featured.select("features"))
    found = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
                                  "prediction int, centre array<double>")
    gap = F.zip_with("vector", "centre", lambda x, y: (x - y) * (x - y))
    placed = write_table(
        model.transform(featured).join(F.broadcast(found), "prediction")
        .select(id_col, "prediction", F.aggregate(gap, F.lit(0.0), lambda s, x: s + x).alias("distance")), "clusters")
    stats = placed.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n_vectors"), F.sum("distance").alias("cost"),
        F.min(F.struct("distance", id_col))[id_col].alias("nearest"))
    ranked = sorted(stats.collect(),  # at most k rows; null ids first
                    key=lambda r: (-r.n_vectors, r.nearest is not None, 0 if r.nearest is None else r.nearest))
    numbers = spark.createDataFrame([(r.prediction, i, r.n_vectors, r.cost, r.nearest) for i, r in enumerate(ranked)],
                                    f"prediction int, cluster int, n_vectors long, cost double, nearest {id_type}")
    members = placed.join(F.broadcast(numbers.select("prediction", "cluster")), "prediction").drop("prediction")
    centres = numbers.join(found, "prediction").drop("prediction")
    return Clusters(members.select(id_col, "cluster", "distance"), centres)


def top_clusters(clusters: Clusters, n: int = 10) -> DataFrame:
    """The ``n`` largest clusters: cluster, n_vectors, cost, nearest."""
    return clusters.centres.where(F.col("cluster") < n).drop("centre")
