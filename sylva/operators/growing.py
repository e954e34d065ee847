"""Stored state that grows by batches: the rows of a batch meet only the buckets of the state that they touch.

A state is a Parquet table partitioned by a bucket of its key. A merge reads the touched buckets, joins them with the
batch, writes the result beside the table and then replaces just these partitions (dynamic partition overwrite); all
other files stay as they are. The list of touched buckets is at most ``buckets`` numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylva.operators.sampling import first_n, rank_key
from sylva.session import write_table

BUCKETS = 64


class BucketedState:
    """A table of ``schema`` at ``path``, dealt by a bucket of the column ``key``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.schema = T.StructType.fromDDL(schema)

    def bucket(self):
        return F.pmod(F.crc32(F.coalesce(F.col(self.key), F.lit(""))), F.lit(self.buckets)).cast("int")

    def _exists(self) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _stored(self) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField("_bucket", T.IntegerType())])
        return self.spark.read.schema(full).parquet(self.path) if self._exists() else self.spark.createDataFrame([], full)

    def read(self) -> DataFrame:
        return self._stored().drop("_bucket")

    def merge(self, batch: DataFrame, settle: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Put ``batch`` (columns of the schema) into the state: ``settle`` makes the new rows of the touched buckets
        from their old and the batch's rows. Returns the touched buckets."""
        new = write_table(batch.select(*self.schema.names).withColumn("_bucket", self.bucket()), "batch")
        touched = sorted(r[0] for r in new.select("_bucket").distinct().collect())
        if not touched:
            return []
        old = self._stored().where(F.col("_bucket").isin(touched))
        merged = settle(old.unionByName(new)).select(*self.schema.names, "_bucket")
        staged = write_table(merged, "merged")  # the table is not read any more when its partitions are replaced
        (staged.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_bucket").parquet(self.path))
        return touched


class GrowingSample:
    """The ``n`` files of every problem with the smallest seeded rank, and the number of files, over all loads so far.

    Of a load only its own ``n`` smallest a problem can enter the sample, so a load is reduced by a group limit
    before it meets the state. Counts are stored by load: a load that is added again replaces itself.
    """

    def __init__(self, spark: SparkSession, path: str, n: int, seed: int = 42, buckets: int = BUCKETS):
        self.n, self.seed = n, seed
        self.kept = BucketedState(spark, f"{path}/sample", "doc_id string, problem_id string, file_name string, rank string",
                                  "problem_id", buckets)
        self.loads = BucketedState(spark, f"{path}/loads", "load string, problem_id string, n_files long", "load", buckets)

    def add(self, files: DataFrame, load: str) -> list[int]:
        """Add the files (``doc_id, problem_id, file_name``) of one load; returns the buckets that were rewritten."""
        rows = files.select("doc_id", "problem_id", "file_name", rank_key(self.seed, "sample", "doc_id").alias("rank"))

        def smallest(df: DataFrame) -> DataFrame:
            return first_n(df, ["problem_id"], ["rank", "doc_id"], self.n)

        touched = self.kept.merge(smallest(rows), lambda both: smallest(both.dropDuplicates(["problem_id", "doc_id"])))
        counts = files.groupBy("problem_id").agg(F.count(F.lit(1)).alias("n_files")).withColumn("load", F.lit(load))
        mark = self.loads.spark.createDataFrame([(load, None, 0)], self.loads.schema)  # an empty load replaces its counts too
        new = counts.select("load", "problem_id", "n_files").unionByName(mark)
        new = write_table(new, "load")
        self.loads.merge(new, lambda both: both.where(F.col("load") != load).unionByName(
            new.withColumn("_bucket", self.loads.bucket())))
        return touched

    def sample(self) -> DataFrame:
        return self.kept.read().select("doc_id", "problem_id", "file_name")

    def counts(self) -> DataFrame:
        """Files of every problem over all loads (``problem_id, n_files``)."""
        return (self.loads.read().where("n_files > 0").groupBy("problem_id").agg(F.sum("n_files").alias("n_files")))


class VersionedVocabulary:
    """Vocabulary over runs: ``key, token, run``, where the last run that has a key says its token.

    Only buckets in which the run brings a key that no later or equal run holds are rewritten, so a run that is
    merged again changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.state = BucketedState(spark, path, "key string, token string, run int", "key", buckets)

    def merge(self, entries: DataFrame, run: int) -> list[int]:
        """Upsert ``entries`` (``key, token``) of a run; returns the buckets that were rewritten."""
        new = entries.groupBy("key").agg(F.max("token").alias("token")).withColumn("run", F.lit(run))
        held = self.state.read().where(F.col("run") >= run).select("key")
        return self.state.merge(new.join(held, "key", "left_anti"), lambda both: (
            both.groupBy("key", "_bucket").agg(F.max(F.struct("run", "token")).alias("e"))
            .select("key", "e.token", "e.run", "_bucket")))

    def entries(self) -> DataFrame:
        return self.state.read()
