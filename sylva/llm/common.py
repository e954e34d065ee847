"""Helpers that several operators of this folder share.

* ``save`` writes a table to the shared folder (``spark.checkpoint.dir``) and reads it back, which
  cuts lineage and survives the loss of an executor.
* ``range_sorted`` and ``running_total`` give every row its place, or the sum before it, in a global
  order without one task seeing more than its own range.
* ``labelled_sample`` picks a bounded, seeded sample of labelled documents for fitting a model.
* ``doc_slices`` walks Arrow batches in small slices, so that a task holds few documents as Python objects.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylva.session import ensure_checkpoint_dir

SEQ_BITS = 33  # monotonically_increasing_id() keeps the row number of a partition in these bits
FOLDS = 5  # rows whose crc32(doc_id as text) mod FOLDS is 0 are held out of every fit


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return it read back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/sylva-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.saved_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`save` that no result still to be computed reads."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.saved_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_sorted(df: DataFrame, order: list[Column], tag: str) -> DataFrame:
    """Saved table in global order, with ``part`` (range number) and ``seq`` (row number in the range).

    A key that holds many rows spreads over several ranges when ``order`` goes on to finer columns.
    """
    n = shuffle_partitions(df.sparkSession)
    marked = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    return (save(marked, tag)
            .withColumn("part", F.shiftright("_mid", SEQ_BITS).cast("int"))
            .withColumn("seq", F.col("_mid").bitwiseAND(F.lit((1 << SEQ_BITS) - 1)))
            .drop("_mid"))


def running_total(t: DataFrame, value: Column, out: str, order: str = "seq") -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in (part, ``order``) order.

    Sums run inside each range; the ranges' own totals are one row per partition, so the
    table of offsets is as small as the number of partitions.
    """
    ranges = t.groupBy("part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("part").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (t.withColumn("_upto", F.sum(value).over(inside))
            .join(F.broadcast(offsets), "part")
            .withColumn(out, F.col("_offset") + F.col("_upto") - value)
            .drop("_offset", "_upto"))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the documents of the held-out fold; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int, seed: str) -> DataFrame:
    """(doc_id, text, y) of at most ``per_class`` documents of each class, none of them held out.

    Ids are chosen by a seeded hash, so the sample does not depend on the partitioning. Only the ids
    (at most 2 * per_class) are broadcast; the texts of other documents are never shuffled. A document
    labelled more than once counts as 1 if any label says 1.
    """
    marked = (labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
              .groupBy("doc_id").agg(F.max(F.col(target).cast("int")).alias("y")))
    rank = F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")))
    chosen = None
    for y in (0, 1):
        one = marked.where(F.col("y") == y).orderBy(rank, "doc_id").limit(per_class)
        chosen = one if chosen is None else chosen.unionByName(one)
    return (docs.select("doc_id", "text").where(F.col("text").isNotNull())
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y"))


def fit_in_task(sample: DataFrame, fit: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> list:
    """Run ``fit`` over a bounded sample in one task, in doc_id order, and collect the model rows it yields."""
    return sample.repartition(1).sortWithinPartitions("doc_id", "text").mapInArrow(fit, schema).collect()


def doc_slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sized_slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices whose texts in ``column`` hold about ``most`` bytes; a longer text comes alone."""
    for batch in batches:
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)).cast(pa.int64()), 0)).to_numpy()
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def per_worker(key: str, make: Callable):
    """A value that all tasks of one Python worker share, such as a cache that is slow to fill."""
    held = sys.modules.setdefault("sylva_llm_worker", types.ModuleType("sylva_llm_worker"))
    if not hasattr(held, key):
        setattr(held, key, make())
    return getattr(held, key)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
