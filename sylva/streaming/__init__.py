"""Reviewer clicks as a stream: the toggle state of every (pair, line), kept by Structured Streaming.

The batch operator :func:`sylva.operators.labels.toggled_lines` reads a finished
click table; here clicks arrive while reviewers work. The state is one count
per (problem, user, line) - bounded by the lines of the reviewed files - and
the sink sees, in ``update`` mode, each line whose click count changed with
its current on/off state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLICKS = T.StructType([
    T.StructField("problem_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("line", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
])


def read_clicks_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream click files from ``path`` (schema :data:`CLICKS`)."""
    r = spark.readStream.format(fmt).schema(CLICKS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def toggle_state(clicks: DataFrame) -> DataFrame:
    """Per (problem, user, line): number of clicks so far and whether the line is selected (odd count)."""
    counts = clicks.groupBy("problem_id", "user_id", "line").agg(F.count(F.lit(1)).alias("n_clicks"))
    return counts.withColumn("selected", F.col("n_clicks") % 2 == 1)


def start_toggle_query(clicks: DataFrame, checkpoint: str, sink: str = "noop", query_name: str = "toggles",
                       trigger_once: bool = False, **sink_options):
    """Start the toggle-state query in ``update`` mode with a checkpoint (restartable after failures)."""
    w = (toggle_state(clicks).writeStream.outputMode("update").format(sink)
         .option("checkpointLocation", checkpoint).options(**sink_options))
    if sink == "memory":
        w = w.queryName(query_name)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
