"""Sinks: Parquet is the primary format; text exports reproduce the tool file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.sources.corpus import VOCAB_MARKER, read_vocabulary


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write a table as Parquet (optionally partitioned, e.g. by ``split``)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_split(split_df: DataFrame, path: str) -> None:
    """Train/val folders: one Parquet table partitioned by ``split``, with the files' texts if the table has them."""
    write_parquet(split_df, path, ["split"])


def write_corpus_text(corpus: DataFrame, path: str) -> None:
    """Path-context corpus file: one ``<stem> <branch> ...`` line per document."""
    corpus.select("line").write.mode("overwrite").text(path)


def vocabulary_records(vocab: DataFrame) -> DataFrame:
    """Vocabulary entries as text records ``<marker><key> <display>``."""
    return vocab.select(F.concat(F.lit(VOCAB_MARKER), F.col("key"), F.lit(" "), F.col("display")).alias("value"))


def write_vocabulary_text(vocab: DataFrame, path: str) -> None:
    """Vocabulary mapping: one record per entry in ``<path>/records``, the entry count in ``<path>/count``.

    The records are written first and counted from what was written, so the vocabulary is computed once.
    """
    records = f"{path.rstrip('/')}/records"
    vocabulary_records(vocab).write.mode("overwrite").text(records)
    written = read_vocabulary(vocab.sparkSession, records)
    written.agg(F.count(F.lit(1)).cast("string").alias("value")).write.mode("overwrite").text(f"{path.rstrip('/')}/count")


def write_labels_text(label_rows: DataFrame, path: str) -> None:
    """Label file: one ``<pt file> <line> ...`` row per pair."""
    label_rows.select(F.col("label_line").alias("value")).write.mode("overwrite").text(path)


def write_dot(dot_df: DataFrame, path: str) -> None:
    """DOT graphs, one text record per document."""
    dot_df.select(F.col("dot").alias("value")).write.mode("overwrite").text(path)
