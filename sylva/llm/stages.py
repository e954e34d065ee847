"""Stages of the corpus pipeline (``corpus_pipeline.py``): (spark, docs, sf_dir) -> DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylva.llm.common import read_table, save
from sylva.llm.decontamination import drop_leaks
from sylva.llm.jaccard_join import jaccard_components, with_class
from sylva.llm.mixing import mix_sources, n_words, text_digest
from sylva.llm.sharding import shard_documents
from sylva.llm.toxicity import fit_lexicon, reject_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject; the lexicon is fitted on these documents' labels."""
    lexicon = fit_lexicon(docs, read_table(spark, sf_dir, "labels"))
    return reject_toxic(docs, lexicon)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join: the one with the smallest id, one without an id only if none has one.

    Documents without words are linked with nothing and all stay, but of those that repeat an id and its text one stays.
    Rows whose id is null or repeated are told apart by the class of their set.
    """
    found = save(jaccard_components(docs), "components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "cid"))
    chosen = found.where("root IS NOT NULL").groupBy("root").agg(first.alias("row")).select("row.doc_id", "row.cid")
    chosen = save(chosen.unionByName(found.where("root IS NULL").select("doc_id", "cid")).distinct(), "chosen")
    unclear = save(found.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select("doc_id"), "unclear")
    kept = docs.join(chosen, "doc_id", "left_semi").select(*docs.columns)
    if unclear.isEmpty():
        return kept
    rows = with_class(docs.join(unclear, "doc_id", "left_semi").select(*docs.columns)
                      .unionByName(docs.where("doc_id IS NULL")), "_cid")
    same = rows["doc_id"].eqNullSafe(chosen["doc_id"]) & rows["_cid"].eqNullSafe(chosen["cid"])
    rows = rows.join(chosen, same, "left_semi")
    one = Window.partitionBy("doc_id", "_cid").orderBy("text")
    worded = rows.where("_cid IS NOT NULL").withColumn("_n", F.row_number().over(one)).where("_n = 1")
    empty = rows.where("_cid IS NULL")
    return reduce(DataFrame.unionByName, [part.select(*docs.columns) for part in (
        kept.join(unclear, "doc_id", "left_anti"), worded, empty.where("doc_id IS NULL"),
        empty.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]))])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as many times (0 to 2) as its source's budget takes it."""
    rows = docs.select("doc_id", "source", n_words().alias("n"), text_digest().alias("digest"), F.struct(*docs.columns).alias("row"))
    taken = mix_sources(rows, F.col("n"), digest=F.col("digest")).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.expr("sequence(1, copies)"))).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard table of the mix."""
    return shard_documents(docs)
