"""The corpus pipeline: ``documents`` through five stages, each an operator of ``sylva.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result to the shared
folder and hands the table read back to the next one. All stages but the last return the columns of ``documents``.
The result is the shard table: one row for each document of the mix (twice if the mix repeats it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylva.llm import stages
from sylva.llm.common import read_table, save

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("jaccard_join", stages.drop_near_copies),
    ("decontamination", stages.drop_contaminated),
    ("mixing", stages.mix),
    ("sharding", stages.shard),
]

#: Learned scores and similarity components have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
