"""Operators as SQL table functions.

:func:`register_functions` makes temporary views of the tables it is given and temporary table functions over them, so
that ``SELECT * FROM error_lines('OK', 'PT')`` and joins with other tables can be written in ``spark.sql``. A function is
its query, which Spark puts in place of the call: filters and column choices of the caller reach into it.

===================================  ============================================================  ====================
Function                             Columns                                                       Needs
===================================  ============================================================  ====================
``ok_pt_pairs(ok, pt)``              problem_id, user_id, ok_id, pt_id                             ``submissions``
``path_contexts(tokens, split, n)``  doc_id, leaf_ord, branch, key, token                          ``encoded``
``error_lines(ok, pt)``              problem_id, user_id, ok_id, pt_id, line                       both
``numbered_lines()``                 doc_id, line_no, listing                                      ``sources``
``toggled_lines()``                  problem_id, user_id, line                                     ``clicks``
===================================  ============================================================  ====================

All arguments have defaults. A policy name that does not exist raises when the function is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.operators import contexts, diff, labels

_PAIRS = """
CREATE OR REPLACE TEMPORARY FUNCTION ok_pt_pairs(ok STRING DEFAULT 'OK', pt STRING DEFAULT 'PT')
RETURNS TABLE (problem_id STRING, user_id STRING, ok_id STRING, pt_id STRING)
RETURN SELECT problem_id, user_id, ok_id, pt_id FROM sylva_pairs
  WHERE ok_status = ok_pt_pairs.ok AND pt_status = ok_pt_pairs.pt"""

_CONTEXTS = """
CREATE OR REPLACE TEMPORARY FUNCTION path_contexts(tokens STRING DEFAULT 'masked_identifiers',
                                                   split STRING DEFAULT 'ids_hash', n INT DEFAULT 5)
RETURNS TABLE (doc_id STRING, leaf_ord INT, branch STRING, key STRING, token STRING)
RETURN SELECT doc_id, leaf_ord, branch, key, token FROM sylva_contexts
  WHERE path_len >= path_contexts.n AND CASE
    WHEN path_contexts.tokens NOT IN ({tokens}) THEN raise_error('unknown tokenizer ' || path_contexts.tokens)::BOOLEAN
    WHEN path_contexts.split NOT IN ({splits}) THEN raise_error('unknown split strategy ' || path_contexts.split)::BOOLEAN
    ELSE tokens_name = path_contexts.tokens AND split_name = path_contexts.split END"""

_LINES = """
CREATE OR REPLACE TEMPORARY FUNCTION error_lines(ok STRING DEFAULT 'OK', pt STRING DEFAULT 'PT')
RETURNS TABLE (problem_id STRING, user_id STRING, ok_id STRING, pt_id STRING, line INT)
RETURN SELECT DISTINCT problem_id, user_id, ok_id, pt_id, leaf_row FROM sylva_lines
  WHERE ok_status = error_lines.ok AND pt_status = error_lines.pt"""

_NUMBERED = """
CREATE OR REPLACE TEMPORARY FUNCTION numbered_lines() RETURNS TABLE (doc_id STRING, line_no INT, listing STRING)
RETURN SELECT doc_id, line_no, listing FROM sylva_listing"""

_TOGGLED = """
CREATE OR REPLACE TEMPORARY FUNCTION toggled_lines() RETURNS TABLE (problem_id STRING, user_id STRING, line INT)
RETURN SELECT problem_id, user_id, line FROM sylva_toggled"""


def _status_pairs(submissions: DataFrame) -> DataFrame:
    """First submissions of every user for any two statuses; a filter on the statuses goes below the aggregates."""
    first = (submissions.where("status IS NOT NULL").groupBy("problem_id", "user_id", "status")
             .agg(F.min("submission_id").alias("id")))
    one, two = (first.select("problem_id", "user_id", F.col("status").alias(f"{side}_status"), F.col("id").alias(f"{side}_id"))
                for side in ("ok", "pt"))
    return one.join(two, ["problem_id", "user_id"])


def _status_lines(pairs: DataFrame, encoded: DataFrame) -> DataFrame:
    """Leaves of every pair's second tree whose signature its first tree does not have."""
    signed = diff.signatures(encoded).select("doc_id", "leaf_row", F.unhex(F.md5("signature")).alias("sig"))
    key = ["problem_id", "user_id", "ok_status", "pt_status"]
    pt = pairs.join(signed.withColumnRenamed("doc_id", "pt_id"), "pt_id")
    ok = pairs.join(signed.withColumnRenamed("doc_id", "ok_id"), "ok_id").select(*key, "sig")
    return pt.join(ok, [*key, "sig"], "left_anti")


def register_functions(spark: SparkSession, submissions: DataFrame | None = None, encoded: DataFrame | None = None,
                       sources: DataFrame | None = None, clicks: DataFrame | None = None) -> list[str]:
    """Register the functions whose tables are given; returns their names.

    ``encoded`` (``encoded_paths`` with ``path_ids``, ``path_len`` and ``fork_ids``) is read by every call, so it
    should be a written table.
    """
    made = []

    def make(name: str, text: str, **views: DataFrame) -> None:
        for view, df in views.items():
            df.createOrReplaceTempView(view)
        spark.sql(text)
        made.append(name)

    if submissions is not None:
        make("ok_pt_pairs", _PAIRS, sylva_pairs=_status_pairs(submissions))
    if encoded is not None:
        named = [contexts.branches(encoded, min_len=0, tokenizer=t, split=s, keep=("path_len",))
                 .select("*", F.lit(t).alias("tokens_name"), F.lit(s).alias("split_name"))
                 for t in contexts.TOKENIZERS for s in contexts.SPLITS]
        text = _CONTEXTS.format(tokens=", ".join(f"'{t}'" for t in contexts.TOKENIZERS),
                                splits=", ".join(f"'{s}'" for s in contexts.SPLITS))
        union = named[0]
        for more in named[1:]:
            union = union.unionByName(more)
        make("path_contexts", text, sylva_contexts=union)
    if submissions is not None and encoded is not None:
        make("error_lines", _LINES, sylva_lines=_status_lines(_status_pairs(submissions), encoded))
    if sources is not None:
        make("numbered_lines", _NUMBERED, sylva_listing=labels.numbered_lines(sources))
    if clicks is not None:
        make("toggled_lines", _TOGGLED, sylva_toggled=labels.toggled_lines(clicks))
    return made
