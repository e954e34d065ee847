"""Line listings, reviewer clicks and label resolution (the review tool as batch data work).

Lines are 0-based in labels and clicks, 1-based in listings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.functions.text import numbered_line, split_lines, with_extension
from sylva.operators.sampling import range_rank
from sylva.session import write_table

PAIR_KEY = ["problem_id", "user_id"]


def text_lines(sources: DataFrame) -> DataFrame:
    """One row per line: ``doc_id, line`` (0-based), ``text``."""
    return sources.select("doc_id", F.posexplode(split_lines("text")).alias("line", "text"))


def numbered_lines(sources: DataFrame) -> DataFrame:
    """Listing rows ``doc_id, line_no`` (1-based), ``listing`` = ``'%5d  %s'``."""
    tl = text_lines(sources)
    return tl.select("doc_id", (F.col("line") + 1).alias("line_no"),
                     numbered_line(F.col("line") + 1, F.col("text")).alias("listing"))


def toggled_lines(clicks: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Lines selected after all clicks: a line is on iff clicked an odd number of times."""
    k = key or PAIR_KEY
    return (clicks.groupBy(*k, "line").agg(F.count(F.lit(1)).alias("n_clicks"))
            .where(F.col("n_clicks") % 2 == 1)
            .select(*k, "line"))


def resolved_labels(pairs: DataFrame, auto_lines: DataFrame, manual_lines: DataFrame,
                    reviewed_empty_ok: bool = False, reviewed: DataFrame | None = None) -> DataFrame:
    """Final label lines per pair: the reviewer's lines when there are any, else the automatic ones.

    ``manual_lines`` are toggled lines (``problem_id, user_id, line``). With
    ``reviewed_empty_ok=True`` a pair listed in ``reviewed`` with no manual
    lines gets no lines instead of the automatic ones. Output:
    ``problem_id, user_id, pt_id, line, origin``.
    """
    p = pairs.select(*PAIR_KEY, "pt_id")
    manual = manual_lines.select(*PAIR_KEY, "line").join(p, PAIR_KEY).withColumn("origin", F.lit("manual"))
    auto = auto_lines.select(*PAIR_KEY, "line").join(p, PAIR_KEY)
    overridden = manual_lines.select(*PAIR_KEY)
    if reviewed_empty_ok and reviewed is not None:
        overridden = overridden.unionByName(reviewed.select(*PAIR_KEY))
    auto = auto.join(overridden.distinct(), PAIR_KEY, "left_anti").withColumn("origin", F.lit("auto"))
    return manual.unionByName(auto).select(*PAIR_KEY, "pt_id", "line", "origin").distinct()


def label_lines(pairs: DataFrame, labels: DataFrame, ext: str = "cpp", reviewed: DataFrame | None = None) -> DataFrame:
    """Label file rows: ``<pt file> <l1> <l2> ...`` with lines ascending; a pair with no lines is the bare name.

    With ``reviewed`` (``problem_id, user_id``) only those pairs get a row.
    """
    if reviewed is not None:
        pairs = pairs.join(reviewed.select(*PAIR_KEY).distinct(), PAIR_KEY, "left_semi")
    per_pair = labels.groupBy(*PAIR_KEY).agg(F.array_sort(F.collect_set("line")).alias("lines"))
    j = pairs.select(*PAIR_KEY, "pt_id").join(per_pair, PAIR_KEY, "left")
    name = with_extension("pt_id", F.lit(ext))
    lines = F.transform(F.coalesce("lines", F.array().cast("array<int>")), lambda x: x.cast("string"))
    return j.select(*PAIR_KEY, name.alias("pt_file"),
                    F.size(F.coalesce("lines", F.array().cast("array<int>"))).alias("n_lines"),
                    F.concat_ws(" ", name, lines).alias("label_line"))


def review_sheet(pairs: DataFrame, listings: DataFrame, error_lines: DataFrame,
                 statements: DataFrame | None = None) -> DataFrame:
    """Side-by-side review rows for every pair.

    ``listings`` has ``doc_id, line, text`` (0-based lines, e.g. from
    :func:`text_lines`). Every pair has a head row (``line_no`` 0) with its
    position ``i / n`` in the problem and the problem's statement
    (``problem_id, statement``), then one row per line number of either side or
    of an automatic error, which ``suspect`` marks.
    """
    base = pairs.select(*PAIR_KEY, "ok_id", "pt_id")
    n = base.groupBy("problem_id").agg(F.count(F.lit(1)).alias("n_pairs"))
    p = range_rank(base, ["problem_id"], ["ok_id", "pt_id"], "pos").join(n, "problem_id")
    position = F.format_string("%d / %d", F.col("pos"), F.col("n_pairs"))
    p = write_table(p.select(*PAIR_KEY, "ok_id", "pt_id", position.alias("position")), "pairs")  # read by every part below
    none = F.lit(None).cast("string")
    pt = p.join(listings.select(F.col("doc_id").alias("pt_id"), "line", F.col("text").alias("pt_text")), "pt_id")
    ok = p.join(listings.select(F.col("doc_id").alias("ok_id"), "line", F.col("text").alias("ok_text")), "ok_id")
    err = p.join(error_lines.select(*PAIR_KEY, "line"), PAIR_KEY)
    key = [*PAIR_KEY, "ok_id", "pt_id", "position", "line"]
    sides = (pt.select(*key, "pt_text", none.alias("ok_text"), F.lit(False).alias("suspect"))
             .unionByName(ok.select(*key, none.alias("pt_text"), "ok_text", F.lit(False).alias("suspect")))
             .unionByName(err.select(*key, none.alias("pt_text"), none.alias("ok_text"), F.lit(True).alias("suspect"))))
    rows = sides.groupBy(*key).agg(F.max("pt_text").alias("pt_text"), F.max("ok_text").alias("ok_text"),
                                   F.max("suspect").alias("suspect"))
    number = F.col("line") + 1
    rows = rows.select(*PAIR_KEY, "ok_id", "pt_id", "position", none.alias("statement"), number.alias("line_no"),
                       *[F.when(F.col(c).isNotNull(), numbered_line(number, F.col(c))).alias(c.replace("text", "listing"))
                         for c in ("pt_text", "ok_text")], "suspect")
    heads = p if statements is None else p.join(statements.select("problem_id", "statement"), "problem_id", "left")
    return rows.unionByName(heads.select(
        *PAIR_KEY, "ok_id", "pt_id", "position", F.col("statement") if statements is not None else none.alias("statement"),
        F.lit(0).alias("line_no"), none.alias("pt_listing"), none.alias("ok_listing"), F.lit(False).alias("suspect")))


def tree_listing(nodes: DataFrame) -> DataFrame:
    """Listing of a tree's text: per document and 0-based row, its terminal values in document order.

    Rows without a terminal do not appear. Used as the listing of documents
    that exist only as trees.
    """
    leaves = nodes.where((F.col("child_count") == 0) & F.col("value").isNotNull())
    per_row = leaves.groupBy("doc_id", F.col("start_row").alias("line")).agg(
        F.array_sort(F.collect_list(F.struct("node_id", "value"))).alias("vs"))
    return per_row.select("doc_id", "line", F.array_join(F.transform("vs", lambda s: s["value"]), " ").alias("text"))
