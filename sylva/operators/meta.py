"""Operators over the ``submissions`` metadata table.

Ids are strings and compare in byte order (``'10' < '9'``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylva.functions.text import with_extension

FIELDS = ["submission_id", "problem_id", "user_id", "language", "status"]


def ok_pt_pairs(submissions: DataFrame, ok_status: str = "OK", pt_status: str = "PT",
                problems: Iterable[str] | None = None, limit: int | None = None,
                ext: str = "cpp") -> DataFrame:
    """First (OK, PT) pair of every user in every problem.

    The first pair in (ok_id, pt_id) order of a user's OK x PT product is
    (smallest OK id, smallest PT id), so one aggregate per (problem, user)
    gives it without building the product: partial aggregation runs map-side,
    and a user with very many submissions costs nothing extra.

    ``limit`` keeps the first ``limit`` pairs of each problem in
    (ok_id, pt_id) order. ``ext`` is appended to make the file names.
    """
    s = submissions
    if problems is not None:
        s = s.where(F.col("problem_id").isin(list(problems)))
    s = s.where(F.col("status").isin(ok_status, pt_status))
    pairs = (s.groupBy("problem_id", "user_id")
             .agg(F.min(F.when(F.col("status") == ok_status, F.col("submission_id"))).alias("ok_id"),
                  F.min(F.when(F.col("status") == pt_status, F.col("submission_id"))).alias("pt_id"))
             .where(F.col("ok_id").isNotNull() & F.col("pt_id").isNotNull()))
    if limit is not None:
        if limit < 1:
            raise ValueError("limit must be >= 1")
        w = Window.partitionBy("problem_id").orderBy("ok_id", "pt_id")
        pairs = pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")
    return pairs.select("problem_id", "user_id", "ok_id", "pt_id",
                        with_extension("ok_id", F.lit(ext)).alias("ok_file"),
                        with_extension("pt_id", F.lit(ext)).alias("pt_file"))


def ok_pt_candidates(submissions: DataFrame, ok_status: str = "OK", pt_status: str = "PT") -> DataFrame:
    """The candidate set of the ranked OK x PT self-join per (problem, user), without building it.

    ``n_ok``, ``n_pt`` and ``n_candidates`` (= ``n_ok * n_pt``, the rows the
    join would produce) and the rank-1 candidate ``ok_id, pt_id``; users
    with no OK or no PT submission have no candidates and are left out.
    """
    s = submissions.where(F.col("status").isin(ok_status, pt_status))
    is_ok = F.col("status") == ok_status
    g = s.groupBy("problem_id", "user_id").agg(
        F.count(F.when(is_ok, 1)).alias("n_ok"),
        F.count(F.when(~is_ok, 1)).alias("n_pt"),
        F.min(F.when(is_ok, F.col("submission_id"))).alias("ok_id"),
        F.min(F.when(~is_ok, F.col("submission_id"))).alias("pt_id"),
    )
    return (g.where((F.col("n_ok") > 0) & (F.col("n_pt") > 0))
            .select("problem_id", "user_id", "n_ok", "n_pt", (F.col("n_ok") * F.col("n_pt")).alias("n_candidates"),
                    "ok_id", "pt_id"))


def other_solutions(submissions: DataFrame, keys: DataFrame, status: str = "OK") -> DataFrame:
    """Submissions of each (problem, user) in ``keys`` whose status differs from ``status``.

    A NULL status is not different from anything (SQL ``!=``), so it is dropped.
    """
    k = keys.select("problem_id", "user_id").distinct()
    return (submissions.join(k, ["problem_id", "user_id"], "left_semi")
            .where(F.col("status") != F.lit(status))
            .select("problem_id", "user_id", "submission_id", "status"))


def lookup_submissions(submissions: DataFrame, ids: DataFrame | str, id_col: str = "submission_id") -> DataFrame:
    """Metadata rows of the given ids (one id, or a DataFrame of ids); missing ids give no row."""
    if isinstance(ids, str):
        return submissions.where(F.col("submission_id") == F.lit(ids)).select(*FIELDS)
    k = ids.select(F.col(id_col).alias("submission_id")).distinct()
    return submissions.join(k, "submission_id", "left_semi").select(*FIELDS)


def duplicate_keys(df: DataFrame, key: str = "submission_id") -> DataFrame:
    """Keys that occur more than once, with their count (uniqueness check as a query)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def assert_unique(df: DataFrame, key: str = "submission_id") -> None:
    """Raise ``ValueError`` when ``key`` is not unique (an action)."""
    dup = duplicate_keys(df, key).limit(1).collect()
    if dup:
        raise ValueError(f"key {key!r} is not unique: {dup[0][key]!r}")


def incomplete_expr(cols: Iterable[str] = FIELDS) -> Column:
    """True when any of ``cols`` is NULL or empty."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | (F.coalesce(F.col(c), F.lit("")) == F.lit(""))
    return cond


def incomplete_rows(submissions: DataFrame) -> DataFrame:
    """Rows with an empty or missing field."""
    return submissions.where(incomplete_expr()).select(*FIELDS)


def adhoc_sql(submissions: DataFrame, query: str, args: dict | None = None,
              view: str = "submissions") -> DataFrame:
    """Run a parameterised SQL query over the metadata registered as ``view``.

    Values go in through ``args`` (named ``:markers``), never by string
    formatting. The result must have the five metadata columns.
    """
    spark = submissions.sparkSession
    submissions.createOrReplaceTempView(view)
    out = spark.sql(query, args=args or {})
    if len(out.columns) != len(FIELDS):
        raise ValueError(f"ad-hoc query must return {len(FIELDS)} columns, got {out.columns}")
    return out.toDF(*FIELDS)


def write_lookup_layout(submissions: DataFrame, path: str, files: int | None = None, id_col: str = "submission_id") -> None:
    """Write metadata for point lookups: range-sorted by id into ``files`` files, with a Bloom filter on the id.

    A lookup skips files and row groups by their smallest and largest id, and by the Bloom filter where the id would
    fit but is not there.
    """
    n = files or int(submissions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (submissions.repartitionByRange(n, id_col).sortWithinPartitions(id_col).write.mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{id_col}", "true")
     .option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path))


def point_lookup(spark: SparkSession, path: str, key: str, id_col: str = "submission_id") -> DataFrame:
    """The rows of one id from a layout of :func:`write_lookup_layout`; the id is a pushed-down filter."""
    return spark.read.parquet(path).where(F.col(id_col) == key)
