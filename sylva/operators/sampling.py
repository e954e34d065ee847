"""Corpus selection: problem counts, top problems, seeded sampling, flattening, train/val split.

Random choices are reproducible: a row's rank is the order of
``md5('<seed>:<salt>:<id>')`` (ties by id), the same in Spark and in any SQL
engine with md5.

"First n per group" for a small n is a ``row_number`` filter, which Spark
plans as a group limit: every map task keeps n rows of a group before the
shuffle. A rank over a whole group or table (:func:`range_rank`) is taken in
ranges of the order itself, so no task sorts more than its own range, whatever
the keys look like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylva.session import write_table


def rank_key(seed: int | str, salt: str, id_col: str | Column) -> Column:
    """Seeded pseudo-random order key: ``md5('<seed>:<salt>:<id>')``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:{salt}:"), c))


def problem_counts(sources: DataFrame) -> DataFrame:
    """Files per problem (``problem_id, n_files``); map-side partial counts."""
    return sources.groupBy("problem_id").agg(F.count(F.lit(1)).alias("n_files"))


def top_problems(counts: DataFrame, n: int | None = None, distinct_counts: bool = False) -> DataFrame:
    """The ``n`` problems with most files (ties by name); all when ``n`` is None.

    ``distinct_counts=True`` keeps only one problem per count (the smallest
    name), as a ranking keyed by the count alone does.
    """
    c = counts
    if distinct_counts:
        c = c.groupBy("n_files").agg(F.min("problem_id").alias("problem_id"))
    c = c.select("problem_id", "n_files")
    if n is None:
        return c
    if n < 0:
        raise ValueError("n must be >= 0")
    return c.orderBy(F.desc("n_files"), F.asc("problem_id")).limit(n)


def first_n(df: DataFrame, group_cols: list[str], order: list[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group in the given order; ``n`` is meant to be small (see module text)."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def range_rank(df: DataFrame, group_cols: list[str], order_cols: list[str], rank: str = "rank") -> DataFrame:
    """Add the exact 1-based rank of each row in its group (or in the whole table, without group columns).

    The rows are range-sorted by (group, order) and written once with their
    place in the range; a rank is the place in the range's piece of the group
    plus the sizes of earlier pieces. There is one piece per group and range.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*group_cols, *order_cols]
    t = write_table(df.repartitionByRange(n, *by).sortWithinPartitions(*by)
                    .withColumn("_place", F.monotonically_increasing_id()), "rank")
    t = t.withColumn("_part", F.shiftright("_place", 33))
    pieces = t.groupBy("_part", *group_cols).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    w = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()).orderBy("_part")
    before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select(F.col("_part").alias("_p"), "_first", before.alias("_before"),
                           *[F.col(g).alias(f"_g_{i}") for i, g in enumerate(group_cols)])
    cond = [t["_part"] == pieces["_p"], *[t[g].eqNullSafe(pieces[f"_g_{i}"]) for i, g in enumerate(group_cols)]]
    return (t.join(pieces, cond)
            .withColumn(rank, (F.col("_before") + F.col("_place") - F.col("_first") + 1).cast("long"))
            .drop("_place", "_part", "_p", "_first", "_before", *[f"_g_{i}" for i in range(len(group_cols))]))


def sample_per_problem(sources: DataFrame, n: int | None = None, seed: int = 42) -> DataFrame:
    """``n`` random files of every problem without replacement (all of them when ``n`` is None or larger)."""
    if n is None:
        return sources
    if n < 0:
        raise ValueError("n must be >= 0")
    return first_n(sources, ["problem_id"], [rank_key(seed, "sample", "doc_id"), "doc_id"], n)


def sampled_files(counts: DataFrame, top: DataFrame, n: int | None = None) -> int:
    """Number of files that sampling ``n`` per problem of ``top`` takes, from the counts alone."""
    taken = F.col("n_files") if n is None else F.least(F.col("n_files"), F.lit(n))
    return counts.join(top.select("problem_id"), "problem_id", "left_semi").agg(F.sum(taken)).first()[0] or 0


def flatten_corpus(sampled: DataFrame, counts: DataFrame) -> DataFrame:
    """Put all problems' files into one namespace; on a name clash the later copy wins.

    Problems are copied in order of (files desc, name asc) and files of a
    problem in id order, so the winner of a name is the file of the problem
    with fewest files, then the largest problem name, then the largest id.
    The winner is a ``max`` over a struct, an aggregate with map-side partial
    results, so a name shared by very many files is cheap.
    """
    j = sampled.join(counts.select("problem_id", "n_files"), "problem_id")
    payload = [c for c in sampled.columns if c not in ("file_name", "text")]
    best = F.max(F.struct((-F.col("n_files")).alias("_neg"), F.col("problem_id").alias("_p"),
                          F.col("doc_id").alias("_d"), *[F.col(c).alias(f"_x_{c}") for c in payload]))
    win = j.groupBy("file_name").agg(best.alias("w"))
    return win.select(*[F.col(f"w._x_{c}").alias(c) for c in payload], "file_name")


def train_size(total: Column, split: int, exact: bool = False) -> Column:
    """Train size: ``split * (total div 100)``; ``exact=True`` gives ``(split * total) div 100``."""
    if exact:
        return F.floor(F.lit(split) * total / 100).cast("long")
    return F.lit(split).cast("long") * F.floor(total / 100).cast("long")


def train_val_split(pool: DataFrame, total: int | None = None, split: int = 75, seed: int = 42,
                    exact: bool = False) -> DataFrame:
    """Mark each pool file ``train`` or ``val``.

    The train size is computed from ``total``, the number of sampled files
    before name clashes were resolved (defaults to the pool's), and the train
    files are the first ones by a seeded rank over the pool.
    """
    if not 0 <= split <= 100:
        raise ValueError("split must be in 0..100")
    ranked = range_rank(pool.withColumn("_k", rank_key(seed, "split", "doc_id")), [], ["_k", "doc_id"], "_rank")
    n = total if total is not None else ranked.count()
    n_train = split * n // 100 if exact else split * (n // 100)
    return (ranked.withColumn("split", F.when(F.col("_rank") <= n_train, F.lit("train")).otherwise(F.lit("val")))
            .drop("_rank", "_k"))


DIGITS = 4  # hex digits of a key that one pass of selection tells apart: at most 16^4 counts come back
FEW = 10_000  # keys that are sorted on the driver at the end


def kth_key(keys: DataFrame, k: int) -> tuple[str, str] | None:
    """The ``k``-th smallest (``key``, ``doc_id``) of a saved table of hex keys, or None if it has fewer rows.

    Each pass counts the rows under the prefix found so far by their next ``DIGITS`` digits and goes on in the
    bin that holds the k-th; evenly spread keys need two or three passes for any number of rows. Rows are neither
    sorted nor moved. Beyond 32 digits, that is for one key with very many ids, the ids' own digests go on.
    """
    if k < 1:
        return None
    text = F.concat("key", F.md5("doc_id"))
    prefix, rest, left = "", keys, k
    while True:
        size = len(prefix) + DIGITS
        bins = sorted(tuple(r) for r in rest.groupBy(F.substring(text, 1, size).alias("bin")).count().collect())
        for name, n in bins:
            if left <= n:
                break
            left -= n
        else:
            return None
        prefix, rest = name, keys.where(F.substring(text, 1, size) == name)
        if n <= FEW or size >= 64:
            if size >= 64:  # rows of one id
                rest, left = rest.limit(1), 1
            return sorted((r.key, r.doc_id) for r in rest.collect())[left - 1]


def train_val_select(pool: DataFrame, total: int | None = None, split: int = 75, seed: int = 42,
                     exact: bool = False) -> DataFrame:
    """The result of :func:`train_val_split`, with the last train file found by selection (:func:`kth_key`).

    Only the keys are written, once; no rows are sorted, and the pool itself is not shuffled. Rows that share their
    id fall on the same side.
    """
    if not 0 <= split <= 100:
        raise ValueError("split must be in 0..100")
    keyed = pool.withColumn("_key", rank_key(seed, "split", "doc_id"))
    keys = write_table(keyed.select(F.col("_key").alias("key"), "doc_id"), "keys")
    n = total if total is not None else keys.count()
    n_train = split * n // 100 if exact else split * (n // 100)
    last = kth_key(keys, n_train)
    if last is None:
        train = F.lit(n_train >= 1)  # fewer files than train places
    else:
        train = (F.col("_key") < last[0]) | ((F.col("_key") == last[0]) & (F.col("doc_id") <= last[1]))
    return keyed.withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("val"))).drop("_key")
