"""Operator 6: mix sources to target weights with hash-random keys, a range sort and prefix sums.

Every source gets a budget of words. Its documents are put in a random but repeatable order (md5 of a seed,
the id and the text's digest, so that rows without an id or with the same one have an order too; rows that are equal in
all of it are interchangeable), the whole corpus is range-sorted by (source, key), and the sum of words before each document
within its source comes from running totals per range plus one offset per range. A source takes whole epochs
as long as its budget holds them and then the documents up to the place nearest to the rest of its budget:
a document counts if its middle lies at or before the cut, so the source's total misses its budget by at
most half of one document.

Defined results: a null source is a source of its own, last in the order of weights; a document without words
(null, empty or only blanks) has size 0 and takes 0 words; repeated rows are separate documents; an empty
table gives an empty result; a very long text is one document, taken whole or not. The source table has one row a source and is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylva.llm.common import range_sorted, read_table, running_total, save
from sylva.llm.words import WORD

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix-1"
OWN = ("size", "source_size", "target", "taken", "copies", "part", "seq")


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def text_digest(text: str = "text") -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def order_key(seed: str, digest: Column, doc_id: str = "doc_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), digest))


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_EPOCHS) -> DataFrame:
    """(source, place, source_size, target): ``share`` of all words by weight, at most ``most`` times a source.

    What a source cannot take goes to the others by weight, again and again until none is above its limit.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1)
    sources = save(sized.groupBy("source").agg(F.sum("size").alias("source_size"))
                   .withColumn("place", place).withColumn("weight", weight), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit, level, full = F.col("source_size") * float(most), 0.0, -1
    while True:  # the level only rises, so at most one round a source
        above = F.col("weight") * F.lit(level) > limit
        r = sources.agg(F.count(F.when(above, 1)).alias("n"), F.sum(F.when(above, limit).otherwise(0.0)).alias("held"),
                        F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if r.n == full or not r.open:
            break
        full, level = r.n, (share * total - r.held) / r.open
    target = F.when(F.col("weight") * F.lit(level) > limit, limit).otherwise(F.col("weight") * F.lit(level))
    return sources.select("source", "place", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, size: Column | None = None, weights: tuple[float, ...] = WEIGHTS,
                share: float = SHARE, most: int = MOST_EPOCHS, seed: str = SEED, digest: Column | None = None) -> DataFrame:
    """All rows of ``docs`` with size, source_size, target, copies (times the mix holds it) and taken (words).

    ``digest`` (default: md5 of the column ``text``) tells rows with the same id apart.
    """
    key = order_key(seed, text_digest() if digest is None else digest)
    rows = (docs.withColumn("_size", size if size is not None else n_words()).withColumn("_key", key).drop(*OWN)
            .withColumnRenamed("_size", "size"))
    t = range_sorted(rows, [F.col("source").asc_nulls_last(), F.col("_key"), F.col("doc_id"), F.col("size")], "mix-rows")
    targets = source_targets(t, weights, share, most)
    earlier = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    targets = targets.withColumn("_source_start", F.coalesce(F.sum("source_size").over(earlier), F.lit(0)))
    t = running_total(t, F.col("size"), "_before").withColumnRenamed("source", "_source")
    t = (t.join(targets, t["_source"].eqNullSafe(targets["source"])).drop("_source")
         .withColumn("_inside", F.col("_before") - F.col("_source_start")))
    epochs = F.least(F.lit(most), F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                     .otherwise(F.lit(1)))
    rest = F.col("target") - F.col("_epochs") * F.col("source_size")
    extra = (F.col("_epochs") < most) & (F.col("size") > 0) & (F.col("_inside") + F.col("size") / 2 <= rest)
    return (t.withColumn("_epochs", epochs).withColumn("copies", (F.col("_epochs") + extra.cast("int")).cast("int"))
            .withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
            .drop("_before", "_inside", "_source_start", "_epochs", "_key", "part", "seq", "place"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    sized = save(docs.select("doc_id", "source", n_words().alias("size"), text_digest().alias("digest")), "mix-sizes")
    return (mix_sources(sized, F.col("size"), digest=F.col("digest"))
            .select("doc_id", F.col("size").cast("long"), F.col("source_size").cast("long"),
                    F.col("target").cast("double"), "taken"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k FROM documents
), s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
s AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s0),
w AS (SELECT source, source_size, CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s),
k AS (SELECT *, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) - 1 AS n_capped,
        coalesce(sum(2.0::DOUBLE * source_size) OVER o, 0) AS held, sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS open,
        sum(source_size) OVER () AS total
      FROM w WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT max((1.5::DOUBLE * total - held) / open) AS level FROM k),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * level) AS target FROM w, lv),
d AS (SELECT doc_id, size, source_size, target,
        least(2, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 1 END) AS epochs,
        coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY sized.k, doc_id, size
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside
      FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((epochs + CASE WHEN epochs < 2 AND size > 0 AND inside + size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM d
"""
