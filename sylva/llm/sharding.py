"""Operator 2: contiguous shards of near equal size (minimax contiguous partition), DataFrame functions only.

Rows are put in one global order, atomic groups stay whole, and the order is cut into shards so that the
largest shard is as small as any contiguous cut allows. The smallest feasible capacity is found by a search
over capacities: each round tries ``TRIES`` capacities at once and checks all of them greedily, one lookup
job per shard ("how far does a shard that starts here reach?"). Groups are places on the line of all bytes, cut
into buckets of equal width; a lookup is an equi-join on the bucket and gives one row for each capacity.

A group that is larger than an even share sets that capacity by itself and stands alone in its shard. Filling up to it would
leave other shards empty, so the stretches before and after it are cut again, each with its part of the shards
left, at its own smallest capacity.

Defined results: a null group value is one group of its own; rows repeated whole take consecutive slots; an
empty table gives an empty result; with fewer groups than shards the later shards stay empty; input columns
named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylva.llm.common import range_sorted, read_table, running_total, save

N_SHARDS = 24
TRIES = 1000
GROUPS_PER_BUCKET = 64


def _inline(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    values = ", ".join("(" + ", ".join(f"{v}L" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def _reach(places: DataFrame, width: int, limits: dict[int, int]) -> dict[int, tuple]:
    """For each key: the group that holds the byte at the limit, as (its start, group, rows before it).

    A shard filled up to the limit ends where that group starts. Every byte lies in exactly one group,
    so each probe matches one row.
    """
    spark = places.sparkSession
    probes = _inline(spark, ["id", "most", "bucket"], [(k, x, x // width) for k, x in limits.items()])
    near = places.where(F.col("bucket").between(min(limits.values()) // width, max(limits.values()) // width))
    hit = (near.join(F.broadcast(probes), "bucket").where("start_bytes <= most AND most < end_bytes")
           .select("id", "start_bytes", "_group", "start_rows"))
    return {r.id: (r.start_bytes, r._group, r.start_rows) for r in hit.collect()}


def _greedy(places: DataFrame, width: int, total: int, capacities: list[int], n: int) -> dict[int, list[tuple] | None]:
    """The inner cuts that greedy filling makes for each capacity; None if ``n`` shards do not hold everything."""
    cuts: dict[int, list[tuple]] = {c: [] for c in capacities}
    going = {c: c for c in capacities if c < total}
    for _ in range(n - 1):
        if not going:
            break
        for c, found in _reach(places, width, going).items():
            cuts[c].append(found)
        going = {c: cuts[c][-1][0] + c for c in going if cuts[c][-1][0] + c < total}
    return {c: None if c in going else cut for c, cut in cuts.items()}


def minimax_cuts(ends: DataFrame, n: int) -> list[tuple]:
    """Inner cuts (start_bytes, first group after the cut, rows before it) of contiguous shards with the smallest maximum.

    ``ends`` has one row a group: _group, bytes, end_bytes, start_rows. Where one group alone sets the maximum,
    the shards on both sides of it are made as even as they can be (see the module text).
    """
    cuts, capacity = _smallest_cuts(ends, n)
    hot = ends.agg(F.max_by(F.struct("_group", "bytes", "end_bytes", "start_rows"), F.struct("bytes", "_group")).alias("g"),
                   F.max("end_bytes").alias("total"), F.count("*").alias("n")).first()
    if not hot.n or capacity > hot.g.bytes or capacity * n <= hot.total + n:
        return cuts
    start, end = hot.g.end_bytes - hot.g.bytes, hot.g.end_bytes
    before, after = ends.where(F.col("end_bytes") <= start), ends.where(F.col("end_bytes") > end)
    n_before, n_after = before.count(), after.count()
    used = sum(1 for c in cuts if c[0] <= start)  # shards that the stretch before needs at this capacity
    needs = len(cuts) + 1 - used - 1
    share = round((n - 1) * start / max(1, hot.total - hot.g.bytes))
    left = min(max(share, used, n - 1 - n_after), n - 1 - needs, max(used, n_before)) if n_before else 0
    right = min(n - 1 - left, max(needs, n_after))
    out = minimax_cuts(before, left) if left > 1 else []
    if n_before:
        out.append((start, hot.g._group, hot.g.start_rows))
    if n_after:
        following = after.agg(F.min_by(F.struct("_group", "start_rows"), "end_bytes").alias("g")).first().g
        out.append((end, following._group, following.start_rows))
        if right > 1:
            rest = minimax_cuts(after.withColumn("end_bytes", F.col("end_bytes") - end), right)
            out += [(c[0] + end, *c[1:]) for c in rest]
    return out


def _smallest_cuts(ends: DataFrame, n: int) -> tuple[list[tuple], int]:
    """Inner cuts by greedy filling at the smallest feasible capacity, and that capacity."""
    stats = ends.agg(F.max("end_bytes").alias("total"), F.max("bytes").alias("largest"), F.count("*").alias("n")).first()
    if not stats.n:
        return [], 0
    total, largest = int(stats.total), int(stats.largest)
    # buckets of some GROUPS_PER_BUCKET groups; a group stands in each bucket that it reaches into
    width = max(1, total * GROUPS_PER_BUCKET // int(stats.n))
    start = F.col("end_bytes") - F.col("bytes")
    reached = F.sequence(F.floor(start / width), F.floor((F.col("end_bytes") - 1) / width))
    places = save(ends.withColumn("start_bytes", start).withColumn("bucket", F.explode(reached))
                  .repartitionByRange("bucket").sortWithinPartitions("bucket"), "shard-places")
    low = max(-(-total // n), largest)
    high = max(low, -(-total // n) + largest)  # always feasible: a shard that closes early holds over total / n
    while True:
        step = max(1, -(-(high - low) // TRIES))
        tried = sorted({*range(low, high, step), high})
        cuts = _greedy(places, width, total, tried, n)
        good = min(c for c in tried if cuts[c] is not None)
        worse = [c for c in tried if c < good]
        if not worse or good - worse[-1] == 1:
            return cuts[good], good
        low, high = worse[-1] + 1, good


def shard_minimax(df: DataFrame, group: Column, size: Column, ties: list[str], n_shards: int = N_SHARDS) -> DataFrame:
    """Add ``shard`` (0 to n_shards - 1) and ``slot`` (place in the shard, gapless from 0) to every row.

    ``group`` is a non-null string that rows of one atomic group share and that also gives the global
    order; ``size`` is a positive whole number; ``ties`` orders the rows of a group.
    """
    rows = df.drop("shard", "slot", "part", "seq").withColumn("_group", group).withColumn("_size", size.cast("long"))
    t = range_sorted(rows, [F.col("_group"), *[F.col(c) for c in ties]], "shard-rows")
    pieces = t.groupBy("part", "_group").agg(F.sum("_size").alias("piece"), F.count("*").alias("n"))
    pieces = running_total(pieces, F.col("piece"), "before", "_group")
    pieces = running_total(pieces, F.col("n"), "rows_before", "_group")
    groups = pieces.groupBy("_group").agg(
        F.sum("piece").alias("bytes"), F.max(F.col("before") + F.col("piece")).alias("end_bytes"),
        F.min("rows_before").alias("start_rows"))
    cuts = minimax_cuts(save(groups, "shard-groups"), n_shards)
    starts = [0, *[c[2] for c in cuts]]
    shard = F.lit(0)
    for _, first_after, _ in cuts:
        shard = shard + (F.col("_group") >= F.lit(first_after)).cast("int")
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("shard") + 1)
    first = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (t.groupBy("part").agg(F.count("*").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("_offset")))
    return (t.withColumn("shard", shard).join(F.broadcast(offsets), "part")
            .withColumn("slot", F.col("_offset") + F.col("seq") - start)
            .drop("_offset", "part", "seq", "_group", "_size"))


def text_group(text: str = "text") -> Column:
    """Key of equal texts; '' stands for the null text, which no digest equals."""
    return F.coalesce(F.sha2(F.col(text), 256), F.lit(""))


def text_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 8


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """Shard table of documents under the ``bytes`` law; equal texts stay together.

    Result: doc_id, size, text_crc32 (null for a null text), law, shard, slot, grown_shard (null).
    """
    digest = docs.select("doc_id", text_size().alias("size"), F.crc32(F.col("text")).alias("text_crc32"),
                         text_group().alias("text_key"))
    out = shard_minimax(digest, F.col("text_key"), F.col("size"), ["doc_id"], n_shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                      F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def op2_shard_minimax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))
