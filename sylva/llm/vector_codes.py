"""Operator 11: product-quantisation codes of integer vectors, by value dictionaries of each dimension.

Every component x becomes floor(1024 * x). The kept vectors are stored once as blocks of up to ``BLOCK``
vectors: for each dimension of a block the sorted distinct integers (its dictionary) and one 16-bit dictionary
code a vector. A round tabulates, for each dimension, the squared differences of the dictionary's integers to
that dimension of all codebook entries; the distance of a part is then a sum of gathered table rows, without
any arithmetic on the vectors themselves. Blocks are independent, so dictionaries never grow with the table.
Tasks return one sum a (part, entry), which Spark adds up; the codebooks (entries x dimensions) are the only
thing that passes through the driver.

Defined results: a vector that is null or holds null or non-finite components is dropped; of fewer than
``entries`` kept vectors all are entries; rows that share an id are vectors of their own, ordered by their
components, null ids last; null labels are one label; an empty table, or one without a kept vector, gives an
empty result. Extra columns are ignored, whatever their names. Vectors of different lengths, lengths that
the parts do not divide, and components whose integers reach 2^27 (errors would not fit a long) raise
``ValueError``. There are no texts; a very long vector only makes tables of one dimension at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylva.llm.common import read_table, save
from sylva.operators.lookup import attach

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK = 4096  # vectors a block, at most 65,536 (codes have 16 bits)
STEP = 512  # vectors whose table rows are gathered at once
LARGEST = 1 << 27


def kept_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v) of the vectors without null or non-finite components; v is an array of doubles."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                           F.col(vector).cast("array<double>").alias("v"))
            .where(F.col("v").isNotNull() & finite))


def _integers(column: pa.Array) -> np.ndarray:
    """Components as integers, one row a vector."""
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors have different lengths")
    wide = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
    if wide.size and np.abs(wide).max() >= LARGEST:
        raise ValueError(f"a component lies beyond {LARGEST // SCALE}")
    return wide.astype(np.int64).reshape(len(column), sizes[0] if len(sizes) else 0)


def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            b = batch.slice(at, BLOCK)
            ints = _integers(b.column("v"))
            words, codes = [], []
            for d in range(ints.shape[1]):
                word, code = np.unique(ints[:, d], return_inverse=True)
                words.append(word.astype(np.int32))
                codes.append(code.reshape(-1).astype(np.uint16))
            one = [0, b.num_rows]
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(one, b.column("vec_id")), pa.ListArray.from_arrays(one, b.column("label")),
                 pa.array([ints.shape[1]], pa.int32()),
                 pa.array([np.array([len(w) for w in words], np.int32).tobytes()], pa.binary()),
                 pa.array([np.concatenate(words).tobytes() if words else b""], pa.binary()),
                 pa.array([np.concatenate(codes).tobytes() if codes else b""], pa.binary())],
                ["ids", "labels", "dims", "sizes", "words", "codes"])


def encode_blocks(kept: DataFrame) -> DataFrame:
    """One row a block: ids, labels, dims, sizes (words of each dimension), words, codes (by dimension)."""
    kinds = dict(kept.dtypes)
    schema = (f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, dims int, sizes binary, words binary, "
              "codes binary")
    return save(kept.mapInArrow(to_blocks, schema), "vector-blocks")


def _unpacked(batch: pa.RecordBatch, i: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Dictionaries of all dimensions and the codes (dimension x vector) of a block."""
    sizes = np.frombuffer(batch.column("sizes")[i].as_py(), np.int32)
    words = np.split(np.frombuffer(batch.column("words")[i].as_py(), np.int32).astype(np.int64), np.cumsum(sizes)[:-1])
    codes = np.frombuffer(batch.column("codes")[i].as_py(), np.uint16)
    n = len(batch.column("ids")[i])
    return (words if len(sizes) else []), codes.reshape(len(sizes), n)


def nearest(words: list[np.ndarray], codes: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties: the lowest) and squared distance, for every vector of a block's part.

    ``words`` and ``codes`` are those of the part's dimensions, ``book`` is entries x dimensions.
    """
    n = codes.shape[1]
    top = max([int(np.abs(w).max()) for w in words if len(w)] + [int(np.abs(book).max()) if book.size else 0])
    kind = np.int32 if len(words) * (2 * top) ** 2 < 2**31 else np.int64
    total = np.zeros((n, len(book)), kind)
    for d, word in enumerate(words):
        table = ((word[:, None] - book[None, :, d]) ** 2).astype(kind)
        for at in range(0, n, STEP):
            total[at:at + STEP] += table[codes[d, at:at + STEP]]
    best = total.argmin(axis=1)
    return best, total[np.arange(n), best].astype(np.int64)


def _assigner(books: list[np.ndarray]):
    """Per block: (best, distance) of all parts."""
    width = books[0].shape[1]

    def assign(words: list[np.ndarray], codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        if len(words) != width * len(books):
            raise ValueError("vectors have different lengths")
        return [nearest(words[p * width:(p + 1) * width], codes[p * width:(p + 1) * width], book)
                for p, book in enumerate(books)]
    return assign


def _sums(books: list[np.ndarray]):
    assign, k, width = _assigner(books), len(books[0]), books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((len(books), k), np.int64)
        total = np.zeros((len(books), k, width), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                words, codes = _unpacked(batch, i)
                for p, (best, _) in enumerate(assign(words, codes)):
                    count[p] += np.bincount(best, minlength=k)
                    for d in range(width):  # sums of one block stay below 2^53, so doubles are exact
                        values = words[p * width + d][codes[p * width + d]]
                        total[p, :, d] += np.bincount(best, values, minlength=k).astype(np.int64)
        parts, entries = np.nonzero(count)
        rows = total[parts, entries]
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), pa.array(entries, pa.int32()), pa.array(count[parts, entries]),
             pa.array(list(rows), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])
    return run


def learn_codebooks(blocks: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """``rounds`` rounds of: assign every part to its nearest entry, replace entries by their parts' floored means."""
    width = books[0].shape[1]
    for _ in range(rounds):
        sums = (blocks.mapInArrow(_sums(books), "part int, entry int, n long, total array<long>")
                .groupBy("part", "entry")
                .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[d]) for d in range(width)]).alias("total")))
        books = [b.copy() for b in books]
        for r in sums.collect():  # at most parts x entries rows
            books[r.part][r.entry] = [t // r.n for t in r.total or []]
    return books


def first_entries(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids, found in two bounded steps (64 groups, then all)."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    w = Window.partitionBy("_group").orderBy(*order)
    few = (kept.select("vec_id", "v").withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(64)))
           .withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= entries)
           .orderBy(*order).limit(entries).select("v").collect())
    if not few:
        return []
    ints = _integers(pa.array([r.v for r in few], pa.list_(pa.float64())))
    if ints.shape[1] % parts:
        raise ValueError(f"vectors of {ints.shape[1]} components cannot be cut into {parts} parts")
    return np.split(ints, parts, axis=1)


def _final(books: list[np.ndarray]):
    assign = _assigner(books)
    hexes = np.array([f"{i:02x}" for i in range(len(books[0]))], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = assign(*_unpacked(batch, i))
                code, error = hexes[found[0][0]], found[0][1].copy()
                for best, distance in found[1:]:
                    code, error = code + hexes[best], error + distance
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("labels")[i].values,
                     pa.array(code, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])
    return run


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' integers by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def compress_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES,
                     rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every kept vector, and the codebooks (one array entries x dimensions a part)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    kept = kept_vectors(vectors, vec_id, vector, label)
    books = first_entries(kept, parts, entries)
    if not books:
        none = kept.where("false").select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none, books
    blocks = encode_blocks(kept)
    books = learn_codebooks(blocks, books, rounds)
    kinds = dict(kept.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return save(blocks.mapInArrow(_final(books), schema), "vector-codes"), books


def decode_vectors(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, v): the codebook entries that each code names, as integers."""
    tables = [F.array(*[F.array(*[F.lit(int(x)) for x in row]) for row in b]) for b in books]
    at = [F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") + 1 for p in range(len(books))]
    return codes.select("vec_id", F.concat(*[F.element_at(t, i) for t, i in zip(tables, at)]).alias("v"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress_vectors(read_table(spark, sf_dir, "embeddings"))
    by_label = save(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-labels")
    return (attach(coded, by_label, ["label"], F.xxhash64("vec_id", "code"))
            .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))


def _oracle() -> str:
    distance = "list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x)"
    near = ("SELECT v.rid, v.p, any_value(v.x) AS x, min(struct_pack(d := " + distance + ", e := c.e)) AS b "
            "FROM v JOIN {c} c ON v.p = c.p GROUP BY v.rid, v.p")
    ctes = [r"""kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS f
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", """v AS MATERIALIZED (
  SELECT rid, t.p::INT AS p, list_slice(f, t.p * (len(f) // 4) + 1, (t.p + 1) * (len(f) // 4)) AS x FROM kept, range(4) t(p)
)""", "c0 AS MATERIALIZED (SELECT p, (rid - 1)::INT AS e, x FROM v WHERE rid <= 256)"]
    for i in range(ROUNDS):
        ctes += [f"a{i} AS MATERIALIZED ({near.format(c=f'c{i}')})",
                 f"""m{i} AS MATERIALIZED (SELECT p, e, list(val ORDER BY i) AS x FROM (
  SELECT p, b.e AS e, s.i AS i, floor(sum(x[s.i]) / count(*)) AS val
  FROM (SELECT p, b, x, unnest(range(1, len(x) + 1)) AS i FROM a{i}) s GROUP BY p, b.e, s.i) GROUP BY p, e)""",
                 f"c{i + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON c.p = m.p AND c.e = m.e)"]
    ctes += [f"z AS MATERIALIZED ({near.format(c=f'c{ROUNDS}')})",
             "r AS (SELECT rid, string_agg(printf('%02x', b.e), '' ORDER BY p) AS code, sum(b.d)::BIGINT AS error FROM z GROUP BY rid)",
             f"h AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: y::BIGINT::VARCHAR), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{ROUNDS})"]
    return ("WITH " + ",\n".join(ctes) + "\nSELECT k.vec_id, r.code, r.error, "
            "(sum(r.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, h.codebooks_sha256 "
            "FROM kept k JOIN r ON k.rid = r.rid, h")


ORACLE = _oracle()
