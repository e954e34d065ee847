"""Operator 5: n-gram Jaccard self-join with count-vector R-trees.

A document's set holds the hashes of its distinct 5-word shingles. Hashing shingles into groups (the low bits of
the hash) turns a set into a point of group counts, and the sum of coordinate minima of two points bounds the
overlap of their sets from above. An R-tree node keeps the coordinate-wise maximum of its points at a coarse
resolution (about 8 shingles to a group), so the same sum bounds the overlap with everything below it; at the leaves
points are compared at a fine resolution (64 groups or more to a shingle), where few groups hold two shingles.

Steps, all on Spark:

1. Equal sets form classes; only one text of a class goes on, so copies are never paired.
2. Points are spread over buckets by shared shingles: each class sends its point to the buckets of its
   ``KEYS`` smallest shingle hashes. Two sets with Jaccard similarity s share the smallest hash of their union with
   probability s, so a pair misses all buckets with probability at most (1 - 0.75) ** 16 = 2e-10; for sets of up
   to 60 shingles the shared bucket is certain (prefix bound). Shingles that crowd a bucket are passed over
   for the next ones; a class made mostly of such shingles also uses its ``KEYS`` smallest crowded ones. Where up to
   ``MOSTLY`` = 0.4 of the shingles are passed over, the others may be alike by only (0.75 - 0.4) / 0.6, and the chance
   of a miss is about 0.42 ** 16 = 8e-7 (estimate).
3. ``ROUNDS`` times (once), every point proposes a few of its neighbours by size in each bucket, those that the bound puts
   nearest; its ``EACH`` best proposals are verified and join components, so that large groups of near copies
   become one component at a cost in proportion to their size; what one round leaves apart goes to the trees.
4. Buckets that hold several components get an R-tree each; a join of the tree with itself finds all pairs of
   different components that size and overlap bounds allow, each pair in the first bucket that both share, and the
   exact sets verify them. Buckets of more than ``BLOCK`` points are dealt out as pairs of blocks.
5. Components of all verified links.

With ``exact=True`` step 2 leaves nothing to chance: a class sends its point to the buckets of its first
``n - ceil(0.75 n) + 1`` shingles in one order that puts the most frequent shingles last, and two sets that link always share
one of those. That is a quarter of all shingles instead of ``KEYS`` a class, so it costs much more for long texts.
No bucket is held by one task: points are dealt by (shingle, piece of ``PIECE`` points) before they are sorted.

Skipped pairs are only those that are already connected, so components are those of all links. Defined results:
null and empty texts have the empty set and stay alone; a document with a null id takes part, but a
component's id is its smallest non-null id; rows that repeat an id are separate documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylva.llm.common import discard, doc_slices, per_worker, read_table, save, sized_slices
from sylva.llm.components import components
from sylva.llm.words import Capped, batch_words, shingle_set, word_hash, word_hashes

WORDS = 5
PERCENT = 75
SPREAD = 64  # groups to a shingle, at least
SAMPLE = 64  # smallest hashes kept of a set
KEYS = 16
CROWD = 200  # points in a bucket from which its shingle is passed over, at least
MOST_CROWDED = 1 << 20  # bound on the number of such shingles, which are sent to every task (8 MB)
MOSTLY = 0.4  # share of crowded shingles in a sample from which crowded buckets are used too
BLOCK = 8192
PIECE = 1024  # points of a bucket that are sorted and compared by size together
BATCH_BYTES = 4 << 20
LEAF = 32
FAN = 16
ROUNDS = 1
EACH = 2
LOOK = 64


def text_set(text: bytes, cache: Capped) -> np.ndarray:
    return shingle_set(word_hashes(text.lower().split(), cache), WORDS)


def class_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def pack_point(shingles: np.ndarray) -> bytes:
    """The point of a set: the sorted groups of its shingles, about ``SPREAD`` groups to a shingle, as steps of a byte.

    A step of 255 means that the next byte goes on with the same step.
    """
    groups = SPREAD << (len(shingles) - 1).bit_length()
    steps = np.diff(np.sort((shingles & np.uint64(groups - 1)).astype(np.int64)), prepend=0)
    long, rest = np.divmod(steps, 255)
    out = np.full(int((long + 1).sum()), 255, np.uint8)
    out[np.cumsum(long + 1) - 1] = rest
    return out.tobytes()


class Point:
    """Group counts of a set at any resolution: groups with equal low bits add up."""

    def __init__(self, packed: bytes):
        steps = np.frombuffer(packed, np.uint8)
        self.at = np.cumsum(steps, dtype=np.int64)[steps != 255]
        self.n = len(self.at)
        self.groups = SPREAD << (self.n - 1).bit_length()
        self.coarse = max(8, 1 << (self.n // 8).bit_length())

    def counts(self, groups: int) -> np.ndarray:
        return np.bincount(self.at & (groups - 1), minlength=groups)

    def bits(self, groups: int) -> np.ndarray:
        """Which groups are not empty, as 64-bit words."""
        on = np.zeros(groups, bool)
        on[self.at & (groups - 1)] = True
        return np.packbits(on).view(np.uint64)


def bit_table(points: list[Point]) -> tuple[np.ndarray, np.ndarray]:
    """Bit rows of points at their common resolution, and how many shingles share a group with another of their set."""
    groups = min(p.groups for p in points)
    rows = np.stack([p.bits(groups) for p in points])
    return rows, np.array([p.n for p in points]) - np.bitwise_count(rows).sum(1, dtype=np.int64)


def overlap_bound(row: np.ndarray, spare: int, rows: np.ndarray, spares: np.ndarray) -> np.ndarray:
    """At least the sum of coordinate minima of one point and others: common groups, and shared ones beyond the first."""
    return np.bitwise_count(rows & row).sum(1, dtype=np.int64) + np.minimum(spares, spare)


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    return counts.reshape(-1, groups).sum(0) if len(counts) > groups else counts


def needed(n_a, n_b):
    """Smallest overlap at which sets of these sizes link: 100 * overlap >= PERCENT * (n_a + n_b - overlap)."""
    return -(-(PERCENT * (n_a + n_b)) // (100 + PERCENT))


def key_table(keys: list[np.ndarray], token: int) -> np.ndarray:
    """Bit rows of the buckets before ``token`` in which each point also stands."""
    before, which = np.unique(np.concatenate([k[k < token] for k in keys]), return_inverse=True)
    rows = np.repeat(np.arange(len(keys)), [int((k < token).sum()) for k in keys])
    on = np.zeros((len(keys), -(-max(1, len(before)) // 64) * 64), bool)
    on[rows, which] = True
    return np.packbits(on, axis=1).view(np.uint64)


class CountTree:
    """Packed R-tree over count vectors: leaves of LEAF points in the given order, FAN children to a node.

    A node is (smallest size, largest size, coordinate-wise largest counts, label if all points have one, children, rows).
    ``others`` has bit rows of further trees that hold the point too; a pair is left to the first tree that has both.
    """

    def __init__(self, points: list[Point], labels: np.ndarray, others: np.ndarray):
        self.points, self.labels, self.others = points, labels, others
        self.sizes = np.array([p.n for p in points])
        level = [self._leaf(np.arange(i, min(i + LEAF, len(points)))) for i in range(0, len(points), LEAF)]
        while len(level) > 1:
            level = [self._node(level[i:i + FAN]) for i in range(0, len(level), FAN)]
        self.root = level[0]

    def _leaf(self, rows: np.ndarray) -> tuple:
        groups = min(self.points[i].coarse for i in rows)
        peak = np.maximum.reduce([self.points[i].counts(groups) for i in rows])
        labels = self.labels[rows]
        return (self.sizes[rows].min(), self.sizes[rows].max(), peak, labels[0] if (labels == labels[0]).all() else None,
                None, rows)

    @staticmethod
    def _node(children: list[tuple]) -> tuple:
        groups = min(len(c[2]) for c in children)
        peak = np.maximum.reduce([folded(c[2], groups) for c in children])
        labels = {c[3] for c in children}
        return (min(c[0] for c in children), max(c[1] for c in children), peak, labels.pop() if len(labels) == 1 else None,
                children, None)

    @staticmethod
    def _apart(a: tuple, b: tuple) -> bool:
        """No point of one node can link to one of the other, or all are in one component already."""
        if a[3] is not None and a[3] == b[3]:
            return True
        if 100 * min(a[1], b[1]) < PERCENT * max(a[0], b[0]):
            return True
        groups = min(len(a[2]), len(b[2]))
        return int(np.minimum(folded(a[2], groups), folded(b[2], groups)).sum()) < needed(a[0], b[0])

    def _rows(self, a: np.ndarray, b: np.ndarray, same: bool) -> Iterator[tuple[int, int]]:
        sizes_a, sizes_b = self.sizes[a][:, None], self.sizes[b][None, :]
        least = needed(sizes_a, sizes_b)
        ok = (np.minimum(sizes_a, sizes_b) >= least) & (self.labels[a][:, None] != self.labels[b][None, :])
        ok &= ~(self.others[a][:, None, :] & self.others[b][None, :, :]).any(2)
        if same:
            ok &= np.triu(np.ones(ok.shape, bool), 1)
        if not ok.any():
            return
        rows, spare = bit_table([self.points[i] for i in (*a, *b)])
        for i in np.nonzero(ok.any(1))[0]:
            bound = overlap_bound(rows[i], spare[i], rows[len(a):], spare[len(a):])
            for j in np.nonzero(ok[i] & (bound >= least[i]))[0]:
                yield int(a[i]), int(b[j])

    def pairs(self) -> Iterator[tuple[int, int]]:
        """Index pairs of different labels that size and overlap bounds allow."""
        todo = [(self.root, self.root)]
        while todo:
            a, b = todo.pop()
            if self._apart(a, b):
                continue
            if a[4] is None and b[4] is None:
                yield from self._rows(a[5], b[5], a is b)
            elif a is b:
                todo += [(a[4][i], a[4][j]) for i in range(len(a[4])) for j in range(i, len(a[4]))]
            elif a[4] is not None:
                todo += [(c, b) for c in a[4]]
            else:
                todo += [(a, c) for c in b[4]]


def document_points(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, cid, tokens, point) of every document; the last three are null for the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = per_worker("words", lambda: Capped(word_hash))
        for b in sized_slices(batches, "text", BATCH_BYTES):
            n, cid, tokens, point = [], [], [], []
            for hashes, _ in batch_words(b.column("text"), cache):
                s = shingle_set(hashes, WORDS)
                n.append(len(s))
                cid.append(class_id(s) if len(s) else None)
                tokens.append(s[:SAMPLE].view(np.int64) if len(s) else None)
                point.append(pack_point(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), b.column("text_key"), pa.array(n, pa.int64()), pa.array(cid, pa.int64()),
                 pa.array(tokens, pa.list_(pa.int64())), pa.array(point, pa.binary())],
                ["doc_id", "text_key", "n_shingles", "cid", "tokens", "point"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, cid long, tokens array<long>, point binary")


def with_class(docs: DataFrame, name: str) -> DataFrame:
    """All columns and, as ``name``, the class of equal sets of the row's text; null for the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = per_worker("words", lambda: Capped(word_hash))
        for b in sized_slices(batches, "text", BATCH_BYTES):
            sets = [shingle_set(hashes, WORDS) for hashes, _ in batch_words(b.column("text"), cache)]
            cids = pa.array([class_id(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, cids], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def crowded_tokens(classes: DataFrame) -> np.ndarray:
    """Shingles (as signed hashes) whose buckets of smallest hashes would hold too many classes.

    The limit rises with the number of classes so that there are at most ``MOST_CROWDED`` of them.
    """
    limit = max(CROWD, -(-classes.count() * KEYS // MOST_CROWDED))
    held = (classes.select(F.explode(F.slice("tokens", 1, KEYS)).alias("token")).groupBy("token").count()
            .where(F.col("count") > limit).select("token").collect())
    return np.sort(np.array([r.token for r in held], np.int64))


def _all_shingles(texts: DataFrame, crowded: np.ndarray | None) -> DataFrame:
    """(token, cid): all shingles of every class, or with ``crowded`` those that the exact way uses as buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, unpack = Capped(word_hash), zstandard.ZstdDecompressor()
        for b in doc_slices(batches):
            for cid, packed in zip(b.column("cid").to_pylist(), b.column("packed").to_pylist(), strict=True):
                own = text_set(unpack.decompress(packed), cache).view(np.int64)
                if crowded is not None:
                    hot = np.isin(own, crowded)
                    own = np.concatenate([own[~hot], own[hot]])[:len(own) - needed_of(len(own)) + 1]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), cid))], ["token", "cid"])

    return texts.mapInArrow(run, "token long, cid long")


def needed_of(n: int) -> int:
    """Smallest overlap at which a set of ``n`` links with any other."""
    return -(-PERCENT * n // 100)


def exact_keys(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(token, cid): buckets in which any two classes that link meet.

    Shingles held by more than a limit of classes come last in the common order; the limit rises with the number of
    shingles so that there are at most ``MOST_CROWDED`` of them.
    """
    total = classes.agg(F.sum("n").alias("n")).first().n or 0
    limit = max(CROWD, -(-total // MOST_CROWDED))
    held = _all_shingles(texts, None).groupBy("token").count().where(F.col("count") > limit).select("token").collect()
    return _all_shingles(texts, np.sort(np.array([r.token for r in held], np.int64)))


def bucket_keys(classes: DataFrame, crowded: np.ndarray) -> DataFrame:
    """(token, cid): the buckets of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in doc_slices(batches, 4096):
            lists = b.column("tokens")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            hot = np.isin(values, crowded)
            tokens, cids = [], []
            for cid, i, j in zip(b.column("cid").to_numpy(), ends[:-1], ends[1:], strict=True):
                own, is_hot = values[i:j], hot[i:j]
                keys = own[~is_hot][:KEYS]
                if is_hot.mean() >= MOSTLY:
                    keys = np.concatenate([keys, own[is_hot][:KEYS]])
                tokens.append(keys)
                cids.append(np.full(len(keys), cid))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(cids))],
                                             ["token", "cid"])

    return classes.select("cid", "tokens").mapInArrow(run, "token long, cid long")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], columns: list[str], overlap: int = 0) -> Iterator[tuple]:
    """Runs of rows with equal keys, as (key, column arrays); rows must arrive sorted by the keys.

    With ``overlap`` a run of more than 64 times as many rows comes in pieces that share ``overlap`` rows.
    """
    held_key, held = None, []

    def joined(parts: list) -> list:
        return [np.concatenate(x) if len(x) > 1 else x[0] for x in zip(*parts, strict=True)]

    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(c).to_numpy(zero_copy_only=False) for c in keys]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.nonzero(new)[0].tolist(), b.num_rows]
        for i, j in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(c[i] for c in cols)
            if key != held_key and held:
                yield held_key, joined(held)
                held = []
            elif overlap and sum(len(x[0]) for x in held) > 64 * overlap:
                whole = joined(held)
                yield held_key, whole
                held = [[x[-overlap:] for x in whole]]
            held_key = key
            held.append([b.column(c).slice(i, j - i).to_numpy(zero_copy_only=False) for c in columns])
    if held:
        yield held_key, joined(held)


def _pair_batches(pairs: Iterator[tuple[int, int]], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    a, b = [], []
    for x, y in pairs:
        a.append(min(x, y))
        b.append(max(x, y))
        if len(a) >= rows:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def near_links(members: DataFrame, each: int = EACH) -> DataFrame:
    """(a, b): for every point, the ``each`` most similar by bound that some bucket shows it, of other labels.

    In a piece of a bucket, in order of size, a point looks at the ``LOOK`` points before it; a bucket passes on two.
    Only the buckets in a point's ``keys`` are looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, alike = [], [], []
        for _, (cid, n, point, label) in _groups(batches, ["token", "piece"], ["cid", "n", "point", "label"], LOOK):
            points = [Point(p) for p in point]
            for at in range(0, len(cid), LOOK):
                seen = np.arange(max(0, at - LOOK), min(at + LOOK, len(cid)))
                rows, spare = bit_table([points[i] for i in seen])
                for i in range(max(1, at), int(seen[-1]) + 1):
                    here = i - int(seen[0])
                    sizes = n[seen[:here]]
                    bound = overlap_bound(rows[here], spare[here], rows[:here], spare[:here])
                    ok = (bound >= needed(sizes, n[i])) & (label[seen[:here]] != label[i])
                    score = np.where(ok, bound / np.maximum(sizes + n[i] - bound, 1), -1.0)
                    for j in np.argsort(-score, kind="stable")[:2]:
                        if score[j] > 0:
                            a.append(int(cid[seen[j]]))
                            b.append(int(cid[i]))
                            alike.append(float(score[j]))
            if len(a) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(alike)], ["a", "b", "alike"])
                a, b, alike = [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(alike, pa.float64())],
                                         ["a", "b", "alike"])

    found = (members.where(F.array_contains("keys", F.col("token")))
             .repartition("token", "piece").sortWithinPartitions("token", "piece", "n", "cid")
             .mapInArrow(run, "a long, b long, alike double"))
    # a point has at most 2 * 2 * KEYS rows here
    best = F.slice(F.sort_array(F.collect_set(F.struct((-F.col("alike")).alias("order"), "a"))), 1, each)
    chosen = found.groupBy("b").agg(best.alias("best")).select(F.explode("best.a").alias("a"), "b")
    return chosen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def tree_pairs(mixed: DataFrame) -> DataFrame:
    """(a, b) of different components that some bucket's R-tree cannot rule out; ``mixed`` has a label per point."""
    dealt = (mixed.withColumn("blocks", F.ceil(F.col("held") / BLOCK))
             .withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int]]:
            for (token, low, high), (cid, n, point, label, own, keys) in _groups(
                    batches, ["token", "low", "high"], ["cid", "n", "point", "label", "own", "keys"]):
                if len(cid) < 2 or (label == label[0]).all():
                    continue
                order = np.lexsort((n, label))
                others = key_table([keys[i] for i in order], token)
                for i, j in CountTree([Point(point[i]) for i in order], label[order], others).pairs():
                    x, y = order[i], order[j]
                    if low == high or own[x] != own[y]:
                        yield int(cid[x]), int(cid[y])

        yield from _pair_batches(found())

    return (dealt.select("token", "low", "high", "cid", "n", "point", "label", "own", "keys")
            .repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")
            .mapInArrow(run, "a long, b long"))


def class_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, packed): the compressed text of one document of each wanted class (cid, of = its doc_id and text_key).

    Rows without an id, or with an id that others have too, meet only classes of their own text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, pack = Capped(word_hash), zstandard.ZstdCompressor(3)
        for b in doc_slices(batches):
            cid, packed = [], []
            for c, t in zip(b.column("cid").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                if class_id(text_set(t, cache)) == c:  # other texts may have the same key
                    cid.append(c)
                    packed.append(pack.compress(t))
            yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), pa.array(packed, pa.binary())], ["cid", "packed"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).where(F.col("text").isNotNull())
    of = wanted.select("cid", F.col("of.doc_id").alias("_doc"), F.col("of.text_key").alias("_key"))
    joined = rows.join(of, rows["doc_id"].eqNullSafe(of["_doc"]) & (rows["text_key"] == of["_key"])).select("cid", "text")
    return joined.mapInArrow(run, "cid long, packed binary").dropDuplicates(["cid"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact sets link, with ``overlap`` and ``united`` sizes."""
    left = texts.select(F.col("cid").alias("a"), F.col("packed").alias("text_a"))
    right = texts.select(F.col("cid").alias("b"), F.col("packed").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, unpack = Capped(word_hash), zstandard.ZstdDecompressor()
        last, first = None, np.empty(0, np.uint64)
        for b in doc_slices(batches):
            out = []
            for a, other, x, y in zip(*(b.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                if a != last:
                    last, first = a, text_set(unpack.decompress(x), cache)
                second = text_set(unpack.decompress(y), cache)
                both = len(np.intersect1d(first, second, assume_unique=True))
                either = len(first) + len(second) - both
                if 100 * both >= PERCENT * either:
                    out.append((a, other, both, either))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)],
                                             ["a", "b", "overlap", "united"])

    return (pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
            .mapInArrow(run, "a long, b long, overlap long, united long"))


def _mixed(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The points with the label of their component so far, in buckets that hold more than one component."""
    if roots is None:
        return members.withColumn("label", F.col("cid"))
    of = roots.select(F.col("node").alias("cid"), "root")
    marked = members.join(of, "cid", "left").select(*members.columns, F.coalesce("root", "cid").alias("label"))
    several = (members.select("token", "cid", "held").join(of, "cid", "left").groupBy("token")
               .agg(F.min(F.coalesce("root", "cid")).alias("low"), F.max(F.coalesce("root", "cid")).alias("high"),
                    F.max("held").alias("held")).where("low <> high"))
    pieces = several.select("token", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("held") / PIECE) - 1)).alias("piece"))
    return marked.join(pieces, ["token", "piece"], "left_semi")


def jaccard_components(docs: DataFrame, exact: bool = False) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, cid (class of equal sets) and root (of its component).

    ``exact``: no link can be missed, at a higher cost (see the module text).
    """
    spark = docs.sparkSession
    every = save(document_points(docs), "jaccard-points")
    classes = save(every.where("cid IS NOT NULL").groupBy("cid").agg(
        F.min("doc_id").alias("first_doc"), F.min(F.struct("doc_id", "text_key")).alias("of"), F.first("n_shingles").alias("n"), F.first("tokens").alias("tokens"),
        F.first("point").alias("point")), "jaccard-classes")
    texts = None
    if exact:
        texts = save(class_texts(docs, classes), "jaccard-texts")
        keys = save(exact_keys(classes, texts), "jaccard-keys")
    else:
        keys = save(bucket_keys(classes, crowded_tokens(classes)), "jaccard-keys")
    shared = keys.join(keys.groupBy("token").agg(F.count("*").alias("held")).where("held > 1"), "token")
    # at most 2 * KEYS, all of them unless exact
    own = shared.groupBy("cid").agg(F.slice(F.sort_array(F.collect_list("token")), 1, 2 * KEYS).alias("keys"))
    piece = F.pmod(F.xxhash64("cid", F.lit("piece")), F.ceil(F.col("held") / PIECE))
    members = save(shared.withColumn("piece", piece).join(own, "cid").join(classes.select("cid", "n", "point"), "cid"),
                   "jaccard-members")
    discard(keys)
    if texts is None:
        texts = save(class_texts(docs, members.select("cid").distinct().join(classes.select("cid", "of"), "cid")),
                     "jaccard-texts")

    links = label = None
    for _ in range(ROUNDS):
        found = save(verified(near_links(_mixed(members, label)), texts).select("a", "b"), "jaccard-links")
        links = found if links is None else save(links.unionByName(found), "jaccard-links")
        label = components(links)
    pairs = tree_pairs(_mixed(members, label))
    pairs = save(pairs.distinct() if exact else pairs, "jaccard-pairs")
    discard(members)
    links = save(links.unionByName(verified(pairs, texts).select("a", "b")), "jaccard-links")
    discard(pairs)
    discard(texts)
    roots = save(components(links), "jaccard-roots")
    placed = (classes.select("cid", "first_doc").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
              .withColumn("root", F.coalesce("root", "cid")))
    named = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_class = placed.join(named, "root").select("cid", "root", "component_id")
    rows = every.select("doc_id", "n_shingles", "cid")
    alone = rows.where("cid IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "cid", F.lit(None).cast("long").alias("root"))
    return (rows.join(by_class, "cid").select("doc_id", "n_shingles", "component_id", "cid", "root")
            .unionByName(alone))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN coalesce(len(words), 0) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS sh FROM w
), n AS (SELECT doc_id, len(sh)::BIGINT AS n_shingles FROM s),
k AS (SELECT doc_id, unnest(list_transform(sh, lambda x: hash(x))) AS h FROM s),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM k x JOIN k y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
      WHERE 100 * c >= 75 * (p.n_shingles + q.n_shingles - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l)
, r AS (
  WITH RECURSIVE reach(doc_id, x) AS (
    SELECT doc_id, doc_id FROM n UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON e.a = reach.x
  ) SELECT doc_id, min(x) AS component_id FROM reach GROUP BY doc_id)
SELECT n.doc_id, n_shingles, component_id FROM n JOIN r ON r.doc_id = n.doc_id
"""
