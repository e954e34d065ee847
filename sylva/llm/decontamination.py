"""Operator 1: benchmark decontamination with SimHash windows, a multi-index over Hamming blocks, and exact checks.

Documents and benchmark items are lower-cased (A-Z) and cut into words; 5-word shingles weigh as many as their
words have bytes. Around every place where a document shares a shingle with some item, all windows of that item's length
get a 128-bit SimHash (other windows share nothing with any item, so their similarity is 0), in which a shingle counts by
the square root of its weight. Each fingerprint is cut into 16 blocks of 8 bits; if two fingerprints differ in at most
``RADIUS`` = 47 bits, some block differs in at most 2, so looking up the items near each block value finds all
items within the radius. These candidates are compared exactly: weight of common shingles over weight of all shingles
of both, at least 0.75.

With square roots as signs' weights the cosine of two shingle vectors is the common weight over the geometric mean of
both, which is 0.857 or more for a pair that meets 0.75; such a pair differs in 22 bits on average, standard deviation
4.3, as long as no shingle outweighs the rest. Where one holds over ``HEAVY`` of the item's weight, in the item or in the
document around it (long words, items of few shingles), the radius is not relied on: the item is compared exactly with
all windows that share a shingle with it, so that ``distance`` may exceed the radius. Before either, an item is left out if
the document's distinct common shingles weigh under 0.75 of the item, since no window can then reach 0.75.

The benchmark is a stated query set: it is read in blocks of at most ``ITEMS`` items, each of which goes to every
task as arrays (a few MB) while the documents stream by. Documents are never shuffled. With more than one block each
block's result is written before the next block is read.

Defined results: items without words match nothing; items of under five words match as one whole shingle; a document
shorter than the item is one window; null texts are empty; repeated documents give repeated rows; of several windows
that match one item the most similar counts, then the first; empty tables give no matches. A very long text is
searched whole, alone in its batch. Extra columns are ignored by ``find_leaks`` and kept by ``drop_leaks``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.llm.common import per_worker, read_table, save, sized_slices
from sylva.llm.words import Capped, batch_arrays, batch_words, mix, rolling, word_hash

WORDS = 5
LEAST = 0.75
BITS, BLOCKS = 128, 16
BLOCK_RADIUS = 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1  # 47: with more, all blocks could differ in more than BLOCK_RADIUS bits
HEAVY = 0.1
ITEMS = 10_000
BATCH_BYTES = 1 << 20
_SECOND = np.uint64(0xD1B54A32D192ED03)
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_NEAR = _ONES[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= BLOCK_RADIUS  # values within the block radius
_TABLE_BITS = 20


def word_parts(text: str, cache: Capped) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and byte lengths of the words of a text."""
    return next(batch_words(pa.array([text], pa.string()), cache))


def weights(lengths: np.ndarray, k: int) -> np.ndarray:
    """Bytes in the words of each run of k words."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return ends[k:] - ends[:-k]


def signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 128 bits of each shingle."""
    both = np.stack([mix(shingles), mix(shingles ^ _SECOND)], axis=1)
    return np.unpackbits(both.view(np.uint8), axis=1).astype(np.int64) * 2 - 1


def fingerprints(shingles: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """SimHash of each run of ``size`` shingles, as 16 bytes."""
    sums = np.zeros((len(shingles) + 1, BITS), np.int64)
    roots = np.rint(np.sqrt(weight) * 1024).astype(np.int64)
    np.cumsum(signs(shingles) * roots[:, None], axis=0, out=sums[1:])
    return np.packbits(sums[size:] - sums[:-size] > 0, axis=1)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ``values`` stand in ``known`` (sorted and distinct)."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def window_similarities(shingles: np.ndarray, weight: np.ndarray, size: int, own: np.ndarray, total: int) -> np.ndarray:
    """Exact similarity of each run of ``size`` shingles with the sorted set ``own`` of weight ``total``."""
    n, at = len(shingles) - size + 1, np.arange(len(shingles))
    # a shingle counts in the windows that hold this place of it and no earlier one
    order = np.argsort(shingles, kind="stable")
    same = shingles[order[1:]] == shingles[order[:-1]]
    before = np.full(len(shingles), -1)
    before[order[1:][same]] = order[:-1][same]
    after = np.minimum(at, n - 1) + 1
    first = np.minimum(np.maximum(before + 1, at - size + 1), after)

    def sums(w: np.ndarray) -> np.ndarray:
        steps = np.zeros(n + 1, np.int64)
        np.add.at(steps, first, w)
        np.subtract.at(steps, after, w)
        return np.cumsum(steps[:n])

    common = sums(np.where(among(shingles, own), weight, 0))
    return common / (total + sums(weight) - common)


def spans(at: np.ndarray, size: int, last: int) -> list[list[int]]:
    """First and last start, at most ``last``, of each stretch of windows of ``size`` that hold one of the places ``at``."""
    begin, end = np.clip(at - size + 1, 0, last), np.clip(at, 0, last)
    runs: list[list[int]] = []
    for b, e in zip(begin.tolist(), end.tolist(), strict=True):
        if runs and b <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([b, e])
    return runs


class Items:
    """One block of benchmark items, ready to be searched."""

    def __init__(self, rows: list[tuple[int, str]]):
        cache = Capped(word_hash)
        self.by_size: dict[int, dict] = {}
        for item_id, text in rows:
            hashes, lengths = word_parts(text, cache)
            n = len(hashes)
            if not n:
                continue
            k = min(WORDS, n)
            shingles, weight = rolling(hashes, k), weights(lengths, k)
            group = self.by_size.setdefault(n, {"ids": [], "sets": [], "prints": [], "k": k})
            group["ids"].append(item_id)
            group["sets"].append(dict(zip(shingles.tolist(), weight.tolist(), strict=True)))
            group["prints"].append(fingerprints(shingles, weight, len(shingles))[0])
        self.k_sizes: dict[int, list[int]] = {}
        self.known: dict[int, np.ndarray] = {}
        self.table: dict[int, np.ndarray] = {}
        for n, group in self.by_size.items():
            self.k_sizes.setdefault(group["k"], []).append(n)
            prints = np.stack(group["prints"])
            # multi-index: for each block and value, the items whose block is near that value
            group["prints"] = prints
            group["near"] = np.stack([_NEAR[:, prints[:, b]] for b in range(BLOCKS)])
            group["keys"] = [np.sort(np.array(list(x), np.uint64)) for x in group["sets"]]
            group["heaviest"] = np.array([max(x.values()) for x in group["sets"]])
            group["total"] = np.array([sum(x.values()) for x in group["sets"]])
            group["own"], place = np.unique(np.concatenate(group["keys"]), return_inverse=True)
            # the items that hold each shingle: holders[starts[j]:starts[j + 1]] for shingle own[j]
            order = np.argsort(place, kind="stable")
            group["holders"] = np.repeat(np.arange(len(prints)), [len(x) for x in group["keys"]])[order]
            group["starts"] = np.searchsorted(place[order], np.arange(len(group["own"]) + 1))
        for k, sizes in self.k_sizes.items():
            self.known[k] = np.unique(np.concatenate([self.by_size[n]["own"] for n in sizes]))
            self.table[k] = np.zeros(1 << _TABLE_BITS, bool)
            self.table[k][self.known[k] >> np.uint64(64 - _TABLE_BITS)] = True

    def hits(self, hashes: np.ndarray, ends: np.ndarray) -> dict[int, dict[int, np.ndarray]]:
        """For each text of a batch that shares shingles with items: their places in the text, by shingle length."""
        starts = np.concatenate([[0], ends[:-1]])
        found: dict[int, dict[int, np.ndarray]] = {}
        for k in self.k_sizes:
            if len(hashes) < k:
                continue
            shingles = rolling(hashes, k)
            at = np.nonzero(self.table[k][shingles >> np.uint64(64 - _TABLE_BITS)])[0]
            at = at[among(shingles[at], self.known[k])]
            text = np.searchsorted(ends, at, "right")
            inside = at + k <= ends[text]  # no shingle goes on in the next text
            at, text = at[inside], text[inside]
            cuts = np.nonzero(np.diff(text))[0] + 1
            for places, t in zip(np.split(at, cuts), text[np.concatenate([[0], cuts])] if len(text) else [], strict=False):
                found.setdefault(int(t), {})[k] = places - starts[t]
        return found

    def search_batch(self, hashes: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> dict[int, list[tuple]]:
        """``search`` of every text of a batch in which an item may stand, by the text's number."""
        starts = np.concatenate([[0], ends[:-1]])
        out = {}
        for t, places in sorted(self.hits(hashes, ends).items()):
            got = self.search(hashes[starts[t]:ends[t]], lengths[starts[t]:ends[t]], places)
            if got:
                out[t] = got
        return out

    def search(self, hashes: np.ndarray, lengths: np.ndarray, places: dict[int, np.ndarray] | None = None) -> list[tuple]:
        """(item_id, start word, words, distance, similarity) of the best window for each item found in a text's words."""
        found: dict[int, tuple] = {}
        if places is None:
            places = self.hits(hashes, np.array([len(hashes)])).get(0, {})
        for k, hits in places.items():
            shingles, weight = rolling(hashes, k), weights(lengths, k)
            for n in self.k_sizes[k]:
                group = self.by_size[n]
                at = hits[among(shingles[hits], group["own"])]
                if len(at):
                    self._windows(shingles, weight, at, n, group, found)
        return sorted(found.values())

    def _windows(self, shingles, weight, at, n: int, group: dict, found: dict) -> None:
        size = min(n - group["k"] + 1, len(shingles))  # shingles in a window
        items = self._possible(shingles, weight, at, group)
        if not len(items):
            return
        at = at[among(shingles[at], np.unique(np.concatenate([group["keys"][i] for i in items])))]
        for b, e in spans(at, size, len(shingles) - size):
            part, heavy = shingles[b:e + size], weight[b:e + size]
            prints = fingerprints(part, heavy, size)
            near = reduce(np.logical_or, (group["near"][i][:, items][prints[:, i]] for i in range(BLOCKS)))
            for c, i in enumerate(items):
                total = int(group["total"][i])
                distance = _ONES[prints ^ group["prints"][i]].sum(axis=1, dtype=np.int64)
                fit = near[:, c] & (distance <= RADIUS)
                if max(int(group["heaviest"][i]), int(heavy.max())) > HEAVY * total:
                    fit[:] = True
                if not fit.any():
                    continue
                alike = np.where(fit, window_similarities(part, heavy, size, group["keys"][i], total), 0.0)
                w, item = int(alike.argmax()), group["ids"][i]
                if alike[w] >= LEAST and (item not in found or alike[w] > found[item][4]):
                    found[item] = (item, int(b + w), int(size + group["k"] - 1), int(distance[w]), float(alike[w]))

    @staticmethod
    def _possible(shingles, weight, at, group: dict) -> np.ndarray:
        """Items of which the text's distinct shingles hold at least the least share of the weight."""
        distinct, first = np.unique(shingles[at], return_index=True)
        held = np.searchsorted(group["own"], distinct)
        counts = group["starts"][held + 1] - group["starts"][held]
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        holders = group["holders"][np.repeat(group["starts"][held], counts) + step]
        common = np.bincount(holders, np.repeat(weight[at[first]], counts), len(group["ids"]))
        return np.nonzero(common >= LEAST * group["total"])[0]


def item_blocks(benchmark: DataFrame, items: int = ITEMS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's (item_id, text), at most about ``items`` at a time."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL")
    n = max(1, -(-rows.count() // items))
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        yield sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is None, r))


def _search_batches(batches: Iterator[pa.RecordBatch], rows: list[tuple[int, str]]) -> Iterator[tuple[pa.RecordBatch, dict]]:
    items, cache = Items(rows), per_worker("words", lambda: Capped(word_hash))
    for b in sized_slices(batches, "text", BATCH_BYTES):
        yield b, items.search_batch(*batch_arrays(b.column("text"), cache))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, distance, similarity): each benchmark item found in each document."""

    def finder(rows: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b, found in _search_batches(batches, rows):
                out = [(b.column("doc_id")[t].as_py(), *hit) for t, hits in found.items() for hit in hits]
                kinds = [pa.int64()] * 5 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
                    ["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"])

        return run

    schema = "doc_id long, item_id long, start_word long, n_words long, distance long, similarity double"
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found, now = [], None
    for rows in item_blocks(benchmark):
        if now is not None:
            found.append(save(now, "leaks"))
        now = texts.mapInArrow(finder(rows), schema)
    return reduce(DataFrame.unionByName, [*found, now])


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, in which no benchmark item is found."""

    def cleaner(rows: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b, found in _search_batches(batches, rows):
                clean = np.ones(b.num_rows, bool)
                clean[list(found)] = False
                yield b.filter(pa.array(clean))

        return run

    for block, rows in enumerate(item_blocks(benchmark)):
        docs = (save(docs, "unleaked") if block else docs).mapInArrow(cleaner(rows), docs.schema)
    return docs


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
