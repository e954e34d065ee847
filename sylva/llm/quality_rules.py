"""Operator 4: quality rules. Base rules on repeated words and length, then gradient-boosted trees over document
statistics, flattened into numpy node arrays, with monotonic constraints on chosen statistics.

Statistics come from whole texts, one pass a document. The trees are fitted on the statistics of a bounded,
seeded sample of labelled documents (at most ``FIT_ROWS`` of each class, none held out), which is a small
numeric table; all documents are then scored in their tasks, a slice at a time.

Defined results: a null text is an empty one and fails the base rules (no words); repeated rows are scored
again; without labels of both classes there are no trees and the base rules decide alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sylva.llm.common import doc_slices, labelled_sample, read_table
from sylva.llm.words import Capped, rolling, word_hash, word_hashes

SYMBOLS = b"#*$%&|<>"  # fixed values of the contract
MIN_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated 3-word windows
FIT_ROWS = 4000  # of each class
KEEP_AT = 0.3
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: statistic and the direction in which quality may move with it (0: free)
STATISTICS = {"log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
              "upper_share": 0, "digit_share": 0, "punct_share": 0, "non_ascii_share": 0, "distinct_share": 0,
              "words_per_line": 0, "short_word_share": 0}
_IS = {name: np.array([f(b) for b in range(256)]) for name, f in {
    "upper": lambda b: 0x41 <= b <= 0x5A, "digit": lambda b: 0x30 <= b <= 0x39, "symbol": lambda b: b in SYMBOLS,
    "punct": lambda b: b in b".,;:!?", "inner": lambda b: 0x80 <= b <= 0xBF, "high": lambda b: b >= 0xC0}.items()}


def repeated_words(hashes: np.ndarray, k: int = 3) -> int:
    """Words that lie in a window of ``k`` words which the text holds twice or more, its first place included."""
    if len(hashes) <= k:
        return 0
    _, which, counts = np.unique(rolling(hashes, k), return_inverse=True, return_counts=True)
    again = counts[which] >= 2
    inside = np.zeros(len(hashes), bool)
    for j in range(k):
        inside[j:j + len(again)] |= again
    return int(inside.sum())


def describe(text: bytes, cache: Capped) -> tuple[list[int], list[float]]:
    """The counts of the contract and the statistics of one text."""
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    if not n:
        return [0] * len(COUNTS), [0.0] * len(STATISTICS)
    bins = np.bincount(np.frombuffer(b"".join(words), np.uint8), minlength=256)
    of = {name: int(bins[mask].sum()) for name, mask in _IS.items()}
    chars = int(bins.sum()) - of["inner"]
    hashes = word_hashes(words, cache)
    n_dup, n_repeat = len(lines) - len(set(lines)), repeated_words(hashes)
    counts = [n, chars, of["symbol"], n_dup, n_repeat]
    stats = [np.log1p(n), chars / n, of["symbol"] / chars, n_dup / len(lines), n_repeat / n, of["upper"] / chars,
             of["digit"] / chars, of["punct"] / chars, of["high"] / chars, len(np.unique(hashes)) / n, n / len(lines),
             sum(len(w) <= 3 for w in words) / n]
    return counts, stats


@dataclass
class Trees:
    """Boosted trees as flat arrays: a node goes left if its feature is at most its threshold; leaves point at themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1.0 / (1.0 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: list[int], n_trees: int = 40, depth: int = 3, bins: int = 32,
              rate: float = 0.2, ridge: float = 1.0, least_rows: int = 20) -> Trees:
    """Second-order boosting of the logistic loss on quantile bins.

    A split on a constrained feature must order its two leaf values the right way, and both sides inherit the
    middle of the two values as a bound, so the constraint holds across the whole tree.
    """
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    nodes: list[list[float]] = []
    roots = []
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    total = np.full(len(y), base)
    for _ in range(n_trees):
        p = 1.0 / (1.0 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        step = np.zeros(len(y))

        def leaf(rows, low, high, g=g, h=h):
            return float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))

        def grow(rows, level, low, high, g=g, h=h, step=step):
            at = len(nodes)
            nodes.append([0, np.inf, at, at, leaf(rows, low, high) * rate])
            best = None
            if level < depth and len(rows) >= 2 * least_rows:
                sum_g, sum_h = g[rows].sum(), h[rows].sum()
                for j, e in enumerate(edges):
                    size = len(e) + 1
                    b = binned[rows, j]
                    gl = np.bincount(b, g[rows], size).cumsum()[:-1]
                    hl = np.bincount(b, h[rows], size).cumsum()[:-1]
                    nl = np.bincount(b, minlength=size).cumsum()[:-1]
                    gr, hr = sum_g - gl, sum_h - hl
                    vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
                    gain = -(gl * vl + (hl + ridge) * vl**2 / 2) - (gr * vr + (hr + ridge) * vr**2 / 2)
                    bad = (nl < least_rows) | (len(rows) - nl < least_rows) | ((vr - vl) * monotone[j] < 0)
                    gain = np.where(bad, -np.inf, gain)
                    if len(gain) and (best is None or gain.max() > best[0]):
                        k = int(gain.argmax())
                        best = (gain[k], j, k, vl[k], vr[k])
                whole = leaf(rows, low, high)
                if best and best[0] <= -(sum_g * whole + (sum_h + ridge) * whole**2 / 2) + 1e-9:
                    best = None
            if best is None:
                step[rows] = nodes[at][4]
                return at
            _, j, k, vl, vr = best
            middle = (vl + vr) / 2
            to_left = binned[rows, j] <= k
            lo_l, hi_l, lo_r, hi_r = low, high, low, high
            if monotone[j] > 0:
                hi_l = lo_r = middle
            elif monotone[j] < 0:
                lo_l = hi_r = middle
            nodes[at][:2] = [j, edges[j][k]]
            nodes[at][2] = grow(rows[to_left], level + 1, lo_l, hi_l)
            nodes[at][3] = grow(rows[~to_left], level + 1, lo_r, hi_r)
            return at

        roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
        total = total + step
    flat = np.array(nodes, float)
    return Trees(flat[:, 0].astype(int), flat[:, 1], flat[:, 2].astype(int), flat[:, 3].astype(int), flat[:, 4],
                 np.array(roots), depth, base)


_COUNT_SCHEMA = ", ".join(f"{c} long" for c in COUNTS)
_STAT_SCHEMA = ", ".join(f"{c} double" for c in STATISTICS)


def document_statistics(docs: DataFrame, keep: str = "doc_id long") -> DataFrame:
    """Counts and statistics of every text, beside the columns named in ``keep``."""
    names = [c.split()[0] for c in keep.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Capped(word_hash)
        for b in doc_slices(batches):
            both = [describe(t or b"", cache) for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), *(pa.array([x[0][i] for x in both], pa.int64()) for i in range(len(COUNTS))),
                 *(pa.array([float(x[1][i]) for x in both], pa.float64()) for i in range(len(STATISTICS)))],
                [*names, *COUNTS, *STATISTICS])

    return docs.select(*names, "text").mapInArrow(run, f"{keep}, {_COUNT_SCHEMA}, {_STAT_SCHEMA}")


def fit_quality_trees(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Trees | None:
    sample = document_statistics(labelled_sample(docs, labels, "quality", rows, "quality-rules"), "doc_id long, y int")
    got = sorted(sample.select("doc_id", "y", *STATISTICS).collect())
    if len({r.y for r in got}) < 2:
        return None
    data = np.array([r[1:] for r in got], float)
    return fit_trees(data[:, 1:], data[:, 0], list(STATISTICS.values()))


def apply_quality_rules(docs: DataFrame, trees: Trees | None, keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, the counts, base_failed, score (of the trees) and kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Capped(word_hash)
        for b in doc_slices(batches):
            both = [describe(t or b"", cache) for t in b.column("text").cast(pa.binary()).to_pylist()]
            counts = np.array([x[0] for x in both], np.int64).reshape(-1, len(COUNTS))
            stats = np.array([x[1] for x in both], float).reshape(-1, len(STATISTICS))
            failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
            score = trees.probability(stats) if trees else np.ones(len(stats))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), *(pa.array(counts[:, i]) for i in range(len(COUNTS))),
                 pa.array(failed), pa.array(score), pa.array(~failed & (score >= keep_at))],
                ["doc_id", *COUNTS, "base_failed", "score", "kept"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id long, {_COUNT_SCHEMA}, base_failed boolean, score double, kept boolean")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return apply_quality_rules(docs, fit_quality_trees(docs, labels))
