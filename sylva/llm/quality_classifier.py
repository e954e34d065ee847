"""Operator 10: quality classifier with supervised subword embeddings.

A document's features are its words, the character n-grams of each word (3 to 5, with word borders) and its word
pairs, all hashed into ``BUCKETS`` rows of an embedding table. Their mean goes through a softmax layer; table
and layer are learned together by numpy stochastic gradient descent over a bounded, seeded sample of labelled
documents (at most ``FIT_ROWS`` of each class, none held out), in one task. As the layer is linear in the mean,
a document's log-odds are a mean of one number per bucket; only that vector of ``BUCKETS`` numbers leaves the task.

Defined results: a null or empty text has no features and gets the score of the bias alone; repeated rows get the
same score; without labels of both classes every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.llm.common import fit_in_task, held_out, labelled_sample, read_table, sized_slices
from sylva.llm.words import mix, split_batch

BUCKETS = 1 << 17
DIM = 16
NGRAMS = (3, 4, 5)
FIT_ROWS = 1500  # of each class
EPOCHS = 6
RATE = 0.5
CUT = 0.3
SEED = 10
BATCH_BYTES = 4 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Features:
    """Hashed features of a batch of texts: of each distinct word its own bucket and those of its character n-grams."""

    def __init__(self, texts: pa.Array):
        distinct, self.codes, self.ends = split_batch(texts)
        words = distinct.to_numpy(zero_copy_only=False).tolist()
        chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
        length = np.fromiter(map(len, words), np.int64, len(words)) + 2
        end = np.cumsum(length)
        start = end - length
        place = np.arange(len(chars)) - np.repeat(start, length)
        # a word's hash: its characters times powers of an odd number, summed (all arithmetic is modulo 2**64)
        power = np.cumprod(np.full(int(length.max(initial=1)), _ODD, np.uint64), dtype=np.uint64)
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(chars * power[place], dtype=np.uint64)])
        self.hashes = mix(upto[end] - upto[start] + length.astype(np.uint64))
        owner, of = [np.arange(len(words))], np.repeat(np.arange(len(words)), length)
        buckets = [self.hashes % np.uint64(BUCKETS)]
        for n in NGRAMS:
            inside = np.nonzero(place + n <= np.repeat(length, length))[0]
            h = np.zeros(len(inside), np.uint64)
            for j in range(n):
                h = h * _ODD + chars[inside + j]
            buckets.append(mix(h + np.uint64(n)) % np.uint64(BUCKETS))
            owner.append(of[inside])
        self.n_words = len(words)
        self.owner, self.buckets = np.concatenate(owner), np.concatenate(buckets).astype(np.int64)
        # word pairs inside one text, and the text they stand in
        text = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))
        h = self.hashes[self.codes]
        same = text[1:] == text[:-1]
        self.text, self.pair_text = text, text[:-1][same]
        self.pairs = (mix(h[:-1] * _ODD + h[1:] + np.uint64(2))[same] % np.uint64(BUCKETS)).astype(np.int64)

    def log_odds(self, odds: np.ndarray) -> np.ndarray:
        """Mean of the buckets' log-odds over each text's features; 0 without any."""
        n = len(self.ends)
        total = np.bincount(self.owner, odds[self.buckets], self.n_words)[self.codes]
        count = np.bincount(self.owner, minlength=self.n_words)[self.codes]
        sums = np.bincount(self.text, total, n) + np.bincount(self.pair_text, odds[self.pairs], n)
        counts = np.bincount(self.text, count, n) + np.bincount(self.pair_text, minlength=n)
        return sums / np.maximum(counts, 1)

    def counted(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its distinct buckets and how often each occurs."""
        order = np.argsort(self.owner, kind="stable")
        per_word = np.split(self.buckets[order], np.cumsum(np.bincount(self.owner, minlength=self.n_words))[:-1])
        pair_ends = np.cumsum(np.bincount(self.pair_text, minlength=len(self.ends)))
        out, at, pair_at = [], 0, 0
        for end, pair_end in zip(self.ends.tolist(), pair_ends.tolist(), strict=True):
            every = np.concatenate([np.empty(0, np.int64), *(per_word[c] for c in self.codes[at:end]), self.pairs[pair_at:pair_end]])
            buckets, counts = np.unique(every, return_counts=True)
            out.append((buckets, counts.astype(float)))
            at, pair_at = end, pair_end
        return out


def train(docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = EPOCHS, rate: float = RATE,
          seed: int = SEED) -> tuple[np.ndarray, float]:
    """(log-odds of each bucket, bias) after stochastic gradient descent; classes weigh the same."""
    random = np.random.default_rng(seed)
    table = random.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer, bias = random.uniform(-0.1, 0.1, (2, DIM)), np.zeros(2)
    weight = {c: len(y) / (2 * max(1, (y == c).sum())) for c in (0, 1)}
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        for i in random.permutation(len(docs)):
            buckets, counts = docs[i]
            now = rate * (1 - done / steps)
            done += 1
            if not len(buckets):
                continue
            share = counts / counts.sum()
            hidden = share @ table[buckets]
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1.0
            p *= weight[y[i]]
            back = layer.T @ p
            layer -= now * np.outer(p, hidden)
            bias -= now * p
            table[buckets] -= (now * share)[:, None] * back * len(buckets) ** 0.5
    return table @ (layer[1] - layer[0]), float(bias[1] - bias[0])


def fit_quality(docs: DataFrame, labels: DataFrame, target: str = "quality", rows: int = FIT_ROWS
                ) -> tuple[np.ndarray, float] | None:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, y = [], []
        for b in sized_slices(batches, "text", BATCH_BYTES):
            seen += Features(b.column("text")).counted()
            y += b.column("y").to_pylist()
        if len(set(y)) == 2:
            odds, bias = train(seen, np.array(y))
            yield pa.RecordBatch.from_arrays([pa.array([odds.astype("<f4").tobytes()], pa.binary()), pa.array([bias])],
                                             ["odds", "bias"])

    got = fit_in_task(labelled_sample(docs, labels, target, rows, "quality-classifier"), fit, "odds binary, bias double")
    return (np.frombuffer(got[0].odds, "<f4").astype(float), got[0].bias) if got else None


def score_quality(docs: DataFrame, model: tuple[np.ndarray, float] | None, cut: float = CUT) -> DataFrame:
    """doc_id, score and predicted for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, bias = model if model else (np.zeros(BUCKETS), 0.0)
        for b in sized_slices(batches, "text", BATCH_BYTES):
            z = bias + Features(b.column("text")).log_odds(odds)
            score = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(score), pa.array((score >= cut).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = score_quality(docs, fit_quality(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
