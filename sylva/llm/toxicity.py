"""Operator 9: toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding writes lookalike letters (accents, full-width, Cyrillic, Greek) and digits or signs inside words
(1, 0, 3, 4, 5, 7, @, $) as one plain letter; ``i``, ``l`` and ``1`` become one letter. The automaton holds the
lexicon and the exception phrases; a term inside an exception phrase does not count. The sum of weights, as it
is and for each hundred words of the text, goes through a logistic curve.

The lexicon is a general seed list and the words and beginnings of words that a bounded, seeded sample of labelled documents (at most
``FIT_ROWS`` of each class, none held out) shows to be telling: greedily the one that explains most toxic
documents not explained so far. Weights and curve are fitted on the same sample, in one task.

Defined results: a null text is an empty one and gets the score of the curve at no hits; repeated rows get the
same score; without labels of both classes the seed list with weight 1 and a fixed curve are used; the fixed curve also
stands in for a fitted one that would reject texts without any hit.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sylva.llm.common import doc_slices, fit_in_task, held_out, labelled_sample, read_table

# general insults; a word that never occurs costs nothing
SEED_TERMS = ("idiot", "moron", "imbecile", "stupid", "loser", "scum", "worthless", "pathetic", "disgusting", "trash",
              "clown", "dumbass", "bastard", "asshole")
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "clown car", "sore loser board", "stupid simple",
              "pathetic fallacy")
FIT_ROWS = 2000  # of each class
STEM_LETTERS = (4, 5, 6)
COVER, LEAST_ODDS, LEAST_NEW, MOST_TERMS = 3, 4.0, 3, 500
CUT = 0.5
DEFAULT_CURVE = (-3.0, 4.0, 0.5)  # intercept, log of the weight sum, log of the weight sum per 100 words

# lookalikes that Unicode does not decompose, and digits and signs used for letters; i, l, 1 and | share a letter
_CYRILLIC = dict(zip("авеһікмнорстухѕјԁԛԝ", "abehikmhopctyxsjdqw", strict=True))
_GREEK = dict(zip("αβεικνορτυχ", "abeiknoptux", strict=True))
_SIGNS = dict(zip("013457@$!|", "oieastasii", strict=True))
_LATIN_BLOCKS = (0xC0, 0x250), (0xFF01, 0xFF5F)


def _fold_table() -> dict[int, str]:
    table = {ord(k): v for k, v in {**_CYRILLIC, **_GREEK, **_SIGNS, "l": "i", "ı": "i", "ł": "i", "ø": "o", "đ": "d"}.items()}
    for low, high in _LATIN_BLOCKS:
        for c in range(low, high):
            plain = unicodedata.normalize("NFKD", chr(c))[0].lower()
            if c not in table and plain.isascii() and plain.isalnum():
                table[c] = _SIGNS.get(plain, "i" if plain == "l" else plain)
    return table


_TABLE = _fold_table()
_LOOSE = re.compile(r"(?<![^\W_])[@$!|]{2,}|[@$!|]+(?![^\W_])")  # signs that stand for no letter of a word
_HAS_SIGN = re.compile(r"[@$!|]")
_BREAK = re.compile(r"[^\w\s]|_")


def fold(text: str) -> str:
    """Lower case, folded, words joined by one space, with a space at both ends."""
    text = text.lower()
    if _HAS_SIGN.search(text):
        text = _LOOSE.sub(" ", text)
    return f" {' '.join(_BREAK.sub(' ', text.translate(_TABLE)).split())} "


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=lambda: {fold(t).strip(): 1.0 for t in SEED_TERMS})
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = DEFAULT_CURVE

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            pattern = f" {term[:-1]}" if term.endswith("*") else f" {term} "
            a.add_word(pattern, (len(pattern), weight))
        for phrase in self.exceptions:
            p = fold(phrase)
            a.add_word(p, (len(p), None))
        a.make_automaton()
        return a

    def score(self, raw: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        x = np.column_stack([np.ones(len(raw)), *_signals(raw, n_words)])
        return 1.0 / (1.0 + np.exp(-np.clip(x @ np.array(self.curve), -30, 30)))


def _signals(raw: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.log1p(raw), np.log1p(100.0 * raw / np.maximum(n_words, 1))


def raw_weight(folded: str, automaton) -> float:
    """Sum of the weights of all terms in a folded text that no exception phrase covers."""
    hits, spared = [], []
    for end, (length, weight) in automaton.iter(folded):
        (spared if weight is None else hits).append((end + 1 - length, end + 1, weight))
    if not hits or not spared:
        return sum(w for _, _, w in hits)
    # a hit is covered if, of the phrases that begin no later, one reaches as far as its end
    spared.sort(key=lambda x: x[0])
    begins, reach = [a for a, _, _ in spared], list(accumulate((b for _, b, _ in spared), max))
    total = 0.0
    for s, e, w in hits:
        i = bisect.bisect_right(begins, s)
        if not i or reach[i - 1] < e:
            total += w
    return total


def stems(words: set[str]) -> set[str]:
    """The words and, marked with ``*``, their beginnings of 4 to 6 letters."""
    return words | {f"{w[:k]}*" for w in words for k in STEM_LETTERS if len(w) > k}


def choose_terms(docs: list[set[str]], y: np.ndarray) -> dict[str, float]:
    """Telling words and beginnings of words with their log-odds, until ``COVER`` of them explain each toxic document.

    A term must be in so many more toxic than clean documents that, among all terms, chance would
    hardly give one such; of terms that explain equally many open documents the most specific is taken.
    """
    in_toxic, in_clean = Counter(), Counter()
    marked = [stems(words) for words in docs]
    for terms, toxic in zip(marked, y, strict=True):
        (in_toxic if toxic else in_clean).update(terms)
    n_toxic, n_clean = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    tried = sum(n >= 3 for n in in_toxic.values())
    least = max(3.0, (np.log(tried + 1) + 3.0) / np.log((n_toxic + n_clean) / n_toxic))
    odds = {w: float(np.log((n + 0.5) / n_toxic) - np.log((in_clean[w] + 0.5) / n_clean)) for w, n in in_toxic.items()
            if n - 5 * in_clean[w] >= least}
    telling = {w for w, o in odds.items() if o >= LEAST_ODDS}
    open_docs = [[terms & telling, COVER] for terms, toxic in zip(marked, y, strict=True) if toxic]
    chosen: dict[str, float] = {}
    while open_docs and len(chosen) < MOST_TERMS:
        left = Counter(w for terms, _ in open_docs for w in terms)
        best = max(left, key=lambda w: (left[w] - 5 * in_clean[w], in_toxic[w], len(w), w), default=None)
        if best is None or left[best] < LEAST_NEW:
            break
        chosen[best] = odds[best]
        same = {w for w in left if w.startswith(best.rstrip("*")) or best.startswith(w.rstrip("*"))}
        for doc in open_docs:
            doc[1] -= best in doc[0]
            doc[0] = doc[0] - same
        open_docs = [doc for doc in open_docs if doc[1] > 0]
    return chosen


def fit_curve(raw: np.ndarray, n_words: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float, float]:
    """Ridge-regularised logistic regression by Newton steps; classes weigh the same."""
    x = np.column_stack([np.ones(len(raw)), *_signals(raw, n_words)])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    ridge = np.diag([1e-3, 0.1, 0.1]) * 10
    b = np.zeros(3)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge @ b
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        b = b - np.linalg.solve(hess, grad)
    return tuple(map(float, b))


def fit_lexicon(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Lexicon:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded, y = [], []
        for b in doc_slices(batches):
            folded += [fold(t) for t in b.column("text").to_pylist()]
            y += b.column("y").to_pylist()
        target = np.array(y, float)
        if len(set(y)) < 2:
            return
        seed = Lexicon()
        terms = choose_terms([set(t.split()) for t in folded], target)
        usual = float(np.median(list(terms.values()))) if terms else 1.0
        found = Lexicon({**dict.fromkeys(seed.weights, usual), **terms})
        a = found.automaton()
        raw = np.array([raw_weight(t, a) for t in folded])
        curve = fit_curve(raw, np.array([t.count(" ") - 1 for t in folded]), target)
        if curve[0] >= 0 or min(curve[1:]) < 0:  # too few labels: it would reject texts without hits, or fall with hits
            curve = DEFAULT_CURVE
        names = list(found.weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*names, "", "", ""]), pa.array([*(found.weights[n] for n in names), *curve])], ["term", "value"])

    got = fit_in_task(labelled_sample(docs, labels, "toxic", rows, "toxicity"), fit, "term string, value double")
    if not got:
        return Lexicon()
    return Lexicon({r.term: r.value for r in got if r.term}, EXCEPTIONS, tuple(r.value for r in got if not r.term))


def _scores(batch: pa.RecordBatch, lexicon: Lexicon, automaton) -> np.ndarray:
    texts = [fold(t or "") for t in batch.column("text").to_pylist()]
    return lexicon.score(np.array([raw_weight(t, automaton) for t in texts], float),
                         np.array([t.count(" ") - 1 if len(t) > 2 else 0 for t in texts]))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, cut: float = CUT) -> DataFrame:
    """doc_id, score and predicted (1 if the score reaches ``cut``) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lexicon.automaton()
        for b in doc_slices(batches):
            score = _scores(b, lexicon, a)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(score), pa.array((score >= cut).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def reject_toxic(docs: DataFrame, lexicon: Lexicon, cut: float = CUT) -> DataFrame:
    """The documents, all columns, whose score stays below ``cut``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lexicon.automaton()
        for b in doc_slices(batches):
            yield b.filter(pa.array(_scores(b, lexicon, a) < cut))

    return docs.mapInArrow(run, docs.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = score_toxicity(docs, fit_lexicon(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
