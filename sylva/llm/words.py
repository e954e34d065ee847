"""Words and word hashes. A word is a run of characters other than space and U+0009 to U+000D.

``bytes.split()`` without arguments splits at exactly these characters, so words are taken from the
UTF-8 bytes. A word's hash is 64 bits of blake2b; hashes of repeated words come from a bounded cache.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Capped(dict):
    """A dict that computes missing values by ``make`` and holds at most about 2 * ``most`` of them.

    When it is full the older half is dropped, so that values in steady use stay.
    """

    def __init__(self, make, most: int = 300_000):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def word_hashes(words: list[bytes], cache: Capped) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def split_batch(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, place of each word among them in text order, end of each text in that order)."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    ends = (lists.offsets.to_numpy() - lists.offsets.to_numpy()[0])[1:]
    real = pc.binary_length(coded.dictionary).to_numpy()[codes] > 0  # white space at an end leaves an empty word
    if not real.all():
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
        codes = codes[real]
    return coded.dictionary, codes, ends


def batch_arrays(texts: pa.Array, cache: Capped) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and byte lengths of all words of a batch of texts, lower-cased (A-Z), and the end of each text in them.

    A word is hashed once for all its places in the batch.
    """
    distinct, codes, ends = split_batch(pc.ascii_lower(texts))
    words = distinct.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
    return word_hashes(words, cache)[codes], np.fromiter(map(len, words), np.int64, len(words))[codes], ends


def batch_words(texts: pa.Array, cache: Capped) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text, lower-cased (A-Z): the hashes of its words and their lengths in bytes."""
    hashes, sizes, ends = batch_arrays(texts, cache)
    at = 0
    for end in ends.tolist():
        yield hashes[at:end], sizes[at:end]
        at = end


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of the public splitmix64 generator)."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words, in order; empty if there are fewer words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _ODD + hashes[j:j + n]
    return mix(out + np.uint64(k))


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles: runs of ``k`` words; the whole sequence if it is shorter; empty without words."""
    if len(hashes) == 0:
        return np.empty(0, np.uint64)
    return np.unique(rolling(hashes, min(k, len(hashes))))
