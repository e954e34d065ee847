"""Operator 8: secret scan with a linear-chain conditional random field.

A text is cut into tokens: runs of word characters, ``+ / . -``, and single other signs. Each token has a profile
of shape features (letters, digits, length, hexadecimal, variety of characters, key word, known prefix); the score
of the tags secret-begin, secret-inside and outside at a token is a sum over its own profile, those of three tokens
before and one after, and features of the whole file. The best tag sequence is found by Viterbi.

Decoding is exact but skips most tokens: where "outside" leads by more than twice the range of the transition
scores, no best path has another tag, so the chain falls into short independent runs.

There are no secret labels, so the field is trained on spans of the base patterns: every document is searched for them,
and of all documents that hold one, ``FIT_HITS`` give at most ``FIT_HITS`` windows of tokens with a span. At most
``FIT_CONTRAST`` windows without one come from ``FIT_DOCS`` of all documents. Both are picked by a seeded hash. Half of the
windows (``BLIND``) are learned without their key words and prefixes. The field finds spans of similar shape and
surroundings that the patterns miss. Spans that overlap a base span are not added.

Defined results: a null text is an empty one; no spans give the digest of the empty string and empty spans; repeated
rows are scanned again; an empty table, or one without any base span, gets no further spans; a very long text is
scanned whole, alone in its batch. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.llm.common import doc_slices, read_table, save, sized_slices
from sylva.llm.words import Capped, split_batch

# fixed values of the contract
KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}

FIT_HITS, FIT_CONTRAST, FIT_DOCS = 4000, 2000, 4000
WINDOW = 24
CACHED_WORDS = 400_000
BATCH_BYTES = 4 << 20
OFFSETS = (-3, -2, -1, 0, 1)
BLIND = 0.5  # share of the training windows whose key words and known prefixes are hidden
N_SHAPES, N_FILE = 26, 4
VARIED = 10  # different characters that make a long token varied, whatever its length
O, B, I = 0, 1, 2  # noqa: E741
_TOKEN = re.compile(r"[\w+/.\-]+|[^\w\s]")
_KEYWORDS = re.compile(r"pass|secret|token|key|auth|cred|pwd|private", re.IGNORECASE)
_PREFIXES = ("AKIA", "sk-", "ghp_", "gho_", "xox", "AIza", "glpat-", "eyJ")


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself) of the base patterns, leftmost and non-overlapping per kind."""
    out = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        out += [("assign", m.start(), m.end(), m.start(2)) for m in _ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start()) for m in _ACCESS.finditer(text)
                if m.end() - m.start() >= LEAST["access"]]
    # runs of [0-9a-f] are maximal either way, so the length can stand in the pattern
    out += [("hex", m.start(), m.end(), m.start()) for m in _LONG_HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def shape(token: str) -> int:
    """Profile of a token as a bit set of N_SHAPES features."""
    n, on = len(token), [0]
    if token.isalpha():
        on.append(1 if token.islower() else 2 if token.isupper() else 3 if token[1:].islower() else 4)
        on += [5] * (not token.isascii())
    elif n == 1 and not token.isdigit():
        on.append(6 if token == "=" else 7 if token == ":" else 8 if token in "\"'`" else 9)
    else:
        digits = sum(c.isdigit() for c in token)
        letters = sum(c.isalpha() for c in token)
        on.append(10 if digits == n else 11 if digits and letters else 12)
        on += [13] * bool(digits and _HEX.fullmatch(token)) + [14] * bool(digits and token.isupper())
        on += [15] * (digits + letters < n) + [16] * (digits >= 4) + [17] * (n >= 12 and len(set(token)) >= min(0.4 * n, VARIED))
    on.append(18 if n < 6 else 19 if n < 12 else 20 if n < 18 else 21 if n < 32 else 22)
    on += [23] * bool(_KEYWORDS.search(token)) + [24] * token.startswith(_PREFIXES)
    on += [25] * (n >= 6 and token.isascii())
    return sum(1 << i for i in on)


def bits(profiles: np.ndarray) -> np.ndarray:
    return (profiles[..., None] >> np.arange(N_SHAPES) & 1).astype(np.float32)


def file_features(n_tokens: int, n_mixed: int, text: str) -> np.ndarray:
    lines = text.count("\n") + 1
    return np.array([n_tokens > 200, n_mixed > 0.02 * n_tokens, n_tokens > 12 * lines, "{" in text], np.float32)


def in_context(profiles: np.ndarray) -> np.ndarray:
    """(n, len(OFFSETS)) profiles of each token's surroundings; 0 beyond the ends."""
    padded = np.pad(profiles, 4)
    return np.stack([padded[4 + o:4 + o + len(profiles)] for o in OFFSETS], axis=1)


_MIXED, _NAMED = 1 << 11, 1 << 23 | 1 << 24


def windows(text: str) -> list[dict]:
    """Training windows of a text: around each base span, and one from its start for contrast."""
    spans = base_spans(text)
    found = list(_TOKEN.finditer(text))
    if not found:
        return []
    starts = np.array([m.start() for m in found])
    profiles = np.array([shape(m[0]) for m in found], np.int64)
    tags = np.zeros(len(found), np.int64)
    for _, _, end, secret in spans:
        i, j = np.searchsorted(starts, secret, "right") - 1, np.searchsorted(starts, end)
        if starts[i] == secret or found[i].end() > secret:
            tags[i:j] = np.where(np.arange(j - i) == 0, B, I)
    context = in_context(profiles)
    own = file_features(len(found), int((profiles & _MIXED > 0).sum()), text)
    at = {max(0, int(np.searchsorted(starts, s[3])) - WINDOW // 2) for s in spans} | {0}
    return [{"context": context[i:i + WINDOW].ravel().tolist(), "file": own.tolist(), "tags": tags[i:i + WINDOW].tolist()}
            for i in sorted(at)]


class Field:
    """Weights of the field: shape features by offset, file features, transitions and starts."""

    def __init__(self, shapes: np.ndarray, file: np.ndarray, moves: np.ndarray, start: np.ndarray):
        self.shapes, self.file, self.moves, self.start = shapes, file, moves, start
        self.spread = 2 * (moves.max() - moves.min()) + (start.max() - start.min())
        self.rows: dict[int, int] = {0: 0}
        self.table = np.zeros((1, len(OFFSETS), 3))

    def lookup(self, profile: int) -> int:
        """Row of a profile in the table of its scores at each offset."""
        if profile not in self.rows:
            self.rows[profile] = len(self.table)
            own = np.einsum("f,oft->ot", bits(np.array(profile)), self.shapes)
            self.table = np.concatenate([self.table, own[None]])
        return self.rows[profile]

    def scores(self, rows: np.ndarray, file: np.ndarray) -> np.ndarray:
        padded = np.pad(rows, 4)
        total = np.tile(file @ self.file, (len(rows), 1))
        for k, o in enumerate(OFFSETS):
            total += self.table[padded[4 + o:4 + o + len(rows)], k]
        return total

    def viterbi(self, e: np.ndarray, first: bool, last: bool) -> list[int]:
        """Best tags of a run; the tag before and after it is outside, unless the text starts or ends there."""
        best, back = e[0] + (self.start if first else self.moves[O]), []
        for row in e[1:]:
            via = best[:, None] + self.moves
            back.append(via.argmax(0))
            best = via.max(0) + row
        tags = [int((best if last else best + self.moves[:, O]).argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]

    def decode(self, e: np.ndarray) -> np.ndarray:
        tags = np.zeros(len(e), np.int64)
        unsure = np.nonzero(e[:, O] - np.maximum(e[:, B], e[:, I]) <= self.spread)[0]
        if len(unsure):
            cuts = np.nonzero(np.diff(unsure) > 1)[0] + 1
            for run in np.split(unsure, cuts):
                i, j = int(run[0]), int(run[-1]) + 1
                tags[i:j] = self.viterbi(e[i:j], i == 0, j == len(e))
        return tags


def train(rows: list, steps: int = 150, rate: float = 0.1, ridge: float = 0.02, blind: float = BLIND) -> Field:
    """Maximum likelihood with a Gaussian prior, by full-batch gradient steps (Adam) with forward-backward sums.

    In a seeded share ``blind`` of the windows no token counts as a key word or shows a known prefix, so that
    the field also learns what secrets look like without them.
    """
    n, length = len(rows), WINDOW
    x = np.zeros((n, length, len(OFFSETS) * N_SHAPES + N_FILE), np.float32)
    tags, lengths = np.zeros((n, length), int), np.array([len(r["tags"]) for r in rows])
    hidden = np.random.default_rng(0).random(n) < blind
    for i, r in enumerate(rows):
        k = len(r["tags"])
        context = np.array(r["context"]) & (~_NAMED if hidden[i] else -1)
        x[i, :k, :-N_FILE] = bits(context.reshape(k, len(OFFSETS))).reshape(k, -1)
        x[i, :k, -N_FILE:] = r["file"]
        tags[i, :k] = r["tags"]
    inside = np.arange(length)[None, :] < lengths[:, None]
    weight = np.zeros((x.shape[2], 3))
    moves, start = np.zeros((3, 3)), np.zeros(3)
    parts = [weight, moves, start]
    mean = [np.zeros_like(p) for p in parts]
    square = [np.zeros_like(p) for p in parts]
    one_hot = np.eye(3)[tags] * inside[..., None]
    flat = x.reshape(n * length, -1)

    def sums(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)

    for t in range(1, steps + 1):
        e = (flat @ weight.astype(np.float32)).reshape(n, length, 3).astype(float)
        ahead = np.zeros((n, length, 3))
        ahead[:, 0] = e[:, 0] + start
        for k in range(1, length):
            new = sums(ahead[:, k - 1, :, None] + moves, 1) + e[:, k]
            ahead[:, k] = np.where(inside[:, k, None], new, ahead[:, k - 1])
        behind = np.zeros((n, length, 3))
        for k in range(length - 2, -1, -1):
            new = sums(moves[None] + (e[:, k + 1] + behind[:, k + 1])[:, None, :], 2)
            behind[:, k] = np.where(inside[:, k + 1, None], new, 0.0)
        whole = sums(ahead[:, -1], 1)
        share = np.exp(ahead + behind - whole[:, None, None]) * inside[..., None]
        g_weight = flat.T @ (one_hot - share).reshape(n * length, 3).astype(np.float32)
        g_moves = np.zeros((3, 3))
        for k in range(1, length):
            both = np.exp(ahead[:, k - 1, :, None] + moves + (e[:, k] + behind[:, k])[:, None, :] - whole[:, None, None])
            seen = one_hot[:, k - 1, :, None] * one_hot[:, k, None, :]
            g_moves += ((seen - both) * inside[:, k, None, None]).sum(0)
        g_start = (one_hot[:, 0] - share[:, 0]).sum(0)
        for p, g, m, s in zip(parts, (g_weight, g_moves, g_start), mean, square, strict=True):
            g = g / n - ridge * p / 10
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p += rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return Field(weight[:-N_FILE].reshape(len(OFFSETS), N_SHAPES, 3), weight[-N_FILE:], moves, start)


def _chosen(ids: DataFrame, n: int, seed: str) -> DataFrame:
    """``n`` of the distinct ids (all if there are fewer) by a seeded hash; few more than ``n`` rows reach the last step."""
    rank = F.xxhash64(F.lit(seed), F.col("doc_id"))
    count = ids.count()
    if count > 2 * n:
        ids = ids.where(F.pmod(rank, F.lit(1 << 30)) < int((1 << 30) * 1.5 * n / count) + 1)
    return ids.orderBy(rank, "doc_id").limit(n)


def _hit_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in doc_slices(batches):
        hit = [bool(base_spans(t)) for t in b.column("text").to_pylist()]
        yield b.select(["doc_id"]).filter(pa.array(hit, pa.bool_()))


def _cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in doc_slices(batches):
        out = [(d, w) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)
               for w in windows(t)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in out], pa.int64()), pa.array([w["context"] for _, w in out], pa.list_(pa.int64())),
             pa.array([w["file"] for _, w in out], pa.list_(pa.float64())),
             pa.array([w["tags"] for _, w in out], pa.list_(pa.int64()))], ["doc_id", "context", "file", "tags"])


def training_windows(docs: DataFrame, hits: int = FIT_HITS, contrast: int = FIT_CONTRAST, sample: int = FIT_DOCS) -> list:
    """Windows with base spans, from all documents that hold one, and windows without; both bounded (see the module text)."""
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    low = F.lower("text")
    may = F.col("text").contains("AKIA") | F.col("text").rlike("[0-9a-f]{24}")
    for word in ("passw", "secret", "token", "api"):
        may = may | low.contains(word)
    with_span = save(texts.where(may).mapInArrow(_hit_ids, "doc_id long").distinct(), "secret-hits")
    order = F.xxhash64("doc_id", "context")

    def cut(ids: DataFrame, wanted: str, most: int) -> list:
        found = texts.join(F.broadcast(ids), "doc_id").mapInArrow(
            _cut_windows, "doc_id long, context array<long>, file array<double>, tags array<long>")
        return found.where(F.array_max("tags") > 0 if wanted == "hit" else F.array_max("tags") == 0).orderBy(order).limit(most).collect()

    own = cut(_chosen(with_span, hits, "secrets"), "hit", hits)
    if not own:
        return []
    others = cut(_chosen(texts.select("doc_id").distinct(), sample, "contrast"), "rest", contrast)
    return sorted([*own, *others], key=lambda r: (r.doc_id, r.context))


def fit_field(docs: DataFrame) -> Field | None:
    """The field trained on :func:`training_windows`; None if no document holds a base span."""
    rows = training_windows(docs)
    return train(rows) if rows else None


def _span_text(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans)


def token_rows(text: str, field: Field) -> array:
    """For each token of a text its row in the field's table; bit 32 marks letters mixed with digits."""
    profiles = map(shape, _TOKEN.findall(text))
    return array("q", [field.lookup(p) | bool(p & _MIXED) << 32 for p in profiles])


def batch_rows(texts: pa.Array, words: Capped) -> Iterator[np.ndarray]:
    """``token_rows`` of each text; no token spans white space, so each distinct word of the batch is cut once."""
    distinct, codes, ends = split_batch(texts)
    known = [words[w] for w in distinct.to_numpy(zero_copy_only=False).tolist()]
    length = np.fromiter(map(len, known), np.int64, len(known))
    rows = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(k, np.int64) for k in known if len(k))])
    place = np.cumsum(length) - length
    n = length[codes]
    upto = np.concatenate([[0], np.cumsum(n)])
    own = rows[np.repeat(place[codes] - upto[:-1], n) + np.arange(upto[-1])]
    at = 0
    for end in upto[ends].tolist():
        yield own[at:end]
        at = end


def scan(text: str, field: Field | None, own: np.ndarray) -> tuple[list[tuple], list[tuple]]:
    """(base spans, all spans) of a text with the given ``token_rows``."""
    base = base_spans(text)
    if not field or not len(own):
        return base, base
    tags = field.decode(field.scores(own & 0xFFFFFFFF, file_features(len(own), int((own >> 32).sum()), text)))
    if not tags.any():
        return base, base
    found = list(_TOKEN.finditer(text))
    more, open_at = [], None
    for i, tag in enumerate([*tags.tolist(), O]):
        if open_at is not None and tag != I:
            more.append(("crf", found[open_at].start(), found[i - 1].end(), found[open_at].start()))
            open_at = None
        if tag == B or tag == I and open_at is None:
            open_at = i
    free = [s for s in more if not any(s[1] < e and b < s[2] for _, b, e, _ in base)]
    return base, sorted([*base, *free], key=lambda s: (s[1], KINDS.index(s[0])))


def scan_secrets(docs: DataFrame, field: Field | None) -> DataFrame:
    """Per document: n_assign, n_access, n_hex, base_sha256, spans and n_crf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Capped(lambda w: token_rows(w, field) if field else array("q"), CACHED_WORDS)
        for b in sized_slices(batches, "text", BATCH_BYTES):
            out = []
            for t, own in zip(b.column("text").to_pylist(), batch_rows(b.column("text"), words), strict=True):
                base, spans = scan(t or "", field, own)
                kinds = [s[0] for s in spans]
                digest = hashlib.sha256(_span_text(base).encode()).hexdigest()
                out.append((*(kinds.count(k) for k in KINDS), digest, _span_text(spans)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), *(pa.array([r[i] for r in out], pa.int64()) for i in range(4)),
                 *(pa.array([r[i] for r in out], pa.string()) for i in (4, 5))],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_crf", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = scan_secrets(docs, fit_field(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf")
