"""Operator 3: token ids as Parquet list columns.

Documents are range-sorted by doc_id and encoded in their tasks with the ``tokenizers`` library; every document
ends with ``END_ID``. The file has one row a document: ``doc_id``, ``part`` and ``seq`` (place in the global
order), ``n_tokens`` and ``ids`` (list of 32-bit integers). Ids are dictionary-encoded (a row group uses only part
of the vocabulary), row groups and pages are kept small, and Parquet's page index on the sorted ``doc_id`` lets a
reader fetch the pages of a few documents, or the counts without any ids.

Encoding is the library's own, run once per distinct piece of text: a byte-level BPE never joins across the
borders that its pre-tokenizer sets, and there is always a border before white space that follows a word. The
library's model gets many new pieces in one call, with a byte between them that it has no merge for. Texts
with unusual white space or with the string of a special token, and tokenizers of any other kind, are
encoded whole by the library.

Defined results: a null or empty text gives only the end id; repeated rows are encoded again, in any order among
themselves; a null doc_id sorts first; an empty table gives an empty file; other columns are not stored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.llm.common import (
    doc_slices,
    per_worker,
    read_table,
    running_total,
    save,
    shuffle_partitions,
    sized_slices,
)
from sylva.llm.words import Capped
from sylva.session import ensure_checkpoint_dir

END_ID = 0
ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 256
# Bytes of text that a task encodes at once, and entries of a cache: an executor holds both once a core.
BATCH_BYTES = 5 << 20
CACHED_WORDS = 300_000
CACHED_PIECES = 75_000
# Pieces that one call of the model gets.
PIECES_AT_ONCE = 400
FILE_OPTIONS = {"compression": "zstd", "parquet.enable.dictionary": "true",
                "parquet.block.size": str(ROW_GROUP_BYTES), "parquet.page.row.count.limit": str(PAGE_ROWS)}
SCHEMA = "doc_id long, part int, seq long, n_tokens int, ids array<int>"
_FIRST = "\x01"  # stands before the first word of a text, which no space precedes
# (RE2) texts that are not words, each after one space or line end
_PAIR_OR_ODD = (r"[ \n][ \n]|[\t\x0b\x0c\r\x01\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
                r"\x{202f}\x{205f}\x{3000}]")
_TAIL = ".,;:!?*%$&#|)]}\"'"
_ODD = re.compile(r"[^\S \n\t\r]")
_CHUNK = re.compile(r" ?[^ \n\t\r]+|[ \n\t\r]+(?![^ \n\t\r])|[ \n\t\r]")
_LATIN_END = "ɐ"  # below it, character classes do not depend on the Unicode version
_LETTERS = "".join(c for c in map(chr, range(ord(_LATIN_END))) if regex.match(r"\p{L}", c))
_NEVER_IN_TEXT = (0xFF, 0xFE, 0xFD, 0xFC, 0xFB, 0xFA, 0xF9, 0xF8, 0xC1, 0xC0)  # bytes that UTF-8 does not use


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as one letter: printable Latin-1 as itself, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _gather(ids: np.ndarray, length: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``codes`` of ``ids``, which has stretches of these lengths, and the end of each in the result."""
    place = np.cumsum(length, dtype=np.int32) - length
    n = length[codes]
    upto = np.cumsum(n, dtype=np.int32)
    return ids[np.repeat(place[codes] - (upto - n), n) + np.arange(n.sum(), dtype=np.int32)], upto


class Together(Capped):
    """A :class:`Capped` that can compute many missing values in one go."""

    def many(self, keys: list[str], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Values of distinct keys."""
        values = list(map(self.get, keys))
        absent = [i for i, v in enumerate(values) if v is None]
        keys = [keys[i] for i in absent]
        older = list(map(self.older.get, keys))
        made = iter(make([k for k, v in zip(keys, older, strict=True) if v is None]))
        found = [next(made) if v is None else v for v in older]
        for i, v in zip(absent, found, strict=True):
            values[i] = v
        at = 0
        while at < len(keys):
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            to = at + self.most - len(self)
            self.update(zip(keys[at:to], found[at:to], strict=True))
            at = to
        return values


class Encoder:
    """Text to little-endian 32-bit ids, equal to ``Tokenizer.encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (spec["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                         and not pre.get("add_prefix_space") and not spec.get("normalizer")
                         and not spec["model"].get("ignore_merges") and not spec["model"].get("dropout"))
        self.specials = [t["content"] for t in spec.get("added_tokens") or []]
        self.letters = _byte_letters()
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.model = self.tokenizer.model
        self.piece = Capped(self._piece, CACHED_PIECES)
        self.chunk = Capped(self._chunk, CACHED_PIECES)
        self.word = Together(self._chunk, CACHED_WORDS)  # by the word with the space or line end before it
        self.border = self._border(spec) if self.by_piece else None
        if self.border:  # UTF-8 to letters, one 16-bit character a byte, and NUL to the border
            self.alphabet = np.array([ord(self.border), *(ord(self.letters[b]) for b in range(1, 256))], "<u2")
            self.border_id = self.model.token_to_id(self.border)

    def _border(self, spec: dict) -> str | None:
        """A letter that is in no text and that the model never merges, so that it parts the pieces of one call."""
        if spec["model"].get("continuing_subword_prefix") or spec["model"].get("end_of_word_suffix"):
            return None
        merged = set().union(*map("".join, spec["model"]["merges"]))
        free = (self.letters[b] for b in _NEVER_IN_TEXT)
        return next((c for c in free if c not in merged and self.model.token_to_id(c) is not None), None)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """:meth:`_piece` of many pieces without a NUL."""
        if not self.border:
            return list(map(self._piece, pieces))
        out = []
        for at in range(0, len(pieces), PIECES_AT_ONCE):
            text = np.frombuffer("\0".join([*pieces[at:at + PIECES_AT_ONCE], ""]).encode(), np.uint8)
            tokens = self.model.tokenize(self.alphabet[text].tobytes().decode("utf-16-le"))
            ids = np.fromiter(map(attrgetter("id"), tokens), "<u4", len(tokens))
            ends, data = np.nonzero(ids == self.border_id)[0] * 4, ids.tobytes()
            out += [data[i:j] for i, j in zip([0, *(ends[:-1] + 4).tolist()], ends.tolist(), strict=True)]
        return out

    def _chunk(self, text: str) -> bytes:
        if not text:
            return b""
        if max(text) >= _LATIN_END:
            return self.whole(text)
        word = text.rstrip(_TAIL)
        if word[1:].isalpha() and (word[0] == " " or word[0].isalpha()):  # a word and signs after it are two pieces
            tail = text[len(word):]
            return self._piece(word) + (self.piece[tail] if tail else b"")
        return b"".join(map(self.piece.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        if not self.by_piece or any(s in text for s in self.specials) or _ODD.search(text):
            return self.whole(text)
        return b"".join(map(self.chunk.__getitem__, _CHUNK.findall(text)))

    def _word_ids(self, words: pa.LargeStringArray, whole: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has.

        A plain word is Latin letters with signs behind, two pieces; equal letters are looked up once.
        """
        line = pc.starts_with(words, "\n")
        head = pc.utf8_rtrim(pc.utf8_ltrim(words, _FIRST + "\n"), _TAIL)
        plain = pc.match_substring_regex(head, f"^[{_LETTERS}]+$")
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), head, pa.scalar(" ", pa.large_string()))
        head = pc.if_else(pc.or_(line, pc.starts_with(words, _FIRST)), head, spaced).filter(plain).dictionary_encode()
        tail = pc.utf8_ltrim(words.filter(plain), _LETTERS + _FIRST + "\n").dictionary_encode()
        known = [b"", self.piece["\n"], *(self.piece[t] if t else b"" for t in tail.dictionary.to_pylist())]
        heads = len(known)
        known += self.word.many(head.dictionary.to_numpy(zero_copy_only=False).tolist(), self._pieces)
        others = len(known)
        for w in words.filter(pc.invert(plain)).to_pylist():
            if w[:2] == _FIRST * 2:
                known.append(whole[w])
            else:
                known.append(self.word[w if w[:1] == "\n" else w[1:] if w[:1] == _FIRST else " " + w])
        plain = plain.to_numpy(zero_copy_only=False)
        parts = np.zeros((len(words), 3), np.int32)
        parts[:, 0] = plain & line.to_numpy(zero_copy_only=False)
        parts[plain, 1] = heads + head.indices.to_numpy()
        parts[plain, 2] = 2 + tail.indices.to_numpy()
        parts[~plain, 1] = np.arange(others, len(known))
        length = np.fromiter(map(len, known), np.int32, len(known)) // 4
        ids, _ = _gather(np.frombuffer(b"".join(known), "<i4"), length, parts.ravel())
        return ids, length[parts].sum(axis=1, dtype=np.int32)

    def encode_batch(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """Ids of each text, then the end id. Words are looked up once per distinct word of the batch."""
        texts = texts.cast(pa.large_string()).fill_null("")
        hard = pc.match_substring_regex(texts, _PAIR_OR_ODD)
        for special in self.specials:
            hard = pc.or_(hard, pc.match_substring(texts, special))
        whole = {}
        if not self.by_piece or pc.any(hard).as_py():
            rows = np.nonzero(hard.to_numpy(zero_copy_only=False))[0] if self.by_piece else range(len(texts))
            whole = {f"{_FIRST}{_FIRST}{i}": self.encode(texts[int(i)].as_py()) for i in rows}
            stand_in = pa.array([None] * len(texts), pa.large_string()).to_pylist()
            for i in rows:
                stand_in[int(i)] = f"{_FIRST}{i}"
            stand_in = pa.array(stand_in, pa.large_string())
            texts = pc.if_else(pc.is_valid(stand_in), stand_in, texts)
        spaced = pc.binary_join_element_wise(
            pa.scalar(_FIRST, pa.large_string()), pc.replace_substring(texts, "\n", " \n"), pa.scalar("", pa.large_string()))
        lists = pc.split_pattern(spaced, " ")
        coded = lists.flatten().dictionary_encode()
        ids, length = self._word_ids(coded.dictionary, whole)
        ends = lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]
        codes = np.insert(coded.indices.to_numpy(), ends, len(length))
        ids, upto = _gather(np.append(ids, np.array([end_id], "<u4").view("<i4")), np.append(length, np.int32(1)), codes)
        offsets = np.concatenate([[0], upto[ends + np.arange(len(ends))]]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Documents (doc_id, text) in ascending doc_id order as rows of the token file."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seq, part = per_worker(f"encoder {tokenizer}", lambda: Encoder(tokenizer)), 0, TaskContext.get().partitionId()
        for b in sized_slices(batches, "text", BATCH_BYTES):
            ids = encoder.encode_batch(b.column("text"), end_id)
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(np.full(n, part, np.int32)),
                 pa.array(np.arange(seq, seq + n)), pc.list_value_length(ids), ids],
                ["doc_id", "part", "seq", "n_tokens", "ids"])
            seq += n

    n = shuffle_partitions(docs.sparkSession)
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(encode, SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    encode_documents(docs, tokenizer or default_tokenizer(), end_id).write.options(**FILE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The token file; filters on doc_id reach the page index, and columns that are not asked for are not read."""
    return spark.read.schema(SCHEMA).parquet(path)


def token_digest(tokens: DataFrame) -> DataFrame:
    """Per document of a token file: doc_id, start (ids before it), n_tokens, ids_crc32, from the stored ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in doc_slices(batches, 1024):
            ids = b.column("ids")
            ends, values = ids.offsets.to_numpy(), ids.values.to_numpy()
            crc = [zlib.crc32(values[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), b.column("seq"),
                 pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "part", "seq", "n_tokens", "ids_crc32"])

    rows = tokens.select("doc_id", "part", "seq", "ids").mapInArrow(
        digest, "doc_id long, part int, seq long, n_tokens long, ids_crc32 long")
    placed = running_total(save(rows, "token-digest"), F.col("n_tokens"), "start")
    return placed.select("doc_id", F.col("start").cast("long"), "n_tokens", "ids_crc32")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    path = f"{ensure_checkpoint_dir(spark)}/sylva-tokens-{uuid.uuid4().hex}"
    write_tokens(read_table(spark, sf_dir, "documents"), path)
    return token_digest(read_tokens(spark, path))
