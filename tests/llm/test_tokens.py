import random
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sylva.llm import tokens
from tests.llm import odd_docs


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name):
    import public_tokenizers
    path = public_tokenizers.path(name)
    encoder, library = tokens.Encoder(path), Tokenizer.from_file(path)
    rnd = random.Random(1)
    letters = list("ab cdé'\n\t .,!1 2ſ'sS tll x") + ["\x85", "　", "\x1c", "日", "<|endoftext|>", "\x01", "\r"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
    texts += [None, "", " ", "  two", "we'll don't 'quote'", "word'' word's", "a \nb", "a\n b", "🙂 ok", " lead", "trail\n"]
    got = encoder.encode_batch(pa.array(texts), 0).to_pylist()
    assert got == [library.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def test_round_trip_through_files(spark):
    path = tempfile.mkdtemp(prefix="sylva-test-") + "/tokens"
    docs = odd_docs.table(spark)
    tokens.write_tokens(docs, path)
    file = tokens.read_tokens(spark, path)
    library = Tokenizer.from_file(tokens.default_tokenizer())
    want = sorted((r[0] if r[0] is not None else -1, library.encode(r[1] or "", add_special_tokens=False).ids + [0])
                  for r in odd_docs.rows())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in file.collect()) == want
    start = 0
    for r in sorted(tokens.token_digest(file).collect(), key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    digests = {(r.doc_id, r.ids_crc32) for r in tokens.token_digest(file).collect()}
    assert digests == {(None if d < 0 else d, zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in want}
    ordered = [r.doc_id for r in sorted(tokens.token_digest(file).collect(), key=lambda r: r.start) if r.doc_id is not None]
    assert ordered == sorted(ordered)


def test_selective_reads_and_empty_table(spark):
    path = tempfile.mkdtemp(prefix="sylva-test-") + "/tokens"
    tokens.write_tokens(odd_docs.table(spark), path)
    plan = tokens.read_tokens(spark, path).where("doc_id = 5").select("n_tokens")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,5)" in plan and "ids" not in plan.split("ReadSchema:")[1].split("\n")[0]
    tokens.write_tokens(odd_docs.empty(spark), path + "2")
    assert tokens.token_digest(tokens.read_tokens(spark, path + "2")).count() == 0


def test_small_caches_and_batches_give_the_same_ids(spark, monkeypatch):
    for name, most in (("CACHED_WORDS", 2), ("CACHED_PIECES", 3), ("BATCH_BYTES", 40)):
        monkeypatch.setattr(tokens, name, most)
    encoder = tokens.Encoder(tokens.default_tokenizer())
    texts = [f"a{i} bé{i % 7}, <|endoftext|> x\ty{i}" if i % 3 else f"plain words {i}" for i in range(60)]
    library = Tokenizer.from_file(tokens.default_tokenizer())
    assert encoder.encode_batch(pa.array(texts), 0).to_pylist() == [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    for cache, most in ((encoder.word, 2), (encoder.piece, 3), (encoder.chunk, 3)):
        assert cache.most == most and len(cache) + len(cache.older) <= 2 * most


class _Counted:
    """The library's model, with the number of its calls."""

    def __init__(self, model):
        self.model, self.calls = model, 0

    def tokenize(self, text):
        self.calls += 1
        return self.model.tokenize(text)


def test_new_words_share_calls_of_the_model():
    rnd = random.Random(2)
    letters = ["th", "on", "er", "ä", "ß", "é", "ñ", "ing", "Qu", "ª", "ɏ", "ÿ", "x"]
    words = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 8))) for _ in range(4000)})
    texts = [" ".join(words[i::7]) for i in range(7)] + [f"{w}," for w in words] + [f"a {w}.\n{w} {w}***" for w in words]
    encoder = tokens.Encoder(tokens.default_tokenizer())
    encoder.model = _Counted(encoder.model)
    got = encoder.encode_batch(pa.array(texts), 0).to_pylist()
    assert encoder.model.calls < len(words) / 20
    library = Tokenizer.from_file(tokens.default_tokenizer())
    assert got == [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    kept = len(encoder.word)
    more = [f"b {w}), {w}'\n" for w in words]  # other signs behind known words
    assert encoder.encode_batch(pa.array(more), 0).to_pylist() == [library.encode(t, add_special_tokens=False).ids + [0] for t in more]
    assert len(encoder.word) <= kept + 2


@pytest.mark.parametrize("border", [True, False])
def test_words_of_many_kinds_equal_the_library(border):
    encoder, library = tokens.Encoder(tokens.default_tokenizer()), Tokenizer.from_file(tokens.default_tokenizer())
    assert encoder.border
    if not border:  # a model that merges all letters gets its pieces one by one
        encoder.border = None
    rnd = random.Random(3)
    parts = ["we", "'ll", "'", "it's", "12", "é", "日本", "Привет", "\0", "ÿ", "þ", "***", ".", ",", "ſ", "ɐ", "ʼ", " ", " ", " ", "\n"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    texts += [None, "", "\n", "a\n", "\na", "a \n", ".", "\n.", "a.\n.b", "\0", "\0\0 a\0b"]
    for batch in (texts, texts[::-1]):  # the second time from the caches
        got = encoder.encode_batch(pa.array(batch), 5).to_pylist()
        assert got == [library.encode(t or "", add_special_tokens=False).ids + [5] for t in batch]


def test_values_made_together_stay_within_the_cache():
    cache, made = tokens.Together(str.encode, 3), []

    def make(keys):
        made.append(keys)
        return [k.encode() for k in keys]

    assert cache.many(list("abcdefgh"), make) == [b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h"]
    assert len(cache) <= 3 and len(cache.older) <= 3
    assert cache.many(list("xhd"), make) == [b"x", b"h", b"d"] and made == [list("abcdefgh"), ["x"]]
    assert len(cache) <= 3 and len(cache.older) <= 3
