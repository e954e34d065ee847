import random

import numpy as np

from sylva.llm import decontamination as D
from sylva.llm import stages
from sylva.llm.words import Capped, word_hash
from tests.llm import odd_docs


def weighted(words):
    k = min(5, len(words))
    return {tuple(words[i:i + k]): sum(len(w.encode()) for w in words[i:i + k]) for i in range(len(words) - k + 1)}, k


def brute(text, items):
    """Best window of each item by comparing every window of its length."""
    words = odd_docs.words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    out = {}
    for item_id, item in items:
        own, k = weighted(odd_docs.words((item or "").lower()))
        n = len(odd_docs.words(item))
        if not n or len(words) < k:
            continue
        for s in range(max(1, len(words) - n + 1)):
            part = words[s:s + n]
            have = {tuple(part[i:i + k]): sum(len(w.encode()) for w in part[i:i + k]) for i in range(len(part) - k + 1)}
            both = sum(w for x, w in have.items() if x in own)
            alike = both / (sum(have.values()) + sum(own.values()) - both)
            if alike >= 0.75 and alike > out.get(item_id, (0, 0))[1]:
                out[item_id] = (s, alike)
    return out


def cases():
    rnd = random.Random(3)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(5, 60)))) for i in range(30)]
    items += [(100, "three word item"), (101, ""), (102, None), (103, "single")]
    docs = []
    for i in range(60):
        body = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 200))]
        passage = rnd.choice(items[:30])[1].split()
        for _ in range(i % 4):
            passage[rnd.randrange(len(passage))] = "changed"
        if i % 3:
            body[len(body) // 2:len(body) // 2] = passage
        docs.append((i, " ".join(body).upper() if i % 5 == 0 else " ".join(body)))
    docs += [(200, "a Three WORD item b"), (201, None), (202, ""), (203, items[0][1])]
    return docs, items


def test_every_leak_is_found_and_nothing_else(spark):
    docs, items = cases()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_leaks(table, bench).collect()
    want = {(d, i): v for d, t in docs for i, v in brute(t, items).items()}
    assert {(r.doc_id, r.item_id) for r in got} == set(want)
    for r in got:
        assert r.start_word == want[r.doc_id, r.item_id][0] and abs(r.similarity - want[r.doc_id, r.item_id][1]) < 1e-9


def test_blocks_of_items_give_the_same_rows(spark, monkeypatch):
    docs, items = cases()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(D.find_leaks(table, bench).collect())
    assert len(list(D.item_blocks(bench, 7))) > 3
    monkeypatch.setattr(D.item_blocks, "__defaults__", (7,))
    assert sorted(D.find_leaks(table, bench).collect()) == whole


def test_index_finds_every_fingerprint_within_the_radius():
    rnd = np.random.default_rng(1)
    own = rnd.integers(0, 256, (40, 16), dtype=np.uint8)
    near = np.stack([D._NEAR[:, own[:, b]] for b in range(D.BLOCKS)])
    for _ in range(300):
        i = int(rnd.integers(40))
        bits = np.unpackbits(own[i])
        bits[rnd.choice(128, int(rnd.integers(0, D.RADIUS + 1)), False)] ^= 1
        probe = np.packbits(bits)
        assert np.logical_or.reduce([near[b][probe[b]] for b in range(D.BLOCKS)])[i]


def test_odd_documents_and_empty_tables(spark):
    docs = odd_docs.table(spark)
    bench = spark.createDataFrame([(1, odd_docs.rows()[20][1]), (2, None), (3, "")], "item_id long, text string")
    assert {r.doc_id for r in D.find_leaks(docs, bench).collect()} >= {20, 71, 72}
    clean = D.drop_leaks(docs, bench)
    assert clean.columns == docs.columns and clean.schema == docs.schema
    found = {r.doc_id for r in D.find_leaks(docs, bench).collect()}
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in odd_docs.rows()} - found
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_leaks(docs, none).count() == 0 and D.drop_leaks(docs, none).count() == docs.count()
    assert D.find_leaks(odd_docs.empty(spark), bench).count() == 0


def test_fingerprints_of_runs_equal_those_of_the_parts():
    rnd = np.random.default_rng(2)
    s, w = rnd.integers(0, 2**63, 30, dtype=np.uint64), rnd.integers(1, 40, 30)
    runs = D.fingerprints(s, w, 10)
    assert len(runs) == 21 and all((runs[i] == D.fingerprints(s[i:i + 10], w[i:i + 10], 10)[0]).all() for i in range(21))


def test_stage_drops_contaminated_documents_only(spark, tmp_path):
    docs, items = cases()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r.doc_id for r in stages.drop_contaminated(spark, table, str(tmp_path)).collect()}
    assert kept == {d for d, t in docs if not brute(t, items)}


def test_search_is_case_blind_for_ascii_only():
    items = D.Items([(1, "É one two three four five")])
    cache = Capped(word_hash)
    assert items.search(*D.word_parts("É ONE two three four five", cache))
    assert not items.search(*D.word_parts("é one two three four five", cache))


def long_word_cases():
    """Items with one long word, each in a document with that word changed: alike by weight, far apart in the SimHash."""
    rnd = random.Random(11)
    items, docs = [], []
    for i, (n, size, place) in enumerate([(60, 150, 59), (100, 250, 99), (150, 400, 149), (300, 150, 150)] * 2):
        words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(4, 5))) for _ in range(n)]
        long = "".join(rnd.choice("abcdef0123456789") for _ in range(size))
        items.append((i, " ".join(words[:place] + [long] + words[place + 1:])))
        for j, changed in enumerate(["x" * size, "short", long]):
            body = [f"d{rnd.randint(0, 10**6)}" for _ in range(40)]
            docs.append((10 * i + j, " ".join(body[:20] + words[:place] + [changed] + words[place + 1:] + body[20:])))
    items.append((90, "again and again and again and again and again and once more"))
    docs.append((900, "so again and again and again and again and again and again and once more"))
    docs.append((901, items[0][1] + " gap " + items[0][1][::-1] + " " + items[0][1]))
    return docs, items


def test_the_index_produces_the_matches(spark, monkeypatch):
    """With the multi-index switched off only items with outweighing shingles are still found."""
    docs, items = cases()
    table, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in D.find_leaks(table, bench).collect()}
    monkeypatch.setattr(D, "_NEAR", np.zeros_like(D._NEAR))
    left = {(r.doc_id, r.item_id) for r in D.find_leaks(table, bench).collect()}
    assert left < whole and len(left) < 0.7 * len(whole)
    sizes = dict((i, len((t or "").split())) for i, t in items)
    assert max(sizes[i] for _, i in left) < min(n for n in sorted(sizes.values()) if n > 24)


def test_near_copies_lie_within_the_radius():
    """Pairs of prose that meet 0.75 differ in far fewer bits than the radius."""
    rnd, cache, far, n = random.Random(8), Capped(word_hash), 0, 0
    for _ in range(400):
        words = ["w" * rnd.randint(1, 9) + str(rnd.randint(0, 400)) for _ in range(rnd.randint(30, 200))]
        other = list(words)
        for _ in range(rnd.randint(1, max(1, len(words) // 40))):
            other[rnd.randrange(len(other))] = "changed" + str(rnd.random())
        prints = []
        for text in (words, other):
            hashes, lengths = D.word_parts(" ".join(text), cache)
            shingles, weight = D.rolling(hashes, 5), D.weights(lengths, 5)
            prints.append(D.fingerprints(shingles, weight, len(shingles))[0])
        a, b = weighted(words)[0], weighted(other)[0]
        both = sum(w for x, w in a.items() if x in b)
        if both / (sum(a.values()) + sum(b.values()) - both) >= 0.75:
            n += 1
            far = max(far, int(np.unpackbits(prints[0] ^ prints[1]).sum()))
    assert n > 100 and far <= D.RADIUS - 5


def test_a_batch_finds_what_single_texts_find():
    docs, items = cases()
    block, cache = D.Items(items), Capped(word_hash)
    import pyarrow as pa
    batch = block.search_batch(*D.batch_arrays(pa.array([t for _, t in docs], pa.string()), cache))
    alone = {i: block.search(*D.word_parts(t, cache)) for i, (_, t) in enumerate(docs)}
    assert batch == {i: hits for i, hits in alone.items() if hits}


def test_long_words_lose_no_leak():
    docs, items = long_word_cases()
    block, cache = D.Items(items), Capped(word_hash)
    for _, text in docs:
        got = {r[0]: r for r in block.search(*D.word_parts(text.lower(), cache))}
        want = brute(text, items)
        assert set(got) == set(want)
        for item, (_, start, _, _, alike) in got.items():
            assert start == want[item][0] and abs(alike - want[item][1]) < 1e-9
