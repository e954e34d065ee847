import hashlib
import math
import random

import numpy as np
import pytest

from sylva.llm import vector_codes as vc
from sylva.operators.lookup import attach

SCHEMA = "vec_id long, embedding array<float>, label int, error int, part string, ids int"


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[math.floor(1024 * float(np.float32(x))) for x in v] for _, v, _ in kept]
    w = len(ints[0]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for v in ints]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(near(v[p], books[p])[1], []).append(v[p])
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e
                        for k, e in enumerate(books[p])]
    out, by_label = [], {}
    for (i, _, lab), v in zip(kept, cut):
        hit = [near(v[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in hit)
        out.append((i, "".join(f"{k:02x}" for _, k in hit), error, lab))
        by_label[lab] = by_label.get(lab, 0) + error
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[lab], sha) for i, c, e, lab in out), key=str)


def rows(n, dims, seed=1, hot=0):
    rnd = random.Random(seed)
    out = [(i, [rnd.gauss(0, 0.2) for _ in range(dims)], rnd.choice([None, 0, 1, 2])) for i in range(n)]
    out += [(n + i, out[3][1], 1) for i in range(hot)]
    nan, inf = float("nan"), float("inf")
    out += [(900, None, 1), (901, [None] * dims, 1), (902, [nan] * dims, 0), (903, [0.1] * (dims - 1) + [-inf], 0),
            (7, out[5][1], 0), (7, out[7][1], None), (None, out[8][1], 2), (None, out[9][1], 2)]
    rnd.shuffle(out)
    return out


def query(spark, data, **kw):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, v, lab, 9, "x", 3) for i, v, lab in data], SCHEMA).repartition(5)
    coded, books = vc.compress_vectors(df, **kw)
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    got = attach(coded, sums, ["label"], F.xxhash64("vec_id"))
    return sorted(((r.vec_id, r.code, r.error, r.label_error, vc.digest(books)) for r in got.collect()), key=str), coded, books


@pytest.mark.parametrize("n,dims,entries,hot", [(40, 8, 256, 0), (120, 8, 16, 60), (60, 4, 3, 0)])
def test_codes_equal_brute_force(spark, n, dims, entries, hot):
    data = rows(n, dims, hot=hot)
    got, coded, books = query(spark, data, entries=entries)
    assert got == brute(data, entries=entries)
    # decoding gives the entries whose distance is the error
    kept = {}
    for i, v, _ in data:
        if i is not None and i < 900 and i != 7 and v is not None:
            kept[i] = [math.floor(1024 * float(np.float32(x))) for x in v]
    errors = {r.vec_id: r.error for r in coded.collect()}
    for r in vc.decode_vectors(coded, books).collect():
        if r.vec_id in kept:
            assert sum((a - b) ** 2 for a, b in zip(r.v, kept[r.vec_id])) == errors[r.vec_id]


def test_ties_go_to_the_lower_entry_and_dictionaries_span_blocks(spark, monkeypatch):
    data = [(i, [float(i % 3), 0.0, 1.0, float(i % 2)], 0) for i in range(50)]
    assert query(spark, data, entries=5)[0] == brute(data, entries=5)
    words = [np.array([-2, 5]), np.array([0, 1, 9])]
    codes = np.array([[0, 1, 1], [2, 0, 1]], np.uint16)
    best, distance = vc.nearest(words, codes, np.array([[5, 0], [5, 0], [-2, 9]]))
    assert best.tolist() == [2, 0, 0] and distance.tolist() == [0, 0, 1]


def test_empty_and_odd_tables(spark):
    assert query(spark, [])[0] == []
    assert query(spark, [(1, None, 1), (2, [float("nan")] * 4, None)])[0] == []
    assert query(spark, [(1, [0.5] * 4, None)])[0] == brute([(1, [0.5] * 4, None)])
    assert [r[1:3] for r in query(spark, [(1, [], None), (2, [], 0)])[0]] == [("00000000", 0)] * 2
    with pytest.raises(ValueError, match="cannot be cut"):
        query(spark, [(1, [0.5] * 6, None)])
    with pytest.raises(Exception, match="different lengths"):
        query(spark, [(1, [0.5] * 4, None), (2, [0.5] * 8, None)])
    with pytest.raises(ValueError, match="beyond"):
        query(spark, [(1, [1e9] * 4, None)])


def test_salted_attach_equals_the_broadcast_one(spark):
    from pyspark.sql import functions as F
    left = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 7).alias("k"))
    right = spark.createDataFrame([(None, "n"), (0, "a"), (3, "b")], "k long, v string")
    one = attach(left, right, ["k"], F.col("id"))
    many = attach(left, right, ["k"], F.col("id"), most=1)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect())) and many.count() == 2000
