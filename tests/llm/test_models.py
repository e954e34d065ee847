import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sylva.llm import quality_classifier as QC
from sylva.llm import quality_rules as QR
from sylva.llm import toxicity as T
from sylva.llm.common import held_out, labelled_sample
from tests.llm import odd_docs

SF = "/root/testdata/sf0.1"


def counts(text):
    w = odd_docs.words(text)
    lines = [x for x in (text or "").split("\n") if odd_docs.words(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    inside = {i + j for i, x in enumerate(windows) if windows.count(x) >= 2 for j in range(3)} if len(w) < 3000 else set()
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)]


def test_counts_equal_brute_force(spark):
    texts = ["a b c a b c", "x x x x", "a\n\na\n b\na", "#a *b $c %d &e |f <g> h", "é é é é", None, "", " \n ", "one", "a b c", "a b a b a b"]
    texts += [r[1] for r in odd_docs.rows() if r[1] is None or len(r[1]) < 10_000]
    docs = odd_docs.table(spark, [(i, t, "", "", 0, 0, 0, 0, 0, 0, 0.0) for i, t in enumerate(texts)])
    for r in QR.apply_quality_rules(docs, None).collect():
        want = counts(texts[r.doc_id])
        assert [r[c] for c in QR.COUNTS] == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)
    assert QR.apply_quality_rules(odd_docs.table(spark), None).count() == len(odd_docs.rows())
    assert QR.apply_quality_rules(odd_docs.empty(spark), None).count() == 0


def test_trees_obey_their_constraints():
    rnd = np.random.default_rng(0)
    x = rnd.normal(0, 1, (3000, 3))
    y = (x[:, 0] + np.sin(3 * x[:, 1]) + rnd.normal(0, 1, 3000) > 0).astype(float)
    trees = QR.fit_trees(x, y, [1, 0, -1])
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.75
    probe = rnd.normal(0, 1, (50, 3))
    for feature, sign in ((0, 1), (2, -1)):
        line = np.linspace(-3, 3, 60)
        for row in probe:
            many = np.repeat(row[None], 60, 0)
            many[:, feature] = line
            assert (sign * np.diff(trees.probability(many)) >= -1e-12).all()


def test_flat_trees_equal_a_walk_over_the_nodes():
    rnd = np.random.default_rng(1)
    x = rnd.normal(0, 1, (800, 4))
    t = QR.fit_trees(x, (x[:, 0] * x[:, 1] > 0).astype(float), [0] * 4, n_trees=5)
    for row in x[:50]:
        total = t.base
        for at in t.roots:
            while t.left[at] != at:
                at = t.left[at] if row[t.feature[at]] <= t.threshold[at] else t.right[at]
            total += t.value[at]
        assert abs(t.probability(row[None])[0] - 1 / (1 + np.exp(-total))) < 1e-12


def accuracy(scored, labels, target):
    both = scored.join(labels, "doc_id").where(held_out())
    return both.agg(F.avg((F.col("predicted") == F.col(target)).cast("int"))).first()[0]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    share = labels.agg(F.avg("quality")).first()[0]
    quality = QC.score_quality(docs, QC.fit_quality(docs, labels, rows=500))
    assert accuracy(quality, labels, "quality") > max(0.93, share)
    toxic = T.score_toxicity(docs, T.fit_lexicon(docs, labels))
    assert accuracy(toxic, labels, "toxic") > 0.95
    kept = QR.apply_quality_rules(docs, QR.fit_quality_trees(docs, labels)).where("NOT base_failed")
    assert accuracy(kept.select("doc_id", F.col("kept").cast("int").alias("predicted")), labels, "quality") > 0.9


def test_held_out_labels_are_never_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    ids = [r.doc_id for r in labelled_sample(docs, labels, "toxic", 300, "x").collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 5 for i in ids)
    again = [r.doc_id for r in labelled_sample(docs.repartition(7), labels, "toxic", 300, "x").collect()]
    assert sorted(ids) == sorted(again)
    turned = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.fit_lexicon(docs, labels, 200) == T.fit_lexicon(docs, turned, 200)


@pytest.mark.parametrize("data", [(), [(3, 1, 0)], [(3, None, None), (25, 1, 1), (25, 0, 0), (None, 1, 1)]])
def test_odd_labels_and_documents(spark, data):
    docs, labels = odd_docs.table(spark), odd_docs.labels(spark, data)
    n = len(odd_docs.rows())
    scored = QC.score_quality(docs, QC.fit_quality(docs, labels)).collect()
    toxic = T.score_toxicity(docs, T.fit_lexicon(docs, labels)).collect()
    assert len(scored) == len(toxic) == n
    for r in [*scored, *toxic]:
        assert 0 <= r.score <= 1
    assert all(r.predicted == int(r.score >= 0.3) for r in scored) and all(r.predicted == int(r.score >= 0.5) for r in toxic)
    assert QR.fit_quality_trees(docs, labels) is None
    assert QC.score_quality(odd_docs.empty(spark), None).count() == T.score_toxicity(odd_docs.empty(spark), T.Lexicon()).count() == 0


def test_folding_and_exceptions():
    assert T.fold("1D10T") == T.fold("idiot") == T.fold("ｉｄｉｏｔ") == T.fold("іdіоt") == T.fold("ïdïöt")
    assert T.fold("$tup1d!!") == T.fold("stupid $$$") and T.fold("") == "  "
    a = T.Lexicon().automaton()
    assert T.raw_weight(T.fold("you id1ot, idiot***"), a) == 2.0
    assert T.raw_weight(T.fold("put it in the trash can, a trash"), a) == 1.0
    assert T.raw_weight(T.fold("idiotic trashy scumble"), a) == 0.0
    stem = T.Lexicon({T.fold("vequ").strip() + "*": 3.0}).automaton()
    assert T.raw_weight(T.fold("un vequaire aveque"), stem) == 3.0


def test_rejecting_keeps_columns(spark):
    docs = odd_docs.table(spark, [(1, "you idiot moron, stupid scum", "en", "a", 0, 0, 0, 0, 0, 0, 0.0), (2, "a kind word", "en", "a", 0, 0, 1, 0, 0, 0, 0.0),
                                  (3, None, "en", "a", 0, 0, 1, 0, 0, 0, 0.0)])
    kept = T.reject_toxic(docs, T.Lexicon())
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_scores_equal_the_trained_model(spark):
    texts = ["good fine words here", " BAD!! BAD!! LOUD!!\n", "more good words", "LOUD!! THÏNGS!!"] * 10
    seen = QC.Features(pa.array(texts)).counted()
    alone = [QC.Features(pa.array([t])).counted()[0] for t in texts]
    assert all((x[0] == y[0]).all() and (x[1] == y[1]).all() for x, y in zip(seen, alone, strict=True))
    # "good": a word, <go goo ood od> <goo good ood> <good good>; no n-gram crosses into the next word
    assert QC.Features(pa.array(["good"])).counted()[0][1].sum() == 1 + 4 + 3 + 2
    assert QC.Features(pa.array(["good good"])).counted()[0][1].sum() == 2 * 10 + 1
    odds, bias = QC.train(seen, np.array([1, 0, 1, 0] * 10))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:4])], "doc_id long, text string")
    for r in QC.score_quality(docs, (odds, bias)).collect():
        buckets, n = seen[r.doc_id]
        z = bias + (odds[buckets] * n).sum() / n.sum()
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-6 and r.predicted == [1, 0, 1, 0][r.doc_id]


def test_toxic_weight_equals_a_plain_scan():
    """All places of every term and exception by string search, each hit against every exception."""
    import random

    from sylva.llm import toxicity
    rnd = random.Random(4)
    lexicon = toxicity.Lexicon({"bad": 1.5, "vil*": 2.0, "very bad": 0.5, "worst thing": 3.0, "d": 0.25},
                               ("not bad", "bad village", "the worst thing ever", "d"))
    automaton = lexicon.automaton()

    def places(text, phrase):
        return [i for i in range(len(text)) if text.startswith(phrase, i)]

    def plain(folded):
        spared = [(i, i + len(toxicity.fold(p))) for p in lexicon.exceptions for i in places(folded, toxicity.fold(p))]
        total = 0.0
        for term, w in lexicon.weights.items():
            pattern = f" {term[:-1]}" if term.endswith("*") else f" {term} "
            for i in places(folded, pattern):
                total += w * (not any(a <= i and i + len(pattern) <= b for a, b in spared))
        return total
    words = ["bad", "very", "not", "village", "vile", "worst", "thing", "ever", "the", "fine", "b4d", "d"]
    for _ in range(300):
        folded = toxicity.fold(" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40))))
        assert abs(toxicity.raw_weight(folded, automaton) - plain(folded)) < 1e-9


def test_a_text_of_very_many_hits_takes_linear_time():
    import time

    from sylva.llm import toxicity
    lexicon = toxicity.Lexicon({"bad": 1.0}, ("not bad",))
    folded = toxicity.fold("not bad but bad " * 200_000)
    began = time.process_time()
    assert toxicity.raw_weight(folded, lexicon.automaton()) == 200_000
    assert time.process_time() - began < 5
