"""A small documents table with every awkward case, and the same without rows."""

import random

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, toxic int, shard int, "
          "part int, token long, score double")


def rows():
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Épée", "ζeta", "eta,", "theta.", "iota", "kappa"]
    texts = [None, "", "   \n\t ", "one", "two words", "a b c d", "a b c d e", LONG, LONG + " tail", "a\nb\n\na\n", "日本 語 🙂"]
    for _ in range(60):
        texts.append(" ".join(rnd.choice(words) + str(rnd.randint(0, 40)) for _ in range(rnd.randint(5, 80))))
    base = texts[20]
    texts += [base, base, base + " extra", base.upper(), "x " + base]
    out = [(i, t, "en", [None, "a", "b", "hot"][i % 4], None, 7, 1, 3, 2, 5, 0.5) for i, t in enumerate(texts)]
    out += [out[3], out[25], (None, "no id here at all", None, None, None, 1, 0, 0, 0, 0, 0.0),
            (25, "same id, other text", "en", "a", None, 1, 0, 0, 0, 0, 0.0)]
    return out


def table(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, data=()):
    return spark.createDataFrame(list(data), "doc_id long, quality int, toxic int")


def words(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
