import os

from pyspark.sql import functions as F

from sylva import sinks
from sylva.operators import trees
from sylva.sources import corpus
from sylva.sources.html import SYMBOLS, html_leaf_paths, html_nodes, parse_tree
from tests.conftest import SF001


def test_scan_corpus_nested_and_flat(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "data")
    os.makedirs(os.path.join(root, "p1"))
    os.makedirs(os.path.join(root, "p2"))
    with open(os.path.join(root, "p1", "10.cpp"), "wb") as f:
        f.write(b"int main() {}\n")
    with open(os.path.join(root, "p1", "11.cpp"), "wb") as f:
        f.write(b"bad \xff byte\x00after nul\n")
    with open(os.path.join(root, "p2", "a.b.c"), "wb") as f:
        f.write(b"")
    for name in ("d.e.f", "_x.cpp", ".z.cpp"):
        with open(os.path.join(root, "p2", name), "wb") as f:
            f.write(b"x")
    rows = {r.doc_id: r for r in corpus.scan_corpus(spark, root).collect()}
    assert set(rows) == {"p1/10.cpp", "p1/11.cpp", "p2/a.b.c", "p2/d.e.f", "p2/_x.cpp", "p2/.z.cpp"}
    assert rows["p2/a.b.c"].text == "" and rows["p2/_x.cpp"].stem == "_x"
    assert rows["p1/10.cpp"].problem_id == "p1" and rows["p1/10.cpp"].stem == "10"
    assert rows["p2/d.e.f"].stem == "d.e" and rows["p2/d.e.f"].ext == "f"
    assert rows["p1/11.cpp"].text.endswith("after nul\n") and "�" in rows["p1/11.cpp"].text
    flat = corpus.scan_corpus(spark, os.path.join(root, "p1"), nested=False).collect()
    assert sorted(r.doc_id for r in flat) == ["10.cpp", "11.cpp"]


def test_scan_corpus_relative_root_that_recurs(spark, tmpdir_fresh, monkeypatch):
    base = os.path.join(tmpdir_fresh, "data", "x")
    os.makedirs(os.path.join(base, "data", "p"))
    with open(os.path.join(base, "data", "p", "a.cpp"), "w") as f:
        f.write("a")
    monkeypatch.chdir(base)
    assert [r.doc_id for r in corpus.scan_corpus(spark, "data").collect()] == ["p/a.cpp"]


def test_vocabulary_text_round_trip(spark, tmpdir_fresh):
    vocab = spark.createDataFrame([("k1", "a"), ("k2", "two\nlines"), ("k3", "x y")], "key string, token string")
    vocab = vocab.withColumn("display", F.concat(F.lit("["), "token", F.lit("]")))
    out = os.path.join(tmpdir_fresh, "vocab")
    sinks.write_vocabulary_text(vocab.coalesce(1), out)
    back = {r.key: r.display for r in corpus.read_vocabulary(spark, os.path.join(out, "records")).collect()}
    assert back == {"k1": "[a]", "k2": "[two\nlines]", "k3": "[x y]"}
    assert [r.value for r in spark.read.text(os.path.join(out, "count")).collect()] == ["3"]


def test_split_and_labels_sinks(spark, tmpdir_fresh):
    df = spark.createDataFrame([("1", "train"), ("2", "val")], "doc_id string, split string")
    sinks.write_split(df, os.path.join(tmpdir_fresh, "split"))
    back = spark.read.parquet(os.path.join(tmpdir_fresh, "split"))
    assert sorted((r.doc_id, r.split) for r in back.collect()) == [("1", "train"), ("2", "val")]


def test_statements(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "stmts")
    os.makedirs(d)
    for name in ("4-NOT SPECIFIED", "a+b"):
        with open(os.path.join(d, f"{name}.txt"), "w") as f:
            f.write("Sum two\nnumbers.\n")
    rows = corpus.read_statements(spark, d).collect()
    assert sorted((r.problem_id, r.statement) for r in rows) == [
        ("4-NOT SPECIFIED", "Sum two\nnumbers.\n"), ("a+b", "Sum two\nnumbers.\n")]


def test_html_tree_rules():
    nodes = parse_tree("<html><body>\n<p>hi<br>there</p></div><!-- c --><x-tag>t</x-tag></body></html>")
    by_id = {n["node_id"]: n for n in nodes}
    assert nodes[0]["type"] == "#document" and nodes[0]["parent_id"] is None
    types = [n["type"] for n in nodes]
    assert types == ["#document", "html", "body", "p", "#text", "br", "#text", "#comment", "x-tag", "#text"]
    br = nodes[types.index("br")]
    assert br["child_count"] == 0 and by_id[br["parent_id"]]["type"] == "p"      # void, no children
    after = nodes[types.index("#text", 5)]
    assert by_id[after["parent_id"]]["type"] == "p"                              # text after <br> stays in <p>
    comment = nodes[types.index("#comment")]
    assert comment["is_extra"] and by_id[comment["parent_id"]]["type"] == "body"  # stray </div> ignored
    assert nodes[types.index("x-tag")]["symbol"] == SYMBOLS.index("#unknown")
    p = nodes[types.index("p")]
    assert p["start_row"] == 1 and p["start_col"] == 0                           # rows are 0-based
    assert parse_tree("")[0]["type"] == "#document"                              # root always exists


def test_html_declarations_end_a_text():
    nodes = parse_tree("<p>hello<?php x ?>world<!DOCTYPE a>tail</p>")
    assert [n["value"] for n in nodes if n["type"] == "#text"] == ["hello", "world", "tail"]


def test_html_byte_offsets():
    text = "<p>é</p>"
    nodes = parse_tree(text)
    t = [n for n in nodes if n["type"] == "#text"][0]
    assert text.encode()[t["start_byte"]:t["end_byte"]].decode() == "é"


def test_parse_job_paths_equal_walk(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    direct = trees.encode_leaf_paths(html_leaf_paths(pages))
    walked = trees.encoded_paths(html_nodes(pages))
    cols = ["doc_id", "leaf_ord", "path_ids", "fork_ids", "path_len", "leaf_row"]
    assert direct.select(cols).exceptAll(walked.select(cols)).count() == 0
    assert walked.select(cols).exceptAll(direct.select(cols)).count() == 0


def test_terminal_values_are_byte_slices(spark):
    from sylva.functions.text import byte_slice
    df = spark.createDataFrame([("é&amp;x", 0, 2), ("é&amp;x", 2, 7)], "t string, s int, e int")
    assert [r[0] for r in df.select(byte_slice("t", "s", "e")).collect()] == ["é", "&amp;"]
    pages = spark.createDataFrame([(1, "<p>a &amp; b</p>")], "page_id long, html string")
    src = pages.selectExpr("cast(page_id as string) as doc_id", "html as text")
    vals = trees.terminal_values(html_nodes(pages), src).collect()
    assert [(r.type, r.text) for r in vals] == [("#text", "a &amp; b")]


def test_files_to_split_folders(spark, tmpdir_fresh):
    from sylva.plans import preprocess_corpus
    root = os.path.join(tmpdir_fresh, "corpus")
    for p, k in (("pa", 6), ("pb", 3), ("pc", 2)):
        os.makedirs(os.path.join(root, p))
        for i in range(k):
            with open(os.path.join(root, p, f"{i}.cpp"), "w") as f:
                f.write(f"// {p} {i}\n")
    src = corpus.scan_corpus(spark, root)
    r = preprocess_corpus(src, n_problems=2, n_files=4, split=50, seed=1)
    out = os.path.join(tmpdir_fresh, "split")
    sinks.write_split(r.split, out)
    back = spark.read.parquet(out).collect()
    sampled = r.sampled.collect()
    # top 2 problems: pa (6 files) and pb (3); 4 of pa and all 3 of pb are sampled
    assert sorted(x.problem_id for x in sampled) == ["pa"] * 4 + ["pb"] * 3
    assert sorted(x.file_name for x in back) == sorted({x.file_name for x in sampled})
    assert sum(1 for x in back if x.split == "train") == 0        # 50 * (7 div 100) = 0
    for x in back:                                                # the smaller problem is copied last
        assert x.problem_id == ("pb" if x.file_name in ("0.cpp", "1.cpp", "2.cpp") else "pa")
