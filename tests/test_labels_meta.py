import pytest

from sylva.functions.text import file_stem, split_lines
from sylva.operators import labels, meta


def test_split_lines_like_a_line_reader(spark):
    df = spark.createDataFrame([("a\nb\n",), ("",), ("a\r\nb",), ("\n",), (None,)], "t string")
    got = [r[0] for r in df.select(split_lines("t")).collect()]
    assert got == [["a", "b"], [], ["a\r", "b"], [""], []]


def test_numbered_listing_format(spark):
    src = spark.createDataFrame([("d", "x\ny")], "doc_id string, text string")
    got = [r.listing for r in labels.numbered_lines(src).orderBy("line_no").collect()]
    assert got == ["    1  x", "    2  y"]


def test_file_stem(spark):
    df = spark.createDataFrame([("a.b.cpp",), ("noext",)], "n string")
    assert [r[0] for r in df.select(file_stem("n")).collect()] == ["a.b", "noext"]


def test_toggles_and_resolution(spark):
    clicks = spark.createDataFrame(
        [("p", "u1", 3), ("p", "u1", 3), ("p", "u1", 4), ("p", "u2", 1), ("p", "u2", 1)],
        "problem_id string, user_id string, line int")
    tog = labels.toggled_lines(clicks)
    assert sorted((r.user_id, r.line) for r in tog.collect()) == [("u1", 4)]
    pairs = spark.createDataFrame([("p", "u1", "o1", "t1"), ("p", "u2", "o2", "t2"), ("p", "u3", "o3", "t3")],
                                  "problem_id string, user_id string, ok_id string, pt_id string")
    auto = spark.createDataFrame([("p", "u1", 9), ("p", "u2", 8)], "problem_id string, user_id string, line int")
    res = labels.resolved_labels(pairs, auto, tog)
    assert sorted((r.user_id, r.line, r.origin) for r in res.collect()) == [("u1", 4, "manual"), ("u2", 8, "auto")]
    # a reviewer may accept "no lines" only with the flag
    reviewed = spark.createDataFrame([("p", "u2")], "problem_id string, user_id string")
    res2 = labels.resolved_labels(pairs, auto, tog, reviewed_empty_ok=True, reviewed=reviewed)
    assert sorted((r.user_id, r.line) for r in res2.collect()) == [("u1", 4)]
    rows = {r.user_id: r.label_line for r in labels.label_lines(pairs, res).collect()}
    assert rows == {"u1": "t1.cpp 4", "u2": "t2.cpp 8", "u3": "t3.cpp"}


def test_metadata_operators(spark):
    subs = spark.createDataFrame(
        [("1", "p", "u", "cpp", "OK"), ("2", "p", "u", "cpp", "PT"), ("3", "p", "u", "cpp", None),
         ("4", "p", "u", "", "PT"), ("4", "q", "v", "cpp", "OK")],
        "submission_id string, problem_id string, user_id string, language string, status string")
    keys = spark.createDataFrame([("p", "u")], "problem_id string, user_id string")
    other = sorted(r.submission_id for r in meta.other_solutions(subs, keys, "OK").collect())
    assert other == ["2", "4"]                                   # NULL status dropped
    assert meta.lookup_submissions(subs, "2").count() == 1 and meta.lookup_submissions(subs, "9").count() == 0
    assert [r.submission_id for r in meta.duplicate_keys(subs).collect()] == ["4"]
    with pytest.raises(ValueError):
        meta.assert_unique(subs)
    assert sorted(r.submission_id for r in meta.incomplete_rows(subs).collect()) == ["3", "4"]
    q = meta.adhoc_sql(subs, "SELECT * FROM submissions WHERE status = :s", args={"s": "OK"})
    assert sorted(r.submission_id for r in q.collect()) == ["1", "4"]
    pairs = meta.ok_pt_pairs(subs)
    assert [(r.ok_id, r.pt_id, r.pt_file) for r in pairs.collect()] == [("1", "2", "2.cpp")]


def test_tree_listing(spark):
    from tests.trees_fixture import hand_nodes
    rows = {(r.doc_id, r.line): r.text for r in labels.tree_listing(hand_nodes(spark)).collect()}
    assert rows[("t1", 3)] == "// hi ;"
    assert rows[("t3", 4)] == "hello"


def test_ids_compare_as_strings(spark):
    subs = spark.createDataFrame(
        [("9", "p", "u", "cpp", "OK"), ("10", "p", "u", "cpp", "OK"), ("100", "p", "u", "cpp", "PT"),
         ("11", "p", "u", "cpp", "PT")],
        "submission_id string, problem_id string, user_id string, language string, status string")
    r = meta.ok_pt_pairs(subs).first()
    assert (r.ok_id, r.pt_id) == ("10", "100")                     # byte order, not numeric order
    c = meta.ok_pt_candidates(subs).first()
    assert (c.n_ok, c.n_pt, c.n_candidates) == (2, 2, 4)
