import pytest
from pyspark.sql import functions as F

from sylva.functions.paths import padded_symbol, path_ids
from sylva.operators import trees
from tests.trees_fixture import hand_nodes


def _paths(df):
    return sorted((r.doc_id, r.leaf_ord, tuple(n.node_id for n in r.path)) for r in df.collect())


def test_root_paths_every_terminal_in_document_order(spark):
    lp = trees.root_paths(hand_nodes(spark))
    got = _paths(lp)
    assert got == [
        ("t1", 3, (0, 1, 2, 3)), ("t1", 5, (0, 4, 5)), ("t1", 6, (0, 4, 6)), ("t1", 7, (0, 4, 7)),
        ("t2", 0, (0,)),
        ("t3", 4, (0, 1, 2, 3, 4)),
    ]


def test_path_count_equals_terminal_count(spark):
    nodes = hand_nodes(spark)
    assert trees.root_paths(nodes).count() == nodes.where("child_count = 0").count()


def test_fork_paths_drop_single_child_nodes(spark):
    fp = trees.fork_paths(trees.root_paths(hand_nodes(spark)))
    got = {(r.doc_id, r.leaf_ord): tuple(n.node_id for n in r.path) for r in fp.collect()}
    assert got[("t1", 3)] == (0, 3)          # chain and mid have one child
    assert got[("t1", 5)] == (0, 4, 5)
    assert got[("t2", 0)] == (0,)            # a lone root is a terminal
    assert got[("t3", 4)] == (4,)            # whole chain dropped


def test_symbol_padding_keeps_long_ids(spark):
    df = spark.createDataFrame([(7,), (42,), (1234,)], "s int")
    assert [r[0] for r in df.select(padded_symbol("s")).collect()] == ["007", "042", "1234"]


def test_encoded_paths_match_array_encodings(spark):
    nodes = hand_nodes(spark)
    enc = trees.encoded_paths(nodes)
    ref = trees.encode_leaf_paths(trees.root_paths(nodes))
    cols = ["doc_id", "leaf_ord", "path_ids", "path_len", "fork_ids", "fork_len", "reversed_ids", "leaf_value"]
    assert sorted(map(tuple, enc.select(cols).collect())) == sorted(map(tuple, ref.select(cols).collect()))
    row = enc.where("doc_id = 't1' AND leaf_ord = 7").first()
    assert row.path_ids == "0010041234" and row.fork_ids == "0010041234" and row.reversed_ids == "1234004001"


def test_separator_removes_ambiguity(spark):
    enc = trees.encoded_paths(hand_nodes(spark), separator="/")
    row = enc.where("doc_id = 't1' AND leaf_ord = 7").first()
    assert row.path_ids == "001/004/1234"


def test_subtree_paths_start_anywhere(spark):
    sp = trees.subtree_paths(hand_nodes(spark), F.col("type") == "fork")
    got = sorted(tuple(n.node_id for n in r.path) for r in sp.collect())
    assert got == [(4, 5), (4, 6), (4, 7)]


def test_reverse_paths(spark):
    rp = trees.reverse_paths(trees.root_paths(hand_nodes(spark)))
    r = rp.where("doc_id = 't1' AND leaf_ord = 3").first()
    assert [n.node_id for n in r.path] == [3, 2, 1, 0]


def test_cycle_guard_raises(spark):
    rows = [("c", 0, None, 0, 1, "r", True, False, 1, 0, None),
            ("c", 1, 0, 0, 2, "a", True, False, 1, 0, None),
            ("c", 2, 1, 0, 3, "b", True, False, 1, 0, None)]
    with pytest.raises(ValueError):
        trees.root_paths(hand_nodes(spark, rows), max_depth=1)


def test_predicates_and_children(spark):
    p = {(r.doc_id, r.type): r for r in trees.node_predicates(hand_nodes(spark)).collect()}
    assert p[("t1", "fork")].is_fork and not p[("t1", "chain")].is_fork
    assert p[("t1", "identifier")].is_named_terminal
    assert not p[("t1", "comment")].is_named_terminal      # extra
    assert not p[("t1", ";")].is_named_terminal            # anonymous
    second = trees.node_children(hand_nodes(spark), 1).where("doc_id = 't1'").collect()
    assert sorted((r.parent_type, r.child_type) for r in second) == [("fork", "comment"), ("unit", "fork")]


def test_dot_graph(spark):
    dot = {r.doc_id: r.dot for r in trees.dot_graph(hand_nodes(spark)).collect()}
    assert dot["t1"].startswith("digraph tree {") and "n0 -> n1;" in dot["t1"] and 'n0 [label="unit"];' in dot["t1"]


def test_path_ids_function(spark):
    lp = trees.root_paths(hand_nodes(spark))
    r = lp.where("doc_id = 't3'").select(path_ids("path").alias("ids")).first()
    assert r.ids == "001005006007008"


def test_wide_hot_document(spark):
    """One document holds almost all nodes and one parent has thousands of children."""
    from sylva.schemas import NODES
    k = 3000
    rows = [("big", 0, None, 0, 1, "unit", True, False, k, 0, 0, 0, 0, 0, 0, None)]
    for i in range(k):
        rows.append(("big", 1 + 2 * i, 0, i, 2, "stmt", True, False, 1, 0, 0, i, 0, i, 0, None))
        rows.append(("big", 2 + 2 * i, 1 + 2 * i, 0, 3, "word", True, False, 0, 0, 0, i, 0, i, 0, f"w{i % 7}"))
    rows.append(("tiny", 0, None, 0, 1, "unit", True, False, 0, 0, 0, 0, 0, 0, 0, "x"))
    nodes = spark.createDataFrame(rows, NODES).repartition(4)
    enc = trees.encoded_paths(nodes)
    got = enc.groupBy("doc_id", "path_ids", "fork_ids").count().collect()
    assert sorted((r.doc_id, r.path_ids, r.fork_ids, r["count"]) for r in got) == [
        ("big", "001002003", "001003", k), ("tiny", "001", "001", 1)]


def _chain(spark, n):
    from sylva.schemas import NODES
    rows = [("c", i, i - 1 if i else None, 0, 1 + i % 9, "n", True, False, int(i < n - 1), 0, 0, i, 0, i, 0, None)
            for i in range(n)]
    return spark.createDataFrame(rows, NODES)


@pytest.mark.parametrize(("n", "most"), [(40, 8), (1000, 12)])
def test_rounds_grow_with_the_logarithm_of_the_depth(spark, monkeypatch, n, most):
    written = []
    real = trees.write_table
    monkeypatch.setattr(trees, "write_table", lambda df, tag: written.append(tag) or real(df, tag))
    row = trees.encoded_paths(_chain(spark, n), only=["path_len", "path_ids"]).collect()
    assert len(row) == 1 and row[0].path_len == n
    assert row[0].path_ids == "".join(f"{1 + i % 9:03d}" for i in range(n))
    assert len(written) - 1 <= most          # the first write holds the inner nodes


def test_children_of_one_node_spread_over_tasks(spark):
    k = 400_000
    cols = {"parent_id": "0", "child_idx": "CAST(id AS INT)", "symbol": "2", "type": "'w'", "child_count": "0", "value": "'x'"}
    root = {"parent_id": "CAST(NULL AS INT)", "child_idx": "0", "symbol": "1", "type": "'r'", "child_count": str(k),
            "value": "CAST(NULL AS STRING)"}

    def table(df, node_id, c):
        return df.selectExpr("'wide' AS doc_id", f"CAST({node_id} AS INT) AS node_id", *[f"{v} AS {n}" for n, v in c.items()],
                             "true AS is_named", "false AS is_extra", "0 AS start_byte", "0 AS end_byte", "0 AS start_row",
                             "0 AS start_col", "0 AS end_row", "0 AS end_col")

    nodes = table(spark.range(k), "id + 1", cols).unionByName(table(spark.range(1), "0", root))
    out = trees.encoded_paths(nodes, only=["path_ids"])
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sizes = [r["count"] for r in out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sum(sizes) == k and len(sizes) >= 8


def test_lost_parent_raises(spark):
    whole = hand_nodes(spark)
    for gone in (1, 2):
        with pytest.raises(Exception, match="no parent row"):
            trees.encoded_paths(whole.where(f"NOT (doc_id = 't1' AND node_id = {gone})")).collect()


def test_nested_starts_give_a_path_each(spark):
    got = trees.subtree_paths(hand_nodes(spark), F.col("doc_id") == "t3").collect()
    assert sorted(tuple(n.node_id for n in r.path) for r in got) == sorted(tuple(range(i, 5)) for i in range(5))
    alone = trees.subtree_paths(hand_nodes(spark), F.col("type").isin("fork", "identifier")).collect()
    assert (4, 5) in {tuple(n.node_id for n in r.path) for r in alone} and all(r.path for r in alone)


def _bushy(spark, depth, docs=3):
    """Documents of several shapes whose inner nodes lie deeper than one round reaches."""
    import random
    from sylva.schemas import NODES
    rnd, rows = random.Random(depth), []
    for d in range(docs):
        kids, parent, level, made = {0: 0}, {0: None}, {0: 0}, [0]
        for i in range(1, 150):
            deep = [p for p in made if level[p] < depth - 1]
            p = deep[-1] if rnd.random() < 0.7 else rnd.choice(deep)
            parent[i], level[i], kids[i] = p, level[p] + 1, 0
            kids[p] += 1
            made.append(i)
        order, at = {}, {}

        def number(n):
            order[n] = len(order)
            for j, k in enumerate([x for x in made if parent[x] == n]):
                at[k] = j
                number(k)
        number(0)
        for n in made:
            rows.append((f"d{d}", order[n], None if parent[n] is None else order[parent[n]], at.get(n, 0), rnd.choice([1, 2, 30, 1200]),
                         "t", True, False, kids[n], 0, 0, n, 0, n, 0, f"v{n % 5}" if not kids[n] else None))
    return spark.createDataFrame(rows, NODES)


def test_long_paths_through_the_trie_equal_array_encodings(spark, monkeypatch):
    nodes = _bushy(spark, 40)
    used = []
    real = trees._trie
    monkeypatch.setattr(trees, "_trie", lambda *a: used.append(1) or real(*a))
    cols = ["doc_id", "leaf_ord", "path_ids", "path_len", "fork_ids", "fork_len", "reversed_ids", "reversed_fork_ids", "start_type"]
    for separator in ("", "/"):
        enc = trees.encoded_paths(nodes, separator=separator)
        ref = trees.encode_leaf_paths(trees.root_paths(nodes), separator)
        assert sorted(map(tuple, enc.select(cols).collect())) == sorted(map(tuple, ref.select(cols).collect()))
    assert used == [1, 1]


def test_trie_holds_every_distinct_prefix_once(spark):
    nodes = _bushy(spark, 12)
    rows = {(r.doc_id, r.node_id): r for r in nodes.collect()}

    def path(r):
        up = () if r.parent_id is None else path(rows[r.doc_id, r.parent_id])
        return (*up, (r.symbol, r.child_count == 1))
    want = {}
    for r in rows.values():
        if r.child_count:
            want[path(r)] = want.get(path(r), 0) + 1
    trie = {r.prefix: r for r in trees.path_trie(nodes).collect()}

    def spelled(r):
        return (*(() if r.parent is None else spelled(trie[r.parent])), (r.symbol, r.is_single))
    assert {spelled(r): r.n_nodes for r in trie.values()} == want
    for r in trie.values():
        symbols = [f"{s:03d}" for s, _ in spelled(r)]
        assert r.path_ids == "".join(symbols) and r.reversed_ids == "".join(reversed(symbols)) and r.path_len == len(symbols)


def test_two_prefixes_with_one_number_raise(spark, monkeypatch):
    monkeypatch.setattr(trees, "MODULI", (7, 5))
    monkeypatch.setattr(trees, "BASES", (3, 2))
    with pytest.raises(Exception, match="same number"):
        trees.path_trie(_bushy(spark, 20)).collect()


def test_documents_larger_than_a_task_walk_over_many(spark, monkeypatch):
    nodes = _bushy(spark, 30)
    want = sorted(map(tuple, trees.encoded_paths(nodes, only=["path_ids"]).collect()))
    monkeypatch.setattr(trees, "NODES_PER_TASK", 60)
    assert sorted(map(tuple, trees.encoded_paths(nodes, only=["path_ids"]).collect())) == want
