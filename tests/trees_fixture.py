"""Hand-made trees (<= 12 nodes each) in the ``nodes`` contract."""

from sylva.schemas import NODES

# (doc, node, parent, child_idx, symbol, type, named, extra, child_count, row, value)
_ROWS = [
    # doc t1: root(1) -> [chain(2) -> mid(3) -> x(10)], [fork(4) -> y(11), c(12, extra), z(1234)]
    ("t1", 0, None, 0, 1, "unit", True, False, 2, 0, None),
    ("t1", 1, 0, 0, 2, "chain", True, False, 1, 0, None),
    ("t1", 2, 1, 0, 3, "mid", True, False, 1, 1, None),
    ("t1", 3, 2, 0, 10, "identifier", True, False, 0, 1, "foo"),
    ("t1", 4, 0, 1, 4, "fork", True, False, 3, 2, None),
    ("t1", 5, 4, 0, 11, "number", True, False, 0, 2, "42"),
    ("t1", 6, 4, 1, 12, "comment", True, True, 0, 3, "// hi"),
    ("t1", 7, 4, 2, 1234, ";", False, False, 0, 3, ";"),
    # doc t2: a single node
    ("t2", 0, None, 0, 1, "unit", True, False, 0, 0, ""),
    # doc t3: root -> a -> b -> c -> d -> leaf (5+ nodes, single-child chain)
    ("t3", 0, None, 0, 1, "unit", True, False, 1, 0, None),
    ("t3", 1, 0, 0, 5, "a", True, False, 1, 0, None),
    ("t3", 2, 1, 0, 6, "b", True, False, 1, 0, None),
    ("t3", 3, 2, 0, 7, "c", True, False, 1, 0, None),
    ("t3", 4, 3, 0, 8, "string", True, False, 0, 4, "hello"),
]


def hand_nodes(spark, rows=None):
    out = []
    for d, nid, pid, idx, sym, typ, named, extra, cc, row, val in rows or _ROWS:
        out.append((d, nid, pid, idx, sym, typ, named, extra, cc, 0, 0, row, 0, row, 0, val))
    return spark.createDataFrame(out, NODES)
