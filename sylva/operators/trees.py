"""Tree operators over the ``nodes`` table (one row per node, parent pointers).

Paths are built by following pointers (see :func:`fold_paths`). Every inner node
holds a pointer to an ancestor and a value folded over the nodes below that
ancestor down to itself; a jump joins each node with the row its pointer
names, joins the two values and takes over that row's pointer. Pointers never
leave a document, so rows are dealt by document once for all, and a round makes
``JUMPS`` jumps without an exchange, since the node table and the tables of the
rounds are written dealt by document: a tree of depth ``d`` needs about
``log(d) / log(JUMPS + 1)`` rounds. Documents that would not fit in a task go
through rounds of one jump, dealt by node. Nodes whose pointer has reached
their start node leave the rounds. Only inner nodes take part; terminals (most
of a tree) are attached to their parents at the end and written once more, in
place too. In documents that have very wide nodes or would not fit in a task,
the join is salted by child ordinal instead, so the children of one very wide
node spread over many tasks. The node table is written once and read by both.

A walk carries only the folds that are asked for. Rounds are written to the
shared checkpoint folder (``spark.checkpoint.dir``), so the plan stays flat
and a lost executor does not force recomputing earlier rounds. A node whose
parent row is missing raises an error when the result is computed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylva.functions.paths import fork_nodes, padded_symbol, path_ids
from sylva.functions.text import byte_slice
from sylva.operators.lookup import attach
from sylva.schemas import PATH_NODE_FIELDS
from sylva.session import bucket_count, by_document, deal_table, drop_table, union_dealt, write_table

# Children of one node that one task attaches at most.
CHILDREN_PER_TASK = 10_000
# Joins of a round over documents that fit in a task: a round multiplies the distance covered by JUMPS + 1.
JUMPS = 4
# Inner nodes of a bucket up to which the first round and the terminals find their parents by hash, and not by sorting.
HASHED_NODES = 1_000_000
# Inner nodes of a document that one task walks at most; larger documents are walked over many tasks.
NODES_PER_TASK = 4_000_000


@dataclass(frozen=True)
class Fold:
    """A value folded along a path, root first.

    ``own()`` is the value of a single node, read from its columns (``symbol``,
    ``type``, ``child_count``, ...); ``join(upper, lower)`` is the value of two
    adjoining stretches of a path. ``join`` must be associative.
    """

    own: Callable[[], Column]
    join: Callable[[Column, Column], Column]


def _path_elem() -> Column:
    return F.struct(*[F.col(c) for c in PATH_NODE_FIELDS])


def node_predicates(nodes: DataFrame) -> DataFrame:
    """Add ``is_terminal`` (no children), ``is_named_terminal`` (terminal, named, not extra), ``is_fork`` (>= 2)."""
    term = F.col("child_count") == 0
    return nodes.select(
        "*",
        term.alias("is_terminal"),
        (term & F.col("is_named") & ~F.col("is_extra")).alias("is_named_terminal"),
        (F.col("child_count") >= 2).alias("is_fork"),
    )


def terminal_values(nodes: DataFrame, sources: DataFrame) -> DataFrame:
    """Source text of every terminal, cut by its byte range: ``doc_id, node_id, type, text``."""
    terms = nodes.where(F.col("child_count") == 0).select("doc_id", "node_id", "type", "start_byte", "end_byte")
    j = terms.join(sources.select("doc_id", "text"), "doc_id")
    return j.select("doc_id", "node_id", "type", byte_slice("text", "start_byte", "end_byte").alias("text"))


def same_node(a_doc: Column, a_node: Column, b_doc: Column, b_node: Column) -> Column:
    """Node equality: same document and same node id."""
    return (a_doc == b_doc) & (a_node == b_node)


def tree_edges(nodes: DataFrame) -> DataFrame:
    """Parent -> child edges with the child's ordinal and both types."""
    parents = nodes.select("doc_id", F.col("node_id").alias("parent_id"), F.col("type").alias("parent_type"))
    kids = nodes.where(F.col("parent_id").isNotNull()).select(
        "doc_id", "parent_id", "node_id", "child_idx", F.col("type").alias("child_type"))
    return kids.join(parents, ["doc_id", "parent_id"])


def node_children(nodes: DataFrame, i: int | None = None) -> DataFrame:
    """The ``i``-th child of every node (all children when ``i`` is None).

    Self-join on (``doc_id``, ``parent_id`` = ``node_id``); the child ordinal
    is a plain column, so asking for one ordinal is a pushed-down filter.
    """
    edges = tree_edges(nodes)
    return edges if i is None else edges.where(F.col("child_idx") == F.lit(i))


def _union(parts: list[DataFrame]) -> DataFrame:
    return union_dealt(parts)


def _written(nodes: DataFrame, start: Column | None, leaf_filter: Column | None, keep: list[str] | None = None) -> DataFrame:
    """The node table of a walk, written once: with ``_start``, and without the terminals that ``leaf_filter`` drops.

    ``keep``: the columns that are read later (default: all). Inner nodes and terminals lie apart (``has_children``), so that the rounds read inner nodes only.
    """
    anchor = F.col("parent_id").isNull() if start is None else F.coalesce(start, F.lit(False))
    buckets = bucket_count(nodes)
    t = nodes.withColumn("_start", anchor).withColumn("has_children", F.coalesce(F.col("child_count") > 0, F.lit(False)))
    if leaf_filter is not None:
        t = t.where((F.col("child_count") > 0) | leaf_filter)
    if keep is not None:
        t = t.select(*keep, "_start", "has_children")
    return deal_table(t, "walk", buckets=buckets, apart="has_children")


@dataclass(frozen=True)
class Shape:
    """Sizes of a written node table: inner nodes, those of its fullest bucket and their children, the widest node's children."""

    inner: int
    fullest: int
    children: int
    widest: int

    @property
    def hashed(self) -> bool:
        return self.fullest <= HASHED_NODES


def _shape(table: DataFrame) -> Shape:
    bucket = F.pmod(F.hash("doc_id"), F.lit(table.dealt))
    sizes = (table.where("has_children").groupBy(bucket)
             .agg(F.count(F.lit(1)).alias("n"), F.sum("child_count").alias("all"), F.max("child_count").alias("most")))
    return Shape(*[v or 0 for v in sizes.agg(F.sum("n"), F.max("n"), F.max("all"), F.max("most")).first()])


def _jump(moving: DataFrame, above: DataFrame, folds: dict[str, Fold]) -> DataFrame:
    """Join every row with the row its pointer names; rows that are done match nothing and stay as they are."""
    j = moving.join(above, (F.col("doc_id") == F.col("_doc")) & (F.col("up") == F.col("_at")), "left")
    found = F.col("_doc").isNotNull()
    return j.select(
        "doc_id", "node_id", "parent_id", "child_count", "is_start",
        *[F.when(found, f.join(F.col(f"_{k}"), F.col(k))).otherwise(F.col(k)).alias(k) for k, f in folds.items()],
        F.when(found, F.col("_up")).alias("up"), F.when(found, F.col("_top")).otherwise(F.col("top")).alias("top"),
        F.when(found, F.col("_lost")).otherwise(F.col("lost") | F.col("up").isNotNull()).alias("lost"))


class _Tables(list):
    """Frames of a walk, with the tables made for them in ``made``."""

    def __init__(self, frames=(), made=()):
        super().__init__(frames)
        self.made = [*made]

    def union(self) -> DataFrame:
        whole = _union(self).drop("up")
        whole.made = self.made
        return whole

    def drop(self) -> None:
        for table in self.made:
            drop_table(table)


def _forget(result: DataFrame, *read: DataFrame) -> DataFrame:
    """``result``; if it is a written table, those that only it was made from go: the node table and the rounds'."""
    if hasattr(result, "dealt"):
        for table in [t for r in read for t in getattr(r, "made", [r] if hasattr(r, "dealt") else [])]:
            drop_table(table)
    return result


def _rounds(rows: DataFrame, folds: dict[str, Fold], max_depth: int, together: bool,
            most: int | None = None, buckets: int | None = None, hashed: bool = False) -> list[DataFrame] | None:
    """Follow all pointers to their ends; the tables returned hold each row of ``rows`` once.

    With ``most``: None if some pointer has not reached its end after so many rounds.

    ``together``: ``rows`` come dealt by document to ``buckets``, and a round makes ``JUMPS`` joins without an exchange.
    Otherwise a round is one join dealt by (document, pointer), so that no document has to fit in a task.
    ``hashed``: the first round, in which values are of single nodes, joins by hash.
    """
    done, moving, covered, rounds = _Tables(), rows, 1, 0
    if rows.where("up IS NOT NULL").isEmpty():
        return _Tables([rows])
    while rounds == 0 or not moving.isEmpty():
        if most is not None and rounds >= most:
            done.drop()
            return None
        if covered > max_depth:
            raise ValueError(f"trees deeper than max_depth={max_depth} (cycle in parent pointers?)")
        above = _union([*done, moving]).select(
            F.col("doc_id").alias("_doc"), F.col("node_id").alias("_at"), F.col("up").alias("_up"),
            F.col("top").alias("_top"), F.col("lost").alias("_lost"), *[F.col(k).alias(f"_{k}") for k in folds])
        if hashed and rounds == 0:
            above = above.hint("shuffle_hash")
        jumps = min(JUMPS, max(1, max_depth // covered)) if together else 1
        for _ in range(jumps):
            moving = _jump(moving, above, folds)
        # the first round writes all rows, so that those of a short walk lie in one table, dealt by document
        table = deal_table(moving, "walk", buckets=buckets) if together else write_table(moving, "walk")
        done.made.append(table)
        done.append(table.where("up IS NULL"))
        moving = table.where("up IS NOT NULL")
        covered, rounds = covered * (jumps + 1), rounds + 1
    return done


def _start_rows(table: DataFrame, folds: dict[str, Fold]) -> DataFrame:
    """Inner nodes with their own values and a pointer to their parent, or none if they are start nodes or roots."""
    stop = F.col("_start") | F.col("parent_id").isNull()
    return (table.where("child_count > 0")
            .select("doc_id", "node_id", "parent_id", "child_count", F.col("_start").alias("is_start"),
                    *[f.own().alias(k) for k, f in folds.items()],
                    F.when(~stop, F.col("parent_id")).alias("up"), F.when(F.col("_start"), F.col("node_id")).alias("top"),
                    F.lit(False).alias("lost")))


def _large_documents(rows: DataFrame, shape: Shape) -> DataFrame | None:
    """Documents with more than ``NODES_PER_TASK`` of ``rows``; None if there are none."""
    if shape.fullest <= NODES_PER_TASK:
        return None
    large = write_table(rows.groupBy("doc_id").count().where(F.col("count") > NODES_PER_TASK).select("doc_id"), "walk")
    return None if large.isEmpty() else large


def _short_folds(table: DataFrame, folds: dict[str, Fold], max_depth: int, shape: Shape) -> DataFrame | None:
    """The folds of all inner nodes if one round reaches them all, else None."""
    rows = _start_rows(table.where("has_children"), folds)
    if _large_documents(rows, shape) is not None:
        return None
    done = _rounds(rows, folds, max_depth, True, most=1, buckets=table.dealt, hashed=shape.hashed)
    return None if done is None else done.union()


def _walked(table: DataFrame, folds: dict[str, Fold], max_depth: int, shape: Shape) -> tuple[DataFrame, bool]:
    """The folds of all inner nodes, and whether one round has reached them all."""
    rows = _start_rows(table.where("has_children"), folds)
    large = _large_documents(rows, shape)
    if large is None:
        done = _rounds(rows, folds, max_depth, True, buckets=table.dealt, hashed=shape.hashed)
        return done.union(), len(done) == 1
    near = _rounds(rows.join(large, "doc_id", "left_anti"), folds, max_depth, True, buckets=table.dealt)
    far = _rounds(rows.join(large, "doc_id", "left_semi"), folds, max_depth, together=False)
    return _Tables([*near, *far], [*near.made, *far.made]).union(), False


def inner_folds(nodes: DataFrame, folds: dict[str, Fold], start: Column | None = None,
                max_depth: int = 10_000) -> DataFrame:
    """Every inner node with its nearest start node and the folds from there down to itself.

    Columns: ``doc_id, node_id, parent_id, child_count, is_start, top`` (the
    start node's id; null if there is none above), ``lost`` (a parent row is
    missing on the way) and one column per fold. The number of rounds is the
    logarithm of the depth; more than ``max_depth`` allows raises, which also
    catches cycles of parent pointers.
    """
    table = _written(nodes.where("child_count > 0"), start, None)
    return _walked(table, folds, max_depth, _shape(table))[0]


def _with_parents(table: DataFrame, inner: DataFrame, values: list[str], shape: Shape, hashed: bool = False,
                  finish: Callable[[DataFrame], DataFrame] = lambda joined: joined) -> DataFrame:
    """Terminals of ``table`` with ``top`` and ``values`` of their parents; raises if a row above is missing.

    Terminals meet their parents where their document lies, and the result is written. Documents with more than
    ``CHILDREN_PER_TASK`` children of one node or ``NODES_PER_TASK`` nodes are joined apart (:func:`_spread_parents`).
    ``hashed``: the values of a bucket's parents fit in a hash table. ``finish`` is applied before the write.
    """
    if shape.widest <= CHILDREN_PER_TASK and shape.children <= NODES_PER_TASK:  # then no document is large or wide
        return _near_parents(table, inner, values, table.dealt, finish, hashed)
    with by_document(table.sparkSession):
        wide = write_table(inner.groupBy("doc_id").agg(F.max("child_count").alias("most"), F.sum("child_count").alias("all"))
                           .where((F.col("most") > CHILDREN_PER_TASK) | (F.col("all") > NODES_PER_TASK)).select("doc_id"), "walk")
    if wide.isEmpty():
        return _near_parents(table, inner, values, table.dealt, finish, hashed)
    near, far = ([df.join(wide, "doc_id", how) for df in (table, inner)] for how in ("left_anti", "left_semi"))
    return _near_parents(*near, values, table.dealt, finish).unionByName(finish(_spread_parents(*far, values)))


def _near_parents(table: DataFrame, inner: DataFrame, values: list[str], buckets: int,
                  finish: Callable[[DataFrame], DataFrame], hashed: bool = False) -> DataFrame:
    parents = inner.select("doc_id", F.col("node_id").alias("parent_id"), F.lit(True).alias("_found"), "top", "lost", *values)
    joined = _terminals(table).join(parents.hint("shuffle_hash") if hashed else parents, ["doc_id", "parent_id"], "left")
    return deal_table(finish(_checked(joined, values, table)), "walk", buckets=buckets)


def _terminals(table: DataFrame) -> DataFrame:
    return table.where("NOT has_children AND child_count = 0")


def _spread_parents(table: DataFrame, inner: DataFrame, values: list[str]) -> DataFrame:
    """The join is on (``doc_id``, ``parent_id``, block of child ordinals); a parent stands once for every block of
    ``CHILDREN_PER_TASK`` children."""
    block = F.floor(F.coalesce("child_idx", F.lit(0)) / CHILDREN_PER_TASK)
    leaves = _terminals(table).withColumn("_block", block)
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("child_count") - 1) / CHILDREN_PER_TASK))
    parents = inner.select("doc_id", F.col("node_id").alias("parent_id"), F.explode(blocks).alias("_block"),
                           F.lit(True).alias("_found"), "top", "lost", *values)
    return _checked(leaves.join(parents, ["doc_id", "parent_id", "_block"], "left"), values, table)


def _checked(joined: DataFrame, values: list[str], table: DataFrame) -> DataFrame:
    orphan = (F.col("parent_id").isNotNull() & F.col("_found").isNull()) | F.coalesce("lost", F.lit(False))
    lost = F.raise_error(F.format_string("node %s of document %s has no parent row above it",
                                         F.col("node_id").cast("string"), F.col("doc_id")))
    # the check is part of a value, so that no filter on that value can pass it by
    own = [c for c in table.columns if c != "has_children"]
    return joined.select(*own, F.when(orphan, lost.cast("int")).otherwise(F.col("top")).alias("top"), *values)


# Columns of the node table that paths, encodings and fingerprints read.
_READ = ["doc_id", "node_id", "parent_id", "child_idx", "symbol", "type", "is_named", "is_extra", "child_count", "start_row",
         "value"]
_LEAF_COLUMNS = {"doc_id": "doc_id", "node_id": "leaf_ord", "symbol": "leaf_symbol", "type": "leaf_type",
                 "is_named": "leaf_is_named", "is_extra": "leaf_is_extra", "value": "leaf_value", "start_row": "leaf_row"}


def _leaf_columns() -> list[Column]:
    return [F.col(c).alias(out) for c, out in _LEAF_COLUMNS.items()]


def fold_paths(nodes: DataFrame, folds: dict[str, Fold], start: Column | None = None,
               max_depth: int = 10_000, leaf_filter: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """Fold values along every path from a start node down to each terminal below it.

    ``start`` is a predicate over ``nodes`` choosing the start nodes (default:
    the roots, ``parent_id IS NULL``). One output row per start node and
    terminal: ``doc_id, leaf_ord`` (the terminal's preorder id = document
    order), its own ``leaf_symbol, leaf_type, leaf_is_named, leaf_is_extra,
    leaf_value, leaf_row`` and one column per fold. ``leaf_filter`` (over the
    node columns) drops terminals before they are attached. ``keep`` names the
    node columns that the folds and the output read (default: all).

    ``nodes`` is computed once, and so is the way from a terminal to its parent's folds.
    """
    table = _written(nodes, start, leaf_filter, keep)
    shape = _shape(table)
    inner, short = _walked(table, folds, max_depth, shape)
    return _forget(_fold_terminals(table, inner, folds, shape, start, shape.hashed and short), table, inner)


def _fold_terminals(table: DataFrame, inner: DataFrame, folds: dict[str, Fold], shape: Shape, start: Column | None = None,
                    hashed: bool = False) -> DataFrame:
    if start is None:  # a terminal is below a root or is one
        return _with_parents(table, inner, list(folds), shape, hashed, lambda joined: _ended(joined, folds))
    joined = _with_parents(table, inner, list(folds), shape, hashed)
    below = {k: f.join(F.col(k), f.own()) for k, f in folds.items()}
    keep = ["top", *_LEAF_COLUMNS]
    under = joined.where("top IS NOT NULL").select(*keep, *[v.alias(k) for k, v in below.items()])
    alone = joined.where("_start").select(*keep, *[f.own().alias(k) for k, f in folds.items()])
    out = [under, alone, *_outer_starts(inner, under, alone, folds, keep)]
    return _union(out).select(*_leaf_columns(), *folds)


def _ended(joined: DataFrame, folds: dict[str, Fold], *more: str) -> DataFrame:
    """Terminals with their leaf columns, their folds from the root and the columns ``more``."""
    return joined.select(*_leaf_columns(), *more, *[F.when(F.col("top").isNotNull(), f.join(F.col(k), f.own())).otherwise(f.own())
                                                    .alias(k) for k, f in folds.items()])


def _outer_starts(inner: DataFrame, below: DataFrame, alone: DataFrame, folds: dict[str, Fold],
                  keep: list[str]) -> list[DataFrame]:
    """Rows of start nodes that enclose other start nodes: one more step up for each level of nesting."""
    stretch = (inner.where("is_start AND parent_id IS NOT NULL").select("doc_id", F.col("node_id").alias("top"), "parent_id")
               .join(inner.select("doc_id", F.col("node_id").alias("parent_id"), F.col("top").alias("_top"),
                                  *[F.col(k).alias(f"_{k}") for k in folds]), ["doc_id", "parent_id"])
               .where("_top IS NOT NULL").drop("parent_id"))
    with by_document(stretch.sparkSession):
        none = stretch.isEmpty()
    if none:
        return []
    stretch = write_table(stretch, "walk")
    out, rows = [], below
    while True:
        up = rows.join(stretch, ["doc_id", "top"]).select(
            *[F.col("_top").alias("top") if c == "top" else F.col(c) for c in keep],
            *[f.join(F.col(f"_{k}"), F.col(k)).alias(k) for k, f in folds.items()])
        rows = write_table(up, "walk")
        if rows.isEmpty():
            return out
        out.append(rows)


def walk_inner(nodes: DataFrame, folds: dict[str, Fold], max_depth: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """The written node table and its inner nodes with their folds from the root (see :func:`inner_folds`)."""
    table = _written(nodes, None, None, _READ)
    return table, _walked(table, folds, max_depth, _shape(table))[0]


def terminals_below(table: DataFrame, inner: DataFrame, folds: dict[str, Fold], skip: DataFrame | None = None) -> DataFrame:
    """Terminals with their folds, as :func:`fold_paths` gives them, from the two results of :func:`walk_inner`.

    ``skip`` (``doc_id, node_id``, distinct) lists inner nodes whose terminals are left out.
    """
    shape = _shape(table)
    if skip is None:
        return _fold_terminals(table, inner, folds, shape)
    gone = skip.select("doc_id", "node_id", F.lit(True).alias("_skip"))
    parents = inner.join(gone, ["doc_id", "node_id"], "left")
    joined = _with_parents(table, parents, [*folds, "_skip"], shape, finish=lambda joined: _ended(joined, folds, "_skip"))
    return joined.where("_skip IS NULL").drop("_skip")


def array_fold() -> Fold:
    """The path itself: array of node structs, root first."""
    return Fold(lambda: F.array(_path_elem()), F.concat)


def ids_fold(separator: str = "") -> Fold:
    """Padded symbols of all nodes, joined by ``separator``."""
    return Fold(lambda: padded_symbol("symbol"), lambda upper, lower: F.concat(upper, F.lit(separator), lower))


def reversed_ids_fold(separator: str = "") -> Fold:
    """Padded symbols of all nodes, terminal first."""
    return Fold(lambda: padded_symbol("symbol"), lambda upper, lower: F.concat(lower, F.lit(separator), upper))


def _joined(first: Column, second: Column, separator: str) -> Column:
    return (F.when(first == F.lit(""), second).when(second == F.lit(""), first)
            .otherwise(F.concat(first, F.lit(separator), second)))


def fork_ids_fold(separator: str = "", reverse: bool = False) -> Fold:
    """Padded symbols of forks and terminals only (single-child nodes skipped); terminal first with ``reverse``."""

    def own() -> Column:
        return F.when(F.col("child_count") != 1, padded_symbol("symbol")).otherwise(F.lit(""))

    if reverse:
        return Fold(own, lambda upper, lower: _joined(lower, upper, separator))
    return Fold(own, lambda upper, lower: _joined(upper, lower, separator))


def count_fold(forks_only: bool = False) -> Fold:
    """Number of nodes on the path (or of forks and terminals only)."""

    def own() -> Column:
        return F.when(F.col("child_count") != 1, F.lit(1)).otherwise(F.lit(0)) if forks_only else F.lit(1)

    return Fold(own, lambda upper, lower: upper + lower)


def start_type_fold() -> Fold:
    """Type of the path's first node."""
    return Fold(lambda: F.col("type"), lambda upper, lower: upper)


def path_folds(separator: str = "") -> dict[str, Fold]:
    """All compact encodings by column name."""
    return {
        "path_ids": ids_fold(separator),
        "path_len": count_fold(),
        "fork_ids": fork_ids_fold(separator),
        "fork_len": count_fold(forks_only=True),
        "reversed_ids": reversed_ids_fold(separator),
        "reversed_fork_ids": fork_ids_fold(separator, reverse=True),
        "start_type": start_type_fold(),
    }


# Two primes below 2^31 (products fit a long) and a base for each, for the numbers that stand for path prefixes.
MODULI = (2_147_483_629, 2_147_483_587)
BASES = (1_000_003, 1_299_709)
# Encodings that depend on nothing but the symbols of a path and on which of its nodes have a single child.
TRIE_ENCODINGS = ("path_ids", "path_len", "fork_ids", "fork_len", "reversed_ids", "reversed_fork_ids")
# Prefixes whose encodings one task folds at most.
PREFIXES_PER_TASK = 100_000


def _code() -> Column:
    """A node's symbol and whether it has a single child, as one number above 0."""
    return F.col("symbol").cast("long") * 2 + (F.col("child_count") == 1).cast("int") + 1


def prefix_fold() -> Fold:
    """Polynomial of the path's codes modulo two primes, with the factors that a longer path needs.

    Four numbers whatever the length of the path: a walk carries these instead of growing strings.
    """

    def own() -> Column:
        return F.struct(*[F.pmod(_code(), F.lit(m)).alias(f"h{i}") for i, m in enumerate(MODULI)],
                        *[F.lit(b).cast("long").alias(f"w{i}") for i, b in enumerate(BASES)])

    def join(upper: Column, lower: Column) -> Column:
        return F.struct(*[((upper[f"h{i}"] * lower[f"w{i}"] + lower[f"h{i}"]) % m).alias(f"h{i}") for i, m in enumerate(MODULI)],
                        *[((upper[f"w{i}"] * lower[f"w{i}"]) % m).alias(f"w{i}") for i, m in enumerate(MODULI)])

    return Fold(own, join)


def _prefix_id(hashes: list[Column]) -> Column:
    return F.shiftleft(hashes[0], 31).bitwiseOR(hashes[1])


def _prefix_of(fold: str) -> Column:
    return _prefix_id([F.col(fold)[f"h{i}"] for i in range(len(MODULI))])


def _trie(inner: DataFrame, max_depth: int, separator: str, names: list[str]) -> DataFrame:
    """All distinct prefixes of ``inner`` (folded with ``prefix`` and ``symbol``), written, with their encodings.

    The parent's number follows from a prefix's own number and its last code, so edges come from one partial
    aggregate without a join. Two prefixes that share a number would give it two edges; that raises an error.
    """
    hashes = [F.pmod(F.pmod(F.col("prefix")[f"h{i}"] - _code(), F.lit(m)) * pow(b, -1, m), F.lit(m))
              for i, (m, b) in enumerate(zip(MODULI, BASES))]
    edge = [_prefix_of("prefix").alias("prefix"), F.when(F.col("parent_id").isNotNull(), _prefix_id(hashes)).alias("parent"),
            "symbol", (F.col("child_count") == 1).alias("is_single")]
    edges = inner.select(*edge).groupBy("prefix", "parent", "symbol", "is_single").agg(F.count(F.lit(1)).alias("n_nodes"))
    clash = F.raise_error(F.lit("two path prefixes have the same number")).cast("long")
    alone = F.count(F.lit(1)).over(Window.partitionBy("prefix")) == 1
    rows = write_table(edges.withColumn("n_nodes", F.when(alone, F.col("n_nodes")).otherwise(clash)), "trie")
    all_folds = path_folds(separator)
    folds = {"n_nodes": _last("n_nodes"), "symbol": _last("symbol"), "is_single": _last("is_single"),
             **{k: all_folds[k] for k in names}}
    tree = rows.select(F.lit("").alias("doc_id"), F.col("prefix").alias("node_id"), F.col("parent").alias("parent_id"),
                       "symbol", "is_single", "n_nodes", F.when(F.col("is_single"), 1).otherwise(2).alias("child_count"))
    small = rows.limit(PREFIXES_PER_TASK + 1).count() <= PREFIXES_PER_TASK
    done = _rounds(_start_rows(tree.withColumn("_start", F.col("parent_id").isNull()), folds), folds, max_depth, together=small)
    return _union(done).select(F.col("node_id").alias("prefix"), F.col("parent_id").alias("parent"), "symbol", "is_single",
                               "n_nodes", *names)


def _last(name: str) -> Fold:
    """A column of the path's last node."""
    return Fold(lambda: F.col(name), lambda upper, lower: lower)


def path_trie(nodes: DataFrame, separator: str = "", max_depth: int = 10_000) -> DataFrame:
    """Dictionary of the distinct root-to-node paths over inner nodes.

    A path is told by its symbols and by which of its nodes have a single child. Columns: ``prefix`` (its number),
    ``parent`` (the number of the path without its last node; null at roots), the last node's ``symbol`` and
    ``is_single``, ``n_nodes`` (nodes of all documents with that path) and the encodings of :func:`path_folds`
    that need nothing else. Nodes whose own or any upper parent row is missing are left out.
    """
    inner = inner_folds(nodes, {"prefix": prefix_fold(), "symbol": _last("symbol")}, max_depth=max_depth)
    return _trie(inner.where("top IS NOT NULL AND NOT lost"), max_depth, separator, list(TRIE_ENCODINGS))


def encoded_paths(nodes: DataFrame, start: Column | None = None, separator: str = "",
                  max_depth: int = 10_000, only: list[str] | None = None,
                  leaf_filter: Column | None = None) -> DataFrame:
    """Compact path encodings of every terminal (no path arrays).

    Columns: the leaf columns of :func:`fold_paths` and those of
    :func:`path_folds`, or just the encodings named in ``only``.

    Paths from the roots that are longer than a round reaches carry numbers of fixed size (:func:`prefix_fold`); their
    strings are made once for each distinct prefix (:func:`path_trie`) and joined to the terminals by that
    number. Short paths, whose strings are no larger than the numbers, and paths from other start nodes fold
    their strings in the walk.
    """
    folds = {k: path_folds(separator)[k] for k in (only or path_folds(separator))}
    names = [k for k in folds if k in TRIE_ENCODINGS]
    if start is not None or not names:
        return fold_paths(nodes, folds, start=start, max_depth=max_depth, leaf_filter=leaf_filter, keep=_READ)
    rest = {k: f for k, f in folds.items() if k not in TRIE_ENCODINGS}
    table = _written(nodes, None, leaf_filter, _READ)
    shape = _shape(table)
    short = _short_folds(table, folds, max_depth, shape)
    if short is not None:
        return _forget(_fold_terminals(table, short, folds, shape, hashed=shape.hashed), table, short)
    inner, _ = _walked(table, {"prefix": prefix_fold(), "symbol": _last("symbol"), **rest}, max_depth, shape)
    trie = _trie(inner.where("top IS NOT NULL AND NOT lost"), max_depth, separator, names)
    parents = inner.select("doc_id", "node_id", "child_count", "top", "lost", _prefix_of("prefix").alias("prefix"), *rest)
    joined = attach(_with_parents(table, parents, ["prefix", *rest], shape, shape.hashed), trie.select("prefix", *names), ["prefix"],
                    F.xxhash64("doc_id", "node_id"))
    return _ended(joined, folds)


def encode_leaf_paths(leaf_paths: DataFrame, separator: str = "") -> DataFrame:
    """The same encodings computed from a ``leaf_paths`` table (e.g. from a parse job)."""
    last = F.element_at("path", -1)
    forks = fork_nodes("path")
    return leaf_paths.select(
        "doc_id", "leaf_ord",
        last["symbol"].alias("leaf_symbol"), last["type"].alias("leaf_type"),
        last["is_named"].alias("leaf_is_named"), last["is_extra"].alias("leaf_is_extra"),
        "leaf_value", "leaf_row",
        path_ids("path", separator).alias("path_ids"),
        F.size("path").alias("path_len"),
        path_ids(forks, separator).alias("fork_ids"),
        F.size(forks).alias("fork_len"),
        path_ids(F.reverse("path"), separator).alias("reversed_ids"),
        path_ids(F.reverse(forks), separator).alias("reversed_fork_ids"),
        F.element_at("path", 1)["type"].alias("start_type"),
    )


def root_paths(nodes: DataFrame, start: Column | None = None, max_depth: int = 10_000) -> DataFrame:
    """All paths from each start node down to every terminal below it, every node kept.

    Output ``leaf_paths``: ``doc_id``, ``leaf_ord`` (preorder id of the
    terminal, i.e. document order), ``path`` (root first), ``leaf_value``,
    ``leaf_row``.
    """
    out = fold_paths(nodes, {"path": array_fold()}, start=start, max_depth=max_depth, keep=_READ)
    return out.select("doc_id", "leaf_ord", "path", "leaf_value", "leaf_row")


def subtree_paths(nodes: DataFrame, start: Column, max_depth: int = 10_000) -> DataFrame:
    """Paths from every node matching ``start`` down to its terminals."""
    return root_paths(nodes, start=start, max_depth=max_depth)


def fork_paths(leaf_paths: DataFrame) -> DataFrame:
    """Compressed paths: forks (>= 2 children) and the terminal only."""
    return leaf_paths.withColumn("path", fork_nodes("path"))


def reverse_paths(leaf_paths: DataFrame) -> DataFrame:
    """Paths listed terminal first."""
    return leaf_paths.withColumn("path", F.reverse("path"))


def path_summary(leaf_paths: DataFrame, separator: str = "") -> DataFrame:
    """Readable form of a path table: ids string, length, leaf type and value."""
    last = F.element_at("path", -1)
    return leaf_paths.select(
        "doc_id",
        path_ids("path", separator).alias("path_ids"),
        F.size("path").alias("path_len"),
        last["type"].alias("leaf_type"),
        "leaf_value",
        "leaf_row",
    )


def dot_graph(nodes: DataFrame) -> DataFrame:
    """One DOT digraph per document (export format; the edge list is :func:`tree_edges`)."""
    # a node stands once in the rows that meet; its lines are spelled when the document is put together
    grouped = nodes.groupBy("doc_id").agg(F.collect_list(F.struct("node_id", "parent_id", "type")).alias("nodes"))

    def lines(of: Column, spell: Callable[[Column], Column]) -> Column:
        return F.transform(F.array_sort(F.transform(of, lambda n: F.struct(n["node_id"].alias("node_id"), spell(n).alias("s")))),
                           lambda x: x["s"])

    labels = lines(F.col("nodes"), lambda n: F.format_string(
        '  n%d [label="%s"];', n["node_id"], F.regexp_replace(n["type"], '"', '\\\\"')))
    edges = lines(F.filter("nodes", lambda n: n["parent_id"].isNotNull()), lambda n: F.format_string(
        "  n%d -> n%d;", n["parent_id"], n["node_id"]))
    return grouped.select(
        "doc_id",
        F.concat(F.lit("digraph tree {\n"), F.array_join(F.concat(labels, edges), "\n"), F.lit("\n}\n")).alias("dot"))
