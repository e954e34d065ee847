"""Driver tables -> library contracts (the mapping of FIXTURES.md).

* ``submissions`` <- ``orders``: one submission per order.
* ``sources``     <- ``documents``: one source file per document.
* ``nodes``       <- ``orders`` + ``lineitem`` + ``part``: one tree per order.
* ``clicks``      <- ``events`` of type ``click``: reviewer clicks on lines.

All of it is lazy DataFrame code, so the fixtures grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylva.functions.text import file_stem

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def submissions_from_orders(orders: DataFrame, language: str = "cpp") -> DataFrame:
    """Metadata table: order -> submission; status F -> OK, O -> PT, else P."""
    status = (F.when(F.col("o_orderstatus") == "F", "OK")
              .when(F.col("o_orderstatus") == "O", "PT")
              .otherwise("P"))
    return orders.select(
        F.col("o_orderkey").cast("string").alias("submission_id"),
        F.col("o_orderpriority").alias("problem_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.lit(language).alias("language"),
        status.alias("status"),
    )


def dirty_submissions_from_orders(orders: DataFrame) -> DataFrame:
    """Metadata with missing fields: priority ``4-NOT SPECIFIED`` becomes an empty problem id."""
    sub = submissions_from_orders(orders)
    return sub.withColumn(
        "problem_id", F.when(F.col("problem_id") == "4-NOT SPECIFIED", F.lit("")).otherwise(F.col("problem_id")))


def sources_from_documents(documents: DataFrame) -> DataFrame:
    """Source files: problem = document source, name = ``<doc_id % 700>.<lang>`` (forces collisions)."""
    name = F.concat((F.col("doc_id") % 700).cast("string"), F.lit("."), F.col("lang"))
    return documents.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("source").alias("problem_id"),
        name.alias("file_name"),
        file_stem(name).alias("stem"),
        F.col("lang").alias("ext"),
        F.col("text"),
    )


def _pick(values: list, k):
    """The ``k``-th of some fixed values."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), k + 1)


def _fanned(rows: DataFrame, kinds: list[tuple], k, node_id, parent_id, child_idx, child_count, value, row) -> DataFrame:
    """Rows of the ``nodes`` contract from rows that stand once for each node; ``kinds`` has the fixed values of node ``k``.

    A row is repeated with a number and spells its node's columns: an exploded array of whole nodes costs many times that.
    """
    symbol, type_, named, extra = zip(*kinds, strict=True)
    zero = F.lit(0)
    return rows.select(
        "doc_id", node_id.cast("int").alias("node_id"), parent_id.cast("int").alias("parent_id"),
        child_idx.cast("int").alias("child_idx"), _pick(symbol, k).alias("symbol"), _pick(type_, k).alias("type"),
        _pick(named, k).alias("is_named"), _pick(extra, k).alias("is_extra"), child_count.cast("int").alias("child_count"),
        zero.alias("start_byte"), zero.alias("end_byte"), row.cast("int").alias("start_row"), zero.alias("start_col"),
        row.cast("int").alias("end_row"), zero.alias("end_col"), value.cast("string").alias("value"))


def nodes_from_orders(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """One syntax-like tree per order, in the ``nodes`` contract (node ids in preorder).

    ``order_unit(1)`` has children ``status(1200)`` and, when the order has line
    items, ``line_list(2)``; each line item is ``line(3)`` with children
    ``part_ref(4)`` and the anonymous leaf ``flag(7)``; ``part_ref`` has
    ``brand(5)``, ``identifier(6)``, the extra leaf ``comment(8)`` and
    ``size_expr(9)``, whose single child is ``number(10)``.

    Line items are numbered per order by ``row_number`` over all their columns
    (``l_linenumber`` repeats inside an order), so a line with rank ``r``
    (0-based) owns node ids ``3 + 8r`` ... ``10 + 8r``.

    Both parts are dealt by ``doc_id``, so that what reads the nodes by document
    needs no further exchange.
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                         "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                         "l_shipdate")
    order_cols = [F.col(c) for c in li.columns if c != "l_orderkey"]
    w = Window.partitionBy("doc_id").orderBy(*order_cols)
    lines = (li.join(part.select("p_partkey", "p_brand", "p_name", "p_type", "p_size"),
                     F.col("l_partkey") == F.col("p_partkey"))
             .withColumn("doc_id", F.col("l_orderkey").cast("string")).drop("l_orderkey")
             .withColumn("r", F.row_number().over(w) - 1))
    k = F.col("k")
    zero = F.lit(0)
    first = F.lit(8) * F.col("r") + 3  # the line's node
    line_kinds = [(3, "line", True, False), (4, "part_ref", True, False), (5, "brand", True, False),
                  (6, "identifier", True, False), (8, "comment", True, True), (9, "size_expr", True, False),
                  (10, "number", True, False), (7, "flag", False, False)]
    line_nodes = _fanned(
        lines.withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(len(line_kinds))]))), line_kinds, k,
        node_id=first + k,
        parent_id=F.when(k == 0, 2).otherwise(first + _pick([0, 0, 1, 1, 1, 1, 5, 0], k)),
        child_idx=F.when(k == 0, F.col("r")).otherwise(_pick([0, 0, 0, 1, 2, 3, 0, 1], k)),
        child_count=_pick([2, 4, 0, 0, 0, 1, 0, 0], k),
        value=(F.when(k == 2, F.col("p_brand")).when(k == 3, F.col("p_name")).when(k == 4, F.col("p_type"))
               .when(k == 6, F.col("p_size").cast("string")).when(k == 7, F.col("l_returnflag"))),
        row=F.col("l_linenumber"))
    counts = lineitem.groupBy(F.col("l_orderkey").cast("string").alias("doc_id")).agg(F.count(F.lit(1)).alias("nl"))
    o = (orders.select(F.col("o_orderkey").cast("string").alias("doc_id"), "o_orderstatus")
         .join(counts.hint("merge"), "doc_id", "left")  # a broadcast would leave the orders undealt
         .select("doc_id", "o_orderstatus", F.coalesce(F.col("nl"), zero).alias("nl")))
    has_lines = F.col("nl") > 0
    order_nodes = _fanned(
        o.withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(3)]))).where((k < 2) | has_lines),
        [(1, "order_unit", True, False), (1200, "status", True, False), (2, "line_list", True, False)], k,
        node_id=k,
        parent_id=F.when(k > 0, 0),
        child_idx=F.when(k == 2, 1).otherwise(0),
        child_count=F.when(k == 0, F.when(has_lines, 2).otherwise(1)).when(k == 1, 0).otherwise(F.col("nl")),
        value=F.when(k == 1, F.col("o_orderstatus")),
        row=zero)
    return line_nodes.unionByName(order_nodes)


# problems of the fixture in the order that click events are dealt to them (fixed values)
PROBLEMS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def clicks_from_events(events: DataFrame) -> DataFrame:
    """Reviewer clicks: user ``u`` reviews the problem with number ``u mod 5``.

    A ``click`` event of user ``u`` with value ``v`` is a click on the 0-based
    line ``trunc(v)`` of the PT listing of user ``u``'s pair.
    """
    problem = F.element_at(F.array(*[F.lit(p) for p in PROBLEMS]), (F.col("user_id") % len(PROBLEMS) + 1).cast("int"))
    return (events.where(F.col("event_type") == "click")
            .select(problem.alias("problem_id"),
                    F.col("user_id").cast("string").alias("user_id"),
                    F.col("value").cast("int").alias("line"),
                    F.col("ts")))


def reviewed_from_events(events: DataFrame) -> DataFrame:
    """Pairs that a reviewer has opened: those of every user with some event, in the user's problem."""
    return clicks_from_events(events.withColumn("event_type", F.lit("click"))).select("problem_id", "user_id").distinct()


def statements_from_documents(documents: DataFrame) -> DataFrame:
    """Problem statements: problem number ``k`` has the text of document ``k``."""
    problems = F.array(*[F.lit(p) for p in PROBLEMS])
    return (documents.where(F.col("doc_id").between(1, len(PROBLEMS)))
            .select(F.element_at(problems, F.col("doc_id").cast("int")).alias("problem_id"), F.col("text").alias("statement")))


def line_trees_from_documents(documents: DataFrame) -> DataFrame:
    """One tree per text: a root with one leaf per line, with real byte and row ranges (``nodes`` contract)."""
    text = F.col("text")
    lines = (documents.where(text.isNotNull()).select(F.col("doc_id").cast("string").alias("doc_id"), F.posexplode(
        F.split(text, "\n", -1)).alias("row", "line")))
    size = F.octet_length("line")
    start = F.coalesce(F.sum(size + 1).over(
        Window.partitionBy("doc_id").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    leaves = lines.withColumn("start", start).select(
        "doc_id", (F.col("row") + 1).alias("node_id"), F.lit(0).alias("parent_id"), F.col("row").alias("child_idx"),
        F.lit(2).alias("symbol"), F.lit("line").alias("type"), F.lit(True).alias("is_named"), F.lit(False).alias("is_extra"),
        F.lit(0).alias("child_count"), F.col("start").cast("int").alias("start_byte"),
        (F.col("start") + size).cast("int").alias("end_byte"), F.col("row").alias("start_row"), F.lit(0).alias("start_col"),
        F.col("row").alias("end_row"), size.cast("int").alias("end_col"), F.col("line").alias("value"))
    n = F.size(F.split(text, "\n", -1))
    roots = documents.where(text.isNotNull()).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.lit(0).alias("node_id"), F.lit(None).cast("int").alias("parent_id"),
        F.lit(0).alias("child_idx"), F.lit(1).alias("symbol"), F.lit("file").alias("type"), F.lit(True).alias("is_named"),
        F.lit(False).alias("is_extra"), n.alias("child_count"), F.lit(0).alias("start_byte"),
        F.octet_length(text).cast("int").alias("end_byte"), F.lit(0).alias("start_row"), F.lit(0).alias("start_col"),
        (n - 1).alias("end_row"), F.octet_length(F.element_at(F.split(text, "\n", -1), -1)).cast("int").alias("end_col"),
        F.lit(None).cast("string").alias("value"))
    return leaves.unionByName(roots)
