"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables through the fixture mapping and runs over
whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.functions.text import file_stem
from sylva.operators import clusters, contexts, diff, growing, labels, meta, sampling, subtrees, trees
from sylva.operators.terminal_contexts import terminal_contexts
from sylva.plans import diff_labels, extract_contexts, preprocess_corpus, subtree_start
from sylva.session import bucket_count, deal_table, drop_table, new_table_path, write_table
from sylva.sinks import write_vocabulary_text
from sylva.sinks.run_files import write_run
from sylva.sources import fixtures as fx
from sylva.sources.corpus import read_metadata, read_vocabulary
from sylva.sources.corpus_format import read_corpus, write_corpus_files
from sylva.sources.html import parser_for
from sylva.sql import register_functions

# Parameters of the registered runs (fixed values).
N_PROBLEMS = 10   # of the top-problems report
N_FILES = 30      # of the per-problem sample
SPLIT = 75
SEED = 42
N_PAIRS = 100
ADHOC_PROBLEM = "1-URGENT"
N_CLUSTERS = 20   # of the vector table
TOP_CLUSTERS = 10  # of the cluster report


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fx.load(spark, sf_dir, name)


def _subs(spark, d):
    return fx.submissions_from_orders(_t(spark, d, "orders"))


def _sources(spark, d):
    return fx.sources_from_documents(_t(spark, d, "documents"))


def _nodes(spark, d):
    return fx.nodes_from_orders(_t(spark, d, "orders"), _t(spark, d, "lineitem"), _t(spark, d, "part"))


def _order_docs(spark, d):
    o = _t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("doc_id"))
    return o.withColumn("stem", F.col("doc_id"))


def _pairs(spark, d):
    return meta.ok_pt_pairs(_subs(spark, d))


# --- metadata -------------------------------------------------------------------------------

def q_submissions_scan(spark, d):
    return _subs(spark, d)


def q_ok_pt_pairs(spark, d):
    return _pairs(spark, d)


def q_ok_pt_pairs_limited(spark, d):
    return meta.ok_pt_pairs(_subs(spark, d), limit=N_PAIRS)


def q_ok_pt_candidates(spark, d):
    return meta.ok_pt_candidates(_subs(spark, d))


def q_other_solutions(spark, d):
    return meta.other_solutions(_subs(spark, d), _pairs(spark, d), status="OK")


def q_lookup_submission(spark, d):
    return meta.lookup_submissions(_subs(spark, d), _pairs(spark, d), id_col="pt_id")


def q_duplicate_keys(spark, d):
    return meta.duplicate_keys(_subs(spark, d), key="user_id")


def q_incomplete_rows(spark, d):
    return meta.incomplete_rows(fx.dirty_submissions_from_orders(_t(spark, d, "orders")))


def q_adhoc_sql(spark, d):
    return meta.adhoc_sql(
        _subs(spark, d),
        "SELECT submission_id, problem_id, user_id, language, status FROM submissions "
        "WHERE status = :status AND problem_id = :problem",
        args={"status": "PT", "problem": ADHOC_PROBLEM})


# --- corpus selection -----------------------------------------------------------------------

def _pre(spark, d):
    return preprocess_corpus(_sources(spark, d), split=SPLIT, seed=SEED)


def q_problem_counts(spark, d):
    return sampling.problem_counts(_sources(spark, d))


def q_top_problems(spark, d):
    return sampling.top_problems(sampling.problem_counts(_sources(spark, d)), N_PROBLEMS)


def q_top_problems_distinct(spark, d):
    return sampling.top_problems(sampling.problem_counts(_sources(spark, d)), N_PROBLEMS, distinct_counts=True)


def q_sample_per_problem(spark, d):
    return sampling.sample_per_problem(_sources(spark, d), N_FILES, SEED).select("doc_id", "problem_id", "file_name")


def q_flatten_corpus(spark, d):
    return _pre(spark, d).pool


def q_train_size(spark, d):
    total = sampling.problem_counts(_sources(spark, d)).agg(F.sum("n_files").alias("n_total"))
    return total.select("n_total", sampling.train_size(F.col("n_total"), SPLIT).alias("n_train"))


def q_train_val_split(spark, d):
    return _pre(spark, d).split.select("doc_id", "problem_id", "file_name", "split", F.md5("text").alias("text_md5"))


def q_train_val_select(spark, d):
    # the split of train_val_split, its threshold found by selection instead of a sort
    src = _sources(spark, d)
    counts = sampling.problem_counts(src)
    pool = sampling.flatten_corpus(src.select("doc_id", "problem_id", "file_name"), counts)
    split = sampling.train_val_select(pool, src.count(), SPLIT, SEED)
    return split.join(src.select("doc_id", F.md5("text").alias("text_md5")), "doc_id")


def q_growing_sample(spark, d):
    # the corpus arrives in one load a language; the kept sample is that of the whole
    src = _sources(spark, d)
    state = growing.GrowingSample(spark, new_table_path(spark, "growing"), N_FILES, SEED)
    for r in src.select("ext").distinct().orderBy("ext").collect():
        state.add(src.where(F.col("ext").eqNullSafe(r.ext)), str(r.ext))
    return state.sample().join(state.counts(), "problem_id")


def q_vocabulary_runs(spark, d):
    # the vocabularies of two runs with different shortest paths, merged; the last run that has an entry wins
    table = growing.VersionedVocabulary(spark, new_table_path(spark, "vocabulary"))
    nodes, encoded = _nodes(spark, d), None  # the shortest path is no matter of the walk, which both runs share
    for run, min_len in ((1, 5), (2, 6)):
        r = extract_contexts(nodes, _order_docs(spark, d), min_len=min_len, encoded=encoded)
        encoded = r.leaf_paths
        table.merge(r.vocabulary.select("key", "token"), run)
    return table.entries()


def q_point_lookup(spark, d):
    # the submission with the largest id, from a layout sorted by id with Bloom filters
    path = new_table_path(spark, "submissions")
    meta.write_lookup_layout(_subs(spark, d), path)
    last = _subs(spark, d).agg(F.max("submission_id")).first()[0]
    return meta.point_lookup(spark, path, last)


def q_file_stem(spark, d):
    return _sources(spark, d).select("doc_id", "file_name", file_stem("file_name").alias("stem"))


def q_read_metadata(spark, d):
    # the metadata table as a file of its own, read back by position
    path = new_table_path(spark, "metadata")
    _subs(spark, d).toDF("a", "b", "c", "d", "e").write.option("header", "true").csv(path)
    return read_metadata(spark, path, "csv", header="true")


# --- trees ----------------------------------------------------------------------------------

def _summary(enc: DataFrame, ids: str, n: str, leaf_type=None) -> DataFrame:
    return enc.select("doc_id", F.col(ids).alias("path_ids"), F.col(n).alias("path_len"),
                      (leaf_type if leaf_type is not None else F.col("leaf_type")).alias("leaf_type"),
                      "leaf_value", "leaf_row")


def _walk(spark, d, ids: str, n: str, leaf_type=None, start=None) -> DataFrame:
    only = [ids, n, "start_type"] if leaf_type is not None else [ids, n]
    return _summary(trees.encoded_paths(_nodes(spark, d), start=start, only=only), ids, n, leaf_type)


def q_root_paths(spark, d):
    return _walk(spark, d, "path_ids", "path_len")


def q_path_trie(spark, d):
    return trees.path_trie(_nodes(spark, d)).select("path_ids", "fork_ids", "path_len", "fork_len", "reversed_ids", "symbol",
                                                    "is_single", "n_nodes", F.col("parent").isNull().alias("is_root"))


def q_fork_paths(spark, d):
    return _walk(spark, d, "fork_ids", "fork_len")


def q_reversed_paths(spark, d):
    # the last element of a reversed path is the start node
    return _walk(spark, d, "reversed_ids", "path_len", F.col("start_type"))


def q_reversed_fork_paths(spark, d):
    return _walk(spark, d, "reversed_fork_ids", "fork_len")


def q_subtree_paths(spark, d):
    return _walk(spark, d, "path_ids", "path_len", start=subtree_start("part_ref"))


def q_node_predicates(spark, d):
    return trees.node_predicates(_nodes(spark, d)).select(
        "doc_id", "type", "start_row", "is_terminal", "is_named_terminal", "is_fork")


def q_node_children(spark, d):
    return trees.node_children(_nodes(spark, d), 1).select("doc_id", "parent_type", "child_idx", "child_type")


def q_tree_edges(spark, d):
    return trees.tree_edges(_nodes(spark, d)).select("doc_id", "parent_type", "child_idx", "child_type")


def q_node_attributes(spark, d):
    return fx.line_trees_from_documents(_t(spark, d, "documents")).select(
        "doc_id", "node_id", "type", "child_count", "start_byte", "end_byte", "start_row", "start_col", "end_row", "end_col")


def q_terminal_values(spark, d):
    docs = _t(spark, d, "documents")
    return trees.terminal_values(fx.line_trees_from_documents(docs), _sources(spark, d))


def q_node_equality(spark, d):
    # is a node the same as its parent's first child? Nodes are dealt by document once, and so no edge is moved
    nodes = _nodes(spark, d).select("doc_id", "node_id", "parent_id", "child_idx", "type")
    table = deal_table(nodes, "edges", buckets=bucket_count(nodes))
    edges = trees.tree_edges(table)
    first = edges.where("child_idx = 0").select(F.col("doc_id").alias("d"), F.col("parent_id").alias("p"),
                                                F.col("node_id").alias("first_id"))
    both = edges.join(first, (F.col("doc_id") == F.col("d")) & (F.col("parent_id") == F.col("p")))
    same = trees.same_node(F.col("doc_id"), F.col("node_id"), F.col("d"), F.col("first_id"))
    told = deal_table(both.select("doc_id", "child_type", "child_idx", same.alias("is_first_child")), "equal", buckets=table.dealt)
    drop_table(table)
    return told


def q_tree_dot(spark, d):
    return trees.dot_graph(_nodes(spark, d))


# --- path-contexts --------------------------------------------------------------------------

def _extract(spark, d):
    return extract_contexts(_nodes(spark, d), _order_docs(spark, d), order="sorted")


def q_branches(spark, d):
    return _extract(spark, d).branches.select("doc_id", "branch")


def q_extract_contexts(spark, d):
    # the corpus file lines in document order, as the extract job writes them
    return extract_contexts(_nodes(spark, d), _order_docs(spark, d), order="document").corpus


def q_doc_vocab(spark, d):
    return contexts.doc_vocab(_extract(spark, d).branches)


def q_vocabulary(spark, d):
    return _extract(spark, d).vocabulary


def q_vocabulary_size(spark, d):
    return contexts.vocabulary_size(_extract(spark, d).vocabulary)


def q_corpus_lines(spark, d):
    return _extract(spark, d).corpus


def q_run_corpus(spark, d):
    # corpus lines with the name of the run that made them
    run = extract_contexts(_nodes(spark, d), _order_docs(spark, d), order="sorted")
    return run.corpus.select("doc_id", "line", F.lit(run.name).alias("run"))


def q_vocabulary_file(spark, d):
    # the vocabulary file, written and parsed back
    path = new_table_path(spark, "vocabulary")
    write_vocabulary_text(_extract(spark, d).vocabulary, path)
    return read_vocabulary(spark, f"{path}/records")


def q_run_files(spark, d):
    # the two files of a run under its name, put together from the tasks' parts and read back
    run = extract_contexts(_nodes(spark, d), _order_docs(spark, d), order="sorted")
    tokens, mapping = write_run(run.corpus, run.vocabulary, run.name, new_table_path(spark, "run"))
    lines, raw, entries = spark.read.text(tokens), spark.read.text(mapping), read_vocabulary(spark, mapping)
    records = {tokens: lines.select(F.col("value").alias("record")),
               mapping: raw.where("value RLIKE '^[0-9]+$'").select(F.col("value").alias("record")).unionByName(
                   entries.select(F.concat_ws(" ", "key", "display").alias("record")))}
    parts = [r.select(F.lit(path.rpartition("/")[2]).alias("file"), "record") for path, r in records.items()]
    return parts[0].unionByName(parts[1])


def q_corpus_source(spark, d):
    # every document as a file of its own, read back through the corpus format
    src = _sources(spark, d).withColumn("file_name", F.concat_ws(".", "doc_id", "ext"))
    root = new_table_path(spark, "corpus")
    written = write_table(write_corpus_files(src, root), "corpus-files")
    back = read_corpus(spark, root).select("problem_id", "file_name", "stem", "ext", F.md5("text").alias("text_md5"))
    return back.join(written, ["problem_id", "file_name"])


def q_signature_groups(spark, d):
    return diff.signature_groups(trees.encoded_paths(_nodes(spark, d), only=["fork_ids"]))


def q_terminal_contexts(spark, d):
    # all pairs of terminals, counted by their lowest common ancestor and types
    return terminal_contexts(_nodes(spark, d))


# --- vectors --------------------------------------------------------------------------------

def q_vector_clusters(spark, d):
    return clusters.vector_clusters(_t(spark, d, "embeddings"), N_CLUSTERS, SEED).members


def q_top_clusters(spark, d):
    return clusters.top_clusters(clusters.vector_clusters(_t(spark, d, "embeddings"), N_CLUSTERS, SEED), TOP_CLUSTERS)


# --- diff and labels ------------------------------------------------------------------------

def q_error_lines(spark, d):
    return diff.error_lines(_pairs(spark, d), _nodes(spark, d))


def q_subtree_fingerprints(spark, d):
    # every subtree with the number of equal ones in the corpus
    return subtrees.equal_subtrees(_nodes(spark, d)).select("doc_id", "symbol", "height", "n_leaves", "n_equal")


def q_error_lines_unshared(spark, d):
    # the same lines with the terminals of subtrees that both trees hold left out before the comparison
    return diff.error_lines(_pairs(spark, d), _nodes(spark, d), skip_shared=True)


def _encoded(spark, d):
    # dealt by document as the walk leaves it, so that the functions' joins on documents move the pairs only
    paths = trees.encoded_paths(_nodes(spark, d), only=["path_ids", "path_len", "fork_ids"])
    encoded = deal_table(paths, "encoded", buckets=getattr(paths, "dealt", None))
    if hasattr(paths, "dealt"):  # the walk's own table of them
        drop_table(paths)
    return encoded


def q_sql_error_lines(spark, d):
    # the operators as table functions of SQL
    enc = _encoded(spark, d)
    register_functions(spark, submissions=_subs(spark, d), encoded=enc)
    return spark.sql("SELECT problem_id, user_id, ok_id, pt_id, line FROM error_lines('OK', 'PT')")


def q_sql_path_contexts(spark, d):
    enc = _encoded(spark, d)
    register_functions(spark, encoded=enc)
    return spark.sql("SELECT doc_id, branch FROM path_contexts(split => 'ids_hash', n => 5)")


def q_sql_pairs(spark, d):
    register_functions(spark, submissions=_subs(spark, d), sources=_sources(spark, d), clicks=_clicks(spark, d))
    return spark.sql("SELECT p.*, count(t.line) AS n_clicked FROM ok_pt_pairs() p LEFT JOIN toggled_lines() t "
                     "ON t.problem_id = p.problem_id AND t.user_id = p.user_id GROUP BY ALL")


def q_label_lines(spark, d):
    r = diff_labels(_subs(spark, d), _nodes(spark, d))
    return r.label_rows


def _clicks(spark, d):
    return fx.clicks_from_events(_t(spark, d, "events"))


def q_toggled_lines(spark, d):
    return labels.toggled_lines(_clicks(spark, d))


def q_resolved_labels(spark, d):
    return diff_labels(_subs(spark, d), _nodes(spark, d), _clicks(spark, d)).labels


def q_reviewed_label_lines(spark, d):
    # clicks to label file in one chain, for the reviewed pairs
    reviewed = fx.reviewed_from_events(_t(spark, d, "events"))
    return diff_labels(_subs(spark, d), _nodes(spark, d), _clicks(spark, d), reviewed=reviewed).label_rows


def q_text_lines(spark, d):
    return labels.text_lines(_sources(spark, d))


def q_numbered_lines(spark, d):
    return labels.numbered_lines(_sources(spark, d))


def q_review_sheet(spark, d):
    # pairs, the nodes of their documents, listings and error lines are written once and read by each part of the sheet
    pairs = write_table(_pairs(spark, d), "pairs")
    docs = diff.pair_documents(pairs).select("doc_id").distinct()
    nodes = write_table(_nodes(spark, d).join(docs, "doc_id", "left_semi"), "nodes")
    listings = write_table(labels.tree_listing(nodes), "listings")
    lines = write_table(diff.error_lines(pairs, nodes), "lines")
    return labels.review_sheet(pairs, listings, lines, fx.statements_from_documents(_t(spark, d, "documents")))


# --- parse job ------------------------------------------------------------------------------

def _spread(spark) -> int:
    # pages are few large rows: deal them to as many tasks as a shuffle has
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def q_html_nodes(spark, d):
    return parser_for("html")[0](_t(spark, d, "pages"), spread=_spread(spark))


def q_html_terminal_values(spark, d):
    pages = _t(spark, d, "pages")
    src = pages.select(F.col("page_id").cast("string").alias("doc_id"), F.col("html").alias("text"))
    return trees.terminal_values(parser_for("html")[0](pages, spread=_spread(spark)), src)


def q_html_branches(spark, d):
    # the parser only splits pages into node rows; paths come from the walk over them
    nodes = write_table(parser_for("html")[0](_t(spark, d, "pages"), spread=_spread(spark)), "html")
    walked = trees.encoded_paths(nodes, only=["path_ids", "path_len"], leaf_filter=~F.col("is_extra"))
    return contexts.branches(walked).select("doc_id", "branch")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
