"""The three composite jobs of the library and their named-policy registries.

* :func:`preprocess_corpus` - counts -> top problems -> per-problem sample ->
  flatten -> train size -> train/val split.
* :func:`extract_contexts`  - nodes -> paths -> filters/mask/hash -> branches,
  corpus lines and vocabulary.
* :func:`diff_labels`       - pairs -> both trees -> signatures -> anti-join ->
  error lines -> resolved labels -> label file rows.

Each is a DataFrame chain; actions run only in the tree walk (one small one
per round) and where a table is written for reuse.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylva.operators import contexts, diff, labels, meta, sampling, trees
from sylva.session import write_table

# Traversal policies by name. ``terminal_terminal`` is accepted and gives the
# root-to-terminal paths, exactly like the policy it is named after does.
TRAVERSALS = {
    "root_terminal": trees.encoded_paths,
    "terminal_terminal": trees.encoded_paths,
}


def traversal(name: str):
    if name not in TRAVERSALS:
        raise ValueError(f"unknown traversal {name!r}; allowed: {sorted(TRAVERSALS)}")
    return TRAVERSALS[name]


@dataclass
class PreprocessResult:
    counts: DataFrame
    top: DataFrame
    sampled: DataFrame
    pool: DataFrame
    split: DataFrame
    total: int


def preprocess_corpus(sources: DataFrame, n_problems: int | None = None, n_files: int | None = None,
                      split: int = 75, seed: int = 42, distinct_counts: bool = False,
                      exact: bool = False) -> PreprocessResult:
    """Select, sample, flatten and split a corpus (``sources`` contract); ``split`` carries the files' texts.

    Only ids travel through sampling, flattening and ranking; the texts are
    joined back by id at the end.
    """
    counts = write_table(sampling.problem_counts(sources), "counts")
    top = sampling.top_problems(counts, n_problems, distinct_counts)
    ids = sources.select("doc_id", "problem_id", "file_name")
    chosen = ids if n_problems is None and not distinct_counts else ids.join(top.select("problem_id"), "problem_id", "left_semi")
    sampled = sampling.sample_per_problem(chosen, n_files, seed)
    pool = sampling.flatten_corpus(sampled, counts)
    total = sampling.sampled_files(counts, top, n_files)
    marked = sampling.train_val_split(pool, total, split, seed, exact)
    out = marked.join(sources.select("doc_id", "text"), "doc_id")
    return PreprocessResult(counts, top, sampled, pool, out, total)


@dataclass
class ExtractResult:
    leaf_paths: DataFrame
    branches: DataFrame
    corpus: DataFrame
    vocabulary: DataFrame
    name: str


def extract_contexts(nodes: DataFrame, docs: DataFrame, traversal_name: str = "root_terminal",
                     tokenizer: str = "masked_identifiers", split: str = "ids_hash", min_len: int = 5,
                     order: str = "document", leaf_paths: DataFrame | None = None,
                     encoded: DataFrame | None = None) -> ExtractResult:
    """Path-contexts of every document plus the global vocabulary.

    ``leaf_paths`` (e.g. from a parse job) replaces the walk over ``nodes``; so does ``encoded``, the encoded
    paths (``leaf_paths`` of the result) of another run over the same nodes.
    """
    walk = traversal(traversal_name)
    if encoded is not None:
        lp = encoded
    elif leaf_paths is None:  # extra leaves never reach the join, and only the encodings in use are folded
        lp = walk(nodes, only=["path_ids", "path_len"], leaf_filter=~F.col("is_extra"))
    else:
        lp = trees.encode_leaf_paths(leaf_paths)
    br = contexts.branches(lp, min_len=min_len, tokenizer=tokenizer, split=split)
    return ExtractResult(
        leaf_paths=lp,
        branches=br,
        corpus=contexts.corpus_lines(br, docs, order=order),
        vocabulary=contexts.vocabulary(br),
        name=contexts.run_name(traversal_name, tokenizer, split),
    )


@dataclass
class DiffResult:
    pairs: DataFrame
    error_lines: DataFrame
    labels: DataFrame
    label_rows: DataFrame


def diff_labels(submissions: DataFrame, nodes: DataFrame, clicks: DataFrame | None = None,
                problems: list[str] | None = None, n_pairs: int | None = None, ext: str = "cpp",
                ok_status: str = "OK", pt_status: str = "PT", separator: str = "",
                reviewed: DataFrame | None = None) -> DiffResult:
    """Pair submissions, diff their trees, resolve labels with reviewer clicks.

    ``reviewed`` (``problem_id, user_id``) limits the label file to the pairs a reviewer has seen.
    """
    pairs = meta.ok_pt_pairs(submissions, ok_status, pt_status, problems=problems, limit=n_pairs, ext=ext)
    el = diff.error_lines(pairs, nodes, separator=separator)
    if clicks is not None:
        manual = labels.toggled_lines(clicks)
        resolved = labels.resolved_labels(pairs, el, manual)
    else:
        resolved = el.select("problem_id", "user_id", "pt_id", "line")
    return DiffResult(pairs, el, resolved, labels.label_lines(pairs, resolved, ext, reviewed))


def subtree_start(type_name: str) -> Column:
    """Start predicate for :func:`sylva.operators.trees.subtree_paths`: nodes of one type."""
    return F.col("type") == F.lit(type_name)
