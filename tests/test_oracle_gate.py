"""A slice of the correctness gate inside pytest: registered queries vs their DuckDB oracles on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from sylva.sources.fixtures import TABLES
from tests.conftest import SF001

GATE = ["error_lines", "label_lines", "resolved_labels", "branches", "extract_contexts", "vocabulary",
        "signature_groups", "train_val_split", "flatten_corpus", "ok_pt_candidates", "ok_pt_pairs_limited",
        "tree_dot", "text_lines", "review_sheet", "reviewed_label_lines", "terminal_values", "node_attributes",
        "reversed_fork_paths", "vocabulary_file", "read_metadata", "node_equality", "run_corpus"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple("NULL" if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", GATE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert got == want
