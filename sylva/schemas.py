"""Table contracts of the library (all operators read and write these shapes)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SUBMISSIONS = T.StructType([
    T.StructField("submission_id", T.StringType()),
    T.StructField("problem_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("status", T.StringType()),
])

SOURCES = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("problem_id", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("stem", T.StringType()),
    T.StructField("ext", T.StringType()),
    T.StructField("text", T.StringType()),
])

NODES = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("node_id", T.IntegerType()),
    T.StructField("parent_id", T.IntegerType()),
    T.StructField("child_idx", T.IntegerType()),
    T.StructField("symbol", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("is_named", T.BooleanType()),
    T.StructField("is_extra", T.BooleanType()),
    T.StructField("child_count", T.IntegerType()),
    T.StructField("start_byte", T.IntegerType()),
    T.StructField("end_byte", T.IntegerType()),
    T.StructField("start_row", T.IntegerType()),
    T.StructField("start_col", T.IntegerType()),
    T.StructField("end_row", T.IntegerType()),
    T.StructField("end_col", T.IntegerType()),
    T.StructField("value", T.StringType()),
])

# One element of a path: the node attributes the path encoders look at.
PATH_NODE = T.StructType([
    T.StructField("node_id", T.IntegerType()),
    T.StructField("symbol", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("is_named", T.BooleanType()),
    T.StructField("is_extra", T.BooleanType()),
    T.StructField("child_count", T.IntegerType()),
])

PATH_NODE_FIELDS = [f.name for f in PATH_NODE.fields]

LEAF_PATHS = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("leaf_ord", T.IntegerType()),
    T.StructField("path", T.ArrayType(PATH_NODE)),
    T.StructField("leaf_value", T.StringType()),
    T.StructField("leaf_row", T.IntegerType()),
])

PAIRS = T.StructType([
    T.StructField("problem_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("ok_id", T.StringType()),
    T.StructField("pt_id", T.StringType()),
])


def require_columns(df: DataFrame, schema: T.StructType, what: str) -> None:
    """Raise ``ValueError`` when ``df`` lacks a column of the contract."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
