"""Path encoders: every function returns a Column over a ``path`` array column.

A path is ``ARRAY<STRUCT<node_id, symbol, type, is_named, is_extra, child_count>>``
ordered root first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def padded_symbol(symbol: str | Column) -> Column:
    """Symbol id zero-padded to at least three digits (``7`` -> ``007``, ``1200`` stays).

    ``lpad`` alone would cut longer numbers; ``format_string`` would do, but costs far more a row.
    """
    s = _col(symbol)
    text = s.cast("string")
    return F.when(s.between(0, 99), F.lpad(text, 3, "0")).when(s >= 100, text).otherwise(F.format_string("%03d", s))


def path_ids(path: str | Column = "path", separator: str = "") -> Column:
    """Concatenated padded symbols of all nodes of the path."""
    return F.array_join(F.transform(_col(path), lambda n: padded_symbol(n["symbol"])), separator)


def leaf(path: str | Column = "path") -> Column:
    """Last element of the path (the terminal)."""
    return F.element_at(_col(path), -1)


def fork_nodes(path: str | Column = "path") -> Column:
    """Keep forks (two or more children) and terminals, drop single-child nodes."""
    return F.filter(_col(path), lambda n: n["child_count"] != 1)


def mask_token(leaf_type: str | Column, leaf_is_named: str | Column, value: str | Column) -> Column:
    """Token of a terminal: its text when it is named and not an identifier, else its grammar type."""
    keep_text = _col(leaf_is_named) & (_col(leaf_type) != F.lit("identifier"))
    return F.when(keep_text, F.coalesce(_col(value), F.lit(""))).otherwise(_col(leaf_type))


def masked_token(path: str | Column = "path", value: str | Column = "leaf_value") -> Column:
    """:func:`mask_token` of the last node of a path array."""
    last = leaf(path)
    return mask_token(last["type"], last["is_named"], value)


def token_key(token: str | Column) -> Column:
    """Stable token hash (md5 hex): the same in Spark and in any SQL engine with md5."""
    return F.md5(_col(token))


def branch_string(ids: str | Column, key: str | Column) -> Column:
    """Path-context string ``<ids>_<key>``."""
    return F.concat(_col(ids), F.lit("_"), _col(key))


def vocab_display(token: str | Column) -> Column:
    """Vocabulary entry as written to the mapping file: ``[token]``."""
    return F.concat(F.lit("["), _col(token), F.lit("]"))


def diff_signature(path: str | Column = "path", value: str | Column = "leaf_value", separator: str = "") -> Column:
    """Diff signature: padded ids of forks and the leaf, then the raw leaf text.

    With the default empty separator this is exactly the string the diff
    compares; a non-empty separator removes the ambiguity between a 4-digit
    symbol and a 3-digit symbol followed by digits of the text.
    """
    ids = path_ids(fork_nodes(path), separator)
    if separator:
        return F.concat(ids, F.lit(separator), F.coalesce(_col(value), F.lit("")))
    return F.concat(ids, F.coalesce(_col(value), F.lit("")))
