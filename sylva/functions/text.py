"""Text helpers: file names and line splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_stem(name: str | Column) -> Column:
    """File name without its last extension (``a.b.cpp`` -> ``a.b``)."""
    return F.regexp_replace(_col(name), r"\.[^.]*$", "")


def with_extension(id_: str | Column, ext: str | Column) -> Column:
    """``<id>.<ext>``."""
    return F.concat(_col(id_), F.lit("."), _col(ext))


def split_lines(text: str | Column) -> Column:
    """Lines of a text the way a line reader sees them.

    Split on ``\\n``; a trailing newline does not open an empty last line, an
    empty text has no lines, carriage returns stay in the line.
    """
    t = _col(text)
    parts = F.split(t, "\n", -1)
    n = F.size(parts)
    trimmed = F.when(F.element_at(parts, -1) == F.lit(""), F.slice(parts, 1, n - 1)).otherwise(parts)
    return F.when(t.isNull() | (t == F.lit("")), F.array().cast("array<string>")).otherwise(trimmed)


def numbered_line(line_no: str | Column, line: str | Column) -> Column:
    """Listing line: 1-based number right-aligned in five columns, two spaces, text."""
    return F.format_string("%5d  %s", _col(line_no), _col(line))


def byte_slice(text: str | Column, start_byte: str | Column, end_byte: str | Column) -> Column:
    """Text between two UTF-8 byte offsets (a byte slice, not a character slice)."""
    raw = _col(text).cast("binary")
    return F.decode(F.substring(raw, _col(start_byte) + 1, _col(end_byte) - _col(start_byte)), "UTF-8")
