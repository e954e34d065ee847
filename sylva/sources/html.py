"""Text -> tree parse job for HTML pages (``mapInArrow`` + the standard library parser).

Each page is parsed inside its task; a task holds the nodes of one page and
at most ``ROWS_PER_BATCH`` finished rows.

Tree rules:

* every document has a root row (type ``#document``);
* rows are 0-based, columns 0-based, byte offsets into the UTF-8 text;
* void elements (``br``, ``img``, ...) never take children;
* an end tag closes the nearest open element with that name (and everything
  opened after it); an end tag with no open match is ignored;
* text runs that are not only whitespace become ``#text`` leaves whose
  ``value`` is their source text (character references left as written);
  comments become ``#comment`` leaves with ``is_extra``;
* ``symbol`` is the position of the type in ``SYMBOLS`` below; tags not in
  the list share the ``#unknown`` symbol (their ``type`` keeps the tag name).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate, islice

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.schemas import LEAF_PATHS, NODES, PATH_NODE_FIELDS

# Node kinds, then HTML element names in alphabetical order.
SPECIAL = ["#document", "#text", "#comment", "#unknown"]
TAGS = sorted("""
a abbr address area article aside audio b base bdi bdo blockquote body br button canvas caption cite code col
colgroup data datalist dd del details dfn dialog div dl dt em embed fieldset figcaption figure footer form h1 h2
h3 h4 h5 h6 head header hgroup hr html i iframe img input ins kbd label legend li link main map mark menu meta
meter nav noscript object ol optgroup option output p param picture pre progress q rp rt ruby s samp script
search section select slot small source span strong style sub summary sup table tbody td template textarea tfoot
th thead time title tr track u ul var video wbr
""".split())
SYMBOLS = SPECIAL + TAGS
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_SYMBOL = {name: i for i, name in enumerate(SYMBOLS)}


class _TreeBuilder(HTMLParser):
    def __init__(self, text: str):
        super().__init__(convert_charrefs=True)
        self.text = text
        lines = text.split("\n")
        self.line_start = [0]
        for ln in lines[:-1]:
            self.line_start.append(self.line_start[-1] + len(ln) + 1)
        # UTF-8 byte offset of every character position (and the end).
        self.byte_at = range(len(text) + 1) if text.isascii() else [
            0, *accumulate(len(ch.encode("utf-8", "surrogatepass")) for ch in text)]
        self.nodes: list[dict] = []
        self.stack: list[int] = []
        self._pending: int | None = None  # text node whose raw end is the next event's start
        self._add("#document", None, 0, "")
        self.stack.append(0)

    def _char_pos(self) -> int:
        row, col = self.getpos()
        return self.line_start[row - 1] + col

    def _point(self, pos: int) -> tuple[int, int]:
        # row of a char position by binary search over line starts
        lo, hi = 0, len(self.line_start) - 1
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self.line_start[mid] <= pos:
                lo = mid
            else:
                hi = mid - 1
        return lo, pos - self.line_start[lo]

    def _add(self, type_: str, parent: int | None, start: int, raw: str, value: str | None = None,
             extra: bool = False, end: int | None = None) -> int:
        nid = len(self.nodes)
        kids_of_parent = None if parent is None else self.nodes[parent]
        child_idx = 0 if kids_of_parent is None else kids_of_parent["child_count"]
        if kids_of_parent is not None:
            kids_of_parent["child_count"] += 1
        symbol = _SYMBOL.get(type_, _SYMBOL["#unknown"])
        end = start + len(raw) if end is None else end
        self.nodes.append({
            "node_id": nid, "parent_id": parent, "child_idx": child_idx, "symbol": symbol, "type": type_,
            "is_named": True, "is_extra": extra, "child_count": 0, "start": start, "end": end, "value": value,
        })
        return nid

    def _close_text(self, pos: int) -> None:
        if self._pending is not None:
            nd = self.nodes[self._pending]
            nd["end"] = pos
            nd["value"] = self.text[nd["start"]:pos]
            self._pending = None

    def handle_starttag(self, tag, attrs):
        pos = self._char_pos()
        self._close_text(pos)
        raw = self.get_starttag_text() or ""
        nid = self._add(tag, self.stack[-1], pos, raw)
        if tag not in VOID:
            self.stack.append(nid)

    def handle_startendtag(self, tag, attrs):
        pos = self._char_pos()
        self._close_text(pos)
        self._add(tag, self.stack[-1], pos, self.get_starttag_text() or "")

    def handle_endtag(self, tag):
        pos = self._char_pos()
        self._close_text(pos)
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.nodes[self.stack[depth]]["type"] == tag:
                close = self.text.find(">", pos)
                end = len(self.text) if close < 0 else close + 1
                for nid in self.stack[depth:]:
                    self.nodes[nid]["end"] = end
                del self.stack[depth:]
                return

    def handle_data(self, data):
        pos = self._char_pos()
        self._close_text(pos)
        if data.strip():
            self._pending = self._add("#text", self.stack[-1], pos, data, value=data)

    def handle_comment(self, data):
        pos = self._char_pos()
        self._close_text(pos)
        self._add("#comment", self.stack[-1], pos, f"<!--{data}-->", value=data, extra=True)

    def _close_at_markup(self, *_) -> None:
        self._close_text(self._char_pos())

    handle_pi = handle_decl = unknown_decl = _close_at_markup  # no nodes, but they end a text

    def finish(self) -> list[dict]:
        self.close()
        n = len(self.text)
        self._close_text(n)
        for nid in self.stack:
            self.nodes[nid]["end"] = n
        self.nodes[0]["end"] = n
        return self.nodes


def parse_tree(text: str) -> list[dict]:
    """Parse one page into node dicts (preorder), with points and byte offsets resolved."""
    b = _TreeBuilder(text or "")
    b.feed(text or "")
    nodes = b.finish()
    for nd in nodes:
        s, e = nd.pop("start"), nd.pop("end")
        e = max(s, min(e, len(b.text)))
        nd["start_byte"], nd["end_byte"] = b.byte_at[s], b.byte_at[e]
        nd["start_row"], nd["start_col"] = b._point(s)
        nd["end_row"], nd["end_col"] = b._point(e)
    return nodes


def _leaf_paths(nodes: list[dict]) -> Iterator[tuple[int, list[dict], str | None, int]]:
    path: list[dict] = []  # from the root to the current node: preorder needs one stack
    for nd in nodes:
        while path and path[-1]["node_id"] != nd["parent_id"]:
            path.pop()
        path.append({k: nd[k] for k in PATH_NODE_FIELDS})
        if nd["child_count"] == 0:
            yield nd["node_id"], list(path), nd["value"], nd["start_row"]


_NODES_ARROW = pa.schema([
    pa.field("doc_id", pa.string()), pa.field("node_id", pa.int32()), pa.field("parent_id", pa.int32()),
    pa.field("child_idx", pa.int32()), pa.field("symbol", pa.int32()), pa.field("type", pa.string()),
    pa.field("is_named", pa.bool_()), pa.field("is_extra", pa.bool_()), pa.field("child_count", pa.int32()),
    pa.field("start_byte", pa.int32()), pa.field("end_byte", pa.int32()), pa.field("start_row", pa.int32()),
    pa.field("start_col", pa.int32()), pa.field("end_row", pa.int32()), pa.field("end_col", pa.int32()),
    pa.field("value", pa.string()),
])
_PATH_ELEM_ARROW = pa.struct([
    pa.field("node_id", pa.int32()), pa.field("symbol", pa.int32()), pa.field("type", pa.string()),
    pa.field("is_named", pa.bool_()), pa.field("is_extra", pa.bool_()), pa.field("child_count", pa.int32()),
])
_LEAF_ARROW = pa.schema([
    pa.field("doc_id", pa.string()), pa.field("leaf_ord", pa.int32()),
    pa.field("path", pa.list_(_PATH_ELEM_ARROW)), pa.field("leaf_value", pa.string()),
    pa.field("leaf_row", pa.int32()),
])


ROWS_PER_BATCH = 4096


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while chunk := list(islice(rows, ROWS_PER_BATCH)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(col, f.type) for col, f in zip(zip(*chunk, strict=True), schema, strict=True)], schema=schema)


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column("doc_id")[i].as_py(), batch.column("text")[i].as_py()


def _nodes_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = _NODES_ARROW.names[1:]
    yield from _in_batches(((doc_id, *(nd[k] for k in names)) for doc_id, text in _pages(batches)
                            for nd in parse_tree(text)), _NODES_ARROW)


def _leaf_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _in_batches(((doc_id, *leaf) for doc_id, text in _pages(batches)
                            for leaf in _leaf_paths(parse_tree(text))), _LEAF_ARROW)


def _input(pages: DataFrame, id_col: str, text_col: str, spread: int | None) -> DataFrame:
    """Id and text of each page, dealt to ``spread`` tasks if that is given (one input file may be one task)."""
    df = pages.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return df.repartition(spread) if spread else df


def html_nodes(pages: DataFrame, id_col: str = "page_id", text_col: str = "html", spread: int | None = None) -> DataFrame:
    """Parse every page into ``nodes`` rows."""
    return _input(pages, id_col, text_col, spread).mapInArrow(_nodes_batches, NODES)


def html_leaf_paths(pages: DataFrame, id_col: str = "page_id", text_col: str = "html",
                    spread: int | None = None) -> DataFrame:
    """Parse every page and emit its root-to-terminal paths directly, with one stack per page."""
    return _input(pages, id_col, text_col, spread).mapInArrow(_leaf_batches, LEAF_PATHS)


# Ship this module's code with the task (pickled by value), so Python workers
# need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Parsers by language name; each maps a text DataFrame to nodes / leaf paths.
PARSERS = {"html": (html_nodes, html_leaf_paths)}


def parser_for(language: str):
    """The (nodes, leaf paths) parse jobs of a language; ``ValueError`` when none is registered."""
    if language not in PARSERS:
        raise ValueError(f"no parser for language {language!r}; available: {sorted(PARSERS)}")
    return PARSERS[language]
