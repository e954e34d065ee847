"""Operator 12: repair the turn structure of conversations by survivor-coalescence Viterbi.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. The cheapest edits (keep,
rerole, delete, insert) that make it so are a shortest path through four states: nothing written yet, an
``s`` written, last a ``u``, last an ``a``. The best paths into the states (the survivors) share a tree of
back pointers with reference counts. As soon as all survivors have one ancestor in common, the edits up to
it are emitted and their nodes dropped, so memory holds the unresolved part only. Of equally cheap paths the
one with the least edit string wins; two tied survivors are compared over the whole of their unresolved parts.
(No cheapest path into a state is a proper prefix of another one into the same state, because they could
differ only by inserts that end in the same state and cost more. So what is least stays least later on.)
A survivor that can no longer win is dropped (see ``WITHIN``): else the path that deletes everything, which
shares no edit with the others, would keep the tree from ever becoming certain.

How it runs. Equal rows of a conversation are one row with a count. Rows are range-sorted by (conversation,
turn, role, digest of the text), so a conversation of any size spreads over several tasks. Conversations
that lie inside one task's range are repaired in that pass. The others are cut into blocks of bounded size;
each block is solved from all four states, a pass over these small results chains the blocks with the same
survivor tree, and then the blocks are edited, again in parallel. Only the last step, one SHA-256 over a
conversation's repaired text, has to read a conversation in order in one task; it streams the pieces.

Defined results: in keys, roles and texts a null is one space; rows of equal turn are ordered by role, then
by the SHA-256 of the text (after damage); copies of a row stand side by side; a conversation with a null
id is a conversation like any other; an empty table gives an empty result. Extra columns are ignored,
whatever their names. A text is held whole by its task, of very long ones one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.llm.common import read_table, save, shuffle_partitions

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs; the last is added to an undeleted truncated row
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ACCEPT = (START, ASSISTANT)
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


# ---- the survivor tree -------------------------------------------------------------------------------------

class _Node:
    __slots__ = ("parent", "label", "note", "kids", "held")

    def __init__(self, parent, label, note):
        self.parent, self.label, self.note, self.kids, self.held = parent, label, note, set(), 0


class Survivors:
    """The best path into each state, as leaves of one tree; ``step`` yields the edges that have become certain.

    ``within`` tells what a state can cost more than another one from here on, whatever follows:
    ``within[t, f]`` = the most that going on from t can cost above going on from f. A survivor in f whose cost
    lies further above one in t can no longer win, not even by a tie, and is dropped.
    """

    def __init__(self, starts: Iterable[int] = (START,), within: dict[tuple[int, int], int] | None = None):
        self.within = within or {}
        self.root = _Node(None, "", None)
        self.best: dict[int, tuple[int, _Node]] = {}
        for s in starts:
            self.best[s] = (0, self.root)
            self.root.held += 1
        self.largest = 0  # most nodes ever held at once, for tests
        self._nodes = 1

    def _suffix(self, node: _Node) -> str:
        """All labels between the last certain edge and ``node``."""
        parts = []
        while node is not self.root:
            parts.append(node.label)
            node = node.parent
        return "".join(reversed(parts))

    def _release(self, node: _Node) -> None:
        while node is not self.root and not node.held and not node.kids:
            node.parent.kids.discard(node)
            self._nodes -= 1
            node = node.parent

    def step(self, arcs: Iterable[tuple]) -> list[tuple[str, object]]:
        """Extend by arcs (from, to, cost, label[, note]); returns (label, note) of the edges all survivors share."""
        chosen: dict[int, tuple] = {}
        for arc in arcs:
            held = self.best.get(arc[0])
            if held is None:
                continue
            cost, now = held[0] + arc[2], chosen.get(arc[1])
            if now is None or cost < now[0] or (
                    cost == now[0] and self._suffix(held[1]) + arc[3] < self._suffix(now[1]) + now[2][3]):
                chosen[arc[1]] = (cost, held[1], arc)
        lost = [f for (t, f), more in self.within.items()
                if t in chosen and f in chosen and chosen[f][0] > chosen[t][0] + more]
        for f in set(lost):
            del chosen[f]
        old, self.best = self.best, {}
        for to, (cost, parent, arc) in chosen.items():
            node = _Node(parent, arc[3], arc[4] if len(arc) > 4 else None)
            node.held = 1
            parent.kids.add(node)
            self._nodes += 1
            self.best[to] = (cost, node)
        self.largest = max(self.largest, self._nodes)
        for _, node in old.values():
            node.held -= 1
        for _, node in old.values():
            self._release(node)
        certain = []
        while not self.root.held and len(self.root.kids) == 1:
            self.root = self.root.kids.pop()
            self._nodes -= 1
            certain.append((self.root.label, self.root.note))
            self.root.parent = None
        return certain

    def cost(self) -> int:
        return min(c for c, _ in self.best.values())


# ---- rows and their arcs -----------------------------------------------------------------------------------

_WRITE = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_AHEAD = {START: [(START, 0, ""), (USER, INSERT, "I"), (ASSISTANT, 2 * INSERT, "II")],
          SYSTEM: [(SYSTEM, 0, ""), (USER, INSERT, "I"), (ASSISTANT, 2 * INSERT, "II")],
          USER: [(USER, 0, ""), (ASSISTANT, INSERT, "I")],
          ASSISTANT: [(ASSISTANT, 0, ""), (USER, INSERT, "I")]}
#: See ``Survivors.within``. From ``a`` all that is open to ``s`` costs the same; what is open to the empty
#: start may keep one ``s`` row that has to go after an ``a``; the start can go on like an ``a``; after an ``s``
#: a conversation cannot end, so it may need both a user and an assistant; one insert leads from ``u`` to ``a`` or back.
WITHIN = {(ASSISTANT, START): DELETE, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): INSERT,
          (USER, ASSISTANT): INSERT, (USER, START): INSERT + DELETE, (USER, SYSTEM): INSERT,
          (START, ASSISTANT): 0, (START, SYSTEM): 0, (START, USER): INSERT,
          (SYSTEM, ASSISTANT): 2 * INSERT, (SYSTEM, START): 2 * INSERT, (SYSTEM, USER): INSERT}
#: Arcs at the end of a conversation: what is still inserted.
CLOSING = [(f, to, c, label, label) for f in STATES for to, c, label in _AHEAD[f] if to in ACCEPT]


def _arcs(forced: bool, initial: str, truncated: bool) -> list[tuple]:
    """All ways past one row: inserts, then one edit of the row. ``forced`` rows must go."""
    out = []
    for f in STATES:
        for g, cost, label in _AHEAD[f]:
            out.append((f, g, cost + DELETE, label + "D"))
            if forced:
                continue
            more = TRUNCATED if truncated else 0
            if (g, initial) in _WRITE:
                out.append((f, _WRITE[g, initial], cost + KEEP + more, label + "K"))
            for to in ROLES:
                if (g, to) in _WRITE:
                    out.append((f, _WRITE[g, to], cost + REROLE + more, label + "R"))
    best = {}
    for arc in out:  # of the arcs between two states only the best can win
        at = arc[:2]
        best[at] = min(best.get(at, arc), arc, key=lambda a: (a[2], a[3]))
    return sorted(best.values())


ARCS = {(forced, initial, cut): _arcs(forced, initial, cut)
        for forced in (False, True) for initial in ("s", "u", "a", "") for cut in (False, True)}


class Row:
    """One distinct row of a conversation: ``n`` copies, ``first`` if its role and text were not seen before."""

    __slots__ = ("turn", "role", "text", "n", "first", "blank", "cut")

    def __init__(self, turn, role, text, n, first):
        self.turn, self.role, self.text, self.n, self.first = turn, role, text, n, first
        body = text.rstrip(BLANKS)
        self.blank = not body
        self.cut = not self.blank and body[-1] not in ENDS

    def steps(self) -> Iterator[list[tuple]]:
        """The arcs past this row and past its copies, which must all go."""
        initial = self.role[:1] if self.role[:1] in ("s", "u", "a") else ""
        yield ARCS[self.blank or not self.first, initial, self.cut]
        if self.n > 1:
            d = self.n - 1
            yield [(s, s, DELETE * d, "D" * d) for s in STATES]


class Tally:
    """Faults, illegal neighbours and turns of a stretch of rows; stretches of one conversation can be added."""

    FIELDS = ["blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "head", "tail"]

    def __init__(self, values: list | None = None):
        (self.blank, self.duplicate, self.truncated, self.illegal, self.low, self.high, self.turns, self.head,
         self.tail) = values or [0, 0, 0, 0, None, None, 0, None, None]

    def values(self) -> list:
        return [getattr(self, f) for f in self.FIELDS]

    def add_row(self, r: Row) -> None:
        one = Tally()
        one.head = one.tail = r.role[:1]
        one.illegal = r.n - 1
        if r.blank:
            one.blank = r.n
        else:
            one.duplicate = r.n - 1 if r.first else r.n
            one.truncated = int(r.first and r.cut)
        if r.turn is not None:
            one.low, one.high, one.turns = r.turn, r.turn, 1
        self.add(one)

    def add(self, later: Tally) -> None:
        self.illegal += later.illegal
        if self.tail is not None and later.head is not None and self.tail + later.head not in LEGAL:
            self.illegal += 1
        for f in ("blank", "duplicate", "truncated"):
            setattr(self, f, getattr(self, f) + getattr(later, f))
        if later.turns:
            self.turns += later.turns - (self.high == later.low)
            self.low, self.high = (later.low if self.low is None else self.low), later.high
        if later.head is not None:
            self.head, self.tail = (later.head if self.head is None else self.head), later.tail

    def gaps(self) -> int:
        return 0 if not self.turns else self.high - self.low + 1 - self.turns


def solve(rows: Iterable[Row], start: int = START) -> tuple[Survivors, list[str]]:
    """Survivors after ``rows`` from one state, and the labels that are certain by then."""
    paths, sure = Survivors([start], WITHIN), []
    for r in rows:
        for arcs in r.steps():
            sure += [label for label, _ in paths.step(arcs)]
    return paths, sure


def best_edits(rows: list[Row]) -> tuple[str, int]:
    """The cheapest edits of a whole conversation and their cost."""
    paths, sure = solve(rows)
    sure += [label for label, _ in paths.step([(f, START, c, label) for f, _, c, label, _ in CLOSING])]
    return "".join(sure), paths.cost()


def repaired(rows: Iterable[Row], audit: str, state: int = START) -> Iterator[str]:
    """Lines ``role:text`` that the edits leave; ``audit`` has one letter a row copy and one an insert."""
    letters = iter(audit)

    def written() -> str:
        return "a" if state == USER else "u"

    for r in rows:
        left = r.n
        while left:
            edit = next(letters)
            if edit == "I":
                yield f"{ROLES[written()]}:"
                state = _WRITE[state, written()]
                continue
            left -= 1
            if edit == "K":
                yield f"{r.role}:{r.text}"
                state = _WRITE[state, r.role[:1]]
            elif edit == "R":
                yield f"{ROLES[written()]}:{r.text}"
                state = _WRITE[state, written()]
    for _ in letters:
        yield f"{ROLES[written()]}:"
        state = _WRITE[state, written()]


# ---- Spark passes ------------------------------------------------------------------------------------------

def damage(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, n): the rows left after damage, equal ones together with their number."""
    space = F.lit(" ")
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), space) if c != ":" else F.lit(":") for c in (conv_id, ":", turn)])
    kind = F.crc32(key) % 20
    words, who = F.coalesce(F.col(text), space), F.coalesce(F.col(role), space)
    return (conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                                 kind.alias("kind"), words.alias("words"), who.alias("who"))
            .where("kind != 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("who")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("words", "[.!?]", ""))
                    .otherwise(F.col("words")).alias("text"),
                    F.when(F.col("kind") == 3, 2).otherwise(1).alias("n"))
            .groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")))


def with_first(rows: DataFrame) -> DataFrame:
    """Add digest and ``first``: no earlier turn of the conversation has the same role and text.

    The first turn of every (conversation, role, text) comes from a partial aggregate; it is joined back on the
    whole row key, of which every row is the only holder, so a sentence said everywhere makes no hot key.
    """
    t = save(rows.withColumn("digest", F.unhex(F.sha2("text", 256))), "conv-rows")
    firsts = (t.groupBy("conv_id", "role", "digest")
              .agg(F.when(F.count("turn") == F.count(F.lit(1)), F.min("turn")).alias("turn"))
              .select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest", "turn")]))
    same: Column = (t["role"] == firsts["_role"]) & (t["digest"] == firsts["_digest"])
    for c in ("conv_id", "turn"):
        same = same & t[c].eqNullSafe(firsts[f"_{c}"])
    return (t.join(firsts, same, "left")
            .select("conv_id", "turn", "role", "text", "digest", "n", F.col("_role").isNotNull().alias("first")))


def _read_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    yield from zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "first")])


_RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
_ROWS = "array<struct<turn:long,role:string,text:string,n:long,first:boolean>>"


def _arrow_rows() -> pa.DataType:
    return pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n", pa.int64()),
                               ("first", pa.bool_())]))


def _finished(rows: list[Row]) -> dict:
    tally = Tally()
    for r in rows:
        tally.add_row(r)
    audit, cost = best_edits(rows)
    text = "\n".join(repaired(rows, audit))
    return {"gaps": tally.gaps(), "blank": tally.blank, "duplicate": tally.duplicate, "truncated": tally.truncated,
            "illegal": tally.illegal, "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()}


def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the conversations that surely lie inside this task, and blocks of rows of all others.

    The first and the last conversation of a task may go on in its neighbours; one that outgrows a block is
    given out in blocks too.
    """
    part, block = TaskContext.get().partitionId(), 0
    kind, out, held = None, [], 0
    rows: list[Row] = []
    size, conv, segment, cut = 0, None, -1, False

    def close(last: bool) -> None:
        nonlocal block, rows, size, held
        if not rows:
            return
        if segment and not last and not cut:
            out.append({"conv_id": conv, **_finished(rows)})
        else:
            out.append({"conv_id": conv, "part": part, "block": block,
                        "rows": [{"turn": r.turn, "role": r.role, "text": r.text, "n": r.n, "first": r.first} for r in rows]})
            block += 1
            held += size
        rows, size = [], 0

    def batch_out() -> pa.RecordBatch:
        nonlocal held
        cols = [pa.array([r.get("conv_id") for r in out], kind), pa.array([r.get("part") for r in out], pa.int32()),
                pa.array([r.get("block") for r in out], pa.int32()),
                *[pa.array([r.get(c) for r in out], pa.int64()) for c in COUNTS],
                *[pa.array([r.get(c) for r in out], pa.string()) for c in ("audit", "repaired_sha256")],
                pa.array([r.get("rows") for r in out], _arrow_rows())]
        out.clear()
        held = 0
        return pa.RecordBatch.from_arrays(cols, ["conv_id", "part", "block", *COUNTS, "audit", "repaired_sha256", "rows"])

    for batch in batches:
        kind = batch.column("conv_id").type
        for at in range(0, batch.num_rows, 256):
            for c, turn, role, text, n, first in _read_rows(batch.slice(at, 256)):
                if segment < 0 or c != conv:
                    close(last=False)
                    conv, segment, cut = c, segment + 1, False
                elif len(rows) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                    cut = True
                    close(last=False)
                rows.append(Row(turn, role, text, n, first))
                size += len(text) + 64
                if len(out) >= 1024 or held >= BLOCK_BYTES:
                    yield batch_out()
    close(last=True)
    if out:
        yield batch_out()


def _block_rows(batch: pa.RecordBatch, i: int) -> list[Row]:
    return [Row(r["turn"], r["role"], r["text"], r["n"], r["first"]) for r in batch.column("rows")[i].as_py()]


_PATH = "array<struct<start:int,end:int,cost:long,audit:string>>"
_TALLY = ("blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, head string, "
          "tail string")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block its tally and the best path between any two states."""
    paths_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    for batch in batches:
        for i in range(batch.num_rows):
            rows, tally, found = _block_rows(batch, i), Tally(), []
            for r in rows:
                tally.add_row(r)
            for start in STATES:
                paths, sure = solve(rows, start)
                head = "".join(sure)
                found += [{"start": start, "end": end, "cost": cost, "audit": head + paths._suffix(node)}
                          for end, (cost, node) in sorted(paths.best.items())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(i, 1) for c in ("conv_id", "part", "block")]
                + [pa.array([v], k) for v, k in zip(tally.values(), kinds)] + [pa.array([found], paths_type)],
                ["conv_id", "part", "block", *Tally.FIELDS, "paths"])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain the blocks of each conversation, in order; yields the way through each block and a row of totals."""
    kind, conv, seen, pending = None, None, False, []
    paths, tally = Survivors(within=WITHIN), Tally()

    def flush() -> pa.RecordBatch:
        cols = [pa.array([r.get("conv_id") for r in pending], kind)]
        cols += [pa.array([r.get(c) for r in pending], pa.int32()) for c in ("part", "block", "start", "end")]
        cols += [pa.array([r.get("tail") for r in pending], pa.string())]
        cols += [pa.array([r.get(c) for r in pending], pa.int64()) for c in COUNTS]
        pending.clear()
        return pa.RecordBatch.from_arrays(cols, ["conv_id", "part", "block", "start", "end", "tail", *COUNTS])

    def settle(certain: list) -> None:
        for _, note in certain:
            if isinstance(note, str):  # what the closing step inserts belongs to the last block
                pending.append({"conv_id": conv, "part": last[0], "block": last[1] + 1, "tail": note})
            else:
                pending.append({"conv_id": conv, "part": note[0], "block": note[1], "start": note[2], "end": note[3], "tail": ""})

    def close() -> None:
        settle(paths.step([(f, START, c, label, note) for f, _, c, label, note in CLOSING]))
        pending.append({"conv_id": conv, "gaps": tally.gaps(), "blank": tally.blank, "duplicate": tally.duplicate,
                        "truncated": tally.truncated, "illegal": tally.illegal, "cost": paths.cost()})

    last = (0, 0)
    for batch in batches:
        kind = batch.column("conv_id").type
        for i in range(batch.num_rows):
            r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            if not seen or r["conv_id"] != conv:
                if seen:
                    close()
                conv, seen, paths, tally = r["conv_id"], True, Survivors(within=WITHIN), Tally()
            tally.add(Tally([r[f] for f in Tally.FIELDS]))
            settle(paths.step([(p["start"], p["end"], p["cost"], p["audit"], (r["part"], r["block"], p["start"], p["end"]))
                               for p in r["paths"]]))
            last = (r["part"], r["block"])
            if len(pending) >= 4096:
                yield flush()
    if seen:
        close()
        yield flush()


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and repaired lines of each block, on the way that the chain has chosen."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows, start, end = _block_rows(batch, i), batch.column("start")[i].as_py(), batch.column("end")[i].as_py()
            paths, sure = solve(rows, start)
            audit = "".join(sure) + paths._suffix(paths.best[end][1])
            lines = list(repaired(rows, audit, start))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(i, 1) for c in ("conv_id", "part", "block")]
                + [pa.array([end], pa.int32()), pa.array([audit], pa.string()), pa.array([len(lines)], pa.int64()),
                   pa.array(["\n".join(lines)], pa.string())],
                ["conv_id", "part", "block", "end", "audit", "lines", "text"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 and the whole edit string of each conversation from its pieces, in order."""
    kind, conv, seen = None, None, False
    done, sha, audit, any_line, state = [], hashlib.sha256(), [], False, START

    def close() -> None:
        done.append((conv, "".join(audit), sha.hexdigest()))

    def flush() -> pa.RecordBatch:
        cols = list(zip(*done))
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), pa.array(cols[1], pa.string()),
                                           pa.array(cols[2], pa.string())], ["conv_id", "audit", "repaired_sha256"])

    for batch in batches:
        kind = batch.column("conv_id").type
        for i in range(batch.num_rows):
            c, end, piece, lines, text = [batch.column(k)[i].as_py() for k in ("conv_id", "end", "audit", "lines", "text")]
            if not seen or c != conv:
                if seen:
                    close()
                conv, seen, sha, audit, any_line, state = c, True, hashlib.sha256(), [], False, START
            if end is None:  # inserts at the end of the conversation
                inserted = list(repaired([], piece, state))
                lines, text = len(inserted), "\n".join(inserted)
            else:
                state = end
            audit.append(piece)
            if lines:
                sha.update((("\n" if any_line else "") + text).encode("utf-8", "surrogatepass"))
                any_line = True
        if len(done) >= 4096:
            yield flush()
    if seen:
        close()
        yield flush()


def repair_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row a conversation.

    ``rows`` has conv_id, turn, role, text and n (copies), each combination once.
    """
    conv = dict(rows.dtypes)["conv_id"]
    n = shuffle_partitions(rows.sparkSession)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    first = save(with_first(rows).repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .mapInArrow(first_pass, f"conv_id {conv}, part int, block int, {_RESULT}, rows {_ROWS}"), "conv-first")
    whole = first.where("part IS NULL").drop("part", "block", "rows")
    blocks = first.where("part IS NOT NULL").select("conv_id", "part", "block", "rows")
    by_conv = ["conv_id", "part", "block"]
    chained = save(
        blocks.mapInArrow(_summaries, f"conv_id {conv}, part int, block int, {_TALLY}, paths {_PATH}")
        .repartition(n, "conv_id").sortWithinPartitions(*by_conv)
        .mapInArrow(_chain, f"conv_id {conv}, part int, block int, start int, end int, tail string, "
                            + ", ".join(f"{c} long" for c in COUNTS)), "conv-chain")
    ways = chained.where("start IS NOT NULL").select("part", "block", "start", "end")
    pieces = blocks.join(ways, ["part", "block"]).mapInArrow(
        _edit, f"conv_id {conv}, part int, block int, end int, audit string, lines long, text string")
    tails = chained.where("tail != ''").select(
        "conv_id", "part", "block", F.lit(None).cast("int").alias("end"), F.col("tail").alias("audit"),
        F.lit(0).cast("long").alias("lines"), F.lit("").alias("text"))
    texts = (pieces.unionByName(tails).repartition(n, "conv_id").sortWithinPartitions(*by_conv)
             .mapInArrow(_digests, f"conv_id {conv}, audit string, repaired_sha256 string")
             .withColumnRenamed("conv_id", "_conv"))
    totals = chained.where("part IS NULL").select("conv_id", *COUNTS)
    split = totals.join(texts, totals["conv_id"].eqNullSafe(texts["_conv"])).drop("_conv")
    return whole.unionByName(split)


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = read_table(spark, sf_dir, "conversations")
    fixed = repair_conversations(damage(source)).withColumnRenamed("conv_id", "_conv")
    ids = source.select("conv_id").distinct()
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return (ids.join(fixed, ids["conv_id"].eqNullSafe(fixed["_conv"]), "left")
            .select("conv_id", *[F.coalesce(F.col(c), empty.get(c, F.lit(0).cast("long"))).alias(c)
                                 for c in [*COUNTS, "audit", "repaired_sha256"]]))


ORACLE = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(
    flatten(list_transform(string_split(k, ''), lambda ch: list_transform(range(8), lambda b: (ord(ch) >> b) & 1))),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT), 4294967295) % 20 AS kind FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged
), marked AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
         role[1] AS c, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM placed
), faults AS (
  SELECT *, again AND NOT blank AS dup, cut AND NOT blank AND NOT again AS trunc FROM marked
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (trunc) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM faults GROUP BY conv_id
), ahead(f, g, cost, ed, txt) AS (
  VALUES ('0', '0', 0, '', ''), ('0', 'u', 3, 'I', E'\nuser:'), ('0', 'a', 6, 'II', E'\nuser:\nassistant:'),
         ('s', 's', 0, '', ''), ('s', 'u', 3, 'I', E'\nuser:'), ('s', 'a', 6, 'II', E'\nuser:\nassistant:'),
         ('u', 'u', 0, '', ''), ('u', 'a', 3, 'I', E'\nassistant:'), ('a', 'a', 0, '', ''), ('a', 'u', 3, 'I', E'\nuser:')
), writes(g, c) AS (VALUES ('0', 's'), ('0', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')
), ways AS (
  SELECT a.f, a.g AS t, a.cost + 4 AS cost, a.ed || 'D' AS ed, a.txt, NULL AS c, 'D' AS op FROM ahead a
  UNION ALL SELECT a.f, w.c, a.cost, a.ed || 'K', a.txt, w.c, 'K' FROM ahead a JOIN writes w ON a.g = w.g
  UNION ALL SELECT a.f, w.c, a.cost + 3, a.ed || 'R', a.txt, w.c, 'R' FROM ahead a JOIN writes w ON a.g = w.g WHERE w.c != 's'
), walk AS (
  SELECT conv_id, 0::BIGINT AS i, '0' AS state, struct_pack(cost := 0::BIGINT, ed := '', txt := '') AS b FROM counts
  UNION ALL
  SELECT r.conv_id, r.i, w.t, min(struct_pack(
      cost := p.b.cost + w.cost + CASE WHEN r.trunc AND w.op != 'D' THEN 3 ELSE 0 END, ed := p.b.ed || w.ed,
      txt := p.b.txt || w.txt || CASE w.op WHEN 'K' THEN E'\n' || r.role || ':' || r.text
        WHEN 'R' THEN E'\n' || CASE w.c WHEN 'u' THEN 'user:' ELSE 'assistant:' END || r.text ELSE '' END))
  FROM walk p JOIN faults r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1 JOIN ways w ON w.f = p.state
  WHERE w.op = 'D' OR (NOT r.blank AND NOT r.again AND (w.op = 'R' OR r.c = w.c))
  GROUP BY r.conv_id, r.i, w.t
), ended AS (
  SELECT p.conv_id, min(struct_pack(cost := p.b.cost + a.cost, ed := p.b.ed || a.ed, txt := p.b.txt || a.txt)) AS b
  FROM walk p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i JOIN ahead a ON a.f = p.state
  WHERE a.g IN ('0', 'a') GROUP BY p.conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
       coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
       coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.b.cost, 0)::BIGINT AS cost, coalesce(e.b.ed, '') AS audit,
       sha256(coalesce(e.b.txt[2:], '')) AS repaired_sha256
FROM ids LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
