"""Operator 7: licence scan. Aho-Corasick finds notice phrases and identifier tags; a shunting-yard parser
evaluates the and/or/with expressions that follow a tag or join two notices.

A text is lower-cased (A-Z) and cut into words of letters a-z, digits and characters beyond ASCII; one automaton
pass over the words finds every phrase. ``base`` phrases give the base labels; notices and tags give exact
licence ids. An expression is evaluated to the ids it leaves to choose from and a level: ``or`` takes the
least restrictive side, ``and`` joins the sides at the higher level, ``with`` lowers a copyleft licence by one.

Defined results: a null text is an empty one; a text without a hit has empty labels, null places and score 0; a
broken expression counts as far as it parses; repeated rows are scanned again.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sylva.llm.common import doc_slices, read_table

# fixed values of the contract
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# notices and the licence id they name (public SPDX ids in lower case)
NOTICES = {
    "agpl-3.0": ["gnu affero general public license", "agplv3", "agpl 3 0"],
    "apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0"],
    "bsd-2-clause": ["bsd 2 clause", "simplified bsd license"],
    "bsd-3-clause": ["bsd 3 clause", "new bsd license", "redistribution and use in source and binary forms"],
    "cc-by-4.0": ["cc by 4 0", "creative commons attribution 4 0"],
    "cc-by-nc-4.0": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0"],
    "cc-by-nc-sa-4.0": ["cc by nc sa 4 0"],
    "cc-by-nd-4.0": ["cc by nd 4 0"],
    "cc-by-sa-4.0": ["cc by sa 4 0", "creative commons attribution sharealike 4 0"],
    "cc0-1.0": ["cc0 1 0", "cc0"],
    "gpl-2.0": ["gnu general public license version 2", "gplv2", "gpl 2 0"],
    "gpl-3.0": ["gnu general public license version 3", "gplv3", "gpl 3 0"],
    "isc": ["isc license"],
    "lgpl": ["gnu lesser general public license", "gnu library general public license"],
    "mit": ["mit license", "permission is hereby granted free of charge to any person obtaining a copy"],
    "mpl-2.0": ["mozilla public license version 2 0", "mpl 2 0"],
    "proprietary": ["all rights reserved"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}
TAGS = ["spdx license identifier"]
LEVELS = ["public domain", "permissive", "weak copyleft", "copyleft", "restricted"]
# level of an id by how it begins; the first that fits counts
LEVEL_OF = [("cc0", 0), ("unlicense", 0), ("0bsd", 0), ("mit", 1), ("bsd", 1), ("apache", 1), ("isc", 1), ("zlib", 1),
            ("cc-by-nc", 4), ("cc-by-nd", 4), ("cc-by-sa", 3), ("cc-by", 1), ("mpl", 2), ("lgpl", 2), ("epl", 2),
            ("agpl", 3), ("gpl", 3), ("proprietary", 4)]
UNKNOWN_LEVEL = 4
TRUST = {"base": 0.6, "notice": 0.8, "tag": 0.95}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                    for b in range(256))
_TAG = re.compile(r"SPDX-License-Identifier\s*:?[ \t]*", re.IGNORECASE | re.ASCII)
_TOKEN = re.compile(r"[^\S\r\n]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+-]*)")  # an expression ends with its line


def parse_expression(text: str, at: int) -> tuple[list[str], int]:
    """The tokens of the longest stretch from ``at`` in which operands and operators alternate, without open ends, and
    where it ends. A line's end and another tag end it, too."""
    out, want, depth, good, end = [], True, 0, 0, at
    while m := _TOKEN.match(text, at):
        t = m[1].lower()
        if want:
            if _TAG.match(t):
                break
            if t in PRECEDENCE or t == ")":
                break
            depth += t == "("
            want = t == "("
        elif t == ")":
            if not depth:
                break
            depth -= 1
        elif t in PRECEDENCE:
            want = True
        else:
            break
        out.append(t)
        at = m.end()
        if not want and not depth:
            good, end = len(out), at
    return [t.rstrip(".") if t not in "()" else t for t in out[:good]], end


def expression_tokens(text: str) -> list[str]:
    """The tokens of the expression that ``text`` begins with."""
    return parse_expression(text, 0)[0]


def tag_expressions(text: str) -> tuple[list[list[str]], str]:
    """The tokens after each tag, and the text with tags and these expressions each replaced by a word of no notice."""
    expressions, rest, at = [], [], 0
    while m := _TAG.search(text, at):
        rest.append(text[at:m.start()])
        tokens, at = parse_expression(text, m.end())
        expressions.append(tokens)
    return expressions, "\nspdx\n".join([*rest, text[at:]])


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: infix tokens to postfix; operators of equal rank group from the left."""
    out, held = [], []
    for t in tokens:
        if t == "(":
            held.append(t)
        elif t == ")":
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        elif t in PRECEDENCE:
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[t]:
                out.append(held.pop())
            held.append(t)
        else:
            out.append(t)
    return out + held[::-1]


def level_of(licence: str) -> int:
    return next((level for start, level in LEVEL_OF if licence.startswith(start)), UNKNOWN_LEVEL)


def evaluate(tokens: list[str]) -> tuple[set[str], set[str], int]:
    """(all ids named, ids of the side an ``or`` leaves to choose, level); empty sets for no tokens."""
    stack: list[tuple[set[str], set[str], int]] = []
    for t in to_postfix(tokens):
        if t not in PRECEDENCE:
            stack.append(({t}, {t}, level_of(t)))
            continue
        right, left = stack.pop(), stack.pop()
        if t == "with":  # the right side names an exception, not a licence
            stack.append((left[0], left[1], left[2] - 1 if left[2] in (2, 3) else left[2]))
        elif t == "and":
            stack.append((left[0] | right[0], left[1] | right[1], max(left[2], right[2])))
        else:
            best = left if left[2] <= right[2] else right
            stack.append((left[0] | right[0], best[1], best[2]))
    return stack[0] if stack else (set(), set(), UNKNOWN_LEVEL)


def build_automaton():
    import ahocorasick

    found: dict[str, list[tuple[str, str]]] = {}
    for phrase, label in BASE.items():
        found.setdefault(phrase, []).append(("base", label))
    for label, phrases in NOTICES.items():
        for phrase in phrases:
            found.setdefault(phrase, []).append(("notice", label))
    for phrase in TAGS:
        found.setdefault(phrase, []).append(("tag", phrase))
    a = ahocorasick.Automaton()
    for phrase, kinds in found.items():
        a.add_word(f" {phrase} ", (len(phrase) + 2, phrase.count(" ") + 1, kinds))
    a.make_automaton()
    return a


_SPACE = re.compile(" ")


def _hits(text: str, automaton) -> tuple[list[bytes], list[tuple[int, int, str, str]]]:
    """The words of a text and all phrases in them as (start word, end word, kind, label)."""
    words = text.encode().translate(_WORD_BYTES).split()
    joined = f" {b' '.join(words).decode()} "
    found, spaces = [], None
    for end, (length, n, kinds) in automaton.iter(joined):
        if spaces is None:  # the place of each space, found once for all hits
            spaces = [m.start() for m in _SPACE.finditer(joined)]
        start = bisect.bisect_left(spaces, end + 1 - length)
        found += [(start, start + n, kind, label) for kind, label in kinds]
    return words, found


def scan(text: str, automaton) -> dict:
    """All findings of one text: words, base places, labels, chosen ids, level and score."""
    words, found = _hits(text, automaton)
    n_words = len(words)
    places = [s for s, _, kind, _ in found if kind == "base"]
    base = {label for *_, kind, label in found if kind == "base"}
    trust = [TRUST[kind] for *_, kind, _ in found]
    tagged = any(kind == "tag" for *_, kind, _ in found)
    expressions = []
    if tagged:  # ids in the expression of a tag are no notices
        expressions, rest = tag_expressions(text)
        words, found = _hits(rest, automaton)
    notices = [(s, e, label) for s, e, kind, label in found if kind == "notice"]
    labels, chosen, level = set(base), set(), None

    def take(tokens: list[str]) -> None:
        nonlocal level
        named, best, at = evaluate(tokens)
        labels.update(named)
        chosen.update(best)
        level = at if level is None else max(level, at)

    for tokens in expressions:
        if tokens:
            take(tokens)
    # of notices that begin at one word the longest names the licence; neighbours may be joined by a word
    longest = {s: (s, e, label) for s, e, label in sorted(notices, key=lambda x: (x[0], x[1]))}
    chain: list[str] = []
    last_end = -1
    for s, e, label in sorted(longest.values()):
        if s < last_end:
            continue
        between = words[last_end:s] if last_end >= 0 else []
        if chain and len(between) <= 2 and between and between[0] in (b"or", b"and") and between[1:] in ([], [b"the"]):
            chain += [between[0].decode(), label]
        else:
            if chain:
                take(chain)
            chain = [label]
        last_end = e
    if chain:
        take(chain)
    miss = 1.0
    for t in trust:
        miss *= 1.0 - t
    return {"n_words": n_words, "n_base": len(places), "first_word": min(places, default=None),
            "last_word": max(places, default=None), "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels)), "score": 1.0 - miss, "chosen": ",".join(sorted(chosen)),
            "level": None if level is None else LEVELS[level]}


_FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
           ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("chosen", pa.string()),
           ("level", pa.string())]
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, chosen string, level string")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row a document: the fields of ``scan`` beside its doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton()
        for b in doc_slices(batches):
            rows = [scan(t or "", automaton) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), *(pa.array([r[k] for r in rows], t) for k, t in _FIELDS)],
                ["doc_id", *(k for k, _ in _FIELDS)])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))
