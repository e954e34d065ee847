import hashlib
import heapq
import random
import re
import zlib

import pytest

from sylva.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, part int, block int, cost string, n long"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        one = (conv, turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
        out += [one] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def search(rows):
    """Cheapest (cost, edits, lines) by a search over (rows used, roles written), whole edit strings compared."""
    def good(s):
        return re.fullmatch("(s?(ua)*u?)?", s)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, ed, i, roles, lines = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, ed, lines
        if (i, roles[-1:]) in done:
            continue
        done.add((i, roles[-1:]))
        steps = [(3, "I", i, c, (f"{n}:",)) for c, n in (("u", "user"), ("a", "assistant"))]
        if i < len(rows):
            role, text, forced, cut = rows[i]
            steps.append((4, "D", i + 1, "", ()))
            if not forced:
                if role[:1] in ("s", "u", "a"):
                    steps.append((3 * cut, "K", i + 1, role[0], (f"{role}:{text}",)))
                steps += [(3 + 3 * cut, "R", i + 1, c, (f"{n}:{text}",)) for c, n in (("u", "user"), ("a", "assistant"))]
        for c, e, j, w, line in steps:
            if good(roles + w):
                heapq.heappush(heap, (cost + c, ed + e, j, roles + w, lines + line))
    raise AssertionError


def brute(rows):
    out = {}
    kept = damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in kept if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        seen, marked, counts = set(), [], [0, 0, 0]
        for _, _, role, text in mine:
            body = text.rstrip(cr.BLANKS)
            fault = 0 if not WORD.search(text) else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            marked.append((role, text, fault in (0, 1), fault == 2))
        illegal = sum(a[2][:1] + b[2][:1] not in cr.LEGAL for a, b in zip(mine, mine[1:]))
        turns = [r[1] for r in mine if r[1] is not None]
        cost, audit, lines = search(marked)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, "x", 4) for r in rows], SCHEMA)
    fixed = {r.conv_id: tuple(r)[1:] for r in cr.repair_conversations(cr.damage(df)).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    return {c: fixed.get(c, nothing) for c in {r[0] for r in rows}}


def table(seed, convs=60, longest=9):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown", "a"]
    texts = ["Hi.", "Hi!", "No end", "", "  \n\t", None, "Yes? \n", "x", "Ünï.", "日本"]
    out = []
    for c in range(convs):
        turn = 0
        for _ in range(rnd.randint(0, longest)):
            turn += rnd.choice([0, 1, 1, 1, 3])
            out.append((rnd.choice([c, c, c, None]) if c < 3 else c, rnd.choice([turn, turn, turn, turn, None]),
                        rnd.choice(roles), rnd.choice(texts + [f"t{rnd.randint(0, 99)}."] * 6)))
    out += [out[i] for i in range(0, len(out), 17)]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repairs_equal_brute_force(spark, seed):
    rows = table(seed)
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("block_rows", [1, 2, 7])
def test_one_long_conversation_in_blocks_equals_brute_force(spark, monkeypatch, block_rows):
    rnd = random.Random(block_rows)
    rows = [(5, i, rnd.choice(["user", "assistant", "assistant", "system", "tool"]), rnd.choice(["Ok.", f"no {i}", f"Yes {i}."]))
            for i in range(300)] + table(9, 10)
    rows = [r for r in rows if r[0] is not None]
    monkeypatch.setattr(cr, "BLOCK_ROWS", block_rows)
    assert result(spark, rows) == brute(rows)


def test_a_hot_conversation_spreads_over_the_tasks(spark):
    from pyspark.sql import functions as F
    rows = spark.range(4000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                    F.concat(F.lit("t"), F.col("id"), F.lit(".")).alias("text"), F.lit(1).cast("long").alias("n"))
    n = 8
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    parts = cr.with_first(rows).repartitionByRange(n, *order).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == n and max(r["count"] for r in parts) < 4000 / 3
    got = cr.repair_conversations(rows).collect()
    assert len(got) == 1 and got[0].cost == 0 and got[0].audit == "K" * 4000
    text = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:t{i}." for i in range(4000))
    assert got[0].repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_survivors_coalesce_and_memory_stays_bounded():
    rnd = random.Random(3)
    rows = [cr.Row(i, rnd.choice(["user", "assistant", "system"]), f"t{i}" + rnd.choice([".", ""]), 1, True) for i in range(20_000)]
    paths, sure = cr.solve(rows)
    assert len(sure) > 19_000 and paths.largest < 400


def test_ties_are_compared_over_whole_suffixes():
    # two ways of cost 1 whose strings differ only in their first letter, many steps before they meet
    paths = cr.Survivors([0])
    paths.step([(0, 1, 0, "b"), (0, 2, 0, "a")])
    for _ in range(50):
        assert paths.step([(1, 1, 0, "x"), (2, 2, 0, "x")]) == []
    sure = paths.step([(1, 3, 1, "A"), (2, 3, 1, "Z")])
    assert "".join(label for label, _ in sure) == "a" + "x" * 50 + "Z"


def test_empty_table_and_long_texts(spark):
    assert result(spark, []) == {}
    long = "word " * 200_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "end."), (2, None, None, None), (3, 0, "user", "Hi.")]
    assert result(spark, rows) == brute(rows)
