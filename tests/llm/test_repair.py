import hashlib
import itertools
import random
import zlib

import pytest

from riskloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"


def test_tables_equal_search():
    t = repair.tables()
    assert len(t.vectors) < 100
    rng = random.Random(1)
    short = [list(itertools.product(repair.SYMBOLS, repeat=n)) for n in range(4)]
    for combos in [*short[:3], rng.sample(short[3], 60)]:
        for combo in combos:
            s = "".join(combo)
            letters, _ = t.trace(s, 0, repair.START)
            assert (repair.edit_cost(letters, s), letters) == repair.cheapest_by_search(s), s


def stepwise(symbols):
    """(cost, letters) by one table over rows and states, the best prefix of each; no blocks."""
    def closed(best):
        for _ in range(2):
            for q in range(4):
                if q in best:
                    c, a = best[q]
                    to = repair.NEXT[q]
                    best[to] = min(best.get(to, (1 << 30, "")), (c + repair.INSERT, a + "I"))
        return best

    best = closed({repair.START: (0, "")})
    for s in symbols:
        after = {}
        for q, (c, a) in best.items():
            for letter, cost, to in repair.row_options(q, s):
                after[to] = min(after.get(to, (1 << 30, "")), (c + cost, a + letter))
        best = closed(after)
    return min(best[q] for q in (repair.START, repair.ASSISTANT) if q in best)


def test_long_sequences_equal_a_plain_table():
    rng = random.Random(2)
    for n in [4, 5, 7, 8, 9, 40, 41, 400]:
        for _ in range(20):
            s = "".join(rng.choices(repair.SYMBOLS, k=n))
            letters, _ = repair.tables().trace(s, 0, repair.START)
            assert (repair.edit_cost(letters, s), letters) == stepwise(s)


def brute(rows):
    """The digests of the contract, one conversation after the other, by a plain table."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            show = lambda v: " " if v is None else str(v)
            kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
            role, text = show(role), show(text)
            if kind == 1:
                text = ""
            if kind == 2:
                text = text.translate({ord(c): None for c in ".!?"})
            if kind == 4:
                role = "user"
            own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, symbols, counts, illegal = set(), "", [0, 0, 0], 0
        for i, (_, role, text) in enumerate(own):
            ink = text.rstrip(" \t\n\v\f\r")
            kept = role[:1] if role[:1] in ("s", "u", "a") else "o"
            fault = 0 if not ink else 1 if (role, text) in seen else 2 if ink[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            symbols += "x" if fault in (0, 1) else kept.upper() if fault == 2 else kept
            illegal += i > 0 and own[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        cost, audit = stepwise(symbols)
        lines, state, rest = [], 0, iter(own)
        for letter in audit:
            if letter == "I":
                state = repair.NEXT[state]
                lines.append(repair.NAMES[state] + ":")
                continue
            _, role, text = next(rest)
            if letter == "K":
                state = repair.KEPT[state, role[0]]
                lines.append(f"{role}:{text}")
            elif letter == "R":
                state = repair.NEXT[state]
                lines.append(f"{repair.NAMES[state]}:{text}")
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def made(n, seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t", None, "Why?", "So.\n", "a. b", "é…"]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    return [(rng.choice([1, 2, 3, 4, None]), rng.choice([None, *range(40)]), rng.choices(roles, [8, 8, 3, 1, 1, 1, 1])[0], rng.choice(texts)) for _ in range(n)]


def got(spark, rows, partitions=None):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair.repair_digests(df).collect()}


@pytest.mark.parametrize("n, seed", [(5, 1), (60, 2), (400, 3)])
def test_equals_brute_force(spark, n, seed):
    rows = made(n, seed)
    assert got(spark, rows) == brute(rows)


def test_a_conversation_over_many_partitions(spark):
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), f"{t % 50} x{rng.choice(['.', ''])}") for t in range(1500)] + made(40, 5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        assert got(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_row_repeated_often(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"1:{t}".encode()) % 20 > 4)
    rows = [(1, turn, "user", "same.")] * 300 + [(2, 0, "user", "b.")]
    own = got(spark, rows)
    assert own == brute(rows) and own[1][2] == 299


def test_dropped_and_empty(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got(spark, [(1, turn, "user", "gone.")]) == {1: nothing}
    assert repair.repair_digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repaired_rows_have_the_structure(spark):
    df = spark.createDataFrame(made(300, 6), SCHEMA).selectExpr("*", "1 as copies", "'x' as digest", "'y' as mark", "2 as letters")
    by_conv = {}
    for r in repair.repair(df).orderBy("conv_id", "turn").collect():
        by_conv.setdefault(r.conv_id, []).append(r)
    for rows in by_conv.values():
        initials = "".join(r.role[0] for r in rows).removeprefix("s")
        assert initials == "ua" * (len(initials) // 2) and initials
        assert [r.turn for r in rows] == list(range(len(rows)))
