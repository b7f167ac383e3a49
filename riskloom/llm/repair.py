"""Conversations with faults, and the cheapest edits that give them the structure ``(s?(ua)+)?`` of role initials.

The grammar is a machine of four states (nothing yet, after the system row, after a user, after an assistant). What a row is to it is one
of nine symbols: its role's initial, with a mark if the text is truncated, or "must go". The vector of what the rest costs from each state,
less its smallest entry, takes only a few dozen values, since no state is more than a few edits from another; so, Four-Russians style:

* A table has the transition of every such vector under every block of BLOCK symbols, computed once. A conversation is processed from its
  end, one look-up for a block.
* The edits are traced forward. A block is expanded backward from the vector behind it, which gives the vectors between its rows; then each
  edit is the ASCII-least one that still costs no more than the best. The edit letters of the same cost lead to one state each, so this
  first-come choice gives the ASCII-least sequence.

A conversation of any length is cut where partitions are cut: keys of rows are sorted over the cluster, and what a segment does to every
vector behind it is a small map. Maps of the segments of one conversation are chained, after which each segment is traced by itself. Only
conversations at a partition's edge need that. Texts move once, to where the repaired conversation is put together row by row.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.texts import map_documents, write_once

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
BLOCK = 4
#: Sound rows by role initial (s, u, a, any other), the same with truncated text, and rows that must go.
SOUND, CUT, GONE = "suao", "SUAO", "x"
SYMBOLS = SOUND + CUT + GONE
#: The row that an inserted or rerolled row must be in each state, and the state after it.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: State after a kept row, by state and initial.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Characters that count as white space.
BLANKS = " \t\n\v\f\r"


def with_inserts(cost: list[int]) -> list[int]:
    """Cheapest cost from each state if rows may be inserted first. Two in a row lead to every state that inserting leads to."""
    for _ in range(2):
        cost = [min(cost[q], INSERT + cost[NEXT[q]]) for q in range(4)]
    return cost


def row_options(state: int, symbol: str) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of what can be done with a row, in ASCII order."""
    if symbol == GONE:
        return [("D", DELETE, state)]
    more = TRUNCATED if symbol in CUT else 0
    out = [("D", DELETE, state)]
    if (state, symbol.lower()) in KEPT:
        out.append(("K", KEEP + more, KEPT[state, symbol.lower()]))
    return [*out, ("R", REROLE + more, NEXT[state])]


def before_row(symbol: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs from each state before a row, inserts included, if ``after`` are those behind it."""
    return tuple(with_inserts([min(c + after[to] for _, c, to in row_options(q, symbol)) for q in range(4)]))


#: Costs at the end of a conversation: it is complete with nothing or after an assistant.
END = tuple(with_inserts([0, 1 << 20, 1 << 20, 0]))


class Tables:
    """Normalised cost vectors, and their transitions under one symbol and under every block of BLOCK symbols."""

    def __init__(self):
        ids, queue, step, gain = {}, [self._normal(END)], [], []
        ids[queue[0]] = 0
        for v in queue:
            to, plus = [], []
            for symbol in SYMBOLS:
                w = before_row(symbol, v)
                least, w = min(w), self._normal(w)
                if w not in ids:
                    ids[w] = len(queue)
                    queue.append(w)
                to.append(ids[w])
                plus.append(least)
            step.append(to)
            gain.append(plus)
        self.vectors, self.ids = queue, ids
        #: step[v, s]: vector before symbol s if v is behind it; gain: what was subtracted.
        self.step, self.gain = np.array(step), np.array(gain)
        n, size = len(queue), len(SYMBOLS)
        to, plus = np.arange(n)[:, None], np.zeros((n, 1), np.int64)
        # The block's number reads its symbols from left to right; one more symbol is put before it.
        for j in range(BLOCK):
            plus = np.concatenate([plus + self.gain[to, s] for s in range(size)], axis=1)
            to = np.concatenate([self.step[to, s] for s in range(size)], axis=1)
        self.block_step, self.block_gain = to, plus

    @staticmethod
    def _normal(v: tuple[int, ...]) -> tuple[int, ...]:
        return tuple(x - min(v) for x in v)

    @staticmethod
    def coded(symbols: str) -> np.ndarray:
        return np.array([SYMBOLS.index(s) for s in symbols], np.int64)

    def boundaries(self, symbols: np.ndarray, behind: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """For vectors ``behind`` the rows: the vectors at every block boundary, from the first to the last, and the sums subtracted.

        Blocks end with the rows; the first one may be short.
        """
        out, total = [behind], np.zeros(len(behind), np.int64)
        n, size = len(symbols), len(SYMBOLS)
        powers = size ** np.arange(BLOCK - 1, -1, -1)
        numbers = symbols[n % BLOCK:].reshape(-1, BLOCK) @ powers
        for number in numbers[::-1].tolist():
            total = total + self.block_gain[behind, number]
            behind = self.block_step[behind, number]
            out.append(behind)
        if n % BLOCK:
            for s in symbols[:n % BLOCK][::-1].tolist():
                total, behind = total + self.gain[behind, s], self.step[behind, s]
            out.append(behind)
        return out[::-1], total

    def trace(self, symbols: str, behind: int, state: int, last: bool = True) -> tuple[str, int]:
        """Edit letters of rows with the vector ``behind`` them, from a state on, and the state after. Inserts behind the last row belong
        to it only at the end of the conversation."""
        marks, _ = self.boundaries(self.coded(symbols), np.array([behind]))
        first = len(symbols) % BLOCK or BLOCK
        out: list[str] = []
        lo = 0
        for mark in marks[1:]:
            hi = min(len(symbols), lo + (first if lo == 0 else BLOCK))
            block = symbols[lo:hi]
            after = [self.vectors[int(mark[0])]]
            for s in reversed(block):  # the vectors between the rows of this block
                after.append(before_row(s, after[-1]))
            after.reverse()
            for i, s in enumerate(block):
                # A row is reached with every insert made that comes before it.
                while True:
                    letter, to, is_row = self._least(state, s, after[i], after[i + 1])
                    out.append(letter)
                    state = to
                    if is_row:
                        break
            lo = hi
        if last:
            while state not in (START, ASSISTANT):
                out.append("I")
                state = NEXT[state]
        return "".join(out), state

    @staticmethod
    def _least(state: int, symbol: str, here: tuple[int, ...], after: tuple[int, ...]) -> tuple[str, int, bool]:
        options = [(letter, c + after[to], to, True) for letter, c, to in row_options(state, symbol)]
        options.append(("I", INSERT + here[NEXT[state]], NEXT[state], False))
        letter, _, to, is_row = min(o for o in options if o[1] == here[state])
        return letter, to, is_row


@functools.cache
def tables() -> Tables:
    return Tables()


def edit_cost(letters: str, symbols: str) -> int:
    """What an edit sequence costs on rows with these symbols."""
    own = {"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}
    rows = [c for c in letters if c != "I"]
    return sum(map(own.__getitem__, letters)) + TRUNCATED * sum(c != "D" and s in CUT for c, s in zip(rows, symbols))


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` with text and role as they are after the damage, and how often a row stands there (``copies``: 0, 1 or 2).

    What happens follows from crc32 of ``conv_id:turn``, modulo 20. Nulls count as one blank, in the key as in text and role.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _mark(role: Column, text: Column) -> Column:
    """The symbol of a row that is no duplicate."""
    ink = F.rtrim(text, F.lit(BLANKS))
    initial = F.substring(role, 1, 1)
    sound = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(ink == "", GONE).when(F.substring(ink, -1, 1).isin(".", "!", "?"), sound).otherwise(F.upper(sound))


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text"), 256))


ORDER = ["turn", "role", "digest"]


def _segments(dealt: DataFrame, kind: str) -> DataFrame:
    """Rows of each conversation within a partition that is sorted by conv_id and ORDER, as one row with a string of symbols."""
    def run(rows: Iterator[tuple]):
        part, at, held = TaskContext.get().partitionId(), 0, None

        def close(edge: bool):
            conv, first, symbols, counts = held
            return {"conv_id": [conv], "part": [part], "turn": [first[0]], "role": [first[1]], "digest": [first[2]], "symbols": ["".join(symbols)],
                    "edge": [edge], "blank": [counts[0]], "duplicate": [counts[1]], "truncated": [counts[2]]}

        for conv, turn, role, digest, mark, again, copies in rows:
            if held is None or held[0] != conv:
                if held is not None:
                    yield close(at == 0)
                    at += 1
                held = conv, (turn, role, digest), [], [0, 0, 0]
            counts = held[3]
            # Copies of one row follow it at once; of a blank row they are blank too.
            if mark == GONE:
                held[2].append(GONE * copies)
                counts[0] += copies
            else:
                held[2].append((GONE if again else mark) + GONE * (copies - 1))
                counts[1] += copies - (not again)
                counts[2] += (not again) and mark in CUT
        if held is not None:
            yield close(True)

    columns = ["conv_id", *ORDER, "mark", "again", "copies"]
    schema = (f"conv_id {kind}, part int, turn long, role string, digest binary, symbols string, edge boolean, "
              "blank long, duplicate long, truncated long")
    return map_documents(dealt, columns, schema, run)


def _chained(edges: DataFrame, kind: str) -> DataFrame:
    """``edges``, the segments at partition edges, with behind (the vector behind the segment), state (before it) and last.

    From the last segment of a conversation to the first, the vectors; from the first to the last, the states. Each way a segment is
    told what it does to every vector or state, and only these maps meet: a few rows for each partition.
    """
    def join_up(of_segment, forward: bool, name: str):
        def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("part", ascending=forward).reset_index(drop=True)
            value = [0] * len(group)  # the end's vector, or the state at the start
            for i in range(1, len(group)):
                value[i] = int(group.to[i - 1][value[i - 1]])
            ends = group.part == (group.part.max())
            return pd.DataFrame({"conv_id": group.conv_id, "part": group.part, name: value, "last": ends})

        told = map_documents(segments, ["conv_id", "part", "symbols", *(["behind"] if forward else [])], f"conv_id {kind}, part int, to array<int>", of_segment)
        found = told.groupBy("conv_id").applyInPandas(run, f"conv_id {kind}, part int, {name} int, last boolean")
        found = found.withColumnRenamed("conv_id", "conv").withColumnRenamed("part", "p")
        joined = segments.drop("last").join(found, (F.col("part") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv", "p")
        return write_once(joined, "chained")

    def vectors(rows: Iterator[tuple]):
        t = tables()
        for conv, part, symbols in rows:
            marks, _ = t.boundaries(t.coded(symbols), np.arange(len(t.vectors)))
            yield {"conv_id": [conv], "part": [part], "to": [marks[0].tolist()]}

    def states(rows: Iterator[tuple]):
        for conv, part, symbols, behind in rows:
            yield {"conv_id": [conv], "part": [part], "to": [[tables().trace(symbols, behind, q, last=False)[1] for q in range(4)]]}

    segments = edges
    segments = join_up(vectors, False, "behind")
    return join_up(states, True, "state")


def _traced(segments: DataFrame, kind: str) -> DataFrame:
    """Segments with their edit letters in place of the symbols, and what these cost."""
    columns = ["conv_id", "part", *ORDER, "symbols", "behind", "state", "last", "blank", "duplicate", "truncated"]

    def run(rows: Iterator[tuple]):
        t = tables()
        for conv, part, turn, role, digest, symbols, behind, state, last, *counts in rows:
            letters, _ = t.trace(symbols, behind, state, last)
            yield {"conv_id": [conv], "turn": [turn], "role": [role], "digest": [digest], "letters": [letters],
                   "counts": [[*counts, edit_cost(letters, symbols)]]}

    return map_documents(segments, columns, f"conv_id {kind}, turn long, role string, digest binary, letters string, counts array<long>", run)


def plan_repairs(damaged: DataFrame) -> DataFrame:
    """Edit letters of every segment, in order of the first row's (turn, role, digest): from keys of rows only, no text moves."""
    kind = damaged.schema["conv_id"].dataType.simpleString()
    keyed = damaged.filter("copies > 0").select("conv_id", F.col("turn").cast("long"), "role", _digest().alias("digest"),
                                                _mark(F.col("role"), F.col("text")).alias("mark"), "copies")
    keys = write_once(keyed.groupBy("conv_id", *ORDER).agg(F.sum("copies").alias("copies"), F.first("mark").alias("mark")), "keys")
    # Of rows with the same role and text the one of the first turn is no duplicate; a null turn comes before all others.
    firsts = keys.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("at"))
    flags = firsts.select("conv_id", F.col("at.turn").alias("turn"), "role", "digest", F.lit(0).cast("long").alias("copies"),
                          F.lit(None).cast("string").alias("mark"), F.lit(True).alias("first"))
    # Grouped by the whole key, which no two rows share, instead of joined by a text that may be in most rows.
    marked = keys.withColumn("first", F.lit(False)).unionByName(flags).groupBy("conv_id", *ORDER).agg(
        F.sum("copies").alias("copies"), F.max("mark").alias("mark"), (~F.max("first")).alias("again"))
    marked = write_once(marked, "marked")
    dealt = marked.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    segments = write_once(_segments(dealt, kind), "segments")
    edges = segments.filter("edge")
    whole = segments.filter("not edge").withColumns({"behind": F.lit(0), "state": F.lit(START), "last": F.lit(True)})
    return _traced(whole.unionByName(_chained(edges, kind).select(*whole.columns)), kind)


def repaired_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, "turn", role, text) of the repaired rows of each conversation, and at its end (conv_id, "end", summary, None).

    The input is sorted: a conversation's own row first, then each segment's letters before its rows.
    """
    conv, seen = None, False
    letters: Iterator[str] = iter(())
    audit, counts, gaps, illegal, state, previous = [], np.zeros(4, np.int64), 0, 0, START, None

    def summary():
        return {"gaps": gaps, "blank": int(counts[0]), "duplicate": int(counts[1]), "truncated": int(counts[2]), "illegal": illegal,
                "cost": int(counts[3]), "audit": "".join(audit)}

    def inserts():
        """The inserted rows that come next, then the letter that stopped them."""
        nonlocal state
        for letter in letters:
            if letter != "I":
                return letter
            state = NEXT[state]
            yield conv, "turn", NAMES[state], ""
        return ""

    for key, what, own_gaps, role, text, own_letters, own_counts, copies in rows:
        if what == 0:  # a conversation begins
            if seen:
                yield from inserts()
                yield conv, "end", summary(), None
            conv, seen, gaps, letters = key, True, own_gaps, iter(())
            audit, counts, illegal, state, previous = [], np.zeros(4, np.int64), 0, START, None
        elif what == 1:  # a segment's letters
            # An earlier segment ends with its last row: inserts behind it stand at the beginning of this one's letters.
            letters = iter(own_letters)
            audit.append(own_letters)
            counts = counts + np.array(own_counts, np.int64)
        else:
            initial = role[:1]
            for _ in range(copies):
                illegal += previous is not None and previous + initial not in ("su", "ua", "au")
                previous = initial
                letter = yield from inserts()
                if letter == "K":
                    state = KEPT[state, initial]
                    yield conv, "turn", role, text
                elif letter == "R":
                    state = NEXT[state]
                    yield conv, "turn", NAMES[state], text
    if seen:
        yield from inserts()
        yield conv, "end", summary(), None


def _together(rows: DataFrame) -> tuple[DataFrame, str]:
    """All that :func:`repaired_rows` needs, each conversation in one place and in order."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    damaged = damage(rows)
    turns = damaged.groupBy("conv_id", "turn").agg(F.max("copies").alias("copies"))
    turn = F.when(F.col("copies") > 0, F.col("turn").cast("long"))
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0))
    none = lambda t, name: F.lit(None).cast(t).alias(name)
    heads = turns.groupBy("conv_id").agg(gaps.alias("gaps")).select(
        "conv_id", F.lit(0).alias("what"), none("long", "turn"), "gaps", none("string", "role"), none("binary", "digest"), none("string", "text"),
        none("string", "letters"), none("array<long>", "counts"), F.lit(0).alias("copies"))
    planned = write_once(plan_repairs(damaged), "letters").select(
        "conv_id", F.lit(1).alias("what"), "turn", none("long", "gaps"), "role", "digest", none("string", "text"), "letters", "counts", F.lit(0).alias("copies"))
    texts = damaged.filter("copies > 0").select(
        "conv_id", F.lit(2).alias("what"), F.col("turn").cast("long"), none("long", "gaps"), "role", _digest().alias("digest"), "text",
        none("string", "letters"), none("array<long>", "counts"), "copies")
    everything = heads.unionByName(planned).unionByName(texts)
    return everything.repartition("conv_id").sortWithinPartitions("conv_id", (F.col("what") > 0), *ORDER, "what"), kind


_READ = ["conv_id", "what", "gaps", "role", "text", "letters", "counts", "copies"]


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn (from 0), role, text, of ``rows`` (conv_id, turn, role, text) after :func:`damage`.

    See :func:`repair_digests` for odd input. A conversation of which nothing is left has no rows.
    """
    def run(found: Iterator[tuple]):
        at = 0
        for conv, what, role, text in repaired_rows(found):
            if what == "turn":
                yield {"conv_id": [conv], "turn": [at], "role": [role], "text": [text]}
            at = at + 1 if what == "turn" else 0

    together, kind = _together(rows)
    return map_documents(together, _READ, f"conv_id {kind}, turn long, role string, text string", run)


def repair_digests(rows: DataFrame) -> DataFrame:
    """One row for every conv_id of ``rows``: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows of a conversation go by turn (nulls first), equal turns by role and digest of the text; repeated rows are duplicates of the
    first. A null id is a conversation like any other. Null texts and roles are one blank; a role that begins with none of s, u, a can't be
    kept. Nothing left after the damage: zeros, an empty audit and the digest of nothing. Further columns don't matter. The digest of a
    conversation is computed in one pass over its rows, as a SHA-256 must be; none of them is held.
    """
    def run(found: Iterator[tuple]):
        sha, started = hashlib.sha256(), False
        for conv, what, value, text in repaired_rows(found):
            if what == "turn":
                sha.update((("\n" if started else "") + f"{value}:{text}").encode())
                started = True
            else:
                yield {"conv_id": [conv], **{k: [v] for k, v in value.items()}, "repaired_sha256": [sha.hexdigest()]}
                sha, started = hashlib.sha256(), False

    together, kind = _together(rows)
    return map_documents(together, _READ, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                                          "audit string, repaired_sha256 string", run)


def cheapest_by_search(symbols: str) -> tuple[int, str]:
    """Cost and letters by trying everything: all ways to treat the rows, with up to two inserts in each gap. For tests."""
    best = (1 << 30, "")
    ways = ["", "I", "II"]
    for gaps in itertools.product(ways, repeat=len(symbols) + 1):
        for letters in itertools.product("DKR", repeat=len(symbols)):
            state = START
            for gap, letter, s in itertools.zip_longest(gaps, letters, symbols):
                for _ in gap:
                    state = NEXT[state]
                if s is None:
                    break
                options = {x: to for x, _, to in row_options(state, s)}
                if letter not in options:
                    state = None
                    break
                state = options[letter]
            if state in (START, ASSISTANT):
                audit = "".join(g + x for g, x in itertools.zip_longest(gaps, letters, fillvalue=""))
                best = min(best, (edit_cost(audit, symbols), audit))
    return best
