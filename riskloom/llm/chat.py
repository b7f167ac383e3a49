"""Conversations as training text: a compiled template renders the turns, marks what is to be learned, and can be read back.

Rows of a conversation stream through its template in order of turn. The result comes in pieces of about PIECE characters, so that a
conversation of any length needs a bounded amount of memory; nearly all have one piece. One task sees all rows of a conversation, one
after the other, as its text and its digests are sequences; it never holds them.

Control strings inside texts are escaped: every ``<``, any number of backslashes, ``|`` gets one more backslash. So a text holds no
``<|`` of its own, and taking one backslash away gives it back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.template import compiled
from riskloom.llm.texts import map_documents

PIECE = 1 << 20

_OPEN, _SHUT = "<|im_start|>", "<|im_end|>"

#: Turns between control strings; only the assistant's texts are to be learned.
TEMPLATE = (
    "{% for message in messages %}" + _OPEN + "{{ message.role | line }}\n"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}" + _SHUT + "\n{% endfor %}"
)

_RAW, _ESCAPED = re.compile(r"<(\\*\|)"), re.compile(r"<\\(\\*\|)")
_TURN = re.compile(re.escape(_OPEN) + r"([^\n]*)\n(.*?)" + re.escape(_SHUT) + r"\n", re.S)


def escape(text: str) -> str:
    """A text without control strings, from which :func:`unescape` makes the text again."""
    return _RAW.sub(r"<\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1", text)


def line(text: str) -> str:
    """As :func:`escape`, on one line: for roles, which end at the line's end. ``%`` and the line feed become %25 and %0A."""
    return escape(text.replace("%", "%25").replace("\n", "%0A"))


def unline(text: str) -> str:
    return unescape(text).replace("%0A", "\n").replace("%25", "%")


FILTERS = {"escape": escape, "line": line, "trim": str.strip}


def render(pieces: Iterator[tuple[str, bool]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Texts of about PIECE characters with the spans between generation markers; a span never lies in two of them."""
    held, spans, size = [], [], 0
    for text, marked in pieces:
        if marked and text:
            if spans and spans[-1][1] == size:
                spans[-1] = (spans[-1][0], size + len(text))
            else:
                spans.append((size, size + len(text)))
        held.append(text)
        size += len(text)
        if size >= PIECE and not marked:
            yield "".join(held), spans
            held, spans, size = [], [], 0
    yield "".join(held), spans


def format_conversations(rows: DataFrame, template: str = TEMPLATE, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``id_col``, piece int, last boolean, formatted string, spans array<struct<start:long,stop:long>> (code points, stop exclusive).

    Rows of a conversation go by turn (nulls first), equal turns by role and text; repeated rows stay repeated. Null texts and roles
    are empty. A null id is a conversation like any other. Pieces count from 0; the last one of a conversation says so. No rows, no
    conversations. Further columns don't matter.
    """
    compiled(template, FILTERS)  # errors of the template show here

    def run(found: Iterator[tuple]):
        renderer = compiled(template, FILTERS)
        ahead = next(found, None)
        while ahead is not None:
            key = ahead[0]

            def messages():
                nonlocal ahead
                while ahead is not None and ahead[0] == key:
                    message = {"role": ahead[1] or "", "text": ahead[2] or ""}
                    ahead = next(found, None)
                    yield message

            turns = messages()
            before, at = None, 0
            for part in render(renderer(turns)):
                if before is not None:
                    yield _piece(id_col, key, at, False, before)
                    at += 1
                before = part
            yield _piece(id_col, key, at, True, before)
            for _ in turns:  # a template need not look at all turns
                pass

    keep = [F.col(c) for c in (id_col, turn_col, role_col, text_col)]
    dealt = rows.select(*keep).repartition(id_col).sortWithinPartitions(id_col, turn_col, role_col, text_col)
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, last boolean, formatted string, spans array<struct<start:long,stop:long>>"
    return map_documents(dealt, [id_col, role_col, text_col], schema, run)


def _piece(id_col: str, key: object, at: int, last: bool, part: tuple[str, list[tuple[int, int]]]) -> dict[str, list]:
    return {id_col: [key], "piece": [at], "last": [last], "formatted": [part[0]], "spans": [[{"start": a, "stop": b} for a, b in part[1]]]}


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the formatted text says, parsed from it: ``id_col``, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``turns_sha256`` digests role, line feed, text, line feed of every turn; ``loss_chars`` and ``loss_sha256`` the unescaped text of all
    spans. For :data:`TEMPLATE`. Conversations of one piece are read where they lie, longer ones in order of their pieces.
    """
    def run(found: Iterator[tuple]):
        rest, n, chars, loss, turns, learned = "", 0, 0, 0, hashlib.sha256(), hashlib.sha256()
        for key, last, text, spans in found:
            chars += len(text)
            for span in spans or ():
                part = unescape(text[span["start"]:span["stop"]])
                loss += len(part)
                learned.update(part.encode())
            rest, at = rest + text, 0
            for m in _TURN.finditer(rest):
                if m.start() != at:
                    break
                n, at = n + 1, m.end()
                turns.update(f"{unline(m[1])}\n{unescape(m[2])}\n".encode())
            rest = rest[at:]
            if last:
                if rest:
                    raise ValueError(f"conversation {key}: text outside of turns")
                yield {id_col: [key], "n_turns": [n], "turns_sha256": [turns.hexdigest()], "loss_chars": [loss],
                       "loss_sha256": [learned.hexdigest()], "formatted_chars": [chars]}
                rest, n, chars, loss, turns, learned = "", 0, 0, 0, hashlib.sha256(), hashlib.sha256()

    kind = formatted.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = [id_col, "last", "formatted", "spans"]
    whole = map_documents(formatted.filter("last and piece = 0"), columns, schema, run)
    torn = formatted.filter("not (last and piece = 0)").repartition(id_col).sortWithinPartitions(id_col, "piece")
    return whole.unionByName(map_documents(torn, columns, schema, run))
