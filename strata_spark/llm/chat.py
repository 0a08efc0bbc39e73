"""Chat formatting with a grammar round trip.

    text := turn*    turn := "<|im_start|>" role "\\n" content "<|im_end|>\\n"

Neither role nor content holds a control string. Rendered turns are parsed again; a turn that doesn't come back as it was
has its control strings escaped (a backslash more behind their "<"), until what is parsed is identical. Reading takes one
backslash off each, so it needs nothing but the text.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .turns import PIECE_CHARS, PIECE_ROWS, by_conversation, digest, in_order, mapped

#: The template's control strings. A line feed in a role is written as the last one.
START, STOP, LINE = "<|im_start|>", "<|im_end|>", "<|im_nl|>"
_CONTROL = re.compile(r"<(\\*)\|(im_start|im_end|im_nl)\|>")
_ESCAPED = re.compile(r"<\\(\\*\|(?:im_start|im_end|im_nl)\|>)")
_TURN = re.compile(r"<\|im_start\|>(?P<role>[^\n]*)\n(?P<content>.*?)<\|im_end\|>\n", re.S)
SCHEMA = "part int, no int, formatted string, loss array<struct<start:int,stop:int>>"


class Conflict(ValueError):
    """Text that the grammar doesn't derive."""


def escaped(s: str) -> str:
    return _CONTROL.sub(r"<\\\1|\2|>", s)


def unescaped(s: str) -> str:
    return _ESCAPED.sub(r"<\1", s)


def render(turns: list[tuple[str, str]], conflicts: list[bool] | None = None) -> str:
    """Turns in the template, the marked ones escaped."""
    out = []
    for k, (role, content) in enumerate(turns):
        if conflicts and conflicts[k]:
            role, content = escaped(role).replace("\n", LINE), escaped(content)
        out.append(f"{START}{role}\n{content}{STOP}\n")
    return "".join(out)


def spans(text: str) -> list[tuple[str, int, int]]:
    """(role, start, end) of each turn's content in rendered text, by the grammar; what it doesn't derive raises Conflict."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m or any(control in m[name] for control in (START, STOP) for name in ("role", "content")):
            raise Conflict(f"no turn at {at}")
        out.append((unescaped(m["role"].replace(LINE, "\n")), m.start("content"), m.end("content")))
        at = m.end()
    return out


def parse(text: str) -> list[tuple[str, str]]:
    return [(role, unescaped(text[start:stop])) for role, start, stop in spans(text)]


def _comes_back(turns: list[tuple[str, str]], text: str) -> bool:
    try:
        return parse(text) == turns
    except Conflict:
        return False


def formatted(turns: list[tuple[str, str]]) -> str:
    """Rendered turns that parse to the same turns: those that don't are escaped, then all are compared again."""
    text = render(turns)
    if _comes_back(turns, text):
        return text
    conflicts = [not _comes_back([turn], render([turn])) for turn in turns]
    text = render(turns, conflicts)
    if not _comes_back(turns, text):
        raise Conflict("escaped turns don't come back")
    return text


def _pieces(rows, most: int, trained: frozenset[str]):
    """Formatted pieces of whole turns, with the spans under the loss mask, from rows in order."""
    from pyspark import TaskContext

    part, no = TaskContext.get().partitionId(), 0
    conv, held, chars = None, [], 0

    def closed():
        nonlocal no
        no += 1
        text = formatted(held)
        return conv, part, no, text, [{"start": start, "stop": stop} for role, start, stop in spans(text) if role in trained]

    for conv_id, role, text in rows:
        if held and (conv_id != conv or len(held) >= most or chars >= PIECE_CHARS):
            yield closed()
            held, chars = [], 0
        conv = conv_id
        held.append((role, text))
        chars += len(text)
    if held:
        yield closed()


def format_conversations(conversations: DataFrame, trained: tuple[str, ...] = ("assistant",), piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(conv_id, part, no, formatted, loss): conversations in the template, cut between turns into pieces of bounded size.

    part and no give the pieces' order; a conversation of usual length is one piece. loss has the spans (code points, end exclusive) of
    the trained roles' texts. Null roles and texts are empty; a null conv_id is a conversation; null turns come first;
    rows of one turn are ordered by role, then by their text's SHA-256; repeated rows stay; other columns don't matter, whatever
    their names; an empty table gives an empty one.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"))
    rows = in_order(rows.withColumn("digest", digest(F.col("text"))))
    kept = frozenset(trained)
    return mapped(rows, SCHEMA, lambda found: _pieces(found, piece_rows, kept), ("conv_id", "role", "text"), lambda row: len(row[3]))


def _read(rows):
    """One row per conversation from its formatted pieces in order: everything comes from the formatted text and the mask."""
    now = None

    def closed():
        return now["conv"], now["turns"], now["sha"].hexdigest(), now["loss"], now["loss_sha"].hexdigest(), now["chars"]

    for conv_id, text, loss in rows:
        if now is None or conv_id != now["conv"]:
            if now:
                yield closed()
            now = {"conv": conv_id, "turns": 0, "sha": hashlib.sha256(), "loss": 0, "loss_sha": hashlib.sha256(), "chars": 0}
        for role, content in parse(text):
            now["turns"] += 1
            now["sha"].update(f"{role}\n{content}\n".encode())
        for span in loss:
            piece = unescaped(text[span["start"] : span["stop"]])
            now["loss"] += len(piece)
            now["loss_sha"].update(piece.encode())
        now["chars"] += len(text)
    if now:
        yield closed()


def read_back(written: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of formatted conversations."""
    out = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return mapped(by_conversation(written, "part", "no"), out, _read, ("conv_id", "formatted", "loss"))
