"""Conversation structure repair by cheapest edits, with Four-Russians block tables.

A repaired conversation's role initials follow the grammar (s?(ua)+)?. The costs of finishing from each of the grammar's
four states, less the least of them, take few different values; for each of these and each block of symbols a table
has the costs before the block. Conversations are run through from their end by lookup; a block is expanded again,
from its end, where its edits are read off, so of equally cheap edits the ASCII-least are told by the exact costs.

A conversation of any length is cut into pieces. A piece's effect on costs is a 4 x 4 matrix, its effect on the
grammar's state depends on the costs after it only: both are composed along a conversation, and pieces are worked on
in parallel.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .turns import PIECE_CHARS, PIECE_ROWS, by_conversation, digest, in_order, mapped

#: What edits cost, and what a truncated row that isn't deleted adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a; where a kept role leads, and what an inserted or new role (user or assistant) leads to.
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "o": (None, None, None, None)}
PUT = (2, 2, 3, 2)
#: Costs of ending in each state.
END = (0, 2 * INSERT, INSERT, 0)
#: Rows as symbols: X has to go; else the role's initial (o: another), as a capital where the row is truncated.
SYMBOLS = "XsuaoSUAO"
NEVER = 1 << 40
BLOCK = 4
LEGAL = frozenset({"su", "ua", "au"})
SPACE = " \t\n\v\f\r"


def before(symbol: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs of finishing from each state before a row, given those after it; insertions before the row included."""
    more, out = TRUNCATED if symbol in "SUAO" else 0, []
    for state in range(4):
        cost = after[state] + DELETE
        if symbol != "X":
            kept = KEPT[symbol.lower()][state]
            cost = min(cost, after[PUT[state]] + REROLE + more, NEVER if kept is None else after[kept] + more)
        out.append(cost)
    for _ in range(3):
        out = [min(cost, out[PUT[state]] + INSERT) for state, cost in enumerate(out)]
    return tuple(min(NEVER, cost) for cost in out)


class Tables:
    """Transitions of normalised cost vectors: by symbol, and by block of BLOCK symbols."""

    def __init__(self, block: int = BLOCK):
        self.block, self.vectors, self.number = block, [], {}
        for v in (END, *self.units()):
            self._of(v)
        one, more, at = [], [], 0
        while at < len(self.vectors):  # vectors that symbols lead to join the list
            found = [self._of(before(s, self.vectors[at])) for s in SYMBOLS]
            one.append([n for n, _ in found])
            more.append([least for _, least in found])
            at += 1
        self.one, self.more = np.array(one, np.int32), np.array(more, np.int64)
        codes = np.arange(len(SYMBOLS) ** block)
        self.to = np.repeat(np.arange(len(self.vectors), dtype=np.int32)[:, None], len(codes), 1)
        self.add = np.zeros(self.to.shape, np.int64)
        for k in range(block):  # the last symbol first
            symbol = codes // len(SYMBOLS) ** k % len(SYMBOLS)
            self.add += self.more[self.to, symbol]
            self.to = self.one[self.to, symbol]
        self.weights = len(SYMBOLS) ** np.arange(block - 1, -1, -1)
        self.code = np.zeros(128, np.int64)
        self.code[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))
        self.edits = lru_cache(1 << 16)(self._edits)

    @staticmethod
    def units():
        return [tuple(0 if i == state else NEVER for i in range(4)) for state in range(4)]

    def _of(self, v: tuple[int, ...]) -> tuple[int, int]:
        """A vector's number, and the least of its costs that was taken off."""
        least = min(v)
        key = tuple(NEVER if c >= NEVER else c - least for c in v)
        if key not in self.number:
            self.number[key] = len(self.vectors)
            self.vectors.append(key)
        return self.number[key], least

    def blocks(self, symbols: str) -> list[int]:
        """Codes of whole blocks; what is left over stands at the front."""
        codes = self.code[np.frombuffer(symbols.encode(), np.uint8)][len(symbols) % self.block :]
        return (codes.reshape(-1, self.block) @ self.weights).tolist()

    def back(self, symbols: str, after: tuple[int, ...], codes: list[int] | None = None) -> tuple[tuple[int, ...], list[int]]:
        """Costs before symbols, given those after them, and the numbers of the vectors behind each block, in order."""
        at, total = self._of(after)
        codes, behind = self.blocks(symbols) if codes is None else codes, []
        for code in reversed(codes):
            behind.append(at)
            total += int(self.add[at, code])
            at = int(self.to[at, code])
        for s in reversed(symbols[: len(symbols) % self.block]):
            total += int(self.more[at, self.code[ord(s)]])
            at = int(self.one[at, self.code[ord(s)]])
        return tuple(min(NEVER, c + total) for c in self.vectors[at]), behind[::-1]

    def matrix(self, symbols: str) -> list[int]:
        """Costs from each state before symbols to each state after them, row by row."""
        codes = self.blocks(symbols)
        columns = [self.back(symbols, unit, codes)[0] for unit in self.units()]
        return [columns[to][state] for state in range(4) for to in range(4)]

    def _edits(self, symbols: str, at: int, state: int) -> tuple[str, int]:
        """The ASCII-least of the cheapest edits of a few symbols from a state, and the state after them: costs are
        expanded from the block's end, then edits read off from its beginning."""
        costs = [self.vectors[at]]
        for s in reversed(symbols):
            costs.append(before(s, costs[-1]))
        costs.reverse()
        out = []
        for k, s in enumerate(symbols):
            now, after = costs[k], costs[k + 1]
            more = TRUNCATED if s in "SUAO" else 0
            while True:
                if now[state] == after[state] + DELETE:
                    out.append("D")
                elif now[state] == now[PUT[state]] + INSERT:
                    out.append("I")
                    state = PUT[state]
                    continue
                elif s != "X" and (kept := KEPT[s.lower()][state]) is not None and now[state] == after[kept] + more:
                    out.append("K")
                    state = kept
                else:
                    out.append("R")
                    state = PUT[state]
                break
        return "".join(out), state

    def trace(self, symbols: str, after: tuple[int, ...], state: int) -> tuple[str, int]:
        """The ASCII-least of the cheapest edits of symbols from a state, given the costs after them, and the state then."""
        codes = self.blocks(symbols)
        _, behind = self.back(symbols, after, codes)
        at = len(symbols) % self.block
        out = []
        if at:
            first, _ = self.back(symbols[at:], after, codes)
            piece, state = self.edits(symbols[:at], self._of(first)[0], state)
            out.append(piece)
        for number in behind:
            piece, state = self.edits(symbols[at : at + self.block], number, state)
            out.append(piece)
            at += self.block
        return "".join(out), state


@lru_cache(1)
def tables() -> Tables:
    return Tables()


def ending(state: int) -> str:
    return "I" * (END[state] // INSERT)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after damage, one row for each distinct one; copies 0: it was dropped."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    role = F.when(kind == 4, "user").otherwise(part("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long")
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


def _seen_before(rows: DataFrame) -> DataFrame:
    """Those of the rows whose role and text an earlier turn of their conversation has, without texts."""
    narrow = rows.where("copies > 0").select("conv_id", "role", "digest", F.struct("turn").alias("at"))  # in a struct, nulls come first
    firsts = narrow.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("first"), F.count("*").alias("turns")).where("turns > 1")
    firsts = firsts.toDF("_conv_id", "_role", "_digest", "first", "turns")
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    return narrow.join(firsts, same).where("at > first").select("conv_id", F.col("at.turn").alias("turn"), "role", "digest")


def _cut(rows, most: int):
    """Pieces of conversations, of `most` rows at most, from rows in order: symbols, matrix, faults, and roles and texts of rows that may stay."""
    from pyspark import TaskContext

    part, no, table = TaskContext.get().partitionId(), 0, tables()
    conv = piece = None

    def new():
        return {"symbols": [], "roles": [], "texts": [], "chars": 0, "faults": [0, 0, 0, 0], "first": None, "last": None, "turns": [None, None, 0]}

    def closed():
        nonlocal no
        no += 1
        symbols = "".join(piece["symbols"])
        low, high, n = piece["turns"]
        return conv, part, no, symbols, table.matrix(symbols), piece["roles"], piece["texts"], *piece["faults"], piece["first"], piece["last"], low, high, n

    def put(symbol, initial, turn, fault):
        piece["symbols"].append(symbol)
        if fault is not None:
            piece["faults"][fault] += 1
        if piece["last"] is None:
            piece["first"] = initial
        elif piece["last"] + initial not in LEGAL:
            piece["faults"][3] += 1
        piece["last"] = initial
        if turn is not None:
            low, high, n = piece["turns"]
            piece["turns"] = [turn if low is None else low, turn, n + (turn != high)]

    seen = False
    for at, (conv_id, turn, role, text, copies, mark) in enumerate(rows):
        if at == 0 or conv_id != conv:
            if at:
                yield closed()
            conv, piece = conv_id, new()
        if mark == 0:  # the next row has been seen before
            seen = True
            continue
        initial = role[:1]
        shown = text.rstrip(SPACE)
        for k in range(copies):
            if len(piece["symbols"]) >= most or piece["chars"] >= PIECE_CHARS:
                yield closed()
                piece = new()
            if not shown:
                put("X", initial, turn, 0)
            elif seen or k:
                put("X", initial, turn, 1)
            else:
                cut = shown[-1] not in ".!?"
                symbol = initial if initial in ("s", "u", "a") else "o"
                put(symbol.upper() if cut else symbol, initial, turn, 2 if cut else None)
                piece["roles"].append(role)
                piece["texts"].append(text)
                piece["chars"] += len(text)
        seen = False
    if piece is not None:
        yield closed()


_PIECE = "part int, no int, symbols string, matrix array<bigint>, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"


def _costs_after(rows):
    """From pieces of each conversation, last first: what finishing costs after each."""
    conv, costs, first = None, END, True
    for conv_id, part, no, symbols, matrix in rows:
        if first or conv_id != conv:
            conv, costs, first = conv_id, END, False
        yield conv_id, part, no, symbols, list(costs)
        costs = tuple(min(matrix[4 * state + to] + costs[to] for to in range(4)) for state in range(4))


def _traced(rows):
    """Edits and next state of each piece for each state that it may begin in, and what finishing costs from the start."""
    table = tables()
    for conv_id, part, no, symbols, after in rows:
        found = [table.trace(symbols, tuple(after), state) for state in range(4)]
        yield conv_id, part, no, [audit for audit, _ in found], [state for _, state in found], table.back(symbols, tuple(after))[0][0]


def _repaired(rows):
    """Pieces with the edits from the state that each begins in, and the turns that they leave; a conversation's last one has its ending."""
    held, state, traced = None, 0, None

    def closed(more):
        conv_id, part, no, audit, start, symbols, roles, texts, cost, *faults = held
        return conv_id, part, no, audit + more, *_applied(audit + more, symbols, start, roles, texts), cost, *faults

    for conv_id, part, no, kind, audits, to, cost, symbols, roles, texts, *faults in rows:
        if kind == 0:
            fresh = held is None or conv_id != held[0]
            if held:
                yield closed(ending(state) if fresh else "")
            state = 0 if fresh else state
            traced = audits[state], to[state], cost
            continue
        audit, after, cost = traced
        held = conv_id, part, no, audit, state, symbols, roles, texts, cost, *faults
        state = after
    if held:
        yield closed(ending(state))


def _applied(audit: str, symbols: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts that edits leave of the rows that may stay."""
    out_roles, out_texts, edits, at = [], [], iter(audit), 0

    def put(role, text):
        out_roles.append(role)
        out_texts.append(text)

    for s in [*symbols, None]:
        edit = next(edits, None)
        while edit == "I":
            state = PUT[state]
            put("user" if state == 2 else "assistant", "")
            edit = next(edits, None)
        if s is None or s == "X":
            continue
        role, text = roles[at], texts[at]
        at += 1
        if edit == "K":
            state = KEPT[s.lower()][state]
            put(role, text)
        elif edit == "R":
            state = PUT[state]
            put("user" if state == 2 else "assistant", text)
    return out_roles, out_texts


def _summed(rows):
    """One row per conversation from its repaired pieces in order."""
    now = None

    def closed():
        low, high, turns = now["turns"]
        gaps = high - low + 1 - turns if turns else 0
        return now["conv"], gaps, *now["faults"], now["cost"], "".join(now["audit"]), now["sha"].hexdigest(), now["kept"]

    for conv_id, _, _, audit, roles, texts, cost, blank, duplicate, truncated, illegal, first, last, low, high, turns in rows:
        if now is None or conv_id != now["conv"]:
            if now:
                yield closed()
            now = {"conv": conv_id, "faults": [0, 0, 0, 0], "cost": cost, "audit": [], "sha": hashlib.sha256(), "kept": 0, "last": None, "turns": (None, None, 0)}
        joins = now["last"] is not None and first is not None and now["last"] + first not in LEGAL
        now["faults"] = [a + b for a, b in zip(now["faults"], (blank, duplicate, truncated, illegal + joins), strict=True)]
        now["last"] = now["last"] if last is None else last
        if low is not None:
            was, top, n = now["turns"]
            now["turns"] = low if was is None else was, high, n + turns - (top == low)
        now["audit"].append(audit)
        for role, text in zip(roles, texts, strict=True):
            now["sha"].update((("\n" if now["kept"] else "") + role + ":" + text).encode())
            now["kept"] += 1
    if now:
        yield closed()


_FAULTS = ("blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns")


def repair(conversations: DataFrame, damage=damaged, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Pieces of repaired conversations, in order within each partition: (conv_id, part, no, audit, roles, texts, cost, faults ...).

    conversations has conv_id, turn, role and text; damage gives its rows as (conv_id, turn, role, text, copies).
    Other columns don't matter, whatever their names. Null roles and texts are one space; a null conv_id is a
    conversation; null turns come first; rows of one turn are ordered by role, then by their text's SHA-256; repeated rows are
    duplicates; an empty table gives an empty one. cost is the whole conversation's.
    """
    rows = staged(damage(conversations).withColumn("digest", digest(F.col("text"))), "repair-rows")
    marks = _seen_before(rows).select("conv_id", "turn", "role", F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"), "digest", F.lit(0).alias("mark"))
    marked = in_order(marks.unionByName(rows.withColumn("mark", F.lit(1))), "mark")
    size = lambda row: sum(map(len, row[6]))  # noqa: E731  of texts
    pieces = staged(mapped(marked, _PIECE, lambda found: _cut(found, piece_rows), ("conv_id", "turn", "role", "text", "copies", "mark"), size), "repair-pieces")
    order = ("conv_id", "part", "no")
    last_first = by_conversation(pieces.select(*order, "symbols", "matrix"), F.desc("part"), F.desc("no"))
    after = mapped(last_first, "part int, no int, symbols string, after array<bigint>", _costs_after, (*order, "symbols", "matrix"))
    traced = mapped(after.repartition("part", "no"), "part int, no int, audits array<string>, to array<int>, cost long", _traced, (*order, "symbols", "after"))
    both = traced.withColumn("kind", F.lit(0)).unionByName(pieces.drop("matrix").withColumn("kind", F.lit(1)), allowMissingColumns=True)
    columns = (*order, "kind", "audits", "to", "cost", "symbols", "roles", "texts", *_FAULTS)
    out = "part int, no int, audit string, roles array<string>, texts array<string>, cost long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"
    return mapped(by_conversation(both, "part", "no", "kind"), out, _repaired, columns, lambda row: sum(map(len, row[5])))


def turns(repaired: DataFrame) -> DataFrame:
    """(conv_id, part, no, at, role, text) of repaired conversations; part, no and at give their order."""
    return repaired.select("conv_id", "part", "no", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "t")).select("conv_id", "part", "no", "at", F.col("t.roles").alias("role"), F.col("t.texts").alias("text"))


def audited(conversations: DataFrame, damage=damaged, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and the repaired rows' digest, streamed over its pieces."""
    out = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, n_kept long"
    return mapped(repair(conversations, damage, piece_rows), out, _summed, ("conv_id", "part", "no", "audit", "roles", "texts", "cost", *_FAULTS))
