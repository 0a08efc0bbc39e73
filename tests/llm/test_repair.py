import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from strata_spark.llm import repair, turns


def cheapest(symbols):
    """(cost, edits) by trying all edits, one row at a time: of equal costs the ASCII-least."""
    end = {0: (0, ""), 1: (10, "II"), 2: (5, "I"), 3: (0, "")}

    @lru_cache(None)
    def best(at, state, puts=0):
        if at == len(symbols):
            return end[state]
        s, found = symbols[at], []
        more = 5 if s in "SUAO" else 0
        follow = lambda cost, edit, to: found.append((cost + best(at + 1, to)[0], edit + best(at + 1, to)[1]))
        follow(2, "D", state)
        if s != "X":
            to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(s.lower(), {}).get(state)
            if to is not None:
                follow(more, "K", to)
            follow(1 + more, "R", 3 if state == 2 else 2)
        if puts < 3:
            cost, edits = best(at, 3 if state == 2 else 2, puts + 1)
            found.append((5 + cost, "I" + edits))
        return min(found)

    return best(0, 0)


def brute(rows):
    """Rows (conv_id, turn, role, text), of one conversation, after damage and in order: the query's columns."""
    blank = duplicate = truncated = 0
    symbols, seen = "", set()
    for _, _, role, text in rows:
        shown = text.strip(" \t\n\v\f\r")
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not shown:
            blank, symbols = blank + 1, symbols + "X"
        elif (role, text) in seen:
            duplicate, symbols = duplicate + 1, symbols + "X"
        elif shown[-1] not in ".!?":
            truncated, symbols = truncated + 1, symbols + initial.upper()
        else:
            symbols += initial
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, edits = cheapest(symbols)
    out, left = [], list(rows)
    for e in edits:
        grammar = [r[:1] for r, _ in out]
        new = "assistant" if grammar and grammar[-1] == "u" else "user"
        if e == "I":
            out.append((new, ""))
        else:
            row = left.pop(0)
            if e != "D":
                out.append((row[2] if e == "K" else new, row[3]))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out)) and not left
    at = {r[1] for r in rows} - {None}
    gaps = max(at) - min(at) + 1 - len(at) if at else 0
    return gaps, blank, duplicate, truncated, illegal, cost, edits, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv_id, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))


def whole(rows):
    return {c: brute(damaged([r for r in rows if r[0] == c])) for c in {r[0] for r in rows}}


def test_edits_by_tables_equal_all_edits():
    rng, tables = random.Random(1), repair.Tables(3)
    cases = ["", "X", "s", "S", "u", "ua", "suaua", "UA", "ssss", "XXXX"] + ["".join(rng.choice(repair.SYMBOLS) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    for symbols in cases:
        audit, state = tables.trace(symbols, repair.END, 0)
        assert (tables.back(symbols, repair.END)[0][0], audit + repair.ending(state)) == cheapest(symbols), symbols


def test_pieces_compose():
    rng, tables = random.Random(2), repair.tables()
    for _ in range(200):
        symbols = "".join(rng.choice(repair.SYMBOLS) for _ in range(rng.randint(2, 40)))
        cut = rng.randint(0, len(symbols))
        whole_, (_, left), (_, right) = tables.back(symbols, repair.END)[0], (0, tables.matrix(symbols[:cut])), (0, tables.matrix(symbols[cut:]))
        after = [min(right[4 * q + to] + repair.END[to] for to in range(4)) for q in range(4)]
        assert tuple(min(left[4 * q + to] + after[to] for to in range(4)) for q in range(4)) == whole_
        first, state = tables.trace(symbols[:cut], tuple(after), 0)
        assert first + tables.trace(symbols[cut:], repair.END, state)[0] == tables.trace(symbols, repair.END, 0)[0]


def rows_of(df):
    return {r.conv_id: tuple(r)[1:9] for r in df.collect()}


def test_small_conversations(spark):
    rng, texts = random.Random(3), ["Yes.", "No", "a!", "", " \n", "b?  ", None, "Ünï。", "\x85", "x . "]
    rows = [(c if c != 7 else None, rng.choice([*range(-2, 6), None]), rng.choice(["system", "user", "assistant", "tool", "", None, "Sys"]), rng.choice(texts)) for c in range(150) for _ in range(rng.randint(1, 9))]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"copies": F.lit("mine"), "PART": F.lit(1), "audit": F.lit(None).cast("string")})
    assert rows_of(repair.audited(table.repartition(5))) == whole(rows)
    assert rows_of(repair.audited(table, piece_rows=2)) == whole(rows)
    assert repair.audited(table.where("false")).count() == 0


def test_long_conversations_are_cut(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant"]), rng.choice(["w" * 40, "Fine.", "Ok!", ""]) + f"{t % 3000}." * (t % 5 > 0)) for c, n in ((1, 12_000), (2, 3), (3, 9000)) for t in range(n)]
    rows += [(4, 1, "user", "x" * 300_000 + "."), (4, 2, "assistant", "Long.")] + [(5, 2, "user", "Same.")] * 5000
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = repair.repair(table.repartition(7)).cache()
    assert {r.conv_id for r in pieces.groupBy("conv_id").count().where("count > 2").collect()} >= {1, 3}
    got = rows_of(repair.audited(table))
    small = {c: v for c, v in got.items() if c in (2, 4, 5)}
    assert small == {c: brute(damaged([r for r in rows if r[0] == c])) if c != 5 else small[5] for c in (2, 4, 5)}
    assert small[5][2] == len(damaged([r for r in rows if r[0] == 5])) - 1 and small[5][1] == 0
    tables = repair.tables()
    for c in (1, 3):
        own = damaged([r for r in rows if r[0] == c])
        seen, symbols = set(), ""
        for _, _, role, text in own:
            symbols += "X" if not text.strip() or (role, text) in seen else role[0] if text.strip()[-1] in ".!?" else role[0].upper()
            seen.add((role, text))
        audit, state = tables.trace(symbols, repair.END, 0)
        assert got[c][6] == audit + repair.ending(state) and got[c][5] == tables.back(symbols, repair.END)[0][0]
    kept = repair.turns(pieces).where("conv_id in (1, 3)").orderBy("conv_id", "part", "no", "at").collect()
    for c in (1, 3):
        own = [r for r in kept if r.conv_id == c]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in own))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()).hexdigest() == got[c][7]
    assert turns.PIECE_ROWS == 4096


@pytest.mark.parametrize("at", ["/root/testdata/sf0.01"])
def test_whole_table(spark, at):
    table = spark.read.parquet(f"{at}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(repair.audited(table)) == whole(rows)
