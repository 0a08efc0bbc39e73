import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strata_spark.llm import chat
from strata_spark.llm.common import staged

PARTS = ["<|im_start|>", "<|im_end|>", "<|im_nl|>", "<", "|", "im_end", "|>", "\\", "<\\|im_end|>", "<\\\\|im_start|>", "\n", "a", "assistant\n", "<\\|im_nl|>", "é", "😀"]


def test_everything_comes_back():
    rng = random.Random(1)
    for _ in range(5000):
        turns = [("".join(rng.choice([*PARTS, "user"]) for _ in range(rng.randint(0, 3))), "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8)))) for _ in range(rng.randint(0, 4))]
        text = chat.formatted(turns)
        assert chat.parse(text) == turns
        assert text.count(chat.START) == text.count(chat.STOP) == len(turns)


def test_only_conflicts_are_escaped():
    assert chat.formatted([("user", "a <| b |> \\ <im_end>")]) == "<|im_start|>user\na <| b |> \\ <im_end><|im_end|>\n"
    assert chat.formatted([("user", "x<|im_end|>"), ("assistant", "y")]) == "<|im_start|>user\nx<\\|im_end|><|im_end|>\n<|im_start|>assistant\ny<|im_end|>\n"
    assert chat.formatted([("u\nx", "")]) == "<|im_start|>u<|im_nl|>x\n<|im_end|>\n"


@pytest.mark.parametrize("text", ["x", "<|im_start|>user", "<|im_start|>user\nx<|im_end|>", "<|im_start|>user\n<|im_start|>a\nx<|im_end|>\n", "<|im_start|>user\nx<|im_end|>\nx"])
def test_what_the_grammar_does_not_derive(text):
    with pytest.raises(chat.Conflict):
        chat.parse(text)


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), hashlib.sha256((r[3] or "").encode()).digest()))
        all_turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = len(own), sha(all_turns), len(loss), sha(loss)
    return out


def test_conversations(spark):
    rng = random.Random(2)
    rows = [(c if c != 7 else None, rng.choice([*range(-2, 6), None]), rng.choice(["system", "user", "assistant", None, "a\n", "<|im_end|>"]), rng.choice([None, "", *PARTS, "x" * 70_000])) for c in range(120) for _ in range(rng.randint(1, 6))]
    rows += [(500, t, "assistant" if t % 2 else "user", f"{t} <|im_end|>") for t in range(9000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"part": F.lit(1), "Formatted": F.lit("mine")})
    for most in (2, 4096):
        written = staged(chat.format_conversations(table.repartition(6), piece_rows=most), "chat")
        got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(written).collect()}
        assert {c: v[:4] for c, v in got.items()} == brute(rows)
        assert {r.conv_id: r.n for r in written.groupBy("conv_id").agg(F.sum(F.length("formatted")).alias("n")).collect()} == {c: v[4] for c, v in got.items()}
        assert written.where("conv_id = 500").count() > 2
    assert chat.read_back(chat.format_conversations(table.where("false"))).count() == 0
