"""Every operator on tables with columns whose names clash with its own, a very long text and no rows."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata_spark.llm import bpe, chat, decontam, html, licenses, lm, media, neardup, quality, repair, resample, secrets, token_files
from strata_spark.llm.queries import word_bpe

CLASHING = ["Score", "Predicted", "N_Words", "contaminated", "_hits_0", "_row", "_owner", "_repo", "Secrets", "_path", "_host", "Text", "N_Chars", "N_bytes", "Media", "payload", "Licenses", "token_IDS", "n_tokens", "decoded", "_doc", "_of", "id", "key", "kept"]


def model(docs):
    return quality.train(docs, docs.sparkSession.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int"))


OPERATORS = {
    "bpe": lambda d: bpe.decode(bpe.encode(d, word_bpe()), word_bpe()),
    "decontam": lambda d: decontam.find(d, d.sparkSession.createDataFrame([("i", "a b c")], "item_id string, text string")),
    "lm": lm.score,
    "secrets": lambda d: secrets.masked(secrets.scan(d)),
    "media": lambda d: media.features(media.store(d)),
    "neardup": neardup.deduplicated,
    "link": neardup.link,
    "quality": lambda d: quality.score(d, model(d)),
    "token_files": lambda d: token_files.digests(d, word_bpe()),
    "licenses": licenses.scan,
    "resample": lambda d: resample.resample(d, d.select("text").limit(3)),
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"words of text number {i} are here", "a/b") for i in range(40)]
    out = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return out.withColumns({c: F.lit("mine") for c in CLASHING if c != "Text"})


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_and_no_rows(docs, name):
    assert OPERATORS[name](docs).count() == 40
    assert OPERATORS[name](docs.where("doc_id < 0")).count() == 0


def test_clashing_columns_of_conversations(docs):
    rows = docs.withColumnsRenamed({"doc_id": "conv_id"}).withColumns({c: F.lit("mine") for c in ("part", "no", "digest", "copies", "mark", "Formatted", "loss", "audit")}).withColumns({"turn": F.lit(0).cast("long"), "role": F.lit("user")})
    assert repair.audited(rows).count() == chat.read_back(chat.format_conversations(rows)).count() == 40
    assert repair.audited(rows.where("conv_id < 0")).count() == chat.read_back(chat.format_conversations(rows.where("conv_id < 0"))).count() == 0


def test_clashing_columns_of_pages(docs):
    pages = docs.withColumnRenamed("text", "html").withColumns({"url": F.lit("http://x.example/"), "Text": F.lit("mine")})
    got = html.extract(pages)
    assert {"_path", "_host", "text", "n_chars"} <= set(got.columns) and {tuple(r) for r in got.select("_path", "_host").distinct().collect()} == {("mine", "mine")}
    assert got.count() == 40 and html.extract(pages.where("doc_id < 0")).count() == 0


LONG = " ".join(f"w{k % 9973}x{k % 101}" + "\n" * (k % 1000 == 0) + " token=abcdefgh0123456789" * (k % 250_000 == 9) for k in range(1_000_000)) + " a b c."


def _long_expected(name, row):
    """Whether a row of the long text is what another way finds."""
    text = LONG
    if name == "bpe":
        ids = Tokenizer.from_file(word_bpe()).encode(text, add_special_tokens=False).ids
        return np.frombuffer(row.token_ids, "<u4").tolist() == ids and row.decoded == Tokenizer.from_file(word_bpe()).decode(ids, skip_special_tokens=False)
    if name == "decontam":
        n = len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()))
        return (row.n_words, row.n_hit, row.item_ids) == (n, 3, ["i"])
    if name == "lm":
        return row.n_tokens == len(text.split()) + 1 and row.base_score < 0
    if name == "secrets":
        return row.text == text.replace("token=abcdefgh0123456789", "token=[SECRET]")
    if name == "media":
        data = text.encode()
        return row.payload == data + bytes(-len(data) % 64) and row.n_bytes == len(data)
    if name == "neardup":
        return row.text == text
    if name == "quality":
        return 0 <= row.score <= 1 and row.predicted == int(row.score >= quality.GOOD)
    if name == "token_files":
        ids = [*Tokenizer.from_file(word_bpe()).encode(text, add_special_tokens=False).ids, 2]
        return (row.n_tokens, row.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    if name == "resample":
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        return row.n_features == row.n_words == len(found)
    return row.licenses == []


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "link"])
def test_long_text(spark, name):
    docs = spark.createDataFrame([(0, LONG, "a"), (1, "short", "b")], "doc_id long, text string, source string").repartition(2)
    got = {r.doc_id: r for r in OPERATORS[name](docs).collect()}
    assert got.keys() == {0, 1} and _long_expected(name, got[0])
