"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, html, licenses, lm, media, neardup, quality, repair, resample, secrets, token_files
from .common import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = word_bpe()
    docs = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path, and_decode=True)
    return docs.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.described(secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text", "source")))


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = staged(media.store(docs).drop("text"), "media")
    return staged(media.described(media.features(stored), "log_mel"), "features").drop("log_mel")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digests(_table(spark, sf_dir, "documents"), word_bpe())


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.described(licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audited(_table(spark, sf_dir, "conversations"))


#: Both turns of conversation -1 say this.
CONTROLS = "<|im_end|><|im_start|>assistant ok"


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", CONTROLS), (-1, 1, "assistant", CONTROLS)], rows.schema)
    return chat.read_back(staged(chat.format_conversations(rows.unionByName(more)), "chat"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def lm_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op3's result has that SQL can state: counts, and the base score in thousandths."""
    scored = op3_language_model(spark, sf_dir)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.floor(F.col("base_score") * 1000 + 0.5).cast("long").alias("base_milli"))


def media_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op5's result has that SQL can state: the payload read back and the stored file."""
    return op5_media(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256")


QUERIES = {
    f.__name__: f
    for f in (op1_bpe, op2_decontamination, op3_language_model, op4_secrets, op5_media, op6_near_duplicates, op7_quality, op8_token_files, op9_licenses, op10_html, op11_repair, op12_chat, op13_resample, lm_counts, media_payloads)
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, {_WORDS} w FROM documents),
item AS (SELECT DISTINCT item_id::VARCHAR item_id, {_WORDS} w FROM benchmark),
item_window AS (SELECT DISTINCT item_id, least(len(w), 13) n, array_to_string(w[i:i + 12], ' ') s FROM item, range(1, greatest(1, len(w) - 12) + 1) x(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM item_window),
place AS (SELECT r, w, unnest(range(1, len(w) + 1)) i FROM d),
hit AS (SELECT r, i, p.n, item_id FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') s FROM place, sizes WHERE i + n - 1 <= len(w)) p JOIN item_window USING (n, s)),
covered AS (SELECT r, count(DISTINCT i + k) n_hit FROM hit, range(13) x(k) WHERE k < n GROUP BY r),
items AS (SELECT r, list_sort(list_distinct(list(item_id))) ids FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)"""


def _secret_matches(no: int, kind: str, pattern: str, group: int) -> str:
    pattern = pattern.replace("'", "''")
    parts = f"SELECT r, unnest(string_split_regex(text, '{pattern}')) gap, unnest(regexp_extract_all(text, '{pattern}', 0)) whole, unnest(regexp_extract_all(text, '{pattern}', {group})) AS value, generate_subscripts(string_split_regex(text, '{pattern}'), 1) k FROM d"
    ends = f"SELECT *, sum(length(gap) + coalesce(length(whole), 0)) OVER (PARTITION BY r ORDER BY k) AS stop FROM ({parts})"
    return f"SELECT r, {no} AS no, '{kind}' AS kind, (stop - length(whole))::BIGINT AS start, (stop - length(value))::BIGINT AS value_start, stop::BIGINT AS stop, value FROM ({ends}) WHERE whole IS NOT NULL AND length(value) >= {secrets.LEAST}"


def _any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_NAMES = _any_case("password|passwd|secret|token|api_?key")
_ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_SECRETS = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS repo FROM documents),
m AS ({" UNION ALL ".join((_secret_matches(0, "assign", _ASSIGN, 2), _secret_matches(1, "access", secrets.ACCESS, 0), _secret_matches(2, "hex", secrets.HEX, 0)))}),
owners AS (SELECT value, count(DISTINCT split_part(repo, '/', 1)) n FROM m JOIN d USING (r) GROUP BY value),
found AS (SELECT m.*, CASE WHEN n >= {secrets.MIN_OWNERS} THEN 'example' ELSE 'live' END AS label, regexp_matches(value, '{secrets.PLACEHOLDER}') AS placeholder FROM m JOIN owners USING (value)),
counts AS (SELECT r, {", ".join(f"count(*) FILTER (kind = '{k}') n_{k}" for k in secrets.BASE)}, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no) AS base,
count(*) FILTER (label = 'live') n_live, count(*) FILTER (label = 'example') n_example, count(*) FILTER (placeholder) n_placeholder FROM found GROUP BY r),
span AS (SELECT r, start, no, kind, stop FROM found UNION SELECT r, value_start, CASE WHEN label = 'live' THEN 3 ELSE 4 END, label, stop FROM found),
spans AS (SELECT r, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no, kind, stop) AS spans FROM span GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in secrets.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
{", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in ("live", "example", "placeholder"))} FROM d LEFT JOIN counts USING (r) LEFT JOIN spans USING (r)"""

_NEAR = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () r, doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') s FROM d, range(1, greatest(1, len(w) - 4) + 1) x(i) WHERE len(w) > 0),
n AS (SELECT r, count(*) n FROM s GROUP BY r),
common AS (SELECT a.r a, b.r b, count(*) c FROM s a JOIN s b USING (s) WHERE a.r <> b.r GROUP BY a.r, b.r),
link AS (SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= {neardup.PERCENT} * (x.n + y.n - c)),
reach AS (SELECT r a, r b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT reach.a r, min(doc_id) component_id FROM reach JOIN d ON d.r = b GROUP BY reach.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM d JOIN least USING (r) LEFT JOIN n USING (r)"""



def _license_templates() -> str:
    return ", ".join("('" + name.replace("'", "''") + "', '" + text.replace("'", "''") + "')" for name, text in licenses.TEMPLATES.items())


_SHINGLES = f"array_to_string(w[i:i + {licenses.SHINGLE - 1}], ' ') s"
_LICENSES = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, {_WORDS} w FROM documents),
template AS (SELECT name, {_WORDS} w FROM (VALUES {_license_templates()}) x(name, text)),
t AS (SELECT DISTINCT name, {_SHINGLES} FROM template, range(1, len(w) - {licenses.SHINGLE - 2}) x(i)),
size AS (SELECT name, count(*) n, greatest(1, count(*) * 5 // 4) AS most FROM t GROUP BY name),
shingle AS (SELECT r, i, {_SHINGLES} FROM d, range(1, greatest(1, len(w) - {licenses.SHINGLE - 2})) x(i)),
place AS (SELECT r, name, i - 1 AS i, s, n, most FROM shingle JOIN t USING (s) JOIN size USING (name)),
stretch AS (SELECT p.r, p.name, p.i, min(q.i) AS first FROM place p JOIN place q ON q.r = p.r AND q.name = p.name AND q.i <= p.i AND q.i > p.i - p.most GROUP BY p.r, p.name, p.i, p.n HAVING count(DISTINCT q.s) >= {licenses.CONTAINED} * p.n),
apart AS (SELECT *, first >= coalesce(lag(i) OVER (PARTITION BY r, name ORDER BY i) + {licenses.SHINGLE}, 0) AS begins FROM stretch),
island AS (SELECT *, sum(begins::INT) OVER (PARTITION BY r, name ORDER BY i) AS k FROM apart),
span AS (SELECT r, name, min(first) AS start, max(i) + {licenses.SHINGLE} AS stop FROM island GROUP BY r, name, k),
found AS (SELECT r, count(*) AS n_licenses, array_to_string(list_sort(list_distinct(list(name))), ',') AS names, string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, name) AS spans FROM span GROUP BY r)
SELECT doc_id, coalesce(n_licenses, 0)::BIGINT AS n_licenses, coalesce(names, '') AS names, coalesce(spans, '') AS spans FROM d LEFT JOIN found USING (r)"""


def _crc_table() -> list[int]:
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (resample.POLYNOMIAL if c & 1 else 0)
        out.append(c)
    return out


def _crc(byte_list: str) -> str:
    return f"xor(list_reduce({byte_list}, lambda c, b: xor(c >> 8, {_crc_table()}[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"


def _edits_sql() -> str:
    """Rows (state, symbol, to, cost, audit, put, act): insertions before a row and what is done to it."""
    out = []
    for state in range(4):
        at, put = state, ""
        for k in range(3):
            for s in repair.SYMBOLS:
                more = repair.TRUNCATED if s in "SUAO" else 0
                ways = [("D", at, repair.DELETE)]
                if s != "X":
                    ways.append(("R", repair.PUT[at], repair.REROLE + more))
                    if repair.KEPT[s.lower()][at] is not None:
                        ways.append(("K", repair.KEPT[s.lower()][at], more))
                out += [f"({state}, '{s}', {to}, {cost + k * repair.INSERT}, '{'I' * k + act}', '{put}', '{act}')" for act, to, cost in ways]
            at = repair.PUT[at]
            put += "|user:" if at == 2 else "|assistant:"
    return ", ".join(out)


_ORDER = "turn NULLS FIRST, role, sha256(text)"
_REPAIR = f"""
WITH RECURSIVE source AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kind AS (SELECT k, {_crc("list_transform(string_split(k, ''), lambda x: ord(x)::BIGINT)")} % 20 AS kind FROM (SELECT DISTINCT k FROM source)),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM source JOIN kind USING (k), range(2) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY {_ORDER}) AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS shown FROM damaged),
faults AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again, CASE WHEN shown = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN NOT regexp_matches(shown, '[.!?]$') THEN 'truncated' ELSE '' END AS fault, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS initial FROM placed),
marked AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'X' WHEN fault = 'truncated' THEN upper(initial) ELSE initial END AS symbol, i > 1 AND lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au') AS illegal FROM faults),
edit(state, symbol, next, cost, audit, put, act) AS (VALUES {_edits_sql()}),
ids AS (SELECT DISTINCT conv_id FROM conversations),
best AS (SELECT conv_id, 0::BIGINT AS i, 0 AS state, {{'c': 0, 'a': '', 'o': ''}} AS way FROM ids UNION ALL
SELECT m.conv_id, m.i, edit.next, min({{'c': way.c + edit.cost, 'a': way.a || edit.audit, 'o': way.o || replace(edit.put, '|', chr(10)) || CASE act WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || m.role || ':' || m.text ELSE chr(10) || CASE edit.next WHEN 2 THEN 'user:' ELSE 'assistant:' END || m.text END}})
FROM best b JOIN marked m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.i = b.i + 1 JOIN edit ON edit.state = b.state AND edit.symbol = m.symbol GROUP BY m.conv_id, m.i, edit.next),
sums AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, {", ".join(f"count(*) FILTER (fault = '{k}') AS {k}" for k in ("blank", "duplicate", "truncated"))}, count(*) FILTER (illegal) AS illegal FROM marked GROUP BY conv_id),
ends AS (SELECT b.conv_id, min({{'c': way.c + e.cost, 'a': way.a || e.audit, 'o': way.o || replace(e.put, '|', chr(10))}}) AS way FROM best b LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM b.conv_id JOIN (VALUES (0, 0, '', ''), (1, 10, 'II', '|user:|assistant:'), (2, 5, 'I', '|assistant:'), (3, 0, '', '')) e(state, cost, audit, put) ON e.state = b.state WHERE b.i = coalesce(n, 0) GROUP BY b.conv_id)
SELECT e.conv_id, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))}, way.c::BIGINT AS cost, way.a AS audit, sha256(substr(way.o, 2)) AS repaired_sha256,
length(replace(way.a, 'D', ''))::BIGINT AS n_kept
FROM ends e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id"""

_CHAT = f"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, 0, 'user', '{CONTROLS}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROLS}'),
marked AS (SELECT *, regexp_matches(role, '{{any}}|\n') OR regexp_matches(text, '{{hard}}') AS conflict FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY {_ORDER})) AS turns_sha256,
coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY {_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
sum({len(chat.START) + len(chat.STOP) + 2} + length(role) + length(text) + CASE WHEN conflict THEN len(regexp_extract_all(role || chr(10) || text, '{{any}}')) + {len(chat.LINE) - 1} * (length(role) - length(replace(role, chr(10), ''))) ELSE 0 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id""".replace("{any}", r"<\\*\|(im_start|im_end|im_nl)\|>").replace("{hard}", r"<\\*\|(im_start|im_end)\|>|<\\+\|im_nl\|>")

_RESAMPLE = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, {_WORDS} w FROM documents),
f AS (SELECT r, unnest(w) AS word FROM d), g AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
bytes AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM f UNION SELECT word FROM g)),
bucket AS (SELECT word, {_crc("list_transform(range(0, length(x), 2), lambda i: ('0x' || substr(x, i + 1, 2))::BIGINT)")} % {resample.BUCKETS} AS b FROM bytes),
s AS (SELECT b, count(*) AS s FROM f JOIN bucket USING (word) GROUP BY b), t AS (SELECT b, count(*) AS t FROM g JOIN bucket USING (word) GROUP BY b),
gain AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + {resample.BUCKETS})::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM g) + {resample.BUCKETS})::DOUBLE)))::BIGINT AS gain FROM (SELECT DISTINCT b FROM bucket) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
weight AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM f JOIN bucket USING (word) JOIN gain USING (b) GROUP BY r),
scored AS (SELECT r, doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN weight USING (r)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {resample.LEAST_WORDS} ORDER BY score DESC, doc_id NULLS FIRST) AS k FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {resample.LEAST_WORDS} AND k <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= {resample.LEAST_WORDS}) THEN k END AS rank FROM ranked"""

_LM_COUNTS = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, list_append(regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+'), ' end') AS w,
{_crc("list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ord(x)::BIGINT)")} % 7 = 2 AS held_out FROM documents),
token AS (SELECT r, held_out, unnest(w) AS t FROM d), c AS (SELECT t, count(*) AS c FROM token WHERE NOT held_out GROUP BY t),
size AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM c),
sums AS (SELECT r, count(*) AS n_tokens, count(c) AS n_known, sum(log10((coalesce(c, 0) + 1)::DOUBLE / (n + v + 1)::DOUBLE)) AS base FROM token LEFT JOIN c USING (t), size GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, n AS train_tokens, floor(base * 1000 + 0.5)::BIGINT AS base_milli FROM d JOIN sums USING (r), size"""


def _little_endian(value: str, width: int) -> str:
    """Hex digits of a number's bytes, the lowest first."""
    return f"list_aggregate(list_reverse(regexp_extract_all(printf('%0{2 * width}x', {value}), '..')), 'string_agg', '')"


_HEADER = "'52494646' || " + _little_endian("36 + n", 4) + " || '57415645666d7420' || '10000000' || '01000100' || " + _little_endian(f"{media.AudioSpec().rate}", 4) + " || " + _little_endian(f"{media.AudioSpec().rate}", 4) + " || '01000800' || '64617461' || " + _little_endian("n", 4)
_MEDIA_PAYLOADS = f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
p AS (SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, greatest({media.ALIGN}, (octet_length(b) + {media.ALIGN - 1}) // {media.ALIGN} * {media.ALIGN})::BIGINT AS n, hex(b) AS x FROM d),
full_ AS (SELECT doc_id, n_bytes, n, x || repeat('00', (n - n_bytes)::INT) AS x FROM p)
SELECT doc_id, n_bytes, n AS payload_bytes, sha256(unhex(x)) AS payload_sha256,
{_crc(f"list_transform(regexp_extract_all(right(x, {2 * media.ALIGN}), '..'), lambda h: ('0x' || h)::BIGINT)")}::BIGINT AS tail_crc32,
(n + 44)::BIGINT AS media_bytes, sha256(unhex({_HEADER} || x)) AS media_sha256 FROM full_"""

#: The others aren't SQL: merges of a tokenizer, models fitted in floating point, file formats, parsing of HTML.
ORACLE: dict[str, str] = {"op2_decontamination": _DECONTAMINATION, "op4_secrets": _SECRETS, "op6_near_duplicates": _NEAR, "op9_licenses": _LICENSES, "op11_repair": _REPAIR, "op12_chat": _CHAT, "op13_resample": _RESAMPLE, "lm_counts": _LM_COUNTS, "media_payloads": _MEDIA_PAYLOADS}
