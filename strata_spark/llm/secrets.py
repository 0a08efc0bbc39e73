"""Secret scans with ownership frequency over the whole corpus; DataFrame functions only.

Candidates are found by patterns. Each candidate's value is hashed, and the distinct repositories and owners
of each hash are counted over all rows: what several owners have is a widely copied example, what one owner
has looks live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, unused

#: Kinds in order, their patterns and the least length of what each keeps.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
BASE = ("assign", "access", "hex")
LEAST = 8
#: A place where one of the patterns may match; documents without one aren't looked at again.
ANY = r"""AKIA[A-Z0-9]{12}|[0-9a-f]{32}|(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
#: Words of values that documentation uses in place of credentials.
PLACEHOLDER = r"(?i)example|changeme|placeholder|your[_-]|xxxx|dummy|sample"
#: From so many distinct owners on, a value is a widely copied example.
MIN_OWNERS = 3


def _matches(rows: DataFrame, text: str, row: str, owner: str, repo: str, kind: str, pattern: str, group: int) -> DataFrame:
    """_row, kind, start, end (code points), value_start, value: from the text between matches, which split() gives."""
    pattern_, group_ = F.lit(pattern), F.lit(group)
    zipped = F.arrays_zip(
        F.transform(F.split(F.col(text), pattern, -1), F.length).alias("gap"),  # only lengths are shuffled, not texts
        F.transform(F.regexp_extract_all(F.col(text), pattern_, F.lit(0)), F.length).alias("whole"),
        F.regexp_extract_all(F.col(text), pattern_, group_).alias("value"),
    )
    up_to = Window.partitionBy("_row").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.select(F.col(row).alias("_row"), F.col(owner).alias("_owner"), F.col(repo).alias("_repo"), F.posexplode(zipped).alias("at", "m"))
    out = out.withColumn("end", F.sum(F.col("m.gap") + F.coalesce(F.col("m.whole"), F.lit(0))).over(up_to).cast("int"))
    out = out.where(F.col("m.whole").isNotNull()).select(
        "_row", "_owner", "_repo", F.lit(kind).alias("kind"), (F.col("end") - F.col("m.whole")).alias("start"), "end",
        (F.col("end") - F.length("m.value")).alias("value_start"), F.col("m.value").alias("value"),
    )
    return out.where(F.length("value") >= LEAST) if kind == "assign" else out


def scan(docs: DataFrame, text: str = "text", repo: str = "source", owner: Column | None = None, min_owners: int = MIN_OWNERS) -> DataFrame:
    """Adds secrets to docs: array of (start, kind_no, kind, end, value_start, value_hash, owners, repos, label, placeholder, mask_end), by start and kind.

    owner defaults to the repository's name up to the first slash. label is `example` where the value's hash
    has min_owners owners or more, else `live`; placeholder says whether the value has a word that documentation
    uses in place of credentials; mask_end is where the overlapping values end that this one is the first of, null for the others. Null and empty texts have no
    secrets; a null repository counts as one of its own; repeated rows count once for their owner; an empty
    table gives an empty table; a column of this name is replaced. Only documents with a candidate are staged
    and shuffled; a hash that many documents have is counted by partial sums.
    """
    owner = F.substring_index(F.col(repo), "/", 1) if owner is None else owner
    docs = docs.drop("secrets")
    has = F.coalesce(F.col(text).rlike(ANY), F.lit(False))
    kind = "array<struct<start:int,kind_no:int,kind:string,end:int,value_start:int,value_hash:string,owners:bigint,repos:bigint,label:string,placeholder:boolean,mask_end:int>>"
    row, of_repo, of_owner = (unused(docs, c) for c in ("row", "repo", "owner"))
    rows = staged(
        docs.where(has).withColumns({row: F.monotonically_increasing_id(), of_repo: F.coalesce(F.col(repo).cast("string"), F.lit("")), of_owner: F.coalesce(owner.cast("string"), F.lit(""))}),
        "secret-rows",
    )
    at = rows, text, row, of_owner, of_repo
    found = _matches(*at, "assign", ASSIGN, 2).unionAll(_matches(*at, "access", ACCESS, 0)).unionAll(_matches(*at, "hex", HEX, 0))
    kind_no = F.when(F.col("kind") == "assign", 0).when(F.col("kind") == "access", 1).otherwise(2)
    found = staged(found.withColumns({"value_hash": F.sha2("value", 256), "placeholder": F.col("value").rlike(PLACEHOLDER), "kind_no": kind_no}).drop("value"), "secret-candidates")
    spread = found.groupBy("value_hash", "_owner", "_repo").agg(F.lit(1).alias("one")).groupBy("value_hash").agg(F.countDistinct("_owner").alias("owners"), F.countDistinct("_repo").alias("repos"))
    spread = staged(spread, "secret-owners")  # written, so that the join with a hash that very many documents have can be split
    label = F.when(F.col("owners") >= min_owners, "example").otherwise("live")
    fields = ["start", "kind_no", "kind", "end", "value_start", "value_hash", "owners", "repos", "label", "placeholder", "mask_end"]
    in_order = Window.partitionBy("_row").orderBy("value_start", F.desc("end"), "label", "kind_no")
    first = F.col("value_start") >= F.coalesce(F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.max("end").over(Window.partitionBy("_row", "island"))
    labelled = found.join(spread, "value_hash").withColumn("label", label).withColumn("first", first)
    labelled = labelled.withColumn("island", F.sum(F.col("first").cast("int")).over(in_order)).withColumn("mask_end", F.when(F.col("first"), rest))
    by_row = labelled.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct(*fields))).cast(kind).alias("secrets")).withColumnRenamed("_row", row)
    empty = F.array().cast(kind)
    with_any = rows.join(by_row, row, "left").withColumn("secrets", F.coalesce("secrets", empty)).drop(row, of_repo, of_owner)
    return docs.where(~has).withColumn("secrets", empty).unionByName(with_any)


def described(scanned: DataFrame) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and spans of scanned documents; live and example values are spans too."""
    base = F.transform("secrets", lambda s: F.struct(s.start.alias("start"), s.kind_no.alias("no"), s.kind.alias("kind"), s.end.alias("end")))
    values = F.transform("secrets", lambda s: F.struct(s.value_start.alias("start"), F.when(s.label == "live", 3).otherwise(4).alias("no"), s.label.alias("kind"), s.end.alias("end")))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    of = lambda kind: lambda s: s.kind == kind
    n = lambda test: F.size(F.filter("secrets", test)).cast("long")
    return scanned.select(
        "doc_id",
        *[n(of(k)).alias(f"n_{k}") for k in BASE],
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.array_sort(F.array_distinct(F.concat(base, values)))).alias("spans"),
        n(lambda s: s.label == "live").alias("n_live"),
        n(lambda s: s.label == "example").alias("n_example"),
        n(lambda s: s.placeholder).alias("n_placeholder"),
    )


#: Texts are cut into blocks of so many code points to be put together anew.
MASK_BLOCK = 256


def masked(scanned: DataFrame, text: str = "text") -> DataFrame:
    """scanned with each value in the text replaced by [SECRET], or [EXAMPLE SECRET] if it is a copied example, and without secrets.

    Where values overlap, the first to start takes the others into its replacement. The text is cut into blocks once; what lies
    between values comes from the blocks at its ends and those between, so the time grows with the text.
    """
    size = MASK_BLOCK
    block = lambda d, at: F.coalesce(F.get(d.blocks, at), F.lit(""))

    def between(d, a, b):
        """Code points a to b, b excluded."""
        low, high = F.floor(a / size).cast("int"), F.floor(b / size).cast("int")
        across = F.concat(F.substring(block(d, low), a % size + 1, F.lit(size)), F.array_join(F.slice(d.blocks, low + 2, F.greatest(high - low - 1, F.lit(0))), ""), F.substring(block(d, high), F.lit(1), b % size))
        return F.when(low == high, F.substring(block(d, low), a % size + 1, b - a)).otherwise(across)

    def whole(d):
        n = F.size(d.masks)
        piece = lambda k: F.concat(
            between(d, F.when(k > 0, F.get(d.masks, k - 1).b).otherwise(0), F.when(k < n, F.get(d.masks, k).a).otherwise(d.size)),
            F.when(k == n, "").when(F.get(d.masks, k).live, "[SECRET]").otherwise("[EXAMPLE SECRET]"),
        )
        return F.array_join(F.transform(F.sequence(F.lit(0), n), piece), "")

    firsts = F.filter("secrets", lambda s: s.mask_end.isNotNull())
    masks = F.array_sort(F.transform(firsts, lambda s: F.struct(s.value_start.alias("a"), s.mask_end.alias("b"), (s.label == "live").alias("live"))))
    blocks = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    once = F.array(F.struct(blocks.alias("blocks"), masks.alias("masks"), F.length(text).alias("size")))  # a lambda's variable is worked out once
    return scanned.withColumn(text, F.when(F.size("secrets") > 0, F.get(F.transform(once, whole), 0)).otherwise(F.col(text))).drop("secrets")
