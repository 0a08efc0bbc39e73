"""Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw_hash(seed: int, year: Column, household: Column) -> Column:
    """The order of a household in its stratum's draw; depends on nothing but these three."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), year.cast("string"), household.cast("string")).cast("binary"))


def hash01(digest: Column) -> Column:
    """A draw hash as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def age_bin(age: Column, edges: tuple[int, ...] = (16, 31, 51, 110), labels: tuple[str, ...] = ("young", "middle", "old")) -> Column:
    """Bins closed on the left; null outside all of them."""
    out = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges[:-1], edges[1:], labels, strict=True))):
        out = F.when((age >= low) & (age < high), label).otherwise(out)
    return out


def zero_filled(code: Column, width: int = 9) -> Column:
    """Zeros in front up to a width; longer codes stay as they are."""
    text = code.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def row_text(*columns: Column) -> Column:
    """One text for a row's values, equal only if all of them are equal: each with its length, null as N."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.lit("V"), F.length(t).cast("string"), F.lit(":"), t), F.lit("N")) for t in texts])


def digest_sums(row: Column, of: Column | None = None) -> tuple[Column, Column, Column]:
    """Aggregates that tell a multiset of rows, in any order and partitioning: how many, and sums of two 60-bit parts of their texts' MD5.

    of restricts them to rows where it is true.
    """
    digest = F.md5(row.cast("binary"))
    parts = [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(28,0)") for at in (1, 16)]
    if of is not None:
        parts = [F.when(of, p) for p in parts]
    n = F.count("*") if of is None else F.count_if(of)
    return n, *[F.coalesce(F.sum(p), F.lit(0)).cast("decimal(38,0)") for p in parts]


def digest_text(n: int, first: int, second: int) -> str:
    """The sums of digest_sums() as one text."""
    return f"{int(n)}-{int(first):x}-{int(second):x}"
