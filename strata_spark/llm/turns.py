"""What the operators on conversations share: their rows in order, and streams over them in bounded memory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A piece of a conversation holds so many rows and characters at most (one longer row is a piece of its own).
PIECE_ROWS, PIECE_CHARS = 4096, 1 << 16
ORDER = ("conv_id", "turn", "role", "digest")


def digest(text) -> F.Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def in_order(rows: DataFrame, *after: str) -> DataFrame:
    """rows dealt by ranges of conversation, turn (nulls first), role and the text's digest, and sorted by these and `after`.

    A conversation of any size spreads over partitions; equal rows meet in one.
    """
    return rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER, *after)


def by_conversation(pieces: DataFrame, *order) -> DataFrame:
    """pieces of each conversation in one partition, in an order; they are streamed, never gathered."""
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def rows_of(batches, *columns: str):
    """Rows of Arrow batches as tuples, a slice of some MB at a time."""
    for batch in batches:
        step = max(1, batch.num_rows * (4 << 20) // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


def batched(rows, schema, most: int = 2000, most_chars: int = 8 << 20, size=lambda row: 0):
    """Arrow batches of rows (tuples in the schema's order), of so many rows or about so many characters."""
    import pyarrow as pa

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += size(row)
        if len(held) >= most or chars >= most_chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def mapped(df: DataFrame, ddl: str, make, columns: tuple[str, ...], size=lambda row: 0) -> DataFrame:
    """df.mapInArrow over rows: make(iterator of tuples of columns) yields tuples of ddl; conv_id keeps df's type."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType([df.schema["conv_id"]] + StructType.fromDDL(ddl).fields)
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: batched(make(rows_of(batches, *columns)), arrow, size=size), schema)
