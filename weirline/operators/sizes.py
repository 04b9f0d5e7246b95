"""Whether a table is small enough to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes up to which a lookup table is broadcast; beyond it the join is shuffled.
BROADCAST_BYTES = 32 << 20
#: Bytes of a row besides its texts, at most.
ROW_BYTES, FIELD_BYTES = 32, 16


def payload(df: DataFrame) -> int:
    """Bytes that the rows of a table take, from one pass that adds up the lengths of its texts."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema if not isinstance(f.dataType, T.NumericType)]
    row = sum(texts, F.lit(ROW_BYTES + FIELD_BYTES * len(df.columns)))
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The table, marked for a broadcast if its bytes are within the limit."""
    return F.broadcast(df) if payload(df) <= (BROADCAST_BYTES if limit is None else limit) else df
