"""Seeded, partition-independent random draws.

A draw is the first 32 bits of ``md5('seed|gen|slot|tag')`` as an unsigned
integer.  It depends only on its arguments, so a population is the same for
any partitioning, after any task retry, and in the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 1 << 32


def draw(*parts: Column | str | int) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    cols = [c.cast("string") for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 8), 16, 10).cast("long")


def draw_sql(*parts: str) -> str:
    """The same draw as DuckDB SQL; ``parts`` are SQL expressions."""
    inner = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5(concat_ws('|', {inner})), 1, 8)) AS BIGINT)"


def rate_threshold(rate: float) -> int:
    """Integer cut so that ``draw < cut`` has probability ``rate``."""
    return int(rate * TWO_32)
