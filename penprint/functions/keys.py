"""Deterministic pseudo-random values from a row's identity.

They stand in for row order and random draws: the same on every run, whatever the partitioning, and
after any executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = float(16**8)


def order_key(seed: int, *ids: str) -> Column:
    """A 32-digit hexadecimal key; sorting by it shuffles the rows."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))


def uniform(seed: int, step: str, *ids: str) -> Column:
    """A number in [0, 1) drawn for this row, seed and step."""
    digest = F.md5(
        F.concat_ws(":", F.lit(str(seed)), F.lit(step), *[F.col(i).cast("string") for i in ids])
    )
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(_SPAN)


def pick(items: tuple[str, ...] | list[str], draw: Column) -> Column:
    """The item a draw in [0, 1) falls on."""
    index = F.floor(draw * F.lit(len(items))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(i) for i in items]), index)
