"""Repeatable pseudo-random draws, equal for equal inputs whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DRAWS_PER_DIGEST = 4
_SCALE = float(2**32)


class Draws:
    """Numbered U(0, 1) draws of a row: each md5 digest of (seed, row key) yields four."""

    def __init__(self, seed: int, *row_key: Column):
        self._column: str | None = None
        self._parts = [F.lit(str(seed)), *[c.cast("string") for c in row_key]]

    def _digest(self, number: int) -> Column:
        return F.md5(F.concat_ws("|", *self._parts, F.lit(str(number))))

    def attach(self, rows: DataFrame, draws: int, column: str = "digests") -> DataFrame:
        """Adds the digests for that many draws as a column, each computed once per row."""
        count = -(-draws // _DRAWS_PER_DIGEST)
        made = rows.withColumn(column, F.array(*[self._digest(n) for n in range(count)]))
        self._column = column
        return made

    def unit(self, index: int) -> Column:
        digest, slot = divmod(index, _DRAWS_PER_DIGEST)
        text = self._digest(digest) if self._column is None else F.get(F.col(self._column), digest)
        return F.conv(F.substring(text, 1 + 8 * slot, 8), 16, 10).cast("double") / F.lit(_SCALE)

    def uniform(self, index: int, low: float, high: float) -> Column:
        return F.lit(low) + self.unit(index) * F.lit(high - low)
