"""Exact order statistics and quantiles that never gather a whole column.

``percentile`` keeps every distinct value of a group in one task.  Here each wanted rank
is bracketed instead: a pass asks ``percentile_approx`` for two values around every rank
still sought, of all columns at once, then counts exactly what lies below them, and keeps
the open intervals between.  A pass is two jobs with map-side combining and shrinks the
intervals by three to four orders of magnitude; runs of one repeated value end a search at
once, so hot values cannot stall it.  What is left of all intervals, a bounded number of
values, is gathered by one last job.  The path is the same for every size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values of an interval that may be gathered.
GATHERED = 10_000
ACCURACY = 10_000


@dataclass
class _Search:
    """The interval that holds a rank, how many values it has and the rank among them."""

    column: str
    left: int
    count: int
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def inside(self) -> Column:
        value = F.col(self.column)
        kept = value.isNotNull()
        if self.low is not None:
            kept &= value > F.lit(self.low)
        if self.high is not None:
            kept &= value < F.lit(self.high)
        return F.when(kept, value)

    def narrow(self, low, high, below: int, upto_low: int, below_high: int, upto_high: int) -> None:
        if self.left < below:
            self.high, self.count = low, below
        elif self.left < upto_low:
            self.found = low
        elif self.left < below_high:
            self.low, self.high = low, high
            self.left, self.count = self.left - upto_low, below_high - upto_low
        elif self.left < upto_high:
            self.found = high
        else:
            self.low, self.left, self.count = high, self.left - upto_high, self.count - upto_high


def order_statistics(
    df: DataFrame, wanted: list[tuple[str, int]], totals: dict[str, int],
    gathered: int = GATHERED, accuracy: int = ACCURACY,
) -> list[float]:
    """The values at 0-based ranks, ``(column, rank)`` each, among the non-null values."""
    searches = []
    for column, rank in wanted:
        if not 0 <= rank < totals[column]:
            raise ValueError(f"rank {rank} outside 0..{totals[column] - 1}")
        searches.append(_Search(column, rank, totals[column]))
    rows = df.select(*dict.fromkeys(c for c, _ in wanted))
    margin = 2.0 / accuracy
    while open_ := [s for s in searches if s.found is None and s.count > gathered]:
        edges = rows.agg(*[
            F.percentile_approx(s.inside(), F.array(*map(F.lit, (
                max(0.0, s.left / s.count - margin), min(1.0, s.left / s.count + margin)))), F.lit(accuracy)).alias(f"e{i}")
            for i, s in enumerate(open_)
        ]).first()
        counts = rows.agg(*[
            F.count_if(condition).alias(f"n{i}_{k}")
            for i, s in enumerate(open_)
            for k, condition in enumerate((
                s.inside() < F.lit(edges[i][0]), s.inside() <= F.lit(edges[i][0]),
                s.inside() < F.lit(edges[i][1]), s.inside() <= F.lit(edges[i][1])))
        ]).first()
        for i, s in enumerate(open_):
            s.narrow(*edges[i], *counts[4 * i:4 * i + 4])
    if rest := [s for s in searches if s.found is None]:
        picked = rows.agg(*[
            F.get(F.sort_array(F.collect_list(s.inside())), F.lit(s.left)).alias(f"v{i}") for i, s in enumerate(rest)
        ]).first()
        for s, value in zip(rest, picked, strict=True):
            s.found = value
    return [s.found for s in searches]


def exact_quantiles(
    df: DataFrame, wanted: dict[str, list[float]], gathered: int = GATHERED
) -> dict[str, list[float | None]]:
    """Linear-interpolated exact quantiles, ``{column: [value per probability]}``."""
    totals = df.agg(*[F.count(c).alias(c) for c in wanted]).first().asDict()
    places = {(c, p): (totals[c] - 1) * p for c, ps in wanted.items() if totals[c] for p in ps}
    ranks = sorted({(c, r) for (c, _), at in places.items() for r in (math.floor(at), math.ceil(at))})
    values = dict(zip(ranks, order_statistics(df, ranks, totals, gathered), strict=True)) if ranks else {}

    def between(column: str, at: float) -> float:
        lower, upper = values[column, math.floor(at)], values[column, math.ceil(at)]
        return lower + (upper - lower) * (at - math.floor(at))

    return {c: [between(c, places[c, p]) if totals[c] else None for p in ps] for c, ps in wanted.items()}
