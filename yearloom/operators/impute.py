"""Linear filling of gaps along each series, by row position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from yearloom.session import scratch_path
from yearloom.sources.wide import ordinal_block
from yearloom.spec import PANEL, PanelSpec

# Series with more cells than this are scanned in pieces by several tasks.
SERIES_LIMIT = 1_000_000


def _line(at: Column, near: dict[str, Column]) -> Column:
    """Value at position ``at`` on the line between the two nearest observations;
    with one neighbour only, its value; with none, NULL."""
    slope = F.try_divide(
        near["next_value"] - near["prev_value"], near["next_at"] - near["prev_at"]
    )
    between = slope * (at - near["prev_at"]) + near["prev_value"]
    return F.coalesce(between, near["prev_value"], near["next_value"])


def _nearest(at: Column, value: Column, window: WindowSpec, order: list) -> dict[str, Column]:
    """Position and value of the last observation up to a row and of the first
    one from it on.

    The latter looks back along the reversed order: a frame that ends at
    ``unboundedFollowing`` is evaluated from scratch for every row, which is
    quadratic in the length of a series; a second sort is not.
    """
    seen = F.when(value.isNotNull(), at)
    found = {}
    for side, spec in (("prev", window.orderBy(*order)), ("next", window.orderBy(F.desc("_at")))):
        frame = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found[f"{side}_at"] = F.last(seen, ignorenulls=True).over(frame)
        found[f"{side}_value"] = F.last(value, ignorenulls=True).over(frame)
    return found


def interpolate_linear(
    long: DataFrame, spec: PanelSpec = PANEL,
    series_limit: int = SERIES_LIMIT, hot: DataFrame | None = None,
) -> DataFrame:
    """Fill missing values of each series; leading and trailing gaps take the
    nearest observation, series without any stay missing, rows without a full
    key go.

    If (series, time) is unique, a series has at most one row per year column
    and one window does it; a repeated (series, time) without an ordinal is an
    error, as nothing orders the two.  With an ordinal a series may repeat without
    bound: those above ``series_limit`` cells (``hot``, found by a key-only count
    when not given, stored once) take the piecewise path, all others the window.
    A limit of 0 sends every series through the pieces.
    """
    rows = long.dropna(subset=spec.series)
    if spec.ordinal is None:
        return _fill_whole(rows, spec)
    if series_limit <= 0:
        return _fill_pieces(rows, spec)
    if hot is None:
        path = scratch_path(rows.sparkSession, "long-series")
        rows.groupBy(*spec.series).count().where(
            F.col("count") > series_limit).select(*spec.series).write.parquet(path)
        hot = rows.sparkSession.read.parquet(path)
    if hot.isEmpty():
        return _fill_whole(rows, spec)
    whole = _fill_whole(rows.join(hot, spec.series, "left_anti"), spec)
    pieces = _fill_pieces(rows.join(hot, spec.series, "left_semi"), spec)
    return whole.unionByName(pieces)


def _fill_whole(rows: DataFrame, spec: PanelSpec) -> DataFrame:
    series, order = Window.partitionBy(*spec.series), spec.ordering
    value, at = F.col(spec.value), F.col("_at")
    placed = rows.withColumn("_at", F.row_number().over(series.orderBy(*order)))
    filled = F.coalesce(value, _line(at, _nearest(at, value, series, order)))
    if spec.ordinal is None:
        repeated = F.lag(spec.time).over(series.orderBy(*order)) == F.col(spec.time)
        error = F.raise_error(F.lit("a series has several source rows: name an ordinal")).cast("double")
        filled = F.when(repeated, error).otherwise(filled)
    return placed.withColumn(spec.value, filled).select(*rows.columns)


def _fill_pieces(rows: DataFrame, spec: PanelSpec) -> DataFrame:
    """The same result for series of any size.

    A piece is one year of one block of source rows.  Each piece is scanned by
    itself; one summary row per piece (row count, first and last observation)
    is then scanned along the series and hands every piece what lies outside it.
    """
    piece = [*spec.series, spec.time, "_block"]
    value, at, start = F.col(spec.value), F.col("_at"), F.col("_start")
    inside, order = Window.partitionBy(*piece), [spec.ordinal]
    placed = (
        rows.withColumn("_block", ordinal_block(rows, spec.ordinal))
        .withColumn("_at", F.row_number().over(inside.orderBy(*order)).cast("long"))
    )
    seen = F.when(value.isNotNull(), at)
    summary = placed.groupBy(*piece).agg(
        F.count("*").alias("_n"),
        F.min(seen).alias("_first_at"), F.min_by(value, seen).alias("_first"),
        F.max(seen).alias("_last_at"), F.max_by(value, seen).alias("_last"),
    )
    along = Window.partitionBy(*spec.series)
    earlier = along.orderBy(spec.time, "_block").rowsBetween(Window.unboundedPreceding, -1)
    later = along.orderBy(F.desc("_start")).rowsBetween(Window.unboundedPreceding, -1)
    outside = summary.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    outside = outside.select(
        *piece, "_start",
        F.last(F.col("_last_at") + start, ignorenulls=True).over(earlier).alias("_before_at"),
        F.last("_last", ignorenulls=True).over(earlier).alias("_before"),
        F.last(F.col("_first_at") + start, ignorenulls=True).over(later).alias("_after_at"),
        F.last("_first", ignorenulls=True).over(later).alias("_after"),
    )
    joined = placed.withColumns({
        f"_{name}": c for name, c in _nearest(at, value, inside, order).items()
    }).join(outside, piece)
    near = {
        "prev_at": F.coalesce(F.col("_prev_at") + start, "_before_at"),
        "prev_value": F.coalesce("_prev_value", "_before"),
        "next_at": F.coalesce(F.col("_next_at") + start, "_after_at"),
        "next_value": F.coalesce("_next_value", "_after"),
    }
    filled = F.coalesce(value, _line(at + start, near))
    return joined.withColumn(spec.value, filled).select(*rows.columns)


def clean_long(filled: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Drop what stayed missing and what is negative, after filling: a negative
    value still shapes its neighbours."""
    return filled.dropna(subset=[spec.value]).where(F.col(spec.value) >= 0)
