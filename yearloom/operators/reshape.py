"""Wide to long, lenient numbers, long to one column per measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearloom.functions.columns import nan_to_null, to_number
from yearloom.sources.wide import year_columns
from yearloom.spec import IMPORTS, PANEL, SUPPLY, PanelSpec


def year_number(name: Column) -> Column:
    return F.replace(name, F.lit("Y"), F.lit("")).cast("int")


def number(df: DataFrame, name: str) -> Column:
    """A column as double with every kind of missing value as NULL."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return to_number(F.col(name))
    return nan_to_null(F.col(name).cast("double"))


def unpivot_years(wide: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """One row per series and year; empty cells stay, they are to be filled."""
    ids = [*spec.series] if spec.ordinal is None else [*spec.series, spec.ordinal]
    long = wide.unpivot(ids, year_columns(wide.columns), spec.time, spec.value)
    return long.withColumns({
        spec.time: year_number(F.col(spec.time)),
        spec.value: number(long, spec.value),
    })


def measure_of(element: str) -> str | None:
    """The measure an element text stands for, by what it contains."""
    if "Import" in element:
        return IMPORTS
    return SUPPLY if "Food supply" in element or "Food Supply" in element else None


def measure_name(kind: Column) -> Column:
    """`measure_of` of a column."""
    return (
        F.when(kind.contains("Import"), IMPORTS)
        .when(kind.contains("Food supply") | kind.contains("Food Supply"), SUPPLY)
    )


def pivot_measures(long: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Mean per (series, time) and measure, one column each, NULL where absent.

    The measures are known, so no job looks for pivot values, and the averages
    combine on the map side: a key that holds most rows costs one partial row
    per task.
    """
    measure, value = measure_name(F.col(spec.kind)), F.col(spec.value)
    rows = long.dropna(subset=[*spec.keys])
    return (
        rows.groupBy(*spec.keys, spec.time)
        .agg(
            F.avg(F.when(measure == IMPORTS, value)).alias(IMPORTS),
            F.avg(F.when(measure == SUPPLY, value)).alias(SUPPLY),
        )
        .where(F.coalesce(IMPORTS, SUPPLY).isNotNull())
    )
