"""Raw wide rows to core and feature panels with one exchange of compact rows.

Unpivoting first would shuffle and sort one row per series and year with the keys
repeated in each.  Here a series travels as one row with its years in an array;
filling, averaging, the ratio and the lags are array expressions on it, and rows
per year appear only at the end.  Rows are dropped after that, not by conditions
on the arrays: the optimizer would push such a condition down and evaluate the
whole chain once more inside it.  Same results as the long operators
(`reshape`, `impute`, `panel`, `features`), which remain for long inputs and take
the keys too often repeated for an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.functions.columns import clip_upper, ratio_pct
from yearloom.operators import impute, panel, reshape
from yearloom.session import scratch_path
from yearloom.sources.wide import year_columns
from yearloom.spec import (
    ELEMENTS, IMPORTS, LAGS, PANEL, RATIO, RATIO_CAP, ROLLING, SUPPLY, PanelSpec,
)

# A key with more source rows than this leaves the array path.
ROWS_PER_KEY = 1_000


def _years(wide: DataFrame) -> list[tuple[int, str]]:
    """Year columns in year order."""
    return sorted((int(c.replace("Y", "")), c) for c in year_columns(wide.columns))


def _points(cells: Column) -> Column:
    indexed = F.transform(cells, lambda v, i: F.struct(i.alias("i"), v.alias("v")))
    return F.filter(indexed, lambda p: p["v"].isNotNull())


def _filled(cells: Column, points: Column) -> Column:
    """Each observation yields the cells from itself up to the next one, so the
    work is linear in the length of the array."""
    first, count = points[0], F.size(points)

    def stretch(p: Column, m: Column) -> Column:
        q = F.get(points, m + 1)
        slope = (q["v"] - p["v"]) / (q["i"] - p["i"])
        return F.when(
            q.isNotNull(),
            F.transform(
                F.sequence(p["i"], q["i"] - 1),
                lambda x: slope * (x - p["i"]) + p["v"],
            ),
        ).otherwise(F.array_repeat(p["v"], F.size(cells) - p["i"]))

    return F.when(
        (count == 0) | (count == F.size(cells)), cells
    ).otherwise(
        F.concat(F.array_repeat(first["v"], first["i"]), F.flatten(F.transform(points, stretch)))
    )


def _interleaved(rows: Column, years: int) -> Column:
    """Cells of all source rows of a series, by year, then by source row."""
    return F.when(F.size(rows) == 1, rows[0]["_cells"]).otherwise(
        F.flatten(F.transform(
            F.sequence(F.lit(0), F.lit(years - 1)),
            lambda y: F.transform(rows, lambda r: F.get(r["_cells"], y)),
        ))
    )


def _yearly_mean(parts: list[tuple[Column, Column]], years: int) -> Column:
    """Per year the mean of the non-negative cells of all parts (filled cells and
    source rows), NULL where there is none."""
    def mean(y: Column) -> Column:
        cells = [F.slice(filled, y * F.size(rows) + 1, F.size(rows)) for filled, rows in parts]
        kept = F.filter(F.concat(*cells), lambda v: v >= 0)
        total = F.aggregate(kept, F.lit(0.0), lambda a, v: a + v)
        return F.try_divide(total, F.size(kept))

    several = F.transform(F.sequence(F.lit(0), F.lit(years - 1)), mean)
    if len(parts) > 1:
        return several
    filled, rows = parts[0]
    return F.when(F.size(rows) == 1, F.transform(filled, lambda v: F.when(v >= 0, v))).otherwise(several)


def frequent_keys(wide: DataFrame, spec: PanelSpec, rows_per_key: int) -> DataFrame:
    """Keys with too many source rows; reads key columns only.  Stored, so that
    counting happens once however often the list is used."""
    spark = wide.sparkSession
    path = scratch_path(spark, "frequent-keys")
    (
        wide.dropna(subset=spec.series).groupBy(*spec.keys).count()
        .where(F.col("count") > rows_per_key).select(*spec.keys)
    ).write.parquet(path)
    return spark.read.parquet(path)


def _unique_rows(wide: DataFrame, spec: PanelSpec, elements: tuple[str, ...]) -> DataFrame:
    """The one source row of each element per key, as a list of one.  A second one
    is an error, not a longer list: without an ordinal nothing says how to order
    the two.

    Rows move once, as they are; the cells are gathered as plain doubles, which a
    hash aggregate can do without sorting, and become arrays afterwards.
    """
    years = [c for _, c in _years(wide)]
    kind = F.col(spec.kind)
    numbers = wide.dropna(subset=spec.series).select(
        *spec.series, *[reshape.number(wide, c).alias(c) for c in years])
    found = numbers.repartition(*spec.keys).groupBy(*spec.keys).agg(
        *[F.max(F.when(kind == e, F.col(c))).alias(f"_{i}{c}") for i, e in enumerate(elements) for c in years],
        *[F.count_if(kind == e).alias(f"_{i}n") for i, e in enumerate(elements)],
    )
    repeated = F.raise_error(F.lit("a series has several source rows: name an ordinal"))
    empty = F.array().cast("array<struct<_cells: array<double>>>")
    return found.select(*spec.keys, *[
        F.when(F.col(f"_{i}n") > 1, repeated.cast("array<struct<_cells: array<double>>>"))
        .when(F.col(f"_{i}n") == 1, F.array(F.struct(F.array(*[F.col(f"_{i}{c}") for c in years]).alias("_cells"))))
        .otherwise(empty).alias(f"_r{i}")
        for i in range(len(elements))
    ])


def _listed_rows(wide: DataFrame, spec: PanelSpec, elements: tuple[str, ...]) -> DataFrame:
    """All source rows of each element per key, in source order; the caller has
    taken out keys with too many."""
    packed = wide.dropna(subset=spec.series).select(
        *spec.series, F.struct(
            F.col(spec.ordinal).alias("_rank"),
            F.array(*[reshape.number(wide, c) for _, c in _years(wide)]).alias("_cells"),
        ).alias("_row"))
    return packed.groupBy(*spec.keys).agg(*[
        F.array_sort(F.collect_list(F.when(F.col(spec.kind) == e, F.col("_row")))).alias(f"_r{i}")
        for i, e in enumerate(elements)
    ])


def _histories(wide: DataFrame, spec: PanelSpec, elements: tuple[str, ...]) -> DataFrame:
    """One row per key with ``history``: the core rows of that key in year order.

    Gaps are filled element by element; elements that stand for the same measure
    meet in its yearly mean.
    """
    years = [year for year, _ in _years(wide)]
    sides = {m: [i for i, e in enumerate(elements) if reshape.measure_of(e) == m] for m in (IMPORTS, SUPPLY)}
    gather = _unique_rows if spec.ordinal is None else _listed_rows
    together = gather(wide, spec, elements)
    for chosen in sides.values():
        sizes = [F.size(f"_r{i}") for i in chosen] or [F.lit(0)]
        together = together.where(sum(sizes[1:], sizes[0]) > 0)
    span, used = len(years), [i for chosen in sides.values() for i in chosen]
    cells = together.withColumns({f"_c{i}": _interleaved(F.col(f"_r{i}"), span) for i in used})
    points = cells.withColumns({f"_p{i}": _points(F.col(f"_c{i}")) for i in used})
    filled = points.withColumns({f"_f{i}": _filled(F.col(f"_c{i}"), F.col(f"_p{i}")) for i in used})

    def mean(measure: str) -> Column:
        parts = [(F.col(f"_f{i}"), F.col(f"_r{i}")) for i in sides[measure]]
        return _yearly_mean(parts, span) if parts else F.array_repeat(F.lit(None).cast("double"), span)

    means = filled.select(
        *spec.keys,
        F.arrays_zip(
            F.array(*map(F.lit, years)).alias("t"), mean(IMPORTS).alias("a"), mean(SUPPLY).alias("b"),
        ).alias("_z"),
    )
    kept = F.filter("_z", lambda z: z["a"].isNotNull() & (z["b"] > 0))
    return means.select(
        *spec.keys,
        F.transform(kept, lambda z: F.struct(
            z["t"].alias(spec.time), z["a"].alias(IMPORTS), z["b"].alias(SUPPLY),
            clip_upper(ratio_pct(z["a"], z["b"]), F.lit(RATIO_CAP)).alias(RATIO),
        )).alias("history"),
    )


def _long_core(wide: DataFrame, spec: PanelSpec) -> DataFrame:
    long = reshape.unpivot_years(wide, spec)
    filled = impute.clean_long(impute.interpolate_linear(long, spec), spec)
    return panel.core_panel(reshape.pivot_measures(filled, spec), spec)


def histories(
    wide: DataFrame, spec: PanelSpec = PANEL,
    elements: tuple[str, ...] = ELEMENTS, rows_per_key: int = ROWS_PER_KEY,
) -> DataFrame:
    """Core rows of every key as ``history: array<struct<time, imports, supply,
    ratio>>``, in year order and one entry per year.

    Rows are numbered by the spec's ordinal or the scan's own.  Keys repeated in
    more than ``rows_per_key`` source rows, found by one count of the keys, are
    built by the long operators and gathered after the per-year mean, when they
    too have at most one row per year; both ways give the same rows.
    """
    spec = spec.numbered(wide.columns)
    rows = wide.where(F.col(spec.kind).isin(*elements))
    if spec.ordinal is None:
        return _histories(rows, spec, elements)
    many = frequent_keys(rows, spec, rows_per_key)
    if many.isEmpty():
        return _histories(rows, spec, elements)
    keys = list(spec.keys)
    usual = _histories(rows.join(many, keys, "left_anti"), spec, elements)
    core = _long_core(rows.join(many, keys, "left_semi"), spec)
    entry = F.struct(spec.time, IMPORTS, SUPPLY, RATIO)
    large = core.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("history"))
    return usual.unionByName(large)


def core_rows(hist: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    return hist.select(*spec.keys, F.inline_outer("history")).where(F.col(spec.time).isNotNull())


def lagged_rows(hist: DataFrame, spec: PanelSpec = PANEL, warm: int = 3) -> DataFrame:
    """Core rows with positional lags and shifted rolling mean, warm-up dropped."""
    h = F.col("history")

    def back(i: Column, k: int, name: str) -> Column:
        return F.get(h, i - k)[name]

    def row(x: Column, i: Column) -> Column:
        imports = [back(i, k, IMPORTS) for k in (3, 2, 1)]
        return F.struct(
            *[x[c].alias(c) for c in (spec.time, IMPORTS, SUPPLY, RATIO)],
            *[back(i, k, c).alias(name) for name, (c, k) in LAGS.items()],
            ((imports[0] + imports[1] + imports[2]) / 3).alias(ROLLING),
        )

    lagged = hist.select(
        *spec.keys, F.slice(F.transform(h, row), warm + 1, F.size("history")).alias("_l")
    )
    return lagged.select(*spec.keys, F.inline_outer("_l")).where(F.col(spec.time).isNotNull())
