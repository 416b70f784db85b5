"""Column expressions: lenient parsing, missing tokens, rounding, clipping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: texts a default CSV reader of the data takes as missing ----
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# ------------------------------------------------------------------------------

# Spark's own parser also takes "1d" and "1.5f"; only plain decimals count here.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(MISSING_TOKENS), text)


def nan_to_null(number: Column) -> Column:
    """What is not finite is missing, as in text."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def to_number(text: Column) -> Column:
    """Lenient parse: text that is not a finite plain number becomes NULL."""
    parsed = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(F.abs(parsed) < F.lit(float("inf")), parsed)


def round_to(number: Column, digits: int) -> Column:
    """Round half to even after scaling, the way array libraries do.

    ``round`` goes through the decimal text of a double and is not portable at
    ties; this form gives the same bits in Spark, numpy and SQL engines.
    """
    scale = F.lit(10.0**digits)
    return F.rint(number * scale) / scale


def clip_upper(number: Column, bound: Column) -> Column:
    """``least`` would turn NULL into the bound, so NULL is kept explicitly."""
    return F.when(number.isNotNull(), F.least(number, bound))


def ratio_pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100
