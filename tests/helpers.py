"""Small panels and comparisons for the tests."""

import math
import random

IMPORT = "Import Quantity"
SUPPLY = "Food supply quantity (kg/capita/yr)"
CORE_SCHEMA = "Area string, Item string, Year int, Import_Quantity double, Food_Supply double, Dependency_Pct double"


def rows(df):
    """Rows as plain tuples, sorted, floats at 9 digits."""
    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
        return v

    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)


def wide(spark, series, years, ordinal=False):
    """``series``: (area, item, element, values[, src_row])."""
    names = ["Area string", "Item string", "Element string"]
    if ordinal:
        names.append("src_row bigint")
    data = [
        (*s[:3], *([s[4]] if ordinal else []), *[None if v is None else float(v) for v in s[3]])
        for s in series
    ]
    return spark.createDataFrame(data, ", ".join(names + [f"Y{y} double" for y in years]))


def random_series(seed, keys, years, max_repeats=1, hot=None):
    """Random wide rows; ``hot`` is (key index, repeats) for one frequent key."""
    rng = random.Random(seed)
    found, src = [], 0
    for k in range(keys):
        for element in (IMPORT, SUPPLY):
            repeats = rng.randint(1, max_repeats)
            if hot and hot[0] == k:
                repeats = hot[1]
            density = rng.choice([0.05, 0.3, 0.7, 1.0])
            for _ in range(repeats):
                values = [
                    float(rng.randint(-3, 40)) if rng.random() < density else None for _ in years
                ]
                found.append((f"a{k % 4}", f"i{k}", element, values, src))
                src += 1
    rng.shuffle(found)
    return found
