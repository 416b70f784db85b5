"""SQL counterparts of the registered queries, for an independent engine."""

from __future__ import annotations

from yearloom.operators import trees
from yearloom.plans.catalog import AHEAD, FIXED_TREES, FORMULA_SETS, FORMULAS, SECOND_IMPORT
from yearloom.spec import ELEMENTS, ENGINEERED, FEATURES, R2_CAP, RF_PARAMS, RIDGE_PARAMS, XGB_PARAMS

CORE_VALUES = ["Import_Quantity", "Food_Supply", "Dependency_Pct"]


def _r(expr: str, digits: int) -> str:
    scale = f"1{'0' * digits}.0::DOUBLE"
    return f"round_even(({expr}) * {scale}, 0) / {scale}"


def _rounded(columns: list[str], digits: int = 4) -> str:
    return ", ".join(f"{_r(c, digits)} AS {c}" for c in columns)


# The years of the data, found by the SQL itself; the last of them.
_LAST = "(SELECT max(yr) FROM span)"

_TRADE = f"""
span AS (SELECT DISTINCT year(o_orderdate) AS yr FROM orders WHERE o_orderdate IS NOT NULL),
trade AS (
  SELECT n_name AS Area, p_brand || '/' || p_type AS Item,
         CASE l_returnflag WHEN 'N' THEN '{ELEMENTS[0]}' WHEN 'R' THEN '{ELEMENTS[1]}'
              ELSE 'Production' END AS Element,
         year(o_orderdate) AS yr, l_linestatus, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey)"""


def _wide(signed: bool, repeated: bool, other: str = "") -> str:
    """The series, and the grid of their cells."""
    q = "CASE WHEN l_linestatus = 'F' THEN -l_quantity ELSE l_quantity END" if signed else "l_quantity"
    row = "CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END::BIGINT" if repeated else "0::BIGINT"
    kept = ", ".join(f"'{e}'" for e in (*ELEMENTS, *([other] if other else [])))
    named = f"CASE WHEN Element = 'Production' THEN '{other}' ELSE Element END" if other else "Element"
    return f"""
cells AS (
  SELECT Area, Item, {named} AS Element, {row} AS src_row, yr, sum({q}) AS Value FROM trade GROUP BY 1, 2, 3, 4, 5),
wide AS (SELECT DISTINCT Area, Item, Element, src_row FROM cells),
selected AS (SELECT * FROM wide WHERE Element IN ({kept}))"""


_LONG = """
long AS (
  SELECT s.Area, s.Item, s.Element, s.src_row, CAST(g.yr AS INTEGER) AS Year, c.Value
  FROM selected s CROSS JOIN span g
  LEFT JOIN cells c ON c.Area = s.Area AND c.Item = s.Item AND c.Element = s.Element
    AND c.src_row = s.src_row AND c.yr = g.yr)"""

_FILLED = """
placed AS (
  SELECT *, row_number() OVER (PARTITION BY Area, Item, Element ORDER BY Year, src_row) AS p FROM long),
near AS (
  SELECT *,
    last_value(CASE WHEN Value IS NOT NULL THEN p END IGNORE NULLS) OVER up AS pp,
    last_value(Value IGNORE NULLS) OVER up AS pv,
    first_value(CASE WHEN Value IS NOT NULL THEN p END IGNORE NULLS) OVER down AS np,
    first_value(Value IGNORE NULLS) OVER down AS nv
  FROM placed
  WINDOW up AS (PARTITION BY Area, Item, Element ORDER BY p
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY Area, Item, Element ORDER BY p
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (
  SELECT Area, Item, Element, src_row, Year,
    coalesce(Value, (nv - pv) / nullif(np - pp, 0) * (p - pp) + pv, pv, nv) AS Value FROM near),
clean AS (SELECT * FROM filled WHERE Value IS NOT NULL AND Value >= 0)"""

_CORE = """
measures AS (
  SELECT Area, Item, Year,
    avg(CASE WHEN Element LIKE '%Import%' THEN Value END) AS Import_Quantity,
    avg(CASE WHEN Element NOT LIKE '%Import%' THEN Value END) AS Food_Supply
  FROM clean GROUP BY 1, 2, 3),
core AS (
  SELECT *, least(Import_Quantity / Food_Supply * 100, 200.0::DOUBLE) AS Dependency_Pct
  FROM measures WHERE Import_Quantity IS NOT NULL AND Food_Supply > 0)"""

_ENGINEERED = """
engineered AS (
  SELECT *,
    lag(Import_Quantity, 1) OVER w AS Import_Lag1, lag(Import_Quantity, 2) OVER w AS Import_Lag2,
    lag(Import_Quantity, 3) OVER w AS Import_Lag3,
    lag(Dependency_Pct, 1) OVER w AS Dep_Lag1, lag(Dependency_Pct, 2) OVER w AS Dep_Lag2,
    avg(Import_Quantity) OVER (PARTITION BY Area, Item ORDER BY Year
                               ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS Import_RollingMean3,
    lag(Food_Supply, 1) OVER w AS FoodSupply_Lag1
  FROM core WINDOW w AS (PARTITION BY Area, Item ORDER BY Year))"""

_CODES = """
areas AS (SELECT Area, row_number() OVER (ORDER BY Area) - 1 AS Area_enc
          FROM (SELECT DISTINCT Area FROM core)),
items AS (SELECT Item, row_number() OVER (ORDER BY Item) - 1 AS Item_enc
          FROM (SELECT DISTINCT Item FROM core))"""

_FEATURES = f"""
features AS (
  SELECT engineered.*, CAST(Area_enc AS INTEGER) AS Area_enc, CAST(Item_enc AS INTEGER) AS Item_enc
  FROM engineered JOIN areas USING (Area) JOIN items USING (Item)
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ENGINEERED)})"""

_SPLIT = """
drawn AS (
  SELECT *, ('0x' || substr(md5('42|' || length(Area) || ':' || Area || '|' || length(Item) || ':' || Item || '|' || length(Year::VARCHAR) || ':' || Year), 1, 15))::BIGINT AS draw
  FROM features),
assigned AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY draw) <= ceil(0.2::DOUBLE * count(*) OVER ())
                 THEN 'test' ELSE 'train' END AS split
  FROM drawn)"""

_NAIVE = f"""
naive AS (
  SELECT 'last_import' AS model, 'import' AS target, 0 AS position, split, Import_Quantity AS y, Import_Lag1 AS p FROM assigned
  UNION ALL SELECT 'last_dep', 'dep', 1, split, Dependency_Pct, Dep_Lag1 FROM assigned
  UNION ALL SELECT 'step_import', 'import', 2, split, Import_Quantity, 2 * Import_Lag1 - Import_Lag2 FROM assigned
  UNION ALL SELECT 'step_dep', 'dep', 3, split, Dependency_Pct, 2 * Dep_Lag1 - Dep_Lag2 FROM assigned
  UNION ALL SELECT 'mean_import', 'import', 4, split, Import_Quantity, Import_RollingMean3 FROM assigned
  UNION ALL SELECT 'mean_dep', 'dep', 5, split, Dependency_Pct, (Dep_Lag1 + Dep_Lag2) / 2 FROM assigned),
metrics AS (
  SELECT model, target, position,
    {_r("1 - sum(CASE WHEN split = 'train' THEN (y - p) * (y - p) END) / (var_pop(CASE WHEN split = 'train' THEN y END) * count(CASE WHEN split = 'train' THEN y END))", 6)} AS r2_train,
    {_r("1 - sum(CASE WHEN split = 'test' THEN (y - p) * (y - p) END) / (var_pop(CASE WHEN split = 'test' THEN y END) * count(CASE WHEN split = 'test' THEN y END))", 6)} AS r2_test,
    {_r("avg(CASE WHEN split = 'test' THEN abs(y - p) END)", 4)} AS mae,
    {_r("sqrt(avg(CASE WHEN split = 'test' THEN (y - p) * (y - p) END))", 4)} AS rmse,
    {_r("avg(CASE WHEN split = 'test' AND abs(y) > 1e-8 THEN abs((y - p) / y) END) * 100", 2)} AS mape
  FROM naive GROUP BY model, target, position)"""


def _linear(part: tuple[float, list[float]]) -> str:
    total = f"{part[0]}::DOUBLE"
    for weight, name in zip(part[1], FEATURES, strict=True):
        total = f"({total} + {weight}::DOUBLE * {name})"
    return total


def _state(year: str) -> str:
    """One row per series: values of the three years before ``year``."""
    at = {
        f"{s}{k}": f"max(CASE WHEN Year = {year} - {k} THEN {c} END)"
        for s, c, ks in (("i", "Import_Quantity", (1, 2, 3)), ("d", "Dependency_Pct", (1, 2)),
                         ("f", "Food_Supply", (1,)))
        for k in ks
    }
    known = ", ".join(f"coalesce({e}, 0.0::DOUBLE) AS {n}" for n, e in at.items() if n != "f1")
    return f"""
state AS (
  SELECT Area, Item, {known}, coalesce({at['f1']}, max_by(Food_Supply, Year), 0.0::DOUBLE) AS f1
  FROM core GROUP BY Area, Item),
coded AS (SELECT state.*, Area_enc, Item_enc FROM state JOIN areas USING (Area) JOIN items USING (Item))"""


def _formula(formula) -> tuple[str, str]:
    return _linear(formula.imports), _linear(formula.ratio)


def _steps(start: str, count: int, formula: tuple[str, str], name: str = "") -> str:
    """Each round turns one state row per series into the next year's by the formulas of imports and ratio."""
    imp, dep = formula
    shown = """Area_enc, Item_enc, Year, i1 AS Import_Lag1, i2 AS Import_Lag2, i3 AS Import_Lag3,
      d1 AS Dep_Lag1, d2 AS Dep_Lag2, (i1 + i2 + i3) / 3 AS Import_RollingMean3, f1 AS FoodSupply_Lag1"""
    return f"""
steps{name} AS (
  SELECT Area, Item, Area_enc, Item_enc, ({start} - 1)::INTEGER AS Year,
         i1, i2, i3, d1, d2, f1 FROM coded
  UNION ALL
  SELECT Area, Item, Area_enc, Item_enc, Year,
         {_r(imp, 2)} AS i1, Import_Lag1, Import_Lag2, {_r(dep, 2)} AS d1, Dep_Lag1, FoodSupply_Lag1
  FROM (SELECT Area, Item, {shown.replace('Year,', 'Year + 1 AS Year,', 1)} FROM steps{name}
        WHERE Year < {start} + {count} - 1)),
future{name} AS (SELECT Area, Item, Year, i1 AS imp, d1 AS dep FROM steps{name} WHERE Year >= {start})"""


_PLAIN = [_TRADE, _wide(False, False), _LONG, _FILLED, _CORE]
_BOTH = [_TRADE, _wide(True, True), _LONG, _FILLED, _CORE]
_CODED = [*_PLAIN, _CODES]
_MODEL = [*_PLAIN, _ENGINEERED, _CODES, _FEATURES]
_DRAWN = [*_MODEL, _SPLIT]
_SCORED = [*_DRAWN, _NAIVE]


def _with(parts: list[str], query: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{','.join(parts)}\n{query}"


_KEYS = "Area, Item, Year"
_CORE_ROWS = f"SELECT {_KEYS}, {_rounded(CORE_VALUES)} FROM core"
_LONG_ROWS = f"SELECT Area, Item, Element, Year, {_rounded(['Value'])}"
_FEATURE_ROWS = f"SELECT {_KEYS}, {_rounded(CORE_VALUES + ENGINEERED)}, Area_enc, Item_enc FROM features"
_REPEATED = [_TRADE, _wide(False, True), _LONG, _FILLED]


def _hist(column: str, cap: str) -> str:
    return f"""
, vals AS (SELECT least({column}, {cap}) AS x FROM core),
b AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 50 AS w FROM vals),
binned AS (SELECT CASE WHEN w = 0 THEN 0 ELSE least(floor((x - lo) / w), 49) END::INTEGER AS bin, lo, hi, w
           FROM vals, b)
SELECT bin, {_r('any_value(lo) + bin * any_value(w)', 4)} AS lo,
       {_r('CASE WHEN bin = 49 THEN any_value(hi) ELSE any_value(lo) + (bin + 1) * any_value(w) END', 4)} AS hi,
       count(*) AS row_count
FROM binned GROUP BY bin"""


def _tail(rows: int) -> str:
    return f"""
SELECT {_KEYS}, {_rounded(['Import_Quantity', 'Dependency_Pct'], 2)}
FROM (SELECT *, row_number() OVER (PARTITION BY Area, Item ORDER BY Year DESC) AS r FROM core)
WHERE r <= {rows}"""


def _score_counts(model: str) -> str:
    """Rows and label sums of both targets by split."""
    return " UNION ALL ".join(
        f"SELECT '{model}_{target}' AS model, '{target}' AS target, split, count(*) AS row_count, "
        f"{_r(f'sum({column})', 2)} AS label_sum FROM assigned GROUP BY split"
        for target, column in (("import", "Import_Quantity"), ("dep", "Dependency_Pct")))


_CALENDAR = f"""
, pairs AS (SELECT DISTINCT Area, Item FROM wide)
SELECT pairs.Area, pairs.Item, ({_LAST} - 1)::INTEGER AS Year,
  {_r('coalesce(i1, 0)', 4)} AS Import_Lag1, {_r('coalesce(i2, 0)', 4)} AS Import_Lag2,
  {_r('coalesce(i3, 0)', 4)} AS Import_Lag3, {_r('coalesce(d1, 0)', 4)} AS Dep_Lag1,
  {_r('coalesce(d2, 0)', 4)} AS Dep_Lag2,
  {_r('(coalesce(i1, 0) + coalesce(i2, 0) + coalesce(i3, 0)) / 3', 4)} AS Import_RollingMean3,
  {_r('coalesce(f1, 0)', 4)} AS FoodSupply_Lag1
FROM pairs LEFT JOIN state USING (Area, Item)"""

_CALENDAR_PANEL = f"""
, latest AS (SELECT Area, Item, max_by(Food_Supply, Year) AS fs FROM core GROUP BY 1, 2)
SELECT c.Area, c.Item, c.Year,
  {_r('coalesce(a.Import_Quantity, 0)', 4)} AS Import_Lag1,
  {_r('coalesce(b.Import_Quantity, 0)', 4)} AS Import_Lag2,
  {_r('coalesce(d.Import_Quantity, 0)', 4)} AS Import_Lag3,
  {_r('coalesce(a.Dependency_Pct, 0)', 4)} AS Dep_Lag1, {_r('coalesce(b.Dependency_Pct, 0)', 4)} AS Dep_Lag2,
  {_r('(coalesce(a.Import_Quantity, 0) + coalesce(b.Import_Quantity, 0) + coalesce(d.Import_Quantity, 0)) / 3', 4)}
    AS Import_RollingMean3,
  {_r('coalesce(a.Food_Supply, l.fs, 0)', 4)} AS FoodSupply_Lag1
FROM core c
LEFT JOIN core a ON a.Area = c.Area AND a.Item = c.Item AND a.Year = c.Year - 1
LEFT JOIN core b ON b.Area = c.Area AND b.Item = c.Item AND b.Year = c.Year - 2
LEFT JOIN core d ON d.Area = c.Area AND d.Item = c.Item AND d.Year = c.Year - 3
JOIN latest l ON l.Area = c.Area AND l.Item = c.Item"""

_LAGS = [c for c in ENGINEERED if c != "Import_RollingMean3"]
_GRAM_COLUMNS = [*FEATURES, "Import_Quantity"]
_GRAM = " UNION ALL ".join(
    f"SELECT '{a}' AS left_col, '{b}' AS right_col, {_r(f'covar_pop({a}::DOUBLE, {b}::DOUBLE)', 3)} "
    "AS cross_product FROM assigned WHERE split = 'train'"
    for i, a in enumerate(_GRAM_COLUMNS) for b in _GRAM_COLUMNS[i:]
)

def _slopes() -> str:
    """Slopes of both targets on each feature alone, and their ranked shares."""
    named = {"Area_enc": "length(Area)", "Item_enc": "length(Item)"}
    one = " UNION ALL ".join(
        f"SELECT 'slope_{t}' AS model, {i} AS position, '{f}' AS feature, coalesce("
        f"covar_pop({named.get(f, f)}::DOUBLE, {y}::DOUBLE) / nullif(var_pop({named.get(f, f)}::DOUBLE), 0), 0) AS size "
        "FROM assigned WHERE split = 'train'"
        for t, y in (("import", "Import_Quantity"), ("dep", "Dependency_Pct")) for i, f in enumerate(FEATURES))
    return f"""
slopes AS ({one}),
shares AS (
  SELECT model, position, feature, {_r('abs(size) / CASE WHEN total = 0 THEN 1 ELSE total END', 4)} AS importance
  FROM (SELECT *, sum(abs(size)) OVER (PARTITION BY model) AS total FROM slopes))"""


_CELLS = _with([_PLAIN[0], _PLAIN[1]], """
SELECT Area, Item, Element, string_agg('Y' || g.yr || '=' || coalesce(Value::BIGINT::VARCHAR, ''), ',' ORDER BY g.yr) AS cells
FROM wide CROSS JOIN span g LEFT JOIN cells USING (Area, Item, Element, yr)
GROUP BY 1, 2, 3""")

_FIRST = f"({_LAST} + 1)"
_AHEAD = [*_CODED, _state(_FIRST)]
_REQUESTED = [*_CODED, f"""{_state(_FIRST).split("coded AS")[0]}
coded AS (
  SELECT p.Area, p.Item, {', '.join(f'coalesce({c}, 0.0::DOUBLE) AS {c}' for c in ('i1', 'i2', 'i3', 'd1', 'd2', 'f1'))},
    Area_enc, Item_enc
  FROM (SELECT DISTINCT Area, Item FROM wide) p JOIN areas USING (Area) JOIN items USING (Item)
  LEFT JOIN state USING (Area, Item))"""]


_TARGETS = [("import", "Import_Quantity"), ("dep", "Dependency_Pct")]


def _ridge() -> str:
    """Weights of both targets: centred products, scaled to a diagonal of ones, eliminated column by column."""
    columns = [*FEATURES, *[c for _, c in _TARGETS]]
    n, wide = len(FEATURES), len(columns)
    product = lambda i, j: f"p{min(i, j)}_{max(i, j)}"
    entries = ", ".join(f"sum(x{i} * x{j}) AS {product(i, j)}" for i in range(n) for j in range(i, wide))
    rows = " UNION ALL ".join(
        f"SELECT {i} AS i, [" + ", ".join(
            f"({product(i, j)} + {RIDGE_PARAMS['alpha'] if i == j else 0.0}::DOUBLE) * s{i}" + (f" * s{j}" if j < n else "")
            for j in range(wide)) + "] AS r FROM products, scales"
        for i in range(n))
    steps = ",".join(f"""
g{k + 1} AS MATERIALIZED (
  SELECT g.i, CASE WHEN g.i = {k} THEN list_transform(q.r, lambda x: x / q.r[{k + 1}])
    ELSE list_transform(range(1, {wide + 1}), lambda j: g.r[j] - g.r[{k + 1}] / q.r[{k + 1}] * q.r[j]) END AS r
  FROM g{k} g, (SELECT r FROM g{k} WHERE i = {k}) q)""" for k in range(n))
    fits = ",".join(f"""
weights_{t} AS MATERIALIZED (
  SELECT {', '.join(f'max(CASE WHEN i = {i} THEN r[{n + k + 1}] END) * any_value(s{i}) AS w{i}' for i in range(n))} FROM g{n}, scales),
fit_{t} AS MATERIALIZED (
  SELECT m{n + k} - ({' + '.join(f'm{i} * w{i}' for i in range(n))}) AS b, weights_{t}.* FROM weights_{t}, mom)"""
                    for k, (t, _) in enumerate(_TARGETS))
    return f"""
mom AS MATERIALIZED (
  SELECT {', '.join(f'avg({c}) AS m{i}' for i, c in enumerate(columns))} FROM assigned WHERE split = 'train'),
centred AS (SELECT {', '.join(f'{c} - m{i} AS x{i}' for i, c in enumerate(columns))} FROM assigned, mom WHERE split = 'train'),
products AS MATERIALIZED (SELECT {entries} FROM centred),
scales AS MATERIALIZED (
  SELECT {', '.join(f"1 / sqrt({product(i, i)} + {RIDGE_PARAMS['alpha']}::DOUBLE) AS s{i}" for i in range(n))} FROM products),
g0 AS MATERIALIZED ({rows}),{steps},{fits}"""


def _fitted(target: str) -> str:
    total = f"(SELECT b FROM fit_{target})"
    for i, name in enumerate(FEATURES):
        total = f"({total} + (SELECT w{i} FROM fit_{target}) * {name})"
    return total


_RIDGE = [*_DRAWN, _ridge()]
_RIDGE_SCORED = [*_RIDGE, "\nscored AS (" + " UNION ALL ".join(
    f"SELECT Area, Item, Year, split, 'ridge_{t}' AS model, '{t}' AS target, {c} AS y, {_fitted(t)} AS p FROM assigned"
    for t, c in _TARGETS) + ")"]

_METRICS = _NAIVE.split("metrics AS (")[1].replace("position,", "", 1).replace("FROM naive", "FROM scored").replace(
    ", position)", ")")


def _conditions(nested) -> str:
    if not isinstance(nested, tuple):
        return f"{nested}::DOUBLE"
    return f"CASE WHEN {nested[0]} < {nested[1]} THEN {_conditions(nested[2])} ELSE {_conditions(nested[3])} END"


def _tree_sum(target: str) -> str:
    return "(0.0::DOUBLE + " + " + ".join(_conditions(t) for t in FIXED_TREES[target]) + ")"


def _tree_nodes() -> str:
    """Rows and label sums of every node of the fixed trees."""
    def nodes(part, node=1, path="true"):
        yield node, part, path
        if isinstance(part, tuple):
            yield from nodes(part[2], 2 * node, f"{path} AND {part[0]} < {part[1]}")
            yield from nodes(part[3], 2 * node + 1, f"{path} AND {part[0]} >= {part[1]}")

    stats = " UNION ALL ".join(
        f"SELECT '{t}' AS target, {k} AS tree, {node} AS node, "
        f"{FEATURES.index(part[0]) if isinstance(part, tuple) else -1} AS position, coalesce(sum({c}), 0) AS s, count(*) AS n "
        f"FROM assigned WHERE split = 'train' AND {path}"
        for t, c in _TARGETS for k, tree in enumerate(FIXED_TREES[t]) for node, part, path in nodes(tree))
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(FEATURES))
    return f"""
stats AS ({stats}),
kinds(kind, penalty) AS (VALUES ('forest', 0), ('boosted', 1)),
scored AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE s * s / (n + penalty) END AS score FROM stats, kinds),
gains AS (
  SELECT p.kind, p.target, p.tree, p.position, l.score + r.score - p.score AS gain
  FROM scored p JOIN scored l ON (l.kind, l.target, l.tree, l.node) = (p.kind, p.target, p.tree, 2 * p.node)
  JOIN scored r ON (r.kind, r.target, r.tree, r.node) = (p.kind, p.target, p.tree, 2 * p.node + 1)),
found AS (
  SELECT kind, target, position, CASE WHEN kind = 'forest' THEN sum(gain / whole) ELSE avg(gain) END AS size
  FROM (SELECT *, sum(gain) OVER (PARTITION BY kind, target, tree) AS whole FROM gains) GROUP BY 1, 2, 3),
sizes AS (
  SELECT kind || '_' || target AS model, position, feature, coalesce(size, 0) AS size
  FROM (SELECT DISTINCT kind, target FROM found) CROSS JOIN (VALUES {names}) f(position, feature)
  LEFT JOIN found USING (kind, target, position)),
shares AS (
  SELECT model, position, feature, {_r('abs(size) / sum(abs(size)) OVER (PARTITION BY model)', 4)} AS importance FROM sizes)"""


_BITS = "length(bin({}::BIGINT))"


def _first_split() -> str:
    """Root splits of the first boosted trees: grid values, cuts between parts of like size, gains of all cuts."""
    seed, part = XGB_PARAMS["random_state"], XGB_PARAMS["colsample_bytree"]
    values = " UNION ALL ".join(f"SELECT {i} AS f, {c}::DOUBLE AS x FROM train" for i, c in enumerate(FEATURES))
    largest = [f"(SELECT floor(max(abs({c}))) FROM train)" for _, c in _TARGETS]
    bits = [f"(least(28, 57 - {_BITS.format('(SELECT count(*) FROM train)')}) - {_BITS.format(m)})" for m in largest]
    fixed = f"pow(2::DOUBLE, least({', '.join(bits)}))"
    found = []
    for k, (t, c) in enumerate(_TARGETS):
        own = f"pow(2::DOUBLE, {bits[k]})"
        base = f"(SELECT sum(round_even({c} * {own}, 0)::HUGEINT)::DOUBLE / count(*) / {own} FROM train)"
        features = trees.drawn_features(seed, c, 1, len(FEATURES), part)
        rows = " UNION ALL ".join(f"SELECT {i} AS f, {FEATURES[i]}::DOUBLE AS x, wanted FROM lacking_{t}" for i in features)
        found.append(f"""
lacking_{t} AS MATERIALIZED (
  SELECT *, round_even(({c} - {base}) * {fixed}, 0)::BIGINT AS wanted FROM train
  WHERE (d * {trees.factor('round', seed, c, 1)}) % {trees.MODULUS} / {trees.MODULUS}::DOUBLE < {XGB_PARAMS['subsample']}),
sides_{t} AS (
  SELECT f, edge, sum(CASE WHEN x < edge THEN wanted ELSE 0 END)::DOUBLE AS sl, sum(wanted)::DOUBLE AS s,
    count(*) FILTER (x < edge) AS nl, count(*) AS n
  FROM ({rows}) JOIN edges USING (f) GROUP BY 1, 2),
best_{t} AS (
  SELECT 'xgb_{t}' AS model, f, edge AS threshold, n,
    (sl * sl / (nl + 1) + (s - sl) * (s - sl) / (n - nl + 1) - s * s / (n + 1)) / ({fixed} * {fixed}) AS gain
  FROM sides_{t} WHERE nl >= 1 AND n - nl >= 1 ORDER BY gain DESC, f, edge LIMIT 1)""")
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(FEATURES))
    return f"""
train AS MATERIALIZED (SELECT *, draw % {trees.MODULUS} AS d FROM assigned WHERE split = 'train'),
vals AS ({values}),
guesses AS (SELECT f, x, abs(x) AS size, floor(log2(CASE WHEN x = 0 THEN 1 ELSE abs(x) END)) AS e FROM vals),
grid AS (
  SELECT f, x, size, pow(2::DOUBLE, {trees.CUT_BITS} - (e + CASE WHEN size >= pow(2::DOUBLE, e + 1) THEN 1
    WHEN size < pow(2::DOUBLE, e) THEN -1 ELSE 0 END)) AS scale FROM guesses),
tallies AS (SELECT f, CASE WHEN size < 1e-290 THEN 0 ELSE floor(x * scale) / scale END AS edge, count(*) AS n FROM grid GROUP BY 1, 2),
ranked AS (
  SELECT f, edge, sum(n) OVER (PARTITION BY f ORDER BY edge) - n AS before, sum(n) OVER (PARTITION BY f) AS total,
    row_number() OVER (PARTITION BY f ORDER BY edge) AS r, count(*) OVER (PARTITION BY f) AS m FROM tallies),
parts AS (SELECT *, (before * {trees.BINS}) // total AS part FROM ranked),
edges AS MATERIALIZED (
  SELECT f, edge FROM (SELECT *, lag(part) OVER (PARTITION BY f ORDER BY edge) AS earlier FROM parts)
  WHERE r > 1 AND (m <= {trees.BINS} OR part > earlier)),{','.join(found)},
names(f, feature) AS (VALUES {names})"""


def _bootstrap() -> str:
    seed = RF_PARAMS["random_state"]
    factors = ", ".join(f"({t + 1}, {trees.factor('tree', seed, t)})" for t in range(RF_PARAMS["n_estimators"]))
    weight = " + ".join(f"(u >= {p!r}::DOUBLE)::INT" for p in trees.POISSON)
    return f"""
shares AS (
  SELECT tree, ((draw % {trees.MODULUS}) * multiplier) % {trees.MODULUS} / {trees.MODULUS}::DOUBLE AS u
  FROM assigned CROSS JOIN (VALUES {factors}) f(tree, multiplier) WHERE split = 'train'),
weighed AS (SELECT tree, {weight} AS weight FROM shares)"""


ORACLE: dict[str, str] = {
    "scan_wide": _CELLS,
    "scan_csv": _CELLS,
    "csv_rejects": _with(_PLAIN[:2], """
SELECT Element, count(*) FILTER (NOT bad) AS kept, count(*) FILTER (bad) AS rejected
FROM (SELECT *, Area = 'NATION_7' AND Item LIKE '%PROMO' AS bad FROM wide) GROUP BY 1"""),
    "item_lookup": _with(_PLAIN, f"{_CORE_ROWS} WHERE Item = 'Brand#12/PROMO'"),
    "sketch_profile": _with(_PLAIN, """
SELECT 'Item' AS measure, NULL::DOUBLE AS probability, count(DISTINCT Item) AS row_count, true AS within FROM core
UNION ALL SELECT measure, probability, (SELECT count(*) FROM core), true
FROM (VALUES ('Import_Quantity'), ('Dependency_Pct')) m(measure),
  (VALUES (0.05::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (0.95::DOUBLE)) q(probability)"""),
    "filter_elements": _with(_PLAIN[:2], "SELECT Element, count(*) AS row_count FROM selected GROUP BY 1"),
    "core_roundtrip": _with(_PLAIN, _CORE_ROWS),
    "stage_counts": _with(_MODEL, " UNION ALL ".join(
        f"SELECT '{name}' AS stage, count(*) AS row_count FROM {table}"
        for name, table in (("raw", "wide"), ("selected", "selected"), ("long", "long"),
                            ("clean", "clean"), ("core", "core"), ("features", "features")))),
    "unpivot_years": _with(_PLAIN[:3], "SELECT Area, Item, Element, Year, Value FROM long"),
    "coerce_numeric": r"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
  CASE WHEN regexp_full_match(raw, '\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*')
       THEN TRY_CAST(trim(raw) AS DOUBLE) END AS value
FROM (SELECT *, CASE l_linenumber
        WHEN 1 THEN q WHEN 2 THEN ' ' || q || ' ' WHEN 3 THEN q || 'd' WHEN 4 THEN q || 'e1'
        WHEN 5 THEN '1_' || q WHEN 6 THEN '+.' || q ELSE 'nan' END AS raw
      FROM (SELECT *, l_quantity::INTEGER::VARCHAR AS q FROM lineitem))""",
    "interpolate_linear": _with(_PLAIN[:4], f"{_LONG_ROWS} FROM filled"),
    "interpolate_repeated": _with(_REPEATED, f"{_LONG_ROWS}, src_row FROM filled"),
    "interpolate_pieces": _with(_REPEATED, f"{_LONG_ROWS}, src_row FROM filled"),
    "clean_long": _with([_TRADE, _wide(True, False), _LONG, _FILLED], f"{_LONG_ROWS} FROM clean"),
    "pivot_measures": _with(_BOTH, f"SELECT {_KEYS}, {_rounded(CORE_VALUES[:2])} FROM measures"),
    "core_panel": _with(_PLAIN, _CORE_ROWS),
    "core_panel_repeated": _with(_BOTH, _CORE_ROWS),
    "core_panel_long": _with(_BOTH, _CORE_ROWS),
    "core_panel_elements": _with([_TRADE, _wide(True, True, SECOND_IMPORT), _LONG, _FILLED, _CORE], _CORE_ROWS),
    "lag_features": _with(
        [*_PLAIN, _ENGINEERED], f"SELECT {_KEYS}, {_rounded(_LAGS)} FROM engineered"),
    "rolling_mean": _with(
        [*_PLAIN, _ENGINEERED], f"SELECT {_KEYS}, {_rounded(['Import_RollingMean3'])} FROM engineered"),
    "label_encode": _with(_CODED, """
SELECT Area, Item, Area_enc::INTEGER AS Area_enc, Item_enc::INTEGER AS Item_enc
FROM (SELECT DISTINCT Area, Item FROM core) JOIN areas USING (Area) JOIN items USING (Item)"""),
    "code_ranges": _with(
        _MODEL, "SELECT max(Area_enc) AS max_area_code, max(Item_enc) AS max_item_code FROM features"),
    "feature_panel": _with(_MODEL, _FEATURE_ROWS),
    "feature_panel_long": _with(_MODEL, _FEATURE_ROWS),
    "calendar_lags": _with([*_CODED, _state(f"({_LAST} - 1)")], "").rstrip() + _CALENDAR,
    "calendar_panel": _with(_BOTH, "").rstrip() + _CALENDAR_PANEL,
    "feature_non_null": _with([*_PLAIN, _ENGINEERED], " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS non_null FROM engineered" for c in ENGINEERED)),
    "lag_drop_counts": _with(_MODEL, """
SELECT b AS rows_before, a AS rows_after, b - a AS rows_dropped
FROM (SELECT (SELECT count(*) FROM engineered) AS b, (SELECT count(*) FROM features) AS a)"""),
    "dataset_info": _with(_DRAWN, """
SELECT count(*) AS total_rows, (SELECT count(*) FROM assigned) AS training_rows,
  (SELECT count(*) FROM assigned WHERE split = 'train') AS train_rows,
  (SELECT count(*) FROM assigned WHERE split = 'test') AS test_rows,
  count(DISTINCT Area) AS n_countries, count(DISTINCT Item) AS n_items,
  min(Year) AS year_min, max(Year) AS year_max, 10::BIGINT AS n_features,
  count(*) - (SELECT count(*) FROM assigned) AS lag_rows_dropped
FROM core"""),
    "measure_stats": _with(_PLAIN, " UNION ALL ".join(
        f"SELECT '{c}' AS measure, {_r(f'avg({c})', 4)} AS mean, {_r(f'median({c})', 4)} AS median, "
        f"{_r(f'max({c})', 4)} AS max FROM core" for c in ("Import_Quantity", "Dependency_Pct"))),
    "winsor_hist": _with(_PLAIN, "").rstrip() + _hist(
        "Import_Quantity", "(SELECT quantile_cont(Import_Quantity, 0.95) FROM core)"),
    "ratio_hist": _with(_PLAIN, "").rstrip() + _hist("Dependency_Pct", "1e300::DOUBLE"),
    "vocabulary": _with(_CODED, """
SELECT 'Area' AS kind, Area AS label, Area_enc::INTEGER AS code FROM areas
UNION ALL SELECT 'Item', Item, Item_enc::INTEGER FROM items"""),
    "series_lookup": _with(
        _PLAIN, f"{_CORE_ROWS} WHERE Area = 'NATION_7' AND Item = 'Brand#12/PROMO'"),
    "history_tail": _with(_PLAIN, _tail(10)),
    "history_tail_short": _with(_PLAIN, _tail(4)),
    "split_assign": _with(_DRAWN, f"SELECT {_KEYS}, split FROM assigned"),
    "split_counts": _with(_DRAWN, "SELECT split, count(*) AS row_count FROM assigned GROUP BY 1"),
    "ridge_gram": _with(_DRAWN, _GRAM),
    "ridge_residual": _with(_RIDGE_SCORED, "", False) + " UNION ALL ".join(
        f"SELECT 'ridge_{t}' AS model, '{c}' AS feature, round((sum(({c} - m{i}) * (y - p)) - {RIDGE_PARAMS['alpha']}::DOUBLE "
        f"* any_value((SELECT w{i} FROM fit_{t}))) / sum(abs(({c} - m{i}) * (y - p))), 6) + 0.0::DOUBLE AS rest "
        f"FROM (SELECT *, {label} AS y, {_fitted(t)} AS p FROM assigned WHERE split = 'train'), mom"
        for t, label in _TARGETS for i, c in enumerate(FEATURES)),
    "ridge_scores": _with(_RIDGE_SCORED, f"""
SELECT Area, Item, Year, split, model, target, {_r('y', 4)} AS y, {_r('p', 3)} AS p FROM scored"""),
    "ridge_metrics": _with([*_RIDGE_SCORED, "\nmetrics AS (" + _METRICS], """
SELECT model, target, r2_train, r2_test, mae, rmse, mape FROM metrics"""),
    "bootstrap_counts": _with([*_DRAWN, _bootstrap()], """
SELECT tree, count(*) AS row_count, sum(weight)::BIGINT AS weight FROM weighed WHERE weight > 0 GROUP BY 1"""),
    "boost_first_split": _with([*_DRAWN, _first_split()], f"""
SELECT model, feature, threshold, {_r('gain / n', 4)} AS gain, n::DOUBLE AS cover
FROM (SELECT * FROM best_import UNION ALL SELECT * FROM best_dep) JOIN names USING (f)"""),
    "tree_importance": _with([*_DRAWN, _tree_nodes()], """
SELECT model, feature, importance,
  row_number() OVER (PARTITION BY model ORDER BY importance DESC, position)::INTEGER AS importance_rank FROM shares"""),
    "tree_forecast": _with([*_AHEAD, _steps(_FIRST, AHEAD, (_tree_sum("import"), _tree_sum("dep")))],
                           "SELECT Area, Item, Year, imp, dep FROM future", True),
    "served_forecast": _with(
        [*_RIDGE, _state(_FIRST), _steps(_FIRST, AHEAD, (_fitted("import"), _fitted("dep")))],
        "SELECT Area, Item, 'ridge' AS algo, Year, imp, dep FROM future", True),
    "eval_metrics": _with(
        _SCORED, "SELECT model, target, r2_train, r2_test, mae, rmse, mape FROM metrics"),
    "best_model": _with(_SCORED, """
SELECT target, model, r2_test
FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY r2_test DESC, position DESC) AS r FROM metrics)
WHERE r = 1"""),
    "metric_best_flags": _with(_SCORED, """
SELECT model, r2_test = (SELECT max(r2_test) FROM metrics) AS best_r2_test,
  mae = (SELECT min(mae) FROM metrics) AS best_mae, rmse = (SELECT min(rmse) FROM metrics) AS best_rmse,
  mape = (SELECT min(mape) FROM metrics) AS best_mape FROM metrics"""),
    "r2_cap_flag": _with(_SCORED, f"SELECT model, target, r2_test, r2_test > {R2_CAP} AS over_cap FROM metrics"),
    "rf_score_counts": _with(_DRAWN, _score_counts("rf")),
    "ridge_score_counts": _with(_DRAWN, _score_counts("ridge")),
    "slope_importance": _with([*_DRAWN, _slopes()], """
SELECT model, feature, importance,
  row_number() OVER (PARTITION BY model ORDER BY importance DESC, position)::INTEGER AS importance_rank FROM shares"""),
    "document_models": _with(_SCORED, "SELECT model, target, r2_train, r2_test, mae, rmse, mape FROM metrics"),
    "document_importances": _with([*_SCORED, _slopes()], """
SELECT metrics.model, feature, importance FROM metrics JOIN shares ON shares.model = 'slope_' || metrics.target"""),
    "document_info": _with(_SCORED, """
SELECT (SELECT count(*) FROM core) AS total_rows, (SELECT count(*) FROM assigned) AS training_rows,
  (SELECT count(DISTINCT Area) FROM core) AS n_countries, (SELECT count(DISTINCT Item) FROM core) AS n_items,
  (SELECT min(Year) FROM core) AS year_min, (SELECT max(Year) FROM core) AS year_max,
  (SELECT model FROM metrics WHERE target = 'import' ORDER BY r2_test DESC, position DESC LIMIT 1) AS best_import,
  (SELECT model FROM metrics WHERE target = 'dep' ORDER BY r2_test DESC, position DESC LIMIT 1) AS best_dep"""),
    "point_forecast": _with(
        [*_CODED, _state(f"({_LAST} + {AHEAD})"), _steps(f"({_LAST} + {AHEAD})", 1, _formula(FORMULAS))],
        "SELECT Area, Item, Year, imp, dep FROM future", True),
    "recursive_forecast": _with(
        [*_AHEAD, _steps(_FIRST, AHEAD, _formula(FORMULAS))], "SELECT Area, Item, Year, imp, dep FROM future", True),
    "requested_forecast": _with(
        [*_REQUESTED, _steps(_FIRST, AHEAD, _formula(FORMULAS))], "SELECT Area, Item, Year, imp, dep FROM future", True),
    "trend_series": _with([*_AHEAD, _steps(_FIRST, AHEAD, _formula(FORMULAS))], f"""
SELECT Area, Item, Year, 'Historical' AS kind, {_r('Import_Quantity', 2)} AS imp, {_r('Dependency_Pct', 2)} AS dep
FROM (SELECT *, row_number() OVER (PARTITION BY Area, Item ORDER BY Year DESC) AS r FROM core) WHERE r <= 10
UNION ALL SELECT Area, Item, Year, 'fixed forecast', imp, dep FROM future""", True),
    "formula_compare": _with(
        [*_AHEAD, *[_steps(_FIRST, AHEAD, _formula(formula), f"_{name}") for name, formula in FORMULA_SETS.items()]],
        "SELECT Area, Item, Year, "
        + ", ".join(f"future_{n}.{c} AS {n}_{t}" for c, t in (("imp", "import"), ("dep", "dep")) for n in FORMULA_SETS)
        + " FROM " + " JOIN ".join(
            f"future_{n}" + (" USING (Area, Item, Year)" if i else "") for i, n in enumerate(FORMULA_SETS)), True),
}
