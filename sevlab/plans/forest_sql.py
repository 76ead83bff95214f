"""DuckDB SQL of a small forest grown by row hash: draws, candidate features, histograms and best cuts
of two levels, from plain aggregations and windows."""

from __future__ import annotations

from ..operators.forest import MIN_GAIN, MIX, UNIT, poisson_points

_WORD = "18446744073709551616::UHUGEINT"


def mixed_sql(x: str) -> str:
    """splitmix64's finish of ``x`` (a whole number, reduced to 64 bits)."""
    a = f"(({x}) % {_WORD})"
    b = f"((xor({a}, {a} >> 30) * {MIX[1]}::UHUGEINT) % {_WORD})"
    c = f"((xor({b}, {b} >> 27) * {MIX[2]}::UHUGEINT) % {_WORD})"
    return f"xor({c}, {c} >> 31)"


def _level(level: int, rows: str, n_features: int, subset: int, seed: int, classes: list[int]) -> str:
    """CTEs ``best<level>``: the best cut of each (tree, node) of ``rows`` (tree, node, y, weight, f0..)."""
    start = (seed + 1) * MIX[0] % 2**64
    w = {c: f"sum(CASE WHEN y = {c} THEN weight ELSE 0 END)" for c in classes}
    left = {c: f"l{c}" for c in classes}
    total = {c: f"t{c}" for c in classes}

    def purity(parts: list[str]) -> str:
        parts = [f"({p})::DOUBLE" for p in parts]
        n = " + ".join(parts)
        return f"CASE WHEN ({n}) > 0 THEN ({' + '.join(f'{p} * {p}' for p in parts)}) / ({n}) ELSE 0 END"

    right = [f"{total[c]} - {left[c]}" for c in classes]
    whole = " + ".join(f"{total[c]}::DOUBLE" for c in classes)
    return f"""
nodes{level} AS (SELECT DISTINCT tree, node FROM {rows}),
options{level} AS (
  SELECT tree, node, feature FROM nodes{level}, range({n_features}) AS r(feature)
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY {mixed_sql(f"(tree::UHUGEINT << 40) + (node::UHUGEINT << 16) + feature::UHUGEINT + {start}::UHUGEINT")}) <= {subset}
),
cells{level} AS (
  SELECT tree, node, feature, v, {', '.join(f'{w[c]} AS w{c}' for c in classes)}
  FROM (SELECT r.tree, r.node, r.y, r.weight, unnest([{', '.join(f"{{'feature': {i}, 'v': f{i}}}" for i in range(n_features))}], recursive := true) FROM {rows} r)
  JOIN options{level} USING (tree, node, feature) GROUP BY ALL
),
upto{level} AS (
  SELECT tree, node, feature, v, {', '.join(f'sum(w{c}) OVER (PARTITION BY tree, node, feature ORDER BY v) AS l{c}, sum(w{c}) OVER (PARTITION BY tree, node, feature) AS t{c}' for c in classes)}
  FROM cells{level}
),
best{level} AS (
  SELECT tree, node, feature, threshold, {', '.join(f'l{c}, t{c}' for c in classes)} FROM (
    SELECT u.*, c.threshold, CASE WHEN c.threshold IS NULL OR {' + '.join(right)} = 0 THEN -1 ELSE ({purity([left[c] for c in classes])} + {purity(right)} - {purity([total[c] for c in classes])}) / ({whole}) END AS gain
    FROM upto{level} u JOIN cuts c USING (feature, v))
  WHERE gain > {MIN_GAIN} QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, feature, threshold) = 1
)"""


def forest_sql(ctes: str, source: str, features: list[str], label: str, key: str, weight: str, condition: str, n_trees: int, seed: int, subset: int, classes: list[int]) -> str:
    """(tree, node, feature, threshold, w<class>...) of a forest of depth 2 on the rows of ``source`` that meet ``condition``."""
    points = ", ".join(str(p) for p in poisson_points())
    salt = f"(((tree + 1 + {seed << 20})::UHUGEINT * {MIX[0]}::UHUGEINT) % {_WORD})"
    draw = f"({mixed_sql(f'k::UHUGEINT + {salt}')} >> 32)"
    n = len(features)
    cols = ", ".join(f"f{i}" for i in range(n))
    side = " ".join(f"WHEN {i} THEN CASE WHEN r.f{i} <= b.threshold THEN 1 ELSE 2 END" for i in range(n))
    inner = " UNION ALL ".join(
        f"SELECT tree, node, feature, threshold, {', '.join(f't{c} AS w{c}' for c in classes)} FROM best{k}" for k in (0, 1))
    leaves = " UNION ALL ".join(
        f"SELECT tree, 2 * node + {1 + s}, NULL, NULL, {', '.join((f'l{c}' if s == 0 else f't{c} - l{c}') + f' AS w{c}' for c in classes)} FROM best{k}" for k in (0, 1) for s in (0, 1))
    return f"""{ctes},
keyed AS (SELECT *, {key} AS row_key FROM {source}),
train AS (SELECT row_key AS k, {label} AS y, CAST(round({weight} * {UNIT}) AS BIGINT) AS w, {', '.join(f'CAST({f} AS DOUBLE) AS f{i}' for i, f in enumerate(features))} FROM keyed WHERE {condition}),
cuts AS (
  SELECT feature, v, (v + lead(v) OVER (PARTITION BY feature ORDER BY v)) / 2 AS threshold
  FROM (SELECT feature, v FROM (SELECT unnest([{', '.join(f"{{'feature': {i}, 'v': f{i}}}" for i in range(n))}], recursive := true) FROM train) GROUP BY feature, v)
),
drawn AS (
  SELECT tree, 0 AS node, y, w * len(list_filter([{points}], lambda p: p <= draw)) AS weight, {cols}
  FROM (SELECT t.tree, train.*, CAST({draw} AS BIGINT) AS draw FROM train, range({n_trees}) AS t(tree)) WHERE draw >= {poisson_points()[0]}
),{_level(0, 'drawn', n, subset, seed, classes)},
below AS (SELECT r.tree, CASE b.feature {side} END AS node, r.y, r.weight, {', '.join(f'r.f{i}' for i in range(n))} FROM drawn r JOIN best0 b USING (tree)),{_level(1, 'below', n, subset, seed, classes)},
found AS ({inner} UNION ALL {leaves})
SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, CAST(max(feature) AS INTEGER) AS feature, max(threshold) AS threshold,
  {', '.join(f'round(max(w{c}) / {UNIT}.0, 6) AS weight_{c}' for c in classes)} FROM found GROUP BY tree, node"""
