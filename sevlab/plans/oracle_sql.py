"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL for the testbed pipeline is generated from the same ``PrepConfig`` the Spark side
uses, step by step, so both sides implement the documented semantics independently:
Spark through the operators, DuckDB through plain SQL.
"""

from __future__ import annotations

from typing import Any, Sequence

from ..config import TIME_BIN_OTHER, TIME_BINS, PrepConfig
from .testbed import SEVERITY_CODES

R = 6  # decimals kept for computed doubles on both sides (engines sum in different orders)


def lit(v: Any) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


SEVERITY_SQL = (
    "CAST(CASE l_returnflag "
    + " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in SEVERITY_CODES.items())
    + " ELSE CAST(l_returnflag AS INTEGER) END AS INTEGER)"
)

CASUALTY_SQL = f"""SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
  CAST(l_quantity AS INTEGER) AS l_quantity, {SEVERITY_SQL} AS severity, l_linestatus, l_tax
FROM lineitem"""

COLLISION_SQL = """SELECT o_orderkey AS l_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate,
  CAST(hour(o_orderdate) AS INTEGER) AS o_hour, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS o_dow,
  o_orderpriority, o_totalprice
FROM orders"""

JOINED_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "severity", "l_linestatus", "l_tax",
               "o_orderstatus", "o_orderdate", "o_hour", "o_dow", "o_orderpriority", "o_totalprice"]
JOINED_TYPES = {"l_orderkey": "BIGINT", "l_linenumber": "INTEGER", "l_quantity": "INTEGER", "severity": "INTEGER",
                "l_linestatus": "VARCHAR", "l_tax": "DOUBLE", "o_orderstatus": "VARCHAR", "o_orderdate": "DATE",
                "o_hour": "INTEGER", "o_dow": "INTEGER", "o_orderpriority": "VARCHAR", "o_totalprice": "DOUBLE"}

JOINED_SQL = f"""SELECT c.l_orderkey, c.l_linenumber, c.l_quantity, c.severity, c.l_linestatus, c.l_tax,
  k.o_orderstatus, k.o_orderdate, k.o_hour, k.o_dow, k.o_orderpriority, k.o_totalprice
FROM ({CASUALTY_SQL}) c JOIN ({COLLISION_SQL}) k ON c.l_orderkey = k.l_orderkey"""


def null_if_sql(c: str, codes: Sequence[Any]) -> str:
    return f"CASE WHEN {c} IN ({', '.join(lit(v) for v in codes)}) THEN NULL ELSE {c} END"


def nulled_sql(cfg: PrepConfig, src: str = "joined", cols: Sequence[str] = JOINED_COLS) -> str:
    sel = [f"{null_if_sql(c, cfg.sentinels[c])} AS {c}" if c in cfg.sentinels else c for c in cols]
    return f"SELECT {', '.join(sel)} FROM {src}"


def required_sql(cfg: PrepConfig, src: str = "nulled") -> str:
    return f"SELECT * FROM {src} WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cfg.required)


def dedup_sql(keys: Sequence[str], cols: Sequence[str], src: str) -> str:
    rest = [c for c in cols if c not in keys]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {order}) AS _rn FROM {src}) WHERE _rn = 1")


def median_sql(c: str, src: str) -> str:
    return f"(SELECT quantile_disc(CAST({c} AS DOUBLE), 0.5) FROM {src})"


def mode_sql(c: str, src: str) -> str:
    return f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def time_bin_sql(c: str) -> str:
    parts = " ".join(f"WHEN {c} >= {lo} AND {c} < {hi} THEN {b}" for lo, hi, b in TIME_BINS)
    return f"CASE {parts} ELSE {TIME_BIN_OTHER} END"


def testbed_ctes(cfg: PrepConfig, upto: str = "final") -> str:
    """WITH clause of the testbed pipeline up to the named step
    (joined, nulled, required, dedup, imputed, binned, encoded, kept, final)."""
    steps: list[tuple[str, str]] = [("joined", JOINED_SQL), ("nulled", nulled_sql(cfg)), ("required", required_sql(cfg)),
                                    ("dedup", dedup_sql(cfg.dedup_keys, JOINED_COLS, "required"))]
    fills = []
    for c in JOINED_COLS:
        if c in cfg.median_columns:
            fills.append(f"COALESCE({c}, CAST({median_sql(c, 'dedup')} AS {JOINED_TYPES[c]})) AS {c}")
        elif c in cfg.mode_columns:
            fills.append(f"COALESCE({c}, {mode_sql(c, 'dedup')}) AS {c}")
        elif c in cfg.constant_fill:
            fills.append(f"COALESCE({c}, {lit(cfg.constant_fill[c])}) AS {c}")
        else:
            fills.append(c)
    steps.append(("imputed", f"SELECT {', '.join(fills)} FROM dedup"))
    steps.append(("binned", f"SELECT *, {time_bin_sql(cfg.time_column)} AS {cfg.time_bin_column} FROM imputed"))
    for c in cfg.categorical:
        steps.append((f"ix_{c}", f"SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, "
                                 f"CAST({c} AS VARCHAR)) - 1 AS DOUBLE) AS idx FROM binned GROUP BY {c}"))
    joins = " ".join(f"LEFT JOIN ix_{c} ON b.{c} = ix_{c}.v" for c in cfg.categorical)
    idx = ", ".join(f"ix_{c}.idx AS {c}_idx" for c in cfg.categorical)
    steps.append(("encoded", f"SELECT b.*, {idx} FROM binned b {joins}"))
    qs = ", ".join(
        f"CAST(quantile_disc(CAST({c} AS DOUBLE), 0.25) AS DOUBLE) AS q1_{c}, "
        f"CAST(quantile_disc(CAST({c} AS DOUBLE), 0.75) AS DOUBLE) AS q3_{c}" for c in cfg.outlier_columns)
    steps.append(("iqr0", f"SELECT {qs} FROM imputed"))
    fence = ", ".join(
        f"q1_{c} - {cfg.iqr_factor!r} * (q3_{c} - q1_{c}) AS lo_{c}, q3_{c} + {cfg.iqr_factor!r} * (q3_{c} - q1_{c}) AS hi_{c}"
        for c in cfg.outlier_columns)
    steps.append(("iqr", f"SELECT {fence} FROM iqr0"))
    if cfg.variant == "drop":
        cond = " AND ".join(f"e.{c} >= (SELECT lo_{c} FROM iqr) AND e.{c} <= (SELECT hi_{c} FROM iqr)" for c in cfg.outlier_columns)
        steps.append(("kept", f"SELECT e.* FROM encoded e WHERE {cond}"))
    else:
        flags = ", ".join(
            f"CASE WHEN e.{c} IS NULL THEN 0 WHEN e.{c} < (SELECT lo_{c} FROM iqr) OR e.{c} > (SELECT hi_{c} FROM iqr) "
            f"THEN 1 ELSE 0 END AS {c}_is_outlier" for c in cfg.outlier_columns)
        steps.append(("flagged", f"SELECT e.*, {flags} FROM encoded e"))
        anyf = " + ".join(f"{c}_is_outlier" for c in cfg.outlier_columns)
        dom = " AND ".join(f"({c} IS NULL OR ({c} >= {lo} AND {c} <= {hi}))" for c, (lo, hi) in cfg.domain_bounds.items())
        steps.append(("kept", f"SELECT *, CASE WHEN {anyf} > 0 THEN 1 ELSE 0 END AS has_any_outlier FROM flagged WHERE {dom}"))
    steps.append(("cw", f"SELECT {cfg.label}, CAST(max(count(*)) OVER () AS DOUBLE) / count(*) AS class_weight "
                        f"FROM kept GROUP BY {cfg.label}"))
    mom = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS mean_{c}, stddev_samp(CAST({c} AS DOUBLE)) AS std_{c}" for c in cfg.numeric)
    steps.append(("sc", f"SELECT {mom} FROM kept"))
    z = ", ".join(f"(CAST(k.{c} AS DOUBLE) - (SELECT mean_{c} FROM sc)) * (1.0 / (SELECT std_{c} FROM sc)) AS z_{c}"
                  for c in cfg.numeric)
    steps.append(("final", f"SELECT k.*, cw.class_weight, {z} FROM kept k LEFT JOIN cw ON k.{cfg.label} = cw.{cfg.label}"))
    names = [n for n, _ in steps]
    cut = names.index(upto) + 1
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in steps[:cut])


def prepared_select_sql(cfg: PrepConfig) -> str:
    """Final columns of a prepare query: scalars, indexes, flags, weight, feature slots."""
    cols = JOINED_COLS + [cfg.time_bin_column] + [f"{c}_idx" for c in cfg.categorical]
    if cfg.variant == "flag":
        cols += [f"{c}_is_outlier" for c in cfg.outlier_columns] + ["has_any_outlier"]
    head = [f"z_{c}" for c in cfg.numeric] if cfg.variant == "drop" else [f"CAST({c} AS DOUBLE)" for c in cfg.numeric]
    feats = head + [f"CAST({c} AS DOUBLE)" for c in cfg.encoded_features]
    sel = cols + [f"round(class_weight, {R}) AS class_weight"]
    sel += [f"round({e}, {R}) AS f_{i}" for i, e in enumerate(feats)]
    if cfg.variant == "flag":
        sel += [f"round(z_{c}, {R}) AS s_{i}" for i, c in enumerate(cfg.numeric)]
    return testbed_ctes(cfg) + "\nSELECT " + ", ".join(sel) + " FROM final"


def unit_hash_sql(cols: Sequence[str], buckets: int = 1000) -> str:
    text = "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + ")"
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % {buckets})"


def hash_condition_sql(label: str, fractions, cols: Sequence[str], buckets: int = 1000) -> str:
    frac = "CASE " + " ".join(f"WHEN {label} = {lit(k)} THEN {float(v)!r}" for k, v in fractions.items()) + " ELSE 0.0 END"
    return f"({unit_hash_sql(cols, buckets)} < ({frac}) * {buckets})"


__all__ = ["CASUALTY_SQL", "COLLISION_SQL", "JOINED_SQL", "JOINED_COLS", "testbed_ctes", "prepared_select_sql",
           "hash_condition_sql", "unit_hash_sql", "lit", "R"]
