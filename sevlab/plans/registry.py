"""Registered queries: one per operator / job of the inventory, each ``(spark, sf_dir) -> DataFrame``
over the whole test tables, with its DuckDB oracle in ``ORACLES`` (omitted only where no SQL
can express the result: Bernoulli sampling and the random forest).

Computed doubles are rounded to ``R`` decimals on both sides (sums are added in a different
order by the two engines)."""

from __future__ import annotations

import math
import uuid
from functools import reduce
from typing import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import bin_by_ranges, hour_of, parse_date, remap
from ..operators import balance, categories, clean, exact_sample, features, forest, model, outliers, quantiles, sampling, stats, wide
from ..session import scratch_path
from ..sources import bad_rows, files, slices
from . import increments
from . import integrate as integ
from . import testbed as tb
from .correlate import correlate
from .oracle_sql import (
    CASUALTY_SQL, JOINED_COLS, JOINED_SQL, R, SEVERITY_SQL, hash_condition_sql, lit, prepared_select_sql, testbed_ctes,
)
from .forest_sql import forest_sql
from .prepare import NUM_SCALED, cut_lineage, prepare
from .train import fit, split, train_and_evaluate

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CFG = tb.TESTBED_FLAG
LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rule_prediction() -> F.Column:
    """A fixed rule standing in for a model, so that evaluation can be checked in SQL."""
    return F.when(F.col("l_quantity") < 17, 1).when(F.col("l_quantity") < 34, 2).otherwise(3)

RULE_PREDICTION_SQL = "CASE WHEN l_quantity < 17 THEN 1 WHEN l_quantity < 34 THEN 2 ELSE 3 END"


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def rnd(c: str) -> F.Column:
    return F.round(F.col(c), R).alias(c)


def _lineitem(spark, sf):
    return tb.table(spark, sf, "lineitem")


def _nulled(spark, sf):
    return clean.sentinels_to_null(tb.joined(spark, sf), CFG.sentinels)


# ---------------------------------------------------------------- sources and sinks

@register("csv_header_scan", "SELECT " + ", ".join([f"CAST({c} AS VARCHAR) AS {c}" for c in LINE_COLS] + LINE_NUMBERS)
          + ", strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem")
def q_csv_header_scan(spark, sf):
    """All eleven columns; the numbers' text is read back as the same numbers, the time's as its date."""
    path = scratch_path(spark, "csv-lineitem")
    files.write_csv(_lineitem(spark, sf), path)
    raw = files.read_csv(spark, path)
    return raw.select(*LINE_COLS, *[F.col(c).cast("double").alias(c) for c in LINE_NUMBERS], F.substring("l_shipdate", 1, 10).alias("l_shipdate"))


@register("parquet_scan", "SELECT * FROM lineitem")
def q_parquet_scan(spark, sf):
    return files.read_parquet(spark, f"{sf}/lineitem.parquet")


@register("parquet_recursive_scan", "SELECT * FROM orders")
def q_parquet_recursive_scan(spark, sf):
    base = scratch_path(spark, "nested-orders")
    o = tb.table(spark, sf, "orders")
    old = F.coalesce(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp"), F.lit(True))  # a row without a date is old
    files.write_parquet(o.filter(old), f"{base}/archive")
    files.write_parquet(o.filter(~old), f"{base}/recent/provisional")
    return files.read_parquet(spark, base, recursive=True)


@register("parquet_overwrite_roundtrip", "SELECT * FROM customer")
def q_parquet_overwrite_roundtrip(spark, sf):
    path = scratch_path(spark, "customer-copy")
    c = tb.table(spark, sf, "customer")
    files.write_parquet(c, path)
    files.write_parquet(c, path, mode="overwrite")  # replaces (an append would double the rows)
    return files.read_parquet(spark, path)


@register("top_k", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def q_top_k(spark, sf):
    o = tb.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(10)


_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date"}


@register("schema_report", f"SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name, CASE column_type "
          + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in _TYPES.items()) + f" END AS data_type, \"null\" = 'YES' AS nullable FROM (DESCRIBE {JOINED_SQL})")
def q_schema_report(spark, sf):
    """The joined table's columns: position, name, type, nullable."""
    return files.schema_report(tb.joined(spark, sf))


# ---------------------------------------------------------------- projections and filters

_KEEP = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_tax"]


@register("keep_columns", f"SELECT {', '.join(_KEEP)} FROM lineitem")
def q_keep_columns(spark, sf):
    return clean.keep_columns(_lineitem(spark, sf), _KEEP)


@register("typed_projection", CASUALTY_SQL)
def q_typed_projection(spark, sf):
    return integ.type_table(tb.raw_casualty(spark, sf), tb.CASUALTY_KEEP, tb.casualty_typing())


_RULE_STR = ["l_returnflag", "l_linestatus", "l_shipdate"]
_RULE_DBL = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("cast_by_rule", "SELECT CAST(l_returnflag AS VARCHAR) AS l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate, "
          "CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey, "
          "CAST(l_suppkey AS INTEGER) AS l_suppkey, l_linenumber, "
          + ", ".join(f"CAST(CAST({c} AS VARCHAR) AS DOUBLE) AS {c}" for c in _RULE_DBL) + " FROM lineitem")
def q_cast_by_rule(spark, sf):
    raw = tb.raw_casualty(spark, sf)
    return clean.cast_by_rule(raw, _RULE_STR, _RULE_DBL)


@register("parse_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def q_parse_date(spark, sf):
    raw = tb.raw_collision(spark, sf)
    return raw.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                      parse_date("o_orderdate", C.DATE_FORMAT).alias("o_orderdate"))


@register("hour_from_time", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events")
def q_hour_from_time(spark, sf):
    ev = tb.table(spark, sf, "events").select("event_id", F.date_format("ts", "HH:mm").alias("time"))
    return ev.select("event_id", hour_of("time", C.TIME_SEPARATOR).alias("hour"))


@register("time_bin", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CASE "
          + " ".join(f"WHEN hour(ts) >= {lo} AND hour(ts) < {hi} THEN {b}" for lo, hi, b in C.TIME_BINS)
          + f" ELSE {C.TIME_BIN_OTHER} END AS time_bin FROM events")
def q_time_bin(spark, sf):
    ev = q_hour_from_time(spark, sf)
    return ev.withColumn("time_bin", bin_by_ranges("hour", C.TIME_BINS, C.TIME_BIN_OTHER))


@register("sentinel_to_null", testbed_ctes(CFG, "nulled") + " SELECT * FROM nulled")
def q_sentinel_to_null(spark, sf):
    return _nulled(spark, sf)


_MULTI = ("4-NOT SPECIFIED", "5-LOW")


@register("multi_sentinel_to_null", "SELECT o_orderkey, CASE WHEN o_orderpriority IN ("
          + ", ".join(lit(v) for v in _MULTI) + ") THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders")
def q_multi_sentinel_to_null(spark, sf):
    o = tb.table(spark, sf, "orders")
    return clean.sentinels_to_null(o.select("o_orderkey", "o_orderpriority"), {"o_orderpriority": _MULTI})


@register("drop_nulls_subset", testbed_ctes(CFG, "required") + " SELECT * FROM required")
def q_drop_nulls_subset(spark, sf):
    return clean.drop_nulls(_nulled(spark, sf), CFG.required)


@register("drop_nulls_all", testbed_ctes(CFG, "nulled") + " SELECT * FROM nulled WHERE "
          + " AND ".join(f"{c} IS NOT NULL" for c in JOINED_COLS))
def q_drop_nulls_all(spark, sf):
    return clean.drop_nulls(_nulled(spark, sf))


@register("drop_columns", "WITH joined AS (" + JOINED_SQL + ") SELECT "
          + ", ".join(c for c in JOINED_COLS if c not in ("o_hour", "o_totalprice")) + " FROM joined")
def q_drop_columns(spark, sf):
    return clean.drop_columns(tb.joined(spark, sf), ["o_hour", "o_totalprice"])


@register("impute_constant", testbed_ctes(CFG, "nulled") + " SELECT "
          + ", ".join(f"COALESCE({c}, {lit(CFG.constant_fill[c])}) AS {c}" if c in CFG.constant_fill else c
                      for c in JOINED_COLS) + " FROM nulled")
def q_impute_constant(spark, sf):
    return clean.fill_values(_nulled(spark, sf), CFG.constant_fill)


@register("label_swap", f"SELECT l_orderkey, l_linenumber, CASE WHEN severity = 1 THEN 3 WHEN severity = 3 THEN 1 "
          f"ELSE severity END AS severity FROM ({CASUALTY_SQL})")
def q_label_swap(spark, sf):
    c = tb.casualty(spark, sf)
    return c.select("l_orderkey", "l_linenumber", remap("severity", C.SEVERITY_SWAP).alias("severity"))


_PRICE_IQR = ("WITH q AS (SELECT quantile_disc(o_totalprice, 0.25) AS q1, quantile_disc(o_totalprice, 0.75) AS q3 FROM orders), "
              "f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)")


def _price_filtered(spark, sf):
    o = tb.table(spark, sf, "orders")
    b = outliers.fit_iqr_bounds(o, ["o_totalprice"], 0.0, C.IQR_FACTOR)
    return outliers.drop_outside(o, outliers.fences(b))


@register("outlier_filter", _PRICE_IQR + " SELECT o.* FROM orders o WHERE o.o_totalprice >= (SELECT lo FROM f) AND o.o_totalprice <= (SELECT hi FROM f)")
def q_outlier_filter(spark, sf):
    return _price_filtered(spark, sf)


@register("min_max_check", _PRICE_IQR + " SELECT min(o.o_totalprice) AS min_o_totalprice, max(o.o_totalprice) AS max_o_totalprice, "
          "min(o.o_custkey) AS min_o_custkey, max(o.o_custkey) AS max_o_custkey "
          "FROM orders o WHERE o.o_totalprice >= (SELECT lo FROM f) AND o.o_totalprice <= (SELECT hi FROM f)")
def q_min_max_check(spark, sf):
    return stats.min_max(_price_filtered(spark, sf), ["o_totalprice", "o_custkey"])


_DOMAIN = {"l_quantity": (0, 40), "o_totalprice": (0.0, 300000.0)}


@register("domain_filter", testbed_ctes(CFG, "nulled") + " SELECT * FROM nulled WHERE "
          + " AND ".join(f"({c} IS NULL OR ({c} >= {lit(lo)} AND {c} <= {lit(hi)}))" for c, (lo, hi) in _DOMAIN.items()))
def q_domain_filter(spark, sf):
    return outliers.domain_filter(_nulled(spark, sf), _DOMAIN)


_FLAG_COLS = ["l_quantity", "o_totalprice"]


@register("outlier_flag", testbed_ctes(CFG, "nulled") + ", q AS (SELECT "
          + ", ".join(f"CAST(quantile_disc(CAST({c} AS DOUBLE), 0.25) AS DOUBLE) AS q1_{c}, "
                      f"CAST(quantile_disc(CAST({c} AS DOUBLE), 0.75) AS DOUBLE) AS q3_{c}" for c in _FLAG_COLS)
          + " FROM nulled), fl AS (SELECT n.l_orderkey, n.l_linenumber, n.l_quantity, n.o_totalprice, "
          + ", ".join(f"CASE WHEN n.{c} IS NULL THEN 0 WHEN n.{c} < (SELECT q1_{c} - 1.5 * (q3_{c} - q1_{c}) FROM q) "
                      f"OR n.{c} > (SELECT q3_{c} + 1.5 * (q3_{c} - q1_{c}) FROM q) THEN 1 ELSE 0 END AS {c}_is_outlier"
                      for c in _FLAG_COLS)
          + " FROM nulled n) SELECT *, CASE WHEN "
          + " + ".join(f"{c}_is_outlier" for c in _FLAG_COLS) + " > 0 THEN 1 ELSE 0 END AS has_any_outlier FROM fl")
def q_outlier_flag(spark, sf):
    d = _nulled(spark, sf).select("l_orderkey", "l_linenumber", *_FLAG_COLS)
    b = outliers.fit_iqr_bounds(d, _FLAG_COLS, 0.0, C.IQR_FACTOR)
    return outliers.flag_outliers(d, outliers.fences(b))


# ---------------------------------------------------------------- joins and class balance

@register("inner_join", JOINED_SQL)
def q_inner_join(spark, sf):
    return tb.joined(spark, sf)


@register("union_by_name", CASUALTY_SQL)
def q_union_by_name(spark, sf):
    ship = _lineitem(spark, sf)
    full = ship.select(
        "l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), F.col("l_quantity").cast("int").alias("l_quantity"),
        tb.severity_of("l_returnflag").alias("severity"), "l_linestatus", "l_tax", "l_shipdate")
    a = full.filter(F.year("l_shipdate") < 2000).drop("l_shipdate")
    b = full.filter(F.year("l_shipdate") >= 2000).drop("l_shipdate")
    b = b.select(*reversed(b.columns))  # different column order: matched by name
    return integ.union_slices([a, b])


_CW_SQL = ("WITH c AS (" + CASUALTY_SQL + "), cw AS (SELECT severity, count(*) AS count, "
           "CAST(max(count(*)) OVER () AS DOUBLE) / count(*) AS class_weight FROM c GROUP BY severity)")


@register("class_distribution", f"SELECT severity, count(*) AS count FROM ({CASUALTY_SQL}) GROUP BY severity")
def q_class_distribution(spark, sf):
    return stats.group_count(tb.casualty(spark, sf), "severity")


@register("sort_by_label", f"SELECT severity, count(*) AS count FROM ({CASUALTY_SQL}) GROUP BY severity ORDER BY severity")
def q_sort_by_label(spark, sf):
    return stats.group_count(tb.casualty(spark, sf), "severity").orderBy("severity")


@register("class_share", f"SELECT severity, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), {R}) AS percent "
          f"FROM ({CASUALTY_SQL}) GROUP BY severity")
def q_class_share(spark, sf):
    return stats.class_share(tb.casualty(spark, sf), "severity").select("severity", "count", rnd("percent"))


@register("class_weight_table", _CW_SQL + f" SELECT severity, count, round(class_weight, {R}) AS class_weight FROM cw")
def q_class_weight_table(spark, sf):
    return balance.class_weight_table(tb.casualty(spark, sf), "severity").select("severity", "count", rnd("class_weight"))


@register("class_weight", _CW_SQL + f" SELECT c.l_orderkey, c.l_linenumber, c.severity, round(cw.class_weight, {R}) AS class_weight "
          "FROM c LEFT JOIN cw ON c.severity = cw.severity")
def q_class_weight(spark, sf):
    c = tb.casualty(spark, sf).select("l_orderkey", "l_linenumber", "severity")
    return balance.attach_class_weight(c, "severity").select("l_orderkey", "l_linenumber", "severity", rnd("class_weight"))


@register("smoothed_weight", _CW_SQL + f" SELECT severity, round(class_weight, {R}) AS class_weight, "
          f"round(sqrt(class_weight), {R}) AS smoothed_weight FROM cw")
def q_smoothed_weight(spark, sf):
    w = balance.class_weight_table(tb.casualty(spark, sf), "severity")
    return balance.smoothed_weight(w).select("severity", rnd("class_weight"), rnd("smoothed_weight"))


# ---------------------------------------------------------------- aggregations and profiles

_STEP_SQL = testbed_ctes(CFG, "dedup") + (
    " SELECT 0 AS step_no, 'input' AS step, count(*) AS rows FROM joined UNION ALL"
    " SELECT 1, 'sentinels_to_null', count(*) FROM nulled UNION ALL"
    " SELECT 2, 'required', count(*) FROM required UNION ALL"
    " SELECT 3, 'dedup', count(*) FROM dedup")


@register("step_row_counts", _STEP_SQL)
def q_step_row_counts(spark, sf):
    """Rows after each cleaning step, observed by the job that writes the clean table (the generic
    ``stats.step_row_counts`` counts any named stages with passes of its own)."""
    from .prepare import counts_table, write_clean
    return counts_table(spark, write_clean(tb.joined(spark, sf), CFG, scratch_path(spark, "clean")))


@register("dedup_subset", testbed_ctes(CFG, "dedup") + " SELECT * FROM dedup")
def q_dedup_subset(spark, sf):
    d = clean.drop_nulls(_nulled(spark, sf), CFG.required)
    return clean.dedup(d, CFG.dedup_keys, CFG.dedup_order)


@register("impute_median", testbed_ctes(CFG, "nulled") + " SELECT "
          + ", ".join(f"COALESCE({c}, CAST((SELECT quantile_disc(CAST({c} AS DOUBLE), 0.5) FROM nulled) AS "
                      f"{'INTEGER' if c == 'l_quantity' else 'DOUBLE'})) AS {c}" if c in CFG.median_columns else c
                      for c in JOINED_COLS) + " FROM nulled")
def q_impute_median(spark, sf):
    return clean.impute_median(_nulled(spark, sf), CFG.median_columns, 0.0)[0]


@register("impute_mode", testbed_ctes(CFG, "nulled") + " SELECT "
          + ", ".join(f"COALESCE({c}, (SELECT {c} FROM nulled WHERE {c} IS NOT NULL GROUP BY {c} "
                      f"ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}" if c in CFG.mode_columns else c
                      for c in JOINED_COLS) + " FROM nulled")
def q_impute_mode(spark, sf):
    return clean.impute_mode(_nulled(spark, sf), CFG.mode_columns)[0]


_Q_COLS = ["l_quantity", "l_tax", "l_extendedprice"]
_PROBS = [0.25, 0.5, 0.75]


@register("quantiles", " UNION ALL ".join(
    f"SELECT {lit(c)} AS column_name, CAST({p!r} AS DOUBLE) AS prob, CAST(quantile_disc(CAST({c} AS DOUBLE), {p!r}) AS DOUBLE) AS value "
    "FROM lineitem"
    for c in _Q_COLS for p in _PROBS))
def q_quantiles(spark, sf):
    return stats.quantile_table(_lineitem(spark, sf), _Q_COLS, _PROBS, 0.0)


@register("quantiles_approx", " UNION ALL ".join(
    f"SELECT {lit(c)} AS column_name, CAST({p!r} AS DOUBLE) AS prob, count({c}) AS n, TRUE AS within_error, TRUE AS as_spark FROM lineitem" for c in _Q_COLS for p in _PROBS))
def q_quantiles_approx(spark, sf):
    """The sketch's answers checked over all rows: the rank error is at most 0.01 n, and the value is the
    one that ``approxQuantile`` gives or one of equal standing (also within the error)."""
    df, err = _lineitem(spark, sf), C.QUANTILE_RELATIVE_ERROR
    table = stats.quantile_table(df, _Q_COLS, _PROBS, err)
    theirs = dict(zip(_Q_COLS, df.approxQuantile(_Q_COLS, _PROBS, err)))
    ranks = quantiles.ranked(quantiles.value_counts(df, _Q_COLS))
    names = F.element_at(F.array(*map(F.lit, _Q_COLS)), F.col("c") + 1)
    known = F.create_map(*[F.lit(x) for c in _Q_COLS for i, p in enumerate(_PROBS) for x in (f"{c}/{p}", theirs[c][i])])
    found = table.withColumn("spark", F.element_at(known, F.concat_ws("/", "column_name", F.col("prob").cast("string")))).alias("t").join(
        ranks.withColumn("column_name", names).alias("r"), "column_name")
    slack = err * F.col("total") + 1
    near = lambda v: F.bool_or((F.col("v") == v) & (F.col("before") <= F.col("prob") * F.col("total") + slack) & (F.col("upto") >= F.col("prob") * F.col("total") - slack))
    return found.groupBy("column_name", "prob").agg(F.max("total").alias("n"), near(F.col("value")).alias("within_error"), near(F.col("spark")).alias("as_spark"))


@register("quantiles_high_cardinality", " UNION ALL ".join(
    f"SELECT CAST({p!r} AS DOUBLE) AS prob, CAST(quantile_disc(value, {p!r}) AS DOUBLE) AS value FROM events" for p in (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)))
def q_quantiles_high_cardinality(spark, sf):
    """The same code on a column in which nearly every row has its own value."""
    return stats.quantile_table(tb.table(spark, sf, "events"), ["value"], (0.0, 0.01, 0.25, 0.5, 0.9, 1.0), 0.0).select("prob", "value")


_EVENT_FENCES = ("WITH q AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events), "
                 "f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q), "
                 "flagged AS (SELECT event_id, value, CAST(value IS NOT NULL AND (value < lo OR value > hi) AS INTEGER) AS value_is_outlier FROM events, f) ")


def _event_bounds(spark, sf):
    return outliers.fences(outliers.fit_iqr_bounds(tb.table(spark, sf, "events"), ["value"], 0.0))


@register("event_outlier_filter", _EVENT_FENCES + "SELECT event_id, value FROM flagged WHERE value IS NOT NULL AND value_is_outlier = 0")
def q_event_outlier_filter(spark, sf):
    """A column with real outliers: rows outside the fences go."""
    return outliers.drop_outside(tb.table(spark, sf, "events").select("event_id", "value"), _event_bounds(spark, sf))


@register("event_outlier_flag", _EVENT_FENCES + "SELECT event_id, value, value_is_outlier, value_is_outlier AS has_any_outlier FROM flagged")
def q_event_outlier_flag(spark, sf):
    return outliers.flag_outliers(tb.table(spark, sf, "events").select("event_id", "value"), _event_bounds(spark, sf))


@register("event_outlier_counts", _EVENT_FENCES + "SELECT count(*) AS rows_before, count(*) FILTER (WHERE value IS NOT NULL AND value_is_outlier = 0) AS rows_after, "
          "count(*) FILTER (WHERE value IS NULL OR value_is_outlier = 1) AS removed, CAST(sum(value_is_outlier) AS BIGINT) AS rows_with_any_outlier FROM flagged")
def q_event_outlier_counts(spark, sf):
    """Rows before and after the outlier step, removed by it, and with any outlier."""
    events, bounds = tb.table(spark, sf, "events"), _event_bounds(spark, sf)
    stays = outliers.between("value", *bounds["value"])
    gone = ~F.coalesce(stays, F.lit(False))
    return outliers.flag_outliers(events.select("value"), bounds).agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(~gone).alias("rows_after"), F.count_if(gone).alias("removed"), F.sum("has_any_outlier").alias("rows_with_any_outlier"))


_IQR_COLS = ["l_quantity", "o_totalprice"]


@register("iqr_bounds", "WITH joined AS (" + JOINED_SQL + ") " + " UNION ALL ".join(
    f"SELECT {lit(c)} AS column_name, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, "
    f"q3 + 1.5 * (q3 - q1) AS upper_bound FROM (SELECT CAST(quantile_disc(CAST({c} AS DOUBLE), 0.25) AS DOUBLE) AS q1, "
    f"CAST(quantile_disc(CAST({c} AS DOUBLE), 0.75) AS DOUBLE) AS q3 FROM joined)" for c in _IQR_COLS))
def q_iqr_bounds(spark, sf):
    return stats.iqr_table(tb.joined(spark, sf), _IQR_COLS, 0.0, C.IQR_FACTOR)


@register("missing_profile", testbed_ctes(CFG, "nulled") + " SELECT "
          + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in ('l_tax', 'o_totalprice') else ''}) AS {c}"
                      for c in JOINED_COLS) + " FROM nulled")
def q_missing_profile(spark, sf):
    return stats.missing_profile(_nulled(spark, sf))


_MISSING_LONG = " UNION ALL ".join(f"SELECT {lit(c)} AS feature, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM nulled"
                                   for c in JOINED_COLS)


@register("missing_report", testbed_ctes(CFG, "nulled") + f" SELECT * FROM ({_MISSING_LONG}) WHERE missing > 0")
def q_missing_report(spark, sf):
    return stats.missing_report(_nulled(spark, sf))


@register("missing_total", testbed_ctes(CFG, "nulled") + f" SELECT CAST(sum(missing) AS BIGINT) AS missing_total FROM ({_MISSING_LONG})")
def q_missing_total(spark, sf):
    return stats.missing_total(_nulled(spark, sf))


_CONF_SQL = ("WITH p AS (SELECT severity, " + RULE_PREDICTION_SQL + " AS prediction FROM (" + CASUALTY_SQL + "))")


@register("confusion_matrix", _CONF_SQL + " SELECT severity, " + ", ".join(
    f"count(*) FILTER (WHERE prediction = {k}) AS pred_{k}" for k in (1, 2)) + ", count(*) FILTER (WHERE prediction IS NULL OR prediction NOT IN (1, 2)) AS other"
    " FROM p GROUP BY severity")
def q_confusion_matrix(spark, sf):
    p = tb.casualty(spark, sf).select("severity", rule_prediction().alias("prediction"))
    ct = stats.crosstab(p, "severity", "prediction", [1, 2])  # 3 is not listed and counts as other
    return ct.select("severity", *[F.col(str(k)).alias(f"pred_{k}") for k in (1, 2)], "other")


_EVAL_SQL = _CONF_SQL + (
    ", pairs AS (SELECT severity AS y, prediction AS yhat, count(*) AS n FROM p GROUP BY ALL),"
    " lab AS (SELECT y AS c, sum(n) AS support, sum(CASE WHEN y = yhat THEN n ELSE 0 END) AS tp FROM pairs GROUP BY y),"
    " prd AS (SELECT yhat AS c, sum(n) AS predicted FROM pairs GROUP BY yhat),"
    " cls AS (SELECT lab.c, CAST(support AS DOUBLE) AS support, CAST(tp AS DOUBLE) AS tp, CAST(COALESCE(predicted, 0) AS DOUBLE) AS predicted"
    " FROM lab LEFT JOIN prd ON lab.c = prd.c),"
    " m AS (SELECT support, tp, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr,"
    " CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM cls)"
    f" SELECT round(sum(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END * support) / sum(support), {R}) AS f1,"
    f" round(sum(tp) / sum(support), {R}) AS accuracy FROM m")


@register("eval_metrics", _EVAL_SQL)
def q_eval_metrics(spark, sf):
    p = tb.casualty(spark, sf).select("severity", rule_prediction().alias("prediction"))
    return model.evaluate(p, "severity", "prediction").select(rnd("f1"), rnd("accuracy"))


_CORR_COLS = ["severity", "l_linenumber", "l_quantity", "l_tax", "o_dow", "o_totalprice"]


def _corr_sql() -> str:
    sel = ", ".join(f"CASE WHEN {c} = 1 THEN 3 WHEN {c} = 3 THEN 1 ELSE {c} END AS {c}" if c == "severity" else c
                    for c in _CORR_COLS)
    cells = []
    for i, a in enumerate(_CORR_COLS):
        for j, b in enumerate(_CORR_COLS):
            if i == j:
                cells.append(f"SELECT {i} AS i, {j} AS j, {lit(a)} AS col_i, {lit(b)} AS col_j, CAST(1.0 AS DOUBLE) AS r")
            else:
                r = f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), {R})"
                cells.append(f"SELECT {i} AS i, {j} AS j, {lit(a)} AS col_i, {lit(b)} AS col_j, {r} AS r FROM d")
    nn = " AND ".join(f"{c} IS NOT NULL" for c in _CORR_COLS)
    return f"WITH joined AS ({JOINED_SQL}), d AS (SELECT {sel} FROM joined WHERE {nn}) " + " UNION ALL ".join(cells)


@register("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, sf):
    m = correlate(tb.joined(spark, sf), _CORR_COLS, C.SEVERITY_SWAP, ["severity"])
    return m.select("i", "j", "col_i", "col_j", rnd("r"))


def _box_sql(col: str) -> str:
    return (f"WITH joined AS ({JOINED_SQL}), q AS (SELECT severity, count(*) AS n, "
            f"quantile_cont(CAST({col} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({col} AS DOUBLE), 0.5) AS median, "
            f"quantile_cont(CAST({col} AS DOUBLE), 0.75) AS q3 FROM joined WHERE {col} IS NOT NULL GROUP BY severity), "
            f"f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q) "
            f"SELECT f.severity, f.n, f.q1, f.median, f.q3, f.lower_fence, f.upper_fence, "
            f"CAST(min(CASE WHEN j.{col} >= f.lower_fence AND j.{col} <= f.upper_fence THEN j.{col} END) AS DOUBLE) AS whisker_low, "
            f"CAST(max(CASE WHEN j.{col} >= f.lower_fence AND j.{col} <= f.upper_fence THEN j.{col} END) AS DOUBLE) AS whisker_high, "
            f"count(*) FILTER (WHERE NOT (j.{col} >= f.lower_fence AND j.{col} <= f.upper_fence)) AS outliers "
            f"FROM joined j JOIN f ON j.severity = f.severity WHERE j.{col} IS NOT NULL GROUP BY ALL")


@register("box_stats", _box_sql("l_quantity"))
def q_box_stats(spark, sf):
    return stats.box_stats(tb.joined(spark, sf), "severity", "l_quantity", C.IQR_FACTOR)


_HIST = {"l_quantity": 30, "l_tax": 15}


def _hist_sql() -> str:
    parts = []
    for c, bins in _HIST.items():
        lo = f"(SELECT min(CAST({c} AS DOUBLE)) FROM joined)"
        w = f"((SELECT max(CAST({c} AS DOUBLE)) - min(CAST({c} AS DOUBLE)) FROM joined) / {bins})"
        parts.append(
            f"SELECT {lit(c)} AS column_name, severity, bin, round(lo + bin * w, {R}) AS bin_low, "
            f"round(lo + (bin + 1) * w, {R}) AS bin_high, count FROM (SELECT j.severity, "
            f"CAST(least(floor((CAST(j.{c} AS DOUBLE) - {lo}) / {w}), {bins - 1}) AS INTEGER) AS bin, {lo} AS lo, {w} AS w, "
            f"count(*) AS count FROM joined j WHERE j.{c} IS NOT NULL GROUP BY ALL)")
    return f"WITH joined AS ({JOINED_SQL}) " + " UNION ALL ".join(parts)


@register("histogram", _hist_sql())
def q_histogram(spark, sf):
    h = stats.histogram_long(tb.joined(spark, sf), "severity", _HIST)
    return h.select("column_name", "severity", "bin", rnd("bin_low"), rnd("bin_high"), "count")


# ---------------------------------------------------------------- sampling and splits

def _rows(spark, sf):
    li = _lineitem(spark, sf)
    return li.select(*tb.ROW_KEY, tb.severity_of("l_returnflag").alias("severity"), "l_quantity")


_ROWS_SQL = f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {SEVERITY_SQL} AS severity, l_quantity FROM lineitem"
_COND = hash_condition_sql("severity", C.TRAIN_FRACTIONS, tb.ROW_KEY)


@register("stratified_sample", f"SELECT * FROM ({_ROWS_SQL}) WHERE {_COND}")
def q_stratified_sample(spark, sf):
    return sampling.hash_stratified_sample(_rows(spark, sf), "severity", C.TRAIN_FRACTIONS, tb.ROW_KEY)


@register("stratified_sample_bernoulli", f"SELECT severity, count(*) AS rows, TRUE AS share_in_bounds, count(*) AS train_and_test, CAST(0 AS BIGINT) AS in_both "
          f"FROM ({_ROWS_SQL}) GROUP BY severity")
def q_stratified_sample_bernoulli(spark, sf):
    """The reference's own split (row id, ``sampleBy``, anti join on the id) over all rows, as facts: each
    class's share lies within five standard deviations, train and test make up all rows, none is in both."""
    path = scratch_path(spark, "split-rows")
    files.write_parquet(sampling.with_row_id(_rows(spark, sf)), path)
    rows = files.read_parquet(spark, path)
    train = sampling.stratified_sample(rows, "severity", C.TRAIN_FRACTIONS, C.SEED)
    files.write_parquet(train, f"{path}-train")
    train = files.read_parquet(spark, f"{path}-train")
    test = sampling.anti_join_split(rows, train, "id")
    tagged = train.select("severity", "id", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(test.select("severity", "id", F.lit(0).alias("a"), F.lit(1).alias("b")))
    per_id = tagged.groupBy("severity", "id").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    facts = per_id.groupBy("severity").agg(F.sum("a").alias("a"), F.count(F.lit(1)).alias("train_and_test"), F.count_if((F.col("a") > 0) & (F.col("b") > 0)).alias("in_both"))
    counts = stats.group_count(rows, "severity", "rows")
    p = F.element_at(F.create_map(*[F.lit(x) for k, v in C.TRAIN_FRACTIONS.items() for x in (int(k), float(v))]), F.col("severity"))
    bound = 5 * F.sqrt(p * (1 - p) * F.col("rows"))
    return counts.join(facts, "severity").select("severity", "rows", (F.abs(F.col("a") - p * F.col("rows")) <= bound).alias("share_in_bounds"), "train_and_test", "in_both")


@register("anti_join_split", f"SELECT * FROM ({_ROWS_SQL}) WHERE NOT {_COND}")
def q_anti_join_split(spark, sf):
    rows = _rows(spark, sf)
    train = sampling.hash_stratified_sample(rows, "severity", C.TRAIN_FRACTIONS, tb.ROW_KEY)
    return sampling.anti_join_split(rows, train, tb.ROW_KEY)


_EX_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "severity", "l_linestatus"]


@register("except_distinct", f"SELECT {', '.join(_EX_COLS)} FROM ({CASUALTY_SQL}) EXCEPT "
          f"SELECT {', '.join(_EX_COLS)} FROM ({CASUALTY_SQL}) WHERE {hash_condition_sql('severity', C.TRAIN_FRACTIONS, _EX_COLS)}")
def q_except_distinct(spark, sf):
    c = tb.casualty(spark, sf).select(*_EX_COLS)
    train = sampling.hash_stratified_sample(c, "severity", C.TRAIN_FRACTIONS, _EX_COLS)
    return sampling.except_split(c, train)


# ---------------------------------------------------------------- features and the prepare jobs

def _prepared(spark, sf, cfg):
    return prepare(tb.joined(spark, sf), cfg)


def _encoded_sql(cfg, select: str) -> str:
    return testbed_ctes(cfg, "encoded") + " " + select


@register("string_index", _encoded_sql(CFG, "SELECT l_orderkey, l_linenumber, l_quantity, l_linestatus, "
                                            + ", ".join(f"{c}_idx" for c in CFG.categorical) + " FROM encoded"))
def q_string_index(spark, sf):
    e = _prepared(spark, sf, CFG).stages["encoded"]
    return e.select("l_orderkey", "l_linenumber", "l_quantity", "l_linestatus", *[f"{c}_idx" for c in CFG.categorical])


_CATEGORIES = ["l_orderkey", "l_partkey", "l_returnflag", "l_tax"]


@register("category_index", "SELECT l_orderkey, l_linenumber, " + ", ".join(f"i{i}.idx AS {c}_idx" for i, c in enumerate(_CATEGORIES)) + " FROM lineitem "
          + " ".join(f"JOIN (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS DOUBLE) AS idx FROM lineitem GROUP BY {c}) i{i} ON {c} = i{i}.v"
                     for i, c in enumerate(_CATEGORIES)))
def q_category_index(spark, sf):
    """Frequency indexes of columns with very many values (order and part keys) and with few."""
    li = _lineitem(spark, sf).select("l_linenumber", *_CATEGORIES)
    out = categories.fit_category_index(li, _CATEGORIES).transform(li)
    return out.select("l_orderkey", "l_linenumber", *[f"{c}_idx" for c in _CATEGORIES])


@register("index_mapping", _encoded_sql(CFG, " UNION ".join(
    f"SELECT DISTINCT {lit(c)} AS column_name, CAST({c} AS VARCHAR) AS value, {c}_idx AS idx FROM encoded" for c in CFG.categorical)))
def q_index_mapping(spark, sf):
    e = _prepared(spark, sf, CFG).stages["encoded"]
    parts = [stats.index_mapping(e, c, f"{c}_idx").select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                                                          F.col(f"{c}_idx").alias("idx")) for c in CFG.categorical]
    return reduce(DataFrame.unionByName, parts)


_ASM = ["l_quantity", "l_tax", "l_linenumber"]


@register("assemble_features", testbed_ctes(CFG, "nulled") + " SELECT l_orderkey, "
          + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 'NaN'::DOUBLE) AS v_{i}" for i, c in enumerate(_ASM)) + " FROM nulled")
def q_assemble_features(spark, sf):
    d = features.assemble(_nulled(spark, sf).select("l_orderkey", *_ASM), _ASM, "vec", "keep")
    return features.vector_columns(d.select("l_orderkey", "vec"), "vec", [f"v_{i}" for i in range(len(_ASM))])


@register("assemble_strict", f"WITH joined AS ({JOINED_SQL}) SELECT l_orderkey, l_linenumber, "
          + ", ".join(f"CAST({c} AS DOUBLE) AS v_{i}" for i, c in enumerate(_CORR_COLS)) + " FROM joined WHERE "
          + " AND ".join(f"{c} IS NOT NULL" for c in _CORR_COLS))
def q_assemble_strict(spark, sf):
    """Complete rows assembled with handleInvalid='error' (a null would fail the job), as the
    correlation input is; the vector is returned as one column per slot."""
    d = tb.joined(spark, sf).select("l_orderkey", *_CORR_COLS).dropna()  # l_linenumber is among the columns
    v = features.assemble(d, _CORR_COLS, "vec", "error").select("l_orderkey", "l_linenumber", "vec")
    return features.vector_columns(v, "vec", [f"v_{i}" for i in range(len(_CORR_COLS))])


_Z = ["l_quantity", "o_totalprice"]


@register("zscore", f"WITH joined AS ({JOINED_SQL}), s AS (SELECT "
          + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_samp(CAST({c} AS DOUBLE)) AS s_{c}" for c in _Z)
          + " FROM joined) SELECT l_orderkey, l_linenumber, "
          + ", ".join(f"round((CAST({c} AS DOUBLE) - (SELECT m_{c} FROM s)) * (1.0 / (SELECT s_{c} FROM s)), {R}) AS z_{i}"
                      for i, c in enumerate(_Z))
          + " FROM joined")
def q_zscore(spark, sf):
    d, _ = features.zscore(tb.joined(spark, sf).select("l_orderkey", "l_linenumber", *_Z), _Z, "raw", "scaled")
    out = features.vector_columns(d.select("l_orderkey", "l_linenumber", "scaled"), "scaled", [f"z_{i}" for i in range(len(_Z))])
    return out.select("l_orderkey", "l_linenumber", *[rnd(f"z_{i}") for i in range(len(_Z))])


def _pipeline_sql(cfg) -> str:
    ctes = testbed_ctes(cfg, "encoded") + ", sc AS (SELECT " + ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS mean_{c}, stddev_samp(CAST({c} AS DOUBLE)) AS std_{c}" for c in cfg.numeric) + " FROM encoded)"
    feats = [f"(CAST({c} AS DOUBLE) - (SELECT mean_{c} FROM sc)) * (1.0 / (SELECT std_{c} FROM sc))" for c in cfg.numeric]
    feats += [f"CAST({c} AS DOUBLE)" for c in cfg.encoded_features]
    return ctes + " SELECT l_orderkey, l_linenumber, l_quantity, l_linestatus, " + ", ".join(
        f"round({e}, {R}) AS f_{i}" for i, e in enumerate(feats)) + " FROM encoded"


@register("feature_pipeline", _pipeline_sql(tb.TESTBED_DROP))
def q_feature_pipeline(spark, sf):
    cfg = tb.TESTBED_DROP
    p = _prepared(spark, sf, cfg)
    binned = p.stages["imputed"].withColumn(cfg.time_bin_column, bin_by_ranges(cfg.time_column, C.TIME_BINS, C.TIME_BIN_OTHER))
    pipe = features.feature_pipeline(cfg.categorical, cfg.numeric, cfg.encoded_features, scaled_numeric=True).fit(binned)
    out = pipe.transform(binned)
    names = [f"f_{i}" for i in range(len(cfg.numeric) + len(cfg.encoded_features))]
    out = features.vector_columns(out.select("l_orderkey", "l_linenumber", "l_quantity", "l_linestatus", "features"), "features", names)
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "l_linestatus", *[rnd(n) for n in names])


def _prepared_out(spark, sf, cfg) -> DataFrame:
    f = _prepared(spark, sf, cfg).frame
    n_feat = len(cfg.numeric) + len(cfg.encoded_features)
    names = [f"f_{i}" for i in range(n_feat)]
    out = features.vector_columns(f.drop("numeric_features_before_scaling", NUM_SCALED if cfg.variant == "drop" else "_none"),
                                  "features", names)
    if cfg.variant == "flag":
        out = features.vector_columns(out, NUM_SCALED, [f"s_{i}" for i in range(len(cfg.numeric))])
    doubles = ["class_weight"] + names + ([f"s_{i}" for i in range(len(cfg.numeric))] if cfg.variant == "flag" else [])
    return out.select(*[rnd(c) if c in doubles else F.col(c) for c in out.columns])


@register("prepare_drop", prepared_select_sql(tb.TESTBED_DROP))
def q_prepare_drop(spark, sf):
    return _prepared_out(spark, sf, tb.TESTBED_DROP)


@register("prepare_flag", prepared_select_sql(tb.TESTBED_FLAG))
def q_prepare_flag(spark, sf):
    return _prepared_out(spark, sf, tb.TESTBED_FLAG)


@register("prepare_drop_approx")
def q_prepare_drop_approx(spark, sf):
    """The original's default: approximate quantiles with relative error 0.01 (no exact oracle)."""
    return _prepared_out(spark, sf, tb.TESTBED_DROP_APPROX)


@register("prepare_approx_facts", testbed_ctes(tb.TESTBED_DROP_APPROX, "dedup") + " SELECT count(*) AS rows, TRUE AS medians_within_error, TRUE AS quartiles_within_error FROM dedup")
def q_prepare_approx_facts(spark, sf):
    """The approximate preparation's fitted numbers, ranked over all rows: each median and quartile lies
    within the relative error of its place."""
    cfg = tb.TESTBED_DROP_APPROX
    p = _prepared(spark, sf, cfg)
    base = files.read_parquet(spark, p.base_path)

    def within(df, wanted):
        """Whether every (column, probability, value) is in its place."""
        n = [F.count(F.col(c)).alias(f"n{i}") for i, (c, _, _) in enumerate(wanted)]
        below = [F.count_if(F.col(c) < v - 1e-9).alias(f"b{i}") for i, (c, _, v) in enumerate(wanted)]
        upto = [F.count_if(F.col(c) <= v + 1e-9).alias(f"u{i}") for i, (c, _, v) in enumerate(wanted)]
        row = df.agg(*n, *below, *upto).first()
        return all(row[f"b{i}"] <= (q + cfg.quantile_error) * row[f"n{i}"] and row[f"u{i}"] >= (q - cfg.quantile_error) * row[f"n{i}"] for i, (_, q, _) in enumerate(wanted))

    medians = [(c, 0.5, v) for c, v in p.fitted["medians"].items()]
    quartiles = [(c, q, b[k]) for c, b in p.fitted["bounds"].items() for q, k in ((0.25, "q1"), (0.75, "q3"))]
    return base.agg(F.count(F.lit(1)).alias("rows"), F.lit(within(base, medians)).alias("medians_within_error"), F.lit(within(p.stages["imputed"], quartiles)).alias("quartiles_within_error"))


#: The 95 % points of the chi-square distribution for 0 to 14 degrees of freedom (0: never reached).
CHI_SQUARE_95 = (0.0, 3.841459, 5.991465, 7.814728, 9.487729, 11.070498, 12.591587, 14.067140, 15.507313, 16.918978, 18.307038, 19.675138, 21.026070, 22.362032, 23.684791)
_CRITICAL = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(CHI_SQUARE_95))


def _chi_sql(cfg) -> str:
    feats = cfg.encoded_features
    hc = hash_condition_sql(cfg.label, cfg.train_fractions, cfg.dedup_keys)
    longs = " UNION ALL ".join(f"SELECT {lit(f)} AS feature, CAST({f} AS DOUBLE) AS v, {cfg.label} AS y FROM tr" for f in feats)
    return (testbed_ctes(cfg, "kept") + f", tr AS (SELECT * FROM kept WHERE {hc}), lg AS ({longs}),"
            " obs AS (SELECT feature, v, y, CAST(count(*) AS DOUBLE) AS o FROM lg GROUP BY ALL),"
            " rt AS (SELECT feature, v, sum(o) AS r FROM obs GROUP BY ALL),"
            " ct AS (SELECT feature, y, sum(o) AS c FROM obs GROUP BY ALL),"
            " nt AS (SELECT feature, sum(o) AS n, count(DISTINCT v) AS nv, count(DISTINCT y) AS ny FROM obs GROUP BY ALL),"
            " st AS (SELECT obs.feature, sum(obs.o * obs.o / (rt.r * ct.c / nt.n)) - max(nt.n) AS s,"
            " CAST((max(nt.nv) - 1) * (max(nt.ny) - 1) AS INTEGER) AS dof FROM obs JOIN rt USING (feature, v) JOIN ct USING (feature, y)"
            " JOIN nt USING (feature) GROUP BY obs.feature),"
            " fin AS (SELECT feature, CASE WHEN dof = 0 THEN 0.0 ELSE s END AS statistic, dof FROM st)"
            f" SELECT feature, round(statistic, 6) AS statistic, dof AS degrees_of_freedom, statistic > CASE dof {_CRITICAL} END AS significant,"
            # the tail from the power series of the lower incomplete gamma function
            " round(CASE WHEN dof = 0 THEN 1.0 ELSE 1.0 - list_sum(list_transform(range(0, 2000), lambda k: exp((dof / 2.0 + k) * ln(statistic / 2.0) - statistic / 2.0 - lgamma(dof / 2.0 + k + 1)))) END, 9) AS p_value,"
            " CAST(row_number() OVER (ORDER BY statistic DESC, feature) AS INTEGER) AS rank FROM fin")


@register("chi_square_rank", _chi_sql(CFG))
def q_chi_square_rank(spark, sf):
    final = _prepared(spark, sf, CFG).frame  # after the outlier step, as the original tests its train rows
    train = sampling.hash_stratified_sample(final, CFG.label, CFG.train_fractions, CFG.dedup_keys)
    r = stats.chi_square(train, CFG.encoded_features, CFG.label)
    return r.select("feature", F.round("statistic", 6).alias("statistic"), "degrees_of_freedom", (F.col("p_value") < 0.05).alias("significant"),
                    F.round("p_value", 9).alias("p_value"), "rank")


def _integrate_sql() -> str:
    return JOINED_SQL


@register("integrate", _integrate_sql())
def q_integrate(spark, sf):
    raw_c, raw_k = tb.raw_casualty(spark, sf), tb.raw_collision(spark, sf)
    col = integ.type_table(raw_k, tb.COLLISION_KEEP, tb.collision_typing())
    slices = []
    old = F.coalesce(F.col("l_shipdate") < "2000", F.lit(True))  # a row without a date is in the archive
    for cond in (old, ~old):
        cas = integ.type_table(raw_c.filter(cond), tb.CASUALTY_KEEP, tb.casualty_typing())
        slices.append((cas, col))
    return integ.integrate(slices, "l_orderkey")


@register("integrate_csv", _integrate_sql())
def q_integrate_csv(spark, sf):
    """The integrate job on real header-CSV files: the raw tables are first written as CSV text
    per period (archive years / latest year, split by the collision's year, as the published
    files are), then read back as all-string tables, pruned, typed, joined per period and
    unioned by name."""
    base = scratch_path(spark, "raw-csv")
    raw_k, li = tb.raw_collision(spark, sf), _lineitem(spark, sf)
    year = F.substring(F.col("o_orderdate"), 7, 4)  # dd/MM/yyyy text
    period = F.when(F.coalesce(year < "2001", F.lit(True)), "archive").otherwise("latest").alias("_period")
    raw_k = raw_k.select("*", period)
    # Both periods come from one join of the typed rows, which are smaller than their text.
    of_key = raw_k.select(F.col("o_orderkey").cast(li.schema["l_orderkey"].dataType).alias("l_orderkey"), "_period")
    raw_c = tb.as_text(li.join(of_key, "l_orderkey"))
    for name, raw in (("casualty", raw_c), ("collision", raw_k)):
        files.write_csv(raw, f"{base}/{name}", partition_by=["_period"])
    slices = []
    for name in ("archive", "latest"):
        cas, col = (files.read_csv(spark, f"{base}/{x}", raw.columns).filter(F.col("_period") == name) for x, raw in (("casualty", raw_c), ("collision", raw_k)))
        slices.append((integ.type_table(cas, tb.CASUALTY_KEEP, tb.casualty_typing()), integ.type_table(col, tb.COLLISION_KEEP, tb.collision_typing())))
    return integ.integrate(slices, "l_orderkey")


# ---------------------------------------------------------------- slices: sinks, states, increments

def _period() -> F.Column:
    return F.coalesce((F.year("l_shipdate") - 1992).cast("int"), F.lit(-1)).alias("period")


_PERIOD_SQL = "CAST(coalesce(year(l_shipdate) - 1992, -1) AS INTEGER)"


@register("slice_sink", f"SELECT l_orderkey, l_linenumber, CASE WHEN period = 3 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, period FROM (SELECT l_orderkey, l_linenumber, l_quantity, {_PERIOD_SQL} AS period FROM lineitem)")
def q_slice_sink(spark, sf):
    """All periods written, then one of them again with other values: only that one is replaced."""
    path = scratch_path(spark, "periods")
    li = _lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", _period())
    slices.write_slices(li, path, "period")
    slices.write_slices(li.filter("period = 3").withColumn("l_quantity", F.col("l_quantity") + 1), path, "period")
    return slices.read_slices(spark, path).select("l_orderkey", "l_linenumber", "l_quantity", "period")


_STATE_COLS = ["l_quantity", "l_extendedprice"]
_STATE_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


@register("quantile_states", " UNION ALL ".join(f"SELECT {lit(c)} AS column_name, p AS prob, count({c}) AS n, TRUE AS within_error FROM lineitem, (SELECT unnest({_STATE_PROBS}::DOUBLE[]) AS p) GROUP BY p" for c in _STATE_COLS))
def q_quantile_states(spark, sf):
    """Quantiles from states kept by period, one period added after the others. Their true ranks are
    counted over all rows: each lies within the stated error of its probability."""
    path = scratch_path(spark, "states")
    li = _lineitem(spark, sf).select(*_STATE_COLS, _period())
    slices.write_quantile_states(li.filter("period <> 4"), _STATE_COLS, "period", path)
    slices.write_quantile_states(li.filter("period = 4"), _STATE_COLS, "period", path)
    found = slices.merged_quantiles(slices.read_slices(spark, path), _STATE_PROBS)
    values = found.collect()  # a row for each listed column and probability
    ranks = li.agg(*[f for i, r in enumerate(values) for f in (F.count_if(F.col(r.column_name) < r.value).alias(f"b{i}"), F.count_if(F.col(r.column_name) <= r.value).alias(f"u{i}"))]).first() if values else None
    e = slices.rank_error()
    rows = [(r.column_name, r.prob, r.n, bool(ranks[f"b{i}"] <= (r.prob + e) * r.n and ranks[f"u{i}"] >= (r.prob - e) * r.n)) for i, r in enumerate(values)]
    return spark.createDataFrame(rows, "column_name string, prob double, n bigint, within_error boolean")


@register("dedup_increment", testbed_ctes(CFG, "dedup") + " SELECT * FROM dedup")
def q_dedup_increment(spark, sf):
    """The cleaned table built from three quarters of the orders and then the rest added: the rows of a full run."""
    d = clean.drop_nulls(_nulled(spark, sf), CFG.required)
    late = F.pmod(F.xxhash64("l_linenumber", "l_quantity"), F.lit(4)) == 3
    path = scratch_path(spark, "clean-ranges")
    bounds = increments.start_clean_table(d.filter(~late), path, CFG.dedup_keys, CFG.dedup_order, 16)
    increments.add_slice(d.filter(late), path, CFG.dedup_keys, bounds, CFG.dedup_order)
    return slices.read_slices(spark, path).select(*d.columns)


@register("integrate_bucketed", JOINED_SQL)
def q_integrate_bucketed(spark, sf):
    """The integrate join over tables stored by buckets of the key."""
    names = [f"sevlab_{x}_{uuid.uuid4().hex[:12]}" for x in ("casualty", "collision")]
    for name, df in zip(names, (tb.casualty(spark, sf), tb.collision(spark, sf))):
        increments.store_bucketed(df, name, "l_orderkey", 16)
    return increments.integrate_stored(spark, *names, "l_orderkey").select(*JOINED_COLS)


_BAD = "l_linenumber = 2 AND l_quantity > 25"


@register("csv_bad_rows", f"SELECT count(*) FILTER (WHERE NOT coalesce({_BAD}, FALSE) AND l_partkey % 50 <> 0) AS good, CAST(sum(l_orderkey) FILTER (WHERE NOT coalesce({_BAD}, FALSE) AND l_partkey % 50 <> 0) AS BIGINT) AS good_keys, "
          f"count(*) FILTER (WHERE {_BAD}) AS short_lines, count(*) FILTER (WHERE NOT coalesce({_BAD}, FALSE) AND l_partkey % 50 = 0) AS no_numbers, count(*) AS placed FROM lineitem")
def q_csv_bad_rows(spark, sf):
    """The line items as CSV text in which some lines lack cells and some hold no number: every line is a good row or a
    reject with its reason, file and line."""
    path = scratch_path(spark, "bad-csv")
    li = _lineitem(spark, sf)
    bad = F.coalesce(F.expr(_BAD), F.lit(False))
    line = F.when(bad, F.col("l_orderkey").cast("string")).otherwise(F.concat_ws(",", F.col("l_orderkey").cast("string"), F.when(F.col("l_partkey") % 50 == 0, "none").otherwise(F.col("l_partkey").cast("string")), F.col("l_quantity").cast("string")))
    li.select(line.alias("l_orderkey,l_partkey,l_quantity")).write.option("header", "true").option("quote", "").option("escapeQuotes", "false").option("sep", "\t").csv(path)
    good, rejects = bad_rows.read_csv_keeping_bad_rows(spark, path, {"l_orderkey": "bigint", "l_partkey": "bigint", "l_quantity": "double"})
    a = good.agg(F.count(F.lit(1)).alias("good"), F.sum("l_orderkey").alias("good_keys"))
    b = rejects.agg(F.count_if(F.col("reason") == "cells").alias("short_lines"), F.count_if(F.col("reason") == "type l_partkey").alias("no_numbers"),
                    (F.count_distinct("file", "line")).alias("places"))
    return a.join(b).select("good", "good_keys", "short_lines", "no_numbers", (F.col("good") + F.col("places")).alias("placed"))


_EXACT_KEY_SQL = "('0x' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR))), 1, 15))::BIGINT"


@register("exact_split", f"SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_EXACT_KEY_SQL}) <= ceil(0.8 * count(*) OVER (PARTITION BY o_orderstatus) - 1e-9) AS in_sample FROM orders")
def q_exact_split(spark, sf):
    """Exactly ceil(0.8 n) orders of each status, and the rest."""
    o = tb.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    sample, rest = exact_sample.exact_split(o, "o_orderstatus", 0.8, ["o_orderkey"])
    return sample.withColumn("in_sample", F.lit(True)).unionByName(rest.withColumn("in_sample", F.lit(False)))


@register("correlation_wide", _corr_sql())
def q_correlation_wide(spark, sf):
    """The correlation matrix from blocked cross products."""
    swapped = tb.joined(spark, sf).withColumn("severity", remap("severity", C.SEVERITY_SWAP))
    return wide.correlation_wide(swapped, _CORR_COLS).select("i", "j", "col_i", "col_j", rnd("r"))


# ---------------------------------------------------------------- model jobs (no SQL oracle)

_MODEL_CACHE: dict[tuple[str, str], tuple] = {}  # path, the fitted model, the rows it was made from
_ROW_KEY_SQL = "('0x' || substr(md5(concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in CFG.dedup_keys) + ")), 1, 15))::BIGINT"
_IN_TRAIN = hash_condition_sql(CFG.label, CFG.train_fractions, ["row_key"])


def _training_table(spark, sf, *more: str) -> DataFrame:
    """What the prepare job writes for training: features, label, class weight, row key (and ``more`` columns).
    Rows lie sorted by their features in each file, so that neighbours walk the same nodes of the trees: these
    are then in the core's cache when a forest of any size scores the table."""
    p = _prepared(spark, sf, CFG)
    keyed = p.frame.withColumn("row_key", forest.row_key(*CFG.dedup_keys)).sortWithinPartitions(*_FEATURES)
    table = cut_lineage(keyed.select("features", CFG.label, "class_weight", "row_key", *more), "train-table")
    p.release()
    return table


_TEST_SQL = testbed_ctes(CFG, "kept") + f", keyed AS (SELECT *, {_ROW_KEY_SQL} AS row_key FROM kept), test AS (SELECT * FROM keyed WHERE NOT {_IN_TRAIN})"


@register("rf_train_score", _TEST_SQL + " SELECT count(*) AS test_rows, " + ", ".join(f"count(*) FILTER (WHERE {CFG.label} = {k}) AS test_{k}" for k in (1, 2, 3))
          + ", count(*) AS in_matrix, TRUE AS f1_as_spark, TRUE AS accuracy_as_counts FROM test")
def q_rf_train_score(spark, sf):
    """The training job on the training table (features, label, weight, row key): sqrt-smoothed weights, 0.8
    per class with the rest held out (complementary hash filters, no join), weighted forest (50 trees, depth
    12, maxBins 64, seed 42). Facts over all held-out rows: how many there are of each class, all of them in
    the confusion matrix, F1 as Spark's evaluator has it, accuracy as the share of equal labels."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    t = train_and_evaluate(_training_table(spark, sf), CFG.label, CFG.train_fractions, C.FOREST_PARAMS, C.SEED, labels=[1, 2, 3], model_path=scratch_path(spark, "forest"))
    pred = cut_lineage(t.predictions.select(CFG.label, "prediction"), "predictions")
    f1 = MulticlassClassificationEvaluator(labelCol=CFG.label, predictionCol="prediction", metricName="f1").evaluate(pred)
    ours = model.evaluate(pred, CFG.label).first()
    matrix = stats.crosstab(pred.withColumn("prediction", F.col("prediction").cast("int")), CFG.label, "prediction", [1, 2, 3])
    cells = matrix.agg(F.sum(F.col("1") + F.col("2") + F.col("3") + F.col("other"))).first()[0]
    right = F.avg((F.col(CFG.label) == F.col("prediction")).cast("int"))
    return pred.agg(F.count(F.lit(1)).alias("test_rows"), *[F.count_if(F.col(CFG.label) == k).alias(f"test_{k}") for k in (1, 2, 3)],
                    F.lit(cells).cast("long").alias("in_matrix"), F.lit(abs(f1 - ours.f1) < 1e-9).alias("f1_as_spark"),
                    (F.abs(right - F.lit(ours.accuracy)) < 1e-9).alias("accuracy_as_counts"))


SMALL_FOREST = {"numTrees": 4, "maxDepth": 2, "maxBins": 64, "seed": C.SEED}
_FEATURES = [*CFG.numeric, *CFG.encoded_features]


@register("forest_by_row_hash", forest_sql(
    testbed_ctes(CFG), "final", _FEATURES, CFG.label, _ROW_KEY_SQL, "sqrt(class_weight)", _IN_TRAIN,
    SMALL_FOREST["numTrees"], SMALL_FOREST["seed"], math.ceil(math.sqrt(len(_FEATURES))), [1, 2, 3]))
def q_forest_by_row_hash(spark, sf):
    """All nodes of a small forest on the training rows: cuts and weights by class."""
    train, _ = split(_training_table(spark, sf), CFG.label, CFG.train_fractions, C.SEED)
    trees = forest.grow(balance.smoothed_weight(train), CFG.label, "smoothed_weight", "row_key", "features", SMALL_FOREST)
    nodes = forest.node_table(spark, trees)
    return nodes.select("tree", "node", "feature", "threshold", *[F.round(F.col("weights")[k], 6).alias(f"weight_{k}") for k in (1, 2, 3)])


def model_path(spark, sf) -> str:
    """Train (once per session and scale) and save the forest the scoring queries load."""
    return _model_path(spark, sf)


def _model_path(spark, sf) -> str:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODEL_CACHE:
        path = scratch_path(spark, "forest")
        table = _training_table(spark, sf, "l_orderkey", "l_linenumber")
        train, _ = split(table, CFG.label, CFG.train_fractions, C.SEED)
        _MODEL_CACHE[key] = (path, fit(balance.smoothed_weight(train), CFG.label, C.FOREST_PARAMS, model_path=path), table)
    return _MODEL_CACHE[key][0]


def _scoring_rows(spark, sf) -> DataFrame:
    """The prepared rows that the training of the saved model has written."""
    _model_path(spark, sf)
    return _MODEL_CACHE[spark.sparkContext.applicationId, sf][2]


_KEPT_COUNT = testbed_ctes(CFG, "kept") + " SELECT count(*) AS rows, {} FROM kept"


@register("model_roundtrip", _KEPT_COUNT.format("CAST(0 AS BIGINT) AS differences"))
def q_model_roundtrip(spark, sf):
    """Predictions of the fitted model and of the one read back, over all rows."""
    from ..sources.models import load_forest
    path = _model_path(spark, sf)
    fitted = _MODEL_CACHE[spark.sparkContext.applicationId, sf][1]
    rows = _scoring_rows(spark, sf).select("features")
    both = model.transform(load_forest(path), model.transform(fitted, rows).select("features", F.col("prediction").alias("before"), F.col("probability").alias("p")))
    same = (F.col("before") == F.col("prediction")) & (vector_to_array("p") == vector_to_array("probability"))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~same).alias("differences"))


@register("batch_score", _KEPT_COUNT.format("count(*) AS sums_to_one, count(*) AS class_0_unused, count(*) AS is_argmax, count(*) AS same_as_vectors"))
def q_batch_score(spark, sf):
    """All rows scored by the saved model, as facts: probabilities sum to 1, class 0 has none, the
    prediction is the greatest one, and vectors made from rows in memory score as the table's do."""
    from .train import score_job
    path = _model_path(spark, sf)
    rows = _scoring_rows(spark, sf).select("l_orderkey", "l_linenumber", "features")
    scored = score_job(path, rows)
    p = [F.col(f"p_{k}") for k in range(4)]
    sample = rows.orderBy("l_orderkey", "l_linenumber").select("features").first()
    one = score_job(path, files.rows_to_frame(spark, [(sample.features,)], ["features"])).select("features", F.col("prediction").alias("one")).first()
    as_vector = (vector_to_array("features") != F.array(*[F.lit(float(x)) for x in sample.features.toArray()])) | (F.col("prediction") == F.lit(one["one"]))
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.abs(p[0] + p[1] + p[2] + p[3] - 1) < 1e-9).alias("sums_to_one"), F.count_if(p[0] == 0).alias("class_0_unused"),
                      F.count_if(F.element_at(F.array(*p), F.col("prediction").cast("int") + 1) == F.greatest(*p)).alias("is_argmax"), F.count_if(as_vector).alias("same_as_vectors"))


# ---------------------------------------------------------------- the profile job

def _profile_sql() -> str:
    src = "nulled"
    miss = " UNION ALL ".join(f"SELECT {lit(c)} AS name, count(*) FILTER (WHERE {c} IS NULL) AS m FROM {src}" for c in JOINED_COLS)
    parts = [f"SELECT 'missing' AS section, CAST(NULL AS INTEGER) AS severity, name, CAST(m AS DOUBLE) AS value FROM ({miss}) WHERE m > 0"]
    parts.append(f"SELECT 'class_share', severity, 'count', CAST(count(*) AS DOUBLE) FROM {src} GROUP BY severity")
    parts.append(f"SELECT 'class_share', severity, 'percent', round(count(*) * 100.0 / sum(count(*)) OVER (), {R}) FROM {src} GROUP BY severity")
    col = "l_quantity"
    box = (f"bq AS (SELECT severity, count(*) AS n, quantile_cont(CAST({col} AS DOUBLE), 0.25) AS q1, "
           f"quantile_cont(CAST({col} AS DOUBLE), 0.5) AS median, quantile_cont(CAST({col} AS DOUBLE), 0.75) AS q3 "
           f"FROM {src} WHERE {col} IS NOT NULL GROUP BY severity), "
           "bf AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM bq), "
           f"bw AS (SELECT bf.severity, min(CASE WHEN s.{col} >= lower_fence AND s.{col} <= upper_fence THEN s.{col} END) AS whisker_low, "
           f"max(CASE WHEN s.{col} >= lower_fence AND s.{col} <= upper_fence THEN s.{col} END) AS whisker_high, "
           f"count(*) FILTER (WHERE NOT (s.{col} >= lower_fence AND s.{col} <= upper_fence)) AS outliers "
           f"FROM {src} s JOIN bf ON s.severity = bf.severity WHERE s.{col} IS NOT NULL GROUP BY bf.severity), "
           "box AS (SELECT bf.*, bw.whisker_low, bw.whisker_high, bw.outliers FROM bf JOIN bw USING (severity))")
    for st in ["n", "q1", "median", "q3", "lower_fence", "upper_fence", "whisker_low", "whisker_high", "outliers"]:
        parts.append(f"SELECT 'box', severity, {lit(st)}, round(CAST({st} AS DOUBLE), {R}) FROM box")
    for c, bins in C.HISTOGRAM_BINS.items():
        tc = {"age_of_casualty": "l_quantity", "speed_limit": "l_tax"}[c]
        parts.append(
            f"SELECT 'histogram_{tc}', severity, 'bin_' || CAST(bin AS VARCHAR), CAST(count(*) AS DOUBLE) FROM (SELECT s.severity, "
            f"CAST(least(floor((CAST(s.{tc} AS DOUBLE) - (SELECT min(CAST({tc} AS DOUBLE)) FROM {src})) / "
            f"((SELECT max(CAST({tc} AS DOUBLE)) - min(CAST({tc} AS DOUBLE)) FROM {src}) / {bins})), {bins - 1}) AS INTEGER) AS bin "
            f"FROM {src} s WHERE s.{tc} IS NOT NULL) GROUP BY ALL")
    return testbed_ctes(CFG, "nulled") + ", " + box + " " + " UNION ALL ".join(parts)


@register("profile", _profile_sql())
def q_profile(spark, sf):
    """Missing values, class shares, box numbers of quantity per severity and the 30/15-bin
    histograms (quantity, tax), after sentinels -> null: one long table."""
    from .profile import profile, profile_long
    bins = {"l_quantity": C.HISTOGRAM_BINS["age_of_casualty"], "l_tax": C.HISTOGRAM_BINS["speed_limit"]}
    parts = profile(tb.joined(spark, sf), CFG.sentinels, "severity", "l_quantity", bins)
    return profile_long(parts, "severity").select("section", "severity", "name", rnd("value"))
