"""Binding of the casualty/collision roles to the TPC-H-like test tables.

No casualty data ships with the tests, so ``lineitem`` plays the casualty table (many rows per
key) and ``orders`` the collision table (one row per key), joined on the order key:

=====================  ===========================  =======================================
role (road data)       test column                  typing / missing code
=====================  ===========================  =======================================
collision_index        l_orderkey (= o_orderkey)    bigint key
casualty_class         l_linenumber                 int, 7 = missing
age_of_casualty        l_quantity                   int, 50 = missing
speed_limit            l_tax                        double, 0.08 = missing
sex_of_casualty        l_linestatus                 string
casualty_severity      severity                     l_returnflag A/N/R -> 1/2/3
road_type              o_orderstatus                string, P = missing, filled with U
weather_conditions     o_orderpriority              string, "4-NOT SPECIFIED" = missing
date                   o_orderdate                  date (text dd/MM/yyyy in the raw form)
time                   o_hour                       hour of the order time (text HH:mm raw)
day_of_week            o_dow                        int 1..7
collision_severity     o_totalprice                 double (numeric side column)
=====================  ===========================  =======================================

The order timestamps carry no time of day (all 00:00), so ``o_hour`` is 0 and every row
falls in the night bin; hour binning is exercised on ``events.ts`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DATE_FORMAT, DOMAIN_BOUNDS, IQR_FACTOR, SEED, TRAIN_FRACTIONS, PrepConfig
from ..functions import hour_of, parse_date, remap

# Test-binding values (ours, not the original pipeline's): label coding of l_returnflag.
SEVERITY_CODES = {"A": 1, "N": 2, "R": 3}
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def severity_of(flag: str | Column) -> Column:
    return remap(flag, SEVERITY_CODES).cast("int")


# ---- raw (all-string, CSV-like) forms, as the integrate job receives them -------------

def raw_casualty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as header-CSV text: every column a string."""
    return as_text(table(spark, sf_dir, "lineitem"))


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def raw_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as header-CSV text, with the date as dd/MM/yyyy and the time as HH:mm."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_orderstatus"),
        F.date_format("o_orderdate", DATE_FORMAT).alias("o_orderdate"),
        F.date_format("o_orderdate", "HH:mm").alias("o_time"),
        F.dayofweek("o_orderdate").cast("string").alias("o_dow"),
        F.col("o_orderpriority"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
    )


CASUALTY_KEEP = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_tax"]
COLLISION_KEEP = ["o_orderkey", "o_orderstatus", "o_orderdate", "o_time", "o_dow", "o_orderpriority", "o_totalprice"]


def casualty_typing(on_error: str = "fail") -> dict:
    """Typed projection of the raw casualty text (spec for ``typed_projection``)."""
    q = F.col("l_quantity")
    q = q.try_cast("double") if on_error == "null" else q.cast("double")
    return {
        "l_orderkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": q.cast("int"),
        "severity": severity_of("l_returnflag"),
        "l_linestatus": None,
        "l_tax": "double",
    }


def collision_typing(on_error: str = "fail") -> dict:
    key = F.col("o_orderkey")
    return {
        "l_orderkey": key.try_cast("bigint") if on_error == "null" else key.cast("bigint"),
        "o_orderstatus": None,
        "o_orderdate": parse_date("o_orderdate", DATE_FORMAT, on_error),
        "o_hour": hour_of("o_time", ":", on_error),
        "o_dow": "int",
        "o_orderpriority": None,
        "o_totalprice": "double",
    }


# ---- typed, joined table (what the integrate job writes), straight from parquet --------

def casualty(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        F.col("l_quantity").cast("int").alias("l_quantity"),
        severity_of("l_returnflag").alias("severity"),
        "l_linestatus",
        "l_tax",
    )


def collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.hour("o_orderdate").cast("int").alias("o_hour"),
        F.dayofweek("o_orderdate").cast("int").alias("o_dow"),
        "o_orderpriority",
        "o_totalprice",
    )


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """casualty ⋈ collision on the key (inner; the key kept once)."""
    return casualty(spark, sf_dir).join(collision(spark, sf_dir), on="l_orderkey", how="inner")


def _config(variant: str, quantile_error: float) -> PrepConfig:
    return PrepConfig(
        key="l_orderkey",
        label="severity",
        sentinels={
            "l_linenumber": (7,),
            "l_quantity": (50,),
            "l_tax": (0.08,),
            "o_orderstatus": ("P",),
            "o_orderpriority": ("4-NOT SPECIFIED",),
        },
        required=["l_linenumber", "o_orderdate", "o_hour", "l_linestatus"],
        dedup_keys=["l_orderkey", "l_linenumber", "l_quantity", "l_linestatus"],
        dedup_order=(),  # survivor = smallest remaining columns, so the oracle can reproduce it
        median_columns=["l_tax", "l_quantity"],
        mode_columns=["o_orderpriority", "l_linestatus"],
        constant_fill={"o_orderstatus": "U"},
        time_column="o_hour",
        categorical=["o_orderstatus", "l_linenumber", "l_linestatus", "o_orderpriority", "time_bin"],
        numeric=["l_quantity", "l_tax"],
        extra_features=["o_dow"],
        outlier_columns=["l_quantity", "l_tax"],
        domain_bounds={"l_quantity": DOMAIN_BOUNDS["age_of_casualty"], "l_tax": DOMAIN_BOUNDS["speed_limit"]},
        train_fractions=TRAIN_FRACTIONS,
        variant=variant,
        quantile_error=quantile_error,
        iqr_factor=IQR_FACTOR,
        seed=SEED,
    )


# Exact quantiles (error 0) make the prepared table reproducible by the SQL oracle; the
# quantile columns here are coded (50 and 9 distinct values), so the exact buffer is tiny.
TESTBED_DROP = _config("drop", 0.0)
TESTBED_FLAG = _config("flag", 0.0)
TESTBED_DROP_APPROX = _config("drop", 0.01)
