"""Profiles and statistics. Every operator is one distributed aggregation (partial + final);
only aggregated rows of bounded size ever reach the driver."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_missing, number
from ..functions.special import chi_square_tail
from ..session import scratch_path
from .clean import fit_quantiles, quantile_expr


def step_row_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each named stage: (step_no, step, rows). The counts are a union of
    aggregates, so Spark runs them in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(i).alias("step_no"), F.lit(name).alias("step"), "rows")
        for i, (name, df) in enumerate(stages.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def group_count(df: DataFrame, key: str | Sequence[str], name: str = "count") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def class_share(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and their percentage of all rows, for any number of classes. Only the total
    comes to the driver; no window gathers the classes in one task."""
    return group_count(df, label).withColumn("percent", F.col("count") * 100.0 / F.lit(df.count()))


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``min_<c>``, ``max_<c>`` for every column."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def missing_profile(df: DataFrame) -> DataFrame:
    """One wide row: number of missing values (null, or NaN for float/double) per column."""
    return df.select(*[F.count(F.when(is_missing(c, t), F.lit(1))).alias(c) for c, t in df.dtypes])


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, long form (feature, missing), most missing first."""
    wide = missing_profile(df)
    long = wide.unpivot([], [F.col(c) for c in wide.columns], "feature", "missing")
    return long.filter(F.col("missing") > 0).orderBy(F.col("missing").desc(), F.col("feature"))


def missing_total(df: DataFrame) -> DataFrame:
    """One row: total number of missing cells."""
    wide = missing_profile(df)
    total = reduce(lambda a, b: a + b, [F.col(c) for c in wide.columns], F.lit(0).cast("bigint"))
    return wide.select(total.alias("missing_total"))


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], rel_error: float) -> DataFrame:
    """Long form (column_name, prob, value) of several quantiles of several columns.
    Approximate: one lazy aggregation. Exact: from value counts; a row a column becomes a small table."""
    if rel_error == 0:
        q = fit_quantiles(df, cols, probs, 0.0)
        rows = [(c, float(p), (q[c][i] if q[c] else None)) for c in cols for i, p in enumerate(probs)]
        return df.sparkSession.createDataFrame(rows, "column_name string, prob double, value double")
    wide = df.agg(*[quantile_expr(c, probs, rel_error).alias(c) for c in cols])
    parts = [
        F.struct(F.lit(c).alias("column_name"), F.lit(float(p)).alias("prob"), F.col(c)[i].alias("value"))
        for c in cols
        for i, p in enumerate(probs)
    ]
    return wide.select(F.explode(F.array(*parts)).alias("q")).select("q.*")


def iqr_table(df: DataFrame, cols: Sequence[str], rel_error: float, factor: float = 1.5) -> DataFrame:
    """(column_name, q1, q3, iqr, lower_bound, upper_bound) of every column."""
    q = quantile_table(df, cols, [0.25, 0.75], rel_error)
    t = q.groupBy("column_name").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return t.select(
        "column_name", "q1", "q3", iqr.alias("iqr"),
        (F.col("q1") - F.lit(factor) * iqr).alias("lower_bound"),
        (F.col("q3") + F.lit(factor) * iqr).alias("upper_bound"),
    )


def index_mapping(df: DataFrame, col: str, idx_col: str) -> DataFrame:
    """Distinct (value, index) pairs of an indexed column."""
    return df.select(col, idx_col).distinct()


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Long-form confusion matrix: (label, prediction, count)."""
    return group_count(df, [label, prediction])


def crosstab(df: DataFrame, a: str, b: str, b_values: Sequence) -> DataFrame:
    """Wide cross tabulation: one column per listed value of ``b`` (0 where absent) and ``other`` for
    all other values and nulls, so every row is counted. The values are passed in, so no pass is
    spent discovering them; rows ordered by ``a``."""
    listed = [F.count_if(F.col(b) == F.lit(v)).alias(str(v)) for v in b_values]
    other = F.count_if(~F.coalesce(F.col(b).isin(list(b_values)), F.lit(False))).alias("other")
    return df.groupBy(a).agg(*listed, other).orderBy(F.col(a))


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form (i, j, col_i, col_j, r).

    One aggregation computes the k(k-1)/2 sample covariances and the k standard deviations
    (co-moments merged per partition; no vector is built). As Spark ML's ``Correlation.corr``:
    1.0 on the diagonal, NaN where a column is constant (no ANSI division error). Rows with a
    missing value in any of the columns are left out, so every pair is over the same rows."""
    k = len(cols)
    df = df.select(*[number(c).alias(c) for c in cols]).dropna()
    x = [F.col(c) for c in cols]
    aggs = [F.stddev_samp(x[i]).alias(f"s{i}") for i in range(k)]
    aggs += [F.covar_samp(x[i], x[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i + 1, k)]
    wide = df.agg(*aggs)
    cells = []
    for i in range(k):
        for j in range(k):
            if i == j:
                r = F.lit(1.0)
            else:
                a, b = min(i, j), max(i, j)
                r = F.coalesce(F.try_divide(F.col(f"c{a}_{b}"), F.col(f"s{a}") * F.col(f"s{b}")), F.lit(float("nan")))
            cells.append(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(cols[i]).alias("col_i"),
                                  F.lit(cols[j]).alias("col_j"), r.alias("r")))
    return wide.select(F.explode(F.array(*cells)).alias("m")).select("m.*")


def chi_square(df: DataFrame, feature_cols: Sequence[str], label: str) -> DataFrame:
    """Pearson chi-square independence test of each feature against the label, from contingency counts.

    One aggregation counts the (feature, value, label) cells of all features with a map-side combine; row and
    column sums come from the cells, so a feature may have any number of values and none of them reaches the
    driver. Cells without rows add their expected counts, which are the total less those of the others.
    Values are read as doubles; null and NaN are one value of their own; rows without a label take no part.
    Returns (feature, statistic, degrees_of_freedom, p_value, rank), rank 1 = largest statistic, ties by name.
    A feature with one value, or a table with one label, has statistic 0 and p-value 1."""
    y = F.col(label).cast("double")
    value = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in feature_cols]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), v.alias("v")) for c, v in zip(feature_cols, value)])
    cells = (df.select(y.alias("y"), F.explode(pairs).alias("p")).filter(F.col("y").isNotNull()).select("y", "p.*")
             .groupBy("feature", "v", "y").agg(F.count(F.lit(1)).cast("double").alias("o")))
    path = scratch_path(df.sparkSession, "contingency")  # the counts are read by each sum below
    cells.write.parquet(path)
    cells = df.sparkSession.read.parquet(path)
    by_value = cells.groupBy("feature", "v").agg(F.sum("o").alias("r"))
    by_label = cells.groupBy("feature", "y").agg(F.sum("o").alias("c"))
    n = by_label.groupBy("feature").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("labels"))
    n = n.join(by_value.groupBy("feature").agg(F.count(F.lit(1)).alias("values")), "feature")
    expected = F.col("r") * F.col("c") / F.col("n")
    joined = cells.join(by_value, ["feature", "v"]).join(by_label, ["feature", "y"]).join(n, "feature")
    sums = joined.groupBy("feature").agg(F.sum(F.pow(F.col("o") - expected, F.lit(2.0)) / expected).alias("found"), F.sum(expected).alias("expected"),
                                         F.max("n").alias("n"), F.max((F.col("values") - 1) * (F.col("labels") - 1)).cast("int").alias("degrees_of_freedom"))
    statistic = F.when(F.col("degrees_of_freedom") == 0, 0.0).otherwise(F.greatest(F.col("found") + F.col("n") - F.col("expected"), F.lit(0.0)))
    tested = sums.select("feature", statistic.alias("statistic"), "degrees_of_freedom", chi_square_tail(statistic, F.col("degrees_of_freedom")).alias("p_value"))
    order = Window.orderBy(F.col("statistic").desc(), "feature")  # a row for each listed feature
    return tested.withColumn("rank", F.row_number().over(order))


def box_stats(df: DataFrame, label: str, col: str, factor: float = 1.5) -> DataFrame:
    """Box-plot numbers of ``col`` per ``label`` (a null label too): quartiles (linear interpolation),
    IQR fences, whiskers at the last value inside the fences, outlier count. Whole data, no sample;
    nulls and NaN are left out. All numbers come from one count of the (label, value) pairs, which
    is much smaller than the rows; the pairs meet their label's fences in an equi join."""
    from .quantiles import interpolated, ranked, value_counts

    ranks = ranked(value_counts(df, [col], label))
    q = interpolated(ranks, [0.25, 0.5, 0.75]).select(F.col("g").alias("label"), "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumns({"lower_fence": F.col("q1") - factor * iqr, "upper_fence": F.col("q3") + factor * iqr})
    pairs = ranks.select("g", "v", F.col("n").alias("rows"))
    inside = F.col("v").between(F.col("lower_fence"), F.col("upper_fence"))
    numbers = ["n", "q1", "median", "q3", "lower_fence", "upper_fence"]
    return pairs.join(q, F.col("g").eqNullSafe(F.col("label"))).groupBy(F.col("label").alias(label), *numbers).agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("rows"))), F.lit(0)).alias("outliers"),
    )


def histogram(df: DataFrame, label: str, col: str, bins: int) -> DataFrame:
    """Equal-width histogram of ``col`` per ``label``: (label, bin, bin_low, bin_high, count).
    Edges span the column's min..max; the maximum falls in the last bin."""
    return histograms(df, label, {col: bins})[col]


def histograms(df: DataFrame, label: str, bins_by_col: Mapping[str, int]) -> dict[str, DataFrame]:
    """Histograms of several columns as separate frames (views of ``histogram_long``)."""
    long = histogram_long(df, label, bins_by_col)
    return {c: long.filter(F.col("column_name") == c).drop("column_name") for c in bins_by_col}


def histogram_long(df: DataFrame, label: str, bins_by_col: Mapping[str, int]) -> DataFrame:
    """Equal-width histograms of several columns per ``label`` in long form
    (column_name, label, bin, bin_low, bin_high, count). Two passes whatever the number of
    columns: one shared min/max aggregation, then one aggregation over (column, bin) pairs
    exploded from each row. Edges span each column's min..max; the maximum is in the last bin."""
    cols = list(bins_by_col)
    aggs = []
    for i, c in enumerate(cols):
        x = number(c)
        aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    mm = df.agg(*aggs).first()
    edges = {}
    for i, c in enumerate(cols):
        lo, hi = mm[f"lo{i}"], mm[f"hi{i}"]
        if lo is not None:
            edges[c] = (lo, (hi - lo) / bins_by_col[c])
    schema = (f"column_name string, {label} {dict(df.dtypes)[label]}, bin int, bin_low double, bin_high double, "
              "count bigint")
    if not edges:
        return df.sparkSession.createDataFrame([], schema)
    cells = []
    for c, (lo, width) in edges.items():
        x = number(c)
        last = bins_by_col[c] - 1
        b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(last)) if width > 0 else F.lit(0)
        cells.append(F.struct(F.lit(c).alias("column_name"), F.when(x.isNotNull(), b).alias("bin")))
    exploded = df.select(F.col(label), F.explode(F.array(*cells)).alias("h")).select(label, "h.*").filter(F.col("bin").isNotNull())
    counted = exploded.groupBy("column_name", label, "bin").agg(F.count(F.lit(1)).alias("count"))
    lo_e = width_e = None
    for c, (lo, width) in edges.items():
        cond = F.col("column_name") == F.lit(c)
        lo_e = F.when(cond, F.lit(lo)) if lo_e is None else lo_e.when(cond, F.lit(lo))
        width_e = F.when(cond, F.lit(width)) if width_e is None else width_e.when(cond, F.lit(width))
    return counted.select(
        "column_name", label, "bin",
        (lo_e + F.col("bin") * width_e).alias("bin_low"),
        (lo_e + (F.col("bin") + 1) * width_e).alias("bin_high"),
        "count",
    )
