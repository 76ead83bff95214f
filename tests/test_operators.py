"""Edge cases of the column functions and operators."""

import math

import pytest
from pyspark.sql import functions as F

from sevlab import config as C
from sevlab.functions import bin_by_ranges, hour_of, null_if, parse_date, remap, to_int, unit_hash
from sevlab.operators import balance, clean, outliers, stats


def test_time_bin_edges(spark):
    hours = [4, 5, 10, 11, 13, 14, 17, 18, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r.b for r in df.select(bin_by_ranges("h", C.TIME_BINS, C.TIME_BIN_OTHER).alias("b")).collect()]
    assert got == [4, 1, 1, 2, 2, 3, 3, 4, 4]


def test_hour_and_date_parsing(spark):
    df = spark.createDataFrame([("08:15", "05/03/2019"), ("23:40", "24/12/2020")], "t string, d string")
    r = df.select(hour_of("t").alias("h"), parse_date("d", C.DATE_FORMAT).alias("d")).collect()
    assert [x.h for x in r] == [8, 23]
    assert [x.d.isoformat() for x in r] == ["2019-03-05", "2020-12-24"]


def test_malformed_text_fails_or_nulls(spark):
    bad = spark.createDataFrame([("abc", "1/2/2024", "xx:10")], "n string, d string, t string")
    with pytest.raises(Exception):
        bad.select(to_int("n")).collect()
    with pytest.raises(Exception):
        bad.select(parse_date("d", C.DATE_FORMAT)).collect()
    r = bad.select(to_int("n", "null").alias("n"), parse_date("d", C.DATE_FORMAT, "null").alias("d"),
                   hour_of("t", ":", "null").alias("h")).first()
    assert r.n is None and r.d is None and r.h is None


def test_sentinels_and_swap(spark):
    df = spark.createDataFrame([(-1, 9, 1), (2, -1, 3), (None, 1, 2)], "a int, s int, sev int")
    out = clean.sentinels_to_null(df, {"a": (-1,), "s": (-1, 9)})
    assert [tuple(r) for r in out.collect()] == [(None, None, 1), (2, None, 3), (None, 1, 2)]
    sw = df.select(remap("sev", C.SEVERITY_SWAP).alias("x")).collect()
    assert [r.x for r in sw] == [3, 1, 2]
    assert df.select(null_if("a", [-1]).alias("x")).collect()[0].x is None


def test_tied_mode_all_null_and_empty(spark):
    df = spark.createDataFrame([(2, None), (3, None), (3, None), (2, None)], "v int, n int")
    assert clean.fit_modes(df, ["v", "n"]) == {"v": 2, "n": None}
    assert clean.fit_medians(df, ["n"], 0.01) == {"n": None}
    filled = clean.fill_values(df, {"n": None, "v": 5})  # all-null column skipped
    assert filled.filter(F.col("n").isNull()).count() == 4
    empty = df.limit(0)
    assert clean.fit_modes(empty, ["v"]) == {"v": None}
    assert clean.dedup(empty, ["v"], ()).count() == 0


def test_median_into_int_column_truncates(spark):
    df = spark.createDataFrame([(None,), (1,)], "x int")
    assert [r.x for r in clean.fill_values(df, {"x": 30.7}).collect()] == [30, 1]


def test_exact_and_approx_quantiles(spark):
    df = spark.range(1, 11).select(F.col("id").cast("double").alias("x"))
    assert clean.fit_quantiles(df, ["x"], [0.25, 0.5, 0.95], 0.0) == {"x": [3.0, 5.0, 10.0]}
    approx = clean.fit_quantiles(df, ["x"], [0.5], 0.01)["x"][0]
    assert approx == df.approxQuantile("x", [0.5], 0.01)[0]


def test_dedup_deterministic_survivor(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", None, "z"), ("j", 2, "c")], "k string, v int, w string")
    out = {r.k: (r.v, r.w) for r in clean.dedup(df, ["k"], ["v", "w"]).collect()}
    assert out == {"k": (None, "z"), "j": (2, "c")}  # nulls first
    assert clean.dedup(df, ["k"]).count() == 2


def test_null_keys_compare_equal_in_dedup(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "k int, v int")
    assert clean.dedup(df, ["k"], ()).count() == 1


def test_outlier_bounds_filter_and_flags(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100, None]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    b = outliers.fit_iqr_bounds(df, ["x"], 0.0)
    assert b["x"]["q1"] == 3.0 and b["x"]["q3"] == 7.0
    f = outliers.fences(b)
    assert sorted(r.x for r in outliers.drop_outside(df, f).collect()) == [1, 2, 3, 4, 5, 6, 7, 8]  # null rejected
    flagged = outliers.flag_outliers(df, f).collect()
    assert {(r.x, r.x_is_outlier, r.has_any_outlier) for r in flagged if r.x in (100, None)} == {(100, 1, 1), (None, 0, 0)}
    kept = outliers.domain_filter(df, {"x": (0, 50)})
    assert kept.count() == 9  # null kept, 100 dropped


def test_null_label_gets_null_weight(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "y int")
    w = balance.attach_class_weight(df, "y").collect()
    got = sorted(((r.y, r.class_weight) for r in w), key=lambda t: (t[0] is None, t[0]))
    assert got == [(1, 1.0), (1, 1.0), (2, 2.0), (None, None)]
    sm = balance.smoothed_weight(spark.createDataFrame([(4.0,)], "class_weight double")).first()
    assert sm.smoothed_weight == 2.0


def test_many_classes_and_a_null_class(spark):
    """1,500 classes and a null one: same columns and rows as for a few."""
    df = spark.range(3001).select((F.col("id") * 2).alias("v"), F.when(F.col("id") < 3000, F.col("id") % 1500).alias("y"))
    out = balance.attach_class_weight(df, "y")
    assert out.columns == ["v", "y", "class_weight"]
    assert {(r.y is None, r.class_weight) for r in out.collect()} == {(False, 1.0), (True, None)}
    share = stats.class_share(df, "y").collect()
    assert len(share) == 1501 and abs(sum(r.percent for r in share) - 100) < 1e-9


def test_crosstab_counts_every_row(spark):
    df = spark.createDataFrame([(1, 1), (1, 4), (2, 9), (2, None)], "y int, p int")
    got = [tuple(r) for r in stats.crosstab(df, "y", "p", [1, 2, 3]).collect()]
    assert got == [(1, 1, 0, 0, 1), (2, 0, 0, 0, 2)]


def test_nan_is_missing_everywhere(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, float(i), i * 2.0) for i in range(100)] + [(1, nan, 1.0)] * 300 + [(None, 5.0, None)], "y int, x double, z double")
    whole = df.filter("y = 1").approxQuantile("x", [0.25, 0.5, 0.75], 0.0)
    for err in (0.0, 0.01):
        got = clean.fit_quantiles(df.filter("y = 1"), ["x"], [0.25, 0.5, 0.75], err)["x"]
        assert all(abs(a - b) <= 100 * err + 1 for a, b in zip(got, whole))
    filled, medians = clean.impute_median(df.select(F.when(~F.isnan("x"), F.col("x")).alias("x")), ["x"], 0.0)
    assert medians["x"] is not None and filled.filter("x IS NULL").count() == 0
    box = {r.y: r for r in stats.box_stats(df, "y", "x").collect()}
    assert (box[1].n, box[1].q1, box[1].q3, box[1].outliers) == (100, 24.75, 74.25, 0)
    assert (box[None].n, box[None].median) == (1, 5.0)
    h = {(r.y, r.bin): r["count"] for r in stats.histogram(df.filter("y = 1"), "y", "x", 2).collect()}
    assert sum(h.values()) == 100 and set(h) == {(1, 0), (1, 1)}
    r = {(r.i, r.j): r.r for r in stats.correlation_long(df, ["x", "z"]).collect()}
    assert abs(r[0, 1] - 1.0) < 1e-12  # rows with a missing value are left out of every pair
    assert clean.fit_modes(df, ["x", "y"]) == {"x": 5.0, "y": 1}


def test_cleaning_counts_without_required_columns(spark):
    from dataclasses import replace

    from sevlab.plans import testbed as tb
    from sevlab.plans.prepare import clean_counts
    cfg = replace(tb.TESTBED_FLAG, required=[], sentinels={}, dedup_keys=["k"])
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [r["rows"] for r in clean_counts(df, cfg).orderBy("step_no").collect()] == [3, 3, 3, 2]


def test_nothing_stays_cached_or_on_disk(spark):
    import os

    from sevlab.plans.profile import profile, profile_long
    from sevlab.session import release_scratch, shared_dir
    release_scratch(spark)
    df = spark.createDataFrame([(1, 2.0, 3), (2, 4.0, 5), (1, 1.0, -1)], "y int, x double, s int")
    assert profile_long(profile(df, {"s": (-1,)}, "y", "x", {"x": 2}), "y").count() > 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    assert release_scratch(spark) > 0
    root = f"{shared_dir(spark)}/sevlab".removeprefix("file:")
    assert not os.path.exists(root) or not os.listdir(root)


def test_correlation_constant_column_and_symmetry(spark):
    df = spark.createDataFrame([(1, 2, 5), (2, 4, 5), (3, 7, 5)], "a int, b int, c int")
    m = {(r.i, r.j): r.r for r in stats.correlation_long(df, ["a", "b", "c"]).collect()}
    assert m[(0, 0)] == 1.0 and m[(2, 2)] == 1.0 and m[(0, 1)] == m[(1, 0)]
    assert math.isnan(m[(0, 2)]) and math.isnan(m[(2, 1)])
    assert abs(m[(0, 1)] - 0.9933992677987828) < 1e-12


def test_histogram_top_edge_and_constant(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 5.0), (2, 10.0)], "y int, x double")
    h = {(r.y, r.bin): r["count"] for r in stats.histogram(df, "y", "x", 2).collect()}
    assert h == {(1, 0): 1, (1, 1): 1, (2, 1): 1}  # the maximum falls in the last bin
    c = spark.createDataFrame([(1, 3.0), (1, 3.0)], "y int, x double")
    assert [r["count"] for r in stats.histogram(c, "y", "x", 5).collect()] == [2]


def test_box_stats_whiskers(spark):
    rows = [(1, float(v)) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]]
    b = stats.box_stats(spark.createDataFrame(rows, "y int, x double"), "y", "x").first()
    assert (b.q1, b.median, b.q3) == (3.0, 5.0, 7.0)
    assert b.whisker_low == 1.0 and b.whisker_high == 8.0 and b.outliers == 1


def test_chi_square_constant_feature(spark):
    df = spark.createDataFrame([(0.0, 1.0, 1), (0.0, 2.0, 2), (0.0, 1.0, 1), (0.0, 2.0, 2)], "a double, b double, y int")
    r = {x.feature: x for x in stats.chi_square(df, ["a", "b"], "y").collect()}
    assert r["a"].degrees_of_freedom == 0 and r["a"].statistic == 0.0
    assert r["b"].degrees_of_freedom == 1 and abs(r["b"].statistic - 4.0) < 1e-12
    assert r["b"].rank == 1 and 0.0 <= r["b"].p_value <= 1.0


def test_step_counts_and_class_share(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,)], "y int")
    counts = stats.step_row_counts({"all": df, "ones": df.filter("y = 1")}).orderBy("step_no").collect()
    assert [(r.step, r.rows) for r in counts] == [("all", 4), ("ones", 2)]
    share = {r.y: r.percent for r in stats.class_share(df, "y").collect()}
    assert share == {1: 50.0, 2: 25.0, 3: 25.0}


def test_unit_hash_is_stable(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    a = [r.h for r in df.select(unit_hash(["k", "s"]).alias("h")).collect()]
    b = [r.h for r in df.repartition(3).orderBy("k").select(unit_hash(["k", "s"]).alias("h")).collect()]
    assert a == b and all(0 <= x < 1000 for x in a)


def test_feature_list_guard():
    from dataclasses import replace
    with pytest.raises(ValueError):
        replace(C.ROAD_CASUALTY, numeric=["casualty_severity", "speed_limit"])
    with pytest.raises(ValueError):
        replace(C.ROAD_CASUALTY, variant="other")
    assert C.LABEL not in C.ROAD_CASUALTY.feature_columns()
    assert len(C.ROAD_CASUALTY.feature_columns()) == 12


def test_exact_quantiles_match_percentile_disc(spark):
    from sevlab.operators.quantiles import exact_quantiles
    # skewed data: one value holds a third of the rows, plus nulls and a long tail
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 7919 % 10007).cast("double")).alias("x"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 97).alias("y"))
    probs = [0.0, 0.01, 0.1, 0.25, 0.3, 0.5, 0.7, 0.75, 0.9, 0.95, 0.999, 1.0]
    exp = {}
    for c in ["x", "y"]:
        row = df.agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY CAST({c} AS DOUBLE))").alias(f"p{i}")
                       for i, p in enumerate(probs)]).first()
        exp[c] = [float(row[f"p{i}"]) for i in range(len(probs))]
    assert exact_quantiles(df, ["x", "y"], probs) == exp
    assert exact_quantiles(df.repartition(7), ["x", "y"], probs) == exp
    assert exact_quantiles(df.filter("x < -1"), ["x"], [0.5]) == {"x": None}


def test_assemble_keep_vs_error(spark):
    from sevlab.operators.features import assemble
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    kept = assemble(df, ["a", "b"], "v", "keep").orderBy("a").collect()
    assert math.isnan(kept[0].v[1]) and list(kept[1].v) == [2.0, 3.0]
    with pytest.raises(Exception):
        assemble(df, ["a", "b"], "v", "error").collect()


def test_grouped_quantiles_match_percentile(spark):
    from sevlab.operators.quantiles import grouped_quantiles
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 4 < 3, F.col("id") % 4).cast("int").alias("g"),
        F.when(F.col("id") % 5 == 0, F.lit(42.0)).otherwise((F.col("id") * 7919 % 10007).cast("double")).alias("x"))
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    want = {r.g: list(r.q) for r in df.groupBy("g").agg(F.percentile("x", probs).alias("q")).collect()}
    got = {r.g: list(r.q) for r in grouped_quantiles(df, "g", "x", probs).collect()}
    assert set(got) == set(want) and None in got
    for g in want:
        assert all(abs(a - b) <= 1e-9 * max(1.0, abs(b)) for a, b in zip(got[g], want[g])), (g, got[g], want[g])
