"""The road-casualty pipeline on the literal rows of FIXTURES.md, with the expected results."""

from pyspark.sql import functions as F

from sevlab import config as C
from sevlab.operators import balance, clean, stats
from sevlab.plans import road
from sevlab.plans.prepare import clean as clean_steps


def test_inner_join_shape(joined):
    assert joined.count() == 6  # C9 has no collision
    assert len(joined.columns) == 16
    assert joined.columns.count("collision_index") == 1
    types = dict(joined.dtypes)
    assert types["date"] == "date" and types["time"] == "int" and types["collision_index"] == "string"


def test_missing_after_sentinels(joined):
    d = clean.sentinels_to_null(joined, C.ROAD_CASUALTY.sentinels)
    row = stats.missing_profile(d).first().asDict()
    expected = {"sex_of_casualty": 1, "age_of_casualty": 3, "road_type": 1, "speed_limit": 1,
                "weather_conditions": 1, "road_surface_conditions": 1, "urban_or_rural_area": 1}
    for c, v in row.items():
        assert v == expected.get(c, 0), c
    rep = stats.missing_report(d).collect()
    assert rep[0]["feature"] == "age_of_casualty" and rep[0]["missing"] == 3
    assert [r["missing"] for r in rep] == sorted([r["missing"] for r in rep], reverse=True)
    assert stats.missing_total(d).first()["missing_total"] == 9


def test_drop_dedup_impute(joined):
    st = clean_steps(joined, C.ROAD_CASUALTY)
    assert st["required"].count() == 5  # C4 goes (road_type missing)
    d = st["dedup"]
    assert d.count() == 4
    medians = clean.fit_medians(d, ["speed_limit", "age_of_casualty"], C.QUANTILE_RELATIVE_ERROR)
    assert medians == {"speed_limit": 30.0, "age_of_casualty": 21.0}
    modes = clean.fit_modes(d, C.MODE_COLUMNS)
    assert modes == {"sex_of_casualty": 1, "light_conditions": 1, "weather_conditions": 1, "road_surface_conditions": 1}


def test_rows_after_imputation_and_binning(joined):
    p = road.prepare_road(joined, "flag")
    imp = p.stages["imputed"].withColumn("bin", F.col("time"))
    got = sorted(
        (r.collision_index, r.casualty_class, r.sex_of_casualty, r.age_of_casualty, r.speed_limit, r.weather_conditions,
         r.road_surface_conditions, r.urban_or_rural_area, r.time, r.time_bin, r.casualty_severity)
        for r in p.stages["encoded"].collect())
    assert got == sorted([
        ("C1", 1, 1, 34, 30, 1, 1, 1, 8, 1, 3),
        ("C1", 2, 2, 21, 30, 1, 1, 1, 8, 1, 3),
        ("C2", 3, 1, 21, 60, 1, 2, 3, 23, 4, 1),
        ("C3", 1, 1, 21, 30, 1, 1, 2, 13, 2, 2),
    ])
    assert imp.count() == 4


def test_class_weights_without_outlier_step(joined):
    d = clean_steps(joined, C.ROAD_CASUALTY)["dedup"]
    w = {r[C.LABEL]: r["class_weight"] for r in balance.class_weight_table(d, C.LABEL).collect()}
    assert w == {1: 2.0, 2: 2.0, 3: 1.0}
    # weight x count is the same for every class
    counts = {r[C.LABEL]: r["count"] for r in balance.class_counts(d, C.LABEL).collect()}
    assert len({w[k] * counts[k] for k in w}) == 1


def test_prepare_flag_outputs(joined):
    p = road.prepare_road(joined, "flag")
    f = p.frame
    assert {"age_of_casualty_is_outlier", "speed_limit_is_outlier", "has_any_outlier", "class_weight",
            "numeric_features_before_scaling", "numeric_features_scaled", "features"} <= set(f.columns)
    rows = f.collect()
    assert len(rows) == 4
    assert all(len(r.features) == 12 for r in rows)
    # variant flag: raw numerics lead the feature vector (age, speed)
    assert sorted((r.features[0], r.features[1]) for r in rows) == sorted(
        (float(r.age_of_casualty), float(r.speed_limit)) for r in rows)
    # no missing value left in the model input
    assert all(v == v for r in rows for v in r.features)


def test_prepare_drop_scales(joined):
    p = road.prepare_road(joined, "drop")
    rows = p.frame.collect()
    z = [r.numeric_features_scaled[0] for r in rows]
    if len(z) > 1:
        import statistics
        assert abs(statistics.fmean(z)) < 1e-9
        sd = statistics.stdev(z)
        assert sd == 0.0 or abs(sd - 1.0) < 1e-9
    assert all(r.features[0] == r.numeric_features_scaled[0] for r in rows)


def test_index_zero_is_most_frequent(joined):
    p = road.prepare_road(joined, "flag")
    e = p.stages["encoded"]
    for c in ["casualty_class", "sex_of_casualty"]:
        counts = stats.group_count(e, c).orderBy(F.col("count").desc(), F.col(c).cast("string")).first()
        idx = e.filter(F.col(c) == counts[c]).select(f"{c}_idx").first()[0]
        assert idx == 0.0


def test_full_casualty_rule(spark):
    raw = spark.createDataFrame([("C1", "2019", "x", "E01", "1", "2", "0.5", "0.25")],
                                "collision_index string, collision_year string, collision_ref_no string, lsoa_of_casualty string, "
                                "casualty_class string, age_of_casualty string, casualty_adjusted_severity_serious string, "
                                "casualty_adjusted_severity_slight string")
    t = road.full_casualty(raw)
    assert t.dtypes == [("collision_index", "string"), ("collision_year", "string"), ("collision_ref_no", "string"),
                        ("lsoa_of_casualty", "string"), ("casualty_class", "int"), ("age_of_casualty", "int"),
                        ("casualty_adjusted_severity_serious", "double"), ("casualty_adjusted_severity_slight", "double")]


def test_union_of_two_slices(spark, csv_dir):
    j = road.integrate_csv(spark, [(f"{csv_dir}/casualty", f"{csv_dir}/collision")] * 2)
    assert j.count() == 12  # union keeps duplicates


def test_reject_counts_and_null_on_error(spark):
    raw = spark.createDataFrame([("C1", "3", "05/03/2019", "08:15"), ("C2", "x", "1/2/2024", "bad"), ("C3", None, None, None)],
                                "collision_index string, road_type string, date string, time string")
    spec = {"collision_index": None, "road_type": "int",
            "date": road.parse_date("date", C.DATE_FORMAT, "null"), "time": road.hour_of("time", ":", "null")}
    r = clean.reject_counts(raw, spec).first().asDict()
    assert r == {"road_type_rejected": 1, "date_rejected": 1, "time_rejected": 1}
    typed = clean.typed_projection(raw, spec, on_error="null").orderBy("collision_index").collect()
    assert [(t.road_type, t.time) for t in typed] == [(3, 8), (None, None), (None, None)]


def test_fit_on_train_marks_rows(spark):
    from dataclasses import replace
    from sevlab.plans import testbed as tb
    from sevlab.plans.prepare import prepare
    cfg = replace(tb.TESTBED_FLAG, fit_on="train")
    p = prepare(tb.joined(spark, "/root/testdata/sf0.001"), cfg)
    counts = {r.is_train: r["count"] for r in p.frame.groupBy("is_train").count().collect()}
    assert set(counts) == {True, False} and counts[True] > counts[False]
    train_total = p.fitted["class_weights"].agg({"count": "sum"}).first()[0]
    assert train_total == counts[True]  # weights fitted on the train rows only


def _write_generated_csv(d: str, n: int = 400) -> tuple[str, str]:
    """A larger made-up casualty/collision pair (deterministic) for the job entry points."""
    import os
    os.makedirs(f"{d}/cas")
    os.makedirs(f"{d}/col")
    with open(f"{d}/cas/part-0.csv", "w") as f:
        f.write("collision_index,casualty_class,sex_of_casualty,age_of_casualty,casualty_severity,casualty_type\n")
        for i in range(n):
            sev = 1 if i % 11 == 0 else (2 if i % 4 == 0 else 3)
            f.write(f"K{i % 150},{1 + i % 3},{[1, 2, 9, -1][i % 4]},{(i * 7) % 90 if i % 13 else -1},{sev},{i % 5}\n")
    with open(f"{d}/col/part-0.csv", "w") as f:
        f.write("collision_index,collision_severity,date,day_of_week,time,road_type,speed_limit,light_conditions,"
                "weather_conditions,road_surface_conditions,urban_or_rural_area\n")
        for k in range(150):
            f.write(f"K{k},{1 + k % 3},{1 + k % 28:02d}/{1 + k % 12:02d}/20{10 + k % 15},{1 + k % 7},{k % 24:02d}:{k % 60:02d},"
                    f"{[1, 2, 3, 6, -1][k % 5]},{[20, 30, 40, 60, 70][k % 5]},{1 + k % 4},{1 + k % 3},{1 + k % 2},{1 + k % 2}\n")
    return f"{d}/cas", f"{d}/col"


def test_road_jobs_end_to_end(spark):
    """integrate -> prepare -> correlate -> profile -> train -> score through the job entry points."""
    import tempfile
    from sevlab.plans.road import parse_args, run
    out = tempfile.mkdtemp(prefix="sevlab-jobs-")
    cas, col = _write_generated_csv(out)
    run(spark, parse_args(["integrate", "--slice", cas, col, "--out", f"{out}/joined"]))
    run(spark, parse_args(["prepare", "--input", f"{out}/joined", "--out", f"{out}/prep", "--variant", "flag"]))
    run(spark, parse_args(["correlate", "--input", f"{out}/joined", "--out", f"{out}/corr"]))
    run(spark, parse_args(["profile", "--input", f"{out}/joined", "--out", f"{out}/profile"]))
    run(spark, parse_args(["train", "--input", f"{out}/prep/train", "--model", f"{out}/forest"]))
    run(spark, parse_args(["score", "--model", f"{out}/forest", "--input", f"{out}/prep/train", "--out", f"{out}/scored"]))
    assert spark.read.parquet(f"{out}/joined").count() == 400
    assert spark.read.parquet(f"{out}/prep/train").columns == ["features", "casualty_severity", "class_weight", "row_key"]
    assert spark.read.parquet(f"{out}/corr").count() == 14 * 14
    assert spark.read.parquet(f"{out}/scored").count() == spark.read.parquet(f"{out}/prep/train").count()
    # the job's own split: test rows in every class, and the metrics are over exactly those rows
    from sevlab.plans.train import split
    from sevlab.sources import load_forest
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    table = spark.read.parquet(f"{out}/prep/train")
    train, test = split(table, C.LABEL, C.TRAIN_FRACTIONS, C.SEED)
    n = {r[0]: r["count"] for r in table.groupBy(C.LABEL).count().collect()}
    held = {r[0]: r["count"] for r in test.groupBy(C.LABEL).count().collect()}
    assert set(held) == set(n) and all(abs(held[k] - 0.2 * n[k]) < 5 * (0.16 * n[k]) ** 0.5 for k in n)
    m = spark.read.parquet(f"{out}/forest-metrics").first()
    pred = load_forest(f"{out}/forest").transform(test)
    f1 = MulticlassClassificationEvaluator(labelCol=C.LABEL, predictionCol="prediction", metricName="f1").evaluate(pred)
    assert abs(m.f1 - f1) < 1e-12
    confusion = spark.read.parquet(f"{out}/forest-confusion").collect()
    assert sum(r["1"] + r["2"] + r["3"] + r["other"] for r in confusion) == sum(held.values()) > 0


def test_prepared_copy_released(spark):
    import os
    from sevlab.plans import testbed as tb
    from sevlab.plans.prepare import prepare
    p = prepare(tb.joined(spark, "/root/testdata/sf0.001"), tb.TESTBED_FLAG)
    path = p.base_path
    n = p.frame.count()
    assert os.path.exists(path.replace("file:", "")) and n > 0
    p.release()
    assert not os.path.exists(path.replace("file:", "")) and p.base_path is None


def test_full_preset_uses_raw_weights(spark):
    import tempfile
    from pyspark.sql import functions as F
    from sevlab.plans.road import parse_args, run, train_road
    out = tempfile.mkdtemp(prefix="sevlab-full-")
    cas, col = _write_generated_csv(out)
    run(spark, parse_args(["integrate", "--slice", cas, col, "--out", f"{out}/joined"]))
    run(spark, parse_args(["prepare", "--input", f"{out}/joined", "--out", f"{out}/prep", "--variant", "flag"]))
    t = train_road(spark.read.parquet(f"{out}/prep/train"), full=True)
    assert t.train.filter(F.col("smoothed_weight") != F.col("class_weight")).count() == 0
    assert t.model.getNumTrees == 100 and t.model.getOrDefault("maxDepth") == 15


def test_clean_counts_equal_generic_step_counts(joined):
    from sevlab.plans.prepare import clean as clean_steps, clean_counts
    fast = sorted(map(tuple, clean_counts(joined, C.ROAD_CASUALTY).collect()))
    generic = sorted(map(tuple, stats.step_row_counts(clean_steps(joined, C.ROAD_CASUALTY)).collect()))
    assert fast == generic == [(0, "input", 6), (1, "sentinels_to_null", 6), (2, "required", 5), (3, "dedup", 4)]
