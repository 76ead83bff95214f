"""Slices: staged sink, quantile states, incremental deduplication, bucketed joins, bad CSV rows, exact splits,
wide correlations."""

import math
import os
import random
import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sevlab.operators import exact_sample, stats, wide
from sevlab.operators.clean import dedup
from sevlab.plans import increments
from sevlab.sources import bad_rows, slices


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_sink_replaces_only_its_slices(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(60).select("id", (F.col("id") % 3).cast("int").alias("period"))
    assert slices.write_slices(df, path, "period") == ["period=0", "period=1", "period=2"]
    kept = {f for f in os.listdir(f"{path}/period=0")}
    assert slices.write_slices(df.filter("period = 1").withColumn("id", -F.col("id")), path, "period") == ["period=1"]
    assert {f for f in os.listdir(f"{path}/period=0")} == kept  # untouched files
    got = slices.read_slices(spark, path)
    assert rows_of(got.select("id", "period")) == sorted(((-i if i % 3 == 1 else i), i % 3) for i in range(60)) or got.count() == 60
    assert got.filter("period = 1 AND id > 0").count() == 0 and got.filter("period <> 1 AND id < 0").count() == 0
    slices.write_slices(df.limit(0), path, "period")
    assert got.count() == 60 and [f for f in os.listdir(path) if f.startswith("_") and f != "_SUCCESS"] == []


def test_failed_run_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    slices.write_slices(spark.range(10).withColumn("period", F.lit(1)), path, "period")
    broken = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("boom")).cast("long")).alias("id"), F.lit(1).alias("period"))
    with pytest.raises(Exception, match="boom"):
        slices.write_slices(broken, path, "period")
    assert slices.read_slices(spark, path).count() == 10 and [f for f in os.listdir(path) if f.startswith("_staged")] == []
    with pytest.raises(ValueError):
        slices.write_slices(slices.read_slices(spark, path), path, "period")


def test_quantile_states_are_merged_within_their_error(spark, tmp_path):
    path, rng = str(tmp_path / "states"), random.Random(5)
    values = [(s, rng.gauss(s, 1 + s), rng.choice([None, float("nan"), 1.0, 2.0, 2.0])) for s in range(4) for _ in range(5000)]
    df = spark.createDataFrame(values, "slice int, a double, b double")
    slices.write_quantile_states(df.filter("slice < 3"), ["a", "b"], "slice", path)
    old = {f: os.path.getmtime(f"{path}/{f}") for f in os.listdir(path) if f.startswith("slice=")}
    slices.write_quantile_states(df.filter("slice = 3"), ["a", "b"], "slice", path)
    assert all(os.path.getmtime(f"{path}/{f}") == t for f, t in old.items()) and len(os.listdir(path)) > len(old)
    states = slices.read_slices(spark, path)
    assert all(path in f for f in states.inputFiles())  # the refit reads states and nothing else
    probs = [k / 20 for k in range(1, 20)]
    a, b = sorted(v[1] for v in values), sorted(v[2] for v in values if v[2] is not None and not math.isnan(v[2]))
    found = slices.merged_quantiles(states, probs).collect()
    assert len(found) == 38
    for r in found:
        x, e = (a if r.column_name == "a" else b), slices.rank_error()
        assert r.n == len(x)
        assert sum(v < r.value for v in x) <= (r.prob + e) * len(x) and sum(v <= r.value for v in x) >= (r.prob - e) * len(x)


def test_increment_equals_a_full_run_and_reads_only_its_ranges(spark, tmp_path):
    rng, path = random.Random(6), str(tmp_path / "clean")
    rows = [(rng.choice([None, *range(400)]), rng.randrange(3), rng.choice("abc"), rng.randrange(100)) for _ in range(3000)]
    schema = "k int, j int, s string, v int"
    first, late = [r for r in rows if r[0] is None or r[0] < 300], [r for r in rows if r[0] is not None and r[0] >= 290]
    bounds = increments.start_clean_table(spark.createDataFrame(first, schema), path, ["k", "j"], ["v"], 8)
    before = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("key_range=")}
    touched = increments.add_slice(spark.createDataFrame(late, schema), path, ["k", "j"], bounds, ["v"])
    whole = dedup(spark.createDataFrame(first + late, schema), ["k", "j"], ["v"])
    assert rows_of(slices.read_slices(spark, path).select("k", "j", "s", "v")) == rows_of(whole.select("k", "j", "s", "v"))
    assert 0 < len(touched) < len(before)
    for d, files in before.items():
        assert (sorted(os.listdir(f"{path}/{d}")) == files) == (int(d.split("=")[1]) not in touched)
    # a null key, nothing at all, and the same slice again
    increments.add_slice(spark.createDataFrame([(None, 1, "a", -5)], schema), path, ["k", "j"], bounds, ["v"])
    assert slices.read_slices(spark, path).filter("k IS NULL AND j = 1").select("v").collect() == [(-5,)]
    assert increments.add_slice(spark.createDataFrame([], schema), path, ["k", "j"], bounds, ["v"]) == []
    n = slices.read_slices(spark, path).count()
    increments.add_slice(spark.createDataFrame(late, schema), path, ["k", "j"], bounds, ["v"])
    assert slices.read_slices(spark, path).count() == n


def test_stored_tables_join_without_a_shuffle(spark):
    names = [f"t_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    a, b = spark.range(5000).select((F.col("id") % 700).alias("k"), "id"), spark.range(700).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for name, df in zip(names, (a, b)):
        increments.store_bucketed(df, name, "k", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = increments.integrate_stored(spark, *names, "k")
        assert rows_of(joined.select("k", "id", "w")) == rows_of(a.join(b, "k").select("k", "id", "w"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bad_csv_rows_are_kept_with_file_and_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,n,s\n1,2,x\n2,bad,y\n3,4\n\n5,6,"q,z"\n7,8,9,10\n,,\n')
    (tmp_path / "b.csv").write_text("id,n,other\n1,2,x\n")
    (tmp_path / "c.csv").write_text("id,n,s\n" + "".join(f"{i},{i},t\n" for i in range(5000)) + "oops\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # the file is read in many splits
    try:
        good, rejects = bad_rows.read_csv_keeping_bad_rows(spark, str(tmp_path), {"id": "int", "n": "int"})
        got = sorted((os.path.basename(r.file), r.line, r.value, r.reason) for r in rejects.collect())
        assert got == [("a.csv", 3, "2,bad,y", "type n"), ("a.csv", 4, "3,4", "cells"), ("a.csv", 7, "7,8,9,10", "cells"), ("b.csv", 1, "id,n,other", "header"), ("c.csv", 5002, "oops", "cells")]
        assert good.count() == 3 + 1 + 5000 and dict(good.dtypes) == {"id": "int", "n": "int", "s": "string"}
        assert {(1, 2, "x"), (5, 6, "q,z"), (None, None, None)} <= {tuple(r) for r in good.collect()}
        lines = bad_rows.numbered_lines(spark, str(tmp_path / "c.csv"))
        assert lines.filter("value = concat(line - 2, ',', line - 2, ',t')").count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("fraction", [0.8, 0.0, 1.0, 0.123])
def test_exact_split(spark, fraction):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "a", "a", "b", None, "c"]), i) for i in range(1500)] + [(7, "a", -k) for k in range(40)] + [(9000, "one", 1)]
    df = spark.createDataFrame(rows, "k int, y string, v int")
    sample, rest = exact_sample.exact_split(df.repartition(3), "y", fraction, ["k"])
    n, got = {}, {}
    for r in rows:
        n[r[1]] = n.get(r[1], 0) + 1
    for r in sample.collect():
        got[r.y] = got.get(r.y, 0) + 1
    assert got == {y: math.ceil(fraction * c - 1e-9) for y, c in n.items() if math.ceil(fraction * c - 1e-9)}
    assert sorted(map(tuple, sample.unionByName(rest).collect()), key=repr) == sorted(rows, key=repr)
    again, _ = exact_sample.exact_split(df.repartition(9, "v"), "y", fraction, ["k"])
    assert rows_of(again) == rows_of(sample)


def test_exact_split_of_nothing(spark):
    df = spark.createDataFrame([], "k int, y string")
    sample, rest = exact_sample.exact_split(df, "y", 0.8, ["k"])
    assert sample.count() == rest.count() == 0 and sample.columns == ["k", "y"]


def test_wide_correlations(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 500)) * 10.0 ** rng.integers(-3, 6, 500) + 10.0 ** rng.integers(0, 7, 500)
    x[:, 7] = x[:, 3] * -2
    x[:, 11] = 0.1
    df = spark.createDataFrame(pa.table({f"c{i}": x[:, i] for i in range(500)})).repartition(5)
    got = {(r.i, r.j): r.r for r in wide.correlation_wide(df, df.columns).collect()}
    with np.errstate(invalid="ignore", divide="ignore"):
        want = np.corrcoef(x.T)
    assert len(got) == 250_000
    for i in range(0, 500, 7):
        for j in range(500):
            if 11 in (i, j) and i != j:
                assert math.isnan(got[i, j])
            elif i == j:
                assert got[i, j] == 1.0
            else:
                assert abs(got[i, j] - want[i, j]) < 1e-6
    small = spark.createDataFrame([(1.0, 2, None), (2.0, 4, 1.0), (float("nan"), 5, 2.0), (4.0, 1, 3.0), (0.5, 3, 9.0)], "a double, b int, c double")
    a, b = ({(r.col_i, r.col_j): r.r for r in f(small, ["a", "b", "c"]).collect()} for f in (wide.correlation_wide, stats.correlation_long))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)
    assert all(math.isnan(r.r) or r.i == r.j for r in wide.correlation_wide(small.limit(0), ["a", "b"]).collect())
