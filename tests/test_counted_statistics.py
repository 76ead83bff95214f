"""Category indexes, chi-square from counts, and step counts observed by the writing job."""

import math
import random

import pytest
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from sevlab import config as C
from sevlab.functions.special import chi_square_tail, log_gamma, upper_gamma
from sevlab.operators import categories, features, stats


def test_category_index_equals_string_indexer(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, rng.choice(["b", "a", "c", None, "", "é", "B"]), rng.choice([1, 2, 10, 3, None]), f"k{rng.randrange(700)}" if i % 3 else "hot") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, s string, n int, k string")
    seen, unseen = df.filter("id < 2500"), df.withColumn("k", F.when(F.col("id") < 5, "never seen").otherwise(F.col("k")))
    cols = ["s", "n", "k"]
    for literal in (categories.LITERAL_VALUES, 3, 0):  # literals, both, joins only
        monkeypatch.setattr(categories, "LITERAL_VALUES", literal)
        index = categories.fit_category_index(seen.repartition(7), cols)
        want = features.string_indexer(cols).fit(seen)
        assert index.sizes == [len(x) for x in want.labelsArray]
        for df2 in (seen, unseen):
            a = sorted(map(tuple, index.transform(df2).collect()), key=repr)
            b = sorted(map(tuple, want.transform(df2).select(*df2.columns, *[f"{c}_idx" for c in cols]).collect()), key=repr)
            assert a == b
    labels = [[r.value for r in index.mapping(spark).filter(F.col("column_name") == c).orderBy("idx").collect()] for c in cols]
    assert labels == [list(x) for x in want.labelsArray]
    again = categories.load_category_index(spark, index.path, cols)
    assert again.sizes == index.sizes and again.transform(seen).count() == seen.count()


def test_category_index_of_nothing(spark):
    df = spark.createDataFrame([(None, "x")], "a string, b string")
    for table in (df, df.limit(0)):
        index = categories.fit_category_index(table, ["a", "b"])
        assert index.sizes == [0, int(table is df)]
        assert [tuple(r)[2:] for r in index.transform(df).collect()] == [(0.0, 0.0)]


def test_many_categories_stay_off_the_driver(spark):
    """A column of 300,000 values: the driver gets two numbers, the values meet the rows in a join."""
    df = spark.range(600_000).select((F.col("id") % 300_000).alias("v"), "id")
    index = categories.fit_category_index(df, ["v"])
    assert index.sizes == [300_000]
    out = index.transform(df)
    assert index.maps == {} and "Join" in out._jdf.queryExecution().optimizedPlan().toString()
    facts = out.agg(F.count_distinct("v_idx").alias("d"), F.min("v_idx").alias("lo"), F.max("v_idx").alias("hi")).first()
    assert tuple(facts) == (300_000, 0.0, 299_999.0)
    # all values are equally frequent, so the order is that of their text
    first = index.table(spark).orderBy("idx").limit(3).collect()
    assert [r.value for r in first] == ["0", "1", "10"]


def closed_tail(x: float, k: int) -> float:
    """The chi-square tail for whole degrees of freedom as a finite sum."""
    h = x / 2
    if k % 2 == 0:
        return sum(math.exp(i * math.log(h) - h - math.lgamma(i + 1)) for i in range(k // 2))
    return math.erfc(math.sqrt(h)) + sum(math.exp((i - 0.5) * math.log(h) - h - math.lgamma(i + 0.5)) for i in range(1, (k + 1) // 2))


def test_chi_square_tail_equals_published_values_and_finite_sums(spark):
    published = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (18.307038053275146, 10, 0.05), (124.34211340400407, 100, 0.05), (6.6348966010212145, 1, 0.01), (0.0, 3, 1.0), (7.0, 0, 1.0)]
    cases = published + [(x, k, closed_tail(x, k)) for k in (1, 2, 3, 5, 8, 21, 60, 333, 2000, 19998) for x in (0.01, 0.5 * k, 0.98 * k, k + 1.0, 1.05 * k + 3, 2.0 * k, 3.0 * k + 40)]
    df = spark.createDataFrame(cases, "x double, k int, want double").withColumn("p", chi_square_tail(F.col("x"), F.col("k")))
    for r in df.collect():
        assert abs(r.p - r.want) < 1e-9, r
        if 1e-250 < r.want < 1e-3:
            assert abs(r.p / r.want - 1) < 1e-7, r  # small tails keep their digits
    gamma = spark.createDataFrame([(a,) for a in (0.5, 1.0, 2.5, 10.0, 1234.5)], "a double").select("a", log_gamma(F.col("a")).alias("g"), upper_gamma(F.col("a"), F.col("a")).alias("q"))
    for r in gamma.collect():
        assert abs(r.g - math.lgamma(r.a)) < 1e-11 * max(1, abs(r.g)) and 0 < r.q < 1


def test_chi_square_equals_sparks_test(spark):
    rng = random.Random(3)
    rows = [(float(rng.randrange(5)), float(rng.randrange(3)), rng.choice([1.0, None, float("nan"), 2.0]), 7.0, rng.randrange(1, 4)) for _ in range(2000)]
    rows = [(a, float((b + y) % 3) if a > 2 else b, c, d, y) for a, b, c, d, y in rows]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y int")
    got = {r.feature: r for r in stats.chi_square(df, ["a", "b", "c", "d"], "y").collect()}
    coded = df.withColumn("c", F.coalesce(F.nanvl("c", F.lit(9.0)), F.lit(9.0))).withColumn("y", F.col("y").cast("double"))  # Spark's test takes no NaN
    vec = features.assembler(["a", "b", "c", "d"], "v").transform(coded)
    want = ChiSquareTest.test(vec, "v", "y", flatten=True).collect()
    for name, w in zip("abcd", want):
        g = got[name]
        assert g.degrees_of_freedom == w.degreesOfFreedom
        assert abs(g.statistic - w.statistic) < 1e-9 * max(1.0, w.statistic) and abs(g.p_value - w.pValue) < 1e-9
    assert [got[f].rank for f in sorted(got, key=lambda f: (-got[f].statistic, f))] == [1, 2, 3, 4]
    nulls = stats.chi_square(df.withColumn("y", F.lit(None).cast("int")), ["a"], "y")
    assert nulls.collect() == []


def test_chi_square_of_more_than_ten_thousand_values(spark):
    n = 24_000
    df = spark.range(n).select((F.col("id") % 12_000).cast("double").alias("a"), F.pmod(F.xxhash64("id"), F.lit(2)).alias("y"))
    r = stats.chi_square(df, ["a"], "y").first()
    assert r.degrees_of_freedom == 11_999
    o = df.groupBy("a", "y").count().toPandas().pivot(index="a", columns="y", values="count").fillna(0).to_numpy()
    e = o.sum(axis=1, keepdims=True) * o.sum(axis=0, keepdims=True) / n
    want = float(((o - e) ** 2 / e).sum())
    assert abs(r.statistic - want) < 1e-6 * want and abs(r.p_value - closed_tail(want, 11_999)) < 1e-9


def test_step_counts_come_from_the_writing_job(spark, joined, tmp_path):
    from sevlab.plans.prepare import clean_counts, counts_table, prepare, write_clean
    cfg = C.ROAD_CASUALTY
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    counts = write_clean(joined, cfg, str(tmp_path / "clean"))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before
    assert counts == {"input": 6, "sentinels_to_null": 6, "required": 5, "dedup": 4}
    fast = sorted(map(tuple, clean_counts(joined, cfg).collect()))
    assert sorted(map(tuple, counts_table(spark, counts).collect())) == fast
    plain = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    from sevlab.plans.prepare import clean
    clean(joined, cfg)["dedup"].write.mode("overwrite").parquet(str(tmp_path / "plain"))
    assert jobs <= len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - plain  # no job besides the write
    assert prepare(joined, cfg).counts == counts
    empty = write_clean(joined.limit(0), cfg, str(tmp_path / "empty"))
    assert set(empty.values()) == {0} and spark.read.parquet(str(tmp_path / "empty")).count() == 0


def test_step_counts_are_made_anew_if_a_task_was_observed_twice(spark, joined, tmp_path, monkeypatch):
    from sevlab.plans import prepare as P

    class Twice:
        """An observation whose map side was counted twice."""
        def __init__(self, name):
            from pyspark.sql import Observation
            self._inner, self._double = Observation(name), name == "clean-before"

        def __getattr__(self, name):
            return getattr(self._inner, name)

        @property
        def get(self):
            return {k: v * 2 for k, v in self._inner.get.items()} if self._double else self._inner.get

    import pyspark.sql.classic.dataframe as D
    observe = D.DataFrame.observe
    monkeypatch.setattr(D.DataFrame, "observe", lambda self, o, *e: observe(self, o._inner if isinstance(o, Twice) else o, *e))
    monkeypatch.setattr(P, "Observation", Twice)
    assert P.write_clean(joined, C.ROAD_CASUALTY, str(tmp_path / "clean")) == {"input": 6, "sentinels_to_null": 6, "required": 5, "dedup": 4}


@pytest.mark.parametrize("order", [None, (), ("casualty_class",)])
def test_dedup_counts_what_it_merges(joined, order):
    from sevlab.operators.clean import dedup
    keys = ["collision_index", "casualty_severity"]
    d = dedup(joined, keys, order, "merged")
    assert d.agg(F.sum("merged")).first()[0] == joined.count() and d.columns == [*joined.columns, "merged"]
    if order is not None:
        assert sorted(map(tuple, d.drop("merged").collect()), key=repr) == sorted(map(tuple, dedup(joined, keys, order).collect()), key=repr)
