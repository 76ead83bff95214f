"""Splits, weighted forest, evaluation, persistence."""

import tempfile

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sevlab.operators import model, sampling
from sevlab.plans.train import train_and_evaluate
from sevlab.sources import load_forest, rows_to_frame

SMALL_FOREST = {"numTrees": 5, "maxDepth": 4, "maxBins": 64, "seed": 42}


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for i in range(600):
        y = 1 + (i % 3)
        rows.append((i, Vectors.dense([float(i % 7), float(y * 10 + i % 5), float(i % 2)]), y, 1.0 + (y == 1)))
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
    schema = StructType([StructField("id", IntegerType()), StructField("features", VectorUDT()),
                         StructField("casualty_severity", IntegerType()), StructField("class_weight", DoubleType())])
    return spark.createDataFrame(rows, schema)


def test_hash_split_is_a_partition(spark, table):
    train, test = sampling.hash_split(table, "casualty_severity", {1: 0.8, 2: 0.8, 3: 0.8}, ["id"])
    a = {r.id for r in train.select("id").collect()}
    b = {r.id for r in test.select("id").collect()}
    assert not a & b and len(a | b) == 600
    assert 400 < len(a) < 560
    again = {r.id for r in sampling.hash_split(table.repartition(5), "casualty_severity", {1: 0.8, 2: 0.8, 3: 0.8}, ["id"])[0]
             .select("id").collect()}
    assert again == a  # same rows on another layout


def test_unlisted_class_gets_fraction_zero(spark, table):
    s = sampling.hash_stratified_sample(table, "casualty_severity", {1: 1.0}, ["id"])
    assert {r.casualty_severity for r in s.collect()} == {1}
    b = sampling.stratified_sample(table, "casualty_severity", {1.0: 1.0}, 42)  # float key matches int label
    assert b.count() == 200


def test_anti_join_and_except_splits(spark, table):
    t = sampling.with_row_id(table)
    train = sampling.stratified_sample(t, "casualty_severity", {1: 0.8, 2: 0.8, 3: 0.8}, 42)
    test = sampling.anti_join_split(t, train, "id")
    assert train.count() + test.count() == 600
    assert train.join(test, "id").count() == 0
    dup = table.select("casualty_severity").union(table.select("casualty_severity"))
    assert sampling.except_split(dup, dup.filter("casualty_severity = 1")).count() == 2  # distinct


def test_train_evaluate_save_load(spark, table):
    path = tempfile.mkdtemp(prefix="sevlab-model-") + "/forest"
    t = train_and_evaluate(table, "casualty_severity", {1: 0.8, 2: 0.8, 3: 0.8}, SMALL_FOREST, 42, labels=[1, 2, 3],
                           method="hash", hash_cols=["id"], model_path=path)
    m = t.metrics.first()
    ev_f1 = MulticlassClassificationEvaluator(labelCol="casualty_severity", predictionCol="prediction", metricName="f1")
    ev_acc = MulticlassClassificationEvaluator(labelCol="casualty_severity", predictionCol="prediction", metricName="accuracy")
    assert abs(m.f1 - ev_f1.evaluate(t.predictions)) < 1e-12
    assert abs(m.accuracy - ev_acc.evaluate(t.predictions)) < 1e-12
    assert t.model.numClasses == 4 and t.model.numFeatures == 3
    scored = model.score(t.model, t.test).collect()
    assert all(abs(sum(r.probability) - 1.0) < 1e-9 and r.p_0 == 0.0 for r in scored)
    loaded = load_forest(path)
    p1 = [r.prediction for r in t.model.transform(t.test).orderBy("id").collect()]
    p2 = [r.prediction for r in loaded.transform(t.test).orderBy("id").collect()]
    assert p1 == p2
    ct = t.confusion.collect()
    assert sum(r["1"] + r["2"] + r["3"] + r["other"] for r in ct) == t.test.count()


def test_split_and_fit_do_not_depend_on_the_layout(spark, table):
    args = ("casualty_severity", {1: 0.8, 2: 0.8, 3: 0.8}, SMALL_FOREST, 42)
    runs = [train_and_evaluate(table.repartition(n, "id"), *args, labels=[1, 2, 3], hash_cols=["id"]) for n in (2, 8)]
    ids = [sorted(r.id for r in t.train.select("id").collect()) for t in runs]
    assert ids[0] == ids[1]
    assert runs[0].model.toDebugString.split("\n", 1)[1] == runs[1].model.toDebugString.split("\n", 1)[1]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_persist_keeps_rows_until_released(spark):
    kept = sampling.persist(spark.range(100).filter("id % 3 = 0"))
    try:
        assert kept.count() == 34 and kept.storageLevel.useMemory and kept.storageLevel.useDisk
        assert "InMemory" in kept.select("id")._jdf.queryExecution().executedPlan().toString()
    finally:
        kept.unpersist(blocking=True)
    assert not kept.storageLevel.useMemory and spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_same_seed_same_forest(spark, table):
    a = model.fit_forest(table, "casualty_severity", SMALL_FOREST, weight="class_weight")
    b = model.fit_forest(table, "casualty_severity", SMALL_FOREST, weight="class_weight")
    pa = [r.prediction for r in a.transform(table).orderBy("id").collect()]
    pb = [r.prediction for r in b.transform(table).orderBy("id").collect()]
    assert pa == pb


def test_score_one_vector(spark, table):
    m = model.fit_forest(table, "casualty_severity", SMALL_FOREST)
    one = rows_to_frame(spark, [(Vectors.dense([1.0, 20.0, 0.0]),)], ["features"])
    r = model.score(m, one).first()
    assert r.prediction in (1.0, 2.0, 3.0) and r.p_0 == 0.0


def test_evaluate_ignores_predicted_only_classes(spark):
    p = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 2.0), (2, 5.0)], "y int, prediction double")
    ours = model.evaluate(p, "y").first()
    ev = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction", metricName="f1")
    assert abs(ours.f1 - ev.evaluate(p.withColumn("y", F.col("y").cast("double")))) < 1e-12
    assert ours.accuracy == 0.5


def test_tables_are_scored_as_sparks_model_scores_them(spark, tmp_path):
    """The same columns and numbers to the last bit, NaN and equal neighbours included; a batch goes down tree by tree."""
    df = spark.range(3000).select("id", F.array((F.col("id") % 5).cast("double"), F.when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("id") % 11 / 3.0), -F.floor(F.col("id") / 9) % 6 * 0.0 + F.floor(F.col("id") / 9) % 6).alias("x"),
                                  (F.floor(F.col("id") * F.col("id") / 5) % 3).cast("int").alias("y"))
    df.select("id", "y", array_to_vector("x").alias("features")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    for trees, depth in ((12, 7), (1, 0)):
        m = model.fit_forest(rows.filter("id % 7 != 0"), "y", {"numTrees": trees, "maxDepth": depth, "seed": 3})
        want, found = m.transform(rows).orderBy("id"), model.transform(m, rows)
        assert [(c.name, c.dataType, c.metadata) for c in found.schema] == [(c.name, c.dataType, c.metadata) for c in want.schema]
        assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
        assert repr(found.orderBy("id").collect()) == repr(want.collect())
        assert model.transform(m, rows.filter("id < 0")).count() == 0
    with pytest.raises(Exception, match="cannot be scored|non-null"):
        model.transform(m, rows.select(F.when(F.col("id") > 5, F.col("features")).alias("features"))).collect()
    limited = m.copy().setThresholds([0.1, 0.1, 0.8])  # asks for more than votes: Spark's own
    assert repr(model.transform(limited, rows).orderBy("id").collect()) == repr(limited.transform(rows).orderBy("id").collect())


def test_cuts_by_categories_are_left_to_spark(spark, tmp_path):
    coded = {"ml_attr": {"attrs": {"nominal": [{"idx": 0, "name": "a", "vals": ["p", "q", "r", "s"]}]}, "num_attrs": 1}}
    rows = spark.range(300).select(array_to_vector(F.array((F.col("id") % 4).cast("double"))).alias("features", metadata=coded), (F.col("id") % 4 % 2).cast("int").alias("y"))
    model.fit_forest(rows, "y", {"numTrees": 2, "maxDepth": 2, "seed": 1}).write().save(str(tmp_path / "forest"))
    m = load_forest(str(tmp_path / "forest"))  # as read back: a fitted model of two classes holds its session
    found = model.transform(m, rows)
    assert "ArrowEvalPython" not in found._jdf.queryExecution().executedPlan().toString()
    assert repr(found.collect()) == repr(m.transform(rows).collect())
