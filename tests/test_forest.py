"""The forest by row hash: the same trees on any layout, Spark's accuracy, every kind of odd row."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sevlab.operators import forest, model
from sevlab.plans.train import fit, split, train_and_evaluate

PARAMS = {"numTrees": 6, "maxDepth": 5, "maxBins": 16, "seed": 11}
FRACTIONS = {1: 0.8, 2: 0.8, 3: 0.8}


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Four features, one of many values, and a label that hangs on them with noise."""
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        a, b, c, d = rng.randrange(5), rng.randrange(9), rng.gauss(0, 1), rng.random()
        y = 1 + (a + (c > 0.3) + (b > 5) + (rng.random() < 0.15)) % 3
        rows.append(([float(a), float(b), c, d], y, {1: 1.0, 2: 2.5, 3: 7.25}[y], i))
    df = spark.createDataFrame(rows, "x array<double>, y int, class_weight double, row_key long")
    path = str(tmp_path_factory.mktemp("forest") / "rows")
    df.select(array_to_vector("x").alias("features"), "y", "class_weight", "row_key").write.parquet(path)
    return spark.read.parquet(path)


def same(a, b):
    return all(np.array_equal(getattr(a, f), getattr(b, f)) for f in ("feature", "cut", "weight", "gain"))


def test_trees_are_equal_on_any_layout(table):
    grown = [forest.grow(t, "y", "class_weight", "row_key", "features", PARAMS) for t in (table.repartition(2), table.repartition(8, "y"), table.repartition(64, "row_key"))]
    assert same(grown[0], grown[1]) and same(grown[0], grown[2])
    other = forest.grow(table, "y", "class_weight", "row_key", "features", PARAMS | {"seed": 12})
    assert not same(grown[0], other)


def test_model_walks_the_trees_and_reads_as_spark_writes(spark, table, tmp_path):
    m = fit(table.withColumn("smoothed_weight", F.col("class_weight")), "y", PARAMS, model_path=str(tmp_path / "forest"))
    trees = forest.grow(table, "y", "class_weight", "row_key", "features", PARAMS)
    rows = m.transform(table).select(vector_to_array("features").alias("x"), vector_to_array("probability").alias("p"), "prediction").collect()
    for r in rows[:200]:
        votes = np.zeros(trees.n_classes)
        for t in range(trees.n_trees):
            node = 0
            while trees.feature[t, node] >= 0:
                f = trees.feature[t, node]
                node = 2 * node + 1 + int(r.x[f] > trees.cuts[f][trees.cut[t, node]])
            votes += trees.weight[t, node] / trees.weight[t, node].sum()
        assert np.allclose(r.p, votes / votes.sum()) and r.prediction == votes.argmax()
    assert m.getNumTrees == 6 and m.numClasses == 4 and m.getOrDefault("maxDepth") == 5 and m.featureImportances.size == 4
    m.write().overwrite().save(str(tmp_path / "again"))
    again = type(m).load(str(tmp_path / "again")).transform(table).select("prediction")
    assert [r.prediction for r in again.collect()] == [r.prediction for r in rows]


def test_accuracy_is_that_of_sparks_forest(table):
    train, test = split(table, "y", FRACTIONS, 42)
    params = {"numTrees": 40, "maxDepth": 8, "maxBins": 32, "seed": 42}
    ours = fit(train.withColumn("smoothed_weight", F.sqrt("class_weight")), "y", params)
    sparks = model.fit_forest(train.withColumn("w", F.sqrt("class_weight")), "y", params, "w")
    a, b = (model.evaluate(m.transform(test), "y").first() for m in (ours, sparks))
    assert a.accuracy > 0.75 and a.accuracy > b.accuracy - 0.02  # 600 test rows: 0.5 points are 3 rows


def test_bootstrap_counts_are_poisson():
    times = np.concatenate([forest.draws(np.arange(20_000), t, 5) for t in range(5)])
    shares = np.bincount(times) / len(times)
    for k in range(5):
        assert abs(shares[k] - math.exp(-1) / math.factorial(k)) < 0.006
    assert not np.array_equal(forest.draws(np.arange(50), 0, 5), forest.draws(np.arange(50), 1, 5))
    picked = forest.candidates(np.arange(4000), 1, 5, 9, 3)
    assert (np.diff(picked, axis=1) > 0).all() and np.abs(np.bincount(picked.ravel()) / 4000 - 1 / 3).max() < 0.05


def test_small_chunks_make_the_same_histograms(monkeypatch):
    rng = np.random.default_rng(3)
    n = 500
    cuts = [np.arange(6) + 0.5, np.arange(300) / 300]
    x = np.stack([rng.integers(0, 7, n), rng.integers(0, 301, n)], axis=1).astype(np.uint16)
    batch = pa.record_batch({"bins": [r.tobytes() for r in x], "y": pa.array(rng.integers(0, 3, n), pa.int32()), "w": rng.integers(1, 9, n) << 16, "k": np.arange(n)})
    trees = forest.Trees(3, 4, 3, 7, cuts, 2)

    def found():
        out = {}
        records = list(forest.histograms([batch.slice(i, 70) for i in range(0, n, 70)], trees, 0))
        rows = sorted((r for b in records for r in b.to_pylist()), key=lambda r: (r["tree"], r["node"]))
        merged = pa.RecordBatch.from_pylist(rows, schema=records[0].schema)
        for b in forest.best_cuts([merged.slice(i, 1) for i in range(len(rows))], trees):
            for r in b.to_pylist():
                assert out.setdefault((r["tree"], r["node"]), r) == r
        return out

    whole = found()
    monkeypatch.setattr(forest, "CHUNK_ROWS", 100)
    monkeypatch.setattr(forest, "CHUNK_CELLS", 40)
    assert found() == whole and len(whole) == 3


def test_odd_rows(spark):
    rows = [(float(i % 4), float("nan") if i % 5 == 0 else 1.0, 1 + i % 2, 1.0, i) for i in range(80)]
    df = spark.createDataFrame(rows, "a double, b double, y int, w double, k long")
    base = df.withColumn("features", array_to_vector(F.array("a", "b")))
    odd = base.unionByName(base.limit(3).withColumn("y", F.lit(None).cast("int"))).unionByName(base.limit(3).withColumn("w", F.lit(None).cast("double")))
    odd = odd.unionByName(base.limit(2).withColumn("k", F.lit(None).cast("long"))).unionByName(base.limit(2).withColumn("features", F.lit(None).cast(base.schema["features"].dataType)))
    assert same(forest.grow(base, "y", "w", "k", "features", PARAMS), forest.grow(odd, "y", "w", "k", "features", PARAMS))
    one_class = forest.grow(base.withColumn("y", F.lit(2)), "y", "w", "k", "features", PARAMS)
    assert (one_class.feature < 0).all()
    constant = base.withColumn("features", array_to_vector(F.array(F.lit(1.0), F.lit(2.0))))
    assert (forest.grow(constant, "y", "w", "k", "features", PARAMS).feature < 0).all()
    m = forest.fit_forest_by_hash(constant, "y", PARAMS, "k")
    assert m.transform(constant).select("prediction").distinct().count() == 1
    for bad in (base.limit(0), base.withColumn("y", F.lit(-1)), base.withColumn("w", F.lit(-1.0))):
        with pytest.raises(ValueError):
            forest.grow(bad, "y", "w", "k", "features", PARAMS)
    with pytest.raises(ValueError):
        forest.grow(base, "y", "w", "k", "features", PARAMS | {"impurity": "entropy"})


def test_training_table_without_columns_to_hash_is_split_by_its_vectors(table):
    """Features, label and weight alone: the shares are right in every class."""
    bare = table.drop("row_key")
    train, test = split(bare, "y", FRACTIONS, 42)
    n = {r.y: r["count"] for r in bare.groupBy("y").count().collect()}
    held = {r.y: r["count"] for r in test.groupBy("y").count().collect()}
    for y, rows in n.items():
        assert abs(held[y] - 0.2 * rows) < 5 * math.sqrt(rows * 0.16)
    assert train.count() + test.count() == 3000
    for cols in (["y"], ["y", "class_weight"]):
        with pytest.raises(ValueError):
            split(bare, "y", FRACTIONS, 42, hash_cols=cols)
    with pytest.raises(ValueError):
        split(bare.select("y", "class_weight"), "y", FRACTIONS, 42)
    t = train_and_evaluate(bare, "y", FRACTIONS, PARAMS, 42, labels=[1, 2, 3])
    assert t.metrics.first().accuracy > 0.6 and t.confusion.count() == 3


def test_packed_bins_are_read_from_any_slice_of_a_column():
    x = np.arange(60, dtype=np.uint8).reshape(20, 3)
    for kind in (pa.binary(), pa.large_binary()):
        batch = pa.record_batch({"bins": pa.array([r.tobytes() for r in x], kind), "y": pa.array(range(20), pa.int32()), "w": np.ones(20, np.int64), "k": np.arange(20)})
        parts = [batch.slice(3, 5), batch.slice(0, 0), batch.slice(8, 12)]
        (found, y, _, _), = forest._rows(parts, 3, False)
        assert np.array_equal(found, x[3:]) and y.tolist() == list(range(3, 20))


def test_draws_are_those_of_the_points():
    """The table of leading bits gives the count that a search among the points gives, also for draws beside a point."""
    points = np.array(forest.poisson_points(), np.uint64)
    keys = np.random.default_rng(5).integers(0, 2**60, 300_000)
    for tree, seed in ((0, 0), (7, 42)):
        salt = np.uint64((tree + 1 + (seed << 20)) * forest.MIX[0] % 2**64)
        draw = forest.mixed(keys.astype(np.uint64) + salt) >> np.uint64(32)
        assert np.array_equal(forest.draws(keys, tree, seed), np.searchsorted(points, draw, side="right"))
    _, counts = forest._draw_tables()
    for p in points.tolist():
        assert counts[p >> 16] == -1 or p & 0xFFFF == 0


def test_a_pass_does_not_copy_its_rows_one_by_one(monkeypatch):
    """Rows are walked in blocks: the sums are those of any block size, leaves above the level included."""
    rng = np.random.default_rng(8)
    n, cuts = 400, [np.arange(6) + 0.5, np.arange(4) + 0.5, np.arange(2) + 0.5]
    x = np.stack([rng.integers(0, len(c) + 1, n) for c in cuts], axis=1).astype(np.uint8)
    batch = pa.record_batch({"bins": pa.array([r.tobytes() for r in x]), "y": pa.array(rng.integers(0, 2, n), pa.int32()), "w": rng.integers(1, 9, n) << 16, "k": np.arange(n)})
    trees = forest.Trees(2, 6, 2, 7, cuts, 2)
    for node in range(2**5 - 1):  # five levels of cuts, the nodes 2 and 4 as leaves
        trees.feature[:, node], trees.cut[:, node] = node % 3, node % 2
    trees.feature[:, 2] = trees.feature[:, 4] = forest._LEAF
    trees.feature[:, 2**5 - 1:2**6 - 1] = forest._LEAF
    below = [n for n in range(2**5 - 1, 2**6 - 1) if not {2, 4} & {(n + 1 >> k) - 1 for k in range(1, 6)}]
    trees.feature[:, below] = forest._OPEN

    def sums():
        return {(r["tree"], r["node"]): dict(zip(r["cells"], r["sums"])) for b in forest.histograms([batch], trees, 5) for r in b.to_pylist()}

    whole = sums()
    assert whole and all(node in below for _, node in whole)
    want = {}
    for tree in range(2):
        for i, times in enumerate(forest.draws(np.arange(n), tree, 7).tolist()):
            node = 0
            while trees.feature[tree, node] >= 0:
                node = 2 * node + 1 + int(x[i, trees.feature[tree, node]] > trees.cut[tree, node])
            if times and trees.feature[tree, node] == forest._OPEN:
                cells = want.setdefault((tree, node), {})
                for s, f in enumerate(forest.candidates(np.array([node]), tree, 7, 3, 2)[0]):
                    cell = int((s * trees.bins + x[i, f]) * 2 + batch.column("y")[i].as_py())
                    cells[cell] = cells.get(cell, 0) + times * batch.column("w")[i].as_py()
    assert whole == want
    monkeypatch.setattr(forest, "BLOCK_ROWS", 37)
    assert sums() == whole


def test_the_training_table_is_sorted_by_its_features_in_each_file(spark, monkeypatch):
    """Neighbours walk the same nodes of the trees, so scoring reads them from the core's cache."""
    from types import SimpleNamespace

    from sevlab.plans import registry

    rng = random.Random(6)
    names = registry._FEATURES
    rows = [(*[float(rng.randrange(3)) for _ in names], 1 + i % 3, 1.0, i) for i in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", severity int, class_weight double, l_orderkey long").repartition(3, "l_orderkey")
    for c in registry.CFG.dedup_keys:
        df = df if c in df.columns else df.withColumn(c, F.lit(1))
    df = df.withColumn("features", array_to_vector(F.array(*names)))
    monkeypatch.setattr(registry, "_prepared", lambda *a: SimpleNamespace(frame=df, release=lambda: None))
    table = registry._training_table(spark, "", "l_orderkey")
    files = {}
    for r in table.select(F.input_file_name().alias("f"), vector_to_array("features").alias("x"), "l_orderkey").collect():
        files.setdefault(r.f, []).append(list(r.x))
    assert sum(map(len, files.values())) == 300 and max(map(len, files.values())) > 50
    assert all(x == sorted(x) for x in files.values())


def test_rows_alike_are_put_together_and_grow_the_same_trees(spark, monkeypatch):
    """Coded columns: the passes over the levels read a row a kind, not a row a row, and the trees stay what they were."""
    df = spark.range(6000).select(F.col("id").alias("k"), (F.col("id") % 5).cast("double").alias("a"), (F.floor(F.col("id") / 7) % 4).cast("double").alias("b"))
    df = df.select("k", array_to_vector(F.array("a", "b")).alias("features"), ((F.col("a") + F.col("b") + F.col("k") % 2) % 3).cast("int").alias("y"), (F.col("k") % 2 + 1.0).alias("w"))
    read = []
    grow = forest._grow
    monkeypatch.setattr(forest, "_grow", lambda binned, trees: (read.append(binned.count()), grow(binned, trees)))
    many = df.withColumn("features", array_to_vector(F.array((F.col("k") * 37 % 6007).cast("double"), F.col("k") % 5 + 0.0)))  # alike once binned only
    for table in (df, many):
        read.clear()
        with monkeypatch.context() as m:
            put = forest.grow(table, "y", "w", "k", "features", PARAMS)
            m.setattr(forest, "ALIKE_ROWS", 1e9)
            rows = forest.grow(table, "y", "w", "k", "features", PARAMS)
        assert same(put, rows) and read[0] < 1500 and read[1] == 6000


def test_rows_alike_in_pieces_have_all_draws(monkeypatch):
    """Small pieces, hashes that collide, two bytes a bin and weights beyond exact doubles give the same sums."""
    rng = np.random.default_rng(9)
    n = 700
    for cuts in ([np.arange(3) + 0.5, np.arange(2) + 0.5], [np.arange(300) + 0.5, np.arange(2) + 0.5]):
        kind = np.uint8 if len(cuts[0]) < 256 else np.uint16
        x = np.stack([rng.integers(0, 4, n) * (len(cuts[0]) // 3), rng.integers(0, 3, n)], axis=1).astype(kind)
        y, w = rng.integers(0, 2, n), rng.integers(1, 3, n) << 44
        batch = pa.record_batch({"bins": [r.tobytes() for r in x], "y": pa.array(y, pa.int32()), "w": w, "k": np.arange(n)})
        trees = forest.Trees(3, 4, 2, 7, cuts, 2)

        def sums(batches):
            out = {}
            for r in (r for b in forest.histograms(batches, trees, 0) for r in b.to_pylist()):
                for c, s in zip(r["cells"], r["sums"]):
                    out[r["tree"], c] = out.get((r["tree"], c), 0) + s
            return out

        whole = sums([batch])
        assert sum(whole.values()) == 2 * sum(int(t) * int(v) for tree in range(3) for t, v in zip(forest.draws(np.arange(n), tree, 7), w))
        for chunk, kinds, most, hashed in ((1 << 20, 1 << 17, 1 << 24, forest.mixed), (100, 10, 1 << 24, forest.mixed), (64, 1 << 17, 3, forest.mixed), (100, 1 << 17, 1 << 24, None)):
            with monkeypatch.context() as m:
                m.setattr(forest, "CHUNK_ROWS", chunk)
                m.setattr(forest, "ALIKE_KINDS", kinds)
                m.setattr(forest, "ALIKE_DRAWS", most)
                if hashed is None:
                    m.setattr(forest, "_hashed", lambda words: words[:, -2] * np.uint64(0))
                found = list(forest.alike([batch.slice(i, 70) for i in range(0, n, 70)], trees))
            assert sums(found) == whole
            if chunk > n:
                assert sum(map(len, found)) == len(np.unique(np.column_stack([x, y, w]), axis=0))
