"""Hard negatives against all products."""

import math
import random

import pytest

from sevlab.llm import slot_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rid string, v string, slot string, score string"
NAN, INF = float("nan"), float("inf")
LIMIT = 2**63


def brute(rows):
    used = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or math.isnan(x) or math.isinf(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        used.append((vec_id, [max(-2**62, min(2**62, math.floor(256 * x))) for x in vector], label))
    out = []
    for i, (anchor, a, label) in enumerate(used):
        if anchor is None or anchor % 100:
            continue
        scored = []
        for j, (other, v, its) in enumerate(used):
            if i != j:
                score = max(-LIMIT, min(LIMIT - 1, sum(x * y for x, y in zip(a, v))))
                scored.append((-score, other is None, other or 0, other, its))
        scored.sort(key=lambda t: t[:3])
        for down, _, _, positive, _ in [t for t in scored if t[4] == label][:5]:
            inside = [t for t in scored if t[4] != label and 80 * -down <= 100 * -t[0] <= 100 * -down][:5]
            out += [(anchor, positive, k + 1, t[3], -down, -t[0]) for k, t in enumerate(inside)]
    return sorted(out, key=repr)


def vectors(n: int, seed: int, d: int = 6):
    rng = random.Random(seed)
    rows = [(rng.randrange(0, n) * rng.choice([1, 1, 100]), [rng.gauss(0, 0.3) for _ in range(d)], rng.randrange(0, 4)) for _ in range(n)]
    rows += [rows[3]] * 7 + [(100, [0.5] * d, 1)] * 4 + [(k, [0.5] * d, 2) for k in range(9)]  # ties and repeated rows
    rows += [(None, [0.2] * d, 1), (None, [0.2] * d, 2), (200, None, 1), (300, [0.1] * d, None), (400, [NAN] * d, 1), (500, [INF] + [0.0] * (d - 1), 1),
             (600, [None] + [0.0] * (d - 1), 1), (700, [], 1), (800, [0.3], 2), (900, [0.1] * (d + 3), 3), (1000, [0.0] * d, 1), (1100, [-0.4] * d, 2)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)


@pytest.mark.parametrize("anchors, tile", [(slot_negatives.ANCHORS, slot_negatives.TILE), (6, 5)])
def test_negatives_equal_brute_force(spark, monkeypatch, anchors, tile):
    monkeypatch.setattr(slot_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(slot_negatives, "TILE", tile)
    rows = vectors(300, 5)
    got = slot_negatives.hard_negatives(frame(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows) != []


def test_large_components_stay_exact(spark):
    rng = random.Random(8)
    rows = vectors(120, 6) + [(100 * k, [rng.choice([1e9, -1e9, 1e30, 3.5, 2.0**40 + 0.25]) for _ in range(6)], rng.randrange(0, 3)) for k in range(8)]
    got = slot_negatives.hard_negatives(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_one_common_vector_and_empty_tables(spark):
    rows = [(k, [0.25, 0.5], k % 3) for k in range(400)]
    got = slot_negatives.hard_negatives(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    for none in ([], [(1, [0.5], 1)]):
        empty = slot_negatives.hard_negatives(frame(spark, none))
        assert empty.collect() == [] and ", ".join(f"{n} {t}" for n, t in empty.dtypes).replace("bigint", "long") == slot_negatives.RESULT


def test_tasks_emit_only_tops():
    import numpy as np

    tops = slot_negatives.Tops(2)
    rng = np.random.default_rng(3)
    for _ in range(50):
        group, score, ids = rng.integers(0, 6, 40), rng.integers(-5, 5, 40), rng.integers(0, 9, 40)
        tops.add(group, score, ids, ids == 8)
        assert len(tops.group) <= 12
    assert tops.least(8)[6] == slot_negatives._LONG.min and (tops.least(8)[:6] == 4).all()
