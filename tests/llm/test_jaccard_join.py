import re
from itertools import combinations

import numpy as np
import pytest
from fixtures import changed, corpus, edges, frame, prose, rows_of

from sevlab.llm import jaccard_join as jj
from sevlab.llm import signature_trees as trees
from sevlab.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, n, percent):
    sets = [shingles(r[1], n) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i) if sets[i] else ("none", i), []).append(i)
    least = {}
    for group in members.values():
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        least |= dict.fromkeys(group, min(ids) if ids else None)
    return sets, members, least


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, n, percent):
    rows = corpus(200) + edges()
    sets, _, least = brute(rows, n, percent)
    got = rows_of(jj.join(frame(spark, rows), n, percent), "doc_id", "n_shingles", "component_id")
    assert got == sorted(((r[0], len(sets[i]), least[i]) for i, r in enumerate(rows)), key=repr)


def test_chains_split_cells_and_large_blocks(spark, monkeypatch):
    """A chain of near copies is one component though its ends are far apart; blocks over CELL are split."""
    import random

    monkeypatch.setattr(jj, "CELL", 8)
    rng = random.Random(3)
    text, rows = prose(rng, 90), []
    for i in range(60):
        rows.append((i, text, "en", "s", 0))
        text = changed(rng, text, 1) if i % 20 != 19 else prose(rng, 90)
    _, _, least = brute(rows, 4, 85)
    got = rows_of(jj.join(frame(spark, rows).repartition(5)), "doc_id", "component_id")
    assert got == sorted(((i, least[i]) for i in range(60)), key=repr)
    assert len({c for _, c in got}) < 20


def test_trees_lose_no_pair():
    rng = np.random.default_rng(1)
    base = [rng.integers(0, 1 << 62, rng.integers(1, 300), dtype=np.uint64) for _ in range(12)]
    sets = [np.unique(b[rng.random(len(b)) < 0.95]) if rng.random() < 0.8 else b for b in base for _ in range(8)]
    sets = [s for s in sets if len(s)]
    sizes = np.array([len(s) for s in sets])
    found = set(zip(*(x.tolist() for x in trees.Bitmaps([trees.bitmap(s) for s in sets], sizes).pairs(np.arange(len(sets)), 80)), strict=True))
    small = set(zip(*(x.tolist() for x in trees.Bitmaps([trees.bitmap(s) for s in sets[:30]], sizes[:30]).group_pairs(np.array([10, 1, 19]), 80)), strict=True))
    for i, j in combinations(range(len(sets)), 2):
        shared = len(np.intersect1d(sets[i], sets[j]))
        if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
            assert (i, j) in found
            if j < 30 and (j < 10 or i > 10):
                assert (i, j) in small
    assert len(found) < len(sets) * (len(sets) - 1) / 4


def test_keep_one(spark):
    rows = corpus(120) + edges()
    docs = frame(spark, rows, clash=True)
    sets, members, _ = brute(rows, 5, 80)
    out = jj.keep_one(docs)
    assert out.columns == docs.columns
    stay = []
    for group in members.values():
        best = min(group, key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
        stay.append(rows[best][0])
    assert rows_of(out, "doc_id") == sorted(((s,) for s in stay), key=repr)
    assert jj.keep_one(docs.limit(0)).count() == 0
    assert jj.join(docs.limit(0)).count() == 0


def test_components_of_a_path(spark):
    links = spark.range(40).selectExpr("id AS a", "id + 1 AS b").filter("a % 13 != 12")
    got = {r.node: r.root for r in components(links).collect()}
    assert all(got[i] == (i // 13) * 13 for i in got)
    assert components(links.limit(0)).count() == 0


def _peak(work):
    import tracemalloc

    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_group_of_near_copies_takes_memory_by_its_sets_not_its_pairs():
    """1,800 near copies meet in three blocks, two of them looked at together: 1.6 million pairs each, a forest of
    1,799 links, and one block of the two to be looked at again."""
    import pyarrow as pa

    rng, n = np.random.default_rng(5), 1800
    base = rng.integers(0, 1 << 62, 120, dtype=np.uint64)
    sets = [np.unique(np.append(base[1:], rng.integers(0, 1 << 62, 1, dtype=np.uint64))) for _ in range(n)]
    bits, size = [trees.bitmap(s) for s in sets], [len(s) for s in sets]
    ids, zero = np.arange(n), np.zeros(3 * n, np.int64)
    batch = pa.RecordBatch.from_pydict({"h": np.repeat([7, 8, 9], n), "low": zero, "high": zero, "root": np.tile(ids, 3), "chunk": zero,
                                        "set": np.tile(ids, 3), "size": size * 3, "bits": bits * 3})
    out, peak = _peak(lambda: list(jj._block_candidates(85, True)(iter([batch]))))
    for part, block in zip(out, (7, 9), strict=True):
        links = [(a, b) for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True) if a is not None]
        assert len(links) == n - 1 and {x for pair in links for x in pair} == set(range(n))
        assert [x for x in part.column("again").to_pylist() if x is not None] == [block]
    assert peak < 40e6, peak


def test_counting_shingles_takes_bounded_memory(monkeypatch):
    """4.5 million shingles of one batch; those of the first text come twice."""
    from types import SimpleNamespace

    import pyarrow as pa

    asked = []

    def keep(df, schema, rows):
        asked.append(rows)
        raise StopIteration

    monkeypatch.setattr(jj, "_arrow", keep)
    with pytest.raises(StopIteration):
        jj.frequent_shingles(SimpleNamespace(select=lambda c: None), 4)
    texts = [" ".join(f"w{i}x{k}" for k in range(3003)) for i in range(1500)]
    batch = pa.RecordBatch.from_pydict({"text": [texts[0], None, *texts]})
    found, peak = _peak(lambda: asked[0](batch))
    assert len(found["h"]) == len(np.unique(found["h"])) == 3000 and set(found["n"].tolist()) == {2}
    assert peak < 90e6, peak


def test_repeated_hashes_take_little_more_than_the_hashes():
    """Two million hashes, 1,000 of them from two sets and one from three."""
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64)) for _ in range(500)]
    sets[1] = np.unique(np.concatenate([sets[1], sets[0][:1000]]))
    sets[2] = np.unique(np.append(sets[2], sets[0][7]))
    (values, counts), peak = _peak(lambda: jj._repeated(sets))
    assert len(values) == 1000 and sorted(counts.tolist()) == [2] * 999 + [3] and not sets
    assert peak < 30e6, peak
    for few in ([], [np.zeros(0, np.uint64)], [np.array([5], np.uint64)]):
        assert [len(x) for x in jj._repeated(few)] == [0, 0]
    assert [x.tolist() for x in jj._repeated([np.array([2, 9], np.uint64), np.array([2], np.uint64), np.array([1, 9], np.uint64)])] == [[2, 9], [2, 2]]


def test_sets_are_sent_some_rows_at_a_time():
    """The sets of one batch come in several, in order."""
    import pyarrow as pa

    asked = []

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, batches, kind):
            asked.append(batches)
            return self

        def dropDuplicates(self, columns):
            return self

    jj.full_sets(Docs(), 2)
    texts = ["", None, *(f"a{i} b{i} c{i % 7} d" for i in range(3 * jj.SENT_ROWS)), ""]
    out = list(asked[0](iter([pa.RecordBatch.from_pydict({"text": texts}), pa.RecordBatch.from_pydict({"text": pa.array([], pa.string())})])))
    assert len(out) >= 4 and max(b.num_rows for b in out) <= jj.SENT_ROWS
    sets = [s for s in jj.shingle_sets(pa.array(texts), 2) if len(s)]
    assert [r["hashes"] for r in pa.Table.from_batches(out).to_pylist()] == [s.view(np.int64).tolist() for s in sets]
