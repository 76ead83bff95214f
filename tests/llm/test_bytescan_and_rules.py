import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import corpus, edges, frame, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from sevlab.llm import bytescan as scan
from sevlab.llm import mcd_rules as mcd
from sevlab.llm import text_statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t#%\x0b中", max_size=60)), max_size=8))
def test_counts_equal_plain_python(texts):
    got = []
    for _, _, data, offsets in scan.chunks(pa.array(texts, pa.string()), 40):
        c = text_statistics.count(data, offsets)
        got += zip(*(c[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))
    assert got == [base(t) for t in texts]


def test_chi_square():
    assert mcd.chi_square_quantile(0.95, 1) == pytest.approx(3.841459, abs=1e-5)
    assert mcd.chi_square_quantile(0.99, 6) == pytest.approx(16.811894, abs=1e-5)
    assert mcd.chi_square_cdf(7.0, 5) == pytest.approx(0.7793596, abs=1e-6)


def verdicts(rows, min_rows):
    """The same estimates by sorting whole cells in numpy."""
    stats, cells = [], {}
    for i, (_, text, lang, source, _n) in enumerate(rows):
        (_, _, data, offsets), = scan.chunks(pa.array([text], pa.string()))
        c = {k: float(v[0]) for k, v in text_statistics.count(data, offsets).items()}
        chars, n, lines = max(c["word_chars"], 1), max(c["n_words"], 1), max(c["n_lines"], 1)
        raw = [math.log(chars / n), *(math.sqrt(c[k] / d) for k, d in (("n_symbols", chars), ("n_punct", chars), ("n_upper", chars), ("n_dup_lines", lines), ("n_echoes", n)))]
        failed = c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        stats.append(([math.floor(min(x, 20) * mcd.UNIT + 0.5) for x in raw], failed))
        if not failed:
            cells.setdefault((lang, source), []).append(i)
    small = {c: m for c, m in cells.items() if len(m) < min_rows}
    pools = {lang: sum(len(m) for c, m in small.items() if c[0] == lang) for lang, _ in small}
    langs = {lang: [i for c, m in cells.items() if c[0] == lang for i in m] for lang, _ in cells}

    def name(cell):
        lang = cell[0]
        return cell if cell not in small else ("pool", lang, 0) if pools[lang] >= min_rows else ("language", lang, 0, 0) if len(langs[lang]) >= min_rows else "all"

    judged, counted = {}, {}
    for cell, members in cells.items():
        judged.setdefault(name(cell), []).extend(members)
        counted.setdefault(name(cell), []).extend(members)
    for group in judged:  # wider estimates are over all rows
        if group == "all" or len(group) == 4:
            counted[group] = [i for m in cells.values() for i in m] if group == "all" else langs[group[1]]
    kept = [not f for _, f in stats]
    floors = np.diag([(v * mcd.UNIT) ** 2 for v in mcd.FLOORS.values()])
    for group, its in judged.items():
        members = counted[group]
        x = np.array([stats[i][0] for i in members], float)

        def distance(center, cov, x=x):
            d = x - center
            return np.maximum(np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d), 0)

        q1, center, q3 = np.percentile(x, [25, 50, 75], axis=0)
        scale = np.maximum((q3 - q1) / 1.349, np.sqrt(np.diag(floors)))
        z = (x - center) / scale
        norm = np.linalg.norm(z, axis=1, keepdims=True)
        best = None
        for scores in (None, np.tanh(z), np.divide(z, norm, out=np.zeros_like(z), where=norm > 0)):
            corr = np.eye(mcd.P)
            if scores is not None:
                m = np.floor(scores * mcd.UNIT + 0.5)
                m = m.T @ m
                side = np.sqrt(np.maximum(np.diag(m), 1e-9))
                corr = m / np.outer(side, side)
            at, cov = center, np.outer(scale, scale) * (0.99 * corr + 0.01 * np.eye(mcd.P)) + floors
            for _ in range(mcd.STEPS):
                bins = np.minimum(np.floor(mcd.BINS_PER_DOUBLING * np.log2(1 + distance(at, cov))), mcd.BINS - 1)
                last = np.sort(bins)[math.ceil(mcd.SHARE * len(x)) - 1]
                near = x[bins <= last]
                at, cov = near.mean(axis=0), mcd.consistency(len(near) / len(x)) * np.cov(near.T, bias=True) + floors
            found = (np.linalg.slogdet(cov)[1], at, cov)
            best = found if best is None or found[0] < best[0] - 1e-9 else best
        near = x[distance(best[1], best[2]) <= mcd.chi_square_quantile(0.975, mcd.P)]
        cov = mcd.consistency(0.975) * np.cov(near.T, bias=True) + floors
        center = near.mean(axis=0)
        own = np.array([stats[i][0] for i in its], float)
        far = distance(center, cov, own) > mcd.chi_square_quantile(mcd.QUANTILE, mcd.P)
        for i, out in zip(its, far, strict=True):
            kept[i] &= not out
    return [f for _, f in stats], kept


def test_rules_equal_brute_force(spark):
    rows = corpus(400) + edges()
    got = rows_of(mcd.judge(frame(spark, rows), min_rows=30), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    failed, kept = verdicts(rows, 30)
    assert got == sorted(((r[0], *base(r[1]), f, k) for r, f, k in zip(rows, failed, kept, strict=True)), key=repr)
    assert any(f is False and k is False for f, k in zip(failed, kept, strict=True))  # the junk is far out


def test_small_cells_and_rare_languages_are_judged(spark):
    """A text of signs in a rare source, in a rare language and in both is rejected; plain ones stay."""
    rows = [(i, t, "en", "src0", n) for i, t, _, _, n in corpus(200)]
    plain, junk = rows[2][1], " ".join(["#%&|"] * 40 + ["w"] * 5)
    odd = [("en", "rare"), ("xx", "src0"), (None, None), ("xx", None)]
    rows += [(1000 + 2 * k + bad, junk if bad else plain + f" {k}", lang, source, 1) for k, (lang, source) in enumerate(odd) for bad in (0, 1)]
    got = {r.doc_id: r.kept for r in mcd.judge(frame(spark, rows)).collect()}
    assert [got[1000 + 2 * k] for k in range(4)] == [True] * 4 and [got[1001 + 2 * k] for k in range(4)] == [False] * 4
    assert got == {r[0]: k for r, k in zip(rows, verdicts(rows, mcd.MIN_ROWS)[1])}
    few = frame(spark, [(1, plain, "en", "s", 1), (2, plain + " more", "de", "t", 1)])
    assert all(r.kept for r in mcd.judge(few).collect())


def test_stage_keeps_the_kept_rows_and_all_columns(spark):
    rows = corpus(120) + edges()
    docs = frame(spark, rows, clash=True)
    out = mcd.keep_good(docs, min_rows=30)
    assert out.columns == docs.columns
    failed, kept = verdicts(rows, 30)
    assert rows_of(out, "doc_id", "text") == sorted(((r[0], r[1]) for r, k in zip(rows, kept, strict=True) if k), key=repr)


def test_partitions_do_not_matter_and_empty(spark):
    docs = frame(spark, corpus(150))
    assert rows_of(mcd.judge(docs.repartition(7), 30), "doc_id", "kept") == rows_of(mcd.judge(docs.coalesce(1), 30), "doc_id", "kept")
    assert mcd.judge(docs.limit(0)).count() == 0
    assert mcd.keep_good(docs.limit(0)).count() == 0


def test_counts_are_sent_a_chunk_at_a_time():
    """Texts of 2 MB in one batch come back in several, each row with its own counts."""
    from pyspark.sql import types as T

    asked = []

    class Docs:
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
        columns = ["doc_id", "text"]

        def mapInArrow(self, batches, kind):
            asked.append(batches)

    mcd.with_counts(Docs(), "counts")
    texts = [None, "", *(f"word{i} " * (i % 60) for i in range(9000)), "", None]
    out = list(asked[0](iter([pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})])))
    assert len(out) > 3 and max(sum(len(t or "") for t in b.column(1).to_pylist()) for b in out) <= scan.CHUNK_BYTES
    rows = pa.Table.from_batches(out).to_pylist()
    assert [r["doc_id"] for r in rows] == list(range(len(texts))) and [r["text"] for r in rows] == texts
    assert [r["counts"]["n_words"] for r in rows] == [len((t or "").split()) for t in texts]
