"""Quality rules by robust multivariate outliers.

Each text becomes a vector of transformed statistics. For every (language, source) cell the
minimum-covariance-determinant estimate (the mean and covariance of the h rows, h = 75 %, whose
covariance has the smallest determinant) is found by concentration steps, reweighted once, and
rows whose squared Mahalanobis distance exceeds a chi-square quantile are rejected.

How it is spread: one concentration step is one aggregation over all rows. A row's distance puts
it into one of ``BINS`` logarithmic bins; per (cell, start, bin) Spark sums counts, vectors and
products with a map-side combine, and per (cell, start) a task with at most ``BINS`` rows adds up
the nearest bins until they hold h rows (whole bins, so ties stay together). No group of rows ever
meets in one task, however large its cell. Vectors are integers (thousandths), so all sums are
exact and no result depends on the order or number of partitions.

Three deterministic starts: robust scales alone, the correlation of tanh-squashed scores, and the
spatial sign covariance. A floor (``FLOORS``) is added to each variance: most clean texts have no
symbol at all, and without it the determinant of such a cell is zero.

Defined results: null or empty texts fail the base rule; null languages and sources are cells of
their own; cells of fewer than ``min_rows`` judged rows are pooled by language; a pool that is still
smaller is judged by the estimate of all its language's rows, and if these are too few, by that of
all rows, so every row has a verdict; equal rows get equal verdicts; empty tables give
empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sevlab.llm import bytescan as scan
from sevlab.llm import text_statistics
from sevlab.llm.common import free_name, key_of, release, written

UNIT = 1000  # a vector's integers are thousandths
#: Lowest standard deviation of each statistic; part of the covariance, so that no determinant is zero.
FLOORS = {"word_length": 0.10, "symbols": 0.05, "punctuation": 0.04, "capitals": 0.06, "duplicate_lines": 0.15, "echoes": 0.10}
P = len(FLOORS)
BINS, BINS_PER_DOUBLING = 1024, 64
MIN_ROWS = 50
SHARE = 0.75
STEPS = 6
QUANTILE = 0.9999


def chi_square_cdf(x: float, dof: int) -> float:
    """P(X <= x) by the recurrence over degrees of freedom."""
    if x <= 0:
        return 0.0
    half = x / 2
    value, k = (math.erf(math.sqrt(half)), 1) if dof % 2 else (1 - math.exp(-half), 2)
    while k < dof:
        value -= math.exp(k / 2 * math.log(half) - half - math.lgamma(k / 2 + 1))
        k += 2
    return value


def chi_square_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dof) < p else (low, mid)
    return high


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of normal rows is multiplied by."""
    return share / chi_square_cdf(chi_square_quantile(share, P), P + 2) if share < 1 else 1.0


def with_counts(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``name`` of text_statistics.COUNTS."""
    kind = T.StructType([T.StructField(c, T.LongType(), False) for c in text_statistics.COUNTS])
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind, False)])
    at = docs.columns.index(text)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for first, end, data, offsets in scan.chunks(batch.column(at)):  # a chunk's rows at a time
                found = text_statistics.count(data, offsets)
                counts = pa.StructArray.from_arrays([pa.array(found[c]) for c in text_statistics.COUNTS], names=list(text_statistics.COUNTS))
                own = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*own.columns, counts], names=[*batch.schema.names, name])

    return docs.mapInArrow(batches, schema)


def base_failed(c: str) -> Column:
    """Fewer than 10 words, or over a fifth of them in repeated 5-word windows."""
    return (F.col(f"{c}.n_words") < 10) | (100 * F.col(f"{c}.n_repeat_words") > 20 * F.col(f"{c}.n_words"))


def vector(c: str) -> list[Column]:
    """The transformed statistics as integers: logarithm of the mean word length, square roots of shares."""
    chars, n = (F.greatest(F.col(f"{c}.{x}"), F.lit(1)).cast("double") for x in ("word_chars", "n_words"))
    n_lines = F.greatest(F.col(f"{c}.n_lines"), F.lit(1)).cast("double")
    raw = [F.log(chars / n), F.sqrt(F.col(f"{c}.n_symbols") / chars), F.sqrt(F.col(f"{c}.n_punct") / chars),
           F.sqrt(F.col(f"{c}.n_upper") / chars), F.sqrt(F.col(f"{c}.n_dup_lines") / n_lines), F.sqrt(F.col(f"{c}.n_echoes") / n)]
    return [F.round(F.least(x, F.lit(20.0)) * UNIT).cast("long").alias(f"x{i}") for i, x in enumerate(raw)]


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(P) for j in range(i, P)]


def _distance(center: str, inverse: str) -> Column:
    """Squared Mahalanobis distance of x0.. from columns holding a center and an inverse covariance."""
    d = [F.col(f"x{i}") - F.col(center)[i] for i in range(P)]
    terms = [(1 if i == j else 2) * F.col(inverse)[i * P + j] * d[i] * d[j] for i, j in _pairs()]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(P)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in _pairs()]]


def _moments(rows: pd.DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and covariance (divided by n) of summed rows, from exact integers."""
    n = int(rows["n"].sum())
    s = [sum(map(int, rows[f"s{i}"])) for i in range(P)]
    cov = np.zeros((P, P))
    for i, j in _pairs():
        cov[i, j] = cov[j, i] = (n * sum(map(int, rows[f"s{i}_{j}"])) - s[i] * s[j]) / (n * n)
    return n, np.array([x / n for x in s]), cov


def _estimate(center: np.ndarray, cov: np.ndarray, factor: float) -> dict:
    """Centre, inverse and log-determinant of ``factor * cov`` with the floors added."""
    full = factor * cov + np.diag([(v * UNIT) ** 2 for v in FLOORS.values()])
    return {"center": center.tolist(), "inverse": np.linalg.inv(full).ravel().tolist(), "logdet": float(np.linalg.slogdet(full)[1])}


ESTIMATE = "cell string, start int, center array<double>, inverse array<double>, logdet double"


def _first_estimates(rows: DataFrame) -> DataFrame:
    """Three starts a cell, from exact quartiles (of integers in a bounded range) and one aggregation."""
    quartiles = rows.groupBy("cell").agg(*[F.percentile(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i in range(P)])
    floor = [v * UNIT for v in FLOORS.values()]
    scales = [F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(floor[i])).alias(f"scale{i}") for i in range(P)]
    centers = written(quartiles.select("cell", *[F.col(f"q{i}")[1].alias(f"center{i}") for i in range(P)], *scales), "mcd-centers")
    z = [(F.col(f"x{i}") - F.col(f"center{i}")) / F.col(f"scale{i}") for i in range(P)]
    norm = F.sqrt(sum((v * v for v in z[1:]), z[0] * z[0]))
    whole = lambda v: F.round(v * UNIT).cast("long")
    scored = rows.join(centers, "cell").select("*", *[whole(F.tanh(v)).alias(f"t{i}") for i, v in enumerate(z)],
                                               *[whole(F.when(norm > 0, v / norm).otherwise(0.0)).alias(f"u{i}") for i, v in enumerate(z)])
    keep = [f"{k}{i}" for k in ("center", "scale") for i in range(P)]
    sums = scored.groupBy("cell", *keep).agg(*[F.sum(F.col(f"{k}{i}") * F.col(f"{k}{j}")).alias(f"{k}{i}_{j}") for k in "tu" for i, j in _pairs()])

    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in pdf.to_dict("records"):
            center, scale = (np.array([r[f"{k}{i}"] for i in range(P)]) for k in ("center", "scale"))
            found = [np.eye(P)]
            for k in "tu":
                m = np.zeros((P, P))
                for i, j in _pairs():
                    m[i, j] = m[j, i] = r[f"{k}{i}_{j}"]
                side = np.sqrt(np.maximum(np.diag(m), 1e-9))
                found.append(m / np.outer(side, side))
            out += [{"cell": r["cell"], "start": s} | _estimate(center, np.outer(scale, scale) * (0.99 * c + 0.01 * np.eye(P)), 1.0) for s, c in enumerate(found)]
        return pd.DataFrame(out)

    return sums.groupBy("cell").applyInPandas(starts, ESTIMATE)


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step of every start: the nearest whole bins that hold h rows give the next estimate."""
    d2 = _distance("center", "inverse")
    at = F.least(F.floor(BINS_PER_DOUBLING * F.log2(1 + d2)), F.lit(BINS - 1)).cast("int")
    sums = rows.join(estimates.select("cell", "start", "center", "inverse"), "cell").withColumn("bin", at).groupBy("cell", "start", "bin").agg(*_sums())

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        total = pdf["n"].cumsum().to_numpy()
        kept = pdf.iloc[: int(np.searchsorted(total, math.ceil(SHARE * total[-1]))) + 1]
        n, center, cov = _moments(kept)
        return pd.DataFrame([{"cell": pdf["cell"].iloc[0], "start": int(pdf["start"].iloc[0])} | _estimate(center, cov, consistency(n / int(total[-1])))])

    return sums.groupBy("cell", "start").applyInPandas(nearest, ESTIMATE)


def _reweighted(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """The best start of each cell, re-estimated from all rows within its 97.5 % ellipsoid."""
    best = estimates.groupBy("cell").agg(F.min_by(F.struct("center", "inverse"), F.struct("logdet", "start")).alias("e")).select("cell", "e.*")
    near = _distance("center", "inverse") <= chi_square_quantile(0.975, P)
    sums = rows.join(best, "cell").filter(near).groupBy("cell").agg(*_sums())
    factor = consistency(0.975)

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        _, center, cov = _moments(pdf)
        return pd.DataFrame([{"cell": pdf["cell"].iloc[0], "start": -1} | _estimate(center, cov, factor)])

    return sums.groupBy("cell").applyInPandas(final, ESTIMATE).select("cell", "center", "inverse")


def fit(judged: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """(lang, source, center, inverse) of every cell that has an estimate. ``judged``: lang, source, x0..;
    the rows that the base rule keeps."""
    lang, source, n = F.col("lang"), F.col("source"), F.col("n")
    counts = judged.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    of_lang = Window.partitionBy("lang")
    counts = counts.withColumns({"pooled": F.sum(F.when(n < min_rows, n)).over(of_lang), "of_lang": F.sum(n).over(of_lang)})
    whole_lang, everything = key_of(F.lit("language"), lang), F.lit("all")
    cell = (F.when(n >= min_rows, key_of(F.lit("cell"), lang, source)).when(F.col("pooled") >= min_rows, key_of(F.lit("pool"), lang))
            .when(F.col("of_lang") >= min_rows, whole_lang).otherwise(everything))
    cells = written(counts.select("lang", "source", cell.alias("cell")).withColumn("lang_asked", F.max(F.col("cell") == whole_lang).over(of_lang)), "mcd-cells")
    all_asked = bool(cells.filter(F.col("cell") == everything).limit(1).count())
    # a row counts for its own cell, and for the wider ones from which smaller cells are judged
    counts_for = F.array_compact(F.array_distinct(F.array("cell", F.when(F.col("lang_asked"), whole_lang), F.when(F.lit(all_asked), everything))))
    named = cells.select(F.col("lang").alias("l"), F.col("source").alias("s"), F.explode(counts_for).alias("cell"))
    same = lang.eqNullSafe(F.col("l")) & source.eqNullSafe(F.col("s"))
    rows = written(judged.join(named, same).select("cell", *[f"x{i}" for i in range(P)]), "mcd-rows")
    estimates = written(_first_estimates(rows), "mcd-start")
    for _ in range(STEPS):
        before, estimates = estimates, written(_concentrate(rows, estimates), "mcd-step")
        release(before)
    return written(cells.join(_reweighted(rows, estimates), "cell").select("lang", "source", "center", "inverse"), "mcd-estimates")


def verdicts(rows: DataFrame, estimates: DataFrame, failed: Column, quantile: float = QUANTILE) -> DataFrame:
    """``rows`` (lang, source, x0.. and more) with ``kept``: not failed, and within its cell's ellipsoid."""
    e = estimates.select(F.col("lang").alias("e_lang"), F.col("source").alias("e_source"), F.col("center").alias("e_center"), F.col("inverse").alias("e_inverse"))
    joined = rows.join(e, F.col("lang").eqNullSafe(F.col("e_lang")) & F.col("source").eqNullSafe(F.col("e_source")), "left")
    far = F.coalesce(_distance("e_center", "e_inverse") > chi_square_quantile(quantile, P), F.lit(False))
    return joined.withColumn("kept", ~failed & ~far).drop("e_lang", "e_source", "e_center", "e_inverse")


def counts_table(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts ``c``, the base rule's verdict and the vector, written once."""
    counted = with_counts(docs.select("doc_id", "lang", "source", "text"), "c").drop("text")
    return written(counted.select("doc_id", "lang", "source", "c", base_failed("c").alias("base_failed"), *vector("c")), "mcd-counts")


def judge(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """doc_id, the base counts, base_failed and kept, a row for each document."""
    table = counts_table(docs)
    estimates = fit(table.filter(~F.col("base_failed")), min_rows)
    base = [F.col(f"c.{x}").alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return verdicts(table, estimates, F.col("base_failed")).select("doc_id", *base, "base_failed", "kept")


def keep_good(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its columns. The estimates come from one pass over
    the texts; the second pass counts again and joins the few estimates, so no text is shuffled."""
    table = counts_table(docs)
    estimates = fit(table.filter(~F.col("base_failed")), min_rows)
    counted = with_counts(docs, name := free_name(docs, "c"))
    nested = counted.select("lang", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), base_failed(name).alias("base_failed"), *vector(name))
    return verdicts(nested, estimates, F.col("base_failed")).filter("kept").select("doc.*")
