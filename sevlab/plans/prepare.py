"""Prepare job: raw joined table -> cleaned, imputed, encoded, outlier-handled, weighted,
scaled training table. Variant "drop" or "flag" (see ``PrepConfig``).

Passes over the data (each a distributed aggregation returning a few numbers):
  1. clean (sentinels, required, dedup) -> written once to the shared folder (lineage cut:
     every later fit reads the compact parquet copy, and a lost executor recomputes from it)
  2. medians, from one count of all median columns' values (exact), or one sketch
  3. modes, from one count of all mode columns' values
  4. category counts for all indexes, one pass (``operators.categories``), concurrently with
  5. IQR quartiles of all outlier columns, as the medians
  6. class counts + per-class mean/variance of the numeric features, one aggregation
     (gives both the class weights and the z-score mean/std); concurrent with 4-5 in the
     flag variant
The rest is one projection/filter chain over the parquet copy and an equi join of the class
weights, which Spark broadcasts if it measures them as small.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import TIME_BIN_OTHER, TIME_BINS, PrepConfig
from ..functions import bin_by_ranges
from ..operators.balance import attach
from ..operators.clean import dedup, drop_nulls, fill_values, fit_medians_and_modes, sentinels_to_null
from ..operators.categories import CategoryIndex, fit_category_index
from ..operators.features import assembler
from ..operators.forest import row_key
from ..operators.outliers import domain_filter, drop_outside, fences, fit_iqr_bounds, flag_outliers
from ..session import scratch_path
from ..sources.files import read_parquet, write_parquet

NUM_VEC = "numeric_features_before_scaling"
NUM_SCALED = "numeric_features_scaled"


@dataclass
class Prepared:
    frame: DataFrame
    fitted: dict[str, Any]
    indexer: CategoryIndex
    stages: dict[str, DataFrame] = field(default_factory=dict)
    base_path: str | None = None
    counts: dict[str, int] = field(default_factory=dict)

    def release(self) -> None:
        """Delete the cleaned copy in the shared folder once ``frame`` has been written or
        consumed (the frame reads it lazily, so release only afterwards)."""
        if self.base_path:
            from ..session import delete_path
            delete_path(self.frame.sparkSession, self.base_path)
            self.base_path = None


def clean(df: DataFrame, cfg: PrepConfig) -> dict[str, DataFrame]:
    """Sentinels -> null, drop rows missing a required column, one row per dedup key."""
    nulled = sentinels_to_null(df, cfg.sentinels)
    required = drop_nulls(nulled, cfg.required)
    deduped = dedup(required, cfg.dedup_keys, cfg.dedup_order)
    return {"input": df, "sentinels_to_null": nulled, "required": required, "dedup": deduped}


def clean_counts(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    """Rows after each cleaning step, (step_no, step, rows), in two passes instead of one per
    step: sentinels drop no row and the required-columns step is a filter, so the input,
    sentinel and required counts come from one aggregation; the dedup count is the number of
    key groups (null keys equal), one more aggregation."""
    from functools import reduce

    nulled = sentinels_to_null(df, cfg.sentinels)
    ok = F.lit(True)
    for c in cfg.required:
        ok = ok & F.col(c).isNotNull()
    first = nulled.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(ok, F.lit(1))).alias("r"))
    steps = [(0, "input", "n"), (1, "sentinels_to_null", "n"), (2, "required", "r")]
    rows3 = first.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col(c).alias("rows")) for i, name, c in steps
    ])).alias("s")).select("s.*")
    parts = [rows3]
    groups = nulled.filter(ok).groupBy(*cfg.dedup_keys).agg(F.lit(1).alias("_g"))
    parts.append(groups.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(3).alias("step_no"), F.lit("dedup").alias("step"), "rows"))
    return reduce(DataFrame.unionByName, parts)


STEPS = ("input", "sentinels_to_null", "required", "dedup")


def write_clean(df: DataFrame, cfg: PrepConfig, path: str) -> dict[str, int]:
    """Write the cleaned table to ``path`` and count the rows of each step in the same job.

    The counts are observed while the rows pass (no further pass over the data). A map task that is run again
    after a lost executor would be observed twice, so the writing stage, whose tasks count once, observes the
    rows that each survivor of the deduplication stands for: their sum must be the map side's count of rows
    with all required columns. Where it is not, the steps are counted anew (``clean_counts``)."""
    nulled = sentinels_to_null(df, cfg.sentinels)
    complete = F.lit(True)
    for c in cfg.required:
        complete = complete & F.col(c).isNotNull()
    one, merged = F.count(F.lit(1)), "_merged_rows"
    before, after = Observation("clean-before"), Observation("clean-after")
    required = nulled.observe(before, one.alias("input"), F.count_if(complete).alias("required")).filter(complete)
    deduped = dedup(required, cfg.dedup_keys, cfg.dedup_order, merged).observe(after, one.alias("dedup"), F.sum(merged).alias("required"))
    write_parquet(deduped.drop(merged), path)
    seen, kept = before.get, after.get
    if (kept.get("required") or 0) != seen.get("required", 0):
        return {r.step: r.rows for r in clean_counts(df, cfg).collect()}
    n = seen.get("input", 0)
    return dict(zip(STEPS, (n, n, seen.get("required", 0), kept.get("dedup", 0))))


def counts_table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """(step_no, step, rows) of counted steps."""
    return spark.createDataFrame([(i, step, n) for i, (step, n) in enumerate(counts.items())], "step_no int, step string, rows bigint")


def cut_lineage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write to the shared folder and read back (reliable; never a local checkpoint)."""
    return cut_lineage_at(df, path or scratch_path(df.sparkSession, name))


def cut_lineage_at(df: DataFrame, path: str) -> DataFrame:
    write_parquet(df, path)
    return read_parquet(df.sparkSession, path)


def combine_moments(rows: DataFrame, cols: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """Overall mean and sample std of each column from per-class (n, mean, population variance) rows: the
    weighted mean, then the variances inside and between the classes. Two rows come to the driver."""
    sums = rows.agg(*[F.struct(F.sum(f"n_{c}"), F.sum(F.col(f"n_{c}") * F.col(f"mean_{c}"))) for c in cols]).first()
    means = {c: (s[0] or 0, s[1] / s[0] if s[0] else None) for c, s in zip(cols, sums)}
    spread = [F.sum(F.col(f"n_{c}") * (F.col(f"var_{c}") + F.pow(F.col(f"mean_{c}") - F.lit(means[c][1]), F.lit(2.0)))) for c in cols]
    squares = rows.agg(*spread).first()
    return {c: (mean, None if mean is None else ((m2 / (n - 1)) ** 0.5 if n > 1 else 0.0)) for (c, (n, mean)), m2 in zip(means.items(), squares)}


def apply_fitted(df: DataFrame, cfg: PrepConfig, fitted: dict, indexer: CategoryIndex, with_weight: bool = True) -> DataFrame:
    """Everything after the fits, as projections/filters with the fitted numbers as literals.
    Also used to prepare new rows (a batch or a stream) with what training learnt."""
    out = fill_values(df, fitted["fill"])
    if cfg.time_column:
        out = out.withColumn(cfg.time_bin_column, bin_by_ranges(cfg.time_column, TIME_BINS, TIME_BIN_OTHER))
    out = indexer.transform(out)
    if cfg.variant == "drop":
        out = drop_outside(out, fences(fitted["bounds"]))
    else:
        out = domain_filter(flag_outliers(out, fences(fitted["bounds"])), cfg.domain_bounds)
    if with_weight:
        out = attach(out, fitted["class_weights"], cfg.label, ["class_weight"])
    scaled = []
    for c in cfg.numeric:
        mean, std = fitted["scale"][c]
        inv = 0.0 if not std else 1.0 / std
        scaled.append(((F.col(c).cast("double") - F.lit(mean)) * F.lit(inv)).alias(f"_z_{c}"))
    out = out.select("*", *scaled)
    zcols = [f"_z_{c}" for c in cfg.numeric]
    out = assembler(cfg.numeric, NUM_VEC).transform(out)
    out = assembler(zcols, NUM_SCALED).transform(out)
    head = [NUM_SCALED] if cfg.variant == "drop" else list(cfg.numeric)
    out = assembler(head + cfg.encoded_features, "features").transform(out)
    return out.drop(*zcols)


def prepare(df: DataFrame, cfg: PrepConfig, base_path: str | None = None) -> Prepared:
    """``cfg.fit_on == "train"``: every fitted number (medians, modes, indexes, fences,
    class weights, mean/std) comes from the md5 train split of the rows only (no leakage
    into the test rows); the output gets an ``is_train`` column. Default: all rows, as the
    original."""
    stages = clean(df, cfg)
    own_copy = base_path is None
    base_path = base_path or scratch_path(df.sparkSession, "prepare-base")
    counts = write_clean(df, cfg, base_path)
    base = read_parquet(df.sparkSession, base_path)
    full = base
    if cfg.fit_on == "train":
        from ..operators.sampling import hash_sample_condition
        full = base.withColumn("is_train", hash_sample_condition(cfg.label, cfg.train_fractions, cfg.dedup_keys))
        base = full.filter(F.col("is_train"))

    medians, modes = fit_medians_and_modes(base, cfg.median_columns, cfg.mode_columns, cfg.quantile_error)
    fill = {**medians, **modes, **dict(cfg.constant_fill)}
    imputed = fill_values(base, fill)
    binned = imputed
    if cfg.time_column:
        binned = imputed.withColumn(cfg.time_bin_column, bin_by_ranges(cfg.time_column, TIME_BINS, TIME_BIN_OTHER))
    def class_pass(kept_rows: DataFrame) -> DataFrame:
        """Class counts and per-class moments in one pass, as a small table of the shared folder."""
        aggs = [F.count(F.lit(1)).alias("count")]
        for c in cfg.numeric:
            x = F.col(c).cast("double")
            aggs += [F.count(x).alias(f"n_{c}"), F.avg(x).alias(f"mean_{c}"), F.var_pop(x).alias(f"var_{c}")]
        return cut_lineage(kept_rows.groupBy(cfg.label).agg(*aggs), "classes")

    # The index counts and the IQR quartiles read only the imputed table, so they run as
    # concurrent jobs (Spark schedules jobs from several driver threads). In the flag variant
    # the kept rows do not depend on the fences (flags only add columns), so the class pass
    # joins them; in the drop variant it waits for the fences.
    with ThreadPoolExecutor(max_workers=3) as pool:
        f_index = pool.submit(fit_category_index, binned, cfg.categorical)
        f_bounds = pool.submit(fit_iqr_bounds, imputed, cfg.outlier_columns, cfg.quantile_error, cfg.iqr_factor)
        f_rows = pool.submit(class_pass, domain_filter(imputed, cfg.domain_bounds)) if cfg.variant == "flag" else None
        indexer, bounds = f_index.result(), f_bounds.result()
        fitted: dict[str, Any] = {"medians": medians, "modes": modes, "fill": fill, "bounds": bounds}
        kept = apply_fitted(base, cfg, {**fitted, "scale": {c: (0.0, 1.0) for c in cfg.numeric}},
                            indexer, with_weight=False)
        kept = kept.drop(NUM_VEC, NUM_SCALED, "features")
        rows = f_rows.result() if f_rows is not None else class_pass(kept)

    most = rows.agg(F.max("count")).first()[0] or 0
    fitted["class_weights"] = rows.select(cfg.label, "count", (F.lit(float(most)) / F.col("count")).alias("class_weight"))
    fitted["scale"] = combine_moments(rows, list(cfg.numeric))
    fitted["index_sizes"] = dict(zip(cfg.categorical, indexer.sizes))

    final = apply_fitted(full, cfg, fitted, indexer)
    stages.update({"imputed": imputed, "encoded": indexer.transform(binned), "kept": kept, "final": final})
    return Prepared(final, fitted, indexer, stages, base_path if own_copy else None, counts)


def training_table(prepared: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """The compact model input: features, label, class weight and ``row_key``, a hash of the ``keys`` that tell
    rows apart, on which the train/test split and the forest's bootstrap draws stand."""
    return prepared.select("features", label, "class_weight", row_key(*keys).alias("row_key"))


def prepare_job(df: DataFrame, cfg: PrepConfig, out_dir: str) -> Prepared:
    """Run ``prepare`` and write the full table and the training table as sibling folders
    (``clean`` and ``train``; not nested, so overwriting one never deletes the other)."""
    p = prepare(df, cfg)
    write_parquet(p.frame, f"{out_dir}/clean")
    write_parquet(training_table(read_parquet(df.sparkSession, f"{out_dir}/clean"), cfg.label, cfg.dedup_keys), f"{out_dir}/train")
    p.release()  # both outputs are written; the scratch copy is no longer read
    return p
