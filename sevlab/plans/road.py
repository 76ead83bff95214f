"""The road-casualty jobs with the original column names (``config.ROAD_CASUALTY``).

    python -m sevlab.plans.road integrate --slice CASUALTY.csv COLLISION.csv [--slice ...] --out DIR
    python -m sevlab.plans.road prepare   --input DIR --out DIR [--variant drop|flag]
    python -m sevlab.plans.road correlate --input DIR --out DIR
    python -m sevlab.plans.road profile   --input DIR --out DIR
    python -m sevlab.plans.road train     --input DIR/train --model DIR [--full]
    python -m sevlab.plans.road score     --model DIR --input DIR --out DIR

All paths should be on storage every executor sees (the shared folder of the cluster).
"""

from __future__ import annotations

import argparse
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import hour_of, parse_date
from ..operators.clean import cast_by_rule
from ..sources.files import read_csv, read_parquet, write_parquet
from .correlate import correlate
from .integrate import integrate, type_table
from .prepare import Prepared, prepare, prepare_job
from .profile import profile
from .train import Trained, score_job, train_and_evaluate


def casualty_typing(on_error: str = "fail") -> dict:
    spec = {c: "int" for c in C.CASUALTY_COLUMNS}
    spec["collision_index"] = None
    return spec


def collision_typing(on_error: str = "fail") -> dict:
    spec: dict = {c: "int" for c in C.COLLISION_COLUMNS}
    spec["collision_index"] = None
    spec["date"] = parse_date("date", C.DATE_FORMAT, on_error)
    spec["time"] = hour_of("time", C.TIME_SEPARATOR, on_error)
    return spec


def typed_casualty(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    return type_table(raw, C.CASUALTY_COLUMNS, casualty_typing(on_error), on_error)


def typed_collision(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    return type_table(raw, C.COLLISION_COLUMNS, collision_typing(on_error), on_error)


def integrate_csv(spark: SparkSession, slices: Sequence[tuple[str, str]], on_error: str = "fail",
                  salt_share: float | None = None) -> DataFrame:
    """Each (casualty CSV, collision CSV) pair typed and joined on collision_index; all pairs
    unioned by name (the archive file and the provisional year, for instance).
    ``salt_share``: salt collisions holding at least that share of casualty rows (use when
    the session runs without AQE skew-join splitting)."""
    pairs = [(typed_casualty(read_csv(spark, c), on_error), typed_collision(read_csv(spark, k), on_error))
             for c, k in slices]
    return integrate(pairs, "collision_index", salt_share=salt_share)


def full_casualty(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    """Every casualty column typed by rule: named strings, named doubles, the rest int."""
    return cast_by_rule(raw, C.CASUALTY_STRING_COLUMNS, C.CASUALTY_DOUBLE_COLUMNS, "int", on_error)


def config(variant: str = "drop", quantile_error: float = C.QUANTILE_RELATIVE_ERROR):
    from dataclasses import replace
    return replace(C.ROAD_CASUALTY, variant=variant, quantile_error=quantile_error)


def prepare_road(df: DataFrame, variant: str = "drop") -> Prepared:
    return prepare(df, config(variant))


def correlate_road(df: DataFrame) -> DataFrame:
    return correlate(df, C.CORRELATION_COLUMNS, C.SEVERITY_SWAP, C.SWAPPED_COLUMNS)


def profile_road(df: DataFrame) -> dict[str, DataFrame]:
    return profile(df, C.ROAD_CASUALTY.sentinels, C.LABEL, "age_of_casualty", C.HISTOGRAM_BINS)


def train_road(table: DataFrame, model_path: str | None = None, full: bool = False) -> Trained:
    """The training script's forest (50 trees, depth 12, sqrt-smoothed class weight), or with
    ``full`` the saved full model's settings (100 trees, depth 15, the class weight itself)."""
    params = C.FOREST_PARAMS_FULL if full else C.FOREST_PARAMS
    return train_and_evaluate(table, C.LABEL, C.TRAIN_FRACTIONS, params, C.SEED, labels=[1, 2, 3],
                              weight="class_weight", model_path=model_path, smooth=not full)


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.job == "integrate":
        write_parquet(integrate_csv(spark, a.slice, a.on_error, a.salt_share), a.out)
    elif a.job == "prepare":
        prepare_job(read_parquet(spark, a.input, recursive=True), config(a.variant), a.out)
    elif a.job == "correlate":
        write_parquet(correlate_road(read_parquet(spark, a.input, recursive=True)), a.out)
    elif a.job == "profile":
        for name, df in profile_road(read_parquet(spark, a.input, recursive=True)).items():
            write_parquet(df, f"{a.out}/{name}")
    elif a.job == "train":
        t = train_road(read_parquet(spark, a.input, recursive=True), a.model, a.full)
        write_parquet(t.metrics, f"{a.model}-metrics")
        write_parquet(t.confusion, f"{a.model}-confusion")
    elif a.job == "score":
        rows = read_parquet(spark, a.input, recursive=True)
        write_parquet(score_job(a.model, rows).drop("rawPrediction", "probability").withColumn(
            "prediction", F.col("prediction").cast("int")), a.out)


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="sevlab.plans.road")
    ap.add_argument("job", choices=["integrate", "prepare", "correlate", "profile", "train", "score"])
    ap.add_argument("--slice", nargs=2, action="append", metavar=("CASUALTY", "COLLISION"))
    ap.add_argument("--input")
    ap.add_argument("--out")
    ap.add_argument("--model")
    ap.add_argument("--variant", default="drop", choices=["drop", "flag"])
    ap.add_argument("--full", action="store_true")
    ap.add_argument("--on-error", default="fail", choices=["fail", "null"])
    ap.add_argument("--salt-share", type=float, default=None,
                    help="salt join keys holding at least this share of rows (sessions without AQE)")
    return ap.parse_args(argv)


def _main(argv: Sequence[str] | None = None) -> None:
    a = parse_args(argv)
    spark = SparkSession.builder.appName(f"sevlab-{a.job}").getOrCreate()
    try:
        run(spark, a)
    finally:
        spark.stop()


if __name__ == "__main__":
    _main()
