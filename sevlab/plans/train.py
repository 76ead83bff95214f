"""Train-and-evaluate job and the scoring job."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.balance import smoothed_weight
from ..operators.forest import fit_forest_by_hash, row_key
from ..operators.model import evaluate, fit_forest, score
from ..operators.sampling import anti_join_split, bernoulli_split, hash_split, stratified_sample, with_row_id
from ..operators.stats import crosstab
from ..sources.models import load_forest, save_model


@dataclass
class Trained:
    model: Any
    predictions: DataFrame
    metrics: DataFrame
    confusion: DataFrame
    train: DataFrame
    test: DataFrame


#: Column of the training table that tells its rows apart: 60 bits of the md5 of the deduplication keys.
ROW_KEY = "row_key"


def _split_columns(table: DataFrame, label: str, weights: Sequence[str]) -> list[Column]:
    """What the split hashes when no columns are named: the row key, else all columns but label and weights."""
    if ROW_KEY in table.columns:
        return [F.col(ROW_KEY)]
    cols = [vector_to_array(F.col(c)).cast("string") if t == "vector" else F.col(c) for c, t in table.dtypes if c not in (label, *weights) and not t.startswith("struct")]
    if not cols:
        raise ValueError("a split needs columns that tell rows apart: the label and its weight put whole classes on one side")
    return cols


def split(table: DataFrame, label: str, fractions: Mapping, seed: int, method: str = "hash",
          hash_cols: Sequence[str] | None = None, weights: Sequence[str] = ("class_weight", "smoothed_weight")) -> tuple[DataFrame, DataFrame]:
    """``hash`` (default): md5 of ``hash_cols`` (unless given the row key, else every column but label and
    weights; rows alike in these share a side) — the same split on any layout, rerun or engine, as two
    complementary filters (no id, no join, no shuffle).
    ``anti_join``: ``sampleBy`` + anti join on a row id, literally as the training script
    (two shuffles of the table); ``bernoulli``: a draw per row. Both depend on the layout and need
    a plain scan of a written table."""
    if method == "hash":
        if hash_cols is not None and not set(hash_cols) - {label, *weights}:
            raise ValueError("a split over the label and its weight puts whole classes on one side")
        return hash_split(table, label, fractions, hash_cols or _split_columns(table, label, weights))
    if method == "bernoulli":
        return bernoulli_split(table, label, fractions, seed)
    t = with_row_id(table)
    train = stratified_sample(t, label, fractions, seed)
    test = anti_join_split(t, train, "id")
    return train.drop("id"), test.drop("id")


def train_and_evaluate(table: DataFrame, label: str, fractions: Mapping, params: Mapping, seed: int,
                       labels: Sequence, method: str = "hash", hash_cols: Sequence[str] | None = None,
                       weight: str = "class_weight", model_path: str | None = None, smooth: bool = True,
                       trainer: str = "row_hash") -> Trained:
    """``smooth``: train with sqrt(weight) (the training script) or with the weight itself.
    ``table`` should be the written training table. ``trainer``: ``row_hash`` grows trees that do not
    depend on the layout (``operators.forest``), keyed as the split is; ``spark_ml`` is Spark's own fit,
    which draws its bootstrap samples per partition."""
    t = smoothed_weight(table, weight, "smoothed_weight") if smooth else table.withColumn("smoothed_weight", table[weight])
    train, test = split(t, label, fractions, seed, method, hash_cols, (weight, "smoothed_weight"))
    model = fit(train, label, params, hash_cols, weight, trainer, model_path)
    pred = model.transform(test)
    metrics = evaluate(pred, label)
    confusion = crosstab(pred.withColumn("prediction", pred["prediction"].cast("int")), label, "prediction", labels)
    return Trained(model, pred, metrics, confusion, train, test)


def fit(train: DataFrame, label: str, params: Mapping, hash_cols: Sequence[str] | None = None, weight: str = "class_weight",
        trainer: str = "row_hash", model_path: str | None = None) -> Any:
    """The forest of the training rows (weighted by ``smoothed_weight``), saved at ``model_path``."""
    if trainer == "spark_ml":
        model = fit_forest(train, label, params, weight="smoothed_weight")
        if model_path:
            save_model(model, model_path)
        return model
    keyed = train
    if ROW_KEY not in train.columns or hash_cols:
        keyed = train.withColumn(ROW_KEY, row_key(*(hash_cols or _split_columns(train, label, (weight, "smoothed_weight")))))
    return fit_forest_by_hash(keyed, label, params, ROW_KEY, "smoothed_weight", path=model_path)


def score_job(model_path: str, rows: DataFrame) -> DataFrame:
    """Load a saved forest and score a table: prediction and one probability per class."""
    return score(load_forest(model_path), rows)
