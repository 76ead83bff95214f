"""Model persistence: Spark ML writers/readers, overwrite by default."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel


def save_model(model, path: str, overwrite: bool = True) -> str:
    w = model.write()
    if overwrite:
        w = w.overwrite()
    w.save(path)
    return path


def load_forest(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
