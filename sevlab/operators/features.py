"""Features: frequency indexes, vector assembly, z-score, fit/transform pipelines (Spark ML)."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def string_indexer(cols: Sequence[str], suffix: str = "_idx", handle_invalid: str = "keep") -> StringIndexer:
    """One multi-column indexer: all columns are counted in a single pass (not one job per
    column). Most frequent value -> 0.0, ties by string order; null/unseen -> number of labels."""
    return StringIndexer(
        inputCols=list(cols), outputCols=[f"{c}{suffix}" for c in cols],
        handleInvalid=handle_invalid, stringOrderType="frequencyDesc",
    )


def string_index(df: DataFrame, cols: Sequence[str], suffix: str = "_idx") -> tuple[DataFrame, PipelineModel]:
    model = Pipeline(stages=[string_indexer(cols, suffix)]).fit(df)
    return model.transform(df), model


def assembler(cols: Sequence[str], out: str, handle_invalid: str = "keep") -> VectorAssembler:
    """``keep``: null becomes NaN in the vector; ``error``: a null fails the job."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


def assemble(df: DataFrame, cols: Sequence[str], out: str, handle_invalid: str = "keep") -> DataFrame:
    return assembler(cols, out, handle_invalid).transform(df)


def zscore_scaler(in_col: str, out: str) -> StandardScaler:
    """Centre and divide by the sample standard deviation."""
    return StandardScaler(inputCol=in_col, outputCol=out, withMean=True, withStd=True)


def zscore(df: DataFrame, cols: Sequence[str], vec: str, out: str) -> tuple[DataFrame, PipelineModel]:
    """Assemble ``cols`` into ``vec`` and add its z-scored copy ``out`` (one fitting pass)."""
    model = Pipeline(stages=[assembler(cols, vec), zscore_scaler(vec, out)]).fit(df)
    return model.transform(df), model


def feature_pipeline(categorical: Sequence[str], numeric: Sequence[str], encoded: Sequence[str],
                     scaled_numeric: bool, features: str = "features") -> Pipeline:
    """Indexes -> numeric vector -> z-score -> final vector. Fitting makes two passes
    (index counts, then mean/std). ``scaled_numeric`` picks the scaled or the raw numeric part."""
    num_vec, num_scaled = "numeric_features_before_scaling", "numeric_features_scaled"
    head = [num_scaled] if scaled_numeric else list(numeric)
    return Pipeline(stages=[
        string_indexer(categorical),
        assembler(numeric, num_vec),
        zscore_scaler(num_vec, num_scaled),
        assembler(head + list(encoded), features),
    ])


def vector_columns(df: DataFrame, vec: str, names: Sequence[str]) -> DataFrame:
    """Replace a vector column by one double column per slot."""
    arr = vector_to_array(F.col(vec))
    return df.select(*[c for c in df.columns if c != vec], *[arr[i].alias(n) for i, n in enumerate(names)])
