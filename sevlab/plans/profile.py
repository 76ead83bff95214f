"""Profile job: missing values, class balance, age distribution per severity — the numbers
behind the exploratory charts, computed on all rows."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame

from ..operators.clean import sentinels_to_null
from .prepare import cut_lineage
from ..operators.stats import box_stats, class_share, histogram_long, missing_report, missing_total


def profile(df: DataFrame, sentinels: Mapping, label: str, box_col: str,
            hist_bins: Mapping[str, int]) -> dict[str, DataFrame]:
    wanted = sentinels_to_null(df, sentinels)
    d = cut_lineage(wanted, "profile")  # read by every part below
    out = {
        "missing_report": missing_report(d),
        "missing_total": missing_total(d),
        "class_share": class_share(d, label),
        "box_stats": box_stats(d, label, box_col),
    }
    out["histograms"] = histogram_long(d, label, hist_bins)  # all columns, one aggregation
    return out


def profile_long(parts: dict[str, DataFrame], label: str) -> DataFrame:
    """All profile outputs as one long table (section, <label>, name, value)."""
    from functools import reduce

    from pyspark.sql import functions as F

    lt = dict(parts["class_share"].dtypes)[label]
    out = [parts["missing_report"].select(F.lit("missing").alias("section"), F.lit(None).cast(lt).alias(label),
                                          F.col("feature").alias("name"), F.col("missing").cast("double").alias("value"))]
    for name in ("count", "percent"):
        out.append(parts["class_share"].select(F.lit("class_share").alias("section"), label, F.lit(name).alias("name"),
                                               F.col(name).cast("double").alias("value")))
    box_stats_cols = [c for c in parts["box_stats"].columns if c != label]
    for c in box_stats_cols:
        out.append(parts["box_stats"].select(F.lit("box").alias("section"), label, F.lit(c).alias("name"),
                                             F.col(c).cast("double").alias("value")))
    if "histograms" in parts:
        out.append(parts["histograms"].select(F.concat(F.lit("histogram_"), F.col("column_name")).alias("section"), label,
                                              F.concat(F.lit("bin_"), F.col("bin").cast("string")).alias("name"),
                                              F.col("count").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, out)
