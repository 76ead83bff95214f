"""Score arriving rows with what a batch run learnt.

After fitting, every preparation step is stateless (sentinels, required columns, fills,
bins, index lookups, outlier rule, weights, scaling and assembly are projections and filters
with literals), so the same functions apply to a streaming DataFrame in append mode.
Deduplication is the one stateful step: with an event-time column it runs as
``dropDuplicatesWithinWatermark`` on the dedup keys, so the state holds only keys seen within
the watermark delay (bounded), not every key ever seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PrepConfig
from ..operators.categories import CategoryIndex
from ..operators.clean import drop_nulls, sentinels_to_null
from ..plans.prepare import apply_fitted


def prepare_stream(rows: DataFrame, cfg: PrepConfig, fitted: dict, indexer: CategoryIndex,
                   event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """``event_time``: a date/timestamp column; rows repeating the dedup keys within ``delay``
    of event time are dropped (the first arrival is kept)."""
    d = drop_nulls(sentinels_to_null(rows, cfg.sentinels), cfg.required)
    if event_time:
        cols = d.columns
        d = (d.withColumn("_event_ts", F.col(event_time).cast("timestamp"))
             .withWatermark("_event_ts", delay)
             .dropDuplicatesWithinWatermark(list(cfg.dedup_keys))
             .select(*cols))
    return apply_fitted(d, cfg, fitted, indexer)


def score_stream(rows: DataFrame, cfg: PrepConfig, fitted: dict, indexer: CategoryIndex, forest,
                 event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Prepared rows plus ``prediction`` and ``probability`` from a fitted forest."""
    return forest.transform(prepare_stream(rows, cfg, fitted, indexer, event_time, delay))
