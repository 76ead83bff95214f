"""Sources and sinks: CSV, parquet, models."""

from .files import head, read_csv, read_parquet, rows_to_frame, schema_report, write_csv, write_parquet  # noqa: F401
from .models import load_forest, load_pipeline, save_model  # noqa: F401
