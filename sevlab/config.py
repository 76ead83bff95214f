"""Column roles and parameters of a preparation run.

``PrepConfig`` names every column an operator touches, so no operator knows a fixed dataset.
``ROAD_CASUALTY`` is the preset for the road-casualty data the pipeline was written for;
``plans.testbed.TESTBED`` binds the same roles to the TPC-H-like test tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

# --------------------------------------------------------------------------------------
# These must equal the original pipeline's for the same results.
# Listed in the order the original scripts use them.
# --------------------------------------------------------------------------------------

# Casualty CSV: columns kept, then their typing (key string, the rest int).
CASUALTY_COLUMNS = [
    "collision_index",
    "casualty_class",
    "sex_of_casualty",
    "age_of_casualty",
    "casualty_severity",
    "casualty_type",
]

# Collision CSV: columns kept. `date` is parsed with DATE_FORMAT, `time` becomes the hour.
COLLISION_COLUMNS = [
    "collision_index",
    "collision_severity",
    "date",
    "day_of_week",
    "time",
    "road_type",
    "speed_limit",
    "light_conditions",
    "weather_conditions",
    "road_surface_conditions",
    "urban_or_rural_area",
]

DATE_FORMAT = "dd/MM/yyyy"
TIME_SEPARATOR = ":"

# Full casualty typing rule: these stay strings, these become doubles, all others int.
CASUALTY_STRING_COLUMNS = ["collision_index", "collision_year", "collision_ref_no", "lsoa_of_casualty"]
CASUALTY_DOUBLE_COLUMNS = ["casualty_adjusted_severity_serious", "casualty_adjusted_severity_slight"]

# Sentinel codes that mean "missing": -1 in these columns, and also 9 for sex.
SENTINEL_COLUMNS = [
    "road_type",
    "casualty_class",
    "sex_of_casualty",
    "age_of_casualty",
    "speed_limit",
    "light_conditions",
    "weather_conditions",
    "road_surface_conditions",
    "urban_or_rural_area",
]
MISSING_CODE = -1
SEX_MISSING_CODES = (-1, 9)

# Rows missing any of these are dropped.
REQUIRED_COLUMNS = ["casualty_class", "date", "time", "road_type"]

# One row is kept per value of these columns.
DEDUP_KEYS = ["collision_index", "casualty_class", "age_of_casualty", "sex_of_casualty"]

# Median imputation (approximate quantile, relative error 0.01), then mode imputation,
# then a constant for urban_or_rural_area (3 = unallocated).
MEDIAN_COLUMNS = ["speed_limit", "age_of_casualty"]
QUANTILE_RELATIVE_ERROR = 0.01
MODE_COLUMNS = ["sex_of_casualty", "light_conditions", "weather_conditions", "road_surface_conditions"]
CONSTANT_FILL = {"urban_or_rural_area": 3}

# Hour bins: [5, 11) = 1 morning, [11, 14) = 2 noon, [14, 18) = 3 afternoon, else 4 night.
TIME_BINS = [(5, 11, 1), (11, 14, 2), (14, 18, 3)]
TIME_BIN_OTHER = 4

# Columns indexed by frequency (most frequent value -> 0.0), invalid kept as an extra index.
CATEGORICAL_COLUMNS = [
    "road_type",
    "casualty_class",
    "sex_of_casualty",
    "light_conditions",
    "weather_conditions",
    "road_surface_conditions",
    "casualty_type",
    "urban_or_rural_area",
    "time_bin",
]

LABEL = "casualty_severity"

# Feature order: numeric first, then these index columns and the raw day of week.
NUMERIC_FEATURES = ["age_of_casualty", "speed_limit"]
ENCODED_FEATURES = [
    "road_type_idx",
    "casualty_class_idx",
    "sex_of_casualty_idx",
    "light_conditions_idx",
    "weather_conditions_idx",
    "road_surface_conditions_idx",
    "urban_or_rural_area_idx",
    "time_bin_idx",
    "casualty_type_idx",
    "day_of_week",
]

# Outliers: IQR fence factor; plausibility bounds of the keep-and-flag variant.
OUTLIER_COLUMNS = ["age_of_casualty", "speed_limit"]
IQR_FACTOR = 1.5
DOMAIN_BOUNDS = {"age_of_casualty": (0, 120), "speed_limit": (0, 200)}

# Sampling: 0.8 of every class for training, 0.1 for the charts' sample, seed 42.
TRAIN_FRACTIONS = {1: 0.8, 2: 0.8, 3: 0.8}
CHART_FRACTIONS = {1: 0.1, 2: 0.1, 3: 0.1}
SEED = 42

# Correlation input: label first, then the other integer columns.
CORRELATION_COLUMNS = [
    "casualty_severity",
    "casualty_class", "sex_of_casualty", "age_of_casualty",
    "casualty_type", "collision_severity", "day_of_week",
    "time", "road_type", "speed_limit", "light_conditions",
    "weather_conditions", "road_surface_conditions", "urban_or_rural_area",
]
# Severity codes are flipped (1 <-> 3) before correlating, so that higher means worse.
SEVERITY_SWAP = {1: 3, 3: 1}
SWAPPED_COLUMNS = ["casualty_severity", "collision_severity"]

# Random forest of the training script (weights: sqrt of class_weight), and of the saved
# "full" model (weights: class_weight itself).
FOREST_PARAMS = {"numTrees": 50, "maxDepth": 12, "maxBins": 64, "seed": 42}
FOREST_PARAMS_FULL = {"numTrees": 100, "maxDepth": 15, "maxBins": 64, "seed": 42}

# Histogram bins of the profile charts.
HISTOGRAM_BINS = {"age_of_casualty": 30, "speed_limit": 15}

# --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PrepConfig:
    """Column roles of one preparation run.

    variant "drop": rows outside the IQR fences are dropped, features use scaled numerics.
    variant "flag": outliers are flagged and kept, only implausible values are dropped,
                    features use raw numerics (the scaled vector is kept as a side column).
    """

    key: str
    label: str
    sentinels: Mapping[str, Sequence[Any]]
    required: Sequence[str]
    dedup_keys: Sequence[str]
    median_columns: Sequence[str]
    mode_columns: Sequence[str]
    constant_fill: Mapping[str, Any]
    time_column: str | None
    categorical: Sequence[str]
    numeric: Sequence[str]
    extra_features: Sequence[str] = ()
    outlier_columns: Sequence[str] = ()
    domain_bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    train_fractions: Mapping[Any, float] = field(default_factory=dict)
    variant: str = "drop"
    quantile_error: float = QUANTILE_RELATIVE_ERROR
    iqr_factor: float = IQR_FACTOR
    seed: int = SEED
    dedup_order: Sequence[str] | None = None  # deterministic survivor; None = any row (as Spark's dropDuplicates)
    time_bin_column: str = "time_bin"
    encoded_order: Sequence[str] = ()  # explicit order of encoded features; default: indexes then extras
    fit_on: str = "all"  # "all" as the original (fits see every row), or "train": fits see the train split only

    def __post_init__(self) -> None:
        if self.variant not in ("drop", "flag"):
            raise ValueError(f"variant must be 'drop' or 'flag', got {self.variant!r}")
        if self.fit_on not in ("all", "train"):
            raise ValueError(f"fit_on must be 'all' or 'train', got {self.fit_on!r}")
        if not 0.0 <= self.quantile_error < 1.0:
            raise ValueError("quantile_error must be in [0, 1)")
        if self.label in self.numeric or self.label in self.categorical or self.label in self.extra_features:
            raise ValueError(f"label {self.label!r} must not be a feature")

    @property
    def indexed(self) -> list[str]:
        return [f"{c}_idx" for c in self.categorical]

    @property
    def encoded_features(self) -> list[str]:
        if self.encoded_order:
            return list(self.encoded_order)
        return self.indexed + list(self.extra_features)

    def feature_columns(self) -> list[str]:
        """Numeric then encoded feature names; the label is never among them."""
        return [c for c in list(self.numeric) + self.encoded_features if c != self.label]


def _road_casualty_sentinels() -> dict[str, tuple[int, ...]]:
    s = {c: (MISSING_CODE,) for c in SENTINEL_COLUMNS}
    s["sex_of_casualty"] = SEX_MISSING_CODES
    return s


ROAD_CASUALTY = PrepConfig(
    key="collision_index",
    label=LABEL,
    sentinels=_road_casualty_sentinels(),
    required=REQUIRED_COLUMNS,
    dedup_keys=DEDUP_KEYS,
    median_columns=MEDIAN_COLUMNS,
    mode_columns=MODE_COLUMNS,
    constant_fill=CONSTANT_FILL,
    time_column="time",
    categorical=CATEGORICAL_COLUMNS,
    numeric=NUMERIC_FEATURES,
    extra_features=["day_of_week"],
    encoded_order=ENCODED_FEATURES,
    outlier_columns=OUTLIER_COLUMNS,
    domain_bounds=DOMAIN_BOUNDS,
    train_fractions=TRAIN_FRACTIONS,
)
