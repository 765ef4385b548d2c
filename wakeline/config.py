"""Fixed values that must equal the behaviour being reproduced.

Fixed values (stated in natural order, do not reorder):
- vessel classes kept by the ingest filter: Cargo, Tanker, Fishing, Tug, Passenger
- navigational statuses counted as ratios: "Engaged in fishing", "At anchor",
  "Under way using engine", "Moored"
- cargo categories counted as ratios: "Category X", "Category Y", "Category Z",
  "Category OS", "Reserved for future use"
- raw CSV null tokens: "", "NA", "null", "NULL"
- raw timestamp format: day-first ``dd/MM/yyyy HH:mm:ss``
- random seed 42; minimum pings per vessel-week 100
- PSI cut-offs 0.10 (stable) and 0.25 (significant); PSI epsilon 1e-6; 10 bins
- reserved class label ``__all__`` and feature label ``__predicted_class_balance__``
- the 29 model input features, in the order of the feature schema file
- the 22 features profiled by the statistics (box plots, ANOVA, Kruskal-Wallis)
"""

SHIP_TYPES = ["Cargo", "Tanker", "Fishing", "Tug", "Passenger"]

NAV_STATUS_RATIOS = {
    "fishing_ratio": "Engaged in fishing",
    "anchor_ratio": "At anchor",
    "underway_engine_ratio": "Under way using engine",
    "moored_ratio": "Moored",
}

CARGO_RATIOS = {
    "CargoX_ratio": "Category X",
    "CargoY_ratio": "Category Y",
    "CargoZ_ratio": "Category Z",
    "CargoOS_ratio": "Category OS",
    "CargoReserved_ratio": "Reserved for future use",
}

NULL_TOKENS = ["", "NA", "null", "NULL"]
RAW_TIMESTAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"

RANDOM_SEED = 42
MIN_PINGS_PER_WEEK = 100

PSI_STABLE = 0.10
PSI_MODERATE = 0.25
PSI_EPSILON = 1e-6
N_BINS = 10

NO_CLASS = "__all__"
PREDICTED_CLASS_KEY = "__predicted_class_balance__"

MODEL_FEATURES = [
    "length_beam_ratio",
    "draught_length_ratio",
    "width",
    "length",
    "min_draught",
    "max_draught",
    "lat_mean",
    "sog_p90",
    "CargoY_ratio",
    "lon_mean",
    "max_speed",
    "draught_variability",
    "sog_median",
    "fishing_ratio",
    "CargoZ_ratio",
    "anchor_ratio",
    "moored_ratio",
    "lon_std",
    "time_span_seconds",
    "rot_std",
    "frac_time_slow",
    "rot_mean_abs",
    "CargoOS_ratio",
    "n_pings",
    "cog_variability",
    "mean_ping_interval_seconds",
    "lat_std",
    "mean_moving_speed",
    "sog_p10",
]

ANALYSIS_FEATURES = [
    "mean_moving_speed",
    "sog_p10",
    "sog_median",
    "sog_p90",
    "frac_time_slow",
    "frac_time_fast",
    "rot_mean_abs",
    "rot_std",
    "heading_cog_diff_mean",
    "fishing_ratio",
    "anchor_ratio",
    "underway_engine_ratio",
    "moored_ratio",
    "length",
    "width",
    "max_draught",
    "draught_variability",
    "length_beam_ratio",
    "draught_length_ratio",
    "bbox_area",
    "n_pings",
    "mean_ping_interval_seconds",
]

# Random-forest settings: 200 trees, unlimited depth (Spark caps at 30),
# at least 2 rows per leaf, balanced class weights.
FOREST_TREES = 200
FOREST_MAX_DEPTH = 30
FOREST_MIN_LEAF = 2
