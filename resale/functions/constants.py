"""Fixed values.

Everything in this module is a fixed value that has to equal what the pricing
workflow uses for results to agree: rule lists, tier lists, value lists,
segment bounds, targets and gate limits.  They are stated plainly, in their
natural order, and are used as data by the operators.
"""

from __future__ import annotations

# --- fixed values: vehicle series rules (first match wins, in this order) ---
# Each rule is (label, needles); a key matches when its upper-cased text
# contains any needle.
SERIES_RULES: list[tuple[str, list[str]]] = [
    ("X1", ["X1"]),
    ("X2", ["X2"]),
    ("X3", ["X3"]),
    ("X4", ["X4"]),
    ("X5", ["X5"]),
    ("X6", ["X6"]),
    ("X7", ["X7"]),
    ("1_series", ["114", "116", "118", "120", "125", "128", "130", "135", "140"]),
    ("2_series", ["214", "216", "218", "220", "225", "228", "230", "235", "240"]),
    ("3_series", ["316", "318", "320", "325", "328", "330", "335", "340"]),
    ("4_series", ["418", "420", "425", "428", "430", "435", "440"]),
    ("5_series", ["518", "520", "523", "525", "528", "530", "535", "540", "550"]),
    ("6_series", ["620", "630", "640", "650"]),
    ("7_series", ["730", "735", "740", "745", "750", "760"]),
    ("8_series", ["8"]),
    ("M_series", ["M2", "M3", "M4", "M5"]),
    ("i_series", ["I3", "I8"]),
    ("Z4", ["Z4"]),
]
SERIES_DEFAULT = "other_series"
SERIES_LABELS: list[str] = [label for label, _ in SERIES_RULES] + [SERIES_DEFAULT]

# --- fixed values: luxury tier per series; unknown series -> 2 ---
LUXURY_TIERS: dict[int, list[str]] = {
    1: ["1_series", "2_series", "X1", "X2"],
    2: ["3_series", "4_series", "X3", "other_series"],
    3: ["5_series", "X4", "X5", "i_series", "Z4"],
    4: ["6_series", "7_series", "8_series", "X6", "X7", "M_series"],
}
LUXURY_DEFAULT = 2

# --- fixed values: calendar flags ---
SUMMER_MONTHS = [6, 7, 8]
YEAR_END_MONTHS = [11, 12]
DAYS_PER_YEAR = 365.25

# --- fixed values: feature thresholds ---
HIGH_ANNUAL_MILEAGE = 25000
OLD_CAR_YEARS = 8
INTERACTION_SCALE = 10000

# --- fixed values: split shares (per cent of the hash bucket) ---
TRAIN_SHARE = 60
VAL_SHARE = 20
TEST_SHARE = 20
EDA_TRAIN_SHARE = 80
INNER_VAL_SHARE = 20  # validation = last 20 % of the train rows
CV_FOLDS = 3

# --- fixed values: parameter quantiles ---
MILEAGE_CAP_Q = 0.99
PRICE_FLOOR_Q = 0.01
PRICE_CAP_Q = 0.99

# --- fixed values: categorical columns encoded by target mean ---
# (encoding name, listing column)
TARGET_ENCODED = [("fuel", "fuel"), ("color", "paint_color"), ("car_type", "car_type")]

# --- fixed values: business metrics ---
TAIL_APE = 5.0
BUSINESS_TARGETS = [
    # (metric, limit, comparison) -- strict comparisons
    ("mae", 2500.0, "<"),
    ("rmse", 3000.0, "<"),
    ("r2", 0.85, ">"),
    ("mape", 4.5, "<"),
    ("tail_rate", 15.0, "<"),
    ("tc_ape", 6.5, "<"),
]

# --- fixed values: deployment gate (inclusive comparisons) ---
# (metric, limit, higher_is_better)
GATE_THRESHOLDS = [
    ("mae", 2500.0, False),
    ("rmse", 3000.0, False),
    ("r2", 0.70, True),
    ("mape", 30.0, False),
    ("tail_rate", 80.0, False),
]

# --- fixed values: price segments, right-closed, with MAE targets ---
# (order, label, lower exclusive, upper inclusive or None, mae target)
PRICE_SEGMENTS = [
    (1, "Economy (<€20K)", 0.0, 20000.0, 1500.0),
    (2, "Mid-Range (€20-35K)", 20000.0, 35000.0, 2500.0),
    (3, "Premium (€35-50K)", 35000.0, 50000.0, 3000.0),
    (4, "Luxury (>€50K)", 50000.0, None, 4000.0),
]

# --- fixed values: mispricing cost ---
UNDER_PRICED_RATIO = 0.95  # predicted below 95 % of actual
OVER_PRICED_RATIO = 1.05  # predicted above 105 % of actual
UNDER_PRICED_COST = 2000.0  # euro per under-priced car
OVER_PRICED_DAYS = 18
OVER_PRICED_COST_PER_DAY = 50.0  # 18 days x 50 = 900 euro per car

# --- fixed values: interval ---
INTERVAL_Z = 1.96
INTERVAL_RMSE_DEFAULT = 2875.0

# --- fixed values: data-quality checks ---
MIN_ROWS = 1000
PRICE_RANGE = (5000.0, 100000.0)
MILEAGE_RANGE = (0.0, 300000.0)
MISSING_CRITICAL_PCT = 20.0
MISSING_WARNING_PCT = 5.0
ZERO_MILEAGE_WARN_PCT = 10.0
OLDEST_YEAR = 1990
RARE_SHARE_PCT = 5.0
TOP_MODEL_KEYS = 15
KNOWN_CODES = ["318", "320", "325", "330", "520", "530", "X3", "X5", "X1"]
EXPECTED_RAW_COLUMNS = [
    "model_key", "mileage", "engine_power", "registration_date", "fuel", "paint_color", "car_type", "price",
    "feature_1", "feature_2", "feature_3", "feature_4", "feature_5", "feature_6", "feature_7", "feature_8",
]
LEAKY_COLUMNS = ["depreciation_rate", "price_per_km", "price_segment"]
LEAKAGE_CORR_BOUND = 0.95

# --- fixed values: request validation lists ---
VALID_FUELS = ["diesel", "petrol", "hybrid_petrol", "electro"]
VALID_CAR_TYPES = ["sedan", "suv", "coupe", "convertible", "estate", "hatchback", "van", "subcompact"]

# --- fixed values: EDA ---
HIST_BINS = 50
SHAPE_RIGHT = 1.15
SHAPE_LEFT = 0.85
IQR_K = 1.5
OUTLIER_LOW_PCT = 5.0
OUTLIER_MID_PCT = 10.0
STRONG_CORR = 0.3
HIGH_PAIR_CORR = 0.9
EXTREME_ROWS = 5
ANOVA_STRONG_P = 0.001
ANOVA_WEAK_P = 0.05

# --- fixed values: residual analysis ---
PROBLEM_TAIL_PCT = 50.0
HETERO_CORR = 0.3
WORST_ROWS = 100

# --- fixed values: tuning ---
OVERFIT_GAP_OK = 500.0
# Centres of the sums of squares that batches write (any value near the data will do).
SUM_CENTER_EURO, SUM_CENTER_LOG = 20_000.0, 10.0
PATIENCE = 5
MIN_IMPROVEMENT = 10.0
GROW_TREES, GROW_STEP = 500, 10
EARLY_STOP_ROUNDS = 20
SEARCH_DRAWS = 30
FOREST_PARAMS = dict(
    numTrees=80, maxDepth=15, minInstancesPerNode=20, featureSubsetStrategy="sqrt", bootstrap=False, seed=42
)
# gamma 0.2 of the reference is a loss reduction summed over a node's rows; MLlib's minInfoGain is a
# per-row impurity gain, so the equivalent threshold is ~0 (0.2 would forbid every split).
BOOST_PARAMS = dict(maxIter=300, maxDepth=4, stepSize=0.05, subsamplingRate=0.9, featureSubsetStrategy="0.6", minInfoGain=0.0)
REG_GRID_DEPTHS = [5, 10, 15, 20]
REG_GRID_LEAVES = [1, 20, 50, 100]

# --- fixed values: model comparison weights ---
VOTE_WEIGHTS = [("mae", 2, False), ("r2", 2, True), ("tail_rate", 3, False), ("mape", 1, False)]

# --- fixed values: drift monitoring ---
MILEAGE_SHIFT = 0.30
PRICE_SHIFT = 0.20
PREDICTION_SHIFT = 0.20
KL_OK = 0.2
KL_RETRAIN = 0.3
UNKNOWN_KEY_ALERT = 10.0
KL_EPS = 1e-6
WEEKLY_SHIFT_WARN = 10.0
WEEKLY_SHIFT_ALERT = 20.0
MODEL_AGE_DAYS = 90
MAE_DEGRADE = 0.15
NEW_DATA_SHARE = 0.10
SAFE_ZONE_DROP = 5.0

# --- fixed values: health tiers (healthy / attention / immediate) ---
HEALTH_MAE = (2500.0, 3000.0)
HEALTH_SAFE_ZONE = (75.0, 70.0)
HEALTH_SEGMENT_OVER = (10.0, 20.0)
HEALTH_KL = (0.2, 0.3)

# --- fixed values: model keys of the listing fixture (index = part key % 27) ---
LISTING_MODEL_KEYS = [
    "116", "118", "120", "218", "225", "316", "318", "320", "420 Gran", "520", "525", "530", "640", "730",
    "X1", "X2", "X3", "X4", "X5", "X6", "X7", "M3", "i8", "Z4", "850", "i3", "unknown",
]

# Model ids of the three baseline predictors.
BASELINE_MODELS = ["baseline_global", "baseline_series", "baseline_series_fuel"]
DEFAULT_MODEL = "baseline_series_fuel"

# --- fixed values: synthetic request generator (value ranges of the load test) ---
GEN_MODEL_KEYS = ["320d", "530i", "X5", "M3"]
GEN_MILEAGE = (5000, 200000)
GEN_POWERS = [184, 252, 306, 340]
GEN_REG_YEARS = (2010, 2020)
GEN_SOLD_YEARS = (2015, 2023)
GEN_FUELS = ["diesel", "petrol"]
GEN_COLORS = ["black", "white", "blue", "grey"]
GEN_CAR_TYPES = ["sedan", "suv", "coupe"]

# --- fixed values: validation lists of the listing fixture (lower-cased) ---
FIXTURE_FUELS = ["economy", "large", "medium", "promo", "small", "standard"]
FIXTURE_CAR_TYPES = ["1-urgent", "2-high", "3-medium", "4-not specified", "5-low"]

# --- fixed values: corrupted-row removal ---
MAX_CORRUPT_SHARE_PCT = 5.0
GOLDEN_ROWS_PER_QUARTILE = 25

# --- fixed values: columns of the models, in their order, and those that are text ---
MODEL_FEATURES = [
    "maker_key", "model_key", "mileage", "engine_power", "registration_date", "fuel", "paint_color", "car_type",
    *[f"feature_{k}" for k in range(1, 9)],
    "sold_at", "series", "luxury_tier", "is_luxury", "is_performance", "registration_year", "registration_month",
    "registration_quarter", "is_summer_registration", "is_year_end_registration", "car_age_years",
    "age_mileage_interaction", "mileage_per_power", "annual_mileage", "power_age_ratio",
    "luxury_mileage_interaction", "luxury_age_interaction", "is_high_mileage", "is_old_car",
    "fuel_encoded", "color_encoded", "car_type_encoded",
]
STRING_FEATURES = ["maker_key", "model_key", "registration_date", "fuel", "paint_color", "car_type", "sold_at", "series"]
