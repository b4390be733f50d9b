"""Parameters and fixed values.

Numbers and word lists below are fixed values: they must equal the surveyed
pipeline's values for the scores to come out the same.  Everything that
differs between its two generations is an argument with the default noted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Region box, grid, decay, kernel, scaler
# --------------------------------------------------------------------------
LAT_MIN, LAT_MAX = 41.60, 42.05          # hour-of-week generation box
LAT_MAX_MONTHLY = 42.1                    # monthly generation box (lat max)
LON_MIN, LON_MAX = -87.95, -87.50
GRID_DECIMALS = 2
GRID_STEP = 0.01
EARTH_RADIUS_KM = 6371.0088
HALF_LIFE_DAYS = 365.0
SIGMA_KM = 0.7
CUTOFF_KM = 3.0
CLIP_PERCENTILE = 0.99
SCORE_EXPONENT = 0.5

# Monthly generation
TEMPORAL_HALFLIFE_MONTHS = 3.0
TEMPORAL_WINDOW_MONTHS = 12
SPATIAL_BANDWIDTH_CELLS = 1.0
SPATIAL_RADIUS_CELLS = 2
CLIP_PCTL_MONTHLY = 99.5
TIER_EDGES_MONTHLY = [-0.01, 50.0, 80.0, 95.0, 100.01]
TIER_LABELS_MONTHLY = ["LOW", "MEDIUM", "HIGH", "VERY HIGH"]

# Serving levels (left-closed) and region
RISK_LEVEL_BOUNDS = [25.0, 50.0, 75.0]
RISK_LEVEL_LABELS = ["Low", "Medium", "High", "Very High"]
REGION_NAME = "Chicago, IL, USA"
REGION_TIMEZONE = "America/Chicago"
MODEL_VERSION = "v1"

# Evaluation and selection
RANDOM_STATE = 42
TEST_SIZE = 0.2
INNER_VAL_SIZE = 0.2
NIGHT_HOURS = (21, 22, 23, 0, 1, 2, 3)
SHRINKAGE_GRID = [0.0, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0]
TARGET_ENCODING_SMOOTHING_M = 10.0
MAE_TIE_MARGIN = 0.5
HOUR_GROUP_EDGES = [-1, 5, 11, 17, 23]
HOUR_GROUP_LABELS = ["00-05", "06-11", "12-17", "18-23"]
QUINTILE_LABELS = ["Q1 (lowest)", "Q2", "Q3", "Q4", "Q5 (highest)"]
LARGE_ERROR_THRESHOLDS = [5, 10, 20]

# drift
PSI_BINS = 10
PSI_THRESHOLD = 0.2
DEGRADE_TOL = 0.15
HOLDOUT_PERIODS = 6
DRIFT_EXCLUDE = ["year_idx", "glat", "glon", "gi", "gj"]

# --------------------------------------------------------------------------
# Crime classes
# --------------------------------------------------------------------------
VIOLENT_TYPES = [
    "HOMICIDE", "CRIMINAL SEXUAL ASSAULT", "CRIM SEXUAL ASSAULT",
    "ROBBERY", "BATTERY", "ASSAULT", "KIDNAPPING", "HUMAN TRAFFICKING",
]
VIOLENT_TYPES_MONTHLY = VIOLENT_TYPES + ["INTIMIDATION"]
PROPERTY_TYPES = [
    "THEFT", "BURGLARY", "MOTOR VEHICLE THEFT", "CRIMINAL DAMAGE", "ARSON",
    "CRIMINAL TRESPASS",
]

# --------------------------------------------------------------------------
# Layered severity (1-100 scale)
# Layer 1: (type, description) anchors; layer 2: base per type + keyword
# modifier; layer 3: global default.
# --------------------------------------------------------------------------
SEVERITY_ANCHOR = [
    ("HOMICIDE", "FIRST DEGREE MURDER", 100),
    ("HOMICIDE", "SECOND DEGREE MURDER", 92),
    ("CRIMINAL SEXUAL ASSAULT", "AGGRAVATED: HANDGUN", 95),
    ("CRIMINAL SEXUAL ASSAULT", "AGGRAVATED - HANDGUN", 95),
    ("CRIMINAL SEXUAL ASSAULT", "NON-AGGRAVATED", 88),
    ("BATTERY", "AGGRAVATED: HANDGUN", 85),
    ("BATTERY", "AGGRAVATED - HANDGUN", 85),
    ("ROBBERY", "ARMED: HANDGUN", 82),
    ("ROBBERY", "ARMED - HANDGUN", 82),
    ("KIDNAPPING", "KIDNAPPING", 80),
    ("ROBBERY", "AGGRAVATED", 78),
    ("ASSAULT", "AGGRAVATED: HANDGUN", 75),
    ("ASSAULT", "AGGRAVATED - HANDGUN", 75),
    ("ROBBERY", "ARMED: KNIFE / CUTTING INSTRUMENT", 74),
    ("WEAPONS VIOLATION", "UNLAWFUL USE HANDGUN", 72),
    ("ROBBERY", "STRONG ARM - NO WEAPON", 62),
    ("ROBBERY", "STRONGARM - NO WEAPON", 62),
    ("WEAPONS VIOLATION", "UNLAWFUL POSSESSION - HANDGUN", 60),
    ("WEAPONS VIOLATION", "UNLAWFUL POSS OF HANDGUN", 60),
    ("BATTERY", "DOMESTIC BATTERY SIMPLE", 55),
    ("BATTERY", "SIMPLE", 50),
    ("ASSAULT", "SIMPLE", 45),
    ("BURGLARY", "FORCIBLE ENTRY", 42),
    ("THEFT", "FROM PERSON", 38),
    ("BURGLARY", "UNLAWFUL ENTRY", 36),
    ("MOTOR VEHICLE THEFT", "AUTOMOBILE", 35),
    ("THEFT", "POCKET-PICKING", 33),
    ("THEFT", "OVER $500", 28),
    ("THEFT", "FROM BUILDING", 22),
    ("THEFT", "$500 AND UNDER", 20),
    ("THEFT", "RETAIL THEFT", 18),
    ("CRIMINAL DAMAGE", "TO PROPERTY", 15),
    ("DECEPTIVE PRACTICE", "FINANCIAL IDENTITY THEFT $300 AND UNDER", 15),
    ("DECEPTIVE PRACTICE", "CREDIT CARD FRAUD", 15),
    ("CRIMINAL DAMAGE", "TO VEHICLE", 12),
    ("CRIMINAL TRESPASS", "TO LAND", 6),
    ("CRIMINAL TRESPASS", "TO BUILDING", 6),
]

TYPE_BASE = [
    ("HOMICIDE", 95),
    ("HUMAN TRAFFICKING", 90),
    ("CRIMINAL SEXUAL ASSAULT", 88),
    ("KIDNAPPING", 78),
    ("ARSON", 70),
    ("ROBBERY", 65),
    ("OFFENSE INVOLVING CHILDREN", 65),
    ("SEX OFFENSE", 60),
    ("CRIMINAL SEXUAL ABUSE", 60),
    ("WEAPONS VIOLATION", 55),
    ("STALKING", 55),
    ("DOMESTIC VIOLENCE", 55),
    ("BATTERY", 50),
    ("INTIMIDATION", 50),
    ("ASSAULT", 45),
    ("RITUALISM", 40),
    ("BURGLARY", 38),
    ("MOTOR VEHICLE THEFT", 35),
    ("CONCEALED CARRY LICENSE VIOLATION", 35),
    ("NARCOTICS", 25),
    ("OTHER NARCOTIC VIOLATION", 25),
    ("THEFT", 22),
    ("DECEPTIVE PRACTICE", 15),
    ("OTHER OFFENSE", 15),
    ("CRIMINAL DAMAGE", 14),
    ("PROSTITUTION", 12),
    ("INTERFERENCE WITH PUBLIC OFFICER", 12),
    ("OBSCENITY", 10),
    ("PUBLIC INDECENCY", 10),
    ("CRIMINAL TRESPASS", 8),
    ("PUBLIC PEACE VIOLATION", 8),
    ("GAMBLING", 5),
    ("LIQUOR LAW VIOLATION", 5),
    ("NON-CRIMINAL", 2),
    ("NON - CRIMINAL", 2),
    ("NON-CRIMINAL (SUBJECT SPECIFIED)", 2),
]
GLOBAL_DEFAULT_SEVERITY = 25
WEAPON_IS_ESSENCE = ["WEAPONS VIOLATION", "CONCEALED CARRY LICENSE VIOLATION"]

# Keyword modifier (additive): weapon (one of), then stacking qualifiers.
GUN_WORDS = ["HANDGUN", "FIREARM", "GUN"]
BLADE_WORDS = ["KNIFE", "CUTTING", "DANGEROUS WEAPON", "ARMED"]
ADJ_GUN, ADJ_BLADE = 18, 10
ADJ_AGGRAVATED, ADJ_DOMESTIC, ADJ_CHILD, ADJ_ATTEMPT = 10, 5, 8, -8

# --------------------------------------------------------------------------
# Monthly generation, tier x modifier severity
# --------------------------------------------------------------------------
SEVERITY_TIERS = [
    (16, ["HOMICIDE", "CRIMINAL SEXUAL ASSAULT", "CRIM SEXUAL ASSAULT",
          "KIDNAPPING", "HUMAN TRAFFICKING"]),
    (8, ["ROBBERY", "ARSON", "WEAPONS VIOLATION", "OFFENSE INVOLVING CHILDREN",
         "CONCEALED CARRY LICENSE VIOLATION", "SEX OFFENSE",
         "CRIMINAL SEXUAL ABUSE"]),
    (4, ["BATTERY", "ASSAULT", "BURGLARY", "NARCOTICS", "INTIMIDATION",
         "STALKING", "PROSTITUTION", "OTHER NARCOTIC VIOLATION"]),
    (2, ["THEFT", "CRIMINAL DAMAGE", "CRIMINAL TRESPASS", "DECEPTIVE PRACTICE",
         "MOTOR VEHICLE THEFT", "PUBLIC PEACE VIOLATION",
         "INTERFERENCE WITH PUBLIC OFFICER", "LIQUOR LAW VIOLATION"]),
]
TIER_DEFAULT = 1.0
MULT_GUN_PATTERN = "HANDGUN|FIREARM|SHOTGUN|RIFLE|GUN|ARMED"
MULT_AGG_PATTERN = "AGGRAVATED"
MULT_WEAPON_PATTERN = "KNIFE|CUTTING|OTHER DANGEROUS WEAPON|WEAPON"
MULT_SIMPLE_PATTERN = "SIMPLE|PETTY|[$]500 AND UNDER"
MULT_GUN, MULT_AGG, MULT_WEAPON, MULT_SIMPLE = 1.8, 1.4, 1.3, 0.9
MULT_MIN, MULT_MAX = 0.8, 2.2

# --------------------------------------------------------------------------
# Place-name aliases
# --------------------------------------------------------------------------
PLACE_ALIASES = [
    ("POLICE FACILITY / VEH PARKING LOT", "POLICE FACILITY / VEHICLE PARKING LOT"),
    ("AIRPORT / AIRCRAFT", "AIRCRAFT"),
    ("RESIDENCE-GARAGE", "RESIDENCE - GARAGE"),
    ("RESIDENCE PORCH / HALLWAY", "RESIDENCE - PORCH / HALLWAY"),
    ("SCHOOL, PUBLIC, BUILDING", "SCHOOL - PUBLIC BUILDING"),
    ("SCHOOL, PUBLIC, GROUNDS", "SCHOOL - PUBLIC GROUNDS"),
    ("SCHOOL, PRIVATE, BUILDING", "SCHOOL - PRIVATE BUILDING"),
    ("SCHOOL, PRIVATE, GROUNDS", "SCHOOL - PRIVATE GROUNDS"),
]

# --------------------------------------------------------------------------
# Feature and drift column lists
# --------------------------------------------------------------------------
FEATURE_COLUMNS = [
    "lat_r", "lon_r",
    "hour", "dow", "is_weekend",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "crime_count", "violent_share", "arrest_rate",
    "cell_total_count", "neighbor_count_mean",
]
LABEL_INGREDIENT_COLUMNS = ["base_value", "risk_raw"]
TARGET_COLUMN = "risk_score"
AGGREGATE_COLUMNS = ["crime_count", "violent_share", "arrest_rate",
                     "cell_total_count", "neighbor_count_mean"]

LABEL_BASIS_MONTHLY = ["n_crimes", "n_violent", "n_property", "n_arrest",
                       "n_domestic", "n_types", "arrest_rate", "domestic_rate",
                       "share_night", "share_weekend"]
FEATURE_COLUMNS_MONTHLY = [
    "glat", "glon", "gi", "gj", "year_idx", "pmonth", "pquarter",
    "pmonth_sin", "pmonth_cos", "lag_1", "lag_3", "lag_12", "roll3_mean",
    "roll6_mean", "roll12_mean", "cell_hist_mean", "trend_3_12",
    "n_violent_lag1", "arrest_rate_lag1", "domestic_rate_lag1",
    "neighbor_lag1_mean", "share_night_lag1", "share_weekend_lag1",
]
RISK_LAG_COLUMNS = ["risk_lag_1", "risk_lag_3", "risk_lag_12"]
LEAK_COLUMNS_MONTHLY = ["harm", "harm_temporal", "harm_spatial", "risk_raw",
                        "risk_tier", "risk_score", "is_partial_period"]


@dataclass(frozen=True)
class Region:
    """Bounding box passed to the box predicates (inclusive)."""
    lat_min: float = LAT_MIN
    lat_max: float = LAT_MAX
    lon_min: float = LON_MIN
    lon_max: float = LON_MAX


HOURLY_REGION = Region()
MONTHLY_REGION = Region(lat_max=LAT_MAX_MONTHLY)


@dataclass(frozen=True)
class LabelParams:
    """Frozen label parameters of the hour-of-week generation."""
    half_life_days: float = HALF_LIFE_DAYS
    sigma_km: float = SIGMA_KM
    cutoff_km: float = CUTOFF_KM
    clip_percentile: float = CLIP_PERCENTILE
    score_exponent: float = SCORE_EXPONENT
    grid_decimals: int = GRID_DECIMALS
    feature_columns: list = field(default_factory=lambda: list(FEATURE_COLUMNS))

# Cases of the decay scenarios (name, age in days, distance in km)
# and the (half-life, sigma) combinations they are compared over
SCENARIOS = [
    ("yesterday_same_cell", 1.0, 0.0),
    ("two_years_same_cell", 730.0, 0.0),
    ("yesterday_next_cell", 1.0, 1.11),
    ("no_incident", None, None),
]
SCENARIO_GRID = [(180, 0.7), (180, 1.0), (365, 0.7), (365, 1.0), (730, 0.7), (730, 1.0)]
