"""Fixed values that must equal the reference's for the same results.

They are stated here as plain data in their natural order.  Operators take
them as parameters; these constants only serve users who run the reference's
own domain (and the unit tests built from its hand cases).
"""

# --- fixed values: season definitions (months) ---
MONSOON_MONTHS = (6, 7, 8, 9)
PREMONSOON_MONTHS = (4, 5)
RAINY_DAY_MM = 5.0            # strict ">" cut for a rainy day

# --- fixed values: dictionary encodings ---
TERRAIN_CODES = {"plains": 1, "coastal": 2, "hills": 3, "mountains": 4}
RISK_CODES = {"high": 3, "medium": 2, "low": 1}
PROVINCE_CODES = {"Punjab": 1, "Sindh": 2, "KPK": 3, "Balochistan": 4, "AJK": 5, "GB": 6}

# --- fixed values: intensity buckets, half-open [lo, hi) on the rounded score ---
INTENSITY_CUTS = (15.0, 50.0, 100.0, 250.0, 500.0)
INTENSITY_LABELS = ("very_low", "low", "moderate", "high", "very_high", "extreme")
INTENSITY_CODES = {"very_low": 1, "low": 2, "moderate": 3, "high": 4, "very_high": 5, "extreme": 6}

# --- fixed values: composite score weights ---
SCORE_W_SEASON, SCORE_W_MAX, SCORE_W_RAINY = 0.6, 2.0, 1.5

# --- fixed values: geographic risk rule cascade, first match wins ---
# (group in set or None, elevation below or None, river required, terrain in set or None, class)
GEO_RISK_RULES = (
    ({"Sindh"}, 80, True, None, "high"),
    ({"Punjab"}, 180, True, None, "high"),
    ({"Balochistan"}, 500, True, None, "medium"),
    ({"KPK", "AJK", "GB"}, None, True, {"hills", "mountains"}, "medium"),
    (None, 50, False, {"coastal"}, "high"),
    (None, 150, True, None, "high"),
    (None, 400, True, None, "medium"),
    (None, 250, False, {"plains", "coastal"}, "medium"),
)
GEO_RISK_DEFAULT = "low"

# --- fixed values: smoothing strengths of the priors ---
ENTITY_PRIOR_M = 4
GROUP_PRIOR_M = 8

# --- fixed values: mean-score bands and importance bands ---
RISK_BAND_HIGH, RISK_BAND_MEDIUM = 0.55, 0.35
IMPORTANCE_QUANTILES = (0.75, 0.4)

# --- fixed values: sweep grids (i / 100) ---
TUNE_GRID = (10, 90)     # 0.10 .. 0.89
REPORT_GRID = (5, 95)    # 0.05 .. 0.94
DEFAULT_THRESHOLD = 0.5

# --- fixed values: ingestion payload ---
PAYLOAD_SENTINEL = -999.0
PAYLOAD_ROUND = 3

# --- fixed values: split, folds, seed ---
SEED = 42
TEST_FRACTION = 0.2
N_FOLDS = 5
SMOTE_K = 5

# --- fixed values: seasonal weight lookups of the sample-series generator ---
MONTH_WEIGHTS = {1: 0.5, 2: 0.4, 3: 0.6, 4: 0.5, 5: 0.4, 6: 1.2,
                 7: 4.0, 8: 4.5, 9: 2.5, 10: 0.8, 11: 0.3, 12: 0.4}
