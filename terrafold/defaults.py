"""Fixed values and default parameters."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Country codes kept when the caller names none.
DEFAULT_COUNTRY_CODES = [
    "AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "GR", "HU", "IE",
    "IT", "LV", "LT", "LU", "MT", "NL", "PL", "PT", "RO", "SK", "SI", "ES", "SE",
]

# Simplified country outlines: (iso code, min lon, min lat, max lon, max lat).
COUNTRY_BOXES = [
    ("DE", 5.9, 47.3, 15.0, 55.1),
    ("FR", -5.1, 41.3, 9.6, 51.1),
    ("IT", 6.7, 35.5, 18.5, 47.1),
    ("ES", -9.4, 35.9, 4.6, 43.8),
    ("PL", 14.1, 49.0, 24.1, 55.0),
    ("NL", 3.2, 50.8, 7.2, 53.7),
    ("BE", 2.5, 49.5, 6.4, 51.5),
    ("AT", 9.5, 46.4, 17.2, 49.0),
    ("CH", 5.9, 45.8, 10.5, 47.8),
    ("CZ", 12.1, 48.6, 18.9, 51.0),
]

# Clay fraction by organic-carbon class: below 1 %, below 3 %, the rest.
CLAY_LOW, CLAY_MEDIUM, CLAY_HIGH = 0.15, 0.25, 0.35
SOC_LOW, SOC_MEDIUM = 1.0, 3.0

# Texts of the quality report's issues.
QUALITY_ISSUES = {
    "soc_missing": "SOC% missing values: ",
    "latitude": "Invalid latitude range detected",
    "longitude": "Invalid longitude range detected",
    "soc_range": "SOC% values outside expected range (0-100%)",
}

# Texts of the warnings about result rows.
RESULT_WARNINGS = {
    "zero_samples": "Country %s has zero samples",
    "low_samples": "Country %s has only %d samples",
    "anomalous_soc": "Country %s has anomalous SOC mean: %.3f%%",
    "anomalous_clay": "Country %s has anomalous clay fraction: %.3f",
}

# Cluster-count rules for groups above LARGE_GROUP rows.
LARGE_GROUP = 1000
TARGET_CLUSTER_ROWS = 150
OVERSIZED_CLUSTER_ROWS = 300
SPLIT_CLUSTER_ROWS = 200
ELBOW_RATIO = 0.5

# Cluster-proportional sampling.
SAMPLING_MAX_CLUSTERS = 10
SAMPLING_MIN_CLUSTERS_LARGE = 5
SAMPLE_ROWS_PER_CLUSTER = 20

# Report thresholds.
IMBALANCE_PERCENT = 50.0
LARGE_MEAN_CLUSTER, SMALL_MEAN_CLUSTER = 100, 10
LOW_SAMPLE_COUNT = 10
SOC_MEAN_LIMIT, CLAY_MEAN_LIMIT = 50.0, 1.0
MAX_DEPTH_CM = 1000
SLOW_STAGE_MS, SLOW_QUERY_MS = 1000, 100
MAP_MARGIN_DEGREES = 3
SIMPLIFY_TOLERANCE = 0.001

# --- default parameters -----------------------------------------------------
SAMPLE_SIZE = 100
MIN_SAMPLES_PER_COUNTRY = 10
MIN_CLUSTERS = 2
MAX_CLUSTERS = 10
MIN_SAMPLES_PER_CLUSTER = 5
SEED = 42
KMEANS_RESTARTS = 10
KMEANS_MAX_ITER = 300
KMEANS_TOLERANCE = 1e-4
GRID_DEGREES = 1.0
