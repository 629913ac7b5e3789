"""Values that results and stored tables depend on."""

# Fixed values, to be kept as they are.

# Status spellings that count as delivered: LIKE patterns, and the exact word.
DELIVERED_PATTERNS = ("%livr%", "%Livr%", "%delivered%", "%Delivered%")
DELIVERED_VALUE = "livré"

# Weekday names, Sunday first (Spark's dayofweek = 1).
FRENCH_WEEKDAYS = ("Dimanche", "Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi")

# Spend thresholds with their segment, highest first, and the segment below them.
SEGMENTS = ((1000, "VIP"), (500, "Fidèle"), (100, "Actif"))
LOWEST_SEGMENT = "Occasionnel"

# Labels for missing names, statuses and payment methods.
UNKNOWN = "Inconnu"
UNKNOWN_PAYMENT = "Non spécifié"
OTHER_PAYMENT = "Autre"
CLIENT_PREFIX = "Client "

# Forecast records and their comparison with history.
FEATURES = ("day", "weekday", "month")
MODEL_NAME = "LinearRegression"
BASELINE_NAME = "weekday_mean"
PREDICTION_PREFIX = "PRED-"
TREND_UP, TREND_DOWN = "HAUSSE", "BAISSE"
ARROW_UP, ARROW_DOWN = "↗", "↘"

# Regression settings, and the fewest rows to train on.
MAX_ITER, REG_PARAM, L1_RATIO = 100, 0.01, 0.8
MIN_TRAINING_ROWS = 3
MIN_DELIVERED = 5

# Stored result tables and their row limit.
RESULT_PREFIX = "analysis_"
STORED_ROWS = 100
