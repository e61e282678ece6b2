"""Fixed values and default thresholds shared by the operators."""

# Domains of the event fields.
EVENT_TYPES = ["page_view", "click", "add_to_cart", "purchase", "login", "logout", "error", "search"]
DEVICE_TYPES = ["desktop", "mobile", "tablet"]

# Traffic source by a piece of the referrer URL; the first match in this order wins.
REFERRER_SOURCES = {
    "google": "organic",
    "facebook": "social",
    "twitter": "social",
    "linkedin": "social",
    "instagram": "social",
    "email": "email",
    "newsletter": "email",
    "bing": "organic",
    "yahoo": "organic",
}
DIRECT_REFERRERS = ["", "/", "None"]

# Quality scoring.
CRITICAL_FIELDS = ["user_id", "session_id", "timestamp", "event_type", "event_id"]
MIN_QUALITY_SCORE = 0.5
MAX_RESPONSE_TIME_MS = 30000
MAX_AGE_DAYS = 7
SILVER_VERSION = "1.0.0"

# Anomaly thresholds.
MIN_SAMPLES = 10
ERROR_RATE_THRESHOLD = 0.05
SLOW_RESPONSE_Z = 3.0
TRAFFIC_SPIKE_FACTOR = 3.0
PURCHASE_DROP_FRACTION = 0.5
P99_RESPONSE_MS = 5000
TREND_WINDOW_SECONDS = 300

# Windows of history behind the rolling traffic average (one hour of 5-minute windows).
TRAFFIC_HISTORY_WINDOWS = 12

# Funnel steps in order.
FUNNEL_STEPS = ["page_view", "click", "add_to_cart", "purchase"]

# Alert routing.
MAX_ALERTS_PER_BATCH = 50
DIGEST_SIZE = 10
SEVERITIES = ["low", "medium", "high", "critical"]

# A visit ends after this much silence.
SESSION_GAP_SECONDS = 1800

# Width of the time slices that per-session and per-user ordering is split into, so that one
# hot session or user is spread over many tasks (see operators/ordering.py).
SLICE_SECONDS = 300
