"""Business rules as data: fixed values the results depend on."""

from __future__ import annotations

# --- Fixed values: products and the event that makes a subscriber active -----
PRODUCTS = ("news", "games", "cooking", "athletic")
ALL_PRODUCTS = "ALL_PRODUCTS"
METRIC_VERSION = "2024.Q1"
LOOKBACK_DAYS = 90
DWELL_CAP_SEC = 1800.0

# product -> (event type, label, seconds of dwell that must be exceeded)
QUALIFYING = {
    "news": ("article_complete", "article_complete", None),
    "games": ("game_complete", "game_complete", None),
    "cooking": ("cook_mode_start", "cook_mode_start", None),
    "athletic": ("article_view", "article_view_60s", 60.0),
}

# --- Fixed values: plans, access, tiers and revenue weights ------------------
PLAN_ACCESS = {
    "news": ["bundle_all", "bundle_3", "news_only"],
    "games": ["bundle_all", "bundle_3", "games_only"],
    "cooking": ["bundle_all", "bundle_3", "cooking_only"],
    "athletic": ["bundle_all", "athletic_only"],
    "wirecutter": ["bundle_all"],
}
REGISTERED_PLANS = ["bundle_all", "bundle_3", "news_only", "games_only", "cooking_only", "athletic_only"]
KNOWN_PLANS = REGISTERED_PLANS + ["wirecutter_only"]
BUNDLE_PLANS = ["bundle_all", "bundle_3"]
TIERS = ["full_bundle", "partial_bundle", "single_product"]
TIER_OF_PLAN = {"bundle_all": "full_bundle", "bundle_3": "partial_bundle"}
TIER_LABELS = {"full_bundle": "Full Bundle", "partial_bundle": "Partial Bundle", "single_product": "Single Product"}
MRR_OF_TIER = {"full_bundle": 20.0, "partial_bundle": 14.0, "single_product": 5.0}

# --- Fixed values: allowed column values ------------------------------------
EVENT_TYPES = {
    "news": ["article_view", "article_complete", "share", "save", "comment"],
    "games": ["game_start", "game_complete", "game_share", "streak_milestone"],
    "cooking": ["view", "save", "cook_mode_start", "cook_mode_complete", "rating_submit", "share"],
    "athletic": ["article_view", "liveblog_view", "podcast_play", "video_play", "comment"],
}
GAME_NAMES = ["wordle", "crossword", "spelling_bee", "connections", "strands"]

# --- Fixed values: quality weights and thresholds ---------------------------
DQ_WEIGHTS = {"completeness": 0.30, "uniqueness": 0.20, "timeliness": 0.15, "referential": 0.20, "validity": 0.15}
PASS_AT = 0.95
WARN_AT = 0.85
NULL_SHARE_ISSUE = 0.01
TOP_INVALID = 5

# --- Fixed values: lateness --------------------------------------------------
LATE_AFTER_HOURS = {"events_news": 2, "events_games": 4, "events_cooking": 4, "events_athletic": 3}
DEFAULT_LATE_AFTER_HOURS = 2
REPROCESS_DAY_PCT = 5.0
HIGH_PRIORITY_PCT = 10.0
DOMAIN_WARNING_PCT = 2.0
# upper bound in hours (inclusive) -> label; the last bucket is open
LAG_BUCKETS = [(0.5, "<30min"), (2.0, "30min-2h"), (6.0, "2-6h"), (12.0, "6-12h"), (None, ">12h")]

# --- Fixed values: churn risk --------------------------------------------------
# the mart's tiers: idle days from which a tier without the full bundle is at high
# risk, and the range that counts as dormant
HIGH_RISK_IDLE_DAYS = 30
HIGH_RISK_TIERS = ["single_product", "partial_bundle"]
DORMANT_DAYS = (14, 29)
BUNDLE_TIERS = ["full_bundle", "partial_bundle"]
RISK_TIERS = {"high": "high", "medium": "medium", "low": "low"}
# the dashboard's buckets
NEW_BELOW_DAYS = 30
RISK_BUCKETS = {"churned": "Churned", "new": "New (<30d)", "bundle": "Low Risk", "other": "Medium Risk"}

# --- Fixed values: what each dataset is scored on ---------------------------
# Every event table shares pk, timestamp and foreign key.
DQ_PROFILES = {
    "subscribers": {
        "domain": "subscriber_domain",
        "key_cols": ["subscriber_id", "plan_type", "subscription_start_date", "is_churned"],
        "pk": "subscriber_id", "ts": "created_at", "fk": None,
        "valid_col": "plan_type", "allowed": KNOWN_PLANS,
    },
    "events_news": {
        "domain": "news_domain",
        "key_cols": ["event_id", "event_type", "event_timestamp"],
        "pk": "event_id", "ts": "event_timestamp", "fk": "subscriber_id",
        "valid_col": "event_type", "allowed": EVENT_TYPES["news"],
    },
    "events_games": {
        "domain": "games_domain",
        "key_cols": ["event_id", "game_name", "event_timestamp"],
        "pk": "event_id", "ts": "event_timestamp", "fk": "subscriber_id",
        "valid_col": "game_name", "allowed": GAME_NAMES,
    },
    "events_cooking": {
        "domain": "cooking_domain",
        "key_cols": ["event_id", "recipe_id", "event_timestamp"],
        "pk": "event_id", "ts": "event_timestamp", "fk": "subscriber_id",
        "valid_col": "event_type", "allowed": EVENT_TYPES["cooking"],
    },
    "events_athletic": {
        "domain": "athletic_domain",
        "key_cols": ["event_id", "sport", "event_timestamp"],
        "pk": "event_id", "ts": "event_timestamp", "fk": "subscriber_id",
        "valid_col": "event_type", "allowed": EVENT_TYPES["athletic"],
    },
}

# --- Fixed values: column tests declared on the raw and staged tables -------
# (relation, column, test, arguments)
COLUMN_TESTS = [
    ("raw.subscribers", "subscriber_id", "not_null", None),
    ("raw.subscribers", "plan_type", "not_null", None),
    ("raw.subscribers", "plan_type", "accepted_values", KNOWN_PLANS),
    ("raw.subscribers", "subscription_start_date", "not_null", None),
    ("raw.subscribers", "is_churned", "not_null", None),
    ("raw.events_news", "event_id", "not_null", None),
    ("raw.events_news", "event_id", "unique", None),
    ("raw.events_news", "event_type", "accepted_values", EVENT_TYPES["news"]),
    ("raw.events_news", "event_timestamp", "not_null", None),
    ("raw.events_games", "event_id", "not_null", None),
    ("raw.events_games", "event_id", "unique", None),
    ("raw.events_games", "game_name", "accepted_values", GAME_NAMES),
    ("raw.events_cooking", "event_id", "not_null", None),
    ("raw.events_cooking", "event_id", "unique", None),
    ("raw.events_athletic", "event_id", "not_null", None),
    ("raw.events_athletic", "event_id", "unique", None),
    ("stg.subscribers", "subscriber_id", "not_null", None),
    ("stg.subscribers", "subscriber_id", "unique", None),
    ("stg.subscribers", "plan_type", "not_null", None),
    ("stg.subscribers", "bundle_tier", "accepted_values", TIERS),
    ("stg.subscribers", "tenure_days", "not_null", None),
    ("stg.subscribers", "tenure_days", "accepted_range", (0, 3650)),
    ("stg.events_news", "event_id", "not_null", None),
    ("stg.events_news", "event_id", "unique", None),
    ("stg.events_news", "event_date", "not_null", None),
    ("stg.events_news", "subscriber_id", "not_null", None),
    ("stg.events_news", "time_on_page_sec", "accepted_range", (0, 1800)),
]

# --- Fixed values: schema registry ------------------------------------------
# dataset -> (column, Spark type, nullable, breaking)
REGISTRY_VERSION = "2024.Q1.3"
REGISTRY = {
    "subscribers": [
        ("subscriber_id", "string", False, True),
        ("email_domain", "string", True, False),
        ("plan_type", "string", False, True),
        ("subscription_start_date", "string", False, True),
        ("subscription_end_date", "string", True, False),
        ("is_churned", "boolean", False, True),
        ("acquisition_channel", "string", True, False),
        ("country", "string", True, False),
        ("device_primary", "string", True, False),
        ("created_at", "string", False, False),
    ],
    "events_games": [
        ("event_id", "string", False, True),
        ("subscriber_id", "string", True, False),
        ("game_name", "string", False, True),
        ("event_type", "string", False, True),
        ("score", "bigint", True, False),
        ("streak_days", "bigint", True, False),
        ("duration_sec", "double", True, False),
        ("event_timestamp", "string", False, True),
        ("platform", "string", True, False),
    ],
    "events_news": [
        ("event_id", "string", False, True),
        ("subscriber_id", "string", True, False),
        ("event_type", "string", False, True),
        ("article_id", "string", False, True),
        ("section", "string", True, False),
        ("time_on_page_sec", "double", True, False),
        ("event_timestamp", "string", False, True),
        ("platform", "string", True, False),
        ("referrer", "string", True, False),
    ],
    "events_cooking": [
        ("event_id", "string", False, True),
        ("subscriber_id", "string", True, False),
        ("recipe_id", "string", False, True),
        ("recipe_category", "string", True, False),
        ("event_type", "string", False, True),
        ("rating", "double", True, False),
        ("event_timestamp", "string", False, True),
        ("platform", "string", True, False),
    ],
    "events_athletic": [
        ("event_id", "string", False, True),
        ("subscriber_id", "string", True, False),
        ("sport", "string", False, True),
        ("article_id", "string", False, True),
        ("event_type", "string", False, True),
        ("time_on_page_sec", "double", True, False),
        ("event_timestamp", "string", False, True),
        ("platform", "string", True, False),
    ],
}
# changes of type that only warn: (registered, live)
TOLERATED_TYPE_CHANGES = [("bigint", "double"), ("double", "float")]
# dataset -> (column, allowed values, severity)
REGISTRY_ENUMS = {
    "events_games": ("game_name", GAME_NAMES, "WARNING"),
    "subscribers": ("plan_type", REGISTERED_PLANS, "BREAKING"),
}
SEVERITY_RANK = {"BREAKING": 3, "WARNING": 2, "INFO": 1, "CLEAN": 0}
