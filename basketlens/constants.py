"""Fixed values and their defaults, all of them parameters of the operators."""

from __future__ import annotations

# --- Fixed values -----------------------------------------------------------
MIN_TRANSACTIONS = 3
CLUSTERS = 5
LONG_WINDOW_DAYS = 84  # reference date in the first or third quarter
SHORT_WINDOW_DAYS = 56  # reference date in the second or fourth quarter
LONG_WINDOW_QUARTERS = (1, 3)
MIGRATION_ALERT = 0.15
SMALL_SEGMENT_PCT = 5.0
LARGE_SEGMENT_PCT = 40.0
DEEP_SESSION_EVENTS = 5
POWER_USER_TRANSACTIONS = 30

PROJECT_CATEGORIES = ("Lumber", "Flooring", "Kitchen & Bath", "Plumbing", "Appliances")
MAINTENANCE_CATEGORIES = ("Hardware", "Paint", "Lighting", "Electrical", "Garden & Outdoor")
LOYALTY_TIERS = {"Gold": 3, "Silver": 2, "Bronze": 1}

# Columns of the processed feature table.
CONTEXT_COLUMNS = ("customer_id", "region")
PROCESSED_FEATURES = (
    "weekly_purchase_frequency",
    "category_breadth",
    "avg_basket_size",
    "online_ratio",
    "project_ratio",
    "promo_purchase_ratio",
    "avg_discount_depth",
    "full_price_ratio",
    "days_since_last_purchase",
    "monthly_frequency",
    "frequency_trend",
    "q2_concentration",
    "weekend_ratio",
    "total_sessions",
    "search_rate",
    "product_page_ratio",
    "deep_browse_ratio",
)
PROCESSED_LOG_FEATURES = ("avg_basket_size", "days_since_last_purchase", "total_sessions")

# Inputs of the distance that clusters customers.
CLUSTER_FEATURES = (
    "avg_basket_size",
    "weekly_purchase_frequency",
    "online_ratio",
    "promo_purchase_ratio",
    "avg_discount_depth",
    "frequency_trend",
    "days_since_last_purchase",
    "category_breadth",
    "project_ratio",
    "search_rate",
    "deep_browse_ratio",
)
CLUSTER_LOG_FEATURES = ("avg_basket_size", "days_since_last_purchase")

# Features averaged into a segment profile.
PROFILE_FEATURES = (
    "total_transactions",
    "weekly_purchase_frequency",
    "category_breadth",
    "avg_basket_size",
    "median_basket_size",
    "online_ratio",
    "project_ratio",
    "promo_purchase_ratio",
    "avg_discount_depth",
    "full_price_ratio",
    "days_since_last_purchase",
    "monthly_frequency",
    "frequency_trend",
    "q2_concentration",
    "weekend_ratio",
    "total_sessions",
    "search_rate",
    "product_page_ratio",
    "deep_browse_ratio",
    "loyalty_tier_numeric",
    "points_balance",
)
COMPARISON_FEATURES = (
    "weekly_purchase_frequency",
    "avg_basket_size",
    "online_ratio",
    "promo_purchase_ratio",
    "project_ratio",
    "weekend_ratio",
    "frequency_trend",
    "days_since_last_purchase",
)

# Segment names with the weights of their linear scores; earlier rules win ties.
NAME_RULES = (
    (
        "Price Hunters",
        {"promo_purchase_ratio": 3.0, "avg_discount_depth": 5.0, "avg_basket_size": -1 / 500},
    ),
    (
        "Project Planners",
        {
            "avg_basket_size": 1 / 300,
            "project_ratio": 3.0,
            "online_ratio": 2.0,
            "search_rate": 5.0,
            "deep_browse_ratio": 10.0,
            "weekly_purchase_frequency": -2.0,
        },
    ),
    (
        "Weekend Warriors",
        {
            "weekly_purchase_frequency": 5.0,
            "category_breadth": 1 / 3,
            "weekend_ratio": 2.0,
            "online_ratio": -3.0,
        },
    ),
    (
        "Loyal Regulars",
        {
            "full_price_ratio": 3.0,
            "loyalty_tier_numeric": 1.0,
            "monthly_frequency": 2.0,
            "promo_purchase_ratio": -2.0,
        },
    ),
    (
        "Dormant / At-Risk",
        {
            "days_since_last_purchase": 1 / 100,
            "frequency_trend": -3.0,
            "weekly_purchase_frequency": -3.0,
            "total_sessions": -1 / 20,
        },
    ),
)
# Decimals of each mean in the profile summary: source, name, digits.
SUMMARY_COLUMNS = (
    ("avg_basket_size", "avg_basket", 2),
    ("weekly_purchase_frequency", "avg_weekly_freq", 4),
    ("category_breadth", "avg_categories", 1),
    ("online_ratio", "avg_online_ratio", 3),
    ("project_ratio", "avg_project_ratio", 3),
    ("promo_purchase_ratio", "avg_promo_ratio", 3),
    ("avg_discount_depth", "avg_discount_depth", 3),
    ("full_price_ratio", "avg_full_price_ratio", 3),
    ("days_since_last_purchase", "avg_recency_days", 0),
    ("frequency_trend", "avg_freq_trend", 3),
    ("weekend_ratio", "avg_weekend_ratio", 3),
    ("total_sessions", "avg_sessions", 1),
    ("search_rate", "avg_search_rate", 3),
    ("deep_browse_ratio", "avg_deep_browse", 3),
)

PROFILE_COLUMNS = (
    "avg_basket_size",
    "median_basket_size",
    "weekly_purchase_frequency",
    "monthly_frequency",
    "total_transactions",
    "category_breadth",
    "online_ratio",
    "project_ratio",
    "promo_purchase_ratio",
    "avg_discount_depth",
    "full_price_ratio",
    "days_since_last_purchase",
    "frequency_trend",
    "q2_concentration",
    "weekend_ratio",
    "total_sessions",
    "search_rate",
    "deep_browse_ratio",
    "loyalty_tier_numeric",
    "points_balance",
    "region",
)

# Churn risk: the first rule that holds gives the level.
CHURN_RULES = (
    ("High Risk", "frequency_trend < -0.3 AND days_since_last_purchase > 300"),
    ("Medium Risk", "frequency_trend < -0.1 OR days_since_last_purchase > 400"),
)
LOW_RISK = "Low Risk"
CHURN_COLUMNS = (
    "days_since_last_purchase",
    "frequency_trend",
    "monthly_frequency",
    "total_transactions",
    "loyalty_tier_numeric",
)

# Features compared between refreshes.
DRIFT_FEATURES = (
    "avg_basket_size",
    "promo_purchase_ratio",
    "online_ratio",
    "days_since_last_purchase",
    "frequency_trend",
)
# --- End of fixed values ----------------------------------------------------
