"""Fixed values.

Names, edges, labels and lists that results depend on. They are data, stated as they are; the code that
uses them is elsewhere.
"""

INF = float("inf")

TARGET = "fraud"
TIMESTAMP = "transaction_datetime"
RAW_TIMESTAMP = "local_timestamp"

# Texts that mean true / false in a boolean-like column, and texts that mean missing.
BOOLEAN_TEXTS = {"true": 1, "false": 0, "yes": 1, "no": 0, "y": 1, "n": 0, "1": 1, "0": 0}
MISSING_TEXTS = ["", "nan", "None"]

# Columns that are numbers whatever the file says.
NUMERIC_COLUMNS = [
    "amount",
    "mean_amount_30d",
    "std_amount_30d",
    "max_amount_30d",
    "night_ratio_30d",
    "mcc_entropy_30d",
    "distinct_merchants_7d",
    "distinct_countries_30d",
    "device_diversity_30d",
    "decline_rate_30d",
    "chargebacks_365d",
    "credit_util_today",
    "spending_trend_30d",
    "fraud",
]

# Right-closed groups: source column -> (new column, upper edges, labels).
IP_SCORE_BIN = ("ip_score_bin", [0.2, 0.5, 0.8], ["low", "medium", "high", "very_high"])
TIME_PERIODS = ("time_period", [5, 11, 17, 21], ["night", "morning", "afternoon", "evening", "late_evening"])
RISK_GROUPS = {
    "ip_score": ("ip_score_risk_group", [0.2, 0.5, 0.8], ["low", "medium", "high", "very_high"]),
    "decline_rate_30d": ("decline_rate_risk_group", [0.1, 0.3, 0.6], ["low", "medium", "high", "very_high"]),
    "credit_util_today": ("credit_util_risk_group", [0.3, 0.6, 0.9], ["low", "medium", "high", "very_high"]),
    "txn_count_7d": ("txn_count_7d_group", [1, 5, 10, 20], ["0_1", "2_5", "6_10", "11_20", "gt_20"]),
    "txn_count_ratio_7d_30d": (
        "txn_velocity_group",
        [0.2, 0.5, 0.8, 1.2],
        ["very_low", "low", "medium", "high", "very_high"],
    ),
    "night_ratio_30d": ("night_ratio_group", [0, 0.1, 0.3, 0.6], ["zero", "very_low", "low", "medium", "high"]),
    "amount_to_mean_30d": (
        "amount_to_mean_group",
        [1, 2, 5, 10],
        ["normal", "slightly_high", "high", "very_high", "extreme"],
    ),
    "amount_to_max_30d": (
        "amount_to_max_group",
        [0.5, 1, 2, 5],
        ["below_half_max", "near_max", "above_max", "much_above_max", "extreme"],
    ),
}
NIGHT_UNUSUAL_GROUP = (
    "night_unusual_group",
    [0, 0.3, 0.6, 0.9],
    ["not_night", "low", "medium", "high", "very_high"],
)

# The first spending column that exists is the one used.
SPENDING_COLUMNS = ["spending_trend_30d", "spending_trend"]

# Fitted thresholds: name -> (column, probability, side, flag). "spending" stands for SPENDING_COLUMNS.
THRESHOLDS = {
    "very_low_mcc_entropy_q05": ("mcc_entropy_30d", 0.05, "low", "very_low_mcc_entropy_flag"),
    "low_mcc_entropy_q10": ("mcc_entropy_30d", 0.10, "low", "low_mcc_entropy_flag"),
    "low_night_ratio_q10": ("night_ratio_30d", 0.10, "low", "low_night_ratio_flag"),
    "high_max_amount_q90": ("max_amount_30d", 0.90, "high", "high_max_amount_30d_flag"),
    "low_spending_trend_q10": ("spending", 0.10, "low", "low_spending_trend_flag"),
    "low_country_diversity_q10": ("distinct_countries_30d", 0.10, "low", "low_country_diversity_flag"),
    "high_device_diversity_q90": ("device_diversity_30d", 0.90, "high", "high_device_diversity_flag"),
    "high_decline_rate_q90": ("decline_rate_30d", 0.90, "high", "high_decline_rate_flag"),
    "high_ip_score_q90": ("ip_score", 0.90, "high", "high_ip_score_flag"),
}

# Products of flags: new column -> flags.
INTERACTIONS = {
    "low_mcc_entropy_x_low_night_ratio": ["low_mcc_entropy_flag", "low_night_ratio_flag"],
    "low_mcc_entropy_x_low_night_ratio_x_card_not_present": [
        "low_mcc_entropy_flag",
        "low_night_ratio_flag",
        "card_not_present_flag",
    ],
    "low_mcc_entropy_x_high_max_amount_30d": ["low_mcc_entropy_flag", "high_max_amount_30d_flag"],
    "low_mcc_entropy_x_low_spending_trend": ["low_mcc_entropy_flag", "low_spending_trend_flag"],
    "low_night_ratio_x_high_max_amount_30d": ["low_night_ratio_flag", "high_max_amount_30d_flag"],
    "low_night_ratio_x_night_transaction": ["low_night_ratio_flag", "night_transaction_flag"],
    "low_mcc_entropy_x_card_not_present": ["low_mcc_entropy_flag", "card_not_present_flag"],
    "cross_border_x_low_country_diversity": ["cross_border_flag", "low_country_diversity_flag"],
    "very_low_mcc_entropy_x_low_night_ratio": ["very_low_mcc_entropy_flag", "low_night_ratio_flag"],
    "very_low_mcc_entropy_x_card_not_present": ["very_low_mcc_entropy_flag", "card_not_present_flag"],
    "high_ip_score_x_card_not_present": ["high_ip_score_flag", "card_not_present_flag"],
    "high_decline_rate_x_card_not_present": ["high_decline_rate_flag", "card_not_present_flag"],
    "high_device_diversity_x_card_not_present": ["high_device_diversity_flag", "card_not_present_flag"],
    "high_max_amount_30d_x_low_country_diversity": ["high_max_amount_30d_flag", "low_country_diversity_flag"],
    "high_max_amount_30d_x_tokenised": ["high_max_amount_30d_flag", "tokenised_flag"],
}

# Candidate model features by kind; those present in a table are used, in this order.
NUMERIC_FEATURES = [
    "night_ratio_30d",
    "mcc_entropy_30d",
    "distinct_merchants_7d",
    "distinct_countries_30d",
    "device_diversity_30d",
    "decline_rate_30d",
    "chargebacks_365d",
    "credit_util_today",
    "spending_trend",
    "ip_score",
    "txn_count_7d",
    "txn_count_30d",
    "txn_count_ratio_7d_30d",
    "hour",
    "log_mean_amount_30d",
    "amount_to_mean_30d",
    "log_amount_to_max_30d",
    "amount_z_30d",
    "night_unusual_score",
]
CATEGORICAL_FEATURES = [
    "currency",
    "payment_channel",
    "merchant_country",
    "mcc",
    "card_entry_mode",
    "auth_result",
    "pin_verif_method",
    "recurring_flag",
    "auth_characteristics",
    "message_type",
    "term_location",
    "day_name",
    "time_period",
    "night_ratio_group",
    "night_unusual_group",
    "amount_to_max_group",
    "ip_score_risk_group",
    "decline_rate_risk_group",
    "credit_util_risk_group",
    "txn_count_7d_group",
    "txn_velocity_group",
]
BINARY_FEATURES = [
    "very_low_mcc_entropy_flag",
    "low_mcc_entropy_flag",
    "low_night_ratio_flag",
    "high_max_amount_30d_flag",
    "low_spending_trend_flag",
    "low_country_diversity_flag",
    "night_transaction_flag",
    "card_not_present_flag",
    "cross_border_flag",
    "tokenised_flag",
]
INTERACTION_FEATURES = [
    "low_mcc_entropy_x_low_night_ratio",
    "low_mcc_entropy_x_low_night_ratio_x_card_not_present",
    "low_mcc_entropy_x_high_max_amount_30d",
    "low_mcc_entropy_x_low_spending_trend",
    "low_night_ratio_x_high_max_amount_30d",
    "low_night_ratio_x_night_transaction",
    "low_mcc_entropy_x_card_not_present",
    "cross_border_x_low_country_diversity",
]
DROPPED_COLUMNS = ["ip_risk", "txn_counts", "ip_address", "transaction_datetime"]

# Columns mined for patterns.
MINED_NUMERIC = [
    "amount",
    "mean_amount_30d",
    "std_amount_30d",
    "max_amount_30d",
    "night_ratio_30d",
    "mcc_entropy_30d",
    "distinct_merchants_7d",
    "distinct_countries_30d",
    "device_diversity_30d",
    "decline_rate_30d",
    "chargebacks_365d",
    "credit_util_today",
    "spending_trend",
    "spending_trend_30d",
    "ip_score",
    "txn_count_7d",
    "txn_count_30d",
    "txn_count_ratio_7d_30d",
    "hour",
    "amount_to_mean_30d",
    "amount_to_max_30d",
    "night_unusual_score",
]
MINED_CATEGORICAL = [
    "currency",
    "payment_channel",
    "merchant_country",
    "mcc",
    "card_present",
    "card_entry_mode",
    "auth_result",
    "pin_verif_method",
    "tokenised",
    "recurring_flag",
    "cross_border",
    "auth_characteristics",
    "message_type",
    "term_location",
    "day_name",
    "time_period",
    "ip_score_bin",
    "ip_score_risk_group",
    "decline_rate_risk_group",
    "credit_util_risk_group",
    "txn_count_7d_group",
    "txn_velocity_group",
    "night_ratio_group",
    "amount_to_mean_group",
    "amount_to_max_group",
    "night_unusual_group",
    "high_ip_high_amount_flag",
    "high_decline_high_amount_flag",
    "private_ip_high_score_flag",
    "high_velocity_high_amount_flag",
    "low_mcc_entropy_x_low_night_ratio",
    "low_mcc_entropy_x_high_max_amount_30d",
    "low_mcc_entropy_x_low_spending_trend",
    "low_mcc_entropy_x_card_not_present",
    "low_night_ratio_x_high_max_amount_30d",
    "cross_border_x_low_country_diversity",
    "high_ip_score_x_card_not_present",
]
# Derived categories that are mined whether or not they were asked for.
AUTO_CATEGORICAL = [
    "ip_score_risk_group",
    "decline_rate_risk_group",
    "credit_util_risk_group",
    "txn_count_7d_group",
    "txn_velocity_group",
    "night_ratio_group",
    "amount_to_mean_group",
    "amount_to_max_group",
    "night_unusual_group",
    "high_ip_high_amount_flag",
    "high_decline_high_amount_flag",
    "private_ip_high_score_flag",
    "high_velocity_high_amount_flag",
    "low_mcc_entropy_x_low_night_ratio",
    "low_mcc_entropy_x_high_max_amount_30d",
    "low_mcc_entropy_x_low_spending_trend",
    "low_mcc_entropy_x_card_not_present",
    "low_night_ratio_x_high_max_amount_30d",
    "cross_border_x_low_country_diversity",
    "high_ip_score_x_card_not_present",
]
AUTO_NUMERIC = ["amount_to_mean_30d", "amount_to_max_30d", "night_unusual_score"]
MINED_PAIRS = [
    ("payment_channel", "merchant_country"),
    ("payment_channel", "card_entry_mode"),
    ("payment_channel", "term_location"),
    ("card_entry_mode", "auth_result"),
    ("auth_result", "pin_verif_method"),
    ("cross_border", "merchant_country"),
    ("card_present", "payment_channel"),
    ("tokenised", "payment_channel"),
    ("time_period", "payment_channel"),
    ("day_name", "payment_channel"),
]

# Business segments: name -> (description, conditions that must all hold). A condition is
# (kind, column, argument): low / high compare with the column's own quantile, equals with a value,
# positive with 0, true / false with the boolean texts.
SEGMENTS = {
    "low_mcc_entropy": ("history in few merchant categories", [("low", "mcc_entropy_30d", 0.1)]),
    "very_low_mcc_entropy": ("history in very few merchant categories", [("low", "mcc_entropy_30d", 0.05)]),
    "low_night_ratio": ("hardly any history at night", [("low", "night_ratio_30d", 0.1)]),
    "night_transaction": ("this transaction is at night", [("equals", "is_night_txn", 1)]),
    "night_unusual": (
        "at night although the history is not",
        [("equals", "is_night_txn", 1), ("low", "night_ratio_30d", 0.1)],
    ),
    "high_max_amount_30d": ("very high largest amount in 30 days", [("high", "max_amount_30d", 0.9)]),
    "high_current_amount": ("high amount now", [("high", "amount", 0.9)]),
    "low_spending_trend": ("low or falling spending", [("low", "spending", 0.1)]),
    "high_decline_rate": ("many declines in 30 days", [("high", "decline_rate_30d", 0.9)]),
    "has_chargeback_history": ("a chargeback within 365 days", [("positive", "chargebacks_365d", None)]),
    "low_country_diversity": ("history in few countries", [("low", "distinct_countries_30d", 0.1)]),
    "high_device_diversity": ("many devices in 30 days", [("high", "device_diversity_30d", 0.9)]),
    "card_not_present": ("card not present", [("false", "card_present", None)]),
    "cross_border": ("across a border", [("true", "cross_border", None)]),
    "high_ip_score": ("high IP risk score", [("high", "ip_score", 0.9)]),
    "tokenised_transaction": ("tokenised", [("true", "tokenised", None)]),
    "high_amount_to_mean": ("amount far above the 30-day mean", [("high", "amount_to_mean_30d", 0.9)]),
    "high_amount_to_max": ("amount near or above the 30-day maximum", [("high", "amount_to_max_30d", 0.9)]),
}

# Rules made of flags: rule -> flags.
PRIORITY_RULES = {
    "low_mcc_entropy AND low_night_ratio": ["low_mcc_entropy_flag", "low_night_ratio_flag"],
    "low_mcc_entropy AND high_max_amount_30d": ["low_mcc_entropy_flag", "high_max_amount_30d_flag"],
    "low_mcc_entropy AND low_spending_trend": ["low_mcc_entropy_flag", "low_spending_trend_flag"],
    "low_mcc_entropy AND card_not_present": ["low_mcc_entropy_flag", "card_not_present_flag"],
    "low_night_ratio AND night_transaction": ["low_night_ratio_flag", "night_transaction_flag"],
    "low_night_ratio AND high_max_amount_30d": ["low_night_ratio_flag", "high_max_amount_30d_flag"],
    "cross_border AND low_country_diversity": ["cross_border_flag", "low_country_diversity_flag"],
    "high_ip_score AND card_not_present": ["high_ip_score_flag", "card_not_present_flag"],
    "high_device_diversity AND card_not_present": ["high_device_diversity_flag", "card_not_present_flag"],
    "high_decline_rate AND card_not_present": ["high_decline_rate_flag", "card_not_present_flag"],
    "low_mcc_entropy AND low_night_ratio AND card_not_present": [
        "low_mcc_entropy_flag",
        "low_night_ratio_flag",
        "card_not_present_flag",
    ],
    "low_mcc_entropy AND low_night_ratio AND high_max_amount_30d": [
        "low_mcc_entropy_flag",
        "low_night_ratio_flag",
        "high_max_amount_30d_flag",
    ],
}

# Strength classes in the order they are tried: (class, least lift, least event rate). Below 30 rows: WEAK_SUPPORT.
STRENGTH_MIN_SUPPORT = 30
STRENGTHS = [
    ("VERY_STRONG", 5, 0.10),
    ("STRONG", 3, 0.07),
    ("MEDIUM", 2, 0.05),
    ("WEAK", 1.5, None),
]

# Decision classes.
APPROVE_BELOW = 0.30
DECISIONS = {"low": ("LOW", "APPROVE"), "medium": ("MEDIUM", "MANUAL_REVIEW"), "high": ("HIGH", "FRAUD_ALERT")}

# Decision thresholds that are searched, and review budgets of the policy table.
SEARCHED_THRESHOLDS = [i / 100 for i in range(1, 100)]
REVIEW_CAPACITIES = [0.03, 0.05, 0.10]

# Columns described per error type.
ERROR_NUMERIC = [
    "mcc_entropy_30d",
    "night_ratio_30d",
    "log_amount_to_max_30d",
    "spending_trend",
    "distinct_countries_30d",
    "amount_z_30d",
    "decline_rate_30d",
    "device_diversity_30d",
    "credit_util_today",
    "ip_score",
    "txn_count_ratio_7d_30d",
]
ERROR_CATEGORICAL = [
    "payment_channel",
    "merchant_country",
    "card_entry_mode",
    "auth_result",
    "term_location",
    "time_period",
    "day_name",
    "amount_to_max_group",
    "night_ratio_group",
    "credit_util_risk_group",
]

# Encoded feature names "column_value" are shown as "column=value" for these columns.
READABLE_COLUMNS = [
    "currency",
    "payment_channel",
    "merchant_country",
    "card_entry_mode",
    "auth_result",
    "pin_verif_method",
    "recurring_flag",
    "auth_characteristics",
    "message_type",
    "term_location",
    "day_name",
    "time_period",
    "ip_score_bin",
    "night_ratio_group",
    "night_unusual_group",
    "amount_to_mean_group",
    "amount_to_max_group",
    "ip_score_risk_group",
    "decline_rate_risk_group",
    "credit_util_risk_group",
    "txn_count_7d_group",
    "txn_velocity_group",
]

# Insight groups of coefficient names, tried in order: group -> substrings.
COEFFICIENT_GROUPS = {
    "MCC behavior anomaly": ["mcc_entropy", "low_mcc_entropy", "very_low_mcc_entropy"],
    "Time behavior anomaly": ["night_ratio", "night_transaction", "night_unusual", "time_period"],
    "Amount anomaly": ["amount_z", "amount_to_mean", "amount_to_max", "max_amount", "log_amount"],
    "Spending trend anomaly": ["spending_trend"],
    "Country / cross-border behavior": ["country", "cross_border", "distinct_countries", "merchant_country"],
    "Risk history / technical risk": ["ip_score", "decline_rate", "chargebacks", "device_diversity", "credit_util"],
    "Payment / authentication context": [
        "payment_channel",
        "card_entry_mode",
        "auth_result",
        "pin_verif",
        "auth_characteristics",
        "message_type",
        "term_location",
        "tokenised",
        "card_not_present",
        "currency",
        "recurring_flag",
    ],
    "Transaction velocity": ["txn_count", "txn_velocity"],
}
COEFFICIENT_OTHER = "Other context"

# Insight groups of importance names, tried in order.
IMPORTANCE_GROUPS = {
    "Amount anomaly": ["amount"],
    "MCC behavior": ["mcc_entropy", "mcc"],
    "Time/night behavior": ["night", "time_period", "hour"],
    "Spending trend": ["spending_trend"],
    "Country behavior": ["country", "cross_border", "countries"],
    "Risk/technical": ["decline", "ip_score", "device", "chargeback", "credit"],
    "Velocity": ["txn_count", "velocity"],
    "Payment/auth context": ["payment", "auth", "card", "pin", "term_location"],
}
IMPORTANCE_OTHER = "Other"
