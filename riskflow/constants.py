"""Fixed values. They are part of the published data contract and must not drift."""

from __future__ import annotations

# -- raw transaction columns --------------------------------------------------
REQUIRED_COLUMNS = ("step", "type", "amount", "nameOrig", "nameDest", "isFraud", "isFlaggedFraud")
LEAKAGE_COLUMNS = ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")

# -- identifiers --------------------------------------------------------------
DEFAULT_SALT = "paysim_project_salt_v1"

# -- transaction type vocabulary ------------------------------------------------
TXN_TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")

# -- behavioural features -------------------------------------------------------
ROLLING_SPAN = 24
RECENCY_CAP_HOURS = 168
SEQUENCE_GAP_HOURS = 6
RATIO_EPSILON = 1e-6
NIGHT_HOURS = (0, 5)

# -- chronological split ----------------------------------------------------------
TRAIN_END_DAY = 20
VAL_START_DAY = 21
VAL_END_DAY = 25
TEST_START_DAY = 26

# -- model input, in order ----------------------------------------------------------
FEATURES_V1 = (
    "txn_type_CASH_IN",
    "txn_type_CASH_OUT",
    "txn_type_DEBIT",
    "txn_type_PAYMENT",
    "txn_type_TRANSFER",
    "amount",
    "hour",
    "is_night",
    "txn_count_24h",
    "avg_amount_24h",
    "amount_deviation",
    "time_since_last_txn_hr",
    "amount_ratio_24h",
    "is_transfer",
    "is_cash_out",
    "transfer_in_last_6h",
    "transfer_then_cashout_6h",
)

# -- boosted trees ------------------------------------------------------------------
MAX_TREES = 300
MAX_DEPTH = 6
LEARNING_RATE = 0.05
ROW_FRACTION = 0.8
COLUMN_FRACTION = 0.8
POS_WEIGHT = 50.0
PATIENCE = 20
SEED = 42

# -- explanations ---------------------------------------------------------------------
TOP_RISK_ROWS = 200
BASELINE_ROWS = 2000
TOP_DRIVERS = 5
IMPORTANCE_ROWS = 20

# -- economics --------------------------------------------------------------------------
MARGIN_RATE = "0.02"
REVIEW_COST = "5.0"
FRAUD_MULTIPLIER = "1.5"
THRESHOLDS = tuple(i / 100 for i in range(1, 100))

# -- decision policy ----------------------------------------------------------------------
POLICY_NAME = "paysim_behavior_only_v1"
MODEL_ARTIFACT = "artifacts/models/xgb_v1.joblib"
POLICY_THRESHOLD = 0.09
BLOCK_LABEL = "DECLINE"
ALLOW_LABEL = "APPROVE"
REVIEW_LABEL = "REVIEW"
POLICY_NOTES = (
    "Threshold chosen via net economic value optimization to maximize profit "
    "while managing false positives."
)

# -- narratives ---------------------------------------------------------------------------
PROMPT_VERSION = "v1.0"
FORBIDDEN_TERMS = (
    "country",
    "cross-border",
    "merchant category",
    "location",
    "user identity",
    "ip address",
    "device",
)
GUARDRAIL_MESSAGE = (
    "GUARDRAIL TRIGGERED: The LLM generated a narrative containing unverified assumptions. "
    "Please review the structured SHAP drivers manually."
)
CONNECTION_MESSAGE = "LLM Connection Error."

# Prompt text around the three variable parts: decision, score, driver lines.
PROMPT_HEAD = """
    You are an expert fraud analyst assistant. 
    Write a brief, professional 2-3 sentence summary explaining why this transaction was flagged. Describe features as risk indicators, not anomalies or intent.
    
    RULES:
    - ONLY use the data provided below.
    - DO NOT mention geography, merchants, or device data.
    - Be objective and concise.
    
    DATA:
    Decision: """
PROMPT_SCORE = "\n    Risk Score: "
PROMPT_DRIVERS = "\n    \n    Top Risk Drivers (Features pushing the score higher):\n    "
PROMPT_TAIL = "\n    "

# White space removed from both ends of a generated text.
STRIP_CHARS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
