"""Thresholds, word lists and labels that results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# --- validation -------------------------------------------------------------------------------
MIN_UNIT_PRICE = "0.01"
MAX_UNIT_PRICE = "10000.00"
MIN_QUANTITY = 1
MIN_STOCK = 0
VALID_TIERS = ("Bronze", "Silver", "Gold", "Platinum", "VIP")
REQUIRED_COLUMNS = {
    "sales": (
        "transaction_id",
        "timestamp",
        "customer_id",
        "product_id",
        "store_id",
        "quantity",
        "unit_price",
        "payment_method",
    ),
    "inventory": ("product_id", "store_id", "stock_on_hand", "reorder_point", "safety_stock"),
    "customers": ("customer_id", "first_name", "last_name", "email", "signup_date", "loyalty_tier"),
}
MISSING_PAYMENT = "Unknown"
EMAIL_DOMAIN = "placeholder.com"

# --- gold -------------------------------------------------------------------------------------
NEVER_PURCHASED_DAYS = 999
REORDER_NEEDED = "REORDER_NEEDED"
HEALTHY = "HEALTHY"


@dataclass(frozen=True)
class RfmThresholds:
    """Spend floors and day limits of the segments, tested in this order."""

    champion_spend: float = 1000
    champion_days: int = 30
    loyal_spend: float = 500
    loyal_days: int = 60
    potential_spend: float = 200
    potential_days: int = 90
    risk_spend: float = 100
    risk_days: int = 90


# --- retail-line quality rules ----------------------------------------------------------------
MISSING_CUSTOMER = "Missing CustomerID"
MISSING_DESCRIPTION = "Missing Description"
NEGATIVE_QUANTITY = "Negative Quantity on Non-Cancellation"
BAD_PRICE = "Invalid/Extreme UnitPrice Bounds"
BAD_DATE = "Invalid Date Timestamp"
BAD_COUNTRY = "Inconsistent Country Name Format"
DUPLICATE_ROW = "Duplicate Row"
CANCELLATION_PREFIX = "C"
MAX_LINE_PRICE = 50000.0
BAD_COUNTRY_NAMES = ("uk", "U.K.", "UNITED KINGDOM", "united kingdom", "UNKNOWN_COUNTRY")
DUPLICATE_KEYS = ("InvoiceNo", "StockCode", "InvoiceDate")
GUEST = "GUEST"
UNKNOWN_COUNTRY = "UNKNOWN"

# --- anomaly model ----------------------------------------------------------------------------
CONTAMINATION = 0.05
N_ESTIMATORS = 100
SEED = 42
MAX_SAMPLES = 256
ALGORITHM = "IsolationForest"
FEATURES = (
    "TotalAmount",
    "Quantity",
    "UnitPrice",
    "CustomerPurchaseFrequency",
    "CustomerTotalSpend",
    "AverageTransactionValue",
    "CountryTransactionCount",
)
STATUS_QUALITY = "DATA QUALITY ISSUE"
STATUS_ANOMALY = "ML-DETECTED ANOMALY"
STATUS_NORMAL = "NORMAL"
LABEL_ANOMALY = "Anomaly"
LABEL_NORMAL = "Normal"
HIGH_SCORE = 0.65
MEDIUM_SCORE = 0.45
FLAGGED_BIN_END = 0.6

# Texts that a delimited file uses for "no value" (the default list of common data-frame readers).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
