"""Table schemas and the tariff / billing rules (as parameters)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- raw usage message (one JSON object per message, three shapes) --------
RAW_CDR = T.StructType([
    T.StructField("record_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("caller_id", T.StringType()),
    T.StructField("callee_id", T.StringType()),
    T.StructField("sender_id", T.StringType()),
    T.StructField("receiver_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("duration_sec", T.IntegerType()),
    T.StructField("session_duration_sec", T.IntegerType()),
    T.StructField("data_volume_mb", T.DoubleType()),
    T.StructField("cell_id", T.StringType()),
    T.StructField("technology", T.StringType()),
])

NORMALIZED_CDR = T.StructType([
    T.StructField("record_type", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("msisdn", T.StringType()),
    T.StructField("peer_id", T.StringType()),
    T.StructField("duration_sec", T.IntegerType()),
    T.StructField("data_volume_mb", T.DoubleType()),
    T.StructField("session_duration_sec", T.IntegerType()),
    T.StructField("cell_id", T.StringType()),
    T.StructField("technology", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("record_hash", T.StringType()),
])
NORMALIZED_COLUMNS = [f.name for f in NORMALIZED_CDR.fields]

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("subscription_type", T.StringType()),
    T.StructField("rate_plan_id", T.StringType()),
    T.StructField("activation_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("is_student", T.BooleanType()),
])

RATE_PLANS = T.StructType([
    T.StructField("rate_plan_id", T.StringType()),
    T.StructField("plan_name", T.StringType()),
])

PRODUCT_CATALOG = T.StructType([
    T.StructField("product_code", T.StringType()),
    T.StructField("service_type", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("rate_type", T.StringType()),
])

PRODUCT_RATES = T.StructType([
    T.StructField("rate_plan_id", T.StringType()),
    T.StructField("service_type", T.StringType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("free_units", T.IntegerType()),
])

PRICE = T.DecimalType(10, 4)   # list prices
MONEY = T.DecimalType(18, 6)   # rated costs, kept exact until output

RATED_CDR = T.StructType([
    T.StructField("record_hash", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("msisdn", T.StringType()),
    T.StructField("peer_id", T.StringType()),
    T.StructField("duration_sec", T.IntegerType()),
    T.StructField("data_volume_mb", T.DoubleType()),
    T.StructField("session_duration_sec", T.IntegerType()),
    T.StructField("cell_id", T.StringType()),
    T.StructField("technology", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("rate_plan_id", T.StringType()),
    T.StructField("unit_price", PRICE),
    T.StructField("base_cost", MONEY),
    T.StructField("final_cost", MONEY),
    T.StructField("discount_applied", T.StringType()),
    T.StructField("rating_status", T.StringType()),
])
RATED_COLUMNS = [f.name for f in RATED_CDR.fields]

INVOICE_MONEY = T.DecimalType(18, 2)
INVOICES = T.StructType([
    T.StructField("invoice_id", T.LongType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("billing_period", T.DateType()),
    T.StructField("total_base_cost", INVOICE_MONEY),
    T.StructField("total_discount", INVOICE_MONEY),
    T.StructField("tax_applied", INVOICE_MONEY),
    T.StructField("total_final_cost", INVOICE_MONEY),
    T.StructField("generated_at", T.TimestampType()),
])
INVOICE_COLUMNS = [f.name for f in INVOICES.fields]

# Primary keys, foreign keys and CHECK sets of the relational model.
PRIMARY_KEYS = {
    "normalized_cdr": ["record_hash"],
    "customers": ["customer_id"],
    "rate_plans": ["rate_plan_id"],
    "product_catalog": ["product_code"],
    "product_rates": ["rate_plan_id", "service_type"],
    "rated_cdr": ["record_hash"],
    "invoices": ["invoice_id"],
}

# ---- fixed values that must equal the reference for equal results --------
SERVICES = ("voice", "sms", "data")
HOME_PREFIX = "212"
VALID_MSISDN_PATTERN = "^212[0-9]+"
BLOCKED_PREFIX = "999"
HASH_SEPARATOR = "|"
STATUS_OK, STATUS_ERROR = "ok", "error"
RATED, UNMATCHED = "rated", "unmatched"
LOYALTY_TAG, STUDENT_TAG = "loyalty_5%", "student_10%"
CUSTOMER_STATUSES = ("active", "suspended", "terminated")
SUBSCRIPTION_TYPES = ("postpaid",)
SEGMENT_LABELS = ("🌟 Champions", "💎 Loyaux", "📈 Potentiel", "🚨 À risque")
EXPORT_RENAMES = {
    "invoice_id": "ID_Facture",
    "customer_id": "ID_Client",
    "customer_name": "Nom_Client",
    "billing_period": "Periode_Facturation",
    "total_base_cost": "Cout_Base",
    "total_discount": "Reductions",
    "tax_applied": "TVA",
    "total_final_cost": "Montant_Total",
    "rate_plan_id": "Plan_Tarifaire",
    "region_mapped": "Region",
}


@dataclass(frozen=True)
class TariffRules:
    """Rating modifiers. Factors are decimals so money stays exact."""
    peak_start_hour: int = 8
    peak_end_hour: int = 20          # exclusive
    peak_factor: str = "1.20"
    weekend_days: tuple[int, ...] = (5, 6)   # dayofweek-1: Friday, Saturday
    weekend_factor: str = "0.90"
    international_factor: str = "2.00"
    loyalty_days: int = 365
    loyalty_factor: str = "0.95"
    student_factor: str = "0.90"


@dataclass(frozen=True)
class BillingRules:
    vat_rate: str = "0.20"
    regulatory_fee: str = "1.00"
    student_discount: str = "0.10"
    loyalty_discount: str = "0.05"
    loyalty_months: int = 12
    # free-unit scaling: allowance unit -> usage unit (voice minutes -> seconds)
    free_unit_scale: dict = field(default_factory=lambda: {"voice": 60, "sms": 1, "data": 1})


DEFAULT_TARIFF = TariffRules()
DEFAULT_BILLING = BillingRules()
