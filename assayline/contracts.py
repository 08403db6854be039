"""Fixed values of the data model: vocabularies, reasons, labels and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Vocabularies. Keys are compared lower-cased; a raw value that is
# not listed becomes NULL.
# ---------------------------------------------------------------------------
REGIONS = {
    "c": "Central", "w": "West", "s": "South", "e": "East", "n": "North",
    "central": "Central", "west": "West", "south": "South", "east": "East", "north": "North",
}
EDUCATION = {
    "primary": "primary", "secondary": "secondary", "tertiary": "tertiary", "terto": "tertiary",
}
MARITAL = {
    "married": "married", "single": "single", "divorced": "divorced",
    "widow": "widow", "separated": "separated",
}
FUEL = {
    "petrol": "petrol", "diesel": "diesel", "electric": "electric",
    "hybrid": "hybrid", "cng": "cng", "lpg": "lpg",
}
TRANSMISSION = {"manual": "manual", "automatic": "automatic"}
SELLER_TYPES = {
    "individual": "individual", "dealer": "dealer",
    "trustmark dealer": "dealer", "company": "company",
}
OWNERS = {
    "first owner": "first owner", "second owner": "second owner", "third owner": "third owner",
    "fourth & above owner": "fourth & above owner",
}
SEVERITIES = {
    "minor damage": "minor damage", "major damage": "major damage",
    "trivial damage": "trivial damage", "total loss": "total loss",
}
INCIDENT_TYPES = {
    "single vehicle collision": "single vehicle collision",
    "multi-vehicle collision": "multi-vehicle collision",
    "vehicle theft": "vehicle theft", "parked car": "parked car",
}
COLLISIONS = {
    "rear collision": "rear collision", "front collision": "front collision",
    "side collision": "side collision",
}
AUTHORITIES = {
    "police": "police", "ambulance": "ambulance", "fire": "fire", "none": "none", "other": "other",
}
# One-letter codes, case-sensitive; any other single letter becomes NULL.
REGION_CODES = {"W": "West", "E": "East", "S": "South", "C": "Central"}

CUSTOMER_REGIONS = ("Central", "West", "South", "East", "North")
SALES_REGIONS = ("east", "west", "central", "south", "north")

# Thresholds.
KM_OUTLIER = 500_000
SEATS_RANGE = (4, 10)
SEVERITY_BANDS = (1000, 100)  # above the first HIGH, above the second MEDIUM, else LOW
TIER_BOUNDS = (50, 25)  # anomaly score from which a claim is HIGH, MEDIUM
FLAG_FROM = 25
LONG_OPEN_DAYS = 30
TOP_K = 4

# Text patterns.
LABEL_PATTERN = r"(Insurance[_ ]\d+)"
FILE_NAME_PATTERN = r"([^/]+)$"
FILE_FORMAT_PATTERN = r"\.(\w+)$"
LIMIT_PAIR_PATTERN = r"^[0-9]+/[0-9]+$"
BROKEN_TIME_PATTERN = r"^\d{2}:\d{2}\.\d$"
SWAPPED_FILE = "customers_6"
DAY_FIRST_FORMAT = "dd-MM-yyyy HH:mm"
ISO_FORMAT = "yyyy-MM-dd"

# Quarantine reasons by entity, in the order they are tested. The
# last reason of cars and of claims closes a gap: such rows passed neither the
# accepting nor the rejecting filter and were lost.
REASONS = {
    "customers": (
        "missing customer_id",
        "invalid or missing region",
        "missing or blank state",
    ),
    "cars": (
        "missing car_id",
        "missing or blank car name",
        "invalid or missing fuel type",
        "invalid or missing transmission",
        "invalid seat count — outside 4-10",
        "negative km_driven — physically impossible",
        "zero or missing mileage — physically impossible",
        "missing km_driven",
    ),
    "policy": (
        "missing policy_number",
        "missing or unparseable policy_bind_date",
        "missing or blank policy_state",
        "missing or invalid policy_csl format",
        "missing or negative deductible",
        "invalid annual_premium — zero or negative",
        "missing car_id",
        "missing customer_id",
    ),
    "sales": (
        "missing sales_id — blank or corrupt row",
        "missing or unparseable ad_placed_on date",
        "invalid selling price — zero or negative",
        "invalid or missing region",
        "missing or blank state",
        "missing car_id",
    ),
    "claims": (
        "missing claim_id — unidentifiable record",
        "missing policy_id — claim not linked to any policy",
        "missing or unparseable incident_date",
        "missing or unparseable claim_logged_on",
        "processed_on before logged_on — impossible",
        "missing or blank incident_state",
        "invalid or missing incident_severity",
        "negative claim amount — invalid",
        "invalid vehicle count — must be at least 1",
        "missing claim amount",
    ),
}

# Anomaly signals, weight and label, in the order the labels are joined.
SIGNALS = {
    "sig_high_amount": (15, "Total claim amount is in the top 5% across all claims"),
    "sig_rejected_with_payout": (
        30, "Claim was marked rejected yet still carries a non-zero payout"),
    "sig_no_witnesses_multi_vehicle": (
        20, "Multi-vehicle incident with no witnesses on record"),
    "sig_damage_no_police": (25, "Property damage reported but no police report filed"),
    "sig_extreme_severity": (10, "Extreme bodily injuries or unusually high vehicle count"),
    "sig_long_open_claim": (10, "Claim has been open and unprocessed for more than 30 days"),
}

# Header variants of the customer files, lower-cased, first non-NULL wins.
CUSTOMER_VARIANTS = {
    "customer_id": ("customerid", "customer_id", "cust_id"),
    "region": ("reg", "region"),
    "city": ("city", "city_in_state"),
    "education": ("education", "edu"),
    "marital_status": ("marital_status", "marital"),
}

# Reasons of the second form of the sales rules, in the order they are tested.
# In this form a listing without a sale fails too.
SOLD_SALES_REASONS = (
    "missing sales_id — blank or partial row",
    "missing ad placement date",
    "missing sold date",
    "invalid selling price — zero or negative",
    "invalid or missing region",
    "missing or blank state",
    "missing car_id",
)

# File patterns of the five entities. Sales files come in both cases.
FILE_PATTERNS = {
    "customers": "customers_*.csv",
    "sales": "*[Ss]ales_*.csv",
    "claims": "claims_*.json",
    "cars": "cars*.csv",
    "policy": "policy*.csv",
}

# Raw columns of the five entities (all strings). The customer list
# is the union of the header variants.
RAW_COLUMNS = {
    "customers": (
        "CustomerID", "Customer_ID", "cust_id", "Reg", "Region", "State", "City",
        "City_in_state", "Education", "Edu", "Marital_status", "Marital", "Job",
        "Default", "HHInsurance", "CarLoan", "Balance"),
    "cars": (
        "car_id", "name", "km_driven", "fuel", "transmission", "mileage", "engine",
        "max_power", "torque", "seats", "model"),
    "policy": (
        "policy_number", "policy_bind_date", "policy_state", "policy_csl",
        "policy_deductable", "policy_annual_premium", "umbrella_limit", "car_id",
        "customer_id"),
    "sales": (
        "sales_id", "ad_placed_on", "sold_on", "original_selling_price", "Region",
        "State", "City", "seller_type", "owner", "car_id"),
    "claims": (
        "ClaimID", "PolicyID", "incident_date", "Claim_Logged_On", "Claim_Processed_On",
        "Claim_Rejected", "incident_state", "incident_city", "incident_location",
        "incident_severity", "incident_type", "collision_type", "authorities_contacted",
        "bodily_injuries", "injury", "property", "vehicle", "witnesses",
        "number_of_vehicles_involved", "police_report_available", "property_damage"),
}

PROVENANCE = ("_source_file", "_ingest_time")


def raw_schema(entity: str) -> T.StructType:
    """All-string schema of one raw entity."""
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[entity]])


# Output columns of the report tables, as DDL.
DQ_REPORT = (
    "issue_id string, table_name string, column_name string, severity string, "
    "affected_records int, entity string, quarantine_reason string, explanation string, "
    "model_name string, generation_status string, generated_at timestamp")
ENTITY_REPORT = (
    "entity string, total_failed int, explanation string, generation_status string, "
    "generated_at timestamp")
ANOMALY_REPORT = (
    "claim_id int, anomaly_score int, priority_tier string, total_claim_amount double, "
    "incident_severity string, incident_type string, signals_fired string, "
    "investigator_brief string, generation_status string, generated_at timestamp")
RETRIEVAL_HISTORY = (
    "query_id string, question string, answer string, source_policies string, "
    "confidence_score float, avg_confidence float, chunks_retrieved float, "
    "policy_found boolean, queried_at timestamp")
INSIGHTS = (
    "insight_id string, domain_name string, summary_title string, target_audience string, "
    "ai_generated_summary string, kpi_json string, model_name string, status string, "
    "generated_at timestamp")
