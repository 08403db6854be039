"""Cleaned entities, their rules, and the routing into silver and quarantine."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assayline import contracts as K
from assayline.functions import clean as C
from assayline.functions import flags as W
from assayline.operators import rules as R
from assayline.operators.rules import Rule
from assayline.session import wide_selects


def lower_names(df: DataFrame) -> DataFrame:
    """All column names in lower case; columns that are so already are left alone."""
    return df.select(*[F.col(f"`{c}`") if c == c.lower() else F.col(f"`{c}`").alias(c.lower())
                       for c in df.columns])


def with_default(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds the column unless it is there."""
    have = {c.lower() for c in df.columns}
    return df if name.lower() in have else df.withColumn(name, value)


# ---------------------------------------------------------------------------
# Cleaning. `id_type` widens the ids where a table outgrows 32 bits. Raw columns are
# addressed in lower case, which Spark matches to any spelling, and get their names
# in the select: renaming them all first would make the optimizer restate every
# filter on the raw rows once per combination of old and new names.
# ---------------------------------------------------------------------------
def clean_customers(bronze: DataFrame, id_type: str = "int") -> DataFrame:
    df = bronze
    # the one file with these two columns exchanged is put right before variants merge
    if {"education", "marital_status"} <= {c.lower() for c in df.columns}:
        df = df.withColumns(C.swapped("education", "marital_status",
                                      F.col("_source_file").contains(K.SWAPPED_FILE)))
    types = {"customer_id": id_type}
    df = df.withColumns({
        name: C.first_present(df.columns, variants, types.get(name, "string"))
        for name, variants in K.CUSTOMER_VARIANTS.items()})
    for name in ("job", "state", "default", "hhinsurance", "carloan", "balance"):
        df = with_default(df, name, F.lit(None).cast("string"))

    def not_na(c):
        return C.null_token(c, "NA", fold_case=True)

    marital = C.vocabulary(not_na("marital_status"), K.MARITAL)
    df = df.select(
        "customer_id", F.col("state").alias("state"), "city",
        C.vocabulary("region", K.REGIONS).alias("region"),
        marital.alias("marital_status"),
        C.vocabulary(not_na("education"), K.EDUCATION).alias("education"),
        F.lower(C.without_trailing_dot(not_na("job"))).alias("job"),
        F.col("default").try_cast("int").alias("has_default"),
        F.col("balance").try_cast("decimal(10,2)").alias("balance"),
        F.col("hhinsurance").try_cast("int").alias("has_home_insurance"),
        F.col("carloan").try_cast("int").alias("has_car_loan"),
        *K.PROVENANCE)
    return df.select(
        "customer_id", "state", "city", "region",
        "marital_status",
        W.not_among("marital_status", K.MARITAL.values()).alias("marital_status_warning"),
        "education", "job",
        "has_default", W.not_among("has_default", (0, 1)).alias("default_warning"),
        "balance", W.negative("balance").alias("balance_negative_flag"),
        "has_home_insurance",
        W.not_among("has_home_insurance", (0, 1)).alias("insurance_warning"),
        "has_car_loan", W.not_among("has_car_loan", (0, 1)).alias("carloan_warning"),
        *K.PROVENANCE)


def clean_cars(bronze: DataFrame, id_type: str = "int") -> DataFrame:
    df = bronze.select(
        F.col("car_id").try_cast(id_type).alias("car_id"),
        F.trim("name").alias("car_name"),
        C.vocabulary("fuel", K.FUEL).alias("fuel"),
        C.vocabulary("transmission", K.TRANSMISSION).alias("transmission"),
        F.col("seats").try_cast("int").alias("seats"),
        F.col("km_driven").try_cast("int").alias("km_driven"),
        C.first_number("mileage").alias("mileage_kmpl"),
        C.first_number("engine").alias("engine_cc"),
        C.first_number("max_power").alias("max_power_bhp"),
        C.first_number("torque").alias("torque_nm"),
        F.lower("model").alias("manufacturer"),
        *K.PROVENANCE)
    return df.select(
        "car_id", "car_name", "fuel", "transmission", "seats",
        "km_driven", W.above("km_driven", K.KM_OUTLIER).alias("km_driven_outlier_flag"),
        "mileage_kmpl",
        "engine_cc", W.missing("engine_cc").alias("engine_cc_warning"),
        "max_power_bhp", W.missing("max_power_bhp").alias("max_power_warning"),
        "torque_nm", W.missing("torque_nm").alias("torque_warning"),
        "manufacturer", *K.PROVENANCE)


def clean_policy(bronze: DataFrame, id_type: str = "int", limit_scale: int = 1) -> DataFrame:
    """`limit_scale` 1 keeps the limits in raw units; 1000 gives the older dollar form."""
    def limit(i):
        if limit_scale == 1:
            return C.pair_part("policy_csl", i)
        return C.pair_part_scaled("policy_csl", i, limit_scale)

    df = bronze.select(
        F.col("policy_number").try_cast(id_type).alias("policy_number"),
        C.iso_date("policy_bind_date").alias("policy_bind_date"),
        F.upper(F.trim("policy_state")).alias("policy_state"),
        F.col("policy_csl").alias("policy_csl"),
        limit(0).alias("csl_bodily_injury_per_person"),
        limit(1).alias("csl_bodily_injury_per_accident"),
        F.col("policy_deductable").try_cast("decimal(10,2)").alias("deductible"),
        F.col("policy_annual_premium").try_cast("decimal(10,2)").alias("annual_premium"),
        F.col("umbrella_limit").try_cast("bigint").alias("umbrella_limit"),
        F.col("car_id").try_cast(id_type).alias("car_id"),
        F.col("customer_id").try_cast(id_type).alias("customer_id"),
        *K.PROVENANCE)
    return df.select(
        "policy_number", "policy_bind_date", "policy_state", "policy_csl",
        "csl_bodily_injury_per_person", "csl_bodily_injury_per_accident",
        "deductible", "annual_premium",
        # the warning looks at the value before the repair
        C.null_if_negative("umbrella_limit").alias("umbrella_limit"),
        W.negative("umbrella_limit").alias("umbrella_limit_warning"),
        "car_id", "customer_id",
        F.col("policy_bind_date").isNotNull().alias("is_active"),
        *K.PROVENANCE)


def clean_sales(bronze: DataFrame, id_type: str = "int") -> DataFrame:
    df = bronze.select(
        F.col("sales_id").try_cast(id_type).alias("sales_id"),
        C.day_first_time("ad_placed_on").alias("ad_placed_on"),
        C.day_first_time("sold_on").alias("sold_on"),
        F.col("original_selling_price").try_cast("decimal(12,2)").alias("selling_price"),
        *[F.lower(F.trim(c)).alias(c) for c in ("region", "state", "city")],
        C.vocabulary("seller_type", K.SELLER_TYPES).alias("seller_type"),
        C.vocabulary("owner", K.OWNERS).alias("owner"),
        F.col("car_id").try_cast(id_type).alias("car_id"),
        *K.PROVENANCE)
    return df.select(
        "sales_id", "ad_placed_on", "sold_on",
        C.days_between("sold_on", "ad_placed_on").alias("days_to_sell"),
        "selling_price", "region", "state",
        "city", W.blank("city").alias("city_warning"),
        "seller_type", W.missing("seller_type").alias("seller_type_warning"),
        "owner", W.missing("owner").alias("owner_warning"),
        C.by_presence("sold_on", "sold", "listed").alias("sale_status"),
        F.col("sold_on").isNotNull().alias("is_sold"),
        "car_id", *K.PROVENANCE)


def clean_claims(bronze: DataFrame, id_type: str = "int") -> DataFrame:
    """Claims with ISO dates. Clock fragments left in the date columns give NULL."""
    return derive_claims(typed_claims(bronze, id_type))


def typed_claims(bronze: DataFrame, id_type: str = "int") -> DataFrame:
    """The columns read from the raw record, in the order of the clean table."""
    return bronze.select(
        F.col("claimid").try_cast(id_type).alias("claim_id"),
        F.col("policyid").try_cast(id_type).alias("policy_id"),
        C.iso_date("incident_date").alias("incident_date"),
        C.iso_date("claim_logged_on").alias("claim_logged_on"),
        C.iso_date(C.null_token("claim_processed_on", "NULL", fold_case=True))
        .alias("claim_processed_on"),
        F.upper(F.trim("incident_state")).alias("incident_state"),
        F.col("incident_city").alias("city"),
        F.col("incident_location").alias("incident_location"),
        C.vocabulary("incident_severity", K.SEVERITIES).alias("incident_severity"),
        C.vocabulary("incident_type", K.INCIDENT_TYPES).alias("incident_type"),
        C.vocabulary(C.null_token("collision_type", "?"), K.COLLISIONS).alias("collision_type"),
        C.y_n("claim_rejected").alias("is_rejected"),
        C.vocabulary("authorities_contacted", K.AUTHORITIES).alias("authorities_contacted"),
        C.number("bodily_injuries", "int").alias("bodily_injuries"),
        F.col("number_of_vehicles_involved").try_cast("int").alias("number_of_vehicles_involved"),
        C.number("witnesses", "int").alias("witnesses"),
        C.yes_no("police_report_available").alias("police_report_available"),
        C.yes_no("property_damage").alias("property_damage"),
        C.number("injury", "decimal(10,2)").alias("injury_amount"),
        C.number("property", "decimal(10,2)").alias("property_amount"),
        C.number("vehicle", "decimal(10,2)").alias("vehicle_amount"),
        *K.PROVENANCE)


def derive_claims(typed: DataFrame, *more: str) -> DataFrame:
    """Adds what follows from columns further left; `more` names columns to be kept as they are."""
    days = C.days_between("claim_processed_on", "claim_logged_on")
    return typed.select(
        "claim_id", "policy_id", "incident_date", "claim_logged_on",
        "claim_processed_on", W.missing("claim_processed_on").alias("claim_processed_on_warning"),
        days.alias("days_to_process"), W.missing(days).alias("days_to_process_warning"),
        C.by_presence("claim_processed_on", "closed", "open").alias("claim_status"),
        "incident_state", "city", "incident_location", "incident_severity", "incident_type",
        "collision_type", W.missing("collision_type").alias("collision_type_warning"),
        "is_rejected", "authorities_contacted",
        "bodily_injuries",
        W.missing_or_negative("bodily_injuries").alias("bodily_injuries_warning"),
        "number_of_vehicles_involved", "witnesses",
        "police_report_available", "property_damage",
        "injury_amount", "property_amount", "vehicle_amount",
        C.total("injury_amount", "property_amount", "vehicle_amount").alias("total_claim_amount"),
        *K.PROVENANCE, *more)


def broken_claim_times(bronze: DataFrame) -> DataFrame:
    """Older claim files, whose date columns hold clock fragments: what can be saved."""
    df = bronze
    parts = {c: C.without_broken_time(C.null_token(c, "NULL", fold_case=True))
             for c in ("incident_date", "claim_logged_on", "claim_processed_on")}
    return df.select(
        F.col("claimid").alias("claimid"),
        C.salvaged_duration("claim_logged_on", "claim_processed_on").alias("days_to_process"),
        C.leading_digits("incident_date").alias("incident_minute"),
        *[e.alias(c) for c, e in parts.items()],
        *[C.clock_time(c).alias(f"{c}_time") for c in parts],
        *[W.parse_loss(c, C.clock_time(c)).alias(f"{c}_warning") for c in parts])


# ---------------------------------------------------------------------------
# Rules, in the order they are tested.
# ---------------------------------------------------------------------------
def _rules(entity: str, *conditions: Column) -> list[Rule]:
    reasons = K.REASONS[entity]
    if len(reasons) != len(conditions):
        raise ValueError(f"{entity}: {len(reasons)} reasons for {len(conditions)} conditions")
    return [Rule(r, c) for r, c in zip(reasons, conditions, strict=True)]


def _none(c: str) -> Column:
    return F.col(c).isNull()


def customer_rules() -> list[Rule]:
    return _rules(
        "customers",
        _none("customer_id"),
        W.is_outside("region", K.CUSTOMER_REGIONS),
        W.is_blank("state"))


def car_rules() -> list[Rule]:
    return _rules(
        "cars",
        _none("car_id"),
        W.is_blank("car_name"),
        W.is_outside("fuel", K.FUEL.values()),
        W.is_outside("transmission", K.TRANSMISSION.values()),
        _none("seats") | ~F.col("seats").between(*K.SEATS_RANGE),
        F.col("km_driven") < 0,
        _no_mileage(),
        _none("km_driven"))


def _no_mileage() -> Column:
    return _none("mileage_kmpl") | (F.col("mileage_kmpl") <= 0)


def policy_rules() -> list[Rule]:
    return _rules(
        "policy",
        _none("policy_number"),
        _none("policy_bind_date"),
        W.is_blank("policy_state"),
        _none("policy_csl") | ~F.col("policy_csl").rlike(K.LIMIT_PAIR_PATTERN),
        _none("deductible") | (F.col("deductible") < 0),
        _none("annual_premium") | (F.col("annual_premium") <= 0),
        _none("car_id"),
        _none("customer_id"))


def sales_rules() -> list[Rule]:
    return _rules(
        "sales",
        _none("sales_id"),
        _none("ad_placed_on"),
        _none("selling_price") | (F.col("selling_price") <= 0),
        W.is_outside("region", K.SALES_REGIONS),
        W.is_blank("state"),
        _none("car_id"))


def sold_sales_rules() -> list[Rule]:
    """Second form: only listings that were sold pass."""
    conditions = [r.condition() for r in sales_rules()]
    conditions.insert(2, _none("sold_on"))
    return [Rule(r, c) for r, c in zip(K.SOLD_SALES_REASONS, conditions, strict=True)]


def claim_rules() -> list[Rule]:
    return _rules(
        "claims",
        _none("claim_id"),
        _none("policy_id"),
        _none("incident_date"),
        _none("claim_logged_on"),
        F.col("days_to_process") < 0,
        W.is_blank("incident_state"),
        W.is_outside("incident_severity", K.SEVERITIES.values()),
        (F.col("injury_amount") < 0) | (F.col("property_amount") < 0),
        _none("number_of_vehicles_involved") | (F.col("number_of_vehicles_involved") < 1),
        _none("injury_amount") | _none("property_amount"))


# ---------------------------------------------------------------------------
# Entities.
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Entity:
    """`typed` and `derive` are the two halves of `clean` where each derived column follows from
    columns further left. Such a column never decides between two rows of a key, so duplicates
    are marked on the first half alone, and the derived columns are neither exchanged nor sorted.
    """

    name: str
    key: str
    clean: Callable[..., DataFrame]
    rules: Callable[[], Sequence[Rule]]
    drop_when: Callable[[], Column] | None = None  # rows beyond repair
    typed: Callable[..., DataFrame] | None = None
    derive: Callable[..., DataFrame] | None = None

    def tagged(self, bronze: DataFrame, **options) -> DataFrame:
        wide_selects(bronze.sparkSession)
        return R.tag((self.typed or self.clean)(bronze, **options), self.key, self.rules(),
                     self.drop_when() if self.drop_when else None, self.derive)


ENTITIES = {
    e.name: e for e in (
        Entity("customers", "customer_id", clean_customers, customer_rules),
        Entity("cars", "car_id", clean_cars, car_rules,
               lambda: (F.col("km_driven") < 0) | _no_mileage()),
        Entity("policy", "policy_number", clean_policy, policy_rules),
        Entity("sales", "sales_id", clean_sales, sales_rules),
        Entity("claims", "claim_id", clean_claims, claim_rules,
               lambda: _none("claim_id") | _none("policy_id"),
               typed_claims, derive_claims),
    )
}


#: Sales under the second form of their rules.
SOLD_SALES = replace(ENTITIES["sales"], rules=sold_sales_rules)


def silver(bronze: DataFrame, entity: str, **options) -> DataFrame:
    return R.passed(ENTITIES[entity].tagged(bronze, **options))


def quarantine(bronze: DataFrame, entity: str, stamp: bool = True, **options) -> DataFrame:
    return R.rejected(ENTITIES[entity].tagged(bronze, **options), stamp)


def build(spark: SparkSession, bronze: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The stored tables of `build_counted`."""
    return build_counted(spark, bronze, folder)[0]


def build_counted(spark: SparkSession, bronze: Mapping[str, DataFrame],
                  folder: str) -> tuple[dict[str, DataFrame], dict[str, R.Outcome]]:
    """Writes each entity once, split by outcome, and returns the stored tables and what was
    counted in the writes.

    Cleaning, duplicate marking and rules run a single time per entity; silver and
    quarantine are two partitions of the same write, so they cannot disagree, and
    reading one of them skips the files of the other. Rows are counted by outcome as
    they are written: log and reconciliation cost no further pass. An entity whose
    outcomes do not add up to its rows is an error.
    """
    out, counts = {}, {}
    for name, df in bronze.items():
        e = ENTITIES[name]
        path = f"{folder}/{name}"
        seen = Observation(f"outcomes of {name}")
        reasons = [f"duplicate {e.key}", *[r.reason for r in e.rules()]]
        tagged = e.tagged(df).observe(seen, *R.outcome_counts(reasons))
        (tagged.withColumn(R.STAMP, F.current_timestamp())
         .withColumn("outcome", F.when(F.col(R.REASON).isNull(), "silver").otherwise("quarantine"))
         .write.mode("overwrite").partitionBy("outcome").parquet(path))
        counts[name] = R.outcome_of(name, reasons, seen.get)
        schema = tagged.withColumns({R.STAMP: F.current_timestamp(), "outcome": F.lit("")}).schema
        stored = spark.read.schema(schema).parquet(path)
        out[f"silver_{name}"] = (stored.filter("outcome = 'silver'")
                                 .drop("outcome", R.REASON, R.KIND, R.STAMP))
        out[f"quarantine_{name}"] = stored.filter("outcome = 'quarantine'").drop("outcome")
    return out, counts


# ---------------------------------------------------------------------------
# Older rule sets: reasons without a type, rows before duplicate removal. Fixed
# values: conditions and reasons, in the order they are tested.
# ---------------------------------------------------------------------------
OLDER_RULES = {
    "customers": [
        Rule("missing customer_id", "customer_id is null"),
        Rule("invalid or missing region", "region not in ('Central', 'West', 'South', 'East')"),
        Rule("missing balance", "balance is null"),
    ],
    "cars": [Rule("missing car_id", "car_id is null")],
    "policy": [
        Rule("missing policy_number", "policy_number is null"),
        Rule("missing car_id", "car_id is null"),
        Rule("missing customer_id", "customer_id is null"),
        Rule("invalid annual premium", "annual_premium <= 0"),
        Rule("negative umbrella_limit", "umbrella_limit < 0"),
    ],
    "sales": [
        Rule("missing sales_id — blank or partial row", "sales_id is null"),
        Rule("missing car_id", "car_id is null"),
        Rule("invalid selling price", "selling_price is null or selling_price <= 0"),
        Rule("missing ad placement date", "ad_placed_on is null"),
    ],
    "claims": [
        Rule("missing claim_id", "claim_id is null"),
        Rule("missing policy_id", "policy_id is null"),
        Rule("zero or negative total claim amount", "total_claim_amount <= 0"),
        Rule("unknown rejection status", "is_rejected is null"),
    ],
}

# Expectations of the older tables, conditions that should hold.
EXPECTATIONS = {
    "customers": {
        "drop": {"valid_customer_id": "customer_id IS NOT NULL"},
        "warn": {"valid_region": "region IN ('Central', 'West', 'South', 'East')",
                 "balance_present": "balance IS NOT NULL"}},
    "cars": {
        "drop": {"valid_car_id": "car_id IS NOT NULL"},
        "warn": {"km_driven_outlier": "km_driven_outlier_flag = 0"}},
    "policy": {
        "drop": {"valid_policy_number": "policy_number IS NOT NULL",
                 "valid_car_id": "car_id IS NOT NULL",
                 "valid_customer_id": "customer_id IS NOT NULL"},
        "warn": {"valid_premium": "annual_premium > 0",
                 "valid_umbrella_limit": "umbrella_limit IS NULL OR umbrella_limit >= 0"}},
    "sales": {
        "drop": {"valid_sales_id": "sales_id IS NOT NULL", "valid_car_id": "car_id IS NOT NULL"},
        "warn": {"valid_selling_price": "selling_price > 0",
                 "valid_ad_date": "ad_placed_on IS NOT NULL"}},
    "claims": {
        "drop": {"valid_claim_id": "claim_id IS NOT NULL",
                 "valid_policy_id": "policy_id IS NOT NULL"},
        "warn": {"valid_total_claim": "total_claim_amount > 0",
                 "rejection_status_known": "is_rejected IS NOT NULL"}},
}
