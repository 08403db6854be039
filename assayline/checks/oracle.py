"""The registered queries restated as SQL for another engine.

Shared steps are named subqueries; each statement takes those it needs. They start
from the raw records of `raw` and say the rules in their own words.
"""

from __future__ import annotations

from assayline.checks import raw

ORACLE: dict[str, str] = {}
_STEPS: dict[str, tuple[str, tuple[str, ...]]] = {}


def _step(name: str, sql: str, *needs: str) -> None:
    _STEPS[name] = (sql.strip(), needs)


def _needed(name: str, seen: list[str]) -> list[str]:
    for n in _STEPS[name][1]:
        _needed(n, seen)
    if name not in seen:
        seen.append(name)
    return seen


def _put(name: str, sql: str, *needs: str) -> None:
    order: list[str] = []
    for n in needs:
        _needed(n, order)
    # Steps that several parts read are computed once.
    steps = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in ('silver_claims', 'limits') else ''}({_STEPS[n][0]})"
                       for n in order)
    ORACLE[name] = (f"WITH {steps}\n" if steps else "") + sql.strip()


def _raw(entity: str) -> str:
    sql = raw.RAW[entity].replace("{q}", '"')
    for t in raw.TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql


# --- raw and cleaned records ------------------------------------------------
for _e in raw.RAW:
    _step(f"raw_{_e}", _raw(_e))

_step("clean_customers", """
SELECT customer_id, state, city,
  CASE lower(region) WHEN 'c' THEN 'Central' WHEN 'central' THEN 'Central' WHEN 'w' THEN 'West'
    WHEN 'west' THEN 'West' WHEN 's' THEN 'South' WHEN 'south' THEN 'South' WHEN 'e' THEN 'East'
    WHEN 'east' THEN 'East' WHEN 'n' THEN 'North' WHEN 'north' THEN 'North' END AS region,
  m AS marital_status, CASE WHEN m IS NULL THEN 1 ELSE 0 END AS marital_status_warning,
  CASE lower(edu) WHEN 'primary' THEN 'primary' WHEN 'secondary' THEN 'secondary'
    WHEN 'tertiary' THEN 'tertiary' WHEN 'terto' THEN 'tertiary' END AS education,
  CASE WHEN upper(job) <> 'NA' THEN lower(CASE WHEN right(job, 1) = '.'
    THEN left(job, length(job) - 1) ELSE job END) END AS job,
  d AS has_default, CASE WHEN d IN (0, 1) THEN 0 ELSE 1 END AS default_warning,
  balance, CASE WHEN balance < 0 THEN 1 ELSE 0 END AS balance_negative_flag,
  h AS has_home_insurance, CASE WHEN h IN (0, 1) THEN 0 ELSE 1 END AS insurance_warning,
  l AS has_car_loan, CASE WHEN l IN (0, 1) THEN 0 ELSE 1 END AS carloan_warning,
  _source_file, _ingest_time
FROM (
  SELECT *, CASE WHEN lower(mar) IN ('married', 'single', 'divorced', 'widow', 'separated')
      THEN lower(mar) END AS m
  FROM (
    SELECT COALESCE(TRY_CAST(CustomerID AS INTEGER), TRY_CAST(Customer_ID AS INTEGER),
        TRY_CAST(cust_id AS INTEGER)) AS customer_id,
      State AS state, COALESCE(City, City_in_state) AS city, COALESCE(Reg, Region) AS region,
      COALESCE(CASE WHEN contains(_source_file, 'customers_6') THEN Marital_status
        ELSE Education END, Edu) AS edu,
      COALESCE(CASE WHEN contains(_source_file, 'customers_6') THEN Education
        ELSE Marital_status END, Marital) AS mar,
      Job AS job, TRY_CAST("Default" AS INTEGER) AS d, TRY_CAST(HHInsurance AS INTEGER) AS h,
      TRY_CAST(CarLoan AS INTEGER) AS l, TRY_CAST(Balance AS DECIMAL(10,2)) AS balance,
      _source_file, _ingest_time
    FROM raw_customers))
""", "raw_customers")

_step("clean_cars", r"""
SELECT car_id, car_name, fuel, transmission, seats, km_driven,
  CASE WHEN km_driven > 500000 THEN 1 ELSE 0 END AS km_driven_outlier_flag, mileage_kmpl,
  engine_cc, CASE WHEN engine_cc IS NULL THEN 1 ELSE 0 END AS engine_cc_warning,
  max_power_bhp, CASE WHEN max_power_bhp IS NULL THEN 1 ELSE 0 END AS max_power_warning,
  torque_nm, CASE WHEN torque_nm IS NULL THEN 1 ELSE 0 END AS torque_warning,
  manufacturer, _source_file, _ingest_time
FROM (
  SELECT TRY_CAST(car_id AS INTEGER) AS car_id, trim(name) AS car_name,
    CASE WHEN lower(fuel) IN ('petrol', 'diesel', 'electric', 'hybrid', 'cng', 'lpg')
      THEN lower(fuel) END AS fuel,
    CASE WHEN lower(transmission) IN ('manual', 'automatic') THEN lower(transmission) END
      AS transmission,
    TRY_CAST(seats AS INTEGER) AS seats, TRY_CAST(km_driven AS INTEGER) AS km_driven,
    TRY_CAST(regexp_extract(replace(mileage, ',', ''), '\d+\.?\d*') AS DOUBLE) AS mileage_kmpl,
    TRY_CAST(regexp_extract(replace(engine, ',', ''), '\d+\.?\d*') AS DOUBLE) AS engine_cc,
    TRY_CAST(regexp_extract(replace(max_power, ',', ''), '\d+\.?\d*') AS DOUBLE)
      AS max_power_bhp,
    TRY_CAST(regexp_extract(replace(torque, ',', ''), '\d+\.?\d*') AS DOUBLE) AS torque_nm,
    lower(model) AS manufacturer, _source_file, _ingest_time
  FROM raw_cars)
""", "raw_cars")

_step("clean_policy", """
SELECT TRY_CAST(policy_number AS INTEGER) AS policy_number,
  CAST(TRY_STRPTIME(policy_bind_date, '%Y-%m-%d') AS DATE) AS policy_bind_date,
  upper(trim(policy_state)) AS policy_state, policy_csl,
  TRY_CAST(split_part(policy_csl, '/', 1) AS INTEGER) AS csl_bodily_injury_per_person,
  TRY_CAST(split_part(policy_csl, '/', 2) AS INTEGER) AS csl_bodily_injury_per_accident,
  TRY_CAST(policy_deductable AS DECIMAL(10,2)) AS deductible,
  TRY_CAST(policy_annual_premium AS DECIMAL(10,2)) AS annual_premium,
  CASE WHEN TRY_CAST(umbrella_limit AS BIGINT) >= 0 THEN TRY_CAST(umbrella_limit AS BIGINT) END
    AS umbrella_limit,
  CASE WHEN TRY_CAST(umbrella_limit AS BIGINT) < 0 THEN 1 ELSE 0 END AS umbrella_limit_warning,
  TRY_CAST(car_id AS INTEGER) AS car_id, TRY_CAST(customer_id AS INTEGER) AS customer_id,
  TRY_STRPTIME(policy_bind_date, '%Y-%m-%d') IS NOT NULL AS is_active, _source_file, _ingest_time
FROM raw_policy
""", "raw_policy")

_step("clean_sales", """
SELECT sales_id, ad_placed_on, sold_on,
  date_diff('day', CAST(ad_placed_on AS DATE), CAST(sold_on AS DATE)) AS days_to_sell,
  selling_price, region, state, city,
  CASE WHEN city IS NULL OR city = '' THEN 1 ELSE 0 END AS city_warning,
  seller_type, CASE WHEN seller_type IS NULL THEN 1 ELSE 0 END AS seller_type_warning,
  owner, CASE WHEN owner IS NULL THEN 1 ELSE 0 END AS owner_warning,
  CASE WHEN sold_on IS NULL THEN 'listed' ELSE 'sold' END AS sale_status,
  sold_on IS NOT NULL AS is_sold, car_id, _source_file, _ingest_time
FROM (
  SELECT TRY_CAST(sales_id AS INTEGER) AS sales_id,
    TRY_STRPTIME(ad_placed_on, '%d-%m-%Y %H:%M') AS ad_placed_on,
    TRY_STRPTIME(sold_on, '%d-%m-%Y %H:%M') AS sold_on,
    TRY_CAST(original_selling_price AS DECIMAL(12,2)) AS selling_price,
    lower(trim(Region)) AS region, lower(trim(State)) AS state, lower(trim(City)) AS city,
    CASE lower(seller_type) WHEN 'individual' THEN 'individual' WHEN 'dealer' THEN 'dealer'
      WHEN 'trustmark dealer' THEN 'dealer' WHEN 'company' THEN 'company' END AS seller_type,
    CASE WHEN lower(owner) IN ('first owner', 'second owner', 'third owner',
      'fourth & above owner') THEN lower(owner) END AS owner,
    TRY_CAST(car_id AS INTEGER) AS car_id, _source_file, _ingest_time
  FROM raw_sales
  WHERE NOT (sales_id IS NULL AND ad_placed_on IS NULL AND sold_on IS NULL
    AND original_selling_price IS NULL AND Region IS NULL AND State IS NULL AND City IS NULL
    AND seller_type IS NULL AND owner IS NULL AND car_id IS NULL))
""", "raw_sales")

_step("clean_claims", """
SELECT claim_id, policy_id, incident_date, claim_logged_on, claim_processed_on,
  CASE WHEN claim_processed_on IS NULL THEN 1 ELSE 0 END AS claim_processed_on_warning,
  days AS days_to_process, CASE WHEN days IS NULL THEN 1 ELSE 0 END AS days_to_process_warning,
  CASE WHEN claim_processed_on IS NULL THEN 'open' ELSE 'closed' END AS claim_status,
  incident_state, city, incident_location, incident_severity, incident_type,
  collision_type, CASE WHEN collision_type IS NULL THEN 1 ELSE 0 END AS collision_type_warning,
  is_rejected, authorities_contacted, bodily_injuries,
  CASE WHEN bodily_injuries >= 0 THEN 0 ELSE 1 END AS bodily_injuries_warning,
  number_of_vehicles_involved, witnesses, police_report_available, property_damage,
  injury_amount, property_amount, vehicle_amount,
  CAST(COALESCE(injury_amount, 0) + COALESCE(property_amount, 0) + COALESCE(vehicle_amount, 0)
    AS DECIMAL(14,2)) AS total_claim_amount, _source_file, _ingest_time
FROM (
  SELECT *, CAST(date_diff('day', claim_logged_on, claim_processed_on) AS INTEGER) AS days
  FROM (
    SELECT TRY_CAST(ClaimID AS INTEGER) AS claim_id, TRY_CAST(PolicyID AS INTEGER) AS policy_id,
      CAST(TRY_STRPTIME(incident_date, '%Y-%m-%d') AS DATE) AS incident_date,
      CAST(TRY_STRPTIME(Claim_Logged_On, '%Y-%m-%d') AS DATE) AS claim_logged_on,
      CAST(TRY_STRPTIME(Claim_Processed_On, '%Y-%m-%d') AS DATE) AS claim_processed_on,
      upper(trim(incident_state)) AS incident_state, incident_city AS city, incident_location,
      CASE WHEN lower(incident_severity) IN ('minor damage', 'major damage', 'trivial damage',
        'total loss') THEN lower(incident_severity) END AS incident_severity,
      CASE WHEN lower(incident_type) IN ('single vehicle collision', 'multi-vehicle collision',
        'vehicle theft', 'parked car') THEN lower(incident_type) END AS incident_type,
      CASE WHEN lower(collision_type) IN ('rear collision', 'front collision', 'side collision')
        THEN lower(collision_type) END AS collision_type,
      CASE upper(Claim_Rejected) WHEN 'Y' THEN true WHEN 'N' THEN false END AS is_rejected,
      CASE WHEN lower(authorities_contacted) IN ('police', 'ambulance', 'fire', 'none', 'other')
        THEN lower(authorities_contacted) END AS authorities_contacted,
      TRY_CAST(bodily_injuries AS INTEGER) AS bodily_injuries,
      TRY_CAST(number_of_vehicles_involved AS INTEGER) AS number_of_vehicles_involved,
      TRY_CAST(witnesses AS INTEGER) AS witnesses,
      CASE upper(police_report_available) WHEN 'YES' THEN true WHEN 'NO' THEN false END
        AS police_report_available,
      CASE upper(property_damage) WHEN 'YES' THEN true WHEN 'NO' THEN false END
        AS property_damage,
      TRY_CAST(injury AS DECIMAL(10,2)) AS injury_amount,
      TRY_CAST(property AS DECIMAL(10,2)) AS property_amount,
      TRY_CAST(vehicle AS DECIMAL(10,2)) AS vehicle_amount, _source_file, _ingest_time
    FROM raw_claims))
""", "raw_claims")

# --- outcome of every record ------------------------------------------------
# Columns after the key, in the order that decides between equal times and files.
# A mark tells how a column is shown: d date, t time, n decimal.
_COLUMNS = {
    "customers": ("customer_id", "state city region marital_status marital_status_warning "
                  "education job has_default default_warning balance:n balance_negative_flag "
                  "has_home_insurance insurance_warning has_car_loan carloan_warning"),
    "cars": ("car_id", "car_name fuel transmission seats km_driven km_driven_outlier_flag "
             "mileage_kmpl engine_cc engine_cc_warning max_power_bhp max_power_warning torque_nm "
             "torque_warning manufacturer"),
    "policy": ("policy_number", "policy_bind_date:d policy_state policy_csl "
               "csl_bodily_injury_per_person csl_bodily_injury_per_accident deductible:n "
               "annual_premium:n umbrella_limit umbrella_limit_warning car_id customer_id "
               "is_active"),
    "sales": ("sales_id", "ad_placed_on:t sold_on:t days_to_sell:i selling_price:n region state "
              "city city_warning seller_type seller_type_warning owner owner_warning sale_status "
              "is_sold car_id"),
    "claims": ("claim_id", "policy_id incident_date:d claim_logged_on:d claim_processed_on:d "
               "claim_processed_on_warning days_to_process days_to_process_warning claim_status "
               "incident_state city incident_location incident_severity incident_type "
               "collision_type collision_type_warning is_rejected authorities_contacted "
               "bodily_injuries bodily_injuries_warning number_of_vehicles_involved witnesses "
               "police_report_available property_damage injury_amount:n property_amount:n "
               "vehicle_amount:n total_claim_amount:n"),
}
_SHOW = {"d": "CAST({0} AS VARCHAR) AS {0}", "t": "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}",
         "n": "CAST({0} AS DOUBLE) AS {0}", "i": "CAST({0} AS INTEGER) AS {0}", "": "{0}"}


def _show(columns: str) -> str:
    parts = [c.partition(":") for c in columns.split()]
    return ", ".join(_SHOW[mark].format(name) for name, _, mark in parts)


_REASON = {
    "customers": """
      WHEN customer_id IS NULL THEN 'missing customer_id'
      WHEN region IS NULL THEN 'invalid or missing region'
      WHEN state IS NULL OR trim(state) = '' THEN 'missing or blank state'""",
    "cars": """
      WHEN car_id IS NULL THEN 'missing car_id'
      WHEN car_name IS NULL OR car_name = '' THEN 'missing or blank car name'
      WHEN fuel IS NULL THEN 'invalid or missing fuel type'
      WHEN transmission IS NULL THEN 'invalid or missing transmission'
      WHEN seats IS NULL OR seats < 4 OR seats > 10 THEN 'invalid seat count — outside 4-10'
      WHEN km_driven < 0 THEN 'negative km_driven — physically impossible'
      WHEN mileage_kmpl IS NULL OR mileage_kmpl <= 0
        THEN 'zero or missing mileage — physically impossible'
      WHEN km_driven IS NULL THEN 'missing km_driven'""",
    "policy": """
      WHEN policy_number IS NULL THEN 'missing policy_number'
      WHEN policy_bind_date IS NULL THEN 'missing or unparseable policy_bind_date'
      WHEN policy_state IS NULL OR policy_state = '' THEN 'missing or blank policy_state'
      WHEN policy_csl IS NULL OR NOT regexp_full_match(policy_csl, '[0-9]+/[0-9]+')
        THEN 'missing or invalid policy_csl format'
      WHEN deductible IS NULL OR deductible < 0 THEN 'missing or negative deductible'
      WHEN annual_premium IS NULL OR annual_premium <= 0
        THEN 'invalid annual_premium — zero or negative'
      WHEN car_id IS NULL THEN 'missing car_id'
      WHEN customer_id IS NULL THEN 'missing customer_id'""",
    "sales": """
      WHEN sales_id IS NULL THEN 'missing sales_id — blank or corrupt row'
      WHEN ad_placed_on IS NULL THEN 'missing or unparseable ad_placed_on date'
      WHEN selling_price IS NULL OR selling_price <= 0
        THEN 'invalid selling price — zero or negative'
      WHEN region IS NULL OR region NOT IN ('east', 'west', 'central', 'south', 'north')
        THEN 'invalid or missing region'
      WHEN state IS NULL OR state = '' THEN 'missing or blank state'
      WHEN car_id IS NULL THEN 'missing car_id'""",
    "claims": """
      WHEN claim_id IS NULL THEN 'missing claim_id — unidentifiable record'
      WHEN policy_id IS NULL THEN 'missing policy_id — claim not linked to any policy'
      WHEN incident_date IS NULL THEN 'missing or unparseable incident_date'
      WHEN claim_logged_on IS NULL THEN 'missing or unparseable claim_logged_on'
      WHEN days_to_process < 0 THEN 'processed_on before logged_on — impossible'
      WHEN incident_state IS NULL OR incident_state = '' THEN 'missing or blank incident_state'
      WHEN incident_severity IS NULL THEN 'invalid or missing incident_severity'
      WHEN injury_amount < 0 OR property_amount < 0 THEN 'negative claim amount — invalid'
      WHEN number_of_vehicles_involved IS NULL OR number_of_vehicles_involved < 1
        THEN 'invalid vehicle count — must be at least 1'
      WHEN injury_amount IS NULL OR property_amount IS NULL THEN 'missing claim amount'""",
}
_DROP = {
    "cars": "km_driven < 0 OR mileage_kmpl IS NULL OR mileage_kmpl <= 0",
    "claims": "claim_id IS NULL OR policy_id IS NULL",
}

for _e, (_key, _cols) in _COLUMNS.items():
    _tie = ", ".join(c.partition(":")[0] + " ASC NULLS FIRST" for c in _cols.split())
    _step(f"tagged_{_e}", f"""
SELECT *, CASE WHEN {_key} IS NOT NULL AND nth > 1 THEN 'drop' WHEN quarantine_reason IS NULL
    THEN NULL WHEN {_DROP.get(_e, 'false')} THEN 'drop' ELSE 'quarantine' END AS quarantine_type
FROM (SELECT *, CASE WHEN {_key} IS NOT NULL AND nth > 1 THEN 'duplicate {_key}'{_REASON[_e]}
      END AS quarantine_reason
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {_key} ORDER BY _ingest_time DESC,
      _source_file DESC, {_tie}) AS nth FROM clean_{_e}))""", f"clean_{_e}")
    _step(f"silver_{_e}", f"SELECT * FROM tagged_{_e} WHERE quarantine_reason IS NULL",
          f"tagged_{_e}")
    _shown = f"{_show(_key + ' ' + _cols)}, _source_file"
    _put(f"silver_{_e}", f"SELECT {_shown} FROM silver_{_e}", f"silver_{_e}")
    _put(f"quarantine_{_e}", f"""SELECT {_shown}, quarantine_reason, quarantine_type
FROM tagged_{_e} WHERE quarantine_reason IS NOT NULL""", f"tagged_{_e}")

# the second form of the sales rules, on the same survivors
_put("sold_sales_log", """SELECT 'sales' AS entity, 'silver.quarantine_sales' AS quarantine_table, quarantine_reason,
  CASE WHEN quarantine_reason = 'duplicate sales_id' THEN 'drop' ELSE 'quarantine' END AS quarantine_type,
  count(*) AS failed_record_count
FROM (SELECT CASE WHEN quarantine_reason = 'duplicate sales_id' THEN quarantine_reason
    WHEN sales_id IS NULL THEN 'missing sales_id — blank or partial row'
    WHEN ad_placed_on IS NULL THEN 'missing ad placement date'
    WHEN sold_on IS NULL THEN 'missing sold date'
    WHEN selling_price IS NULL OR selling_price <= 0 THEN 'invalid selling price — zero or negative'
    WHEN region IS NULL OR region NOT IN ('east', 'west', 'central', 'south', 'north') THEN 'invalid or missing region'
    WHEN state IS NULL OR trim(state) = '' THEN 'missing or blank state'
    WHEN car_id IS NULL THEN 'missing car_id' END AS quarantine_reason FROM tagged_sales)
WHERE quarantine_reason IS NOT NULL GROUP BY ALL""", "tagged_sales")

_ENTITIES = tuple(_COLUMNS)


def _each(sql: str) -> str:
    return "\nUNION ALL\n".join(sql.replace("@", e) for e in _ENTITIES)


_ALL_TAGGED = tuple(f"tagged_{e}" for e in _ENTITIES)
_step("log", _each("""SELECT '@' AS entity, 'silver.quarantine_@' AS quarantine_table,
  quarantine_reason, quarantine_type, count(*) AS failed_record_count
FROM tagged_@ WHERE quarantine_reason IS NOT NULL GROUP BY ALL"""), *_ALL_TAGGED)
_put("quality_log", "SELECT * FROM log", "log")
_put("quality_log_untyped", """SELECT entity, quarantine_table, quarantine_reason,
  CAST(sum(failed_record_count) AS BIGINT) AS failed_record_count FROM log GROUP BY ALL""", "log")
_put("flag_report", """SELECT entity, quarantine_reason, quarantine_type, failed_record_count
FROM log ORDER BY entity, failed_record_count DESC, quarantine_reason""", "log")
_put("claim_breakdown", """SELECT quarantine_reason, quarantine_type, failed_record_count AS cnt
FROM log WHERE entity = 'claims' ORDER BY cnt DESC""", "log")
_put("reconcile_counts", _each("""SELECT '@' AS entity, (SELECT count(*) FROM clean_@) AS records,
  (SELECT count(*) FROM silver_@) AS passed_records,
  count(quarantine_reason) AS failed_records FROM tagged_@"""),
     *_ALL_TAGGED, *[f"silver_{e}" for e in _ENTITIES])
_put("pass_counts", _each("SELECT '@' AS entity, count(*) AS passed_records FROM silver_@"),
     *[f"silver_{e}" for e in _ENTITIES])

_put("tag_by_sql", """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'too large'
  WHEN o_orderstatus = 'P' THEN 'pending'
  WHEN o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%' THEN 'rushed'
  ELSE 'unknown' END AS quarantine_reason FROM orders""")

_EXPECT = {
    "customers": [("valid_customer_id", "drop", "customer_id IS NOT NULL"),
                  ("valid_region", "warn", "region IN ('Central', 'West', 'South', 'East')"),
                  ("balance_present", "warn", "balance IS NOT NULL")],
    "cars": [("valid_car_id", "drop", "car_id IS NOT NULL"),
             ("km_driven_outlier", "warn", "km_driven_outlier_flag = 0")],
    "policy": [("valid_policy_number", "drop", "policy_number IS NOT NULL"),
               ("valid_car_id", "drop", "car_id IS NOT NULL"),
               ("valid_customer_id", "drop", "customer_id IS NOT NULL"),
               ("valid_premium", "warn", "annual_premium > 0"),
               ("valid_umbrella_limit", "warn", "umbrella_limit IS NULL OR umbrella_limit >= 0")],
    "sales": [("valid_sales_id", "drop", "sales_id IS NOT NULL"),
              ("valid_car_id", "drop", "car_id IS NOT NULL"),
              ("valid_selling_price", "warn", "selling_price > 0"),
              ("valid_ad_date", "warn", "ad_placed_on IS NOT NULL")],
    "claims": [("valid_claim_id", "drop", "claim_id IS NOT NULL"),
               ("valid_policy_id", "drop", "policy_id IS NOT NULL"),
               ("valid_total_claim", "warn", "total_claim_amount > 0"),
               ("rejection_status_known", "warn", "is_rejected IS NOT NULL")],
}
_put("expectations", "\nUNION ALL\n".join(
    f"""SELECT '{n}' AS expectation, '{a}' AS action, count(*) FILTER ({c}) AS passed_records,
  count(*) - count(*) FILTER ({c}) AS failed_records, '{e}' AS entity FROM clean_{e}"""
    for e, rules in _EXPECT.items() for n, a, c in rules), *[f"clean_{e}" for e in _ENTITIES])
_put("expected_policy", f"""SELECT {_show('policy_number ' + _COLUMNS['policy'][1])}, _source_file
FROM clean_policy
WHERE policy_number IS NOT NULL AND car_id IS NOT NULL AND customer_id IS NOT NULL""",
     "clean_policy")

_OLDER = {
    "customers": [("customer_id IS NULL", "missing customer_id"),
                  ("region NOT IN ('Central', 'West', 'South', 'East')",
                   "invalid or missing region"),
                  ("balance IS NULL", "missing balance")],
    "cars": [("car_id IS NULL", "missing car_id")],
    "policy": [("policy_number IS NULL", "missing policy_number"),
               ("car_id IS NULL", "missing car_id"),
               ("customer_id IS NULL", "missing customer_id"),
               ("annual_premium <= 0", "invalid annual premium"),
               ("umbrella_limit < 0", "negative umbrella_limit")],
    "sales": [("sales_id IS NULL", "missing sales_id — blank or partial row"),
              ("car_id IS NULL", "missing car_id"),
              ("selling_price IS NULL OR selling_price <= 0", "invalid selling price"),
              ("ad_placed_on IS NULL", "missing ad placement date")],
    "claims": [("claim_id IS NULL", "missing claim_id"),
               ("policy_id IS NULL", "missing policy_id"),
               ("total_claim_amount <= 0", "zero or negative total claim amount"),
               ("is_rejected IS NULL", "unknown rejection status")],
}
_put("older_rules_log", "\nUNION ALL\n".join(
    f"""SELECT '{e}' AS entity, 'silver.quarantine_{e}' AS quarantine_table, quarantine_reason,
  count(*) AS failed_record_count
FROM (SELECT CASE {' '.join(f"WHEN {c} THEN '{r}'" for c, r in rules)} END AS quarantine_reason
  FROM clean_{e}) WHERE quarantine_reason IS NOT NULL GROUP BY ALL"""
    for e, rules in _OLDER.items()), *[f"clean_{e}" for e in _ENTITIES])

_put("before_after_customers", """
SELECT s.customer_id, COALESCE(r.Reg, r.Region) AS region_raw,
  COALESCE(r.Education, r.Edu) AS education_raw,
  COALESCE(r.Marital_status, r.Marital) AS marital_status_raw, r.Job AS job_raw,
  s.region, s.education, s.marital_status, s.job
FROM raw_customers r JOIN silver_customers s ON s.customer_id = COALESCE(
  TRY_CAST(r.CustomerID AS INTEGER), TRY_CAST(r.Customer_ID AS INTEGER),
  TRY_CAST(r.cust_id AS INTEGER))""", "raw_customers", "silver_customers")

for _e, _key, _raw_key, _before, _after in (
    ("cars", "car_id", "car_id", "fuel transmission seats km_driven mileage",
     "fuel transmission seats km_driven mileage_kmpl"),
    ("policy", "policy_number", "policy_number", "policy_bind_date policy_state umbrella_limit",
     "policy_bind_date:d policy_state umbrella_limit umbrella_limit_warning"),
    ("sales", "sales_id", "sales_id", "ad_placed_on sold_on region owner",
     "ad_placed_on:t sold_on:t region owner sale_status"),
    ("claims", "claim_id", "ClaimID", "claim_processed_on collision_type claim_rejected",
     "claim_processed_on:d collision_type is_rejected claim_status"),
):
    _put(f"before_after_{_e}", f"""
SELECT * FROM (SELECT TRY_CAST({_raw_key} AS INTEGER) AS {_key},
  {', '.join(f'{c} AS {c}_raw' for c in _before.split())} FROM raw_{_e})
JOIN (SELECT {_key}, {_show(_after)} FROM silver_{_e}) USING ({_key})""",
         f"raw_{_e}", f"silver_{_e}")

_put("broken_claims", r"""
SELECT claimid,
  CASE WHEN b >= a AND a > 0 AND b > 0 THEN b - a END AS days_to_process, m AS incident_minute,
  CASE WHEN regexp_matches(i, '^\d\d:\d\d\.\d$') THEN NULL ELSE i END AS incident_date,
  CASE WHEN regexp_matches(l, '^\d\d:\d\d\.\d$') THEN NULL ELSE l END AS claim_logged_on,
  CASE WHEN regexp_matches(p, '^\d\d:\d\d\.\d$') OR upper(p) = 'NULL' THEN NULL ELSE p END
    AS claim_processed_on,
  NULL::VARCHAR AS incident_date_time,
  CASE WHEN l = '08:30.0' THEN '1970-01-01 08:30:00' END AS claim_logged_on_time,
  NULL::VARCHAR AS claim_processed_on_time,
  CASE WHEN i IS NOT NULL THEN 1 ELSE 0 END AS incident_date_warning,
  CASE WHEN l IS NOT NULL AND l <> '08:30.0' THEN 1 ELSE 0 END AS claim_logged_on_warning,
  CASE WHEN p IS NOT NULL THEN 1 ELSE 0 END AS claim_processed_on_warning
FROM (
  SELECT ClaimID AS claimid, incident_date AS i, Claim_Logged_On AS l, Claim_Processed_On AS p,
    TRY_CAST(regexp_extract(Claim_Logged_On, '^\d+') AS INTEGER) AS a,
    TRY_CAST(regexp_extract(Claim_Processed_On, '^\d+') AS INTEGER) AS b,
    TRY_CAST(regexp_extract(incident_date, '^\d+') AS INTEGER) AS m
  FROM raw_claims)""", "raw_claims")

_SEVERITY = """CASE WHEN failed_record_count > 1000 THEN 'HIGH'
  WHEN failed_record_count > 100 THEN 'MEDIUM' ELSE 'LOW' END"""
_put("dq_issue_report", f"""
SELECT entity || '|' || quarantine_reason || '|' || quarantine_type AS issue_id,
  'silver.silver_quality_log' AS table_name, quarantine_reason AS column_name,
  {_SEVERITY} AS severity, CAST(failed_record_count AS INTEGER) AS affected_records, entity,
  quarantine_reason,
  'Data Quality Issue Details:' || chr(10) || '  - Record type   : ' || entity || chr(10)
    || '  - Problem area  : ' || replace(quarantine_reason, '_', ' ') || chr(10)
    || '  - Issue detected: ' || replace(quarantine_reason, '_', ' ') || chr(10)
    || '  - Severity      : ' || {_SEVERITY} || chr(10)
    || '  - Records affected: ' || format('{{:,}}', failed_record_count) AS explanation,
  'template' AS model_name, 'success' AS generation_status
FROM log""", "log")
_put("dq_entity_report", """
SELECT entity, CAST(sum(failed_record_count) AS INTEGER) AS total_failed,
  'Entity: ' || upper(entity) || chr(10) || 'Total failed records: '
    || format('{:,}', CAST(sum(failed_record_count) AS BIGINT)) || chr(10)
    || 'Failure breakdown:' || chr(10)
    || string_agg('  • ' || replace(quarantine_reason, '_', ' ') || ': '
      || format('{:,}', failed_record_count) || ' records', chr(10)
      ORDER BY failed_record_count DESC, quarantine_reason) AS explanation,
  'success' AS generation_status
FROM log GROUP BY entity""", "log")

# --- scalar functions -------------------------------------------------------
_put("vocab_map", """SELECT c_custkey,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'AUTOMOBILE' THEN 'vehicles'
    WHEN 'MACHINERY' THEN 'vehicles' WHEN 'HOUSEHOLD' THEN 'home' END AS label,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'AUTOMOBILE' THEN 'vehicles'
    WHEN 'MACHINERY' THEN 'vehicles' WHEN 'HOUSEHOLD' THEN 'home' ELSE 'other' END
    AS label_or_other, c_mktsegment AS unmapped FROM customer""")
_put("code_expand", """SELECT CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted'
  END AS word, l_returnflag || l_linestatus AS pair, count(*) AS n FROM lineitem GROUP BY ALL""")
_put("extract_number", r"""SELECT p_partkey,
  CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand_no, NULL::DOUBLE AS name_no,
  CAST('1' || CAST(p_size AS VARCHAR) || '.5' AS DOUBLE) AS engine_cc, 1.0::DOUBLE AS engine_plain
FROM part""")
_put("split_pair", """SELECT o_orderkey, CAST(a AS INTEGER) AS left_raw,
  CAST(b AS INTEGER) AS right_raw,
  CAST(CASE WHEN b IS NOT NULL THEN a * 1000 END AS INTEGER) AS left_dollars,
  CAST(b * 1000 AS INTEGER) AS right_dollars
FROM (SELECT o_orderkey, o_custkey % 500 AS a,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 900 END AS b FROM orders)""")
_put("placeholder_cast", """
SELECT event_id, CASE WHEN k % 10 > 3 THEN k END AS as_int,
  CASE WHEN k % 10 > 3 THEN CAST(k AS DOUBLE) END AS as_amount,
  CASE WHEN k % 10 > 0 THEN t END AS no_mark,
  CASE WHEN k % 10 NOT IN (1, 3) THEN t END AS no_null,
  CASE WHEN k % 10 <> 2 THEN t END AS no_na
FROM (SELECT event_id, k, CASE k % 10 WHEN 0 THEN '?' WHEN 1 THEN 'null' WHEN 2 THEN ' NA '
    WHEN 3 THEN 'Null' ELSE CAST(k AS VARCHAR) END AS t
  FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))""")
_put("bool_map", """SELECT CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS returned,
  l_linestatus = 'O' AS is_open, l_linenumber > 3 AS late,
  CASE WHEN l_quantity > 25 THEN true WHEN l_quantity > 10 THEN false END AS bulk, count(*) AS n
FROM lineitem GROUP BY ALL""")
_put("parse_dates", """
SELECT o_orderkey, CAST(d AS VARCHAR) AS d, strftime(t, '%Y-%m-%d %H:%M:%S') AS t,
  CAST(date_diff('day', CAST(t AS DATE), d) AS INTEGER) AS days,
  CAST(strftime(d, '%Y%m%d') AS INTEGER) AS d_key,
  CASE WHEN d IS NULL THEN 'undated' ELSE 'dated' END AS status
FROM (SELECT o_orderkey,
    CASE WHEN o_orderkey % 9 > 1 THEN CAST(o_orderdate AS DATE) END AS d,
    CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderdate AS DATE) + INTERVAL 20 HOUR
      + INTERVAL 22 MINUTE END AS t FROM orders)""")
_put("broken_time", """
SELECT event_id, NULL::VARCHAR AS a_kept,
  CASE WHEN event_type = 'view' THEN day END AS b_kept,
  CASE WHEN mi < 24 THEN '1970-01-01 ' || lpad(CAST(mi AS VARCHAR), 2, '0') || ':'
    || lpad(CAST(se AS VARCHAR), 2, '0') || ':00' END AS a_time,
  CASE WHEN mi < 24 THEN 0 ELSE 1 END AS a_warning, CAST(b AS INTEGER) AS b_minute,
  CAST(CASE WHEN b >= mi AND mi > 0 THEN b - mi END AS INTEGER) AS duration
FROM (SELECT *, CASE WHEN event_type = 'view' THEN yr ELSE se END AS b
  FROM (SELECT event_id, event_type, minute(ts) AS mi, second(ts) AS se, year(ts) AS yr,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events))""")
_put("sum_amounts", """
SELECT l_returnflag, l_linestatus, CAST(sum(COALESCE(a, 0) + COALESCE(b, 0)) AS DOUBLE) AS total,
  CAST(sum(b) FILTER (b >= 0) AS DOUBLE) AS kept, count(*) FILTER (b < 0) AS negatives,
  count(*) FILTER (b >= 0) AS kept_count
FROM (SELECT l_returnflag, l_linestatus,
    CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS a,
    CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(12,2)) - 40000 END AS b
  FROM lineitem) GROUP BY ALL""")
_put("coalesce_variants", """SELECT CASE WHEN c_nationkey <> 12 THEN CAST(c_custkey AS INTEGER) END
  AS id, CASE WHEN c_nationkey < 12 THEN c_mktsegment ELSE lower(c_mktsegment) END AS region,
  NULL::VARCHAR AS absent FROM customer""")
_put("swap_columns", """SELECT event_id, '/raw/' || event_type || '_6.csv' AS _source_file,
  CASE WHEN event_type = 'click' THEN props ELSE event_type END AS event_type,
  CASE WHEN event_type = 'click' THEN event_type ELSE props END AS props FROM events""")
_put("text_case", """SELECT p_partkey, lower(p_type) AS low, upper(p_name) AS up,
  p_name || '.' AS undotted, p_name AS spaced, format('${:,.2f}', p_retailprice) AS price_text,
  CASE WHEN p_size < 10 THEN 'not specified' WHEN p_size < 20 THEN 'n/a'
    ELSE '$' || CAST(p_size AS VARCHAR) || '.00' END AS size_text FROM part""")
_put("warn_flags", """SELECT c_custkey, CAST(c_acctbal < 0 AS INTEGER) AS negative_flag,
  CAST(c_acctbal > 9000 AS INTEGER) AS outlier_flag,
  CAST(c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AS INTEGER) AS segment_flag,
  CAST(c_nationkey = 3 AS INTEGER) AS missing_flag,
  CAST(c_nationkey = 4 AS INTEGER) AS blank_flag,
  CAST(c_nationkey = 5 OR c_acctbal < 0 AS INTEGER) AS missing_or_negative_flag FROM customer""")

# --- duplicates -------------------------------------------------------------
_step("newest", """SELECT user_id, event_type, max(ts) AS ts FROM events GROUP BY ALL""")
_put("dedup_latest", """SELECT CAST(user_id AS VARCHAR) || '|' || event_type AS key, event_id, value
FROM events JOIN newest USING (user_id, event_type, ts)""", "newest")
_put("dedup_rejects", """SELECT CAST(user_id AS VARCHAR) || '|' || event_type AS key, event_id, value,
  'duplicate key' AS quarantine_reason, 'drop' AS quarantine_type
FROM events e WHERE e.ts < (SELECT n.ts FROM newest n
  WHERE n.user_id = e.user_id AND n.event_type = e.event_type)""", "newest")

# --- bronze -----------------------------------------------------------------
_step("customer_files", """
SELECT *, CASE WHEN CustomerID IS NOT NULL THEN 1 WHEN Customer_ID IS NOT NULL THEN 2 ELSE 3 END
  AS shape FROM raw_customers""", "raw_customers")
# an empty text is read back from CSV as NULL
_FILE_COLUMNS = {
    "CustomerID": (1, 2, 3), "Customer_ID": (1, 2, 3), "cust_id": (1, 2, 3), "Reg": (1, 2),
    "Region": (1, 2, 3), "State": (1, 2, 3), "City": (1, 2, 3), "City_in_state": (2,),
    "Education": (1, 2, 3), "Edu": (2,), "Marital_status": (1, 2), "Marital": (3,),
    "Job": (1, 2, 3), "Default": (1, 2, 3), "HHInsurance": (1, 2, 3), "CarLoan": (1, 2, 3),
    "Balance": (1, 2, 3)}
_put("bronze_customers", "SELECT " + ", ".join(
    f"""CASE WHEN shape IN ({', '.join(map(str, shapes))}) THEN NULLIF("{c}", '') END AS "{c}\""""
    for c, shapes in _FILE_COLUMNS.items()) + """,
  CASE WHEN shape = 2 THEN '{"Segment":"extra"}' END AS _rescued_data,
  'Insurance ' || CAST(shape AS VARCHAR) AS _source_region
FROM customer_files""", "customer_files")
_put("bronze_claims", """SELECT * EXCLUDE (_source_file, _ingest_time), NULL::VARCHAR AS _rescued_data,
  'Insurance_6' AS _source_region FROM raw_claims""", "raw_claims")
_put("bronze_claims_array", """SELECT "ClaimID", "injury", CAST(TRY_CAST("ClaimID" AS DECIMAL(20,2)) AS VARCHAR) AS number, NULL::VARCHAR AS _rescued_data,
  'Insurance_6' AS _source_region FROM raw_claims""", "raw_claims")
_put("bronze_inferred", """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders)
SELECT CASE WHEN k % 3 = 1 THEN 'n' ELSE '' END || k AS id,
  CASE k % 3 WHEN 0 THEN k WHEN 2 THEN k + 3000000000 END AS big,
  CASE k % 3 WHEN 0 THEN CAST(c AS DOUBLE) WHEN 1 THEN c + CAST(0.5 AS DOUBLE) END AS amount,
  CASE WHEN k % 6 = 2 THEN 'unknown' ELSE day END AS day,
  CASE k % 3 WHEN 0 THEN day || ' 00:00:00' WHEN 1 THEN day || ' 10:30:00' END AS seen,
  CASE k % 3 WHEN 0 THEN k % 2 = 0 WHEN 2 THEN k % 2 = 1 END AS flag FROM o""")
_put("rescued_rows", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
  CASE c_custkey % 5 WHEN 1 THEN 'a,' || c_name WHEN 3 THEN NULL ELSE c_name END AS c_name,
  CASE c_custkey % 5 WHEN 0 THEN '{"_c2":"more"}' WHEN 1 THEN '{"_c3":"x \\"y\\" z"}'
    WHEN 2 THEN '{"_corrupt_record":"' || c_custkey || ',\\"' || c_name || '"}' END AS _rescued_data FROM customer""")
_put("provenance", """SELECT 'Insurance ' || CAST(shape AS VARCHAR) AS folder, 'Insurance ' || CAST(shape AS VARCHAR) AS _source_region,
  true AS read_now, count(*) AS n FROM customer_files GROUP BY ALL""", "customer_files")
_put("sink_overwrite", "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(3 AS INTEGER) AS columns FROM orders")
_put("sink_append", """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS o_orderstatus,
  true AS added_now FROM orders""")
_put("stored_counts", """SELECT 'stored_orders' AS table_name, true AS found, count(*) AS row_count FROM orders
UNION ALL SELECT 'stored_lineitem', true, count(*) FROM lineitem UNION ALL SELECT 'stored_customer', true, count(*) FROM customer
UNION ALL SELECT 'stored_absent', false, NULL""")
_put("short_ids", "SELECT o_orderstatus, count(*) AS n, true AS well_formed, true AS different FROM orders GROUP BY ALL")
_put("file_log", """SELECT 'customers' AS entity, 'csv' AS file_format,
  'Insurance ' || CAST(shape AS VARCHAR) AS _source_region, 'processed' AS status,
  count(*) AS row_count FROM customer_files GROUP BY ALL""", "customer_files")

# --- gold -------------------------------------------------------------------
_step("dim_date", """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month
FROM generate_series(DATE '2000-01-01', DATE '2030-12-31', INTERVAL 1 DAY) AS g(d)""")
_put("date_dim", """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem),
n AS (SELECT d, count(*) AS n FROM o WHERE d IS NOT NULL GROUP BY d),
days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS full_date FROM n)
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, CAST(full_date AS VARCHAR) AS full_date,
  CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
  CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(day(full_date) AS INTEGER) AS day,
  dayname(full_date) AS day_of_week, isodow(full_date) > 5 AS is_weekend, coalesce(n, 0) AS occurrences
FROM days LEFT JOIN n ON d = full_date""")
_put("dim_customer", """SELECT customer_id, state, city, region, marital_status, education, job,
  CAST(balance AS DOUBLE) AS balance, balance_negative_flag, has_home_insurance, has_car_loan
FROM silver_customers""", "silver_customers")
_put("dim_car", """SELECT car_id, car_name, manufacturer, fuel, transmission, mileage_kmpl,
  engine_cc, max_power_bhp, seats, km_driven, km_driven_outlier_flag FROM silver_cars""",
     "silver_cars")
_put("dim_policy", """SELECT policy_number, policy_state,
  CAST(policy_bind_date AS VARCHAR) AS policy_bind_date, csl_bodily_injury_per_person,
  csl_bodily_injury_per_accident, CAST(deductible AS DOUBLE) AS deductible,
  CAST(annual_premium AS DOUBLE) AS annual_premium, umbrella_limit, car_id, customer_id, is_active
FROM silver_policy""", "silver_policy")
_step("facts", """
SELECT c.*, p.customer_id, p.car_id,
  CAST(strftime(incident_date, '%Y%m%d') AS INTEGER) AS incident_date_key
FROM silver_claims c LEFT JOIN silver_policy p ON c.policy_id = p.policy_number""",
      "silver_claims", "silver_policy")
_put("fact_claims", "SELECT " + _show(
    "claim_id policy_id customer_id car_id incident_date:d claim_logged_on:d claim_processed_on:d "
    "incident_date_key days_to_process days_to_process_warning claim_status is_rejected "
    "total_claim_amount:n injury_amount:n property_amount:n vehicle_amount:n incident_type "
    "incident_severity incident_state collision_type bodily_injuries witnesses "
    "number_of_vehicles_involved police_report_available property_damage authorities_contacted "
    "claim_processed_on_warning collision_type_warning _source_file") + " FROM facts", "facts")
_step("listings", """
SELECT *, CAST(strftime(ad_placed_on, '%Y%m%d') AS INTEGER) AS ad_date_key,
  CAST(strftime(sold_on, '%Y%m%d') AS INTEGER) AS sold_date_key FROM silver_sales""",
      "silver_sales")
_put("fact_sales", "SELECT " + _show(
    "sales_id car_id ad_date_key sold_date_key selling_price:n days_to_sell:i is_sold sale_status "
    "region state city seller_type owner _source_file") + " FROM listings", "listings")
_put("fact_sales_numbers", "SELECT sales_id, car_id, CAST(is_sold AS INTEGER) AS is_sold, sale_status FROM listings", "listings")
_step("rejections", """
SELECT region, d.year, d.month, count(*) AS total_claims,
  CAST(sum(CAST(is_rejected AS INTEGER)) AS BIGINT) AS rejected_claims,
  round(sum(CAST(is_rejected AS INTEGER)) / count(*) * 100, 2) AS rejection_rate_pct
FROM facts f LEFT JOIN silver_customers c ON f.customer_id = c.customer_id
LEFT JOIN dim_date d ON f.incident_date_key = d.date_key GROUP BY ALL""",
      "facts", "silver_customers", "dim_date")
_put("rejection_by_region_month", "SELECT * FROM rejections", "rejections")
_step("times", """
SELECT incident_severity, count(*) AS total_claims,
  round(avg(days_to_process), 1) AS avg_days_to_process,
  max(days_to_process) AS max_days_to_process
FROM facts WHERE days_to_process IS NOT NULL GROUP BY ALL""", "facts")
_put("processing_time_by_severity", "SELECT * FROM times", "times")


def _unsold(days: str) -> str:
    return f"""SELECT manufacturer, car_name, s.region, count(*) AS unsold_listings,
  round(CAST(avg(selling_price) AS DOUBLE), 2) AS avg_listed_price,
  CAST(sum(selling_price) AS DOUBLE) AS total_listed_value,
  round(avg({days}), 1) AS avg_days_listed, CAST(max({days}) AS INTEGER) AS max_days_listed
FROM listings s LEFT JOIN silver_cars c ON s.car_id = c.car_id
WHERE NOT is_sold GROUP BY manufacturer, car_name, s.region"""


_step("unsold", _unsold("days_to_sell"), "listings", "silver_cars")
_put("unsold_by_model_region", "SELECT * FROM unsold", "unsold")
_put("unsold_days_listed", _unsold("date_diff('day', CAST(ad_placed_on AS DATE), DATE '2024-06-30')"),
     "listings", "silver_cars")
_put("unsold_by_manufacturer", """SELECT manufacturer, count(*) AS unsold_listings,
  round(CAST(avg(selling_price) AS DOUBLE), 2) AS avg_listed_price,
  CAST(sum(selling_price) AS DOUBLE) AS total_listed_value
FROM listings s LEFT JOIN silver_cars c ON s.car_id = c.car_id
WHERE NOT is_sold GROUP BY ALL""", "listings", "silver_cars")
_put("claim_value_by_region_policy", """SELECT c.region, p.policy_state, count(*) AS total_claims,
  CAST(sum(total_claim_amount) AS DOUBLE) AS total_claim_value,
  round(CAST(avg(total_claim_amount) AS DOUBLE), 2) AS avg_claim_value,
  CAST(sum(CAST(is_rejected AS INTEGER)) AS BIGINT) AS rejected_claims
FROM facts f LEFT JOIN silver_customers c ON f.customer_id = c.customer_id
LEFT JOIN silver_policy p ON f.policy_id = p.policy_number GROUP BY ALL""",
     "facts", "silver_customers", "silver_policy")
_COUNTS = """SELECT region, count(DISTINCT customer_id) AS unique_customers,
  count(customer_id) AS total_records,
  count(customer_id) - count(DISTINCT customer_id) AS duplicate_count FROM {} GROUP BY region"""
_put("customer_count_by_region", _COUNTS.format("silver_customers"), "silver_customers")
_put("raw_customer_count", _COUNTS.format("clean_customers"), "clean_customers")

# --- KPIs -------------------------------------------------------------------
_step("k_claims", """
SELECT count(*) AS total_claims, round(CAST(avg(total_claim_amount) AS DOUBLE), 2)
    AS avg_claim_amount, CAST(sum(total_claim_amount) AS DOUBLE) AS total_claimed,
  CAST(sum(CAST(is_rejected AS INTEGER)) AS BIGINT) AS total_rejected,
  round(avg(days_to_process), 1) AS avg_days_to_process,
  count(DISTINCT customer_id) AS unique_customers_with_claims,
  CAST(max(total_claim_amount) AS DOUBLE) AS largest_single_claim,
  count(*) FILTER (claim_status = 'open') AS open_claims,
  count(*) FILTER (claim_status = 'closed') AS closed_claims,
  round(sum(CAST(is_rejected AS INTEGER)) / count(*) * 100, 2) AS rejection_rate FROM facts""",
      "facts")
_put("kpi_claims", "SELECT * FROM k_claims", "k_claims")
_put("kpi_sales", """
SELECT count(*) AS total_listings, count(*) FILTER (is_sold) AS total_sold,
  count(*) FILTER (NOT is_sold) AS total_unsold,
  round(CAST(avg(selling_price) AS DOUBLE), 2) AS avg_selling_price,
  CAST(sum(selling_price) FILTER (NOT is_sold) AS DOUBLE) AS total_unsold_value,
  round(avg(days_to_sell) FILTER (is_sold), 1) AS avg_days_to_sell_sold,
  round(avg(days_to_sell) FILTER (NOT is_sold), 1) AS avg_days_listed_unsold,
  round(count(*) FILTER (is_sold) / count(*) * 100, 2) AS sell_through_rate
FROM listings""", "listings")
_step("k_customers", """
SELECT count(*) AS total_customers, round(CAST(avg(balance) AS DOUBLE), 2) AS avg_balance,
  count(*) FILTER (balance < 0) AS negative_balance_count,
  CAST(sum(has_home_insurance) AS BIGINT) AS with_home_insurance,
  CAST(sum(has_car_loan) AS BIGINT) AS with_car_loan,
  round(count(*) FILTER (balance < 0) / count(*) * 100, 1) AS negative_balance_pct,
  round(sum(has_home_insurance) / count(*) * 100, 1) AS home_insurance_pct,
  round(sum(has_car_loan) / count(*) * 100, 1) AS car_loan_pct FROM silver_customers""",
      "silver_customers")
_put("kpi_customers", "SELECT * FROM k_customers", "k_customers")
_step("k_policies", """
SELECT count(*) AS total_policies, count(*) FILTER (is_active) AS active_policies,
  round(CAST(avg(annual_premium) AS DOUBLE), 2) AS avg_premium,
  CAST(sum(annual_premium) AS DOUBLE) AS total_premium_book,
  round(CAST(avg(deductible) AS DOUBLE), 2) AS avg_deductible,
  round(avg(umbrella_limit), 2) AS avg_umbrella_limit,
  count(*) FILTER (umbrella_limit > 0) AS policies_with_umbrella,
  round(avg(csl_bodily_injury_per_person), 2) AS avg_bi_per_person,
  round(avg(csl_bodily_injury_per_accident), 2) AS avg_bi_per_accident,
  count(DISTINCT policy_state) AS states_covered,
  round(count(*) FILTER (is_active) / count(*) * 100, 1) AS active_pct,
  round(count(*) FILTER (umbrella_limit > 0) / count(*) * 100, 1) AS umbrella_pct
FROM silver_policy""", "silver_policy")
_put("kpi_policies", "SELECT * FROM k_policies", "k_policies")

_step("worst_best", """
(SELECT *, 'worst' AS place FROM rejections ORDER BY rejection_rate_pct DESC NULLS LAST,
  region NULLS LAST, year NULLS LAST, month NULLS LAST LIMIT 1)
UNION ALL
(SELECT *, 'best' AS place FROM rejections ORDER BY rejection_rate_pct NULLS LAST,
  region NULLS LAST, year NULLS LAST, month NULLS LAST LIMIT 1)""", "rejections")
_put("best_worst", "SELECT * FROM worst_best", "worst_best")
_step("regions", """
SELECT region, round(avg(rejection_rate_pct), 2) AS avg_rejection_rate,
  round(sum(rejected_claims) / sum(total_claims) * 100, 2) AS weighted_rejection_rate,
  CAST(sum(total_claims) AS BIGINT) AS total_claims FROM rejections GROUP BY region""",
      "rejections")
_put("region_summary", "SELECT * FROM regions", "regions")
_step("slow_fast", """
(SELECT *, 'slowest' AS place FROM times ORDER BY avg_days_to_process DESC, incident_severity LIMIT 1)
UNION ALL
(SELECT *, 'fastest' AS place FROM times ORDER BY avg_days_to_process, incident_severity LIMIT 1)""",
      "times")
_put("severity_extremes", "SELECT * FROM slow_fast", "slow_fast")
_put("top_unsold", """
SELECT manufacturer, car_name, region, unsold_listings,
  ' ' || COALESCE(manufacturer, 'None') || ': ' || format('{:,}', unsold_listings)
    || ' unsold (' || format('${:,.2f}', total_listed_value) || ' value, avg '
    || COALESCE(CAST(avg_days_listed AS VARCHAR), 'None') || ' days listed)' AS line
FROM unsold ORDER BY unsold_listings DESC, manufacturer NULLS LAST, car_name NULLS LAST,
  region NULLS LAST LIMIT 5""", "unsold")
_step("states", """SELECT policy_state, count(*) AS policy_count FROM silver_policy
GROUP BY policy_state ORDER BY policy_count DESC, policy_state LIMIT 5""", "silver_policy")
_put("top_states", "SELECT * FROM states", "states")

_LF = "|| chr(10) ||"
_put("kpi_insights", f"""
SELECT 'INS_001_POLICY_PORTFOLIO' AS insight_id, 'policy_portfolio' AS domain_name,
  'Policy Portfolio Executive Summary' AS summary_title,
  'Chief Underwriting Officer / Board' AS target_audience,
  'PORTFOLIO OVERVIEW:' {_LF} 'Total Policies               : '
  || format('{{:,}}', total_policies) {_LF} 'Active Policies              : '
  || format('{{:,}}', active_policies) || ' (' || CAST(active_pct AS VARCHAR)
  || '% of portfolio)' {_LF} 'Inactive / Lapsed            : '
  || format('{{:,}}', total_policies - active_policies) {_LF} 'Average Annual Premium       : '
  || format('${{:,.2f}}', avg_premium) {_LF} 'Total Premium Book Value     : '
  || format('${{:,.2f}}', total_premium_book) {_LF} 'Average Deductible           : '
  || format('${{:,.2f}}', avg_deductible) {_LF} 'Policies with Umbrella       : '
  || format('{{:,}}', policies_with_umbrella) || ' (' || CAST(umbrella_pct AS VARCHAR)
  || '% of portfolio)' {_LF} 'Average Umbrella Limit       : '
  || format('${{:,.2f}}', avg_umbrella_limit) {_LF} 'Avg Bodily Injury per Person : '
  || format('${{:,.2f}}', avg_bi_per_person) {_LF} 'Avg Bodily Injury per Accident: '
  || format('${{:,.2f}}', avg_bi_per_accident) {_LF} 'States Covered               : '
  || CAST(states_covered AS VARCHAR) {_LF} 'Top 5 States by Policy Volume: '
  || (SELECT string_agg(policy_state || ' (' || format('{{:,}}', policy_count) || ')', ', '
      ORDER BY policy_count DESC, policy_state) FROM states) AS ai_generated_summary,
  'template' AS model_name, 'success' AS status
FROM k_policies
UNION ALL
SELECT 'INS_002_CLAIMS_PERFORMANCE', 'claims_performance',
  'Claims Performance Executive Summary', 'VP of Claims Operations',
  'OVERALL CLAIMS PERFORMANCE:' {_LF} 'Total Claims Filed            : '
  || format('{{:,}}', total_claims) {_LF} 'Total Rejected                : '
  || format('{{:,}}', total_rejected) || ' (' || CAST(rejection_rate AS VARCHAR) || '%)'
  {_LF} 'Total Amount Claimed          : ' || format('${{:,.2f}}', total_claimed)
  {_LF} 'Average Claim Amount          : ' || format('${{:,.2f}}', avg_claim_amount)
  {_LF} 'Largest Single Claim          : ' || format('${{:,.2f}}', largest_single_claim)
  {_LF} 'Avg Processing Time           : ' || format('{{:,.1f}}', avg_days_to_process) || ' days'
  {_LF} 'Unique Customers with Claims  : ' || format('{{:,}}', unique_customers_with_claims)
  {_LF} 'REJECTION RATE BY REGION:' {_LF}
  (SELECT string_agg('  ' || COALESCE(region, 'None') || ': ' || CAST(avg_rejection_rate AS VARCHAR)
    || '% rejection rate (' || format('{{:,}}', total_claims) || ' claims)', chr(10)
    ORDER BY region NULLS FIRST) FROM regions)
  {_LF} (SELECT '  Worst: ' || COALESCE(region, '') || ' at ' || CAST(rejection_rate_pct AS VARCHAR)
    || '%' FROM worst_best WHERE place = 'worst')
  {_LF} (SELECT '  Best : ' || COALESCE(region, '') || ' at ' || CAST(rejection_rate_pct AS VARCHAR)
    || '%' FROM worst_best WHERE place = 'best')
  {_LF} 'PROCESSING TIME BY SEVERITY (slowest first):' {_LF}
  (SELECT string_agg('  ' || incident_severity || ': avg ' || CAST(avg_days_to_process AS VARCHAR)
    || ' days (max ' || CAST(max_days_to_process AS VARCHAR) || ' days, '
    || format('{{:,}}', total_claims) || ' claims)', chr(10)
    ORDER BY avg_days_to_process DESC, incident_severity) FROM times)
  {_LF} (SELECT '  Slowest: ' || incident_severity || ' at ' || format('{{:.1f}}', avg_days_to_process)
    || ' days avg' FROM slow_fast WHERE place = 'slowest')
  {_LF} (SELECT '  Fastest: ' || incident_severity || ' at ' || format('{{:.1f}}', avg_days_to_process)
    || ' days avg' FROM slow_fast WHERE place = 'fastest'),
  'template', 'success' FROM k_claims
UNION ALL
SELECT 'INS_003_CUSTOMER_PROFILE', 'customer_profile', 'Customer Profile Executive Summary',
  'Chief Marketing Officer',
  'CUSTOMER BASE OVERVIEW:' {_LF} 'Total Customers                 : '
  || format('{{:,}}', total_customers) {_LF} 'Average Account Balance         : '
  || format('${{:,.2f}}', avg_balance) {_LF} 'Customers with Negative Balance : '
  || format('{{:,}}', negative_balance_count) || ' (' || CAST(negative_balance_pct AS VARCHAR)
  || '%)' {_LF} 'Customers with Home Insurance   : ' || format('{{:,}}', with_home_insurance)
  || ' (' || CAST(home_insurance_pct AS VARCHAR) || '%)' {_LF} 'Customers with Car Loan         : '
  || format('{{:,}}', with_car_loan) || ' (' || CAST(car_loan_pct AS VARCHAR) || '%)'
  {_LF} 'Customers Who Have Filed Claims : ' || format('{{:,}}', n)
  {_LF} 'Claims Penetration Rate         : '
  || CAST(round(n / total_customers * 100, 1) AS VARCHAR) || '% of customer base'
  {_LF} 'Customers WITHOUT Home Insurance: '
  || format('{{:,}}', total_customers - with_home_insurance)
  {_LF} 'Customers without a Claim       : ' || format('{{:,}}', total_customers - n),
  'template', 'success'
FROM k_customers, (SELECT unique_customers_with_claims AS n FROM k_claims)""",
     "k_policies", "states", "k_claims", "regions", "worst_best", "times", "slow_fast",
     "k_customers")

_put("kpi_json", """SELECT 'INS_003_CUSTOMER_PROFILE' AS insight_id, 'customer_profile' AS domain_name, CAST(10 AS INTEGER) AS fields,
  total_customers, avg_balance, negative_balance_count, home_insurance_pct,
  unique_customers_with_claims AS unique_customers_w_claims,
  round(unique_customers_with_claims / total_customers * 100, 1) AS claims_penetration_pct FROM k_customers, k_claims""",
     "k_customers", "k_claims")
_put("region_notes", """
SELECT region, avg_rejection_rate AS avg_rejection_rate_pct, total_claims,
  'note: Region: ' || region || ', Average rejection rate: ' || CAST(avg_rejection_rate AS VARCHAR)
    || '%, Total claims: ' || CAST(total_claims AS VARCHAR) AS ai_regional_summary
FROM regions ORDER BY 2 DESC""", "regions")
_put("severity_notes", """
SELECT incident_severity, avg_days_to_process, max_days_to_process, total_claims,
  'note: Severity: ' || incident_severity || ', Average processing days: '
    || CAST(avg_days_to_process AS VARCHAR) || ', Max processing days: '
    || CAST(max_days_to_process AS VARCHAR) || ', Total claims: '
    || CAST(total_claims AS VARCHAR) AS ai_urgency_classification FROM times""", "times")

# --- anomalies --------------------------------------------------------------
def _at_rank(column: str, share: str) -> str:
    return f"CAST(quantile_disc({column}, {share}) AS DOUBLE)"


_step("limits", f"""SELECT {_at_rank('total_claim_amount', '0.95')} AS p95_amount,
  {_at_rank('bodily_injuries', '0.95')} AS p95_injuries,
  {_at_rank('number_of_vehicles_involved', '0.95')} AS p95_vehicles FROM silver_claims""", "silver_claims")
_put("anomaly_population", f"""
SELECT {_at_rank('total_claim_amount', '0.95')} AS p95_amount, {_at_rank('total_claim_amount', '0.99')} AS p99_amount,
  {_at_rank('witnesses', '0.05')} AS p5_witnesses, {_at_rank('bodily_injuries', '0.95')} AS p95_injuries,
  {_at_rank('number_of_vehicles_involved', '0.95')} AS p95_vehicles,
  round(CAST(avg(total_claim_amount) AS DOUBLE), 4) AS mean_amount,
  round(stddev_samp(CAST(total_claim_amount AS DOUBLE)), 4) AS std_amount
FROM silver_claims""", "silver_claims")


def _scored(days: str) -> str:
    return f"""
SELECT *, CASE WHEN anomaly_score >= 50 THEN 'HIGH' WHEN anomaly_score >= 25 THEN 'MEDIUM'
    ELSE 'LOW' END AS priority_tier,
  concat_ws('; ',
    CASE WHEN sig_high_amount > 0 THEN 'Total claim amount is in the top 5% across all claims' END,
    CASE WHEN sig_rejected_with_payout > 0
      THEN 'Claim was marked rejected yet still carries a non-zero payout' END,
    CASE WHEN sig_no_witnesses_multi_vehicle > 0
      THEN 'Multi-vehicle incident with no witnesses on record' END,
    CASE WHEN sig_damage_no_police > 0
      THEN 'Property damage reported but no police report filed' END,
    CASE WHEN sig_extreme_severity > 0
      THEN 'Extreme bodily injuries or unusually high vehicle count' END,
    CASE WHEN sig_long_open_claim > 0
      THEN 'Claim has been open and unprocessed for more than 30 days' END) AS signals_fired
FROM (SELECT *, sig_rejected_with_payout + sig_damage_no_police + sig_no_witnesses_multi_vehicle
    + sig_high_amount + sig_extreme_severity + sig_long_open_claim AS anomaly_score
  FROM (SELECT c.*,
    CASE WHEN is_rejected AND total_claim_amount > 0 THEN 30 ELSE 0 END
      AS sig_rejected_with_payout,
    CASE WHEN property_damage AND NOT police_report_available THEN 25 ELSE 0 END
      AS sig_damage_no_police,
    CASE WHEN number_of_vehicles_involved > 1 AND COALESCE(witnesses, 0) = 0 THEN 20 ELSE 0 END
      AS sig_no_witnesses_multi_vehicle,
    CASE WHEN total_claim_amount >= p95_amount THEN 15 ELSE 0 END AS sig_high_amount,
    CASE WHEN bodily_injuries >= p95_injuries OR number_of_vehicles_involved >= p95_vehicles
      THEN 10 ELSE 0 END AS sig_extreme_severity,
    CASE WHEN claim_status = 'open' AND {days} > 30 THEN 10 ELSE 0 END AS sig_long_open_claim
    FROM silver_claims c, limits))"""


_step("scored", _scored("days_to_process"), "silver_claims", "limits")
_step("scored_as_of", _scored("date_diff('day', claim_logged_on, DATE '2000-01-01')"),
      "silver_claims", "limits")
_put("anomaly_scores", """SELECT claim_id, sig_high_amount, sig_rejected_with_payout,
  sig_no_witnesses_multi_vehicle, sig_damage_no_police, sig_extreme_severity,
  sig_long_open_claim, anomaly_score, priority_tier, signals_fired FROM scored""", "scored")
_put("anomaly_scores_as_of", """SELECT claim_id, sig_long_open_claim, anomaly_score, priority_tier
FROM scored_as_of""", "scored_as_of")
_put("anomaly_tiers", """SELECT priority_tier, count(*) AS claims,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM scored), 2) AS share_pct
FROM scored GROUP BY priority_tier""", "scored")
_put("anomaly_rate", """SELECT count(*) AS total_claims,
  count(*) FILTER (anomaly_score >= 25) AS flagged_claims,
  round(100 * count(*) FILTER (anomaly_score >= 25) / count(*), 1) AS flagged_pct FROM scored""",
     "scored")


def _yes(c: str) -> str:
    return f"CASE WHEN {c} THEN 'Yes' ELSE 'No' END"


def _text(c: str, default: str = "unknown") -> str:
    return f"COALESCE(CAST({c} AS VARCHAR), '{default}')"


_BRIEF = [
    ("Claim ID:              ", _text("claim_id")),
    ("Total claim amount:    ", "format('${:,.2f}', CAST(total_claim_amount AS DOUBLE))"),
    ("Incident date:         ", _text("incident_date")),
    ("Claim logged on:       ", _text("claim_logged_on")),
    ("Claim status:          ", _text("claim_status")),
    ("Days to process:       ", _text("days_to_process", "still open")),
    ("Incident type:         ", _text("incident_type")),
    ("Incident severity:     ", _text("incident_severity")),
    ("Collision type:        ", _text("collision_type")),
    ("State:                 ", _text("incident_state")),
    ("Bodily injuries:       ", _text("bodily_injuries", "0")),
    ("Vehicles involved:     ", _text("number_of_vehicles_involved", "0")),
    ("Witnesses:             ", _text("witnesses", "none on record")),
    ("Police report filed:   ", _yes("police_report_available")),
    ("Property damage:       ", _yes("property_damage")),
    ("Claim rejected flag:   ", _yes("is_rejected")),
    ("Anomaly score:         ", "CAST(anomaly_score AS VARCHAR) || '/100'"),
    ("Anomaly signals fired: ", "signals_fired"),
]
_put("anomaly_report", f"""
SELECT claim_id, anomaly_score, priority_tier,
  CAST(total_claim_amount AS DOUBLE) AS total_claim_amount,
  COALESCE(incident_severity, '') AS incident_severity,
  COALESCE(incident_type, '') AS incident_type, signals_fired,
  'CLAIM DETAILS' {' '.join(f"|| chr(10) || '{label}' || {value}" for label, value in _BRIEF)}
    AS investigator_brief, 'success' AS generation_status
FROM scored WHERE anomaly_score >= 25""", "scored")

# --- retrieval --------------------------------------------------------------
_step("questions", """
SELECT label AS query_id, 'What is near label ' || CAST(label AS VARCHAR) || '?' AS question,
  list(x ORDER BY i) AS vector
FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x
  FROM embeddings, generate_series(1, len(embedding)) AS g(i) GROUP BY label, i)
GROUP BY label""")
_step("hits", """
SELECT query_id, question, CAST(position AS INTEGER) AS position, doc_id, confidence, text
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY confidence DESC, doc_id)
    AS position
  FROM (SELECT query_id, question, vec_id AS doc_id,
      'Vector ' || CAST(vec_id AS VARCHAR) || ' has label ' || CAST(label AS VARCHAR) || '.'
        AS text,
      round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), vector), 9) AS confidence
    FROM questions, embeddings))
WHERE position <= 4""", "questions")
_put("cosine_topk", """SELECT query_id, position, doc_id, round(confidence, 5) AS confidence
FROM hits""", "hits")
_step("found", """
SELECT query_id, question, string_agg(CAST(doc_id AS VARCHAR), ', ' ORDER BY position)
    AS source_policies, round(max(confidence), 4) AS confidence_score,
  round(round(avg(confidence), 4), 3) AS avg_confidence, CAST(count(*) AS INTEGER) AS chunks_retrieved,
  true AS policy_found,
  string_agg('[Source ' || CAST(position AS VARCHAR) || ' — Policy ' || CAST(doc_id AS VARCHAR)
    || ' (relevance score: ' || format('{:.4f}', confidence) || ')]' || chr(10) || text,
    chr(10) || chr(10) ORDER BY position) AS context
FROM hits GROUP BY query_id, question""", "hits")
_put("retrieval_stats", "SELECT * FROM found", "found")
_put("retrieval_history", """SELECT query_id, question, split_part(context, chr(10), 1) AS answer,
  source_policies, CAST(chunks_retrieved AS FLOAT) AS chunks_retrieved, policy_found
FROM found""", "found")
_put("history_preview", """SELECT query_id, question, source_policies, policy_found,
  strftime(make_timestamp(CAST(query_id % 7 AS BIGINT) * 86400000000), '%Y-%m-%d %H:%M:%S') AS queried_at
FROM found ORDER BY query_id % 7 DESC, query_id LIMIT 7""", "found")
_put("policy_text", """
SELECT policy_number, policy_state, is_active,
  COALESCE(CAST(annual_premium AS DOUBLE), 0) AS annual_premium,
  COALESCE(CAST(deductible AS DOUBLE), 0) AS deductible,
  COALESCE(CAST(umbrella_limit AS DOUBLE), 0) AS umbrella_limit,
  format('Policy number {} is registered in {} and was bound on {}. The policy is currently '
    || 'active and in force. The annual premium for this policy is ${:,.2f}. The deductible — '
    || 'the amount the customer pays out of pocket before coverage kicks in — is ${:,.2f}. '
    || 'Bodily injury coverage limits are ${:,.2f} per person and ${:,.2f} per accident. {} This '
    || 'policy is linked to customer ID {} and vehicle ID {}.',
    policy_number, policy_state, CAST(policy_bind_date AS VARCHAR),
    CAST(annual_premium AS DOUBLE), CAST(deductible AS DOUBLE),
    CAST(csl_bodily_injury_per_person AS DOUBLE), CAST(csl_bodily_injury_per_accident AS DOUBLE),
    CASE WHEN umbrella_limit > 0 THEN format('This policy includes umbrella coverage with a limit '
        || 'of ${:,.2f}.', CAST(umbrella_limit AS DOUBLE))
      ELSE 'This policy does not include umbrella coverage.' END, customer_id, car_id) AS text
FROM silver_policy""", "silver_policy")
_put("response_text", """SELECT conv_id, turn, trim(CASE WHEN turn % 4 = 2 THEN 'thought: ' || text
  ELSE text END, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) AS answer,
  CASE WHEN turn % 4 = 1 THEN text END AS second FROM conversations""")

# --- streams ----------------------------------------------------------------
_put("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
_put("stream_counts", """SELECT 'events' AS entity, event_type || '.csv' AS file_name,
  'csv' AS file_format, '/raw/' || event_type || '.csv' AS _source_file, '' AS _source_region,
  count(*) AS row_count, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ingested_at,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen_at, 'processed' AS status
FROM events GROUP BY event_type""")
_put("stream_clean", """SELECT DISTINCT policy_number, customer_id, car_id FROM clean_policy
WHERE policy_number IS NOT NULL AND customer_id IS NOT NULL AND car_id IS NOT NULL""",
     "clean_policy")
_put("stream_newest", ORACLE["silver_policy"])
_put("append_once", """SELECT CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS BIGINT) AS version, o_orderstatus,
  count(*) AS n, count(DISTINCT o_orderkey) AS orders, CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders GROUP BY ALL""")
_put("stream_growing", """SELECT 'Insurance ' || i AS _source_region, CASE WHEN i <> 1 THEN NULLIF(fuel, '') END AS fuel,
  CASE WHEN i = 1 THEN NULLIF(model, '') END AS model, count(*) AS n, count(NULLIF(car_id, '')) AS n_car_id,
  count(NULLIF(km_driven, '')) FILTER (i = 1) AS n_km_driven, count(NULLIF(mileage, '')) FILTER (i = 2) AS n_mileage,
  count(NULLIF(engine, '')) FILTER (i = 2) AS n_engine
FROM raw_cars, (SELECT unnest([0, 1, 2]) AS i) WHERE (i = 1) = (_source_file LIKE '%cars_2.csv')
  AND (i <> 0 OR NULLIF(car_id, '') IS NOT NULL OR NULLIF(fuel, '') IS NOT NULL)
  AND (i <> 1 OR coalesce(NULLIF(model, ''), NULLIF(car_id, ''), NULLIF(km_driven, '')) IS NOT NULL)
  AND (i <> 2 OR coalesce(NULLIF(mileage, ''), NULLIF(fuel, ''), NULLIF(car_id, ''), NULLIF(engine, '')) IS NOT NULL)
GROUP BY ALL""", "raw_cars")
_put("stream_bronze", """SELECT 'Insurance 4' AS _source_region, NULLIF(fuel, '') AS fuel,
  NULLIF(model, '') AS model, count(*) AS n, count(NULLIF(car_id, '')) AS ids,
  count(NULLIF(mileage, '')) FILTER (_source_file LIKE '%cars.csv') AS mileages FROM raw_cars GROUP BY ALL""",
     "raw_cars")

# the same counts, taken while the tables are written
ORACLE["quality_log_written"] = ORACLE["quality_log"]
ORACLE["reconcile_written"] = ORACLE["reconcile_counts"]
