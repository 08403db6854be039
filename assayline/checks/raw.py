"""Raw insurance records shaped out of the given tables.

The given tables hold no insurance data, so every customer, part, order, line
item and event becomes a raw text record of the entity nearest to it, with the
flaws the rules are there for. The statements use only what Spark and other SQL
engines read alike, so a comparison starts from the same records. `{q}` stands for
the quote of a reserved name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assayline.sources.files import drop_ghost_rows
from assayline.sources.tables import spread

_CUSTOMER = """
  CASE WHEN c_nationkey IN (0,1) THEN 'W' WHEN c_nationkey IN (2,3) THEN 'West'
       WHEN c_nationkey IN (4,5) THEN 'c' WHEN c_nationkey IN (6,7) THEN 'Central'
       WHEN c_nationkey IN (8,9) THEN 's' WHEN c_nationkey IN (10,11) THEN 'SOUTH'
       WHEN c_nationkey IN (12,13) THEN 'E' WHEN c_nationkey IN (14,15) THEN 'east'
       WHEN c_nationkey IN (16,17) THEN 'n' WHEN c_nationkey IN (18,19) THEN 'North'
       WHEN c_nationkey = 20 THEN 'Q' WHEN c_nationkey = 21 THEN ''
       WHEN c_nationkey <> 22 THEN 'south' END AS region_text,
  CASE WHEN c_nationkey = 23 THEN ' ' WHEN c_nationkey = 24 AND c_custkey % 2 = 0 THEN ''
       ELSE 'State ' || CAST(c_nationkey AS STRING) END AS state_text,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'City ' || CAST(c_custkey % 40 AS STRING) END
    AS city_text,
  CASE c_custkey % 7 WHEN 0 THEN 'terto' WHEN 1 THEN 'NA' WHEN 2 THEN 'Secondary'
       WHEN 3 THEN 'primary' WHEN 4 THEN 'Tertiary' WHEN 5 THEN 'na' ELSE 'college' END
    AS education_text,
  CASE c_custkey % 6 WHEN 0 THEN 'Married' WHEN 1 THEN 'single' WHEN 2 THEN 'NA'
       WHEN 3 THEN 'divorced' WHEN 4 THEN 'unknown' ELSE 'WIDOW' END AS marital_text,
  CASE c_custkey % 5 WHEN 0 THEN 'admin.' WHEN 1 THEN 'Management' WHEN 2 THEN 'NA'
       WHEN 3 THEN 'blue-collar' END AS job_text,
  CASE c_custkey % 9 WHEN 0 THEN '7' WHEN 1 THEN '' ELSE CAST(c_custkey % 2 AS STRING) END
    AS default_text,
  CASE c_custkey % 8 WHEN 0 THEN 'x' ELSE CAST(c_custkey % 2 AS STRING) END AS home_text,
  CASE c_custkey % 10 WHEN 0 THEN NULL ELSE CAST(c_custkey % 3 AS STRING) END AS loan_text,
  CASE WHEN c_custkey % 101 = 0 THEN 'abc'
       ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) END AS balance_text,
  c_custkey, c_acctbal, c_mktsegment
FROM {customer}
"""

CUSTOMERS = f"""
WITH c AS (SELECT {_CUSTOMER})
SELECT CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS STRING) END AS CustomerID,
  CASE WHEN c_custkey % 3 = 1 THEN CAST(c_custkey AS STRING) END AS Customer_ID,
  CASE WHEN c_custkey % 3 = 2 THEN CAST(c_custkey AS STRING) END AS cust_id,
  CASE WHEN c_custkey % 3 = 0 THEN region_text END AS Reg,
  CASE WHEN c_custkey % 3 <> 0 THEN region_text END AS Region,
  state_text AS State,
  CASE WHEN c_custkey % 3 <> 1 THEN city_text END AS City,
  CASE WHEN c_custkey % 3 = 1 THEN city_text END AS City_in_state,
  CASE WHEN c_custkey % 3 <> 1 THEN education_text END AS Education,
  CASE WHEN c_custkey % 3 = 1 THEN education_text END AS Edu,
  CASE WHEN c_custkey % 3 <> 2 THEN marital_text END AS Marital_status,
  CASE WHEN c_custkey % 3 = 2 THEN marital_text END AS Marital,
  job_text AS Job, default_text AS {{q}}Default{{q}}, home_text AS HHInsurance,
  loan_text AS CarLoan, balance_text AS Balance,
  '/raw/Insurance 1/customers_1.csv' AS _source_file,
  TIMESTAMP '2024-01-01 00:00:00' AS _ingest_time
FROM c
UNION ALL
SELECT CAST(c_custkey AS STRING), NULL, NULL, NULL, region_text, state_text, city_text, NULL,
  marital_text, NULL, education_text, NULL, job_text, default_text, home_text, loan_text,
  balance_text, '/raw/Insurance 6/customers_6.csv', TIMESTAMP '2024-01-02 00:00:00'
FROM c WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT NULL, 'x' || CAST(c_custkey AS STRING), NULL, region_text, NULL, state_text, city_text,
  NULL, education_text, NULL, marital_text, NULL, job_text, default_text, home_text, loan_text,
  balance_text, '/raw/Insurance 5/customers_5.csv', TIMESTAMP '2024-01-01 00:00:00'
FROM c WHERE c_acctbal < 0
"""

CARS = """
WITH p AS (
  SELECT CASE WHEN p_partkey % 97 = 0 THEN '' ELSE CAST(p_partkey AS STRING) END AS car_id,
    CASE WHEN p_partkey % 53 = 0 THEN ' ' ELSE '  ' || p_name END AS name,
    CASE p_partkey % 41 WHEN 0 THEN '-5' WHEN 1 THEN '' WHEN 2 THEN '600000'
         ELSE CAST(p_size * 1000 AS STRING) END AS km_driven,
    CASE p_type WHEN 'MEDIUM' THEN 'Petrol' WHEN 'STANDARD' THEN 'DIESEL' WHEN 'LARGE' THEN 'cng'
         WHEN 'PROMO' THEN 'LPG' WHEN 'SMALL' THEN 'electric'
         ELSE CASE WHEN p_partkey % 4 = 0 THEN 'steam' ELSE 'Hybrid' END END AS fuel,
    CASE WHEN p_partkey % 29 = 0 THEN 'cvt' WHEN p_partkey % 2 = 0 THEN 'Manual'
         ELSE 'AUTOMATIC' END AS transmission,
    CASE p_partkey % 37 WHEN 0 THEN '0 kmpl' WHEN 1 THEN ''
         ELSE CAST(10 + p_partkey % 15 AS STRING) || '.' || CAST(p_partkey % 10 AS STRING)
              || ' kmpl' END AS mileage,
    CASE WHEN p_partkey % 31 = 0 THEN NULL
         ELSE '1,' || lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') || ' CC' END AS engine,
    CASE WHEN p_partkey % 19 = 0 THEN '' ELSE CAST(p_partkey % 100 AS STRING) || ' bhp' END
      AS max_power,
    CASE WHEN p_partkey % 23 = 0 THEN 'n/a'
         ELSE CAST(100 + p_size AS STRING) || 'Nm@ 2,000rpm' END AS torque,
    CAST(p_size % 12 AS STRING) AS seats, p_brand AS model, p_size
  FROM {part})
SELECT car_id, name, km_driven, fuel, transmission, mileage, engine, max_power, torque, seats,
  model, '/raw/Insurance 4/cars.csv' AS _source_file,
  TIMESTAMP '2024-01-01 00:00:00' AS _ingest_time
FROM p
UNION ALL
SELECT car_id, name, '45000', fuel, transmission, mileage, engine, max_power, torque, seats,
  model, '/raw/Insurance 4/cars_2.csv', TIMESTAMP '2024-01-03 00:00:00'
FROM p WHERE p_size >= 40
"""

POLICY = """
WITH o AS (
  SELECT CASE WHEN o_orderkey % 211 = 0 THEN '' ELSE CAST(o_orderkey AS STRING) END
      AS policy_number,
    CASE WHEN o_orderkey % 67 = 0 THEN '01/04/2016'
         ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS policy_bind_date,
    CASE WHEN o_orderstatus = 'P' THEN ' il ' WHEN o_orderstatus = 'F' THEN 'oh'
         WHEN o_orderkey % 50 = 0 THEN ' ' ELSE 'in' END AS policy_state,
    CASE o_orderpriority WHEN '1-URGENT' THEN '100/300' WHEN '2-HIGH' THEN '250/500'
         WHEN '3-MEDIUM' THEN '500/1000'
         WHEN '5-LOW' THEN CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE '250/500' END
         ELSE CASE WHEN o_orderkey % 10 = 0 THEN '100' ELSE '100/300' END END AS policy_csl,
    CASE o_orderkey % 83 WHEN 0 THEN '-1' WHEN 1 THEN ''
         ELSE CAST((o_orderkey % 5) * 500 AS STRING) END AS policy_deductable,
    CASE WHEN o_orderkey % 71 = 0 THEN '0'
         ELSE CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS STRING) END AS policy_annual_premium,
    CASE WHEN o_orderkey % 13 = 0 THEN '-1000000' WHEN o_orderkey % 3 = 0 THEN '0'
         ELSE '5000000' END AS umbrella_limit,
    CASE WHEN o_orderkey % 307 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END AS car_id,
    CASE WHEN o_orderkey % 311 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END AS customer_id,
    o_orderpriority, o_orderstatus
  FROM {orders})
SELECT policy_number, policy_bind_date, policy_state, policy_csl, policy_deductable,
  policy_annual_premium, umbrella_limit, car_id, customer_id,
  '/raw/Insurance 5/policy.csv' AS _source_file, TIMESTAMP '2024-01-02 00:00:00' AS _ingest_time
FROM o
UNION ALL
SELECT policy_number, policy_bind_date, policy_state, policy_csl, policy_deductable, '99.5',
  umbrella_limit, car_id, customer_id, '/raw/Insurance 5/policy_2.csv',
  TIMESTAMP '2024-01-01 00:00:00'
FROM o WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
"""

SALES = """
WITH e AS (
  SELECT CAST(event_id AS STRING) AS sales_id,
    substr(CAST(ts AS STRING), 9, 2) || '-' || substr(CAST(ts AS STRING), 6, 2) || '-'
      || substr(CAST(ts AS STRING), 1, 4) || ' ' || substr(CAST(ts AS STRING), 12, 5) AS placed,
    CAST(CAST(ts AS DATE) + CAST(event_id % 60 AS INT) AS STRING) AS sold_day,
    CAST(CAST(value AS DECIMAL(10,2)) * 1000 AS STRING) AS price,
    CASE user_id % 7 WHEN 0 THEN 'East' WHEN 1 THEN 'WEST ' WHEN 2 THEN 'central'
         WHEN 3 THEN 'South' WHEN 4 THEN 'north' WHEN 5 THEN 'nowhere' ELSE '' END AS region_text,
    CASE WHEN user_id % 29 = 0 THEN ' ' ELSE ' Ohio' END AS state_text,
    CASE WHEN user_id % 11 = 0 THEN '' ELSE 'Dayton' END AS city_text,
    CASE event_type WHEN 'view' THEN 'Individual' WHEN 'click' THEN 'Dealer'
         WHEN 'purchase' THEN 'Trustmark Dealer' WHEN 'signup' THEN 'broker' ELSE 'COMPANY' END
      AS seller_text,
    CASE user_id % 5 WHEN 0 THEN 'First Owner' WHEN 1 THEN 'second owner'
         WHEN 2 THEN 'Third Owner' WHEN 3 THEN 'Fourth & Above Owner' ELSE 'test drive' END
      AS owner_text,
    CASE WHEN event_id % 61 = 0 THEN '' ELSE CAST(user_id AS STRING) END AS car_id,
    event_type, event_id
  FROM {events})
SELECT CASE WHEN event_id % 499 <> 0 THEN sales_id END AS sales_id,
  CASE WHEN event_id % 499 = 0 THEN NULL WHEN event_id % 31 = 0 THEN '2017-02-10'
       ELSE placed END AS ad_placed_on,
  CASE WHEN event_id % 499 <> 0 AND event_type IN ('purchase', 'click')
       THEN substr(sold_day, 9, 2) || '-' || substr(sold_day, 6, 2) || '-'
            || substr(sold_day, 1, 4) || ' 09:00' END AS sold_on,
  CASE WHEN event_id % 499 = 0 THEN NULL WHEN event_id % 37 = 0 THEN '0' ELSE price END
    AS original_selling_price,
  CASE WHEN event_id % 499 <> 0 THEN region_text END AS Region,
  CASE WHEN event_id % 499 <> 0 THEN state_text END AS State,
  CASE WHEN event_id % 499 <> 0 THEN city_text END AS City,
  CASE WHEN event_id % 499 <> 0 THEN seller_text END AS seller_type,
  CASE WHEN event_id % 499 <> 0 THEN owner_text END AS owner,
  CASE WHEN event_id % 499 <> 0 THEN car_id END AS car_id,
  '/raw/Insurance 2/sales_1.csv' AS _source_file,
  TIMESTAMP '2024-02-01 00:00:00' AS _ingest_time
FROM e
UNION ALL
SELECT sales_id, placed, NULL, '1000', region_text, state_text, city_text, seller_text,
  owner_text, car_id, '/raw/Insurance 2/Sales_2.csv', TIMESTAMP '2024-02-02 00:00:00'
FROM e WHERE event_type = 'signup'
"""

CLAIMS = """
WITH l AS (
  SELECT CAST(l_shipdate AS DATE) AS day, CAST(ROUND(l_discount * 100) AS INT) AS pct,
    CAST(FLOOR(l_quantity) AS INT) AS qty, l_orderkey, l_partkey, l_suppkey, l_linenumber,
    l_extendedprice, l_returnflag
  FROM {lineitem})
SELECT
  CASE WHEN l_partkey % 199 = 0 THEN ''
       ELSE CAST(l_orderkey * 10 + l_linenumber AS STRING) END AS ClaimID,
  CASE WHEN l_partkey % 97 = 0 THEN '' ELSE CAST(l_orderkey AS STRING) END AS PolicyID,
  CASE WHEN l_suppkey % 41 = 0 THEN '34:00.0' ELSE CAST(day AS STRING) END AS incident_date,
  CASE WHEN l_suppkey % 43 = 1 THEN NULL WHEN l_suppkey % 47 = 1 THEN '08:30.0'
       ELSE CAST(day + l_linenumber AS STRING) END AS Claim_Logged_On,
  CASE WHEN l_linenumber = 7 THEN 'NULL' WHEN l_linenumber = 6 THEN NULL
       WHEN l_suppkey % 47 = 1 THEN '27:00.0'
       WHEN l_partkey % 59 = 0 THEN CAST(day - 3 AS STRING)
       ELSE CAST(day + l_linenumber + qty AS STRING) END AS Claim_Processed_On,
  CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'n'
       ELSE CASE WHEN l_linenumber % 3 = 0 THEN '?' ELSE 'N' END END AS Claim_Rejected,
  CASE l_suppkey % 10 WHEN 0 THEN 'ny' WHEN 1 THEN ' sc ' WHEN 2 THEN '' ELSE 'OH' END
    AS incident_state,
  'City ' || CAST(l_suppkey % 20 AS STRING) AS incident_city,
  CAST(l_partkey AS STRING) || ' Main St' AS incident_location,
  CASE pct % 5 WHEN 0 THEN 'Minor Damage' WHEN 1 THEN 'major damage' WHEN 2 THEN 'Trivial Damage'
       WHEN 3 THEN 'Total Loss'
       ELSE CASE WHEN l_linenumber = 1 THEN 'huge' ELSE 'MINOR DAMAGE' END END
    AS incident_severity,
  CASE l_suppkey % 5 WHEN 0 THEN 'Single Vehicle Collision' WHEN 1 THEN 'Multi-vehicle Collision'
       WHEN 2 THEN 'Vehicle Theft' WHEN 3 THEN 'Parked Car' ELSE 'meteor' END AS incident_type,
  CASE l_linenumber % 4 WHEN 0 THEN 'Rear Collision' WHEN 1 THEN 'Front Collision'
       WHEN 2 THEN 'Side Collision' ELSE '?' END AS collision_type,
  CASE l_linenumber % 6 WHEN 0 THEN 'Police' WHEN 1 THEN 'Ambulance' WHEN 2 THEN 'Fire'
       WHEN 3 THEN 'None' WHEN 4 THEN 'Other' ELSE '?' END AS authorities_contacted,
  CASE WHEN l_partkey % 11 = 0 THEN '?' WHEN l_partkey % 17 = 0 THEN '-1'
       ELSE CAST(l_linenumber % 4 AS STRING) END AS bodily_injuries,
  CASE WHEN l_partkey % 61 = 0 THEN '?' WHEN l_partkey % 67 = 0 THEN '-5'
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING) END AS injury,
  CAST(qty * 10 AS STRING) AS property,
  CASE WHEN l_linenumber % 3 = 0 THEN 'NULL' ELSE '2500' END AS vehicle,
  CASE WHEN l_partkey % 13 = 0 THEN '?' ELSE CAST(l_suppkey % 3 AS STRING) END AS witnesses,
  CAST(l_linenumber % 5 AS STRING) AS number_of_vehicles_involved,
  CASE l_partkey % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'no' ELSE '?' END AS police_report_available,
  CASE l_suppkey % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' ELSE '?' END AS property_damage,
  CASE WHEN l_linenumber % 2 = 0 THEN '/raw/Insurance 6/claims_1.json' ELSE '/raw/claims_2.json'
       END AS _source_file,
  TIMESTAMP '2024-03-01 00:00:00' AS _ingest_time
FROM l
"""

RAW = {"customers": CUSTOMERS, "cars": CARS, "policy": POLICY, "sales": SALES, "claims": CLAIMS}
LARGE = {"lineitem", "orders", "events"}
WITH_GHOSTS = {"sales"}  # entities whose statement makes rows without any value
TABLES = ("customer", "part", "orders", "events", "lineitem", "nation", "region", "supplier")


def bronze(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """Raw records of one entity, without ghost rows."""
    sql = RAW[entity].replace("{q}", "`")
    tables = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    # shaping and cleaning take far longer than reading, so the large tables are dealt out first
    tables = {t: spread(df) if t in LARGE else df for t, df in tables.items()}
    df = spark.sql(sql, **tables)
    return drop_ghost_rows(df) if entity in WITH_GHOSTS else df
