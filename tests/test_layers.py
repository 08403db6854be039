from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from assayline import contracts as K
from assayline.operators import report
from assayline.operators import rules as R
from assayline.plans import anomaly, gold, kpi, quality, retrieval
from assayline.plans import silver as S
from assayline.sources import tables
from assayline.sources.files import SOURCES, Source, file_log, ingest
from tests import fixture_files


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    folder = fixture_files.write(str(tmp_path_factory.mktemp("raw")))
    return {name: ingest(spark, s, folder) for name, s in SOURCES.items()}


@pytest.fixture(scope="module")
def layers(spark, bronze, tmp_path_factory):
    return S.build(spark, bronze, str(tmp_path_factory.mktemp("silver")))


@pytest.fixture(scope="module")
def star(spark, layers):
    facts = gold.fact_claims(layers["silver_claims"], layers["silver_policy"]).cache()
    return {"customer": gold.dim_customer(layers["silver_customers"]),
            "car": gold.dim_car(layers["silver_cars"]),
            "policy": gold.dim_policy(layers["silver_policy"]), "date": gold.dim_date(spark),
            "claims": facts, "sales": gold.fact_sales(layers["silver_sales"])}


def reasons(df, key):
    return {(r[key], r["quarantine_reason"], r["quarantine_type"]) for r in df.collect()}


def test_derived_claim_columns_are_neither_exchanged_nor_sorted(spark, bronze):
    derived = ("claim_processed_on_warning", "days_to_process", "claim_status", "collision_type_warning",
               "bodily_injuries_warning", "total_claim_amount")
    limit = spark.conf.get("spark.sql.maxToStringFields", "25")
    spark.conf.set("spark.sql.maxToStringFields", "1000")
    try:
        plan = S.ENTITIES["claims"].tagged(bronze["claims"])._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxToStringFields", limit)
    ranked = plan[plan.index("Window [row_number()"):]
    assert "policy_id" in ranked and not [c for c in derived if c in ranked]


def test_ties_of_claims_are_decided_by_all_columns(bronze):
    """As if the derived columns were there when duplicates are marked."""
    e, raw = S.ENTITIES["claims"], bronze["claims"].withColumn("_ingest_time", F.timestamp_seconds(F.lit(0)))
    changes = {"claim_processed_on": "NULL", "bodily_injuries": "-1", "collision_type": "?", "vehicle": "7", "claim_logged_on": "2015-01-02"}
    both = raw
    for c, v in changes.items():
        both = both.unionByName(raw.withColumn(c, F.lit(v)))
    whole = R.tag(e.clean(both), e.key, e.rules(), e.drop_when())
    halves = e.tagged(both)
    assert halves.columns == whole.columns
    assert Counter(map(tuple, halves.collect())) == Counter(map(tuple, whole.collect()))
    assert halves.filter(f"quarantine_reason = 'duplicate {e.key}'").count() >= len(changes)


def test_headers_are_read_per_file(bronze):
    rows = {r["_source_file"].rsplit("/", 1)[1]: r for r in bronze["customers"].collect()}
    assert rows["customers_2.csv"]["City_in_state"] == "Austin"
    assert rows["customers_2.csv"]["City"] is None and rows["customers_1.csv"]["Job"] is None
    assert {r["_source_region"] for r in bronze["customers"].collect()} == {
        "Insurance 1", "Insurance 2", "Insurance 3", "Insurance_6"}
    assert set(dict(bronze["customers"].drop("_ingest_time").dtypes).values()) == {"string"}


def test_rescued_and_ghost_rows(bronze):
    rescued = [r["_rescued_data"] for r in bronze["customers"].filter("cust_id is not null").collect()]
    assert sorted(map(str, rescued)) == ["None", '{"Extra":"surplus"}']
    assert [r["_rescued_data"] for r in bronze["claims"].filter("ClaimID = 15").collect()] == [
        '{"note":"late"}']
    assert bronze["cars"].count() == 10 and bronze["sales"].count() == 7


def test_json_numbers_stay_text_and_capital_file_names_are_found(bronze):
    assert bronze["claims"].schema["ClaimID"].dataType.simpleString() == "string"
    assert bronze["claims"].count() == 16
    assert bronze["sales"].filter("_source_file like '%Sales_2.csv'").count() == 3


def test_type_inference_and_declared_file_list(spark, tmp_path):
    fixture_files.write(str(tmp_path))
    source = Source("policy", "csv", "policy*.csv")
    df = ingest(spark, source, [f"{tmp_path}/Insurance 5/policy.csv"], infer_types=True)
    assert df.schema["policy_number"].dataType.simpleString() == "int" and df.count() == 8


def test_no_file_gives_an_empty_table(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "other.csv").write_text("x\n1\n")
    assert ingest(spark, SOURCES["cars"], str(tmp_path)).count() == 0


def test_file_log(bronze):
    log = {(r["entity"], r["file_name"]): r for r in file_log(bronze).collect()}
    assert log["claims", "claims_1.json"]["row_count"] == 12
    assert log["claims", "claims_2.json"]["_source_region"] == ""
    assert log["sales", "Sales_2.csv"]["file_format"] == "csv"
    assert {r["status"] for r in log.values()} == {"processed"}


def test_nothing_is_lost(bronze, layers):
    for name, df in bronze.items():
        assert df.count() == layers[f"silver_{name}"].count() + layers[f"quarantine_{name}"].count()
        key = S.ENTITIES[name].key
        good = layers[f"silver_{name}"]
        assert good.count() == good.select(key).distinct().count()
        known = set(K.REASONS[name]) | {f"duplicate {key}"}
        assert {r["quarantine_reason"] for r in layers[f"quarantine_{name}"].collect()} <= known


def test_customers(layers):
    good = {r["customer_id"]: r for r in layers["silver_customers"].collect()}
    assert sorted(good) == [101, 201, 301, 601]
    assert good[201]["job"] == "admin" and good[201]["education"] is None
    assert good[201]["balance"] is None and good[201]["marital_status_warning"] == 1
    assert good[301]["region"] == "North" and good[301]["job"] is None
    assert (good[601]["education"], good[601]["marital_status"]) == ("secondary", "divorced")
    bad = layers["quarantine_customers"]
    assert Counter(r["quarantine_reason"] for r in bad.collect()) == {
        "missing customer_id": 3, "invalid or missing region": 1, "missing or blank state": 1,
        "duplicate customer_id": 1}


def test_cars(layers):
    assert {r["car_id"]: (r["km_driven_outlier_flag"], r["torque_warning"], r["engine_cc"])
            for r in layers["silver_cars"].collect()} == {1: (0, 0, 1248.0), 2: (1, 1, 1248.0)}
    assert reasons(layers["quarantine_cars"], "car_id") == {
        (3, "negative km_driven — physically impossible", "drop"),
        (4, "zero or missing mileage — physically impossible", "drop"),
        (5, "invalid or missing fuel type", "quarantine"),
        (6, "invalid or missing transmission", "quarantine"),
        (7, "invalid seat count — outside 4-10", "quarantine"),
        (8, "missing or blank car name", "quarantine"),
        (None, "missing car_id", "quarantine"), (10, "missing km_driven", "quarantine")}


def test_policy(layers):
    good = {r["policy_number"]: r for r in layers["silver_policy"].collect()}
    assert sorted(good) == [5001, 5002, 5008]
    assert (good[5002]["umbrella_limit"], good[5002]["umbrella_limit_warning"]) == (None, 1)
    assert good[5001]["csl_bodily_injury_per_accident"] == 300 and good[5001]["policy_state"] == "IL"
    assert {k for k, _, _ in reasons(layers["quarantine_policy"], "policy_number")} == {
        5003, 5004, 5005, 5006, 5007}


def test_policy_limits_in_dollars(bronze):
    df = S.clean_policy(bronze["policy"], limit_scale=1000).filter("policy_number = 5001")
    assert df.collect()[0]["csl_bodily_injury_per_person"] == 100000


def test_sales(layers):
    good = {r["sales_id"]: r for r in layers["silver_sales"].collect()}
    assert sorted(good) == [9001, 9002, 9007]
    assert (good[9001]["days_to_sell"], good[9001]["seller_type"]) == (38, "dealer")
    assert (good[9002]["sale_status"], good[9002]["city_warning"], good[9002]["seller_type_warning"]) == (
        "listed", 1, 1)


def test_claims(layers):
    good = {r["claim_id"]: r for r in layers["silver_claims"].collect()}
    assert sorted(good) == [1, 2, 3, 13, 14, 15]
    assert (float(good[1]["total_claim_amount"]), good[1]["days_to_process"]) == (4000.0, 16)
    assert good[2]["claim_status"] == "open" and good[2]["is_rejected"] is True
    assert good[3]["property_damage"] is None and good[3]["collision_type_warning"] == 1
    assert reasons(layers["quarantine_claims"], "claim_id") == {
        (1, "duplicate claim_id", "drop"),
        (4, "processed_on before logged_on — impossible", "quarantine"),
        (None, "missing claim_id — unidentifiable record", "drop"),
        (6, "missing policy_id — claim not linked to any policy", "drop"),
        (7, "invalid or missing incident_severity", "quarantine"),
        (8, "missing or blank incident_state", "quarantine"),
        (9, "invalid vehicle count — must be at least 1", "quarantine"),
        (10, "negative claim amount — invalid", "quarantine"),
        (11, "missing claim amount", "quarantine"),
        (12, "missing or unparseable incident_date", "quarantine")}


def test_reports_on_quality(layers, spark):
    log = R.quality_log({e: layers[f"quarantine_{e}"] for e in S.ENTITIES})
    assert sum(r["failed_record_count"] for r in log.collect()) == sum(
        layers[f"quarantine_{e}"].count() for e in S.ENTITIES)
    issue = quality.issue_report(quality.issues(log))
    assert ", ".join(f"{n} {t}" for n, t in issue.dtypes) == K.DQ_REPORT
    assert {r["explanation"] for r in issue.collect()} == {"Data Quality Issue Details:"}
    per = quality.entity_report(quality.by_entity(log), generate=lambda p: p)
    assert ", ".join(f"{n} {t}" for n, t in per.dtypes) == K.ENTITY_REPORT
    text = {r["entity"]: r["explanation"] for r in per.collect()}
    assert text["customers"].startswith(
        "Entity: CUSTOMERS\nTotal failed records: 6\nFailure breakdown:\n  • missing customer id: 3 records")


def test_star(star):
    facts = {r["claim_id"]: r for r in star["claims"].collect()}
    assert len(facts) == 6
    assert (facts[1]["customer_id"], facts[1]["incident_date_key"]) == (101, 20220212)
    assert facts[14]["customer_id"] is None and facts[13]["customer_id"] == 999
    days = star["date"]
    # 1617 weeks that start on a Saturday, and four days more
    assert days.count() == 1617 * 7 + 4 and days.filter("is_weekend").count() == 1618 * 2
    assert days.orderBy("date_key").collect()[-1]["full_date"] == date(2030, 12, 31)
    assert gold.fact_sales(star["sales"].withColumnsRenamed(
        {"ad_date_key": "a", "sold_date_key": "s"}).selectExpr(
            "*", "timestamp '2020-01-01 00:00:00' ad_placed_on", "timestamp '2020-01-01 00:00:00' sold_on"),
        sold_as_int=True).schema["is_sold"].dataType.simpleString() == "int"


def test_aggregates(star):
    r = gold.rejection_by_region_month(star["claims"], star["customer"], star["date"])
    assert {(x["region"], x["year"], x["month"], x["total_claims"], x["rejected_claims"],
             x["rejection_rate_pct"]) for x in r.collect()} == {
        ("East", 2022, 2, 3, 1, 33.33), ("North", 2022, 2, 1, 0, 0.0), (None, 2022, 2, 2, 0, 0.0)}
    assert "agg_timestamp" in r.columns
    t = gold.processing_time_by_severity(star["claims"]).collect()
    assert [(x["incident_severity"], x["total_claims"], x["avg_days_to_process"]) for x in t] == [
        ("major damage", 4, 16.0)]
    u = gold.unsold_by_model_region(star["sales"], star["car"]).collect()
    assert {(x["manufacturer"], x["region"], x["unsold_listings"], x["avg_days_listed"]) for x in u} == {
        ("maruti", "west", 1, None), (None, "north", 1, None)}
    u = gold.unsold_by_model_region(star["sales"], star["car"], as_of="2017-02-20").collect()
    assert {x["max_days_listed"] for x in u} == {10}
    v = gold.claim_value_by_region_policy(star["claims"], star["customer"], star["policy"]).collect()
    assert {(x["region"], x["policy_state"], float(x["total_claim_value"])) for x in v} == {
        ("East", "IL", 12000.0), ("North", "OH", 4000.0), (None, "OH", 4000.0), (None, None, 4000.0)}
    c = gold.customer_count_by_region(star["customer"]).collect()
    assert {x["duplicate_count"] for x in c} == {0}


def test_kpis(star):
    k = kpi.claims(star["claims"]).collect()[0]
    assert (k["total_claims"], k["total_rejected"], k["open_claims"], k["rejection_rate"]) == (6, 1, 2, 16.67)
    s = kpi.sales(star["sales"]).collect()[0]
    assert (s["total_sold"], s["total_unsold"], s["total_unsold_value"], s["sell_through_rate"]) == (
        1, 2, 1500.0, 33.33)
    empty = kpi.sales(star["sales"].limit(0)).collect()[0]
    assert empty["sell_through_rate"] == 0.0


def test_insights(star, spark):
    r = gold.rejection_by_region_month(star["claims"], star["customer"], star["date"])
    t = gold.processing_time_by_severity(star["claims"])
    got = kpi.insights([kpi.policy_domain(star["policy"]), kpi.claims_domain(star["claims"], r, t),
                        kpi.customer_domain(star["customer"], star["claims"])])
    assert ", ".join(f"{n} {x}" for n, x in got.dtypes) == K.INSIGHTS
    rows = {x["domain_name"]: x for x in got.collect()}
    assert len(rows) == 3 and '"top_5_states_by_volume":"OH (2), IL (1)"' in rows["policy_portfolio"]["kpi_json"]
    assert '"worst_region":"East"' in rows["claims_performance"]["kpi_json"]


def test_anomalies(layers, spark):
    scored = anomaly.score(layers["silver_claims"])
    got = {r["claim_id"]: r for r in scored.collect()}
    # every amount equals the p95, so the amount signal fires for all
    assert got[2]["anomaly_score"] == 30 + 15 + 10 and got[2]["priority_tier"] == "HIGH"
    assert got[13]["anomaly_score"] == 25 + 20 + 15 + 10
    assert got[13]["signals_fired"].split("; ")[0].startswith("Total claim amount")
    assert got[3]["sig_no_witnesses_multi_vehicle"] == 20 and got[2]["sig_long_open_claim"] == 0
    late = anomaly.score(layers["silver_claims"], as_of="2022-12-31")
    assert late.filter("claim_id = 2").collect()[0]["sig_long_open_claim"] == 10
    rep = anomaly.report(scored)
    assert ", ".join(f"{n} {x}" for n, x in rep.dtypes) == K.ANOMALY_REPORT
    assert {r["investigator_brief"] for r in rep.collect()} == {"CLAIM DETAILS"}
    near = anomaly.population(layers["silver_claims"], accuracy=10000).collect()[0]
    assert near["p95_amount"] == 4000.0 and near["mean_amount"] == 4000.0


def test_approximate_quantile_keeps_its_rank_error(spark):
    df = spark.range(20000).selectExpr("id as total_claim_amount", "1 witnesses", "1 bodily_injuries",
                                       "2 number_of_vehicles_involved")
    exact = anomaly.limits(df).collect()[0]["p95_amount"]
    near = anomaly.limits(df, accuracy=1000).collect()[0]["p95_amount"]
    assert exact == 18999.0 and abs(near - exact) <= 20000 / 1000


def test_retrieval_history_accumulates(star, spark, tmp_path):
    docs = retrieval.documents(star["policy"])
    text = {r["policy_number"]: r["text"] for r in docs.collect()}
    assert "does not include umbrella coverage" in text[5001] and "$6,000,000.00" in text[5008]
    vec = docs.selectExpr("policy_number as doc_id", "text",
                          "array(double(policy_number - 5000), 1.0D) as vector")
    q = spark.createDataFrame([(1, "first?", [1.0, 1.0])], "query_id int, question string, vector array<double>")
    found = retrieval.stats(q, retrieval.retrieve(q, vec, k=2))
    row = found.collect()[0]
    assert row["source_policies"] == "5001, 5002" and row["confidence_score"] == 1.0
    assert row["context"].startswith("[Source 1 — Policy 5001 (relevance score: 1.0000)]\nPolicy number 5001")
    rows = retrieval.answer(found)
    assert ", ".join(f"{n} {x}" for n, x in rows.dtypes) == K.RETRIEVAL_HISTORY
    for _ in range(2):
        tables.append(rows, f"{tmp_path}/history")
    stored = tables.read(spark, f"{tmp_path}/history")
    assert stored.count() == 2 and retrieval.latest(stored, 1).count() == 1
    none = retrieval.answer(retrieval.stats(q, retrieval.retrieve(q, vec.limit(0)))).collect()[0]
    assert none["answer"] == retrieval.NOTHING_FOUND and none["policy_found"] is False


def test_tables_replace_and_merge(spark, tmp_path):
    a, b = spark.range(3).toDF("x"), spark.range(2).selectExpr("id as x", "'n' as y")
    tables.overwrite(a, f"{tmp_path}/t")
    tables.append(b, f"{tmp_path}/t")
    assert tables.read(spark, f"{tmp_path}/t").columns == ["x", "y"]
    tables.overwrite(b, f"{tmp_path}/t")
    assert tables.read(spark, f"{tmp_path}/t").count() == 2


def test_previews(bronze, layers):
    b = bronze["claims"]
    from pyspark.sql import functions as F
    got = report.before_after(b, layers["silver_claims"], F.col("ClaimID").cast("int"), "claim_id",
                              {"severity": F.col("incident_severity")}, ("incident_severity",))
    assert Counter(r["claim_id"] for r in got.collect()) == {1: 2, 2: 1, 3: 1, 13: 1, 14: 1, 15: 1}
    assert {r["cnt"] for r in report.breakdown(layers["quarantine_cars"]).collect()} == {1}
    assert report.pass_counts({"a": layers["silver_cars"]}).collect()[0]["passed_records"] == 2


def test_whole_run(spark, tmp_path):
    from assayline.plans.run import run
    done = run(spark, fixture_files.write(f"{tmp_path}/raw"), f"{tmp_path}/out")
    assert done["gold/fact_claims"].count() == 6 and done["gold/insights"].count() == 3
    # all amounts and vehicle counts are equal, so each is at its p95: 15 + 10 = 25 for everyone
    assert done["gold/anomaly_report"].count() == 6
    assert done["silver/quality_log"].count() == done["gold/dq_report"].count()
    assert "agg_timestamp" in done["gold/unsold_by_model_region"].columns
    again = run(spark, f"{tmp_path}/raw", f"{tmp_path}/out")
    assert again["gold/fact_claims"].count() == 6


def test_table_comment(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS notes LOCATION '{tmp_path}/notes'")
    tables.overwrite(spark.range(3), "notes.t", comment="Gold: it's a test")
    try:
        assert tables.read(spark, "notes.t").count() == 3
        rows = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED notes.t").collect()}
        assert rows["Comment"] == "Gold: it's a test"
        got = report.table_counts(spark, ["notes.t", "notes.u"]).collect()
        assert [tuple(r) for r in got] == [("notes.t", True, 3), ("notes.u", False, None)]
    finally:
        spark.sql("DROP DATABASE notes CASCADE")


def test_json_type_inference(spark, tmp_path):
    fixture_files.write(str(tmp_path))
    df = ingest(spark, SOURCES["claims"], str(tmp_path), infer_types=True)
    assert df.schema["ClaimID"].dataType.simpleString() == "bigint"
