import pytest

import __spark_entry__ as entry
from assayline.checks.oracle import ORACLE
from assayline.checks.queries import QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, FOLDER, name) == []


def test_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries()) 
    assert set(QUERIES) == set(ORACLE) <= set(entry.queries())
    assert entry.entry(spark).columns == [
        "region", "year", "month", "total_claims", "rejected_claims", "rejection_rate_pct"]


def test_raw_claim_files_are_few(spark):
    """Files of a few hundred records each were 72,000 for 36 million claims."""
    df = QUERIES["bronze_claims_array"](spark, FOLDER)
    assert len(df.inputFiles()) < 8 and df.count() > 5_000


def test_raw_claims_are_packed(spark):
    """The names in every record made the files ten times as long as the values."""
    files = QUERIES["bronze_claims"](spark, FOLDER).inputFiles()
    assert files and all(f.endswith(".json.gz") for f in files)


@pytest.mark.parametrize("name", ["anomaly_rate", "kpi_insights", "kpi_json"])
def test_stored_claims_have_only_columns_that_are_read(spark, monkeypatch, name):
    from assayline.checks import queries as Q
    from assayline.plans import anomaly, kpi
    read = {"anomaly_rate": anomaly.CLAIMS_READ, "kpi_insights": kpi.FACTS_READ, "kpi_json": ("customer_id",)}[name]
    stored, stage = {}, Q.stage

    def noted(df, table):
        stored[table] = df.columns
        return stage(df, table)

    monkeypatch.setattr(Q, "stage", noted)
    Q.QUERIES[name](spark, FOLDER)
    tables = {t: set(c) for t, c in stored.items() if t.endswith("-claims")}
    assert list(tables.values()) == [set(read)]
