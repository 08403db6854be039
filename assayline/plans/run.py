"""All layers in order, each stored before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assayline.operators import rules as R
from assayline.operators.enrich import STUB_NAME, first_line
from assayline.plans import anomaly, gold, kpi, quality, silver
from assayline.sources import tables
from assayline.sources.files import SOURCES, Source, file_log, ingest


def run(spark: SparkSession, raw: str, out: str, sources: dict[str, Source] | None = None,
        generate: Callable[[str], str] = first_line, model: str = STUB_NAME,
        as_of: str | None = None) -> dict[str, DataFrame]:
    """Raw files to report tables below `out`. Returns every stored table by name.

    A stored table cuts the lineage: a lost executor costs the tasks of one layer,
    and a run that stopped can be started again, since every write replaces.
    """
    done: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, comment: str | None = None) -> DataFrame:
        tables.overwrite(df, f"{out}/{name}", comment)
        done[name] = tables.read(spark, f"{out}/{name}")
        return done[name]

    bronze = {e: keep(f"bronze/{e}", ingest(spark, s, raw))
              for e, s in (sources or SOURCES).items()}
    keep("bronze/file_log", file_log(bronze))

    layer, outcomes = silver.build_counted(spark, bronze, f"{out}/silver")
    done.update({f"silver/{n}": df for n, df in layer.items()})
    log = keep("silver/quality_log", R.log_of(spark, outcomes.values()))

    dates = keep("gold/dim_date", gold.dim_date(spark))
    customers = keep("gold/dim_customer", gold.dim_customer(layer["silver_customers"]))
    cars = keep("gold/dim_car", gold.dim_car(layer["silver_cars"]))
    policies = keep("gold/dim_policy", gold.dim_policy(layer["silver_policy"]))
    claims = keep("gold/fact_claims",
                  gold.fact_claims(layer["silver_claims"], layer["silver_policy"]))
    sales = keep("gold/fact_sales", gold.fact_sales(layer["silver_sales"]))

    rejections = keep("gold/rejection_by_region_month",
                      gold.rejection_by_region_month(claims, customers, dates))
    times = keep("gold/processing_time_by_severity", gold.processing_time_by_severity(claims))
    keep("gold/unsold_by_model_region", gold.unsold_by_model_region(sales, cars, as_of))
    keep("gold/claim_value_by_region_policy",
         gold.claim_value_by_region_policy(claims, customers, policies))
    keep("gold/customer_count_by_region", gold.customer_count_by_region(customers))

    keep("gold/dq_report", quality.issue_report(quality.issues(log), generate, model))
    scored = anomaly.score(layer["silver_claims"], as_of=as_of)
    keep("gold/anomaly_report", anomaly.report(scored, generate, model))
    keep("gold/insights", kpi.insights(
        [kpi.policy_domain(policies), kpi.claims_domain(claims, rejections, times),
         kpi.customer_domain(customers, claims)], generate, model))
    return done
