"""Anomaly scores of claims from weighted signals with thresholds taken from the data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline import contracts as K
from assayline.functions import text as X
from assayline.operators.enrich import STUB_NAME, first_line, with_text
from assayline.operators.quantiles import exact_quantiles

QUANTILES = {
    "p95_amount": ("total_claim_amount", 0.95),
    "p99_amount": ("total_claim_amount", 0.99),
    "p5_witnesses": ("witnesses", 0.05),
    "p95_injuries": ("bodily_injuries", 0.95),
    "p95_vehicles": ("number_of_vehicles_involved", 0.95),
}
LIMITS = ("p95_amount", "p95_injuries", "p95_vehicles")  # those the signals use
#: Columns that limits and signals are taken from.
CLAIMS_READ = ("total_claim_amount", "bodily_injuries", "number_of_vehicles_involved", "witnesses", "is_rejected",
               "property_damage", "police_report_available", "claim_status", "claim_logged_on", "days_to_process")


def limits(claims: DataFrame, accuracy: int | None = None) -> DataFrame:
    """One row with the limits the signals compare with.

    Exact by default. With an accuracy, a mergeable sketch answers in one pass with
    a rank error of at most 1/accuracy.
    """
    wanted = {n: QUANTILES[n] for n in LIMITS}
    return _quantiles(claims, wanted, accuracy)


def _quantiles(claims, wanted, accuracy) -> DataFrame:
    if accuracy is None:
        return exact_quantiles(claims, wanted)
    return claims.agg(*[
        F.percentile_approx(c, p, accuracy).cast("double").alias(n)
        for n, (c, p) in wanted.items()])


def population(claims: DataFrame, accuracy: int | None = None) -> DataFrame:
    """One row: all five quantiles, mean and sample standard deviation of the amount."""
    spread = claims.agg(F.mean("total_claim_amount").cast("double").alias("mean_amount"),
                        F.stddev("total_claim_amount").alias("std_amount"))
    marks = _quantiles(claims, QUANTILES, accuracy).select(F.struct(*QUANTILES).alias("m"))
    return spread.withColumn("m", marks.scalar()).select("m.*", "mean_amount", "std_amount")


def _conditions(as_of: str | None) -> dict[str, Column]:
    def limit(name):
        return F.coalesce(F.col(f"_limits.{name}"), F.lit(0.0))

    days = F.col("days_to_process")
    if as_of is not None:
        days = F.coalesce(days, F.datediff(F.lit(as_of).cast("date"), F.col("claim_logged_on")))
    vehicles, witnesses = F.col("number_of_vehicles_involved"), F.col("witnesses")
    return {
        "sig_rejected_with_payout": F.col("is_rejected") & (F.col("total_claim_amount") > 0),
        "sig_damage_no_police": F.col("property_damage") & ~F.col("police_report_available"),
        "sig_no_witnesses_multi_vehicle":
            (vehicles > 1) & ((witnesses == 0) | witnesses.isNull()),
        "sig_high_amount": F.col("total_claim_amount").cast("double") >= limit("p95_amount"),
        "sig_extreme_severity":
            (F.col("bodily_injuries") >= limit("p95_injuries"))
            | (vehicles >= limit("p95_vehicles")),
        "sig_long_open_claim": (F.col("claim_status") == "open") & (days > K.LONG_OPEN_DAYS),
    }


def score(claims: DataFrame, thresholds: DataFrame | None = None,
          as_of: str | None = None) -> DataFrame:
    """Claims with a weight per signal, their sum, the tier and the fired labels.

    An open claim has no days to process, so without `as_of`, the day to count to,
    the long-open signal stays at 0. The thresholds enter as one scalar row.
    """
    thresholds = limits(claims) if thresholds is None else thresholds
    signals = {
        name: F.when(condition, F.lit(K.SIGNALS[name][0])).otherwise(F.lit(0))
        for name, condition in _conditions(as_of).items()}
    total = sum((F.col(n) for n in signals), F.lit(0))
    high, medium = K.TIER_BOUNDS
    fired = F.concat_ws("; ", *[
        F.when(F.col(n) > 0, F.lit(label)) for n, (_, label) in K.SIGNALS.items()])
    return (
        claims.withColumn("_limits", thresholds.select(F.struct(*LIMITS).alias("l")).scalar())
        .withColumns(signals).drop("_limits")
        .withColumn("anomaly_score", total)
        .withColumns({
            "priority_tier": F.when(F.col("anomaly_score") >= high, "HIGH")
            .when(F.col("anomaly_score") >= medium, "MEDIUM").otherwise("LOW"),
            "signals_fired": fired}))


def flagged(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("anomaly_score") >= K.FLAG_FROM)


def tier_counts(scored: DataFrame) -> DataFrame:
    """Claims per tier with their share of all claims; LOW holds the unflagged."""
    n = scored.groupBy("priority_tier").agg(F.count(F.lit(1)).alias("claims"))
    all_claims = scored.agg(F.count(F.lit(1)).alias("n")).scalar()
    return n.withColumn("share_pct", F.round(F.col("claims") * 100.0 / all_claims, 2))


def flag_rate(scored: DataFrame) -> DataFrame:
    """One row: all claims, flagged claims, percentage."""
    hit = F.count_if(F.col("anomaly_score") >= K.FLAG_FROM)
    return scored.agg(F.count(F.lit(1)).alias("total_claims"), hit.alias("flagged_claims")).select(
        "*", F.coalesce(F.round(F.try_divide(100 * F.col("flagged_claims"), F.col("total_claims")),
                                1), F.lit(0.0)).alias("flagged_pct"))


def report(scored: DataFrame, generate: Callable[[str], str] = first_line,
           model: str = STUB_NAME, stamp: bool = True) -> DataFrame:
    """Flagged claims with a memo each, in the stored schema. Read it with the highest
    score first; a stored table has no order."""
    made = with_text(flagged(scored).withColumn("_brief", X.claim_brief()), "_brief",
                     "investigator_brief", generate, model)
    out = made.select(
        "claim_id", "anomaly_score", "priority_tier",
        F.coalesce(F.col("total_claim_amount").cast("double"), F.lit(0.0))
        .alias("total_claim_amount"),
        F.coalesce("incident_severity", F.lit("")).alias("incident_severity"),
        F.coalesce("incident_type", F.lit("")).alias("incident_type"),
        "signals_fired", "investigator_brief", "generation_status")
    return out.withColumn("generated_at", F.current_timestamp()) if stamp else out
