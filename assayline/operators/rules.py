"""Ordered quality rules: first matching reason, routing, expectations, quality log."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assayline.operators.latest import mark_latest

REASON, KIND, STAMP = "quarantine_reason", "quarantine_type", "quarantine_timestamp"
KINDS = ("drop", "quarantine")


@dataclass(frozen=True)
class Rule:
    """A reason and the condition under which a row fails for it.

    The condition is a column or SQL text. NULL means "does not fail": a rule that
    is to catch NULLs says so.
    """

    reason: str
    fails: Column | str

    def condition(self) -> Column:
        return F.expr(self.fails) if isinstance(self.fails, str) else self.fails


def first_reason(rules: Iterable[Rule], otherwise: str | None = None) -> Column:
    """Reason of the first rule that fails, or `otherwise`."""
    picks = [F.when(r.condition(), F.lit(r.reason)) for r in rules]
    return F.coalesce(*picks, F.lit(otherwise).cast("string"))


def tag_reason(df: DataFrame, rules: Sequence[tuple[str, str]],
               otherwise: str | None = "unknown") -> DataFrame:
    """Adds the first matching reason from (SQL condition, reason) pairs."""
    return df.withColumn(REASON, first_reason([Rule(r, c) for c, r in rules], otherwise))


def tag(df: DataFrame, key: str, rules: Sequence[Rule],
        drop_when: Column | None = None,
        derive: Callable[..., DataFrame] | None = None) -> DataFrame:
    """One frame that holds every input row with its outcome.

    A replaced duplicate and a row that fails a rule get reason and type; a row
    that passes has NULL in both. So each input row lands on exactly one side.
    `derive` adds columns to the marked rows before the rules are tested; it gets the frame
    and the name of the mark, which it keeps.
    """
    drop_when = F.lit(False) if drop_when is None else F.coalesce(drop_when, F.lit(False))
    marked = mark_latest(df, key)
    if derive is not None:
        marked = derive(marked, "_is_latest")
    reason = F.when(~F.col("_is_latest"), F.lit(f"duplicate {key}")).otherwise(first_reason(rules))
    return (
        marked.withColumn(REASON, reason)
        .withColumn(KIND, F.when(F.col(REASON).isNull(), F.lit(None).cast("string"))
                    .when(~F.col("_is_latest") | drop_when, F.lit("drop"))
                    .otherwise(F.lit("quarantine")))
        .drop("_is_latest")
    )


def passed(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON, KIND)


def rejected(tagged: DataFrame, stamp: bool = True) -> DataFrame:
    out = tagged.filter(F.col(REASON).isNotNull())
    return out.withColumn(STAMP, F.current_timestamp()) if stamp else out


def rule_set_failures(df: DataFrame, rules: Sequence[Rule], stamp: bool = True) -> DataFrame:
    """Older form: failing rows before any duplicate removal, with reason but no type.
    A row may be here and in the clean table as well."""
    out = df.withColumn(REASON, first_reason(rules)).filter(F.col(REASON).isNotNull())
    return out.withColumn(STAMP, F.current_timestamp()) if stamp else out


def union_all(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by name; with `allow_missing`, absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def quality_log(quarantines: Mapping[str, DataFrame], with_type: bool = True,
                stamp: bool = True, schema: str = "silver") -> DataFrame:
    """Rejected rows counted by entity, reason and type.

    Each table is counted first, so the shuffle carries one row per task and reason.
    """
    keys = [REASON, KIND] if with_type else [REASON]
    parts = [
        q.groupBy(*keys).agg(F.count(F.lit(1)).alias("failed_record_count")).select(
            F.lit(entity).alias("entity"),
            F.lit(f"{schema}.quarantine_{entity}").alias("quarantine_table"),
            *keys, "failed_record_count")
        for entity, q in quarantines.items()
    ]
    log = union_all(parts)
    return log.withColumn("log_timestamp", F.current_timestamp()) if stamp else log


@dataclass(frozen=True)
class Outcome:
    """Rows of one entity by what became of them: in, passed, and rejected by (reason, type)."""

    entity: str
    records: int
    passed: int
    rejected: Mapping[tuple[str, str], int]


def outcome_counts(reasons: Sequence[str]) -> list[Column]:
    """Aggregates over a tagged frame for `observe`: all rows, those that passed, and those
    rejected for each known reason and type."""
    none = F.lit(False)
    counts = [F.count(F.lit(1)).alias("records"), F.count_if(F.col(REASON).isNull()).alias("passed")]
    for i, reason in enumerate(reasons):
        for kind in KINDS:
            hit = F.coalesce((F.col(REASON) == reason) & (F.col(KIND) == kind), none)
            counts.append(F.count_if(hit).alias(f"{kind}_{i}"))
    return counts


def outcome_of(entity: str, reasons: Sequence[str], seen: Mapping[str, int]) -> Outcome:
    """Counts that were observed, checked: in = passed + rejected."""
    rejected = {(r, k): seen[f"{k}_{i}"] for i, r in enumerate(reasons) for k in KINDS if seen[f"{k}_{i}"]}
    if seen["passed"] + sum(rejected.values()) != seen["records"]:
        raise ValueError(f"{entity}: {seen['records']} rows, of which {seen['passed']} passed and "
                         f"{sum(rejected.values())} were rejected for a known reason")
    return Outcome(entity, seen["records"], seen["passed"], rejected)


def log_of(spark: SparkSession, outcomes: Iterable[Outcome], stamp: bool = True, schema: str = "silver") -> DataFrame:
    """The quality log out of observed counts: a row per entity, reason and type."""
    rows = [(o.entity, f"{schema}.quarantine_{o.entity}", r, k, n) for o in outcomes for (r, k), n in o.rejected.items()]
    log = spark.createDataFrame(rows, f"entity string, quarantine_table string, {REASON} string, {KIND} string, failed_record_count bigint")
    return log.withColumn("log_timestamp", F.current_timestamp()) if stamp else log


def reconciliation_of(spark: SparkSession, outcomes: Iterable[Outcome]) -> DataFrame:
    """Rows in, passed and rejected per entity out of observed counts."""
    return spark.createDataFrame([(o.entity, o.records, o.passed, o.records - o.passed) for o in outcomes],
                                 "entity string, records bigint, passed_records bigint, failed_records bigint")


def _holds(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def expect(df: DataFrame, warn: Mapping[str, str] | None = None,
           drop: Mapping[str, str] | None = None,
           observation: Observation | str | None = None) -> DataFrame:
    """Expectations: `warn` only counts, `drop` also removes the rows that break one.

    The counts are metrics of the same pass, under the name given; on a stream
    they arrive with each micro-batch. A condition that is NULL counts as broken.
    """
    rules = {**(warn or {}), **(drop or {})}
    if observation is not None and rules:
        df = df.observe(observation, *[
            F.sum(F.when(_holds(sql), 0).otherwise(1)).alias(name) for name, sql in rules.items()])
    for sql in (drop or {}).values():
        df = df.filter(_holds(sql))
    return df


def expectation_counts(df: DataFrame, warn: Mapping[str, str] | None = None,
                       drop: Mapping[str, str] | None = None) -> DataFrame:
    """The same counts as a table: one row per expectation, from a single aggregate."""
    rules = [(n, s, "warn") for n, s in (warn or {}).items()]
    rules += [(n, s, "drop") for n, s in (drop or {}).items()]
    broken = [F.coalesce(F.sum(F.when(_holds(s), 0).otherwise(1)), F.lit(0)).alias(f"b{i}")
              for i, (_, s, _) in enumerate(rules)]
    one = df.agg(F.count(F.lit(1)).alias("n"), *broken)
    rows = F.array(*[
        F.struct(F.lit(n).alias("expectation"), F.lit(action).alias("action"),
                 (F.col("n") - F.col(f"b{i}")).alias("passed_records"),
                 F.col(f"b{i}").alias("failed_records"))
        for i, (n, _, action) in enumerate(rules)])
    return one.select(F.inline(rows))
