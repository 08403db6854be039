"""Text built from rows: amounts, labels, sentences and briefs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayline.functions.clean import as_col

_BLANKS = " \t\n\r\x0b\x0c"


def stripped(c) -> Column:
    return F.btrim(as_col(c), F.lit(_BLANKS))


def dollars(c) -> Column:
    """'$1,234.50', or 'not specified' for NULL."""
    c = as_col(c)
    return F.when(c.isNull(), F.lit("not specified")).otherwise(
        F.concat(F.lit("$"), F.format_number(c.cast("decimal(20,4)"), 2)))


def dollars_text(c) -> Column:
    """The same for a string column; blank, 'none' and 'null' are not specified, and
    text that is no number stays as it is."""
    c = as_col(c)
    unset = c.isNull() | F.lower(c).isin("none", "null", "")
    amount = c.try_cast("double")
    return (F.when(unset, F.lit("not specified"))
            .when(amount.isNull(), c)
            .otherwise(F.concat(F.lit("$"), F.format_number(amount, 2))))


def grouped(c) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(as_col(c).cast("bigint"), 0)


def spaced(c) -> Column:
    """Underscores shown as spaces."""
    return F.translate(as_col(c), "_", " ")


def shown(c, default: str) -> Column:
    """Value as text, or the default for NULL."""
    return F.coalesce(as_col(c).cast("string"), F.lit(default))


def short_id() -> Column:
    """Eight upper-case characters of a random id."""
    return F.upper(F.substring(F.expr("uuid()"), 1, 8))


def response_text(c) -> Column:
    """Plain answer out of a block response.

    A JSON list of blocks gives its first non-empty text block, else its first
    non-empty summary text of a reasoning block; any other content is the answer.
    """
    raw = stripped(c)
    block = "array<struct<type:string,text:string,summary:array<struct<type:string,text:string>>>>"
    blocks = F.when(F.startswith(raw, F.lit("[")), F.from_json(raw, block))
    texts = F.transform(F.filter(blocks, lambda b: b["type"] == "text"),
                        lambda b: stripped(b["text"]))
    notes = F.flatten(F.transform(
        F.filter(blocks, lambda b: (b["type"] == "reasoning") & b["summary"].isNotNull()),
        lambda b: F.transform(F.filter(b["summary"], lambda s: s["type"] == "summary_text"),
                              lambda s: stripped(s["text"]))))
    return F.coalesce(_first_filled(texts), _first_filled(notes), raw)


def _first_filled(texts: Column) -> Column:
    return F.get(F.filter(texts, lambda t: t != ""), F.lit(0))


def block_text(c, index: int = 1) -> Column:
    """Text of one block by position: path `$[index]`, then `$.text`."""
    return F.get_json_object(F.get_json_object(as_col(c), f"$[{index}]"), "$.text")


# The wording below, in the sentence and in the labels of the briefs, is fixed: stored
# texts and whatever was derived from them depend on it.
def policy_sentence() -> Column:
    """One policy row as prose, the unit of retrieval."""
    active = F.when(F.coalesce(F.col("is_active"), F.lit(False)),
                    F.lit("currently active and in force")).otherwise(
                        F.lit("currently inactive"))
    umbrella = F.when(
        F.col("umbrella_limit") > 0,
        F.concat(F.lit("This policy includes umbrella coverage with a limit of "),
                 dollars("umbrella_limit"), F.lit(".")),
    ).otherwise(F.lit("This policy does not include umbrella coverage."))
    return F.concat(
        F.lit("Policy number "), shown("policy_number", "None"),
        F.lit(" is registered in "), shown("policy_state", "None"),
        F.lit(" and was bound on "), shown("policy_bind_date", "None"),
        F.lit(". The policy is "), active,
        F.lit(". The annual premium for this policy is "), dollars("annual_premium"),
        F.lit(". The deductible — the amount the customer pays out of pocket before "
              "coverage kicks in — is "), dollars("deductible"),
        F.lit(". Bodily injury coverage limits are "), dollars("csl_bodily_injury_per_person"),
        F.lit(" per person and "), dollars("csl_bodily_injury_per_accident"),
        F.lit(" per accident. "), umbrella,
        F.lit(" This policy is linked to customer ID "), shown("customer_id", "None"),
        F.lit(" and vehicle ID "), shown("car_id", "None"), F.lit("."))


def lines(pairs: list[tuple[str, Column]], indent: str = "") -> Column:
    """'label: value' lines; the label is padded by its writer."""
    return F.concat_ws("\n", *[
        F.concat(F.lit(indent + label), value.cast("string")) for label, value in pairs])


def word(c, default: str = "unknown") -> Column:
    """Text, with NULL and '' shown as the default."""
    c = as_col(c).cast("string")
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)


def mark(c) -> Column:
    """Yes for true; No for false and NULL."""
    return F.when(F.coalesce(as_col(c), F.lit(False)), F.lit("Yes")).otherwise(F.lit("No"))


def claim_brief() -> Column:
    """Facts of one scored claim, as the input of a memo."""
    amount = F.coalesce(F.col("total_claim_amount"), F.lit(0).cast("decimal(14,2)"))
    return lines([
        ("CLAIM DETAILS", F.lit("")),
        ("Claim ID:              ", F.col("claim_id")),
        ("Total claim amount:    ", dollars(amount)),
        ("Incident date:         ", word("incident_date")),
        ("Claim logged on:       ", word("claim_logged_on")),
        ("Claim status:          ", word("claim_status")),
        ("Days to process:       ", shown("days_to_process", "still open")),
        ("Incident type:         ", word("incident_type")),
        ("Incident severity:     ", word("incident_severity")),
        ("Collision type:        ", word("collision_type")),
        ("State:                 ", word("incident_state")),
        ("Bodily injuries:       ", shown("bodily_injuries", "0")),
        ("Vehicles involved:     ", shown("number_of_vehicles_involved", "0")),
        ("Witnesses:             ", shown("witnesses", "none on record")),
        ("Police report filed:   ", mark("police_report_available")),
        ("Property damage:       ", mark("property_damage")),
        ("Claim rejected flag:   ", mark("is_rejected")),
        ("Anomaly score:         ", F.concat(F.col("anomaly_score").cast("string"), F.lit("/100"))),
        ("Anomaly signals fired: ", F.col("signals_fired")),
    ])


def issue_brief() -> Column:
    """Facts of one quality issue."""
    return lines([
        ("Data Quality Issue Details:", F.lit("")),
        ("  - Record type   : ", F.col("entity")),
        ("  - Problem area  : ", spaced("column_name")),
        ("  - Issue detected: ", spaced("quarantine_reason")),
        ("  - Severity      : ", F.col("severity")),
        ("  - Records affected: ", grouped("affected_records")),
    ])


def entity_brief() -> Column:
    """Facts of all issues of one entity; `issues` is a list of (reason, count)."""
    bullets = F.transform("issues", lambda i: F.concat(
        F.lit("  • "), spaced(i["quarantine_reason"]), F.lit(": "),
        grouped(i["failed_record_count"]), F.lit(" records")))
    return lines([
        ("Entity: ", F.upper("entity")),
        ("Total failed records: ", grouped("total_failed")),
        ("Failure breakdown:\n", F.array_join(bullets, "\n")),
    ])
