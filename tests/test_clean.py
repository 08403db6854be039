from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assayline import contracts as K
from assayline.functions import clean as C
from assayline.functions import flags as W
from assayline.functions import text as X


def test_vocabulary(values):
    assert values(["terto", "Secondary", "college", None], C.vocabulary("c", K.EDUCATION)) == [
        "tertiary", "secondary", None, None]
    assert values(["W", "north", "Q"], C.vocabulary("c", K.REGIONS, "?")) == ["West", "North", "?"]
    assert values(["kept"], C.vocabulary("c", {})) == ["kept"]


def test_code_expansion_is_case_sensitive_and_has_no_north(values):
    assert values(["W", "West", "w", "N", None], C.expand_code("c")) == [
        "West", "West", None, None, None]


def test_tokens(values):
    assert values(["?", "x", None], C.null_token("c", "?")) == [None, "x", None]
    assert values(["Null", "NULLS"], C.null_token("c", "NULL", fold_case=True)) == [None, "NULLS"]
    assert values([" NA ", "na"], C.null_token("c", "NA", trim=True)) == [None, "na"]
    assert values([" NA ", "na"], C.null_token("c", "NA", fold_case=True)) == [" NA ", None]


def test_trailing_dot(values):
    assert values(["admin.", "a.b", "x.."], C.without_trailing_dot("c")) == ["admin", "a.b", "x."]


def test_numbers_in_text(values):
    got = values(["23.4 kmpl", "1248 CC", "190Nm@ 2,000rpm", "n/a", "", None],
                 C.first_number("c"))
    assert got == [23.4, 1248.0, 190.0, None, None, None]
    assert values(["1,248 CC"], C.first_number("c")) == [1248.0]
    assert values(["1,248 CC", "1.2.3"], C.plain_number("c")) == [1.0, None]


def test_pairs(values):
    raw = values(["100/300", "100", "a/b", None], C.pair_part("c", 0), C.pair_part("c", 1))
    assert raw == [[100, 100, None, None], [300, None, None, None]]
    scaled = values(["100/300", "100"], C.pair_part_scaled("c", 0), C.pair_part_scaled("c", 1))
    assert scaled == [[100000, None], [300000, None]]
    assert values(["9999999/1"], C.pair_part_scaled("c", 0)) == [None]


def test_typed_numbers(values):
    assert values(["3", "?", "NULL", "null", "x"], C.number("c", "int")) == [3, None, None, None, None]
    assert values(["1200.5"], C.number("c", "decimal(10,2)")) == [Decimal("1200.50")]


def test_booleans(values):
    assert values(["YES", "no", "?", None], C.yes_no("c")) == [True, False, None, None]
    assert values(["Y", "n", "maybe"], C.y_n("c")) == [True, False, None]


def test_dates(values):
    assert values(["2016-04-01", "01/04/2016", ""], C.iso_date("c")) == [date(2016, 4, 1), None, None]
    assert values(["10-02-2017 20:22", "2017-02-10"], C.day_first_time("c")) == [
        datetime(2017, 2, 10, 20, 22), None]
    assert values(["2017-03-20", None], C.days_between(F.col("c").cast("date"),
                  F.lit("2017-02-10").cast("date"))) == [38, None]
    assert values(["2017-03-20", None], C.date_key(F.col("c").cast("date"))) == [20170320, None]


def test_broken_times(values):
    assert values(["34:00.0", "2017-03-15"], C.without_broken_time("c")) == [None, "2017-03-15"]
    assert values(["08:30.0", "08:30", "27:00.0", "x", None], C.clock_time("c")) == [
        datetime(1970, 1, 1, 8, 30), datetime(1970, 1, 1, 8, 30), None, None, None]
    assert values(["27:00.0", "08:30.0", None], W.parse_loss("c", C.clock_time("c"))) == [1, 0, 0]
    assert values(["45:00.0", "03:00.0", "00:10.0"],
                  C.salvaged_duration(F.lit("03:00.0"), "c")) == [42, 0, None]


def test_totals_and_presence(values):
    total = C.total(F.lit(1000), F.lit(500), F.lit(None).cast("decimal(10,2)"))
    assert values(["x"], total) == [Decimal("1500.00")]
    assert values(["x", None], C.by_presence("c", "sold", "listed")) == ["sold", "listed"]
    assert values([-1000000, 0, None], C.null_if_negative("c"), dtype="bigint") == [None, 0, None]


def test_flags(values):
    assert values([-1, 0, None], W.negative("c"), dtype="int") == [1, 0, 0]
    assert values([600000, 5, None], W.above("c", K.KM_OUTLIER), dtype="int") == [1, 0, 0]
    assert values([7, 1, None], W.not_among("c", (0, 1)), dtype="int") == [1, 0, 1]
    assert values([" ", "x", None], W.blank("c"), W.missing("c")) == [[1, 0, 1], [0, 0, 1]]
    assert values([-1, 2, None], W.missing_or_negative("c"), dtype="int") == [1, 0, 1]


@pytest.mark.parametrize("f", [
    C.first_number, C.plain_number, lambda c: C.pair_part(c, 1), lambda c: C.pair_part_scaled(c, 0),
    lambda c: C.number(c, "int"), lambda c: C.number(c, "decimal(10,2)"), C.yes_no, C.y_n,
    C.iso_date, C.day_first_time, C.clock_time, C.leading_digits, C.without_broken_time,
    lambda c: C.vocabulary(c, K.REGIONS), C.expand_code, X.dollars_text, X.response_text,
    X.block_text])
def test_malformed_text_never_fails(values, f):
    texts = ["", " ", "?", "12x", "1e400", "99999999999999999999", "31-02-2020 25:61", "-/-",
             "2020-13-45", "[", "[{]", '[{"type": 5}]', "é/ü", None]
    assert len(values(texts, f("c"))) == len(texts)


def test_variants_and_swap(spark):
    df = spark.createDataFrame([("x1", "7", "customers_6.csv", "m", "e"),
                                ("5", "8", "customers_1.csv", "e", "m")],
                               "CustomerID string, cust_id string, _source_file string, a string, b string")
    got = df.select(C.first_present(df.columns, ("customerid", "customer_id", "cust_id"), "int")
                    .alias("id"), C.first_present(df.columns, ("edu",)).alias("none"))
    assert [tuple(r) for r in got.collect()] == [(7, None), (5, None)]
    back = df.withColumns(C.swapped("a", "b", F.col("_source_file").contains("customers_6")))
    assert [tuple(r) for r in back.select("a", "b").collect()] == [("e", "m"), ("e", "m")]


def test_amount_text(values):
    assert values([1234.5, None], X.dollars("c"), dtype="double") == ["$1,234.50", "not specified"]
    assert values(["None", "", "12", "n/a"], X.dollars_text("c")) == [
        "not specified", "not specified", "$12.00", "n/a"]


def test_response_text(values):
    got = values([
        " plain ", '[{"type":"text","text":" a "}]',
        '[{"type":"reasoning","summary":[{"type":"summary_text","text":"r"}]}]',
        '[{"type":"text","text":" "},{"type":"reasoning","summary":[{"type":"summary_text","text":"r"}]},'
        '{"type":"text","text":"b"}]',
        '{"type":"text","text":"one"}', '[not json', "[{'type': 'text', 'text': 'single'}]"],
        X.response_text("c"))
    assert got == ["plain", "a", "r", "b", '{"type":"text","text":"one"}', "[not json", "single"]


def test_iso_date_reads_what_the_format_reads(spark, values):
    """Plain dates are cast, without the cost of a format; the rest reads as before."""
    texts = ["2020-01-05", "2020-1-5", "2020-02-30", "2000-02-29", "1900-02-29", "0000-01-01", "+12345-01-01", "+2020-01-01", "-0001-01-01",
             "2020-01-01 ", " 2020-01-01", "2020-01-01\n", "2020-01-1T", "2020-01-01T", "12020-01-01", "", None, "34:00.0", "now", "epoch",
             "２０２０-01-01", "2020-13-01", "2020", "2020-01", "1582-10-10", "9999-12-31", "2020-01-01 10:00"]
    by_format, got = values(texts, F.try_to_date("c", "yyyy-MM-dd").cast("string"), C.iso_date("c").cast("string"))
    assert got == by_format and got[:4] == ["2020-01-05", None, None, "2000-02-29"]
    plan = spark.range(1).select(C.iso_date(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(" in plan.split("gettimestamp")[0] and "as date" in plan.split("gettimestamp")[0]
