"""Registered queries: each takes (spark, folder) and runs library code over whole tables.

Outputs hold text, whole numbers, doubles and booleans only, so that engines can be
compared; clocks and random ids are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline import contracts as K
from assayline.checks import raw
from assayline.functions import clean as C
from assayline.functions import flags as W
from assayline.functions import text as X
from assayline.operators import enrich
from assayline.operators import latest as L
from assayline.operators import report as P
from assayline.operators import rules as R
from assayline.operators.similar import cosine_top_k
from assayline.plans import anomaly, gold, kpi, quality, retrieval
from assayline.plans import silver as S
from assayline.session import scratch
from assayline.sources import files as SRC
from assayline.sources import tables
from assayline.sources.tables import tpc
from assayline.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as double."""
    def plain(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        return c
    return df.select(*[plain(f) for f in df.schema.fields])


def stage(df: DataFrame, name: str) -> DataFrame:
    """A frame that is read several times, written once to the shared folder."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# --- the layers -------------------------------------------------------------
def bronze(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    return raw.bronze(spark, folder, entity)


def tagged(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    return S.ENTITIES[entity].tagged(bronze(spark, folder, entity))


def silver(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    return R.passed(tagged(spark, folder, entity))


DIMS = {"customer": (gold.dim_customer, "customers"), "car": (gold.dim_car, "cars"), "policy": (gold.dim_policy, "policy")}


def dims(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """The named dimensions; only these are built, as the keys of an entity are read for it."""
    return {n: gold.dim_date(spark) if n == "date" else DIMS[n][0](silver(spark, folder, DIMS[n][1])) for n in names}


def facts(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_claims(silver(spark, folder, "claims"), silver(spark, folder, "policy"))


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_sales(silver(spark, folder, "sales"))


# --- scalar functions -------------------------------------------------------
@query
def vocab_map(spark, folder):
    words = {"building": "construction", "automobile": "vehicles", "machinery": "vehicles",
             "household": "home"}
    return tpc(spark, folder, "customer").select(
        "c_custkey", C.vocabulary("c_mktsegment", words).alias("label"),
        C.vocabulary("c_mktsegment", words, "other").alias("label_or_other"),
        C.vocabulary("c_mktsegment", {}).alias("unmapped"))


@query
def code_expand(spark, folder):
    words = {"R": "Returned", "A": "Accepted"}
    return (tpc(spark, folder, "lineitem")
            .select(C.expand_code("l_returnflag", words).alias("word"),
                    C.expand_code(F.concat("l_returnflag", "l_linestatus"), words).alias("pair"))
            .groupBy("word", "pair").agg(F.count(F.lit(1)).alias("n")))


@query
def extract_number(spark, folder):
    return tpc(spark, folder, "part").select(
        "p_partkey", C.first_number("p_brand").alias("brand_no"),
        C.first_number("p_name").alias("name_no"),
        C.first_number(F.concat(F.lit("1,"), F.col("p_size").cast("string"), F.lit(".5 CC")))
        .alias("engine_cc"),
        C.plain_number(F.concat(F.lit("about 1,"), F.col("p_size").cast("string"), F.lit(" CC")))
        .alias("engine_plain"))


@query
def split_pair(spark, folder):
    pair = F.concat((F.col("o_custkey") % 500).cast("string"),
                    F.when(F.col("o_orderstatus") == "P", "").otherwise(
                        F.concat(F.lit("/"), (F.col("o_orderkey") % 900).cast("string"))))
    df = tpc(spark, folder, "orders").select("o_orderkey", pair.alias("pair"))
    return df.select(
        "o_orderkey", C.pair_part("pair", 0).alias("left_raw"),
        C.pair_part("pair", 1).alias("right_raw"),
        C.pair_part_scaled("pair", 0).alias("left_dollars"),
        C.pair_part_scaled("pair", 1).alias("right_dollars"))


@query
def placeholder_cast(spark, folder):
    k = F.get_json_object("props", "$.k")
    text = (F.when(k.cast("int") % 10 == 0, F.lit("?"))
            .when(k.cast("int") % 10 == 1, F.lit("null")).when(k.cast("int") % 10 == 2, F.lit(" NA "))
            .when(k.cast("int") % 10 == 3, F.lit("Null")).otherwise(k))
    df = tpc(spark, folder, "events").select("event_id", text.alias("t"))
    return df.select(
        "event_id", C.number("t", "int").alias("as_int"),
        C.number("t", "decimal(10,2)", ("?",)).cast("double").alias("as_amount"),
        C.null_token("t", "?").alias("no_mark"),
        C.null_token("t", "NULL", fold_case=True).alias("no_null"),
        C.null_token("t", "NA", trim=True).alias("no_na"))


@query
def bool_map(spark, folder):
    return (tpc(spark, folder, "lineitem").select(
        C.truth("l_returnflag", "r", "a").alias("returned"),
        C.truth("l_linestatus", "O", "F").alias("is_open"),
        C.y_n(F.when(F.col("l_linenumber") > 3, "y").otherwise("N")).alias("late"),
        C.yes_no(F.when(F.col("l_quantity") > 25, "yes").when(F.col("l_quantity") > 10, "NO")
                 .otherwise("?")).alias("bulk"))
        .groupBy("returned", "is_open", "late", "bulk").agg(F.count(F.lit(1)).alias("n")))


@query
def parse_dates(spark, folder):
    day = F.col("o_orderdate").cast("date").cast("string")
    iso = F.when(F.col("o_orderkey") % 9 == 0, "01/04/2016").when(
        F.col("o_orderkey") % 9 == 1, "").otherwise(day)
    dmy = F.concat(F.substring(day, 9, 2), F.lit("-"), F.substring(day, 6, 2), F.lit("-"),
                   F.substring(day, 1, 4), F.lit(" 20:22"))
    dmy = F.when(F.col("o_orderkey") % 7 == 0, day).otherwise(dmy)
    df = tpc(spark, folder, "orders").select(
        "o_orderkey", C.iso_date(iso).alias("d"), C.day_first_time(dmy).alias("t"))
    return portable(df.select(
        "o_orderkey", "d", "t", C.days_between("d", "t").alias("days"),
        C.date_key("d").alias("d_key"), C.by_presence("d", "dated", "undated").alias("status")))


@query
def broken_time(spark, folder):
    ts = F.col("ts").cast("string")
    clock = F.concat(F.substring(ts, 15, 2), F.lit(":"), F.substring(ts, 18, 2), F.lit(".0"))
    later = F.concat(F.substring(ts, 18, 2), F.lit(":00.0"))
    df = tpc(spark, folder, "events").select(
        "event_id", clock.alias("a"),
        F.when(F.col("event_type") == "view", F.substring(ts, 1, 10)).otherwise(later).alias("b"))
    return portable(df.select(
        "event_id", C.without_broken_time("a").alias("a_kept"),
        C.without_broken_time("b").alias("b_kept"), C.clock_time("a").alias("a_time"),
        W.parse_loss("a", C.clock_time("a")).alias("a_warning"),
        C.leading_digits("b").alias("b_minute"),
        C.salvaged_duration("a", "b").alias("duration")))


@query
def sum_amounts(spark, folder):
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    a = F.when(F.col("l_returnflag") != "R", price)
    b = F.when(F.col("l_linestatus") == "O", price - 40000)
    df = tpc(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", C.total(a, b).alias("t"),
        C.null_if_negative(b).alias("b"), W.negative(b).alias("neg"))
    return portable(df.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("t").alias("total"), F.sum("b").alias("kept"), F.sum("neg").alias("negatives"),
        F.count("b").alias("kept_count")))


@query
def coalesce_variants(spark, folder):
    c = tpc(spark, folder, "customer")
    one = c.filter("c_nationkey < 12").select(
        F.col("c_custkey").cast("string").alias("CustomerID"), F.col("c_mktsegment").alias("Reg"))
    two = c.filter("c_nationkey >= 12").select(
        F.concat(F.when(F.col("c_nationkey") == 12, "x").otherwise(""),
                 F.col("c_custkey").cast("string")).alias("cust_id"),
        F.lower("c_mktsegment").alias("Region"))
    df = S.lower_names(one.unionByName(two, allowMissingColumns=True))
    return df.select(
        C.first_present(df.columns, ("customerid", "customer_id", "cust_id"), "int").alias("id"),
        C.first_present(df.columns, ("reg", "region")).alias("region"),
        C.first_present(df.columns, ("edu",)).alias("absent"))


@query
def swap_columns(spark, folder):
    df = tpc(spark, folder, "events").select(
        "event_id", "event_type", "props",
        F.concat(F.lit("/raw/"), F.col("event_type"), F.lit("_6.csv")).alias("_source_file"))
    return df.withColumns(C.swapped("event_type", "props",
                                    F.col("_source_file").contains("click_6")))


@query
def text_case(spark, folder):
    return tpc(spark, folder, "part").select(
        "p_partkey", F.lower("p_type").alias("low"), F.upper(F.trim(
            F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))).alias("up"),
        C.without_trailing_dot(F.concat("p_name", F.lit(".."))).alias("undotted"),
        X.spaced(F.translate("p_name", " ", "_")).alias("spaced"),
        X.dollars("p_retailprice").alias("price_text"),
        X.dollars_text(F.when(F.col("p_size") < 10, "None").when(F.col("p_size") < 20, "n/a")
                       .otherwise(F.col("p_size").cast("string"))).alias("size_text"))


@query
def warn_flags(spark, folder):
    c = tpc(spark, folder, "customer")
    return c.select(
        "c_custkey", W.negative("c_acctbal").alias("negative_flag"),
        W.above("c_acctbal", 9000).alias("outlier_flag"),
        W.not_among("c_mktsegment", ("BUILDING", "MACHINERY")).alias("segment_flag"),
        W.missing(F.nullif("c_nationkey", F.lit(3))).alias("missing_flag"),
        W.blank(F.when(F.col("c_nationkey") == 4, " ").otherwise(F.col("c_name"))).alias("blank_flag"),
        W.missing_or_negative(F.when(F.col("c_nationkey") != 5, F.col("c_acctbal")))
        .alias("missing_or_negative_flag"))


# --- duplicates -------------------------------------------------------------
def _events(spark, folder) -> DataFrame:
    return tpc(spark, folder, "events").select(
        F.concat_ws("|", F.col("user_id").cast("string"), F.col("event_type")).alias("key"),
        F.col("ts").alias("_ingest_time"), "event_id", "value")


@query
def dedup_latest(spark, folder):
    return L.keep_latest(_events(spark, folder), "key").select("key", "event_id", "value")


@query
def dedup_rejects(spark, folder):
    _, replaced = L.split_latest(_events(spark, folder), "key")
    return replaced.select("key", "event_id", "value", R.REASON, R.KIND)


# --- bronze -----------------------------------------------------------------
_SHAPES = {  # header variants of the customer files, by the column that carries the id
    "CustomerID": ("CustomerID", "Reg", "Region", "State", "City", "Education", "Marital_status",
                   "Job", "Default", "HHInsurance", "CarLoan", "Balance"),
    "Customer_ID": ("Customer_ID", "Reg", "Region", "State", "City", "City_in_state",
                    "Education", "Edu", "Marital_status", "Job", "Default", "HHInsurance",
                    "CarLoan", "Balance", "Segment"),
    "cust_id": ("cust_id", "Region", "State", "City", "Education", "Marital", "Job", "Default",
                "HHInsurance", "CarLoan", "Balance"),
}


def _customer_files(spark, folder) -> DataFrame:
    """Raw customers written as CSV files under three headers and read back."""
    base = scratch(spark, "raw-customers")
    df = bronze(spark, folder, "customers").withColumn("Segment", F.lit("extra"))
    for i, (key, names) in enumerate(_SHAPES.items(), 1):
        (df.filter(F.col(key).isNotNull()).select(*names).write.option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{base}/Insurance {i}"))
    source = SRC.Source("customers", "csv", "*.csv", K.RAW_COLUMNS["customers"])
    return SRC.ingest(spark, source, base)


@query
def bronze_customers(spark, folder):
    return _customer_files(spark, folder).drop("_source_file", "_ingest_time")


@query
def bronze_claims(spark, folder):
    """Raw claims written as JSON and read back as text. The names in every record make it ten
    times as long as its values, so files are packed; as a packed one is read by one task, none is large."""
    base = scratch(spark, "raw-claims")
    (bronze(spark, folder, "claims").select(*K.RAW_COLUMNS["claims"]).write
     .option("maxRecordsPerFile", 250_000).json(f"{base}/Insurance_6", compression="gzip"))
    source = SRC.Source("claims", "json", "*.json.gz", K.RAW_COLUMNS["claims"],
                        options={"multiLine": "false"})
    return SRC.ingest(spark, source, base).drop("_source_file", "_ingest_time")


@query
def bronze_claims_array(spark, folder):
    """The same as files of one JSON array each, numbers among the values. Ids tell files
    apart: some ten thousand records make a file, so that files are not too many to list and open."""
    base = scratch(spark, "raw-claim-arrays")
    rows = bronze(spark, folder, "claims").select(
        F.to_json(F.struct("ClaimID", "injury", F.col("ClaimID").try_cast("decimal(20,2)").alias("number"))).alias("j"),
        F.floor(F.monotonically_increasing_id() / 20_000).alias("file"))
    (rows.groupBy("file").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("j"), ",\n"), F.lit("\n]")).alias("value"))
     .select("value").write.option("lineSep", "\n\n").option("maxRecordsPerFile", 1).text(f"{base}/Insurance_6"))
    source = SRC.Source("claims", "json", "*.txt", ("ClaimID", "injury", "number"))
    return SRC.ingest(spark, source, base).drop("_source_file", "_ingest_time")


@query
def bronze_inferred(spark, folder):
    """Three headers, and columns whose types differ between the files that have them."""
    base = scratch(spark, "raw-typed")
    o = tpc(spark, folder, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"))
    k = F.col("k")
    parts = [
        o.filter(k % 3 == 0).select(k.alias("id"), k.alias("big"), F.col("c").alias("amount"), "day", F.col("day").alias("seen"),
                                    (k % 2 == 0).alias("flag")),
        o.filter(k % 3 == 1).select("day", (F.col("c") + 0.5).alias("amount"), F.concat(F.lit("n"), k.cast("string")).alias("id"),
                                    F.concat("day", F.lit(" 10:30:00")).alias("seen")),
        o.filter(k % 3 == 2).select(F.when(k % 2 == 0, F.lit("unknown")).otherwise(F.col("day")).alias("day"), k.alias("id"),
                                    (k + 3_000_000_000).alias("big"), (k % 2 == 1).alias("flag"))]
    for i, df in enumerate(parts):
        df.write.option("header", True).csv(f"{base}/Insurance {i}")
    df = SRC.ingest(spark, SRC.Source("t", "csv", "*.csv", ("id", "big", "amount", "day", "seen", "flag")), base, infer_types=True)
    return portable(df.drop("_source_file", "_ingest_time", "_source_region", SRC.RESCUED))


@query
def rescued_rows(spark, folder):
    """Records with values beyond the header, too few values, and quotes that do not close."""
    base = scratch(spark, "raw-surplus")
    c, key = tpc(spark, folder, "customer"), F.col("c_custkey")
    k, name = key.cast("string"), F.col("c_name")
    line = (F.when(key % 5 == 0, F.concat(k, F.lit(","), name, F.lit(",more")))
            .when(key % 5 == 1, F.concat(k, F.lit(',"a,'), name, F.lit('",,"x ""y"" z"')))
            .when(key % 5 == 2, F.concat(k, F.lit(',"'), name))
            .when(key % 5 == 3, k).otherwise(F.concat(k, F.lit(","), name)))
    # one header line per file: the first record of each task of the writer
    rows = c.select(line.alias("value"), F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part"))
    heads = rows.groupBy("part").agg(F.min("at").alias("at")).select(F.lit("c_custkey,c_name").alias("value"), (F.col("at") - 0.5).alias("at"), "part")
    (rows.withColumn("at", F.col("at").cast("double")).unionByName(heads)
     .repartition("part").sortWithinPartitions("part", "at").select("value", "part").write.partitionBy("part").text(base))
    df = SRC.ingest(spark, SRC.Source("t", "csv", "*.txt", ("c_custkey", "c_name")), base)
    return df.select("c_custkey", "c_name", SRC.RESCUED)


@query
def file_log(spark, folder):
    log = SRC.file_log({"customers": _customer_files(spark, folder)})
    return log.groupBy("entity", "file_format", "_source_region", "status").agg(
        F.sum("row_count").alias("row_count"))


# --- silver and quarantine --------------------------------------------------
def _silver(entity: str) -> Query:
    return lambda spark, folder: portable(silver(spark, folder, entity).drop("_ingest_time"))


def _quarantine(entity: str) -> Query:
    return lambda spark, folder: portable(
        R.rejected(tagged(spark, folder, entity), stamp=False).drop("_ingest_time"))


for _e in S.ENTITIES:
    QUERIES[f"silver_{_e}"] = _silver(_e)
    QUERIES[f"quarantine_{_e}"] = _quarantine(_e)


def _log(spark, folder) -> DataFrame:
    return R.quality_log({e: R.rejected(tagged(spark, folder, e), stamp=False)
                          for e in S.ENTITIES}, stamp=False)


@query
def quality_log(spark, folder):
    return _log(spark, folder)


@query
def quality_log_untyped(spark, folder):
    return R.quality_log({e: R.rejected(tagged(spark, folder, e), stamp=False)
                          for e in S.ENTITIES}, with_type=False, stamp=False)


@query
def flag_report(spark, folder):
    return P.flag_report(_log(spark, folder))


@query
def claim_breakdown(spark, folder):
    return P.breakdown(R.rejected(tagged(spark, folder, "claims"), stamp=False))


@query
def tag_by_sql(spark, folder):
    rules = [("o_totalprice > 400000", "too large"), ("o_orderstatus = 'P'", "pending"),
             ("o_orderpriority IN ('1-URGENT', '2-HIGH')", "rushed")]
    return R.tag_reason(tpc(spark, folder, "orders"), rules).select("o_orderkey", R.REASON)


@query
def expectations(spark, folder):
    return R.union_all(
        R.expectation_counts(S.ENTITIES[e].clean(bronze(spark, folder, e)), **S.EXPECTATIONS[e])
        .withColumn("entity", F.lit(e)) for e in S.ENTITIES)


@query
def expected_policy(spark, folder):
    """Rows left by the dropping expectations, with no duplicate removed."""
    df = S.clean_policy(bronze(spark, folder, "policy"))
    return portable(R.expect(df, **S.EXPECTATIONS["policy"]).drop("_ingest_time"))


@query
def older_rules_log(spark, folder):
    return R.quality_log({
        e: R.rule_set_failures(S.ENTITIES[e].clean(bronze(spark, folder, e)), rules, stamp=False)
        for e, rules in S.OLDER_RULES.items()}, with_type=False, stamp=False)


@query
def reconcile_counts(spark, folder):
    return P.reconcile({e: tagged(spark, folder, e) for e in S.ENTITIES})


@query
def pass_counts(spark, folder):
    return P.pass_counts({e: silver(spark, folder, e) for e in S.ENTITIES})


@query
def before_after_customers(spark, folder):
    b = S.lower_names(bronze(spark, folder, "customers"))
    before = {n: C.first_present(b.columns, K.CUSTOMER_VARIANTS[n])
              for n in ("region", "education", "marital_status")}
    before["job"] = F.col("job")
    return P.before_after(
        b, silver(spark, folder, "customers"),
        C.first_present(b.columns, K.CUSTOMER_VARIANTS["customer_id"], "int"), "customer_id",
        before, ("region", "education", "marital_status", "job"))


_PREVIEWS = {  # raw key, raw columns, cleaned columns
    "cars": ("car_id", ("fuel", "transmission", "seats", "km_driven", "mileage"),
             ("fuel", "transmission", "seats", "km_driven", "mileage_kmpl")),
    "policy": ("policy_number", ("policy_bind_date", "policy_state", "umbrella_limit"),
               ("policy_bind_date", "policy_state", "umbrella_limit", "umbrella_limit_warning")),
    "sales": ("sales_id", ("ad_placed_on", "sold_on", "region", "owner"),
              ("ad_placed_on", "sold_on", "region", "owner", "sale_status")),
    "claims": ("claimid", ("claim_processed_on", "collision_type", "claim_rejected"),
               ("claim_processed_on", "collision_type", "is_rejected", "claim_status")),
}


def _preview(entity: str) -> Query:
    raw_key, before, after = _PREVIEWS[entity]
    return lambda spark, folder: portable(P.before_after(
        bronze(spark, folder, entity), silver(spark, folder, entity),
        F.col(raw_key).try_cast("int"), S.ENTITIES[entity].key,
        {c: F.col(c) for c in before}, after))


for _e in _PREVIEWS:
    QUERIES[f"before_after_{_e}"] = _preview(_e)


@query
def broken_claims(spark, folder):
    return portable(S.broken_claim_times(bronze(spark, folder, "claims")))


@query
def dq_issue_report(spark, folder):
    rows = quality.issues(_log(spark, folder)).withColumn("issue_id", F.concat_ws(
        "|", "entity", "quarantine_reason", "quarantine_type"))
    return quality.issue_report(rows, generate=lambda p: p, stamp=False)


@query
def dq_entity_report(spark, folder):
    return quality.entity_report(quality.by_entity(_log(spark, folder)), generate=lambda p: p,
                                 stamp=False)


# --- gold -------------------------------------------------------------------
def _outcomes(spark, folder) -> list[R.Outcome]:
    """What is counted while every entity is written, each planned and run once."""
    layers = {e: bronze(spark, folder, e) for e in S.ENTITIES}
    return list(S.build_counted(spark, layers, scratch(spark, "counted"))[1].values())


@query
def quality_log_written(spark, folder):
    """The quality log out of the counts of the write itself."""
    return R.log_of(spark, _outcomes(spark, folder), stamp=False)


@query
def reconcile_written(spark, folder):
    return R.reconciliation_of(spark, _outcomes(spark, folder))


@query
def sold_sales_log(spark, folder):
    """Rejected listings by reason under the second form of the rules, which fails those not sold."""
    return R.quality_log({"sales": R.rejected(S.SOLD_SALES.tagged(bronze(spark, folder, "sales")), stamp=False)}, stamp=False)


@query
def fact_sales_numbers(spark, folder):
    """The older form of the fact, with is_sold as 0 or 1."""
    return portable(gold.fact_sales(silver(spark, folder, "sales"), sold_as_int=True).select(
        "sales_id", "car_id", "is_sold", "sale_status"))


# --- stored tables ----------------------------------------------------------
@query
def sink_overwrite(spark, folder):
    """A stored table replaced by one of other columns, split by a column and into small files."""
    out = scratch(spark, "sink-overwrite")
    orders = tpc(spark, folder, "orders")
    tables.overwrite(orders.select("o_orderkey", "o_orderdate"), out)
    tables.overwrite(orders.select("o_orderkey", "o_custkey", "o_orderstatus"), out, partition_by=("o_orderstatus",), rows_per_file=1000)
    kept = tables.read(spark, out)
    return kept.select("o_orderkey", "o_custkey", "o_orderstatus", F.lit(len(kept.columns)).alias("columns"))


@query
def sink_append(spark, folder):
    """History: two appends, the second with a column more. Each has a time stamp."""
    out = scratch(spark, "sink-append")
    orders = tpc(spark, folder, "orders")
    first = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    second = orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey", "o_orderstatus")
    for part in (first, second):
        tables.append(enrich.stamped(part, "added_at"), out)
    kept = tables.read(spark, out)
    recent = F.col("added_at").between(F.current_timestamp() - F.expr("interval 1 day"), F.current_timestamp())
    return kept.select("o_orderkey", "o_custkey", "o_orderstatus", recent.alias("added_now"))


@query
def stored_counts(spark, folder):
    """Rows of named tables; one of the names is not there."""
    names = ("orders", "lineitem", "customer", "absent")
    for name in names[:-1]:
        tpc(spark, folder, name).createOrReplaceTempView(f"stored_{name}")
    return P.table_counts(spark, [f"stored_{n}" for n in names])


@query
def provenance(spark, folder):
    """Rows by the folder of their file, from the real path, and whether they were read just now."""
    df = _customer_files(spark, folder)
    folder_name = F.regexp_extract("_source_file", "/(Insurance [0-9]+)/[^/]+[.]csv$", 1)
    recent = F.col("_ingest_time").between(F.current_timestamp() - F.expr("interval 1 day"), F.current_timestamp())
    return df.groupBy(folder_name.alias("folder"), "_source_region", recent.alias("read_now")).agg(F.count(F.lit(1)).alias("n"))


@query
def short_ids(spark, folder):
    """A random id per order: eight upper-case signs, and nearly all of them different."""
    ids = tpc(spark, folder, "orders").select("o_orderstatus", X.short_id().alias("i"))
    return ids.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.every(F.col("i").rlike("^[0-9A-F]{8}$")).alias("well_formed"),
        (F.count_distinct("i") > 0.99 * F.count(F.lit(1))).alias("different"))


@query
def date_dim(spark, folder):
    """The days that orders and line items span, with how many of them fall on each."""
    days = gold.days_of((tpc(spark, folder, "orders"), "o_orderdate"), (tpc(spark, folder, "lineitem"), "l_shipdate"))
    return portable(gold.calendar(days).join(days, "full_date"))


@query
def dim_customer(spark, folder):
    return portable(dims(spark, folder, "customer")["customer"])


@query
def dim_car(spark, folder):
    return portable(dims(spark, folder, "car")["car"])


@query
def dim_policy(spark, folder):
    return portable(dims(spark, folder, "policy")["policy"])


@query
def fact_claims(spark, folder):
    return portable(facts(spark, folder).drop("_ingest_time"))


@query
def fact_sales(spark, folder):
    return portable(listings(spark, folder).drop("_ingest_time"))


@query
def rejection_by_region_month(spark, folder):
    d = dims(spark, folder, "customer", "date")
    return gold.rejection_by_region_month(facts(spark, folder), d["customer"], d["date"],
                                          stamp=False)


@query
def processing_time_by_severity(spark, folder):
    return gold.processing_time_by_severity(facts(spark, folder), stamp=False)


@query
def unsold_by_model_region(spark, folder):
    return portable(gold.unsold_by_model_region(
        listings(spark, folder), dims(spark, folder, "car")["car"], stamp=False))


@query
def unsold_days_listed(spark, folder):
    return portable(gold.unsold_by_model_region(
        listings(spark, folder), dims(spark, folder, "car")["car"], as_of="2024-06-30", stamp=False))


@query
def unsold_by_manufacturer(spark, folder):
    return portable(gold.unsold_by_manufacturer(
        listings(spark, folder), dims(spark, folder, "car")["car"], stamp=False))


@query
def claim_value_by_region_policy(spark, folder):
    d = dims(spark, folder, "customer", "policy")
    return portable(gold.claim_value_by_region_policy(
        facts(spark, folder), d["customer"], d["policy"], stamp=False))


@query
def customer_count_by_region(spark, folder):
    return gold.customer_count_by_region(dims(spark, folder, "customer")["customer"], stamp=False)


@query
def raw_customer_count(spark, folder):
    """The duplicate count before duplicates are removed."""
    return P.duplicate_count(S.clean_customers(bronze(spark, folder, "customers")), "region", "customer_id",
                             distinct="unique_customers", total="total_records", surplus="duplicate_count")


# --- KPIs -------------------------------------------------------------------
@query
def kpi_claims(spark, folder):
    return kpi.claims(facts(spark, folder))


@query
def kpi_sales(spark, folder):
    return kpi.sales(listings(spark, folder))


@query
def kpi_customers(spark, folder):
    return kpi.customers(dims(spark, folder, "customer")["customer"])


@query
def kpi_policies(spark, folder):
    return kpi.policies(dims(spark, folder, "policy")["policy"])


def _rejections(spark, folder) -> DataFrame:
    return stage(rejection_by_region_month(spark, folder), "rejections")


@query
def best_worst(spark, folder):
    r = _rejections(spark, folder)
    return R.union_all([
        kpi.worst_region(r, best).withColumn("place", F.lit("best" if best else "worst"))
        for best in (False, True)])


@query
def region_summary(spark, folder):
    return kpi.region_summary(rejection_by_region_month(spark, folder))


@query
def severity_extremes(spark, folder):
    t = stage(processing_time_by_severity(spark, folder), "times")
    return R.union_all([
        kpi.severity_extreme(t, slow).withColumn("place", F.lit("slowest" if slow else "fastest"))
        for slow in (True, False)])


@query
def top_unsold(spark, folder):
    df = unsold_by_model_region(spark, folder)
    return kpi.top_unsold(df).select("manufacturer", "car_name", "region", "unsold_listings",
                                     kpi.unsold_lines().alias("line"))


@query
def top_states(spark, folder):
    return kpi.top_states(dims(spark, folder, "policy")["policy"])


@query
def kpi_json(spark, folder):
    """The KPI record stored with the customer domain, read back from its JSON."""
    domain = kpi.customer_domain(stage(gold.dim_customer(silver(spark, folder, "customers")), "dim-customer"),
                                 stage(facts(spark, folder).select("customer_id"), "fact-claims"))
    row = F.from_json("kpi_json", "total_customers bigint, avg_balance double, negative_balance_count bigint, "
                      "home_insurance_pct double, unique_customers_w_claims bigint, claims_penetration_pct double")
    return domain.select("insight_id", "domain_name", row.alias("k"), F.size(F.json_object_keys("kpi_json")).alias("fields")) \
        .select("insight_id", "domain_name", "fields", "k.*")


@query
def kpi_insights(spark, folder):
    """The three domains. The gold tables are stored first, since each is read often; of the facts,
    the columns that the domains read, so that no others are joined and written."""
    d = {n: stage(df, n) for n, df in dims(spark, folder, "customer", "policy", "date").items()}
    f = stage(gold.fact_claims(silver(spark, folder, "claims"), d["policy"]).select(*kpi.FACTS_READ), "fact-claims")
    rejections = stage(gold.rejection_by_region_month(f, d["customer"], d["date"], stamp=False),
                       "rejections")
    times = stage(gold.processing_time_by_severity(f, stamp=False), "times")
    return kpi.insights(
        [kpi.policy_domain(d["policy"]), kpi.claims_domain(f, rejections, times),
         kpi.customer_domain(d["customer"], f)],
        generate=lambda p: p, stamp=False).drop("kpi_json")


def _blocks(p: str) -> str:
    import json
    return json.dumps([{"type": "reasoning"}, {"type": "text", "text": "note: " + p}])


@query
def region_notes(spark, folder):
    return kpi.region_notes(rejection_by_region_month(spark, folder), generate=_blocks)


@query
def severity_notes(spark, folder):
    return kpi.severity_notes(processing_time_by_severity(spark, folder), generate=_blocks)


# --- anomalies --------------------------------------------------------------
def _claims(spark, folder, *columns: str) -> DataFrame:
    """Claims, stored as they are read more than once; if columns are named, only these are."""
    claims = silver(spark, folder, "claims")
    return stage(claims.select(*columns) if columns else claims, "silver-claims")


@query
def anomaly_population(spark, folder):
    df = anomaly.population(_claims(spark, folder))
    return df.withColumns({c: F.round(c, 4) for c in ("mean_amount", "std_amount")})


@query
def anomaly_scores(spark, folder):
    return anomaly.score(_claims(spark, folder)).select(
        "claim_id", *K.SIGNALS, "anomaly_score", "priority_tier", "signals_fired")


@query
def anomaly_scores_as_of(spark, folder):
    return anomaly.score(_claims(spark, folder), as_of="2000-01-01").select(
        "claim_id", "sig_long_open_claim", "anomaly_score", "priority_tier")


@query
def anomaly_tiers(spark, folder):
    return anomaly.tier_counts(stage(anomaly.score(_claims(spark, folder)), "scored"))


@query
def anomaly_rate(spark, folder):
    return anomaly.flag_rate(anomaly.score(_claims(spark, folder, *anomaly.CLAIMS_READ)))


@query
def anomaly_report(spark, folder):
    return anomaly.report(anomaly.score(_claims(spark, folder)), generate=lambda p: p, stamp=False)


# --- retrieval --------------------------------------------------------------
def _questions(spark, folder) -> DataFrame:
    """One question per label, its vector being the mean of all vectors of the label."""
    parts = (tpc(spark, folder, "embeddings")
             .select("label", F.posexplode("embedding").alias("i", "x"))
             .groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x")))
    return parts.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"])
        .alias("vector")).select(
            F.col("label").alias("query_id"),
            F.concat(F.lit("What is near label "), F.col("label").cast("string"), F.lit("?"))
            .alias("question"), "vector")


def _docs(spark, folder) -> DataFrame:
    return tpc(spark, folder, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        F.concat(F.lit("Vector "), F.col("vec_id").cast("string"), F.lit(" has label "),
                 F.col("label").cast("string"), F.lit(".")).alias("text"),
        F.col("embedding").alias("vector"))


@query
def cosine_topk(spark, folder):
    return cosine_top_k(_questions(spark, folder), _docs(spark, folder)).select(
        "query_id", "position", "doc_id", F.round("confidence", 5).alias("confidence"))


@query
def retrieval_stats(spark, folder):
    q = stage(_questions(spark, folder), "questions")
    found = retrieval.stats(q, retrieval.retrieve(q, _docs(spark, folder)))
    return found.withColumn("avg_confidence", F.round("avg_confidence", 3))


@query
def retrieval_history(spark, folder):
    q = stage(_questions(spark, folder), "questions")
    found = retrieval.stats(q, retrieval.retrieve(q, _docs(spark, folder)))
    return retrieval.answer(found, stamp=False).drop("confidence_score", "avg_confidence")


@query
def history_preview(spark, folder):
    """The newest rows of a history in which each question was asked on a day of its own."""
    q = stage(_questions(spark, folder), "questions")
    found = retrieval.stats(q, retrieval.retrieve(q, _docs(spark, folder)))
    history = retrieval.answer(found, stamp=False).withColumn(
        "queried_at", F.timestamp_seconds(86400 * (F.col("query_id") % 7).cast("bigint")))
    return portable(retrieval.latest(history, 7).drop("confidence_score"))


@query
def policy_text(spark, folder):
    return retrieval.documents(dims(spark, folder, "policy")["policy"])


@query
def response_text(spark, folder):
    """Answers wrapped into the block forms a generator may return, and unwrapped."""
    def blocks(*items):
        return F.concat(F.lit("["), F.concat_ws(", ", *items), F.lit("]"))

    def block(kind, text):
        return F.to_json(F.struct(F.lit(kind).alias("type"), text.alias("text")))

    thought = F.to_json(F.struct(
        F.lit("reasoning").alias("type"),
        F.array(F.struct(F.lit("summary_text").alias("type"),
                         F.concat(F.lit("thought: "), F.col("text")).alias("text")))
        .alias("summary")))
    wrapped = (
        F.when(F.col("turn") % 4 == 0, F.col("text"))
        .when(F.col("turn") % 4 == 1, blocks(thought, block("text", F.col("text"))))
        .when(F.col("turn") % 4 == 2, blocks(block("text", F.lit("  ")), thought))
        .otherwise(blocks(block("image", F.lit("x")), block("text", F.col("text")))))
    df = tpc(spark, folder, "conversations").select("conv_id", "turn", wrapped.alias("content"))
    return df.select("conv_id", "turn", X.response_text("content").alias("answer"),
                     F.when(F.col("turn") % 4 == 1, X.block_text("content")).alias("second"))


# --- streams ----------------------------------------------------------------
@query
def stream_dedup(spark, folder):
    """All event files as a stream; one row per key. Which row stays depends on arrival,
    so the keys are the result."""
    out, mark = scratch(spark, "stream-out"), scratch(spark, "stream-mark")
    events = jobs.stream_of(spark, folder, "events*.parquet").select("user_id", "event_type")
    jobs.run(L.keep_any(events, ["user_id", "event_type"]), out, mark)
    return spark.read.parquet(out)


@query
def stream_counts(spark, folder):
    """Row count per file label, kept up to date by a stream."""
    out, mark = scratch(spark, "stream-out"), scratch(spark, "stream-mark")
    events = jobs.stream_of(spark, folder, "events*.parquet").select(
        F.concat(F.lit("/raw/"), F.col("event_type"), F.lit(".csv")).alias("_source_file"),
        F.lit("").alias("_source_region"), F.col("ts").alias("_ingest_time"))
    jobs.run_changes(jobs.file_counts(events, "events"), out, mark)
    return portable(tables.read_newest(spark, out, ["_source_file"]))


@query
def stream_clean(spark, folder):
    """Raw policies as a stream through cleaning, expectations and one row per key."""
    src, out, mark = (scratch(spark, n) for n in ("stream-src", "stream-out", "stream-mark"))
    bronze(spark, folder, "policy").write.parquet(src)
    jobs.run(jobs.clean(jobs.stream_of(spark, src), "policy"), out, mark)
    return spark.read.parquet(out).select("policy_number", "customer_id", "car_id")


def _policy_halves(spark, folder) -> list[DataFrame]:
    """Raw policies dealt so that rows of one key come in both halves."""
    df = bronze(spark, folder, "policy")
    odd = F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0
    return [df.filter(odd), df.filter(~odd)]


@query
def stream_newest(spark, folder):
    """Raw policies in two micro-batches: the stream keeps the newest row of each key, as the
    batch does, so that rules give the silver table in all columns."""
    src, out, mark = (scratch(spark, n) for n in ("newest-src", "newest-out", "newest-mark"))
    entity = S.ENTITIES["policy"]
    for half in _policy_halves(spark, folder):
        half.write.mode("append").parquet(src)
        jobs.run_changes(jobs.newest(entity.clean(jobs.stream_of(spark, src)), entity.key), out, mark)
    kept = tables.read_newest(spark, out, [entity.key])
    good = kept.filter(R.first_reason(entity.rules()).isNull())
    return portable(good.drop("_ingest_time"))


@query
def append_once(spark, folder):
    """Orders appended in runs, one of them twice over, and a part whose run never ended."""
    out = scratch(spark, "append-once")
    orders = tpc(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for run in ("F", "O", "F", "P", "O"):
        tables.append_once(orders.filter(F.col("o_orderstatus") == run), out, f"status {run}")
    orders.limit(10).write.parquet(f"{out}/parts/run=unfinished")
    return tables.read_committed(spark, out, "version").groupBy("version", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("orders"), F.sum("o_custkey").alias("customers"))


@query
def stream_growing(spark, folder):
    """Three micro-batches, each with columns the ones before had not. The reader takes the
    columns from the schema log and opens no file to find them."""
    src, out, mark = (scratch(spark, n) for n in ("grow-src", "grow-out", "grow-mark"))
    df = bronze(spark, folder, "cars")
    first, second = df.filter("_source_file like '%cars.csv'"), df.filter("_source_file like '%cars_2.csv'")
    batches = [first.select("car_id", "fuel"), second.select("model", "car_id", "km_driven"),
               first.select("mileage", "fuel", "car_id", "engine")]
    source = SRC.Source("cars", "csv", "*.csv")
    for i, batch in enumerate(batches):
        batch.write.option("header", True).csv(f"{src}/Insurance {i}")
        jobs.bronze(spark, source, src, out, mark).awaitTermination()
    grown = jobs.read_bronze(spark, out, mark)
    return grown.groupBy("_source_region", "fuel", "model").agg(
        F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"n_{c}") for c in ("car_id", "km_driven", "mileage", "engine")])


@query
def stream_bronze(spark, folder):
    """Files with several headers, followed by a stream."""
    src, out, mark = (scratch(spark, n) for n in ("stream-src", "stream-out", "stream-mark"))
    df = bronze(spark, folder, "cars")
    (df.filter("_source_file like '%cars.csv'").select(*K.RAW_COLUMNS["cars"])
     .write.option("header", True).csv(f"{src}/Insurance 4/first"))
    (df.filter("_source_file like '%cars_2.csv'").select("model", "car_id", "km_driven", "fuel")
     .write.option("header", True).csv(f"{src}/Insurance 4/second"))
    source = SRC.Source("cars", "csv", "*.csv", K.RAW_COLUMNS["cars"])
    jobs.bronze(spark, source, src, out, mark).awaitTermination()
    return jobs.read_bronze(spark, out, mark).groupBy("_source_region", "fuel", "model").agg(
        F.count(F.lit(1)).alias("n"), F.count("car_id").alias("ids"),
        F.count("mileage").alias("mileages"))
