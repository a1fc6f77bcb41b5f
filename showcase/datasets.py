"""Extracts and targets derived from the given tables.

Small dimensions are joined without hints: Catalyst broadcasts a side only when
its measured size allows it, and otherwise shuffles, where adaptive execution
splits a customer that holds a large part of the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyboard.sources.datasets import literal_rows
from tallyboard.spec import Feed, ReportSpec

WEEK = "1998-W24"
STRADDLING_WEEK = "1998-W01"
EVENTS_WEEK = "2024-W03"

# The weeks the order dates span.
FIRST_WEEK, LAST_WEEK = "1994-W52", "2001-W31"

TARGET_COLUMNS = {"unit": "unit", "start": "start_target", "annual": "annual_target"}


# Declared schemas: nothing is inferred, so opening a table starts no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def orders_wide(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order with the customer's segment and nation."""
    places = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return table(spark, folder, "orders").join(places, F.col("o_custkey") == F.col("c_custkey"))


def orders_by_region(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region")
    return orders_wide(spark, folder).join(regions, F.col("n_regionkey") == F.col("r_regionkey"))


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The same extract as a careless export would deliver it: everything is
    text, dates come in three notations, some are unreadable or missing, so are
    some amounts, names are padded or missing."""
    key = F.col("o_orderkey")
    hour = F.make_interval(hours=(key % 24).cast("int"))
    moment = F.col("o_orderdate") + hour
    day_text = (
        F.when(key % 50 == 0, "not a date")
        .when(key % 50 == 1, None)
        .when(key % 3 == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(key % 3 == 1, F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    segment = F.col("c_mktsegment")
    segment_text = (
        F.when(key % 11 == 0, None)
        .when(key % 7 == 0, F.concat(F.lit("\t"), segment, F.lit("\u00a0 ")))
        .otherwise(segment)
    )
    unit_text = (
        F.when(key % 13 == 0, None)
        .when(key % 17 == 0, " ")
        .when(key % 5 == 0, F.concat(F.lit("\u2003 "), F.col("n_name"), F.lit(" ")))
        .otherwise(F.col("n_name"))
    )
    money = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    amount_text = (
        F.when(key % 40 == 0, "n/a")
        .when(key % 40 == 1, None)
        .when(key % 40 == 2, " ")
        .when(key % 40 == 3, "1.234")  # more digits than the declared type holds
        .when(key % 7 == 0, F.concat(F.lit("\u00a0"), money))
        .otherwise(money)
    )
    return orders_wide(spark, folder).select(
        day_text.alias(" Case date "),
        segment_text.alias("Segment"),
        unit_text.alias("Unit code "),
        F.col("o_orderpriority").alias("Priority"),
        key.alias("Reference"),
        amount_text.alias("Amount"),
    )


def nation_targets(spark: SparkSession, folder: str) -> DataFrame:
    """A target per nation, with a zero, a NULL, a missing and an extra one."""
    key = F.col("n_nationkey")
    full = F.when(key == 3, 0.0).when(key != 4, (30 + 5 * (key % 5)).cast("double"))
    named = table(spark, folder, "nation").filter(key != 5)
    extra = literal_rows(
        spark, "unit string, start_target double, annual_target double", [("NATION_99", 10.0, 20.0)]
    )
    return named.select(
        F.col("n_name").alias("unit"),
        (full * 0.5).alias("start_target"),
        full.alias("annual_target"),
    ).unionByName(extra)


def region_targets(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("r_regionkey")
    return table(spark, folder, "region").select(
        F.col("r_name").alias("unit"),
        (100.0 + 10 * key).cast("double").alias("start_target"),
        (200.0 + 20 * key).cast("double").alias("annual_target"),
    )


def customer_targets(spark: SparkSession, folder: str) -> DataFrame:
    """A target per customer, in quarters so that sums are exact in a double."""
    quarter = F.floor(F.col("c_acctbal") * 4).cast("double") / 4
    return table(spark, folder, "customer").select(
        F.col("c_name").alias("unit"),
        quarter.alias("start_target"),
        (quarter * 16).alias("annual_target"),
    )


def dirty_targets(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    start = (
        F.when(key % 9 == 0, "n/a")
        .when(key % 9 == 1, None)
        .when(key % 9 == 2, " 12.5 ")
        .when(key % 9 == 3, "7d")
        .otherwise(F.floor("c_acctbal").cast("string"))
    )
    annual = F.when(key % 8 == 0, F.lit(float("nan"))).otherwise(F.floor("c_acctbal") * 2.0)
    unit = F.when(key % 10 != 0, F.concat(F.lit(" "), F.col("c_name"), F.lit("\u00a0")))
    return table(spark, folder, "customer").select(
        unit.alias("unit"), start.alias("start_target"), annual.alias("annual_target")
    )


def repeated_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Targets on an ambiguous unit: customers with the same whole balance."""
    balance = F.floor("c_acctbal")
    return table(spark, folder, "customer").select(
        balance.cast("string").alias("unit"),
        balance.cast("double").alias("start_target"),
        balance.cast("double").alias("annual_target"),
    )


def events_wide(spark: SparkSession, folder: str) -> DataFrame:
    unit = F.concat(F.lit("U"), (F.col("user_id") % 10).cast("string"))
    return table(spark, folder, "events").select("ts", "event_type", unit.alias("unit"), "value")


def event_targets(spark: SparkSession, folder: str) -> DataFrame:
    """A target per unit found in the events, whatever the period."""
    number = F.substring("unit", 2, 1).cast("double")
    units = events_wide(spark, folder).select("unit").distinct()
    return units.select(
        "unit", (100 + number).alias("start_target"), (1000 + number * 10).alias("annual_target")
    )


def _feed(name: str) -> Feed:
    return Feed(database="showcase", dataset=name)


def orders_spec(**changes) -> ReportSpec:
    fields = dict(
        name="orders",
        source=_feed("orders_wide"),
        targets=_feed("nation_targets"),
        source_columns={"date": "o_orderdate", "segment": "c_mktsegment", "unit": "n_name"},
        target_columns=TARGET_COLUMNS,
        measure_label="orders",
        segments=("BUILDING", "MACHINERY"),
        excluded_unit="NATION_7",
        text_is_trimmed=True,
    )
    return ReportSpec(**{**fields, **changes})


def dirty_spec(**changes) -> ReportSpec:
    fields = dict(
        name="cases",
        source=_feed("dirty_orders"),
        source_columns={"date": "Case date", "segment": "Segment", "unit": "Unit code"},
        segments=("BUILDING", "MACHINERY", "SPACECRAFT"),
        excluded_unit="NATION_77",
        text_is_trimmed=False,
    )
    return orders_spec(**{**fields, **changes})


def amounts_spec(**changes) -> ReportSpec:
    fields = dict(
        name="amounts",
        measure="Amount",
        measure_type="decimal(18,2)",
        unreadable_amounts="exclude",
        excluded_unit="NATION_7",
        segments=("BUILDING", "MACHINERY"),
    )
    return dirty_spec(**{**fields, **changes})


def events_spec(**changes) -> ReportSpec:
    fields = dict(
        name="events",
        source=_feed("events_wide"),
        targets=_feed("event_targets"),
        source_columns={"date": "ts", "segment": "event_type", "unit": "unit"},
        measure_label="events",
        segments=("click", "purchase"),
        excluded_unit="U3",
    )
    return orders_spec(**{**fields, **changes})
