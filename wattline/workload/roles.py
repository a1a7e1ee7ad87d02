"""Domain tables derived from the star-schema tables.

Events play the readings, customers the customers, parts the tariffs, suppliers the meters,
orders the bills and line items the outages. The ``raw_*`` tables are all text, as a CSV
scan gives them, with faults placed by key arithmetic; no row is left out.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions import degree_days
from wattline.operators.rulesets import WEATHER_CONDITIONS
from wattline.operators.skew import lookup_join
from wattline.plans.build import Build

AS_OF = datetime(2026, 1, 1)
RUN = Build(run_id="run-1", as_of=AS_OF, environment="test")
# Orders end in 2001 and events start in 2024: this many days bring them together.
ORDER_SHIFT_DAYS = 9861


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table by its declared schema, so that no job runs to find the columns."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def text(value: Column) -> Column:
    return value.cast("string")


def every(key: str, n: int, faulty: Column, normal: Column) -> Column:
    """One value for every n-th key, another for the rest."""
    return F.when(F.col(key) % n == 0, faulty).otherwise(normal)


def identifier(prefix: str, key: str | Column) -> Column:
    return F.concat(F.lit(prefix), text(F.col(key) if isinstance(key, str) else key))


def with_nation(spark: SparkSession, sf: str, rows: DataFrame, key: str) -> DataFrame:
    """Add nation and region names; both tables are short by nature and broadcast by size."""
    nation, region = load(spark, sf, "nation"), load(spark, sf, "region")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey)
    places = named.select(F.col("n_nationkey").alias(key), "n_name", F.col("r_name").alias("region"))
    return rows.join(places, key, "left")


def with_region(spark: SparkSession, sf: str, rows: DataFrame, key: str) -> DataFrame:
    """Add the region of the customer with the given number."""
    customer = load(spark, sf, "customer").select(F.col("c_custkey").alias(key), "c_nationkey")
    homes = with_nation(spark, sf, customer, "c_nationkey").select(key, "region")
    return lookup_join(rows, homes, key, lookup_rows=customer.count())


def lineage(df: DataFrame, file: str) -> DataFrame:
    """The lineage columns of validated rows, with fixed values so that results repeat."""
    at = F.lit(AS_OF).cast("timestamp")
    return df.withColumns(
        {
            "source_file_name": F.lit(file),
            "source_system": F.lit("star"),
            "generated_at_utc": at,
            "_source_file_path": F.lit(file),
            "_run_id": F.lit(RUN.run_id),
            "_environment": F.lit(RUN.environment),
            "silver_processed_at_utc": at,
        }
    )


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Readings with known ids; values over 100 kWh are still in."""
    events = with_region(spark, sf, load(spark, sf, "events"), "user_id")
    late = F.col("event_id") % 100 == 0
    return lineage(
        events.select(
            identifier("R", "event_id").alias("reading_id"),
            identifier("M", "user_id").alias("meter_id"),
            identifier("C", "user_id").alias("customer_id"),
            F.col("ts").cast("timestamp").alias("reading_timestamp"),
            F.col("ts").cast("date").alias("reading_date"),
            F.col("value").alias("consumption_kwh"),
            every("event_id", 97, F.lit(None), 196 + F.col("event_id") % 67).cast("double").alias("voltage"),
            F.col("event_type").alias("reading_source"),
            F.lit("Active").alias("meter_status"),
            "region",
            late.alias("is_late_arriving"),
            F.when(late, 24 + F.col("event_id") % 96).cast("double").alias("ingestion_delay_hours"),
            F.lit(False).alias("data_quality_issue_injected"),
            identifier("FW_", F.col("event_id") % 3).alias("firmware_version"),
            (-70.0 - F.col("event_id") % 16).alias("signal_strength_dbm"),
            F.upper("event_type").alias("meter_reading_quality_code"),
        ),
        "readings.csv",
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    named = with_nation(spark, sf, load(spark, sf, "customer"), "c_nationkey")
    return lineage(
        named.select(
            identifier("C", "c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias(
                "email"
            ),
            identifier("0", "c_custkey").alias("phone_number"),
            identifier("P", "c_nationkey").alias("postcode"),
            "region",
            F.col("c_mktsegment").alias("customer_segment"),
            F.col("n_name").alias("property_type"),
            F.when(F.col("c_acctbal") < 0, "Suspended")
            .when(F.col("c_acctbal") > 9000, "Closed")
            .otherwise("Active")
            .alias("account_status"),
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).alias(
                "registration_date"
            ),
        ),
        "customers.csv",
    )


def tariffs(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    start = F.date_add(F.lit("2025-01-01").cast("date"), F.col("p_size"))
    return lineage(
        part.select(
            identifier("T", "p_partkey").alias("tariff_id"),
            F.col("p_name").alias("tariff_name"),
            (F.col("p_size") + 0.5).alias("standing_charge_pence_per_day"),
            F.col("p_retailprice").alias("unit_rate_pence_per_kwh"),
            (F.col("p_size") % 2 == 0).alias("green_energy_flag"),
            start.alias("effective_start_date"),
            F.when(F.col("p_partkey") % 5 == 0, F.date_add(start, 90)).alias("effective_end_date"),
        ),
        "tariffs.csv",
    )


def meters(spark: SparkSession, sf: str) -> DataFrame:
    """One meter per supplier; its owner is the customer of the same number."""
    placed = with_region(spark, sf, load(spark, sf, "supplier"), "s_suppkey")
    return lineage(
        placed.select(
            identifier("M", "s_suppkey").alias("meter_id"),
            identifier("C", "s_suppkey").alias("customer_id"),
            identifier("T", F.col("s_suppkey") % 7).alias("tariff_id"),
            "region",
            every("s_suppkey", 2, F.lit("SMETS1"), F.lit("SMETS2")).alias("meter_type"),
            F.when(F.col("s_acctbal") < 0, "Faulty").otherwise("Active").alias("meter_status"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("s_suppkey") % 365).cast("int")).alias(
                "installation_date"
            ),
        ),
        "meters.csv",
    )


def payment_status(code: str) -> Column:
    return F.when(F.col(code) == "F", "Paid").when(F.col(code) == "O", "Pending").otherwise("Overdue")


def payment_method(priority: str) -> Column:
    return (
        F.when(F.col(priority) == "1-URGENT", "Card")
        .when(F.col(priority) == "2-HIGH", "Bank Transfer")
        .when(F.col(priority) == "3-MEDIUM", "Prepayment")
        .otherwise("Direct Debit")
    )


def billing(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_add(F.col("o_orderdate").cast("date"), ORDER_SHIFT_DAYS)
    orders = with_region(spark, sf, load(spark, sf, "orders"), "o_custkey").withColumn("day", day)
    status = payment_status("o_orderstatus")
    return lineage(
        orders.select(
            identifier("B", "o_orderkey").alias("billing_event_id"),
            identifier("C", "o_custkey").alias("customer_id"),
            identifier("T", "o_custkey").alias("tariff_id"),
            "region",
            F.col("day").alias("billing_date"),
            F.col("day").alias("billing_period_start"),
            F.col("day").alias("billing_period_end"),
            ((F.col("o_orderkey") % 500) / 8).alias("total_consumption_kwh"),
            F.lit(0.5).alias("standing_charge_amount"),
            F.col("o_totalprice").alias("energy_charge_amount"),
            F.lit(0.25).alias("vat_amount"),
            F.col("o_totalprice").alias("total_amount"),
            status.alias("payment_status"),
            payment_method("o_orderpriority").alias("payment_method"),
            F.date_add("day", 14).alias("due_date"),
            F.when(status == "Paid", F.date_add("day", (F.col("o_orderkey") % 10).cast("int"))).alias("paid_at"),
            F.lit(False).alias("billing_quality_issue_injected"),
        ),
        "billing.csv",
    )


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """One made-up weather row per billing day and region, from that day's order keys."""
    orders = with_region(spark, sf, load(spark, sf, "orders"), "o_custkey")
    days = (
        orders.groupBy(
            F.date_add(F.col("o_orderdate").cast("date"), ORDER_SHIFT_DAYS).alias("weather_date"), "region"
        )
        .agg(F.sum(F.col("o_orderkey") % 97).alias("n"))
        .withColumn("mean", ((F.col("n") % 320 - 60) / 8).cast("double"))
    )
    demand = degree_days(F.col("mean"))
    conditions = F.array(*[F.lit(c) for c in WEATHER_CONDITIONS])
    return lineage(
        days.select(
            F.concat_ws("-", F.lit("W"), text(F.col("weather_date")), "region").alias("weather_id"),
            "weather_date",
            "region",
            F.col("mean").alias("avg_temperature_c"),
            (F.col("mean") - 3).alias("min_temperature_c"),
            (F.col("mean") + 4).alias("max_temperature_c"),
            (F.col("n") % 101).cast("double").alias("humidity_percent"),
            (F.col("n") % 41).cast("double").alias("wind_speed_mph"),
            F.element_at(conditions, (F.col("n") % 7 + 1).cast("int")).alias("weather_condition"),
            demand["heating_degree_days"].alias("heating_degree_days"),
            demand["cooling_degree_days"].alias("cooling_degree_days"),
        ),
        "weather.csv",
    )


def severity(flag: str) -> Column:
    return F.when(F.col(flag) == "A", "Low").when(F.col(flag) == "N", "Medium").otherwise("High")


def outages(spark: SparkSession, sf: str) -> DataFrame:
    """One outage per line item; ids repeat where order and line number do."""
    return numbered_outages(spark, sf).drop("n")


def numbered_outages(spark: SparkSession, sf: str) -> DataFrame:
    supplier = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    placed = with_nation(spark, sf, supplier, "s_nationkey").select("l_suppkey", "region")
    lines = lookup_join(
        load(spark, sf, "lineitem"), placed, "l_suppkey", lookup_rows=supplier.count()
    )
    minutes = F.col("l_quantity") * 30
    start = F.col("l_shipdate").cast("timestamp")
    kinds = F.array(
        *[F.lit(k) for k in ("Planned Maintenance", "Network Fault", "Storm Damage", "Equipment Failure")]
    )
    return lineage(
        lines.select(
            F.concat_ws("-", F.lit("O"), text(F.col("l_orderkey")), text(F.col("l_linenumber"))).alias(
                "outage_id"
            ),
            "region",
            F.element_at(kinds, (F.col("l_linenumber") % 4 + 1).cast("int")).alias("outage_type"),
            severity("l_returnflag").alias("severity"),
            start.alias("outage_start_timestamp"),
            F.timestamp_add("MINUTE", minutes.cast("bigint"), start).alias("outage_end_timestamp"),
            minutes.alias("duration_minutes"),
            F.col("l_partkey").alias("affected_customers"),
            (F.col("l_linestatus") == "F").alias("resolved_flag"),
            ((F.col("l_partkey") * 100000 + F.col("l_suppkey")) * 100 + F.col("l_quantity"))
            .cast("bigint")
            .alias("n"),
        ),
        "outages.csv",
    )


def load_time(key: str) -> Column:
    """Text of a load time that repeats every five keys, so that newer copies exist."""
    hour = (F.col(key) * 7 % 5).cast("string")
    return F.concat(F.lit("2025-02-01 0"), hour, F.lit(":00:00"))


def raw(df: DataFrame, key: str, changed: dict[str, Column]) -> DataFrame:
    """All-text form of a domain table: changed columns first, load columns last."""
    shaped = df.withColumns(changed).drop("silver_processed_at_utc")
    timed = shaped.withColumn("_ingested_at_utc", load_time(key))
    return timed.select(
        F.col(key).cast("bigint").alias("row_number"), *[text(F.col(c)).alias(c) for c in timed.columns]
    )


def number_of(identifier_column: str) -> Column:
    return F.substring(identifier_column, 2, 20).cast("bigint")


def raw_readings(spark: SparkSession, sf: str) -> DataFrame:
    base = readings(spark, sf).withColumn("n", number_of("reading_id"))
    kwh = text(F.col("consumption_kwh"))
    return raw(
        base,
        "n",
        {
            "reading_id": F.when(F.col("n") % 401 == 0, "")
            .when(F.col("n") % 50 == 49, identifier("R", F.col("n") - 1))
            .otherwise(F.concat(F.lit("  "), F.col("reading_id"), F.lit(" "))),
            "meter_id": every("n", 211, F.lit(None), F.col("meter_id")),
            "customer_id": every("n", 307, F.lit(" "), F.col("customer_id")),
            "reading_timestamp": F.when(F.col("n") % 503 == 0, "abc")
            .when(F.col("n") % 997 == 0, "2030-01-01 00:00:00")
            .otherwise(F.date_format("reading_timestamp", "yyyy-MM-dd HH:mm:ss")),
            "consumption_kwh": F.when(F.col("n") % 499 == 0, "abc")
            .when(F.col("n") % 199 == 0, F.concat(F.lit("-"), kwh))
            .otherwise(kwh),
        },
    ).drop("n")


def raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    base = customers(spark, sf).withColumn("n", number_of("customer_id"))
    return raw(
        base,
        "n",
        {
            "customer_id": F.when(F.col("n") % 59 == 58, identifier("C", F.col("n") - 1)).otherwise(
                F.col("customer_id")
            ),
            "customer_name": every("n", 61, F.lit(" "), F.col("customer_name")),
            "email": F.when(F.col("n") % 37 == 0, "no-at-sign")
            .when(F.col("n") % 43 == 0, F.lit(None))
            .otherwise(F.col("email")),
            "region": every("n", 53, F.lit(None), F.col("region")),
            "account_status": F.when(F.col("n") % 41 == 0, "Unknown")
            .when(F.col("n") % 71 == 0, F.lit(None))
            .otherwise(F.col("account_status")),
            "registration_date": every("n", 47, F.lit("soon"), text(F.col("registration_date"))),
        },
    ).drop("n")


def raw_tariffs(spark: SparkSession, sf: str) -> DataFrame:
    base = tariffs(spark, sf).withColumn("n", number_of("tariff_id"))
    return raw(
        base,
        "n",
        {
            "tariff_id": F.when(F.col("n") % 59 == 58, identifier("T", F.col("n") - 1)).otherwise(
                F.col("tariff_id")
            ),
            "tariff_name": every("n", 61, F.lit(None), F.col("tariff_name")),
            "standing_charge_pence_per_day": F.when(F.col("n") % 37 == 0, "-1.5")
            .when(F.col("n") % 43 == 0, "free")
            .otherwise(text(F.col("standing_charge_pence_per_day"))),
            "unit_rate_pence_per_kwh": F.when(F.col("n") % 41 == 0, "0").otherwise(
                text(F.col("unit_rate_pence_per_kwh"))
            ),
            "green_energy_flag": every("n", 53, F.lit("perhaps"), text(F.col("green_energy_flag"))),
            "effective_start_date": every("n", 47, F.lit(None), text(F.col("effective_start_date"))),
            "effective_end_date": F.when(F.col("n") % 35 == 0, "2024-12-31").otherwise(
                text(F.col("effective_end_date"))
            ),
        },
    ).drop("n")


def raw_meters(spark: SparkSession, sf: str) -> DataFrame:
    base = meters(spark, sf).withColumn("n", number_of("meter_id"))
    return raw(
        base,
        "n",
        {
            "meter_id": F.when(F.col("n") % 19 == 18, identifier("M", F.col("n") - 1)).otherwise(
                F.col("meter_id")
            ),
            "customer_id": F.when(F.col("n") % 13 == 0, identifier("X", "n"))
            .when(F.col("n") % 17 == 0, F.lit(None))
            .otherwise(F.col("customer_id")),
            "tariff_id": F.when(F.col("n") % 23 == 0, identifier("X", "n"))
            .when(F.col("n") % 29 == 0, "")
            .otherwise(F.col("tariff_id")),
            "meter_type": F.when(F.col("n") % 31 == 0, "ANALOGUE")
            .when(F.col("n") % 37 == 0, F.lit(None))
            .otherwise(F.col("meter_type")),
            "meter_status": every("n", 41, F.lit("Lost"), F.col("meter_status")),
            "installation_date": every("n", 43, F.lit("soon"), text(F.col("installation_date"))),
        },
    ).drop("n")


def raw_weather(spark: SparkSession, sf: str) -> DataFrame:
    base = weather(spark, sf).withColumn(
        "n",
        F.datediff("weather_date", F.lit("2000-01-01").cast("date")) * 100
        + F.ascii(F.substring("region", 2, 1)),
    )
    return raw(
        base,
        "n",
        {
            "weather_id": every("n", 59, F.lit(""), F.col("weather_id")),
            "weather_date": every("n", 61, F.lit("soon"), text(F.col("weather_date"))),
            "region": every("n", 53, F.lit(None), F.col("region")),
            "avg_temperature_c": F.when(F.col("n") % 37 == 0, "50")
            .when(F.col("n") % 43 == 0, "mild")
            .otherwise(text(F.col("avg_temperature_c"))),
            "max_temperature_c": every("n", 41, F.lit("-60"), text(F.col("max_temperature_c"))),
            "humidity_percent": F.when(F.col("n") % 47 == 0, "101").otherwise(
                text(F.col("humidity_percent"))
            ),
            "wind_speed_mph": F.when(F.col("n") % 67 == 0, F.lit(None)).otherwise(
                text(F.col("wind_speed_mph"))
            ),
            "weather_condition": F.when(F.col("n") % 71 == 0, "Hail")
            .when(F.col("n") % 73 == 0, F.lit(None))
            .otherwise(F.col("weather_condition")),
        },
    ).drop("n")


def raw_outages(spark: SparkSession, sf: str) -> DataFrame:
    base = numbered_outages(spark, sf)
    return raw(
        base,
        "n",
        {
            "region": every("affected_customers", 53, F.lit(""), F.col("region")),
            "outage_type": every("affected_customers", 41, F.lit("Unknown"), F.col("outage_type")),
            "severity": F.when(F.col("affected_customers") % 43 == 0, "Total")
            .when(F.col("affected_customers") % 71 == 0, F.lit(None))
            .otherwise(F.col("severity")),
            "outage_start_timestamp": every(
                "affected_customers", 47, F.lit("then"), F.date_format("outage_start_timestamp", "yyyy-MM-dd HH:mm:ss")
            ),
            "outage_end_timestamp": F.when(F.col("affected_customers") % 37 == 0, "1990-01-01 00:00:00").otherwise(
                F.date_format("outage_end_timestamp", "yyyy-MM-dd HH:mm:ss")
            ),
            "duration_minutes": every("affected_customers", 59, F.lit("0"), text(F.col("duration_minutes"))),
            "affected_customers": F.when(F.col("affected_customers") % 61 == 0, "-1").otherwise(
                text(F.col("affected_customers"))
            ),
        },
    ).drop("n")


def raw_billing(spark: SparkSession, sf: str) -> DataFrame:
    base = billing(spark, sf).withColumn("n", number_of("billing_event_id"))
    return raw(
        base,
        "n",
        {
            "billing_event_id": F.when(F.col("n") % 59 == 58, identifier("B", F.col("n") - 1)).otherwise(
                F.col("billing_event_id")
            ),
            "customer_id": F.when(F.col("n") % 13 == 0, identifier("X", "n"))
            .when(F.col("n") % 17 == 0, F.lit(None))
            .otherwise(F.col("customer_id")),
            "tariff_id": F.when(F.col("n") % 23 == 0, identifier("X", "n"))
            .when(F.col("n") % 29 == 0, "")
            .otherwise(F.col("tariff_id")),
            "billing_date": every("n", 61, F.lit("soon"), text(F.col("billing_date"))),
            "billing_period_end": every("n", 67, F.lit("1999-01-01"), text(F.col("billing_period_end"))),
            "total_consumption_kwh": every("n", 47, F.lit("-2"), text(F.col("total_consumption_kwh"))),
            "total_amount": F.when(F.col("n") % 37 == 0, "-9.5")
            .when(F.col("n") % 41 == 0, "much")
            .when(F.col("n") % 3 != 0, "250.25")
            .otherwise(text(F.col("total_amount"))),
            "payment_status": F.when(F.col("n") % 71 == 0, "Lost")
            .when(F.col("n") % 73 == 0, F.lit(None))
            .otherwise(F.col("payment_status")),
            "payment_method": every("n", 79, F.lit("Cheque"), F.col("payment_method")),
            "paid_at": every("n", 5, F.lit(None), text(F.col("paid_at"))),
        },
    ).drop("n")
