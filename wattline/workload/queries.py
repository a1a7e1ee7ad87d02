"""Every registered query: the Spark job and the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wattline.functions import (
    LOAD_AUDIT,
    cast_columns,
    degree_days,
    ensure_columns,
    pence_to_pounds,
    surrogate_key,
    trim_strings,
)
from wattline.operators import checks, incremental, rulesets, scd
from wattline.operators.audit import LANDING_AUDIT, VALIDATION_AUDIT, audit_of_run, create_audit_tables
from wattline.operators.dedup import distinct_rows, flag_duplicates, latest_rows
from wattline.operators.rules import NULL_DROPS, RuleSet
from wattline.operators.sinks import (
    FULL,
    INCREMENTAL,
    create_schemas,
    create_table,
    in_partitions,
    land_table,
    publish,
    replace_partitions,
    save_table,
    source_metadata,
    write_daily_csv,
)
from wattline.operators.skew import flag_unknown_keys
from wattline.operators.validate import (
    billing_profile,
    clean_rows,
    drift_profile,
    flag_rows,
    outcome_counts,
    quarantine_summary,
    quarantined_rows,
    readings_profile,
    standardise,
    verdict,
)
from wattline.plans import dimensions, facts, growth, marts
from wattline.plans.build import Build
from wattline.plans.billing import billable, billing_charges
from wattline.plans.landing import FILE_LOG, FILE_LOG_COLUMNS, land_source, lineage_columns
from wattline.plans.staging import stage
from wattline.plans.validation import validate_new_rows, validate_source
from wattline.session import prepare, shared_folder
from wattline.sources.csv import NoFilesFound, file_manifest, list_files, read_daily_files, union_by_name, unseen_files
from wattline.sources.registry import Source
from wattline.streaming.ingest import ingest_new_files, read_ingested
from wattline.streaming.usage import rows_behind, run_usage_stream, streamed_daily_usage
from wattline.workload import oracle, roles
from wattline.workload.oracle import AS_OF as NOW
from wattline.workload.oracle import half_up, key, sql
from wattline.workload.roles import AS_OF, RUN

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, expected: str | None = None) -> Callable[[Query], Query]:
    def add(job: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return job(prepare(spark), str(sf).rstrip("/"))

        run.__name__, run.__doc__ = name, job.__doc__
        QUERIES[name] = run
        if expected is not None:
            ORACLE[name] = expected
        return job

    return add


# --- reports -----------------------------------------------------------------------------


@register(
    "daily_energy_summary",
    sql(
        f"""select {key('u.reading_date', 'u.region')} as daily_energy_summary_sk, u.*, w.avg_temperature_c,
          w.weather_condition, w.heating_degree_days, w.cooling_degree_days,
          coalesce(b.total_revenue_amount, 0) as total_revenue_amount,
          coalesce(b.billed_consumption_kwh, 0) as billed_consumption_kwh,
          coalesce(b.billing_event_count, 0) as billing_event_count
        from ({oracle.DAILY_USAGE}) u
        left join weather w on u.reading_date = w.weather_date and u.region = w.region
        left join ({oracle.DAILY_BILLING}) b on u.reading_date = b.billing_date and u.region = b.region""",
        "readings",
        "weather",
        "billing",
    ),
)
def daily_energy_summary(spark, sf):
    return marts.daily_energy_summary(
        billable(roles.readings(spark, sf)), roles.weather(spark, sf), roles.billing(spark, sf)
    )


@register("daily_usage", sql(oracle.DAILY_USAGE, "readings"))
def daily_usage(spark, sf):
    return marts.daily_usage(billable(roles.readings(spark, sf)))


@register("daily_billing", sql(oracle.DAILY_BILLING, "billing"))
def daily_billing(spark, sf):
    return marts.daily_billing(roles.billing(spark, sf))


@register("customer_billing", sql(oracle.CUSTOMER_BILLING, "billing"))
def customer_billing(spark, sf):
    return marts.customer_billing(roles.billing(spark, sf))


@register(
    "customer_energy_summary",
    sql(
        f"""select {key('c.customer_id')} as customer_sk, c.customer_id, c.customer_name, c.region,
          c.customer_segment, c.property_type, c.account_status, count(distinct r.meter_id) as meter_count,
          count(*) as reading_count, {half_up(oracle.exact_sum('r.consumption_kwh'), 3)} as total_consumption_kwh,
          {half_up(oracle.mean('r.consumption_kwh'), 3)} as avg_half_hour_consumption_kwh,
          {half_up('max(r.consumption_kwh)', 3)} as max_half_hour_consumption_kwh,
          min(r.reading_date) as first_reading_date, max(r.reading_date) as latest_reading_date,
          coalesce(any_value(b.total_billed_amount), 0) as total_billed_amount,
          coalesce(any_value(b.total_billed_consumption_kwh), 0) as total_billed_consumption_kwh,
          coalesce(any_value(b.billing_event_count), 0) as billing_event_count,
          coalesce(any_value(b.paid_amount), 0) as paid_amount,
          coalesce(any_value(b.unpaid_or_problem_amount), 0) as unpaid_or_problem_amount,
          coalesce({oracle.exact_sum('r.consumption_kwh')} > 1000, false) as is_high_consumption_customer
        from customers c left join readings r on c.customer_id = r.customer_id
        left join ({oracle.CUSTOMER_BILLING}) b on c.customer_id = b.customer_id
        group by c.customer_id, c.customer_name, c.region, c.customer_segment, c.property_type,
          c.account_status""",
        "customers",
        "readings",
        "billing",
    ),
)
def customer_energy_summary(spark, sf):
    keyed = roles.customers(spark, sf).withColumn("customer_sk", surrogate_key("customer_id"))
    return marts.customer_energy_summary(keyed, roles.readings(spark, sf), roles.billing(spark, sf))


@register(
    "billing_charges",
    sql(
        """select customer_id, tariff_id, region, reading_date as billing_date,
          reading_date as billing_period_start, reading_date as billing_period_end,
          cast(kwh as double) as total_consumption_kwh, cast(standing as double) as standing_charge_amount,
          cast(energy as double) as energy_charge_amount, cast(vat as double) as vat_amount,
          cast(energy + standing + vat as double) as total_amount, reading_date + 14 as due_date
        from (select *, round((energy + standing) * 0.05, 2) as vat from (
          select *, round(kwh * (cast(rate as decimal(12, 6)) * 0.01), 2) as energy,
            round(cast(charge as decimal(12, 6)) * 0.01, 2) as standing
          from (select r.reading_date, r.customer_id, m.tariff_id, r.region,
              t.standing_charge_pence_per_day as charge, t.unit_rate_pence_per_kwh as rate,
              cast(round(sum(cast(r.consumption_kwh as decimal(20, 6))), 3) as decimal(18, 3)) as kwh
            from readings r
            left join (select distinct meter_id, customer_id, tariff_id, region from meters) m
              on r.meter_id = m.meter_id and r.customer_id = m.customer_id
              and r.region is not distinct from m.region
            left join (select distinct tariff_id, standing_charge_pence_per_day, unit_rate_pence_per_kwh
              from tariffs) t on m.tariff_id is not distinct from t.tariff_id
            where r.consumption_kwh between 0 and 100 group by all) g) e) v""",
        "readings",
        "meters",
        "tariffs",
    ),
)
def charges(spark, sf):
    return billing_charges(roles.readings(spark, sf), roles.meters(spark, sf), roles.tariffs(spark, sf))


@register(
    "late_arrivals",
    sql(
        f"""select reading_date, region, count(*) as reading_count,
          count(*) filter (where is_late_arriving) as late_arriving_reading_count,
          {half_up('avg(ingestion_delay_hours) filter (where is_late_arriving)', 2)} as avg_delay_hours
        from readings group by reading_date, region""",
        "readings",
    ),
)
def late_arrivals(spark, sf):
    return marts.late_arrivals(roles.readings(spark, sf))


@register(
    "billable_readings",
    sql(
        """select reading_id, customer_id, meter_id, consumption_kwh from readings
        where customer_id is not null and meter_id is not null and consumption_kwh between 0 and 100""",
        "readings",
    ),
)
def billable_readings(spark, sf):
    return billable(roles.readings(spark, sf)).select(
        "reading_id", "customer_id", "meter_id", "consumption_kwh"
    )


@register(
    "readings_sample",
    sql(
        """select reading_id, meter_id, customer_id, reading_timestamp, reading_date, consumption_kwh,
          voltage, reading_source, meter_status, region, firmware_version, signal_strength_dbm,
          meter_reading_quality_code, silver_processed_at_utc from readings order by reading_id limit 20""",
        "readings",
    ),
)
def readings_sample(spark, sf):
    """Twenty rows to look at, the first by id."""
    # The columns shown.
    shown = (
        "reading_id", "meter_id", "customer_id", "reading_timestamp", "reading_date", "consumption_kwh",
        "voltage", "reading_source", "meter_status", "region", "firmware_version", "signal_strength_dbm",
        "meter_reading_quality_code", "silver_processed_at_utc",
    )
    return roles.readings(spark, sf).select(*shown).orderBy("reading_id").limit(20)


# --- columns -----------------------------------------------------------------------------


@register(
    "surrogate_keys",
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
      {key('l_orderkey', "nullif(l_linenumber, 3)", 'l_shipdate::date')} as line_sk from lineitem""",
)
def surrogate_keys(spark, sf):
    line = roles.load(spark, sf, "lineitem")
    parts = ("l_orderkey", F.nullif("l_linenumber", F.lit(3)), F.col("l_shipdate").cast("date"))
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", surrogate_key(*parts).alias("line_sk")
    )


@register(
    "pence_to_pounds",
    """select p_partkey, cast(round(cast(p_retailprice as decimal(18, 6)) * 0.01, 2) as double) as price_pounds,
      cast(round(cast(p_size + 0.5 as decimal(18, 6)) * 0.01, 2) as double) as size_pounds from part""",
)
def pounds(spark, sf):
    return roles.load(spark, sf, "part").select(
        "p_partkey",
        pence_to_pounds("p_retailprice").alias("price_pounds"),
        pence_to_pounds(F.col("p_size") + F.lit(0.5)).alias("size_pounds"),
    )


@register(
    "degree_days",
    """select s_suppkey,
      cast(round(cast(greatest(0, 15.5 - t) as decimal(18, 6)), 2) as double) as heating_degree_days,
      cast(round(cast(greatest(0, t - 22) as decimal(18, 6)), 2) as double) as cooling_degree_days
    from (select s_suppkey, s_acctbal / 256 as t from supplier) s""",
)
def demand(spark, sf):
    measures = degree_days(F.col("s_acctbal") / 256)
    return roles.load(spark, sf, "supplier").select(
        "s_suppkey", *[c.alias(name) for name, c in measures.items()]
    )


@register(
    "trim_strings",
    """select c_custkey, trim(c_name) as c_name, trim(c_mktsegment) as c_mktsegment, c_acctbal
    from (select c_custkey, '  ' || c_name || ' ' as c_name, c_mktsegment || '   ' as c_mktsegment, c_acctbal
      from customer) c""",
)
def trimmed(spark, sf):
    padded = roles.load(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.concat("c_mktsegment", F.lit("   ")).alias("c_mktsegment"),
        "c_acctbal",
    )
    return trim_strings(padded)


@register(
    "try_casts",
    """select event_id, case when event_id % 50 = 0 then null else value end as number,
      case when event_id % 60 = 0 then null else cast(ts as date) end as day,
      case when event_id % 70 = 0 then null else date_trunc('second', ts) end as at,
      case when event_id % 80 = 0 then null else event_id end as whole,
      case when event_id % 90 = 0 then null else event_id % 2 = 0 end as yes
    from events""",
)
def try_casts(spark, sf):
    e = F.col("event_id")
    texts = roles.load(spark, sf, "events").select(
        "event_id",
        F.when(e % 50 == 0, "abc").otherwise(F.col("value").cast("string")).alias("number"),
        F.when(e % 60 == 0, "").otherwise(F.col("ts").cast("date").cast("string")).alias("day"),
        F.when(e % 70 == 0, "never").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("at"),
        F.when(e % 80 == 0, "ten").otherwise(e.cast("string")).alias("whole"),
        F.when(e % 90 == 0, "perhaps").when(e % 2 == 0, "True").otherwise("False").alias("yes"),
    )
    kinds = {"number": "double", "day": "date", "at": "timestamp", "whole": "bigint", "yes": "boolean"}
    return cast_columns(texts, kinds)


@register(
    "late_columns",
    "select event_id, cast(null as varchar) as firmware_version, "
    "cast(null as double) as signal_strength_dbm, event_type from events",
)
def late_columns(spark, sf):
    """Rows of a batch from before a schema change, with its later columns as nulls."""
    batch = roles.load(spark, sf, "events").select("event_id", "event_type")
    return ensure_columns(
        batch, {"firmware_version": "string", "signal_strength_dbm": "double", "event_type": "string"}
    )


@register(
    "landing_lineage",
    sql(
        f"""select reading_id, source_file_name, 'meter_readings' as _source_name,
          source_file_name as _source_file_path, {NOW} as _ingested_at_utc, 'run-1' as _run_id,
          'test' as _environment from readings""",
        "readings",
    ),
)
def landing_lineage(spark, sf):
    rows = roles.readings(spark, sf).select("reading_id", "source_file_name")
    return lineage_columns(rows, "meter_readings", RUN)


@register(
    "source_metadata",
    """select event_id, 'meter_readings_' || strftime(ts, '%Y%m%d') || '.csv' as source_file_name,
      'meters' as source_system, timestamp '2026-01-01 00:00:00' as generated_at_utc from events""",
)
def raw_file_columns(spark, sf):
    rows = roles.load(spark, sf, "events").select("event_id", F.col("ts").cast("date").alias("day"))
    return source_metadata(rows, "day", "meter_readings", "meters", AS_OF).drop("day")


# --- validation --------------------------------------------------------------------------

ROLES: dict[str, tuple[Query, RuleSet]] = {
    "readings": (roles.raw_readings, rulesets.READINGS),
    "customers": (roles.raw_customers, rulesets.CUSTOMERS),
    "tariffs": (roles.raw_tariffs, rulesets.TARIFFS),
    "meters": (roles.raw_meters, rulesets.METERS),
    "weather": (roles.raw_weather, rulesets.WEATHER),
    "outages": (roles.raw_outages, rulesets.OUTAGES),
    "billing": (roles.raw_billing, rulesets.BILLING),
}


def flagged_role(spark: SparkSession, sf: str, role: str) -> tuple[DataFrame, RuleSet]:
    source, rules = ROLES[role]
    references = {}
    if role in ("meters", "billing"):
        references = {
            "customers_clean": roles.customers(spark, sf).select("customer_id"),
            "tariffs_clean": roles.tariffs(spark, sf).select("tariff_id"),
        }
    typed = standardise(source(spark, sf), rules)
    return flag_rows(typed, rules, AS_OF, references, position=("row_number",)), rules


def coded(flag: str):
    """A flag as T, F or N, so that an unknown verdict stays visible."""
    return F.when(F.col(flag), "T").when(~F.col(flag), "F").otherwise("N").alias(flag)


def register_rule_flags(role: str) -> None:
    def job(spark, sf):
        flagged, rules = flagged_role(spark, sf, role)
        return flagged.select("row_number", *[coded(f) for f in rules.flags], "quarantine_reason")

    register(f"rule_flags_{role}", oracle.rule_flags(role))(job)


for _role in ROLES:
    register_rule_flags(_role)


def judged_sql(columns: str, role: str, condition: str) -> str:
    return sql(f"select {columns} from judged_{role} where {condition}", f"judged_{role}")


@register(
    "quarantine_reasons",
    judged_sql(
        f"row_number, reading_id, {oracle.reason('readings')} as quarantine_reason", "readings", "true"
    ),
)
def quarantine_reasons(spark, sf):
    flagged, _ = flagged_role(spark, sf, "readings")
    return flagged.select("row_number", "reading_id", "quarantine_reason")


@register(
    "quarantine_summary",
    sql(
        f"""select {oracle.reason('readings')} as quarantine_reason, count(*) as count
        from judged_readings where {oracle.faulty('readings', False)} group by 1""",
        "judged_readings",
    ),
)
def reasons_by_count(spark, sf):
    flagged, rules = flagged_role(spark, sf, "readings")
    return quarantine_summary(quarantined_rows(flagged, rules, AS_OF))


@register(
    "clean_rows",
    judged_sql(
        f"""row_number, billing_event_id, customer_id, tariff_id, billing_date, total_amount,
        payment_status, {NOW} as silver_processed_at_utc""",
        "billing",
        f"not {oracle.faulty('billing', True)}",
    ),
)
def clean_bills(spark, sf):
    flagged, rules = flagged_role(spark, sf, "billing")
    return clean_rows(flagged, rules, AS_OF).select(
        "row_number",
        "billing_event_id",
        "customer_id",
        "tariff_id",
        "billing_date",
        "total_amount",
        "payment_status",
        "silver_processed_at_utc",
    )


@register(
    "quarantined_rows",
    judged_sql(
        f"""row_number, billing_event_id, {oracle.reason('billing')} as quarantine_reason,
        {NOW} as quarantined_at_utc""",
        "billing",
        oracle.faulty("billing", True),
    ),
)
def quarantined_bills(spark, sf):
    flagged, rules = flagged_role(spark, sf, "billing")
    return quarantined_rows(flagged, rules, AS_OF).select(
        "row_number", "billing_event_id", "quarantine_reason", "quarantined_at_utc"
    )


@register(
    "clean_rows_3vl",
    judged_sql(
        "row_number, reading_id, meter_id, consumption_kwh, voltage, '' as quarantine_reason",
        "readings",
        f"not {oracle.faulty('readings', False)}",
    ),
)
def clean_readings(spark, sf):
    flagged, rules = flagged_role(spark, sf, "readings")
    return clean_rows(flagged, rules, AS_OF).select(
        "row_number", "reading_id", "meter_id", "consumption_kwh", "voltage", "quarantine_reason"
    )


@register(
    "quarantined_rows_3vl",
    judged_sql(
        f"""row_number, reading_id, {oracle.reason('readings')} as quarantine_reason, cast(place as int)
          as duplicate_rank""",
        "readings",
        oracle.faulty("readings", False),
    ).replace(
        "select *, reading_id is null or reading_id = '' as is_missing_reading_id",
        """select *, row_number() over (partition by reading_id
          order by loaded desc nulls last, row_number) as place,
          reading_id is null or reading_id = '' as is_missing_reading_id""",
    ),
)
def quarantined_readings(spark, sf):
    flagged, rules = flagged_role(spark, sf, "readings")
    return quarantined_rows(flagged, rules, AS_OF).select(
        "row_number", "reading_id", "quarantine_reason", "duplicate_rank"
    )


@register(
    "unjudged_rows",
    judged_sql(
        "row_number, reading_id", "readings", f"{oracle.faulty('readings', False)} is null"
    ),
)
def unjudged_rows(spark, sf):
    """Rows that land in neither table because a rule could not be decided."""
    flagged, rules = flagged_role(spark, sf, "readings")
    return flagged.filter(verdict(rules.flags, NULL_DROPS).isNull()).select("row_number", "reading_id")


@register(
    "silver_metrics",
    "\nunion all\n".join(
        f"select * from ({part})"
        for part in (
            sql(
                f"""select '{role}' as source, count(*) as bronze_records,
                  count(*) filter (where not {oracle.faulty(role, nulls)}) as clean_records,
                  count(*) filter (where {oracle.faulty(role, nulls)}) as quarantined_records,
                  count(*) filter (where {flag}) as duplicate_records from judged_{role}""",
                f"judged_{role}",
            )
            for role, nulls, flag in (
                ("readings", False, "is_duplicate_reading"),
                ("billing", True, "is_duplicate_billing_event_id"),
            )
        )
    ),
)
def silver_metrics(spark, sf):
    parts = []
    for role in ("readings", "billing"):
        flagged, rules = flagged_role(spark, sf, role)
        parts.append(outcome_counts(flagged, rules).select(F.lit(role).alias("source"), "*"))
    return parts[0].unionByName(parts[1])


@register(
    "readings_profile",
    sql(
        f"""select cast(count(*) as bigint) as total_rows,
          count(*) filter (where customer_id is null) as missing_customer_id,
          count(*) filter (where meter_id is null) as missing_meter_id,
          count(*) filter (where consumption_kwh < 0) as negative_consumption,
          count(*) filter (where consumption_kwh > 100) as consumption_outliers,
          count(*) filter (where reading_timestamp > {NOW}) as future_timestamps,
          cast(count(*) - (select count(*) from (select distinct reading_id, meter_id, customer_id,
            reading_timestamp, consumption_kwh from cast_readings)) as bigint) as duplicate_rows
        from cast_readings""",
        "cast_readings",
    ),
)
def profile_readings(spark, sf):
    typed = standardise(roles.raw_readings(spark, sf), rulesets.READINGS)
    return readings_profile(
        typed.select("reading_id", "meter_id", "customer_id", "reading_timestamp", "consumption_kwh"), AS_OF
    )


@register(
    "billing_profile",
    sql(
        """select cast(count(*) as bigint) as total_rows,
          count(*) filter (where tariff_id is null) as missing_tariff_id,
          count(*) filter (where total_amount < 0) as negative_amounts,
          count(*) filter (where total_amount > 1000) as high_amounts,
          cast(count(*) - (select count(*) from (select distinct customer_id, tariff_id, total_amount
            from cast_billing)) as bigint) as duplicate_rows
        from cast_billing""",
        "cast_billing",
    ),
)
def profile_billing(spark, sf):
    typed = standardise(roles.raw_billing(spark, sf), rulesets.BILLING)
    return billing_profile(typed.select("customer_id", "tariff_id", "total_amount"))


# --- duplicates and references -----------------------------------------------------------


@register(
    "duplicate_flags",
    """select l_orderkey, l_linenumber, cast(count(*) as bigint) as copies,
      cast(count(*) - 1 as bigint) as flagged, cast(max(l_shipdate) as date) as kept_shipdate
    from lineitem group by 1, 2""",
)
def duplicate_flags(spark, sf):
    """Copies of each order line, those flagged, and the ship date of the one that is not."""
    line = roles.load(spark, sf, "lineitem").withColumn("n", F.col("l_partkey") * 100000 + F.col("l_suppkey"))
    flagged = flag_duplicates(
        line, ["l_orderkey", "l_linenumber"], "is_duplicate", "l_shipdate", position=("n",)
    )
    return flagged.groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if("is_duplicate").alias("flagged"),
        F.max(F.when(~F.col("is_duplicate"), F.col("l_shipdate"))).cast("date").alias("kept_shipdate"),
    )


@register(
    "latest_per_key",
    """select o_custkey, o_orderkey, cast(o_orderdate as date) as last_order from (
      select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) as place
      from orders) o where place = 1""",
)
def latest_per_key(spark, sf):
    newest = latest_rows(roles.load(spark, sf, "orders"), "o_custkey", "o_orderdate", ("o_orderkey",))
    return newest.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("last_order"))


@register("distinct_keys", "select distinct l_partkey, l_suppkey from lineitem")
def distinct_keys(spark, sf):
    return distinct_rows(roles.load(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@register(
    "reference_check",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, k as customer_key,
      k is not null and k not in (select c_custkey from customer) as is_unknown_customer
    from (select *, case when l_linenumber = 7 then null else l_orderkey % 3000 end as k from lineitem) l""",
)
def reference_check(spark, sf):
    line = roles.load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey") % 3000).alias("customer_key"),
    )
    known = roles.load(spark, sf, "customer").select(F.col("c_custkey").alias("customer_key"))
    return flag_unknown_keys(line, known, "customer_key", "is_unknown_customer")


# --- staging and dimensions --------------------------------------------------------------

STAGED: dict[str, tuple[str, Query]] = {
    "customers": ("stg_customers", roles.customers),
    "tariffs": ("stg_tariffs", roles.tariffs),
    "meters": ("stg_meters", roles.meters),
    "readings": ("stg_meter_readings", roles.readings),
    "weather": ("stg_weather", roles.weather),
    "outages": ("stg_outage_events", roles.outages),
    "billing": ("stg_billing_events", roles.billing),
}


def staged_role(spark: SparkSession, sf: str, role: str) -> DataFrame:
    model, source = STAGED[role]
    return stage(model, source(spark, sf), RUN)


def register_staging(role: str) -> None:
    register(STAGED[role][0], oracle.staged(role))(lambda spark, sf: staged_role(spark, sf, role))


for _role in STAGED:
    register_staging(_role)

_CUSTOMER_DIM = f"""select {key('customer_id')} as customer_sk, customer_id, customer_name, email, phone_number,
  postcode, region, customer_segment, property_type, account_status, registration_date,
  account_status = 'Active' as is_active_customer, source_system, silver_processed_at_utc, {oracle.STAMP}
  from customers"""
_TARIFF_DIM = f"""select {key('tariff_id')} as tariff_sk, tariff_id, tariff_name, standing_charge_pence_per_day,
  cast(round(cast(standing_charge_pence_per_day as decimal(18, 6)) * 0.01, 2) as double)
    as standing_charge_amount_per_day, unit_rate_pence_per_kwh,
  cast(round(cast(unit_rate_pence_per_kwh as decimal(18, 6)) * 0.01, 2) as double) as unit_rate_amount_per_kwh,
  green_energy_flag, effective_start_date, effective_end_date,
  effective_end_date is null as is_current_tariff, {oracle.STAMP} from tariffs"""
_METER_DIM = f"""select {key('m.meter_id')} as meter_sk, m.meter_id,
  case when c.customer_id is not null then {key('c.customer_id')} end as customer_sk,
  case when t.tariff_id is not null then {key('t.tariff_id')} end as tariff_sk, m.customer_id, m.tariff_id,
  m.region, m.meter_type, m.meter_status, m.installation_date, m.meter_status = 'Active' as is_active_meter,
  m.silver_processed_at_utc, {oracle.STAMP}
  from meters m left join customers c on m.customer_id = c.customer_id
  left join tariffs t on m.tariff_id = t.tariff_id"""


@register("dim_customers", sql(_CUSTOMER_DIM, "customers"))
def dim_customers(spark, sf):
    return dimensions.dim_customers(staged_role(spark, sf, "customers"), RUN)


@register("dim_tariffs", sql(_TARIFF_DIM, "tariffs"))
def dim_tariffs(spark, sf):
    return dimensions.dim_tariffs(staged_role(spark, sf, "tariffs"), RUN)


@register("dim_meters", sql(_METER_DIM, "meters", "customers", "tariffs"))
def dim_meters(spark, sf):
    return dimensions.dim_meters(
        staged_role(spark, sf, "meters"), dim_customers(spark, sf), dim_tariffs(spark, sf), RUN
    )


@register(
    "dim_regions",
    sql(f"select {key('region')} as region_sk, region, {oracle.STAMP} from ({oracle.REGIONS}) r", *STAGED),
)
def dim_regions(spark, sf):
    frames = [source(spark, sf) for role, (_, source) in STAGED.items() if role != "tariffs"]
    return dimensions.dim_regions(frames, RUN)


def reading_days(spark: SparkSession, sf: str) -> tuple[date, date]:
    """First and last day of the events: two values that bound the calendar."""
    day = F.col("ts").cast("date")
    return tuple(roles.load(spark, sf, "events").agg(F.min(day), F.max(day)).first())


@register(
    "dim_date",
    f"""select date_sk, date_day, cast(year(date_day) as int) as year_number,
      cast(quarter(date_day) as int) as quarter_number, cast(month(date_day) as int) as month_number,
      strftime(date_day, '%B') as month_name, cast(day(date_day) as int) as day_of_month,
      cast(dayofweek(date_day) + 1 as int) as day_of_week, strftime(date_day, '%a') as day_name,
      cast(weekofyear(date_day) as int) as week_of_year, dayofweek(date_day) in (0, 6) as is_weekend,
      cast(date_trunc('month', date_day) as date) as month_start_date,
      last_day(date_day) as month_end_date, {oracle.STAMP} from ({oracle.DATES}) d""",
)
def dim_date(spark, sf):
    return dimensions.dim_date(spark, RUN, *reading_days(spark, sf))


# --- facts -------------------------------------------------------------------------------


def region_and_date(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    names = roles.load(spark, sf, "region").select(F.col("r_name").alias("region"))
    regions = dimensions.dim_regions([names], RUN)
    return regions, dimensions.dim_date(spark, RUN, *reading_days(spark, sf))


_PLACED = f"""case when {{t}}.region is not null then {key('{t}.region')} end as region_sk, d.date_sk"""


def placed(alias: str) -> str:
    return _PLACED.replace("{t}", alias)


@register(
    "fact_readings",
    sql(
        f"""select {key('r.reading_id')} as meter_reading_sk, m.meter_sk, m.customer_sk, m.tariff_sk,
          {placed('r')}, r.reading_id, r.meter_id, r.customer_id, r.reading_timestamp, r.reading_date,
          r.consumption_kwh, r.voltage, r.reading_source, r.meter_status, r.region, r.is_late_arriving,
          r.ingestion_delay_hours, r.firmware_version, r.signal_strength_dbm, r.meter_reading_quality_code,
          r.silver_processed_at_utc, {oracle.STAMP}
        from readings r left join ({_METER_DIM}) m on r.meter_id = m.meter_id
        left join ({oracle.DATES}) d on r.reading_date = d.date_day""",
        "readings",
        "meters",
        "customers",
        "tariffs",
    ),
)
def fact_readings(spark, sf):
    return facts.fact_meter_readings(
        staged_role(spark, sf, "readings"), dim_meters(spark, sf), *region_and_date(spark, sf), RUN
    )


@register(
    "fact_billing",
    sql(
        f"""select {key('b.billing_event_id')} as billing_event_sk, {key('c.customer_id')} as customer_sk,
          case when t.tariff_id is not null then {key('t.tariff_id')} end as tariff_sk, {placed('b')},
          b.billing_event_id, b.customer_id, b.tariff_id, b.region, b.billing_date, b.billing_period_start,
          b.billing_period_end, b.total_consumption_kwh, b.standing_charge_amount, b.energy_charge_amount,
          b.vat_amount, b.total_amount, b.payment_status, b.payment_method, b.due_date, b.paid_at,
          b.billing_quality_issue_injected, b.silver_processed_at_utc, {oracle.STAMP}
        from billing b left join customers c on b.customer_id = c.customer_id
        left join tariffs t on b.tariff_id = t.tariff_id
        left join ({oracle.DATES}) d on b.billing_date = d.date_day""",
        "billing",
        "customers",
        "tariffs",
    ),
)
def fact_billing(spark, sf):
    return facts.fact_billing_events(
        staged_role(spark, sf, "billing"),
        dim_customers(spark, sf),
        dim_tariffs(spark, sf),
        *region_and_date(spark, sf),
        RUN,
    )


@register(
    "fact_outages",
    sql(
        f"""select {key('o.outage_id')} as outage_sk, {placed('o')}, o.outage_id, o.region, o.outage_type,
          o.severity, o.outage_start_timestamp, o.outage_end_timestamp,
          cast(o.outage_start_timestamp as date) as outage_date, o.duration_minutes, o.affected_customers,
          o.resolved_flag, o.silver_processed_at_utc, {oracle.STAMP}
        from outages o left join ({oracle.DATES}) d on cast(o.outage_start_timestamp as date) = d.date_day""",
        "outages",
    ),
)
def fact_outages(spark, sf):
    return facts.fact_outage_events(staged_role(spark, sf, "outages"), *region_and_date(spark, sf), RUN)


@register(
    "fact_weather",
    sql(
        f"""select {key('w.weather_id')} as weather_sk, {placed('w')}, w.weather_id, w.weather_date, w.region,
          w.avg_temperature_c, w.min_temperature_c, w.max_temperature_c, w.humidity_percent, w.wind_speed_mph,
          w.weather_condition, w.heating_degree_days, w.cooling_degree_days, w.silver_processed_at_utc,
          {oracle.STAMP}
        from weather w left join ({oracle.DATES}) d on w.weather_date = d.date_day""",
        "weather",
    ),
)
def fact_weather(spark, sf):
    return facts.fact_weather_daily(staged_role(spark, sf, "weather"), *region_and_date(spark, sf), RUN)


# --- incremental work --------------------------------------------------------------------


@register(
    "high_watermark",
    "select cast(max(o_orderdate) as date) as newest_order, count(*) as row_count from orders",
)
def high_watermark(spark, sf):
    orders = roles.load(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    newest = incremental.high_watermark(orders, "day")
    return orders.agg(F.lit(newest).alias("newest_order"), F.count(F.lit(1)).alias("row_count"))


@register(
    "incremental_filter",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date) as ship_day from lineitem
    where l_shipdate >= (select max(o_orderdate) - interval 30 day from orders)""",
)
def incremental_filter(spark, sf):
    """Line items shipped since the newest order, with thirty days of overlap."""
    ship_day = F.col("l_shipdate").cast("date")
    lines = roles.load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ship_day.alias("ship_day")
    )
    done = roles.load(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("ship_day"))
    return incremental.newer_rows(lines, done, "ship_day", lookback_days=30)


def customer_batch(spark: SparkSession, sf: str) -> DataFrame:
    """An update of customers in debt, and a new key for each with a large balance."""
    named = roles.load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    changed = named.filter("c_acctbal < 0").withColumn("c_mktsegment", F.lit("CHANGED"))
    added = named.filter("c_acctbal > 9000").withColumn("c_custkey", -F.col("c_custkey") - 1)
    return changed.unionByName(added)


_BATCH = """select c_custkey, c_name, 'CHANGED' as c_mktsegment, c_acctbal from customer where c_acctbal < 0
  union all select -c_custkey - 1, c_name, c_mktsegment, c_acctbal from customer where c_acctbal > 9000"""


@register(
    "upsert_one_key",
    f"""select c_custkey, c_name, c_mktsegment, c_acctbal from customer where c_acctbal >= 0
    union all {_BATCH}""",
)
def upsert_one_key(spark, sf):
    return incremental.upsert(
        roles.load(spark, sf, "customer"), customer_batch(spark, sf), "c_custkey"
    )


@register(
    "upsert_two_keys",
    sql(
        f"""with_usage as ({oracle.DAILY_USAGE}),
        batch as (select reading_date, region, reading_count * 2 as reading_count from with_usage
          where avg_consumption_kwh > 50)
        select reading_date, region, reading_count from with_usage u where not exists (
          select 1 from batch b where b.reading_date = u.reading_date and b.region = u.region)
        union all select * from batch""",
        "readings",
    ).replace("\nwith_usage as", ", with_usage as"),
)
def upsert_two_keys(spark, sf):
    usage = marts.daily_usage(billable(roles.readings(spark, sf)))
    batch = usage.filter("avg_consumption_kwh > 50").select(
        "reading_date", "region", (F.col("reading_count") * 2).alias("reading_count")
    )
    target = usage.select("reading_date", "region", "reading_count")
    return incremental.upsert(target, batch, ["reading_date", "region"])


@register(
    "column_sync",
    """select c_custkey, c_name, c_mktsegment, cast(null as varchar) as channel from customer
      where c_acctbal >= 0
    union all select c_custkey, c_name, 'CHANGED', 'mail' from customer where c_acctbal < 0
    union all select -c_custkey - 1, c_name, c_mktsegment, 'mail' from customer where c_acctbal > 9000""",
)
def column_sync(spark, sf):
    """A batch without the balance and with a channel: the table follows its columns."""
    batch = customer_batch(spark, sf).drop("c_acctbal").withColumn("channel", F.lit("mail"))
    return incremental.upsert(roles.load(spark, sf, "customer"), batch, "c_custkey")


# --- history -----------------------------------------------------------------------------

FIRST_RUN, SECOND_RUN = datetime(2026, 1, 1), datetime(2026, 2, 1)


def two_snapshots(first: DataFrame, second: DataFrame, history: scd.History) -> DataFrame:
    versions = scd.apply_snapshot(None, first, history, FIRST_RUN)
    return scd.apply_snapshot(versions, second, history, SECOND_RUN)


def customer_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Suspended customers join late, closed ones vanish, one segment is renamed."""
    now = dim_customers(spark, sf)
    renamed = F.when(F.col("customer_segment") == "BUILDING", "BUILDINGS").otherwise(F.col("customer_segment"))
    first = now.filter("account_status <> 'Suspended'")
    second = now.filter("account_status <> 'Closed'").withColumns(
        {"customer_segment": renamed, "registration_date": F.date_add("registration_date", 1)}
    )
    return two_snapshots(first, second, scd.CUSTOMER_HISTORY)


_CUSTOMER_STATES = f"""first_state as (select * from ({_CUSTOMER_DIM}) x where account_status <> 'Suspended'),
second_state as (select * replace (case when customer_segment = 'BUILDING' then 'BUILDINGS'
    else customer_segment end as customer_segment, registration_date + 1 as registration_date)
  from ({_CUSTOMER_DIM}) x where account_status <> 'Closed')"""
_CUSTOMER_SCD_COLUMNS = ", ".join(c for c in scd.CUSTOMER_HISTORY.columns if c not in scd.HIDDEN_COLUMNS)


def with_states(states: str, query: str, *tables: str) -> str:
    return sql(f"@@{states}\n{query}", *tables).replace("\n@@", ",\n")


_CUSTOMER_SCD = oracle.scd(
    "customers",
    _CUSTOMER_SCD_COLUMNS,
    "customer_id",
    "customer_version_sk",
    "b.customer_id is not null and a.customer_segment is distinct from b.customer_segment",
)


@register("scd2_history", with_states(_CUSTOMER_STATES, _CUSTOMER_SCD, "customers"))
def scd2_history(spark, sf):
    return scd.versioned_dimension(customer_versions(spark, sf), scd.CUSTOMER_HISTORY, scd.HIDDEN_COLUMNS)


@register(
    "scd2_current",
    with_states(
        _CUSTOMER_STATES,
        f"select customer_id, customer_segment, valid_from_timestamp from ({_CUSTOMER_SCD}) v "
        "where is_current_record",
        "customers",
    ),
)
def scd2_current(spark, sf):
    shown = scd.versioned_dimension(customer_versions(spark, sf), scd.CUSTOMER_HISTORY)
    return shown.filter("is_current_record").select(
        "customer_id", "customer_segment", "valid_from_timestamp"
    )


@register(
    "scd2_meters",
    with_states(
        f"""first_state as (select * from ({_METER_DIM}) x),
        second_state as (select * replace (false as is_active_meter, 'Disconnected' as meter_status)
          from ({_METER_DIM}) x where not is_active_meter union all
          select * from ({_METER_DIM}) x where is_active_meter)""",
        oracle.scd(
            "meters",
            ", ".join(c for c in scd.METER_HISTORY.columns if c not in scd.HIDDEN_COLUMNS),
            "meter_id",
            "meter_version_sk",
            "b.meter_id is not null and a.meter_status is distinct from b.meter_status",
        ),
        "meters",
        "customers",
        "tariffs",
    ),
)
def scd2_meters(spark, sf):
    now = dim_meters(spark, sf)
    status = F.when(F.col("is_active_meter"), F.col("meter_status")).otherwise("Disconnected")
    versions = two_snapshots(now, now.withColumn("meter_status", status), scd.METER_HISTORY)
    return scd.versioned_dimension(versions, scd.METER_HISTORY, scd.HIDDEN_COLUMNS)


@register(
    "scd2_tariffs",
    with_states(
        f"""first_state as (select * from ({_TARIFF_DIM}) x),
        second_state as (select * replace (effective_start_date + 30 as effective_end_date,
            false as is_current_tariff) from ({_TARIFF_DIM}) x where green_energy_flag
          union all select * from ({_TARIFF_DIM}) x where not green_energy_flag)""",
        oracle.scd(
            "tariffs",
            ", ".join(scd.TARIFF_HISTORY.columns),
            "tariff_id",
            "tariff_version_sk",
            "a.green_energy_flag",
        ),
        "tariffs",
    ),
)
def scd2_tariffs(spark, sf):
    """Every green tariff gets an end date, also where it had another one."""
    now = dim_tariffs(spark, sf)
    green = F.col("green_energy_flag")
    second = now.withColumns(
        {
            "effective_end_date": F.when(green, F.date_add("effective_start_date", 30)).otherwise(
                F.col("effective_end_date")
            ),
            "is_current_tariff": F.when(green, F.lit(False)).otherwise(F.col("is_current_tariff")),
        }
    )
    versions = two_snapshots(now, second, scd.TARIFF_HISTORY)
    return scd.versioned_dimension(versions, scd.TARIFF_HISTORY)


# --- checks ------------------------------------------------------------------------------


@register("check_not_null", judged_sql("row_number", "readings", "meter_id is null"))
def check_not_null(spark, sf):
    typed = standardise(roles.raw_readings(spark, sf), rulesets.READINGS)
    return checks.null_rows(typed, "meter_id").select("row_number")


@register(
    "check_unique",
    """select outage_id, count(*) as n_records from (
      select 'O-' || l_orderkey || '-' || l_linenumber as outage_id from lineitem) l
    group by 1 having count(*) > 1""",
)
def check_unique(spark, sf):
    return checks.repeated_values(roles.outages(spark, sf), "outage_id")


@register(
    "check_accepted",
    sql(
        """select payment_status, count(*) as n_records from cast_billing
        where payment_status not in ('Paid', 'Pending') group by 1""",
        "cast_billing",
    ),
)
def check_accepted(spark, sf):
    typed = standardise(roles.raw_billing(spark, sf), rulesets.BILLING)
    return checks.unaccepted_values(typed, "payment_status", ["Paid", "Pending"])


@register(
    "check_relationships",
    sql(
        """select meter_id, count(*) as n_records from readings
        where meter_id is not null and meter_id not in (select meter_id from meters) group by 1""",
        "readings",
        "meters",
    ),
)
def check_relationships(spark, sf):
    return checks.orphan_values(roles.readings(spark, sf), "meter_id", roles.meters(spark, sf), "meter_id")


@register("check_positive", "select c_custkey, c_acctbal from customer where c_acctbal < 0")
def check_positive(spark, sf):
    found = checks.below_zero(roles.load(spark, sf, "customer"), "c_acctbal")
    return found.select("c_custkey", "c_acctbal")


@register(
    "check_between",
    sql("select reading_id, voltage from readings where voltage < 200 or voltage > 260", "readings"),
)
def check_between(spark, sf):
    return checks.outside_range(roles.readings(spark, sf), "voltage", 200, 260).select("reading_id", "voltage")


def _counted(check: str, table: str, column: str, violations: str) -> str:
    return (
        f"select '{check}' as check_name, '{table}' as table_name, '{column}' as column_name, "
        f"cast(({violations}) as bigint) as violations"
    )


_REPORT = " union all ".join(
    [
        _counted("not_null", "readings", "reading_id", "select count(*) from readings where reading_id is null"),
        _counted("not_null", "readings", "voltage", "select count(*) from readings where voltage is null"),
        _counted(
            "positive_or_zero",
            "readings",
            "consumption_kwh",
            "select count(*) from readings where consumption_kwh < 0",
        ),
        _counted(
            "value_between",
            "readings",
            "voltage",
            "select count(*) from readings where voltage < 200 or voltage > 260",
        ),
        _counted(
            "unique",
            "readings",
            "reading_id",
            "select count(*) from (select 1 from readings group by reading_id having count(*) > 1)",
        ),
        _counted(
            "relationships",
            "readings",
            "meter_id",
            "select count(*) from readings where meter_id not in (select meter_id from meters)",
        ),
        _counted(
            "unique",
            "outages",
            "outage_id",
            "select count(*) from (select 1 from outages group by outage_id having count(*) > 1)",
        ),
        _counted(
            "accepted_values",
            "billing",
            "payment_method",
            "select count(distinct payment_method) from billing where payment_method not in "
            "('Card', 'Prepayment')",
        ),
    ]
)


@register(
    "check_report",
    sql(
        f"select *, case when violations = 0 then 'pass' else 'fail' end as status from ({_REPORT}) r",
        "readings",
        "meters",
        "outages",
        "billing",
    ),
)
def check_report(spark, sf):
    tables = {
        "readings": roles.readings(spark, sf),
        "meters": roles.meters(spark, sf),
        "outages": roles.outages(spark, sf),
        "billing": roles.billing(spark, sf),
    }
    wanted = [
        *checks.key("readings", "reading_id"),
        *checks.not_null("readings", "voltage"),
        *checks.positive("readings", "consumption_kwh"),
        *checks.between("readings", "voltage", 200, 260),
        *checks.refers("readings", "meter_id", "meters"),
        *checks.unique("outages", "outage_id"),
        *checks.accepted("billing", "payment_method", ["Card", "Prepayment"]),
    ]
    return checks.check_report(tables, wanted)


@register(
    "freshness",
    """select *, case when age <= 30 then 'pass' when age <= 90 then 'warn' else 'error' end as status from (
      select *, date_diff('day', max_loaded_at, timestamp '2024-03-15 00:00:00') as age from (
        select 'events' as table_name, date_trunc('day', max(ts)) as max_loaded_at from events
        union all select 'orders', cast(max(o_orderdate) as timestamp) from orders) t) u""".replace(
        "select *, case", "select table_name, max_loaded_at, case"
    ),
)
def freshness(spark, sf):
    tables = {
        "events": roles.load(spark, sf, "events").select(F.date_trunc("day", "ts").alias("loaded")),
        "orders": roles.load(spark, sf, "orders").select(F.col("o_orderdate").alias("loaded")),
    }
    return checks.freshness(tables, "loaded", datetime(2024, 3, 15))


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@register(
    "table_counts",
    " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES),
)
def table_counts(spark, sf):
    return checks.table_counts({t: roles.load(spark, sf, t) for t in TABLES})


# --- files -------------------------------------------------------------------------------

DRIFT_COLUMNS = ("firmware_version", "signal_strength_dbm")
_DRIFT_DAY = date(2024, 1, 16)
EVENT_FILES = Source("events", "*/reading_date=*/*.csv", INCREMENTAL, "event_id", drifting=True)


def daily_files(spark: SparkSession, sf: str, reordered: bool = False) -> str:
    """The events as daily CSV files; two columns appear in the middle from a later day on.

    The files are derived by Spark from the events and written below a new shared folder,
    which is returned. ``reordered`` turns the columns of the later files around.
    """
    base = shared_folder(spark, "daily-files")
    folder = f"{base}/{EVENT_FILES.name}"
    events = roles.load(spark, sf, "events").select(
        "event_id",
        F.col("ts").cast("date").alias("reading_date"),
        "user_id",
        identifier_of("FW_", 3).alias("firmware_version"),
        (-70 - F.col("event_id") % 16).alias("signal_strength_dbm"),
        "event_type",
    )
    named = source_metadata(events, "reading_date", "meter_readings", "meters", AS_OF)
    early = named.filter(F.col("reading_date") < F.lit(_DRIFT_DAY)).drop(*DRIFT_COLUMNS)
    write_daily_csv(early, f"{folder}/early", "reading_date")
    late = named.filter(F.col("reading_date") >= F.lit(_DRIFT_DAY))
    late = late.select(*reversed(late.columns)) if reordered else late
    write_daily_csv(late, f"{folder}/late", "reading_date")
    return base


def identifier_of(prefix: str, parts: int):
    return F.concat(F.lit(prefix), (F.col("event_id") % parts).cast("string"))


@register(
    "drift_union",
    """select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id, event_type,
      case when cast(ts as date) >= date '2024-01-16' then 'FW_' || (event_id % 3) end as firmware_version,
      case when cast(ts as date) >= date '2024-01-16' then cast(-70 - event_id % 16 as varchar) end
        as signal_strength_dbm,
      'meter_readings_' || strftime(ts, '%Y%m%d') || '.csv' as source_file_name,
      cast(cast(ts as date) as varchar) as reading_date from events""",
)
def drift_union(spark, sf):
    rows = EVENT_FILES.read(spark, EVENT_FILES.path(daily_files(spark, sf)))
    return rows.select(
        "event_id",
        "user_id",
        "event_type",
        "firmware_version",
        "signal_strength_dbm",
        "source_file_name",
        "reading_date",
    )


@register("drift_reordered", ORACLE["drift_union"])
def drift_reordered(spark, sf):
    """The same rows from files of which some name their columns in another order."""
    rows = EVENT_FILES.read(spark, EVENT_FILES.path(daily_files(spark, sf, reordered=True)))
    return rows.select(
        "event_id",
        "user_id",
        "event_type",
        "firmware_version",
        "signal_strength_dbm",
        "source_file_name",
        "reading_date",
    )


@register(
    "corrupt_lines",
    """select cast(event_id as varchar) as event_id, case when event_id % 10 <> 0 then event_type end as event_type,
      case when event_id % 10 = 0 then cast(event_id as varchar) || ',' || user_id end as corrupt from events""",
)
def corrupt_lines(spark, sf):
    """Every tenth line lacks a field; the reader keeps its text."""
    folder = f"{shared_folder(spark, 'ragged-files')}/events"
    number, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    line = F.when(F.col("event_id") % 10 == 0, F.concat_ws(",", number, user)).otherwise(
        F.concat_ws(",", number, user, "event_type")
    )
    lines = roles.load(spark, sf, "events").select(line.alias("event_id,user_id,event_type"))
    lines.write.option("header", True).option("sep", "\t").csv(f"{folder}/day=1")
    source = Source("events", "day=*/*.csv", INCREMENTAL, "event_id")
    rows = source.read(spark, source.path(folder.rsplit("/", 1)[0]), corrupt_column="corrupt")
    return rows.select("event_id", "event_type", "corrupt")


@register(
    "file_manifest",
    """select 'meter_readings' as source_name, cast(day as varchar) as event_date,
      cast(count(*) as bigint) as record_count, day >= date '2024-01-16' as schema_drift_applied,
      cast(case when day >= date '2024-01-16' then 8 else 6 end as bigint) as column_count,
      case when day >= date '2024-01-16'
        then 'event_id|user_id|firmware_version|signal_strength_dbm|event_type|'
          || 'source_file_name|source_system|generated_at_utc'
        else 'event_id|user_id|event_type|source_file_name|source_system|generated_at_utc' end as columns
    from (select cast(ts as date) as day from events) e group by day""",
)
def manifest(spark, sf):
    """One row per file, summed per day because Spark may split a day over several files."""
    files = file_manifest(
        spark, EVENT_FILES.path(daily_files(spark, sf)), "meter_readings", "event_id", DRIFT_COLUMNS
    )
    return files.groupBy("source_name", "event_date", "schema_drift_applied", "columns").agg(
        F.sum("record_count").cast("bigint").alias("record_count"),
        F.max("column_count").cast("bigint").alias("column_count"),
    )


@register(
    "schema_drift_profile",
    """with days as (
      select count(*) > 0 as any_day, count(*) filter (where cast(ts as date) >= date '2024-01-16') > 0 as late_day
      from events)
    select 'event_type' as column_name, any_day as is_present from days
    union all select 'firmware_version', late_day from days
    union all select 'signal_strength_dbm', late_day from days
    union all select 'meter_reading_quality_code', false from days""",
)
def schema_drift(spark, sf):
    rows = EVENT_FILES.read(spark, EVENT_FILES.path(daily_files(spark, sf)))
    return drift_profile(rows, ["event_type", *DRIFT_COLUMNS, "meter_reading_quality_code"])


@register(
    "union_by_name",
    """select c_custkey as id, c_name as name, c_acctbal as balance, null::varchar as brand from customer
    union all select s_suppkey, s_name, s_acctbal, null from supplier
    union all select p_partkey, p_name, null, p_brand from part""",
)
def named_union(spark, sf):
    customer = roles.load(spark, sf, "customer").selectExpr(
        "c_custkey as id", "c_name as name", "c_acctbal as balance"
    )
    supplier = roles.load(spark, sf, "supplier").selectExpr(
        "s_acctbal as balance", "s_suppkey as id", "s_name as name"
    )
    part = roles.load(spark, sf, "part").selectExpr("p_partkey as id", "p_name as name", "p_brand as brand")
    return union_by_name([customer, supplier, part])


# --- saved tables ------------------------------------------------------------------------


def scratch_schema(spark: SparkSession) -> str:
    """A new schema whose tables lie in the shared folder."""
    name = f"scratch_{uuid.uuid4().hex}"
    create_schemas(spark, name, location=shared_folder(spark, "tables"))
    return name


@register(
    "partition_upsert",
    """select o_orderkey, o_custkey, o_orderstatus, cast(date_trunc('month', o_orderdate) as date) as month
      from orders where o_orderstatus <> 'P'
    union all select o_orderkey, o_custkey, 'F', cast(date_trunc('month', o_orderdate) as date) + 3
      from orders where o_orderstatus = 'P'
    union all select -o_orderkey - 1, o_custkey, o_orderstatus, cast(date_trunc('month', o_orderdate) as date)
      from orders where o_orderpriority = '1-URGENT'""",
)
def partition_upsert(spark, sf):
    """Orders saved by month; open ones close and move to another partition, urgent ones get a twin."""
    table = f"{scratch_schema(spark)}.orders_by_month"
    orders = roles.load(spark, sf, "orders")
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")
    saved = orders.select("o_orderkey", "o_custkey", "o_orderstatus", month)
    closed = saved.filter("o_orderstatus = 'P'").withColumns(
        {"o_orderstatus": F.lit("F"), "month": F.date_add("month", 3)}
    )
    twins = orders.filter("o_orderpriority = '1-URGENT'").select(
        (-F.col("o_orderkey") - 1).alias("o_orderkey"), "o_custkey", "o_orderstatus", month
    )
    replace_partitions(spark, table, saved, "o_orderkey", "month")
    replace_partitions(spark, table, closed.unionByName(twins), "o_orderkey", "month")
    return spark.table(table)


@register(
    "widened_append",
    """select c_custkey, c_name, null::varchar as channel from customer
    union all select -c_custkey - 1, null, 'mail' from customer""",
)
def widened_append(spark, sf):
    """Two loads of one table; the second lacks a column and brings another."""
    table = f"{scratch_schema(spark)}.customers"
    first = roles.load(spark, sf, "customer").select("c_custkey", "c_name")
    land_table(first, table, INCREMENTAL)
    second = first.select((-F.col("c_custkey") - 1).alias("c_custkey"), F.lit("mail").alias("channel"))
    land_table(second, table, INCREMENTAL)
    return spark.table(table)


@register(
    "published_rebuild",
    "select p_partkey, p_brand, p_retailprice * 2 as p_retailprice from part",
)
def published_rebuild(spark, sf):
    """A published table rebuilt from its own rows."""
    name = f"{scratch_schema(spark)}.parts"
    publish(roles.load(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice"), name, "run-1")
    doubled = spark.table(name).withColumn("p_retailprice", F.col("p_retailprice") * 2)
    publish(doubled, name, "run-2")
    return spark.table(name)


@register(
    "validation_audit",
    sql(
        f"""select 'SUCCESS' as status, count(*) as bronze_records,
          count(*) filter (where not {oracle.faulty('readings', False)}) as clean_records,
          count(*) filter (where {oracle.faulty('readings', False)}) as quarantined_records,
          count(*) filter (where is_duplicate_reading) as duplicate_records, '' as error_message,
          'test' as environment from judged_readings""",
        "judged_readings",
    ),
)
def validation_audit(spark, sf):
    """The audit row of a validation run from a saved landing table to published tables."""
    schema = scratch_schema(spark)
    create_audit_tables(spark, schema)
    land_table(roles.raw_readings(spark, sf).drop("row_number"), f"{schema}.meter_readings_raw", FULL)
    validate_source(spark, rulesets.READINGS, schema, schema, schema, RUN)
    return audit_of_run(spark.table(f"{schema}.{VALIDATION_AUDIT}"), RUN.run_id).select(
        "status",
        "bronze_records",
        "clean_records",
        "quarantined_records",
        "duplicate_records",
        "error_message",
        "environment",
    )


@register(
    "unseen_files",
    """select distinct cast(cast(ts as date) as varchar) as event_date from events
    where cast(ts as date) >= date '2024-01-16'""",
)
def new_files(spark, sf):
    """Days whose files are not in the record of earlier loads."""
    files = list_files(spark, EVENT_FILES.path(daily_files(spark, sf)))
    recorded = files.filter(F.col("file_path").contains("/early/"))
    day = F.regexp_extract("file_path", "reading_date=([^/]+)/", 1).alias("event_date")
    return unseen_files(files, recorded).select(day).distinct()


@register(
    "landing_audit",
    """select 'run-0' as run_id, 'events' as source_name, 'incremental' as load_type, 'SUCCESS' as status, count(*) as records_loaded from events
    union all select 'run-1', 'nothing', 'full', 'FAILED', 0
    union all select 'run-2', 'events', 'incremental', 'SUCCESS', 0
    union all select 'run-3', 'events', 'incremental', 'SUCCESS', count(*) from events where cast(ts as date) = (select max(cast(ts as date)) from events)""",
)
def landing_audit(spark, sf):
    """Four landing runs: all files, a source without files, nothing new, and a day that is delivered once more."""
    schema, raw_base = scratch_schema(spark), daily_files(spark, sf)
    create_audit_tables(spark, schema)
    create_table(spark, f"{schema}.{FILE_LOG}", FILE_LOG_COLUMNS)
    missing = Source("nothing", "*.csv", FULL, "event_id")
    for number, source in enumerate((EVENT_FILES, missing, EVENT_FILES, EVENT_FILES)):
        if number == 3:
            events = roles.load(spark, sf, "events")
            newest = events.agg(F.max(F.col("ts").cast("date"))).first()[0]
            again = events.where(F.col("ts").cast("date") == F.lit(newest)).select("event_id", F.col("ts").cast("date").alias("reading_date"), "user_id")
            again = source_metadata(again, "reading_date", "meter_readings", "meters", AS_OF)
            write_daily_csv(again, f"{raw_base}/{EVENT_FILES.name}/again", "reading_date")
        try:
            land_source(spark, source, raw_base, schema, schema, Build(f"run-{number}", AS_OF, "test"))
        except (NoFilesFound, AnalysisException):
            if source is not missing:
                raise
    return spark.table(f"{schema}.{LANDING_AUDIT}").select("run_id", "source_name", "load_type", "status", "records_loaded")


@register(
    "reingested_rows",
    sql(
        """select load, count(*) as row_count, case load when 1 then count(reading_id)
          else count(reading_id) - count(distinct reading_id) end as duplicates from readings cross join (values (1), (2)) l(load) group by load""",
        "readings",
    ),
)
def reingested_rows(spark, sf):
    """Readings that are landed twice: the next judgement keeps the newest copy of each and flags the others."""
    schema = scratch_schema(spark)
    create_audit_tables(spark, schema)
    rows = roles.readings(spark, sf)
    rows = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns if not c.startswith("_") and c != "silver_processed_at_utc"])
    for load in (1, 2):
        stamped = rows.withColumn("_ingested_at_utc", F.lit(f"2026-01-0{load} 00:00:00")).withColumn("load", F.lit(load))
        land_table(stamped, f"{schema}.meter_readings_raw", INCREMENTAL)
        validate_new_rows(spark, rulesets.READINGS, schema, schema, schema, Build(f"run-{load}", AS_OF, "test"))
    judged = spark.table(f"{schema}.meter_readings_verdicts")
    return judged.groupBy("load").agg(F.count(F.lit(1)).alias("row_count"), F.count_if(rulesets.READINGS.duplicate_flag).alias("duplicates"))


@register(
    "empty_source",
    """select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id, event_type from events
    where cast(ts as date) < date '2024-01-16'""",
)
def empty_source(spark, sf):
    """The daily files of two deliveries, of which one has none yet."""
    base = daily_files(spark, sf)
    columns = ("event_id", "user_id", "event_type")
    deliveries = [read_daily_files(spark, base, f"{EVENT_FILES.name}/{part}/reading_date=*/*.csv", columns, drifting=True) for part in ("early", "next")]
    return union_by_name(deliveries).select(*columns)


# --- streams -----------------------------------------------------------------------------


@register(
    "stream_file_ingest",
    """select cast(event_id as varchar) as event_id, event_type,
      case when cast(ts as date) >= date '2024-01-16' then 'FW_' || (event_id % 3) end as firmware_version,
      'meter_readings_' || strftime(ts, '%Y%m%d') || '.csv' as _source_file_path,
      'events' as _source_name, 'run-1' as _run_id from events""",
)
def stream_file_ingest(spark, sf):
    """Daily files ingested by a stream in two calls; the second finds nothing new."""
    raw_base, folder = daily_files(spark, sf), shared_folder(spark, "file-ingest")
    for _ in range(2):
        ingest_new_files(spark, EVENT_FILES, raw_base, f"{folder}/out", f"{folder}/checkpoint", RUN)
    return read_ingested(spark, f"{folder}/out").select(
        "event_id", "event_type", "firmware_version", "_source_file_path", "_source_name", "_run_id"
    )


def usage_readings(spark, sf, events):
    return roles.with_region(spark, sf, events, "user_id").select(
        F.concat(F.lit("R"), F.col("event_id").cast("string")).alias("reading_id"),
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("meter_id"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("customer_id"),
        F.col("ts").cast("timestamp").alias("reading_timestamp"),
        F.col("value").alias("consumption_kwh"),
        F.when(F.col("event_id") % 97 != 0, 196 + F.col("event_id") % 67).cast("double").alias("voltage"),
        "region",
        (F.col("event_id") % 100 == 0).alias("is_late_arriving"),
    )


@register("stream_daily_usage", sql(oracle.DAILY_USAGE.replace(" where consumption_kwh between 0 and 100", ""), "readings"))
def stream_daily_usage(spark, sf):
    """Usage of every day, the open ones included, after the stream has read all."""
    folder = shared_folder(spark, "usage-stream")
    schema = roles.load(spark, sf, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet")
    run_usage_stream(usage_readings(spark, sf, events), f"{folder}/out", f"{folder}/checkpoint")
    return streamed_daily_usage(spark, f"{folder}/out")


@register(
    "stream_rows_behind",
    """with landed as (select *, event_id % 3 as landing from events),
    marks as (select 1 as landing, max(ts) - interval 120 hour as mark from landed where landing = 0
      union all select 2, max(ts) - interval 120 hour from landed where landing <= 1)
    select cast(l.ts as date) as reading_date,
      count_if(m.mark is null or l.ts >= m.mark) as accepted, count_if(l.ts < m.mark) as behind
    from landed l left join marks m on l.landing = m.landing group by cast(l.ts as date)""",
)
def stream_rows_behind(spark, sf):
    """Readings that arrive in three portions with every sixth row sent twice: what each day accepted, and what came too late for it."""
    folder = shared_folder(spark, "usage-stream")
    readings = usage_readings(spark, sf, roles.load(spark, sf, "events"))
    number = F.substring("reading_id", 2, 20).cast("long")
    tables = [f"{folder}/{part}" for part in ("in", "out", "checkpoint")]
    for landing in range(3):
        again = readings.where((number % 6 == 0) & (number % 3 == landing))
        readings.where(number % 3 == landing).unionByName(again).write.mode("append").parquet(tables[0])
        stream = spark.readStream.schema(readings.schema).parquet(tables[0])
        run_usage_stream(stream, *tables[1:])
    accepted = streamed_daily_usage(spark, tables[1]).groupBy("reading_date").agg(F.sum("reading_count").alias("accepted"))
    behind = rows_behind(spark, tables[1], readings.schema)
    late = behind.dropDuplicates(["reading_id"]).groupBy(F.col("reading_timestamp").cast("date").alias("reading_date"))
    zero = F.lit(0).cast("long")
    return accepted.join(late.agg(F.count(F.lit(1)).alias("behind")), "reading_date", "full").select(
        "reading_date", F.coalesce("accepted", zero).alias("accepted"), F.coalesce("behind", zero).alias("behind")
    )



def _portion(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n))


@register(
    "growth_equals_full",
    sql(f"select row_number, billing_event_id, {oracle.reason('billing')} as quarantine_reason, {oracle.faulty('billing', True)} as quarantined from judged_billing", "judged_billing"),
)
def growth_equals_full(spark, sf):
    """Bills judged in three loads while customers and tariffs come and go: the verdicts are those of one full run at the end."""
    schema = scratch_schema(spark)
    create_audit_tables(spark, schema)
    # Bills spread thinly over years are kept by month.
    rules = replace(rulesets.BILLING, day="billing_month", casts={**rulesets.BILLING.casts, "billing_month": "date"})
    bills = roles.raw_billing(spark, sf).withColumn("billing_month", F.concat(F.substring("billing_date", 1, 7), F.lit("-01")))
    bills = bills.withColumn("row_number", F.col("row_number").cast("string"))
    customers = roles.customers(spark, sf).select("customer_id")
    tariffs = roles.tariffs(spark, sf).select("tariff_id")
    gone = customers.select(F.concat(F.lit("X"), F.expr("cast(monotonically_increasing_id() * 13 as string)")).alias("customer_id"))
    loads = (
        (customers.filter(_portion("customer_id", 3) != 0), tariffs.limit(0)),
        (customers.filter(_portion("customer_id", 3) != 1).unionByName(gone), tariffs),
        (customers, tariffs),
    )
    for number, (owners, rates) in enumerate(loads):
        run = Build(f"run-{number}", AS_OF, "test")
        publish(owners, f"{schema}.customers_clean", run.run_id)
        publish(rates, f"{schema}.tariffs_clean", run.run_id)
        land_table(bills.filter(_portion("row_number", 3) == number), f"{schema}.billing_events_raw", INCREMENTAL)
        validate_new_rows(spark, rules, schema, schema, schema, run)
    judged = spark.table(f"{schema}.billing_events_verdicts")
    return judged.select(
        F.col("row_number").cast("long"), "billing_event_id", "quarantine_reason", (F.col("verdict") == "quarantine").alias("quarantined")
    )


_UNSTAMPED = "select * exclude (dbt_loaded_at, dbt_invocation_id) from ({}) f"


def _unstamped(df: DataFrame) -> DataFrame:
    return df.drop(*LOAD_AUDIT)


@register("fact_late_dimension", _UNSTAMPED.format(ORACLE["fact_readings"]))
def fact_late_dimension(spark, sf):
    """Readings land in two runs. In the first, meters, their owners and the second half of the calendar are incomplete."""
    schema = scratch_schema(spark)
    regions, dates = region_and_date(spark, sf)
    readings = staged_role(spark, sf, "readings")
    half = _portion("reading_id", 2)
    owners, tariffs = dim_customers(spark, sf), dim_tariffs(spark, sf)
    meters = staged_role(spark, sf, "meters")
    runs = (
        (readings.filter(half == 0), meters.filter(_portion("meter_id", 5) != 0), owners.filter(_portion("customer_id", 3) != 0), 0),
        (readings.filter(half == 1), meters, owners, 1),
    )
    for fresh, known, customers, whole in runs:
        days = dates.filter(F.lit(whole == 1) | (_portion("date_sk", 2) == 0))
        run = Build(f"run-{whole}", AS_OF, "test")
        dims = {"dim_meters": dimensions.dim_meters(known, customers, tariffs, run), "dim_regions": regions, "dim_date": days}
        shape = partial(facts.fact_meter_readings, meters=dims["dim_meters"], regions=regions, dates=days, run=run)
        growth.grow_fact(spark, schema, growth.READINGS, fresh, shape, dims, run)
    return _unstamped(spark.table(f"{schema}.{growth.READINGS.name}"))


@register("fact_billing_late_dimension", _UNSTAMPED.format(ORACLE["fact_billing"]))
def fact_billing_late_dimension(spark, sf):
    """Bills land in two runs; customers, tariffs and regions come complete with the second only."""
    schema = scratch_schema(spark)
    regions, dates = region_and_date(spark, sf)
    bills, customers, tariffs = staged_role(spark, sf, "billing"), dim_customers(spark, sf), dim_tariffs(spark, sf)
    half = _portion("billing_event_id", 2)
    # Bills spread thinly over years are kept by month.
    by_month = replace(growth.BILLING, day="billing_month")
    month = F.trunc("billing_date", "month").alias("billing_month")
    runs = (
        (bills.filter(half == 0), customers.filter(_portion("customer_id", 2) == 0), tariffs.limit(0), regions.filter("region < 'B'")),
        (bills.filter(half == 1), customers, tariffs, regions),
    )
    for number, (fresh, owners, rates, places) in enumerate(runs):
        run = Build(f"run-{number}", AS_OF, "test")
        dims = {"dim_customers": owners, "dim_tariffs": rates, "dim_regions": places, "dim_date": dates}
        keyed = partial(facts.fact_billing_events, customers=owners, tariffs=rates, regions=places, dates=dates, run=run)
        growth.grow_fact(spark, schema, by_month, fresh, lambda rows, keyed=keyed: keyed(rows).select("*", month), dims, run)
    return _unstamped(spark.table(f"{schema}.{growth.BILLING.name}")).drop("billing_month")


@register("daily_mart_incremental", ORACLE["daily_energy_summary"])
def daily_mart_incremental(spark, sf):
    """The daily report over three runs: most readings, late readings of all days, then the bills. Only changed days are rebuilt."""
    schema, report = scratch_schema(spark), "mart_daily_energy_summary"
    readings = billable(roles.readings(spark, sf))
    bills, weather = roles.billing(spark, sf), roles.weather(spark, sf)
    late = _portion("reading_id", 7) == 0
    save_table(bills.limit(0), f"{schema}.bills")
    for number, rows in enumerate((readings.filter(~late), readings.filter(late), None)):
        run = Build(f"run-{number}", AS_OF, "test")
        if rows is None:
            save_table(bills, f"{schema}.bills")
            billed_days = {row[0] for row in bills.select("billing_date").distinct().collect()}
            growth.log_changes(spark, schema, "bills", billed_days, run)
        else:
            changed = replace_partitions(spark, f"{schema}.usage", rows, "reading_id", "reading_date")
            growth.log_changes(spark, schema, "usage", changed, run)
        days, runs = growth.days_to_build(spark, schema, report, ("usage", "bills"))
        usage = spark.table(f"{schema}.usage").filter(in_partitions("reading_date", days))
        billed = spark.table(f"{schema}.bills").filter(in_partitions("billing_date", days))
        growth.rebuild_days(spark, schema, report, "reading_date", days, runs, marts.daily_energy_summary(usage, weather, billed))
    return spark.table(f"{schema}.{report}")
