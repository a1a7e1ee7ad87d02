"""The registered queries once more, in plain SQL over the same tables."""

from __future__ import annotations

AS_OF = "timestamp '2026-01-01 00:00:00'"

_LINEAGE = f""" '{{file}}' as source_file_name, 'star' as source_system,
  {AS_OF} as generated_at_utc, '{{file}}' as _source_file_path, 'run-1' as _run_id,
  'test' as _environment, {AS_OF} as silver_processed_at_utc """


def _lineage(file: str) -> str:
    return _LINEAGE.replace("{file}", file)


# Domain tables, each as one common table expression with those it needs.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "places": (
        (),
        "select n_nationkey, n_name, r_name as region from nation join region on n_regionkey = r_regionkey",
    ),
    "homes": (
        ("places",),
        "select c_custkey, region from customer left join places on c_nationkey = n_nationkey",
    ),
    "readings": (
        ("homes",),
        f"""select 'R' || event_id as reading_id, 'M' || user_id as meter_id, 'C' || user_id as customer_id,
          ts as reading_timestamp, cast(ts as date) as reading_date, value as consumption_kwh,
          case when event_id % 97 = 0 then null else cast(196 + event_id % 67 as double) end as voltage,
          event_type as reading_source, 'Active' as meter_status, region,
          event_id % 100 = 0 as is_late_arriving,
          case when event_id % 100 = 0 then cast(24 + event_id % 96 as double) end as ingestion_delay_hours,
          false as data_quality_issue_injected, 'FW_' || (event_id % 3) as firmware_version,
          cast(-70 - event_id % 16 as double) as signal_strength_dbm,
          upper(event_type) as meter_reading_quality_code, {_lineage('readings.csv')}
        from events left join homes on user_id = c_custkey""",
    ),
    "customers": (
        ("places",),
        f"""select 'C' || c_custkey as customer_id, c_name as customer_name,
          lower(replace(c_name, '#', '.')) || '@example.com' as email, '0' || c_custkey as phone_number,
          'P' || c_nationkey as postcode, region, c_mktsegment as customer_segment, n_name as property_type,
          case when c_acctbal < 0 then 'Suspended' when c_acctbal > 9000 then 'Closed' else 'Active' end
            as account_status,
          date '2020-01-01' + cast(c_custkey % 1000 as int) as registration_date, {_lineage('customers.csv')}
        from customer left join places on c_nationkey = n_nationkey""",
    ),
    "tariffs": (
        (),
        f"""select 'T' || p_partkey as tariff_id, p_name as tariff_name,
          cast(p_size + 0.5 as double) as standing_charge_pence_per_day,
          p_retailprice as unit_rate_pence_per_kwh, p_size % 2 = 0 as green_energy_flag,
          date '2025-01-01' + p_size as effective_start_date,
          case when p_partkey % 5 = 0 then date '2025-01-01' + p_size + 90 end as effective_end_date,
          {_lineage('tariffs.csv')}
        from part""",
    ),
    "meters": (
        ("homes",),
        f"""select 'M' || s_suppkey as meter_id, 'C' || s_suppkey as customer_id,
          'T' || (s_suppkey % 7) as tariff_id, region,
          case when s_suppkey % 2 = 0 then 'SMETS1' else 'SMETS2' end as meter_type,
          case when s_acctbal < 0 then 'Faulty' else 'Active' end as meter_status,
          date '2024-01-01' + cast(s_suppkey % 365 as int) as installation_date, {_lineage('meters.csv')}
        from supplier left join homes on s_suppkey = c_custkey""",
    ),
    "billing": (
        ("homes",),
        f"""select 'B' || o_orderkey as billing_event_id, 'C' || o_custkey as customer_id,
          'T' || o_custkey as tariff_id, region, day as billing_date, day as billing_period_start,
          day as billing_period_end, (o_orderkey % 500) / 8.0::double as total_consumption_kwh,
          0.5::double as standing_charge_amount, o_totalprice as energy_charge_amount,
          0.25::double as vat_amount, o_totalprice as total_amount, status as payment_status,
          case o_orderpriority when '1-URGENT' then 'Card' when '2-HIGH' then 'Bank Transfer'
            when '3-MEDIUM' then 'Prepayment' else 'Direct Debit' end as payment_method,
          day + 14 as due_date,
          case when status = 'Paid' then day + cast(o_orderkey % 10 as int) end as paid_at,
          false as billing_quality_issue_injected, {_lineage('billing.csv')}
        from (select *, cast(o_orderdate as date) + 9861 as day,
                case o_orderstatus when 'F' then 'Paid' when 'O' then 'Pending' else 'Overdue' end as status
              from orders) o
        left join homes on o_custkey = c_custkey""",
    ),
    "weather": (
        ("homes",),
        f"""select 'W-' || weather_date || '-' || region as weather_id, weather_date, region,
          mean as avg_temperature_c, mean - 3 as min_temperature_c, mean + 4 as max_temperature_c,
          cast(n % 101 as double) as humidity_percent, cast(n % 41 as double) as wind_speed_mph,
          ['Clear', 'Cloudy', 'Rain', 'Heavy Rain', 'Snow', 'Fog', 'Windy'][cast(n % 7 + 1 as int)]
            as weather_condition,
          cast(round(cast(greatest(0, 15.5 - mean) as decimal(18, 6)), 2) as double) as heating_degree_days,
          cast(round(cast(greatest(0, mean - 22) as decimal(18, 6)), 2) as double) as cooling_degree_days,
          {_lineage('weather.csv')}
        from (select *, (n % 320 - 60) / 8.0::double as mean from (
                select cast(o_orderdate as date) + 9861 as weather_date, region,
                  cast(sum(o_orderkey % 97) as bigint) as n
                from orders left join homes on o_custkey = c_custkey group by 1, 2) s) t""",
    ),
    "numbered_outages": (
        ("places",),
        f"""select 'O-' || l_orderkey || '-' || l_linenumber as outage_id, region,
          ['Planned Maintenance', 'Network Fault', 'Storm Damage', 'Equipment Failure']
            [cast(l_linenumber % 4 + 1 as int)] as outage_type,
          case l_returnflag when 'A' then 'Low' when 'N' then 'Medium' else 'High' end as severity,
          cast(l_shipdate as timestamp) as outage_start_timestamp,
          cast(l_shipdate as timestamp) + to_minutes(cast(l_quantity * 30 as bigint)) as outage_end_timestamp,
          l_quantity * 30 as duration_minutes, l_partkey as affected_customers,
          l_linestatus = 'F' as resolved_flag,
          cast((l_partkey * 100000 + l_suppkey) * 100 + l_quantity as bigint) as n, {_lineage('outages.csv')}
        from lineitem join supplier on l_suppkey = s_suppkey left join places on s_nationkey = n_nationkey""",
    ),
    "outages": (("numbered_outages",), "select * exclude (n) from numbered_outages"),
    # The raw tables: the same rows as text with faults placed by key arithmetic, then trimmed
    # and cast as the rules expect them.
    "cast_readings": (
        ("readings",),
        """select n as row_number, trim(case when n % 401 = 0 then '' when n % 50 = 49 then 'R' || (n - 1)
            else '  ' || reading_id || ' ' end) as reading_id,
          case when n % 211 = 0 then null else meter_id end as meter_id,
          trim(case when n % 307 = 0 then ' ' else customer_id end) as customer_id,
          case when n % 503 = 0 then null when n % 997 = 0 then timestamp '2030-01-01 00:00:00'
            else date_trunc('second', reading_timestamp) end as reading_timestamp,
          reading_date,
          case when n % 499 = 0 then null when n % 199 = 0 then -consumption_kwh else consumption_kwh end
            as consumption_kwh,
          voltage, region, reading_source,
          timestamp '2025-02-01 00:00:00' + to_hours(cast(n * 7 % 5 as int)) as loaded
        from (select *, cast(substr(reading_id, 2) as bigint) as n from readings) r""",
    ),
    "judged_readings": (
        ("cast_readings",),
        f"""select *, reading_id is null or reading_id = '' as is_missing_reading_id,
          customer_id is null or customer_id = '' as is_missing_customer_id,
          meter_id is null or meter_id = '' as is_missing_meter_id,
          reading_timestamp is null as is_missing_reading_timestamp,
          consumption_kwh is null as is_missing_consumption,
          consumption_kwh < 0 as is_negative_consumption, consumption_kwh > 100 as is_consumption_outlier,
          reading_timestamp > {AS_OF} as is_future_timestamp,
          voltage < 200 or voltage > 260 as is_invalid_voltage,
          reading_id is not null and row_number() over (partition by reading_id
            order by loaded desc nulls last, row_number) > 1 as is_duplicate_reading
        from cast_readings""",
    ),
    "cast_customers": (
        ("customers",),
        """select n as row_number, case when n % 59 = 58 then 'C' || (n - 1) else customer_id end as customer_id,
          case when n % 61 = 0 then '' else customer_name end as customer_name,
          case when n % 37 = 0 then 'no-at-sign' when n % 43 = 0 then null else email end as email,
          case when n % 53 = 0 then null else region end as region,
          case when n % 41 = 0 then 'Unknown' when n % 71 = 0 then null else account_status end as account_status,
          case when n % 47 = 0 then null else registration_date end as registration_date,
          timestamp '2025-02-01 00:00:00' + to_hours(cast(n * 7 % 5 as int)) as loaded
        from (select *, cast(substr(customer_id, 2) as bigint) as n from customers) c""",
    ),
    "judged_customers": (
        ("cast_customers",),
        r"""select *, customer_id is null or customer_id = '' as is_missing_customer_id,
          customer_name is null or customer_name = '' as is_missing_customer_name,
          not regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$') as is_invalid_email,
          region is null or region = '' as is_missing_region,
          account_status not in ('Active', 'Suspended', 'Closed') as is_invalid_account_status,
          registration_date is null as is_missing_registration_date,
          customer_id is not null and row_number() over (partition by customer_id
            order by loaded desc nulls last, row_number) > 1 as is_duplicate_customer_id
        from cast_customers""",
    ),
    "cast_tariffs": (
        ("tariffs",),
        """select n as row_number, case when n % 59 = 58 then 'T' || (n - 1) else tariff_id end as tariff_id,
          case when n % 61 = 0 then null else tariff_name end as tariff_name,
          case when n % 37 = 0 then -1.5 when n % 43 = 0 then null else standing_charge_pence_per_day end
            as standing_charge_pence_per_day,
          case when n % 41 = 0 then 0 else unit_rate_pence_per_kwh end as unit_rate_pence_per_kwh,
          case when n % 53 = 0 then null else green_energy_flag end as green_energy_flag,
          case when n % 47 = 0 then null else effective_start_date end as effective_start_date,
          case when n % 35 = 0 then date '2024-12-31' else effective_end_date end as effective_end_date,
          timestamp '2025-02-01 00:00:00' + to_hours(cast(n * 7 % 5 as int)) as loaded
        from (select *, cast(substr(tariff_id, 2) as bigint) as n from tariffs) t""",
    ),
    "judged_tariffs": (
        ("cast_tariffs",),
        """select *, tariff_id is null or tariff_id = '' as is_missing_tariff_id,
          tariff_name is null or tariff_name = '' as is_missing_tariff_name,
          standing_charge_pence_per_day is null or standing_charge_pence_per_day < 0
            as is_invalid_standing_charge,
          unit_rate_pence_per_kwh is null or unit_rate_pence_per_kwh <= 0 as is_invalid_unit_rate,
          effective_start_date is null as is_missing_effective_start_date,
          effective_end_date is not null and effective_end_date < effective_start_date
            as is_invalid_effective_date_range,
          tariff_id is not null and row_number() over (partition by tariff_id
            order by loaded desc nulls last, row_number) > 1 as is_duplicate_tariff_id
        from cast_tariffs""",
    ),
    "cast_meters": (
        ("meters",),
        """select n as row_number, case when n % 19 = 18 then 'M' || (n - 1) else meter_id end as meter_id,
          case when n % 13 = 0 then 'X' || n when n % 17 = 0 then null else customer_id end as customer_id,
          case when n % 23 = 0 then 'X' || n when n % 29 = 0 then '' else tariff_id end as tariff_id,
          case when n % 31 = 0 then 'ANALOGUE' when n % 37 = 0 then null else meter_type end as meter_type,
          case when n % 41 = 0 then 'Lost' else meter_status end as meter_status,
          case when n % 43 = 0 then null else installation_date end as installation_date,
          timestamp '2025-02-01 00:00:00' + to_hours(cast(n * 7 % 5 as int)) as loaded
        from (select *, cast(substr(meter_id, 2) as bigint) as n from meters) m""",
    ),
    "judged_meters": (
        ("cast_meters", "customers", "tariffs"),
        """select *, meter_id is null or meter_id = '' as is_missing_meter_id,
          customer_id is null or customer_id = '' as is_missing_customer_id,
          tariff_id is null or tariff_id = '' as is_missing_tariff_id,
          customer_id is not null and not exists (select 1 from customers c
            where c.customer_id = m.customer_id) as is_unknown_customer_id,
          tariff_id is not null and not exists (select 1 from tariffs t
            where t.tariff_id = m.tariff_id) as is_unknown_tariff_id,
          meter_type not in ('SMETS1', 'SMETS2') as is_invalid_meter_type,
          meter_status not in ('Active', 'Faulty', 'Disconnected') as is_invalid_meter_status,
          installation_date is null as is_missing_installation_date,
          meter_id is not null and row_number() over (partition by meter_id
            order by loaded desc nulls last, row_number) > 1 as is_duplicate_meter_id
        from cast_meters m""",
    ),
    "cast_weather": (
        ("weather",),
        """select n as row_number, case when n % 59 = 0 then '' else weather_id end as weather_id,
          case when n % 61 = 0 then null else weather_date end as weather_date,
          case when n % 53 = 0 then null else region end as region,
          case when n % 37 = 0 then 50 when n % 43 = 0 then null else avg_temperature_c end as avg_temperature_c,
          min_temperature_c,
          case when n % 41 = 0 then -60 else max_temperature_c end as max_temperature_c,
          case when n % 47 = 0 then 101 else humidity_percent end as humidity_percent,
          case when n % 67 = 0 then null else wind_speed_mph end as wind_speed_mph,
          case when n % 71 = 0 then 'Hail' when n % 73 = 0 then null else weather_condition end
            as weather_condition,
          timestamp '2025-02-01 00:00:00' + to_hours(cast(n * 7 % 5 as int)) as loaded
        from (select *, cast((weather_date - date '2000-01-01') * 100
                + ascii(substr(region, 2, 1)) as bigint) as n from weather) w""",
    ),
    "judged_weather": (
        ("cast_weather",),
        """select *, weather_id is null or weather_id = '' as is_missing_weather_id,
          weather_date is null as is_missing_weather_date,
          region is null or region = '' as is_missing_region,
          avg_temperature_c is null or avg_temperature_c < -30 or avg_temperature_c > 45
            as is_invalid_avg_temperature,
          max_temperature_c < min_temperature_c as is_invalid_temperature_range,
          humidity_percent is null or humidity_percent < 0 or humidity_percent > 100 as is_invalid_humidity,
          wind_speed_mph is null or wind_speed_mph < 0 or wind_speed_mph > 100 as is_invalid_wind_speed,
          weather_condition not in ('Clear', 'Cloudy', 'Rain', 'Heavy Rain', 'Snow', 'Fog', 'Windy')
            as is_invalid_weather_condition,
          weather_id is not null and row_number() over (partition by weather_id
            order by loaded desc nulls last, row_number) > 1 as is_duplicate_weather_id
        from cast_weather""",
    ),
    "cast_outages": (
        ("numbered_outages",),
        """select n as row_number, outage_id, case when p % 53 = 0 then '' else region end as region,
          case when p % 41 = 0 then 'Unknown' else outage_type end as outage_type,
          case when p % 43 = 0 then 'Total' when p % 71 = 0 then null else severity end as severity,
          case when p % 47 = 0 then null else outage_start_timestamp end as outage_start_timestamp,
          case when p % 37 = 0 then timestamp '1990-01-01 00:00:00' else outage_end_timestamp end
            as outage_end_timestamp,
          case when p % 59 = 0 then 0 else duration_minutes end as duration_minutes,
          case when p % 61 = 0 then -1 else p end as affected_customers,
          timestamp '2025-02-01 00:00:00' + to_hours(cast(n * 7 % 5 as int)) as loaded
        from (select *, affected_customers as p from numbered_outages) o""",
    ),
    "judged_outages": (
        ("cast_outages",),
        """select *, outage_id is null or outage_id = '' as is_missing_outage_id,
          region is null or region = '' as is_missing_region,
          outage_type not in ('Planned Maintenance', 'Network Fault', 'Storm Damage', 'Equipment Failure',
            'Third Party Damage') as is_invalid_outage_type,
          severity not in ('Low', 'Medium', 'High', 'Critical') as is_invalid_severity,
          outage_start_timestamp is null as is_missing_start_timestamp,
          outage_end_timestamp is null as is_missing_end_timestamp,
          outage_end_timestamp is not null and outage_start_timestamp is not null
            and outage_end_timestamp < outage_start_timestamp as is_invalid_timestamp_range,
          duration_minutes is null or duration_minutes <= 0 as is_invalid_duration,
          affected_customers is null or affected_customers < 0 as is_invalid_affected_customers,
          outage_id is not null and row_number() over (partition by outage_id
            order by loaded desc nulls last, row_number) > 1 as is_duplicate_outage_id
        from cast_outages""",
    ),
    "cast_billing": (
        ("billing",),
        """select n as row_number,
          case when n % 59 = 58 then 'B' || (n - 1) else billing_event_id end as billing_event_id,
          case when n % 13 = 0 then 'X' || n when n % 17 = 0 then null else customer_id end as customer_id,
          case when n % 23 = 0 then 'X' || n when n % 29 = 0 then '' else tariff_id end as tariff_id, region,
          case when n % 61 = 0 then null else billing_date end as billing_date, billing_period_start,
          case when n % 67 = 0 then date '1999-01-01' else billing_period_end end as billing_period_end,
          case when n % 47 = 0 then -2 else total_consumption_kwh end as total_consumption_kwh,
          case when n % 37 = 0 then -9.5 when n % 41 = 0 then null when n % 3 <> 0 then 250.25
            else total_amount end as total_amount,
          case when n % 71 = 0 then 'Lost' when n % 73 = 0 then null else payment_status end as payment_status,
          case when n % 79 = 0 then 'Cheque' else payment_method end as payment_method,
          case when n % 5 = 0 then null else paid_at end as paid_at,
          timestamp '2025-02-01 00:00:00' + to_hours(cast(n * 7 % 5 as int)) as loaded
        from (select *, cast(substr(billing_event_id, 2) as bigint) as n from billing) b""",
    ),
    "judged_billing": (
        ("cast_billing", "customers", "tariffs"),
        """select *, billing_event_id is null or billing_event_id = '' as is_missing_billing_event_id,
          customer_id is null or customer_id = '' as is_missing_customer_id,
          tariff_id is null or tariff_id = '' as is_missing_tariff_id,
          customer_id is not null and customer_id not in (select customer_id from customers)
            as is_unknown_customer_id,
          tariff_id is not null and tariff_id not in (select tariff_id from tariffs) as is_unknown_tariff_id,
          billing_date is null as is_missing_billing_date,
          total_consumption_kwh is null or total_consumption_kwh < 0 as is_invalid_total_consumption,
          total_amount is null as is_missing_total_amount,
          total_amount < 0 as is_negative_total_amount, total_amount > 1000 as is_high_total_amount,
          payment_status not in ('Paid', 'Pending', 'Failed', 'Overdue') as is_invalid_payment_status,
          payment_method not in ('Direct Debit', 'Card', 'Bank Transfer', 'Prepayment')
            as is_invalid_payment_method,
          billing_period_end is not null and billing_period_start is not null
            and billing_period_end < billing_period_start as is_invalid_billing_period,
          payment_status = 'Paid' and paid_at is null as is_paid_without_paid_at,
          billing_event_id is not null and row_number() over (partition by billing_event_id
            order by loaded desc nulls last, row_number) > 1 as is_duplicate_billing_event_id
        from cast_billing""",
    ),
}


def sql(query: str, *tables: str) -> str:
    """A query with the domain tables it names, each defined once and after those it needs."""
    ordered: dict[str, str] = {}

    def define(name: str) -> None:
        needs, body = CTES[name]
        for need in needs:
            define(need)
        ordered.setdefault(name, body)

    for table in tables:
        define(table)
    ctes = ",\n".join(f"{name} as ({body})" for name, body in ordered.items())
    return f"with {ctes}\n{query}" if ctes else query


# Flag and message of every rule, in the order the messages are joined.
MESSAGES = {
    "readings": {
        "is_missing_reading_id": "Missing reading_id",
        "is_missing_customer_id": "Missing customer_id",
        "is_missing_meter_id": "Missing meter_id",
        "is_missing_reading_timestamp": "Missing or invalid reading_timestamp",
        "is_missing_consumption": "Missing or invalid consumption_kwh",
        "is_negative_consumption": "Negative consumption_kwh",
        "is_consumption_outlier": "Consumption outlier greater than 100 kWh",
        "is_future_timestamp": "Future reading_timestamp",
        "is_invalid_voltage": "Voltage outside expected range 200-260",
        "is_duplicate_reading": "Duplicate reading_id",
    },
    "customers": {
        "is_missing_customer_id": "Missing customer_id",
        "is_missing_customer_name": "Missing customer_name",
        "is_invalid_email": "Invalid email format",
        "is_missing_region": "Missing region",
        "is_invalid_account_status": "Invalid account_status",
        "is_missing_registration_date": "Missing or invalid registration_date",
        "is_duplicate_customer_id": "Duplicate customer_id",
    },
    "tariffs": {
        "is_missing_tariff_id": "Missing tariff_id",
        "is_missing_tariff_name": "Missing tariff_name",
        "is_invalid_standing_charge": "Invalid standing charge",
        "is_invalid_unit_rate": "Invalid unit rate",
        "is_missing_effective_start_date": "Missing effective_start_date",
        "is_invalid_effective_date_range": "effective_end_date earlier than effective_start_date",
        "is_duplicate_tariff_id": "Duplicate tariff_id",
    },
    "meters": {
        "is_missing_meter_id": "Missing meter_id",
        "is_missing_customer_id": "Missing customer_id",
        "is_missing_tariff_id": "Missing tariff_id",
        "is_unknown_customer_id": "customer_id does not exist in customers_clean",
        "is_unknown_tariff_id": "tariff_id does not exist in tariffs_clean",
        "is_invalid_meter_type": "Invalid meter_type",
        "is_invalid_meter_status": "Invalid meter_status",
        "is_missing_installation_date": "Missing or invalid installation_date",
        "is_duplicate_meter_id": "Duplicate meter_id",
    },
    "weather": {
        "is_missing_weather_id": "Missing weather_id",
        "is_missing_weather_date": "Missing weather_date",
        "is_missing_region": "Missing region",
        "is_invalid_avg_temperature": "Average temperature outside expected range",
        "is_invalid_temperature_range": "max_temperature_c lower than min_temperature_c",
        "is_invalid_humidity": "Humidity outside expected range 0-100",
        "is_invalid_wind_speed": "Wind speed outside expected range",
        "is_invalid_weather_condition": "Invalid weather_condition",
        "is_duplicate_weather_id": "Duplicate weather_id",
    },
    "outages": {
        "is_missing_outage_id": "Missing outage_id",
        "is_missing_region": "Missing region",
        "is_invalid_outage_type": "Invalid outage_type",
        "is_invalid_severity": "Invalid severity",
        "is_missing_start_timestamp": "Missing outage_start_timestamp",
        "is_missing_end_timestamp": "Missing outage_end_timestamp",
        "is_invalid_timestamp_range": "outage_end_timestamp earlier than outage_start_timestamp",
        "is_invalid_duration": "Invalid duration_minutes",
        "is_invalid_affected_customers": "Invalid affected_customers",
        "is_duplicate_outage_id": "Duplicate outage_id",
    },
    "billing": {
        "is_missing_billing_event_id": "Missing billing_event_id",
        "is_missing_customer_id": "Missing customer_id",
        "is_missing_tariff_id": "Missing tariff_id",
        "is_unknown_customer_id": "customer_id does not exist in customers_clean",
        "is_unknown_tariff_id": "tariff_id does not exist in tariffs_clean",
        "is_missing_billing_date": "Missing billing_date",
        "is_invalid_total_consumption": "Invalid total_consumption_kwh",
        "is_missing_total_amount": "Missing total_amount",
        "is_negative_total_amount": "Negative total_amount",
        "is_high_total_amount": "High total_amount greater than £1000",
        "is_invalid_payment_status": "Invalid payment_status",
        "is_invalid_payment_method": "Invalid payment_method",
        "is_invalid_billing_period": "billing_period_end earlier than billing_period_start",
        "is_paid_without_paid_at": "Paid billing event missing paid_at",
        "is_duplicate_billing_event_id": "Duplicate billing_event_id",
    },
}


def code(flag: str) -> str:
    return f"case when {flag} then 'T' when not {flag} then 'F' else 'N' end"


def reason(role: str) -> str:
    parts = ", ".join(f"case when {flag} then '{text}' end" for flag, text in MESSAGES[role].items())
    return f"concat_ws('; ', {parts})"


def faulty(role: str, null_passes: bool) -> str:
    tests = [f"coalesce({f}, false)" if null_passes else f for f in MESSAGES[role]]
    return "(" + " or ".join(tests) + ")"


def rule_flags(role: str) -> str:
    codes = ", ".join(f"{code(flag)} as {flag}" for flag in MESSAGES[role])
    return sql(
        f"select row_number, {codes}, {reason(role)} as quarantine_reason from judged_{role}", f"judged_{role}"
    )


def half_up(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(24, 9)), {digits}) as double)"


def exact_sum(value: str) -> str:
    return f"sum(cast({value} as decimal(20, 6)))"


def mean(value: str) -> str:
    return f"(cast({exact_sum(value)} as double) / count({value}))"


def key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '__null__')" for c in columns)
    return f"sha256(concat_ws('||', {parts}))"


STAMP = f"{AS_OF} as dbt_loaded_at, 'run-1' as dbt_invocation_id"

DAILY_USAGE = f"""select reading_date, region, count(*) as reading_count,
    count(distinct meter_id) as active_meter_count, count(distinct customer_id) as active_customer_count,
    {half_up(exact_sum('consumption_kwh'), 3)} as total_consumption_kwh,
    {half_up(mean('consumption_kwh'), 3)} as avg_consumption_kwh,
    {half_up('max(consumption_kwh)', 3)} as max_half_hour_consumption_kwh,
    {half_up(mean('voltage'), 2)} as avg_voltage,
    cast(sum(case when is_late_arriving then 1 else 0 end) as bigint) as late_arriving_reading_count
  from readings where consumption_kwh between 0 and 100 group by reading_date, region"""
DAILY_BILLING = f"""select billing_date, region,
    cast({exact_sum('total_amount')} as double) as total_revenue_amount,
    cast({exact_sum('total_consumption_kwh')} as double) as billed_consumption_kwh,
    count(distinct billing_event_id) as billing_event_count
  from billing group by billing_date, region"""
CUSTOMER_BILLING = f"""select customer_id, cast({exact_sum('total_amount')} as double) as total_billed_amount,
    cast({exact_sum('total_consumption_kwh')} as double) as total_billed_consumption_kwh,
    count(distinct billing_event_id) as billing_event_count,
    cast({exact_sum("case when payment_status = 'Paid' then total_amount else 0 end")} as double) as paid_amount,
    cast({exact_sum("case when payment_status in ('Pending', 'Overdue', 'Failed') then total_amount else 0 end")}
      as double) as unpaid_or_problem_amount
  from billing group by customer_id"""
REGIONS = """select distinct region from (select region from customers union select region from meters
    union select region from readings union select region from weather union select region from outages
    union select region from billing) where region is not null"""
DATES = """select cast(strftime(d, '%Y%m%d') as int) as date_sk, d as date_day from (
    select cast(unnest(generate_series((select min(cast(ts as date)) from events),
      (select max(cast(ts as date)) from events), interval 1 day)) as date) as d)"""

_STAGE_COLUMNS = {
    "customers": "customer_id, customer_name, email, phone_number, postcode, region, customer_segment, "
    "property_type, account_status, registration_date",
    "tariffs": "tariff_id, tariff_name, standing_charge_pence_per_day, "
    "cast(round(cast(standing_charge_pence_per_day as decimal(18, 6)) * 0.01, 2) as double) "
    "as standing_charge_amount_per_day, unit_rate_pence_per_kwh, "
    "cast(round(cast(unit_rate_pence_per_kwh as decimal(18, 6)) * 0.01, 2) as double) "
    "as unit_rate_amount_per_kwh, green_energy_flag, effective_start_date, effective_end_date",
    "meters": "meter_id, customer_id, tariff_id, region, meter_type, meter_status, installation_date",
    "readings": "reading_id, meter_id, customer_id, reading_timestamp, reading_date, consumption_kwh, voltage, "
    "reading_source, meter_status, region, is_late_arriving, ingestion_delay_hours, "
    "data_quality_issue_injected, firmware_version, signal_strength_dbm, meter_reading_quality_code",
    "weather": "weather_id, weather_date, region, avg_temperature_c, min_temperature_c, max_temperature_c, "
    "humidity_percent, wind_speed_mph, weather_condition, heating_degree_days, cooling_degree_days",
    "outages": "outage_id, region, outage_type, severity, outage_start_timestamp, outage_end_timestamp, "
    "duration_minutes, affected_customers, resolved_flag",
    "billing": "billing_event_id, customer_id, tariff_id, region, billing_date, billing_period_start, "
    "billing_period_end, total_consumption_kwh, standing_charge_amount, energy_charge_amount, vat_amount, "
    "total_amount, payment_status, payment_method, due_date, paid_at, billing_quality_issue_injected",
}
_STAGE_LINEAGE = (
    "source_file_name, source_system, generated_at_utc, _source_file_path, _run_id, _environment, "
    "silver_processed_at_utc"
)
_STAGE_KEYS = {
    "customers": ("customer_sk", "customer_id"),
    "tariffs": ("tariff_sk", "tariff_id"),
    "meters": ("meter_sk", "meter_id"),
    "readings": ("meter_reading_sk", "reading_id"),
    "weather": ("weather_sk", "weather_id"),
    "outages": ("outage_sk", "outage_id"),
    "billing": ("billing_event_sk", "billing_event_id"),
}


def staged(role: str) -> str:
    sk, natural = _STAGE_KEYS[role]
    return sql(
        f"select {key(natural)} as {sk}, {_STAGE_COLUMNS[role]}, {_STAGE_LINEAGE}, {STAMP} from {role}", role
    )


def scd(role: str, columns: str, key_column: str, version: str, changed: str, new_filter: str = "") -> str:
    """Two snapshots a month apart: version rows as a join of the first with the second state."""
    t1, t2 = "timestamp '2026-01-01 00:00:00'", "timestamp '2026-02-01 00:00:00'"
    names = [c.strip() for c in columns.split(",")]
    first = ", ".join(f"a.{c}" for c in names)
    second = ", ".join(f"b.{c}" for c in names)
    return f"""select {key('a.' + key_column, t1)} as {version}, {first},
        {t1} as valid_from_timestamp, case when {changed} then {t2} end as valid_to_timestamp,
        not ({changed}) as is_current_record
      from first_state a left join second_state b on a.{key_column} = b.{key_column}
      union all
      select {key('b.' + key_column, t2)}, {second}, {t2}, null, true
      from second_state b left join first_state a on a.{key_column} = b.{key_column}
      where a.{key_column} is null or ({changed})"""
