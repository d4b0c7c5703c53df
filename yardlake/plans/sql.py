"""DuckDB SQL parts that the queries' oracles are put together from."""

from __future__ import annotations

from yardlake.plans.given import RAW_SQL
from yardlake.schemas import TOPIC_OF_TYPE

CONTAINER = "nullif(upper(regexp_replace(container_no_raw, '[^A-Za-z0-9]', '', 'g')), '')"


def code(c: str) -> str:
    return rf"nullif(regexp_extract(upper(trim({c})), '(CT\d{{2}})', 1), '')"


FACILITY = f"CASE WHEN topic IN ('raw.gate', 'raw.mnr') THEN coalesce({code('facility')}, {code('location')}) ELSE {code('facility')} END"
FORMATS = "['%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%d/%m/%Y %H:%M', '%Y-%m-%d', '%d/%m/%Y']"


def time(text: str) -> str:
    """The time of a text, else of date_raw and time_raw, else of date_raw, if its year is in range."""
    parsed = f"coalesce(try_strptime({text}, {FORMATS}), try_strptime(date_raw || ' ' || time_raw, ['%d/%m/%Y %H:%M:%S', '%d/%m/%Y %H:%M']), try_strptime(date_raw, '%d/%m/%Y'))"
    return f"CASE WHEN year({parsed}) BETWEEN 2020 AND 2030 THEN {parsed} END"


TIME = time("CASE topic WHEN 'raw.cleaning' THEN coalesce(event_time, date_in) ELSE event_time END")
TYPE = r"upper(regexp_replace(regexp_replace(trim(event_type), '[\s\-]+', '_', 'g'), '[^A-Za-z0-9_]', '', 'g'))"
GATED = f"CASE WHEN {TYPE} IN ('GATE_IN', 'GATEIN', 'GATE_OUT', 'GATEOUT') THEN {TYPE} END"
RAW_FACILITY = r"coalesce(nullif(regexp_extract({}, '(CT\d{{2}})', 1), ''), 'UNKNOWN')"
AS_OF, LATER = "TIMESTAMP '2024-01-31 00:00:00'", "TIMESTAMP '2024-03-01 00:00:00'"


def joined_id(*columns: str) -> str:
    return "md5(" + " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + ")"


def seconds(end: str) -> str:
    return f"(CAST(epoch({end}) AS BIGINT) - CAST(epoch(gate_in_time) AS BIGINT))"


def hours(end: str) -> str:
    """Two places, halves up, in integers: DuckDB's round() works on the binary value."""
    return f"(({seconds(end)} * 100 + 1800) // 3600) / 100::DOUBLE"


WHERE = ("kafka_partition", "kafka_offset")
ID = f"""CASE topic
  WHEN 'raw.gate' THEN {joined_id("container_no_norm", "event_type_norm", "event_time_parsed", "booking", *WHERE)}
  WHEN 'raw.yard_move' THEN {joined_id("container_no_norm", "event_time_parsed", "location", *WHERE)}
  WHEN 'raw.inspection' THEN {joined_id("container_no_norm", "event_time_parsed", "NULL", "NULL", *WHERE)}
  WHEN 'raw.cleaning' THEN {joined_id("container_no_norm", "event_time_parsed", "event_type_norm", *WHERE, "NULL", "NULL")}
  ELSE {joined_id("container_no_norm", "event_time_parsed", "event_type_norm", "stage_norm", *WHERE, "NULL", "NULL")} END"""
ACCEPTED = "event_time_parsed IS NOT NULL AND facility IS NOT NULL AND (topic <> 'raw.gate' OR container_no_norm IS NOT NULL AND event_type_norm IS NOT NULL)"

CTES = {
    "raw": RAW_SQL.format(events="events"),
    "cleaned": f"""SELECT event_id, topic, event_type, container_no_raw, location, truck, booking, kafka_partition, kafka_offset, facility AS facility_raw,
        {CONTAINER} AS container_no_norm, {FACILITY} AS facility, {TIME} AS event_time_parsed,
        CASE topic WHEN 'raw.gate' THEN {GATED} WHEN 'raw.cleaning' THEN upper(trim(event_type)) WHEN 'raw.mnr' THEN upper(trim(event_type)) END AS event_type_norm,
        upper(trim(severity)) AS severity_norm, upper(trim(stage)) AS stage_norm
      FROM raw""",
    "silver": f"SELECT *, {ID} AS event_id_generated FROM cleaned WHERE {ACCEPTED}",
    "gate": "SELECT *, event_type_norm IN ('GATE_OUT', 'GATEOUT') AS is_out FROM silver WHERE topic = 'raw.gate'",
    "yard": "SELECT * FROM silver WHERE topic = 'raw.yard_move'",
    "opened": """SELECT container_no_norm, facility, event_time_parsed AS gate_in_time, min(truck) AS gate_in_truck,
        md5(container_no_norm || '|' || CAST(event_time_parsed AS VARCHAR) || '|' || facility) AS cycle_id
      FROM gate WHERE NOT is_out GROUP BY 1, 2, 3""",
    "latest_in": """SELECT o.container_no_norm, o.facility, o.event_time_parsed AS gate_out_time, o.truck, max(i.gate_in_time) AS gate_in_time
      FROM gate o JOIN opened i ON o.is_out AND o.container_no_norm = i.container_no_norm AND o.facility = i.facility AND i.gate_in_time <= o.event_time_parsed
      GROUP BY o.container_no_norm, o.facility, o.event_time_parsed, o.truck""",
    "closed": """SELECT container_no_norm, facility, gate_in_time, min(gate_out_time) AS gate_out_time, min(struct_pack(t := gate_out_time, truck := truck)).truck AS gate_out_truck
      FROM latest_in GROUP BY 1, 2, 3""",
    "cycles": f"""SELECT container_no_norm, facility, gate_in_time, gate_out_time, gate_in_truck, gate_out_truck, cycle_id,
        CASE WHEN gate_out_time IS NULL THEN 'OPEN' ELSE 'CLOSED' END AS cycle_status,
        {hours("gate_out_time")} AS dwell_time_hours
      FROM opened LEFT JOIN closed USING (container_no_norm, facility, gate_in_time)""",
    "harmonized0": """SELECT container_no_norm, event_time_parsed,
        CASE topic WHEN 'raw.yard_move' THEN 'YARD_MOVE' WHEN 'raw.inspection' THEN 'INSPECTION' ELSE event_type_norm END AS event_type_norm, facility AS f,
        CASE topic WHEN 'raw.yard_move' THEN location END AS last_location, CASE topic WHEN 'raw.inspection' THEN severity_norm END AS last_inspection_severity,
        CASE topic WHEN 'raw.mnr' THEN stage_norm END AS last_repair_stage, CASE topic WHEN 'raw.cleaning' THEN event_type_norm END AS last_cleaning_type, event_id_generated
      FROM silver WHERE container_no_norm IS NOT NULL""",
    "harmonized": f"SELECT * EXCLUDE (f), {code('coalesce(f, last_location)')} AS facility FROM harmonized0",
    "ordered": "SELECT *, row(event_time_parsed, event_type_norm, event_id_generated) AS o FROM harmonized",
    "status": """SELECT container_no_norm, max(event_time_parsed) AS event_time_parsed, arg_max(event_type_norm, o) AS event_type_norm,
        arg_max(row(facility), o)[1] AS facility,
        arg_max(last_location, o) FILTER (last_location IS NOT NULL) AS last_location,
        arg_max(last_inspection_severity, o) FILTER (last_inspection_severity IS NOT NULL) AS last_inspection_severity,
        arg_max(last_repair_stage, o) FILTER (last_repair_stage IS NOT NULL) AS last_repair_stage,
        arg_max(last_cleaning_type, o) FILTER (last_cleaning_type IS NOT NULL) AS last_cleaning_type
      FROM ordered GROUP BY container_no_norm""",
    "open_now": f"""SELECT *, {hours(AS_OF)} AS current_dwell_hours
      FROM cycles WHERE cycle_status = 'OPEN' AND gate_in_time <= {AS_OF}""",
    "inventory": """SELECT facility, CASE WHEN current_dwell_hours <= 120 THEN 'SHORT_0_5D' WHEN current_dwell_hours <= 288 THEN 'MEDIUM_6_12D'
          WHEN current_dwell_hours <= 480 THEN 'LONG_13_20D' ELSE 'CRITICAL_GT20D' END AS dwell_bucket,
        count(*)::BIGINT AS container_count, max(current_dwell_hours) AS max_dwell_hours, min(current_dwell_hours) AS min_dwell_hours, 'INVENTORY_BY_DWELL' AS metric_type
      FROM open_now GROUP BY 1, 2""",
    "waiting": """SELECT *, CASE WHEN last_inspection_severity IS NOT NULL AND last_repair_stage IS NULL THEN 'WAITING_REPAIR'
        WHEN last_repair_stage IS NOT NULL AND last_cleaning_type IS NULL THEN 'WAITING_CLEANING'
        WHEN event_type_norm IN ('GATE_IN', 'GATEIN') AND last_inspection_severity IS NULL THEN 'WAITING_INSPECTION' END AS backlog_type FROM status""",
    "backlog": "SELECT facility, backlog_type, count(*)::BIGINT AS backlog_count FROM waiting WHERE backlog_type IS NOT NULL AND facility IS NOT NULL GROUP BY 1, 2",
    "shift_events": f"""SELECT facility, event_time_parsed AS t, CASE WHEN is_out THEN 'SHIFT_GATE_OUT' ELSE 'SHIFT_GATE_IN' END AS kpi_type FROM gate
      WHERE event_time_parsed BETWEEN {AS_OF} - INTERVAL 30 DAY AND {AS_OF}
      UNION ALL SELECT facility, event_time_parsed, 'SHIFT_YARD_MOVES' FROM yard WHERE event_time_parsed BETWEEN {AS_OF} - INTERVAL 30 DAY AND {AS_OF}""",
    "shift_kpi": """SELECT facility, (CASE WHEN hour(t) < 6 THEN CAST(t AS DATE) - 1 ELSE CAST(t AS DATE) END)::DATE AS operational_date,
        CASE WHEN hour(t) BETWEEN 6 AND 13 THEN 'MORNING' WHEN hour(t) BETWEEN 14 AND 21 THEN 'AFTERNOON' ELSE 'NIGHT' END AS shift_id, kpi_type, count(*)::BIGINT AS value
      FROM shift_events GROUP BY 1, 2, 3, 4 HAVING operational_date >= DATE '2024-01-01'""",
    "throughput": """SELECT facility, CAST(gate_out_time AS DATE) AS operational_date, count(*)::BIGINT AS cycles_completed, sum(dwell_time_hours) AS dwell_hours_sum,
        avg(dwell_time_hours) AS avg_dwell_hours, min(dwell_time_hours) AS min_dwell_hours, max(dwell_time_hours) AS max_dwell_hours,
        quantile_disc(dwell_time_hours, 0.5) AS median_dwell_hours, quantile_disc(dwell_time_hours, 0.95) AS p95_dwell_hours
      FROM cycles WHERE cycle_status = 'CLOSED' GROUP BY 1, 2""",
    "dense": """SELECT facility, CAST(d AS DATE) AS operational_date FROM (SELECT DISTINCT facility FROM cycles),
      generate_series(DATE '2024-01-31' - INTERVAL 365 DAY, TIMESTAMP '2024-01-31', INTERVAL 1 DAY) g(d)""",
    "rolling0": "SELECT d.*, coalesce(cycles_completed, 0)::BIGINT AS cycles_completed, coalesce(dwell_hours_sum, 0) AS dwell_hours_sum, avg_dwell_hours, min_dwell_hours, max_dwell_hours, median_dwell_hours, p95_dwell_hours FROM dense d LEFT JOIN throughput USING (facility, operational_date)",
    "rolling": """SELECT *, avg(cycles_completed) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_avg_throughput,
        CASE WHEN sum(cycles_completed) OVER m > 0 THEN sum(dwell_hours_sum) OVER m / sum(cycles_completed) OVER m / 24 END AS rolling_30d_avg_dwell
      FROM rolling0 WINDOW w AS (PARTITION BY facility ORDER BY operational_date), m AS (PARTITION BY facility ORDER BY operational_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "yard_days": """SELECT facility, operational_date, count(DISTINCT container_no_norm)::BIGINT AS n FROM dense JOIN cycles USING (facility)
      WHERE operational_date BETWEEN CAST(gate_in_time AS DATE) AND coalesce(CAST(gate_out_time AS DATE), DATE '2024-01-31') GROUP BY 1, 2""",
    "daily_inventory": "SELECT facility, operational_date, coalesce(n, 0)::BIGINT AS inventory_eod FROM dense LEFT JOIN yard_days USING (facility, operational_date)",
    "daily": """SELECT facility, CAST(operational_date AS TIMESTAMP) AS day_ts, 'DAILY_THROUGHPUT' AS kpi_type, cycles_completed AS value, avg_dwell_hours AS metric1, median_dwell_hours AS metric2,
        p95_dwell_hours AS metric3, CAST(NULL AS VARCHAR) AS category, rolling_7d_avg_throughput, rolling_30d_avg_dwell FROM rolling
      UNION ALL SELECT facility, CAST(operational_date AS TIMESTAMP), 'DAILY_INVENTORY_EOD', inventory_eod, NULL, NULL, NULL, NULL, NULL, NULL FROM daily_inventory""",
    "peaks": f"""SELECT facility, dayname(event_time_parsed) AS day_name, hour(event_time_parsed)::INTEGER AS hour_of_day, count(*)::BIGINT AS total_activity,
        count(*) / (60.0::DOUBLE / 7) AS avg_activity, 'PEAK_HEATMAP' AS kpi_type
      FROM gate WHERE event_time_parsed BETWEEN {AS_OF} - INTERVAL 60 DAY AND {AS_OF} GROUP BY 1, 2, 3""",
}
#: Topic of a type, as an expression over `t`.
ROUTE = "CASE t " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TOPIC_OF_TYPE.items()) + " END"


def over(query: str) -> str:
    """The query with those parts before it that it reaches."""
    need: set[str] = set()

    def add(text: str) -> None:
        import re

        for name in CTES:
            if name not in need and re.search(rf"\b{name}\b(?!\.)", text):
                need.add(name)
                add(CTES[name])

    add(query)
    parts = ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in need)
    return f"WITH {parts}\n{query}" if parts else query
