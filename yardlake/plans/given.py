"""The given tables seen as raw yard events, for the queries and their SQL alike.

signup and purchase events stand for gate-in and gate-out, clicks for yard moves, views for inspections, errors for
cleaning and repair; ids inject odd spellings, all time formats, missing and wrong values, and containers that are only
known from one kind of event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardlake.operators import cycles, silver, status
from yardlake.schemas import TOPICS

RAW_SQL = """
SELECT event_id,
  CASE WHEN event_type = 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'GATE_IN' WHEN 1 THEN 'gate-in' ELSE 'GATEIN' END
       WHEN event_type = 'purchase' THEN CASE event_id % 3 WHEN 0 THEN 'GATE_OUT' WHEN 1 THEN 'gate out' ELSE 'GATEOUT' END
       WHEN event_type = 'click' THEN 'yard_move'
       WHEN event_type = 'view' THEN 'inspection'
       WHEN event_id % 2 = 0 THEN CASE WHEN event_id % 3 = 0 THEN 'WASH' ELSE 'CLEANING' END
       ELSE CASE event_id % 3 WHEN 0 THEN 'MNR_ESTIMATE' WHEN 1 THEN 'MNR_APPROVED' ELSE 'MNR_REPAIRED' END END AS event_type,
  CASE WHEN event_type IN ('signup', 'purchase') THEN 'raw.gate' WHEN event_type = 'click' THEN 'raw.yard_move'
       WHEN event_type = 'view' THEN 'raw.inspection' WHEN event_id % 2 = 0 THEN 'raw.cleaning' ELSE 'raw.mnr' END AS topic,
  CASE WHEN event_id % 103 = 0 THEN 'nan'
       WHEN event_id % 101 = 0 THEN '1999' || substr(CAST(ts AS STRING), 5, 15)
       WHEN event_id % 12 = 1 THEN {day} || substr(CAST(ts AS STRING), 11, 9)
       WHEN event_id % 12 = 7 THEN {day} || substr(CAST(ts AS STRING), 11, 6)
       WHEN event_id % 6 = 2 THEN substr(CAST(ts AS STRING), 1, 10) || 'T' || substr(CAST(ts AS STRING), 12, 8)
       WHEN event_id % 36 = 9 THEN {day}
       WHEN event_id % 36 = 21 THEN substr(CAST(ts AS STRING), 1, 10)
       WHEN event_id % 12 = 10 AND event_type NOT IN ('click', 'view') THEN CAST(NULL AS STRING)
       WHEN event_id % 36 = 11 AND event_type IN ('signup', 'purchase') THEN 'at noon'
       ELSE substr(CAST(ts AS STRING), 1, 19) END AS event_time,
  CASE WHEN event_type IN ('signup', 'purchase') AND (event_id % 12 = 10 OR event_id % 36 = 11) THEN {day} END AS date_raw,
  CASE WHEN event_type IN ('signup', 'purchase') AND event_id % 24 = 10 THEN substr(CAST(ts AS STRING), 12, 8)
       WHEN event_type IN ('signup', 'purchase') AND event_id % 24 = 22 THEN substr(CAST(ts AS STRING), 12, 5)
       WHEN event_id % 36 = 11 THEN '?' END AS time_raw,
  CASE WHEN event_type NOT IN ('signup', 'purchase', 'click', 'view') AND event_id % 2 = 0 THEN substr(CAST(ts AS STRING), 1, 10) END AS date_in,
  CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS STRING)
       WHEN event_id % 7 = 3 AND event_type = 'view' THEN 'INSU' || lpad(CAST(event_id % 991 AS STRING), 7, '0')
       WHEN event_id % 7 = 3 AND event_type = 'signup' THEN 'NEWU' || lpad(CAST(event_id % 991 AS STRING), 7, '0')
       WHEN event_id % 14 = 3 AND event_type = 'error' THEN 'REPU' || lpad(CAST(event_id % 991 AS STRING), 7, '0')
       WHEN event_id % 10 = 0 THEN '  tcnu ' || lpad(CAST(user_id AS STRING), 7, '0') || ' '
       WHEN event_id % 10 = 1 THEN 'TCNU-' || lpad(CAST(user_id AS STRING), 7, '0')
       ELSE 'TCNU' || lpad(CAST(user_id AS STRING), 7, '0') END AS container_no_raw,
  CASE event_id % 11 WHEN 0 THEN 'ct0' || CAST(user_id % 4 + 1 AS STRING) WHEN 1 THEN 'UNKNOWN' ELSE 'CT0' || CAST(user_id % 4 + 1 AS STRING) END AS facility,
  CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS STRING)
       ELSE 'CT0' || CAST(user_id % 4 + 1 AS STRING) || '-A-' || CAST(event_id % 5 + 1 AS STRING) || '-' || CAST(event_id % 4 + 1 AS STRING) END AS location,
  'TRK' || lpad(CAST(event_id % 10000 AS STRING), 4, '0') AS truck,
  'BK' || CAST(event_id % 500 AS STRING) AS booking,
  CASE event_id % 4 WHEN 0 THEN ' minor ' WHEN 1 THEN 'Major' WHEN 2 THEN 'CRITICAL' ELSE CAST(NULL AS STRING) END AS severity,
  CASE event_id % 3 WHEN 0 THEN 'estimate' WHEN 1 THEN 'Approved ' ELSE 'repaired' END AS stage,
  CAST(user_id % 3 AS INT) AS kafka_partition,
  event_id AS kafka_offset
FROM {events}
""".replace("{day}", "substr(CAST(ts AS STRING), 9, 2) || '/' || substr(CAST(ts AS STRING), 6, 2) || '/' || substr(CAST(ts AS STRING), 1, 4)")
#: Types of the given events that a kind is made of; None: all others.
MADE_OF = {"gate": ["signup", "purchase"], "yard_move": ["click"], "inspection": ["view"], "cleaning": None, "mnr": None}
#: Bronze columns that a kind has beside the common ones, made from which.
EXTRA = {
    "gate": {"date_raw": "date_raw", "time_raw": "time_raw", "booking": "booking", "truck": "truck", "location": "location"},
    "yard_move": {"to_location": "location"},
    "inspection": {"damage_code": None, "component": None, "severity": "severity"},
    "cleaning": {"date_in": "date_in", "source_file": None, "source_row": None},
    "mnr": {"location_raw": "location", "stage": "stage", "source_file": None, "source_row": None},
}


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def as_of() -> Column:
    return at("2024-01-31 00:00:00")


def raw(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    """All raw events; with a kind, the files are only read for rows that it is made of."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if kind:
        known = [t for types in MADE_OF.values() if types for t in types]
        its = F.col("event_type").isin(MADE_OF[kind]) if MADE_OF[kind] else ~F.col("event_type").isin(known) | F.col("event_type").isNull()
        events = events.where(its)
    return spark.sql(RAW_SQL, events=events)


def bronze(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    rows = raw(spark, sf_dir, kind).where(F.col("topic") == TOPICS[kind])
    extra = [(F.col(c) if c else F.lit(None).cast("string")).alias(n) for n, c in EXTRA[kind].items()]
    return rows.select("event_id", "event_type", "event_time", "container_no_raw", "facility", "kafka_partition", "kafka_offset", *extra)


def clean_events(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return silver.deduplicated(silver.silver(bronze(spark, sf_dir, kind), kind))


def gate_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.cycles(clean_events(spark, sf_dir, "gate"))


def harmonized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.all_events({k: clean_events(spark, sf_dir, k) for k in TOPICS})


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.current(harmonized(spark, sf_dir))


#: Added before rounding, as means that end in a 5 differ in their last bit with the order of their terms.
TIE = 1e-9


def edge(df: DataFrame) -> DataFrame:
    """Timestamps and dates as timestamps without a zone, and doubles of six places, as the SQL has them."""
    fixed = {"timestamp": lambda c: F.col(c).cast("timestamp_ntz"), "date": lambda c: F.col(c).cast("timestamp_ntz"), "double": lambda c: F.round(F.col(c) + TIE, 6)}
    return df.select(*[fixed[t](c).alias(c) if t in fixed else F.col(c) for c, t in df.dtypes])
