"""Single values, on the documented examples and the edges."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from yardlake.functions import clean, shifts
from yardlake.operators import metrics, shape
from yardlake.schemas import GATE_TYPES


def one(spark, values, f):
    """f over a text column, as a list."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("x"))).collect()]


def test_container(spark):
    assert one(spark, ["  TCNU1234567  ", "tcnu9876543", "  ", "TCNU-123 4567", None], clean.container_number) == ["TCNU1234567", "TCNU9876543", None, "TCNU1234567", None]


def test_facility(spark):
    rows = spark.createDataFrame([("UNKNOWN", "CT01-A-5-4"), ("ct02", None), ("XCT03", None), ("YARD", None)], "a string, b string")
    assert [tuple(r) for r in rows.select(clean.facility_code("a", "b"), clean.facility_prefix("a", "b")).collect()] == [("CT01", None), ("CT02", "CT02"), ("CT03", None), (None, None)]
    assert one(spark, ["CT03-MNR-SHOP-1", "ct02", None], clean.raw_facility) == ["CT03", "UNKNOWN", "UNKNOWN"]


def test_event_time(spark):
    ten, midnight = datetime(2024, 1, 5, 10), datetime(2024, 1, 5)
    good = ["2024-01-05 10:00:00", "05/01/2024 10:00:00", "2024-01-05T10:00:00", "05/01/2024 10:00", "2024-01-05", "05/01/2024"]
    assert one(spark, good, lambda c: clean.event_time(c)) == [ten] * 4 + [midnight] * 2
    bad = ["nan", "2024-01-05T10:00:00.123", "1/2/2024", "2019-12-31", "2031-01-01", None, ""]
    assert one(spark, bad, lambda c: clean.event_time(c)) == [None] * 7
    assert one(spark, ["2020-01-01", "2030-12-31"], lambda c: clean.event_time(c)) == [datetime(2020, 1, 1), datetime(2030, 12, 31)]
    assert one(spark, ["x"], lambda c: clean.event_time(c, F.lit("05/01/2024"), F.lit("10:00"))) == [ten]
    assert one(spark, ["x"], lambda c: clean.event_time(c, F.lit("05/01/2024"), F.lit("?"))) == [midnight]


def test_event_type(spark):
    given = ["gate-in", "Gate In", "GATEOUT", "CLEANING", " GATE_IN ", None]
    assert one(spark, given, lambda c: clean.event_type(c, GATE_TYPES)) == ["GATE_IN", "GATE_IN", "GATEOUT", None, "GATE_IN", None]


def test_ids(spark):
    import hashlib

    got = spark.range(1).select(clean.text_id(F.lit("A"), F.lit(None), F.lit(5))).first()[0]
    assert got == hashlib.md5(b"A||5").hexdigest()


@pytest.mark.parametrize("hour,name,day", [(0, "NIGHT", 4), (5, "NIGHT", 4), (6, "MORNING", 5), (13, "MORNING", 5), (14, "AFTERNOON", 5), (21, "AFTERNOON", 5), (22, "NIGHT", 5), (23, "NIGHT", 5)])
def test_shift(spark, hour, name, day):
    ts = F.lit(f"2024-01-05 {hour:02}:30:00").cast("timestamp")
    assert tuple(spark.range(1).select(shifts.shift(ts), shifts.operational_date(ts)).first()) == (name, date(2024, 1, day))


def test_dwell_class(spark):
    days = [5.0, 5.01, 12.0, 12.01, 20.0, 20.01, None]
    rows = spark.createDataFrame([(d * 24 if d else d,) for d in days], "h double")
    assert [r[0] for r in rows.select(metrics.dwell_class(F.col("h"))).collect()] == ["SHORT_0_5D", "MEDIUM_6_12D", "MEDIUM_6_12D", "LONG_13_20D", "LONG_13_20D", "CRITICAL_GT20D", None]


def test_backlog_type(spark):
    rows = [("H", None, None, "INSPECTION"), ("H", "E", None, "MNR"), (None, None, None, "GATE_IN"), (None, None, None, "YARD_MOVE"), ("H", "E", "W", "CLEANING")]
    df = spark.createDataFrame(rows, "last_inspection_severity string, last_repair_stage string, last_cleaning_type string, event_type_norm string")
    assert [r[0] for r in df.select(metrics.backlog_type()).collect()] == ["WAITING_REPAIR", "WAITING_CLEANING", "WAITING_INSPECTION", None, None]


def test_file_kinds_and_csv(spark, tmp_path):
    from yardlake.sources.tables import staging_csv

    names = ["/a/stg_gate_events.csv", "x/STG_CLEANING.csv", "mnr.csv", "yard_location_movement.csv", "inspection_damage_report.csv", "other.csv"]
    assert one(spark, names, shape.kind_of_file) == ["gate", "cleaning", "mnr", "yard_move", "inspection", None]
    path = tmp_path / "stg_cleaning_events.csv"
    path.write_text("event_type,event_time,Date In,container_no_raw,facility,source_row\nWASH, ,2024-01-05,C1,CT02-x,7\nCLEAN,2024-01-06,,C2,,8\n")
    got = shape.cleaning(staging_csv(spark, str(path))).orderBy("event_id").collect()
    assert re.fullmatch("CLEAN_[0-9a-f]{8}_0", got[0].event_id)  # which file, which row
    assert [(r.event_id.replace(got[0].event_id[5:-1], "_"), r.event_type, r.event_time, r.facility) for r in got] == [("CLEAN_0", "CLEANING", "2024-01-05", "CT02"), ("CLEAN_1", "CLEAN", "2024-01-06", "UNKNOWN")]
    sent = shape.envelope(shape.cleaning(staging_csv(spark, str(path))))
    assert {r.topic for r in sent.collect()} == {"raw.cleaning"}


def test_dead_letters(spark):
    from yardlake.operators import bronze

    values = [None, "", "{bad", "[1]", '{"n":"a"}', '{"container_no_raw":5}', '{"container_no_raw":""}']
    rows = spark.createDataFrame([("k", v, "raw.gate", 0, i, datetime(2024, 1, 1)) for i, v in enumerate(values)], "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    p = bronze.parsed(rows, "raw.gate")
    at = F.current_timestamp()
    assert [r.kafka_offset for r in bronze.dead_letters(p, at).orderBy("kafka_offset").collect()] == [0, 1, 2, 3, 4]
    assert [(r.kafka_offset, r.container_no_raw) for r in bronze.valid(p, at).orderBy("kafka_offset").collect()] == [(5, "5"), (6, "")]


def test_kafka_options():
    """The connector is not here: what it would be asked for."""
    from types import SimpleNamespace

    from yardlake.sources import tables

    asked = {}

    class Reader:
        def format(self, name):
            asked["format"] = name
            return self

        def options(self, **options):
            asked.update(options)
            return self

        def load(self):
            return asked

    assert tables.topic_stream(SimpleNamespace(readStream=Reader()), "host:9092", "raw.gate", 10) == {
        "format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "raw.gate", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "10", "failOnDataLoss": "false",
    }


def test_own_list_of_types(spark):
    from yardlake.operators import silver
    from yardlake.schemas import TYPES_OF_KIND

    rows = spark.createDataFrame([(i, t, "2024-01-05 10:00:00", "C1", "CT01", None, 0, i) for i, t in enumerate(["restack", "yard move", " LOAD ", "fly", None])], "id int, event_type string, event_time string, container_no_raw string, facility string, to_location string, kafka_partition int, kafka_offset long")
    assert silver.silver(rows, "yard_move").count() == 5
    assert [r.event_type_norm for r in silver.silver(rows, "yard_move", types=TYPES_OF_KIND["yard_move"]).orderBy("id").collect()] == ["RESTACK", "YARD_MOVE", "LOAD"]
