"""Raw event schemas, event types and topics. Everything here is a fixed value of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Payload fields of each topic, all text.
TOPIC_FIELDS = {
    "raw.gate": "event_id event_type event_time date_raw time_raw container_no_raw eir seq type_raw opt move booking truck vessel voyage dest grade position location remark nominate_remark facility source_file source_sheet source_row is_synthetic ingest_time",
    "raw.yard_move": "event_id event_type event_time container_no_raw facility from_location from_block from_row from_bay from_tier to_location to_block to_row to_bay to_tier move_reason equipment_id operator_id source_file ingest_time",
    "raw.inspection": "event_id event_type event_time container_no_raw facility damage_code component severity estimated_cost currency inspector_id photo_ref remarks source ingest_time",
    "raw.cleaning": "event_id event_type event_time date_in container_no_raw type_raw remark_raw amount facility source_file source_sheet source_row is_synthetic ingest_time",
    "raw.mnr": "event_id event_type event_time container_no_raw size_raw location_raw amount_raw cleaning_cost_raw repair_cost_raw discount_raw note_raw stage facility source_file source_sheet source_row is_synthetic ingest_time",
}

# Topic of each kind of event.
TOPICS = {"gate": "raw.gate", "yard_move": "raw.yard_move", "inspection": "raw.inspection", "cleaning": "raw.cleaning", "mnr": "raw.mnr"}

# Spelling of a type -> its topic, case-sensitive.
TOPIC_OF_TYPE = {
    "GATE_IN": "raw.gate", "GATEIN": "raw.gate", "GATE_OUT": "raw.gate", "GATEOUT": "raw.gate",
    "yard_move": "raw.yard_move", "YARD_MOVE": "raw.yard_move",
    "inspection": "raw.inspection", "INSPECTION": "raw.inspection",
    "CLEANING": "raw.cleaning", "CLEAN": "raw.cleaning", "WASHING": "raw.cleaning", "CLEANED": "raw.cleaning",
    "MNR_ESTIMATE": "raw.mnr", "MNR_EST": "raw.mnr", "MNR_APPROVAL": "raw.mnr", "MNR_APPROVED": "raw.mnr", "MNR_APPR": "raw.mnr",
    "MNR_COMPLETE": "raw.mnr", "MNR_COMP": "raw.mnr", "MNR_RECEIVED": "raw.mnr", "MNR_REPAIRED": "raw.mnr",
}

# Event types that silver accepts.
GATE_TYPES = ["GATE_IN", "GATEIN", "GATE_OUT", "GATEOUT"]
YARD_TYPES = ["YARD_MOVE", "YARD_TRANSFER", "RESTACK", "LOAD", "UNLOAD"]
CLEANING_TYPES = ["CLEANING", "WASH", "DRY"]
MNR_TYPES = ["REPAIR", "MAINTENANCE", "MNR", "MNR_ESTIMATE", "MNR_APPROVAL", "MNR_COMPLETE", "MNR_RECEIVED", "MNR_APPROVED", "MNR_REPAIRED"]
INSPECTION_TYPES = ["INSPECTION", "DAMAGE_REPORT"]
TYPES_OF_KIND = {"gate": GATE_TYPES, "yard_move": YARD_TYPES, "inspection": INSPECTION_TYPES, "cleaning": CLEANING_TYPES, "mnr": MNR_TYPES}
IN_TYPES, OUT_TYPES = ["GATE_IN", "GATEIN"], ["GATE_OUT", "GATEOUT"]

DLQ_REASON = "INVALID_JSON_OR_MISSING_CONTAINER"

ENVELOPE = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def payload(topic: str, more: tuple[str, ...] = ()) -> T.StructType:
    """more: fields that a producer has begun to send."""
    return T.StructType([T.StructField(f, T.StringType()) for f in (*TOPIC_FIELDS[topic].split(), *more)])
