"""What a keyed table becomes when new rows meet it: target, source -> next target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardlake.operators import status
from yardlake.operators.cycles import dwell_hours


def _same(target: DataFrame, source: DataFrame, keys: list[str]):
    out = F.lit(True)
    for k in keys:
        out &= target[k].eqNullSafe(source[k])
    return out


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new keys are added; of a key that source repeats one row stays."""
    s, t = source.alias("s"), target.select(*keys).alias("t")
    new = s.dropDuplicates(keys).join(t, keys, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def replace(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of source take the place of rows of the same key; null keys are equal."""
    return target.join(source, _same(target, source, keys), "left_anti").unionByName(source, allowMissingColumns=True)


def close_cycles(target: DataFrame, matched: DataFrame) -> DataFrame:
    """OPEN cycles with a gate-out not before their gate-in are closed; no row is added.

    matched: cycle_id, gate_out_time, gate_out_truck, once per cycle.
    """
    m = matched.select("cycle_id", F.col("gate_out_time").alias("__out"), F.col("gate_out_truck").alias("__truck"))
    joined = target.join(m, "cycle_id", "left")
    closes = F.coalesce((F.col("cycle_status") == "OPEN") & (F.col("__out") >= F.col("gate_in_time")), F.lit(False))
    new = {"gate_out_time": F.col("__out"), "gate_out_truck": F.col("__truck"), "cycle_status": F.lit("CLOSED"), "dwell_time_hours": dwell_hours(F.col("gate_in_time"), F.col("__out"))}
    return joined.withColumns({c: F.when(closes, v).otherwise(F.col(c)) for c, v in new.items()}).select(*target.columns)


def newest_status(target: DataFrame, source: DataFrame) -> DataFrame:
    """The newest event of a container wins, and of each attribute the newest event that tells it, whichever of them has the container's
    newest event. Both sides are states (status.state()), which keep the order of what told each value; so batches may come in any order,
    interleave and hold equal times. status.visible() shows the rows."""
    return status.merged(target, source)
