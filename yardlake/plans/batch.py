"""The periodic batch run: figures from silver and gold tables into gold tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from yardlake.operators import kpi, upsert
from yardlake.sources.sinks import Dated, Snapshots, register

SHIFT_KEY = ["facility", "operational_date", "shift_id", "kpi_type"]
DAILY_KEY = ["facility", "day_ts", "kpi_type", "category"]


@dataclass(frozen=True)
class Lookbacks:
    """Days that each figure looks back."""

    shift: int = 30
    daily: int = 365
    peak: int = 60


def run_kpis(spark: SparkSession, gate: DataFrame, yard: DataFrame, cycles: DataFrame, gold: str, run: int, as_of: Column, lookbacks: Lookbacks = Lookbacks()) -> dict[str, Snapshots | Dated]:
    """Shift and daily figures replace rows of the same key, nulls in it being equal, and rewrite only the days that have changed since
    the last run; the heatmap is made anew. run: this run's number, larger than those before; repeating a run repeats its result."""
    made = {
        "gold_kpi_shift": (kpi.shift_kpis(gate, yard, as_of, lookbacks.shift), SHIFT_KEY),
        "gold_kpi_daily": (kpi.daily_kpis(cycles, as_of, lookbacks.daily), DAILY_KEY),
        "gold_kpi_peak_hours": (kpi.peak_hours(gate, as_of, lookbacks.peak), None),
    }
    out = {}
    for name, (rows, key) in made.items():
        rows = rows.withColumn("computed_at", as_of)
        if key:
            table = Dated(spark, f"{gold}/{name}", rows.schema, key[1])
            table.upsert(rows, lambda t, s, key=key: upsert.replace(t, s, key), ignore=("computed_at",))
        else:
            table = Snapshots(spark, f"{gold}/{name}", rows.schema)
            table.write(rows, run)
        out[name] = table
    return out


def register_all(spark: SparkSession, schema: str, tables: dict[str, Snapshots | Dated]) -> None:
    """Every table as it is now under its name."""
    for name, table in tables.items():
        register(spark, schema, name, table.place)
