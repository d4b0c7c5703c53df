"""Cycles, upserts and figures on small and on generated rows."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yardlake.operators import cycles, kpi, upsert
from rules import pairs

T0 = datetime(2024, 1, 1)
GATE = "container_no_norm string, facility string, event_time_parsed timestamp, event_type_norm string, truck string"


def gate(spark, rows):
    return spark.createDataFrame([(c, "CT01", T0 + timedelta(hours=h), t, f"T{h}") for c, h, t in rows], GATE)


def test_out_belongs_to_latest_in(spark):
    got = cycles.cycles(gate(spark, [("A", 1, "GATE_IN"), ("A", 3, "GATEIN"), ("A", 4, "GATE_OUT"), ("A", 6, "GATEOUT")])).orderBy("gate_in_time").collect()
    assert [(r.gate_in_time.hour, r.cycle_status, r.gate_out_time and r.gate_out_time.hour, r.dwell_time_hours) for r in got] == [(1, "OPEN", None, None), (3, "CLOSED", 4, 1.0)]


def test_no_gate_events(spark):
    assert cycles.cycles(gate(spark, []).limit(0)).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 20), st.sampled_from(["GATE_IN", "GATE_OUT"])), min_size=1, max_size=25))
def test_window_form_equals_join_form(spark, rows):
    df = gate(spark, rows)
    closed = {tuple(r) for r in cycles.matched(df).select("container_no_norm", "gate_in_time", "gate_out_time").collect()}
    assert closed == {tuple(r) for r in cycles.pair_matches(df).select("container_no_norm", "gate_in_time", "gate_out_time").collect()}
    by_hand = set()
    for c in "AB":
        events = {(h, int(t == "GATE_OUT"), f"T{h}") for x, h, t in rows if x == c}
        by_hand |= {(c, T0 + timedelta(hours=i), T0 + timedelta(hours=o)) for i, (_, o, _) in pairs(events).items() if o is not None}
    assert closed == by_hand
    found = cycles.cycles(df).collect()
    assert len({r.cycle_id for r in found}) == len(found) and all((r.dwell_time_hours or 0) >= 0 for r in found)


def test_silver_parses_each_time_once(spark):
    """Three texts, nine formats; no filter or id makes a parse of its own."""
    from yardlake.operators import silver
    from yardlake.plans import given as feed

    rows = silver.deduplicated(silver.silver(feed.bronze(spark, "/root/testdata/sf0.001", "gate"), "gate"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == 9


def test_inventory_of_overlapping_stays(spark):
    """Against the days of each stay, written out and counted."""
    import random

    rnd = random.Random(1)
    stays = [(f"C{rnd.randrange(6)}", rnd.choice(["CT01", "CT02"]), a := rnd.randrange(-5, 12), None if rnd.random() < 0.2 else a + rnd.randrange(8)) for _ in range(60)]
    rows = [(c, f, T0 + timedelta(days=a, hours=3), None if b is None else T0 + timedelta(days=b, hours=5)) for c, f, a, b in stays]
    df = spark.createDataFrame(rows, "container_no_norm string, facility string, gate_in_time timestamp, gate_out_time timestamp")
    got = {(r.facility, r.operational_date): r.inventory_eod for r in kpi.daily_inventory(df, F.lit("2024-01-11 00:00:00").cast("timestamp"), 10).collect()}
    for f in ("CT01", "CT02"):
        for d in range(11):
            inside = {c for c, g, a, b in stays if g == f and a <= d <= (10 if b is None else b)}
            assert got[f, (T0 + timedelta(days=d)).date()] == len(inside)


def test_upsert_rules(spark):
    t = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    s = spark.createDataFrame([(None, "c"), (2, "d")], "k int, v string")
    got = sorted((tuple(r) for r in upsert.replace(t, s, ["k"]).collect()), key=str)
    assert got == sorted([(1, "a"), (None, "c"), (2, "d")], key=str)
    assert sorted(tuple(r) for r in upsert.insert_only(t.where("k = 1"), spark.createDataFrame([(1, "x"), (3, "y"), (3, "y")], "k int, v string"), ["k"]).collect()) == [(1, "a"), (3, "y")]


def test_daily_inventory_counts_the_out_day(spark):
    row = lambda c, i, o: (c, "CT01", T0 + timedelta(days=i), None if o is None else T0 + timedelta(days=o))
    df = spark.createDataFrame([row("A", 0, 0), row("B", 0, 2), row("C", 1, None)], "container_no_norm string, facility string, gate_in_time timestamp, gate_out_time timestamp")
    got = kpi.daily_inventory(df, F.lit("2024-01-04 00:00:00").cast("timestamp"), 5).orderBy("operational_date").collect()
    assert [r.inventory_eod for r in got] == [0, 0, 2, 2, 2, 1]


def test_daily_figures_read_cycles_once_each(spark, tmp_path):
    """Facilities without a closed cycle, or with none in the calendar, have all their days; the plan reads the cycles once for each of the two figures."""
    rows = [("A", "CT01", 0, 2), ("B", "CT01", 1, 2), ("C", "CT02", 1, None), ("D", "CT03", 9, None), ("E", "CT04", -99, -90), ("F", None, 0, 1)]
    made = [(c, f, T0 + timedelta(days=i), None if o is None else T0 + timedelta(days=o), "OPEN" if o is None else "CLOSED", None if o is None else 24.0 * (o - i)) for c, f, i, o in rows]
    spark.createDataFrame(made, "container_no_norm string, facility string, gate_in_time timestamp, gate_out_time timestamp, cycle_status string, dwell_time_hours double").write.parquet(f"file://{tmp_path}/cycles")
    daily = kpi.daily_kpis(spark.read.parquet(f"file://{tmp_path}/cycles"), F.lit("2024-01-05 00:00:00").cast("timestamp"), 4)
    got = {}
    for r in daily.orderBy("day_ts").collect():
        got.setdefault((r.kpi_type, r.facility), []).append(r.value)
    days = [(T0 + timedelta(days=d)).date() for d in range(5)]
    assert days[-1].isoformat() == "2024-01-05"
    none = [0] * 5
    assert got == {
        **{("DAILY_THROUGHPUT", f): none for f in ("CT02", "CT03", "CT04")}, ("DAILY_THROUGHPUT", "CT01"): [0, 0, 2, 0, 0],
        **{("DAILY_INVENTORY_EOD", f): none for f in ("CT03", "CT04")}, ("DAILY_INVENTORY_EOD", "CT01"): [1, 2, 2, 0, 0], ("DAILY_INVENTORY_EOD", "CT02"): [0, 1, 1, 1, 1],
    }
    assert daily._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2


def test_batch_run_is_repeatable(spark, tmp_path):
    from yardlake.plans import batch, given

    sf, days = "/root/testdata/sf0.001", batch.Lookbacks(daily=40)
    gate_rows, yard_rows = given.clean_events(spark, sf, "gate"), given.clean_events(spark, sf, "yard_move")
    made = cycles.cycles(gate_rows)
    run = lambda n, as_of: batch.run_kpis(spark, gate_rows, yard_rows, made, f"file://{tmp_path}/gold", n, as_of, days)
    plain = lambda row: str([round(x, 6) if isinstance(x, float) else x for x in row])  # noqa: E731  sums of doubles end as they come
    seen = lambda tables: {k: sorted(map(plain, t.read().collect())) for k, t in tables.items()}
    first = seen(run(0, given.as_of()))
    again = run(1, given.as_of())
    assert seen(again) == first and all(first.values())
    assert seen(run(1, given.as_of())) == first
    later = run(2, F.lit("2024-02-02 00:00:00").cast("timestamp"))["gold_kpi_daily"].read()
    assert later.groupBy(*batch.DAILY_KEY).count().where("count > 1").count() == 0
    batch.register_all(spark, "yard_gold", again)
    assert spark.table("yard_gold.gold_kpi_shift").count() == len(first["gold_kpi_shift"])
    spark.sql("DROP SCHEMA yard_gold CASCADE")
