"""Layout by day, touched days, footers, offsets, unknown fields, sketches and tallies: what the plans and files say."""

import json
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from yardlake.operators import bronze, health, kpi, upsert
from yardlake.plans.given import at
from yardlake.sources import sinks
from yardlake.sources.envelopes import EnvelopeReader, offset_stream
from yardlake.sources.sinks import DAY, Dated, append_batch, publish, read_appended, read_days
from yardlake.sources.tables import between, on_days, table_stream
from yardlake.streaming import ingest, progress

T0 = datetime(2024, 1, 1)


def events(spark, n=60, hours=7):
    return spark.createDataFrame([(k, T0 + timedelta(hours=hours * k)) for k in range(n)], "k long, t timestamp")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """Files that the scans of a run plan opened, by their metrics."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), []

    def visit(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return visit(node.plan())
        metrics = node.metrics()
        if metrics.contains("numFiles"):
            out.append(metrics.apply("numFiles").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(plan)
    return out


def test_days_prune_folders(spark, tmp_path):
    folder = f"file://{tmp_path}/t"
    for batch in range(2):  # a late-fed table: each batch has all days
        append_batch(events(spark).where(F.col("k") % 2 == batch), folder, batch, day_of="t")
    rows = read_days(spark, folder)
    assert rows.count() == 60 and rows.where(F.col(DAY) != F.to_date("t")).count() == 0
    n_days = rows.select(DAY).distinct().count()
    bound = between(rows, "t", at("2024-01-03 06:00:00"), at("2024-01-05 01:00:00"))
    assert f"PartitionFilters: [isnotnull({DAY}" in plan_of(bound) and files_read(bound) == [2 * 3] and n_days > 15
    assert bound.count() == events(spark).where("t between timestamp'2024-01-03 06:00:00' and timestamp'2024-01-05 01:00:00'").count()
    append_batch(spark.createDataFrame([(date(2024, 1, 2), 1), (date(2024, 1, 9), 5), (date(2024, 1, 11), 6)], "day date, n int"), f"file://{tmp_path}/days", 0)
    picked = on_days(rows, read_appended(spark, f"file://{tmp_path}/days").where("n > 3"), "day")
    assert "dynamicpruning" in plan_of(picked).lower()
    assert max(files_read(picked)) == 2 * 2
    assert sorted(r.k for r in picked.collect()) == sorted(r.k for r in events(spark).where("to_date(t) in ('2024-01-09', '2024-01-11')").collect())
    # as a stream and as appended rows the table is what it was without the layout
    assert read_appended(spark, folder).count() == 60
    seen = []
    table_stream(spark, folder, "k long, t timestamp").writeStream.foreachBatch(lambda df, i: seen.extend(r.k for r in df.collect())).option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert sorted(seen) == list(range(60))


def test_touched_days_only(spark, tmp_path):
    """Files of days that a run does not change keep name and time; absent rows stay; a repeated run writes nothing."""
    rows = [("CT01", date(2024, 1, d), s, d * 10, "first") for d in range(1, 9) for s in ("A", "B")] + [(None, date(2024, 1, 3), "A", 7, "first")]
    df = spark.createDataFrame(rows, "facility string, day date, shift string, value int, computed_at string")
    table, key = Dated(spark, f"file://{tmp_path}/t", df.schema, "day"), ["facility", "day", "shift"]
    rule = lambda t, s: upsert.replace(t, s, key)

    def files():
        return {p.parent.name: {(q.name, q.stat().st_mtime_ns) for q in p.parent.glob("*.parquet")} for p in (tmp_path / "t").glob("day_part=*/*.parquet")}

    assert table.read().count() == 0
    table.upsert(df, rule, ("computed_at",))
    first = files()
    assert len(first) == 8 and table.read().count() == 17
    table.upsert(df.withColumn("computed_at", F.lit("second")), rule, ("computed_at",))
    assert files() == first
    part = spark.createDataFrame([("CT01", date(2024, 1, 5), "A", 999, "third"), ("CT01", date(2024, 1, 6), "A", 60, "third"), (None, date(2024, 1, 3), "A", 8, "third"), ("CT01", date(2024, 2, 1), "A", 1, "third")], df.schema)
    table.upsert(part, rule, ("computed_at",))
    second = files()
    assert {d for d in second if second[d] != first.get(d)} == {"day_part=2024-01-05", "day_part=2024-01-03", "day_part=2024-02-01"}
    got = {(r.facility, r.day.isoformat(), r["shift"]): r.value for r in table.read().collect()}
    assert len(got) == 18 and got["CT01", "2024-01-05", "A"] == 999 and got["CT01", "2024-01-05", "B"] == 50 and got[None, "2024-01-03", "A"] == 8 and got["CT01", "2024-01-03", "B"] == 30
    table.upsert(df.limit(0), rule)
    assert files() == second


def test_health_from_footers(spark, tmp_path):
    rows = events(spark, 500).withColumn("micros", F.unix_micros("t")).withColumn("wide", F.repeat(F.lit("x"), 200))
    rows.select("wide", "k", "micros").repartition(3).write.parquet(f"file://{tmp_path}/t")
    found = health.stored_health(spark, {("silver", "t"): (f"file://{tmp_path}/t", "micros")})
    plan = plan_of(found)
    assert "PushedAggregation: [COUNT(*), MAX(micros)]" in plan
    (r,) = found.collect()
    assert (r.layer, r.table_name, r.n, r.latest) == ("silver", "t", 500, T0 + timedelta(hours=7 * 499))


def envelopes(spark, *offsets):
    """(partition, offset)."""
    rows = spark.createDataFrame([("K", f"{p}-{o}", "t", p, o) for p, o in offsets], "key string, value string, topic string, partition int, offset long")
    return rows.withColumn("timestamp", at("2024-01-01 00:00:00"))


def run_offsets(spark, root, records, seen, **more):
    stream = offset_stream(spark, f"{root}/topic", f"{root}/cp", records, **more)
    q = stream.writeStream.foreachBatch(lambda df, i: seen.append((i, sorted((r.partition, r.offset) for r in df.collect())))).option("checkpointLocation", f"{root}/cp").trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_offsets_bound_a_trigger(spark, tmp_path):
    """Three partitions, 40 records a trigger; started again at the next offset; files that come late and hold several partitions."""
    root, seen = f"file://{tmp_path}", []
    first = [(0, o) for o in range(70)] + [(1, o) for o in range(10)]
    publish(envelopes(spark, *first), f"{root}/topic", 2)
    run_offsets(spark, root, 40, seen)
    assert [len(rows) for _, rows in seen] == [40, 40]
    more = [(1, o) for o in range(10, 15)] + [(2, o) for o in range(60)]
    publish(envelopes(spark, *more), f"{root}/topic", 1)
    run_offsets(spark, root, 40, seen)
    assert [i for i, _ in seen] == list(range(len(seen))) and max(len(rows) for _, rows in seen) <= 40
    assert sorted(x for _, rows in seen for x in rows) == sorted(first + more)
    before = len(seen)
    run_offsets(spark, root, 40, seen)
    assert len(seen) == before


def test_lost_offsets(spark, tmp_path):
    """Offsets that no file holds stop the query, or are passed over."""
    for lenient in (True, False):
        root, seen = f"file://{tmp_path}/{lenient}", []
        publish(envelopes(spark, *[(0, o) for o in range(20) if o not in (3, 4)]), f"{root}/topic", 1)
        if lenient:
            run_offsets(spark, root, 100, seen, fail_on_data_loss=False, starting_offsets={0: 2})
            assert [x for _, rows in seen for x in rows] == [(0, o) for o in range(2, 20) if o not in (3, 4)]
        else:
            with pytest.raises(Exception, match="failOnDataLoss"):
                run_offsets(spark, root, 100, seen)


def test_a_trigger_opens_the_files_that_hold_its_offsets(spark, tmp_path):
    for part in range(6):
        publish(envelopes(spark, *[(0, o) for o in range(10 * part, 10 * part + 10)]), f"file://{tmp_path}/topic", 1)
    reader = EnvelopeReader({"path": f"file://{tmp_path}/topic", "checkpoint": f"file://{tmp_path}/cp", "records": "15"})
    start, ends = reader.initialOffset(), []
    for _ in range(4):
        ends.append(reader.latestOffset())
    assert [e["next"]["0"] for e in ends] == [15, 30, 45, 60]
    assert [len(reader.partitions(a, b)[0].files) for a, b in zip([start, *ends], ends, strict=False)] == [2, 2, 2, 2]


@pytest.mark.parametrize("value,want", [
    ('{"event_id":"1","container_no_raw":"A"}', None), ("{bad", None), (None, None), ("[1]", None),
    ('{"container_no_raw":"A","seal":"S1","n":5,"deep":{"x":[1,{"y":2.5}]},"none":null,"yes":true}', {"seal": "S1", "n": 5, "deep": {"x": [1, {"y": 2.5}]}, "none": None, "yes": True}),
    ('{"container_no_raw":"A","text":"{\\"a\\":1}"}', {"text": '{"a":1}'}),
])
def test_unknown_fields_keep_their_types(spark, value, want):
    df = spark.createDataFrame([(value,)], "v string").select(F.to_json(bronze.unknown(F.col("v"), ["event_id", "container_no_raw"])).alias("u"))
    (r,) = df.collect()
    assert (None if r.u is None else json.loads(r.u)) == want


def test_sketches_of_days_merge_within_their_error(spark):
    """Thousands of stays a day, so that sketches compact: ranks of merged quantiles against all values."""
    rnd = random.Random(3)
    rows = [("CT01", datetime(2024, 1, d, 12), round(rnd.lognormvariate(3, 1), 2)) for d in range(1, 29) for _ in range(1500)]
    df = spark.createDataFrame(rows, "facility string, gate_out_time timestamp, dwell_time_hours double").withColumn("cycle_status", F.lit("CLOSED"))
    days = kpi.dwell_sketches(df).persist()
    assert days.count() == 28 and days.agg(F.max(F.length("dwell_sketch"))).first()[0] < 8000
    told = {"p1": 0.01, "p50": 0.5, "p95": 0.95}
    for period, size in ((F.date_trunc("month", "operational_date"), 28), (F.col("operational_date"), 1)):
        for r in kpi.merged_dwell(days, period, "facility", quantiles=told).collect():
            values = [v for _, t, v in rows if size == 28 or t.date() == r.period]
            assert r.cycles_completed == len(values) == 1500 * size
            for name, q in told.items():
                rank = sum(v <= r[name] for v in values) / len(values)
                assert abs(rank - q) <= 2 * kpi.SKETCH_ERROR, (name, rank)


def test_tallies_of_batches(spark, tmp_path):
    """A batch of every run has a row; what was read twice after a failure counts once."""
    root = f"file://{tmp_path}"
    with progress.progress_table(spark, f"{root}/p") as listener:
        for part in range(3):
            append_batch(spark.range(10 * part, 10 * part + 10), f"{root}/in", part)
            stream = table_stream(spark, f"{root}/in", "id long").observe("seen", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("id") % 2 == 0).alias("even"))
            stream.writeStream.queryName("evens").foreachBatch(lambda df, i: df.count() and None).option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start().awaitTermination()
    rows = progress.read_progress(spark, f"{root}/p")
    assert rows.where("rows_in > 0").count() == 3
    want = {("evens", "rows_in"): 30, ("evens", "dropped_late"): 0, ("evens", "rows"): 30, ("evens", "even"): 15}
    assert {(r.name, r.metric): r.n for r in progress.tallies(rows).collect()} == want
    again = [r.asDict(True) | {"at": "2999-01-01T00:00:00Z", "run_id": "later"} for r in rows.collect()]
    listener.rows = again
    listener.flush()
    assert {(r.name, r.metric): r.n for r in progress.tallies(progress.read_progress(spark, f"{root}/p")).collect()} == want
    assert progress.read_progress(spark, f"{root}/none").count() == 0


def test_late_rows_are_counted(spark, tmp_path):
    root, kinds = f"file://{tmp_path}", "container_no_norm string, event_time_parsed timestamp, event_id_generated string"
    from yardlake.operators import silver

    with progress.progress_table(spark, f"{root}/p"):
        for part, days in enumerate(([0, 20, 21], [1, 2, 22], [3])):
            append_batch(spark.createDataFrame([("A", T0 + timedelta(days=d), f"id{d}") for d in days], kinds), f"{root}/in", part)
            rows = silver.deduplicated(table_stream(spark, f"{root}/in", kinds))
            rows.writeStream.queryName("late").foreachBatch(lambda df, i: df.count() and None).option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start().awaitTermination()
    counts = {r.metric: r.n for r in progress.tallies(progress.read_progress(spark, f"{root}/p")).collect()}
    assert counts["dropped_late"] == 3 and counts["rows_in"] == 7
    assert ingest.ONCE == {"availableNow": True} and sinks.KEEP == 3


def test_a_file_of_a_topic_holds_few_offsets(spark, tmp_path):
    """So that a trigger opens what it takes and not all that there is."""
    import pyarrow.parquet as pq

    rows = spark.range(1000).selectExpr("'k' AS key", "cast(id AS string) AS value", "'raw.gate' AS topic", "cast(id % 2 AS int) AS partition", "id AS offset", "timestamp'2024-06-01' AS timestamp")
    sinks.publish(rows.repartition(3), f"file://{tmp_path}/topic", records=100)
    found = [pq.read_table(f, partitioning=None).to_pandas() for f in (tmp_path / "topic").glob("*.parquet")]
    assert sum(map(len, found)) == 1000 and max(map(len, found)) <= 100
    spans = sorted((f["partition"].min(), f["offset"].min(), f["partition"].max(), f["offset"].max()) for f in found)
    assert all((a[2], a[3]) < (b[0], b[1]) for a, b in zip(spans, spans[1:], strict=False) if a[0] == a[2])


def test_a_trigger_lists_the_topic_once(spark, tmp_path):
    """Also a query that starts with a batch that was planned before finds its files."""
    for part in range(3):
        publish(envelopes(spark, *[(0, o) for o in range(10 * part, 10 * part + 10)]), f"file://{tmp_path}/topic", 1)
    listed = []

    class Reader(EnvelopeReader):
        def files(self):
            listed.append(1)
            return super().files()

    options = {"path": f"file://{tmp_path}/topic", "checkpoint": f"file://{tmp_path}/cp", "records": "15"}
    reader = Reader(options)
    start, end = reader.initialOffset(), reader.latestOffset()
    assert [(p.start, p.end, len(p.files)) for p in reader.partitions(start, end)] == [(0, 15, 2)] and len(listed) == 1
    assert [(p.start, p.end, len(p.files)) for p in Reader(options).partitions(start, end)] == [(0, 15, 2)]


def test_small_batches(spark, tmp_path):
    """Written by the tasks, once, over what a failed attempt left; columns that come later are the table's; a batch without rows is there too."""
    root, seen = f"file://{tmp_path}/t", {}
    os.makedirs(tmp_path / "t" / "_new-0")
    (tmp_path / "t" / "_new-0" / "part-00009.parquet").write_text("left by a failure")
    rows = spark.range(20).select("id", F.timestamp_seconds("id").alias("t")).repartition(3)
    assert sinks.append_batch(rows, root, 0, small=True, seen=seen) and not sinks.append_batch(rows, root, 0, small=True, seen=seen)
    assert sinks.append_batch(rows.where("id < 0"), root, 1, small=True, seen=seen)
    assert sinks.append_batch(rows.withColumn("more", F.lit("x")), root, 2, small=True, seen=seen)
    got = sinks.read_appended(spark, root)
    assert got.columns == ["id", "t", "more"] and got.count() == 40
    assert sorted(got.where("more is null").drop("more").collect()) == sorted(rows.collect())
    assert sorted(f.name for f in (tmp_path / "t").iterdir() if f.name.startswith("batch_id")) == ["batch_id=0", "batch_id=1", "batch_id=2"]
