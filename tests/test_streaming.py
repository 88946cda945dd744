import json
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from hearthmill.operators.outages import outage_runs
from hearthmill.streaming import telemetry as streaming
from hearthmill.streaming.runs import outage_runs_to_table

SCHEMA = "event_id long, ts timestamp, component string, good boolean"


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"event_id": i, "ts": at.isoformat() + ".000000Z", "component": c, "good": g}) for i, at, c, g in rows]
    (folder / name).write_text("\n".join(lines))


def raw_stream(spark, folder, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return streaming.read_sample_stream(spark, str(folder), schema, **options)


def stream(spark, folder, **options):
    samples = streaming.readable(raw_stream(spark, folder, **options), "ts")
    return streaming.without_duplicates(samples, ["event_id"], "ts")


def test_duplicates_within_and_across_files(spark, tmp_path):
    start = datetime(2026, 1, 1)
    rows = [(i, start + timedelta(minutes=20 * i), "a", i % 3 != 0) for i in range(12)]
    write(tmp_path / "in", "1.json", rows + rows[:5])
    write(tmp_path / "in", "2.json", rows[3:])
    result = streaming.uptime_stream(stream(spark, tmp_path / "in"), ["component"], F.col("good"), "ts")
    got, _ = streaming.run_to_table(result, "complete", "t")
    assert sorted((r["window_start"].hour, r["n_samples"], r["n_good"]) for r in got.collect()) == [
        (0, 3, 2), (1, 3, 2), (2, 3, 2), (3, 3, 2)
    ]


def test_append_shows_closed_windows_only(spark, tmp_path):
    start = datetime(2026, 1, 1)
    write(tmp_path / "in", "1.json", [(1, start, "a", True), (2, start + timedelta(hours=60), "a", True)])
    result = streaming.uptime_stream(stream(spark, tmp_path / "in"), ["component"], F.col("good"), "ts")
    got, _ = streaming.run_to_table(result, "append", "t")
    assert [r["window_start"] for r in got.collect()] == [start]


def test_late_rows_are_counted(spark, tmp_path):
    start = datetime(2026, 1, 1)
    # A batch judges lateness by the watermark the batch before it started with.
    for place, hours in enumerate([60, 59, 0]):
        write(tmp_path / "in", f"{place}.json", [(place, start + timedelta(hours=hours), "a", True)])
        os.utime(tmp_path / "in" / f"{place}.json", (1e9 + place, 1e9 + place))
    samples = streaming.readable(raw_stream(spark, tmp_path / "in", files_per_batch=1), "ts")
    result = streaming.uptime_stream(samples.withWatermark("ts", streaming.WATERMARK), ["component"], F.col("good"), "ts")
    got, query = streaming.run_to_table(result, "update", "t")
    assert streaming.late_rows(query) == 1
    assert sorted(r["window_start"] for r in got.collect()) == [start + timedelta(hours=59), start + timedelta(hours=60)]


def test_broken_lines_go_their_own_way(spark, tmp_path):
    write(tmp_path / "in", "1.json", [(1, datetime(2026, 1, 1), "a", True)])
    (tmp_path / "in" / "2.json").write_text('{broken\n{"event_id": "x"}\n{"event_id": 5}')
    result = streaming.uptime_stream(stream(spark, tmp_path / "in"), ["component"], F.col("good"), "ts")
    assert streaming.run_to_table(result, "complete", "t")[0].first()["n_samples"] == 1
    bad, _ = streaming.run_to_table(streaming.unreadable(raw_stream(spark, tmp_path / "in"), "ts"), "append", "bad")
    assert sorted(str(r["record"]) for r in bad.collect()) == ["None", '{"event_id": "x"}', "{broken"]


def test_sessions(spark, tmp_path):
    start = datetime(2026, 1, 1)
    minutes = [0, 20, 45, 200, 229]
    write(tmp_path / "in", "1.json", [(m, start + timedelta(minutes=m), "a", False) for m in minutes] + [(999, start, "a", True)])
    result = streaming.outage_stream(stream(spark, tmp_path / "in"), ["component"], F.col("good"), "ts")
    got, _ = streaming.run_to_table(result, "complete", "t")
    assert sorted((r["outage_start"].minute, r["outage_end"].minute, r["n_bad"]) for r in got.collect()) == [
        (0, 45, 3), (20, 49, 2)
    ]


def probe_run(spark, tmp_path):
    samples = stream(spark, tmp_path / "in", files_per_batch=1)
    samples = samples.withColumns({"metric_value": F.lit(1.0), "status": F.lit("ONLINE")})
    closed = streaming.probe_windows(samples, "component", F.col("good"), "ts")
    fixture = spark.createDataFrame([("a", 7.0, "BACKUP")], "component string, metric_value double, status string")
    fill = lambda batch, reached: streaming.fill_closed_windows(batch, fixture.select("component"), fixture, "component", filled_to=reached)
    return streaming.run_to_table(closed, "append", "probe", fill, folder=str(tmp_path / "run"), reaches="window_start")[0]


def test_absent_windows_between_batches_and_runs(spark, tmp_path):
    start = datetime(2026, 1, 1)
    deliveries = [[0, 1, 2], [5, 6, 7], [52], [60], [130]]
    for place, hours in enumerate(deliveries):
        if place == 3:  # the stream stops here and starts again
            probe_run(spark, tmp_path)
        write(tmp_path / "in", f"{place}.json", [(h, start + timedelta(hours=h), "a", True) for h in hours])
        os.utime(tmp_path / "in" / f"{place}.json", (1e9 + place, 1e9 + place))
    rows = probe_run(spark, tmp_path).collect()
    hours = {round((r["window_start"] - start).total_seconds() / 3600): r["status"] for r in rows}
    assert sorted(hours) == list(range(61)) and len(rows) == 61
    assert {h for h, status in hours.items() if status == "ONLINE"} == {0, 1, 2, 5, 6, 7, 52, 60}
    assert sorted(map(repr, probe_run(spark, tmp_path).collect())) == sorted(map(repr, rows))


def test_empty_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    result = streaming.uptime_stream(stream(spark, tmp_path / "in"), ["component"], F.col("good"), "ts")
    got, query = streaming.run_to_table(result, "complete", "t")
    assert got.count() == 0 and streaming.late_rows(query) == 0


def outage_samples(start):
    """Runs within hours, across hours, across empty hours, out of order, with ties, and one that nothing ends."""
    minutes = {"a": [(0, 1), (3, 0), (9, 0), (12, 1), (50, 0), (63, 0), (70, 1), (130, 0), (400, 0), (401, 1), (402, 0)], "b": [(0, 0), (59, 0), (60, 0), (119, 0), (500, 1), (505, 1), (580, 0)]}
    minutes["c"] = [(i, int(i % 7 != 3 and i % 90 < 60)) for i in range(0, 700, 2)]
    return [(1000 * k + i, start + timedelta(minutes=m), name, bool(good)) for k, (name, rows) in enumerate(minutes.items()) for i, (m, good) in enumerate(rows)]


def test_runs_of_a_stream_equal_runs_of_a_table(spark, tmp_path):
    start = datetime(2026, 1, 1)
    rows = outage_samples(start)
    rows += [(5000, start + timedelta(minutes=63), "a", True), (5001, start + timedelta(minutes=63), "a", False)]
    late = [(9000 + k, start + timedelta(hours=70 + k), "d", True) for k in range(4)]
    shuffled = sorted(rows, key=lambda r: (r[0] * 7919) % 1009)
    # Batches out of order within the watermark, then samples that move it on in steps.
    steps = [shuffled[:150], shuffled[150:], late[:1], late[1:2], [(9100, start + timedelta(hours=56), "z", True)], late[2:]]
    runs = None
    for place, part in enumerate(steps):
        write(tmp_path / "in", f"{place}.json", part)
        os.utime(tmp_path / "in" / f"{place}.json", (1e9 + place, 1e9 + place))
        if place in (2, 5):  # the stream stops after the third delivery and starts again
            samples = stream(spark, tmp_path / "in", files_per_batch=1)
            runs, opened, _ = outage_runs_to_table(samples, ["component"], F.col("good"), "ts", "event_id", folder=str(tmp_path / "run"))
    table = spark.createDataFrame(rows, "event_id long, ts timestamp, component string, good boolean")
    want = outage_runs(table, ["component"], F.col("good"), "ts", "event_id")
    every = runs.unionByName(opened).select(*want.columns)
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, want.collect()))
    assert {r["component"] for r in opened.collect()} == {"a", "b"} | ({"c"} if not rows[-3][3] else set())
