import json

from hearthmill.operators import telemetry
from hearthmill.operators.quality import split_errors
from hearthmill.sources import telemetry_json

PING = {
    "timestamp": "2026-03-06T05:00:00Z", "target": "10.0.0.1", "telemetry_type": "router_ping",
    "status": "ONLINE", "latency_ms": 3.87, "raw_payload": "64 bytes time=3.87 ms",
}
DAEMON = {
    "timestamp": "2026-03-06T05:00:01Z", "target": "d", "telemetry_type": "docker_stats",
    "status": "HEALTHY", "active_containers": 5, "raw_payload": '{"up": 5}',
}


def documents(spark, *texts):
    return spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "path string, document string")


def test_samples_of_a_json_array(spark):
    array = json.dumps([PING, 5, "{not an object", [1], None, DAEMON])
    found = telemetry.project_samples(telemetry_json.explode_samples(documents(spark, array)))
    good, bad = split_errors(found)
    rows = telemetry.displayed(good.orderBy("position")).collect()
    assert [tuple(r) for r in rows] == [
        ("2026-03-06T05:00:00Z", "router_ping", "latency_ms", 3.87, "ONLINE", PING["raw_payload"]),
        ("2026-03-06T05:00:01Z", "docker_stats", "active_containers", 5.0, "HEALTHY", DAEMON["raw_payload"]),
    ]
    assert bad.count() == 0
    assert [r["position"] for r in good.orderBy("position").collect()] == [0, 5]


def test_unusable_samples_and_documents(spark):
    faulty = [
        {**PING, "telemetry_type": "disk"}, {k: v for k, v in PING.items() if k != "status"},
        {**PING, "latency_ms": "fast"}, {**DAEMON, "active_containers": 4.5}, {**PING, "raw_payload": {"a": 1}},
        {k: v for k, v in PING.items() if k != "raw_payload"}, {k: v for k, v in PING.items() if k != "telemetry_type"},
        {k: v for k, v in PING.items() if k != "latency_ms"},
    ]
    found = telemetry.project_samples(
        telemetry_json.explode_samples(documents(spark, json.dumps(faulty), json.dumps(PING), "[broken", "[]"))
    )
    good, bad = split_errors(found)
    assert good.count() == 0
    rows = {(r["path"], r["position"]): r["error"] for r in bad.collect()}
    assert rows == {
        ("f0", 0): "unknown telemetry_type disk", ("f0", 1): "missing field", ("f0", 2): "unreadable figure",
        ("f0", 3): "unreadable figure", ("f0", 4): "payload is not text", ("f0", 5): "payload is not text",
        ("f0", 6): "no telemetry_type", ("f0", 7): "unreadable figure",
        ("f1", None): "root is not a list", ("f2", None): "not JSON",
    }
    assert json.loads(bad.where("position = 0").first()["record"])["telemetry_type"] == "disk"


def test_text_figures_are_read(spark):
    array = json.dumps([{**PING, "latency_ms": " 4.5 "}, {**DAEMON, "active_containers": "7"}])
    found = telemetry.project_samples(telemetry_json.explode_samples(documents(spark, array)))
    assert [r["metric_value"] for r in found.orderBy("position").collect()] == [4.5, 7.0]


def test_json_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([PING, DAEMON], indent=1))
    (tmp_path / "b.jsonl").write_text(json.dumps(PING) + "\n{oops\n" + json.dumps(DAEMON) + "\n")
    array = telemetry_json.explode_samples(telemetry_json.read_sample_documents(spark, str(tmp_path / "a.json")))
    assert telemetry.project_samples(array).where("error is null").count() == 2
    lines = telemetry.project_samples(telemetry_json.read_sample_lines(spark, str(tmp_path / "b.jsonl")))
    assert sorted(str(r["error"]) for r in lines.collect()) == ["None", "None", "not JSON"]


def test_silent_probe_takes_the_first_fixture_row(spark):
    expected = spark.createDataFrame([("ping",), ("docker",), ("ups",)], "component string")
    live = spark.createDataFrame([("docker", 9.0, "HEALTHY")], "component string, v double, status string")
    fixture = spark.createDataFrame(
        [("ping", 2, 2.0, "B"), ("ping", 1, 1.0, "A"), ("docker", 0, 0.0, "C")],
        "component string, position int, v double, status string",
    )
    found = telemetry.with_fallback(expected, live, fixture, ["component"], ["position"])
    rows = {r["component"]: tuple(r)[1:] for r in found.collect()}
    assert rows == {
        "ping": (1.0, "A", True, None), "docker": (9.0, "HEALTHY", False, None),
        "ups": (None, None, None, "no live sample and no fixture row"),
    }


def test_ping_needs_reply_and_exit_code(spark):
    rows = spark.createDataFrame(
        [(0, "time=1.5 ms"), (1, "time=1.5 ms"), (0, "no reply")], "exit_code int, raw_payload string"
    )
    (sample,) = telemetry.ping_observations(rows).collect()
    assert (sample["metric_value"], sample["status"], sample["raw_payload"]) == (1.5, "ONLINE", "time=1.5 ms")
