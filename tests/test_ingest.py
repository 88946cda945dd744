import json

from hearthmill.operators.receipts import extract_receipts
from hearthmill.plans import ingest
from tests.test_ledger import SPLIT_HEADER, SPLIT_ROWS
from tests.test_messages import MAILS
from tests.test_telemetry import DAEMON, PING


def test_statements_are_loaded_once(spark, tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    (files / "a.csv").write_text("\n".join([SPLIT_HEADER, *SPLIT_ROWS, SPLIT_ROWS[0]]))
    (files / "copy.csv").write_text("\n".join([SPLIT_HEADER, *SPLIT_ROWS]))
    (files / "x_3521_0919.csv").write_text("Date,Sub-description,Amount\n2026-01-01,AMZN,-1.00\nnever,AMZN,abc")
    table = str(tmp_path / "out")
    for _ in range(2):
        decided = ingest.ingest_statements(spark, str(files), table)
    loaded = spark.read.parquet(f"{table}/ledger")
    # Five settled rows, one of them bought twice in one file, and one from the other layout.
    assert loaded.count() == 7
    assert loaded.select("transaction_id").distinct().count() == 7
    assert {r["month"] for r in loaded.select("month").distinct().collect()} == {"2026-03", "2026-01"}
    held = decided.quarantine.collect()
    assert [sorted(r["failed_rules"]) for r in held] == [["amount_ok", "date_ok"]]
    assert spark.read.parquet(f"{table}/ledger_quarantine").count() == 1
    summary = {r["rule"]: (r["n_rows"], r["n_failed"]) for r in decided.summary.collect()}
    assert summary == {"date_ok": (8, 1), "amount_ok": (8, 1), "account_masked": (8, 0)}


def logged(spark, table, job, load):
    rows = spark.read.parquet(f"{table}/load_log").where(f"job = '{job}' and load = '{load}'").collect()
    return {r["measure"]: r["n_rows"] for r in rows}


def test_loads_are_counted_and_errors_kept_in_one_log(spark, tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    pending = [row.replace('"Cleared"', '" Pending "') for row in SPLIT_ROWS if '"Cleared"' in row]
    (files / "a.csv").write_text("\n".join([SPLIT_HEADER, *SPLIT_ROWS, *pending, '"1","never","","d","abc","","ok"', SPLIT_ROWS[0] + ',"more"']))
    (files / "b.csv").write_text("Foo,Bar\n1,2")
    table = str(tmp_path / "out")
    for _ in range(2):
        ingest.ingest_statements(spark, str(files), table, load="march")
    assert len(pending) and logged(spark, table, "statements", "march") == {
        "pending": len(pending) + 1, "rows": 6, "unplaced": 3, "amount_unreadable": 1, "date_unreadable": 1,
        "failed_date_ok": 1, "failed_amount_ok": 1, "failed_account_masked": 0,
    }
    transcripts = [
        ("2026-03-24 10:05:00", 0, "64 bytes: time=4.5 ms"), ("2026-03-24 10:20:00", 1, "Request timeout"), ("2026-03-24 12:01:00", 2, ""),
        ("2026-03-24 13:01:00", None, None),
    ]
    pings = spark.createDataFrame(transcripts, "timestamp string, exit_code int, raw_payload string").selectExpr("cast(timestamp as timestamp) as timestamp", "exit_code", "raw_payload")
    documents = [("2026-03-24 10:30:00", '{"ContainersRunning": 3}'), ("2026-03-24 12:30:00", "{broken")]
    daemons = spark.createDataFrame(documents, "timestamp string, raw_payload string").selectExpr("cast(timestamp as timestamp) as timestamp", "raw_payload")
    (tmp_path / "fixture.json").write_text(json.dumps([PING, DAEMON]))
    for _ in range(2):
        observed = ingest.ingest_probes(spark, pings, daemons, str(tmp_path / "fixture.json"), table, load="noon")
    rows = sorted((r["run"].hour, r["source_component"], r["metric_value"], r["from_fixture"]) for r in observed.collect())
    assert rows == [
        (10, "docker_stats", 3.0, False), (10, "router_ping", 4.5, False), (12, "docker_stats", 5.0, True), (12, "router_ping", 3.87, True),
        (13, "docker_stats", 5.0, True), (13, "router_ping", 3.87, True),
    ]
    assert spark.read.parquet(f"{table}/telemetry").count() == 6
    assert logged(spark, table, "probes", "noon") == {"observations": 6, "from_fixture": 4, "rejected": 4, "unresolved": 0}
    errors = {(r["job"], r["error"]): r["n_rows"] for r in spark.read.parquet(f"{table}/error_log").collect()}
    assert errors == {
        ("statements", "unknown layout"): 2, ("statements", "more cells than the header"): 1, ("statements", "rule date_ok"): 1,
        ("statements", "rule amount_ok"): 1, ("probes", "no answer, exit code 1"): 1, ("probes", "no answer, exit code 2"): 1,
        ("probes", "no answer, exit code"): 1, ("probes", "unreadable daemon document"): 1,
    }


def test_messages_are_staged_and_loaded(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for name in ("html", "twin", "nodate"):
        (inbox / f"{name}.eml").write_text(MAILS[name])
    (inbox / "again.eml").write_text(MAILS["html"])
    (inbox / "broken.eml").write_bytes(b"\x89PNG no headers")
    table = str(tmp_path / "out")
    for _ in range(2):
        ingest.ingest_messages(spark, str(inbox), "*.eml", table)
    assert spark.read.option("header", True).option("multiLine", True).csv(f"{table}/staged_bills_csv").count() == 4
    bills = spark.read.parquet(f"{table}/bills")
    assert bills.count() == 3 and "raw_body_text" not in bills.columns
    assert any("[NUMBER]" in r["safe_text"] for r in bills.collect())
    raw = spark.read.parquet(f"{table}/bills_raw")
    assert raw.count() == 3 and any("77776666" in r["raw_body_text"] for r in raw.collect())
    assert spark.read.parquet(f"{table}/bills_quarantine").count() == 1


def test_receipts_keep_their_text(spark, tmp_path):
    texts = spark.createDataFrame([("a", "2016/05/04 9.99"), ("b", "none")], "path string, raw_ocr_text string")
    for _ in range(2):
        ingest.ingest_receipts(texts, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/receipts").count() == 2
    loaded = spark.read.parquet(f"{tmp_path}/receipts")
    assert {r["path"]: (r["raw_ocr_text"], r["date"], r["total_amount"], r["month"]) for r in loaded.collect()} == {
        "a": ("2016/05/04 9.99", "2016-05-04", 9.99, "2016-05"), "b": ("none", None, None, "undated")
    }
    assert extract_receipts(texts).columns == ["path", "raw_ocr_text", "date", "total_amount", "receipt_date"]


def test_telemetry_run_degrades_per_probe(spark, tmp_path):
    newer = {**DAEMON, "timestamp": "2026-03-24T00:00:00Z", "active_containers": 6}
    (tmp_path / "live.jsonl").write_text("\n".join([json.dumps(DAEMON), json.dumps(newer), json.dumps({**DAEMON, "timestamp": "24/03/2026 10:00"}), "{oops"]))
    (tmp_path / "fixture.json").write_text(json.dumps([PING, {**PING, "latency_ms": 9}, DAEMON, {"telemetry_type": "x"}]))
    table = str(tmp_path / "out")
    for _ in range(2):
        observed = ingest.ingest_telemetry(
            spark, str(tmp_path / "live.jsonl"), str(tmp_path / "fixture.json"), table
        )
    rows = sorted((r["source_component"], r["metric_value"], r["from_fixture"]) for r in observed.collect())
    # Two runs, both without a ping.
    assert rows == [("docker_stats", 5.0, False), ("docker_stats", 6.0, False), ("router_ping", 3.87, True), ("router_ping", 3.87, True)]
    assert spark.read.parquet(f"{table}/telemetry").count() == 4
    assert spark.read.parquet(f"{table}/telemetry_unresolved").count() == 0
    assert spark.read.parquet(f"{table}/telemetry_quarantine").count() == 3


def test_array_beyond_the_size_of_a_variant(spark):
    from hearthmill.sources.telemetry_json import explode_samples

    document = "[" + ",".join(json.dumps({**PING, "raw_payload": "x" * 4000}) for _ in range(40_000)) + "]"
    assert len(document) > 128 << 20
    rows = explode_samples(spark.createDataFrame([("a", document)], "path string, document string"))
    assert rows.where("error is null").count() == 40_000


def test_amounts_beyond_cents(spark):
    from hearthmill.plans import baselines, cash

    small = spark.createDataFrame([("a", 0.004)] * 3, "k string, v double")
    assert baselines.baseline(small, ["k"], "v").first()["mean_value"] == 0.004
    cells = [1e17, float("inf"), 1e30, 0.005]
    odd = spark.createDataFrame([("a", v) for v in cells], "k string, v double").selectExpr("*", "date'2026-01-05' as d")
    flow = cash.monthly_flow(odd, ["k"], "d", "v").first()
    assert (flow["net_flow"], flow["n_rows"], flow["n_left_out"]) == (1e17, 4, 2)
