"""Raw files to loaded tables: one job per kind of record."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hearthmill.functions import text
from hearthmill.operators import ledger as statements
from hearthmill.operators import messages, quality, receipts, telemetry, vendors
from hearthmill.schemas import BILL_COLUMNS, LEDGER_COLUMNS, OBSERVATION_COLUMNS
from hearthmill.sources import documents, sinks, telemetry_json
from hearthmill.sources.shared import settle
from hearthmill.sources.statements import FILE_COLUMN


class Gated(NamedTuple):
    """Rows that may be loaded, rows held back, and failures per rule."""

    passed: DataFrame
    quarantine: DataFrame
    summary: DataFrame


def gate(df: DataFrame, rules: dict) -> Gated:
    checked = settle(quality.apply_rules(df, rules), "checked")
    passed, quarantine = quality.split_gate(checked)
    return Gated(passed, quarantine, quality.gate_summary(checked, list(rules)))


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """A written table, or None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_once(df: DataFrame, path: str, key: Sequence[str] = ()) -> None:
    """Append held-back rows, each content once; ``row_id`` keeps a repeat from adding any."""
    keyed = df.withColumn("row_id", quality.key_uuid([F.col(name) for name in key or df.columns]))
    once = settle(keyed.dropDuplicates(["row_id"]), "held-back")
    loaded = existing(df.sparkSession, path)
    new = once if loaded is None else quality.not_loaded(once, loaded, ["row_id"])
    new.write.mode("append").parquet(path)


def append_new(df: DataFrame, path: str, date: str, key: str) -> None:
    """Append the rows whose key the table lacks, so a repeat adds nothing."""
    loaded = existing(df.sparkSession, path)
    if loaded is not None:
        # The key fixes the month, so only the batch's own months are read.
        months = [row[0] for row in df.select(sinks.month_of(date)).distinct().collect()]
        df = quality.not_loaded(df, loaded.where(F.col("month").isin(months)), [key])
    sinks.write_monthly(df, path, date)


def log_load(spark: SparkSession, table: str, job: str, load: str | None, counts: dict[str, int]) -> None:
    """Write a load's counts to ``load_log``; a load that is repeated under its name replaces them."""
    rows = [(name, int(n or 0)) for name, n in counts.items()]
    folder = f"{table}/load_log/job={job}/load={load or uuid.uuid4().hex}"
    spark.createDataFrame(rows, "measure string, n_rows long").coalesce(1).write.mode("overwrite").parquet(folder)


def log_errors(rejected: DataFrame, table: str, job: str, source: str) -> None:
    """Add to ``error_log``, one table for all jobs, how often each source failed and why."""
    found = rejected.groupBy(F.lit(job).alias("job"), F.col(source).cast("string").alias("source"), "error").agg(F.count("*").alias("n_rows"))
    append_once(found, f"{table}/error_log")


def count_rows(df: DataFrame, **conditions: Column) -> dict[str, int]:
    """Rows that meet each condition, in one pass."""
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()]).first().asDict()


def ledger_entries(ledger: DataFrame) -> DataFrame:
    """Ledger rows with vendor, category and key, each purchase once."""
    described = ledger.withColumn("vendor_normalized", vendors.normalized_vendor(F.col("description")))
    described = described.withColumn("category", vendors.vendor_category(F.col("vendor_normalized")))
    keyed = quality.with_record_key(described, LEDGER_COLUMNS, within=[FILE_COLUMN])
    return quality.keep_first(keyed, ["transaction_id"], ["received_ts", FILE_COLUMN])


LEDGER_RULES = {
    "date_ok": lambda: F.col("post_date").isNotNull(),
    "amount_ok": lambda: F.col("amount_ok"),
    "account_masked": lambda: F.col("account_number").rlike(r"^XXXX-(\d{1,4}|REDACTED)$"),
    "vendor_known": lambda: vendors.matched_vendor(F.col("description")).isNotNull(),
    "on_time": lambda: quality.is_timely(F.col("received_ts"), F.current_timestamp()),
}


def ingest_statements(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: str,
    rules: Sequence[str] = ("date_ok", "amount_ok", "account_masked"),
    load: str | None = None,
) -> Gated:
    """Statements to a ledger table by month; returns what was decided.

    ``load`` names the load in ``load_log``, which gets its counts.
    """
    pending = Observation(f"pending {uuid.uuid4().hex}")
    rows = settle(statements.read_ledger(spark, paths, pending), "ledger-rows")
    ledger, unplaced = quality.split_errors(rows)
    is_row = F.col("error").isNull()
    counts = {
        "pending": pending.get["pending_rows"],
        **count_rows(
            rows, rows=is_row, unplaced=~is_row, amount_unreadable=is_row & ~F.col("amount_ok"),
            date_unreadable=is_row & F.col("post_date").isNull(),
        ),
    }
    decided = gate(ledger_entries(ledger.drop("record")), {rule: LEDGER_RULES[rule]() for rule in rules})
    append_new(decided.passed, f"{table}/ledger", "post_date", "transaction_id")
    append_once(decided.quarantine, f"{table}/ledger_quarantine", ["transaction_id"])
    unplaced = unplaced.withColumn("record", text.mask_personal_data(F.col("record")))
    append_once(unplaced.select(FILE_COLUMN, "record", "error"), f"{table}/ledger_unplaced")
    log_errors(unplaced, table, "statements", FILE_COLUMN)
    held = decided.quarantine.withColumn("error", F.explode(F.transform("failed_rules", lambda rule: F.concat(F.lit("rule "), rule))))
    log_errors(held, table, "statements", FILE_COLUMN)
    counts |= {f"failed_{r['rule']}": r["n_failed"] for r in decided.summary.collect()}
    log_load(spark, table, "statements", load, counts)
    return decided


def ingest_messages(spark: SparkSession, folder: str, pattern: str, table: str, load: str | None = None) -> DataFrame:
    """E-mail files to staged bills (CSV handover and table by month).

    Two tables are kept: the raw one with restricted access, and a masked one
    for everything downstream. No matching file is an error before any write.
    """
    found = documents.read_documents(spark, folder, pattern)
    captured, rejected = quality.split_errors(settle(messages.extract_bills(found), "bills"))
    sinks.stage_bills_csv(captured, f"{table}/staged_bills_csv")
    content = [F.col(name) for name in BILL_COLUMNS]
    keyed = captured.withColumn("bill_id", quality.key_uuid(content))
    once = settle(quality.keep_first(keyed, ["bill_id"], ["received_ts", "path"]), "bills-once")
    append_new(once, f"{table}/bills_raw", "date", "bill_id")
    masked = once.withColumns(
        {"safe_text": text.mask_personal_data(F.col("raw_body_text")), "subject": text.mask_personal_data(F.col("subject"))}
    )
    append_new(masked.drop("raw_body_text"), f"{table}/bills", "date", "bill_id")
    append_once(rejected.select("path", "received_ts", "error"), f"{table}/bills_quarantine")
    log_errors(rejected, table, "messages", "path")
    no = {f"no_{name}": F.col(name).isNull() for name in ("date", "subject", "total_amount")}
    counts = {"messages": captured.count(), "rejected": rejected.count(), **count_rows(captured, **no)}
    log_load(spark, table, "messages", load, counts)
    return captured


def ingest_receipts(ocr_texts: DataFrame, table: str) -> DataFrame:
    """Receipt texts (``path``, ``raw_ocr_text``) to a table by month."""
    found = receipts.extract_receipts(ocr_texts)
    identity = [F.col("path"), F.col("raw_ocr_text")]
    keyed = found.withColumn("receipt_id", quality.key_uuid(identity))
    once = settle(quality.keep_first(keyed, ["receipt_id"], ["path"]), "receipts")
    append_new(once, f"{table}/receipts", "receipt_date", "receipt_id")
    return found


COMPONENTS = ("router_ping", "docker_stats")


def ingest_telemetry(
    spark: SparkSession, live_paths: str | Sequence[str], fixture_path: str, table: str,
    components: Sequence[str] = COMPONENTS, run: str = "1 hour", load: str | None = None,
) -> DataFrame:
    """Every good sample, with the fixture's row for a probe silent during a run.

    A run is a window of that length which holds a sample of any probe.
    """
    lines = telemetry.project_samples(telemetry_json.read_sample_lines(spark, live_paths))
    live, bad = quality.split_errors(settle(lines, "live-samples"))
    return _load_observations(spark, live, bad, fixture_path, table, components, run, "telemetry", load)


def ingest_probes(
    spark: SparkSession, pings: DataFrame, daemons: DataFrame, fixture_path: str, table: str,
    components: Sequence[str] = COMPONENTS, run: str = "1 hour", load: str | None = None,
) -> DataFrame:
    """Ping transcripts and daemon documents to the same table as samples.

    ``pings`` has timestamp, exit_code and raw_payload, ``daemons`` timestamp
    and raw_payload. Unanswered probes and unreadable documents are kept with
    their ``error``; the fixture stands in for them in runs without another
    sample of the component. They count as runs of their own.
    """
    seen = ["timestamp", "source_component", "metric_name", "metric_value", "status", "raw_payload", "error"]
    results = telemetry.ping_results(pings).select(*seen).unionByName(telemetry.daemon_results(daemons).select(*seen))
    live, bad = quality.split_errors(settle(results, "probe-results"))
    kept = bad.select("error", F.col("raw_payload").alias("record"), "timestamp", "source_component")
    return _load_observations(spark, live, kept, fixture_path, table, components, run, "probes", load, tried=bad.select("timestamp"))


def _load_observations(
    spark: SparkSession, live: DataFrame, bad: DataFrame, fixture_path: str, table: str, components: Sequence[str], run: str,
    job: str, load: str | None, tried: DataFrame | None = None,
) -> DataFrame:
    arrays = telemetry.project_samples(telemetry_json.read_sample_arrays(spark, fixture_path))
    fixture, bad_fixture = quality.split_errors(settle(arrays, "fixture-samples"))
    values = ["timestamp", "metric_name", "metric_value", "status", "raw_payload"]
    key = ["source_component"]
    in_run = F.window("timestamp", run)["start"].alias("run")
    live = live.select(in_run, *key, *values)
    runs = live.select("run") if tried is None else live.select("run").union(tried.where("timestamp is not null").select(in_run))
    runs = settle(runs.distinct(), "runs")
    if runs.isEmpty():
        runs = spark.range(1).select(F.lit(None).cast("timestamp").alias("run"))
    expected = runs.select("run", F.explode(F.array(*[F.lit(name) for name in components])).alias(key[0]))
    silent = expected.join(live.select("run", *key).distinct(), ["run", *key], "left_anti")
    backup = telemetry.with_fallback(
        silent, live.limit(0), fixture.select(*key, *values, "path", "position"), key, ["path", "position"], run=["run"]
    )
    own = live.withColumns({"from_fixture": F.lit(False), "error": F.lit(None).cast("string")})
    resolved, unresolved = quality.split_errors(settle(own.unionByName(backup), "observations"))
    # A fixture row stands for a run, so the run is part of its key.
    content = [*[F.col(name) for name in OBSERVATION_COLUMNS], F.when(F.col("from_fixture"), F.col("run"))]
    keyed = quality.keep_first(resolved.withColumn("log_id", quality.key_uuid(content)), ["log_id"], ["run"])
    append_new(settle(keyed, "telemetry-once"), f"{table}/telemetry", "timestamp", "log_id")
    append_once(unresolved, f"{table}/telemetry_unresolved")
    failed = bad.unionByName(bad_fixture, allowMissingColumns=True).drop("sample")
    append_once(failed, f"{table}/{job}_quarantine")
    log_errors(failed.withColumn("source", F.coalesce(*[F.col(c) for c in ("path", "source_component") if c in failed.columns])), table, job, "source")
    log_errors(unresolved, table, job, "source_component")
    observed = count_rows(resolved, observations=F.lit(True), from_fixture=F.col("from_fixture"))
    log_load(spark, table, job, load, {**observed, "rejected": failed.count(), "unresolved": unresolved.count()})
    return resolved
