"""Files cut into records by several tasks, against reads of whole files."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthmill.operators import ledger
from hearthmill.sources import splits, statements, telemetry_json


@pytest.fixture
def short_splits(spark):
    """Splits of a few hundred bytes, so that records, quotes and escapes fall on their edges."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(name) for name in names]

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield cut
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def plain(rows):
    return sorted((r["path"].rsplit("/", 1)[1], r["error"], r["position"], str(r["sample"]) if r["sample"] is not None else None) for r in rows.collect())


ODD = {
    "empty.json": "", "blank.json": " \n ", "none.json": "[]", "figures.json": "[1, \"}\", null, [2]]", "object.json": '{"a": {"b": 1}}', "word.json": '"text"',
    "cut.json": '[{"a": 1}, {"b": 2', "open.json": '[{"a": 1}', "closed.json": '[{"a": 1}}]', "extra.json": '[{"a": 1},]', "twice.json": '[{"a": 1} {"a": 2}]',
    "comma.json": '[,{"a": 1}]', "late.json": '[{"a": 1}] x', "broken.json": "[{broken", "wrong.json": '[{"a": 1}, {"b": }, {"c": 3}]', "brace.json": '{"a": 1',
    "nested.json": '[[{"a": 1}], {"b": [{"c": "}]"}, {"d": {}}]}, 5, {"e": "\\\\"}, "{", {"f": "\\"}"}, [] ]',
    "spaces.json": ' \n [ \n {"a" : 1 } , \t 7 ,\n "]" , { } \n ] \n',
}


def sample(rng, i):
    texts = ["64 bytes", 'say "hi" {', "}]\\", "[[", "tab\t}", "é\U0001f600}", "\\\"", ""]
    return {"n": i, "raw": rng.choice(texts) * rng.randrange(3), "deep": [{"x": [rng.choice(texts)]}] * rng.randrange(3)}


@pytest.mark.parametrize("size", [293, 10_000_000])
def test_arrays_are_read_as_whole_documents_are(spark, tmp_path, short_splits, size):
    rng = random.Random(size)
    for name, text in ODD.items():
        (tmp_path / name).write_text(text)
    for k in range(2):
        elements = [sample(rng, i) if rng.random() < 0.8 else rng.choice([7, "{no}", [1, {"a": "}"}], None, "]"]) for i in range(60)]
        (tmp_path / f"big{k}.json").write_text(json.dumps(elements, indent=[None, 1][k % 2], ensure_ascii=k == 0))
    folder = str(tmp_path)
    whole = plain(telemetry_json.explode_samples(telemetry_json.read_sample_documents(spark, folder)))
    short_splits(size)
    if size < 1000:
        assert splits.read_pieces(spark, folder, "}").rdd.getNumPartitions() > 20
    assert plain(telemetry_json.read_sample_arrays(spark, folder)) == whole


def test_a_large_array_is_read_by_several_tasks(spark, tmp_path, short_splits):
    rows = [json.dumps({"n": i, "raw": "x" * (i % 700)}) for i in range(40_000)]
    (tmp_path / "large.json").write_text("[" + ",\n".join(rows) + "]")
    short_splits(1_000_000)
    assert splits.read_pieces(spark, str(tmp_path), "}").rdd.getNumPartitions() >= 10
    got = telemetry_json.read_sample_arrays(spark, str(tmp_path)).select("position", F.try_variant_get("sample", "$.n", "int").alias("n"), "error")
    assert got.filter("error is null and n = position").count() == got.count() == 40_000


def test_states_of_quotes_compose():
    rng = np.random.default_rng(0)
    for n in (1, 2, 50):
        closed, opened = rng.integers(0, 2, n), rng.integers(0, 2, n)
        for start in (0, 1):
            state, want = start, []
            for a, b in zip(closed, opened):
                state = b if state else a
                want.append(state)
            assert splits.open_after(start, closed, opened).tolist() == want


HEADER = ["Account Number", "Post Date", "Check", "Description", "Debit", "Credit", "Status"]


def csv_row(rng, i):
    texts = ["RENT", 'BOOKS "R" US', "two\nlines", "a,b\n\n,c", 'ends with quote "', "x" * 90, "", '"', "\n", '",""\n"', '","', '",']
    text = rng.choice(texts).replace('"', '""')
    return ",".join([f'"{i}"', "2026-01-02", "", f'"{text}"', f'"{i}.25"', "", rng.choice(["ok", '"o,k"', '"o\nk"'])])


@pytest.mark.parametrize("size", [211, 10_000_000])
def test_quoted_cells_across_splits(spark, tmp_path, short_splits, size):
    rng = random.Random(size)
    for k in range(3):
        rows = [",".join(f'"{name}"' if k else name for name in HEADER), *[csv_row(rng, 1000 * k + i) for i in range(80)]]
        (tmp_path / f"f{k}.csv").write_text("\n".join(rows) + "\n" * k, newline="\r\n" if k == 1 else "\n")
    whole = ledger.normalize_split(statements.read_layout(spark, str(tmp_path), HEADER))
    columns = ["account_number", "description", "amount", "status", "source_file", "received_ts", "post_date"]
    want = sorted(map(tuple, whole.select(*columns).collect()))
    assert len(want) == 240
    short_splits(size)
    assert size > 1000 or splits.read_pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 40
    got = ledger.read_ledger(spark, str(tmp_path))
    assert got.filter("error is not null").count() == 0
    assert sorted(map(tuple, got.select(*columns).collect())) == want


def test_quotes_inside_plain_cells_are_characters(spark, tmp_path):
    lines = ['5" pipe,1.00,2026-01-01', 'he said "hi",2.00,2026-01-02', '"q""x",3.00,2026-01-03', '"open\nquote",4.00,2026-01-04']
    (tmp_path / "a_1234.csv").write_text("\n".join(["Sub-description,Amount,Date", *lines]))
    rows = ledger.read_ledger(spark, str(tmp_path)).collect()
    assert sorted((r["amount"], r["description"]) for r in rows) == [(1.0, '5" pipe'), (2.0, 'he said "hi"'), (3.0, 'q"x'), (4.0, "open\nquote")]


def test_plan_and_driver_do_not_grow_with_layouts(spark, tmp_path):
    from pyspark.sql import Observation

    def plan_of(folder):
        return len(ledger.read_ledger(spark, str(folder))._jdf.queryExecution().optimizedPlan().toString().split("\n"))

    rng = random.Random(5)
    few, many = tmp_path / "few", tmp_path / "many"
    for folder, n in ((few, 1), (many, 40)):
        folder.mkdir()
        for k in range(n):
            extra = [*HEADER, *[f"Extra {j}" for j in range(k % 4)]]
            rng.shuffle(extra)
            cells = {"Account Number": "9876", "Post Date": "2026-01-01", "Debit": f"{k}", "Status": "pending" if k % 8 == 1 else "ok"}
            (folder / f"s{k}.csv").write_text(",".join(extra) + "\n" + ",".join(cells.get(name, "") for name in extra))
        (folder / "other.csv").write_text("Foo,Bar\n1,2")
        (folder / "x_1111.csv").write_text("Amount,Date,Sub-description\n7,2026-01-01,x")
    assert plan_of(few) == plan_of(many)
    counts = Observation("pending rows")
    rows = ledger.read_ledger(spark, str(many), counts).collect()
    assert sorted(r["amount"] for r in rows if r["error"] is None) == sorted([-float(k) for k in range(40) if k % 8 != 1] + [7.0])
    assert counts.get == {"pending_rows": 5} and sum(r["error"] == "unknown layout" for r in rows) == 2
