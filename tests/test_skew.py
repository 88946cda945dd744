"""One key holds more than a third of the rows; answers equal brute force."""

import random
import statistics
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hearthmill.operators import medians, ordered, outages, quality
from hearthmill.plans import baselines, cash


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    keys = ["hot"] * 2500 + [f"k{rng.randrange(40)}" for _ in range(2000)] + [None] * 50
    return [(k, i, rng.randrange(30), rng.randrange(-500, 500), rng.gauss(0, 50)) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, id int, day int, cents int, x double").repartition(7)


def test_running_sums_over_levels(frame, rows):
    levelled = frame.withColumn("block", F.floor(F.col("id") / 100))
    got = ordered.running_sums(
        levelled, ["k"], ["day", "block"], ["id"], {"total": F.col("cents"), "n": F.lit(1)}
    )
    want, sums, counts = {}, Counter(), Counter()
    for k, i, _, cents, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        sums[k] += cents
        counts[k] += 1
        want[i] = (sums[k], counts[k])
    assert {r["id"]: (r["total"], r["n"]) for r in got.collect()} == want


def test_running_balance(spark, rows):
    moves = spark.createDataFrame(
        [(k, i, datetime(2026, 1, 1) + timedelta(days=d), c / 100) for k, i, d, c, _ in rows if k],
        "account string, id int, at timestamp, amount double",
    )
    got = cash.running_balance(moves, ["account"], "at", "id", "amount")
    want, sums = {}, Counter()
    for k, i, _, cents, _ in sorted((r for r in rows if r[0]), key=lambda r: (r[2], r[1])):
        sums[k] += cents
        want[i] = sums[k]
    assert {r["id"]: int(r["balance"] * 100) for r in got.collect()} == want


@pytest.mark.parametrize("column", ["x", "cents"])
@pytest.mark.parametrize("broadcast_bytes", ["-1", "10m"])
def test_grouped_median(spark, frame, rows, column, broadcast_bytes, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_bytes)
    place = {"x": 4, "cents": 3}[column]
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row[place])
    got = {r["k"]: (r["median"], r["n_values"]) for r in medians.grouped_median(frame, ["k"], column).collect()}
    assert got == {k: (pytest.approx(statistics.median(v)), len(v)) for k, v in groups.items()}


def test_median_of_a_narrow_band(spark, monkeypatch):
    """Values that share one relative bin are parted by the bin's own range."""
    monkeypatch.setattr(medians, "_SORTED_AT_ONCE", 50)
    rng = random.Random(5)
    cells = [("band", 1e9 + rng.random()) for _ in range(3001)] + [("pair", 1e9), ("pair", 1e9 + 1)] + [("same", 7.5)] * 400
    frame = spark.createDataFrame(cells, "g string, v double").repartition(5)
    groups = defaultdict(list)
    for g, v in cells:
        groups[g].append(v)
    got = {r["g"]: (r["median"], r["n_values"]) for r in medians.grouped_median(frame, ["g"], "v").collect()}
    assert got == {g: (pytest.approx(statistics.median(v), abs=1e-7), len(v)) for g, v in groups.items()}


def test_outage_runs_in_one_burst(spark):
    start = datetime(2026, 1, 1)
    flags = [i % 7 < 3 for i in range(300)]
    cells = [("a", i, start + timedelta(milliseconds=100 * i), good) for i, good in enumerate(flags)]
    frame = spark.createDataFrame(cells, "c string, id int, at timestamp, good boolean").repartition(5)
    got = outages.outage_runs(frame, ["c"], F.col("good"), "at", "id").collect()
    assert sum(r["n_bad"] for r in got) == flags.count(False) and max(r["n_bad"] for r in got) == 4
    assert len(got) == sum(1 for i, good in enumerate(flags) if not good and (i == 0 or flags[i - 1]))


def test_median_of_extremes_and_nulls(spark):
    cells = [("a", v) for v in (1e300, -1e300, 0.0, -0.0, None, 5e-324)] + [("b", None), ("c", 2.0), ("d", 1.0), ("d", 4.0)]
    frame = spark.createDataFrame(cells, "g string, v double")
    got = {r["g"]: r["median"] for r in medians.grouped_median(frame, ["g"], "v").collect()}
    assert got == {"a": 0.0, "c": 2.0, "d": 2.5}


def test_value_bins_keep_order(spark):
    frame = spark.range(-5000, 5000).select((F.col("id") * F.abs("id") / 7.0).alias("v"))
    bins = [r[0] for r in frame.orderBy("v").select(medians.value_bin(F.col("v"))).collect()]
    assert bins == sorted(bins)


def test_anomalies(frame, rows):
    groups = defaultdict(list)
    for k, _, _, _, x in rows:
        groups[k].append(x)
    want = set()
    for k, i, _, _, x in rows:
        middle = statistics.median(groups[k])
        spread = statistics.median(abs(v - middle) for v in groups[k])
        if abs(x - middle) > 3 * 1.4826 * spread:
            want.add(i)
    assert want and {r["id"] for r in baselines.anomalies(frame, ["k"], "x").collect()} == want


def test_occurrences_of_equal_and_unequal_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "_COPIES_PER_RANGE", 7)
    data = [("a", 1, "x")] * 100 + [("a", 1, f"y{i % 5}") for i in range(50)] + [("b", 2, "z")] + [("n", None, "q")] * 3
    frame = spark.createDataFrame(data, "k string, n int, rest string").repartition(5)
    got = quality.number_occurrences(frame, ["k", "n"]).collect()
    assert Counter((r["k"], r["n"], r["rest"]) for r in got) == Counter(data)
    numbers = defaultdict(list)
    for r in got:
        numbers[r["k"], r["n"]].append(r["occurrence"])
    assert {key: sorted(v) for key, v in numbers.items()} == {
        ("a", 1): list(range(1, 151)), ("b", 2): [1], ("n", None): [1, 2, 3]
    }
    again = quality.number_occurrences(frame.repartition(3), ["k", "n"]).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_occurrences_without_other_columns(spark):
    frame = spark.createDataFrame([("a",)] * 5 + [("b",)], "k string")
    got = quality.number_occurrences(frame, ["k"]).collect()
    assert sorted((r["k"], r["occurrence"]) for r in got) == [("a", n) for n in range(1, 6)] + [("b", 1)]


def samples(rng, n):
    start = datetime(2026, 1, 1)
    keys = ["hot"] * n + [f"p{rng.randrange(10)}" for _ in range(n)]
    return [(k, i, start + timedelta(seconds=rng.randrange(10 * 86400)), rng.random() < 0.6) for i, k in enumerate(keys)]


def test_outage_sessions(spark):
    data = samples(random.Random(3), 900)
    data += [("edge", -1, datetime(2026, 1, 1), False), ("edge", -2, datetime(2026, 1, 1, 0, 30), False),
             ("edge", -3, datetime(2026, 1, 1, 1, 0, 0, 1), False)]
    frame = spark.createDataFrame(data, "k string, id int, timestamp timestamp, good boolean")
    want = Counter()
    by_key = defaultdict(list)
    for k, _, at, good in data:
        if not good:
            by_key[k].append(at)
    for k, times in by_key.items():
        times.sort()
        first = last = times[0]
        n = 0
        for at in times:
            if at - last > timedelta(minutes=30):
                want[k, first, last, n] += 1
                first, n = at, 0
            last, n = at, n + 1
        want[k, first, last, n] += 1
    got = outages.outage_sessions(frame.where("not good"), ["k"])
    assert Counter(map(tuple, got.collect())) == want


def test_outage_runs(spark):
    data = samples(random.Random(5), 700)
    frame = spark.createDataFrame(data, "k string, id int, at timestamp, good boolean")
    want = Counter()
    runs = {}
    for k, _, at, good in sorted(data, key=lambda r: (r[0], r[2], r[1])):
        if good:
            if k in runs:
                want[(k, *runs.pop(k))] += 1
        else:
            first, _, n = runs.get(k, (at, at, 0))
            runs[k] = (first, at, n + 1)
    for k, run in runs.items():
        want[(k, *run)] += 1
    got = outages.outage_runs(frame, ["k"], F.col("good"), "at", "id")
    assert Counter(map(tuple, got.collect())) == want


def test_first_per_key_limits_groups_before_the_shuffle(frame):
    first = quality.keep_first(frame, ["k"], ["day", "id"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
