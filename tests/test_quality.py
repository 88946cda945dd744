import datetime

from pyspark.sql import functions as F

from hearthmill.operators import quality, vendors
from hearthmill.plans import cash, ingest, kpis, upkeep

DAY = datetime.date


def test_keys_survive_a_repeated_ingest(spark):
    purchases = [("XXXX-1", "2026-01-01", "coffee", 4.5)] * 2 + [("XXXX-1", "2026-01-01", "tea", 3.0)]
    columns = "account string, day string, description string, amount double"
    one = spark.createDataFrame(purchases, columns).withColumn("file", F.lit("a.csv"))
    two = one.withColumn("file", F.lit("b.csv"))
    natural = ["account", "day", "description", "amount"]
    keyed = quality.with_record_key(one.unionByName(two), natural, within=["file"])
    kept = quality.keep_first(keyed, ["transaction_id"], ["file"])
    assert keyed.count() == 6 and kept.count() == 3
    assert {r["file"] for r in kept.collect()} == {"a.csv"}
    key = kept.first()["transaction_id"]
    assert [len(part) for part in key.split("-")] == [8, 4, 4, 4, 12]
    assert quality.not_loaded(kept, kept, ["transaction_id"]).count() == 0


def test_keys_tell_parts_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a\\", "b"), ("a", "\\b"), ("a", None), ("a", ""), (None, "a"), ("a", "\\N"), ("a", "N")]
    frame = spark.createDataFrame(rows, "x string, y string")
    keys = frame.select(quality.key_uuid([F.col("x"), F.col("y")])).distinct()
    assert keys.count() == len(rows)


def test_timeliness_boundary(spark):
    start = datetime.datetime(2026, 1, 1, 10)
    rows = [(start, start + datetime.timedelta(hours=h)) for h in (0, 48, 49)] + [(start, None)]
    frame = spark.createDataFrame(rows, "received timestamp, processed timestamp")
    got = frame.select(quality.is_timely(F.col("received"), F.col("processed"))).collect()
    assert [r[0] for r in got] == [True, True, False, None]


def test_gate(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None), (-1, None), (None, "b")], "n int, s string")
    decided = ingest.gate(frame, {"positive": F.col("n") > 0, "named": F.col("s").isNotNull()})
    assert [tuple(r) for r in decided.passed.collect()] == [(1, "a")]
    assert sorted(map(tuple, decided.summary.collect())) == [("named", 4, 2), ("positive", 4, 2)]
    assert sorted(r["failed_rules"] for r in decided.quarantine.collect()) == [
        ["named"], ["positive"], ["positive", "named"]
    ]


def test_key_count_with_null_keys(spark):
    frame = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "p"), (None, "q")], "k int, v string")
    got = {r["v"]: r["key_rows"] for r in quality.with_key_count(frame, ["k"]).collect()}
    assert got == {"x": 2, "y": 2, "z": 1, "p": 2, "q": 2}


def test_vendor_rules_first_match_wins(values):
    cells = ["AMZN Mktp US*HT45", "Amazon.com*1", "amzn", "SHELL OIL 48392", "WALMART #1234", "Corner  Shop #12", None]
    assert values(vendors.normalized_vendor, cells) == [
        "Amazon", "Amazon", "Amazon", "Shell", "Walmart", "CORNER SHOP", None
    ]
    rules = [vendors.VendorRule(2, "oil", "Oil"), vendors.VendorRule(1, "SHELL", "First")]
    assert values(lambda c: vendors.matched_vendor(c, rules), ["SHELL oil", "oil", "x"]) == ["First", "Oil", None]


def test_categories(spark, values):
    assert values(vendors.vendor_category, ["Amazon", "nobody", None]) == ["Shopping", "Uncategorized", "Uncategorized"]
    bought = spark.createDataFrame([("A",), ("B",), (None,)], "vendor_normalized string")
    table = spark.createDataFrame([("A", "Food")], "vendor string, category string")
    got = {r["vendor_normalized"]: r["category"] for r in vendors.join_categories(bought, table).collect()}
    assert got == {"A": "Food", "B": "Uncategorized", None: "Uncategorized"}


def test_service_due(spark):
    days = [("car", "2026-01-01"), ("car", "2026-01-01"), ("car", "2026-01-11"), ("car", "2026-01-31"), ("hvac", "2026-03-01")]
    frame = spark.createDataFrame(days, "asset string, day string").withColumn("day", F.to_date("day"))
    got = {r["asset"]: tuple(r)[1:] for r in upkeep.service_due(frame, ["asset"], "day").collect()}
    assert got == {"car": (DAY(2026, 1, 31), 3, 15.0, DAY(2026, 2, 15)), "hvac": (DAY(2026, 3, 1), 1, None, None)}


def test_priorities(values):
    assert values(upkeep.priority_rank, ["Low", "High", "Medium", "none", None]) == [1, 3, 2, None, None]
    assert values(lambda c: upkeep.at_least(c, "Medium"), ["Low", "High", "Medium", "none"]) == [False, True, True, None]


def test_forecast_and_trend_skip_missing_months(spark):
    months = [("a", "2026-01-01", 10.0), ("a", "2026-02-01", 20.0), ("a", "2026-05-01", 90.0), ("a", "2027-01-01", 15.0)]
    frame = spark.createDataFrame(months, "g string, month string, net double").withColumn("month", F.to_date("month"))
    ahead = cash.forecast(frame, ["g"], "net").orderBy("month").collect()
    assert [(r["months_used"], r["forecast_mean"], r["forecast_median"]) for r in ahead] == [
        (0, None, None), (1, 10.0, 10.0), (1, 20.0, 20.0), (0, None, None)
    ]
    change = cash.trend(frame, ["g"], "net").orderBy("month").collect()
    assert [(r["change_mom"], r["change_yoy"]) for r in change] == [(None, None), (10.0, None), (None, None), (None, 5.0)]


def test_kpi_totals(spark):
    frame = spark.createDataFrame([("2026-01-05", 2.0), ("2026-01-06", 3.0), ("2026-02-01", 4.0)], "d string, v double")
    one = kpis.department_kpis(frame, "x", F.to_date("d"), {"spend": F.sum("v"), "records": F.count("*")})
    two = kpis.department_kpis(frame, "y", F.to_date("d"), {"spend": F.sum("v")})
    got = {(r["kpi"], r["department"], r["month"]): (r["value"], r["level"]) for r in kpis.kpi_table([one, two]).collect()}
    assert got[("spend", "x", DAY(2026, 1, 1))] == (5.0, "month")
    assert got[("spend", "y", None)] == (9.0, "department")
    assert got[("spend", None, None)] == (18.0, "all")
    assert got[("records", None, None)] == (3.0, "all")
    assert len(got) == 6 + 3 + 2


def test_kpis_keep_small_figures(spark):
    frame = spark.createDataFrame([("2026-01-05", 0.004), ("2026-02-06", 0.003)], "d string, v double")
    kpi = kpis.department_kpis(frame, "fleet", F.to_date("d"), {"litres": F.sum("v"), "mean": F.avg("v")})
    got = {(r["kpi"], r["level"], r["month"]): r["value"] for r in kpis.kpi_table([kpi]).collect()}
    assert got[("litres", "all", None)] == 0.007 and got[("mean", "month", DAY(2026, 2, 1))] == 0.003


def test_rules_of_a_table_equal_the_chain(spark):
    texts = ["AMZN Mktp", "amazon.com*1 shell", "WAL-MART 12", "walmart", "McDonald's", "city util", "util", "Utilities", "payroll", "xamznx", "a", "", None, "AMZN Mktp"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, description string")
    needles = {1: ["amzn", "amazon.com"], 2: ["wal"], 3: ["shell"], 4: ["mcdonald"], 5: ["util"], 6: [None]}
    rows = [(r.priority, needle, r.pattern, r.vendor) for r in vendors.DEFAULT_RULES for needle in needles[r.priority]]
    rows += [(100 + i, f"needle{i}", f"needle{i}$", f"v{i}") for i in range(10_000)] + [(0, "absent", "absent", "never")]
    rules = spark.createDataFrame(rows, "priority int, needle string, pattern string, vendor string")
    got = vendors.join_rules(df, rules)
    want = df.withColumn("vendor_matched", vendors.matched_vendor(df.description))
    assert sorted(got.select("id", "vendor_matched").collect()) == sorted(want.select("id", "vendor_matched").collect())
    last = vendors.join_rules(spark.createDataFrame([("see needle9999",), ("needle77 x",)], "description string"), rules)
    assert {r["description"]: r["vendor_matched"] for r in last.collect()} == {"see needle9999": "v9999", "needle77 x": None}
    assert {r[1] for r in vendors.join_rules(df.select("description"), rules.limit(0)).collect()} == {None}
