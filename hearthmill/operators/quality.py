"""Keys, duplicates, timeliness and the gate before loading."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.operators.ordered import running_sums
from hearthmill.operators.telemetry import first_per_key

TIMELY_HOURS = 48

_SLOTS_PER_KEY = 1 << 16
_COPIES_PER_RANGE = 100_000
_RANGES_PER_DIGEST = 1 << 40


def _key_part(value: Column) -> Column:
    """Text that neither a separator inside a value nor a null can confuse."""
    escaped = F.replace(
        F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")
    )
    return F.coalesce(escaped, F.lit("\\N"))


def key_uuid(parts: Sequence[Column]) -> Column:
    """UUID-shaped digest of the parts; the same parts give the same key."""
    digest = F.sha2(F.concat_ws("|", *[_key_part(part) for part in parts]), 256)
    bounds = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in bounds])


def number_occurrences(
    df: DataFrame, natural_key: Sequence[str], occurrence: str = "occurrence"
) -> DataFrame:
    """Number the rows that share a natural key from 1, by content only.

    Equal rows are counted, not gathered, and a large count is cut into ranges
    that go to different slots. Rows that differ outside the key are ordered
    by a digest and then by their other columns. A repeated ingest of the same
    rows gives the same numbers.
    """
    rest = [name for name in df.columns if name not in natural_key]
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    digest = F.pmod(F.xxhash64(*rest), F.lit(_SLOTS_PER_KEY)) if rest else F.lit(0)
    # Ranges of one digest are numbered after each other, so order is kept.
    starts = F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(_COPIES_PER_RANGE))
    ranges = (
        copies.select("*", F.explode(starts).alias("_start"))
        .withColumn("_copies", F.least(F.col("_copies") - F.col("_start"), F.lit(_COPIES_PER_RANGE)))
        .withColumn("_slot_number", digest * _RANGES_PER_DIGEST + F.floor(F.col("_start") / _COPIES_PER_RANGE))
    )
    numbered = running_sums(
        ranges, natural_key, ["_slot_number"], [*rest, "_start"], {"_last": F.col("_copies")}
    )
    first = F.col("_last") - F.col("_copies") + 1
    return numbered.select(*df.columns, F.explode(F.sequence(first, F.col("_last"))).alias(occurrence))


def with_record_key(
    df: DataFrame,
    natural_key: Sequence[str],
    within: Sequence[str] = (),
    name: str = "transaction_id",
) -> DataFrame:
    """Deterministic key from the natural key and the occurrence number.

    ``within`` (such as the source file) limits the numbering but is not part
    of the key: two equal purchases in one file get two keys, the same
    purchase in two files gets one.
    """
    numbered = number_occurrences(df, [*natural_key, *within])
    return numbered.withColumn(
        name, key_uuid([*[F.col(k) for k in natural_key], F.col("occurrence")])
    )


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``."""
    return first_per_key(df, key, order)


def not_loaded(df: DataFrame, loaded: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key a table does not hold yet."""
    return df.join(loaded.select(*key), list(key), "left_anti")


def is_timely(received: Column, processed: Column, hours: int = TIMELY_HOURS) -> Column:
    return processed <= received + F.make_dt_interval(hours=F.lit(hours))


def timely_rate(df: DataFrame, by: Sequence[str], timely: str = "timely") -> DataFrame:
    """Rows, timely rows and their share per ``by``; rows may be weighted."""
    weight = F.col("weight") if "weight" in df.columns else F.lit(1)
    on_time = F.sum(F.when(F.col(timely), weight).otherwise(0))
    return df.groupBy(*by).agg(
        F.sum(weight).alias("n_rows"),
        on_time.alias("n_timely"),
        (on_time / F.sum(weight)).alias("timely_share"),
    )


def with_key_count(df: DataFrame, key: Sequence[str], name: str = "key_rows") -> DataFrame:
    """How many rows share the key, via the keys that repeat."""
    packed = F.struct(*key).alias("_key")
    repeated = df.groupBy(packed).agg(F.count("*").alias(name)).where(F.col(name) > 1)
    return df.select("*", packed).join(repeated, "_key", "left").drop("_key").fillna(1, [name])


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and with an ``error``; settle the rows first if costly."""
    return df.where("error is null").drop("error"), df.where("error is not null")


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``failed_rules``: names of the rules a row does not meet."""
    checks = [
        F.when(F.coalesce(rule, F.lit(False)), F.lit("")).otherwise(F.lit(name))
        for name, rule in rules.items()
    ]
    return df.withColumn("failed_rules", F.array_remove(F.array(*checks), ""))


def split_gate(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every rule, and the quarantine."""
    failures = F.size("failed_rules")
    return checked.where(failures == 0).drop("failed_rules"), checked.where(failures > 0)


def gate_summary(checked: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Rows and failures per rule, counted in one pass over the rows."""
    counted = checked.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.array_contains("failed_rules", rule)).alias(rule) for rule in rules],
    )
    return counted.unpivot("n_rows", list(rules), "rule", "n_failed").select("rule", "n_rows", "n_failed")
