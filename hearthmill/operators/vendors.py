"""Vendor names and spend categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.functions.text import strip

UNCATEGORIZED = "Uncategorized"
GRAM = 4  # characters by which rules of a table are found


class VendorRule(NamedTuple):
    priority: int
    pattern: str
    vendor: str


# Spellings of one vendor, and the category of each vendor.
DEFAULT_RULES = [
    VendorRule(1, r"(?i)\bamzn\b|amazon\.com", "Amazon"),
    VendorRule(2, r"(?i)\bwal-?mart\b", "Walmart"),
    VendorRule(3, r"(?i)\bshell\b", "Shell"),
    VendorRule(4, r"(?i)\bmcdonald", "McDonalds"),
    VendorRule(5, r"(?i)\butil(ity|ities)?\b", "Utilities"),
    VendorRule(6, r"(?i)\bpayroll\b", "Payroll"),
]
DEFAULT_CATEGORIES = {
    "Amazon": "Shopping",
    "Walmart": "Groceries",
    "Shell": "Fuel",
    "McDonalds": "Dining Out",
    "Utilities": "Utilities",
    "Payroll": "Income",
}


def cleaned_name(description: Column) -> Column:
    """Description without store numbers and repeated blanks, upper case."""
    words = F.regexp_replace(strip(description), r"[#*]?\d+", " ")
    return F.upper(F.trim(F.regexp_replace(words, r"\s+", " ")))


def matched_vendor(description: Column, rules: Sequence[VendorRule] = DEFAULT_RULES) -> Column:
    """Vendor of the first matching rule, null when none matches."""
    ordered = sorted(rules)
    return reduce(
        lambda found, rule: found.when(description.rlike(rule.pattern), rule.vendor),
        ordered[1:],
        F.when(description.rlike(ordered[0].pattern), ordered[0].vendor),
    )


def normalized_vendor(description: Column, rules: Sequence[VendorRule] = DEFAULT_RULES) -> Column:
    return F.coalesce(matched_vendor(description, rules), cleaned_name(description))


def _grams(text: str) -> str:
    return f"transform(sequence(1, greatest(length({text}) - {GRAM - 1}, 1)), i -> substring({text}, i, {GRAM}))"


def join_rules(df: DataFrame, rules: DataFrame, description: str = "description") -> DataFrame:
    """``vendor_matched`` by a table of rules (``priority``, ``needle``, ``pattern``, ``vendor``) of any number.

    ``needle`` is a text that every match of ``pattern`` holds, in any case.
    A rule is listed under the rarest run of GRAM characters of its needle,
    and a description meets only the rules listed under its own runs. A rule
    whose needle is null or shorter is compared with every description. The
    lowest priority wins, then the first vendor by name. Each text is judged
    once, however many rows have it; null texts and texts without a match get
    null. The plan does not grow with the rules.
    """
    listed = rules.select("priority", "pattern", "vendor", F.lower("needle").alias("needle")).distinct()
    runs = listed.select("*", F.explode(F.expr(f"if(length(needle) >= {GRAM}, {_grams('needle')}, array(''))")).alias("run"))
    shared = runs.groupBy("run").agg(F.count("*").alias("n"))
    index = runs.join(shared, "run").groupBy("priority", "pattern", "vendor", "needle").agg(F.min(F.struct("n", "run")).alias("rarest"))
    index = index.select("priority", "pattern", "vendor", "needle", F.col("rarest.run").alias("run"))
    texts = df.select(F.col(description).alias("text")).filter("text is not null").distinct()
    met = texts.select("text", F.explode(F.expr(f"array_union({_grams('lower(text)')}, array(''))")).alias("run")).join(index, "run")
    met = met.filter("contains(lower(text), coalesce(needle, '')) and rlike(text, pattern)")
    winners = met.groupBy("text").agg(F.min(F.struct("priority", "vendor")).alias("first"))
    winners = winners.select(F.col("text").alias(description), F.col("first.vendor").alias("vendor_matched"))
    return df.join(winners, description, "left")


def vendor_category(vendor: Column, categories: Mapping[str, str] = DEFAULT_CATEGORIES) -> Column:
    """Category from a short list kept in the program."""
    listed = F.create_map(*[F.lit(part) for pair in categories.items() for part in pair])
    return F.coalesce(F.try_element_at(listed, vendor), F.lit(UNCATEGORIZED))


def join_categories(df: DataFrame, categories: DataFrame, vendor: str = "vendor_normalized") -> DataFrame:
    """Category from a table (``vendor``, ``category``) of any size.

    A vendor listed twice takes its first category by name. No broadcast is forced: Spark broadcasts the table if it is small and
    splits a vendor that holds too many rows if it is not.
    """
    lookup = categories.groupBy(F.col("vendor").alias(vendor)).agg(F.min("category").alias("category"))
    return df.join(lookup, vendor, "left").fillna(UNCATEGORIZED, ["category"])
