"""Temperature mixing of sources, realised as budgeted block permutations.

Each source's share of the tokens is raised to an exponent between 0 and 1
and normalised. The exponent is bisected until the weights reach a target
entropy, or until no source is repeated beyond a limit. A source's part of the
budget then is a number of whole passes and the rest of one more; every pass
is a permutation of the source's blocks, and the last one stops where
the budget does.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.llm.common import known
from hearthmill.operators.ordered import running_sums
from hearthmill.sources.shared import settle

BLOCKS = 4096
PROBES = 15


@dataclass(frozen=True)
class Target:
    """What the weights shall reach.

    ``entropy`` is a fraction of that of equal weights. ``repeats`` bounds
    how often a source's tokens are used and wins over the entropy.
    ``budget`` is a number of tokens; None stands for as many tokens as
    there are, and ``cover`` for the least budget that uses every document;
    no source is then used more than ``repeats`` times as often as another.
    """

    entropy: float = 0.9
    repeats: float = 4.0
    budget: float | None = None
    cover: bool = False
    seed: int = 1


def tokens(text: Column) -> Column:
    """Words between blanks; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _measures(totals: DataFrame, exponents: list[float], all_tokens: int, target: Target) -> list[tuple[float, float]]:
    """Entropy of the weights and largest number of repeats for each exponent."""
    probes = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(x)).alias("x")) for i, x in enumerate(exponents)]))
    share = F.col("t") / F.lit(float(all_tokens))
    raised = totals.select(share.alias("p"), probes.alias("e")).withColumn("u", F.pow("p", F.col("e.x")))
    rows = raised.groupBy("e.i").agg(F.sum("u").alias("z"), F.sum(F.col("u") * F.log("u")).alias("ul"), F.max(F.col("u") / F.col("p")).alias("most"), F.min(F.col("u") / F.col("p")).alias("least")).collect()
    budget = float(target.budget or all_tokens)
    found = {}
    for r in rows:
        repeats = r["most"] / r["least"] if target.cover else r["most"] / r["z"] * budget / all_tokens
        found[r["i"]] = (math.log(r["z"]) - r["ul"] / r["z"], repeats)
    return [found[i] for i in range(len(exponents))]


def exponent(totals: DataFrame, all_tokens: int, sources: int, target: Target) -> float:
    """Largest exponent up to 1 that reaches the entropy, raised to the least one within the repeats.

    ``totals`` has one row per source with tokens t. Both measures fall as the
    exponent rises, so each round of ``PROBES`` probes narrows the range 16-fold.
    """

    def bisect(reached) -> float:
        low, high = 0.0, 1.0
        for _ in range(5):
            step = (high - low) / (PROBES + 1)
            probes = [low + step * (i + 1) for i in range(PROBES)]
            measured = _measures(totals, probes, all_tokens, target)
            kept = [x for x, m in zip(probes, measured) if reached(m)]
            low, high = (max(kept), min(high, max(kept) + step)) if kept else (low, probes[0])
        return low

    wanted = target.entropy * math.log(sources)
    natural, flat = _measures(totals, [1.0, 0.0], all_tokens, target)
    chosen = 1.0 if natural[0] >= wanted else bisect(lambda m: m[0] >= wanted)
    if flat[1] > target.repeats and natural[1] <= target.repeats:
        too_often = bisect(lambda m: m[1] > target.repeats)
        chosen = max(chosen, min(1.0, too_often + 16.0**-5))
    return chosen


def plan(docs: DataFrame, target: Target = Target()) -> tuple[DataFrame, DataFrame]:
    """(per source, per document): weights with passes, and each document's number of copies.

    Per document: id, own (hash of the text), source, tokens, block, copies.
    """
    narrow = docs.select(
        known("doc_id").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("own"),
        F.concat(F.lit("s:"), F.col("source").cast("string")).alias("named"), tokens(F.col("text").cast("string")).alias("t"),
    )
    narrow = narrow.select("id", "own", F.coalesce("named", F.lit("null")).alias("key"), "t")
    narrow = settle(narrow.withColumn("block", F.pmod(F.xxhash64("id", "own"), F.lit(BLOCKS))), "mix-rows")
    totals = settle(narrow.groupBy("key").agg(F.sum("t").alias("t")).filter("t > 0"), "mix-sources")
    whole = totals.agg(F.sum("t").alias("t"), F.count("*").alias("n")).first()
    if not whole["n"]:
        return totals.selectExpr("key", "t", "0D as weight", "0L as passes", "0D as rest", "0D as uses"), narrow.limit(0).withColumn("copies", F.lit(0))
    a = exponent(totals, whole["t"], whole["n"], target)
    share = F.col("t") / F.lit(float(whole["t"]))
    raised = totals.withColumn("u", F.pow(share, F.lit(a)))
    sums = raised.agg(F.sum("u").alias("z"), F.max(F.col("t") / F.col("u")).alias("scarce")).first()
    if target.cover:
        # Every source is used once at least; the exponent keeps the others within the repeats.
        uses = F.greatest(F.col("u") / F.col("t") * F.lit(sums["scarce"]), F.lit(1.0))
    else:
        uses = F.least(F.col("u") / F.lit(sums["z"]) * F.lit(float(target.budget or whole["t"])) / F.col("t"), F.lit(float(target.repeats)))
    sources = raised.select("key", "t", (F.col("u") / F.lit(sums["z"])).alias("weight"), F.round(uses, 9).alias("uses"))
    sources = settle(sources.withColumn("passes", F.floor("uses")).withColumn("rest", (F.col("uses") - F.floor("uses")) * F.col("t")), "mix-plan")
    dealt = narrow.filter("t > 0").join(sources.select("key", "passes", "rest"), "key")
    dealt = dealt.withColumn("turn", F.xxhash64(F.lit(target.seed), "key", "passes", "block"))
    dealt = dealt.withColumns({"level1": F.shiftrightunsigned("turn", 56), "level2": F.shiftrightunsigned("turn", 48).bitwiseAND(F.lit(255))})
    dealt = dealt.withColumn("inside", F.xxhash64("id", "own", F.lit(target.seed)))
    summed = running_sums(dealt, ["key"], ["level1", "level2"], ["turn", "inside", "id", "own"], {"reached": F.col("t")})
    copies = (F.col("passes") + F.when(F.col("reached") <= F.col("rest"), 1).otherwise(0)).cast("int")
    return sources, summed.select("id", "own", "key", "t", "block", copies.alias("copies"))


def mixed_rows(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """The documents in their numbers of copies, with mix_copy and mix_position added.

    Sorting by mix_position deals all sources evenly, pass by pass, each pass
    in its own order of blocks. Null sources are a source of their own.
    Documents without words carry no tokens and are left out, since no weight
    can reach them. Rows that repeat count one by one. A column of docs named
    like an added one is replaced.
    """
    sources, counted = plan(docs, target)
    # Rows that repeat share a key: their copies are spread over them by number.
    shared = counted.groupBy("id", "own", "key").agg(F.array_sort(F.collect_list("copies")).alias("copies"), F.first("block").alias("block"))
    chosen = shared.join(sources.select("key", "uses"), "key").filter("aggregate(copies, 0, (s, x) -> s + x) > 0")
    chosen = settle(chosen.select(F.col("id").alias("__id"), F.col("own").alias("__own"), F.col("key").alias("__key"), "copies", "block", "uses"), "mix-copies").toDF(
        "__id", "__own", "__key", "__copies", "__block", "__uses"
    )
    single, several = chosen.filter("size(__copies) = 1"), chosen.filter("size(__copies) > 1")
    kept = [c for c in docs.columns if c not in ("mix_copy", "mix_position")]
    named = F.coalesce(F.concat(F.lit("s:"), F.col("source").cast("string")), F.lit("null"))
    marked = docs.select(*kept).withColumns({"__doc": known("doc_id"), "__hash": F.xxhash64(F.col("text").cast("string")), "__named": named})
    own = (F.col("__doc") == F.col("__id")) & (F.col("__hash") == F.col("__own")) & (F.col("__named") == F.col("__key"))
    found = marked.join(single, own).withColumn("__n", F.get("__copies", F.lit(0)))
    if not several.isEmpty():
        numbered = marked.join(several, own).selectExpr("*", "row_number() over (partition by __id, __own, __key order by __id) as __row")
        found = found.unionByName(numbered.withColumn("__n", F.expr("get(__copies, __row - 1)")).drop("__row"))
    copied = found.filter("__n > 0").withColumn("mix_copy", F.explode(F.expr("sequence(0, __n - 1)")))
    turn = F.shiftrightunsigned(F.xxhash64(F.lit(target.seed), "__key", F.col("mix_copy").cast("long"), "__block"), 11) / F.lit(float(2**53))
    return copied.withColumn("mix_position", (F.col("mix_copy") + turn) / F.col("__uses")).select(*kept, "mix_copy", "mix_position")
