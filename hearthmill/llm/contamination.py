"""Benchmark passages in documents by a prefix-filtered set join, in DataFrame operations only.

An item is cut into windows of ``width`` words (a shorter item is one
window), a window into shingles of ``gram`` words. A window can only occur
where each of its shingles does, so the join needs one shingle per window:
the rarest over all documents. Length and position bounds prune the
candidate places; the words themselves are compared at those that remain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.llm.common import known
from hearthmill.sources.shared import settle

# ASCII characters that separate words, and A-Z: each becomes a blank or its lower-case letter.
_SEPARATORS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCK = 256  # places of a document that are compared together


def words(text: Column) -> Column:
    """Lower-cased words: runs of ASCII letters, digits and all non-ASCII characters."""
    plain = F.translate(text, _SEPARATORS + _CAPITALS, " " * len(_SEPARATORS) + _CAPITALS.lower())
    return F.array_remove(F.split(F.coalesce(plain, F.lit("")), " "), "")


def shingles(tokens: str, gram: int) -> Column:
    """The shingle at each place, its words joined by blanks; a shorter text is one shingle, no text none."""
    parts = ", ".join(f"get({tokens}, i + {k})" for k in range(gram))
    return F.expr(
        f"if(size({tokens}) = 0, cast(array() as array<string>), "
        f"transform(sequence(0, greatest(size({tokens}) - {gram}, 0)), i -> concat_ws(' ', {parts})))"
    )


def _short_spots(tokens: str, length: int) -> Column:
    """Places and shingles of ``length`` words; a text of just that length has it as its whole shingle already."""
    parts = ", ".join(f"get({tokens}, i + {k})" for k in range(length))
    return F.expr(
        f"if(size({tokens}) > {length}, transform(sequence(0, size({tokens}) - {length}), "
        f"i -> struct(i as place, concat_ws(' ', {parts}) as shingle, false as whole)), "
        f"cast(array() as array<struct<place: int, shingle: string, whole: boolean>>))"
    )


def _windows(items: DataFrame, width: int) -> DataFrame:
    """Distinct windows: window (words joined by blanks), length; and which items hold them."""
    cut = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text").cast("string")).alias("w"))
    cut = cut.filter("size(w) > 0").withColumn("s", F.explode(F.expr(f"sequence(0, greatest(size(w) - {width}, 0))")))
    return cut.select("item", F.expr(f"slice(w, s + 1, {width})").alias("w")).select(
        "item", F.array_join("w", " ").alias("window"), F.size("w").alias("length")
    )


def contaminated_words(docs: DataFrame, items: DataFrame, width: int = 13, gram: int = 4) -> DataFrame:
    """One row per row of docs: doc_id, text_hash, n_words, n_hit, item_ids.

    A word is hit inside any occurrence of a window; ``item_ids`` are the
    items with an occurring window, sorted as strings, null if there are
    none. Null and empty texts have no words. Null item ids count as one
    item named by the empty string; equal windows of several items count for
    each. Rows that repeat give a row each, with equal figures. Empty tables
    give no rows or no hits; further columns are not read.
    """
    held = settle(_windows(items, width).distinct(), "windows")
    patterns = held.select("window", "length").distinct().select("window", "length", F.split("window", " ").alias("w"))
    patterns = settle(patterns.select("window", "length", shingles("w", gram).alias("pattern")), "window-shingles", held.count())
    window_shingles = patterns.select("window", F.posexplode("pattern").alias("offset", "shingle"))
    wanted = settle(window_shingles.select("shingle").distinct(), "wanted-shingles", width * held.count())
    # A window below gram words is one shorter shingle; documents are cut into shingles of these lengths too.
    short = sorted(r["length"] for r in patterns.filter(F.col("length") < gram).select("length").distinct().collect())

    own = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    cut = own.select("doc_id", known("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    # A document without words leaves one empty shingle, so that each row of docs is seen at place 0.
    whole = F.transform(
        F.when(F.size("w") == 0, F.array(F.lit(""))).otherwise(shingles("w", gram)),
        lambda s, i: F.struct(i.alias("place"), s.alias("shingle"), F.lit(True).alias("whole")),
    )
    spots = F.concat(whole, *[_short_spots("w", length) for length in short]) if short else whole
    placed = cut.select("doc_id", "id", "text_hash", F.size("w").alias("n_words"), F.inline(spots))
    met = placed.join(wanted.withColumn("known", F.lit(True)), "shingle", "left").filter("place = 0 and whole or known")
    met = settle(met, "met-shingles")

    rarity = met.filter("known").groupBy("shingle").agg(F.count("*").alias("seen"))
    # A window with a shingle that no document holds cannot occur and is dropped here.
    rarest = window_shingles.join(rarity, "shingle", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "offset", "shingle")).alias("rarest")
    )
    prefix = patterns.join(rarest.filter("rarest.seen > 0"), "window").select("window", "length", "pattern", "rarest.offset", "rarest.shingle")
    prefix = settle(prefix, "window-prefixes", held.count())
    # Candidate places by the prefix alone, within the bounds of the document. A document is taken in blocks,
    # each with the places that a window beginning in it may reach, so that a long one is no long list.
    reach = max(width - gram, 0)
    block = max(BLOCK, 2 * reach)
    start = F.col("place") - F.col("offset")
    fits = (start >= 0) & (start + F.col("length") <= F.col("n_words")) & (F.floor(start / block) == F.col("block"))
    blocks = F.expr(f"array_distinct(array(floor(place / {block}), floor(greatest(place - {reach}, 0) / {block})))")
    candidates = met.filter("known").withColumn("block", F.explode(blocks)).join(prefix, "shingle", "left").groupBy("id", "text_hash", "block").agg(
        F.sort_array(F.collect_set(F.when(F.col("whole"), F.struct("place", "shingle")))).alias("spots"),
        F.collect_set(F.when(fits, F.struct(start.alias("start"), "length", "window", "pattern"))).alias("asked"),
    )
    # A window occurs where all its shingles stand one after the other: compared word by word, not by hash.
    # A window of one shingle has been compared by the join.
    at = "slice(spots, greatest(array_position(spots.place, a.start), 1), size(a.pattern))"
    occurs = f"size(a.pattern) = 1 or array_position(spots.place, a.start) > 0 and {at}.shingle = a.pattern and element_at({at}.place, -1) = a.start + size(a.pattern) - 1"
    found = candidates.filter("size(asked) > 0").withColumn("found", F.expr(f"filter(asked, a -> {occurs})")).filter("size(found) > 0")
    spans = "array_distinct(transform(found, a -> struct(a.start as start, a.start + a.length as stop)))"
    # Words inside any window: spans by start, each adding what lies beyond those before it.
    covered = (
        "aggregate(array_sort(array_distinct(flatten(collect_list(spans)))), struct(0 as n, 0 as stop), (s, x) -> "
        "struct(s.n + greatest(x.stop - greatest(x.start, s.stop), 0) as n, greatest(s.stop, x.stop) as stop)).n"
    )
    verified = (
        found.select("id", "text_hash", F.expr(spans).alias("spans"), F.expr("array_distinct(found.window)").alias("windows"))
        .groupBy("id", "text_hash").agg(F.expr(covered).alias("n_hit"), F.expr("array_distinct(flatten(collect_list(windows)))").alias("windows"))
    )
    verified = settle(verified, "verified-windows")
    ids = (
        verified.select("id", "text_hash", F.explode("windows").alias("window"))
        .join(held.select("window", "item"), "window")
        .groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    )
    hits = settle(verified.select("id", "text_hash", "n_hit").join(ids, ["id", "text_hash"]), "hits")
    return (
        met.filter("place = 0 and whole").select("doc_id", "id", "text_hash", "n_words")
        .join(hits, ["id", "text_hash"], "left")
        .select("doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "item_ids")
    )


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """At least one word in twenty is hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns as they are."""
    bad = contaminated_words(docs, items).filter(is_contaminated())
    bad = bad.select(known("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    bad = settle(bad, "contaminated")
    own = (F.col("__doc") == F.col("__id")) & (F.col("__own") == F.col("__hash"))
    marked = docs.withColumn("__doc", known("doc_id")).withColumn("__own", F.xxhash64(F.col("text").cast("string")))
    return marked.join(bad, own, "left_anti").select(*docs.columns)
