"""Reply trees to chat text: paths from root to leaf, ranked and formatted.

Ancestors are found by iterative self-joins that double their reach: after
round r every message knows its ancestor 2^r replies up, and each path is known
that far from its leaf. A path of n messages takes log2(n) rounds.

A turn is written ``<s>[INST]role[/INST]text</s>``. Inside roles and texts a
backslash follows every ``<``, ``[`` and backslash, so that no control string
can occur there and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.sources.shared import settle

OPEN, SPLIT, CLOSE = "<s>[INST]", "[/INST]", "</s>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def reply_paths(messages: DataFrame) -> DataFrame:
    """(leaf, msg, depth): every path of the trees, depth counted from the leaf.

    ``messages`` has msg and parent, both long; a null or unknown parent makes
    a root. Messages on a cycle have no root and give no path.
    """
    links = messages.select("msg", "parent")
    known_parents = links.select(F.col("msg").alias("parent")).distinct()
    up = settle(links.join(known_parents, "parent").select(F.col("msg").alias("low"), F.col("parent").alias("high")), "reply-links")
    leaves = links.select("msg").distinct().join(up.select(F.col("high").alias("msg")).distinct(), "msg", "left_anti")
    paths = settle(leaves.select(F.col("msg").alias("leaf"), "msg", F.lit(0).alias("depth")), "reply-paths")
    reach = 1
    while not up.isEmpty():
        further = paths.join(up, F.col("msg") == F.col("low")).select("leaf", F.col("high").alias("msg"), (F.col("depth") + reach).alias("depth"))
        longer = settle(paths.union(further), "reply-paths")
        if further.isEmpty():
            break
        twice = up.select(F.col("low").alias("l"), F.col("high").alias("mid")).join(up, F.col("mid") == F.col("low"))
        up, paths, reach = settle(twice.select(F.col("l").alias("low"), "high"), "reply-links"), longer, reach * 2
        if up.isEmpty():
            break
    return paths


def ranked_branches(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """(tree, leaf, branch, branch_score, msg, depth) of the best branches of each tree.

    A branch's score is the mean of its messages' scores (null counts as 0);
    ties go to the longer branch, then to the smaller leaf. ``best`` None
    keeps all branches.
    """
    paths = reply_paths(messages)
    own = messages.select("msg", "tree", F.coalesce("score", F.lit(0.0)).alias("s"))
    scored = paths.join(own, "msg")
    branches = scored.groupBy("tree", "leaf").agg(F.avg("s").alias("branch_score"), F.count("*").alias("n"))
    order = "row_number() over (partition by tree order by branch_score desc, n desc, leaf) as branch"
    branches = branches.selectExpr("tree", "leaf", "branch_score", order)
    if best is not None:
        branches = branches.filter(F.col("branch") <= best)
    return paths.join(branches, "leaf").select("tree", "leaf", "branch", "branch_score", "msg", "depth")


def format_conversations(messages: DataFrame, best: int | None = 1, trained_role: str = "assistant") -> DataFrame:
    """(tree, branch, branch_score, n_turns, formatted, loss_spans), one row per chosen path.

    ``messages`` has tree, msg (unique), parent, role, text and score.
    ``loss_spans`` are (start, length) in code points of the formatted text:
    the escaped texts of the trained role. Null texts and roles are empty.
    """
    chosen = ranked_branches(messages, best)
    texts = messages.select("msg", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = chosen.join(texts, "msg").select(
        "tree", "branch", "branch_score", (-F.col("depth")).alias("place"), F.col("role") == trained_role,
        F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(SPLIT)).alias("head"), escaped(F.col("text")).alias("body"),
    ).toDF("tree", "branch", "branch_score", "place", "trained", "head", "body")
    gathered = turns.groupBy("tree", "branch", "branch_score").agg(F.sort_array(F.collect_list(F.struct("place", "head", "body", "trained"))).alias("t"))
    formatted = F.array_join(F.transform("t", lambda x: F.concat(x.head, x.body, F.lit(CLOSE))), "")
    spans = F.expr(
        f"aggregate(t, struct(0 as at, cast(array() as array<struct<start:int,length:int>>) as spans), (s, x) -> struct("
        f"s.at + char_length(x.head) + char_length(x.body) + {len(CLOSE)} as at, "
        "if(x.trained, array_append(s.spans, struct(s.at + char_length(x.head) as start, char_length(x.body) as length)), s.spans) as spans)).spans"
    )
    return gathered.select("tree", "branch", "branch_score", F.size("t").cast("long").alias("n_turns"), formatted.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: str = "formatted") -> Column:
    """Array of (role, text) parsed from a formatted conversation."""
    pieces = F.expr(f"filter(split({formatted}, '{CLOSE}'), x -> x <> '')")
    cut = len(OPEN) + 1
    role = lambda x: F.substring_index(F.substr(x, F.lit(cut)), SPLIT, 1)
    text = lambda x: F.substr(x, F.char_length(role(x)) + F.lit(cut + len(SPLIT)))
    return F.transform(pieces, lambda x: F.struct(unescaped(role(x)).alias("role"), unescaped(text(x)).alias("text")))


def loss_text(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, read from the formatted conversation."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(F.col(formatted), s.start + 1, s.length))), "")


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Messages of conversations whose rows follow each other by turn.

    Each row replies to the one before it; equal turns are ordered by role
    and text, null turns come first. Messages get numbers from the hash of
    conversation and place; a null conv_id is a conversation of its own.
    """
    rows = conversations.select("conv_id", F.col("turn").alias("t"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    placed = rows.selectExpr("*", "row_number() over (partition by conv_id order by t, role, text) as place")
    number = lambda place: F.xxhash64(F.col("conv_id"), F.col("conv_id").isNull(), place)
    return placed.select(
        F.col("conv_id").alias("tree"), number(F.col("place")).alias("msg"),
        F.when(F.col("place") > 1, number(F.col("place") - 1)).alias("parent"), "role", "text", F.lit(0.0).alias("score"),
    )
